"""Queries of the text functions.  Texts are built around columns of the given tables, so that SQL can say what is in them."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusproof.functions import helpers, markup, text
from corpusproof.operators import pages
from corpusproof.plans.bindings import PAGES, page_ledger, table
from corpusproof.plans.registry import query


def _say(*parts):
    """Concatenation of column names (in braces) and literal texts."""
    return F.concat(*(F.coalesce(F.col(p[1:-1]).cast("string"), F.lit("")) if p.startswith("{") and p.endswith("}") else F.lit(p) for p in parts))


@query("""SELECT doc_id, 'numbers' AS kind, CAST(n_chars AS VARCHAR) AS value FROM documents WHERE n_chars >= 10
UNION ALL SELECT doc_id, 'acronyms', upper(lang) || 'X' FROM documents UNION ALL SELECT doc_id, unnest(['names', 'names', 'names', 'quotes']), unnest([lang || '-job', source || '_table', 'DataMart', 'one two three ' || lang]) FROM documents""")
def text_specifics(spark, sf):
    block = _say("- The ", "{source}", "_table of ", "{mark}", "X runs `", "{lang}", '-job` for DataMart, "one two three ', "{lang}", '" and "too short" [p:99] in ', "{n_chars}", " steps by [its](77-page.md) API")
    rows = table(spark, sf, "documents").withColumn("mark", F.upper("lang")).select("doc_id", text.specifics(block).alias("s"))
    return rows.select("doc_id", F.explode(F.map_from_arrays(F.array(*map(F.lit, ("numbers", "acronyms", "names", "quotes"))), F.array("s.numbers", "s.acronyms", "s.names", "s.quotes"))).alias("kind", "v")).select("doc_id", "kind", F.explode("v").alias("value"))


@query("""SELECT doc_id, unnest([lang || '/f' || CAST(doc_id AS VARCHAR) || '.py', 'a b.sql']) AS path, unnest([n_chars, 3]) AS start, unnest([n_chars, n_chars + 3]) AS "end" FROM documents""")
def text_source_citations(spark, sf):
    said = _say("It retries (src: ", "{lang}", "/f", "{doc_id}", ".py:", "{n_chars}", ") twice (src: a b.sql:3-", "{more}", ") (src: none) (src: x:y)")
    rows = table(spark, sf, "documents").withColumn("more", F.col("n_chars") + 3)
    return rows.select("doc_id", F.explode(text.source_citations(said)).alias("c")).select("doc_id", "c.path", "c.start", "c.end")


@query("""SELECT doc_id, CAST(doc_id AS VARCHAR) AS page_id, substring(text, 1, 40) AS title, 'body: ' || lang AS body FROM documents""")
def text_front_matter(spark, sf):
    """Front matter is built and read back; titles hold quotes, colons and line ends."""
    made = F.concat(text.build_front_matter({"page_id": F.col("doc_id"), "title": F.substring("text", 1, 40)}), _say("body: ", "{lang}"))
    rows = table(spark, sf, "documents").select("doc_id", text.front_matter(made).alias("f"))
    return rows.select("doc_id", F.col("f.fields")["page_id"].alias("page_id"), F.col("f.fields")["title"].alias("title"), "f.body")


@query("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'rest of ' || lang ELSE '## no title ' || lang END AS body FROM documents""")
def text_without_title(spark, sf):
    made = F.when(F.col("doc_id") % 2 == 0, _say("\n# Title ", "{source}", "\nrest of ", "{lang}")).otherwise(_say("## no title ", "{lang}"))
    return table(spark, sf, "documents").select("doc_id", text.without_title(made).alias("body"))


@query("""SELECT doc_id, unnest(['top ' || CAST(doc_id AS VARCHAR), 'quoted ' || lang, source]) AS heading FROM documents""")
def text_headings(spark, sf):
    made = _say("# Top  ", "{doc_id}", "\ntext # no\n> ## Quoted **", "{lang}", "**\n#none\n### ", "{source}", "\n")
    return table(spark, sf, "documents").select("doc_id", F.explode(text.headings_in(made)).alias("heading"))


@query("""SELECT doc_id, unnest([false, true, false, false, false]) AS image, unnest(['outside://S/' || lang, 'attachments/' || CAST(doc_id AS VARCHAR) || '/a.png', 'https://x.org/' || source, CAST(doc_id AS VARCHAR) || '-page.md#part', '#here']) AS target,
 unnest(['outside', 'attachment', 'external', 'page', 'other']) AS kind FROM documents""")
def text_links(spark, sf):
    made = _say("[a](outside://S/", "{lang}", ") ![i](attachments/", "{doc_id}", "/a.png) [b](https://x.org/", "{source}", ") [c](", "{doc_id}", "-page.md#part) [d](#here) [e] (f)")
    return table(spark, sf, "documents").select("doc_id", F.explode(text.markdown_links(made)).alias("l")).select("doc_id", "l.image", "l.target", "l.kind")


@query("""SELECT doc_id, unnest(['ac:link', 'ri:page']) AS tag FROM documents WHERE doc_id % 2 = 0""")
def text_leftover_markup(spark, sf):
    made = F.when(F.col("doc_id") % 2 == 0, _say("<ac:link x> ", "{lang}", "</ri:page> </ac:link> <p>")).otherwise(_say("<p> ac:link ", "{text}"))
    return table(spark, sf, "documents").select("doc_id", F.explode(text.leftover_markup(made)).alias("tag"))


@query("""SELECT doc_id, '*' || source || '_[' || lang || ']\\' AS plain FROM documents""")
def text_unescaped(spark, sf):
    made = _say("\\*", "{source}", "\\_\\[", "{lang}", "\\]\\\\")
    return table(spark, sf, "documents").select("doc_id", text.unescaped(made).alias("plain"))


@query("""SELECT doc_id, (['not documented in ' || lang, 'None.', 'rule of ' || source, 'none [p:1]'])[doc_id % 4 + 1] AS bare, doc_id % 4 <> 2 AS exempt FROM documents""")
def text_bare_blocks(spark, sf):
    blocks = F.array(_say("- not documented in ", "{lang}"), F.lit("  12. None."), _say("* rule of ", "{source}"), F.lit("none [p:1]"))
    rows = table(spark, sf, "documents").select("doc_id", blocks[(F.col("doc_id") % 4).cast("int")].alias("block"))
    return rows.select("doc_id", text.bare_block(F.col("block")).alias("bare"), text.is_exempt(F.col("block")).alias("exempt"))


@query("SELECT doc_id, 'org__' || lang || '__' || source AS folder FROM documents")
def text_repo_folders(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.repo_folder(F.concat_ws("/", F.lit("org"), "lang", "source")).alias("folder"))


@query("""SELECT conv_id, turn, 'About ' || role || chr(10) || coalesce(text, '') || chr(10) || chr(10) || 'first' || chr(10) || CAST(turn AS VARCHAR) AS ticket FROM conversations""")
def ticket_texts(spark, sf):
    comments = F.array(F.struct(F.lit("first").alias("body")), F.struct(F.col("turn").cast("string").alias("body")))
    rows = table(spark, sf, "conversations")
    return rows.select("conv_id", "turn", text.ticket_text(_say("About ", "{role}"), F.col("text"), F.lit(None).cast("string"), comments).alias("ticket"))


@query("""SELECT conv_id, turn, unnest(['h' || CAST(turn AS VARCHAR), 'g']) AS hash, unnest([coalesce(text, ''), '']) AS message FROM conversations""")
def commit_log_records(spark, sf):
    log = _say("\n h", "{turn}", "\u001f", "{text}", "\u001e g \u001e \u001e")
    return table(spark, sf, "conversations").select("conv_id", "turn", F.explode(text.commit_records(log)).alias("c")).select("conv_id", "turn", "c.hash", "c.message")


@query("""SELECT page_id, 'attachments/' || CAST(page_id AS VARCHAR) || '/flow%20one%20%28' || CAST(page_id AS VARCHAR) || '%29%2A~/%C3%A9.png' AS url FROM pages""")
def page_attachment_urls(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.attachment_url(F.col("page_id"), _say("flow one (", "{page_id}", ")*~/é.png")).alias("url"))


@query("""SELECT doc_id, (['## ' || lang, '###### ' || lang, 'plain # ' || lang])[doc_id % 3 + 1] AS line FROM documents""")
def text_demoted_headings(spark, sf):
    lines = F.array(_say("# ", "{lang}"), _say("##### ", "{lang}"), _say("plain # ", "{lang}"))
    return table(spark, sf, "documents").select("doc_id", text.demoted_headings(lines[(F.col("doc_id") % 3).cast("int")]).alias("line"))


@query("""SELECT doc_id, ([lang || chr(10) || 'after', lang || chr(10) || 'after', lang])[doc_id % 3 + 1] AS text, CAST(([1, 2, 1])[doc_id % 3 + 1] AS INT) AS blocks FROM documents""")
def text_outside_fences(spark, sf):
    """A block that holds other fences, two blocks of which one is quoted, and one that is not closed."""
    bodies = F.array(_say("{lang}", "\n````sql\n```\n~~~\n````x\n````\nafter"), _say("{lang}", "\n```\na\n```\n> ~~~~\n> b\n> ~~~~\nafter"), _say("{lang}", "\n~~~ js\n```\nafter"))
    rows = table(spark, sf, "documents").select("doc_id", markup.outside_fences(bodies[(F.col("doc_id") % 3).cast("int")]).alias("o"))
    return rows.select("doc_id", "o.text", "o.blocks")


@query("""SELECT doc_id, lang || ' & é <' || source || '> "' AS plain, 'Gro e ' || lang AS folded FROM documents""")
def text_entities_and_folding(spark, sf):
    rows = table(spark, sf, "documents")
    return rows.select("doc_id", helpers.unescape_entities(_say("{lang}", " &amp; &eacute; &lt;", "{source}", "&gt; &quot;")).alias("plain"), helpers.ascii_folded(_say("Größ é ", "{lang}")).alias("folded"))


_SLUG = "trim(substring(trim(lower(regexp_replace(regexp_replace(strip_accents(title), '[^\\x00-\\x7F]', '', 'g'), '[^A-Za-z0-9]+', '-', 'g')), '-'), 1, 60), '-')"


@query(f"WITH {PAGES} SELECT page_id, CAST(page_id AS VARCHAR) || '-' || CASE WHEN {_SLUG} = '' THEN 'page' ELSE {_SLUG} END || '.md' AS md_name FROM page_rows")
def page_file_names(spark, sf):
    return pages.with_file_name(page_ledger(spark, sf)).select("page_id", "md_name")


@query("""WITH b AS (SELECT page_id, page_id % 4 AS k FROM pages)
SELECT page_id, 'toc' AS macro, CAST(CASE WHEN k = 1 THEN 2 ELSE 1 END AS INT) AS n FROM b WHERE k <> 3 UNION ALL SELECT page_id, 'unnamed', 1 FROM b WHERE k = 2 UNION ALL SELECT page_id, 'jira', 1 FROM b WHERE k = 1""")
def page_bodyless_macros(spark, sf):
    """Macros in either tag, of any case, without a name, with a blank or a real ticket key, quiet ones, nested ones and ones inside CDATA."""
    rows = table(spark, sf, "pages")
    key = lambda v: f'<ac:macro ac:name="Jira"><ac:parameter ac:name="key">{v}</ac:parameter></ac:macro>'
    toc, status = '<ac:structured-macro ac:name="TOC" />', '<ac:structured-macro ac:name="status"><ac:parameter ac:name="title">x</ac:parameter></ac:structured-macro>'
    code = '<ac:structured-macro ac:name="code"><ac:plain-text-body><![CDATA[<ac:macro ac:name="no"/>]]></ac:plain-text-body></ac:structured-macro>'
    kinds = [toc + status + code, toc + '<ac:macro ac:name="toc"></ac:macro>' + key(" "), '<ac:structured-macro><ac:parameter ac:name="a">b</ac:parameter></ac:structured-macro>' + toc + key("PAY-1"), code + key("PAY-2") + status]
    html = F.concat("html", F.array(*map(F.lit, kinds))[(F.col("page_id") % 4).cast("int")])
    return markup.bodyless_macros(rows.select("page_id", html.alias("html"))).select("page_id", "macro", "n")


@query("""WITH n AS (SELECT page_id, page_id % 3 AS k FROM pages) SELECT 'toc' AS macro, count(*) AS n, count(*) AS pages FROM n WHERE k = 0 UNION ALL SELECT 'chart', 2 * count(*), count(*) FROM n WHERE k <= 1""")
def page_placeholder_totals(spark, sf):
    chart, toc = "[MACRO: chart] and [MACRO: chart]\n```\n[MACRO: toc]\n```\n", "[MACRO: toc]"
    made = F.when(F.col("page_id") % 3 == 0, chart + toc).when(F.col("page_id") % 3 == 1, chart).otherwise(F.lit("```\n[MACRO: toc]\n"))
    return pages.placeholder_totals(table(spark, sf, "pages").select("page_id", made.alias("markdown")))


@query("""WITH l AS (SELECT 'outside://S/' || CAST(page_id % 80 AS VARCHAR) AS target, page_id FROM pages UNION ALL SELECT 'outside://S/7', page_id FROM pages WHERE page_id % 2 = 0)
SELECT target, count(*) AS n FROM l GROUP BY 1 ORDER BY n DESC, target LIMIT 50""")
def page_outside_links(spark, sf):
    made = F.concat(_say("[a](outside://S/"), (F.col("page_id") % 80).cast("string"), F.lit(") [in](5-x.md)\n"), F.when(F.col("page_id") % 2 == 0, "[b](outside://S/7)").otherwise("```\n[b](outside://S/8)\n```"))
    return pages.outside_links(table(spark, sf, "pages").select("page_id", made.alias("markdown")))
