"""The registered queries of the library's own operators, each with its DuckDB counterpart where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusproof.functions import markdown, text
from corpusproof.operators import entries, handbook, ledger, linkage, pages, repos, tickets
from corpusproof.plans.bindings import (
    CHAPTERS,
    ENTRIES,
    LEDGER,
    LINES,
    MADE_USED,
    PAGES,
    REFS,
    SECOND,
    chapter_rows,
    document_lines,
    entry_rows,
    made_and_used,
    norm_sql,
    page_ledger,
    second_inventory,
    table,
    ticket_refs,
)
from corpusproof.plans.bindings import ledger as ledger_rows
from corpusproof.plans.registry import ORACLES, QUERIES, query
from corpusproof.sources.shared import checkpointed

NOW = "2024-05-06 07:08:00"
HTML_TAGS = ("table", "tr", "td", "th", "ul", "ol", "li", "p", "div", "pre")


# ---- ledger ----


@query(f"""WITH {LEDGER} SELECT status, count(*) AS n FROM ledger GROUP BY 1 UNION ALL SELECT '(total)', count(*) FROM ledger
UNION ALL SELECT '(still open)', count(*) FROM ledger WHERE status IN ('pending', 'done', 'failed')""")
def ledger_status_counts(spark, sf):
    return ledger.status_counts(ledger_rows(spark, sf))


@query(f"""WITH {LEDGER} SELECT key, status, attempts FROM ledger WHERE status IN ('failed', 'pending') AND space = 'en'
ORDER BY CASE status WHEN 'failed' THEN 1 ELSE 2 END, row_no LIMIT 25""")
def ledger_next_batch(spark, sf):
    return ledger.next_batch(ledger_rows(spark, sf), 25, where={"space": "en"}).select("key", "status", "attempts")


@query(f"""WITH {LEDGER}, {SECOND}, j AS (SELECT coalesce(a.key, b.key) AS key, a.key AS ka, b.key AS kb, a.version AS va, b.version AS vb, a.space AS sa, b.space AS sb
 FROM ledger a FULL JOIN second b ON a.key = b.key)
SELECT key, 'only_first' AS change, NULL AS field, NULL AS old, NULL AS new FROM j WHERE kb IS NULL
UNION ALL SELECT key, 'only_second', NULL, NULL, NULL FROM j WHERE ka IS NULL
UNION ALL SELECT key, 'changed', 'version', va, vb FROM j WHERE ka IS NOT NULL AND kb IS NOT NULL AND coalesce(va, '') <> coalesce(vb, '')
UNION ALL SELECT key, 'changed', 'space', sa, sb FROM j WHERE ka IS NOT NULL AND kb IS NOT NULL AND coalesce(sa, '') <> coalesce(sb, '')""")
def ledger_difference(spark, sf):
    return ledger.ledger_diff(ledger_rows(spark, sf), second_inventory(spark, sf), "key", ["version", "space"])


@query(f"""WITH {LEDGER}, {SECOND} SELECT coalesce(a.key, b.key) AS key, coalesce(a.status, 'pending') AS status, coalesce(a.attempts, '0') AS attempts,
 coalesce(b.version, a.version) AS version, CASE WHEN a.key IS NULL THEN 'added' WHEN b.key IS NOT NULL THEN 'updated' END AS merge FROM ledger a FULL JOIN second b ON a.key = b.key""")
def ledger_merge_update(spark, sf):
    merged = ledger.merged(ledger_rows(spark, sf), second_inventory(spark, sf), "key", update=True)
    return merged.select("key", "status", "attempts", "version", "merge")


@query(f"""WITH {LEDGER}, {SECOND}, m AS (SELECT CASE WHEN a.key IS NULL THEN 'added' WHEN b.key IS NOT NULL THEN 'skipped' END AS merge FROM ledger a FULL JOIN second b ON a.key = b.key)
SELECT count(*) FILTER (merge = 'added') AS added, count(*) FILTER (merge = 'updated') AS updated, count(*) FILTER (merge = 'skipped') AS skipped, count(*) AS total FROM m""")
def ledger_merge_summary(spark, sf):
    return ledger.merge_summary(ledger.merged(ledger_rows(spark, sf), second_inventory(spark, sf), "key"))


@query(f"""WITH {LEDGER}, {SECOND}, j AS (SELECT coalesce(a.key, b.key) AS key, CASE WHEN a.key IS NULL THEN 'added' WHEN b.key IS NULL THEN 'removed'
 WHEN coalesce(a.version, '') <> coalesce(b.version, '') THEN 'changed' ELSE 'same' END AS change, a.status, coalesce(b.version, a.version) AS version FROM ledger a FULL JOIN second b ON a.key = b.key)
SELECT key, CASE change WHEN 'removed' THEN 'removed_at_source' WHEN 'same' THEN status ELSE 'pending' END AS status, version, change FROM j""")
def ledger_reconcile(spark, sf):
    return ledger.reconciled(ledger_rows(spark, sf), second_inventory(spark, sf), "key", ["version"]).select("key", "status", "version", "change")


@query(f"""WITH {LEDGER}, c AS (SELECT key, bool_and(ok) AS ok, string_agg(CASE WHEN NOT ok THEN name || ': ' || detail END, '; ' ORDER BY name) AS failing FROM (
 SELECT key, 'C1' AS name, CAST(version AS BIGINT) >= 200 AS ok, version AS detail FROM ledger UNION ALL SELECT key, 'C2', space <> 'de', space FROM ledger) GROUP BY key)
SELECT key, CASE WHEN ok THEN 'verified' WHEN CAST(attempts AS INT) + 1 >= 3 THEN 'needs_human' ELSE 'failed' END AS status,
 CASE WHEN ok THEN attempts ELSE CAST(CAST(attempts AS INT) + 1 AS VARCHAR) END AS attempts, CASE WHEN ok THEN '' ELSE '2024-05-06 07:08 ' || failing END AS notes FROM ledger JOIN c USING (key)""")
def ledger_apply_checks(spark, sf):
    rows = ledger_rows(spark, sf)
    from corpusproof.operators.checks import checks_of

    checks = checks_of(rows, "key", {"C1": (F.col("version").try_cast("bigint") >= 200, F.col("version")), "C2": (F.col("space") != "de", F.col("space"))})
    return ledger.with_verdicts(rows, ledger.verdicts(checks), "key", F.lit(NOW).cast("timestamp")).select("key", "status", "attempts", "notes")


@query(f"""WITH {LEDGER} SELECT key, CASE WHEN status = 'failed' AND space = 'en' THEN 'pending' ELSE status END AS status,
 CASE WHEN status = 'failed' AND space = 'en' THEN 'again' ELSE notes END AS notes FROM ledger""")
def ledger_bulk_set(spark, sf):
    return ledger.bulk_set(ledger_rows(spark, sf), {"status": "failed", "space": "en"}, {"status": "pending", "notes": "again"}).select("key", "status", "notes")


@query(f"""WITH {LEDGER}, {SECOND} SELECT coalesce(a.key, b.key) AS key, CASE WHEN b.key IS NULL THEN 'first' WHEN a.key IS NULL THEN 'second' ELSE 'both' END AS side FROM ledger a FULL JOIN second b ON a.key = b.key""")
def ledger_key_sets(spark, sf):
    return ledger.key_sets(ledger_rows(spark, sf), second_inventory(spark, sf), "key")


@query(f"""WITH {LEDGER} SELECT key, 'source status is ''' || status || '''' AS reason FROM ledger WHERE status <> 'verified'""")
def ledger_excluded(spark, sf):
    return ledger.seeded(ledger_rows(spark, sf), "key")[1]


@query(f"""WITH {LEDGER}, r AS (SELECT count(*) FILTER (status <> 'verified' AND status <> 'failed') AS open_rows, count(*) FILTER (status = 'failed' AND notes = '') AS unnoted FROM ledger)
SELECT open_rows = 0 AND unnoted = 0 AS accepted, open_rows, CAST(0 AS BIGINT) AS failing_checks, unnoted, '' AS missing FROM r""")
def ledger_acceptance(spark, sf):
    return ledger.acceptance(ledger_rows(spark, sf), noted=["failed"])


@query()
def ledger_sample(spark, sf):
    return ledger.sample_verified(ledger_rows(spark, sf), 20, 7).select("key", "status")


# ---- pages ----


@query(f"WITH {PAGES} SELECT title, count(*) AS n FROM page_rows GROUP BY 1 HAVING count(*) > 1")
def page_duplicate_titles(spark, sf):
    return pages.duplicate_keys(page_ledger(spark, sf), "title")


@query(f"WITH {PAGES} SELECT page_id, 'title' AS field FROM page_rows WHERE page_id % 11 = 3 OR trim(title) = '' UNION ALL SELECT page_id, 'space_key' FROM page_rows WHERE page_id % 7 = 2 OR trim(space_key) = ''")
def page_blank_fields(spark, sf):
    """Some titles are blank, some spaces are null."""
    rows = page_ledger(spark, sf).withColumns({"title": F.when(F.col("page_id") % 11 == 3, "  ").otherwise(F.col("title")), "space_key": F.when(F.col("page_id") % 7 != 2, F.col("space_key"))})
    return pages.blank_fields(rows, "page_id", ["title", "space_key"])


@query(f"""WITH {PAGES}, k AS (SELECT * FROM page_rows WHERE page_id % 6 <> 0 OR page_id = 0)
SELECT page_id, parent_id FROM k WHERE parent_id IS NOT NULL AND parent_id NOT IN (0) AND parent_id NOT IN (SELECT page_id FROM k)""")
def page_open_parents(spark, sf):
    rows = page_ledger(spark, sf).where("page_id % 6 <> 0 or page_id = 0").withColumns({"page_id": F.col("page_id").cast("string"), "parent_id": F.col("parent_id").cast("string")})
    return pages.open_parents(rows, roots=["0"]).select(F.col("page_id").cast("long").alias("page_id"), F.col("parent_id").cast("long").alias("parent_id"))


@query(f"""WITH {PAGES}, f AS (SELECT lower(title) AS name, page_id FROM page_rows) SELECT name, count(DISTINCT page_id) AS n FROM f GROUP BY 1 HAVING count(DISTINCT page_id) > 1""")
def page_clashing_names(spark, sf):
    return pages.clashing_names(page_ledger(spark, sf), "page_id", F.lower("title"))


@query(f"""WITH {PAGES}, r AS (SELECT page_id AS ref_no, CASE WHEN page_id % 3 = 0 THEN 'nowhere' ELSE space_key END AS space, CASE WHEN page_id % 5 = 0 THEN title || 'x' ELSE title END AS title FROM page_rows),
s AS (SELECT space_key, title, max_by(page_id, row_no) AS p FROM page_rows GROUP BY 1, 2), t AS (SELECT title, min_by(page_id, row_no) AS p FROM page_rows GROUP BY 1)
SELECT ref_no, coalesce(CAST(coalesce(s.p, t.p) AS VARCHAR), 'outside') AS target FROM r LEFT JOIN s ON s.space_key = r.space AND s.title = r.title LEFT JOIN t ON t.title = r.title""")
def page_title_targets(spark, sf):
    rows = page_ledger(spark, sf)
    refs = rows.select(F.col("page_id").alias("ref_no"), F.when(F.col("page_id") % 3 == 0, "nowhere").otherwise(F.col("space_key")).alias("space"), F.when(F.col("page_id") % 5 == 0, F.concat("title", F.lit("x"))).otherwise(F.col("title")).alias("title"), F.lit("").alias("content_id"), F.lit("").alias("href"))
    found = pages.resolved_targets(refs, rows)
    return found.select("ref_no", F.when(F.col("url").startswith("outside://"), "outside").otherwise(F.regexp_extract("url", "^(\\d+)-", 1)).alias("target"))


@query(f"""WITH RECURSIVE {PAGES}, up AS (SELECT page_id, page_id AS anc, n_words FROM page_rows UNION ALL SELECT u.page_id, p.parent_id, u.n_words FROM up u JOIN page_rows p ON p.page_id = u.anc WHERE p.parent_id IS NOT NULL)
SELECT anc AS page_id, count(*) AS pages, CAST(sum(n_words) AS BIGINT) AS words FROM up GROUP BY 1""")
def page_subtree_totals(spark, sf):
    return pages.subtree_totals(page_ledger(spark, sf))


@query(f"""WITH RECURSIVE {PAGES}, walk AS (SELECT page_id, 0 AS depth, [row_no] AS path FROM page_rows WHERE parent_id IS NULL
UNION ALL SELECT p.page_id, w.depth + 1, list_append(w.path, p.row_no) FROM walk w JOIN page_rows p ON p.parent_id = w.page_id)
SELECT page_id, depth, array_to_string(path, '/') AS path FROM walk""")
def page_tree_listing(spark, sf):
    return pages.tree_listing(page_ledger(spark, sf)).select("page_id", "depth", F.array_join(F.transform("path", lambda x: x.cast("string")), "/").alias("path"))


@query(f"""WITH RECURSIVE {PAGES}, walk AS (SELECT page_id, CAST(0 AS BIGINT) AS depth, [row_no] AS path FROM page_rows WHERE parent_id IS NULL
UNION ALL SELECT p.page_id, w.depth + 1, list_append(w.path, p.row_no) FROM walk w JOIN page_rows p ON p.parent_id = w.page_id)
SELECT page_id, depth, row_number() OVER (ORDER BY path) - 1 AS place FROM walk""")
def page_preorder(spark, sf):
    """The listing of the tree as numbers."""
    return pages.preorder(page_ledger(spark, sf))


def _visible(html: str) -> str:
    out = f"regexp_replace({html}, '(?s)<!--.*?-->', ' ', 'g')"
    for tag in ("script", "style", "head"):
        out = f"regexp_replace({out}, '(?is)<{tag}\\b[^>]*>.*?</{tag}\\s*>', ' ', 'g')"
    return f"regexp_replace({out}, '<[^>]*>', ' ', 'g')"


@query(f"""WITH w AS (SELECT page_id, lower(unnest(regexp_extract_all({_visible("html")}, '[\\p{{L}}\\p{{N}}_]+'))) AS word FROM pages),
h AS (SELECT page_id, lower(unnest(regexp_extract_all({_visible("CASE WHEN page_id % 3 = 0 THEN regexp_replace(html, '<p>[^<]*</p>', ' ') ELSE html END")}, '[\\p{{L}}\\p{{N}}_]+'))) AS word FROM pages),
a AS (SELECT page_id, word, count(*) AS want FROM w GROUP BY 1, 2), b AS (SELECT page_id, word, count(*) AS have FROM h GROUP BY 1, 2),
c AS (SELECT page_id, CAST(sum(want) AS BIGINT) AS wanted, CAST(sum(greatest(want - coalesce(have, 0), 0)) AS BIGINT) AS lost FROM a LEFT JOIN b USING (page_id, word) GROUP BY 1)
SELECT p.page_id, coalesce(wanted, 0) AS wanted, coalesce(lost, 0) AS lost, round(coalesce(1.0 - CAST(lost AS DOUBLE) / wanted, 1.0), 6) AS coverage FROM pages p LEFT JOIN c USING (page_id)""")
def page_word_coverage(spark, sf):
    """Every third page has lost its first paragraph."""
    rows = table(spark, sf, "pages")
    lost = F.when(F.col("page_id") % 3 == 0, F.regexp_replace("html", "(?s)^(.*?)<p>[^<]*</p>", "$1 ")).otherwise(F.col("html"))
    source = rows.select("page_id", text.visible_text(F.col("html")).alias("text"))
    derived = rows.select("page_id", text.visible_text(lost).alias("text"))
    found = pages.word_coverage(source, derived)
    return found.select("page_id", "wanted", "lost", F.round("coverage", 6).alias("coverage"))


@query("""SELECT page_id, CAST(len(regexp_extract_all(html, '(?i)<h[1-6]\\b')) AS INT) AS headings, CAST(len(regexp_extract_all(html, '(?i)<table\\b')) AS INT) AS tables,
 CAST(len(regexp_extract_all(html, '(?i)<a\\b[^>]*\\bhref=')) AS INT) AS links, CAST(len(regexp_extract_all(html, '(?i)<img\\b')) AS INT) AS images FROM pages""")
def page_structure(spark, sf):
    """All headings of these pages have text, so the plain count is the count of headings that must survive."""
    rows = table(spark, sf, "pages").select("page_id", pages.raw_structure(F.col("html")).alias("s"))
    return rows.select("page_id", "s.headings", "s.tables", "s.links", "s.images")


@query("""WITH t AS (SELECT page_id, html, unnest(['table','tr','td','th','ul','ol','li','p','div','pre']) AS tag FROM pages), n AS (SELECT page_id, tag,
 CAST(len(list_filter(regexp_extract_all(html, '(?i)<' || tag || '(\\s[^>]*)?>'), lambda x: x NOT LIKE '%/>')) AS INT) AS opened, CAST(len(regexp_extract_all(html, '(?i)</' || tag || '\\s*>')) AS INT) AS closed FROM t)
SELECT page_id, tag, opened, closed FROM n WHERE opened <> closed""")
def page_unbalanced_tags(spark, sf):
    rows = table(spark, sf, "pages").select("page_id", F.explode(pages.unbalanced_tags(F.col("html"), HTML_TAGS)).alias("u"))
    return rows.select("page_id", F.substring_index("u", " ", 1).alias("tag"), F.regexp_extract("u", " (\\d+)/", 1).cast("int").alias("opened"), F.regexp_extract("u", "/(\\d+)$", 1).cast("int").alias("closed"))


@query("""WITH n AS (SELECT page_id, trim(regexp_replace(html, '\\s+', ' ', 'g')) AS h FROM pages),
f AS (SELECT page_id, trim(regexp_replace(CASE WHEN page_id % 4 = 0 THEN html || '<p>more</p>' ELSE replace(html, ' ', '  ') END, '\\s+', ' ', 'g')) AS g FROM pages)
SELECT page_id, CASE WHEN page_id % 9 = 8 THEN 'FAIL' WHEN h = g THEN 'PASS' ELSE 'DIFF' END AS result FROM n JOIN f USING (page_id)""")
def page_compare_bodies(spark, sf):
    rows = table(spark, sf, "pages")
    fetched = rows.select("page_id", F.when(F.col("page_id") % 4 == 0, F.concat("html", F.lit("<p>more</p>"))).otherwise(F.replace("html", F.lit(" "), F.lit("  "))).alias("html"))
    return pages.compare_bodies(rows.where("page_id % 9 <> 8"), fetched)


@query()
def page_conversion(spark, sf):
    made = markdown.converted_pages(table(spark, sf, "pages"))
    return made.select("page_id", "body", "placeholders", F.array_join("warnings", "; ").alias("warnings"))


@query()
def page_checks(spark, sf):
    """Conversion of every page, then all checks of it against its source."""
    rows = page_ledger(spark, sf).withColumns({"page_id": F.col("page_id").cast("string"), "version": F.lit("1"), "source_url": F.col("url"), "empty_body": F.lit("no"), "attachment_count": F.lit("0")})
    named = pages.with_file_name(rows).withColumn("md_path", F.concat(F.lit("pages/"), "md_name")).drop("md_name")
    bodies = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("page_id"), "html")
    markdown = checkpointed(pages.convert(bodies, named))  # every check reads it
    none = spark.createDataFrame([], "page_id string, filename string, size long")
    return pages.page_checks(named, bodies, markdown, none)


# ---- text ----


@query("SELECT doc_id, CAST(len(regexp_extract_all(text, '[^\\s]+')) AS INT) AS n_words FROM documents")
def text_word_counts(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.word_count(F.col("text")).alias("n_words"))


@query("""WITH t AS (SELECT doc_id, unnest(list_distinct(list_filter(list_transform(regexp_extract_all(' ' || regexp_replace(text, '([^\\p{L}\\p{N}_.,])', '\\1 ', 'g') || ' ', '[\\p{L}\\p{N}_.,]+'),
 lambda x: CASE WHEN regexp_full_match(regexp_replace(x, '^[,]+', ''), '[0-9][0-9,.]*') THEN regexp_replace(replace(regexp_replace(x, '^[,]+', ''), ',', ''), '[.]+$', '') ELSE '' END), lambda x: length(regexp_replace(x, '[^0-9]', '', 'g')) >= 2))) AS number FROM documents)
SELECT doc_id, number FROM t""")
def text_numbers(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.explode(text.numbers_in(F.col("text"))).alias("number"))


@query("""WITH s AS (SELECT doc_id, unnest(list_filter([CASE WHEN regexp_matches(text, '\\bAKIA[0-9A-Z]{16}\\b') THEN 'AWS access key' END,
 CASE WHEN regexp_matches(text, '-----BEGIN [A-Z ]*PRIVATE KEY-----') THEN 'private key block' END, CASE WHEN regexp_matches(text, '\\bgh[pousr]_[A-Za-z0-9]{36,}\\b') THEN 'GitHub token' END,
 CASE WHEN regexp_matches(text, '\\bxox[baprs]-[A-Za-z0-9-]{10,}\\b') THEN 'Slack token' END, CASE WHEN regexp_matches(text, '\\bATATT[A-Za-z0-9_\\-=]{20,}\\b') THEN 'Atlassian API token' END,
 CASE WHEN regexp_matches(text, '\\bBearer\\s+[A-Za-z0-9_\\-.=]{30,}\\b') THEN 'bearer token' END,
 CASE WHEN regexp_matches(text, '(?i)\\b(password|passwd|secret|api[_-]?key|token)\\b\\s*[:=]\\s*[''"][^''"\\s<\\[{$]{8,}[''"]') THEN 'password assignment' END], lambda x: x IS NOT NULL)) AS label FROM documents) SELECT doc_id, label FROM s""")
def text_secrets(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.explode(text.secrets_in(F.col("text"))).alias("label"))


_REDACTED = "text"
for _pattern in ("\\bAKIA[0-9A-Z]{16}\\b", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "\\bgh[pousr]_[A-Za-z0-9]{36,}\\b", "\\bxox[baprs]-[A-Za-z0-9-]{10,}\\b", "\\bATATT[A-Za-z0-9_\\-=]{20,}\\b", "\\bBearer\\s+[A-Za-z0-9_\\-.=]{30,}\\b", "(?i)\\b(password|passwd|secret|api[_-]?key|token)\\b\\s*[:=]\\s*[''\"][^''\"\\s<\\[{$]{8,}[''\"]"):
    _REDACTED = f"regexp_replace({_REDACTED}, '{_pattern}', '[REDACTED]', 'g')"


@query(f"SELECT doc_id, md5({_REDACTED}) AS redacted, {_REDACTED} <> text AS changed FROM documents WHERE text IS NOT NULL")
def text_redacted(spark, sf):
    """Every text with all seven kinds of secrets replaced."""
    docs = table(spark, sf, "documents").where("text is not null").withColumn("r", text.redacted(F.col("text")))
    return docs.select("doc_id", F.md5("r").alias("redacted"), (F.col("r") != F.col("text")).alias("changed"))


_SECRETS = [
    ("AWS access key", "\\bAKIA[0-9A-Z]{16}\\b"), ("private key block", "-----BEGIN [A-Z ]*PRIVATE KEY-----"), ("GitHub token", "\\bgh[pousr]_[A-Za-z0-9]{36,}\\b"), ("Slack token", "\\bxox[baprs]-[A-Za-z0-9-]{10,}\\b"),
    ("Atlassian API token", "\\bATATT[A-Za-z0-9_\\-=]{20,}\\b"), ("bearer token", "\\bBearer\\s+[A-Za-z0-9_\\-.=]{30,}\\b"), ("password assignment", "(?i)\\b(?:password|passwd|secret|api[_-]?key|token)\\b\\s*[:=]\\s*[''\"][^''\"\\s<\\[{$]{8,}[''\"]"),
]
_PLACES = " UNION ALL ".join(f"SELECT doc_id, text, '{label}' AS label, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS found FROM documents WHERE regexp_matches(text, '{pattern}')" for label, pattern in _SECRETS)


@query(f"""WITH m AS ({_PLACES}), i AS (SELECT *, unnest(range(1, len(found) + 1)) AS k FROM m),
p AS (SELECT doc_id, text, label, CAST(list_sum(list_transform(gaps[1:k], lambda g: length(g))) + coalesce(list_sum(list_transform(found[1:k - 1], lambda f: length(f))), 0) AS INT) AS start, length(found[k]) AS size FROM i)
SELECT doc_id, CAST(length(substring(text, 1, start)) - length(replace(substring(text, 1, start), chr(10), '')) + 1 AS INT) AS line, start, label FROM p
WHERE NOT EXISTS (SELECT 1 FROM p q WHERE q.doc_id = p.doc_id AND (q.start < p.start OR q.start = p.start AND (q.size > p.size OR q.size = p.size AND q.label < p.label)) AND q.start + q.size > p.start)""")
def text_secret_places(spark, sf):
    """Where each secret of the whole texts stands."""
    docs = table(spark, sf, "documents").select("doc_id", F.explode(text.secret_places(F.col("text"))).alias("p"))
    return docs.select("doc_id", "p.line", "p.start", "p.label")


# ---- evidence ----


def _claims(spark, sf):
    items, docs = table(spark, sf, "benchmark"), table(spark, sf, "documents")
    n = docs.agg(F.count("*").alias("n"))
    return items.crossJoin(F.broadcast(n)).select("item_id", F.col("text").alias("quote"), F.explode(F.sequence(F.lit(0), F.lit(49))).alias("k"), "n").select("item_id", "quote", ((F.col("item_id") * 37 + F.col("k") * 211) % F.col("n")).cast("string").alias("source")).withColumn("where", F.lit("(top)"))


@query(f"""WITH c AS (SELECT item_id, text AS quote, (item_id * 37 + k * 211) % (SELECT count(*) FROM documents) AS doc_id FROM benchmark, range(50) AS r(k)),
n AS (SELECT doc_id, {norm_sql("text")} AS form FROM documents)
SELECT item_id, CAST(doc_id AS VARCHAR) AS source, contains(form, {norm_sql("quote")}) AS found FROM c JOIN n USING (doc_id)""")
def evidence_in_pages(spark, sf):
    """Fifty claims for each item, joined with pages whose text is normalised once."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("source"), F.col("text").alias("markdown"))
    return entries.page_evidence(_claims(spark, sf), docs).select("item_id", "source", "found")


@query(f"""WITH {LINES}, q AS (SELECT repo, path, line AS spot, greatest(1, line + CASE CAST(path AS BIGINT) % 3 WHEN 0 THEN 0 WHEN 1 THEN -1 ELSE 40 END) AS cited, array_to_string(string_split(text, ' ')[1:6], ' ') AS quote FROM doc_lines WHERE len(string_split(text, ' ')) >= 6),
n AS (SELECT path AS p, max(line) AS last FROM doc_lines GROUP BY 1)
SELECT path, spot, cited <= last AS found FROM q JOIN n ON p = path""")
def evidence_places(spark, sf):
    """Citations of lines, some beyond the end of their file."""
    lines = document_lines(spark, sf)
    stats = repos.file_stats(table(spark, sf, "documents").select(F.col("source").alias("repo"), F.col("doc_id").cast("string").alias("path"), F.col("text").alias("content")))
    shift = F.when(F.col("path").cast("long") % 3 == 0, 0).when(F.col("path").cast("long") % 3 == 1, -1).otherwise(40)
    cites = lines.where(F.size(F.split("text", " ")) >= 6).select("repo", "path", F.col("line").alias("spot"), F.greatest(F.lit(1), F.col("line") + shift).alias("lo")).withColumn("hi", F.col("lo"))
    bad = repos.unresolved_citations(cites, stats).select("path", "spot", F.lit(True).alias("bad"))
    return cites.join(bad, ["path", "spot"], "left").select("path", "spot", F.col("bad").isNull().alias("found"))


@query(f"""WITH {LINES}, q AS (SELECT repo, path, greatest(1, line + CASE CAST(path AS BIGINT) % 3 WHEN 0 THEN 0 WHEN 1 THEN -1 ELSE 40 END) AS cited, array_to_string(string_split(text, ' ')[1:6], ' ') AS quote FROM doc_lines WHERE len(string_split(text, ' ')) >= 6),
w AS (SELECT q.repo, q.path, cited, quote, bool_or(l.line = cited) AS here, {norm_sql("string_agg(l.text, chr(10) ORDER BY l.line)")} AS around FROM q JOIN doc_lines l ON l.repo = q.repo AND l.path = q.path AND l.line BETWEEN cited - 20 AND cited + 20 GROUP BY 1, 2, 3, 4),
f AS (SELECT repo, path, {norm_sql("string_agg(text, chr(10) ORDER BY line)")} AS body FROM doc_lines GROUP BY 1, 2)
SELECT DISTINCT q.path, q.cited, q.quote, CASE WHEN NOT coalesce(here, false) THEN 'no such place' WHEN contains(around, {norm_sql("q.quote")}) AND {norm_sql("q.quote")} <> '' THEN 'ok' WHEN contains(body, {norm_sql("q.quote")}) AND {norm_sql("q.quote")} <> '' THEN 'not near' ELSE 'not found' END AS result
FROM q LEFT JOIN w ON w.repo = q.repo AND w.path = q.path AND w.cited = q.cited AND w.quote = q.quote JOIN f ON f.repo = q.repo AND f.path = q.path""")
def evidence_near_lines(spark, sf):
    """Quotes of six words, cited at, before or far behind their line."""
    lines = document_lines(spark, sf)
    shift = F.when(F.col("path").cast("long") % 3 == 0, 0).when(F.col("path").cast("long") % 3 == 1, -1).otherwise(40)
    rows = lines.where(F.size(F.split("text", " ")) >= 6).select("repo", "path", F.greatest(F.lit(1), F.col("line") + shift).alias("cited"), F.array_join(F.slice(F.split("text", " "), 1, 6), " ").alias("quote"))
    files = lines.select(F.concat_ws("/", "repo", "path").alias("path"), F.lit("all").alias("repo"), "line", "text")
    quotes = rows.select(F.lit("all").alias("source"), F.concat_ws(":", F.concat_ws("/", "repo", "path"), F.col("cited").cast("string")).alias("where"), "quote").distinct()
    found = entries.line_evidence(quotes, files)
    return found.select(F.regexp_extract("where", "/([^/:]*):", 1).alias("path"), F.regexp_extract("where", ":(\\d+)$", 1).cast("long").alias("cited"), "quote", "result").distinct()


# ---- linkage ----


@query(f"""WITH {MADE_USED} SELECT u.repo, u.part, count(m.repo) AS n, coalesce(string_agg(m.repo, ',' ORDER BY m.repo), '') AS makers FROM used u LEFT JOIN made m ON m.part = u.part AND m.repo <> u.repo GROUP BY 1, 2""")
def link_producers(spark, sf):
    made, used = made_and_used(spark, sf)
    rows = lambda df: df.select("repo", F.lit("table").alias("kind"), F.col("part").alias("id"))
    found = linkage.producers_of(rows(used), rows(made))
    return found.select("repo", F.col("id").alias("part"), F.size("producers").cast("long").alias("n"), F.array_join(F.transform("producers", lambda p: p["producer"]), ",").alias("makers"))


def _identifiers(spark, sf):
    words = table(spark, sf, "benchmark").select("item_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0))).alias("identifier"))
    return linkage.searchable(words.select("identifier", F.concat(F.lit("src"), (F.col("item_id") % 8).cast("string")).alias("target")).distinct())[0]


_GENERIC = ", ".join(f"'{g}'" for g in linkage.GENERIC)
_IDS = f"""ids AS (SELECT DISTINCT w AS identifier, 'src' || CAST(item_id % 8 AS VARCHAR) AS target FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM benchmark) WHERE length(w) >= 5 AND w NOT IN ({_GENERIC}))"""


@query(f"""WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS identifier, 'src' || CAST(item_id % 8 AS VARCHAR) AS target FROM benchmark)
SELECT identifier, target, CASE WHEN length(identifier) < {linkage.SHORTEST} THEN 'shorter than {linkage.SHORTEST}' ELSE 'generic' END AS reason FROM w WHERE length(identifier) < {linkage.SHORTEST} OR identifier IN ({_GENERIC})""")
def link_left_out(spark, sf):
    """Identifiers that are not searched for, with their reasons."""
    words = table(spark, sf, "benchmark").select("item_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0))).alias("identifier"))
    return linkage.searchable(words.select("identifier", F.concat(F.lit("src"), (F.col("item_id") % 8).cast("string")).alias("target")).distinct())[1]


_TRIM = "regexp_replace(regexp_replace(regexp_replace(x, '^[./-]+|[./-]+$', '', 'g'), '\\.git$', ''), '^[./-]+|[./-]+$', '', 'g')"
_TOKENS = f"""tok AS (SELECT repo, path, line, unnest(list_distinct(list_transform(list_filter(flatten(list_transform(regexp_extract_all(text, '[A-Za-z0-9_./:@\\-]+'), lambda t: list_transform(regexp_split_to_array(t, '[:@]'), lambda x: {_TRIM}))), lambda y: y <> '' AND NOT contains(y, '/')), lambda z: lower(z)))) AS identifier FROM doc_lines WHERE length(text) <= 2000)"""


@query(f"""WITH {LINES}, {_IDS}, {_TOKENS}, hits AS (SELECT DISTINCT repo, target, identifier, path, line FROM tok JOIN ids USING (identifier) WHERE target <> repo)
SELECT repo, target, identifier, count(*) AS n FROM hits GROUP BY 1, 2, 3""")
def link_mentions(spark, sf):
    """No token of these texts has a slash inside, so tokens are their own parts."""
    return linkage.mention_counts(linkage.mention_rows(document_lines(spark, sf), _identifiers(spark, sf)))


@query(f"""WITH {LINES}, {_IDS}, {_TOKENS}, hits AS (SELECT DISTINCT repo, target, identifier, path, line FROM tok JOIN ids USING (identifier) WHERE target <> repo),
k AS (SELECT *, row_number() OVER (PARTITION BY repo, target, identifier ORDER BY path, line) AS place FROM hits)
SELECT repo, target, identifier, string_agg(path || ':' || CAST(line AS VARCHAR), ' ' ORDER BY place) AS samples FROM k WHERE place <= 3 GROUP BY 1, 2, 3""")
def link_mention_samples(spark, sf):
    lines = document_lines(spark, sf)
    rows = linkage.mention_samples(linkage.mention_rows(lines, _identifiers(spark, sf)), lines)
    return rows.select("repo", "target", "identifier", F.array_join(F.transform("samples", lambda s: F.concat_ws(":", s["path"], s["line"].cast("string"))), " ").alias("samples"))


@query(f"""WITH {LINES}, h AS (SELECT repo, path, line, CASE WHEN line % 9 = 4 THEN 'webhook' ELSE 'gha_schedule' END AS label, line % 9 = 4 AS "cross", row_number() OVER (PARTITION BY repo ORDER BY path, line) AS k FROM doc_lines WHERE length(text) <= 1900 AND line % 9 IN (4, 7))
SELECT repo, path, line, label, "cross" FROM h WHERE k <= 300""")
def link_trigger_hits(spark, sf):
    """Every line as it is, but some short ones begin with a schedule or end with a webhook."""
    lines = document_lines(spark, sf)
    said = F.when(F.length("text") > 1900, F.col("text")).when(F.col("line") % 9 == 4, F.concat("text", F.lit(" calls a WebHook"))).when(F.col("line") % 9 == 7, F.concat(F.lit(" - cron: '0 1 * * *' "), F.col("text"))).otherwise(F.col("text"))
    return linkage.trigger_hits(lines.withColumn("text", said)).select("repo", "path", "line", "label", "cross")


@query(f"""WITH {LINES} SELECT repo, path, line FROM doc_lines WHERE NOT (CAST(path AS BIGINT) % 2 = 0 AND (line BETWEEN 1 AND 5 OR line BETWEEN 10 AND 2000))""")
def link_uncited_lines(spark, sf):
    """Lines that are cited nowhere: files are cited in a short range and in one of 1991 lines."""
    lines = document_lines(spark, sf)
    files = table(spark, sf, "documents").where("doc_id % 2 = 0").select(F.col("source").alias("cited_repo"), F.col("doc_id").cast("string").alias("path"))
    cites = files.select("*", F.lit(1).cast("long").alias("lo"), F.lit(5).cast("long").alias("hi")).union(files.select("*", F.lit(10).cast("long"), F.lit(2000).cast("long")))
    return linkage.uncited_lines(lines.select("repo", "path", "line"), cites)


_EDGES = f"""{MADE_USED}, e AS (SELECT u.repo AS from_repo, m.repo AS to_repo, u.part AS identifier, 'reads' AS kind, 0 AS origin, CAST(u.part AS BIGINT) AS seq FROM used u JOIN made m ON m.part = u.part AND m.repo <> u.repo
 UNION ALL SELECT m.repo, u.repo, u.part, 'feeds:table', 1, CAST(u.part AS BIGINT) FROM used u JOIN made m ON m.part = u.part AND m.repo < u.repo),
 edges AS (SELECT from_repo, to_repo, identifier, kind FROM (SELECT *, row_number() OVER (PARTITION BY from_repo, to_repo, identifier ORDER BY origin, seq) AS k FROM e) WHERE k = 1)"""


def _edges(spark, sf):
    made, used = made_and_used(spark, sf)
    pairs = used.join(made.withColumnRenamed("repo", "maker"), "part").where("maker <> repo")
    a = pairs.select(F.col("repo").alias("from_repo"), F.col("maker").alias("to_repo"), F.col("part").alias("identifier"), F.lit("reads").alias("kind"), F.lit(0).alias("origin"), F.col("part").cast("long").alias("seq"))
    b = pairs.where("maker < repo").select(F.col("maker").alias("from_repo"), F.col("repo").alias("to_repo"), F.col("part").alias("identifier"), F.lit("feeds:table").alias("kind"), F.lit(1).alias("origin"), F.col("part").cast("long").alias("seq"))
    return linkage.first_edges(a.unionByName(b))


@query(f"WITH {_EDGES} SELECT from_repo, to_repo, identifier, kind FROM edges")
def graph_first_edges(spark, sf):
    return _edges(spark, sf)


@query(f"""WITH {_EDGES} SELECT n_name AS repo, (SELECT count(*) FROM edges WHERE from_repo = n_name) AS out_degree, (SELECT count(*) FROM edges WHERE to_repo = n_name) AS in_degree FROM nation""")
def graph_nodes(spark, sf):
    nodes = linkage.graph_nodes(table(spark, sf, "nation").select(F.col("n_name").alias("repo")), _edges(spark, sf))
    return nodes.select("repo", "out_degree", "in_degree")


@query(f"WITH {_EDGES}, s AS (SELECT * FROM edges WHERE from_repo < 'NATION_17' AND to_repo < 'NATION_17') SELECT n_name AS repo FROM nation WHERE n_name NOT IN (SELECT from_repo FROM s) AND n_name NOT IN (SELECT to_repo FROM s)")
def graph_isolated(spark, sf):
    """The graph of the edges among the first names: the other nodes are left alone."""
    some = _edges(spark, sf).where("from_repo < 'NATION_17' and to_repo < 'NATION_17'")
    return linkage.isolated(table(spark, sf, "nation").select(F.col("n_name").alias("repo")), some)


@query(f"WITH {_EDGES}, p AS (SELECT from_repo, to_repo, string_agg(DISTINCT string_split(kind, ':')[1], ', ' ORDER BY string_split(kind, ':')[1]) AS kinds FROM edges GROUP BY 1, 2) SELECT *, from_repo || ' -->|' || kinds || '| ' || to_repo AS diagram FROM p")
def graph_edge_summary(spark, sf):
    return linkage.edge_summary(_edges(spark, sf))


@query(f"WITH {MADE_USED} SELECT repo, count(*) AS n FROM used WHERE part NOT IN (SELECT part FROM made WHERE part NOT LIKE '%5') GROUP BY 1")
def graph_unresolved(spark, sf):
    """Nobody is said to make the parts that end in 5."""
    made, used = made_and_used(spark, sf)
    made = made.where("part not like '%5'")
    solved = made.select("part").distinct().withColumn("hit", F.lit(True))
    rows = used.join(solved, "part", "left").select("repo", F.lit("table").alias("kind"), F.col("part").alias("id"), F.when(F.col("hit"), "internal").otherwise("unresolved").alias("resolution"))
    return linkage.unresolved_of(rows).select("repo", "n")


@query("""WITH f AS (SELECT lang AS repo, CAST(doc_id AS VARCHAR) || '.' || source AS path, n_chars FROM documents), c AS (SELECT repo, string_split(path, '.')[2] AS extension, count(*) AS n FROM f GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY n DESC, extension) AS place FROM c) SELECT repo, extension, n FROM k WHERE place <= 5""")
def scan_extensions(spark, sf):
    files = table(spark, sf, "documents").select(F.col("lang").alias("repo"), F.concat_ws(".", F.col("doc_id").cast("string"), F.col("source")).alias("path"))
    return repos.extension_histogram(files, 5)


@query("SELECT source AS repo, count(*) AS files, CAST(sum(n_chars) AS BIGINT) AS bytes, CASE WHEN count(*) < 200 THEN 'small' WHEN count(*) < 2000 THEN 'medium' ELSE 'large' END AS size_class FROM documents GROUP BY 1")
def scan_sizes(spark, sf):
    return repos.repo_sizes(table(spark, sf, "documents").select(F.col("source").alias("repo"), F.col("n_chars").alias("size")))


# ---- entries ----


@query(f"WITH {ENTRIES} SELECT source, 'rule' AS type, substring(norm, 1, 1) AS name, count(*) AS n FROM entries GROUP BY 1, 3 HAVING count(*) > 1")
def entry_duplicates(spark, sf):
    """Entries of one type by the first letter of their names."""
    return entries.duplicates(entry_rows(spark, sf).select("source", F.lit("rule").alias("type"), F.substring("norm", 1, 1).alias("name")))


@query(f"WITH {ENTRIES} SELECT type, count(*) AS n, count(DISTINCT source) AS sources FROM entries GROUP BY 1")
def entry_type_counts(spark, sf):
    return entries.type_counts(entry_rows(spark, sf)).select("type", "n", "sources")


@query(f"WITH {ENTRIES} SELECT norm, count(DISTINCT source) AS sources, count(*) AS n FROM entries GROUP BY 1 HAVING count(DISTINCT source) > 1")
def entry_collisions(spark, sf):
    return entries.collisions(entry_rows(spark, sf)).select("norm", "sources", F.col("n").cast("long").alias("n"))


@query(f"WITH {ENTRIES} SELECT source, type, name, statement FROM entries WHERE basis = 'inferred'")
def entry_review_list(spark, sf):
    return entries.for_review(entry_rows(spark, sf))


@query(f"WITH {ENTRIES} SELECT name, norm, statement, source FROM entries WHERE type = 'term'")
def entry_glossary(spark, sf):
    return entries.glossary(entry_rows(spark, sf))


@query(f"""WITH {ENTRIES} SELECT a.norm, a.statement AS statement_a, a.source AS source_a, b.statement AS statement_b, b.source AS source_b FROM entries a JOIN entries b ON a.norm = b.norm
WHERE CAST(a.source AS INT) < 4 AND CAST(b.source AS INT) >= 4 AND {norm_sql("a.statement")} <> {norm_sql("b.statement")}""")
def entry_disagreements(spark, sf):
    rows = entry_rows(spark, sf)
    return entries.disagreements(rows.where("cast(source as int) < 4"), rows.where("cast(source as int) >= 4"))


@query(f"""WITH {ENTRIES}, f AS (SELECT norm, {norm_sql("statement")} AS form, min(statement) AS statement, count(*) FILTER (CAST(source AS INT) < 4) AS n_first, count(*) FILTER (CAST(source AS INT) >= 4) AS n_second FROM entries GROUP BY 1, 2)
SELECT * FROM f WHERE norm IN (SELECT norm FROM f GROUP BY 1 HAVING count(*) > 1 AND sum(n_first) > 0 AND sum(n_second) > 0)""")
def entry_disagreement_forms(spark, sf):
    """The statements of names on which two catalogues disagree, one row for each form."""
    rows = entry_rows(spark, sf)
    return entries.disagreement_forms(rows.where("cast(source as int) < 4"), rows.where("cast(source as int) >= 4"))


# ---- tickets ----


@query(f"WITH {REFS} SELECT key, source_kind, source, location FROM refs")
def ticket_references(spark, sf):
    return tickets.references(["PAY"], lines=ticket_refs(spark, sf))


@query(f"""WITH {REFS}, k AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY source_kind, source, location) AS place, count(*) OVER (PARTITION BY key) AS n FROM refs)
SELECT key, n AS n_references, source_kind || ' ' || source || ' ' || location AS first_reference FROM k WHERE place = 1""")
def ticket_reference_counts(spark, sf):
    return tickets.reference_counts(tickets.references(["PAY"], lines=ticket_refs(spark, sf)))


@query(f"""WITH {REFS}, k AS (SELECT *, row_number() OVER (PARTITION BY source, key ORDER BY location) AS place, count(*) OVER (PARTITION BY source, key) AS n FROM refs)
SELECT source_kind, source, key, n, string_agg(location, ', ' ORDER BY place) || CASE WHEN n > 5 THEN ', ...' ELSE '' END AS locations FROM k WHERE place <= 5 GROUP BY 1, 2, 3, 4""")
def ticket_locations(spark, sf):
    return tickets.source_tickets(tickets.references(["PAY"], lines=ticket_refs(spark, sf)))


@query("""WITH s AS (SELECT user_id, lead(user_id) OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts, event_id) AS nxt FROM events), l AS (SELECT DISTINCT user_id, nxt FROM s WHERE nxt IS NOT NULL AND nxt <> user_id AND user_id % 2 = 0),
x AS (SELECT 'PAY-' || CAST(nxt AS VARCHAR) AS key, min('PAY-' || CAST(user_id AS VARCHAR)) AS linker FROM l WHERE nxt % 2 = 1 GROUP BY 1) SELECT key, '1' AS depth, 'linked from ' || linker AS first_reference FROM x""")
def ticket_linked(spark, sf):
    """Users as tickets, linked to whoever comes next in their kind of event in the same hour; even ones are in the ledger."""
    from pyspark.sql import Window

    events = table(spark, sf, "events")
    nxt = F.lead("user_id").over(Window.partitionBy("event_type", F.date_trunc("hour", "ts")).orderBy("ts", "event_id"))
    links = events.select("user_id", nxt.alias("next")).where("next is not null and next <> user_id").distinct()
    name = lambda c: F.concat(F.lit("PAY-"), F.col(c).cast("string"))
    rows = links.groupBy("user_id").agg(F.collect_list(F.struct(F.lit("relates").alias("type"), name("next").alias("key"))).alias("links"))
    known = rows.select(name("user_id").alias("key"), F.lit("").alias("parent"), F.lit("").alias("epic"), "links", "user_id")
    state = events.select("user_id").distinct().where("user_id % 2 = 0").select(name("user_id").alias("key"), F.lit("0").alias("depth"))
    return tickets.linked_rows(known, state)


@query("""SELECT 'PAY-' || CAST(user_id AS VARCHAR) AS key, row_number() OVER (ORDER BY user_id) AS place FROM (SELECT DISTINCT user_id FROM events)""")
def ticket_key_order(spark, sf):
    keys = table(spark, sf, "events").select(F.concat(F.lit("PAY-"), F.col("user_id").cast("string")).alias("key")).distinct()
    return ledger.numbered(keys, ledger.numeric_key_order(F.col("key")))


# ---- handbook ----


def _outline(spark, sf):
    rows = page_ledger(spark, sf).select(F.col("page_id").cast("string").alias("page_id"), "n_words")
    area = F.col("page_id").cast("long") % 10
    assigned = rows.where("cast(page_id as bigint) % 31 <> 30").select(area.cast("string").alias("area"), "page_id")
    twice = rows.where("page_id = '7'").select(F.lit("3").alias("area"), "page_id")
    strange = rows.where("page_id = '1'").select(F.lit("4").alias("area"), F.lit("none-such").alias("page_id"))
    return rows, assigned.unionByName(twice).unionByName(strange)


_OUTLINE = f"""{PAGES}, assigned AS (SELECT CAST(page_id % 10 AS VARCHAR) AS area, CAST(page_id AS VARCHAR) AS page_id FROM page_rows WHERE page_id % 31 <> 30 UNION ALL SELECT '3', '7' UNION ALL SELECT '4', 'none-such')"""


@query(f"""WITH {_OUTLINE} SELECT DISTINCT page_id, 'unknown' AS problem FROM assigned WHERE page_id NOT IN (SELECT CAST(page_id AS VARCHAR) FROM page_rows)
UNION ALL SELECT page_id, 'twice' FROM assigned GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT CAST(page_id AS VARCHAR), 'unassigned' FROM page_rows WHERE CAST(page_id AS VARCHAR) NOT IN (SELECT page_id FROM assigned)""")
def outline_assignment(spark, sf):
    rows, assigned = _outline(spark, sf)
    return handbook.outline_assignment(assigned, rows)


@query(f"WITH {_OUTLINE} SELECT area, count(*) AS n_pages, CAST(coalesce(sum(n_words), 0) AS BIGINT) AS n_words FROM assigned a LEFT JOIN page_rows p ON CAST(p.page_id AS VARCHAR) = a.page_id GROUP BY 1")
def outline_sizes(spark, sf):
    rows, assigned = _outline(spark, sf)
    return handbook.area_sizes(assigned, rows)


@query(f"WITH {CHAPTERS} SELECT area, block_no FROM blocks WHERE section <> 'Pages not used' AND NOT cites")
def chapter_uncited(spark, sf):
    return handbook.uncited_blocks(chapter_rows(spark, sf)).select("area", "block_no")


@query(f"WITH {CHAPTERS} SELECT page AS page_id, count(DISTINCT area) AS chapters FROM blocks WHERE section <> 'Pages not used' AND cites GROUP BY 1")
def chapter_citing(spark, sf):
    return handbook.citing_chapters(chapter_rows(spark, sf))


@query(f"""WITH {CHAPTERS}, d AS (SELECT CAST(doc_id AS VARCHAR) AS page, text || ' ' || CAST(n_chars AS VARCHAR) AS body FROM documents),
c AS (SELECT area, block_no, page, CASE WHEN block_no % 2 = 1 THEN '10' ELSE regexp_extract(bare, '([0-9]+)$', 1) END AS value FROM blocks WHERE cites)
SELECT area, block_no, value FROM c LEFT JOIN d USING (page) WHERE length(value) >= 2 AND NOT coalesce(regexp_matches(' ' || body || ' ', '[^\\p{{L}}\\p{{N}}_.]' || value || '([.]+)?[^\\p{{L}}\\p{{N}}_.,]'), false)""")
def chapter_ungrounded_numbers(spark, sf):
    """Numbers of blocks that are neither in the cited text nor its length."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("page_id"), F.concat_ws(" ", "text", F.col("n_chars").cast("string")).alias("text"))
    return handbook.ungrounded(chapter_rows(spark, sf), docs).where("kind = 'numbers'").select("area", "block_no", "value")


@query(f"""WITH {CHAPTERS}, w AS (SELECT area, CAST(sum(len(regexp_extract_all(bare, '\\S+')) + CAST(cites AS INT)) AS BIGINT) AS written FROM blocks GROUP BY 1),
s AS (SELECT DISTINCT area, page FROM blocks WHERE section <> 'Pages not used' AND cites), n AS (SELECT area, CAST(sum(len(regexp_extract_all(text, '\\S+'))) AS BIGINT) AS n FROM s JOIN documents ON CAST(doc_id AS VARCHAR) = page GROUP BY 1)
SELECT area, written, CAST(least(5000, floor(0.06 * coalesce(n, 0))) AS INT) AS floor FROM w LEFT JOIN n USING (area)""")
def chapter_depth(spark, sf):
    blocks = chapter_rows(spark, sf)
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("page_id"), text.word_count(F.col("text")).cast("long").alias("n_words"))
    n = docs.agg(F.count("*").alias("n"))
    assigned = blocks.select("area").distinct().crossJoin(F.broadcast(n)).select("area", (F.col("area").cast("long") * 7 % F.col("n")).cast("string").alias("page_id"))  # one row
    return handbook.chapter_depth(blocks, assigned, docs)


@query(f"""WITH {CHAPTERS}, c AS (SELECT DISTINCT page FROM blocks WHERE section <> 'Pages not used' AND cites), l AS (SELECT DISTINCT page FROM blocks WHERE section = 'Pages not used' AND cites)
SELECT CAST(doc_id AS VARCHAR) AS page_id, CASE WHEN CAST(doc_id AS VARCHAR) IN (SELECT page FROM c) THEN 'cited' WHEN CAST(doc_id AS VARCHAR) IN (SELECT page FROM l) THEN 'listed' WHEN quality = 0 THEN 'judged_empty' ELSE 'untouched' END AS state
FROM documents LEFT JOIN labels USING (doc_id)""")
def book_coverage(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = docs.join(labels, "doc_id", "left").select(F.col("doc_id").cast("string").alias("page_id"), F.when(F.col("quality") == 0, "no_business_content").alias("entry_verdict"))
    return handbook.book_coverage(rows, chapter_rows(spark, sf))


@query("""SELECT CAST(doc_id AS VARCHAR) AS page_id, unnest(list_filter(['that', 'with', 'this'], lambda p: regexp_matches(text, '(^|[^A-Za-z0-9])' || p || '([^A-Za-z0-9]|$)'))) AS platform FROM documents""")
def platform_mentions(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("page_id"), "text")
    return handbook.platform_mentions(docs, ["that", "with", "this"])


def _as_chapters(spark, sf):
    turns = table(spark, sf, "conversations")
    head = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("## Part "), (F.col("turn") / 3).cast("int").cast("string"))).otherwise(F.concat(F.lit("- "), F.coalesce("text", F.lit(""))))
    lines = turns.select(F.col("conv_id").cast("string").alias("area"), F.col("turn").alias("line"), F.regexp_replace(head, "[\\n|]", " ").alias("text"))
    return lines


@query("""SELECT CAST(conv_id AS VARCHAR) AS doc, 'part ' || CAST(CAST(floor(turn / 3) AS INT) AS VARCHAR) AS section, trim(string_agg(CASE WHEN turn % 3 <> 0 THEN '- ' || regexp_replace(coalesce(text, ''), '[\\n|]', ' ', 'g') END, chr(10) ORDER BY turn)) AS body
FROM conversations GROUP BY 1, 2 HAVING count(*) FILTER (turn % 3 = 0) > 0 AND count(*) FILTER (turn % 3 <> 0) > 0""")
def document_sections(spark, sf):
    return repos.sections_of(_as_chapters(spark, sf).withColumnRenamed("area", "doc")).where("body <> ''")


@query("""WITH b AS (SELECT CAST(conv_id AS VARCHAR) AS area, turn, CAST(floor(turn / 3) AS INT) AS part, '- ' || regexp_replace(coalesce(text, ''), '[\\n|]', ' ', 'g') AS block FROM conversations WHERE turn % 3 <> 0)
SELECT area, 'Part ' || CAST(part AS VARCHAR) AS section, CAST(row_number() OVER (PARTITION BY area ORDER BY turn) AS INT) AS block_no, block FROM b""")
def chapter_blocks(spark, sf):
    return handbook.chapter_blocks(_as_chapters(spark, sf)).select("area", "section", "block_no", "block")


from corpusproof.plans import columns, files, workspaces  # noqa: E402  register their queries

__all__ = ["ORACLES", "QUERIES", "columns", "files", "workspaces"]
