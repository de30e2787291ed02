"""Wiki pages: inventory checks, conversion, and proof that nothing was lost on the way to Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from corpusproof.functions.helpers import ascii_folded, unescape_entities
from corpusproof.functions.markdown import converted_pages
from corpusproof.functions.markup import bodyless_macros, outside_fences
from corpusproof.functions.text import (
    attachment_url,
    build_front_matter,
    escaped_cdata,
    front_matter,
    leftover_markup,
    markdown_links,
    page_file,
    percent_encoded,
    slug,
    squeeze,
    tag_counts,
    text_of,
    visible_text,
    without_title,
    word_tokens,
)
from corpusproof.sources.shared import checkpointed
from corpusproof.operators.checks import check, checks_of, none_left, union_all

# fixed values: tags that must be closed as often as opened
BALANCED_TAGS = ("table", "ac:structured-macro", "ac:rich-text-body", "ac:plain-text-body", "ac:layout", "ac:layout-section", "ac:layout-cell", "ac:link", "ac:image", "ac:task-list", "ul", "ol")
COVERAGE = 0.99


# ---- inventory ----


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """(key, n) of keys that occur more than once."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def blank_fields(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field) of fields that are blank or null."""
    return rows.select(key, F.explode(F.array(*(F.when(F.trim(text_of(F.col(f))) == "", F.lit(f)) for f in fields))).alias("field")).where("field is not null")


def open_parents(rows: DataFrame, key: str = "page_id", parent: str = "parent_id", roots: list[str] = ()) -> DataFrame:
    """Rows whose parent is neither a key nor an allowed root."""
    known = rows.select(F.col(key).alias(parent))
    return rows.where(text_of(F.col(parent)) != "").where(~F.col(parent).isin([*roots, ""])).join(known, parent, "left_anti")


def clashing_names(rows: DataFrame, key: str, name: Column) -> DataFrame:
    """(name, n) of derived names that several keys share."""
    return rows.select(key, name.alias("name")).groupBy("name").agg(F.countDistinct(key).alias("n")).where("n > 1")


def with_file_name(rows: DataFrame) -> DataFrame:
    return rows.withColumn("md_name", page_file(F.col("page_id"), slug(ascii_folded(F.col("title")))))


def inventory_checks(rows: DataFrame, expected: int | None, roots: list[str] = ()) -> DataFrame:
    """I1 to I5 under the key "inventory": unique keys, no blanks, closed tree, expected number, unique file names."""

    def count(bad: DataFrame, name: str) -> DataFrame:
        return bad.agg(F.count("*").alias("n")).select(F.lit("inventory").alias("key"), F.lit(name).alias("check"), (F.col("n") == 0).alias("ok"), F.when(F.col("n") > 0, F.concat(F.col("n").cast("string"), F.lit(" rows"))).otherwise(F.lit("")).alias("detail"))

    total = rows.agg(F.count("*").alias("n"))
    tree = count(open_parents(rows, roots=list(roots)), "I3") if roots else total.select(F.lit("inventory").alias("key"), F.lit("I3").alias("check"), (F.col("n") > 0).alias("ok"), F.lit("").alias("detail"))
    number = total.select(F.lit("inventory").alias("key"), F.lit("I4").alias("check"), F.coalesce(F.col("n") == F.lit(expected), F.lit(False)).alias("ok"), F.concat(F.col("n").cast("string"), F.lit(f" rows, expected {expected}")).alias("detail"))
    return union_all([count(duplicate_keys(rows, "page_id"), "I1"), count(blank_fields(rows, "page_id", ["page_id", "title"]), "I2"), tree, number, count(clashing_names(with_file_name(rows), "page_id", F.col("md_name")), "I5")])


# ---- links and conversion ----


def resolved_targets(refs: DataFrame, ledger: DataFrame, base_url: str = "") -> DataFrame:
    """Add ``url`` to ``refs(ref_no, space, title, content_id, href)``: a page's file name, an outside URL, or the href.

    A title is looked up in its space (the last such row of the ledger), then in any space (the first row); an id is
    taken from content_id or the href.  ``ledger`` needs page_id, title, space_key and row_no.
    """
    named = with_file_name(ledger)
    by_space = named.groupBy("space_key", "title").agg(F.max_by("md_name", "row_no").alias("_in_space"))
    any_space = named.groupBy("title").agg(F.min_by("md_name", "row_no").alias("_anywhere"))
    by_id = named.groupBy("page_id").agg(F.max_by("md_name", "row_no").alias("_by_id"))
    href = text_of(F.col("href"))
    found = F.coalesce(F.nullif(text_of(F.col("content_id")), F.lit("")), F.nullif(F.regexp_extract(href, "/pages/(\\d+)", 1), F.lit("")), F.nullif(F.regexp_extract(href, "[?&]pageId=(\\d+)", 1), F.lit("")))
    joined = refs.withColumn("_id", found).join(by_space.withColumnsRenamed({"space_key": "space"}), ["space", "title"], "left").join(any_space, "title", "left").join(by_id.withColumnRenamed("page_id", "_id"), "_id", "left")
    outside = F.concat(F.lit("outside://"), percent_encoded(F.col("space"), keep_slash=True), F.lit("/"), percent_encoded(F.col("title")))
    fragment = F.regexp_extract(href, "(#[^#]*)$", 1)
    absolute = F.when(href.startswith("/"), F.concat(F.lit(base_url), href)).otherwise(href)
    url = F.when(F.col("_by_id").isNotNull(), F.concat(F.col("_by_id"), fragment)).when(text_of(F.col("title")) != "", F.coalesce("_in_space", "_anywhere", outside)).otherwise(absolute)
    return joined.withColumn("url", url).select(*refs.columns, "url")


def convert(pages: DataFrame, ledger: DataFrame, converted_from: str = "html") -> DataFrame:
    """(page_id, markdown, placeholders, warnings): front matter, title and body with links resolved against the ledger."""
    made = checkpointed(converted_pages(pages))  # read for the links and for the bodies
    shape = "corpus-page:(id/)?([^)\\s]*)"
    links = made.select("page_id", F.explode(F.array_distinct(F.regexp_extract_all("body", F.lit("corpus-page:[^)\\s]*"), F.lit(0)))).alias("token"))
    rest = F.regexp_extract("token", shape, 2)
    plain = F.replace(F.replace(F.replace(rest, F.lit("%20"), F.lit(" ")), F.lit("%28"), F.lit("(")), F.lit("%29"), F.lit(")"))
    is_id = F.regexp_extract("token", shape, 1) != ""
    refs = links.select("page_id", "token", F.when(is_id, "").otherwise(F.substring_index(plain, "/", 1)).alias("space"), F.when(is_id, "").otherwise(F.regexp_replace(plain, "^[^/]*/", "")).alias("title"), F.when(is_id, rest).otherwise("").alias("content_id"), F.lit("").alias("href"))
    solved = resolved_targets(refs, ledger).groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct(F.length("token").alias("n"), "token", "url")), lambda a, b: F.when(a["n"] > b["n"], -1).when(a["n"] < b["n"], 1).otherwise(0)).alias("solved"))
    swap = lambda body, x: F.replace(body, F.concat(F.lit("]("), x["token"], F.lit(")")), F.concat(F.lit("]("), x["url"], F.lit(")")))
    body = F.aggregate(F.coalesce("solved", F.array().cast("array<struct<n:int,token:string,url:string>>")), F.col("body"), swap)
    titled = ledger.select("page_id", "title", "version", "space_key", "source_url")
    joined = made.join(solved, "page_id", "left").withColumn("body", body).join(titled, "page_id")
    attached = F.regexp_replace("body", "\\]\\(attachment:", "](attachments/")
    shown = F.when(F.trim("body") == "", F.lit("_(This page has no content at its source.)_")).otherwise(attached)
    head = build_front_matter({"page_id": F.col("page_id"), "title": F.col("title"), "space": F.col("space_key"), "version": F.col("version"), "source": F.col("source_url"), "converted_from": F.lit(converted_from)})
    return joined.select("page_id", F.concat(head, F.lit("\n# "), F.col("title"), F.lit("\n\n"), shown, F.lit("\n")).alias("markdown"), "placeholders", "warnings")


def passed_through(pages: DataFrame, ledger: DataFrame) -> DataFrame:
    """Bodies that are Markdown already: front matter is added, and the title unless the body begins with one."""
    joined = pages.join(ledger.select("page_id", "title", "version", "space_key", "source_url"), "page_id")
    head = build_front_matter({"page_id": F.col("page_id"), "title": F.col("title"), "space": F.col("space_key"), "version": F.col("version"), "source": F.col("source_url"), "converted_from": F.lit("markdown")})
    body = F.ltrim(text_of(F.col("html")))
    return joined.select("page_id", F.concat(head, F.lit("\n"), F.when(body.startswith("# "), body).otherwise(F.concat(F.lit("# "), F.col("title"), F.lit("\n\n"), body)), F.lit("\n")).alias("markdown"))


# ---- per-page checks ----


def word_coverage(source: DataFrame, derived: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, wanted, lost, coverage, missing) of source words that the derived text has too few times.

    ``source(key, text)`` and ``derived(key, text)`` hold plain text.  Words are counted within each row, so one word's
    rows never meet across pages.  A source without words is covered.  missing lists the twelve words most often lost.
    """

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, F.explode(word_tokens(F.col("text"))).alias("word")).groupBy(key, "word").agg(F.count("*").alias(name))

    lost = F.greatest(F.col("want") - F.coalesce("have", F.lit(0)), F.lit(0))
    both = counted(source, "want").join(counted(derived, "have"), [key, "word"], "left").withColumn("lost", lost)
    top = F.transform(F.slice(F.array_sort(F.collect_list(F.when(F.col("lost") > 0, F.struct((-F.col("lost")).alias("n"), "word")))), 1, 12), lambda x: x["word"])
    per = both.groupBy(key).agg(F.sum("want").alias("wanted"), F.sum("lost").alias("lost"), F.array_join(top, " ").alias("missing"))
    zero = F.lit(0).cast("long")
    joined = source.select(key).distinct().join(per, key, "left").select(key, F.coalesce("wanted", zero).alias("wanted"), F.coalesce("lost", zero).alias("lost"), F.coalesce("missing", F.lit("")).alias("missing"))
    return joined.select(key, "wanted", "lost", F.when(F.col("wanted") == 0, 1.0).otherwise(1.0 - F.col("lost") / F.col("wanted")).alias("coverage"), "missing")


def raw_structure(html: Column) -> Column:
    """struct of headings, tables, code, images and links in raw HTML that have to show up in Markdown; markup inside CDATA is text."""
    plain = escaped_cdata(html)
    n = lambda pattern: F.regexp_count(plain, F.lit(pattern))
    headings = n("(?is)<h([1-6])\\b[^>]*>(?=(?:(?!</h\\1\\s*>).)*?(?:>|^)?[^<\\s]|(?:(?!</h\\1\\s*>).)*?<(?:img|ac:image))(?:(?!</h\\1\\s*>).)+</h\\1\\s*>")
    tables = n("(?i)<table\\b")
    code = n("(?i)<ac:plain-text-body\\b") + n("(?i)<pre\\b")
    images = n("(?i)<ac:image\\b") + n("(?i)<img\\b(?![^>]*emoticon)")
    links = n("(?i)<a\\b[^>]*\\bhref=") + n("(?i)<ac:link\\b(?!(?:(?!</ac:link>)[\\s\\S])*<ri:user)")
    return F.struct(headings.alias("headings"), tables.alias("tables"), code.alias("code"), images.alias("images"), links.alias("links"))


def markdown_structure(outside: Column, blocks: Column) -> Column:
    """The same counts of a Markdown body, from its text outside fences and the number of fenced blocks."""
    plain = without_title(outside)
    n = lambda pattern: F.regexp_count(plain, F.lit(pattern))
    images = n("!\\[[^\\]]*\\]\\(")
    tables = n("(?m)^[ \\t>]*\\|?(?:\\s*:?-{3,}:?\\s*\\|)+(?:\\s*:?-{3,}:?)?\\s*$") + n("<table")
    return F.struct(n("(?m)^[ \\t>]*#{1,6}[ \\t]+\\S").alias("headings"), tables.alias("tables"), blocks.alias("code"), images.alias("images"), (n("\\]\\(") - images).alias("links"))


def unbalanced_tags(html: Column, tags: tuple[str, ...] = BALANCED_TAGS) -> Column:
    """Names and counts of tags that are opened and closed a different number of times; markup inside CDATA is text."""
    parts, plain = [], escaped_cdata(html)
    for tag in tags:
        opened, closed = tag_counts(plain, tag)
        parts.append(F.when(opened != closed, F.concat(F.lit(f"{tag} "), opened.cast("string"), F.lit("/"), closed.cast("string"))))
    return F.array_compact(F.array(*parts))


def attachment_checks(ledger: DataFrame, listing: DataFrame, present: DataFrame) -> DataFrame:
    """D3: as many attachments as expected; where a listing exists, the same names, and sizes where they are numbers."""
    have = present.groupBy("page_id").agg(F.count("*").alias("have"))
    both = listing.withColumn("_l", F.lit(True)).alias("l").join(present.withColumn("_p", F.lit(True)).alias("p"), (F.col("l.page_id") == F.col("p.page_id")) & (F.col("l.filename") == F.col("p.filename")), "full_outer")
    sized = text_of(F.col("l.size")).rlike("^\\d+$") & (F.col("l.size").try_cast("bigint") != F.col("p.size").cast("bigint"))
    wrong = both.where(F.col("_l").isNull() | F.col("_p").isNull() | sized).select(F.coalesce("l.page_id", "p.page_id").alias("page_id"), F.coalesce("l.filename", "p.filename").alias("filename"))
    listed = listing.select("page_id").distinct()
    bad = wrong.join(listed, "page_id", "left_semi").groupBy("page_id").agg(F.array_join(F.array_sort(F.collect_set("filename")), ", ").alias("wrong"))
    joined = ledger.select("page_id", "attachment_count").join(have, "page_id", "left").join(bad, "page_id", "left").withColumn("have", F.coalesce("have", F.lit(0)))
    want = F.when(text_of(F.col("attachment_count")).rlike("^\\d+$"), F.col("attachment_count").try_cast("bigint"))
    return check(joined, "page_id", "D3", (want == F.col("have")) & F.col("wrong").isNull(), F.concat_ws(" ", F.lit("expected"), F.col("attachment_count"), F.lit("found"), F.col("have").cast("string"), F.col("wrong")))


def page_checks(ledger: DataFrame, pages: DataFrame, markdown: DataFrame, attachments: DataFrame, final: bool = False, coverage: float = COVERAGE) -> DataFrame:
    """D1, D2, C4 to C11 of every ledger row; checks of the Markdown are left out where it is absent."""
    named = with_file_name(ledger)
    body = named.join(pages.select("page_id", "html"), "page_id", "left").join(markdown.select("page_id", "markdown"), "page_id", "left")
    shared = named.where(text_of(F.col("md_path")) != "").groupBy("md_path").agg(F.count("*").alias("shared")).where("shared > 1")
    body = body.join(shared, "md_path", "left").withColumns({"fm": front_matter(F.col("markdown")), "raw": text_of(F.col("html"))})
    empty = F.col("empty_body") == "yes"
    first = checks_of(
        body,
        "page_id",
        {
            "D1": ((F.trim("raw") != "") | empty, "raw body is absent"),
            "D2": (F.size(unbalanced_tags(F.col("html"))) == 0, F.array_join(unbalanced_tags(F.col("html")), ", ")),
            "C4": (F.col("markdown").isNotNull() & (F.col("fm.fields")["page_id"] == F.col("page_id").cast("string")) & (F.col("fm.fields")["version"] == F.col("version").cast("string")) & F.col("md_path").endswith(F.col("md_name")), "Markdown absent, or its front matter or name differs"),
            "C5": (F.col("shared").isNull(), "another row has this md_path"),
        },
    )
    there = body.where("markdown is not null").withColumn("body", F.coalesce("fm.body", "markdown"))
    there = there.withColumn("out", outside_fences(F.col("body"))).withColumns({"have": markdown_structure(F.col("out.text"), F.col("out.blocks")), "want": raw_structure(F.col("html"))})
    parts = ("headings", "tables", "code", "images", "links")
    less = F.array_compact(F.array(*(F.when(F.col(f"have.{p}") < F.col(f"want.{p}"), F.concat(F.lit(f"{p} "), F.col(f"have.{p}").cast("string"), F.lit("/"), F.col(f"want.{p}").cast("string"))) for p in parts)))
    structure = checks_of(there, "page_id", {"C6": (F.size(less) == 0, F.array_join(less, ", ")), "C11": (F.size(leftover_markup(F.col("out.text"))) == 0, F.array_join(leftover_markup(F.col("out.text")), ", "))})
    covered = word_coverage(there.select("page_id", unescape_entities(visible_text(F.col("html"))).alias("text")), there.select("page_id", unescape_entities("body").alias("text")))
    words = check(covered, "page_id", "C7", F.col("coverage") >= coverage, F.concat(F.round("coverage", 4).cast("string"), F.lit(" missing: "), F.col("missing")))
    links = there.select("page_id", F.explode(markdown_links(F.col("out.text"))).alias("l")).select("page_id", "l.*")
    local = attachments.select("page_id", attachment_url(F.col("page_id"), F.col("filename")).alias("target")).union(attachments.select("page_id", F.concat(F.lit("attachments/"), percent_encoded(F.col("filename"), True))))
    lost_files = links.where("kind = 'attachment'").join(local, ["page_id", "target"], "left_anti")
    files = none_left(there, lost_files, "page_id", "C8", "target")
    known = named.join(markdown.select("page_id"), "page_id", "left_semi") if final else named
    targets = links.where("kind = 'page'").withColumn("md_name", F.regexp_replace(F.substring_index("target", "#", 1), "^.*/", ""))
    lost_pages = targets.join(known.select("md_name").distinct(), "md_name", "left_anti")
    page_links = none_left(there, lost_pages, "page_id", "C9", "target")
    shown = there.select("page_id", F.explode(F.regexp_extract_all("out.text", F.lit("\\[MACRO: ([A-Za-z0-9_-]+)"), F.lit(1))).alias("macro")).groupBy("page_id", "macro").agg(F.count("*").alias("shown"))
    hidden = bodyless_macros(pages).join(there.select("page_id"), "page_id", "left_semi").join(shown, ["page_id", "macro"], "left").where(F.col("n") > F.coalesce("shown", F.lit(0)))
    macros = none_left(there, hidden, "page_id", "C10", "macro")
    return union_all([first, structure, words, files, page_links, macros])


def outside_links(markdown: DataFrame, n: int = 50) -> DataFrame:
    """(target, n) of the links that point outside the corpus, the most common first."""
    links = markdown.select(outside_fences(F.col("markdown")).alias("o")).select(F.explode(markdown_links(F.col("o.text"))).alias("l")).where("l.kind = 'outside'")
    return links.groupBy(F.col("l.target").alias("target")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "target").limit(n)


def placeholder_totals(markdown: DataFrame) -> DataFrame:
    """(macro, n, pages) of placeholders over the corpus."""
    found = markdown.select("page_id", outside_fences(F.col("markdown")).alias("o")).select("page_id", F.explode(F.regexp_extract_all("o.text", F.lit("\\[MACRO: ([A-Za-z0-9_-]+)"), F.lit(1))).alias("macro"))
    return found.groupBy("macro").agg(F.count("*").alias("n"), F.countDistinct("page_id").alias("pages"))


def compare_bodies(stored: DataFrame, fetched: DataFrame) -> DataFrame:
    """(page_id, result): PASS, DIFF or FAIL (no stored body) of re-fetched bodies, white space aside."""
    joined = fetched.select("page_id", F.col("html").alias("new")).join(stored.select("page_id", F.col("html").alias("old")), "page_id", "left")
    return joined.select("page_id", F.when(F.col("old").isNull(), "FAIL").when(squeeze(F.col("old")) == squeeze(F.col("new")), "PASS").otherwise("DIFF").alias("result"))


# ---- the tree ----


def _jumped(rows: DataFrame, key: str, parent: str, carried: dict[str, Column], grow) -> DataFrame:
    """``carried`` of each row, combined over its branch or its way up by jumps of doubling length.

    After k rounds ``up`` is the ancestor 2 ** k links above, and the carried columns cover 2 ** k links.  A round is one
    or two joins of as many rows as the tree has, so a tree of depth d takes log2(d) rounds of any depth.  A row whose
    parent is not a key is a root.  Rows whose way up still has not ended after as many links as there are rows lead
    into a parent cycle; they keep a non-null ``up``.
    """
    known = rows.select(F.col(key).alias("up")).distinct()
    linked = rows.select(F.col(key).alias("node"), F.col(parent).alias("up"), *(c.alias(n) for n, c in carried.items()))
    state = checkpointed(linked.join(known.withColumn("_known", F.lit(True)), "up", "left").select("node", F.when(F.col("_known"), F.col("up")).alias("up"), *carried))
    total, covered = state.count(), 1
    while covered < total and not state.where("up is not null").isEmpty():
        state, covered = checkpointed(grow(state)), 2 * covered
    return state


def subtree_totals(rows: DataFrame, key: str = "page_id", parent: str = "parent_id", words: str = "n_words") -> DataFrame:
    """(key, pages, words) of the branch under each row, itself included.  Rows in a parent cycle have no totals (null); those below one have."""

    def grow(state: DataFrame) -> DataFrame:
        below = state.where("up is not null").groupBy(F.col("up").alias("node")).agg(F.sum("pages").alias("_pages"), F.sum("words").alias("_words"))
        above = state.select(F.col("node").alias("up"), F.col("up").alias("_up"))
        zero = F.lit(0).cast("long")
        return state.join(below, "node", "left").join(above, "up", "left").select("node", F.col("_up").alias("up"), (F.col("pages") + F.coalesce("_pages", zero)).alias("pages"), (F.col("words") + F.coalesce("_words", zero)).alias("words"))

    state = _jumped(rows, key, parent, {"pages": F.lit(1).cast("long"), "words": F.col(words).cast("long")}, grow)
    # where the ways up of endless rows now end are all rows of the cycles
    cyclic = state.where("up is not null").select(F.col("up").alias("node")).distinct().withColumn("_cyclic", F.lit(True))
    marked = state.join(cyclic, "node", "left")
    return marked.select(F.col("node").alias(key), *(F.when(F.col("_cyclic").isNull(), F.col(c)).alias(c) for c in ("pages", "words")))


def tree_listing(rows: DataFrame, key: str = "page_id", parent: str = "parent_id", order: str = "row_no") -> DataFrame:
    """(key, depth, path): pre-order of the tree; path is the array of orders from the root down, and sorts the listing.

    Rows that lead into a parent cycle have no place in the tree: depth and path are null, and they come first.
    """

    def grow(state: DataFrame) -> DataFrame:
        above = state.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("path").alias("_path"))
        return state.join(above, "up", "left").select("node", F.col("_up").alias("up"), F.when(F.col("_path").isNotNull(), F.concat("_path", "path")).otherwise(F.col("path")).alias("path"))

    state = _jumped(rows, key, parent, {"path": F.array(order)}, grow)
    path = F.when(F.col("up").isNull(), F.col("path"))
    return state.select(F.col("node").alias(key), (F.size(path) - 1).alias("depth"), path.alias("path")).withColumn("depth", F.when(F.col("path").isNotNull(), F.col("depth"))).orderBy("path")


def sums_before(rows: DataFrame, group: str, order: str, value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same group that come before, by a unique order.

    Rows are cut into ranges of (group, order) and summed up inside each; a group that spans ranges carries its sums on, so
    no task sees a whole large group.  Nulls are a group of their own.
    """
    ranged = checkpointed(rows.repartitionByRange(F.col(group).asc_nulls_first(), order).withColumn("_range", F.spark_partition_id()))
    whole = ranged.groupBy("_range", group).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range that a group is in
    carried = whole.select(F.col("_range").alias("_r"), F.col(group).alias("_g"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_carried"))
    inside = Window.partitionBy("_range", group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = summed.join(carried, (F.col("_range") == F.col("_r")) & F.col(group).eqNullSafe(F.col("_g")))
    return joined.select(*rows.columns, (F.col("_inside") + F.col("_carried")).alias(name))


def preorder(rows: DataFrame, key: str = "page_id", parent: str = "parent_id", order: str = "row_no") -> DataFrame:
    """(key, depth, place): the tree's listing as numbers, place 0 first; siblings stand in the order of ``order``.

    A row comes right behind its parent and the whole branches of its earlier siblings: its place is its parent's and one
    more, and the sizes of those branches.  Sizes and places are added up by jumps of doubling length, so a chain of any
    depth needs numbers only, never a path.  Rows that lead into a parent cycle have no depth and no place.
    """
    known = rows.select(F.col(key).alias("_up"), F.lit(True).alias("_known")).distinct()
    sizes = subtree_totals(rows.select(key, parent, F.lit(0).alias("_w")), key, parent, "_w").select(key, F.coalesce("pages", F.lit(0)).alias("_size"))
    linked = rows.select(key, F.col(parent).alias("_up"), F.col(order).alias("_order")).join(known, "_up", "left").join(sizes, key)
    linked = linked.select(key, F.when(F.col("_known"), F.col("_up")).alias("_up"), "_order", "_size")
    placed = sums_before(linked, "_up", "_order", "_size", "_before").withColumn("_step", F.col("_before") + F.col("_up").isNotNull().cast("long"))

    def grow(state: DataFrame) -> DataFrame:
        above = state.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("place").alias("_place"), F.col("depth").alias("_depth"))
        zero = F.lit(0).cast("long")
        return state.join(above, "up", "left").select("node", F.col("_up").alias("up"), (F.col("place") + F.coalesce("_place", zero)).alias("place"), (F.col("depth") + F.coalesce("_depth", zero)).alias("depth"))

    state = _jumped(placed, key, "_up", {"place": F.col("_step"), "depth": F.col("_up").isNotNull().cast("long")}, grow)
    ends = F.col("up").isNull()
    return state.select(F.col("node").alias(key), F.when(ends, F.col("depth")).alias("depth"), F.when(ends, F.col("place")).alias("place"))
