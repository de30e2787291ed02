"""Fenced blocks of Markdown as one pattern over lines, and macros of raw pages as rows of tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusproof.functions.text import escaped_cdata, text_of

# a run of one sign opens a block; a run of it at least as long, alone on its line, closes it, and else the text's end
_QUOTE = "[^\\S\\n]*(?:>[^\\S\\n]*)*"
_FENCED = f"(?m)^{_QUOTE}((`|~)\\2{{2,}}+)[^\\n]*+(?s:.*?)(?:\\n{_QUOTE}\\1\\2*[^\\S\\n]*$|\\z)"
_BLOCK = "\ue01f"


def outside_fences(body: Column) -> Column:
    """struct(text, blocks): the lines outside of fenced blocks, and the number of blocks.

    A block closes by the sign it opened with, at least as often, alone on a line; one that is not closed goes to the end.
    A null body is an empty one.
    """
    marked = F.regexp_replace(F.translate(text_of(body), _BLOCK, ""), _FENCED, _BLOCK)
    lines = F.split(marked, "\n", -1)
    return F.struct(F.array_join(F.filter(lines, lambda x: x != _BLOCK), "\n").alias("text"), F.size(F.filter(lines, lambda x: x == _BLOCK)).alias("blocks"))


# fixed values: macros that need no placeholder when they have no body, and the tags of macros and of their bodies
QUIET_MACROS = ["status", "anchor"]
MACRO_TAGS = ["ac:structured-macro", "ac:macro"]
BODY_TAGS = ["ac:rich-text-body", "ac:plain-text-body"]


def bodyless_macros(pages: DataFrame) -> DataFrame:
    """(page_id, macro, n): macros without a body on each page of ``pages(page_id, html)``.

    Names are lower-cased, a macro without one is "unnamed"; one for tickets needs no body where its key parameter holds
    text.  Macros that are never closed do not count, nor does what CDATA sections and comments hold.  Rows that repeat
    both columns count once.
    """
    some = pages.where(F.lower("html").contains("<ac:structured-macro") | F.lower("html").contains("<ac:macro"))
    plain = F.regexp_replace(F.regexp_replace(escaped_cdata(F.col("html")), "(?s)<!--.*?-->", ""), "(?is)<(script|style)(?=[\\s>])[^>]*>.*?</\\1\\s*>", "")
    tags = F.regexp_extract_all(plain, F.lit("(?s)<[^>]*>[^<]*"), F.lit(0))
    rows = some.select("page_id", F.xxhash64("html").alias("_row"), tags.alias("_tags")).distinct().select("page_id", "_row", F.posexplode("_tags").alias("at", "tag"))
    head = F.regexp_extract("tag", "(?s)^<[^>]*>", 0)
    kind = F.lower(F.regexp_extract("tag", "^<(/?[A-Za-z][A-Za-z0-9:_-]*)", 1))
    named = lambda c: F.regexp_extract(c, "(?is)\\sac:name\\s*=\\s*[\"']([^\"']*)", 1)
    rows = rows.select("page_id", "_row", "at", kind.alias("kind"), head.endswith("/>").alias("alone"), named(head).alias("name"), (F.trim(F.regexp_replace("tag", "(?s)^<[^>]*>\\s*", "")) != "").alias("says"))

    opens, closes = F.col("kind").isin(MACRO_TAGS) & ~F.col("alone"), F.col("kind").isin([f"/{t}" for t in MACRO_TAGS])
    page = Window.partitionBy("page_id", "_row").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"opens": opens, "closes": closes}).withColumn("sum", F.sum(F.col("opens").cast("int") - F.col("closes").cast("int")).over(page))
    # a closing tag without an open macro does not count, which the lowest sum so far takes back
    rows = rows.withColumns({"low": F.least(F.lit(0), F.min("sum").over(page)), "key": F.last(F.when((F.col("kind") == "ac:parameter") & ~F.col("alone"), F.col("name") == "key").when(F.col("kind") == "/ac:parameter", False), True).over(page)})
    rows = rows.withColumn("stray", F.col("closes") & (F.col("sum") == F.col("low")) & (F.coalesce(F.lag("low").over(Window.partitionBy("page_id", "_row").orderBy("at")), F.lit(0)) > F.col("low")))
    rows = rows.withColumn("level", F.col("sum") - F.col("low") + (F.col("closes") & ~F.col("stray")).cast("int"))
    # every tag belongs to the last macro that was opened on its level
    level = Window.partitionBy("page_id", "_row", "level").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("macro", F.last(F.when(F.col("opens"), F.col("at")), True).over(level)).where("macro is not null and level > 0")
    macros = rows.groupBy("page_id", "_row", "macro").agg(
        F.max(F.when(F.col("opens"), F.lower("name"))).alias("name"),
        F.bool_or(F.col("kind").isin(BODY_TAGS) & ~F.col("alone")).alias("body"),
        F.bool_or(F.coalesce("key", F.lit(False)) & F.col("says")).alias("keyed"),
        F.bool_or(F.col("closes")).alias("closed"),
    )
    return _counted(macros.where("closed and not body and not (name = 'jira' and keyed)"), rows_alone(some))


def rows_alone(pages: DataFrame) -> DataFrame:
    """(page_id, name) of macros that are one self-closed tag."""
    plain = F.regexp_replace(escaped_cdata(F.col("html")), "(?s)<!--.*?-->", "")
    tags = F.regexp_extract_all(plain, F.lit(f"(?is)<(?:{'|'.join(MACRO_TAGS)})(?=[\\s/])[^>]*/>"), F.lit(0))
    return pages.select("page_id", "html").distinct().select("page_id", F.explode(tags).alias("tag")).select("page_id", F.lower(F.regexp_extract("tag", "(?is)\\sac:name\\s*=\\s*[\"']([^\"']*)", 1)).alias("name"))


def _counted(macros: DataFrame, alone: DataFrame) -> DataFrame:
    loud = macros.select("page_id", "name").unionByName(alone).where(~F.col("name").isin(QUIET_MACROS))
    return loud.groupBy("page_id", F.when(F.col("name") == "", "unnamed").otherwise(F.col("name")).alias("macro")).agg(F.count("*").cast("int").alias("n"))
