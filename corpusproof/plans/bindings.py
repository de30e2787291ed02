"""How the star-schema, document and page tables stand in for ledgers, files, facts and tickets in the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusproof.functions.text import word_count


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels as a ledger of strings, and row_no."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    status = F.when(F.col("l.doc_id").isNull(), "pending").when(F.col("toxic") == 1, "failed").when(F.col("quality") == 1, "verified").otherwise("done")
    joined = docs.alias("d").join(labels.alias("l"), F.col("d.doc_id") == F.col("l.doc_id"), "left")
    return joined.select(F.col("d.doc_id").cast("string").alias("key"), status.alias("status"), (F.col("d.doc_id") % 3).cast("string").alias("attempts"), F.lit("").alias("notes"), F.col("n_chars").cast("string").alias("version"), F.col("lang").alias("space"), F.col("d.doc_id").alias("row_no"))


LEDGER = """ledger AS (SELECT CAST(d.doc_id AS VARCHAR) AS key, CASE WHEN l.doc_id IS NULL THEN 'pending' WHEN toxic = 1 THEN 'failed'
 WHEN quality = 1 THEN 'verified' ELSE 'done' END AS status, CAST(d.doc_id % 3 AS VARCHAR) AS attempts, '' AS notes,
 CAST(n_chars AS VARCHAR) AS version, lang AS space, d.doc_id AS row_no FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def second_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later inventory: some documents gone, some versions changed, some keys new."""
    docs = table(spark, sf_dir, "documents")
    version = F.concat(F.col("n_chars").cast("string"), F.when(F.col("doc_id") % 7 == 0, "9").otherwise(""))
    kept = docs.where("doc_id % 19 <> 0").select(F.col("doc_id").cast("string").alias("key"), version.alias("version"), F.col("lang").alias("space"))
    new = docs.where("doc_id % 23 = 0").select((F.col("doc_id") + 1_000_000_000).cast("string").alias("key"), F.col("n_chars").cast("string").alias("version"), F.col("lang").alias("space"))
    return kept.unionByName(new)


SECOND = """second AS (SELECT CAST(doc_id AS VARCHAR) AS key, CAST(n_chars AS VARCHAR) || CASE WHEN doc_id % 7 = 0 THEN '9' ELSE '' END AS version, lang AS space
 FROM documents WHERE doc_id % 19 <> 0 UNION ALL SELECT CAST(doc_id + 1000000000 AS VARCHAR), CAST(n_chars AS VARCHAR), lang FROM documents WHERE doc_id % 23 = 0)"""


def page_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with title (first heading), space (host), parent (a tree of fan-out four), row_no."""
    pages = table(spark, sf_dir, "pages")
    parent = F.when(F.col("page_id") > 0, F.floor((F.col("page_id") - 1) / 4).cast("long"))
    return pages.select("page_id", F.regexp_extract("html", "<h1>([^<]*)</h1>", 1).alias("title"), F.regexp_extract("url", "://([^/?#]*)", 1).alias("space_key"), parent.alias("parent_id"), F.col("page_id").alias("row_no"), "url", word_count(F.col("html")).cast("long").alias("n_words"))


PAGES = """page_rows AS (SELECT page_id, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS title, regexp_extract(url, '://([^/?#]*)', 1) AS space_key,
 CASE WHEN page_id > 0 THEN CAST(floor((page_id - 1) / 4.0) AS BIGINT) END AS parent_id, page_id AS row_no, url,
 CAST(len(regexp_extract_all(html, '\\S+')) AS BIGINT) AS n_words FROM pages)"""


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: repo is the source, path the doc_id, lines from 1."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("source").alias("repo"), F.col("doc_id").cast("string").alias("path"), F.posexplode(F.split("text", "\\n")).alias("at", "text")).select("repo", "path", (F.col("at") + 1).cast("long").alias("line"), "text")


LINES = """doc_lines AS (SELECT source AS repo, CAST(doc_id AS VARCHAR) AS path, CAST(i AS BIGINT) AS line, parts[i] AS text
 FROM (SELECT source, doc_id, string_split(text, chr(10)) AS parts FROM documents), unnest(range(1, len(parts) + 1)) AS u(i))"""


def made_and_used(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(produces(repo, part), consumes(repo, part)): nations as repositories, parts as identifiers; items with odd numbers are made by the supplier's nation, others used by the customer's."""
    item, orders, customer, supplier, nation = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "supplier", "nation"))
    made = item.where("l_linenumber % 2 = 1").join(supplier, item["l_suppkey"] == supplier["s_suppkey"]).join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("repo"), F.col("l_partkey").cast("string").alias("part")).distinct()
    used = item.where("l_linenumber % 2 = 0").join(orders, item["l_orderkey"] == orders["o_orderkey"]).join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("repo"), F.col("l_partkey").cast("string").alias("part")).distinct()
    return made, used


MADE_USED = """made AS (SELECT DISTINCT n_name AS repo, CAST(l_partkey AS VARCHAR) AS part FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
 JOIN nation ON s_nationkey = n_nationkey WHERE l_linenumber % 2 = 1),
used AS (SELECT DISTINCT n_name AS repo, CAST(l_partkey AS VARCHAR) AS part FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE l_linenumber % 2 = 0)"""


def chapter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as chapter blocks: (area, section, block_no, block); every fifth cites nothing, some state numbers."""
    turns, docs = table(spark, sf_dir, "conversations"), table(spark, sf_dir, "documents")
    n = docs.agg(F.count("*").alias("n"))
    cited = turns.crossJoin(F.broadcast(n)).withColumn("page", F.col("conv_id") * 7 % F.col("n"))  # one row
    joined = cited.join(docs.select(F.col("doc_id").alias("page"), "n_chars"), "page", "left")
    number = F.when(F.col("turn") % 2 == 1, F.lit(" 10 days")).otherwise(F.concat(F.lit(" "), F.coalesce(F.col("n_chars"), F.lit(0)).cast("string")))
    cite = F.when(F.col("turn") % 5 == 4, F.lit("")).otherwise(F.concat(F.lit(" [p:"), F.col("page").cast("string"), F.lit("]")))
    section = F.when(F.col("turn") % 7 == 6, "Pages not used").otherwise("5. Processes followed")
    return joined.select(F.col("conv_id").cast("string").alias("area"), section.alias("section"), F.lit("").alias("subhead"), F.col("turn").alias("block_no"), F.concat(F.coalesce("text", F.lit("")), number, cite).alias("block"))


CHAPTERS = """blocks AS (SELECT CAST(conv_id AS VARCHAR) AS area, CASE WHEN turn % 7 = 6 THEN 'Pages not used' ELSE '5. Processes followed' END AS section, turn AS block_no,
 CAST(page AS VARCHAR) AS page, turn % 5 <> 4 AS cites, coalesce(c.text, '') || CASE WHEN turn % 2 = 1 THEN ' 10 days' ELSE ' ' || CAST(coalesce(d.n_chars, 0) AS VARCHAR) END AS bare
 FROM (SELECT *, conv_id * 7 % (SELECT count(*) FROM documents) AS page FROM conversations) c LEFT JOIN documents d ON d.doc_id = c.page)"""


def entry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as entries: (source, type, name, statement, basis, norm)."""
    from corpusproof.functions.text import quote_form
    from corpusproof.operators.entries import TYPES

    items = table(spark, sf_dir, "benchmark")
    kinds = F.array(*map(F.lit, TYPES))
    rows = items.select((F.col("item_id") % 8).cast("string").alias("source"), kinds[(F.col("item_id") % 11).cast("int")].alias("type"), F.regexp_extract("text", "^\\s*(\\S+)", 1).alias("name"), F.col("text").alias("statement"), F.when(F.col("item_id") % 4 == 0, "inferred").otherwise("stated").alias("basis"))
    return rows.withColumn("norm", quote_form(F.col("name")))


_NORM = "lower(trim(regexp_replace(regexp_replace(translate({}, '‘’“”', '''''\"\"'), '[\\\\*`_|>#]', '', 'g'), '\\s+', ' ', 'g')))"


def norm_sql(value: str) -> str:
    """quote_form in DuckDB, for text without line-break tags."""
    return _NORM.format(value)


ENTRIES = f"""entries AS (SELECT CAST(item_id % 8 AS VARCHAR) AS source, (['rule','term','process','calculation','state','constraint','decision','role','integration','metric','policy'])[item_id % 11 + 1] AS type,
 regexp_extract(text, '^\\s*(\\S+)', 1) AS name, text AS statement, CASE WHEN item_id % 4 = 0 THEN 'inferred' ELSE 'stated' END AS basis, {norm_sql("regexp_extract(text, '^\\s*(\\S+)', 1)")} AS norm FROM benchmark)"""


def ticket_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as lines that name tickets: (repo, path, line, text)."""
    events = table(spark, sf_dir, "events")
    text = F.concat(F.lit("see PAY-"), F.col("user_id").cast("string"), F.lit(" and UTF-8, XPAY-"), F.col("user_id").cast("string"))
    return events.select(F.col("event_type").alias("repo"), F.lit("log").alias("path"), F.col("event_id").alias("line"), text.alias("text"))


REFS = """refs AS (SELECT DISTINCT 'PAY-' || CAST(user_id AS VARCHAR) AS key, 'code' AS source_kind, event_type AS source, 'log:' || CAST(event_id AS VARCHAR) AS location
 FROM events WHERE user_id BETWEEN 1 AND 9999999)"""
