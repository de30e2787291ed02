"""Queries of sources and sinks: rows of the given tables are written below the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusproof.operators import entries, ledger, linkage, tickets
from corpusproof.plans.bindings import ENTRIES, LEDGER, REFS, SECOND, entry_rows, second_inventory, table, ticket_refs
from corpusproof.plans.bindings import ledger as ledger_rows
from corpusproof.plans.columns import _say
from corpusproof.plans.queries import _EDGES, _edges
from corpusproof.plans.registry import query
from corpusproof.sources import lines, tables
from corpusproof.sources.shared import scratch_folder


@query(f"""WITH {LEDGER} SELECT key, status, attempts, 'two' || chr(10) || 'lines, "' || space || '"' AS notes, '' AS owner FROM ledger""")
def files_ledger(spark, sf):
    """A ledger with quotes, commas and line ends in its cells, and a column that no row has."""
    path = scratch_folder(spark, "ledger")
    rows = ledger_rows(spark, sf).withColumn("notes", _say("two\nlines, \"", "{space}", '"'))
    tables.write_ledger(rows, path, ["key", "status", "attempts", "notes", "owner"])
    return tables.read_ledger(spark, path, ["key", "status", "attempts", "notes", "owner"])


@query(f"""WITH {SECOND} SELECT key, 'pending' AS status, '0' AS attempts, '' AS notes, version, 'added' AS merge FROM second""")
def files_empty_ledger(spark, sf):
    """A ledger that is created empty, read back and filled from an inventory."""
    path = scratch_folder(spark, "ledger")
    ledger.create_ledger(spark, path, ["key", "version"])
    fields = ["key", "version", *ledger.REQUIRED]
    filled = ledger.merged(tables.read_ledger(spark, path, fields), second_inventory(spark, sf).select("key", "version"), "key")
    return filled.select("key", "status", "attempts", "notes", "version", "merge")


@query("""SELECT CASE WHEN k IN (0, 1, 4) THEN CAST(doc_id AS VARCHAR) WHEN k = 2 THEN ' ' END AS key, CASE k WHEN 1 THEN 'unknown field: other' WHEN 2 THEN 'blank key' WHEN 3 THEN 'broken JSON' WHEN 4 THEN 'status verified cannot be set' END AS problem FROM (SELECT doc_id, doc_id % 6 AS k FROM documents) WHERE k < 5""")
def files_inventory(spark, sf):
    """Lines of an inventory: sound, with an unknown field, a blank key, broken, verified by hand, blank."""
    path = scratch_folder(spark, "inventory")
    k = F.col("doc_id") % 6
    line = F.when(k == 0, _say('{"key": "', "{doc_id}", '"}')).when(k == 1, _say('{"key": "', "{doc_id}", '", "other": 1}')).when(k == 2, '{"key": " "}').when(k == 3, _say('{"key": "', "{doc_id}")).when(k == 4, _say('{"key": "', "{doc_id}", '", "status": "verified"}')).otherwise("  ")
    table(spark, sf, "documents").select(line.alias("value")).write.text(path)
    return tables.read_inventory(spark, path, ["key", "status"], "key").select("key", "problem")


_TEXT_LINES = """d AS (SELECT source, doc_id, text, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents WHERE text IS NOT NULL)"""


def _documents_by_source(spark, sf):
    """Whole texts as one document for each source: (doc, seq, line), with their lines in order of doc_id."""
    cut = table(spark, sf, "documents").select("source", "doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    return cut.select(F.col("source").alias("doc"), F.struct("doc_id", "at").alias("seq"), "line")


@query(f"""WITH {_TEXT_LINES} SELECT source AS doc, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id, k, l) AS BIGINT) AS line, l AS text FROM d""")
def files_documents(spark, sf):
    """Documents as large as a source, written in ordered parts and read back in splits as numbered lines."""
    path = scratch_folder(spark, "documents")
    lines.write_ordered(_documents_by_source(spark, sf), path)
    return lines.read_ordered(spark, path)


@query(f"""WITH {_TEXT_LINES} SELECT source AS doc, CAST(count(*) AS BIGINT) AS lines, CAST(sum(strlen(l) + 1) AS BIGINT) AS bytes, true AS in_order FROM d GROUP BY source""")
def files_manifest(spark, sf):
    """What the manifest says of the parts of each document; each begins after the lines of those before."""
    parts = lines.write_ordered(_documents_by_source(spark, sf), scratch_folder(spark, "documents"))
    before = F.coalesce(F.sum("lines").over(Window.partitionBy("doc").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    seen = parts.withColumn("fits", F.col("first_line") == before + 1)
    return seen.groupBy("doc").agg(F.sum("lines").alias("lines"), F.sum("bytes").alias("bytes"), F.bool_and("fits").alias("in_order"))


@query(f"""WITH {_TEXT_LINES}, w AS (SELECT source AS repo, l AS text FROM d UNION ALL SELECT source, '' FROM documents WHERE text IS NOT NULL GROUP BY source)
SELECT repo, text, CAST(count(*) AS BIGINT) AS n FROM w GROUP BY ALL""")
def files_lines(spark, sf):
    """A tree of files below one folder for each source, read in splits as numbered lines; skipped folders and lock files leave none."""
    path = scratch_folder(spark, "tree")
    texts = table(spark, sf, "documents").where("text is not null")
    kept = texts.select("text", F.col("source").alias("repo")).repartition(1 + texts.select("source").distinct().count(), "repo")
    kept.write.partitionBy("repo").text(f"{path}/tree", lineSep="\n")
    texts.select("text", F.concat("source", F.lit("/vendor")).alias("repo")).write.partitionBy("repo").text(f"{path}/tree/repo=vendored/vendor", lineSep="\n")
    read = lines.read_lines(spark, f"{path}/tree", most_bytes=None)
    return read.groupBy(F.regexp_replace("repo", "^repo=", "").alias("repo"), "text").agg(F.count("*").alias("n"))


@query("""SELECT CAST(page_id AS VARCHAR) AS page_id, unnest(['a ' || CAST(page_id AS VARCHAR) || '.png', 'b']) AS filename, unnest([CAST(page_id AS VARCHAR), 'big']) AS size FROM pages WHERE page_id % 3 <> 0""")
def files_attachments(spark, sf):
    """Listings of attachments in JSON; every third page has an empty one."""
    listing = F.when(F.col("page_id") % 3 == 0, "[]").otherwise(_say('[{"filename": "a ', "{page_id}", '.png", "size": "', "{page_id}", '"}, {"filename": "b", "size": "big"}]'))
    return tables.attachments_of(table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("page_id"), listing.alias("listing")))


@query(f"""WITH {ENTRIES} SELECT type, name, statement, source, 'page' AS source_kind, 'Title ' || source AS source_title, CASE WHEN source <> '3' THEN '2024' END AS source_last_modified FROM entries""")
def files_flat_entries(spark, sf):
    """Entries widened by their sources, written as JSON lines and read back."""
    path = scratch_folder(spark, "entries")
    rows = entry_rows(spark, sf).select("source", F.array(F.struct("type", "name", "statement")).alias("entries"))
    known = rows.select(F.col("source").alias("key")).distinct().select("key", _say("Title ", "{key}").alias("title"), F.when(F.col("key") != "3", "2024").alias("last_modified"))
    tables.flat_entries(rows, known, "page").write.json(path)
    schema = "type string, name string, statement string, source string, source_kind string, source_title string, source_last_modified string"
    return spark.read.schema(schema).json(path)


@query(f"""WITH {_EDGES} SELECT from_repo, to_repo, kind, identifier, '' AS evidence_from, '' AS evidence_to, 'high' AS confidence FROM edges""")
def files_graph(spark, sf):
    """The graph's edges as CSV in their fixed order of columns, read back; degrees are counted from what was written."""
    path = scratch_folder(spark, "graph")
    edges = _edges(spark, sf).withColumns({"evidence_from": F.lit(""), "evidence_to": F.lit(""), "confidence": F.lit("high")})
    tables.write_graph({"edges": edges}, path, "gzip")
    written = tables.read_graph(spark, path, "edges")
    repos = table(spark, sf, "nation").select(F.col("n_name").alias("repo"))
    pipelines = repos.select("repo", *(F.lit("x").alias(c) for c in tables.GRAPH_COLUMNS["pipelines"][1:]))
    tables.write_graph({"pipelines": pipelines, "nodes": linkage.graph_nodes(repos, written)}, path, "gzip")
    return written


@query(f"WITH {REFS} SELECT key, source_kind, source, location FROM refs")
def files_references(spark, sf):
    path = scratch_folder(spark, "references")
    refs = tickets.references(["PAY"], lines=ticket_refs(spark, sf))
    tables.write_references(refs.unionByName(refs), path)
    return tables.read_ledger(spark, path, ["key", "source_kind", "source", "location"])


@query(f"""WITH {ENTRIES}, l AS (SELECT type, 0 AS p, '' AS n, '' AS s, '## ' || type || ' (' || CAST(count(*) AS VARCHAR) || ')' AS line FROM entries GROUP BY type
 UNION ALL SELECT type, 1, norm, source, '- **' || name || '**: ' || statement || ' (' || source || ')' FROM entries),
c AS (SELECT *, unnest(string_split(line, chr(10))) AS text, generate_subscripts(string_split(line, chr(10)), 1) AS k FROM l)
SELECT 'catalogue' AS doc, CAST(row_number() OVER (ORDER BY list_position(['rule','term','process','calculation','state','constraint','decision','role','integration','metric','policy'], type), p, n, s, line, k) AS BIGINT) AS line, text FROM c""")
def entry_catalogue(spark, sf):
    """The catalogue as one document, written in ordered parts and read back."""
    path = scratch_folder(spark, "catalogue")
    lines.write_ordered(entries.catalogue_lines(entry_rows(spark, sf)), path)
    return lines.read_ordered(spark, path)
