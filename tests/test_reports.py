"""Sinks, totals and indexes that the check tests don't reach."""

import json

from pyspark.sql import functions as F

from corpusproof.operators import entries, handbook, ledger, linkage, pages, repos
from corpusproof.sources import tables

ITEM = "source string, verdict string, reason string, entries array<struct<type:string,name:string,statement:string,basis:string>>"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_entry_sinks_and_totals(spark, tmp_path):
    items = spark.createDataFrame([("1", "extracted", "", [("term", "B", "two", "stated"), ("rule", "A", "one", "inferred")]), ("2", "no_business_content", " nothing  here ", [])], ITEM)
    state = spark.createDataFrame([("1", "verified"), ("2", "verified"), ("3", "done")], "page_id string, status string")
    assert rows(entries.entry_totals(items, state, "page_id")) == [("extracted", 1, 2, 1), ("no_business_content", 1, 0, 0)]
    assert rows(entries.empty_sources(items)) == [("2", "nothing here")]
    flat = entries.catalogue(items)
    assert [r.name for r in flat.collect()] == ["A", "B"]
    body = tables.rendered(entries.catalogue_lines(flat)).first().body
    assert body == "## rule (1)\n- **A**: one (1)\n## term (1)\n- **B**: two (1)"
    sources = spark.createDataFrame([("1", "Title", "2024")], "key string, title string, last_modified string")
    tables.flat_entries(items, sources, "page").write.json(str(tmp_path / "e"))
    assert rows(spark.read.json(str(tmp_path / "e")).select("name", "source", "source_kind", "source_title")) == [("A", "1", "page", "Title"), ("B", "1", "page", "Title")]
    tables.write_documents(spark.createDataFrame([("d", "x\ny")], "doc string, body string"), str(tmp_path / "docs"))
    assert {r.value for r in spark.read.text(str(tmp_path / "docs")).collect()} == {"x", "y"}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a-1.json").write_text(json.dumps({"source": "a", "verdict": "extracted"}, indent=1))
    assert rows(tables.read_documents(spark, str(tmp_path / "in"), "source string, verdict string")) == [("a", "extracted", "a-1")]


def test_graph_sinks(spark, tmp_path):
    edges = spark.createDataFrame([("a", "b", "imports", "x", "", "", "high")], ", ".join(f"{c} string" for c in tables.GRAPH_COLUMNS["edges"]))
    pipes = spark.createDataFrame([tuple("r" * 8)], ", ".join(f"c{k} string" for k in range(8))).toDF(*tables.GRAPH_COLUMNS["pipelines"])
    nodes = linkage.graph_nodes(spark.createDataFrame([("a",), ("b",), ("c",)], "repo string"), edges)
    tables.write_graph({"edges": edges, "pipelines": pipes, "nodes": nodes}, str(tmp_path))
    assert rows(spark.read.csv(str(tmp_path / "nodes"), header=True)) == [("a", "1", "0", "0"), ("b", "0", "1", "0"), ("c", "0", "0", "0")]
    assert rows(linkage.isolated(nodes, edges)) == [("c",)]
    refs = spark.createDataFrame([("P-1", "page", "1", "l"), ("P-1", "page", "1", "l")], "key string, source_kind string, source string, location string")
    tables.write_references(refs, str(tmp_path / "refs"))
    assert spark.read.csv(str(tmp_path / "refs"), header=True).count() == 1


def test_repository_reports(spark):
    facts = spark.createDataFrame([("a", "service", "x | y", ["p"], [("k", "i")])], "repo string, kind string, purpose string, pipelines array<string>, consumes array<struct<kind:string,id:string>>")
    state = spark.createDataFrame([("a", "u", "verified"), ("b", "", "done")], "repo string, clone_url string, status string")
    assert rows(repos.repo_index(state, facts)) == [("a", "service", "x / y", 1, "verified"), ("b", "", "", 0, "done")]
    assert {r.check for r in repos.inventory_checks(state, 2).where("not ok").collect()} == {"I3"}
    found = spark.createDataFrame([("a", "b", "i", 3)], "repo string, target string, identifier string, n long")
    hits = spark.createDataFrame([("a", True), ("a", False)], "repo string, cross boolean")
    assert rows(linkage.candidate_totals(state, facts, found, hits)) == [("a", 1, 1, 2, 1), ("b", 0, 0, 0, 0)]
    files = spark.createDataFrame([("a", "db/migrate/1.sql"), ("a", "infra/main.tf"), ("a", "x.sql")], "repo string, path string")
    assert rows(repos.sql_folders(files)) == [("a", ".", 1), ("a", "db/migrate", 1)]
    assert rows(repos.terraform_folders(files)) == [("a", "infra")] and rows(repos.migration_folders(files)) == [("a", "db/migrate")]


def test_page_reports(spark):
    made = spark.createDataFrame([("1", "[a](outside://S/T) [b](outside://S/T) [MACRO: toc]\n```\n[MACRO: no]\n```"), ("2", "[MACRO: toc (x)]")], "page_id string, markdown string")
    assert rows(pages.outside_links(made)) == [("outside://S/T", 2)]
    assert rows(pages.placeholder_totals(made)) == [("toc", 2, 2)]
    state = spark.createDataFrame([("1", "T", "3", "S", "u"), ("2", "U", "1", "S", "u")], "page_id string, title string, version string, space_key string, source_url string")
    got = {r.page_id: r.markdown for r in pages.passed_through(spark.createDataFrame([("1", "# Own\nx"), ("2", "plain")], "page_id string, html string"), state).collect()}
    assert got["1"].endswith("---\n\n# Own\nx\n") and got["2"].endswith("# U\n\nplain\n")


def test_handbook_reports(spark):
    state = spark.createDataFrame([("a", "team", "done"), ("o", "overview", "done")], "area string, kind string, status string")
    assert [r.area for r in handbook.ready_chapters(state).collect()] == ["a"]
    assert handbook.ready_chapters(state.withColumn("status", F.when(F.col("area") == "a", "verified").otherwise("done"))).count() == 2
    wiki = spark.createDataFrame([("1", "verified", "x.md"), ("2", "done", "y.md"), ("3", "verified", "")], "page_id string, status string, md_path string")
    judged = spark.createDataFrame([("1", "verified", "extracted")], "page_id string, status string, verdict string")
    assert [(r.page_id, r.entry_verdict) for r in handbook.usable_pages(wiki, judged).collect()] == [("1", "extracted")]
    blocks = spark.createDataFrame([("a", "5. Processes followed", 1, "x [p:1]")], "area string, section string, block_no int, block string")
    titled = spark.createDataFrame([("1", "Zeta"), ("2", "alpha")], "page_id string, title string")
    assert [(r.title, r.chapters) for r in handbook.source_index(titled, blocks).collect()] == [("alpha", 0), ("Zeta", 1)]
    facts = handbook.chapter_facts(spark.createDataFrame([("a", "1")], "area string, page_id string"), spark.createDataFrame([("1", "n")], "source string, name string"))
    assert rows(facts.select("area", "name")) == [("a", "n")]


def test_outcomes_and_seeding(spark):
    state = spark.createDataFrame([("1", "done", "0", "", "", "", ""), ("2", "done", "0", "", "", "", "")], "page_id string, status string, attempts string, notes string, verdict string, n_entries string, n_inferred string")
    judged = spark.createDataFrame([("1", True, ""), ("2", True, "")], "key string, ok boolean, failing string")
    items = spark.createDataFrame([("1", "extracted", "", [("term", "B", "two", "inferred")]), ("2", "needs_human", "", [])], ITEM)
    got = ledger.with_entry_outcomes(state, judged, items, "page_id", F.lit("2024-01-01").cast("timestamp"))
    assert sorted((r.page_id, r.status, r.verdict, r.n_entries, r.n_inferred) for r in got.collect()) == [("1", "verified", "extracted", "1", "1"), ("2", "needs_human", "needs_human", "0", "0")]
    counts = ledger.refreshed_counts(state, spark.createDataFrame([("1", 5), ("9", 6)], "page_id string, n_entries int"), "page_id")
    assert {r.page_id: (r.n_entries, r.status) for r in counts.collect()} == {"1": ("5", "done"), "2": ("", "done"), "9": ("6", "pending")}
