"""Tickets: references found in pages, code and commits, one-hop expansion, checks, and context attached to sources."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusproof.functions.text import commit_records, linked_tickets, quote_in, secrets_in, text_of, ticket_keys, ticket_text, word_count
from corpusproof.operators.checks import checks_of, none_left, union_all
from corpusproof.operators.entries import TICKET_PLACES, entry_problems

MOST_LOCATIONS = 5
UNAVAILABLE = ("not_found", "no_access")


def references(projects: Iterable[str], pages: DataFrame | None = None, lines: DataFrame | None = None, commits: DataFrame | None = None, branches: DataFrame | None = None) -> DataFrame:
    """Distinct (key, source_kind, source, location) of ticket keys.

    ``pages(page_id, markdown)`` give line numbers, ``lines(repo, path, line, text)`` path and line, ``commits(repo, log)``
    the hash, ``branches(repo, branch)`` the upper-cased branch name.
    """
    projects = list(projects)
    found = []

    def add(rows: DataFrame, text, kind: str, source: str, location) -> None:
        found.append(rows.select(F.explode(ticket_keys(text, projects)).alias("key"), F.lit(kind).alias("source_kind"), F.col(source).cast("string").alias("source"), location.alias("location")))

    if pages is not None:
        split = pages.select("page_id", F.posexplode(F.split("markdown", "\\n")).alias("at", "text"))
        add(split, F.col("text"), "page", "page_id", F.concat(F.lit("line "), (F.col("at") + 1).cast("string")))
    if lines is not None:
        add(lines, F.col("text"), "code", "repo", F.concat_ws(":", "path", F.col("line").cast("string")))
    if commits is not None:
        split = commits.select("repo", F.explode(commit_records(F.col("log"))).alias("c"))
        add(split, F.col("c.message"), "commit", "repo", F.col("c.hash"))
    if branches is not None:
        add(branches, F.upper("branch"), "branch", "repo", F.col("branch"))
    return union_all(found).distinct()


def reference_counts(refs: DataFrame) -> DataFrame:
    """(key, n_references, first_reference): over distinct references; the first is the smallest of (kind, source, location)."""
    once = refs.select("key", "source_kind", "source", "location").distinct()
    first = F.min(F.struct("source_kind", "source", "location"))
    return once.groupBy("key").agg(F.count("*").alias("n_references"), F.concat_ws(" ", first["source_kind"], first["source"], first["location"]).alias("first_reference"))


def linked_rows(tickets: DataFrame, ledger: DataFrame) -> DataFrame:
    """(key, first_reference) of tickets linked by tickets of depth 0 that the ledger lacks; the first linker, by key, counts."""
    near = tickets.join(ledger.where(text_of(F.col("depth")) == "0").select("key"), "key", "left_semi")
    links = near.select(F.col("key").alias("by"), F.explode(linked_tickets(F.col("parent"), F.col("epic"), F.col("links"))).alias("key"))
    fresh = links.join(ledger.select("key"), "key", "left_anti")
    return fresh.groupBy("key").agg(F.min("by").alias("by")).select("key", F.lit("1").alias("depth"), F.concat(F.lit("linked from "), "by").alias("first_reference"))


def ticket_checks(tickets: DataFrame, ledger: DataFrame) -> DataFrame:
    """J1 to J6; J4 only where the shape (J3) is right."""
    base = ledger.select("key", "depth").join(tickets, "key", "left")
    text = ticket_text(F.col("summary"), F.col("description"), F.col("acceptance_criteria"), F.col("comments"))
    problems = entry_problems(F.col("entries"), TICKET_PLACES)
    blank = F.trim(text) == ""
    quotes = F.flatten(F.transform("entries", lambda e: e["evidence"]))
    false = F.exists(quotes, lambda q: ~quote_in(q["quote"], F.col("_text")))
    whole = F.concat_ws("\n", text, F.to_json("entries"), text_of(F.col("why")))
    base = base.withColumn("_text", text)
    checks = checks_of(
        base,
        "key",
        {
            "J1": (F.col("summary").isNotNull() & F.col("status").isNotNull() & F.col("links").isNotNull() & F.col("comments").isNotNull() & F.col("entries").isNotNull(), "fields are absent"),
            "J2": (word_count(F.col("why")) >= F.when(blank, 5).otherwise(15), "why is too short"),
            "J3": (F.size(problems) == 0, F.array_join(problems, "; ")),
            "J4": (F.when(F.size(problems) == 0, ~F.coalesce(false, F.lit(False))).otherwise(F.lit(True)), "a quote is not in the ticket"),
            "J6": (F.size(secrets_in(whole)) == 0, F.array_join(secrets_in(whole), ", ")),
        },
    )
    near = base.where(text_of(F.col("depth")) == "0")
    links = near.select("key", F.explode(linked_tickets(F.col("parent"), F.col("epic"), F.col("links"))).alias("linked"))
    lost = links.join(ledger.select(F.col("key").alias("linked")), "linked", "left_anti")
    return union_all([checks, none_left(base, lost, "key", "J5", "linked")])


def enriched(refs: DataFrame, tickets: DataFrame, ledger: DataFrame) -> DataFrame:
    """References with their ticket's summary and why; of unavailable tickets the status instead."""
    known = tickets.join(ledger.where("status = 'verified'").select("key"), "key", "left_semi").select("key", "summary", "why", F.col("status").alias("ticket_status"))
    state = ledger.select("key", F.col("status").alias("ledger_status"))
    return refs.join(known, "key", "left").join(state, "key", "left").withColumn("context", F.coalesce("summary", F.concat(F.lit("("), F.coalesce("ledger_status", F.lit("unknown")), F.lit(")"))))


def source_tickets(refs: DataFrame, most: int = MOST_LOCATIONS) -> DataFrame:
    """(source_kind, source, key, n, locations): of each source its keys, with the first locations and "..." for more."""
    once = refs.select("source_kind", "source", "key", "location").distinct()
    by = ["source_kind", "source", "key"]
    ranked = once.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy("location"))).withColumn("_n", F.count("*").over(Window.partitionBy(*by)))
    first = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", "location"))), lambda x: x["location"]), ", ")
    return ranked.where(F.col("_k") <= most).groupBy(*by).agg(F.max("_n").alias("n"), first.alias("_l")).select(*by, "n", F.when(F.col("n") > most, F.concat("_l", F.lit(", ..."))).otherwise(F.col("_l")).alias("locations"))
