"""Extracted business facts: shape, verbatim evidence, independent samples, and the catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusproof.functions.text import field_citation, headings_in, quote_form, secrets_in, squeeze, text_of, word_count
from corpusproof.operators.checks import check, checks_of, none_left, union_all

# fixed values: the vocabulary of entries
TYPES = ["rule", "term", "process", "calculation", "state", "constraint", "decision", "role", "integration", "metric", "policy"]
BASIS = ["stated", "inferred"]
CONFIDENCE = ["high", "medium", "low"]
VERDICTS = ["extracted", "no_business_content", "needs_human"]
TICKET_PLACES = ["summary", "description", "acceptance_criteria", "comment"]
NEAR = 20
#: Rows that an independent sample has at least, for entries.
LEAST_SAMPLE = 8


def entry_problems(entries: Column, places: list[str] | None = None) -> Column:
    """array of what is wrong with the shape of entries; ``places`` limits where evidence may be."""
    none = F.array().cast("array<string>")

    def of_quote(e: Column, n: Column) -> Column:
        words = word_count(e["quote"])
        where = F.trim(text_of(e["where"])) == "" if places is None else ~text_of(e["where"]).isin(places)
        return F.array_compact(F.array(F.when(where, F.concat(n, F.lit(": evidence without a valid place"))), F.when((words < 3) | (words > 40), F.concat(n, F.lit(": quote of "), words.cast("string"), F.lit(" words")))))

    def one(e: Column, i: Column) -> Column:
        n = F.concat(F.lit("entry "), (i + 1).cast("string"))
        name, statement = word_count(e["name"]), word_count(e["statement"])
        said = F.array_compact(
            F.array(
                F.when(~text_of(e["type"]).isin(TYPES), F.concat(n, F.lit(": type"))),
                F.when((name < 1) | (name > 12), F.concat(n, F.lit(": name"))),
                F.when((statement < 5) | (statement > 90), F.concat(n, F.lit(": statement"))),
                F.when(~text_of(e["basis"]).isin(BASIS), F.concat(n, F.lit(": basis"))),
                F.when(~text_of(e["confidence"]).isin(CONFIDENCE), F.concat(n, F.lit(": confidence"))),
                F.when(e["related"].isNull(), F.concat(n, F.lit(": related is no list"))),
                F.when(e["jira_keys"].isNull(), F.concat(n, F.lit(": jira_keys is no list"))),
                F.when(F.coalesce(F.size(e["evidence"]), F.lit(0)) < 1, F.concat(n, F.lit(": no evidence"))),
            )
        )
        return F.concat(said, F.coalesce(F.flatten(F.transform(e["evidence"], lambda q: of_quote(q, n))), none))

    return F.coalesce(F.flatten(F.transform(entries, one)), none)


def with_form(pages: DataFrame) -> DataFrame:
    """(source, form, headings) of ``pages(source, markdown)``: normalised once, for all quotes."""
    return pages.select("source", quote_form(F.col("markdown")).alias("form"), headings_in(F.col("markdown")).alias("headings"))


def page_evidence(quotes: DataFrame, pages: DataFrame) -> DataFrame:
    """``quotes(source, where, quote, ...)`` with found and placed: quote in the page, heading (or "(top)") among its headings."""
    joined = quotes.join(with_form(pages), "source", "left")
    form = quote_form(F.col("quote"))
    placed = (F.trim("where") == "(top)") | F.array_contains("headings", quote_form(F.col("where")))
    return joined.withColumns({"found": F.coalesce((form != "") & F.col("form").contains(form), F.lit(False)), "placed": F.coalesce(placed, F.lit(False))}).select(*quotes.columns, "found", "placed")


def line_blocks(forms: DataFrame, place: str, before: int, length: int, after: int) -> DataFrame:
    """(repo, path, block, lines): overlapping blocks of ``forms(repo, path, <place>, form)``, each an array of (at, form) in order.

    Block k holds the places from k * length - before up to (k + 1) * length + after, so a row is in few blocks, and a
    place of block ``floor(place / length)`` has what is around it in that block.
    """
    at = F.col(place)
    numbers = F.sequence(F.ceil((at - after + 1) / length).cast("long") - 1, F.floor((at + before) / length).cast("long"))
    rows = forms.select("repo", "path", F.explode(numbers).alias("block"), F.struct(at.alias("at"), "form").alias("row"))
    return rows.groupBy("repo", "path", "block").agg(F.sort_array(F.collect_list("row")).alias("lines"))


def line_evidence(quotes: DataFrame, lines: DataFrame, window: int = NEAR) -> DataFrame:
    """``quotes(source, where, quote)`` with result: ok, not near, not found, malformed or no such place.

    ``lines(repo, path, line, text)``.  Lines are normalised once, each on its own, and put into overlapping blocks; a
    citation joins the one block that holds all lines around it.  Quotes that are not near are looked for in blocks of
    their file's lines that are not blank: one of n words lies within n of those.  Only quotes of more words than a block
    has lines look through their file in one piece.  A tag that is broken over two lines counts as text.
    """
    cited = quotes.withColumn("_q", F.xxhash64("source", "where", "quote")).withColumn("_c", field_citation(F.col("where"))).withColumns({"_path": F.col("_c.path"), "_line": F.col("_c.start")})
    places = cited.where("_c is not null").select("_q", quote_form(F.col("quote")).alias("own"), F.col("source").alias("repo"), F.col("_path").alias("path"), F.col("_line").alias("cited")).distinct()
    forms = lines.select("repo", "path", F.col("line").cast("long").alias("line"), quote_form(F.col("text")).alias("form"))
    length = 2 * window
    text = lambda rows: F.array_join(F.filter(F.transform(rows, lambda x: x["form"]), lambda f: f != ""), " ")
    here = F.filter("lines", lambda x: x["at"].between(F.col("cited") - window, F.col("cited") + window))
    blocks = line_blocks(forms, "line", window, length, window)
    around = places.withColumn("block", F.floor(F.col("cited") / length)).join(blocks, ["repo", "path", "block"])
    around = around.select("_q", "own", "repo", "path", F.exists("lines", lambda x: x["at"] == F.col("cited")).alias("exists"), ((F.col("own") != "") & text(here).contains(F.col("own"))).alias("near"))

    left = around.where("exists and not near and own <> ''").select("_q", "own", "repo", "path", word_count(F.col("own")).alias("words"))
    rank = F.row_number().over(Window.partitionBy("repo", "path").orderBy("line")) - 1
    filled = forms.where("form <> ''").join(left.select("repo", "path").distinct(), ["repo", "path"], "left_semi")
    dense = line_blocks(filled.withColumn("rank", rank.cast("long")), "rank", 0, length, length).select("repo", "path", text(F.col("lines")).alias("text"))
    far = left.where(F.col("words") <= length).join(dense, ["repo", "path"]).where(F.col("text").contains(F.col("own"))).select("_q")
    wordy = left.where(F.col("words") > length)
    whole = filled.join(wordy.select("repo", "path").distinct(), ["repo", "path"], "left_semi").groupBy("repo", "path").agg(text(F.sort_array(F.collect_list(F.struct("line", "form")))).alias("text"))
    far = far.unionByName(wordy.join(whole, ["repo", "path"]).where(F.col("text").contains(F.col("own"))).select("_q")).distinct().withColumn("in_file", F.lit(True))
    joined = cited.join(around.select("_q", "exists", "near"), "_q", "left").join(far, "_q", "left")
    result = F.when(F.col("_c").isNull(), "malformed").when(~F.coalesce("exists", F.lit(False)), "no such place").when(F.col("near"), "ok").when(F.col("in_file"), "not near").otherwise("not found")
    return joined.select(*quotes.columns, result.alias("result"))


def quotes_of(items: DataFrame) -> DataFrame:
    """(source, name, where, quote) of all evidence in ``items(source, entries)``."""
    return items.select("source", F.explode("entries").alias("e")).select("source", F.col("e.name").alias("name"), F.explode("e.evidence").alias("v")).select("source", "name", "v.where", "v.quote")


def duplicates(rows: DataFrame) -> DataFrame:
    """(source, type, name, n) of normalised names that ``rows(source, type, name)`` have twice for one source and type."""
    return rows.select("source", "type", quote_form(F.col("name")).alias("name")).groupBy("source", "type", "name").agg(F.count("*").alias("n")).where("n > 1")


def duplicate_names(items: DataFrame) -> DataFrame:
    """``duplicates`` among the entries of ``items(source, entries)``."""
    return duplicates(items.select("source", F.explode("entries").alias("e")).select("source", "e.type", "e.name"))


def sample_checks(checks: DataFrame, known: DataFrame, sizes: DataFrame, name: str, least: int, modified: DataFrame | None = None) -> DataFrame:
    """Independent samples: ``checks(key, sampled array<struct<name,result,reason>>, checked_at)``.

    The sample has min(least, n) rows of ``sizes(key, n)``, each among ``known(key, name)``, at most one not PASS, and is
    not older than ``modified(key, modified_at)``.
    """
    rows = checks.select("key", F.explode("sampled").alias("s")).select("key", F.col("s.name").alias("name"), F.col("s.result").alias("result"))
    per = rows.groupBy("key").agg(F.count("*").alias("sampled"), F.count_if(F.col("result") != "PASS").alias("failed"))
    strange = rows.select("key", quote_form(F.col("name")).alias("name")).join(known.select("key", quote_form(F.col("name")).alias("name")).distinct(), ["key", "name"], "left_anti").groupBy("key").agg(F.count("*").alias("strange"))
    joined = sizes.join(checks.select("key", "checked_at"), "key", "left").join(per, "key", "left").join(strange, "key", "left")
    fresh = F.lit(True)
    if modified is not None:
        joined = joined.join(modified, "key", "left")
        fresh = F.coalesce(F.col("checked_at") >= F.col("modified_at"), F.lit(True))
    zero = F.lit(0)
    ok = F.col("checked_at").isNotNull() & (F.coalesce("sampled", zero) >= F.least(F.lit(least), F.col("n"))) & (F.coalesce("strange", zero) == 0) & (F.coalesce("failed", zero) <= 1) & fresh
    detail = F.concat(F.lit("sampled "), F.coalesce("sampled", zero).cast("string"), F.lit(", unknown "), F.coalesce("strange", zero).cast("string"), F.lit(", not PASS "), F.coalesce("failed", zero).cast("string"), F.when(~fresh, F.lit(", older than its source")).otherwise(F.lit("")))
    return check(joined, "key", name, ok, detail)


def empty_verdict_checks(items: DataFrame, checks: DataFrame) -> DataFrame:
    """B7 of sources without entries: a second opinion agrees, with a reason of five or more words."""
    empty = items.where("verdict = 'no_business_content'").select(F.col("source").alias("key"))
    joined = empty.join(checks.select("key", "agrees", "reason"), "key", "left")
    return check(joined, "key", "B7", F.coalesce("agrees", F.lit(False)) & (word_count(F.col("reason")) >= 5), "no agreeing second opinion")


def entry_checks(kind: str, ledger: DataFrame, items: DataFrame, sources: DataFrame, checks: DataFrame, modified: DataFrame | None = None) -> DataFrame:
    """B1 to B7 of ``items(source, verdict, reason, entries)``; B4 only where the shape (B3) is right.

    ``sources`` are lines (kind "repo") or ``pages(source, markdown)`` (kind "page").
    """
    key = "repo" if kind == "repo" else "page_id"
    base = ledger.select(F.col(key).cast("string").alias("key")).join(items.withColumn("key", F.col("source")), "key", "left")
    n = F.greatest(F.coalesce(F.size("entries"), F.lit(0)), F.lit(0))
    problems = entry_problems(F.col("entries"))
    told = F.when(F.col("verdict") == "extracted", n > 0).otherwise((n == 0) & (word_count(F.col("reason")) >= 8))
    text = F.to_json("entries")
    first = checks_of(
        base,
        "key",
        {
            "B1": (F.col("source").isNotNull() & F.col("verdict").isin(VERDICTS), "no such document, or its verdict is unknown"),
            "B2": (told, "entries and verdict disagree, or the reason is too short"),
            "B3": (F.size(problems) == 0, F.array_join(problems, "; ")),
            "B6": (F.size(secrets_in(text)) == 0, F.array_join(secrets_in(text), ", ")),
        },
    )
    right = base.where(F.size(problems) == 0)
    quotes = quotes_of(right)
    if kind == "repo":
        bad = line_evidence(quotes, sources).where("result <> 'ok'").select("source", F.concat_ws(" ", "where", "result").alias("what"))
    else:
        bad = page_evidence(quotes, sources).where("not (found and placed)").select("source", "where").withColumnRenamed("where", "what")
    evidence = none_left(right.select(F.col("source")).where("source is not null"), bad, "source", "B4", "what")
    names = none_left(items.select("source"), duplicate_names(items), "source", "B5", "name")
    result = [first, evidence, names, empty_verdict_checks(items, checks)]
    if kind == "repo":
        sizes = items.where("verdict = 'extracted'").select(F.col("source").alias("key"), F.size("entries").alias("n"))
        known = items.select(F.col("source").alias("key"), F.explode("entries").alias("e")).select("key", F.col("e.name").alias("name"))
        result.append(sample_checks(checks, known, sizes, "B7", LEAST_SAMPLE, modified))
    return union_all(result)


# ---- the catalogue ----


def catalogue(items: DataFrame) -> DataFrame:
    """Entries of all sources with norm and the place of their type, in the order of the catalogue."""
    rows = items.select("source", F.explode("entries").alias("e")).select("source", "e.*").withColumn("norm", quote_form(F.col("name")))
    return rows.withColumn("type_no", F.array_position(F.array(*map(F.lit, TYPES)), F.col("type"))).orderBy("type_no", "norm", "source")


def type_counts(entries: DataFrame) -> DataFrame:
    """(type_no, type, n, sources) in the fixed order of types."""
    place = F.array_position(F.array(*map(F.lit, TYPES)), F.col("type"))
    return entries.groupBy("type").agg(F.count("*").alias("n"), F.countDistinct("source").alias("sources")).withColumn("type_no", place)


def collisions(entries: DataFrame) -> DataFrame:
    """(norm, sources, n) of names that more than one source has.  Sources are counted first, then listed for these names only."""
    pairs = entries.groupBy("norm", "source").agg(F.count("*").alias("n"))
    many = pairs.groupBy("norm").agg(F.count("*").alias("k"), F.sum("n").alias("n")).where("k > 1")
    return many.select("norm", F.col("k").alias("sources"), "n")


def entry_totals(items: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """(verdict, sources, entries, inferred) over verified rows."""
    done = ledger.where("status = 'verified'").select(F.col(key).alias("source"))
    inferred = F.size(F.filter("entries", lambda e: e["basis"] == "inferred"))
    return items.join(done, "source", "left_semi").groupBy("verdict").agg(F.count("*").alias("sources"), F.sum(F.greatest(F.coalesce(F.size("entries"), F.lit(0)), F.lit(0))).alias("entries"), F.sum(F.greatest(F.coalesce(inferred, F.lit(0)), F.lit(0))).alias("inferred"))


def glossary(entries: DataFrame) -> DataFrame:
    return entries.where("type = 'term'").select("name", "norm", "statement", "source")


def for_review(entries: DataFrame) -> DataFrame:
    return entries.where("basis = 'inferred'").select("source", "type", "name", "statement")


def empty_sources(items: DataFrame) -> DataFrame:
    return items.where("verdict = 'no_business_content'").select("source", squeeze(F.col("reason")).alias("reason"))


def catalogue_lines(entries: DataFrame) -> DataFrame:
    """(doc, seq, line) of the catalogue: a heading with a count for each type, then its entries by name."""
    counts = type_counts(entries)
    place = F.array_position(F.array(*map(F.lit, TYPES)), F.col("type"))
    heads = counts.select(F.lit("catalogue").alias("doc"), F.struct(F.col("type_no").alias("t"), F.lit("").alias("n"), F.lit("").alias("s")).alias("seq"), F.concat(F.lit("## "), "type", F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("line"))
    rows = entries.select(F.lit("catalogue").alias("doc"), F.struct(place.alias("t"), F.concat(F.lit(" "), quote_form(F.col("name"))).alias("n"), F.col("source").alias("s")).alias("seq"), F.concat(F.lit("- **"), "name", F.lit("**: "), "statement", F.lit(" ("), "source", F.lit(")")).alias("line"))
    return heads.unionByName(rows)


def disagreements(first: DataFrame, second: DataFrame) -> DataFrame:
    """(norm, statement_a, source_a, statement_b, source_b): the same name in both catalogues with different statements."""
    side = lambda df, s: df.select(quote_form(F.col("name")).alias("norm"), F.col("statement").alias(f"statement_{s}"), F.col("source").alias(f"source_{s}"))
    return side(first, "a").join(side(second, "b"), "norm").where(quote_form(F.col("statement_a")) != quote_form(F.col("statement_b")))


def disagreement_forms(first: DataFrame, second: DataFrame) -> DataFrame:
    """(norm, form, statement, n_first, n_second): the statements of names on which the two catalogues disagree.

    There is a row for each normalised form of a name's statements, with one statement that has it and the numbers of
    entries that say so in either catalogue.  Two entries of ``disagreements`` are any two of different rows of a name, one
    counted in the first and one in the second catalogue, so a name costs what it has of different statements.
    """
    side = lambda df, n: df.select(quote_form(F.col("name")).alias("norm"), quote_form(F.col("statement")).alias("form"), "statement", F.lit(n).alias("side"))
    both = side(first, 1).unionByName(side(second, 2)).where("form is not null")
    forms = both.groupBy("norm", "form").agg(F.min("statement").alias("statement"), F.count_if(F.col("side") == 1).alias("n_first"), F.count_if(F.col("side") == 2).alias("n_second"))
    names = forms.groupBy("norm").agg(F.count("*").alias("forms"), F.sum("n_first").alias("a"), F.sum("n_second").alias("b")).where("forms > 1 and a > 0 and b > 0")
    return forms.join(names.select("norm"), "norm", "left_semi")
