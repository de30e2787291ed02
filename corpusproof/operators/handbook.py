"""The cited handbook: outline, chapters cut into blocks, grounding of every block in the pages it cites, assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusproof.functions.text import bare_block, demoted_headings, is_exempt, mentions, page_citations, quote_form, secrets_in, specifics, squeeze, text_of, unescaped, word_count
from corpusproof.operators.checks import check, checks_of, none_left, union_all
from corpusproof.operators.entries import sample_checks
from corpusproof.sources.shared import checkpointed

MOST_PAGES, MOST_WORDS = 80, 40_000
LEAST_SAMPLE = 12
# fixed values: kinds of chapters and their sections
KINDS = ["team", "cross-team", "overview"]
TEAM_SECTIONS = [
    "1. Why this team exists",
    "2. People, roles and ownership",
    "3. What the team delivers",
    "4. Consumers and stakeholders",
    "5. Processes followed",
    "6. Platforms and tools",
    "7. Data and reporting",
    "8. Rules, policies and service levels",
    "9. History and decisions",
    "10. Gaps, contradictions and stale content",
    "Pages not used",
]
OVERVIEW_SECTIONS = [
    "1. Why it exists",
    "2. Teams and what each owns",
    "3. Consumers",
    "4. Processes followed",
    "5. Platforms and tools",
    "6. How work and data flow across teams",
    "7. Gaps, contradictions and stale content",
    "Pages not used",
]
SECTIONS = {"team": TEAM_SECTIONS, "cross-team": TEAM_SECTIONS, "overview": OVERVIEW_SECTIONS}
PLATFORM_SECTION = {"team": TEAM_SECTIONS[5], "cross-team": TEAM_SECTIONS[5], "overview": OVERVIEW_SECTIONS[4]}
UNUSED = "Pages not used"


def usable_pages(ledger: DataFrame, entry_ledger: DataFrame | None = None) -> DataFrame:
    """Verified pages with Markdown, with the verdict of their entries where that row is verified."""
    pages = ledger.where((F.col("status") == "verified") & (text_of(F.col("md_path")) != ""))
    if entry_ledger is None:
        return pages.withColumn("entry_verdict", F.lit(None).cast("string"))
    judged = entry_ledger.where("status = 'verified'").select("page_id", F.col("verdict").alias("entry_verdict"))
    return pages.join(judged, "page_id", "left")


def platform_mentions(pages: DataFrame, platforms: list[str]) -> DataFrame:
    """(page_id, platform) of pages whose text names a platform, case as given, not touching letters or digits.

    Every run of letters and digits in a name is a whole run in a text that has it, so names are indexed by their longest
    one.  A page's distinct runs are joined with that index, and only the names they bring up are looked for in its text:
    the work is one pass over the texts, however many names there are.
    """
    runs = lambda c: F.regexp_extract_all(c, F.lit("[A-Za-z0-9]+"), F.lit(0))
    longest = F.array_max(F.transform(runs(F.col("platform")), lambda r: F.struct(F.length(r).alias("n"), r.alias("run"))))["run"]
    names = pages.sparkSession.createDataFrame([(p,) for p in dict.fromkeys(platforms)], "platform string").withColumn("run", F.coalesce(longest, F.lit("")))
    found = pages.select("page_id", F.explode(F.array_distinct(F.concat(runs(unescaped(F.col("text"))), F.array(F.lit(""))))).alias("run"))  # a name may have no run
    candidates = found.join(names, "run").groupBy("page_id").agg(F.collect_set("platform").alias("_names"))
    plain = unescaped(F.col("text"))
    quoted = lambda n: F.concat(F.lit("(?<![A-Za-z0-9])\\Q"), F.replace(n, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E(?![A-Za-z0-9])"))
    return pages.join(candidates, "page_id").select("page_id", F.explode(F.filter("_names", lambda n: F.rlike(plain, quoted(n)))).alias("platform"))


# ---- outline ----


def outline_assignment(area_pages: DataFrame, pages: DataFrame) -> DataFrame:
    """(page_id, problem): assigned pages that are unknown, pages assigned more than once, and pages left over."""
    known = pages.select("page_id").distinct()
    strange = area_pages.select("page_id").distinct().join(known, "page_id", "left_anti").withColumn("problem", F.lit("unknown"))
    twice = area_pages.groupBy("page_id").agg(F.count("*").alias("n")).where("n > 1").select("page_id", F.lit("twice").alias("problem"))
    left = known.join(area_pages.select("page_id").distinct(), "page_id", "left_anti").withColumn("problem", F.lit("unassigned"))
    return union_all([strange, twice, left])


def area_sizes(area_pages: DataFrame, pages: DataFrame) -> DataFrame:
    """(area, n_pages, n_words) of ``pages(page_id, n_words)``."""
    return area_pages.join(pages.select("page_id", "n_words"), "page_id", "left").groupBy("area").agg(F.count("*").alias("n_pages"), F.coalesce(F.sum("n_words"), F.lit(0)).alias("n_words"))


def outline_checks(areas: DataFrame, area_pages: DataFrame, pages: DataFrame, platforms: list[str] | None) -> DataFrame:
    """O1 to O5 under the key "outline": shape, platform list, one overview, every page once, sizes within limits."""
    total = areas.agg(
        F.count("*").alias("n"),
        F.countDistinct("area").alias("ids"),
        F.count_if(~F.col("area").rlike("^[a-z0-9][a-z0-9-]*$")).alias("odd"),
        F.count_if(~F.col("kind").isin(KINDS)).alias("kinds"),
        F.count_if((F.col("kind") == "team") & (F.trim(text_of(F.col("team"))) == "")).alias("teams"),
        F.count_if(F.col("kind") == "overview").alias("overviews"),
    )
    loose = outline_assignment(area_pages, pages).agg(F.count("*").alias("loose"))
    large = area_sizes(area_pages, pages).join(areas.where("kind <> 'overview'").select("area"), "area", "left_semi").where((F.col("n_pages") > MOST_PAGES) | (F.col("n_words") > MOST_WORDS)).agg(F.count("*").alias("large"))
    both = total.crossJoin(F.broadcast(loose)).crossJoin(F.broadcast(large))  # one row each
    rows = [
        ("O1", (F.col("n") > 0) & (F.col("n") == F.col("ids")) & (F.col("odd") == 0) & (F.col("kinds") == 0) & (F.col("teams") == 0)),
        ("O2", F.lit(bool(platforms))),
        ("O3", F.col("overviews") == 1),
        ("O4", F.col("loose") == 0),
        ("O5", F.col("large") == 0),
    ]
    return both.select(F.lit("outline").alias("key"), F.explode(F.array(*(F.struct(F.lit(n).alias("check"), ok.alias("ok"), F.lit("").alias("detail")) for n, ok in rows))).alias("c")).select("key", "c.*")


def chapter_ledger(old: DataFrame, areas: DataFrame, sizes: DataFrame) -> DataFrame:
    """The ledger of chapters after an outline: known rows keep their state, counts are new, the overview is last, dropped areas are "removed"."""
    fresh = areas.select("area", "title", "kind", "team").join(sizes, "area", "left").withColumn("_new", F.lit(True))
    kept = [c for c in old.columns if c not in ("area", "title", "kind", "team", "n_pages", "n_words")]
    joined = old.select("area", *(F.col(c).alias(f"_{c}") for c in kept), F.lit(True).alias("_old")).join(fresh, "area", "full_outer")
    start = {"status": "pending", "attempts": "0"}
    state = [F.when(F.col("_new").isNull() & F.lit(c == "status"), "removed").otherwise(F.coalesce(F.col(f"_{c}"), F.lit(start.get(c, "")))).alias(c) for c in kept]
    order = F.when(F.col("_new").isNull(), 2).when(F.col("kind") == "overview", 1).otherwise(0)
    return joined.select("area", *(text_of(F.col(c)).alias(c) for c in ("title", "kind", "team")), *(F.coalesce(F.col(c), F.lit(0)).cast("string").alias(c) for c in ("n_pages", "n_words")), *state, order.alias("part"))


# ---- chapters ----


#: Lines of a document that are scanned together; what goes from one such chunk to the next is one small row.
CHUNK = 1000
_MARKS = ["", "```", "~~~"]


def _chunk(place: str) -> Column:
    return F.floor(F.col(place) / CHUNK).cast("long")


def _met(state: Column, mark: Column) -> Column:
    """The open fence after a fence line: a fence opens where none is open, and closes its own kind."""
    return F.when(state == "", mark).when(state == mark, F.lit("")).otherwise(state)


def outside_fenced_lines(lines: DataFrame, doc: str = "area") -> DataFrame:
    """(doc, line, text) of the lines outside fenced blocks, fences left out too.

    A fence of three or more back ticks or tildes opens a block, and the next fence of the same character closes it; other
    fences in between belong to the block.  A block that is not closed runs to the end.

    The scan is spread over a document's chunks of lines: the fences of a chunk make a map from the state before it to the
    state after it, the maps of a document are applied one after another, and each chunk is then read from its own state.
    """
    mark = F.regexp_extract("text", "^\\s*(```|~~~)", 1)
    rows = lines.select(doc, "line", "text", _chunk("line").alias("_c"), mark.alias("_mark"))
    fence = F.when(F.col("_mark") != "", F.struct(F.col("line").cast("long").alias("line"), F.col("_mark").alias("mark")))
    chunks = rows.groupBy(doc, "_c").agg(F.array_sort(F.collect_list(fence)).alias("f"))
    leads_to = F.array(*(F.aggregate("f", F.lit(m), lambda now, x: _met(now, x["mark"])) for m in _MARKS))
    maps = chunks.select(doc, F.struct(F.col("_c").alias("c"), leads_to.alias("to")).alias("m")).groupBy(doc).agg(F.array_sort(F.collect_list("m")).alias("maps"))
    after = lambda state, m: F.element_at(m["to"], F.array_position(F.array(*map(F.lit, _MARKS)), state).cast("int"))
    none = F.array().cast("array<string>")
    states = F.aggregate("maps", F.struct(F.lit("").alias("now"), none.alias("at")), lambda s, m: F.struct(after(s["now"], m).alias("now"), F.concat(s["at"], F.array(s["now"])).alias("at")))
    begun = maps.select(doc, F.explode(F.arrays_zip(F.transform("maps", lambda m: m["c"]).alias("c"), states["at"].alias("state"))).alias("s")).select(doc, F.col("s.c").alias("_c"), F.col("s.state").alias("_state"))

    spans = "array<struct<lo:bigint,hi:bigint>>"
    state = f"struct<mark:string,since:bigint,spans:{spans}>"
    first = F.struct(F.col("_state").alias("mark"), F.lit(-(2**62)).alias("since"), F.array().cast(spans).alias("spans")).cast(state)

    def met(now: Column, x: Column) -> Column:
        closed = F.struct(F.lit("").alias("mark"), F.lit(0).cast("long").alias("since"), F.concat(now["spans"], F.array(F.struct(now["since"].alias("lo"), x["line"].alias("hi")))).alias("spans")).cast(state)
        opened = F.struct(x["mark"].alias("mark"), x["line"].alias("since"), now["spans"].alias("spans")).cast(state)
        return F.when(now["mark"] == "", opened).when(now["mark"] == x["mark"], closed).otherwise(now)

    ends = chunks.join(begun, [doc, "_c"]).select(doc, "_c", F.aggregate("f", first, met).alias("e"))
    ends = ends.select(doc, "_c", F.when(F.col("e.mark") != "", F.concat("e.spans", F.array(F.struct(F.col("e.since").alias("lo"), F.lit(2**62).alias("hi"))))).otherwise(F.col("e.spans")).alias("_spans"))
    inside = F.exists("_spans", lambda s: F.col("line").between(s["lo"], s["hi"]))
    return rows.join(ends, [doc, "_c"]).where(~inside).select(doc, "line", "text")


def chapter_blocks(lines: DataFrame, doc: str = "area") -> DataFrame:
    """(area, section, subhead, block_no, block) from ``lines(area, line, text)``.

    A block ends at a blank line, a heading, a change between table and text, and before a list mark with fewer than two
    spaces.  Table separators, and the header row above one, and fenced lines are left out.  A section title that comes
    again goes on; sub-headings end with their section.

    Lines are read in chunks, and what a chunk leaves to the next ones (its last title, sub-heading and kind of line) is one
    row, so no task holds the lines of a long document.
    """
    chunk = Window.partitionBy(doc, "_c").orderBy("line")
    so_far = chunk.rowsBetween(Window.unboundedPreceding, 0)
    chunks = Window.partitionBy(doc).orderBy("_c")  # a row for each chunk
    earlier = chunks.rowsBetween(Window.unboundedPreceding, -1)
    rows = outside_fenced_lines(lines, doc)
    head, sub = F.col("text").rlike("^## +\\S"), F.col("text").rlike("^###+ +\\S")
    table = F.trim("text").startswith("|")
    line = F.col("text").rlike("^\\s*\\|?[\\s:|-]*-{3,}[\\s:|-]*$") & F.col("text").contains("|")
    blank = F.trim("text") == ""
    item = F.col("text").rlike("^ ?(?:[-*+]|\\d+[.)])\\s+")
    rows = rows.select(doc, "line", "text", _chunk("line").alias("_c"), head.alias("_h"), sub.alias("_u"), table.alias("_t"), line.alias("_sep"), blank.alias("_b"), item.alias("_i"))
    rows = rows.withColumns({"_title": F.when(F.col("_h"), F.trim(F.regexp_replace("text", "^## +", ""))), "_sub": F.when(F.col("_u"), F.trim(F.regexp_replace("text", "^#+ +", ""))).when(F.col("_h"), "")})
    last = lambda value, where: F.max_by(value, F.when(F.col(where).isNotNull(), F.col("line")))
    left = rows.groupBy(doc, "_c").agg(
        F.min_by("_sep", "line").alias("sep"), F.max_by("_t", "line").alias("t"), F.max_by(F.col("_b") | F.col("_h") | F.col("_u"), "line").alias("gap"),
        F.count_if("_h").alias("heads"), last("_title", "_title").alias("title"), last("_sub", "_sub").alias("sub"),
    )
    left = left.select(
        doc, "_c", F.lead("sep").over(chunks).alias("sep_then"), F.lag("t").over(chunks).alias("t_before"), F.lag("gap").over(chunks).alias("gap_before"),
        F.coalesce(F.sum("heads").over(earlier), F.lit(0)).alias("heads_before"), F.last("title", True).over(earlier).alias("title_before"), F.last("sub", True).over(earlier).alias("sub_before"),
    )
    rows = rows.join(left, [doc, "_c"])
    rows = rows.withColumns({"_under": F.coalesce(F.lead("_sep").over(chunk), "sep_then", F.lit(False)), "_was": F.coalesce(F.lag("_t").over(chunk), "t_before", F.lit(False)), "_gap": F.coalesce(F.lag(F.col("_b") | F.col("_h") | F.col("_u")).over(chunk), "gap_before", F.lit(True))})
    start = F.col("_gap") | F.col("_i") | (F.col("_was") != F.col("_t")) | F.col("_t")
    rows = rows.withColumns(
        {
            "section": F.coalesce(F.last("_title", True).over(so_far), "title_before"),
            "subhead": F.coalesce(F.last("_sub", True).over(so_far), "sub_before", F.lit("")),
            "_sec": F.sum(F.col("_h").cast("int")).over(so_far) + F.col("heads_before"),
            "_begun": F.when(start, F.col("line")),
        }
    )
    # a block has the number of the line that begins it
    begun = rows.groupBy(doc, "_c").agg(F.max("_begun").alias("begun")).select(doc, "_c", F.last("begun", True).over(earlier).alias("begun_before"))
    rows = rows.withColumn("_blk", F.last("_begun", True).over(so_far)).join(begun, [doc, "_c"]).withColumn("_blk", F.coalesce("_blk", "begun_before"))
    body = rows.where(~F.col("_h") & ~F.col("_u") & ~F.col("_b") & ~F.col("_sep") & ~(F.col("_t") & F.col("_under")) & F.col("section").isNotNull())
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), "\n")
    blocks = body.groupBy(doc, "section", "_sec", "_blk").agg(F.first("subhead").alias("subhead"), F.min("line").alias("line"), text.alias("block")).withColumn("_c", _chunk("line"))
    counts = blocks.groupBy(doc, "_c").count().select(doc, "_c", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("blocks_before"))
    numbered = blocks.join(counts, [doc, "_c"]).withColumn("block_no", (F.row_number().over(chunk) + F.col("blocks_before")).cast("int"))
    return numbered.select(doc, "section", "subhead", "block_no", "block")


def block_citations(blocks: DataFrame) -> DataFrame:
    """(area, section, block_no, page_id) of the pages that blocks cite."""
    return blocks.select("area", "section", "block_no", F.explode(F.array_distinct(page_citations(F.col("block")))).alias("page_id"))


def uncited_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks outside "Pages not used" that cite nothing and are not exempt."""
    return blocks.where((F.col("section") != UNUSED) & ~is_exempt(F.col("block")) & (F.size(page_citations(F.col("block"))) == 0))


def page_forms(pages: DataFrame) -> DataFrame:
    """(page_id, form, numbers): each page's text prepared once for all blocks that cite it."""
    from corpusproof.functions.text import numbers_in

    plain = unescaped(F.col("text"))
    return pages.select("page_id", quote_form(plain).alias("form"), F.col("text").alias("plain"), numbers_in(plain).alias("numbers"))


def ungrounded(blocks: DataFrame, pages: DataFrame, by: list[str] = ("area", "block_no")) -> DataFrame:
    """(by, kind, value): numbers, acronyms, names and quotes of blocks that no page they cite has.

    ``pages(page_id, text)``.  Blocks without citations have none of their own to fail here.
    """
    by = list(by)
    told = blocks.select(*by, F.array_distinct(page_citations(F.col("block"))).alias("cites"), specifics(F.col("block")).alias("s")).where(F.size("cites") > 0)

    def of_kind(kind: str) -> Column:
        return F.transform(F.col(f"s.{kind}"), lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    kinds = F.flatten(F.array(*map(of_kind, ("numbers", "acronyms", "names", "quotes"))))
    claims = told.select(*by, "cites", F.explode(kinds).alias("c")).select(*by, "cites", "c.kind", "c.value")
    pairs = claims.select(*by, "kind", "value", F.explode("cites").alias("page_id")).join(page_forms(pages), "page_id", "left")
    in_page = F.when(F.col("kind") == "numbers", F.array_contains("numbers", F.col("value"))).when(F.col("kind") == "quotes", F.col("form").contains(quote_form(F.col("value")))).otherwise(F.col("form").contains(F.lower("value")) | F.col("form").contains(quote_form(F.col("value"))))
    return pairs.groupBy(*by, "kind", "value").agg(F.bool_or(F.coalesce(in_page, F.lit(False))).alias("found")).where("not found").drop("found")


def unused_pages(blocks: DataFrame) -> DataFrame:
    """(area, page_id, reason) listed under "Pages not used"."""
    rows = blocks.where(F.col("section") == UNUSED).select("area", F.explode(page_citations(F.col("block"))).alias("page_id"), squeeze(F.regexp_replace(bare_block(F.col("block")), "\\[p:[A-Za-z0-9_-]+\\]", " ")).alias("reason"))
    return rows


def unaccounted_pages(area_pages: DataFrame, blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """(area, page_id, problem) of assigned pages neither cited, listed with a reason of three words, nor judged empty; and contradictions."""
    cited = block_citations(blocks.where(F.col("section") != UNUSED)).select("area", "page_id").distinct().withColumn("cited", F.lit(True))
    listed = unused_pages(blocks).groupBy("area", "page_id").agg(F.max(word_count(F.col("reason"))).alias("words"))
    joined = area_pages.join(cited, ["area", "page_id"], "left").join(listed, ["area", "page_id"], "left").join(pages.select("page_id", "entry_verdict"), "page_id", "left")
    problem = (
        F.when(F.col("cited").isNotNull(), None)
        .when(F.col("words").isNotNull() & (F.col("entry_verdict") == "extracted"), "unused but has facts")
        .when(F.col("words") >= 3, None)
        .when(F.col("words").isNotNull(), "no reason")
        .when(F.col("entry_verdict") == "no_business_content", None)
        .otherwise("not used")
    )
    return joined.select("area", "page_id", problem.alias("problem")).where("problem is not null")


def platform_problems(areas: DataFrame, blocks: DataFrame, area_pages: DataFrame, pages: DataFrame, platforms: list[str]) -> DataFrame:
    """(area, platform, problem): each platform is named in the platform section; where a page in scope has it, a block that names it cites such a page."""
    spark = areas.sparkSession
    names = spark.createDataFrame([(p,) for p in platforms], "platform string")
    section = F.create_map(*(x for k, v in PLATFORM_SECTION.items() for x in (F.lit(k), F.lit(v))))
    own = blocks.join(areas.select("area", "kind"), "area").where(F.col("section") == F.try_element_at(section, F.col("kind")))
    hit = F.array_compact(F.array(*(F.when(mentions(F.concat_ws("\n", "subhead", "block"), p), F.lit(p)) for p in platforms)))
    naming = own.select("area", "block", F.explode(hit).alias("platform"))
    named = naming.select("area", "platform").distinct().withColumn("named", F.lit(True))
    found = platform_mentions(pages, platforms)
    scope = area_pages.join(areas.select("area", "kind"), "area")
    in_team = scope.where("kind <> 'overview'").select("area", "page_id").join(found, "page_id")
    in_all = areas.where("kind = 'overview'").select("area").crossJoin(F.broadcast(found.select("platform").distinct()))  # one overview, as many rows as platforms
    due = in_team.select("area", "platform").union(in_all.select("area", "platform")).distinct().withColumn("due", F.lit(True))
    cites = naming.select("area", "platform", F.explode(page_citations(F.col("block"))).alias("page_id"))
    backed = cites.join(found, ["page_id", "platform"]).select("area", "platform").distinct().withColumn("backed", F.lit(True))
    rows = areas.select("area").crossJoin(F.broadcast(names)).join(named, ["area", "platform"], "left").join(due, ["area", "platform"], "left").join(backed, ["area", "platform"], "left")
    problem = F.when(F.col("named").isNull(), "not named").when(F.col("due") & F.col("backed").isNull(), "named without a page that has it")
    return rows.select("area", "platform", problem.alias("problem")).where("problem is not null")


def chapter_depth(blocks: DataFrame, area_pages: DataFrame, pages: DataFrame) -> DataFrame:
    """(area, written, floor): words written, and the least: 6 % of the words of assigned pages that are cited, 5000 at most."""
    wrote = blocks.groupBy("area").agg(F.sum(word_count(F.col("block"))).alias("written"))
    cited = block_citations(blocks.where(F.col("section") != UNUSED)).select("area", "page_id").distinct()
    source = area_pages.join(cited, ["area", "page_id"]).join(pages.select("page_id", "n_words"), "page_id").groupBy("area").agg(F.sum("n_words").alias("n"))
    floor = F.least(F.lit(5000), F.floor(F.lit(0.06) * F.coalesce("n", F.lit(0))).cast("int"))
    return wrote.join(source, "area", "left").select("area", "written", floor.alias("floor"))


def chapter_checks(areas: DataFrame, chapters: DataFrame, area_pages: DataFrame, pages: DataFrame, platforms: list[str], samples: DataFrame | None = None, modified: DataFrame | None = None) -> DataFrame:
    """H1 to H9 of ``chapters(area, text)``.  ``pages(page_id, text, n_words, entry_verdict)`` are the usable pages."""
    lines = chapters.select("area", F.posexplode(F.split("text", "\\n")).alias("line", "text"))
    blocks = checkpointed(chapter_blocks(lines))  # every check reads them
    keys = areas.select("area")
    need = F.create_map(*(x for k, v in SECTIONS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    wanted = areas.select("area", F.explode(F.try_element_at(need, F.col("kind"))).alias("section"))
    absent = wanted.join(blocks.select("area", "section").distinct(), ["area", "section"], "left_anti")
    untitled = areas.join(chapters, "area", "left").where(~F.coalesce(text_of(F.col("text")).rlike("(?m)^Area:\\s*\\S"), F.lit(False))).select("area", F.lit("Area: line").alias("section"))
    h1 = none_left(keys, absent.union(untitled.select("area", "section")), "area", "H1", "section")
    h2 = none_left(keys, uncited_blocks(blocks).select("area", F.substring("block", 1, 60).alias("block")), "area", "H2", "block")
    h3 = none_left(keys, block_citations(blocks).join(pages.select("page_id"), "page_id", "left_anti"), "area", "H3", "page_id")
    h4 = none_left(keys, ungrounded(blocks.where(F.col("section") != UNUSED), pages), "area", "H4", "value")
    h5 = none_left(keys, unaccounted_pages(area_pages, blocks, pages).withColumn("what", F.concat_ws(" ", "page_id", "problem")), "area", "H5", "what")
    h6 = none_left(keys, platform_problems(areas, blocks, area_pages, pages, platforms).withColumn("what", F.concat_ws(" ", "platform", "problem")), "area", "H6", "what")
    depth = keys.join(chapter_depth(blocks, area_pages, pages), "area", "left")
    h7 = check(depth, "area", "H7", F.coalesce("written", F.lit(0)) >= F.coalesce("floor", F.lit(0)), F.concat(F.coalesce("written", F.lit(0)).cast("string"), F.lit(" words, at least "), F.col("floor").cast("string")))
    found = secrets_in(F.col("text"))
    h8 = checks_of(keys.join(chapters, "area", "left"), "area", {"H8": (F.size(found) == 0, F.array_join(found, ", "))})
    parts = [h1, h2, h3, h4, h5, h6, h7, h8]
    if samples is not None:
        sizes = blocks.where(~is_exempt(F.col("block"))).groupBy(F.col("area").alias("key")).agg(F.count("*").alias("n"))
        known = blocks.select(F.col("area").alias("key"), F.col("block").alias("name"))
        parts.append(sample_checks(samples, known, sizes, "H9", LEAST_SAMPLE, modified))
    return union_all(parts)


def ready_chapters(ledger: DataFrame) -> DataFrame:
    """Rows to check: the overview waits while any other chapter is pending, done or failed."""
    open_rows = ledger.where((F.col("kind") != "overview") & F.col("status").isin("pending", "done", "failed")).agg(F.count("*").alias("_open"))
    return ledger.crossJoin(F.broadcast(open_rows)).where((F.col("kind") != "overview") | (F.col("_open") == 0)).drop("_open")  # one row


# ---- assembly ----


def citing_chapters(blocks: DataFrame) -> DataFrame:
    """(page_id, chapters): how many chapters cite each page."""
    return block_citations(blocks.where(F.col("section") != UNUSED)).groupBy("page_id").agg(F.countDistinct("area").alias("chapters"))


def book_coverage(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """(page_id, state): cited, listed, judged_empty or untouched, in this order of precedence."""
    cited = citing_chapters(blocks).select("page_id", F.lit(True).alias("cited"))
    listed = unused_pages(blocks).select("page_id").distinct().withColumn("listed", F.lit(True))
    joined = pages.join(cited, "page_id", "left").join(listed, "page_id", "left")
    return joined.select("page_id", F.when(F.col("cited"), "cited").when(F.col("listed"), "listed").when(F.col("entry_verdict") == "no_business_content", "judged_empty").otherwise("untouched").alias("state"))


def contents_lines(areas: DataFrame) -> DataFrame:
    """(seq, line) of the contents; a team's name stands above its first chapter only.  ``areas(area, title, team, seq)``."""
    # chapters lie in ranges of their order, and the last team of a range is handed to the next
    ranged = checkpointed(areas.repartitionByRange("seq").withColumn("_range", F.spark_partition_id()))
    handed = F.lag("team").over(Window.orderBy("_range"))
    ends = ranged.groupBy("_range").agg(F.max_by(F.struct("team"), "seq")["team"].alias("team")).select("_range", handed.alias("_handed"))  # a row for each range
    order = Window.partitionBy("_range").orderBy("seq")
    before = F.when(F.row_number().over(order) == 1, F.col("_handed")).otherwise(F.lag("team").over(order))
    rows = ranged.join(ends, "_range").withColumn("_before", before).withColumn("_new", (F.trim(text_of(F.col("team"))) != "") & ~F.coalesce(F.col("_before") == F.col("team"), F.lit(False)))
    lines = F.when(F.col("_new"), F.array(F.concat(F.lit("**"), "team", F.lit("**")), F.concat(F.lit("- "), "title"))).otherwise(F.array(F.concat(F.lit("- "), "title")))
    return rows.select(F.struct("seq", F.lit(0).alias("k")).alias("seq"), F.posexplode(lines).alias("k", "line")).select(F.struct(F.col("seq.seq").alias("seq"), "k").alias("seq"), "line")


def chapter_lines(chapters: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc, seq, line) of chapters for the book: citations become links, headings go down a level, ``Area:`` lines go."""
    lines = chapters.select(F.col("area").alias("doc"), F.posexplode(F.split("text", "\\n")).alias("seq", "line")).where(~F.col("line").rlike("^Area:"))
    cited = lines.select("doc", "seq", F.explode(F.array_distinct(page_citations(F.col("line")))).alias("page_id")).join(pages.select("page_id", "title", "md_name"), "page_id", "left")
    swaps = cited.groupBy("doc", "seq").agg(F.array_sort(F.collect_list(F.struct("page_id", F.concat(F.lit("["), F.coalesce("title", F.col("page_id")), F.lit("]("), F.coalesce("md_name", F.lit("")), F.lit(")")).alias("link")))).alias("swaps"))
    none = F.array().cast("array<struct<page_id:string,link:string>>")
    linked = F.aggregate(F.coalesce("swaps", none), F.col("line"), lambda text, x: F.replace(text, F.concat(F.lit("[p:"), x["page_id"], F.lit("]")), x["link"]))
    return lines.join(swaps, ["doc", "seq"], "left").select("doc", "seq", demoted_headings(linked).alias("line"))


def chapter_facts(area_pages: DataFrame, entries: DataFrame) -> DataFrame:
    """Entries of the catalogue by chapter, through the pages assigned to it."""
    return area_pages.join(entries.withColumnRenamed("source", "page_id"), "page_id")


def source_index(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """(page_id, title, chapters) by title."""
    return pages.select("page_id", "title").join(citing_chapters(blocks), "page_id", "left").withColumn("chapters", F.coalesce("chapters", F.lit(0))).orderBy(F.lower("title"), "page_id")
