"""Linking repositories: identifiers, mentions, triggers, reviewed links and the graph made of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusproof.functions.text import field_citation, node_id, text_of, token_parts, word_count
from corpusproof.operators.checks import check, left_out, none_left_each, union_all
from corpusproof.operators.repos import suffix_of, unresolved_citations
from corpusproof.sources.shared import checkpointed
from corpusproof.sources.tables import walk_order

SHORTEST = 5
LONGEST_LINE = 2000
MOST_HITS = 300
SAMPLES = 3
# fixed values: identifiers too generic to search for
GENERIC = [
    "common", "utils", "util", "core", "shared", "tools", "infra", "config", "configs", "docs", "tests", "test", "scripts", "service", "services",
    "server", "client", "library", "base", "main", "master", "internal", "public", "private", "platform", "backend", "frontend", "deploy", "pipeline",
    "pipelines", "terraform", "ansible", "docker", "python", "example", "examples", "sample", "template", "templates", "default", "admin", "users",
    "data", "models", "model", "events", "event", "status", "health",
]
# fixed values: (label, crosses repositories, pattern) of trigger lines, the first that fits counts
TRIGGERS = [
    ("gha_workflow_run", True, "^\\s*workflow_run\\s*:"),
    ("gha_repository_dispatch", True, "repository_dispatch|/dispatches\\b|createDispatchEvent|createWorkflowDispatch"),
    ("gha_workflow_call", True, "^\\s*workflow_call\\s*:"),
    ("gha_uses_remote_workflow", True, "uses:\\s*[\\w.-]+/[\\w.-]+/\\.github/workflows/"),
    ("gha_workflow_dispatch", False, "^\\s*workflow_dispatch\\s*:?"),
    ("gha_schedule", False, "^\\s*-?\\s*cron:\\s*['\"]"),
    ("jenkins_build_job", True, "\\bbuild\\s*\\(?\\s*job\\s*:"),
    ("jenkins_upstream", True, "\\bupstream\\s*\\(|upstreamProjects"),
    ("jenkins_cron", False, "\\b(cron|pollSCM)\\s*\\(?\\s*['\"]"),
    ("gitlab_trigger", True, "^\\s*trigger\\s*:|\\bproject:\\s*[\\w.-]+/[\\w.-]+"),
    ("azure_pipeline_resource", True, "^\\s*-\\s*pipeline\\s*:|^\\s*-\\s*repository\\s*:"),
    ("airflow_trigger_dag", True, "TriggerDagRunOperator|ExternalTaskSensor|ExternalTaskMarker"),
    ("airflow_schedule", False, "schedule(_interval)?\\s*="),
    ("aws_event_rule", True, "aws_cloudwatch_event_(rule|target)|aws_scheduler_schedule|AWS::Events::Rule|EventBridge"),
    ("aws_s3_notification", True, "aws_s3_bucket_notification|NotificationConfiguration|s3:ObjectCreated"),
    ("aws_event_source_mapping", True, "aws_lambda_event_source_mapping|EventSourceMapping"),
    ("aws_sns_sqs_subscription", True, "aws_sns_topic_subscription|AWS::SNS::Subscription"),
    ("gcp_trigger", True, "google_cloudbuild_trigger|google_cloud_scheduler_job|google_pubsub_subscription|google_eventarc_trigger"),
    ("azure_trigger", True, "azurerm_eventgrid|azurerm_data_factory_trigger|\"type\"\\s*:\\s*\"(ScheduleTrigger|BlobEventsTrigger|TumblingWindowTrigger)\""),
    ("webhook", True, "(?i)\\bwebhook"),
    ("k8s_cron", False, "^\\s*schedule:\\s*['\"]?[\\d*/,-]+\\s"),
    ("kafka_consumer", True, "@KafkaListener|KafkaConsumer\\(|\\.subscribe\\(\\s*\\[?['\"]"),
]
# fixed values: suffixes of files that can hold triggers
TRIGGER_SUFFIXES = ["yml", "yaml", "groovy", "py", "tf", "json", "sh", "java", "kt", "ts", "js", "go", "cs", ""]
RESOLUTIONS = ["internal", "external", "unresolved"]
# fixed values: kinds of edges
EDGE_KINDS = ["imports", "calls_api", "triggers", "triggered_by", "reads_data", "writes_data", "uses_image", "uses_workflow", "deploys", "config", "submodule", "publishes_to", "subscribes_to", "other"]
CONFIDENCE = ["high", "medium", "low"]


def trigger_of(path: Column, text: Column) -> Column:
    """(label, cross) of the first trigger pattern that a line fits; null for other suffixes and long lines."""
    tests = [F.when(text.rlike(pattern), F.struct(F.lit(label).alias("label"), F.lit(cross).alias("cross"))) for label, cross, pattern in TRIGGERS]
    return F.when(suffix_of(path).isin(TRIGGER_SUFFIXES) & (F.length(text) <= LONGEST_LINE), F.coalesce(*tests))


def trigger_hits(lines: DataFrame, most: int | None = MOST_HITS) -> DataFrame:
    """(repo, path, line, label, cross, text): the first ``most`` trigger lines of each repository in walk order; None gives all."""
    hits = lines.withColumn("_t", trigger_of(F.col("path"), F.col("text"))).where("_t is not null").select("repo", "path", "line", "_t.label", "_t.cross", F.substring("text", 1, 200).alias("text"))
    if most is None:
        return hits
    return hits.withColumn("_k", F.row_number().over(Window.partitionBy("repo").orderBy(walk_order(F.col("path")), "line"))).where(F.col("_k") <= most).drop("_k")


def identifiers(facts: DataFrame, repos: DataFrame) -> DataFrame:
    """(identifier, target, kind): repository names, their last parts, and what facts say is produced, lower-cased."""
    whole = repos.select(F.lower("repo").alias("identifier"), F.col("repo").alias("target"), F.lit("repo").alias("kind"))
    last = repos.where(F.col("repo").contains("/")).select(F.lower(F.substring_index("repo", "/", -1)).alias("identifier"), F.col("repo").alias("target"), F.lit("repo").alias("kind"))
    made = facts.select("repo", F.explode("produces").alias("p")).select(F.lower(F.regexp_replace(F.trim("p.id"), "^/+|/+$", "")).alias("identifier"), F.col("repo").alias("target"), F.col("p.kind").alias("kind"))
    return union_all([whole, last, made]).where("identifier <> ''").distinct()


def searchable(ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(identifiers to search for, those left out with their reason)."""
    reason = F.when(F.length("identifier") < SHORTEST, f"shorter than {SHORTEST}").when(F.col("identifier").isin(GENERIC), "generic")
    judged = ids.withColumn("reason", reason)
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null").select("identifier", "target", "reason")


def producers_of(used: DataFrame, made: DataFrame) -> DataFrame:
    """(repo, kind, id, producers) of everything in ``used(repo, kind, id)``: who else makes it in ``made(repo, kind, id)``, ids compared without case."""
    makers = made.select(F.col("repo").alias("producer"), F.lower("id").alias("_id"), F.col("kind").alias("made_kind"))
    found = used.withColumn("_id", F.lower("id")).join(makers, "_id").where("producer <> repo").groupBy("repo", "kind", "id").agg(F.sort_array(F.collect_set(F.struct("producer", "made_kind"))).alias("producers"))
    return used.distinct().join(found, ["repo", "kind", "id"], "left").withColumn("producers", F.coalesce("producers", F.array().cast("array<struct<producer:string,made_kind:string>>")))


def producers(facts: DataFrame) -> DataFrame:
    """``producers_of`` what the facts say is consumed and produced."""
    return producers_of(*(facts.select("repo", F.explode(side).alias("x")).select("repo", "x.kind", "x.id") for side in ("consumes", "produces")))


def mention_rows(lines: DataFrame, ids: DataFrame, longest: int | None = LONGEST_LINE) -> DataFrame:
    """(repo, target, identifier, path, line): lines of a repository with a token that names another one.

    Lines beyond ``longest`` characters are passed over; None takes all.  Tokens that are no identifier end in the join,
    which needs no shuffle of the lines where the identifiers are few (Spark decides by their size).
    """
    short = lines.where(F.length("text") <= longest) if longest else lines
    tokens = short.select("repo", "path", "line", F.explode(token_parts(F.col("text"))).alias("identifier"))
    return tokens.join(ids.select("identifier", "target").distinct(), "identifier").where("target <> repo").select("repo", "target", "identifier", "path", "line")


BY = ["repo", "target", "identifier"]


def mention_counts(rows: DataFrame) -> DataFrame:
    """(repo, target, identifier, n) of ``mention_rows``."""
    return rows.groupBy(*BY).agg(F.count("*").alias("n"))


def mention_samples(rows: DataFrame, lines: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(repo, target, identifier, samples): the first few of ``mention_rows`` in walk order, with their text.

    Ranks are limited in each task before rows meet, so an identifier on every line of a repository is no hot group; only
    lines that are shown have their text looked up.
    """
    order = Window.partitionBy(*BY).orderBy(walk_order(F.col("path")), "line")
    first = rows.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= samples)
    shown = first.join(lines.select("repo", "path", "line", F.substring("text", 1, 200).alias("text")), ["repo", "path", "line"])
    ranked = F.array_sort(F.collect_list(F.struct("_k", "path", "line", "text")))
    return shown.groupBy(*BY).agg(F.transform(ranked, lambda x: F.struct(x["path"].alias("path"), x["line"].alias("line"), x["text"].alias("text"))).alias("samples"))


def mentions(lines: DataFrame, ids: DataFrame, samples: int = SAMPLES, longest: int | None = LONGEST_LINE) -> DataFrame:
    """(repo, target, identifier, n, samples): how many lines mention it, and the first few in walk order."""
    rows = checkpointed(mention_rows(lines, ids, longest))
    return mention_counts(rows).join(mention_samples(rows, lines, samples), BY)


def candidate_totals(repos: DataFrame, facts: DataFrame, mention_table: DataFrame, hits: DataFrame) -> DataFrame:
    """(repo, n_consumes, n_mentions, n_trigger_hits, n_cross_trigger_hits) of every repository."""
    used = facts.select("repo", F.greatest(F.size("consumes"), F.lit(0)).alias("n_consumes"))
    named = mention_table.groupBy("repo").agg(F.count("*").alias("n_mentions"))
    hit = hits.groupBy("repo").agg(F.count("*").alias("n_trigger_hits"), F.count_if("cross").alias("n_cross_trigger_hits"))
    return repos.select("repo").join(used, "repo", "left").join(named, "repo", "left").join(hit, "repo", "left").na.fill(0)


# ---- checks of reviewed links ----


def link_problems(links: DataFrame, repos: DataFrame) -> DataFrame:
    """(repo, problems) of every repository, from ``links(repo, consumes, edges, mentions_reviewed, pipelines, trigger_hits_dismissed)``.

    A repository without links has that as its only problem; links of an unknown repository are passed over.
    """
    none = F.array().cast("array<string>")
    said = lambda rows, test, text: F.coalesce(F.transform(F.filter(rows, test), text), none)
    problems = F.concat(
        said("consumes", lambda c: ~text_of(c["resolution"]).isin(RESOLUTIONS), lambda c: F.concat(F.lit("resolution of "), text_of(c["id"]))),
        said("consumes", lambda c: (c["resolution"] != "internal") & (word_count(c["note"]) < 4), lambda c: F.concat(F.lit("note of "), text_of(c["id"]), F.lit(" is too short"))),
        said("edges", lambda e: ~text_of(e["kind"]).isin(EDGE_KINDS), lambda e: F.concat(F.lit("edge kind "), text_of(e["kind"]))),
        said("edges", lambda e: ~text_of(e["confidence"]).isin(CONFIDENCE), lambda e: F.concat(F.lit("confidence "), text_of(e["confidence"]))),
        said("mentions_reviewed", lambda m: ~F.coalesce(m["is_edge"], F.lit(False)) & (word_count(m["reason"]) < 3), lambda m: F.concat(F.lit("reason for "), text_of(m["identifier"]), F.lit(" is too short"))),
        said("pipelines", lambda p: (F.size(F.coalesce(p["triggers"], F.array())) <= 0) & (word_count(p["searched"]) < 4), lambda p: F.concat(F.lit("pipeline "), text_of(p["name"]), F.lit(": no trigger"))),
        said("trigger_hits_dismissed", lambda t: t["line"].isNull(), lambda t: F.concat(F.lit("dismissed line in "), text_of(t["path"]))),
    )
    every = repos.select("repo").join(links.withColumn("_there", F.lit(True)), "repo", "left")
    shape = every.select("repo", F.when(F.col("_there").isNull(), F.array(F.lit("links are absent"))).otherwise(problems).alias("problems"))
    targets = links.select("repo", F.explode(F.concat(F.coalesce(F.transform(F.filter("consumes", lambda c: c["resolution"] == "internal"), lambda c: c["to_repo"]), none), F.coalesce(F.transform("edges", lambda e: e["to_repo"]), none))).alias("target"))
    pairs = targets.distinct()
    # a target that most links name is compared once
    unknown = pairs.select("target").distinct().join(repos.select(F.col("repo").alias("target")), "target", "left_anti").select(F.col("target").alias("_unknown"))
    named = pairs.join(unknown, F.col("target").eqNullSafe(F.col("_unknown"))).select("repo", "target").union(pairs.where("target = repo"))
    strange = named.groupBy("repo").agg(F.sort_array(F.collect_set(F.concat(F.lit("target "), text_of(F.col("target"))))).alias("more"))
    return shape.join(strange, "repo", "left").select("repo", F.concat("problems", F.coalesce("more", none)).alias("problems"))


def link_targets(links: DataFrame) -> DataFrame:
    """(repo, target): of edges and internal consumes."""
    edges = links.select("repo", F.explode("edges").alias("e")).select("repo", F.col("e.to_repo").alias("target"))
    inner = links.select("repo", F.explode("consumes").alias("c")).where("c.resolution = 'internal'").select("repo", F.col("c.to_repo").alias("target"))
    return edges.union(inner).distinct()


def link_checks(links: DataFrame, facts: DataFrame, repos: DataFrame, mention_table: DataFrame, hits: DataFrame, stats: DataFrame) -> DataFrame:
    """L1 to L7; L2 to L7 only for repositories that pass L1.

    What L2, L3, L4 and L7 want and have are rows of one grouping by repository, read from links and facts in one pass each.
    """
    problems = checkpointed(link_problems(links, repos))  # short rows that take long to find
    shape = check(problems, "repo", "L1", F.size("problems") == 0, F.array_join("problems", "; "))
    fine = problems.where(F.size("problems") == 0).select("repo").distinct()
    used = lambda c: (c["kind"], F.lower(c["id"]))
    name = lambda p: (F.lit(""), p["name"])
    internal = F.filter("consumes", lambda c: c["resolution"] == "internal")
    wanted = union_all(
        [
            facts.select("repo", F.explode(F.concat(_items("L2", "consumes", used), _items("L4", "pipelines", name))).alias("x")),
            links.select("repo", F.explode(_items("L7", F.filter("mentions_reviewed", lambda m: m["is_edge"]), lambda m: (F.lit(""), m["target_repo"]))).alias("x")),
            mention_table.select("repo", _item("L3", F.col("target"), F.lower("identifier")).alias("x")),
        ]
    )
    have = F.concat(
        _items("L2", "consumes", used),
        _items("L3", "mentions_reviewed", lambda m: (m["target_repo"], F.lower(m["identifier"]))),
        _items("L4", "pipelines", name),
        _items("L7", "edges", lambda e: (F.lit(""), e["to_repo"])),
        _items("L7", internal, lambda c: (F.lit(""), c["to_repo"])),
    )
    lost = left_out(wanted.select("repo", "x.*"), links.select("repo", F.explode(have).alias("x")).select("repo", "x.*"), ["repo", "check", "of", "item"])
    cites = all_citations(links)
    dismissed = links.select("repo", F.explode("trigger_hits_dismissed").alias("t")).select("repo", F.col("t.path").alias("path"), F.col("t.line").cast("long").alias("line"))
    # a repository's own short ranges need no shuffle; others close what these leave open
    closed = cites.where("cited_repo = repo and hi >= lo and hi - lo < 1000").select("repo", "path", F.explode(F.sequence("lo", "hi")).alias("line"))
    open_hits = left_out(hits.where("cross").select("repo", "path", F.col("line").cast("long").alias("line")), closed.unionByName(dismissed), ["repo", "path", "line"])
    others = checkpointed(cites.where("cited_repo <> repo or hi - lo >= 1000").join(fine, "repo"))
    open_hits = uncited_lines(open_hits, others)
    unresolved_cites = unresolved_citations(cites.select(F.col("cited_repo").alias("repo"), "path", "lo", "hi", F.col("repo").alias("citing")), stats)
    place = lambda line: F.concat_ws(":", "path", F.col(line).cast("string")).alias("detail")
    bad = union_all(
        [
            lost.select("repo", "check", F.col("item").alias("detail"), "n"),
            open_hits.select("repo", F.lit("L5").alias("check"), place("line"), "n"),
            unresolved_cites.select(F.col("citing").alias("repo"), F.lit("L6").alias("check"), place("lo"), F.lit(1).cast("long").alias("n")),
        ]
    )
    return shape.unionByName(none_left_each(fine, bad, "repo", ["L2", "L3", "L4", "L5", "L6", "L7"]))


def _item(check: str, of: Column, item: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), of.cast("string").alias("of"), item.cast("string").alias("item"))


def _items(check: str, rows: Column | str, parts: Callable[[Column], tuple[Column, Column]]) -> Column:
    """An array of (check, of, item); a null array has none."""
    return F.coalesce(F.transform(rows, lambda x: _item(check, *parts(x))), F.array().cast("array<struct<check:string,of:string,item:string>>"))


def all_citations(links: DataFrame) -> DataFrame:
    """(repo, cited_repo, path, lo, hi) of every evidence field of the links; a citation without a repository is its own."""
    none = F.array().cast("array<string>")
    fields = F.concat(
        F.coalesce(F.flatten(F.transform("consumes", lambda c: F.array(c["evidence_from"], c["evidence_to"]))), none),
        F.coalesce(F.flatten(F.transform("edges", lambda e: F.array(e["evidence_from"], e["evidence_to"]))), none),
        F.coalesce(F.flatten(F.transform("pipelines", lambda p: F.transform(p["triggers"], lambda t: t["evidence"]))), none),
    )
    values = links.select("repo", F.explode(fields).alias("v")).where(F.trim(text_of(F.col("v"))) != "").distinct()
    rows = values.select("repo", "v", F.explode(F.array(field_citation(F.col("v")))).alias("c"))  # parsed once, whatever is asked of its fields
    return rows.select("repo", F.coalesce("c.repo", "repo").alias("cited_repo"), F.coalesce("c.path", "v").alias("path"), F.coalesce("c.start", F.lit(0)).alias("lo"), F.coalesce("c.end", F.lit(0)).alias("hi")).distinct()


def uncited_lines(lines: DataFrame, cites: DataFrame) -> DataFrame:
    """Rows of ``lines(repo, path, line)`` inside no range of ``cites(cited_repo, path, lo, hi)``.

    Ranges are short, so they are spread into their lines and the join is on equal lines; ranges of over 1000 lines are
    compared as ranges within their file.
    """
    own = cites.select(F.col("cited_repo").alias("repo"), "path", "lo", "hi").where("hi >= lo")
    spread = own.where("hi - lo < 1000").select("repo", "path", F.explode(F.sequence("lo", "hi")).alias("line")).distinct()
    left = lines.join(spread, ["repo", "path", "line"], "left_anti")
    wide = own.where("hi - lo >= 1000").select(F.col("repo").alias("_r"), F.col("path").alias("_p"), "lo", "hi")
    return left.join(wide, (left["repo"] == wide["_r"]) & (left["path"] == wide["_p"]) & left["line"].between(wide["lo"], wide["hi"]), "left_anti")


# ---- the graph ----


def graph_edges(links: DataFrame) -> DataFrame:
    """Edges, one for each (from, to, identifier): internal consumes before explicit edges, in their order."""
    blank = lambda c: text_of(F.col(c))
    inner = links.select("repo", F.posexplode("consumes").alias("seq", "c")).where("c.resolution = 'internal'")
    sure = F.when((blank("c.evidence_from") != "") & (blank("c.evidence_to") != ""), "high").otherwise("medium")
    a = inner.select(F.col("repo").alias("from_repo"), F.col("c.to_repo").alias("to_repo"), F.concat(F.lit("consumes:"), blank("c.kind")).alias("kind"), blank("c.id").alias("identifier"), blank("c.evidence_from").alias("evidence_from"), blank("c.evidence_to").alias("evidence_to"), sure.alias("confidence"), F.lit(0).alias("origin"), "seq")
    b = links.select("repo", F.posexplode("edges").alias("seq", "e")).select(F.col("repo").alias("from_repo"), F.col("e.to_repo").alias("to_repo"), blank("e.kind").alias("kind"), blank("e.identifier").alias("identifier"), blank("e.evidence_from").alias("evidence_from"), blank("e.evidence_to").alias("evidence_to"), blank("e.confidence").alias("confidence"), F.lit(1).alias("origin"), "seq")
    return first_edges(a.unionByName(b))


def first_edges(edges: DataFrame) -> DataFrame:
    """The first edge in (origin, seq) of each (from_repo, to_repo, identifier)."""
    order = Window.partitionBy("from_repo", "to_repo", "identifier").orderBy("origin", "seq")
    return edges.withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k", "origin", "seq")


def graph_pipelines(facts: DataFrame, links: DataFrame) -> DataFrame:
    """One row for each trigger of each pipeline, or one with none_found; the trigger's source defaults to the own repository."""
    known = facts.select("repo", F.explode("pipelines").alias("p")).select("repo", F.col("p.name").alias("pipeline"), F.col("p.system").alias("system"), F.col("p.definition").alias("definition"))
    linked = links.select("repo", F.explode("pipelines").alias("q")).select("repo", F.col("q.name").alias("pipeline"), F.col("q.triggers").alias("triggers"), F.array_join("q.downstream", "; ").alias("downstream"))
    rows = known.join(linked, ["repo", "pipeline"], "left").select("*", F.explode_outer("triggers").alias("t"))
    return rows.select("repo", "pipeline", "system", "definition", F.coalesce("t.type", F.lit("none_found")).alias("trigger_type"), text_of(F.col("t.detail")).alias("trigger_detail"), F.when(F.col("t").isNotNull(), F.coalesce(F.nullif(F.col("t.source_repo"), F.lit("")), F.col("repo"))).otherwise("").alias("trigger_source_repo"), text_of(F.col("downstream")).alias("downstream"))


def graph_nodes(repos: DataFrame, edges: DataFrame, pipelines: DataFrame | None = None) -> DataFrame:
    """(repo, out_degree, in_degree, pipelines) of every repository."""
    end = lambda c: F.struct(F.col(c).alias("repo"), F.lit(c == "from_repo").alias("leaves"))
    ends = edges.select(F.explode(F.array(end("from_repo"), end("to_repo"))).alias("e")).select("e.*")
    degrees = ends.groupBy("repo").agg(F.count_if("leaves").alias("out_degree"), F.count_if(~F.col("leaves")).alias("in_degree"))
    rows = repos.select("repo").join(degrees, "repo", "left")
    if pipelines is not None:
        rows = rows.join(pipelines.groupBy("repo").agg(F.countDistinct("pipeline").alias("pipelines")), "repo", "left")
    else:
        rows = rows.withColumn("pipelines", F.lit(0).cast("long"))
    return rows.na.fill(0)


def isolated(repos: DataFrame, edges: DataFrame) -> DataFrame:
    ends = edges.select(F.col("from_repo").alias("repo")).union(edges.select("to_repo")).distinct()
    return repos.select("repo").join(ends, "repo", "left_anti")


def edge_summary(edges: DataFrame) -> DataFrame:
    """(from_repo, to_repo, kinds, diagram): the sorted kinds, up to a colon, of each pair, and the pair as a diagram line."""
    kinds = F.array_join(F.array_sort(F.collect_set(F.substring_index("kind", ":", 1))), ", ").alias("kinds")
    pairs = edges.groupBy("from_repo", "to_repo").agg(kinds)
    return pairs.withColumn("diagram", F.concat(node_id(F.col("from_repo")), F.lit(" -->|"), "kinds", F.lit("| "), node_id(F.col("to_repo"))))


def unresolved_of(used: DataFrame) -> DataFrame:
    """(repo, n, ids) of rows of ``used(repo, kind, id, resolution)`` that are unresolved."""
    rows = used.where("resolution = 'unresolved'")
    return rows.groupBy("repo").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set(F.concat_ws(" ", "kind", "id"))), "; ").alias("ids"))


def unresolved(links: DataFrame) -> DataFrame:
    """``unresolved_of`` what the links say is consumed."""
    return unresolved_of(links.select("repo", F.explode("consumes").alias("c")).select("repo", "c.kind", "c.id", "c.resolution"))
