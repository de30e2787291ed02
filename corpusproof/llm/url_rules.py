"""URL filters: association rules mined from labelled URLs by FP-growth.

A URL is a set of tokens: host labels, path words (digits as ``#``), file extension, names of query parameters.  Labelled
URLs with their label as one more token are mined for frequent token sets (Spark's FP-growth); a set with the label
"block" gives a rule.  Rules are pruned by support and confidence, and a rule is dropped if a part of its tokens is
already as confident.  Rules are matched through an inverted index: each rule is listed under its rarest token, URLs meet
only the lists of their own tokens, and the rule's other tokens are then looked up.

A short list of host and path rules goes before the mined ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusproof.llm.native import small
from corpusproof.llm.scratch import written

SUPPORT = 0.001
CONFIDENCE = 0.6
#: Labelled URLs that a rule must hold for, at least, beside SUPPORT.
LEAST = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = "label=block"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; then up to ``? #`` or the end."""
    shape = "(?s)^.*?://([^/?#]*)([^?#]*)"
    plain = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(plain, shape, 1), _UPPER, _LOWER), F.regexp_extract(plain, shape, 2)


def url_tokens(url: Column) -> Column:
    """The URL's distinct tokens; none without ``://``."""
    host, path = url_parts(url)
    query = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), "(?s)^[^?#]*\\?([^#]*)", 1)
    some = lambda kind, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))
    words = F.split(F.regexp_replace(F.translate(path, _UPPER, _LOWER), "[0-9]+", "#"), "[/._-]+")
    names = F.transform(F.split(query, "&"), lambda x: F.split_part(x, F.lit("="), F.lit(1)))
    return F.array_sort(F.array_distinct(F.concat(some("h:", F.split(host, "\\.")), some("p:", words), some("q:", names))))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of ``rules`` (("net/", "block"), ...) that fits; null where none does.

    A rule is a host, and the path from its first slash on; it fits that host and its subdomains if the path begins so.
    """
    rule, verdict = None, None
    for text, value in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        at = text.index("/")
        fits = ((host == text[:at]) | host.endswith("." + text[:at])) & path.startswith(text[at:])
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(value)) if verdict is None else verdict.when(fits, F.lit(value))
    none = F.lit(None).cast("string")
    return (none if rule is None else rule), (none if verdict is None else verdict)


def mine_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, least: int = LEAST) -> DataFrame:
    """(rule_id, tokens, size, n, confidence) of the rules for "block" from ``labelled(url, blocked)``."""
    baskets = labelled.where("blocked is not null").select(F.concat(url_tokens(F.col("url")), F.when(F.col("blocked"), F.array(F.lit(BLOCK))).otherwise(F.array().cast("array<string>"))).alias("items"))
    baskets = written(baskets, "baskets")
    total = baskets.count()
    schema = "tokens array<string>, n long, confidence double, size int, rule_id string"
    if not total:
        return labelled.sparkSession.createDataFrame([], schema)
    sets = FPGrowth(itemsCol="items", minSupport=min(1.0, max(support, least / total)), minConfidence=confidence).fit(baskets).freqItemsets
    sets = written(sets.select(F.array_sort("items").alias("items"), "freq"), "itemsets")
    with_label = sets.where(F.array_contains("items", BLOCK)).select(F.array_remove("items", BLOCK).alias("items"), F.col("freq").alias("n")).where(F.size("items") > 0)
    rules = with_label.join(sets, "items").select(F.col("items").alias("tokens"), "n", (F.col("n") / F.col("freq")).alias("confidence")).where(F.col("confidence") >= confidence)
    rules = written(rules.withColumns({"size": F.size("tokens"), "rule_id": F.array_join("tokens", " ")}), "rules")
    # a smaller rule that is part of this one shares its own first token with it
    part = rules.select(F.element_at("tokens", 1).alias("t"), F.col("tokens").alias("part"), F.col("size").alias("part_size"), F.col("confidence").alias("part_confidence"))
    whole = rules.select("rule_id", "tokens", "size", "confidence", F.explode("tokens").alias("t"))
    beaten = whole.join(part, "t").where((F.col("part_size") < F.col("size")) & (F.col("part_confidence") >= F.col("confidence")) & (F.size(F.array_except("part", "tokens")) == 0))
    return rules.join(beaten.select("rule_id").distinct(), "rule_id", "left_anti").select("tokens", "n", "confidence", "size", "rule_id")


def matched_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, mined): the distinct URLs that some rule matches, with the most confident such rule."""
    rules = written(rules, "rules")
    tokens = written(urls.select("url").where("url is not null").distinct().select("url", url_tokens(F.col("url")).alias("own")), "urls")
    listed = rules.select("rule_id", "tokens", "confidence", F.explode("tokens").alias("t"))
    heard = tokens.select(F.explode("own").alias("t")).groupBy("t").agg(F.count("*").alias("df")).join(small(written(listed.select("t").distinct(), "listed"), 100_000), "t")
    index = listed.join(heard, "t").groupBy("rule_id").agg(F.min_by("t", F.struct("df", "t")).alias("t"), F.first("tokens").alias("tokens"), F.first("confidence").alias("confidence"))
    index = written(index, "index")
    met = tokens.select("url", "own", F.explode("own").alias("t")).join(small(index, 100_000), "t").where(F.size(F.array_except("tokens", "own")) == 0)
    return met.groupBy("url").agg(F.min_by("rule_id", F.struct(-F.col("confidence"), F.col("rule_id"))).alias("mined"))


def judge_urls(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str]] = (), support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """All columns of ``pages`` with host, path, rule, mined (the association rule met, else null) and verdict.

    verdict is that of ``rules``, else "block" where a mined rule matches, else "allow".  URLs that are null or without
    ``://`` have an empty host and path, and are allowed.  Without labels nothing is mined.  Repeated rows are judged
    alike; own columns named host, path, rule, mined or verdict are replaced; an empty table gives no rows.
    """
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "mined", "verdict")]
    found = written(matched_urls(pages, mine_rules(labelled, support, confidence)), "matched")
    host, path = url_parts(F.col("url"))
    judged = pages.select(*own).join(found, "url", "left").select(*own, host.alias("host"), path.alias("path"), "mined")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("mined").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("*", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"))
