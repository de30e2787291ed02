"""Mixing sources to target weights by soft membership.

Domains are the values of a labelled table.  A multinomial logistic regression on hashed words and a few shares of
characters, fitted on a bounded sample of labelled rows, gives every document its posterior over domains.  A document of
n words then counts n * posterior words in each domain, and nonnegative rates are fitted so that the expected totals
match the targets.

The fit is projected gradient descent from rate 1 on the least squares of the domains' gaps.  Gaps are weighted by the
inverse of M, the table of expected words that two domains share (sum of n * p_i * p_j), and a document's step is scaled
by 1 / n, so that the curvature is 1 and a step of length 1 is the longest that cannot overshoot: where no rate is cut
off at 0, one round meets all targets.  Steps have Nesterov's momentum, which starts anew when the weighted gap rises.  A
round is one aggregation over all documents; rates follow from the rounds' gradients, a number for each domain.  Rounds
go on until every domain is within ``TOLERANCE`` of its target, or until the weighted squared gap falls by less than
``GAIN`` in ``PATIENCE`` rounds: such targets cannot be met, or not by a useful number of rounds, and ``Fit.gaps`` says
how much is left.  Rates have no upper bound.

Spark's own ML and DataFrame functions do all the work; executors run no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusproof.llm.native import hidden, lowered_words, row_key, shown
from corpusproof.llm.scratch import written

#: Labelled rows that the classifier is fitted on, at most.
SAMPLE = 6000
HASHED = 1 << 13
#: Gap of a domain, as a share of its target (or, where larger, of a thousandth of all words), that counts as met.
TOLERANCE = 1e-3
#: Share of the weighted squared gap that PATIENCE rounds must take off it to be followed by more.
GAIN = 0.1
PATIENCE = 5
#: Rounds after which the rates so far are written, so that expressions stay short.
CHAIN = 6


def _features(documents: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, n_words and a feature vector of each text: hashed words' shares of the text, and shares of characters."""
    raw = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = F.greatest(F.length(raw), F.lit(1))
    share = lambda chars: (F.length(raw) - F.length(F.translate(raw, chars, ""))) / size
    rows = documents.select(*keep, lowered_words(F.col("text")).alias("_words"), share("#*$%&<>|!").alias("_marks"), share("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("_upper"))
    rows = rows.withColumns({"n_words": F.size("_words").cast("long"), "_distinct": F.size(F.array_distinct("_words")) / F.greatest(F.size("_words"), F.lit(1))})
    hashed = HashingTF(numFeatures=HASHED, binary=True, inputCol="_words", outputCol="_tf").transform(rows)
    return VectorAssembler(inputCols=["_marks", "_upper", "_distinct", "_tf"], outputCol="_features").transform(hashed).select(*keep, "n_words", "_features")


def domain_posteriors(documents: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, list[str]]:
    """(key, tie, n_words, p) of each row, and the domains that p's places stand for.

    ``labelled(doc_id, domain)``: rows without a doc_id or domain are passed over.  With fewer than two domains the only
    one (or "all") has posterior 1.
    """
    known = labelled.where("doc_id is not null and domain is not null").select("doc_id", F.col("domain").cast("string").alias("domain"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id", "domain").limit(sample)
    train = written(_features(documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id"), ["domain"]), "sample")
    domains = sorted(r["domain"] for r in train.select("domain").distinct().collect())
    texts = row_key(documents.select("doc_id", "text"))
    if len(domains) < 2:
        return texts.select("key", "tie", F.size(lowered_words(F.col("text"))).cast("long").alias("n_words"), F.array(F.lit(1.0)).alias("p")), domains or ["all"]
    number = F.array_position(F.array(*map(F.lit, domains)), F.col("domain")) - 1
    fit = LogisticRegression(featuresCol="_features", labelCol="label", family="multinomial", regParam=1e-3, maxIter=25, standardization=True)
    model = fit.fit(train.withColumn("label", number.cast("double")).coalesce(4)).setProbabilityCol("_p").setRawPredictionCol("").setPredictionCol("")
    scored = model.transform(_features(texts, ["key", "tie"]))
    return scored.select("key", "tie", "n_words", vector_to_array("_p").alias("p")), domains


@dataclass
class Fit:
    """Rates of ``rows`` (key, tie, n_words, p, rate) and, by domain, the words wanted, reached and had at rate 1."""

    rows: DataFrame
    domains: list[str]
    wanted: list[float]
    reached: list[float]
    had: list[float]
    rounds: int

    def gaps(self) -> dict[str, float]:
        """Of each domain: (reached - wanted) / wanted; of one that is not wanted, over all words wanted."""
        whole = sum(self.wanted) or 1.0
        return {d: (r - w) / (w or whole) for d, w, r in zip(self.domains, self.wanted, self.reached, strict=True)}


def _after(rows: DataFrame, steps: list[tuple[list[float], float]]) -> DataFrame:
    """``rows`` with rate and ahead (the rate with momentum) after the given rounds of (step, momentum).

    Steps are array literals, so that all documents and sizes share one generated class.
    """
    for step, momentum in steps:
        s = F.array(*map(F.lit, [*step, momentum]))
        move = sum((F.col("p")[k] * s[k] for k in range(len(step))), F.lit(0.0))
        rows = rows.withColumn("new", F.greatest(F.lit(0.0), F.col("ahead") - move))
        rows = rows.withColumn("ahead", F.greatest(F.lit(0.0), F.col("new") + (F.col("new") - F.col("rate")) * s[len(step)])).withColumn("rate", F.col("new")).drop("new")
    return rows


def fit_rates(documents: DataFrame, labelled: DataFrame, targets: dict[str, float], total: float | None = None, sample: int = SAMPLE) -> Fit:
    """The rates of all rows of ``documents(doc_id, text)``.

    ``targets`` are the domains' weights (any positive scale; a domain that is left out has weight 0) of ``total`` words,
    by default as many as the documents have.  A target of a domain without an expected word cannot be met; ``gaps``
    tells.  Null and empty texts have 0 words, a posterior like any text, and a rate.  Repeated rows count each on its
    own and get the same rate; an empty table gives no rows.
    """
    posteriors, domains = domain_posteriors(documents, labelled, sample)
    rows = written(posteriors.withColumns({"rate": F.lit(1.0), "ahead": F.lit(1.0)}), "posteriors")
    places = range(len(domains))
    n, p = F.col("n_words"), F.col("p")
    now = rows.agg(*(F.coalesce(F.sum(n * p[k]), F.lit(0.0)).alias(f"t{k}") for k in places), *(F.coalesce(F.sum(n * p[i] * p[j]), F.lit(0.0)).alias(f"m{i}_{j}") for i in places for j in places)).first()
    had = np.array([now[f"t{k}"] for k in places])
    scale = sum(targets.get(d, 0.0) for d in domains) or 1.0
    wanted = np.array([(total if total is not None else had.sum()) * targets.get(d, 0.0) / scale for d in domains])
    inverse = np.linalg.pinv(np.array([[now[f"m{i}_{j}"] for j in places] for i in places]), hermitian=True)
    steps: list[tuple[list[float], float]] = []
    worth: list[float] = []
    reached, pace = had, 1.0
    while (np.abs(reached - wanted) > TOLERANCE * np.maximum(wanted, 1e-3 * wanted.sum())).any():
        gap = reached - wanted
        worth.append(float(gap @ inverse @ gap))
        if len(worth) > PATIENCE and min(worth[-PATIENCE:]) >= (1 - GAIN) * min(worth[:-PATIENCE]):
            break
        if len(worth) > 1 and worth[-1] > worth[-2]:
            pace = 1.0
        following = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        steps.append(((inverse @ gap).tolist(), (pace - 1) / following))
        pace = following
        sums = _after(rows, steps).agg(*(F.coalesce(F.sum(n * p[k] * F.col("ahead")), F.lit(0.0)).alias(f"t{k}") for k in places)).first()
        reached = np.array([sums[f"t{k}"] for k in places])
        if len(steps) == CHAIN:
            rows, steps = written(_after(rows, steps), "rates"), []
    rates = _after(rows, steps).select("key", "tie", "n_words", "p", F.col("ahead").alias("rate"))
    return Fit(rates, domains, wanted.tolist(), reached.tolist(), had.tolist(), len(worth))


def _rated(documents: DataFrame, labelled: DataFrame, targets: dict[str, float], total: float | None = None, sample: int = SAMPLE) -> DataFrame:
    """Rows of ``hidden(documents)`` with mix: struct of n_words, domain (likeliest), posterior (its probability), rate."""
    fit = fit_rates(documents, labelled, targets, total, sample)
    best = F.array_max("p")
    named = F.array(*map(F.lit, fit.domains))[(F.array_position("p", best) - 1).cast("int")]
    found = F.struct("n_words", named.alias("domain"), best.alias("posterior"), "rate")
    rated = fit.rows.select("key", "tie", found.alias("mix")).dropDuplicates(["key", "tie"])
    return hidden(documents).join(rated, ["key", "tie"])


def document_rates(documents: DataFrame, labelled: DataFrame, targets: dict[str, float], total: float | None = None, sample: int = SAMPLE) -> DataFrame:
    """All columns of ``documents`` with n_words, domain, posterior and rate, as ``fit_rates`` finds them; own columns of these names are replaced."""
    rated = _rated(documents, labelled, targets, total, sample)
    own = [F.col(f"own{k}").alias(c) for k, c in enumerate(documents.columns) if c not in ("n_words", "domain", "posterior", "rate")]
    return rated.select(*own, "mix.*")


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain): "clean", "poor" (quality 0) or "toxic" (toxic 1)."""
    domain = F.when(F.col("toxic") == 1, F.lit("toxic")).when(F.col("quality") == 0, F.lit("poor")).when(F.col("quality") == 1, F.lit("clean"))
    return labels.select("doc_id", domain.alias("domain"))


def mixed(documents: DataFrame, labelled: DataFrame, targets: dict[str, float], total: float | None = None) -> DataFrame:
    """``documents`` with each row as often as its rate says: its whole part, and once more if a hash of the row falls below the rest.

    Rows that repeat doc_id and text are drawn alike; null ids and texts are hashed as such; own columns of any name stay.
    """
    rated = _rated(documents, labelled, targets, total)
    draw = F.pmod(F.xxhash64(F.lit("mix"), F.col("key"), F.col("tie")), F.lit(1_000_003)) / 1_000_003
    rate = F.col("mix.rate")
    copies = (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("int")
    return shown(rated.withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies))), documents)
