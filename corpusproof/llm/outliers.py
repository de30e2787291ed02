"""Quality rules as robust multivariate outliers.

Each text gives a vector of transformed statistics.  For every language and source the minimum-covariance-determinant
estimate of centre and scatter is found by concentration steps, each of which is two grouped aggregations over all rows:
the quantile of the squared Mahalanobis distances, then mean and covariance of the rows within it.  Two deterministic
starts are carried along until no determinant falls by more than ``SETTLED``, and the one with the smaller determinant
is kept.  A text whose squared distance exceeds
``CUTOFF`` is rejected.

Scatter has a floor: measured in units of ``FLOOR`` (standard deviations of the transformed statistics), none of its
eigenvalues is below 1, so a group in which most texts share a value does not reject a text for a small departure from
it, and scatter above the floor counts as it is.  At the floor each statistic can reject a text by itself; distances are
scaled down, never up, to the chi-square median.
Every group is judged by its own estimate, whatever its size: scatter is at least that of the floor, so that even the
estimate of a few rows has an inverse.  A row that is alone in its group, or one of two, lies at the centre or as near to it
as the other, and is kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusproof.llm.native import small
from corpusproof.llm.scratch import written
from corpusproof.llm.textbytes import chunks, ngrams

#: Share of a group that the estimate is taken from.
SUPPORT = 0.75
#: Fall of a log determinant below which a concentration step changes nothing more.
SETTLED = 1e-3
#: Squared distance beyond which a text is rejected: the 0.999 quantile of chi-square with five degrees of freedom.
CUTOFF = 20.515
#: Groups up to which their estimates are broadcast (about 300 bytes each), so that a large group stays spread over tasks.
GROUPS = 20_000
_MEDIAN = 4.351  # chi-square median, five degrees of freedom
#: Statistics: log mean word length, log symbol share, upper-case share, repeated-line share, repeated-word share.
FLOOR = (0.08, 0.15, 0.03, 0.12, 0.12)
_P = len(FLOOR)
_SYMBOLS = np.zeros(256, np.int32)
_SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = 1
_UPPER = np.zeros(256, np.int32)
_UPPER[65:91] = 1
_POINTS = np.ones(256, np.int32)  # bytes that begin a code point
_POINTS[0x80:0xC0] = 0
_SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long"


def text_statistics(texts: pa.Array) -> list[np.ndarray]:
    """The columns of ``_SCHEMA`` for each text."""
    out = []
    for chunk in chunks(texts):
        start, end, first = chunk.words()
        sums = [np.concatenate([[0], np.cumsum(t[chunk.data])]) for t in (_POINTS, _SYMBOLS, _UPPER)]
        letters = np.concatenate([[0], np.cumsum(sums[0][end] - sums[0][start])])[first]
        line_start, line_end, line_first = chunk.lines()
        filled = np.searchsorted(start, line_start) < np.searchsorted(start, line_end)
        lines = chunk.hashes(line_start, line_end)
        grams, gram_first = ngrams(chunk.hashes(start, end), first, 3)
        repeated_lines, repeated_words = np.zeros(chunk.n, np.int64), np.zeros(chunk.n, np.int64)
        for k in range(chunk.n):
            a, b = line_first[k], line_first[k + 1]
            if b - a > 1:
                own = np.sort(lines[a:b][filled[a:b]])
                repeated_lines[k] = (own[1:] == own[:-1]).sum()
            a, b = gram_first[k], gram_first[k + 1]
            if b - a > 1:
                order = np.argsort(grams[a:b])
                same = grams[a:b][order]
                same = same[1:] == same[:-1]
                if same.any():
                    twice = np.zeros(b - a + 2, bool)
                    found = np.concatenate([order[1:][same], order[:-1][same]])
                    twice[found] = twice[found + 1] = twice[found + 2] = True
                    repeated_words[k] = twice.sum()
        whole = [s[chunk.at[1:]] - s[chunk.at[:-1]] for s in sums[1:]]
        out.append([np.diff(first), np.diff(letters), whole[0], repeated_lines, repeated_words, np.diff(line_first), whole[1]])
    return [np.concatenate(c).astype(np.int64) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 7


def with_statistics(documents: DataFrame) -> DataFrame:
    """(doc_id, lang, source) and the statistics of each text; a null text counts as empty."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *map(pa.array, text_statistics(batch.column(3)))], names=["doc_id", "lang", "source", *(c.split()[0] for c in _SCHEMA.split(", "))])

    have = set(documents.columns)
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in have else F.lit("").alias(c)
    return documents.select(F.col("doc_id").cast("long"), part("lang"), part("source"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, lang string, source string, " + _SCHEMA)


def _vector() -> list:
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return [
        F.log(chars / words),
        F.log1p(100.0 * F.col("n_symbols") / chars),
        F.col("n_upper") / chars,
        F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        F.sqrt(F.col("n_repeat_words") / words),
    ]


def _floored(cov: np.ndarray) -> np.ndarray:
    """``cov`` with eigenvalues of at least 1 in units of ``FLOOR``."""
    unit = np.outer(FLOOR, FLOOR)
    values, vectors = np.linalg.eigh((cov + cov.T) / 2 / unit)
    return (vectors * np.maximum(values, 1.0)) @ vectors.T * unit


def _inverses(moments: DataFrame) -> DataFrame:
    """From (pool, start, mean, square) the centre, inverse scatter and log determinant of each."""

    def run(frames):
        for frame in frames:
            rows = []
            for pool, start, mean, square in zip(frame["pool"], frame["start"], frame["mean"], frame["square"], strict=True):
                mean = np.array(mean, float)
                cov = _floored(np.array(square, float).reshape(_P, _P) - np.outer(mean, mean))
                rows.append((pool, start, mean.tolist(), np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1])))
            yield pd.DataFrame(rows, columns=["pool", "start", "centre", "inverse", "logdet"])

    return moments.mapInPandas(run, "pool string, start int, centre array<double>, inverse array<double>, logdet double")


def _distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Add d2, the squared Mahalanobis distance of x under the row's estimate."""
    joined = rows.join(small(estimates, GROUPS), ["pool", "start"])
    gap = [F.col("x")[i] - F.col("centre")[i] for i in range(_P)]
    d2 = sum((gap[i] * gap[j] * F.col("inverse")[_P * i + j] for i in range(_P) for j in range(_P)), F.lit(0.0))
    return joined.select(*rows.columns, d2.alias("d2"))


def judged(documents: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Statistics of each row, base_failed, distance2 and kept.

    base_failed: fewer than 50 words, or more than half of the words in three-word windows found twice or more.  Such
    rows take no part in the estimates and are not kept.  Null and empty texts have all statistics 0 and fail the base
    rules.  Null languages and sources are groups of their own, as are tables without these columns.  Repeated rows are
    judged alike; other columns are ignored; an empty table gives no rows.
    """
    rows = written(with_statistics(documents), "statistics")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.withColumn("pool", F.to_json(F.array("lang", "source")))
    fit = written(rows.where(~failed).select("pool", F.array(*_vector()).alias("x")), "fit")

    robust = fit.groupBy("pool").agg(*(F.percentile_approx(F.col("x")[i], 0.5, 1000).alias(f"m{i}") for i in range(_P)))
    spread = fit.join(small(written(robust, "medians"), GROUPS), "pool").groupBy("pool").agg(*(F.first(f"m{i}").alias(f"m{i}") for i in range(_P)), *(F.percentile_approx(F.abs(F.col("x")[i] - F.col(f"m{i}")), 0.5, 1000).alias(f"s{i}") for i in range(_P)))
    diagonal = lambda scale: F.array(*(1 / F.greatest(scale(i) * scale(i), F.lit(FLOOR[i] ** 2)) if i == j else F.lit(0.0) for i in range(_P) for j in range(_P)))
    centre = F.array(*(F.col(f"m{i}") for i in range(_P)))
    starts = [spread.select("pool", F.lit(k).alias("start"), centre.alias("centre"), inverse.alias("inverse"), F.lit(0.0).alias("logdet")) for k, inverse in enumerate([diagonal(lambda i: F.col(f"s{i}") * 1.4826), diagonal(lambda i: F.lit(3 * FLOOR[i]))])]
    estimates = written(starts[0].unionByName(starts[1]), "estimates")
    both = fit.select("pool", "x", F.explode(F.array(F.lit(0), F.lit(1))).alias("start"))  # one row for each start
    estimates = estimates.withColumn("least", F.lit(float("inf")))
    moving = True
    while moving:
        far = _distance(both, estimates)
        limit = far.groupBy("pool", "start").agg(F.percentile_approx("d2", SUPPORT, 1000).alias("limit"))
        near = far.join(small(written(limit, "limits"), GROUPS), ["pool", "start"]).where("d2 <= limit")
        moments = near.groupBy("pool", "start").agg(F.array(*(F.avg(F.col("x")[i]) for i in range(_P))).alias("mean"), F.array(*(F.avg(F.col("x")[i] * F.col("x")[j]) for i in range(_P) for j in range(_P))).alias("square"))
        # least only falls and has a bound, as scatter has, so the steps come to an end
        before = estimates.select("pool", "start", F.col("least").alias("before"))
        estimates = written(_inverses(moments).join(before, ["pool", "start"]).withColumn("least", F.least("before", "logdet")), "estimates")
        moving = estimates.where(F.col("before") - F.col("logdet") > SETTLED).limit(1).count() > 0
    best = estimates.groupBy("pool").agg(F.min_by(F.struct("start", "centre", "inverse"), F.struct("logdet", "start")).alias("b")).select("pool", "b.*")
    best = written(best, "best")
    median = _distance(both, best).groupBy("pool").agg(F.percentile_approx("d2", 0.5, 1000).alias("median"))
    final = best.join(median, "pool").select("pool", "start", "centre", "inverse", F.greatest(F.lit(1.0), F.col("median") / _MEDIAN).alias("scale"))
    final = written(final, "estimates")

    joined = rows.withColumn("base_failed", failed).withColumn("x", F.array(*_vector())).join(small(final, GROUPS), "pool", "left")
    gap = [F.col("x")[i] - F.col("centre")[i] for i in range(_P)]
    d2 = sum((gap[i] * gap[j] * F.col("inverse")[_P * i + j] for i in range(_P) for j in range(_P)), F.lit(0.0)) / F.col("scale")
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance2") <= cutoff, F.lit(True))
    return joined.withColumn("distance2", d2).select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance2", kept.alias("kept"))
