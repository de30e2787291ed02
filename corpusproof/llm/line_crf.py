"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Every line is labelled good (1) or bad (0).  Its emission score adds weights of binned statistics of the line itself
and of the lines before and after it; a 2 x 2 table scores neighbouring labels.  Forward and backward messages (as log
odds, since there are two labels) give each line's marginal, and a document's quality is the mean of the marginals
weighted by the lines' lengths in bytes.

The model is fitted in one task from a bounded sample of labelled documents, every line of which takes the label of
its document; only its weights come to the driver.  Texts are scored whole, inside Arrow batches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusproof.llm.native import bounded_sample
from corpusproof.llm.textbytes import Chunk, chunks

#: Upper bound of the labelled documents that the model is fitted on.
SAMPLE = 4000
#: Upper bound of their texts' characters in all; a longer text than what is left of it is passed over.
SAMPLE_CHARS = 24_000_000
_SHARES = np.array([0.005, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7])
_SIZES = np.array([1, 3, 6, 12, 25, 50, 100])
_LENGTHS = np.array([2.0, 3.0, 4.0, 5.0, 6.5, 8.0, 11.0])
_BINS = 8
_CLASSES = [b"#*$%&<>@^~_=+\\{}[]", b"|", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!", b".,;:?", bytes(range(0x80, 0x100))]
_COUNT = len(_CLASSES) + 4
#: Bins of one line, and one more for "there is no such line".
_WIDTH = _COUNT * _BINS
_ONE_OF = np.zeros((len(_CLASSES), 256), np.int32)
for _row, _members in zip(_ONE_OF, _CLASSES, strict=True):
    _row[np.frombuffer(_members, np.uint8)] = 1


def line_features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bins, weights, text_first): one bin of each statistic per line, lengths in bytes, lines of each text."""
    start, end, first = chunk.lines()
    size = end - start
    columns = []
    for one in _ONE_OF:
        total = np.concatenate([[0], np.cumsum(one[chunk.data])])
        columns.append(np.searchsorted(_SHARES, (total[end] - total[start]) / np.maximum(size, 1)))
    word_start, word_end, _ = chunk.words()
    low, high = np.searchsorted(word_start, start), np.searchsorted(word_start, end)
    n_words = high - low
    columns.append(np.searchsorted(_SIZES, n_words, "right"))
    letters = np.concatenate([[0], np.cumsum(word_end - word_start)])
    columns.append(np.searchsorted(_LENGTHS, (letters[high] - letters[low]) / np.maximum(n_words, 1)))
    words = chunk.hashes(word_start, word_end)
    for back in (1, 2):
        again = np.zeros(len(words) + 1, np.int64)
        if len(words) > back:
            again[back + 1 :] = words[back:] == words[:-back]
        total = np.cumsum(again)
        inside = np.minimum(low + back, high)
        columns.append(np.searchsorted(_SHARES, (total[high] - total[inside]) / np.maximum(n_words, 1)))
    bins = np.stack(columns, 1) + np.arange(_COUNT) * _BINS
    return bins.astype(np.int32), size + 1, first


def with_neighbours(bins: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Feature numbers of each line, the line before and the line after; a missing line has a number of its own."""
    before, after = np.full_like(bins, 3 * _WIDTH), np.full_like(bins, 3 * _WIDTH + 1)
    if len(bins) > 1:
        before[1:] = bins[:-1] + _WIDTH
        after[:-1] = bins[1:] + 2 * _WIDTH
    filled = first[:-1] < first[1:]
    before[first[:-1][filled]] = 3 * _WIDTH
    after[first[1:][filled] - 1] = 3 * _WIDTH + 1
    return np.concatenate([bins, before, after], 1)


@dataclass
class LineCrf:
    """weights: of the features, for label 1 against 0; trans[i, j]: of label i followed by j; begin: of a first 1."""

    weights: np.ndarray
    trans: np.ndarray
    begin: float

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return self.weights[features].sum(1)

    def messages(self, e: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward log odds of each line; all texts advance together, the longest first."""
        t = self.trans
        count = np.diff(first)
        order = np.argsort(-count, kind="stable")
        start, length = first[:-1][order], count[order]
        forward, backward = np.zeros(len(e)), np.zeros(len(e))
        longest = int(length[0]) if len(length) else 0
        live = np.searchsorted(-length, -np.arange(longest), "left")  # texts with more than k lines
        if longest:
            at = start[: live[0]]
            a = forward[at] = self.begin + e[at]
        for k in range(1, longest):
            a = a[: live[k]]
            at = start[: live[k]] + k
            a = forward[at] = e[at] + np.logaddexp(a + t[1, 1], t[0, 1]) - np.logaddexp(a + t[1, 0], t[0, 0])
        for k in range(longest - 2, -1, -1):
            at = start[: live[k + 1]] + k
            x = e[at + 1] + backward[at + 1]
            backward[at] = np.logaddexp(t[1, 1] + x, t[1, 0]) - np.logaddexp(t[0, 1] + x, t[0, 0])
        return forward, backward

    def marginals(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        forward, backward = self.messages(self.emissions(features), first)
        return 1 / (1 + np.exp(-np.clip(forward + backward, -60, 60)))

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Document quality: marginals averaged by line length."""
        out = []
        for chunk in chunks(texts):
            bins, weight, first = line_features(chunk)
            part = np.concatenate([[0], np.cumsum(self.marginals(with_neighbours(bins, first), first) * weight)])
            whole = np.concatenate([[0], np.cumsum(weight)])
            out.append(np.clip((part[first[1:]] - part[first[:-1]]) / (whole[first[1:]] - whole[first[:-1]]), 0, 1))
        return np.concatenate(out) if out else np.zeros(0)


def fit(texts: pa.Array, labels: np.ndarray, rounds: int = 120, rate: float = 0.1, decay: float = 1e-4) -> LineCrf:
    """Maximise the penalised likelihood of the line labels by Adam; without both labels the score is their constant."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    odds = float(np.log(share / (1 - share)))
    model = LineCrf(np.zeros(3 * _WIDTH + 2), np.zeros((2, 2)), odds)
    if len(set(labels.tolist())) < 2:
        model.trans = np.array([[0.0, -30.0], [-30.0, 0.0]])
        return model
    features, first = [], [np.zeros(1, np.int64)]
    for chunk in chunks(texts):
        bins, _, f = line_features(chunk)
        features.append(with_neighbours(bins, f))
        first.append(f[1:] + first[-1][-1])
    features, first = np.concatenate(features), np.concatenate(first)
    gold = np.repeat(labels.astype(float), np.diff(first))
    pair = np.ones(len(gold), bool)
    pair[first[1:] - 1] = False
    at = np.flatnonzero(pair)
    weight = 1 / np.repeat(np.maximum(np.diff(first), 1), np.diff(first))  # each document counts once
    state = np.zeros(len(model.weights) + 5)
    m, v = np.zeros_like(state), np.zeros_like(state)
    state[-1] = odds
    for step in range(1, rounds + 1):
        model = LineCrf(state[:-5], state[-5:-1].reshape(2, 2), float(state[-1]))
        e = model.emissions(features)
        forward, backward = model.messages(e, first)
        p = 1 / (1 + np.exp(-np.clip(forward + backward, -60, 60)))
        grad = np.zeros_like(state)
        grad[:-5] = np.bincount(features.ravel(), np.repeat((gold - p) * weight, features.shape[1]), len(model.weights))
        ahead = e[at + 1] + backward[at + 1]
        joint = np.stack([np.full(len(at), model.trans[0, 0]), model.trans[0, 1] + ahead, forward[at] + model.trans[1, 0], forward[at] + model.trans[1, 1] + ahead])
        joint = np.exp(joint - joint.max(0))
        joint /= joint.sum(0)
        seen = (2 * gold[at] + gold[at + 1]).astype(int)
        grad[-5:-1] = np.bincount(seen, weight[at], 4) - (joint * weight[at]).sum(1)
        begins = first[:-1]
        grad[-1] = ((gold - p) * weight)[begins].sum()
        grad = grad / len(labels) - decay * state
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        state = state + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return LineCrf(state[:-5], state[-5:-1].reshape(2, 2), float(state[-1]))


def labelled_sample(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> DataFrame:
    """(text, quality) of at most ``sample`` labelled documents of ``chars`` characters, those whose doc_id has the smallest hash."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)")
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id")
    return bounded_sample(rows.withColumn("h", F.xxhash64("doc_id")), ["h", "doc_id", "text", "quality"], sample, chars).select("text", "quality")


def fitted(sample: DataFrame) -> LineCrf:
    """``fit`` in one task over ``sample(text, quality)``."""

    def run(batches):
        rows = pa.Table.from_batches(list(batches), pa.schema([("text", pa.string()), ("quality", pa.int32())]))
        model = fit(rows["text"].combine_chunks() if rows.num_rows else pa.array([], pa.string()), rows["quality"].to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tolist()]), pa.array([model.trans.ravel().tolist()]), pa.array([model.begin])], names=["weights", "trans", "begin"])

    found = sample.coalesce(1).mapInArrow(run, "weights array<double>, trans array<double>, begin double").first()
    return LineCrf(np.array(found["weights"]), np.array(found["trans"]).reshape(2, 2), found["begin"]) if found else fit(pa.array([], pa.string()), np.zeros(0))


def quality_scores(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """All columns of ``documents`` and ``quality_score`` (0 to 1, higher: label 1 likelier).

    ``labels(doc_id, quality)`` holds what may be learnt from; rows with another quality than 0 or 1, or no doc_id, are
    passed over.  Null and empty texts are scored as one empty line.  Without labels of both kinds every score is the
    constant share of label 1.  Repeated rows are scored alike; an empty table gives no rows.
    """
    model = fitted(labelled_sample(documents, labels, sample))
    keep = [c for c in documents.columns if c != "quality_score"]
    schema = documents.select(keep).schema.add("quality_score", "double")

    def run(batches):
        for batch in batches:
            scores = pa.array(model.scores(batch.column(0).cast(pa.string())), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], scores], names=schema.names)

    return documents.select(F.col("text").alias("_scored"), *keep).mapInArrow(run, schema)
