"""LM scoring: a log-bilinear neural model, trained in numpy with noise-contrastive estimation.

The model predicts the next token's unit from the units of the three tokens before it.  Every word that occurs at least
``OFTEN`` times in training, up to the ``HEAD`` most frequent ones, is a unit of its own; every other word belongs to one
of ``GROUPS`` units by its shape (closing punctuation, accents, last letter), and the end of a text is a unit.  Units in
order of their counts are cut into classes of like size.  The prediction vector is the sum of the context units' vectors,
each weighted componentwise by its place; the score of a class, and of a unit in its class, is an inner product with
this vector plus a bias.  Scores of all classes, and of all units of a token's class, come from matrix products over
batches of tokens, so probabilities are normalised:

    p(word | context) = p(class | context) * p(unit | class, context) * (c + 1) / (sum of (c + 1) over the known words of the unit, + 1 for unknown)

where c is the word's training count and the last factor is 1 for units of one word and the end.  Words never seen in
training share the one unknown word of their unit.  Both levels are trained with noise from their training counts.

Counting covers all training texts: each task merges its own counts before the shuffle.  Training covers all training
texts too: from a start fitted in one task on a bounded sample every partition trains on its own texts, and parameters
are averaged by tokens with a grouped sum.  Counts of the ``FREQUENT`` most frequent words are broadcast; all other words
of a text meet their counts in a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusproof.llm.native import bounded_sample
from corpusproof.llm.scratch import written
from corpusproof.llm.textbytes import Chunk, chunks

#: Words with vectors of their own, at most, and the count that a word needs for them.
HEAD = 6_000
OFTEN = 50
CONTEXT = 3
WIDTH = 16
#: Noise drawn for the classes of a batch, and for the units of each class.
NOISE, UNIT_NOISE = 24, 12
BATCH = 32_768
#: Words whose counts every task gets, at most; 16 bytes each.
FREQUENT = 300_000
#: Texts, and their characters, of the sample that the start is fitted on, at most.
SAMPLE, SAMPLE_CHARS = 1500, 8_000_000
_PLAIN = 26 + 1 + 16  # last letter, anything else, accents
_MARKS = b".,!&*%$#|"
_MARKED = 17  # no accent, accents
GROUPS = _PLAIN + len(_MARKS) * _MARKED
_MARK_OF = np.zeros(256, np.int64)
for _k, _c in enumerate(_MARKS):
    _MARK_OF[_c] = _k + 1


def shapes(chunk: Chunk, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The group of each word: by its last byte, and by the last byte of its last character beyond ASCII."""
    if not len(start):
        return np.zeros(0, np.int64)
    data = chunk.data
    at = np.where(data >= 0x80, np.arange(len(data)), -1)
    seen = np.maximum.accumulate(at)[end - 1]
    accent = np.where(seen >= start, 1 + (data[np.maximum(seen, 0)] & 15), 0).astype(np.int64)
    last = data[end - 1].astype(np.int64)
    mark = _MARK_OF[last]
    letter = np.where((last >= 97) & (last < 123), last - 97, 26)
    plain = np.where(accent > 0, 26 + accent, letter)
    return np.where(mark > 0, _PLAIN + (mark - 1) * _MARKED + accent, plain)


def _merge(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h, group, n = (np.concatenate(c) for c in zip(*parts, strict=True))
    words, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    return words, group[first], np.bincount(inverse, n, len(words)).astype(np.int64)


def word_counts(texts: DataFrame, hold: int = 400_000) -> DataFrame:
    """(h, shape, c) of every word of ``texts(text)``, lower-cased; tasks merge up to ``hold`` words before they send."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                low = chunk.lowered()
                start, end, _ = low.words()
                held.append(_merge([(low.hashes(start, end), shapes(low, start, end), np.ones(len(start)))]))
                size += len(held[-1][0])
                if size > 2 * hold:
                    held = [_merge(held)]
                    size = len(held[0][0])
                    if size > hold:
                        yield _batch(held[0])
                        held, size = [], 0
        if held:
            yield _batch(_merge(held))

    def _batch(part):
        return pa.RecordBatch.from_arrays([pa.array(part[0].view(np.int64)), pa.array(part[1].astype(np.int32)), pa.array(part[2])], names=["h", "shape", "c"])

    return texts.select("text").mapInArrow(run, "h long, shape int, c long").groupBy("h").agg(F.min("shape").alias("shape"), F.sum("c").alias("c"))


@dataclass
class LogBilinear:
    """context: vectors of the units as context (one more: before a text), place: weights by distance, class_out and class_bias
    of the classes, out and bias of the units (unit u is number u % size of class u // size; places without a unit are never likely)."""

    context: np.ndarray
    place: np.ndarray
    class_out: np.ndarray
    class_bias: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, unit_counts: np.ndarray, seed: int = 7) -> LogBilinear:
        """Small random vectors and the log probabilities of single units."""
        draw = np.random.RandomState(seed)
        size, classes = shape_of(len(unit_counts))
        filled = size * classes
        mass = np.zeros(filled)
        mass[: len(unit_counts)] = unit_counts + 0.5
        whole = mass.reshape(classes, size).sum(1)
        with np.errstate(divide="ignore"):
            bias = np.maximum(np.log(mass / np.repeat(whole, size)), -1e4)
        small = lambda *n: draw.normal(0, 0.1, n).astype(np.float32)
        return cls(small(len(unit_counts) + 1, WIDTH), np.ones((CONTEXT, WIDTH), np.float32), small(classes, WIDTH), np.log(whole / whole.sum()).astype(np.float32), small(filled, WIDTH), bias.astype(np.float32))

    def arrays(self) -> list[np.ndarray]:
        return [self.context, self.place, self.class_out, self.class_bias[:, None], self.out, self.bias[:, None]]

    @classmethod
    def of(cls, arrays: list[np.ndarray]) -> LogBilinear:
        flat = lambda a: np.ascontiguousarray(a[:, 0])
        return cls(arrays[0], arrays[1], arrays[2], flat(arrays[3]), arrays[4], flat(arrays[5]))

    def predict(self, contexts: np.ndarray) -> np.ndarray:
        return sum(self.context[contexts[:, j]] * self.place[j] for j in range(CONTEXT))

    def log_probabilities(self, contexts: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Normalised natural-log probabilities, by matrix products over batches."""
        result = np.empty(len(units), np.float64)
        classes = len(self.class_out)
        size = len(self.out) // classes
        # a last row for the biases; contexts get a last 1
        of_class = np.vstack([self.class_out.T, self.class_bias])
        of_unit = np.concatenate([self.out.reshape(classes, size, -1).transpose(0, 2, 1), self.bias.reshape(classes, 1, size)], 1)
        for k in range(0, len(units), 1 << 16):
            own = units[k : k + (1 << 16)]
            q = np.ones((len(own), WIDTH + 1), np.float32)
            q[:, :WIDTH] = self.predict(contexts[k : k + (1 << 16)])
            first, order, edges = by_class(own // size, classes)
            log_p = np.empty(len(own), np.float64)
            for lo in range(0, len(own), 2048):
                log_p[lo : lo + 2048] = _own_log_share(q[lo : lo + 2048] @ of_class, first[lo : lo + 2048])
            inside, q = np.empty(len(own), np.float64), q[order]
            slot = (own % size)[order]
            for c in np.flatnonzero(np.diff(edges)):
                a, b = edges[c], edges[c + 1]
                inside[a:b] = _own_log_share(q[a:b] @ of_unit[c], slot[a:b])
            log_p[order] += inside
            result[k : k + (1 << 16)] = log_p
        return result


def _own_log_share(scores: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Log softmax of each row at its own column; ``scores`` are used up."""
    at = scores[np.arange(len(scores)), own].astype(np.float64)
    if scores.max(initial=0) > 80:  # exp would overflow
        most = scores.max(1)
        scores -= most[:, None]
        at -= most
    np.exp(scores, out=scores)
    return at - np.log(scores.sum(1))


def shape_of(units: int) -> tuple[int, int]:
    """(units of a class, classes)."""
    size = max(1, int(np.ceil(units**0.5)))
    return size, -(-units // size)


def by_class(of: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each token, order by class, where each class begins in that order)."""
    order = np.argsort(of.astype(np.uint16), kind="stable")
    return of, order, np.searchsorted(of[order], np.arange(classes + 1))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)), in the place of x."""
    np.clip(x, -30, 30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Trainer:
    """Noise-contrastive estimation with AdaGrad, of classes and of units in their class; the same noise serves a whole batch."""

    def __init__(self, model: LogBilinear, unit_counts: np.ndarray, seed: int = 11, rate: float = 0.08):
        self.model = LogBilinear.of([a.copy() for a in model.arrays()])
        self.classes = len(model.class_out)
        self.size = len(model.out) // self.classes
        mass = np.zeros(len(model.out))
        mass[: len(unit_counts)] = unit_counts + 0.5
        whole = mass.reshape(self.classes, self.size).sum(1)
        self.class_cumulative, self.log_class_noise = np.cumsum(whole / whole.sum()), np.log(whole / whole.sum() * NOISE).astype(np.float32)
        inside = np.cumsum((mass.reshape(self.classes, self.size) / whole[:, None]), 1)
        self.cumulative = (inside + np.arange(self.classes)[:, None]).ravel()  # of class c: from c to c + 1
        self.log_noise = np.log(np.maximum(mass / np.repeat(whole, self.size), 1e-9) * UNIT_NOISE).astype(np.float32)
        self.draw, self.rate = np.random.RandomState(seed), rate
        self.sums = [np.full_like(a, 1.0) for a in self.model.arrays()]
        self.tokens = 0

    def step(self, contexts: np.ndarray, units: np.ndarray) -> None:
        m = self.model
        of, order, edges = by_class(units // self.size, self.classes)
        contexts, units, of = contexts[order], units[order], of[order]
        rows = [m.context[contexts[:, j]] for j in range(CONTEXT)]
        q = sum(r * m.place[j] for j, r in enumerate(rows))
        grads = [np.zeros_like(a) for a in m.arrays()]
        d_context, d_place, d_class, d_class_bias, d_out, d_bias = grads

        noise = np.minimum(np.searchsorted(self.class_cumulative, self.draw.random_sample(NOISE)), self.classes - 1)
        own, others = m.class_out[of], m.class_out[noise]
        g = (_sigmoid((q * own).sum(1) + m.class_bias[of] - self.log_class_noise[of]) - 1).astype(np.float32)
        wrong = _sigmoid(q @ others.T + m.class_bias[noise] - self.log_class_noise[noise]).astype(np.float32)
        gq = g[:, None] * own + wrong @ others
        filled = np.flatnonzero(np.diff(edges))
        d_class[filled] += np.add.reduceat(g[:, None] * q, edges[filled])
        d_class_bias[:, 0] += np.bincount(of, g, self.classes)
        np.add.at(d_class, noise, wrong.T @ q)
        np.add.at(d_class_bias[:, 0], noise, wrong.sum(0))

        own = m.out[units]
        g = (_sigmoid((q * own).sum(1) + m.bias[units] - self.log_noise[units]) - 1).astype(np.float32)
        gq += g[:, None] * own
        _scatter(d_out, units, g[:, None] * q)
        d_bias[:, 0] += np.bincount(units, g, len(d_bias))
        drawn = np.searchsorted(self.cumulative, np.arange(self.classes)[:, None] + self.draw.random_sample((self.classes, UNIT_NOISE)))
        drawn = np.minimum(drawn, np.arange(1, self.classes + 1)[:, None] * self.size - 1)
        others, shift = m.out[drawn], m.bias[drawn] - self.log_noise[drawn]
        to_out, to_bias = np.zeros_like(others), np.zeros_like(shift)
        for c in filled:
            a, b = edges[c], edges[c + 1]
            wrong = q[a:b] @ others[c].T
            wrong += shift[c]
            _sigmoid(wrong)
            gq[a:b] += wrong @ others[c]
            to_out[c], to_bias[c] = wrong.T @ q[a:b], wrong.sum(0)
        np.add.at(d_out, drawn.ravel(), to_out.reshape(-1, WIDTH))
        np.add.at(d_bias[:, 0], drawn.ravel(), to_bias.ravel())

        d_place += np.stack([(gq * r).sum(0) for r in rows])
        for j in range(CONTEXT):
            _scatter(d_context, contexts[:, j], gq * m.place[j])
        for a, s, d in zip(m.arrays(), self.sums, grads, strict=True):
            s += d * d
            a -= self.rate * d / np.sqrt(s)
        self.tokens += len(units)

    def run(self, contexts: np.ndarray, units: np.ndarray) -> None:
        for k in range(0, len(units), BATCH):
            self.step(contexts[k : k + BATCH], units[k : k + BATCH])


def _scatter(into: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """into[at] += rows, for many repeats of few places."""
    order = np.argsort(at.astype(np.uint16), kind="stable")
    ordered = at[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    into[ordered[first]] += np.add.reduceat(rows[order], first)


@dataclass
class Vocabulary:
    """Words' hashes (sorted) with their counts and units (-1: that of their shape), the units of shapes and of the end,
    and by unit its count and, for shapes, the sum of (c + 1) over its known words and 1 for unknown ones (for others 1)."""

    words: np.ndarray
    count: np.ndarray
    unit: np.ndarray
    group_unit: np.ndarray
    end: int
    unit_counts: np.ndarray
    unit_mass: np.ndarray

    def head(self) -> Vocabulary:
        """Only the words that are units."""
        own = self.unit >= 0
        return Vocabulary(self.words[own], self.count[own], self.unit[own], self.group_unit, self.end, self.unit_counts, self.unit_mass)

    def units(self, texts: pa.Array) -> Iterator[tuple]:
        """For each chunk: words' hashes, their place in ``words`` (-1: none), text_first, and (units, contexts, token_first) with an end after each text."""
        for chunk in chunks(texts):
            low = chunk.lowered()
            start, end, first = low.words()
            words = low.hashes(start, end)
            unit = self.group_unit[shapes(low, start, end)]
            at = np.full(len(words), -1)
            if len(self.words):
                near = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
                at = np.where(self.words[near] == words, near, -1)
                own = np.where(at >= 0, self.unit[near], -1)
                unit = np.where(own >= 0, own, unit)
            text = np.repeat(np.arange(chunk.n), np.diff(first))
            tokens = np.full(len(words) + chunk.n, self.end, np.int64)
            tokens[np.arange(len(words)) + text] = unit
            token_first = first + np.arange(chunk.n + 1)
            contexts = np.full((len(tokens), CONTEXT), len(self.unit_counts), np.int64)
            place = np.arange(len(tokens)) - np.repeat(token_first[:-1], np.diff(token_first))
            for j in range(CONTEXT):
                contexts[j + 1 :, j] = tokens[: len(tokens) - j - 1]
                contexts[place <= j, j] = len(self.unit_counts)
            yield words, at, first, tokens, contexts, token_first


def _vocabulary(counts: DataFrame, n_texts: int, most: int = HEAD, often: int = OFTEN) -> tuple[Vocabulary, int, int]:
    """The vocabulary, N (tokens with ends) and V (distinct tokens with the end) from the written word counts."""
    frequent = counts.orderBy(F.desc("c"), "h").limit(FREQUENT).toArrow()
    h, c, shape = frequent["h"].to_numpy().view(np.uint64), frequent["c"].to_numpy(), frequent["shape"].to_numpy()
    groups = counts.groupBy("shape").agg(F.sum("c").alias("c"), F.count("*").alias("v")).toArrow()  # a row for each group
    n_head = min(most, int((c >= often).sum()))
    tokens, mass = np.zeros(n_head + GROUPS + 1), np.ones(n_head + GROUPS + 1)
    at = n_head + groups["shape"].to_numpy()
    tokens[at] = groups["c"].to_numpy()
    mass[at] += groups["c"].to_numpy() + groups["v"].to_numpy()
    np.subtract.at(tokens, n_head + shape[:n_head], c[:n_head])
    np.subtract.at(mass, n_head + shape[:n_head], c[:n_head] + 1)
    tokens[:n_head] = c[:n_head]
    tokens[-1] = n_texts
    ranked = np.argsort(-tokens, kind="stable")
    unit_of = np.empty(len(tokens), np.int64)
    unit_of[ranked] = np.arange(len(tokens))
    unit = np.full(len(h), -1)
    unit[:n_head] = unit_of[:n_head]
    order = np.argsort(h)
    n = int(groups["c"].to_numpy().sum()) + n_texts
    v = int(groups["v"].to_numpy().sum()) + (n_texts > 0)
    return Vocabulary(h[order], c[order], unit[order], unit_of[n_head:-1], int(unit_of[-1]), tokens[ranked], mass[ranked]), n, v


def _averaged(texts: DataFrame, start: LogBilinear, words: Vocabulary, rounds: int = 1) -> LogBilinear:
    """Every partition trains from the same start; the mean of their parameters by tokens, from a grouped sum."""
    head = words.head()

    def run(batches):
        trainer = Trainer(start, head.unit_counts)
        held = list(batches) if rounds > 1 else batches
        for _ in range(rounds):
            for batch in held:
                for _, _, _, tokens, contexts, _ in head.units(batch.column(0)):
                    trainer.run(contexts, tokens)
        if trainer.tokens:
            for k, a in enumerate(trainer.model.arrays()):
                value = np.zeros((len(a), WIDTH), np.float64)
                value[:, : a.shape[1]] = a.astype(np.float64) * trainer.tokens
                rows = pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1, dtype=np.int32) * WIDTH), pa.array(value.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), k, np.int32)), pa.array(np.arange(len(a), dtype=np.int32)), pa.array(np.full(len(a), float(trainer.tokens))), rows], names=["kind", "row", "weight", "value"])

    sums = texts.select("text").mapInArrow(run, "kind int, row int, weight double, value array<double>").groupBy("kind", "row").agg(F.sum("weight").alias("weight"), *(F.sum(F.col("value")[i]).alias(f"v{i}") for i in range(WIDTH)))
    rows = sums.toArrow()  # a row for each parameter vector
    if not rows.num_rows:
        return start
    values = np.stack([rows[f"v{i}"].to_numpy() for i in range(WIDTH)], 1) / rows["weight"].to_numpy()[:, None]
    arrays = [a.copy() for a in start.arrays()]
    kind, row = rows["kind"].to_numpy(), rows["row"].to_numpy()
    for k, a in enumerate(arrays):
        a[row[kind == k]] = values[kind == k][:, : a.shape[1]]
    return LogBilinear.of(arrays)


def lm_scores(documents: DataFrame, training: Column, often: int = OFTEN) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for each row of ``documents(doc_id, text)``.

    ``training`` is the condition, on columns of ``documents``, of the rows that are learnt from.  Scores are log10
    probabilities of the whole text with its end; base_score is that of add-one smoothed single words.  Null and empty
    texts are one end token.  Without training rows every word is unknown and scores are those of the untrained model.
    Repeated rows count, and are scored, each on its own; an empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    learn = documents.where(training).select(text)
    counts = written(word_counts(learn), "words")
    n_texts = learn.select(F.lit(1)).count()
    words, n, v = _vocabulary(counts, n_texts, often=often)
    sample = bounded_sample(documents.where(training).select(F.xxhash64("doc_id").alias("h"), "doc_id", text), ["h", "doc_id", "text"], SAMPLE, SAMPLE_CHARS)
    model = _averaged(sample.coalesce(1), LogBilinear.start(words.unit_counts), words, rounds=3)
    model = _averaged(learn, model, words)
    shared = documents.sparkSession.sparkContext.broadcast((words, model))

    def run(batches):
        from pyspark import TaskContext

        words, model = shared.value
        number = TaskContext.get().partitionId() << 40
        log_mass = np.log(words.unit_mass)
        grouped = np.zeros(len(log_mass), bool)
        grouped[words.group_unit] = True
        log_counts = np.log(words.count + 1.0)
        for batch in batches:
            lo = 0
            for hashes, at, first, tokens, contexts, token_first in words.units(batch.column(1)):
                k = len(first) - 1
                logs = np.concatenate([[0], np.cumsum(model.log_probabilities(contexts, tokens) - log_mass[tokens])])
                unit = np.delete(tokens, token_first[1:] - 1)
                found = at >= 0
                log_count = np.where(found, log_counts[at], 0) if len(log_counts) else np.zeros(len(hashes))
                tail = np.concatenate([[0], np.cumsum(log_count * grouped[unit])])
                whole = np.concatenate([[0], np.cumsum(log_count)])
                known = np.concatenate([[0], np.cumsum(found)])
                span = lambda s, f: s[f[1:]] - s[f[:-1]]
                rare_at = np.concatenate([[0], np.cumsum(~found)])[first].astype(np.int32)
                rare = pa.ListArray.from_arrays(pa.array(rare_at), pa.array(hashes[~found].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number + np.arange(k)), batch.column(0).slice(lo, k), pa.array(np.diff(token_first)), pa.array(span(known, first)), pa.array(span(logs, token_first) + span(tail, first)), pa.array(span(whole, first)), rare],
                    names=["row", "doc_id", "n_tokens", "known", "model", "base", "rare"],
                )
                lo, number = lo + k, number + k

    scored = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(run, "row long, doc_id long, n_tokens long, known long, model double, base double, rare array<long>")
    scored = written(scored, "scored")
    rare = scored.select("row", F.explode("rare").alias("h")).join(counts.select("h", "c"), "h")
    more = rare.groupBy("row").agg(F.count("*").alias("more"), F.sum(F.log(F.col("c") + 1.0)).alias("log_count"))
    all_of = scored.select("row", "doc_id", "n_tokens", "known", "model", "base").join(more, "row", "left")
    extra, ln10 = F.coalesce("log_count", F.lit(0.0)), float(np.log(10.0))
    ends = float(np.log(n_texts + 1.0))
    base = (F.col("base") + extra + ends - F.col("n_tokens") * float(np.log(n + v + 1.0))) / ln10
    return all_of.select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0)) + int(n_texts > 0)).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), ((F.col("model") + extra) / ln10).alias("score")
    )
