"""Best-fit packing of documents into sequences of a fixed number of tokens.

Texts are encoded with a public tokenizer and cut where a document is longer than a sequence.  How many pieces there are
of each length, at most as many numbers as a sequence has tokens, is all that the plan needs, however large the corpus:

1. the configuration linear program over this histogram (a configuration is a multiset of lengths that fits a sequence;
   take as few as cover all pieces) is solved by multiplicative weights.  Each length has a weight that falls as its
   pieces are covered.  A knapsack dynamic program prices configurations: one table gives the most valuable configuration
   of all and, for every length, the most valuable one that holds it.  All that come close to the best are raised together,
   in proportion to the pieces of their lengths;
2. the fractional numbers are rounded so that running sums stay true, as far as pieces are there, and pieces left over go
   best-fit, the longest first;
3. every piece has a rank among those of its length: a number within its task, and the tasks' numbers added up before it.
   Rank and plan give its sequence and its place there by arithmetic, so no piece is compared with any other.

The weights also give a lower bound on the number of sequences, ``Packing.lower_bound``.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from corpusproof.llm.native import small
from corpusproof.llm.scratch import written
from corpusproof.llm.textbytes import chunks
from corpusproof.llm.token_files import TextEncoder

#: Rounds of multiplicative weights, how much of a length's pieces one configuration may cover at a time, and how fast weights fall.
ROUNDS, STEP, RATE = 400, 0.1, 3.0
#: Configurations are raised that are worth less than the best by this share at most.
NEAR = 0.02
#: How much more a piece as long as a sequence is worth for each token, at first, than the shortest.
BIAS = 0.3
#: Pieces that go best-fit at most; of more that are left over, another program takes most.
LEFT = 50_000
#: Bytes of ids in one batch of pieces.
BATCH = 8 << 20


# ---- tokens ----

# fixed values: how the byte-level tokenizer cuts texts
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_KIND = np.zeros(256, np.uint8)  # 1 letter, 2 punctuation, 3 digit; 0: white space and all else, where only the rules of _cuts hold
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = 2
_KIND[list(range(48, 58))] = 3
_SEPARATOR = 0xFF  # in no UTF-8 text


class ByteEncoder(TextEncoder):
    """Ids of whole texts under the byte-level tokenizer, through a cache from pieces of text to their ids.

    Pieces are cut where the tokenizer's own pattern always cuts: between a letter, a digit and a punctuation mark (not
    after an apostrophe, which can begin a contraction), before a single space between two such characters, and around a
    single line feed between them.  Other tokenizers, and texts with an added token's string, are encoded whole.
    """

    def __init__(self, path: str):
        super().__init__(path)
        own = json.loads(self.tokenizer.to_str())
        added = own.get("added_tokens") or []
        self.by_piece = own.get("pre_tokenizer") == BYTE_LEVEL and not own.get("normalizer") and not own.get("post_processor") and own["model"]["type"] == "BPE" and not any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
        if self.by_piece:
            from tokenizers import pre_tokenizers

            level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.bytes = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(32, 127)}
            self.plain = frozenset(chr(c) for c in (*range(65, 91), *range(97, 123)))

    def _ids(self, piece: bytes) -> bytes:
        text = piece.decode()
        if self.plain.issuperset(text[1:]) and (text[0] == " " or text[0] in self.plain):
            ids = [t.id for t in self.tokenizer.model.tokenize(text.translate(self.bytes))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        found = np.array(ids, self.kind).tobytes()
        if len(self.cache) < 700_000 and len(piece) <= 64:
            self.cache[piece] = found
        return found

    @staticmethod
    def _cuts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether a piece begins at each byte."""
        kind = _KIND[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)  # two-byte letters U+00C0 to U+00FF, but for two signs
        lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
        kind[lead], kind[lead + 1] = 1, 1
        known = kind > 0
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = known[1:] & known[:-1] & (kind[1:] != kind[:-1]) & ((data[:-1] != 39) | (kind[1:] != 1))
        single = known[:-2] & known[2:] & ((data[1:-1] == 32) | (data[1:-1] == 10))
        inside = np.zeros(len(data) + 1, bool)
        inside[at] = True  # where a text begins, what stands before is no neighbour
        single &= ~inside[1:-2] & ~inside[2:-1]
        places = np.flatnonzero(single) + 1
        cut[places] = True
        cut[places[data[places] == 10] + 1] = True
        cut[at] = True
        return cut[:-1]

    def encode(self, texts: pa.Array):
        """(ids, text_first) for each chunk of texts."""
        if not self.by_piece:
            yield from super().encode(texts)
            return
        for chunk in chunks(texts):
            if not len(chunk.data):
                yield np.zeros(0, self.kind), np.zeros(chunk.n + 1, np.int64)
                continue
            starts = np.flatnonzero(self._cuts(chunk.data, chunk.at))
            spread = np.full(len(chunk.data) + len(starts), _SEPARATOR, np.uint8)
            shift = np.zeros(len(chunk.data), np.int64)
            shift[starts] = 1
            spread[np.arange(len(chunk.data)) + np.cumsum(shift)] = chunk.data
            pieces = spread.tobytes().split(bytes([_SEPARATOR]))[1:]
            have = self.cache.get
            coded = [have(p) or self._ids(p) for p in pieces]
            ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)))]) // self.kind.itemsize
            first = ends[np.searchsorted(starts, chunk.at)]
            yield self._with_added(chunk, np.frombuffer(b"".join(coded), self.kind), first)


_encoders: dict[str, ByteEncoder] = {}


def encoder(path: str) -> ByteEncoder:
    """One encoder for each tokenizer and Python worker."""
    if path not in _encoders:
        _encoders[path] = ByteEncoder(path)
    return _encoders[path]


def token_pieces(documents: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """(doc_id, piece, start, length, ids, part, number): pieces of at most ``capacity`` tokens of every document.

    ids are little-endian unsigned 32-bit; number counts the pieces of one length in the task ``part``.
    """

    def run(batches):
        own = encoder(tokenizer)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            lo = 0
            for ids, first in own.encode(batch.column(1)):
                n = np.diff(first) + 1
                wide = np.full(len(ids) + len(n), end_id, "<u4")
                spot = np.arange(len(ids)) + np.repeat(np.arange(len(n)), np.diff(first))
                wide[spot] = ids
                pieces = -(-n // capacity)
                text = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = n - (pieces - 1) * capacity  # the first piece may be shorter
                start = np.where(piece == 0, 0, head[text] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[text], capacity)
                order = np.argsort(length, kind="stable")
                ranked = length[order]
                fresh = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
                number = np.empty(len(text), np.int64)
                number[order] = np.arange(len(text)) - np.repeat(fresh, np.diff(np.append(fresh, len(text)))) + seen[ranked]
                seen += np.bincount(length, minlength=capacity + 1)
                at = np.append((np.cumsum(n) - n)[text] + start, len(wide)) * 4
                doc_id = batch.column(0).slice(lo, len(n)).take(pa.array(text))
                lo += len(n)
                for a in range(0, len(text), max(1, BATCH // (4 * capacity))):
                    b = min(len(text), a + max(1, BATCH // (4 * capacity)))
                    binary = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((at[a : b + 1] - at[a]).astype(np.int32)), pa.py_buffer(wide[at[a] // 4 : at[b] // 4])])
                    yield pa.RecordBatch.from_arrays([doc_id.slice(a, b - a), pa.array(piece[a:b], pa.int32()), pa.array(start[a:b]), pa.array(length[a:b]), binary, pa.array(np.full(b - a, part, np.int32)), pa.array(number[a:b])], names=["doc_id", "piece", "start", "length", "ids", "part", "number"])

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary, part int, number long")


# ---- the plan ----


def knapsack(value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(best, item): the most that lengths, repeated at will, are worth within each capacity, and one length of it (0: none).

    ``value[l]`` is what a piece of length l is worth, -inf where there is none.
    """
    best, item = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        with_item = value[1 : c + 1] + best[c - 1 :: -1]
        k = int(with_item.argmax())
        if with_item[k] > best[c - 1]:
            best[c], item[c] = with_item[k], k + 1
        else:
            best[c], item[c] = best[c - 1], -1  # a token of the capacity stays free
    return best, item


def _spelled_out(item: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """A row of counts by length for each given length: itself and the best that goes beside it."""
    rows = np.zeros((len(lengths), capacity + 1), np.int32)
    rows[np.arange(len(lengths)), lengths] = 1
    free = capacity - lengths
    going = np.flatnonzero(free > 0)
    while len(going):
        taken = item[free[going]]
        real = taken > 0
        np.add.at(rows, (going[real], taken[real]), 1)
        free[going] -= np.abs(taken)
        going = going[free[going] > 0]
    return rows


def configurations(count: np.ndarray, capacity: int, rounds: int = ROUNDS, step: float = STEP, rate: float = RATE) -> tuple[dict[tuple[tuple[int, int], ...], float], float]:
    """(number of times by configuration, lower bound) of the linear program, from ``count[l]`` pieces of each length.

    A configuration is a tuple of (length, how many), the longest first.
    """
    lengths = np.flatnonzero(count)
    cover = np.zeros(capacity + 1)
    taken: dict[tuple[tuple[int, int], ...], float] = {}
    bound = float((lengths * count[lengths]).sum()) / capacity
    while rounds and len(lengths) and cover[lengths].min() < 1:
        rounds -= 1
        value = np.full(capacity + 1, -np.inf)
        # of equal worth, one long piece is taken before many short ones, which fill better what is left in the end
        value[lengths] = lengths * (1 + BIAS * lengths / capacity) * np.exp(-rate * (cover[lengths] - cover[lengths].min()))
        best, item = knapsack(value, capacity)
        bound = max(bound, float((value[lengths] * count[lengths]).sum() / best[capacity]))
        worth = value[lengths] + best[capacity - lengths]
        least = (1 - NEAR) * best[capacity]
        good = lengths[worth >= least]
        good = good[np.argsort(-worth[worth >= least], kind="stable")]
        now = value.tolist()
        for row in _spelled_out(item, good, capacity):
            at = np.flatnonzero(row)[::-1]
            key = tuple(zip(at.tolist(), row[at].tolist(), strict=True))
            if sum(now[a] * b for a, b in key) < least:
                continue  # its lengths have been raised since they were priced
            times = step * min(count[a] / b for a, b in key)
            taken[key] = taken.get(key, 0.0) + times
            for a, b in key:
                gain = times * b / count[a]
                cover[a] += gain
                now[a] *= math.exp(-rate * gain)
    return taken, bound


Configurations = dict[tuple[tuple[int, int], ...], int]


def rounded(taken: dict[tuple[tuple[int, int], ...], float], left: np.ndarray, capacity: int) -> Configurations:
    """Whole numbers of times by configuration, for as many pieces as there are; ``left`` loses those."""
    size = sum(x * sum(a * b for a, b in c) for c, x in taken.items())
    scale = float((left * np.arange(capacity + 1)).sum()) / size if size else 0.0  # the rounds cover some lengths more than once
    plan: Configurations = {}
    carried = 0.0
    for c in sorted(taken, reverse=True):
        carried += taken[c] * scale
        times = min(int(carried), *(int(left[a]) // b for a, b in c))
        carried = min(carried - times, 1.0)
        if times:
            plan[c] = times
            for a, b in c:
                left[a] -= times * b
    return plan


def planned(count: np.ndarray, capacity: int) -> tuple[Configurations, float]:
    """(number of sequences by configuration, lower bound on the number of all) for ``count[l]`` pieces of each length.

    Every piece is used once.  Time and size depend on the number of lengths, and on pieces by a logarithm only.
    """
    left = count.astype(np.int64).copy()
    plan: Configurations = {}
    bound = float(left[capacity])
    if left[capacity]:
        plan[((capacity, 1),)] = int(left[capacity])
        left[capacity] = 0
    first = True
    while first or left.sum() > LEFT:
        before = left.sum()
        taken, lower = configurations(left, capacity)
        bound, first = bound + lower * first, False
        for c, times in rounded(taken, left, capacity).items():
            plan[c] = plan.get(c, 0) + times
        if left.sum() > 0.9 * before:
            break
    for c, times in _best_fit(left, capacity).items():
        plan[c] = plan.get(c, 0) + times
    return plan, bound


def _best_fit(left: np.ndarray, capacity: int) -> Configurations:
    """Configurations of the pieces left over: the longest first, each into the open sequence with the least room for it."""
    room: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r: there is a sequence with room r
    for length in np.flatnonzero(left)[::-1].tolist():
        for _ in range(int(left[length])):
            fits = open_rooms >> length
            r = length + (fits & -fits).bit_length() - 1 if fits else capacity
            held = room[r].pop() if fits else []
            if fits and not room[r]:
                open_rooms ^= 1 << r
            held.append(length)
            room[r - length].append(held)
            open_rooms |= 1 << (r - length)
    plan: Configurations = {}
    for rooms in room:
        for held in rooms:
            lengths, times = np.unique(held, return_counts=True)
            key = tuple(zip(lengths[::-1].tolist(), times[::-1].tolist(), strict=True))
            plan[key] = plan.get(key, 0) + 1
    return plan


class Places:
    """Sequence and offset of a piece from its length and its rank among the pieces of that length."""

    def __init__(self, plan: Configurations):
        rows = []
        sequence = 0
        used: dict[int, int] = {}
        for c in sorted(plan, reverse=True):
            offset = 0
            for length, n in c:
                rows.append((length, used.get(length, 0), n, sequence, offset))
                used[length] = used.get(length, 0) + n * plan[c]
                offset += length * n
            sequence += plan[c]
        self.sequences = sequence
        self.most = max(used.values(), default=0) + 1
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.length, self.base, self.n, self.sequence, self.offset = table.T
        self.key = self.length * self.most + self.base

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence_id, offset) of each piece."""
        row = np.searchsorted(self.key, length * self.most + rank, "right") - 1
        nth = rank - self.base[row]
        return self.sequence[row] + nth // self.n[row], self.offset[row] + nth % self.n[row] * length


# ---- Spark ----


@dataclass
class Packing:
    """Packed documents: their pieces, the plan, and a bound that no packing can go below."""

    cut: DataFrame
    offsets: DataFrame
    places: Places
    lower_bound: int

    @property
    def n_sequences(self) -> int:
        return self.places.sequences

    def pieces(self, with_ids: bool = True) -> DataFrame:
        """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]): ids are little-endian unsigned 32-bit numbers."""
        places = self.places
        kept = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
        kinds = {"piece": "int", "ids": "binary"}

        def place(batches):
            for batch in batches:
                sequence, offset = places.of(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

        ranked = self.cut.join(small(self.offsets, 2_000_000), ["length", "part"]).select((F.col("number") + F.col("before")).alias("rank"), *kept)
        return ranked.mapInArrow(place, ", ".join(f"{c} {kinds.get(c, 'long')}" for c in [*kept, "sequence_id", "offset"]))

    def sequences(self) -> DataFrame:
        """(sequence_id, ids, documents): the ids of a sequence's pieces in order, and the offset, doc_id, start and length of each."""
        spans = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))  # of at most so many as a sequence has tokens
        held = self.pieces().groupBy("sequence_id").agg(spans.alias("spans"))
        ids = F.aggregate("spans", F.lit(b"").cast("binary"), lambda all_ids, s: F.concat(all_ids, s["ids"]))
        return held.select("sequence_id", ids.alias("ids"), F.transform("spans", lambda s: s.dropFields("ids")).alias("documents"))


def packed(documents: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> Packing:
    """Pack ``documents(doc_id, text)`` into sequences of at most ``capacity`` tokens.

    Every document is the ids of its text and ``end_id``; null and empty texts have that alone.  Longer ones are cut into
    pieces of ``capacity``, of which the first may be shorter.  Null doc_ids stay null, and rows that repeat a doc_id are
    documents of their own.  Other columns are ignored; an empty table has no pieces and no sequences.
    """
    cut = written(token_pieces(documents, tokenizer, capacity, end_id).withColumn("ids_crc32", F.crc32("ids")), "pieces")
    by_task = written(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    count = np.zeros(capacity + 1, np.int64)
    for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row for each length
        count[r["length"]] = r["n"]
    plan, bound = planned(count, capacity)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    offsets = by_task.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return Packing(cut, written(offsets, "piece-offsets"), Places(plan), math.ceil(bound - 1e-6))
