"""Token-id output: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

Texts are encoded once, with a public tokenizer whose path is a parameter.  Documents are dealt out to shards by ranges
of (doc_id, hash of the text), and each task writes its shards as raw files in ascending order and counts their ids.
Ids are then renumbered by falling frequency over all shards (ties: smaller id first), so that the common ones take one
byte, and each raw file is written again with these ranks.

A finished folder can be read without anything else.  ``ids.table`` holds the id of every rank (little-endian uint32).  A
shard file is a header of four little-endian 64-bit numbers (magic, ids in all shards before it, documents, ids) and a
run of blocks.  A block holds whole documents: a header of five such numbers (documents, ids, control bytes, data bytes,
magic), the doc_ids (int64), one byte each for "has a doc_id", the ids per document (int64), the control bytes (two bits
per id: its bytes less one, four ids to a byte, the first in the low bits) and the data bytes (each rank in 1 to 4
little-endian bytes).  Decoding looks the four lengths of each control byte up in a table of 256 rows.

A file is written under a name of its own and then moved, so that a repeated task leaves the same files.  Output goes to
any folder that pyarrow opens by its URI.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusproof.llm.native import row_key
from corpusproof.llm.scratch import new_dir, written
from corpusproof.llm.textbytes import Chunk, chunks

MAGIC = 0x314B4C42
#: Ids after which a block is closed.
BLOCK = 1 << 18
#: Pieces kept with their ids by a Python worker.
CACHE = 700_000

# fixed values: how the public word tokenizer normalises and cuts texts; its pieces may be encoded one by one
WORD_TOKENIZER = {
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    "pattern": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
}


# ---- coding ----

_LENGTHS = np.array([[((c >> (2 * k)) & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)


def encode_ranks(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(control, data) of unsigned 32-bit values."""
    ranks = ranks.astype(np.uint32)
    code = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    four = np.zeros((len(ranks) + 3) // 4 * 4, np.uint8)
    four[: len(code)] = code
    four = four.reshape(-1, 4)
    control = four[:, 0] | (four[:, 1] << 2) | (four[:, 2] << 4) | (four[:, 3] << 6)
    size = code.astype(np.int64) + 1
    end = np.cumsum(size)
    at = end - size
    data = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
    data[at] = ranks & 0xFF
    for k in (1, 2, 3):
        more = np.flatnonzero(code >= k)
        if len(more):
            data[at[more] + k] = (ranks[more] >> (8 * k)) & 0xFF
    return control.astype(np.uint8), data


def decode_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The n values that encode_ranks has coded."""
    size = _LENGTHS[control].reshape(-1)[:n]
    end = np.cumsum(size, dtype=np.int64)
    at = end - size
    ranks = data[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        if len(more):
            ranks[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


# ---- tokenizing ----

_KIND = np.zeros(256, np.uint8)  # 1 letter, 2 punctuation, 3 digit; 0: never cut beside it
_KIND[list(range(97, 123))] = 1
_KIND[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = 2
_KIND[list(range(48, 58))] = 3
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class TextEncoder:
    """Ids of whole texts, through a cache from pieces of text to their ids.

    For the public word tokenizer a piece is a run of letters, digits or punctuation between white space: its own
    normaliser and pattern never join what is cut here (only ASCII characters and the Latin letters U+00C0 to U+00FF are
    cut apart, never beside an apostrophe or any other character).  Letters alone go straight to the tokenizer's model,
    all else through its whole pipeline.  Texts that hold the string of an added token, and all texts of any other
    tokenizer, are encoded whole, so that such strings get the ids that the library gives them.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        own = json.loads(self.tokenizer.to_str())
        split = ((own.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        self.by_piece = (own.get("normalizer") or {}).get("normalizers") == WORD_TOKENIZER["normalizers"] and split.get("pattern") == {"Regex": WORD_TOKENIZER["pattern"]} and own["model"]["type"] == "BPE" and not own.get("post_processor")
        self.added = [t["content"].encode() for t in own.get("added_tokens") or []]
        self.by_piece = self.by_piece and not any(t["normalized"] for t in own.get("added_tokens") or [])
        self.size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.cache: dict[bytes, bytes] = {}
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: level.pre_tokenize_str(chr(c))[0][0] for c in [*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100)]}
        self.alphabet = {chr(c) for c in self.letters}

    def _ids(self, piece: bytes) -> bytes:
        text = piece.decode()
        low = text.lower()
        if self.alphabet.issuperset(low):
            ids = [t.id for t in self.tokenizer.model.tokenize(low.translate(self.letters))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        found = np.array(ids, self.kind).tobytes()
        if len(self.cache) < CACHE:
            self.cache[piece] = found
        return found

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, text_first) for each chunk of texts."""
        for chunk in chunks(texts):
            if not self.by_piece:
                whole = [chunk.data[a:b].tobytes().decode() for a, b in zip(chunk.at[:-1], chunk.at[1:], strict=True)]
                ids = [np.array(x.ids, self.kind) for x in self.tokenizer.encode_batch(whole, add_special_tokens=False)]
                yield np.concatenate(ids), np.concatenate([[0], np.cumsum([len(x) for x in ids])])
                continue
            data = _LOWER[chunk.data]
            kind = _KIND[data]
            lead = np.flatnonzero(data[:-1] == 0xC3)  # two-byte letters U+00C0 to U+00FF, but for two signs
            lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
            kind[lead], kind[lead + 1] = 1, 1
            cut = np.zeros(len(data) + 1, bool)
            cut[1:-1] = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
            cut[chunk.at] = True
            spread = np.full(len(data) + int(cut.sum()), 32, np.uint8)
            spread[np.arange(len(data)) + np.cumsum(cut[:-1])] = data
            pieces = spread.tobytes().split()
            have = self.cache.get
            coded = [have(p) or self._ids(p) for p in pieces]
            blank = (data == 32) | ((data >= 9) & (data <= 13))
            begins = ~blank
            begins[1:] &= blank[:-1] | cut[1:-1]
            count = np.concatenate([[0], np.cumsum(begins)])[chunk.at]
            ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)))]) // self.kind.itemsize
            yield self._with_added(chunk, np.frombuffer(b"".join(coded), self.kind), ends[count])

    def _with_added(self, chunk: Chunk, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first) in which texts that hold an added token's string have the ids of the whole text."""
        raw = chunk.data.tobytes()
        found = {m.start() for token in self.added for m in re.finditer(re.escape(token), raw)}
        if not found:
            return ids, first
        whole = set(np.searchsorted(chunk.at, sorted(found), "right") - 1)
        parts = [np.array(self.tokenizer.encode(raw[chunk.at[k] : chunk.at[k + 1]].decode(), add_special_tokens=False).ids, self.kind) if k in whole else ids[first[k] : first[k + 1]] for k in range(chunk.n)]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


_encoders: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """One encoder for each tokenizer and Python worker."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


# ---- Spark ----


@dataclass
class TokenFiles:
    """A written folder."""

    spark: SparkSession
    folder: str

    def read(self, with_ids: bool = False) -> DataFrame:
        """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, decoded from the files alone."""
        schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
        folder = self.folder

        def run(batches):
            id_of = id_table(folder)
            for batch in batches:
                for file in batch.column(0).to_pylist():
                    start = None
                    for head, doc_ids, count, ranks in read_blocks(file):
                        start = head[1] if start is None else start
                        ids = id_of[ranks]
                        first = np.concatenate([[0], np.cumsum(count)])
                        crc = [zlib.crc32(ids[a:b].data) for a, b in zip(first[:-1], first[1:], strict=True)]
                        columns = [doc_ids, pa.array(start + first[:-1]), pa.array(count), pa.array(crc, pa.int64())]
                        if with_ids:
                            columns.append(pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids.astype(np.int64))))
                        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])
                        start += int(first[-1])

        return _each(self.spark, shard_files(folder)).select("file").mapInArrow(run, schema)


def _each(spark: SparkSession, files: list[str]) -> DataFrame:
    """(number, file), each in a partition of its own."""
    return spark.createDataFrame(list(enumerate(files)), "number int, file string").repartitionById(max(1, len(files)), "number")


def shard_files(folder: str) -> list[str]:
    """The URIs of a folder's shard files, in order."""
    from pyarrow import fs

    store, top = fs.FileSystem.from_uri(folder)
    found = store.get_file_info(fs.FileSelector(top, allow_not_found=True))
    return sorted(f"{folder}/{f.base_name}" for f in found if f.base_name.startswith("shard-"))


def id_table(folder: str) -> np.ndarray:
    """The id of each rank."""
    from pyarrow import fs

    store, top = fs.FileSystem.from_uri(folder)
    with store.open_input_stream(f"{top}/ids.table") as f:
        return np.frombuffer(f.read(), "<u4")


def read_blocks(uri: str) -> Iterator[tuple[tuple[int, ...], pa.Array, np.ndarray, np.ndarray]]:
    """(file header, doc_ids, ids per document, ranks) of each block of a shard file."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_stream(path) as f:
        header = tuple(np.frombuffer(f.read(32), "<i8").tolist())
        if len(header) != 4 or header[0] != MAGIC:
            raise ValueError(f"{uri} is no token file")
        while head := f.read(40):
            n_docs, n_ids, n_control, n_data, magic = np.frombuffer(head, "<i8").tolist()
            if magic != MAGIC:
                raise ValueError(f"{uri} is no token file")
            ids = np.frombuffer(f.read(8 * n_docs), "<i8")
            known = np.frombuffer(f.read(n_docs), np.uint8)
            count = np.frombuffer(f.read(8 * n_docs), "<i8")
            control = np.frombuffer(f.read(n_control), np.uint8)
            data = np.frombuffer(f.read(n_data), np.uint8)
            yield header, pa.array(ids, pa.int64(), mask=known == 0), count, decode_ranks(control, data, n_ids)


class _Writer:
    """Writes one shard file block by block."""

    def __init__(self, folder: str, shard: int, header: tuple[int, int, int] = (0, 0, 0)):
        from pyarrow import fs

        self.store, top = fs.FileSystem.from_uri(folder)
        self.store.create_dir(top, recursive=True)
        self.shard, self.name = shard, f"{folder}/shard-{shard:08d}.ids"
        self.path, self.part = f"{top}/shard-{shard:08d}.ids", f"{top}/.part-{shard:08d}-{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.part)
        self.out.write(np.array([MAGIC, *header], "<i8").tobytes())
        self.docs: list[int | None] = []
        self.coded: list[np.ndarray] = []
        self.held = self.n_docs = self.n_ids = 0

    def add(self, doc_id: int | None, ranks: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.coded.append(ranks)
        self.held += len(ranks)
        if self.held >= BLOCK:
            self.flush()

    def flush(self) -> None:
        if self.docs:
            self.block([x or 0 for x in self.docs], [x is not None for x in self.docs], [len(x) for x in self.coded], np.concatenate(self.coded))
            self.docs, self.coded, self.held = [], [], 0

    def block(self, doc_ids, known, count, ranks: np.ndarray) -> None:
        control, data = encode_ranks(ranks)
        self.out.write(np.array([len(doc_ids), len(ranks), len(control), len(data), MAGIC], "<i8").tobytes())
        for column, kind in ((doc_ids, "<i8"), (known, np.uint8), (count, "<i8")):
            self.out.write(np.asarray(column, kind).tobytes())
        self.out.write(control.tobytes())
        self.out.write(data.tobytes())
        self.n_docs, self.n_ids = self.n_docs + len(doc_ids), self.n_ids + len(ranks)

    def close(self) -> None:
        self.flush()
        self.out.close()
        self.store.move(self.part, self.path)


class _Shards:
    """Which shard a row is in: equal shares of the rows by ranges of (key, tie).

    ``cuts`` are quantiles of key; one that occurs r times is the key of many rows, whose ties are cut into r ranges.
    """

    def __init__(self, cuts: list[int]):
        self.keys, self.times = np.unique(np.array(cuts, np.int64), return_counts=True)
        self.before = np.concatenate([[0], np.cumsum(self.times)])
        self.n = len(cuts) + 1

    def of(self, key: np.ndarray, tie: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, key, "left")
        shard = self.before[at]
        if len(self.keys):
            own = np.minimum(at, len(self.keys) - 1)
            part = ((tie.astype(np.int64) >> 32) + (1 << 31)) * self.times[own] >> 32
            shard = np.where(self.keys[own] == key, shard + 1 + part, shard)
        return np.minimum(shard, self.n - 1).astype(np.int32)


def write_token_files(documents: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 2) -> TokenFiles:
    """Encode ``documents(doc_id, text)`` and write them as shard files in ascending doc_id order.

    ``end_id`` is appended to every document; null and empty texts have it alone.  Rows with a null doc_id come first;
    rows that repeat a doc_id follow one another, ordered by a hash of their texts.  Other columns are ignored; an empty
    table writes no shard file.  There are as many shards as the input has partitions, of like numbers of documents.
    """
    spark = documents.sparkSession
    folder = folder or new_dir(spark, "tokens")
    raw = new_dir(spark, "raw-tokens")
    rows = row_key(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    shards = max(1, rows.rdd.getNumPartitions())
    cuts = rows.select(F.percentile_approx("key", [k / shards for k in range(1, shards)] or [0.5], max(10_000, 10 * shards)).alias("cuts")).first()["cuts"] or []
    place = _Shards(cuts if shards > 1 else [])

    def encoded(batches):
        own = encoder(tokenizer)
        end = np.array([end_id], "<u4").astype(own.kind).tobytes()
        for batch in batches:
            shard = place.of(batch.column(1).to_numpy(), batch.column(2).to_numpy())
            lo = 0
            for ids, first in own.encode(batch.column(3)):
                held = [ids[a:b].tobytes() + end for a, b in zip(first[:-1], first[1:], strict=True)]
                hi = lo + len(held)
                yield pa.RecordBatch.from_arrays([pa.array(shard[lo:hi]), *(batch.column(k).slice(lo, hi - lo) for k in range(3)), pa.array(held, pa.binary())], names=["shard", "doc_id", "key", "tie", "ids"])
                lo = hi

    def write(batches):
        own = encoder(tokenizer)
        out, total = None, np.zeros(max(own.size, end_id + 1), np.int64)
        done = []

        def close():
            out.close()
            found = np.flatnonzero(total)
            done.append((out.shard, out.name, out.n_docs, out.n_ids, [{"id": i, "n": n} for i, n in zip(found.tolist(), total[found].tolist(), strict=True)]))
            total[:] = 0

        for batch in batches:
            for shard, doc_id, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if out is None or out.shard != shard:
                    if out:
                        close()
                    out = _Writer(raw, shard)
                ids = np.frombuffer(held.as_buffer(), own.kind)
                out.add(doc_id, ids)
                np.add.at(total, ids, 1)
        if out:
            close()
        columns = list(zip(*done, strict=True)) or [[], [], [], [], []]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.struct([("id", pa.int64()), ("n", pa.int64())]))]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["shard", "file", "documents", "ids", "found"])

    coded = rows.select("doc_id", "key", "tie", "text").mapInArrow(encoded, "shard int, doc_id long, key long, tie long, ids binary").repartitionById(place.n, "shard")
    ordered = coded.sortWithinPartitions("shard", "key", "tie", "ids").select("shard", "doc_id", "ids")
    made = written(ordered.mapInArrow(write, "shard int, file string, documents long, ids long, found array<struct<id:long,n:long>>"), "raw-shards")
    counts = made.select(F.explode("found").alias("f")).groupBy("f.id").agg(F.sum("f.n").alias("n")).toArrow()  # a row for each id of the tokenizer
    files = sorted(tuple(r) for r in made.select("shard", "file", "documents", "ids").collect())  # a row for each shard

    total = np.zeros(max(encoder(tokenizer).size, end_id + 1), np.int64)
    total[counts["id"].to_numpy()] = counts["n"].to_numpy()
    id_of = np.lexsort((np.arange(len(total)), -total)).astype("<u4")
    rank_of = np.empty(len(id_of), np.uint32)
    rank_of[id_of] = np.arange(len(id_of))
    _put(folder, "ids.table", id_of.tobytes())
    start = np.concatenate([[0], np.cumsum([f[3] for f in files])]).astype(np.int64).tolist()
    heads = [(shard, start[k], n_docs, n_ids) for k, (shard, _, n_docs, n_ids) in enumerate(files)]

    def ranked(batches):
        for batch in batches:
            for number, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard, *header = heads[number]
                out = _Writer(folder, shard, tuple(header))
                for _, doc_ids, count, ids in read_blocks(file):
                    out.block(doc_ids.fill_null(0), doc_ids.is_valid(), count, rank_of[ids])
                out.close()
                yield pa.RecordBatch.from_arrays([pa.array([out.n_ids])], names=["n"])

    if _each(spark, [f[1] for f in files]).mapInArrow(ranked, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"] != start[-1]:
        raise RuntimeError(f"{folder} lacks ids")
    _drop(raw)
    return TokenFiles(spark, folder)


def _put(folder: str, name: str, data: bytes) -> None:
    from pyarrow import fs

    store, top = fs.FileSystem.from_uri(folder)
    store.create_dir(top, recursive=True)
    with store.open_output_stream(f"{top}/{name}") as f:
        f.write(data)


def _drop(folder: str) -> None:
    from pyarrow import fs

    store, top = fs.FileSystem.from_uri(folder)
    if store.get_file_info(top).type != fs.FileType.NotFound:
        store.delete_dir(top)
