import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusproof.llm.token_files import TextEncoder, TokenFiles, _Shards, decode_ranks, encode_ranks, id_table, write_token_files

public = pytest.importorskip("public_tokenizers")


@given(st.lists(st.one_of(st.integers(0, 2**32 - 1), st.sampled_from([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24])), max_size=40))
def test_coding_round_trip(values):
    ranks = np.array(values, np.uint32)
    assert np.array_equal(decode_ranks(*encode_ranks(ranks), len(ranks)), ranks)


@pytest.fixture(scope="module")
def own():
    return TextEncoder(public.path("word_bpe_49k.json"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abzAZ éÉßñ×÷'st.,!0129\n\t|&<>İKΣς́\xa0“”_-"), st.characters(codec="utf-8")), max_size=30), max_size=4))
def test_pieces_give_the_ids_of_whole_texts(own, texts):
    assert own.by_piece
    want = [own.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    got = [ids[a:b].tolist() for ids, first in own.encode(pa.array(texts, pa.string())) for a, b in zip(first[:-1], first[1:], strict=True)]
    assert got == want


def test_other_tokenizers_encode_whole_texts():
    other = TextEncoder(public.path("byte_bpe_50k.json"))
    assert not other.by_piece
    ((ids, first),) = other.encode(pa.array(["Hello there", None, ""]))
    assert ids.tolist() == other.tokenizer.encode("Hello there", add_special_tokens=False).ids and first.tolist() == [0, len(ids), len(ids), len(ids)]


def test_files_give_every_document_back(spark, awkward, nothing, own):
    files = write_token_files(awkward.repartition(3), public.path("word_bpe_49k.json"))
    got = files.read(with_ids=True).collect()
    rows = [(r.doc_id, own.tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in awkward.collect()]
    at = lambda d: -1 if d is None else d
    got.sort(key=lambda r: r.start)
    assert [at(r.doc_id) for r in got] == sorted(at(d) for d, _ in rows)
    assert sorted((at(r.doc_id), r.ids) for r in got) == sorted((at(d), ids) for d, ids in rows)
    start = 0
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    id_of = id_table(files.folder)
    counts = np.bincount([i for _, ids in rows for i in ids], minlength=len(id_of))
    assert (np.diff(counts[id_of]) <= 0).all()
    again = TokenFiles(spark, files.folder).read(with_ids=True).collect()  # by the folder alone
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert write_token_files(nothing, public.path("word_bpe_49k.json")).read().count() == 0


def test_added_tokens_get_the_ids_of_the_library(own):
    texts = ["a<|endoftext|>b", "<|EndOfText|> <|endof text|>", "x <|startoftext|><|endoftext|>", "plain", "<|", None]
    ((ids, first),) = own.encode(pa.array(texts, pa.string()))
    want = [own.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == want
    assert 49407 in want[0] and 49407 not in want[1] and want[2][1] == 49406


def test_a_hot_key_is_dealt_out_by_its_texts_in_order():
    draw = np.random.RandomState(3)
    key = np.where(draw.random_sample(20_000) < 0.4, 7, draw.randint(-50, 50, 20_000))
    tie = draw.randint(-(2**63), 2**63 - 1, 20_000, np.int64)
    cuts = np.quantile(key, [k / 20 for k in range(1, 20)], method="inverted_cdf").astype(int).tolist()
    shard = _Shards(cuts).of(key, tie)
    order = np.lexsort((tie, key))
    assert (np.diff(shard[order]) >= 0).all()
    assert np.bincount(shard, minlength=20).max() < 2.5 * 1000
    assert (_Shards([]).of(key, tie) == 0).all()
