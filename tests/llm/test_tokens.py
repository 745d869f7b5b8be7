import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from atomframe.llm import packing, tokenfiles as F, tokens

TEXTS = [None, "", "a", " a  b ", "it's 's b1c x²y é́a _a a_b ½ a.\nB, c can't.", "<|endoftext|> <|endoftext|>", "a\x1c b\u0085 c  d", "日本 語 テキスト 😀 😀x", "x" * 5000, "word, " * 4000, "\n"]
_T = Tokenizer.from_file(tokens.default_tokenizer())


def brute(text):
    return [*_T.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é1.,'s\n\t  ́_語")), max_size=4))
def test_same_ids_as_the_library(texts):
    assert [x.tolist() for x in tokens.encoder(tokens.default_tokenizer()).encode(texts)] == [_T.encode(t, add_special_tokens=False).ids for t in texts]


def test_special_tokens_in_a_text_are_the_librarys():
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z", "a b", "<|endoftext| >"]
    assert _T.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    got = tokens.encoder(tokens.default_tokenizer()).encode(texts)
    assert [x.tolist() for x in got] == [_T.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_that_a_tokenizer_would_join_are_encoded_one_by_one(monkeypatch):
    e = tokens.Encoder(tokens.default_tokenizer())
    e.sizes = e.sizes + 1  # no border falls where it should
    texts = ["some words, more words 12 it's", "and others"]
    assert [x.tolist() for x in e.encode(texts)] == [_T.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=30), st.integers(0, 3000))
def test_blocks_round_trip(odd, n):
    values = np.concatenate([np.arange(n, dtype=np.uint32) % 700, np.array(odd, dtype=np.uint32)])
    blocks = F.encode_blocks(values)
    starts = np.cumsum([0, *map(len, blocks)])[:-1]
    sizes = np.minimum(F.BLOCK, len(values) - np.arange(len(blocks)) * F.BLOCK)
    if blocks:
        assert np.array_equal(F.decode_blocks(b"".join(blocks), starts, sizes), values)
        assert np.array_equal(F.decode_blocks(b"".join(blocks), starts[-1:], sizes[-1:]), values[(len(blocks) - 1) * F.BLOCK :])


def rows():
    return [(i * 7 % 11 if i % 5 else None, t, "clash", 3) for i, t in enumerate(TEXTS)] + [(4, "same", None, 1)] * 3


def test_files_hold_all_ids_in_order(spark, tmp_path):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, start string, n int")
    files = F.write_token_files(docs, str(tmp_path / "out"), partitions=3)
    got = sorted(F.read_token_files(files, str(tmp_path / "out"), with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows()), key=lambda x: (x is not None, x))
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == Counter((i, tuple(brute(t))) for i, t, *_ in rows())
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), crc(r.ids))
        at += r.n_tokens


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert F.read_token_files(F.write_token_files(docs, str(tmp_path / "none")), str(tmp_path / "none")).count() == 0
    assert packing.pack(docs).count() == 0


def check_packing(got, want, size):
    pieces, bins = {}, {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    total = sum(r.length for r in got)
    for doc, ids in want.items():
        at = 0
        for k, r in enumerate(sorted(pieces[doc], key=lambda r: r.piece)):
            assert (r.piece, r.start, r.ids_crc32) == (k, at, crc(ids[at : at + r.length]))
            assert k == 0 or r.length == size
            at += r.length
        assert at == len(ids) and len(pieces[doc]) == -(-len(ids) // size)
    return len(bins), -(-total // size)


@pytest.mark.parametrize("size", [64, 1024])
def test_packing(spark, size):
    texts = [t for t in TEXTS] + ["w " * k for k in range(150)] + ["same text"] * 200
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, rank string")
    got = packing.pack(docs.repartition(5), size).collect()
    used, least = check_packing(got, {i: brute(t) for i, t in enumerate(texts)}, size)
    assert used <= least * 1.03 + 1


def test_placed_ids_make_the_documents(spark):
    texts = TEXTS + ["w " * k for k in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = packing.pack(docs, 64).collect()
    made, sequences = {}, {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.piece)):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.length == len(ids) and r.ids_crc32 == crc(ids)
        made.setdefault(r.doc_id, []).extend(ids)
        sequences.setdefault(r.sequence_id, {})[r.offset] = ids
    assert made == {i: brute(t) for i, t in enumerate(texts)}
    for s in sequences.values():
        whole = [x for at in sorted(s) for x in s[at]]
        assert len(whole) <= 64 and all(whole[at : at + len(ids)] == ids for at, ids in s.items())
    plain = [(r.doc_id, r.piece, r.length, r.ids_crc32) for r in packing.pack(docs, 64, with_ids=False).collect()]
    assert sorted(plain) == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in got)


@pytest.mark.parametrize("most_bases", [0, 1000])
def test_packing_of_odd_rows(spark, most_bases):
    """Null and repeated ids, equal rows, and a text above the bytes that are tokenised at a time; with and without a broadcast."""
    long = "some words and more, " * 60_000
    assert len(long) > packing.PIECE_BYTES
    rows = [(None, "a b"), (None, "a b"), (None, None), (1, "x y z"), (1, "other"), (2, long), (3, ""), (3, "")]
    docs = spark.createDataFrame([(*r, "clash", 5) for r in rows], "doc_id long, text string, piece string, length int").repartition(3)
    got = packing.pack(docs, 64, most_bases=most_bases).collect()
    want = sorted((i or -1, crc(ids[a:b])) for i, t in rows for ids in [brute(t)] for a, b in _cuts(len(ids), 64))
    assert sorted((r.doc_id or -1, r.ids_crc32) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        assert sorted(places)[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(sorted(places), sorted(places)[1:])) and sum(n for _, n in places) <= 64
    assert not packing.pack(docs.limit(0), 64, most_bases=most_bases).count()


def _cuts(n, size):
    first = n % size or size
    ends = [0, *range(first, n + 1, size)]
    return list(zip(ends, ends[1:]))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_plan_equals_best_fit_decreasing(lengths):
    plan = packing.best_fit(dict(Counter(lengths)), 50)
    assert Counter(x for n, p in plan for _ in range(n) for x in p) == Counter(lengths)
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= x]
        room = min(fits, default=50)
        if fits:
            rooms.remove(room)
        rooms.append(room - x)
    assert sum(n for n, _ in plan) == len(rooms)
    assert all(sum(p) <= 50 for _, p in plan)


def test_whole_tables(spark):
    sf = "/root/testdata/sf0.01"
    want = {r.doc_id: brute(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    at = 0
    for r in sorted(F.op5_token_files(spark, sf).collect(), key=lambda r: r.doc_id):
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(want[r.doc_id]), crc(want[r.doc_id]))
        at += r.n_tokens
    used, least = check_packing(packing.op7_packing(spark, sf).collect(), want, 1024)
    assert used <= least * 1.02
