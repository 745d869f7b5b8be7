import hashlib
import random
from collections import Counter

import pytest

from atomframe.llm import repeats as R


def brute(rows):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[p : p + 200] for d in data for p in range(len(d) - 199))
    out = []
    for (i, _), d in zip(rows, data, strict=True):
        gone = bytearray(len(d))
        for p in range(len(d) - 199):
            if seen[d[p : p + 200]] > 1:
                gone[p : p + 200] = b"\1" * 200
        spans = sum(g and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        kept = bytes(x for x, g in zip(d, gone, strict=True) if not g)
        out.append((i, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def answer(spark, rows, n=5):
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, key string").repartition(n)
    joined = docs.select("doc_id", "text").withColumn("key", R.document_key()).join(R.repeated_spans(docs), "key", "left").select("doc_id", "text", "runs")
    return Counter(tuple(r) for r in joined.mapInArrow(R._apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string").collect())


def rows(seed):
    r = random.Random(seed)
    text = lambda n: "".join(r.choice("abcdé \n") for _ in range(n))
    shared = [text(n) for n in (150, 199, 200, 201, 260, 500, 1500)]
    out = [None, "", "x" * 199, "x" * 200, "y" * 201, "ab" * 300, text(50) * 12]
    for _ in range(60):
        parts = [r.choice(shared)[r.randrange(40) : r.choice([180, 230, 400, 5000])] if r.random() < 0.6 else text(r.randrange(1, 400)) for _ in range(r.randrange(1, 6))]
        out.append("".join(parts))
    copy = text(900)
    out += [copy] * 4 + [copy[:300] + "#" + copy[301:], copy[7:]]
    return [(i if i % 13 else None, t) for i, t in enumerate(out)] + [(1, copy), (1, copy)]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("piece", [3 << 20, 350])
def test_equals_brute_force(spark, seed, piece, monkeypatch):
    assert R.Names(b"x" * 300).strings(R.np.array([0]))  # importable as it is
    data = rows(seed)
    if piece == 350:  # pieces of long texts, checked in this process
        monkeypatch.setattr(R, "PIECE", piece)
        text = next(t for _, t in data if t and len(t) > 1000).encode()
        whole = {p for _, _, _, low, more, _ in [R.runs(text, R.np.array([len(text)]))] for a, m in zip(low, more, strict=True) for p in range(a, a + m + 1)}
        batch = R.pa.RecordBatch.from_pydict({"text": [text.decode()]})
        parts = [p + o[0] for d, e, _, o in R.pieces(batch) for a, m in zip(*R.runs(d, e)[3:5], strict=True) for p in range(a, a + m + 1)]
        assert sorted(parts) == sorted(whole)
        return
    assert answer(spark, data) == brute(data)


@pytest.mark.parametrize("n", [1, 7, 40])
def test_refined_buckets_are_those_of_equal_strings(n):
    r = random.Random(n)
    parts = [bytes(r.choice(b"ab") for _ in range(r.randrange(200, 260))) for _ in range(n)]
    parts += [p[r.randrange(5) :] + bytes(r.choice(b"xy") for _ in range(40)) for p in parts] + [b"a" * 256] * 2
    data, starts, at = b"".join(parts), [], 0
    for p in parts:
        starts += range(at, at + max(0, len(p) - 199))
        at += len(p)
    seen = Counter(data[s : s + 200] for s in starts)
    assert R.repeated_starts(data, R.np.array(starts)).tolist() == [seen[data[s : s + 200]] > 1 for s in starts]


def test_a_popular_anchor_with_unlike_surroundings(spark):
    r = random.Random(8)
    passage = "".join(r.choice("abcdefgh ") for _ in range(320))
    some = lambda n: "".join(r.choice("klmnop ") for _ in range(n))
    data = [(i, some(r.randrange(300)) + passage[r.randrange(3) :] + some(r.randrange(300))) for i in range(150)]
    data += [(500 + i, some(60) + passage[: 150 + i] + some(90)) for i in range(60)]
    assert answer(spark, data) == brute(data)


@pytest.mark.parametrize("length", [160, 199, 260])
def test_a_core_of_very_many_unlike_blocks(spark, length):
    """A line in 1,500 documents with unlike surroundings: no core of more than HOT blocks is gathered anywhere."""
    r = random.Random(length)
    line = "".join(r.choice("0123456789 ") for _ in range(length))
    some = lambda n: "".join(r.choice("klmnop ") for _ in range(n))
    data = [(i, some(r.randrange(150)) + line + some(r.randrange(150))) for i in range(1500)]
    data += [(5000 + i, some(40) + "zz" + line + "zz" + some(40)) for i in range(3)]
    assert answer(spark, data, 3) == brute(data)

    def blocks():
        for i, t in data:
            at = t.index(line)
            for p in range(max(0, at + 60 - R.SPAN + 1), min(at + 60, len(t) - R.LENGTH) + 1):
                yield i, p, at + 60 - p, t[p : p + R.LENGTH].encode()

    # the same from blocks that are made here: one string each, of an anchor in the line
    rows_ = [(R.named(w[place - place // R.WIDTH * R.WIDTH :][: R.LENGTH - R.WIDTH + 1]), i, p, place % R.WIDTH, w) for i, p, place, w in blocks()]
    table = spark.createDataFrame(rows_, "core long, key long, low int, left int, window binary")
    assert max(Counter(x[0] for x in rows_).values()) > 1000
    found = set()
    for part, repeated in R.parted(R.saved(table, "test")):
        if repeated:
            found |= {(x.key, x.low) for x in part.collect()}
        else:
            assert (part.groupBy("core").count().agg({"count": "max"}).first()[0] or 0) <= R.HOT
            found |= {(x.key, x.low + k) for x in part.repartition(3, "core").sortWithinPartitions("core").select("core", "key", "low", "window").mapInArrow(R._refine, "key long, low int, more int").collect() for k in range(x.more + 1)}
    seen = Counter(w for _, _, _, w in blocks())
    assert found == {(i, p) for i, p, _, w in blocks() if seen[w] > 1}


@pytest.mark.parametrize("width", [29, 15, 1])
def test_halves_hold_each_string_once(width):
    r = random.Random(width)
    for _ in range(50):
        left = r.randrange(2 * width)
        n = r.randrange(1, left + 2)
        window = bytes(r.randrange(256) for _ in range(n - 1 + R.LENGTH))
        out = list(R.halves((7, 100, left, window), width))
        assert sorted(low + k - 100 for _, _, low, _, w in out for k in range(len(w) - R.LENGTH + 1)) == list(range(n))
        for core, _, low, own, w in out:
            assert w == window[low - 100 :][: len(w)] and R.named(w[own : own + R.LENGTH - width + 1]) == core and own - (len(w) - R.LENGTH) >= 0


def test_a_text_above_the_piece_size(spark):
    r = random.Random(9)
    long = "".join(r.choice("abcdefghijklmnop") for _ in range(40_000)) * 90
    passage = "".join(r.choice("qrstuvwxyz") for _ in range(300))
    assert len(long) > R.PIECE
    tail = "".join(r.choice("ABCDEFGH") for _ in range(500))
    rows_ = [(1, long + tail + passage), (2, passage + "#"), (3, long[17:700]), (4, tail[100:])]
    got = {a[0]: a for a in answer(spark, rows_)}
    assert got[1][2] == len(long) + 400 + 300 and got[1][3] == 2 and got[2][2] == 300 and got[3][2] == 683 and got[4][2] == 400


def test_empty(spark):
    assert not answer(spark, [])


def test_cut_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "z" * 500, "a"), (2, "short", "b"), (3, None, "c")], "doc_id long, text string, runs string")
    assert sorted(tuple(r) for r in R.cut(docs).collect()) == [(1, "", "a"), (2, "short", "b"), (3, None, "c")]


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    data = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in R.op4_repeats(spark, sf).collect()) == brute(data)
