import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row

from atomframe.llm import search as S

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """item, rank, doc_id and score by the definition."""
    texts = [(i, w) for i, t in docs if (w := words(t))]
    n, total = len(texts), sum(len(w) for _, w in texts)
    terms = {}
    for i, t in items:
        terms.setdefault(i, []).extend(words(t))
    df = Counter(t for _, w in texts for t in set(w))
    counts = [(i, len(w), Counter(w)) for i, w in texts]
    out = []
    for item, own in terms.items():
        scored = []
        for i, size, c in counts:
            m = 100 - 75 + 75 * size * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in own if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


DOCS = [
    (1, "Alpha beta, gamma!"),
    (2, "alpha alpha ALPHA-beta alphabet"),
    (3, None),
    (4, ""),
    (5, " .,; "),
    (6, "Éa éa ÉA x1 1x"),
    (7, "beta"),
    (7, "beta"),
    (7, "gamma delta"),
    (None, "beta"),
    (None, "alpha beta gamma delta epsilon"),
    (8, "the the the the " * 50 + "omega"),
    (9, "q " * 30_000 + "alpha" + " q" * 30_000),
    (10, "\x00nul\x00alpha\tbeta\nno break alpha"),
] + [(100 + i, "copy of one text with alpha") for i in range(40)]
ITEMS = [
    (1, "alpha Beta alpha"),
    (2, "Éa; no break"),
    (3, None),
    (4, "."),
    (5, "nowhere found"),
    (6, "gamma delta"),
    (6, "the omega gamma"),
    (None, "q beta"),
    (7, "copy text"),
]


def frames(spark):
    docs = spark.createDataFrame([(*r, "x", 3, "t") for r in DOCS], "doc_id long, text string, item_id string, n int, terms string")
    items = spark.createDataFrame([(*r, "x", 1.5) for r in ITEMS], "item_id long, text string, doc_id string, score double")
    return docs.repartition(5), items


@pytest.mark.parametrize("max_terms", [1000, 3])
@pytest.mark.parametrize("k", [1, 3, 10])
def test_equal_to_the_definition(spark, max_terms, k):
    docs, items = frames(spark)
    got = Counter(map(tuple, S.search(docs, items, k, max_terms).collect()))
    assert got == brute(DOCS, ITEMS, k)


def _items(*rows):
    return S.Items([Row(item_id=i, term=t, times=n) for i, t, n in rows])


def test_runs_are_cut_at_spaces(monkeypatch):
    items = _items((1, b"words", 1), (1, b"word", 1), (2, b"more", 1), (2, b"words", 2))
    monkeypatch.setattr(S, "RUN", 4)
    parts = list(S.runs(b"some words  more words"))
    assert all(p[0] == p[-1] == " " for p in parts) and len(parts) > 3
    found = Counter(v for p in parts for _, v in items.automaton().iter(p))
    assert {items.terms[i]: n for i, n in found.items()} == {b"words": 2, b"more": 1}
    assert [S.words_in(x) for x in (b"", b" ", b"a", b" a", b"a  b ")] == [0, 0, 1, 1, 2]


@pytest.mark.parametrize("scores,postings", [(1 << 20, 1 << 20), (9, 1 << 20), (1 << 20, 5), (1, 1)])
def test_blocks_of_any_size(monkeypatch, scores, postings):
    monkeypatch.setattr(S, "SCORES", scores)
    monkeypatch.setattr(S, "POSTINGS", postings)
    texts = [d for d in DOCS if words(d[1])]
    items = _items(*((i, t.encode(), n) for i in {i for i, _ in ITEMS} for t, n in Counter(w for j, x in ITEMS if i == j for w in words(x)).items()))
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in texts], pa.int64()), pa.array([t for _, t in texts])], ["doc_id", "text"])
    counted = list(S._scan(items)(iter([batch, batch.slice(0, 0)])))
    df = np.bincount(np.concatenate([np.asarray(b.column("terms").flatten()) for b in counted]), minlength=len(items.terms))
    n, total = len(texts), sum(len(words(t)) for _, t in texts)
    out = next(S._best(items, S.weights(df, n), n, total, 10)(iter(counted)))
    got = sorted((items.ids[r["item"]] or 0, -r["score"], r["doc_id"] or 10**6) for r in out.to_pylist())
    assert got == sorted((i or 0, -s, d or 10**6) for (i, _, d, s), k in brute(DOCS, ITEMS).items() for _ in range(k))


def test_best_keeps_the_smallest_ids_of_ties():
    rng = np.random.default_rng(5)
    for _ in range(20):
        scores = rng.integers(0, 4, (300, 3))
        ids, missing = rng.permutation(300), (rng.random(300) < 0.1).astype(np.int64)
        best = S.Best(3, 7)
        for a in range(0, 300, 23):
            best.add(ids[a : a + 23], missing[a : a + 23], scores[a : a + 23])
        got = set(zip(*(x.tolist() for x in best.rows), strict=True))
        want = set()
        for item in range(3):
            want |= {(item, s, m, i) for s, m, i in sorted(((int(scores[d, item]), int(missing[d]), int(ids[d])) for d in range(300) if scores[d, item] > 0), key=lambda x: (-x[0], x[1], x[2]))[:7]}
        assert got == want


def test_norms_beyond_64_bits():
    sizes = np.array([5, 3_000_000])
    assert S.length_norms(sizes, 10**12, 10**15).tolist() == [25 + 75 * int(n) * 10**12 // 10**15 for n in sizes]


def test_empty_tables(spark):
    docs, items = frames(spark)
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("text is null"), items), (docs, items.where("text is null"))):
        out = S.search(d, i)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and not out.count()


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert Counter(map(tuple, S.op11_search(spark, sf).collect())) == brute(docs, items)
