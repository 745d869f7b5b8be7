import hashlib
import re
from collections import Counter

import pytest

from atomframe.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def item_windows(bench, n=10):
    out = {}
    for item, text, *_ in bench:
        w = words(text)
        size = min(n, len(w))
        if item is not None:
            for i in range(len(w) - size + 1 if size else 0):
                out.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    return out


def hits(text, grams):
    w = words(text)
    inside, items = set(), set()
    for size in {len(g) for g in grams}:
        for i in range(len(w) - size + 1):
            if names := grams.get(tuple(w[i : i + size])):
                inside |= set(range(i, i + size))
                items |= names
    return len(w), inside, items


def text(a, b):
    return " ".join(f"w{i}" for i in range(a, b))


BENCH = [(1, text(0, 30), "x"), (2, text(20, 50), "x"), (2, text(20, 50), "x"), (3, "Short  ÉÉ-item", None), (4, None, "x"), (5, "", "x"), (None, text(500, 520), "x"), (6, text(0, 10), "x"), (7, " .,! ", "x")]
DOCS = [
    (1, f"before {text(3, 18).upper()} after, " + "more " * 40, "a"),
    (2, text(100, 150), "b"),
    (3, f"{text(0, 30)}", "c"),
    (4, None, "d"),
    (5, "", "e"),
    (6, "x SHORT éé item", "f"),
    (6, "x SHORT ÉÉ. item " + "y " * 10, "f"),
    (7, text(500, 520), "g"),
    (None, f"n {text(5, 16)} n " + "z " * 30, "h"),
    (8, "q " * 60_000 + text(0, 12) + " q" * 60_000, "i"),
    (9, "r " * 40 + text(20, 25) + " " + text(0, 10) + "; " + text(25, 30), "j"),
] + [(10, "s " * 30 + text(40, 50), "copy")] * 3


def frames(spark):
    bench = spark.createDataFrame([(*r, "clash") for r in BENCH], "item_id long, text string, source string, spans string")
    docs = spark.createDataFrame([(i, t, s, 7, "w", "c") for i, t, s in DOCS], "doc_id long, text string, spans string, n_words int, windows string, __lost string")
    return docs, bench


@pytest.mark.parametrize("max_windows", [1000, 7])
def test_hits_equal_brute_force(spark, max_windows):
    docs, bench = frames(spark)
    numbers, items = D.benchmark_windows(bench)
    assert numbers.count() == len(item_windows(BENCH))
    found = D.with_items(D.saved(D.find_hits(docs.select("doc_id", "text"), numbers, max_windows=max_windows), "test"), items)
    got = Counter((r.doc_id, r.text, r.n_words, frozenset(k for s in r.spans for k in range(s["first"], s["end"])), tuple(r["items"])) for r in found.collect())
    grams = item_windows(BENCH)
    want = Counter()
    for i, t, _ in DOCS:
        n, inside, names = hits(t, grams)
        want[i, t, n, frozenset(inside), tuple(sorted(names))] += 1
    assert got == want


@pytest.mark.parametrize("max_windows", [1000, 7])
def test_cut_texts_have_no_window(spark, max_windows):
    docs, bench = frames(spark)
    out = D.decontaminate(docs, bench, max_windows=max_windows)
    assert out.columns == docs.columns
    got, grams = Counter((r.doc_id, r.text, r.spans) for r in out.collect()), item_windows(BENCH)
    assert not any(hits(t, grams)[1] for _, t, _ in got)
    clean = [d for d in DOCS if not hits(d[1], grams)[1]]
    assert all(got[d] == 1 for d in clean)
    assert not {3} & {i for i, *_ in got}  # nothing else was in it
    texts = {i: t for i, t, _ in got}
    assert texts[1] == "before  after, " + "more " * 40 and texts[None] == "n  n " + "z " * 30
    # the cut of the inner window brings another one together, which goes too
    assert words(texts[9]) == ["r"] * 40
    assert got[10, "s " * 30, "copy"] == 3 and len(words(texts[8])) == 120_000


def test_empty_tables(spark):
    docs, bench = frames(spark)
    for d, b in ((docs.limit(0), bench), (docs, bench.limit(0)), (docs.limit(0), bench.limit(0))):
        assert D.decontaminate(d, b).count() == d.count()
        numbers, _ = D.benchmark_windows(b)
        assert not D.find_hits(d.select("doc_id", "text"), numbers).where("size(spans) > 0").count()


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    grams = item_windows([tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()])
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in D.op6_decontaminate(spark, sf).collect():
        n, inside, names = hits(docs[r.doc_id], grams)
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, len(inside), len(names), digest, bool(inside))
