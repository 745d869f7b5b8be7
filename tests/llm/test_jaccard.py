import random
import re
from collections import Counter

import numpy as np
import pytest

from atomframe.llm import jaccard as J

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    by = {}
    for i, s in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(i)
    seen = set()
    for at in by.values():
        for x in range(len(at)):
            for y in range(x):
                p = (at[y], at[x])
                if p not in seen:
                    seen.add(p)
                    if 100 * len(sets[p[0]] & sets[p[1]]) >= 75 * len(sets[p[0]] | sets[p[1]]):
                        up[find(p[1])] = find(p[0])
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return Counter((d, len(s), low.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def texts(seed, n=160):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(400)}"
    common = " ".join(word() for _ in range(40))
    out = []
    for _ in range(n // 8):
        base = [word() for _ in range(r.choice([3, 6, 20, 60, 200]))]
        for _ in range(r.randrange(1, 12)):
            copy = list(base)
            for _ in range(r.randrange(0, 1 + len(base) // 25)):
                copy[r.randrange(len(copy))] = word()
            out.append(" ".join(copy) if r.random() < 0.7 else common + "\n" + " ".join(copy).upper())
    return out + [None, "", " \n", "one", "ONE", "a b c d", "a b c d e", "x " * 3000, "x " * 3000 + "y"] + [common] * 5


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(J, "COMMON", 4)
    t = texts(seed)
    rows = [(i * 7 % 1000 if i % 31 else None, x) for i, x in enumerate(t)] + [(3, "q r s t u v w"), (3, "other words in here"), (3, "q r s t u v w")]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, node string").repartition(6)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(docs).collect())
    assert got == brute(rows)


def test_empty(spark):
    assert J.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_probe_prunes_but_misses_nothing():
    r = np.random.default_rng(4)
    join = J.Join(5, 75, 100, J.NONE, np.zeros(0, np.int8))
    base = np.unique(r.integers(0, 2**63, 300).astype(np.uint64))
    others = []
    for k in range(200):
        keep = r.random(len(base)) < r.choice([0.6, 0.85, 0.9, 1.0])
        others.append(np.unique(np.concatenate([base[keep], r.integers(0, 2**63, r.integers(0, 60)).astype(np.uint64)])))
    want = [4 * len(np.intersect1d(base, o)) >= 3 * len(np.union1d(base, o)) for o in others]
    assert join.probe(base, others) == want and any(want) and not all(want)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in J.op2_jaccard(spark, sf).collect())
    assert got == brute(rows)


def chain(seed=3, n=120, size=60):
    """A family of copies, each a few words from the one before: neighbours are alike, the ends are not."""
    r = random.Random(seed)
    copy, out = [f"c{i}" for i in range(size)], []
    for _ in range(n):
        copy = list(copy)
        copy[r.randrange(size)] = f"n{r.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("few", [0, 4])
def test_components_of_many_chunks(spark, monkeypatch, few):
    monkeypatch.setattr(J, "FEW", few)
    rows = list(enumerate(chain() + chain(4) + texts(9, 64)))
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(docs).collect()) == brute(rows)


def test_a_common_line_in_unlike_short_documents(spark):
    line = "all rights reserved by the authors of this text and nobody else may copy it"
    rows = [(i, f"{line}\nw{i} x{i % 7} y{i % 11}") for i in range(700)] + [(5000 + i, line) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(docs).collect()) == brute(rows)


def test_one_row_of_each_component_stays(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(5, long, "a"), (3, long + " x", "b"), (3, "quite another text with some more words in it", "c"), (3, long + " x", "d"), (None, long, "e"), (None, "no id here but six words", "f"), (None, "no id here but six words", "f"), (8, "", "g"), (8, None, "h"), (8, "", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_key string").withColumn("node", J.F.lit(1)).withColumn("first", J.F.lit("x"))
    out = J.representatives(docs)
    assert out.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in out.collect())
    assert got == Counter({(3, long + " x"): 1, (3, rows[2][1]): 1, (None, rows[5][1]): 1, (8, ""): 2, (8, None): 1})
