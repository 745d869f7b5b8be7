import math
import random
import re
from fractions import Fraction

import numpy as np
import pytest

from atomframe.llm import quality as Q

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = {}
    for i in range(len(words) - 2):
        grams.setdefault(tuple(words[i : i + 3]), []).append(i)
    inside = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(3)}
    n = len(words)
    failed = n < 50 or 100 * len(inside) > 50 * n
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(inside), failed


TEXTS = [None, "", " \n\t", "a", "a b c a b c", "é é é é é\né é é é é\n\n\n", "x " * 70, " ".join(f"w{i}" for i in range(60)) + " # $$\nq\nq\n q", "a b\u0085c d\n" * 3, "z" * 200_000, "0 " * 40_000]


def test_counts_match_brute_force(spark):
    rows = [(i, t, "en", "clash") for i, t in enumerate(TEXTS)] + [(3, "a", None, "clash"), (None, "n u l l", "de", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words string")
    labels = spark.createDataFrame([(0, 1, 0), (3, None, 1), (None, 1, 1), (4, 0, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in Q.judge(docs, labels).collect())
    assert got == sorted((str(i), *brute(t)) for i, t, *_ in rows)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Q.judge(docs, labels).count() == 0


def test_cutoff_limits_false_rejections():
    share, good, bad = np.array([0, 10, 100]), np.array([5000, 3, 0]), np.array([10, 0, 400])
    assert Q.cutoff(share, good, bad, 0.01, 0.001) == 99
    assert Q.cutoff(share, np.array([5000, 3, 400]), bad, 0.01, 0.001) is None
    assert Q.cutoff(share, np.array([40, 0, 0]), bad, 0.01, 0.001) is None


def test_binomial_tail():
    assert Q.binomial_cdf(0, 10, 0.1).tolist() == pytest.approx([0.9**10])
    assert Q.binomial_cdf(9, 3, 0.5).tolist() == pytest.approx([1 / 8, 4 / 8, 7 / 8, 1])
    n = 5000
    exact = [float(sum(Fraction(math.comb(n, j)) * Fraction(1, 100) ** j * Fraction(99, 100) ** (n - j) for j in range(k + 1))) for k in (0, 20, 40)]
    assert [Q.binomial_cdf(50, n, 0.01)[k] for k in (0, 20, 40)] == pytest.approx(exact, rel=1e-9)


def plain_verdicts(docs, labels, risk=0.05, delta=0.05):
    """kept of every (doc_id, text, lang), from the definition: fractions, comb and loops over documents."""
    good = {}
    for doc, q in labels:
        if doc is not None and q is not None:
            good[doc] = max(good.get(doc, 0), q)
    shares = {}
    for _, text, _ in docs:
        n, chars, symbols, dup, rep, failed = brute(text)
        lines = sum(bool(WORD.search(x)) for x in (text or "").split("\n"))
        upper = sum("A" <= c <= "Z" for c in text or "")
        parts = ((symbols, chars), (dup, lines), (rep, n), (upper, chars), (n - len(set(WORD.findall(text or ""))), n))
        shares[text] = (failed, [math.floor(Fraction(Q.STEPS * a, b)) if b else 0 for a, b in parts])
    trials = {}
    for doc, text, lang in docs:
        if doc in good and not shares[text][0]:
            key = (lang or "", text)
            trials[key] = max(trials.get(key, 0), good[doc])
    strata = {s for s, _ in trials}
    level, each = delta / max(1, 5 * len(strata)), Fraction(str(risk)) / 5
    cut = {}
    for s in strata:
        for rule in range(5):
            mine = [(shares[t][1][rule], g > 0) for (x, t), g in trials.items() if x == s]
            total = sum(g for _, g in mine)
            best, most = None, 0
            for c in range(Q.STEPS, -1, -1):
                lost, caught = sum(g for v, g in mine if v > c), sum(not g for v, g in mine if v > c)
                if not total or lost > each * total or sum(math.comb(total, j) * each**j * (1 - each) ** (total - j) for j in range(lost + 1)) > level:
                    break
                if caught > most:
                    best, most = c, caught
            if best is not None:
                cut[s, rule] = best
    return [not shares[t][0] and not any(shares[t][1][r] > cut.get((lang or "", r), Q.STEPS * 10**9) for r in range(5)) for _, t, lang in docs]


def test_verdicts_equal_the_definition(spark):
    r = random.Random(4)
    words = lambda n: [r.choice("abcdefgh") + r.choice("klmnop") + str(r.randrange(300)) for _ in range(n)]
    docs, labels = [], []
    for i in range(1500):
        bad = i % 5 == 0
        w = words(r.randrange(52, 90))
        if bad:
            w = [x if k % 3 else "##" for k, x in enumerate(w)]
        docs.append((i, " ".join(w), "en" if i % 3 else None))
        if i % 4:
            labels.append((i, 0 if bad else 1, 0))
    docs += [(3000 + i, docs[1][1], "en") for i in range(200)]
    labels += [(3000 + i, 0, 0) for i in range(200)] + [(None, 1, 0), (7, None, 0)]
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = {r.doc_id: r.kept for r in Q.judge(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    want = plain_verdicts(docs, [(d, q) for d, q, _ in labels])
    assert [got[d] for d, _, _ in docs] == want and not all(want) and any(want)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    for r in Q.op10_quality(spark, sf).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(docs[r.doc_id])
        assert not (r.kept and r.base_failed)
