import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from atomframe.llm import hmm as M

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """doc_id, n_tokens, n_known, base for each row."""
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    docs = [(i, [*WORD.findall((t or "").translate(LOWER)), None]) for i, t in rows]
    c = Counter(w for i, ws in docs if not out(i) for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, out(i), len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for i, ws in docs]


def compare(got, rows):
    key = lambda r: (str(r[0]), r[2], r[3], round(r[5], 6))
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(brute(rows), key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)


TEXTS = [None, "", "A a B", "é É x\u0085y", "word " * 3000, "only here", "a b c", "\n"]


def run(spark, rows):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, n_known string")
    docs = docs.select("doc_id", "text", M.held_out().alias("held_out"))
    training = docs.where("not held_out")
    counts = M.count_words(training)
    model = M.train(training, counts)
    out = M.score(docs, model, counts).select("doc_id", M.held_out().alias("held_out"), "n_tokens", "n_known", M.F.lit(counts.total).alias("train_tokens"), "base_score", "score").collect()
    return out, counts, model


def test_small_rows(spark):
    rows = [(i * 3, t) for i, t in enumerate(TEXTS * 4)] + [(None, "a b"), (5, "same"), (5, "same"), (5, "other")]
    got, counts, model = run(spark, rows)
    compare(got, rows)
    assert np.allclose(model.emit.sum(axis=0), 1) and np.allclose(model.move.sum(axis=1), 1) and model.start.sum() == pytest.approx(1)
    shares = 1 / (counts.tokens + 0.5 * (counts.kinds + 1))
    plain = Counter(w for i, t in rows if not brute([(i, "")])[0][1] for w in WORD.findall((t or "").translate(LOWER)))
    for r, (i, t) in [(next(r for r in got if r.doc_id == i and r.n_tokens == len(WORD.findall(t or "")) + 1), (i, t)) for i, t in rows[:8]]:
        words = WORD.findall((t or "").translate(LOWER))
        a, log = None, 0.0
        for c, n in [*((int(M.word_hashes([w.encode()])[0] % np.uint64(M.CLASSES)), plain[w]) for w in words), (M.END, counts.tokens[M.END])]:
            a = (model.start if a is None else a @ model.move) * model.emit[c] * shares[c] * (n + 0.5)
            log += math.log10(a.sum())
            a = a / a.sum()
        assert r.score == pytest.approx(log)


@pytest.mark.parametrize("rows", [[], [(i, "x y") for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1]])
def test_nothing_to_learn(spark, rows):
    got, *_ = run(spark, rows)
    compare(got, rows)


def test_whole_table_and_gain_over_the_base(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = M.op1_hmm(spark, sf).collect()
    compare([tuple(r)[:6] for r in got], rows)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_last_step_counts_every_training_document_alike(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * 7 + k * k) % 41}" for k in range(i % 13))) for i in range(120)] + [(None, "x y z")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts, models, expected = M.count_words(docs), [], M._expected
    monkeypatch.setattr(M, "_expected", lambda model: (models.append(model), expected(model))[1])
    got, last = M.train(docs, counts), models[-1]
    ids, lengths, *_ = M._class_ids([t.encode() for _, t in rows])
    gamma, xi, _ = M.chain.posteriors(last.chain(), ids, lengths + 1, moves=True)
    emit = np.stack([np.bincount(ids, weights=gamma[:, k], minlength=M.CLASSES + 1) for k in range(M.STATES)], axis=1)
    assert emit[M.END].sum() == pytest.approx(len(rows))
    prior = (counts.tokens + 0.5) / (counts.tokens + 0.5).sum()
    emit += 0.5 * M.STATES * prior[:, None] + 1e-6
    start = gamma[np.cumsum(lengths + 1) - lengths - 1].sum(axis=0) + 0.1
    assert np.allclose(got.emit, emit / emit.sum(axis=0)) and np.allclose(got.start, start / start.sum())
    assert np.allclose(got.move, (xi + 0.1) / (xi + 0.1).sum(axis=1, keepdims=True))


@pytest.mark.parametrize("texts", [[], [b""], [b"", b" \t\n", b"A a\x0bB\x0c\r a", "\u00e9 \u00c9 x\u0085y\u00a0z \x1c q".encode(), b"a\x00b a\x00B", b"end"], [b"w"] * 300])
def test_numbers_of_words(texts):
    ids, words, lengths = M.numbered_words(texts)
    assert [words[i] for i in ids] == [w for x in texts for w in x.lower().split()]
    assert lengths.tolist() == [len(x.split()) for x in texts] and len(set(words)) == len(words)


def test_training_texts_are_read_once(spark, monkeypatch, tmp_path):
    """One job takes words and class ids from the texts; counting and all steps of training work on what it saved."""
    rows = [(i, f"a{i % 7} b{i % 3} c") for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    made = []
    saved = M.saved
    monkeypatch.setattr(M, "saved", lambda df, name: (made.append((name, str(tmp_path) in "".join(df.inputFiles()))), saved(df, name))[1])
    compare([tuple(r)[:6] for r in M.op1_hmm(spark, str(tmp_path)).collect()], rows)
    assert [reads for _, reads in made].count(True) == 1
