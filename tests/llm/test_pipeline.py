import numpy as np
import pytest

import corpus_pipeline as P
from test_jaccard import brute as near_brute
from test_secrets import brute as secret_brute
from test_tokens import brute as tokens, check_packing

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows after each stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for name, stage in P.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append(docs.collect())
    return out


def test_columns_stay(stages):
    for rows in stages[:-1]:
        assert set(rows[0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars"}
        assert all(r.n_chars == len(r.text) for r in rows)


def test_near_duplicates(stages):
    rows = [(r.doc_id, r.text) for r in stages[1]]
    assert {r.doc_id for r in stages[2]} == {d for d, _, c in near_brute(rows) if d == c}


def test_clean_documents_are_unchanged(stages):
    ids = {r.doc_id for r in stages[0]}
    assert len({r.doc_id for r in stages[1]}) >= 0.99 * len(ids)
    before = {r.doc_id: r.text for r in stages[2]}
    assert sum(before[r.doc_id] == r.text for r in stages[3]) >= 0.9 * len(before)


def test_no_benchmark_window_is_left(spark, stages):
    import re

    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    grams = lambda t, n=10: {tuple(w[i : i + min(n, len(w))]) for w in [word.findall(t.lower())] for i in range(len(w) - min(n, len(w)) + 1)}
    bench = set().union(*(grams(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()))
    hit = {r.doc_id for r in stages[2] if grams(r.text) & bench}
    assert hit and not {r.doc_id for r in stages[3] if grams(r.text) & bench}


def test_no_secret_is_left(stages):
    assert any(secret_brute(r.text) for r in stages[3])
    assert not any(secret_brute(r.text) for r in stages[4])


def test_packing(stages):
    used, least = check_packing(stages[5], {r.doc_id: tokens(r.text) for r in stages[4]}, 1024)
    assert used <= least * 1.02


def test_sequences_hold_the_ids(stages):
    want = {r.doc_id: tokens(r.text) for r in stages[4]}
    assert all(bytes(r.ids) == np.array(want[r.doc_id][r.start : r.start + r.length], "<u4").tobytes() for r in stages[5])
    assert sum(r.length for r in stages[5]) == sum(map(len, want.values()))


def test_mixed_documents_and_unlabelled_tables_pass(spark):
    import random

    sounds = {"aa": ["ba", "lo", "mi"], "bb": ["sch", "ung", "keit"], "cc": ["xé", "qui", "aux"], "dd": ["vw", "yk", "zt"]}
    r = random.Random(3)
    words = lambda x, n: " ".join("".join(r.choice(sounds[x]) for _ in range(r.randint(2, 4))) for _ in range(n))
    rows = [(i, words(x, 40), x) for i in range(60) for x in sounds] + [(900, " ".join(words(x, n) for x, n in zip(sounds, (38, 32, 30, 30))), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert P.language_id(spark, docs, SF).where("doc_id = 900").count() == 1
    assert P.language_id(spark, docs.withColumn("lang", P.F.lit(None).cast("string")), SF).count() == len(rows)


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score string, lang_pred string, row_key string, node string, first string, spans string, n_words string, rank string, ids string, length string"


def odd_rows():
    import random

    r = random.Random(6)
    prose = lambda n: " ".join("".join(r.choice(["ba", "lo", "mi", "re"]) for _ in range(r.randint(1, 4))) for _ in range(n))
    own, same = prose(60), prose(40)
    texts = [(1, None), (2, ""), (3, "12 !!"), (4, own), (4, own), (4, prose(50)), (None, own), (None, same), (None, same), (9, own + " extra"), (10, prose(30_000)), (11, "password=abc123def456 " + prose(30))]
    return [(i, t, "aa", "s", len(t or ""), *["clash"] * 10) for i, t in texts]


def through(spark, docs, folder):
    out = []
    for name, stage in P.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append(docs)
    return out


def test_odd_rows_pass_through_all_stages(spark, tmp_path):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, COLUMNS)
    *texts, packed = through(spark, docs, tmp_path)
    assert all(d.columns == docs.columns for d in texts)
    named, once, _, clean = [[(r.doc_id, r.text) for r in d.collect()] for d in texts]
    assert {i for i, _ in named} == {4, None, 9, 10, 11} and len(named) == 9  # no text, no letter: no language
    assert sorted(once, key=str) == sorted({(i, t) for i, t in named if (i, t) not in {(None, rows[3][1]), (9, rows[9][1])}}, key=str)
    assert len(once) == 5 and dict(clean)[11].startswith("[assign] ") and dict(clean)[10] == rows[10][1]
    assert all(r.n_chars == len(r.text) for r in texts[-1].collect())
    total = sum(len(tokens(t)) for _, t in clean)
    assert sum(r.length for r in packed.collect()) == total and packed.where("doc_id is null").count() == 1


def test_unlabelled_nulls_are_packed_as_their_end(spark, tmp_path):
    docs = spark.createDataFrame([(1, None, None), (2, "", None)], "doc_id long, text string, lang string")
    assert sorted((r.doc_id, r.length) for r in through(spark, docs, tmp_path)[-1].collect()) == [(1, 1), (2, 1)]


def test_empty_tables_pass_through_all_stages(spark, tmp_path):
    docs = spark.createDataFrame([], COLUMNS)
    assert all(d.count() == 0 for d in through(spark, docs, tmp_path))
