import random

from pyspark.sql import functions as F

from atomframe.operators import names


def _table(spark, rows):
    return spark.createDataFrame([(n,) for n in rows], "p string")


def _brute(spark, wrong, known, best=3, least=0.72):
    a, b = _table(spark, wrong).toDF("name").distinct(), _table(spark, known).toDF("suggestion").distinct()
    longest = F.greatest(F.length("name"), F.length("suggestion"))
    scored = a.crossJoin(b).withColumn("score", 1 - F.levenshtein("name", "suggestion") / longest).where(F.col("score") >= least)
    out = {}
    for r in scored.collect():
        out.setdefault(r.name, []).append((-round(r.score, 6), r.suggestion))
    return {(n, s, -d) for n, rows in out.items() for d, s in sorted(rows)[:best]}


def _rows(df):
    return {(r.name, r.suggestion, round(r.score, 6)) for r in df.collect()}


def test_names_under_one_long_root(spark):
    """Unlike ends under one root of 60 characters and a shared last part: brute force's rows, and no large bucket."""
    r = random.Random(5)
    root = "/" + "".join(r.choice("abcdefgh/") for _ in range(59))
    ends = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(12)) for _ in range(2500)]
    known = [root + e + "/set.000" for e in ends]
    wrong = [k[:20] + k[21:] for k in known[:30]] + [k[:-9] + "x" + k[-9:] for k in known[30:60]] + [k.replace("/set", "_set") for k in known[60:80]]
    wrong += [root[:30] + "zz" + root[32:] + ends[90] + "/set.000", "nothing like it", None, "", known[100], known[100]]
    wanted = [w for w in wrong if w]
    out = names.similar_names(_table(spark, wrong), _table(spark, [*known, None, known[0]]), "p", best=1)
    assert _rows(out) == _brute(spark, wanted, known, best=1)
    with_ends = names._with_ends(_table(spark, known).toDF("suggestion")).cache()
    for k, most in ((2, 60), (4, 300)):
        index = names.segments(with_ends, len(known), k, 0.28 / 0.72)
        assert index.groupBy("key", "block").count().agg(F.max("count")).first()[0] <= most
    with_ends.unpersist()


def test_large_buckets_are_dealt(spark, monkeypatch):
    """Names that differ in the middle only, so that ends are shared by nearly all: the same rows from buckets of any size."""
    r = random.Random(6)
    known = ["aaaaaaaaaa" + "".join(r.choice("bc") for _ in range(6)) + "dddddddddd" for _ in range(60)]
    wrong = [k[:11] + k[12:] for k in known[:15]] + ["aaaaaaaaaabbbbbb", "eeeeeeeeeeee"]
    want = _brute(spark, wrong, known)
    monkeypatch.setattr(names, "BLOCK", 4)
    monkeypatch.setattr(names, "COMMON", 5)
    for edits in ((1,), (2, 4, 8), (3,), ()):
        assert _rows(names.similar_names(_table(spark, wrong), _table(spark, known), "p", edits=edits)) == want
    index = names.segments(names._with_ends(_table(spark, known).toDF("suggestion").distinct()), 60, 2, 0.28 / 0.72)
    assert index.groupBy("key", "block").count().agg(F.max("count")).first()[0] <= 12


def test_no_names(spark):
    none, some = _table(spark, []), _table(spark, ["abc", None, ""])
    for a, b in ((none, some), (some, none), (none, none)):
        assert names.similar_names(a, b, "p").collect() == []
    assert _rows(names.similar_names(some, some, "p")) == {("abc", "abc", 1.0), ("", "", 1.0)}
