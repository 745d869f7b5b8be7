from atomframe.llm import langid as L


def words(lang, n, seed):
    import random

    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice({"aa": ["ba", "lo", "mi"], "bb": ["sch", "ung", "keit"]}[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))


def frame(spark):
    rows = [(i, words(x, 5 + i % 60, i), x, "clash") for i in range(60) for x in ("aa", "bb")]
    odd = [(900, None, "aa", "1"), (901, "", "bb", None), (902, "12 !! 3", None, "x"), (903, "é", None, "x"), (None, words("aa", 30, 1), None, None), (904, words("bb", 9000, 7), None, ""), (904, words("bb", 9000, 7), None, "")]
    return spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score string")


def test_predictions(spark):
    docs = frame(spark)
    model = L.train(docs.where("doc_id is not null and doc_id % 2 = 0"))
    got = L.predict(docs, model, ["doc_id", "lang"]).collect()
    assert len(got) == docs.count()
    assert not [r for r in got if r.lang and r.doc_id < 900 and r.lang_pred != r.lang]
    by = {r.doc_id: r for r in got}
    assert [by[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3 and by[900].score == 0
    assert by[904].lang_pred == "bb" and by[None].lang_pred == "aa" and 0 <= by[903].score <= 1


def test_code_switching_is_labelled_by_word(spark):
    import numpy as np

    model = L.train(frame(spark))
    text = words("aa", 40, 91) + " " + words("bb", 40, 92)
    ids, distinct, lengths = L.numbered(L.lower_words([text.encode()]))
    gamma, *_ = L.chain.posteriors(model.chain(distinct), ids, lengths)
    gold = np.repeat([0, 1], 40)
    assert (gamma.argmax(axis=1) == gold).mean() > 0.95


def test_nothing_to_learn(spark):
    docs = frame(spark).where("false")
    assert L.train(docs) is None and L.predict(docs, None).count() == 0
    assert {r.lang_pred for r in L.predict(frame(spark), None).collect()} == {"und"}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id", "lang")
    rows = L.op9_langid(spark, sf).join(truth, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


MASK = (1 << 64) - 1


def plain_mixed(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def plain_score(model, word):
    """Weights of all hashed byte n-grams of the word with its borders, one by one, and the lexicon's part."""
    data, out = b"\x02" + word + b"\x03", model.lexicon_weight * model.lexicon[int(L.word_hashes([word])[0]) % L.LEXICON]
    for i in range(len(data)):
        h = 0
        for n in range(1, 5):
            if i + n > len(data):
                break
            h = plain_mixed((h * 257 + data[i + n - 1] + 0x9E3779B97F4A7C15) & MASK)
            out = out + model.weights[h % L.FEATURES].astype(float)
    return out


def plain_prediction(model, text):
    """The chain's marginals by enumeration of forward and backward sums, without blocks or tables."""
    import numpy as np

    words_ = (text or "").lower().encode().split()
    if not words_ or not any(c.isalpha() for c in text):
        return "und", 0.0
    k = len(model.langs)
    e = np.array([np.exp(np.maximum(s - s.max(), -L.SPAN)) for s in (plain_score(model, w) for w in words_)])
    move = np.exp(model.move)
    fwd, bwd = [e[0] / k], [np.ones(k)]
    for x in e[1:]:
        a = (fwd[-1] @ move) * x
        fwd.append(a / a.sum())
    for x in e[:0:-1]:
        b = move @ (x * bwd[-1])
        bwd.append(b / b.sum())
    g = np.array([a * b / (a @ b) for a, b in zip(fwd, bwd[::-1], strict=True)]).mean(axis=0)
    return model.langs[int(g.argmax())], float(g.max())


def test_predictions_equal_a_plain_chain(spark):
    import numpy as np
    import pytest

    r = np.random.default_rng(5)
    model = L.Model(["x", "y", "z"], r.normal(0, 1, (L.LEXICON, 3)))
    model.weights = r.normal(0, 0.3, (L.FEATURES + 1, 3)).astype(np.float32)
    model.weights[L.FEATURES] = 0
    model.move = r.normal(0, 1, (3, 3))
    texts = [None, "", "12 34", "é", "One word", "ß É ÉCOLE 1", words("aa", 700, 3) + " " + words("bb", 600, 4), "a " * 300] + [words("aa", n, n) for n in range(1, 40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for row in L.predict(docs, model).collect():
        lang, score = plain_prediction(model, texts[row.doc_id])
        assert row.lang_pred == lang and row.score == pytest.approx(score, rel=1e-6)


def test_equal_languages_are_taken_by_name(spark):
    import numpy as np

    model = L.Model(["b", "c"], np.zeros((L.LEXICON, 2)))
    docs = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    row = L.predict(docs, model).first()
    assert row.lang_pred == "b" and abs(row.score - 0.5) < 1e-9


def test_a_language_of_long_documents_only_is_learned(spark):
    rows = [(i, words("aa", 40, i), "aa") for i in range(40)] + [(100 + i, words("bb", 2000, i), "bb") for i in range(10)]
    model = L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_chars=1000)
    new = spark.createDataFrame([(i, words(x, 30, 700 + i), x) for i in range(20) for x in ("aa", "bb")], "doc_id long, text string, lang string")
    assert all(r.lang == r.lang_pred for r in L.predict(new, model, ["doc_id", "lang"]).collect())


def test_whole_table_equals_a_plain_chain(spark):
    import pytest

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = L.train(docs.where("doc_id is not null").where(~L.held_out()))
    texts = {r.doc_id: r.text for r in docs.collect() if not r.text or len(r.text) < 3000}
    checked = 0
    for row in L.op9_langid(spark, sf).collect():
        if row.doc_id in texts:
            lang, score = plain_prediction(model, texts[row.doc_id])
            assert row.lang_pred == lang and row.score == pytest.approx(score, rel=1e-5)
            checked += 1
    assert checked > 50
