import hashlib
import math
import re

import pytest

from atomframe.llm import secrets as S

WORDS = "(password|passwd|secret|token|api_?key)"


def brute(text):
    out = []
    for m in re.finditer(f"""(?ai:{WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or ""):
        out += [(m.start(), 0, m.end())] if len(m[2]) >= 6 else []
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return sorted(out)


def test_base_and_learned_spans(spark):
    import random

    r = random.Random(1)
    hexa = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    prose = "the ordinary tionnthereingble words ofanotherlongishword here "
    texts = [prose * 60 + f"é password={hexa(18)} and AKIA{''.join(r.choice('ABCDEFGH234567') for _ in range(16))} " + hexa(32) for _ in range(200)]
    texts += [None, "", "PassWord : 'abc'", 'API_KEY"="abcdefg.h', "token=token: abcdefgh", "AKIA" * 4, "AKIA" * 6, "0" * 23, "f" * 24, "ſecret=abcdefgh", prose * 20_000]
    texts += [f"é bare {hexa(18)} here", prose]
    rows = [(i if i % 50 else None, t, "x") for i, t in enumerate(texts)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted((str(r.doc_id), r.n_assign + r.n_access + r.n_hex, r.base_sha256) for r in S.scan(docs).collect())
    assert got == sorted((str(i), len(b := brute(t)), hashlib.sha256(S.written(b).encode()).hexdigest()) for i, t, _ in rows)
    formats = S.learn(docs)
    assert S.all_spans(texts[-2], formats)[1] and not S.all_spans(prose, formats)[1]
    clean = {r.text for r in S.redact(docs).collect()}
    assert prose in clean and not any(S.base_spans(t, t.encode()) for t in clean if t)


def test_short_secrets_and_rests_of_runs(spark):
    import random

    r = random.Random(2)
    short = lambda: "".join(r.choice("ABCDEFGHJKLMNPQRSTUVWXYZ0123456789") for _ in range(12))
    prose = "the ordinary words of anotherlongishword and something else here "
    texts = [prose * 20 + f"token={short()} and AKIA{'ABCDEFGH234567XY'} " for _ in range(300)]
    formats = S.learn(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    bare = [short() for _ in range(20)]
    found = [S.all_spans(f"é bare {b} here", formats) for b in bare]
    assert all(not base and [(s, e) for s, _, e in spans] == [(7, 19)] for base, spans in found)
    hexa = "0123456789abcdef" * 2
    for b in ["X" + b[1:] for b in bare]:
        base, spans = S.all_spans(f"see {hexa}{b} here", formats)
        assert [(s, e) for s, _, e in base] == [(4, 36)] and [(s, e) for s, _, e in spans] == [(4, 36), (36, 48)]
    left = spark.createDataFrame([(f"see {hexa}{b} here",)], "text string")
    assert S.redact(left, formats).first().text.startswith("see [hex][") and b not in S.redact(left, formats).first().text
    assert not S.all_spans(prose * 3, formats)[1]


def test_merged_states_generalise():
    a = S.Automaton({bytes([1, 2] * n): 5 for n in range(1, 30)})
    assert len({id(a.next[0])}) == 1 and a.log_probability(bytes([1, 2] * 50)) > -100
    assert a.log_probability(bytes([3])) == float("-inf")


def test_shorter_strings_cannot_pass():
    import itertools

    pairs = S.np.ones(S.N * S.N) * 1000
    pairs[1:5] = 3
    f = S.Formats({0: {"a1" * n: 4 for n in range(3, 9)}, 1: {"AB12": 9}}, pairs, threshold=9.0)
    kinds = {n: any(f._judged(bytes(x)) is not None for x in itertools.product(range(1, 5), repeat=n)) for n in range(1, 7)}
    assert f.least == min(n for n in kinds if kinds[n]) > 1


def test_counts_matter_to_the_merges():
    """A rare ending after a frequent beginning: seen often enough, it keeps states apart that would else be one."""
    few = S.Automaton({bytes([1, 1]): 2, bytes([1, 2]): 1})
    many = S.Automaton({bytes([1, 1]): 2000, bytes([1, 2]): 1000})
    assert many.log_probability(bytes([1, 1])) == pytest.approx(math.log(2 / 3)) and many.log_probability(bytes([1, 1, 1])) == float("-inf")
    assert few.log_probability(bytes([1, 1])) != pytest.approx(math.log(2 / 3))


def naive_spans(text, formats):
    """All spans by trying every maximal run between base spans, with plain sums of logs."""
    base = brute(text)
    covered = {i for s, _, e in base for i in range(s, e)}
    out, at = list(base), 0
    allowed = lambda i: text[i] in "+/_.=-" or (text[i].isascii() and text[i].isalnum())
    while at < len(text):
        end = at
        while end < len(text) and allowed(end) and end not in covered:
            end += 1
        if end > at:
            codes = [S.CODES[ord(c)] for c in text[at:end]]
            before = [0, *codes]
            plain = sum(formats.plain[a][b] for a, b in zip(before, [*codes, 0], strict=True))
            best = None
            for kind, a in sorted(formats.automata.items()):
                state, log = 0, 0.0
                for c in codes:
                    if c not in a.log_move[state]:
                        log = float("-inf")
                        break
                    log, state = log + a.log_move[state][c], a.next[state][c]
                else:
                    log += a.log_end[state]
                if log > float("-inf") and (best is None or log > best[0]):
                    best = (log, kind)
            if best and best[0] - plain >= formats.threshold:
                out.append((at, best[1], end))
        at = max(end, at + 1)
    return sorted(out)


def test_all_spans_equal_brute_force_on_whole_texts(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    formats, got = S.learn(docs), {r.doc_id: r.spans for r in S.op3_secrets(spark, sf).collect()}
    added = 0
    for r in docs.select("doc_id", "text").collect():
        want = naive_spans(r.text or "", formats)
        assert got[r.doc_id] == S.written(want)
        added += len(want) - len(brute(r.text))
    assert len(got) == docs.count()


def test_of_equal_likelihoods_the_first_kind():
    formats = S.Formats({2: {"0f" * 12: 3}, 0: {"0f" * 12: 3}}, S.np.ones(S.N * S.N), threshold=1.0)
    assert formats.least <= 24 and formats.kind("1a" * 12) == 0 and S.all_spans("see " + "1a" * 12, formats)[1]
    assert S.all_spans("nothing learned " + "x9" * 12, S.Formats({}, S.np.ones(S.N * S.N)))[1] == []


def test_pairs_are_not_sampled_and_repeats_count(spark):
    docs = spark.createDataFrame([(1, "token=abcdef12 plain A.b-c=d_e+f/g 9"), (1, "token=abcdef12 plain A.b-c=d_e+f/g 9"), (2, "token=zzzzzz99")], "doc_id long, text string")
    one, all_ = S.learn(docs, per_kind=1), S.learn(docs)
    assert one.plain == all_.plain
    assert all_.automata[0].log_move == S.Automaton(S.by_classes({"abcdef12": 2, "zzzzzz99": 1})).log_move


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.scan(docs).count() == 0


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    for r in S.op3_secrets(spark, sf).collect():
        b = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(S.written(b).encode()).hexdigest()
        assert {x for x in S.written(b).split(",") if x} <= set(r.spans.split(","))
