import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from atomframe.llm import merkle as M


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(i, source, lang, n, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def tree(leaves):
    """The root, and for each leaf its levels of (place, digests of its run)."""
    levels, walks = [leaves], [[] for _ in leaves]
    while len(levels[-1]) > 1:
        own = levels[-1]
        levels.append([h(*own[k : k + 8]) for k in range(0, len(own), 8)])
        for i, walk in enumerate(walks):
            at = i // 8 ** (len(levels) - 2)
            walk.append((at % 8, own[at // 8 * 8 : at // 8 * 8 + 8]))
    return levels[-1][0], walks


def lower(text):
    return text.translate(str.maketrans(M.UPPER, M.LOWER))


def brute(docs):
    by_lang = {}
    for d in docs:
        by_lang.setdefault(d[2], []).append((d[0] is not None, d[0] or 0, leaf(*d), d))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = [tree([x[2] for x in sorted(by_lang[lang], key=lambda x: x[:3])]) for lang in langs]
    root, over = tree([t[0] for t in trees])
    out = []
    for lang, (subroot, walks), top in zip(langs, trees, over, strict=True):
        for (_, _, own, d), walk in zip(sorted(by_lang[lang], key=lambda x: x[:3]), walks, strict=True):
            path = walk + top
            proof = h(*(x for at, run in path for k, x in enumerate(run) if k != at))
            got = own
            if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0 and d[4] is not None:
                got = leaf(*d[:4], lower(d[4]))
            for at, run in path:
                got = h(*(got if k == at else x for k, x in enumerate(run)))
            out.append((d[0], own, subroot, root, proof, got, got == root))
    return Counter(out)


def docs_of(n):
    langs = ["en", "en", "en", "de", "é", "", None]
    rows = [(i, f"s{i % 3}" if i % 5 else None, langs[i % 7] if i % 2 else "en", i if i % 4 else None, f"Text {i} É" if i % 6 else None) for i in range(n)]
    return rows + [(10**12, "big", "one", 1, "X" * 300_000), (None, None, None, None, None), (None, None, "en", None, "A"), (3, "s0", "en", 3, "Text 3 É"), (3, "s0", "en", 3, "Text 3 É"), (3, "other", "en", 3, "")]


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def frame(spark, docs):
    rows = [(*d, "x", 5, b"z") for d in docs]
    return spark.createDataFrame(rows, f"{SCHEMA}, tree string, index int, path binary").repartition(3)


def changed():
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", M.UPPER, M.LOWER))


@pytest.mark.parametrize("n,height", [(0, 3), (1, 3), (40, 1), (150, 1), (150, 2), (700, 3)])
def test_equal_to_the_definition(spark, n, height):
    docs = docs_of(n)
    got = M.verified(M.manifest(frame(spark, docs), changed(), height))
    assert Counter(map(tuple, got.collect())) == brute(docs)


@pytest.mark.parametrize("n", [*range(1, 18), 63, 64, 65, 73, 512, 513, 600])
def test_sweep_of_a_tree(n):
    """Whole runs of any height give the nodes and paths of the definition; the queue stays small."""
    leaves = [h(str(i)) for i in range(n)]
    root, walks = tree(leaves)
    rows = [{"total": n, "index": i, "digest": bytes.fromhex(x)} for i, x in enumerate(leaves)]
    height = 4
    nodes = {(level, i): d.hex() for level, i, d in M.forward(((r["index"], r["digest"]) for r in rows), n, height)}
    top = M.levels_in(n, height)
    assert top == 0 or nodes[top, 0] == root
    for x, path, walk in zip(leaves, M.paths(rows, b"", height), walks, strict=True):
        assert [(at, s.decode()) for at, s in M.steps(path)] == [(at, "".join(y for k, y in enumerate(run) if k != at)) for at, run in walk]
        assert M.folded(bytes.fromhex(x), path).hex() == root


def test_proofs_tell_a_changed_leaf(spark):
    docs = docs_of(100)
    found = M.manifest(frame(spark, docs), height=1)
    for r in M.proofs(found).collect():
        assert M.folded(bytes(r.leaf), bytes(r.path)) == found.root
        assert M.folded(hashlib.sha256(b"other").digest(), bytes(r.path)) != found.root


def test_a_path_that_does_not_come_is_an_error():
    rows = [{"tree": "=a", "run": 0, "index": 0, "total": 1, "digest": b"0" * 32}]

    class Batch(list):
        def to_pylist(self):
            return self

    with pytest.raises(ValueError, match="no path"):
        list(M._down(3, M._messages)(iter([Batch(rows)])))


def test_empty_table(spark):
    found = M.manifest(frame(spark, docs_of(1)).limit(0), changed())
    assert found.root is None and not M.verified(found).count() and not M.proofs(found).count()


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert Counter(map(tuple, M.op13_merkle(spark, sf).collect())) == brute(docs)
