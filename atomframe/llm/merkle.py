"""A Merkle manifest of documents by time-forward processing.

Each row is a leaf; a language's leaves, in order of doc_id, are a tree in which every FAN neighbours have one parent, and
the trees' roots (subroots), in order of the language, are the leaves of the topmost tree.

A node's label is its time: the last leaf below it, then its level, so children come before their parent. The sweep
sends each digest to the parent with the parent's time as priority; when that time has come, the queue hands over all
children in order. The queue is external: rows reach their task through a sort by label, a task's own queue (a heap)
holds what is open at one leaf (FAN for each level), and digests that leave a run of FAN ** height nodes are saved and
sorted into the next round. A round shrinks the trees by that factor, so no tree, however large, is gathered anywhere.

The reversed sweep goes through the saved rounds from the root down: a message with the path above it comes before the
nodes of a run (again by sorting), and each node's own siblings are put before it. A path is, level by level upwards, the
node's place among its siblings (one byte), their number (one byte) and their digests (32 bytes each, left to right).

Null values count as '-' in a leaf; null languages are a tree of their own, which comes first; rows without doc_id come
first in their tree. Rows of equal doc_id go by their leaf; equal rows are leaves of their own, next to each other.
Texts of any length are hashed whole. Extra columns are ignored, whatever their names. An empty table has no root and
no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from atomframe.llm.common import column, parts, saved

#: Children of a node, and levels that one round works off.
FAN, HEIGHT = 8, 3
# The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NODE = "tree string, index long, total long, digest binary"


def field(x: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = x.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(text: Column) -> Column:
    return F.sha2(F.concat(*[field(text if c == "text" else F.col(c)) for c in FIELDS]), 256)


def parent_of(digests: Iterable[bytes]) -> bytes:
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def levels_in(total: int, height: int) -> int:
    """Levels that a round adds above a tree's ``total`` nodes."""
    level = 0
    while level < height and -(-total // FAN**level) > 1:
        level += 1
    return level


def forward(nodes: Iterable[tuple[int, bytes]], total: int, height: int) -> Iterator[tuple[int, int, bytes]]:
    """The time-forward sweep over a tree's nodes (index, digest; ascending, whole runs): level, index and digest of each
    node above them, when its time has come."""
    top, queue = levels_in(total, height), []

    def send(level: int, index: int, digest: bytes) -> None:
        parent = index // FAN
        last = min((parent + 1) * FAN ** (level + 1), total) - 1
        heappush(queue, (last, level + 1, parent, index, digest))

    for index, digest in nodes:
        if top:
            send(0, index, digest)
        while queue and queue[0][0] <= index:
            label, children = queue[0][:3], []
            while queue and queue[0][:3] == label:
                children.append(heappop(queue)[4])
            digest = parent_of(children)
            yield *label[1:], digest
            if label[1] < top:
                send(*label[1:], digest)


def paths(rows: list[dict], above: bytes, height: int) -> list[bytes]:
    """The path of each node of one run, whose topmost node has the path ``above``."""
    total, first, last = rows[0]["total"], rows[0]["index"], rows[-1]["index"]
    digests = {(0, r["index"]): r["digest"] for r in rows}
    digests |= {(level, index): digest for level, index, digest in forward(((r["index"], r["digest"]) for r in rows), total, height)}
    top = levels_in(total, height)
    known = {first // FAN**top: above}
    for level in reversed(range(top)):
        size, below = FAN**level, {}
        for parent, path in known.items():
            run = range(parent * FAN, min((parent + 1) * FAN, last // size + 1))
            for index in run:
                siblings = b"".join(digests[level, i] for i in run if i != index)
                below[index] = bytes((index - run[0], len(run) - 1)) + siblings + path
        known = below
    return [known[r["index"]] for r in rows]


def steps(path: bytes) -> Iterator[tuple[int, bytes]]:
    """Place and siblings (as hex text) of each level of a path."""
    at = 0
    while at < len(path):
        end = at + 2 + 32 * path[at + 1]
        yield path[at], path[at + 2 : end].hex().encode()
        at = end


def folded(digest: bytes, path: bytes) -> bytes:
    """The root that a leaf's digest and its path give."""
    for place, siblings in steps(path):
        digest = hashlib.sha256(siblings[: 64 * place] + digest.hex().encode() + siblings[64 * place :]).digest()
    return digest


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task and each row's place among its rows of the same tree."""
    part, last, at = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        found = []
        for tree in column(batch, "tree").to_pylist():
            at, last = (at + 1 if tree == last else 0), tree
            found.append(at)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(found), pa.int32()), pa.array(found, pa.int64())], [*batch.schema.names, "part", "place"])


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``index``, the place in their tree by ``order``, and ``total``, the tree's rows: a saved table. Rows
    are dealt by range; the places in a task are counted on from those of the tasks before."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    dealt = rows.repartitionByRange(parts(rows.sparkSession), "tree", *order).sortWithinPartitions("tree", *order)
    placed = saved(dealt.mapInArrow(_places, f"{schema}, part int, place long"), "placed")
    counts = placed.groupBy("part", "tree").agg(F.count("*").alias("n"))  # one row for each task and tree in it
    tree = Window.partitionBy("tree")
    bases = counts.select("part", "tree", (F.sum("n").over(tree.orderBy("part")) - F.col("n")).alias("before"), F.sum("n").over(tree).alias("total"))
    found = placed.join(bases, ["part", "tree"])
    return saved(found.select(*rows.columns, (F.col("before") + F.col("place")).alias("index"), "total"), "leaves")


def _up(height: int):
    kinds = {"tree": pa.string(), "index": pa.int64(), "total": pa.int64(), "digest": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in batch.to_pylist())
        for (tree, total), own in itertools.groupby(rows, lambda r: (r["tree"], r["total"])):
            top = levels_in(total, height)
            out = ((tree, index, -(-total // FAN**top), digest) for level, index, digest in forward(((r["index"], r["digest"]) for r in own), total, height) if level == top)
            while some := list(itertools.islice(out, 5000)):
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*some, strict=True), kinds.values(), strict=True)], list(kinds))

    return run


def dealt(rows: DataFrame, height: int) -> DataFrame:
    """Rows by runs of nodes; in a run what has no index (a message) comes first, then nodes by index."""
    run = F.expr(f"index div {FAN**height}")
    run = F.coalesce("run", run) if "run" in rows.columns else run
    return rows.withColumn("run", run).repartition("tree", "run").sortWithinPartitions("tree", "run", F.asc_nulls_first("index"))


def rounds_up(nodes: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """The rounds of the sweep: ``nodes`` (tree, index, total, digest), then what is left of them, up to single nodes."""
    rounds, most = [nodes], nodes.agg(F.max("total")).first()[0] or 0
    while most > 1:
        above = dealt(rounds[-1].where("total > 1").select("tree", "index", "total", "digest"), height).drop("run")
        rounds.append(saved(above.mapInArrow(_up(height), NODE), "nodes"))
        most = -(-most // FAN**height)
    return rounds


def tops(rounds: list[DataFrame]) -> DataFrame:
    """Each tree's root: tree, digest, and the round in which it is left."""
    found = [x.where("total = 1").select("tree", "digest", F.lit(k).alias("round")) for k, x in enumerate(rounds)]
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def _down(height: int, finish: Callable[[list[dict]], pa.RecordBatch]):
    """Rows of runs, each led by its message (path and top): the nodes' rows with their own path, through ``finish``."""

    def done(rows: list[dict], message: dict | None) -> list[dict]:
        if not rows:
            return []
        if message is None or (message["tree"], message["run"]) != (rows[0]["tree"], rows[0]["run"]):
            raise ValueError(f"no path has come for run {rows[0]['run']} of {rows[0]['tree']}")
        for row, path in zip(rows, paths(rows, message["path"], height), strict=True):
            row |= {"path": path, "top": message["top"]}
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, message, out = [], None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["index"] is not None:
                    rows.append(row)
                    continue
                out += done(rows, message)
                rows, message = [], row
                if len(out) >= 2000:
                    yield finish(out)
                    out = []
        yield finish(out + done(rows, message))

    return run


def _messages(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"tree": pa.string(), "index": pa.int64(), "path": pa.binary(), "top": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in kinds.items()], list(kinds))


def rounds_down(rounds: list[DataFrame], above: DataFrame, finish, schema: str, height: int = HEIGHT) -> DataFrame:
    """The reversed sweep. ``above``: tree, path, top and round (see ``tops``). ``finish`` makes the result's rows of the
    first round's with path (to the root) and top (their tree's root)."""
    below = None
    for k in reversed(range(len(rounds))):
        messages = above.where(F.col("round") == k).select("tree", F.lit(0).cast("long").alias("run"), "path", "top")
        if below is not None:
            messages = messages.unionByName(below.select("tree", F.col("index").alias("run"), "path", "top"))
        led = dealt(rounds[k].unionByName(messages, allowMissingColumns=True), height)
        if not k:
            return led.mapInArrow(_down(height, finish), schema)
        below = saved(led.mapInArrow(_down(height, _messages), "tree string, index long, path binary, top binary"), "paths")
    raise AssertionError


@dataclass
class Manifest:
    """Rounds of the documents' trees and of the topmost one; ``root`` is None without documents."""

    rounds: list[DataFrame]
    topmost: list[DataFrame]
    root: bytes | None
    height: int


def manifest(docs: DataFrame, changed: Column | None = None, height: int = HEIGHT) -> Manifest:
    """The trees of ``docs``. ``changed``: a text to be put in the place of a row's own when it is verified; null where
    it is to stay."""
    rows = docs.select(*FIELDS, F.lit(None).cast("string").alias("changed") if changed is None else changed.alias("changed"))
    other = F.when(F.col("changed").isNotNull(), F.unhex(leaf_of(F.col("changed"))))
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    leaves = rows.select("doc_id", tree.alias("tree"), F.unhex(leaf_of(F.col("text"))).alias("digest"), other.alias("other"), F.monotonically_increasing_id().alias("row"))
    found = rounds_up(numbered(saved(leaves, "digests"), ["doc_id", "digest", "row"]).drop("row"), height)
    over = tops(found).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest", "round")
    topmost = rounds_up(numbered(over, ["name"]), height)
    root = tops(topmost).first()
    return Manifest(found, topmost, bytes(root.digest) if root else None, height)


def delivered(found: Manifest, make: Callable[[dict], dict], schema: str) -> DataFrame:
    """One row of ``schema`` for each document, by ``make`` of its row (doc_id, digest, other, path, top)."""
    out = pa.schema([(f.name, KINDS[f.dataType.typeName()]) for f in found.rounds[0].sparkSession.createDataFrame([], schema).schema])

    def finish(rows: list[dict]) -> pa.RecordBatch:
        made = list(map(make, rows))
        return pa.RecordBatch.from_arrays([pa.array([m[f.name] for m in made], f.type) for f in out], schema=out)

    def names(rows: list[dict]) -> pa.RecordBatch:
        kinds = {"name": pa.string(), "path": pa.binary(), "round": pa.int32(), "digest": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in kinds.items()], list(kinds))

    spark = found.rounds[0].sparkSession
    start = tops(found.topmost).select("tree", F.lit(b"").alias("path"), F.col("digest").alias("top"), "round")
    over = rounds_down(found.topmost, start, names, "name string, path binary, round int, digest binary", found.height)
    above = saved(over.select(F.col("name").alias("tree"), "path", F.col("digest").alias("top"), "round"), "subroots")
    return rounds_down(found.rounds, above, finish, schema, found.height)


KINDS = {"long": pa.int64(), "integer": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def proofs(found: Manifest) -> DataFrame:
    """doc_id, leaf, subroot (digests) and the path from the leaf to the root."""
    kind = found.rounds[0].schema["doc_id"].dataType.simpleString()
    return delivered(found, lambda r: {"doc_id": r["doc_id"], "leaf": r["digest"], "subroot": r["top"], "path": r["path"]}, f"doc_id {kind}, leaf binary, subroot binary, path binary")


def verified(found: Manifest) -> DataFrame:
    """Each document's leaf, subroot, root and proof, the root that its changed (else own) leaf gives with that proof, and
    whether it is the root. Digests are hex text."""
    kind, root = found.rounds[0].schema["doc_id"].dataType.simpleString(), found.root.hex() if found.root else None

    def make(r: dict) -> dict:
        proof = hashlib.sha256(b"".join(siblings for _, siblings in steps(r["path"]))).hexdigest()
        got = folded(r["other"] or r["digest"], r["path"]).hex()
        return {"doc_id": r["doc_id"], "leaf": r["digest"].hex(), "subroot": r["top"].hex(), "root": root, "proof_sha256": proof, "folded_root": got, "verified": got == root}

    return delivered(found, make, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def op13_merkle(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    some = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return verified(manifest(docs, F.when(some, F.translate("text", UPPER, LOWER))))


SQL = r"""
with recursive f as (select row_number() over () as r, doc_id, text, lang, case when doc_id is null then '-' else strlen(cast(doc_id as varchar)) || ':' || doc_id end || case when source is null then '-' else strlen(source) || ':' || source end
  || case when lang is null then '-' else strlen(lang) || ':' || lang end || case when n_chars is null then '-' else strlen(cast(n_chars as varchar)) || ':' || n_chars end as head from documents),
h as (select r, doc_id, coalesce('=' || lang, '') as tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf, sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) as other,
  xor(list_reduce(list_prepend(4294967295, [cast(ascii(x) as bigint) for x in string_split(cast(doc_id as varchar), '')]), lambda c, b: list_reduce(list_prepend(xor(c, b), cast([0, 0, 0, 0, 0, 0, 0, 0] as bigint[])), lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295) as crc from f),
l as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf, r) - 1 as i, count(*) over (partition by tree) as n from h),
up as (select tree, 0 as level, i, n, leaf as d from l union all select tree, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(d, '' order by i)) from up where n > 1 group by tree, level, i // 8, n),
s as (select tree, d as subroot, row_number() over (order by tree) - 1 as i, count(*) over () as n from up where n = 1),
topmost as (select 0 as level, i, n, subroot as d from s union all select level + 1, i // 8, (n + 7) // 8, sha256(string_agg(d, '' order by i)) from topmost where n > 1 group by level, i // 8, n),
runs as (select tree, level, i // 8 as p, string_agg(d, '' order by i) as run from (select tree, level, i, n, d from up union all select '~', level, i, n, d from topmost) where n > 1 group by tree, level, i // 8),
walk as (select r, tree, 0 as level, i, n, '' as proof, case when crc % 3 = 0 then other else leaf end as fold from l
  union all
  select w.r, case when w.n > 1 then w.tree else '~' end, case when w.n > 1 then w.level + 1 else 0 end, case when w.n > 1 then w.i // 8 else s.i end, case when w.n > 1 then (w.n + 7) // 8 else s.n end,
    case when w.n > 1 then w.proof || run[:64 * (w.i % 8)] || run[64 * (w.i % 8) + 65:] else w.proof end, case when w.n > 1 then sha256(run[:64 * (w.i % 8)] || w.fold || run[64 * (w.i % 8) + 65:]) else w.fold end
  from walk w left join runs on w.n > 1 and runs.tree = w.tree and runs.level = w.level and p = w.i // 8 left join s on w.n = 1 and s.tree = w.tree where w.n > 1 or w.tree <> '~')
select doc_id, leaf, subroot, d as root, sha256(proof) as proof_sha256, fold as folded_root, fold = d as verified
from walk join l using (r) join s on s.tree = l.tree join topmost on topmost.n = 1 where walk.tree = '~' and walk.n = 1
"""
