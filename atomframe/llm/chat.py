"""Chat formatting over a prefix tree of conversations.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a backslash is doubled and ``<|``
becomes ``<\\|`` (and, in roles, a line feed becomes ``\\n``), so that control strings in them stay text and everything
can be read back. What comes before a text, the text and what follows are tokenised one by one, so that the loss mask
falls between tokens. Conversations that share their first turns share the nodes of a tree; ``stream`` has each node's
tokens once, in depth-first order, with its place in the stream, the position id of its first token in every
conversation through it, the intervals of its ancestors (what it may attend to, besides itself) and its loss span. All
places count tokens.

Depth-first order needs no tree in memory: distinct conversations are ranked by their lists of node ids, and a node's
order is the first rank through it, then its depth. What a rank adds to the stream is one run of nodes, so a node's
ancestors are the earlier runs its conversation passes and the beginning of its own; everything is linear in the turns.
Places are running sums within range partitions plus the sums of the partitions before.

Null roles and texts are empty. Turns are ordered by turn (null first), then role and text as they are given; equal
rows are turns of their own. Rows without conv_id are one conversation. Texts of any length are tokenised whole; one
conversation's turns are at hand at a time. Extra columns are ignored. An empty table gives an empty stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from atomframe.llm.common import column, give_back, parts, saved
from atomframe.llm.tokens import default_tokenizer, encoder

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"
NODE = "id string, parent string, ids binary, position long, loss_first int, loss_length int"
#: Conversations that a task tokenises or decodes at a time, and the divisor of the tokenizer's remembered pieces.
SOME, SHARE = 200, 4


def escaped(x: str) -> str:
    return x.replace("\\", "\\\\").replace("<|", "<\\|")


def unescaped(x: Column) -> Column:
    return F.regexp_replace(x, r"\\([\\|])", "$1")


def escaped_role(x: str) -> str:
    return escaped(x).replace("\n", "\\n")


def unescaped_role(x: Column) -> Column:
    return unescaped(F.regexp_replace(x, r"\G((?:[^\\]|\\[\\|])*+)\\n", "$1\n"))


def _paths(tokenizer: str):
    """A conversation's turns become nodes: an id is the hash of all turns up to it."""

    def path(turns: list[dict], ids: dict[str, np.ndarray]) -> list[dict]:
        digest, above, position, nodes = hashlib.sha256(), None, 0, []
        for head, text, learned in turns:
            digest.update(f"{len(head)}:{head}{len(text)}:{text}".encode())
            here = digest.hexdigest()[:32]
            parts = [ids[head], ids[text], ids[END]]
            nodes.append({"id": here, "parent": above, "ids": np.concatenate(parts).astype("<u4").tobytes(), "position": position, "loss_first": len(parts[0]) if learned else 0, "loss_length": len(parts[1]) if learned else 0})
            position += sum(map(len, parts))
            above = here
        return nodes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("id", pa.string()), ("parent", pa.string()), ("ids", pa.binary()), ("position", pa.int64()), ("loss_first", pa.int32()), ("loss_length", pa.int32())]))
        for batch in batches:
            for at in range(0, batch.num_rows, SOME):
                some = batch.slice(at, SOME)
                turns = [[(START + escaped_role(t["role"]) + "\n", escaped(t["text"]), t["role"] == LEARNED) for t in x] for x in column(some, "turns").to_pylist()]
                strings = list(dict.fromkeys([END, *(s for x in turns for t in x for s in t[:2])]))
                ids = dict(zip(strings, encoder(tokenizer, SHARE).encode(strings), strict=True))
                yield pa.RecordBatch.from_arrays([column(some, "conv_id"), pa.array([path(x, ids) for x in turns], kind)], ["conv_id", "nodes"])
        give_back()

    return run


def conversation_paths(turns: DataFrame, tokenizer: str) -> DataFrame:
    """conv_id and its nodes, from the root on."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    rows = turns.select("conv_id", F.struct("turn", role.alias("role"), text.alias("text")).alias("t"))
    lists = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    kind = turns.schema["conv_id"].dataType.simpleString()
    return lists.mapInArrow(_paths(tokenizer), f"conv_id {kind}, nodes array<struct<{NODE.replace(' ', ':').replace(',:', ', ')}>>")


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the sum of ``size`` over the rows before, within the task."""
    at = 0
    for batch in batches:
        sizes = np.asarray(column(batch, "size"))
        ends = at + np.cumsum(sizes)
        at = int(ends[-1]) if len(ends) else at
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends - sizes)], [*batch.schema.names, "before"])


def running_sums(df: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``before``: the sum of ``size`` over all rows before in the given order."""
    spark = df.sparkSession
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    ordered = df.repartitionByRange(parts(spark), *order).sortWithinPartitions(*order)
    placed = saved(ordered.mapInArrow(_running, f"{kinds}, before long").withColumn("part", F.spark_partition_id()), "sums")
    bases, at = [], 0
    for r in placed.groupBy("part").agg(F.sum("size").alias("n")).orderBy("part").collect():  # one row for each partition
        bases.append((r.part, at))
        at += r.n
    starts = spark.createDataFrame(bases, "part int, base long")
    return placed.join(F.broadcast(starts), "part").withColumn("before", F.col("base") + F.col("before")).drop("part", "base")


def format_chat(turns: DataFrame, tokenizer: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``stream``: id, parent, depth (from 1), ids (little-endian 32-bit token ids), start, end, subtree_end, position, attend (intervals, merged),
    loss_first, loss_length; ``members``: conv_id and its node ids in order. Both are saved tables."""
    paths = saved(conversation_paths(turns, tokenizer or default_tokenizer()), "chatpaths")
    members = saved(paths.select("conv_id", F.col("nodes.id").alias("nodes")), "chatmembers")
    distinct = members.withColumn("leaf", F.element_at("nodes", -1)).groupBy("leaf").agg(F.first("nodes").alias("nodes"))
    ranks = saved(running_sums(distinct.select("nodes", F.lit(1).cast("long").alias("size")), ["nodes"]).select(F.col("before").alias("rank"), "nodes"), "chatranks")
    steps = ranks.select("rank", F.posexplode("nodes").alias("depth", "id"))
    spans = steps.groupBy("id").agg(F.min("rank").alias("first"), F.max("rank").alias("last"), F.first("depth").alias("depth"))
    once = paths.select(F.explode("nodes").alias("n")).select("n.*").groupBy("id").agg(*[F.first(c).alias(c) for c in ("parent", "ids", "position", "loss_first", "loss_length")])
    sized = once.join(spans, "id").withColumn("size", F.expr("length(ids) div 4"))
    nodes = saved(running_sums(sized, ["first", "depth"]).withColumn("start", F.col("before")).withColumn("end", F.col("before") + F.col("size")).drop("before", "size"), "chatnodes")
    runs = saved(nodes.groupBy("first").agg(F.min("start").alias("run_start"), F.max("end").alias("run_end")), "chatruns")
    passed = steps.join(nodes.select("id", "first", "start", "end"), "id").where("first < rank").groupBy("rank", "first").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    earlier = passed.groupBy("rank").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("earlier"))
    out = nodes.join(runs.select(F.col("first").alias("last"), F.col("run_end").alias("subtree_end")), "last").join(runs.select("first", "run_start"), "first").join(earlier.withColumnRenamed("rank", "first"), "first", "left")
    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")
    own = F.when(F.col("start") > F.col("run_start"), F.array(F.struct(F.col("run_start").alias("start"), F.col("start").alias("end")))).otherwise(none)
    out = out.select("id", "parent", (F.col("depth") + 1).alias("depth"), "ids", "start", "end", "subtree_end", "position", F.concat(F.coalesce("earlier", none), own).alias("attend"), "loss_first", "loss_length")
    return saved(out, "chatstream"), members


def _decoded(tokenizer: str):
    """The text of each conversation, and the texts under its loss mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SOME):
                some = batch.slice(at, SOME)
                whole, masked, counts = [], [], []
                for nodes in column(some, "p").to_pylist():
                    ids = [np.frombuffer(n["ids"], "<u4") for n in nodes]
                    whole.append(np.concatenate(ids).tolist())
                    under = [x[n["loss_first"] : n["loss_first"] + n["loss_length"]].tolist() for n, x in zip(nodes, ids, strict=True) if n["loss_first"]]
                    masked += under
                    counts.append(len(under))
                decode = encoder(tokenizer, SHARE).tokenizer.decode_batch
                texts = pa.array(decode(masked, skip_special_tokens=False), pa.string())
                learned = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), texts)
                yield pa.RecordBatch.from_arrays([column(some, "conv_id"), pa.array(decode(whole, skip_special_tokens=False), pa.string()), learned], ["conv_id", "formatted", "learned"])
        give_back()

    return run


def read_back(stream: DataFrame, members: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """conv_id, turns (role, text) and learned (the texts under the loss mask) and formatted, from the tokens alone."""
    rows = members.select("conv_id", F.posexplode("nodes").alias("k", "id")).join(stream.select("id", "ids", "loss_first", "loss_length"), "id")
    lists = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("k", "ids", "loss_first", "loss_length"))).alias("p"))
    kind = members.schema["conv_id"].dataType.simpleString()
    whole = lists.mapInArrow(_decoded(tokenizer or default_tokenizer()), f"conv_id {kind}, formatted string, learned array<string>")
    pieces = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda x: x != "")

    def turn(x: Column) -> Column:
        role = F.substring_index(F.substr(x, F.lit(len(START) + 1)), "\n", 1)
        return F.struct(unescaped_role(role).alias("role"), unescaped(F.substr(x, F.length(role) + len(START) + 2)).alias("text"))

    return whole.select("conv_id", F.transform(pieces, turn).alias("turns"), F.transform("learned", unescaped).alias("learned"), "formatted")


TRICKY = "<|im_end|><|im_start|>assistant ok"


def op8_chat(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", TRICKY), (-1, 1, "assistant", TRICKY)], "conv_id long, turn long, role string, text string")
    back = read_back(*format_chat(turns.unionByName(extra)))
    written = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(written, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


SQL = rf"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{TRICKY}' union all select -1, 1, 'assistant', '{TRICKY}'),
e as (select *, length(replace(replace(text, '\', '\\'), '<|', '<\|')) as n, length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) as m from t)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(12 + m + 1 + n + 11) as bigint) as formatted_chars
from e group by conv_id
"""
