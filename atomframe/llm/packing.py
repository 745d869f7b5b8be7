"""Best-fit packing by length-histogram planning.

The documents are tokenised and cut into pieces of at most ``size`` ids (a shorter piece comes first). Best-fit
decreasing runs over the counts of the at most ``size`` lengths, not over pieces: it yields slots (sequence, offset)
for each length. A piece takes the slot of its rank among the pieces of its length: a rank within its task plus the
counts of the tasks before it, so no length, however frequent, is gathered anywhere. The ids go with their piece to its
place as little-endian 32-bit numbers; ``ids_crc32`` is that of the ids placed.

Null text is empty: one piece with the end id only. Every row is packed: equal rows too, rows of one doc_id and rows without
one, each with pieces of its own. Very long texts are tokenised whole, alone. Of equally good sequences the first is taken.
Extra columns are ignored, whatever their names. An empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from atomframe.llm.common import chunks, column, held, saved
from atomframe.llm.tokens import OWNER, default_tokenizer, encoder


#: Text bytes that one task encodes at a time, and the divisor of its remembered pieces: ids are carried, so less than
#: elsewhere.
PIECE_BYTES, SHARE = 1 << 20, 2
#: Rows (task, length, number of pieces before) that are broadcast at most, some 80 bytes each.
BASES = 1_000_000


def best_fit(counts: dict[int, int], size: int) -> list[tuple[int, list[int]]]:
    """Patterns (number of sequences, the lengths in each) that hold ``counts[length]`` pieces of each length."""
    open_bins: dict[int, list[tuple[int, list[int]]]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        fits = sorted(room for room in open_bins if room >= length)
        for room in fits:
            group = open_bins.pop(room)
            # pieces of this length go into one bin as long as they fit, the fullest bins first
            each = room // length
            for bins, pattern in group:
                full = min(bins, left // each)
                if full:
                    open_bins.setdefault(room - each * length, []).append((full, pattern + [length] * each))
                    left -= full * each
                if full < bins:
                    some = left
                    if some:
                        open_bins.setdefault(room - some * length, []).append((1, pattern + [length] * some))
                        left = 0
                    if bins - full - (some > 0):
                        open_bins.setdefault(room, []).append((bins - full - (some > 0), pattern))
            if not left:
                break
        each = size // length
        if left // each:
            open_bins.setdefault(size - each * length, []).append((left // each, [length] * each))
        if left % each:
            open_bins.setdefault(size - left % each * length, []).append((1, [length] * (left % each)))
    return [x for _, group in sorted(open_bins.items()) for x in group]


def slots(plan: list[tuple[int, list[int]]]) -> dict[int, list[tuple[int, int, int, list[int]]]]:
    """For each length, in rank order: first rank, first sequence, number of sequences, offsets in each."""
    out: dict[int, list] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for bins, pattern in plan:
        offsets: dict[int, list[int]] = {}
        at = 0
        for length in pattern:
            offsets.setdefault(length, []).append(at)
            at += length
        for length, places in offsets.items():
            out.setdefault(length, []).append((ranks.get(length, 0), sequence, bins, places))
            ranks[length] = ranks.get(length, 0) + bins * len(places)
        sequence += bins
    return out


def _pieces(tokenizer: str, end_id: int, size: int, share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(size + 1, dtype=np.int64)
        for batch in chunks(batches, limit=PIECE_BYTES, owner=OWNER):
            rows, data = [], []
            for i, ids in enumerate(encoder(tokenizer, share).encode([t or "" for t in column(batch, "text").to_pylist()])):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                first = len(ids) % size or size
                cuts = [0, *range(first, len(ids) + 1, size)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append((i, k, a, b - a))
                    data.append(ids[a:b].tobytes())
            table = np.array(rows, dtype=np.int64)
            rank = np.zeros(len(rows), dtype=np.int64)
            order = np.argsort(table[:, 3], kind="stable")
            lengths = table[order, 3]
            starts = np.flatnonzero(np.append(True, lengths[1:] != lengths[:-1]))
            runs = np.diff(np.append(starts, len(lengths)))
            rank[order] = np.arange(len(rows)) - np.repeat(starts, runs) + seen[lengths]
            seen[lengths[starts]] += runs
            ids = column(batch, "doc_id").take(pa.array(table[:, 0]))
            out = [ids, pa.array(table[:, 1].astype(np.int32)), *(pa.array(table[:, c]) for c in (2, 3)), pa.array([part] * len(rows), pa.int32()), pa.array(rank), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "piece", "start", "length", "part", "rank", "ids"])

    return run


def _placed(plan: dict[int, list]):
    """A function of length and rank: the place in the plan. Ids stay outside Python."""
    tables = {}
    for length, rows in plan.items():
        tables[length] = (np.array([r[0] for r in rows]), [(r[1], np.array(r[3])) for r in rows])

    @F.arrow_udf("sequence_id long, offset long")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        held("")
        length, rank = np.asarray(length), np.asarray(rank)
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for n in np.unique(length):
            firsts, rows = tables[int(n)]
            mine = np.flatnonzero(length == n)
            which = np.searchsorted(firsts, rank[mine], side="right") - 1
            for w in np.unique(which):
                some = mine[which == w]
                begin, places = rows[w]
                q = rank[some] - firsts[w]
                sequence[some], offset[some] = begin + q // len(places), places[q % len(places)]
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    return place


def pack(docs: DataFrame, size: int = 1024, tokenizer: str | None = None, end_id: int = 2, with_ids: bool = True, share: int = SHARE, most_bases: int = BASES) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, ids, sequence_id and offset; without ids, they
    are placed all the same but not returned. ``share`` divides the pieces that a worker remembers."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    pieces = saved(rows.mapInArrow(_pieces(tokenizer or default_tokenizer(), end_id, size, share), f"doc_id {kind}, piece int, start long, length long, part int, rank long, ids binary"), "pieces")
    counts = saved(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "counts", light=True)
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `size` rows
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    # a row for each task and length in it: few are broadcast, so that the ids are not shuffled; many are joined by both keys
    bases = counts.select("part", "length", before.alias("before"))
    bases = F.broadcast(bases) if counts.count() <= most_bases else bases.hint("merge")
    ranked = pieces.join(bases, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    placed = ranked.withColumn("place", _placed(slots(best_fit(totals, size)))("length", "rank"))
    return placed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), *["ids"] * with_ids, "place.sequence_id", "place.offset")


def op7_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_ids=False)
