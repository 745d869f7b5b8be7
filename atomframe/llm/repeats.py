"""Suffix-array deduplication by bucket-pointer refinement: removal of byte strings that occur more than once.

A byte goes if some string of ``LENGTH`` bytes that covers it also starts anywhere else. Full suffix sorting is not
needed for that: it is enough to refine the buckets of suffixes up to ``LENGTH`` bytes.

1. Every string has an anchor, its leftmost 32-byte gram of least name (a 64-bit hash, alike on every machine);
   neighbouring strings mostly share it. For each run of strings with one anchor a row goes to the bucket of the anchor's
   name: name, a name of the run's content, place. Runs that repeat within a task are settled there and sent once, so no
   bucket gets all copies of a popular passage.
2. In a bucket, an anchor that occurs once is settled: its strings are unique. Runs of equal content are settled too: all
   their strings repeat. Only runs that share an anchor but not the whole content are refined further.
3. These runs are cut into blocks by the place of the anchor in the string, so that equal strings lie in equal blocks,
   and all strings of a block share its core, the bytes between the last start and the first end. A block's bytes go to
   the bucket of the core's name, which parts a popular anchor by what is around it. A core of more than HOT blocks is not
   gathered: its blocks are halved by the place of the anchor, which makes their cores longer, and dealt again, down to
   single strings, whose number alone says that they repeat; what repeats within a task meanwhile is settled there and
   goes on once. In the buckets of the others the suffixes are refined: the
   buckets of their q-grams get pointers, and buckets of several suffixes are sorted again and again by the pointers at
   a later offset, each round using the pointers of the round before, which doubles the depth, up to ``LENGTH``.
4. The removed spans are joined to the texts and cut out.

Strings never cross documents; overlapping occurrences within a document count. Null and empty texts have no bytes.
Texts above ``PIECE`` bytes are handled in overlapping pieces. Equal rows remove each other's strings. Rows without
doc_id count like all others. Documents are told apart by a 64-bit name of id and text. Extra columns are ignored by
``repeated_spans`` and kept by ``cut``. An empty table has no repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from atomframe.llm.common import chunks, column, mixed, parts, ranges, raw, saved

LENGTH, GRAM = 200, 32
#: Grams in a string, which is also the longest run of strings with one anchor.
SPAN = LENGTH - GRAM + 1
#: Bytes handled at a time; longer texts are handled in overlapping pieces.
PIECE = 3 << 20
#: Places of the anchor in a string (SPAN of them) that make a block; bytes of blocks refined at a time.
WIDTH, REFINED = SPAN // 3 + 1, 1 << 20
#: Blocks of one core that a task gathers at most.
HOT = 64
PLACE = np.uint64((1 << 24) - 1)
THREE = np.uint64(3)


class Names:
    """Bucket names of all offsets of a byte buffer."""

    def __init__(self, data: bytes):
        n = max(0, len(data) - 7)
        self.eight = np.ndarray((n,), dtype="<u8", buffer=data, strides=(1,)) if n else np.zeros(0, np.uint64)
        sixteen = mixed(self.eight[:-8] * THREE + self.eight[8:]) if n > 8 else np.zeros(0, np.uint64)
        self.gram = mixed(sixteen[:-16] * THREE + sixteen[16:]) if len(sixteen) > 16 else np.zeros(0, np.uint64)

    def strings(self, at: np.ndarray) -> np.ndarray:
        """Names of the strings that start at ``at``."""
        out = self.gram[at]
        for k in range(1, LENGTH // GRAM):
            out = mixed(out * THREE + self.gram[at + k * GRAM])
        return mixed(out * THREE + self.eight[at + LENGTH - 8])


def _least(values: np.ndarray) -> np.ndarray:
    """For each start the place of the leftmost least of SPAN values."""
    n = len(values) - SPAN + 1
    keys = (values & ~PLACE) | np.arange(len(values), dtype=np.uint64)
    rows = -(-len(keys) // SPAN)
    table = np.full(rows * SPAN, np.iinfo(np.uint64).max, dtype=np.uint64)
    table[: len(keys)] = keys
    table = table.reshape(rows, SPAN)
    left = np.minimum.accumulate(table, axis=1).ravel()
    right = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(right[:n], left[SPAN - 1 : SPAN - 1 + n]) & PLACE).astype(np.int64)


def runs(data: bytes, ends: np.ndarray):
    """Runs of strings with one anchor in texts that lie one after another: anchor name, content name, text number,
    first string (place in the buffer), number of strings less one, and the anchor's place in the first string."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none.view(np.uint64), none.view(np.uint64), none, none, none, none
    names = Names(data)
    anchor = _least(names.gram[: len(data) - GRAM + 1])
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[: len(anchor)]
    start = np.flatnonzero(np.arange(len(anchor)) + LENGTH <= ends[text])
    if not len(start):
        return none.view(np.uint64), none.view(np.uint64), none, none, none, none
    first = np.append(True, (np.diff(start) != 1) | (np.diff(anchor[start]) != 0) | (np.diff(text[start]) != 0))
    low = start[first]
    more = np.diff(np.append(np.flatnonzero(first), len(start))) - 1
    content = mixed(names.strings(low) * THREE + names.strings(low + more) + more.astype(np.uint64))
    return names.gram[anchor[low]], content, text[low], low, more, anchor[low] - low


def pieces(batch: pa.RecordBatch) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Buffers of whole texts, or of pieces of a long one: bytes, ends, row numbers and the texts' own offsets."""
    texts, some, size = raw(batch), [], 0
    for i, t in enumerate(texts):
        if len(t) > PIECE:
            for a in range(0, len(t) - LENGTH + 1, PIECE):
                b = min(len(t), a + PIECE + LENGTH - 1)
                yield t[a:b], np.array([b - a]), np.array([i]), np.array([a])
        else:
            some.append(i)
            size += len(t)
    if some:
        yield b"".join(texts[i] for i in some), np.cumsum([len(texts[i]) for i in some]), np.array(some), np.zeros(len(some), np.int64)


def _first_of(a: np.ndarray, b: np.ndarray):
    """For rows of pairs: the order that sorts them, where each distinct pair begins and how often it occurs."""
    order = np.lexsort((b, a))
    new = np.append(True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1]))
    starts = np.flatnonzero(new)
    return order, starts, np.diff(np.append(starts, len(order)))


RUN = ["bucket", "anchors", "contents", "keys", "lows", "mores", "places", "flags"]
OUT = "key long, low int, more int, place int, settled boolean"


def _send_runs(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=PIECE):
            keys = np.asarray(column(batch, "key"))
            for data, ends, rows, offsets in pieces(batch):
                anchor, content, text, low, more, place = runs(data, ends)
                if not len(low):
                    continue
                begins = ends - np.diff(ends, prepend=0)
                low = low - begins[text] + offsets[text]
                key = keys[rows[text]]
                order, starts, counts = _first_of(anchor, content)
                many = np.repeat(counts > 1, counts)
                # what repeats here is settled: the places go out as they are, to any bucket, and one row to the anchor's
                parted = [(np.int64(x), order[many][x::buckets], 2) for x in range(min(buckets, int(many.sum())))]
                one = order[starts]
                bucket = (mixed(anchor[one]) % np.uint64(buckets)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                cuts = [*np.flatnonzero(np.diff(bucket[by], prepend=-1)), len(by)]
                flag = (counts > 1).astype(np.int8)
                out = [(int(x), at, np.full(len(at), f, np.int8)) for x, at, f in parted]
                out += [(int(bucket[by[a]]), one[by[a:b]], flag[by[a:b]]) for a, b in zip(cuts, cuts[1:], strict=False)]
                cells = [(x, anchor[at].tobytes(), content[at].tobytes(), key[at].tobytes(), low[at].astype(np.int32).tobytes(), more[at].astype(np.int16).tobytes(), place[at].astype(np.uint8).tobytes(), f.tobytes()) for x, at, f in out]
                yield pa.RecordBatch.from_arrays([pa.array([c[k] for c in cells], pa.binary() if k else pa.int32()) for k in range(len(RUN))], RUN)

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs that repeat as a whole (settled), and one run of each content that shares its anchor with others."""
    kept = {name: [] for name in RUN[1:]}
    kinds = dict(zip(RUN[1:], (np.uint64, np.uint64, np.int64, np.int32, np.int16, np.uint8, np.int8), strict=True))

    def rows(x: dict[str, np.ndarray], at, settled: bool) -> pa.RecordBatch:
        numbers = [pa.array(x[n][at].astype(np.int32)) for n in ("lows", "mores", "places")]
        return pa.RecordBatch.from_arrays([pa.array(x["keys"][at]), *numbers, pa.array([settled] * len(numbers[0]), pa.bool_())], ["key", "low", "more", "place", "settled"])

    for batch in batches:
        for cells in zip(*(column(batch, n).to_pylist() for n in RUN[1:]), strict=True):
            x = {n: np.frombuffer(c, kinds[n]) for n, c in zip(RUN[1:], cells, strict=True)}
            if x["flags"][0] == 2:
                yield rows(x, slice(None), True)
            else:
                for n in kept:
                    kept[n].append(x[n])
    if not kept["keys"]:
        return
    x = {n: np.concatenate(v) for n, v in kept.items()}
    order, starts, counts = _first_of(x["anchors"], x["contents"])
    flag = x["flags"][order]
    repeated = (counts > 1) | (np.maximum.reduceat(flag, starts) > 0)
    out = order[np.repeat(repeated, counts) & (flag == 0)]
    yield rows(x, out, True)
    # an anchor with several contents, not all of them settled
    names = x["anchors"][order[starts]]
    group = np.cumsum(np.append(True, names[1:] != names[:-1])) - 1
    several, open_ones = np.bincount(group), np.bincount(group, weights=~repeated)
    again = order[starts[(several[group] > 1) & (open_ones[group] > 0)]]
    yield rows(x, again, False)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs to refine, cut into blocks: rows (core, key, low, left, window), the window being the bytes of all its strings
    and ``left`` the bytes before the core in the first of them."""
    for batch in chunks(batches, limit=PIECE):
        out = []
        for text, key, todo in zip(raw(batch), column(batch, "key").to_pylist(), column(batch, "runs").to_pylist(), strict=True):
            for t in todo:
                anchor, last = t["low"] + t["place"], t["place"] - t["more"]
                for first in range(last // WIDTH * WIDTH, t["place"] + 1, WIDTH):
                    high, low = min(t["place"], first + WIDTH - 1), max(last, first)
                    core = text[anchor - first : anchor - first - WIDTH + 1 + LENGTH]
                    out.append((named(core), key, anchor - high, high - first, text[anchor - high : anchor - low + LENGTH]))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(BLOCK.values())], list(BLOCK))


BLOCK = {"core": pa.int64(), "key": pa.int64(), "low": pa.int32(), "left": pa.int32(), "window": pa.binary()}


def named(core: bytes) -> int:
    return xxhash.xxh3_64_intdigest(core) - (1 << 63)


def halves(row: tuple, width: int) -> Iterator[tuple]:
    """A block (key, low, left, window) of at most ``2 * width`` places of the anchor as blocks of at most ``width``, each led by
    its core: the bytes that all strings at these places have."""
    key, low, left, window = row
    last = left - (len(window) - LENGTH)  # the bytes before the core in the last string
    for a in (0, width):
        high, least = min(left, a + width - 1), max(last, a)
        if high >= least:
            at = left - high
            core = window[left - a : left - a + LENGTH - width + 1]
            yield named(core), key, low + at, high - a, window[at : at + high - least + LENGTH]


def _halve(width: int):
    """Blocks halved; those with one window in a task are settled (no core), but for one that goes on for the others' sake."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "window", PIECE):
            rows = [x for r in zip(*(column(batch, c).to_pylist() for c in ("key", "low", "left", "window")), strict=True) for x in halves(r, width)]
            copies: dict[bytes, int] = {}
            for r in rows:
                copies[r[4]] = copies.get(r[4], 0) + 1
            out, seen = [], set()
            for r in rows:
                if copies[r[4]] > 1:
                    out.append((None, *r[1:]))
                if r[4] not in seen:
                    out.append(r)
                    seen.add(r[4])
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(BLOCK.values())], list(BLOCK))

    return run


def parted(blocks: DataFrame, hot: int = HOT) -> Iterator[tuple[DataFrame, bool]]:
    """The blocks (a saved table) in tables of which no core has more than ``hot``; and tables of blocks of which all strings
    repeat (True)."""
    width = WIDTH
    while True:
        many = saved(blocks.groupBy("core").count().where(F.col("count") > hot).select("core"), "hot")
        if many.isEmpty():
            yield blocks, False
            return
        yield blocks.join(many, "core", "left_anti"), False
        left = blocks.join(many, "core", "left_semi")
        if width == 1:  # a core is a string
            yield left, True
            return
        width = -(-width // 2)
        cut = saved(left.select(*BLOCK).mapInArrow(_halve(width), "core long, key long, low int, left int, window binary"), "blocks")
        yield cut.where("core is null"), True
        blocks = cut.where("core is not null")


def refined(pointer: np.ndarray, depth: int, to: int) -> np.ndarray:
    """Bucket pointers (a bucket's is the sorted place of its first suffix) of ``depth`` bytes refined to ``to`` bytes:
    buckets of several suffixes are sorted by the pointers at offset ``to - depth``."""
    n = len(pointer)
    sizes = np.bincount(pointer, minlength=n)
    open_ = np.flatnonzero(sizes[pointer] > 1)
    later = np.minimum(open_ + (to - depth), n - 1)  # past the end there is no whole string
    keys = pointer[open_] * np.int64(n) + pointer[later]
    order = np.argsort(keys, kind="stable")
    keys, own = keys[order], pointer[open_[order]]
    at = np.arange(len(keys))
    new = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, bool)
    bucket = np.append(True, own[1:] != own[:-1]) if len(own) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(new, at, 0)) if len(at) else at
    base = np.maximum.accumulate(np.where(bucket, at, 0)) if len(at) else at
    out = pointer.copy()
    out[open_[order]] = own + first - base
    return out


def first_pointers(grams: np.ndarray) -> np.ndarray:
    """The bucket pointers of the q-grams at all places."""
    order = np.argsort(grams, kind="stable")
    new = np.append(True, grams[order][1:] != grams[order][:-1])
    out = np.empty(len(grams), np.int64)
    out[order] = np.maximum.accumulate(np.where(new, np.arange(len(grams)), 0))
    return out


def repeated_starts(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Which of the strings that start at ``starts`` occur more than once among them."""
    depth, pointer = GRAM, first_pointers(Names(data).gram)
    while depth < LENGTH:
        to = min(2 * depth, LENGTH)
        pointer, depth = refined(pointer, depth, to), to
    at = pointer[starts]
    return np.bincount(at, minlength=len(pointer))[at] > 1


def _refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order of their cores become runs of strings that occur more than once: rows (key, low, more)."""

    def runs_of(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        number: dict[bytes, int] = {}
        which = np.array([number.setdefault(window, len(number)) for _, _, window in rows])
        windows, copies = list(number), np.bincount(which)
        sizes = np.array([len(w) for w in windows])
        strings = sizes - LENGTH + 1
        starts = ranges(np.cumsum(sizes) - sizes, strings)
        twice = repeated_starts(b"".join(windows), starts)
        twice |= np.repeat(copies > 1, strings)
        # runs of repeated strings in each window, given to all blocks that have it
        owner = np.repeat(np.arange(len(windows)), strings)
        at = np.flatnonzero(twice)
        new = np.append(True, (np.diff(at) != 1) | (np.diff(owner[at]) != 0)) if len(at) else np.zeros(0, bool)
        begin = at[new]
        more = np.diff(np.append(np.flatnonzero(new), len(at))) - 1
        whose, place = owner[begin], begin - (np.cumsum(strings) - strings)[owner[begin]]
        by_window: list[list[tuple[int, int]]] = [[] for _ in windows]
        for w, p, m in zip(whose.tolist(), place.tolist(), more.tolist(), strict=True):
            by_window[w].append((p, m))
        out = [(key, low + p, m) for (key, low, _), w in zip(rows, which.tolist(), strict=True) for p, m in by_window[w]]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int32()))], ["key", "low", "more"])

    rows: list[tuple[int, int, bytes]] = []
    size, last, several = 0, None, False
    for batch in chunks(batches, "window", REFINED):
        for core, *row in zip(*(column(batch, c).to_pylist() for c in ("core", "key", "low", "window")), strict=True):
            if core != last:
                if rows and not several:  # a core that occurs once: its strings are unique
                    size -= len(rows.pop()[2])
                if size > REFINED:
                    yield runs_of(rows)
                    rows, size = [], 0
                last, several = core, False
            else:
                several = True
            rows.append(tuple(row))
            size += len(row[2])
    if rows and not several:
        rows.pop()
    if rows:
        yield runs_of(rows)


def document_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    return F.xxhash64(F.col(doc_id).isNull(), F.col(doc_id).cast("string"), F.col(text))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(key, runs): for each document with repeats, by its ``document_key``, the first string and number of strings less
    one of runs of repeated strings."""
    buckets = parts(docs.sparkSession)
    keyed = docs.select(F.col("text").cast("string").alias("text"), document_key().alias("key"))
    blobs = keyed.mapInArrow(_send_runs(buckets), "bucket int, " + ", ".join(f"{c} binary" for c in RUN[1:]))
    first = saved(blobs.repartition(buckets, "bucket").mapInArrow(_settle, OUT), "runs")
    # equal rows have the same runs
    todo = first.where("not settled").groupBy("key").agg(F.collect_set(F.struct("low", "more", "place")).alias("runs"))
    blocks = saved(keyed.join(todo, "key").mapInArrow(_blocks, "core long, key long, low int, left int, window binary"), "blocks")
    both = first.where("settled").select("key", "low", "more")
    for some, repeated in parted(blocks):
        if repeated:
            found = some.select("key", "low", (F.octet_length("window") - LENGTH).alias("more"))
        else:
            dealt = some.select("core", "key", "low", "window").repartition(buckets, "core").sortWithinPartitions("core")
            found = saved(dealt.mapInArrow(_refine, "key long, low int, more int"), "strings")
        both = both.unionByName(found)
    return both.groupBy("key").agg(F.collect_set(F.struct("low", "more")).alias("runs"))


def cut_spans(text: bytes, found: list[dict]) -> tuple[bytes, int, int]:
    """The remaining bytes, the number of removed bytes and of removed spans."""
    kept, at, removed, spans, open_end = [], 0, 0, 0, -1
    for low, end in sorted((r["low"], r["low"] + r["more"] + LENGTH) for r in found):
        if low > open_end:
            spans += 1
            kept.append(text[at:low])
            removed -= low
            if spans > 1:
                removed += open_end
            at = open_end = end
        elif end > open_end:
            at = open_end = end
    removed += open_end if spans else 0
    return b"".join([*kept, text[at:]]), removed, spans


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, found in zip(raw(batch), column(batch, "runs").to_pylist(), strict=True):
            rest, removed, spans = cut_spans(text, found or [])
            rows.append((len(text), removed, spans, hashlib.sha256(rest).hexdigest()))
        out = [pa.array([r[k] for r in rows], pa.string() if k == 3 else pa.int64()) for k in range(4)]
        yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), *out], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = column(batch, "text").to_pylist()
        for i, (data, found) in enumerate(zip(raw(batch), column(batch, "__runs").to_pylist(), strict=True)):
            if found:
                texts[i] = cut_spans(data, found)[0].decode(errors="ignore")
        out = [pa.array(texts, pa.string()) if c == "text" else column(batch, c) for c in batch.schema.names if c != "__runs"]
        yield pa.RecordBatch.from_arrays(out, [c for c in batch.schema.names if c != "__runs"])


def cut(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes removed; bytes of code points that were cut apart are dropped."""
    spans = repeated_spans(docs).withColumnRenamed("key", "__key").withColumnRenamed("runs", "__runs")
    return docs.withColumn("__key", document_key()).join(spans, "__key", "left").drop("__key").mapInArrow(_cut, docs.schema)


def op4_repeats(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    joined = docs.withColumn("key", document_key()).join(repeated_spans(docs), "key", "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(_apply, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
