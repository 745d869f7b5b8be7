"""Benchmark decontamination: training windows looked up in a broadcast hash set of normalised test n-grams.

Words are runs of digits, ASCII letters (lower-cased) and non-ASCII characters. Every run of ``n`` words of a
benchmark item is a window; an item with fewer words, but not none, is one window. Fingerprint hits are verified
word by word. At most ``max_windows`` windows are broadcast at a time. A benchmark of that size is scanned in one pass;
a larger one in slices, each a job of its own that writes the hits it finds, which are then joined to the texts: what a
task holds does not grow with the benchmark. Only windows and their numbers are sent out; items are joined to the
numbers that were hit.

``decontaminate`` cuts hit spans out, looks at what is left of a changed text again (a cut can bring the words of a
window together) until nothing is hit, and drops documents that lose too much.

Null or empty texts have no words and no hits. Very long texts are scanned whole, alone. Benchmark rows without an
item_id or words are ignored; windows of several items, and repeated items, count for each item once. Rows with equal
ids, and equal rows, are judged one by one. Columns other than those named are passed through by ``decontaminate`` and
ignored by ``find_hits``, whatever their names. Empty tables give empty or clean results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from atomframe.llm.common import WORD_CHUNK, chunks, column, numbered, raw, saved, windows, word_hashes

#: Every byte to itself if it belongs to a word, upper case to lower case, all others to a space.
NORMAL = bytes((b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32) for b in range(256))
HITS = "n_words long, spans array<struct<first:int,end:int>>, windows array<long>"
SPANS = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
#: Windows that are broadcast at a time, about 60 bytes each.
MAX_WINDOWS = 200_000
#: Size of the table that sorts out windows before the exact lookup.
SIEVE = 1 << 20


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def _item_windows(n: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            ids, keys, sizes = [], [], []
            for item, text in zip(column(batch, "item_id").to_pylist(), raw(batch), strict=True):
                words = words_of(text)
                size = min(n, len(words))
                for i in range(len(words) - size + 1 if size else 0):
                    ids.append(item)
                    keys.append(b" ".join(words[i : i + size]))
                    sizes.append(size)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32())], ["item", "gram", "size"])

    return cut


def benchmark_windows(bench: DataFrame, n: int = 10) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (gram, size, window: a number), and the items of each number (window, item): saved tables."""
    rows = bench.where("item_id is not null").select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    grams = saved(rows.mapInArrow(_item_windows(n), "item string, gram binary, size int").distinct(), "benchmark")
    numbers = saved(grams.select("gram", "size").distinct().withColumn("window", F.monotonically_increasing_id()), "windows")
    return numbers, grams.join(numbers, ["gram", "size"]).select("window", "item")


class Windows:
    """A slice of the benchmark's windows as hash tables by size, each with a sieve before it."""

    def __init__(self, rows: list[tuple[bytes, int, int]]):
        self.tables: dict[int, dict[int, list]] = {}
        for gram, size, number in rows:
            h = int(windows(word_hashes(gram.split(b" ")), size)[0])
            self.tables.setdefault(size, {}).setdefault(h, []).append((gram, number))
        self.sieves = {}
        for size, table in self.tables.items():
            self.sieves[size] = np.zeros(SIEVE, dtype=bool)
            self.sieves[size][np.fromiter(table, dtype=np.uint64) % np.uint64(SIEVE)] = True

    def find(self, texts: list[list[bytes]]) -> dict[int, tuple[list, list]]:
        """For each text (a list of words) with hits: merged spans of words, and numbers of windows."""
        numbers, distinct, lengths = numbered(texts)
        hashes = word_hashes(distinct)[numbers] if len(numbers) else np.zeros(0, np.uint64)
        ends = np.cumsum(lengths)
        found: dict[int, tuple[list, set]] = {}
        for size, table in self.tables.items():
            keys = windows(hashes, size)
            for i in np.flatnonzero(self.sieves[size][keys % np.uint64(SIEVE)]).tolist():
                if (grams := table.get(int(keys[i]))) is None:
                    continue
                k = int(np.searchsorted(ends, i, side="right"))
                first = int(i - (ends[k] - lengths[k]))
                if first + size > lengths[k]:
                    continue
                text = b" ".join(texts[k][first : first + size])
                for gram, number in grams:
                    if gram == text:
                        spans, hit = found.setdefault(k, ([], set()))
                        spans.append((first, first + size))
                        hit.add(number)
        return {k: (merged(spans), sorted(hit)) for k, (spans, hit) in found.items()}


def _as_spans(spans: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"first": a, "end": b} for a, b in x] for x in spans], SPANS)


def _scan(known: Windows, keep: list[str], hits_only: bool):
    """The ``keep`` columns with n_words, spans and windows of all rows, or of those with hits."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=WORD_CHUNK):
            texts = [words_of(x) for x in raw(batch)]
            found = known.find(texts)
            rows = sorted(found) if hits_only else range(len(texts))
            none: tuple[list, list] = ([], [])
            got = [found.get(k, none) for k in rows]
            out = [column(batch, c).take(pa.array(rows, pa.int64())) if hits_only else column(batch, c) for c in keep]
            out += [pa.array([len(texts[k]) for k in rows], pa.int64()), _as_spans([x for x, _ in got]), pa.array([x for _, x in got], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(out, [*keep, "n_words", "spans", "windows"])

    return scan


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _slices(numbers: DataFrame, max_windows: int) -> Iterator[Windows]:
    """The windows in slices of about ``max_windows``, one at a time."""
    many = max(1, -(-numbers.count() // max_windows))
    for k in range(many):
        rows = numbers.where(F.pmod(F.xxhash64("gram", "size"), F.lit(many)) == k).select("gram", "size", "window").collect()
        yield Windows([(bytes(r.gram), r["size"], r["window"]) for r in rows])


def _kinds(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*names).schema)


def text_name() -> Column:
    return F.md5(F.col("text").cast("string"))


def _hits_by_text(docs: DataFrame, numbers: DataFrame, max_windows: int) -> DataFrame:
    """Hits of all slices for each distinct text (__name): lists of spans and windows. One job for each slice."""
    slim = docs.select(text_name().alias("__name"), F.col("text").cast("string").alias("text")).where("text is not null")
    every = None
    for known in _slices(numbers, max_windows):
        part = slim.mapInArrow(_scan(known, ["__name"], True), f"__name string, {HITS}").dropDuplicates(["__name"])
        part = saved(part, "hits")
        every = part if every is None else every.unionByName(part)
    return every.groupBy("__name").agg(F.flatten(F.collect_list("spans")).alias("__spans"), F.flatten(F.collect_list("windows")).alias("__windows"))


def _merge(keep: list[str]):
    """Adds n_words and merged spans where a join has brought the hits of several slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=WORD_CHUNK):
            spans = [merged([(s["first"], s["end"]) for s in x or []]) for x in column(batch, "__spans").to_pylist()]
            hit = [sorted(set(x or [])) for x in column(batch, "__windows").to_pylist()]
            sizes = [len(words_of(x)) for x in raw(batch)]
            out = [*(column(batch, c) for c in keep), pa.array(sizes, pa.int64()), _as_spans(spans), pa.array(hit, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(out, [*keep, "n_words", "spans", "windows"])

    return run


def find_hits(docs: DataFrame, numbers: DataFrame, keep: list[str] | None = None, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """The ``keep`` columns (doc_id and text) with n_words, spans (word positions inside any window, merged) and the
    numbers of the windows that occur. ``numbers``: from ``benchmark_windows``."""
    keep = keep or ["doc_id", "text"]
    schema = f"{_kinds(docs, keep)}, {HITS}"
    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    if numbers.count() <= max_windows:
        return rows.mapInArrow(_scan(next(_slices(numbers, max_windows)), keep, False), schema)
    return rows.withColumn("__name", text_name()).join(_hits_by_text(docs, numbers, max_windows), "__name", "left").mapInArrow(_merge(keep), schema)


def with_items(hits: DataFrame, items: DataFrame) -> DataFrame:
    """``hits`` (a saved table) with the sorted items of its windows; documents with equal windows are looked up once."""
    lists = hits.where("size(windows) > 0").select("windows").distinct()
    named = lists.select("windows", F.explode("windows").alias("window")).join(items, "window").groupBy("windows").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return hits.join(named, "windows", "left").withColumn("items", F.coalesce("items", F.expr("cast(array() as array<string>)")))


INSIDE = np.array([b != 32 for b in NORMAL])


def without_spans(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A text without the given spans of words."""
    flags = np.concatenate([[False], INSIDE[np.frombuffer(data, dtype=np.uint8)], [False]])
    edges = np.flatnonzero(flags[1:] != flags[:-1])
    starts, ends = edges[::2], edges[1::2]
    kept, at = [], 0
    for a, b in spans:
        kept.append(data[at : starts[a]])
        at = int(ends[b - 1])
    return b"".join([*kept, data[at:]])


def _clean(known: Windows, max_share: float):
    """Texts cut until no window is left; a document that loses more than ``max_share`` of its words goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=WORD_CHUNK):
            texts = raw(batch)
            words = [words_of(x) for x in texts]
            found, lost, changed = known.find(words), {}, set()
            while found:
                again = []
                for k, (spans, _) in found.items():
                    lost[k] = lost.get(k, 0) + sum(b - a for a, b in spans)
                    changed.add(k)
                    if lost[k] <= max_share * len(words[k]):
                        texts[k] = without_spans(texts[k], spans)
                        again.append(k)
                more = known.find([words_of(texts[k]) for k in again])
                found = {again[i]: x for i, x in more.items()}
            stay = [k for k in range(len(texts)) if lost.get(k, 0) <= max_share * len(words[k])]
            own = column(batch, "text").to_pylist()
            new = [texts[k].decode() if k in changed else own[k] for k in stay]
            take = pa.array(stay, pa.int64())
            out = [pa.array(new, pa.string()) if c == "text" else column(batch, c).take(take) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(out, batch.schema.names)

    return run


def _cut_once(max_share: float):
    """For texts joined with the hits of several slices: one cut; __all (words at first), __lost and __dirty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=WORD_CHUNK):
            names = [c for c in batch.schema.names if c not in ("__name", "__spans", "__windows")]
            values = {c: column(batch, c).to_pylist() for c in ("text", "__all", "__lost")}
            stay, dirty = [], []
            for k, (data, hit) in enumerate(zip(raw(batch), column(batch, "__spans").to_pylist(), strict=True)):
                spans = merged([(s["first"], s["end"]) for s in hit or []])
                total = values["__all"][k] = len(words_of(data)) if values["__all"][k] is None else values["__all"][k]
                values["__lost"][k] += sum(b - a for a, b in spans)
                if values["__lost"][k] <= max_share * total:
                    stay.append(k)
                    dirty.append(bool(spans))
                    if spans:
                        values["text"][k] = without_spans(data, spans).decode()
            take = pa.array(stay, pa.int64())
            made = {c: pa.array([v[k] for k in stay], column(batch, c).type) for c, v in values.items()} | {"__dirty": pa.array(dirty, pa.bool_())}
            yield pa.RecordBatch.from_arrays([made[c] if c in made else column(batch, c).take(take) for c in names], names)

    return run


def decontaminate(docs: DataFrame, bench: DataFrame, n: int = 10, max_share: float = 0.5, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``docs`` without the benchmark's words: a document goes if more than ``max_share`` of its words are cut, from the
    others the hit spans are removed. All columns stay; clean rows are unchanged."""
    numbers, _ = benchmark_windows(bench, n)
    if numbers.count() <= max_windows:
        return docs.mapInArrow(_clean(next(_slices(numbers, max_windows)), max_share), docs.schema)
    safe = [f"c{i}" for i in range(len(docs.columns))]
    text = safe[docs.columns.index("text")]
    todo = docs.toDF(*safe).withColumnRenamed(text, "text").withColumns({"__all": F.lit(None).cast("long"), "__lost": F.lit(0).cast("long"), "__dirty": F.lit(True)})
    out = None
    while True:
        hits = _hits_by_text(todo, numbers, max_windows).drop("__windows")
        named = todo.withColumn("__name", text_name()).join(hits, "__name", "left")
        cut = saved(named.mapInArrow(_cut_once(max_share), T.StructType([f for f in named.schema.fields if f.name not in ("__name", "__spans")])), "cut")
        clean, todo = cut.where("not __dirty"), cut.where("__dirty")
        out = clean if out is None else out.unionByName(clean)
        if todo.isEmpty():
            return out.select(*[F.col("text" if c == text else c).alias(own) for c, own in zip(safe, docs.columns, strict=True)])


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    numbers, items = benchmark_windows(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hits = with_items(saved(find_hits(docs, numbers, ["doc_id"]), "hits"), items)
    n_hit = F.expr("aggregate(spans, 0L, (s, x) -> s + x.end - x.first)")
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


SQL = r"""
with b as (select cast(item_id as varchar) as item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
g as (select distinct item_id, least(10, len(w)) as size, w[i:i + least(10, len(w)) - 1] as gram
      from (select *, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from b where len(w) > 0)),
d as (select row_number() over () as r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w from documents),
s as (select distinct size from g),
p as (select r, size, i, w[i:i + size - 1] as gram from (select d.r, s.size, d.w, unnest(range(1, len(d.w) - s.size + 2)) as i from d, s where len(d.w) >= s.size)),
h as (select p.r, p.i, p.size, g.item_id from p join g on p.size = g.size and p.gram = g.gram),
hit as (select r, count(distinct x) as n_hit from (select r, unnest(range(i, i + size)) as x from h) group by r),
it as (select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items from (select distinct r, item_id from h) group by r)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (r) left join it using (r)
"""
