"""Ranked lexical search by an Aho-Corasick scan: the items' terms are counted in the texts themselves, without an index.

Words are runs of digits, ASCII letters (lower-cased) and non-ASCII characters. Every other byte of a text becomes a
space, and the automaton holds each term with a space on both sides, so that only whole words are found and neighbours
share their space. Its outputs are numbers of terms, which map to the items that hold them.

One scan writes, for each document, its number of words and the counts of the terms found. From that table come the
numbers of documents and words and each term's document frequency (sums in Spark), and then the scores: each task scores
its documents for all items in blocks of bounded size and hands on at most ``k`` of them for each item.

The terms of a slice of items (at most about MAX_TERMS pairs of item and term, or one item) go to the tasks at a time; a
larger set of items takes several scans, so that what a task holds does not grow with it.

Null or empty texts, and those without a word, are no documents. Very long texts are scanned whole, in runs that are cut
at spaces. Of equal scores the smaller doc_id comes first, rows without doc_id last; rows with equal ids, and equal rows,
are documents of their own. Items without terms have no rows; rows of one item_id (or of none) are one item. Extra
columns are ignored, whatever their names. Without items or documents the result is empty.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from atomframe.llm.common import chunks, column, ranges, raw, saved
from atomframe.llm.decontaminate import NORMAL, words_of

#: Pairs of item and term that go to the tasks at a time.
MAX_TERMS = 200_000
#: Bytes of a text that the automaton is led through at a time (it takes four for each).
RUN = 4 << 20
#: Scores (documents x items) and postings that a task holds at a time.
SCORES, POSTINGS = 1 << 21, 1 << 20


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        rows, terms, times = [], [], []
        for i, text in enumerate(raw(batch)):
            found = Counter(words_of(text))
            rows += [i] * len(found)
            terms += found
            times += found.values()
        out = [column(batch, "item_id").take(pa.array(rows, pa.int64())), pa.array(terms, pa.binary()), pa.array(times, pa.int64())]
        yield pa.RecordBatch.from_arrays(out, ["item_id", "term", "times"])


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct pairs (item_id, term) with the term's occurrences in the item: a saved table."""
    kind = items.schema["item_id"].dataType
    rows = items.select("item_id", F.col("text").cast("string").alias("text"))
    cut = rows.mapInArrow(_item_terms, f"item_id {kind.simpleString()}, term binary, times long")
    return saved(cut.groupBy("item_id", "term").agg(F.sum("times").alias("times")), "terms")


class Items:
    """A slice of the items: the distinct terms, and for each the items that hold it."""

    def __init__(self, rows: list):
        self.ids = list(dict.fromkeys(r.item_id for r in rows))
        self.terms = sorted({bytes(r.term) for r in rows})
        item, term = {x: i for i, x in enumerate(self.ids)}, {x: i for i, x in enumerate(self.terms)}
        pairs = np.array(sorted((term[bytes(r.term)], item[r.item_id], r.times) for r in rows), dtype=np.int64).reshape(-1, 3)
        self.counts = np.bincount(pairs[:, 0], minlength=len(self.terms))
        self.starts = np.cumsum(self.counts) - self.counts
        self.item, self.times = pairs[:, 1], pairs[:, 2]

    def automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        for i, term in enumerate(self.terms):
            out.add_word(f" {term.decode('latin-1')} ", i)
        out.make_automaton()
        return out


def slices(terms: DataFrame, max_terms: int = MAX_TERMS) -> Iterator[Items]:
    """The items in slices of about ``max_terms`` pairs, one at a time."""
    many = max(1, -(-terms.count() // max_terms))
    for k in range(many):
        if rows := terms.where(F.pmod(F.xxhash64("item_id"), F.lit(many)) == k).collect():
            yield Items(rows)


def runs(text: bytes) -> Iterator[str]:
    """A normal text between two spaces, in runs that begin and end with one."""
    text, at = b" " + text + b" ", 0
    while at < len(text) - 1:
        end = len(text) - 1 if len(text) - at <= RUN else text.index(b" ", at + RUN - 1)
        yield text[at : end + 1].decode("latin-1")
        at = end


def words_in(text: bytes) -> int:
    """The number of words of a normal text."""
    inside = np.frombuffer(text, dtype=np.uint8) != 32
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]) + inside[:1].sum())


def _scan(items: Items):
    """For each row with a word: doc_id, n, and the terms found with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, number = items.automaton(), itemgetter(1)
        for batch in chunks(batches):
            rows, sizes, terms, counts, ends = [], [], [], [], [0]
            for i, text in enumerate(raw(batch)):
                text = text.translate(NORMAL)
                if not (n := words_in(text)):
                    continue
                found: Counter = Counter()
                for part in runs(text):
                    found.update(map(number, automaton.iter(part)))
                rows.append(i)
                sizes.append(n)
                terms += found
                counts += found.values()
                ends.append(len(terms))
            at = pa.array(ends, pa.int32())
            out = [column(batch, "doc_id").take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64())]
            out += [pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "n", "terms", "counts"])

    return run


def term_counts(docs: DataFrame, items: Items) -> DataFrame:
    """doc_id, n (words) and the counts of the slice's terms, of every row with a word: a saved table."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return saved(rows.mapInArrow(_scan(items), "doc_id long, n long, terms array<int>, counts array<long>"), "counts")


def weights(frequencies: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in frequencies], dtype=np.int64)


def length_norms(sizes: np.ndarray, documents: int, words: int) -> np.ndarray:
    """m of documents with ``sizes`` words. Products beyond 64 bits are made as Python's whole numbers."""
    if 75 * int(sizes.max(initial=0)) * documents < 1 << 63:
        return 25 + 75 * sizes * documents // words
    return np.array([25 + 75 * int(n) * documents // words for n in sizes], dtype=np.int64)


class Best:
    """The ``k`` best documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, dtype=np.int64)
        self.rows = [np.zeros(0, dtype=np.int64)] * 4  # item, score, without an id, id

    def add(self, ids: np.ndarray, missing: np.ndarray, scores: np.ndarray) -> None:
        """Scores of some documents (rows) for all items (columns)."""
        if len(ids) > self.k:  # the k-th best of these rows alone is a bound
            self.least = np.maximum(self.least, np.partition(scores, len(ids) - self.k, axis=0)[len(ids) - self.k])
        doc, item = np.nonzero(scores >= self.least)
        if not len(doc):
            return
        new = (item, scores[doc, item], missing[doc], ids[doc])
        item, score, none, doc_id = (np.concatenate(x) for x in zip(self.rows, new, strict=True))
        order = np.lexsort((doc_id, none, -score, item))
        item = item[order]
        first = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
        place = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
        kept = order[place < self.k]
        self.rows = [x[kept] for x in (np.concatenate((self.rows[0], new[0])), score, none, doc_id)]
        full = place == self.k - 1
        self.least[item[full]] = np.maximum(self.least[item[full]], score[order[full]])


def _best(items: Items, weight: np.ndarray, documents: int, words: int, k: int):
    """At most ``k`` rows (item: its number, doc_id, score) of each item from a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, wide = Best(len(items.ids), k), max(1, SCORES // len(items.ids))
        for batch in batches:
            ids = column(batch, "doc_id")
            missing, ids = np.asarray(ids.is_null()).astype(np.int64), np.asarray(ids.fill_null(0))
            norms = length_norms(np.asarray(column(batch, "n")), documents, words)
            terms, counts = column(batch, "terms"), column(batch, "counts")
            sizes = np.asarray(terms.value_lengths())
            terms, counts = np.asarray(terms.flatten()), np.asarray(counts.flatten())
            load = np.cumsum(np.bincount(np.repeat(np.arange(len(ids)), sizes), weights=items.counts[terms], minlength=len(ids)).astype(np.int64))
            ends, at = np.cumsum(sizes), 0
            while at < len(ids):
                heavy = int(np.searchsorted(load, (load[at - 1] if at else 0) + POSTINGS, side="right"))
                stop = max(at + 1, min(at + wide, heavy, len(ids)))
                some = slice(ends[at] - sizes[at], ends[stop - 1])
                row, term, count = np.repeat(np.arange(stop - at), sizes[at:stop]), terms[some], counts[some]
                value = weight[term] * (1_000_000_000 * count // (1000 * count + 8 * norms[at:stop][row]))
                each = items.counts[term]
                post = ranges(items.starts[term], each)
                scores = np.zeros((stop - at) * len(items.ids), dtype=np.int64)
                np.add.at(scores, np.repeat(row, each) * len(items.ids) + items.item[post], np.repeat(value, each) * items.times[post])
                best.add(ids[at:stop], missing[at:stop], scores.reshape(stop - at, -1))
                at = stop
        item, score, none, doc_id = best.rows
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(doc_id, mask=none.astype(bool)), pa.array(score)], ["item", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 10, max_terms: int = MAX_TERMS) -> DataFrame:
    """The ``k`` best documents (doc_id, text) of each item (item_id, text): item_id, rank (from 1), doc_id, score."""
    spark, kind = docs.sparkSession, items.schema["item_id"].dataType.simpleString()
    out, totals = None, None
    for some in slices(item_terms(items), max_terms):
        found = term_counts(docs, some)
        totals = totals or found.agg(F.count("*").alias("n"), F.sum("n").alias("words")).first()
        if not totals.n:
            break
        df = np.zeros(len(some.terms), dtype=np.int64)
        for r in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # terms of the slice
            df[r.term] = r["count"]
        scored = found.mapInArrow(_best(some, weights(df, totals.n), totals.n, totals.words, k), "item int, doc_id long, score long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        names = spark.createDataFrame(list(enumerate(some.ids)), f"item int, item_id {kind}")
        top = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        top = top.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = top if out is None else out.unionByName(top)
    return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long") if out is None else out


def op11_search(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = r"""
with q as (select item_id, term, count(*) as k from (select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark) group by all),
d as (select * from (select row_number() over () as r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents) where len(w) > 0),
s as (select cast(count(*) as bigint) as docs, cast(sum(len(w)) as bigint) as words from d),
p as (select r, term, cast(count(*) as bigint) as tf from (select r, unnest(w) as term from d) where term in (select term from q) group by all),
f as (select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) as bigint) as w from p, s group by term, docs),
m as (select r, doc_id, 100 - 75 + (75 * cast(len(w) as bigint) * docs) // words as m from d, s),
z as (select item_id, doc_id, r, cast(sum(k * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
      from q join p using (term) join f using (term) join m using (r) group by item_id, doc_id, r),
t as (select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id nulls last) as int) as rank, doc_id, score from z where score > 0)
select * from t where rank <= 10
"""
