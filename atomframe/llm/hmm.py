"""LM scoring with a hidden Markov language model.

A word belongs to one of ``CLASSES`` classes by its hash, the end of a text to a class of its own. States emit
classes; within a class a word has its smoothed share of the class's training tokens,

    P(word | state) = P(class | state) * (count + 0.5) / (tokens of the class + 0.5 * (words of the class + 1)),

so frequent words all but own their class, parameters stay bounded at any vocabulary, and a word never seen has a
probability. Baum-Welch counts are summed over partitions. Steps over slices of the training documents, in which the
counts of earlier steps fade (stepwise EM), only find a good start: the final model is made of the counts of one last
pass, in which every training document has the same weight. The likelihood of a whole text is exact: the scaled
forward recursion over its classes plus the words' shares.

The training texts are read once: one pass saves each chunk's words by bucket of the vocabulary with their counts, for the
counts, and its class ids by slice, for all steps of the training.

Counts of words: the head (at most ``HEAD`` words, each with at least a ``HEAD``-th of a bucket's tokens) is
broadcast; the others go to buckets of the vocabulary together with the documents of a chunk that have them, and come
back as one row of sums for each bucket and chunk. No word and no document is gathered anywhere.

Null and empty texts have the end token only. Rows with equal ids and texts get equal rows. Rows without doc_id are
training rows. Extra columns are ignored. Without training documents every token has log10 probability 0 in the base.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from atomframe.llm import chain
from atomframe.llm.common import chunks, column, dropped, give_back, mixed, parts, ranges, raw, saved, word_hashes

CLASSES, STATES, HEAD = 4096, 8, 1 << 16
#: Class ids that a task works on at a time, about; a longer text is worked on alone.
SOME_IDS = 1 << 20
END = CLASSES
#: Slices of the training documents (of 16) for each step of the warm start, and the weight of a step's counts.
STEPS = [(0, 1, 1.0), (0, 1, 1.0), (1, 2, 1.0), (2, 4, 0.8), (4, 8, 0.8), (8, 16, 0.8)]
SLICES = 16
#: The last step: all training documents; its weight leaves nothing of the counts before.
WHOLE = (0, SLICES, 1.0)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))


def numbered_words(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Word numbers of all texts one after another, the distinct words by number, and the words in each text."""
    joined = np.frombuffer(b" ".join([b"", *texts, b""]).lower(), np.uint8)
    space = (joined == 0x20) | ((joined >= 0x09) & (joined <= 0x0D))
    turns = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = turns[::2], turns[1::2]
    offsets = np.append(0, np.cumsum(ends - starts))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined[~space])]).dictionary_encode()
    borders = np.cumsum([1, *(len(x) + 1 for x in texts)])
    return words.indices.to_numpy().astype(np.int64), words.dictionary.to_pylist(), np.diff(np.searchsorted(starts, borders))


def _bucket_rows(hashes: np.ndarray, buckets: int):
    """For each bucket that has some of the words: its number and the words' places."""
    bucket = (mixed(hashes) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = [*np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield int(bucket[order[a]]), order[a:b]


#: Rows of a chunk's training documents: those of one slice with their class ids (uint16) and lengths, or the words of
#: one bucket with their counts, or (no words) the number of documents.
READ = pa.schema([("slice", pa.int32()), ("ids", pa.binary()), ("lengths", pa.binary()), ("bucket", pa.int32()), ("words", pa.binary()), ("counts", pa.binary())])


def _read(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            ids, lengths, numbers, words, hashes = _class_ids(raw(batch))
            counts = np.bincount(numbers, minlength=len(words)).astype(np.int64)
            rows = [(None, None, None, 0, None, np.array([len(lengths)], np.int64).tobytes())]
            rows += [(None, None, None, b, b"\n".join(words[i] for i in at.tolist()), counts[at].tobytes()) for b, at in _bucket_rows(hashes, buckets)]
            lengths, part = lengths + 1, np.asarray(column(batch, "slice"))
            starts = np.cumsum(lengths) - lengths
            for k in np.unique(part):
                mine = np.flatnonzero(part == k)
                rows.append((int(k), ids[ranges(starts[mine], lengths[mine])].astype(np.uint16).tobytes(), lengths[mine].tobytes(), None, None, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), READ.types, strict=True)], schema=READ)

    return run


def read_words(docs: DataFrame) -> DataFrame:
    """The words and class ids of ``docs`` (doc_id, text), saved: what ``count_words`` and ``train`` work on."""
    part = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(SLICES))
    rows = docs.select(part.cast("int").alias("slice"), "text").mapInArrow(_read(parts(docs.sparkSession)), "slice int, ids binary, lengths binary, bucket int, words binary, counts binary")
    return saved(rows, "words")


def _add_up(buckets: int):
    """Rows (kind, word, class, n, v): the tokens and words of each class, the bucket's head words, the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}
        docs = 0
        for batch in batches:
            for words, counts in zip(column(batch, "words").to_pylist(), column(batch, "counts").to_pylist(), strict=True):
                numbers = np.frombuffer(counts, dtype=np.int64).tolist()
                if words is None:
                    docs += numbers[0]
                else:
                    for w, n in zip(words.split(b"\n"), numbers, strict=True):
                        total[w] = total.get(w, 0) + n
        names = list(total)
        n = np.fromiter(total.values(), dtype=np.int64, count=len(names))
        classes = (word_hashes(names) % np.uint64(CLASSES)).astype(np.int64)
        tokens = np.bincount(classes, weights=n, minlength=CLASSES).astype(np.int64)
        kinds = np.bincount(classes, minlength=CLASSES)
        at = np.flatnonzero(kinds)
        heads = np.flatnonzero(n * HEAD >= n.sum() * buckets) if len(names) else np.zeros(0, np.int64)
        rows = [("class", None, int(c), int(tokens[c]), int(kinds[c])) for c in at] + [("head", names[i], int(classes[i]), int(n[i]), 1) for i in heads]
        rows += [("docs", None, END, docs, 1)] if docs else []
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.binary(), pa.int32(), pa.int64(), pa.int64()))], ["kind", "word", "class", "n", "v"])

    return run


@dataclass
class Counts:
    """Training tokens and words by class, the end's class last, and the counts of the head words."""

    tokens: np.ndarray
    kinds: np.ndarray
    head: dict[bytes, int]

    @property
    def total(self) -> int:
        return int(self.tokens.sum())

    @property
    def distinct(self) -> int:
        return int(self.kinds.sum())


def count_words(docs: DataFrame, read: DataFrame | None = None) -> Counts:
    """Counts of all words of ``docs`` (doc_id, text). ``read``: what ``read_words`` made of them, where it is at hand."""
    buckets = parts(docs.sparkSession)
    made = read is None
    read = read_words(docs) if made else read
    rows = read.where("bucket is not null").select("bucket", "words", "counts")
    stats = saved(rows.repartition(buckets, "bucket").mapInArrow(_add_up(buckets), "kind string, word binary, class int, n long, v long"), "wordcounts")
    tokens, kinds = np.zeros(CLASSES + 1, np.int64), np.zeros(CLASSES + 1, np.int64)
    for r in stats.where("kind <> 'head'").groupBy("class").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        tokens[r["class"]], kinds[r["class"]] = r.n, min(r.v, 1) if r["class"] == END else r.v
    head = {bytes(r.word): r.n for r in stats.where("kind = 'head'").collect()}
    dropped(stats, *[read] * made)
    return Counts(tokens, kinds, head)


@dataclass
class Model:
    """start (K), move (K, K) and emit (CLASSES + 1, K): probabilities of states, transitions and classes."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    def chain(self, shares: np.ndarray | None = None) -> chain.Chain:
        return chain.Chain(self.start, self.move, self.emit if shares is None else self.emit * shares[:, None])


def first_model(counts: Counts) -> Model:
    """Sticky states whose emissions are those of the corpus, each class a little more or less likely by its hash."""
    noise = mixed(np.arange((CLASSES + 1) * STATES, dtype=np.uint64) + np.uint64(12345)).astype(np.float64) / 2**64
    emit = (counts.tokens[:, None] + 0.5) * (0.5 + noise.reshape(-1, STATES))
    move = np.full((STATES, STATES), 0.05 / STATES) + np.eye(STATES) * 0.95
    return Model(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=0))


def _class_ids(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Class ids of all texts with their ends, the lengths without, word numbers, the distinct words and their hashes."""
    ids, words, lengths = numbered_words(texts)
    hashes = word_hashes(words)
    classes = (hashes % np.uint64(CLASSES)).astype(np.int64)
    ends = np.cumsum(lengths + 1) - 1
    out = np.full(len(ids) + len(lengths), END, dtype=np.int64)
    inside = np.ones(len(out), bool)
    inside[ends] = False
    out[inside] = classes[ids]
    return out, lengths, ids, words, hashes


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Class ids and lengths of about SOME_IDS ids at a time."""
    some: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        for ids, lengths in zip(column(batch, "ids").to_pylist(), column(batch, "lengths").to_pylist(), strict=True):
            some.append((np.frombuffer(ids, np.uint16), np.frombuffer(lengths, np.int64)))
            if sum(len(x) for x, _ in some) >= SOME_IDS:
                yield np.concatenate([x for x, _ in some]).astype(np.int64), np.concatenate([n for _, n in some])
                some = []
    if some:
        yield np.concatenate([x for x, _ in some]).astype(np.int64), np.concatenate([n for _, n in some])
    give_back()


def _expected(model: Model):
    """Expected counts of a task: rows (class, k0 ...); class -1 - i has the transitions out of state i, the last the starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit, move, start = np.zeros((CLASSES + 1, STATES)), np.zeros((STATES, STATES)), np.zeros(STATES)
        for ids, lengths in _together(batches):
            for total, part in zip((emit, move, start), chain.expected(model.chain(), ids, lengths), strict=True):
                total += part
        table = np.concatenate([emit, move, start[None]])
        at = np.flatnonzero(table.sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(table[at, k]) for k in range(STATES))], ["row", *(f"k{k}" for k in range(STATES))])

    return run


def train(docs: DataFrame, counts: Counts, epochs: int = 1, read: DataFrame | None = None) -> Model:
    """Baum-Welch over slices of ``docs`` (doc_id, text), then over all of them. ``read``: see ``count_words``."""
    model = first_model(counts)
    memory = np.zeros((CLASSES + 1 + STATES + 1, STATES))
    columns = [f"k{k}" for k in range(STATES)]
    made = read is None
    read = read_words(docs) if made else read
    classed = read.select("slice", "ids", "lengths")
    for low, high, weight in [*STEPS * epochs, WHOLE]:
        rows = classed.where((F.col("slice") >= low) & (F.col("slice") < high)).mapInArrow(_expected(model), "row int, " + ", ".join(f"{c} double" for c in columns))
        new = np.zeros_like(memory)
        for r in rows.groupBy("row").agg(*[F.sum(c).alias(c) for c in columns]).collect():  # one row for each parameter row
            new[r.row] = r[1:]
        if not new.any():
            continue
        scale = max(1.0, new[: CLASSES + 1].sum())
        memory = (1 - weight) * memory + weight * new / scale
        total = scale * memory
        prior = (counts.tokens + 0.5) / (counts.tokens + 0.5).sum()
        emit = total[: CLASSES + 1] + 0.5 * STATES * prior[:, None] + 1e-6
        move, start = total[CLASSES + 1 : -1] + 0.1, total[-1] + 0.1
        model = Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    dropped(*[read] * made)
    return model


def _score_rows(model: Model, counts: Counts, buckets: int):
    """Blobs by bucket: the words outside the head with the documents that have them, and each document's own sums."""
    shares = 1 / (counts.tokens + 0.5 * (counts.kinds + 1))
    end = np.log(counts.tokens[END] + 0.5)
    table = model.chain(shares)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(chunks(batches)):
            texts = raw(batch)
            ids, lengths, numbers, words, hashes = _class_ids(texts)
            likelihood = chain.log_likelihood(table, ids, lengths + 1)
            docs = np.repeat(np.arange(len(texts)), lengths)
            head = np.fromiter((counts.head.get(w, 0) for w in words), dtype=np.int64, count=len(words))
            known = head[numbers]
            logs = np.bincount(docs, weights=np.where(known > 0, np.log(known + 0.5), 0.0), minlength=len(texts)) + end
            seen = np.bincount(docs, weights=known > 0, minlength=len(texts)).astype(np.int64) + (counts.tokens[END] > 0)
            ids_of = np.array([0 if i is None else i for i in column(batch, "doc_id").to_pylist()], dtype=np.int64)
            has = np.array(column(batch, "doc_id").is_valid(), dtype=bool)
            train = ~np.array(column(batch, "held_out"), dtype=bool)
            key = f"{part}-{number}-{xxhash.xxh3_64_hexdigest(ids.tobytes() + ids_of.tobytes())}"
            flags = np.packbits(train).tobytes()
            own = (ids_of.tobytes(), has.tobytes(), np.stack([lengths + 1, seen]).tobytes(), np.stack([logs, likelihood]).tobytes())
            rows = [((part + number) % buckets, key, None, *own)]
            pairs, n = np.unique(numbers[known == 0] * len(texts) + docs[known == 0], return_counts=True)
            word, doc = np.divmod(pairs, max(1, len(texts)))
            firsts = np.searchsorted(word, np.arange(len(words) + 1))
            tail = np.flatnonzero(np.diff(firsts))
            for b, at in _bucket_rows(hashes[tail], buckets):
                mine = tail[at]
                size = firsts[mine + 1] - firsts[mine]
                take = ranges(firsts[mine], size)
                rows.append((b, key, b"\n".join(words[i] for i in mine.tolist()), doc[take].astype(np.int32).tobytes(), n[take].astype(np.int32).tobytes(), size.astype(np.int32).tobytes(), flags))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.string(), *[pa.binary()] * 5), strict=True)], BLOB)

    return run


BLOB = ["bucket", "chunk", "words", "a", "b", "c", "d"]
SUMS = ["chunk", "own", "a", "b", "c", "d"]


def _sum_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a bucket of the vocabulary adds to the documents of each chunk: one row for each blob; their own sums pass."""
    total: dict[bytes, int] = {}
    held = []

    def rows(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], t) for k, t in enumerate((pa.string(), pa.bool_(), *[pa.binary()] * 4))], SUMS)

    for batch in batches:
        passed = []
        for r in batch.to_pylist():
            if r["words"] is None:
                passed.append((r["chunk"], True, r["a"], r["b"], r["c"], r["d"]))
                continue
            doc, n, size = (np.frombuffer(r[c], np.int32) for c in "abc")
            train = np.unpackbits(np.frombuffer(r["d"], np.uint8))
            by_word = np.add.reduceat(n * train[doc].astype(np.int64), np.cumsum(size) - size)
            words = r["words"].split(b"\n")
            for w, x in zip(words, by_word.tolist(), strict=True):
                total[w] = total.get(w, 0) + x
            held.append((r["chunk"], words, doc, n, size))
        yield rows(passed)
    for chunk, words, doc, n, size in held:
        count = np.repeat(np.fromiter((total[w] for w in words), dtype=np.int64, count=len(words)), size)
        some = np.unique(doc)
        logs = np.bincount(doc, weights=n * np.log(count + 0.5))[some]
        known = np.bincount(doc, weights=n * (count > 0))[some].astype(np.int64)
        yield rows([(chunk, False, some.astype(np.int32).tobytes(), known.tobytes(), logs.tobytes(), None)])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the rows of each chunk: one row for each document."""
    own: dict[str, tuple] = {}
    parts_of: dict[str, list] = {}
    for batch in batches:
        for r in batch.to_pylist():
            if r["own"]:
                own[r["chunk"]] = (np.frombuffer(r["a"], np.int64), np.frombuffer(r["b"], bool), np.frombuffer(r["c"], np.int64).reshape(2, -1).copy(), np.frombuffer(r["d"], np.float64).reshape(2, -1).copy())
            else:
                parts_of.setdefault(r["chunk"], []).append((np.frombuffer(r["a"], np.int32), np.frombuffer(r["b"], np.int64), np.frombuffer(r["c"], np.float64)))
    for chunk, (ids, has, counts, sums) in own.items():
        for doc, known, logs in parts_of.get(chunk, []):
            counts[1][doc] += known
            sums[0][doc] += logs
        yield pa.RecordBatch.from_arrays([pa.array(ids, mask=~has), pa.array(counts[0]), pa.array(counts[1]), pa.array(sums[0]), pa.array(sums[1])], ["doc_id", "n_tokens", "n_known", "logs", "likelihood"])


def score(docs: DataFrame, model: Model, counts: Counts) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score for ``docs`` (doc_id, text, held_out)."""
    buckets = parts(docs.sparkSession)
    blobs = docs.mapInArrow(_score_rows(model, counts, buckets), "bucket int, chunk string, words binary, a binary, b binary, c binary, d binary")
    sums = blobs.repartition(buckets, "bucket").mapInArrow(_sum_documents, "chunk string, own boolean, a binary, b binary, c binary, d binary")
    one = sums.repartition(buckets, "chunk").mapInArrow(_finish, "doc_id long, n_tokens long, n_known long, logs double, likelihood double")
    norm = float(np.log10(max(counts.total + 0.5 * (counts.distinct + 1), 0.5)))
    base = F.col("logs") / F.lit(float(np.log(10))) - F.col("n_tokens") * F.lit(norm)
    return one.select("doc_id", "n_tokens", "n_known", base.alias("base_score"), ((F.col("logs") + F.col("likelihood")) / F.lit(float(np.log(10)))).alias("score"))


def op1_hmm(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out().alias("held_out"))
    training = docs.where("not held_out")
    read = read_words(training)
    counts = count_words(training, read)
    model = train(training, counts, read=read)
    dropped(read)
    out = score(docs, model, counts)
    return out.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(counts.total).cast("long").alias("train_tokens"), "base_score", "score")
