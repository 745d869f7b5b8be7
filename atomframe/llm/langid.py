"""Language identification by a linear-chain conditional random field over words.

Each word is scored by affix and n-gram features (byte n-grams of the word with its borders, hashed to ``FEATURES``
weights) and a lexicon feature (log odds of the word's bucket among all labelled words of each language); learned
transitions and forward-backward label the words of code-switched text. A document's language is the one with the
largest mean word probability, which is its score.

Learning: the lexicon counts every word of every labelled training document. The weights are fitted on at most
``per_language`` documents of each language (a bounded sample of labelled rows), those with the smallest hash, texts of
at most ``max_chars`` characters first; of longer ones, where there are too few of those, a run of at most so many
characters from their middle. The sample is joined into code-switched sequences. Prediction covers whole texts.

Null text, and text without a letter, is ``und`` with score 0; so is every text if nothing can be learned. Of languages
of equal mean probability the first by name is taken. Very long texts are labelled whole, alone. Rows without doc_id or
lang are never learned from. Equal rows are predicted one by one. Extra columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from atomframe.llm import chain
from atomframe.llm.common import MIX, chunks, column, mixed, numbered, raw, word_hashes

FEATURES = 1 << 16
LEXICON = 1 << 15
UNKNOWN = "und"
GRAMS = (1, 2, 3, 4)
#: Scores are cut off here before they become potentials.
SPAN = 30.0
#: Bytes of distinct words whose features are at hand at a time, and text bytes of a chunk.
WORD_BYTES, CHUNK = 1 << 18, 2 << 20


def lower_words(texts: list[bytes]) -> list[list[bytes]]:
    return [x.decode().lower().encode().split() for x in texts]


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words one after another, and where each word's begin; FEATURES stands for none."""
    sizes = np.array([len(w) + 2 for w in words], dtype=np.int64)
    data = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), dtype=np.uint8).astype(np.uint64)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))
    out = np.full((len(data), len(GRAMS)), FEATURES, dtype=np.int32)
    h = np.zeros(len(data), dtype=np.uint64)
    for k, n in enumerate(GRAMS):
        nxt = np.zeros(len(data), dtype=np.uint64)
        nxt[: len(data) - n + 1] = data[n - 1 :]
        h = mixed(h * np.uint64(257) + nxt + MIX)
        out[:, k] = np.where(left >= n, (h % np.uint64(FEATURES)).astype(np.int32), FEATURES)
    return out.ravel(), (np.cumsum(sizes) - sizes) * len(GRAMS)


def word_scores(words: list[bytes], weights: np.ndarray, lexicon: np.ndarray, lexicon_weight: float) -> np.ndarray:
    """Scores of each word, computed for WORD_BYTES of words at a time (a longer word alone)."""
    out = np.empty((len(words), weights.shape[1]))
    place = np.cumsum(np.array([len(w) for w in words], dtype=np.int64)) // WORD_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), len(words)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        some = words[a:b]
        if some:
            feats, begin = word_features(some)
            buckets = (word_hashes(some) % np.uint64(LEXICON)).astype(np.int64)
            out[a:b] = np.add.reduceat(weights[feats], begin, axis=0) + lexicon_weight * lexicon[buckets]
    return out


def potentials(scores: np.ndarray) -> np.ndarray:
    return np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -SPAN)) if len(scores) else scores


def _lexicon_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in chunks(batches, limit=CHUNK):
        texts, langs = raw(batch), column(batch, "lang").to_pylist()
        for lang in set(langs):
            words, distinct, _ = numbered(lower_words([t for t, x in zip(texts, langs, strict=True) if x == lang]))
            n = np.bincount(words, minlength=len(distinct))
            table = totals.setdefault(lang, np.zeros(LEXICON))
            table += np.bincount((word_hashes(distinct) % np.uint64(LEXICON)).astype(np.int64), weights=n, minlength=LEXICON)
    for lang, table in totals.items():
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(table[at].astype(np.int64))], ["lang", "bucket", "n"])


class Model:
    """Languages, feature weights, lexicon log odds with their weight, and transition scores."""

    def __init__(self, langs: list[str], lexicon: np.ndarray):
        k = len(langs)
        self.langs, self.lexicon = langs, lexicon
        self.weights, self.lexicon_weight = np.zeros((FEATURES + 1, k)), 1.0
        self.move = np.log(np.full((k, k), 0.1 / max(1, k)) + np.eye(k) * 0.9)

    def chain(self, words: list[bytes]) -> chain.Chain:
        scores = word_scores(words, self.weights, self.lexicon, self.lexicon_weight)
        return chain.Chain(np.full(len(self.langs), 1.0 / len(self.langs)), np.exp(self.move), potentials(scores))

    def fit(self, sequences: list[list[tuple[bytes, int]]], passes: int = 3, rate: float = 0.2) -> None:
        """AdaGrad on the conditional log likelihood, in batches of sequences."""
        k = len(self.langs)
        g_w, g_l, g_m = np.full_like(self.weights, 1e-2), 1e-2, np.full((k, k), 1e-2)
        for _ in range(passes):
            for at in range(0, len(sequences), 16):
                part = sequences[at : at + 16]
                ids, words, lengths = numbered([[w for w, _ in s] for s in part])
                gold = np.array([y for s in part for _, y in s])
                gamma, xi, _ = chain.posteriors(self.chain(words), ids, lengths, moves=True)
                diff = -gamma
                diff[np.arange(len(gold)), gold] += 1
                by_word = np.stack([np.bincount(ids, weights=diff[:, j], minlength=len(words)) for j in range(k)], axis=1) / len(gold)
                feats, begin = word_features(words)
                sizes = np.diff(np.append(begin, len(feats)))
                rows = np.repeat(by_word, sizes, axis=0)
                used, inverse = np.unique(feats, return_inverse=True)
                step = np.stack([np.bincount(inverse, weights=rows[:, j], minlength=len(used)) for j in range(k)], axis=1)
                step[used == FEATURES] = 0
                g_w[used] += step**2
                self.weights[used] += rate * step / np.sqrt(g_w[used])
                d = float((by_word * self.lexicon[word_hashes(words) % np.uint64(LEXICON)]).sum())
                g_l += d * d
                self.lexicon_weight += rate * d / np.sqrt(g_l)
                inside = np.ones(len(gold), bool)
                inside[np.cumsum(lengths) - lengths] = False
                seen = np.zeros((k, k))
                np.add.at(seen, (gold[np.flatnonzero(inside) - 1], gold[inside]), 1)
                m = (seen - xi) / len(gold)
                g_m += m * m
                self.move += rate * m / np.sqrt(g_m)


def switched(texts: list[tuple[list[bytes], int]], size: int = 200, seed: int = 5) -> list[list[tuple[bytes, int]]]:
    """Whole documents as sequences, and as many made of short pieces of several documents."""
    rng = np.random.default_rng(seed)
    pieces = [(words[i : i + 25], y) for words, y in texts for i in range(0, len(words), 25)]
    out, current = [[(w, y) for w in words] for words, y in texts if words], []
    for j in rng.permutation(len(pieces)):
        current += [(w, pieces[j][1]) for w in pieces[j][0]]
        if len(current) >= size:
            out.append(current)
            current = []
    out += [current] if current else []
    return [out[j] for j in rng.permutation(len(out))]


def train(docs: DataFrame, per_language: int = 60, max_chars: int = 4000) -> Model | None:
    """A model of the labelled rows (text and lang not null); None without any."""
    rows = docs.where("text is not null and lang is not null").select("text", "lang")
    counts = rows.mapInArrow(_lexicon_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    if not counts:
        return None
    langs = sorted({r.lang for r in counts})
    table = np.zeros((LEXICON, len(langs)))
    for r in counts:
        table[r.bucket, langs.index(r.lang)] = r.n
    odds = np.log((table + 0.5) / (table.sum(axis=0) + 0.5 * LEXICON))
    model = Model(langs, odds - odds.mean(axis=1, keepdims=True))
    size = F.length("text")
    known = rows.select("lang", (size > max_chars).alias("long"), F.xxhash64("text").alias("key")).distinct()
    # first within parts of a language, so that no task ranks all rows of a frequent one
    some = known.withColumn("part", F.pmod(F.col("key"), F.lit(64)))
    some = some.withColumn("r", F.row_number().over(Window.partitionBy("lang", "part").orderBy("long", "key"))).where(F.col("r") <= per_language)
    best = F.row_number().over(Window.partitionBy("lang").orderBy("long", "key"))
    keys = [r.key for r in some.withColumn("r", best).where(F.col("r") <= per_language).select("key").collect()]
    middle = F.when(size <= max_chars, F.col("text")).otherwise(F.substr("text", F.floor((size - max_chars) / 2).cast("int") + 1, F.lit(max_chars)))
    sample = rows.where(F.xxhash64("text").isin(keys)).select(middle.alias("text"), "lang").distinct().collect() if keys else []
    texts = [(lower_words([r.text.encode()])[0], langs.index(r.lang)) for r in sorted(sample)]
    if sequences := switched(texts):
        model.fit(sequences)
    model.weights = model.weights.astype(np.float32)
    return model


def has_letter(text: bytes) -> bool:
    return text != text.translate(None, LETTERS) or (not text.isascii() and any(map(str.isalpha, text.decode())))


LETTERS = bytes(b for b in range(128) if chr(b).isalpha())


def _predict(model: Model | None, keep: list[str], confidence: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=CHUNK):
            texts = raw(batch)
            langs, scores, sure = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            if model:
                ids, words, lengths = numbered(lower_words(texts))
                gamma, *_ = chain.posteriors(model.chain(words), ids, lengths)
                ends = np.cumsum(lengths)
                for i, text in enumerate(texts):
                    if lengths[i] and has_letter(text):
                        words_of = gamma[ends[i] - lengths[i] : ends[i]]
                        mean, sure[i] = words_of.mean(axis=0), min(1.0, float(words_of.max(axis=1).mean()))
                        langs[i], scores[i] = model.langs[int(mean.argmax())], min(1.0, float(mean.max()))
            out = [*(column(batch, c) for c in keep), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), *[pa.array(sure, pa.float64())] * bool(confidence)]
            yield pa.RecordBatch.from_arrays(out, [*keep, "lang_pred", "score", *[confidence] * bool(confidence)])

    return run


def predict(docs: DataFrame, model: Model | None, keep: list[str] | None = None, confidence: str | None = None) -> DataFrame:
    """The ``keep`` columns (doc_id and text if none are named) with lang_pred and score and, if it is given a name, the
    mean of each word's largest probability, whatever its language."""
    keep = keep or ["doc_id", "text"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(_predict(model, keep, confidence), f"{kinds}, lang_pred string, score double" + (f", `{confidence}` double" if confidence else ""))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def op9_langid(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where("doc_id is not null").where(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
