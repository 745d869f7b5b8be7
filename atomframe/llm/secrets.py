"""Secret scans: plain patterns, and formats learned from what they find by grammar inference.

Base spans come from three patterns (assign, access, hex). Their values are labelled credentials: for each kind at
most ``per_kind`` distinct values (those with the smallest hash; a bounded sample of labelled rows), each as often as
it was found, make a prefix tree over character classes, whose statistically compatible states are merged (ALERGIA,
Hoeffding test) into a probabilistic automaton. Every run of characters that may stand in a credential, in every text,
is a candidate, and so is what base spans leave of a run; those too short for any string of their length to pass need no
scoring (``Formats.least``, computed from the automata). A candidate is a secret if, for some kind, the automaton accepts it and its log likelihood is above that of ordinary
text (a first-order model of the classes of all texts outside base spans) by ``threshold``. A span is a whole match:
code points, end exclusive.

Null and empty texts have no spans. Very long texts are scanned whole. Of kinds of equal likelihood the one listed first
is taken. Equal rows are scanned one by one. Extra columns are ignored by ``scan`` and kept by ``redact``. Without any
base match nothing is learned and only the patterns speak.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from atomframe.llm.common import WORD_CHUNK, chunks, column, saved

# The patterns of the base scan.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

#: Character classes: digit, a-f, other lower case, upper case, and each mark by itself; 0 is everything else.
CLASSES = "0az" + "A" + "+/_.=-"
CODES = bytearray(256)
for _i in range(128):
    _c = chr(_i)
    CODES[_i] = 1 if _c.isdigit() else 2 if _c in "abcdef" else 3 if _c.islower() else 4 if _c.isupper() else CLASSES.find(_c) + 1 if _c in "+/_.=-" else 0
CODES = bytes(CODES)
N = len(CLASSES) + 1
#: A length that candidates are scored from in any case.
LONGEST = 64
#: Verdicts remembered in a worker, by class codes of at most SHORT characters.
VERDICTS, SHORT = 1 << 17, 32
HEXMAP = bytes(104 if chr(b) in "0123456789abcdef" else 32 for b in range(256))


def base_spans(text: str, data: bytes) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value) of the base matches, in order."""
    out = []
    low = data.lower()
    if b"passw" in low or b"secret" in low or b"token" in low or b"key" in low:
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if b"AKIA" in data:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    if b"h" * MIN_HEX in data.translate(HEXMAP):
        out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text) if len(m[0]) >= MIN_HEX]
    return sorted(out)


#: The kind under which class pairs are counted.
PAIRS = -1


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (kind, value, n): the base values, and as PAIRS the class pairs of all text outside them."""
    pairs = np.zeros(N * N, dtype=np.int64)
    for batch in chunks(batches, limit=WORD_CHUNK):
        found: Counter[tuple[int, str]] = Counter()
        for text in column(batch, "text").to_pylist():
            if text:
                data = text.encode()
                if spans := base_spans(text, data):
                    found.update((kind, value) for _, kind, _, value in spans)
                    kept, at = [], 0
                    for start, end in merged([(s, e) for s, _, e, _ in spans]):
                        kept += [text[at:start], "\0"]
                        at = end
                    data = "".join([*kept, text[at:]]).encode()
                codes = np.frombuffer(b"\0" + data.translate(CODES) + b"\0", dtype=np.uint8)
                pairs += np.bincount(codes[:-1].astype(np.int64) * N + codes[1:], minlength=N * N)
        yield _rows([(k, v, n) for (k, v), n in found.items()])
    yield _rows([(PAIRS, str(i), pairs[i]) for i in np.flatnonzero(pairs)])


def _rows(rows: list[tuple[int, str, int]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["kind", "value", "n"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping spans, in order of their starts, as one."""
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


class Automaton:
    """A probabilistic deterministic automaton: for each state the log probability of ending and of each symbol."""

    def __init__(self, values: dict[bytes, int], alpha: float = 0.05):
        """From strings of class codes with their counts: the prefix tree, then merges of compatible states in the order of
        the tree."""
        self.next: list[dict[int, int]] = [{}]
        self.seen: list[dict[int, int]] = [{}]
        self.ends, self.total, self.bound = [0], [0], math.sqrt(0.5 * math.log(2 / alpha))
        for value, n in values.items():
            state = 0
            self.total[0] += n
            for symbol in value:
                if symbol not in self.next[state]:
                    self.next[state][symbol] = len(self.next)
                    self.next.append({})
                    self.seen.append({})
                    self.ends.append(0)
                    self.total.append(0)
                self.seen[state][symbol] = self.seen[state].get(symbol, 0) + n
                state = self.next[state][symbol]
                self.total[state] += n
            self.ends[state] += n
        self._merge_all()
        self.log_end = [math.log(e / t) if e else -math.inf for e, t in zip(self.ends, self.total, strict=True)] if values else [-math.inf]
        self.log_move = [{s: math.log(n / t) for s, n in seen.items()} for seen, t in zip(self.seen, self.total, strict=True)]

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self.bound * (n1**-0.5 + n2**-0.5)

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n1, n2 = self.total[a], self.total[b]
            if self._differ(self.ends[a], n1, self.ends[b], n2):
                return False
            for s in {*self.seen[a], *self.seen[b]}:
                if self._differ(self.seen[a].get(s, 0), n1, self.seen[b].get(s, 0), n2):
                    return False
                if s in self.next[a] and s in self.next[b]:
                    todo.append((self.next[a][s], self.next[b][s]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Adds the tree below b to the states from a on."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.total[a] += self.total[b]
            self.ends[a] += self.ends[b]
            for s, n in self.seen[b].items():
                self.seen[a][s] = self.seen[a].get(s, 0) + n
                if s in self.next[a]:
                    todo.append((self.next[a][s], self.next[b][s]))
                else:
                    self.next[a][s] = self.next[b][s]

    def _merge_all(self) -> None:
        kept, at = [0], 0
        while at < len(kept):
            state = kept[at]
            for symbol in sorted(self.next[state]):
                child = self.next[state][symbol]
                if child in kept:
                    continue
                for other in kept:
                    if self._compatible(other, child):
                        self.next[state][symbol] = other
                        self._fold(other, child)
                        break
                else:
                    kept.append(child)
            at += 1
            # a fold can hang new subtrees on earlier states
            if at == len(kept) and any(t not in kept for k in kept for t in self.next[k].values()):
                at = 0

    def log_probability(self, codes: bytes) -> float:
        """Of the whole string; minus infinity if it isn't accepted."""
        state, log = 0, 0.0
        for symbol in codes:
            step = self.log_move[state].get(symbol)
            if step is None:
                return -math.inf
            log += step
            state = self.next[state][symbol]
        return log + self.log_end[state]


class Formats:
    """The automata of all kinds and the model of ordinary text."""

    def __init__(self, values: dict[int, dict[str, int]], pairs: np.ndarray, threshold: float = 15.0):
        self.automata = {k: Automaton(by_classes(x)) for k, x in sorted(values.items()) if x}
        table = pairs.reshape(N, N) + 0.5
        self.plain = np.log(table / table.sum(axis=1, keepdims=True)).tolist()
        self.threshold = threshold
        self.verdicts: dict[bytes, int | None] = {}
        #: The least length of a string that can pass the threshold: shorter ones need not be scored.
        self.least = min(map(self._least, self.automata.values()), default=LONGEST)
        self.run = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % self.least)

    def _least(self, a: Automaton) -> int:
        """The least length at which some accepted string's log likelihood ratio passes the threshold: the largest ratio by
        state and last class, one symbol after another."""
        best = {(0, 0): 0.0}
        for length in range(1, LONGEST):
            longer: dict[tuple[int, int], float] = {}
            for (state, last), ratio in best.items():
                for symbol, log in a.log_move[state].items():
                    key = (a.next[state][symbol], symbol)
                    longer[key] = max(longer.get(key, -math.inf), ratio + log - self.plain[last][symbol])
            best = longer
            if any(r + a.log_end[state] - self.plain[last][0] >= self.threshold for (state, last), r in best.items()):
                return length
        return LONGEST

    def ordinary(self, codes: bytes) -> float:
        log, before = 0.0, 0
        for c in codes:
            log += self.plain[before][c]
            before = c
        return log + self.plain[before][0]

    def kind(self, value: str) -> int | None:
        """The kind whose automaton explains the value best, if any does much better than ordinary text."""
        codes = value.encode().translate(CODES)
        if codes in self.verdicts:
            return self.verdicts[codes]
        verdict = self._judged(codes)
        if len(codes) <= SHORT and len(self.verdicts) < VERDICTS:
            self.verdicts[codes] = verdict
        return verdict

    def _judged(self, codes: bytes) -> int | None:
        scores = [(a.log_probability(codes), -k) for k, a in self.automata.items()]
        best = max(scores, default=(-math.inf, 0))
        if best[0] == -math.inf or best[0] - self.ordinary(codes) < self.threshold:
            return None
        return -best[1]


def by_classes(values: dict[str, int]) -> dict[bytes, int]:
    """The class codes of the values, in order, with their counts."""
    out: Counter[bytes] = Counter()
    for value, n in sorted(values.items()):
        out[value.encode().translate(CODES)] += n
    return out


def learn(docs: DataFrame, per_kind: int = 400, threshold: float = 15.0) -> Formats:
    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_labelled, "kind int, value string, n long").groupBy("kind", "value").agg(F.sum("n").alias("n"))
    rows = saved(rows, "values")
    rank = F.row_number().over(Window.partitionBy("kind").orderBy(F.xxhash64("value"), "value"))
    # each task hands on its first values of a kind only; of the pairs there are N * N at most
    first = rows.where(F.col("kind") != PAIRS).withColumn("r", rank).where(F.col("r") <= per_kind).drop("r")
    values: dict[int, dict[str, int]] = {k: {} for k in range(len(KINDS))}
    pairs = np.zeros(N * N)
    for r in first.unionByName(rows.where(F.col("kind") == PAIRS)).collect():
        if r.kind == PAIRS:
            pairs[int(r.value)] = r.n
        else:
            values[r.kind][r.value] = r.n
    return Formats(values, pairs, threshold)


def uncovered(start: int, end: int, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The parts of a run outside ``spans``, which are in order of their starts."""
    out = []
    for s, _, e in spans:
        if s >= end:
            break
        if e > start:
            if s > start:
                out.append((start, s))
            start = e
    return out + [(start, end)] * (start < end)


def all_spans(text: str, formats: Formats) -> tuple[list, list]:
    """Base spans, and all spans with those that the automata add: (start, kind, end)."""
    data = text.encode()
    base = [(s, k, e) for s, k, e, _ in base_spans(text, data)]
    added = []
    for m in formats.run.finditer(text) if formats.automata else ():
        for start, end in uncovered(m.start(), m.end(), base) if base else [m.span()]:
            if end - start >= formats.least and (kind := formats.kind(text[start:end])) is not None:
                added.append((start, kind, end))
    return base, sorted(base + added)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(formats: Formats):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=WORD_CHUNK):
            rows = []
            for text in column(batch, "text").to_pylist():
                base, spans = all_spans(text or "", formats)
                kinds = [k for _, k, _ in base]
                rows.append((*(kinds.count(k) for k in range(3)), hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
            names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True))], ["doc_id", *names])

    return run


def scan(docs: DataFrame, formats: Formats | None = None) -> DataFrame:
    """doc_id with the counts by kind, the digest of the base spans and all spans as text."""
    formats = formats or learn(docs)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_scan(formats), f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def _redact(formats: Formats):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=WORD_CHUNK):
            texts = column(batch, "text").to_pylist()
            for i, text in enumerate(texts):
                if text and (spans := all_spans(text, formats)[1]):
                    out, at = [], 0
                    for s, k, e in spans:
                        if s >= at:
                            out += [text[at:s], f"[{KINDS[k]}]"]
                        at = max(at, e)
                    texts[i] = "".join([*out, text[at:]])
            cols = [pa.array(texts, pa.string()) if c == "text" else column(batch, c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names)

    return run


def redact(docs: DataFrame, formats: Formats | None = None) -> DataFrame:
    """``docs`` with every secret replaced by its kind in brackets; other texts and columns are unchanged."""
    return docs.mapInArrow(_redact(formats or learn(docs)), docs.schema)


def op3_secrets(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
