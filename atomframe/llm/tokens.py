"""Token ids of whole texts by the tokenizers library, with the ids of frequent words remembered in each worker.

A byte-level tokenizer's pretokens always begin at a single space between two visible characters, so a text's ids are
those of its space-separated pieces, each with its space; they also begin where a run of letters ends, so that a piece
is its leading letters and a rest. Heads, rests and pieces seen before are looked up; new heads and rests are encoded
together. Texts with any other white space next to a space, or with the string of an added token, are encoded whole.

Ids are those of the library's ``encode(text, add_special_tokens=False)``: the literal string of a special token in a
text is that token.
"""

from __future__ import annotations

import itertools
import json
import os
import re

import numpy as np

from atomframe.llm.common import Numbering, held, ranges

#: Pieces remembered in a worker, and heads and rests.
REMEMBERED, PARTS, MEAN = 500_000, 250_000, 16
HEAD = re.compile(r"[^\W\d_]+")


class Store:
    """Ids of strings, one after another; at most ``room`` strings stay from one call to the next."""

    def __init__(self, room: int = REMEMBERED):
        self.room, self.known, self.kept, self.chars = room, Numbering(), 0, 0
        self.begin, self.length, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def find(self, names: list[str]) -> tuple[np.ndarray, list[str]]:
        """The numbers of ``names``, and those that are new, in the order of their numbers."""
        old = len(self.known)
        found = self.known.all(names)
        return found, list(itertools.islice(reversed(self.known), len(self.known) - old))[::-1]

    def add(self, length: np.ndarray, flat: np.ndarray) -> None:
        """The ids of the new names."""
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.flat = np.concatenate([self.flat, flat])

    def trim(self) -> None:
        """Forgets the names that came last, as far as there is no room (on average MEAN characters and ids a name)."""
        new = list(itertools.islice(reversed(self.known), len(self.known) - self.kept))[::-1]
        sizes = np.cumsum([len(p) for p in new]) + self.chars + np.cumsum(self.length[self.kept :])
        stay = min(int(np.searchsorted(sizes, 2 * MEAN * self.room, side="right")), self.room - self.kept)
        for _ in range(len(new) - stay):
            self.known.popitem()
        self.chars, self.kept = int(sizes[stay - 1]) if stay else self.chars, len(self.known)
        self.begin, self.length = self.begin[: len(self.known)], self.length[: len(self.known)]
        if len(self.flat) > (end := int(self.begin[-1] + self.length[-1]) if len(self.begin) else 0):
            self.flat = self.flat[:end].copy()


class Encoder:
    """Encodes texts with one byte-level tokenizer file."""

    def __init__(self, path: str, share: int = 1):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for token, i in vocab.items():
            self.sizes[i] = len(token)
        parts = json.loads(self.tokenizer.to_str())
        self.byte_level = parts["pre_tokenizer"]["type"] == "ByteLevel" and parts["normalizer"] is None
        self.added = [token["content"] for token in parts["added_tokens"]]
        self.pieces, self.heads, self.rests = Store(REMEMBERED // share), Store(PARTS // share), Store(PARTS // share)
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, names: list[str], space: str) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids, and the ids, of strings that each begin a pretoken, each after ``space``."""
        if not names:
            return np.zeros(0, np.int64), np.zeros(0, np.uint32)
        if not space:
            each = self.whole(names)
            return np.array([len(x) for x in each], dtype=np.int64), np.concatenate([np.zeros(0, np.uint32), *each])
        groups, size, at = [], 0, []
        for i, p in enumerate(names):
            if not size:
                at.append(i)
            size = 0 if size > 4000 else size + len(p) + 1
        groups = [" " + " ".join(names[a:b]) for a, b in zip(at, [*at[1:], len(names)], strict=True)]
        flat = np.concatenate([np.zeros(0, np.uint32), *self.whole(groups)])
        ends = np.cumsum(self.sizes[flat])
        cuts = np.cumsum([len(p.encode()) + 1 for p in names])
        last = np.searchsorted(ends, cuts) + 1
        if len(last) and not np.array_equal(ends[np.minimum(last, len(ends)) - 1], cuts):  # joined across a space: one by one
            each = self.whole([space + name for name in names])
            return np.array([len(x) for x in each], dtype=np.int64), np.concatenate(each)
        return np.diff(last, prepend=0).astype(np.int64), flat

    def _new_pieces(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids, and the ids, of pieces after a space; none for a piece with white space at its ends."""
        heads, rests, parted, whole = [], [], [], []
        for k, p in enumerate(names):
            if not p or p[0].isspace() or p[-1].isspace():
                continue
            whole.append(k)
            n = len(p)
            if not p.isalpha():
                m = HEAD.match(p)
                if m and m[0].isalpha():
                    n = m.end()
                    rests.append(p[n:])
                    parted.append(k)
            heads.append(p[:n])
        h, new = self.heads.find(heads)
        self.heads.add(*self._together(new, " "))
        r, new = self.rests.find(rests)
        self.rests.add(*self._together(new, ""))
        begin, length = np.zeros((len(names), 2), np.int64), np.zeros((len(names), 2), np.int64)
        begin[whole, 0], length[whole, 0] = self.heads.begin[h], self.heads.length[h]
        begin[parted, 1], length[parted, 1] = self.rests.begin[r] + len(self.heads.flat), self.rests.length[r]
        flat = np.concatenate([self.heads.flat, self.rests.flat])[ranges(begin.ravel(), length.ravel())]
        self.heads.trim()
        self.rests.trim()
        return length.sum(axis=1), flat

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.byte_level:
            return self.whole(texts)
        pieces: list[str] = []
        firsts, counts = [], []
        special = np.array([any(token in text for token in self.added) for text in texts], dtype=bool)
        for text, skip in zip(texts, special.tolist(), strict=True):
            first, *rest = ("",) if skip else text.split(" ")
            firsts.append(first)
            counts.append(len(rest))
            pieces += rest
        counts = np.array(counts, dtype=np.int64)
        store = self.pieces
        found, new = store.find(pieces)
        store.add(*self._new_pieces(new))
        ends = np.cumsum(counts)
        bad = np.concatenate([[0], np.cumsum(store.length[found] == 0)])
        whole = bad[ends] - bad[ends - counts] > 0
        whole |= special | np.array([n > 0 and (not f or f[-1].isspace()) for f, n in zip(firsts, counts, strict=True)], dtype=bool)
        head = iter(self.whole([f for f, w in zip(firsts, whole, strict=True) if not w]))
        entire = iter(self.whole([t for t, w in zip(texts, whole, strict=True) if w]))
        use = found[np.repeat(~whole, counts)]
        lengths = store.length[use]
        ids = store.flat[ranges(store.begin[use], lengths)]
        sizes = np.concatenate([[0], np.cumsum(lengths)])
        stops = np.cumsum(np.where(whole, 0, counts))
        store.trim()
        return [next(entire) if whole[k] else np.concatenate([next(head), ids[sizes[stops[k] - counts[k]] : sizes[stops[k]]]]) for k in range(len(texts))]


#: The owner of the encoders that a worker keeps.
OWNER = "tokens"


def encoder(path: str, share: int = 1) -> Encoder:
    """The worker's encoder for a tokenizer file; ``share`` divides what it remembers."""
    encoders = held(OWNER)
    if (path, share) not in encoders:
        encoders[path, share] = Encoder(path, share)
    return encoders[path, share]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
