"""N-gram Jaccard join over prefix trees.

A document's set holds the distinct fingerprints of its word n-grams, in one global order: rarer first (the level of an
n-gram is the log of a lossy count over all documents), then by fingerprint. Two sets with a similarity of at least
``num / den`` share k of the first n - ceil(n * num / den) + k members of each (its prefix); k is 1 + n / 32.

1. Within a chunk of documents all sets are at hand: those that share a prefix member are joined, which leaves
   components of the chunk.
2. A prefix member reaches its bucket once for each chunk and component, so a group of copies, however large, sends a
   few rows. Members seen in several components make groups; equal groups are one.
3. The first component of each group is compared with the others (a star, not all pairs); links join components.
4. In groups that still hold several components, the first is compared with one of each other, now with all documents
   they stand for; this is repeated while it joins large ones. Then all pairs of components that share enough members
   over all groups are compared: pairs of documents where they are few, else both components as a whole, in one task,
   until a link is found. A component of a chunk is no larger than the chunk, so a task's work is bounded.

Pairs are compared only if their sizes and parities (two bits or more for each member, which bound the number of
different members from below) allow it; few pairs that are not similar pass. The probing text goes once to each block of
texts to compare it with. Comparing is a prefix-tree join: candidates are sorted so that common beginnings are adjacent,
which is the tree in depth-first order; the overlap with the probing set is carried along a shared beginning, and a
branch is left as soon as the overlap so far plus what remains cannot reach the bound. Components are found by joins
with saved tables, which go as soon as nothing reads them.

Equal sets are one node (a 64-bit fingerprint of the set). Null, empty and word-less texts have an empty set and are
linked with nothing; their component is their own doc_id. Documents of equal id, and equal rows, stay separate rows.
Rows without doc_id link like all others. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from atomframe.llm.common import chunks, column, dropped, mixed, numbered, parts, raw, saved, windows, word_hashes

SIEVE = 1 << 22
#: N-grams with a level above 0 at most (they are broadcast), and documents that make an n-gram common.
MOST_COMMON, COMMON = 1 << 20, 32
#: One more member of the prefix for so many members of the set.
MORE = 32
#: Bits of a set's parity: the least, and so many for each member or more, up to the next power of two.
PARITY, BITS_EACH = 64, 2
#: Texts that one copy of a probing text is compared with, about.
BLOCK = 500
#: Pairs of documents of two components are listed if they are at most so many for each document; rounds in which the
#: first component of a group is compared with one of each other, before all that are left are.
FEW, ROUNDS = 4, 3
#: Bits of the filter that goes to all tasks.
FILTER = 1 << 25
#: Text bytes of a chunk.
CHUNK = 3 << 20
NONE = np.zeros(0, np.uint64)


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Each text's distinct n-gram fingerprints, sorted; a shorter text is one n-gram."""
    ids, words, lengths = numbered([x.lower().split() for x in texts])
    hashes = word_hashes(words)[ids] if len(ids) else NONE
    grams = windows(hashes, n)
    out, at = [], 0
    for size in lengths.tolist():
        if size >= n:
            out.append(np.unique(grams[at : at + size - n + 1]))
        else:
            out.append(windows(hashes[at : at + size], size) if size else NONE)
        at += size
    return out


def node_of(members: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(members.tobytes())).view(np.int64)) if len(members) else 0


def parity(members: np.ndarray) -> np.ndarray:
    """Bits, each flipped once for every member that falls on it: two sets differ in at least as many members as their
    bits differ. Halves of a longer parity, one flipped by the other, are the parity of half the length."""
    size = max(PARITY, 1 << (BITS_EACH * len(members) - 1).bit_length())
    bits = np.bincount((members % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


class Join:
    """The similarity bound num / den and the global order."""

    def __init__(self, n: int, num: int, den: int, common: np.ndarray, levels: np.ndarray):
        self.n, self.num, self.den, self.common, self.levels = n, num, den, common, levels
        self.sieve = np.zeros(SIEVE, dtype=bool)
        self.sieve[common % np.uint64(SIEVE)] = True

    def ordered(self, members: np.ndarray) -> np.ndarray:
        """A sorted set in the global order."""
        return self.split(members)[0]

    def split(self, members: np.ndarray) -> tuple[np.ndarray, int]:
        """A sorted set in the global order, and how many common members it has (they come last)."""
        maybe = np.flatnonzero(self.sieve[members % np.uint64(SIEVE)])
        if not len(maybe):
            return members, 0
        at = np.searchsorted(self.common, members[maybe])
        at[at == len(self.common)] = 0
        hit = self.common[at] == members[maybe]
        level = np.zeros(len(members), dtype=np.int8)
        level[maybe[hit]] = self.levels[at[hit]]
        return members[np.argsort(level, kind="stable")], int(np.count_nonzero(hit))

    def prefix(self, size: int) -> int:
        return size - -(-size * self.num // self.den) + self.common_members(size)

    def common_members(self, size: int) -> int:
        """How many members of their prefixes two similar sets share at least, the smaller one of this size."""
        return 1 + size // MORE

    def needed(self, a: int, b: int) -> int:
        """The least overlap of sets of these sizes that are similar."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def near(self, a: int, b: int) -> bool:
        return self.den * min(a, b) >= self.num * max(a, b)

    def probe(self, members: np.ndarray, others: list[np.ndarray]) -> list[bool]:
        """Which of the ordered sets ``others`` are similar to ``members`` (sorted by fingerprint)."""
        order = sorted(range(len(others)), key=lambda i: others[i].astype(">u8").tobytes())
        out = [False] * len(others)
        before, counts, pruned = NONE, np.zeros(1, np.int64), None
        for i in order:
            other = others[i]
            m = min(len(before), len(other))
            differ = np.flatnonzero(before[:m] != other[:m])
            shared = int(differ[0]) if len(differ) else m
            needed = self.needed(len(members), len(other))
            depth = min(shared, len(counts) - 1)
            overlap = counts[: depth + 1]
            if pruned is not None and shared >= pruned and overlap[pruned] + len(other) - pruned < needed:
                continue  # the whole branch below the pruned place, as far as the bound of this set goes too
            pruned = None
            step = 64
            while depth < len(other):
                new = other[depth : depth + step]
                at = np.searchsorted(members, new)
                at[at == len(members)] = 0
                overlap = np.concatenate([overlap, overlap[-1] + np.cumsum(members[at] == new)])
                depth += len(new)
                if overlap[-1] + len(other) - depth < needed:
                    pruned = depth
                    break
                step *= 2
            out[i] = depth == len(other) and int(overlap[-1]) >= needed
            before, counts = other, overlap
        return out


class Components:
    """Union-find over local numbers; a component is named by its smallest node."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def _groups(keys: np.ndarray, values: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """The distinct groups of two or more distinct values that share a key, each with its number of keys."""
    order = np.lexsort((values, keys))
    k, v = keys[order], values[order]
    fresh = np.append(True, (k[1:] != k[:-1]) | (v[1:] != v[:-1])) if len(k) else np.zeros(0, bool)
    k, v = k[fresh], v[fresh]
    starts = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(k)))
    marks = np.add.reduceat(mixed(v.astype(np.int64).view(np.uint64) + np.uint64(7)), starts) if len(starts) else NONE
    many = np.flatnonzero(sizes > 1)
    _, once, times = np.unique(marks[many], return_index=True, return_counts=True)
    return [(v[starts[g] : starts[g] + sizes[g]], int(n)) for g, n in zip(many[once], times, strict=True)]


def marked(members: np.ndarray, often: int, size: int) -> np.ndarray:
    """The first ``size`` of ordered members as tokens, whose last bit says whether they are common."""
    common = np.arange(size) >= len(members) - often
    return (members[:size] & ~np.uint64(1)) | common.astype(np.uint64)


def join_chunk(join: Join, sets: list[np.ndarray]) -> tuple[list[np.ndarray], Components, list[int]]:
    """All links among sorted, distinct sets: the tokens of their prefixes, their components and common members."""
    parted = [join.split(s) for s in sets]
    ordered, often = [o for o, _ in parted], [n for _, n in parted]
    heads = [marked(o, n, min(len(o), join.prefix(len(o)))) if len(o) else NONE for o, n in parted]
    tokens = np.concatenate([NONE, *heads])
    owners = np.repeat(np.arange(len(sets)), [len(h) for h in heads])
    comps, checked = Components(len(sets)), set()
    for group, _ in _groups(tokens, owners):
        group = group.tolist()
        while True:
            by: dict[int, list[int]] = {}
            for i in group:
                by.setdefault(comps.find(i), []).append(i)
            if len(by) < 2:
                break
            small = min(by.values(), key=len)
            own = set(small)
            rest = [i for i in group if i not in own]
            for i in small:
                todo = [j for j in rest if comps.find(i) != comps.find(j) and (min(i, j), max(i, j)) not in checked and join.near(len(sets[i]), len(sets[j]))]
                checked.update((min(i, j), max(i, j)) for j in todo)
                for j, same in zip(todo, join.probe(sets[i], [ordered[j] for j in todo]) if todo else [], strict=True):
                    if same:
                        comps.join(i, j)
            group = rest
    return heads, comps, often


def _common_rows(n: int):
    """N-grams that at least two different sets of a chunk have: rows (gram, sets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=CHUNK):
            sets = {node_of(s): s for s in shingle_sets(raw(batch), n)}
            grams, counts = np.unique(np.concatenate([NONE, *sets.values()]), return_counts=True)
            often = counts > 1
            yield pa.RecordBatch.from_arrays([pa.array(grams[often].view(np.int64)), pa.array(counts[often])], ["gram", "n"])

    return run


def common_grams(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of many sets, sorted, with their levels; at most MOST_COMMON, since each has that share of the total."""
    counts = saved(docs.select("text").mapInArrow(_common_rows(n), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON), "grams", light=True)
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.where(F.col("n") > total // MOST_COMMON).collect()  # fewer than MOST_COMMON rows
    dropped(counts)
    grams = np.array([r.gram for r in rows], dtype=np.int64).view(np.uint64)
    order = np.argsort(grams)
    return grams[order], np.log2(np.array([r.n for r in rows], dtype=np.float64)[order]).astype(np.int8) if rows else np.zeros(0, np.int8)


def _chunk_rows(join: Join, buckets: int):
    """Documents with their nodes and chunk components, and blobs of (prefix member, component) by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=CHUNK):
            every = shingle_sets(raw(batch), join.n)
            nodes = [node_of(s) for s in every]
            sets = {k: s for k, s in sorted(zip(nodes, every, strict=True), key=lambda x: x[0]) if len(s)}
            heads, comps, often = join_chunk(join, list(sets.values()))
            names = np.array(list(sets), dtype=np.int64)
            at = {k: i for i, k in enumerate(sets)}
            comp_of = [int(names[comps.find(at[k])]) if len(s) else None for k, s in zip(nodes, every, strict=True)]
            size = len(nodes)
            own = {
                "doc_id": column(batch, "doc_id"),
                "row_key": column(batch, "row_key"),
                "node": pa.array([k if len(s) else None for k, s in zip(nodes, every, strict=True)], pa.int64()),
                "n": pa.array([len(s) for s in every], pa.int64()),
                "often": pa.array([often[at[k]] if len(s) else 0 for k, s in zip(nodes, every, strict=True)], pa.int64()),
                "comp": pa.array(comp_of, pa.int64()),
                "parity": pa.array([parity(s) if len(s) else None for s in every], BITS),
            }
            yield pa.RecordBatch.from_arrays([pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary()), pa.nulls(size, pa.binary()), *own.values()], ROW)
            tokens = np.concatenate([NONE, *heads])
            owner = names[[comps.find(i) for i in range(len(heads))]] if len(heads) else np.zeros(0, np.int64)
            owner = np.repeat(owner, [len(h) for h in heads])
            pairs = np.unique(np.stack([tokens.view(np.int64), owner], axis=1), axis=0) if len(tokens) else np.zeros((0, 2), np.int64)
            bucket = (mixed(pairs[:, 0].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = [*np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order)]
            rows = [(int(bucket[order[a]]), pairs[order[a:b], 0].tobytes(), pairs[order[a:b], 1].tobytes()) for a, b in zip(cuts, cuts[1:], strict=False)]
            none = [pa.nulls(len(rows), t) for t in (column(batch, "doc_id").type, *[pa.int64()] * 5, BITS)]
            yield pa.RecordBatch.from_arrays([*(pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.binary(), pa.binary()))), *none], ROW)

    return run


ROW = ["bucket", "tokens", "comps", "doc_id", "row_key", "node", "n", "often", "comp", "parity"]
BITS = pa.list_(pa.int64())


def _bucket_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passes documents on and turns a bucket's blobs into distinct groups of components: rows (sig, comp) with m, the
    number of members that have the group, and often: whether they are common (such members make groups of their own)."""
    tokens, comps = [], []
    for batch in batches:
        docs = batch.filter(pa.array(np.asarray(column(batch, "bucket").is_null())))
        if docs.num_rows:
            none = pa.nulls(docs.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, *(column(docs, c) for c in ROW[3:])], ["sig", "m", *ROW[3:]])
        for t, c in zip(column(batch, "tokens").to_pylist(), column(batch, "comps").to_pylist(), strict=True):
            if t is not None:
                tokens.append(np.frombuffer(t, np.uint64))
                comps.append(np.frombuffer(c, np.int64))
        kind = column(batch, "doc_id").type
    if not tokens:
        return
    keys, values = np.concatenate(tokens), np.concatenate(comps)
    tokens.clear()
    comps.clear()
    for often in (0, 1):
        mine = keys & np.uint64(1) == often
        groups = _groups(keys[mine], values[mine])
        for a in range(0, len(groups), 20_000):
            some, times = zip(*groups[a : a + 20_000], strict=True)
            sizes = [len(g) for g in some]
            flat, none = np.concatenate(some), pa.nulls(sum(sizes), pa.int64())
            sigs = np.repeat(np.array([xxhash.xxh3_64_intdigest(g.tobytes(), seed=often) for g in some], dtype=np.uint64).view(np.int64), sizes)
            out = [pa.array(sigs), pa.array(np.repeat(np.array(times, dtype=np.int64), sizes)), pa.nulls(len(flat), kind), none, none, none, pa.array(np.full(len(flat), often)), pa.array(flat), pa.nulls(len(flat), BITS)]
            yield pa.RecordBatch.from_arrays(out, ["sig", "m", *ROW[3:]])


def _verify(join: Join):
    """Rows (a, node, first, text), the probing text (first) before those to compare with it: the similar pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, NONE
        for batch in chunks(batches, limit=CHUNK):
            probing, nodes, first = (column(batch, c).to_pylist() for c in ("a", "node", "first"))
            sets = shingle_sets(raw(batch), join.n)
            out_a, out_b, at = [], [], 0
            while at < len(sets):
                if first[at]:
                    key, members = probing[at], sets[at]
                    at += 1
                    continue
                end = at
                while end < len(sets) and not first[end]:
                    end += 1
                for k, same in enumerate(join.probe(members, [join.ordered(s) for s in sets[at:end]])):
                    if same:
                        out_a.append(key)
                        out_b.append(nodes[at + k])
                at = end
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    return run


def verified(join: Join, pairs: DataFrame, docs: DataFrame, once: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar. ``once``: one row_key of ``docs`` for each node. The texts to
    compare with a are dealt in blocks, so that a text with many partners is not one task's work."""
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("blocks")).alias("block"))
    roles = dealt.select("a", "block", F.col("b").alias("node"), F.lit(False).alias("first"))
    roles = roles.unionByName(dealt.select("a", "block", F.col("a").alias("node"), F.lit(True).alias("first")).distinct())
    wanted = saved(roles.join(once.select("node", "row_key"), "node"), "wanted")
    near = fetched(docs, wanted, "a", "block").sortWithinPartitions("a", "block", F.desc("first"))
    out = saved(near.select("a", "node", "first", "text").mapInArrow(_verify(join), "a long, b long"), "links")
    dropped(wanted)
    return out


def fetched(docs: DataFrame, wanted: DataFrame, *by: str) -> DataFrame:
    """``wanted`` (row_key, node, ...) with the texts, dealt by the given columns."""
    slim = docs.select("row_key", "text")
    found = slim.mapInArrow(_sift(wanted_bits(wanted)), slim.schema).join(wanted, "row_key").dropDuplicates(["row_key", "node", *by])
    return found.repartition(parts(docs.sparkSession), *by)


def _link_components(join: Join):
    """Rows (comp_a, comp_b, second, node, text), a pair's first component before its second: one link where there is one."""

    def link(ours: list, theirs: list) -> tuple[int, int] | None:
        if swapped := len(ours) > len(theirs):
            ours, theirs = theirs, ours
        ordered = [(node, join.ordered(s)) for node, s in theirs]
        for node, members in ours:
            near = [x for x in ordered if join.near(len(members), len(x[1]))]
            for (other, _), same in zip(near, join.probe(members, [o for _, o in near]), strict=True):
                if same:
                    return (other, node) if swapped else (node, other)
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, sides = None, ([], [])
        found: list[tuple[int, int]] = []

        def end() -> None:
            if all(sides) and (one := link(*sides)):
                found.append(one)
            sides[0].clear()
            sides[1].clear()

        for batch in chunks(batches, limit=CHUNK):
            keys = zip(*(column(batch, c).to_pylist() for c in ("comp_a", "comp_b", "second", "node")), strict=True)
            for (a, b, second, node), members in zip(keys, shingle_sets(raw(batch), join.n), strict=True):
                if (a, b) != pair:
                    end()
                    pair = (a, b)
                sides[second].append((node, members))
        end()
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def linked_components(join: Join, pairs: DataFrame, of: DataFrame, docs: DataFrame, once: DataFrame) -> DataFrame:
    """Links (a, b) between the components of ``pairs`` (comp_a, comp_b, low_a, high_a, low_b, high_b: their sizes), one
    for each pair that has any. ``of``: comp, node, n."""
    roles = None
    for own, other in ("ab", "ba"):
        nodes = of.select(F.col("comp").alias(f"comp_{own}"), "node", "n")
        fits = (F.col("n") * join.den >= F.col(f"low_{other}") * join.num) & (F.col(f"high_{other}") * join.den >= F.col("n") * join.num)
        side = pairs.join(nodes, f"comp_{own}").where(fits).select("comp_a", "comp_b", F.lit(own == "b").alias("second"), "node")
        roles = side if roles is None else roles.unionByName(side)
    wanted = saved(roles.join(once.select("node", "row_key"), "node"), "wanted")
    near = fetched(docs, wanted, "comp_a", "comp_b").sortWithinPartitions("comp_a", "comp_b", "second")
    out = saved(near.select("comp_a", "comp_b", "second", "node", "text").mapInArrow(_link_components(join), "a long, b long"), "links")
    dropped(wanted)
    return out


def with_links(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after more links."""
    every = saved(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(links), "links", light=True)
    out = components(every)
    dropped(every, labels, links)
    return out


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): the smallest node of its component. Each round takes every node
    to the smallest label among its neighbours and then to the label of that, until nothing changes."""
    both = saved(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges", light=True)
    labels = saved(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels", light=True)
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels.node == near.a).select("node", F.col("label").alias("old"), F.least("label", "near").alias("low"))
        roots = labels.select(F.col("node").alias("low"), F.col("label").alias("root"))
        new = saved(step.join(roots, "low", "left").select("node", "old", F.least("low", F.coalesce("root", "low")).alias("label")), "labels", light=True)
        dropped(labels)
        labels = new.select("node", "label")
        if new.where("old <> label").isEmpty():
            dropped(both)
            return labels


def _sift(bits: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.asarray(column(batch, "row_key")).view(np.uint64) % np.uint64(FILTER)
            yield batch.filter(pa.array((bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)))

    return run


def wanted_bits(wanted: DataFrame) -> np.ndarray:
    """A bitmap of FILTER bits, whatever the number of rows, of the row_keys: it keeps most of the texts that are not
    wanted out of the shuffle; the join decides. Where very many are wanted it lets all texts through, which is one
    shuffle of the input."""
    place = F.pmod(F.col("row_key"), F.lit(FILTER)).alias("at")
    # a negative key's pmod is its unsigned remainder, since FILTER divides 2 ** 64; bitmaps count from 1
    rows = wanted.select((place + 1).alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect()
    bits = np.zeros((FILTER // 32768, 4096), dtype=np.uint8)
    for r in rows:  # at most FILTER / 32768 rows
        bits[r.bucket - 1] = np.frombuffer(bytes(r.bits), dtype=np.uint8)
    return bits.ravel()


def _sizes_allow(join: Join):
    return (F.col("n_a") * join.den >= F.col("n_b") * join.num) & (F.col("n_b") * join.den >= F.col("n_a") * join.num)


def _parities_allow(join: Join):
    """Sizes that allow the similarity are within a factor of two, so that at most one parity has to be folded once."""
    words = F.least(F.size("p_a"), F.size("p_b"))

    def folded(p: str):
        half = F.zip_with(F.slice(p, F.lit(1), words), F.slice(p, words + 1, words), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(p) > words, half).otherwise(F.col(p))

    differ = F.aggregate(F.zip_with(folded("p_a"), folded("p_b"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    needed = F.ceil(join.num * (F.col("n_a") + F.col("n_b")) / (join.num + join.den))
    return differ <= F.col("n_a") + F.col("n_b") - 2 * needed


def row_key() -> Column:
    """A row's name: rows of equal id and text have the same."""
    return F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id").cast("string"), F.col("text").cast("string"))


def grouped(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """doc_id, n_shingles, component_id, row_key and first (the row_key of the component's first row; null for an empty
    set) of every row of ``docs``."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("row_key", row_key())
    kind = docs.schema["doc_id"].dataType.simpleString()
    join = Join(n, num, den, *common_grams(docs, n))
    buckets = parts(spark)
    rows = docs.mapInArrow(_chunk_rows(join, buckets), f"bucket int, tokens binary, comps binary, doc_id {kind}, row_key long, node long, n long, often long, comp long, parity array<bigint>")
    spread = rows.repartition(buckets, F.coalesce("bucket", F.pmod(F.xxhash64("doc_id", "node"), F.lit(buckets)).cast("int")))
    out = saved(spread.mapInArrow(_bucket_groups, f"sig long, m long, doc_id {kind}, row_key long, node long, n long, often long, comp long, parity array<bigint>"), "groups")
    nodes = out.where("sig is null")
    groups = out.where("sig is not null").groupBy("sig", "comp").agg(F.sum("m").alias("m"), F.first("often").alias("often"))
    # one row for each node; a node's components in different chunks are linked by the node itself
    nodes = nodes.where("node is not null")
    once = saved(nodes.groupBy("node").agg(F.first("n").alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("best"), F.first("parity").alias("parity")).withColumn("row_key", F.col("best.row_key")), "nodes")
    member = nodes.select(F.col("node").alias("a"), F.col("comp").alias("b")).distinct()
    groups = saved(groups, "groups")
    side = {c: once.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("parity").alias(f"p_{c}")) for c in "ab"}

    leaders = groups.groupBy("sig").agg(F.min("comp").alias("a"))
    starred = groups.join(leaders, "sig").where("comp <> a").select("a", F.col("comp").alias("b")).distinct()
    sized = starred.join(side["a"], "a").join(side["b"], "b").where(_sizes_allow(join)).where(_parities_allow(join))
    stars = saved(sized.select("a", "b"), "stars", light=True)
    links = saved(member.where("a <> b").unionByName(verified(join, stars, docs, once)), "links", light=True)
    labels = components(links)
    dropped(links)
    # what is still apart within a group
    of = saved(nodes.select("comp", "node", "n", "often", "parity").dropDuplicates(["comp", "node"]), "members")
    mostly = F.bool_or(F.col("often") * (num + den) >= 2 * num * F.col("n"))
    span = saved(of.groupBy("comp").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("size"), F.max("often").alias("most"), mostly.alias("mostly")), "spans", light=True)

    def apart() -> DataFrame:
        """Groups of several labels: sig, comp, m, often, label and the component's sizes."""
        named = groups.join(labels, groups.comp == labels.node, "left").select("sig", "comp", "m", "often", F.coalesce("label", "comp").alias("label"))
        several = named.groupBy("sig").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most").select("sig", "least")
        return saved(named.join(several, "sig").join(span, "comp"), "mixed", light=True)

    sides = ("comp", "label", "low", "high", "size")
    near_sizes = (F.col("high_a") * den >= F.col("low_b") * num) & (F.col("high_b") * den >= F.col("low_a") * num)
    heavy = F.col("size_a") * F.col("size_b") > FEW * (F.col("size_a") + F.col("size_b"))
    tested = None
    for _ in range(ROUNDS):
        mixed_groups = apart()
        each = mixed_groups.groupBy("sig", "label").agg(F.min(F.struct("comp", "low", "high", "size")).alias("c"), F.first("least").alias("least"))
        at = {c: F.struct(F.col("label"), *[F.col(f"c.{x}").alias(x) for x in ("comp", "low", "high", "size")]) for c in "ab"}
        first = each.where("label = least").select("sig", at["a"].alias("a"))
        trial = each.where("label > least").select("sig", at["b"].alias("b")).join(first, "sig").select(*[F.col(f"{c}.{x}").alias(f"{x}_{c}") for c in "ab" for x in sides])
        trial = trial.where(near_sizes & heavy).dropDuplicates(["comp_a", "comp_b"])
        trial = saved(trial if tested is None else trial.join(tested, ["comp_a", "comp_b"], "left_anti"), "trial", light=True)
        dropped(mixed_groups)
        if trial.isEmpty():
            break
        labels = with_links(labels, linked_components(join, trial, of, docs, once))
        tested = trial.select("comp_a", "comp_b") if tested is None else tested.unionByName(trial.select("comp_a", "comp_b"))
    mixed_groups = apart()
    # Two sets that need a larger overlap than either has common members share others too, so the groups of common members
    # may leave them out. The smaller of two sets that do not is mostly common: needed(n, n) is no larger than its common
    # members.
    more = (*sides[2:], "most", "mostly")
    left, right = (mixed_groups.select("sig", "often", *[F.col(x).alias(f"{x}_{c}") for x in ("m", "comp", "label", *more)]) for c in "ab")
    rare = left.where("often = 0").drop("often").join(right.where("often = 0").drop("often"), "sig").where((F.col("label_a") < F.col("label_b")) & near_sizes)
    room = (F.col("low_a") + F.col("low_b")) * num <= F.least("most_a", "most_b") * (num + den)
    once_only = ~F.col("mostly_a") | (F.col("label_a") < F.col("label_b"))
    common = left.where("often = 1").drop("often").join(right.where("often = 1 and mostly_b").drop("often"), "sig")
    common = common.where((F.col("label_a") != F.col("label_b")) & near_sizes & room & once_only)
    turned = F.col("label_a") > F.col("label_b")
    common = common.select("sig", *[F.when(turned, F.col(f"{x}_{d}")).otherwise(F.col(f"{x}_{c}")).alias(f"{x}_{c}") for x in ("m", "comp", "label", *more) for c, d in ("ab", "ba")])
    cross = rare.unionByName(common.select(*rare.columns)).groupBy("comp_a", "comp_b")
    cross = cross.agg(F.sum("m_a").alias("shared"), *[F.first(f"{x}_{c}").alias(f"{x}_{c}") for x in (*sides[2:], "most") for c in "ab"])

    def enough(n: str, often: str):
        """The members of their prefixes that similar sets of these sizes share at least, as far as the groups show them."""
        a, b = F.col(f"{n}_a"), F.col(f"{n}_b")
        others = F.ceil(num * (a + b) / (num + den)) - F.least(f"{often}_a", f"{often}_b")
        k = 1 + F.floor(F.least(a, b) / MORE)
        return F.col("shared") >= F.when(others > 0, F.least(k, others)).otherwise(F.lit(1) if n == "low" else k)

    cross = cross.where(enough("low", "most"))
    cross = saved(cross if tested is None else cross.join(tested, ["comp_a", "comp_b"], "left_anti"), "cross", light=True)
    few = cross.where(~heavy).select("comp_a", "comp_b", "shared")
    for c in "ab":
        few = few.join(of.select(*[F.col(x).alias(y) for x, y in (("comp", f"comp_{c}"), ("node", c), ("n", f"n_{c}"), ("often", f"often_{c}"), ("parity", f"p_{c}"))]), f"comp_{c}")
    pairs = few.where(_sizes_allow(join)).where(enough("n", "often")).where(_parities_allow(join)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    done = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = saved(pairs.join(done, ["a", "b"], "left_anti"), "pairs", light=True)
    if not rest.isEmpty():
        labels = with_links(labels, verified(join, rest, docs, once))
    many = cross.where(heavy)
    if not many.isEmpty():
        labels = with_links(labels, linked_components(join, many, of, docs, once))
    dropped(mixed_groups, stars, groups, cross, of, span)
    final = once.join(labels, "node", "left").select("node", "best", F.coalesce("label", "node").alias("label"))
    smallest = final.groupBy("label").agg(F.min("best").alias("best"))
    ids = saved(final.join(smallest.withColumnRenamed("best", "least"), "label").select("node", F.col("least.doc_id").alias("component_id"), F.col("least.row_key").alias("first")), "components", light=True)
    dropped(rest, once, labels)
    result = out.where("sig is null").select("doc_id", "row_key", "node", "n").join(ids, "node", "left")
    return result.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "row_key", "first")


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text)."""
    return grouped(docs, n, num, den).select("doc_id", "n_shingles", "component_id")


def representatives(docs: DataFrame, n: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one of smallest doc_id (rows without doc_id last, equal ids by
    a hash of the text), once if it is there repeatedly; and every row with an empty set."""
    keys = grouped(docs, n, num, den).where("first is null or first = row_key").select(F.col("row_key").alias("__row_key"), F.col("first").isNull().alias("__alone")).distinct()
    staying = docs.withColumn("__row_key", row_key()).join(keys, "__row_key")
    own = staying.where("not __alone").dropDuplicates(["__row_key"])
    return own.unionByName(staying.where("__alone")).select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_jaccard(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
with recursive d as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select r, doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) end as g from d),
u as (select r, unnest(g) as g from s),
p as (select a.r as a, b.r as b, count(*) as c from u a join u b on a.g = b.g and a.r < b.r group by 1, 2),
l as (select a, b from p join s x on x.r = a join s y on y.r = b where 100 * c >= 75 * (len(x.g) + len(y.g) - c)),
e as (select a, b from l union all select b, a from l),
reach as (select r, r as x from s union select reach.r, e.b from reach join e on e.a = reach.x),
m as (select reach.r, min(s.doc_id) as low from reach join s on s.r = reach.x group by 1)
select s.doc_id, len(s.g)::bigint as n_shingles, coalesce(m.low, s.doc_id) as component_id from s join m using (r)
"""
