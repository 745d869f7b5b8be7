"""Similar names: an index of segments, searched with more and more edits, and rare tokens for what that leaves open.

A name within ``k`` edits of another, which is cut into ``k + 1`` segments, holds one of the segments unchanged and near its
place (at most ``i`` characters off for segment ``i``, seen from the left, and the like from the right). Names under one long
shared root would all share the segments that lie in the root, so the root (and an end that very many share) goes whole into
the first (last) segment and the cuts are made in what tells names apart. Buckets above ``BLOCK`` names are dealt out.

Nulls are left out, repeated names count once, an empty name resembles the empty name only, and an empty table on either
side gives no rows. Ties are broken by the suggestion."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from atomframe.session import written

#: Names of a bucket of the index that one task meets; larger buckets are dealt to several.
BLOCK = 1000
#: Beginnings and ends are counted at each so many characters, and are common if more names than this share them.
STEP, COMMON = 4, 64
#: Tasks that the rows of one bucket go to while its size is joined to them.
SLOTS = 64


def matching_ratio(a: str = "name", b: str = "suggestion") -> Column:
    """The matching-block similarity of two names (2 * matches / total length), as an Arrow batch function."""
    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        return pd.Series([SequenceMatcher(None, q, p).ratio() for p, q in zip(x, y, strict=True)], dtype="float64")

    return ratio(a, b)


def similar_names(missing: DataFrame, known: DataFrame, name: str, least: float = 0.72, best: int = 3, ratio: Column | None = None, edits: tuple[int, ...] = (3, 8)) -> DataFrame:
    """For each missing name up to ``best`` known ones of similarity ``least`` or more: by edit distance or, if given, by
    ``ratio`` (the matching-block ratio). Names within ``edits[0]`` edits are found first. A name is done when its ``best``
    found ones are better than any further away can be, or none further away can be similar; the others are searched with
    more edits and, after the last of ``edits``, by their rarest tokens. The result is the same for any ``edits``."""
    shortest = least if ratio is None else least / (2 - least)
    # A pair of similarity ``least`` is within ``far`` edits for each character of either name: the unmatched characters
    # of matching blocks are insertions and deletions.
    far = (1 - least) / least * (1 if ratio is None else 2)
    left = written(missing.select(F.col(name).alias("name")).where("name is not null").distinct(), "names-wanted")
    others = known.select(F.col(name).alias("suggestion")).where("suggestion is not null").distinct()
    done = []
    if far < 1:
        others = written(_with_ends(others), "names-known")
        total = others.count()
        for k in sorted(edits):
            index = written(segments(others, total, k, far), "names-index")
            found = written(_best(_scored(_candidates(left, index, k, shortest), ratio, least, k), best), "names-found")
            # No name more than k edits away is better than this.
            length = F.length("name") * (1 if ratio is None else 2)
            bound = length / (length + k + 1)
            worst = found.where(F.col("rank") == best).select("name", F.col("score").alias("worst"))
            state = left.join(worst, "name", "left")
            state = written(state.select("name", ((bound < least - 1e-9) | F.coalesce(F.col("worst") > bound + 1e-9, F.lit(False))).alias("done")), "names-state")
            done.append(found.join(state.where("done").select("name"), "name", "left_semi"))
            left = state.where("not done").select("name")
            if left.isEmpty():
                break
    rest = _best(_scored(_by_rare_tokens(left, others.select("suggestion"), least, shortest, ratio is not None), ratio, least), best)
    for found in done:
        rest = rest.unionByName(found)
    return rest


def _with_ends(others: DataFrame) -> DataFrame:
    """Adds ``heads`` and ``tails``: how many names share the first (last) STEP, 2 STEP ... characters, while they are common."""
    size = F.length("suggestion")
    cuts = lambda: F.when(size >= STEP, F.sequence(F.lit(1), F.floor(size / STEP).cast("int")))
    each = others.select("suggestion", F.pmod(F.xxhash64("suggestion"), F.lit(SLOTS)).alias("slot"), F.posexplode(F.array("suggestion", F.reverse("suggestion"))).alias("side", "text"))
    each = each.select("suggestion", "slot", "side", F.explode(cuts()).alias("cut"), "text")
    each = each.select("suggestion", "slot", "side", "cut", F.xxhash64("side", F.substr("text", F.lit(1), F.col("cut") * STEP)).alias("key"))
    common = each.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > COMMON).withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SLOTS - 1).cast("long"))))
    counts = lambda s: F.transform(F.array_sort(F.filter("ends", lambda e: e.side == s)), lambda e: e.n)
    ends = each.join(common, ["key", "slot"]).groupBy("suggestion").agg(F.collect_list(F.struct("side", "cut", "n")).alias("ends"))
    ends = ends.select("suggestion", counts(0).alias("heads"), counts(1).alias("tails"))
    none = F.array().cast("array<bigint>")
    return others.join(ends, "suggestion", "left").select("suggestion", size.alias("length"), F.coalesce("heads", none).alias("heads"), F.coalesce("tails", none).alias("tails"))


def _cut(place: Column) -> Column:
    """Where segment number ``place`` begins: segments are even between the root and the end, which they take in."""
    even = F.col("root") + F.floor((F.col("length") - F.col("root") - F.col("end")) * place / (F.col("k") + 1)).cast("int")
    return F.when(place == 0, 0).when(place == F.col("k") + 1, F.col("length")).otherwise(even)


def segments(others: DataFrame, total: int, k: int, far: float) -> DataFrame:
    """The index for ``k`` edits: (suggestion, length, k, root, end, segment, key, block). A root or end is as much of a name as
    more than total ** (k / (k + 1)) names share, so that it tells about as much as each other segment."""
    hot = max(float(COMMON), total ** (k / (k + 1)))
    shared = lambda ends: STEP * F.size(F.filter(ends, lambda n: n > hot))
    edits = F.least(F.lit(k), F.floor(F.col("length") * far + 1e-9)).cast("int")
    cut = others.select("suggestion", "length", edits.alias("k"), shared("heads").alias("root"), shared("tails").alias("end"))
    room = F.col("length") - F.col("k") - 1
    cut = cut.withColumn("root", F.greatest(F.lit(0), F.least("root", room))).withColumn("end", F.greatest(F.lit(0), F.least(F.col("end"), room - F.col("root"))))
    each = cut.withColumn("segment", F.explode(F.sequence(F.lit(0), F.col("k"))))
    begin, until = _cut(F.col("segment")), _cut(F.col("segment") + 1)
    return _dealt(each.withColumn("key", F.xxhash64("length", "root", "end", "segment", F.substr("suggestion", begin + 1, until - begin))))


def _large(index: DataFrame) -> DataFrame:
    """(key, slot, blocks) of the buckets above BLOCK."""
    large = index.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    return large.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SLOTS - 1).cast("long"))).alias("slot"), F.ceil(F.col("n") / BLOCK).alias("blocks"))


def _dealt(index: DataFrame) -> DataFrame:
    index = index.withColumn("slot", F.pmod(F.xxhash64("suggestion"), F.lit(SLOTS)))
    index = index.join(_large(index), ["key", "slot"], "left")
    block = F.pmod(F.xxhash64("suggestion", F.lit("block")), F.coalesce("blocks", F.lit(1)))
    return index.withColumn("block", block).drop("slot", "blocks")


def _candidates(names: DataFrame, index: DataFrame, k: int, shortest: float) -> DataFrame:
    """Pairs that share a segment near its place, and so all pairs within the edits of the index."""
    size = F.length("name").alias("size")
    classes = index.select("length", "k", "root", "end").distinct()
    probes = names.select("name", size).withColumn("length", F.explode(F.sequence(F.greatest(F.lit(0), F.col("size") - k), F.col("size") + k))).join(classes, "length")
    more, segment = F.col("size") - F.col("length"), F.col("segment")
    probes = probes.where((F.abs(more) <= F.col("k")) & (F.least("size", "length") >= F.greatest("size", "length") * shortest - 1e-9))
    probes = probes.withColumn("segment", F.explode(F.sequence(F.lit(0), F.col("k"))))
    begin, width = _cut(segment), _cut(segment + 1) - _cut(segment)
    probes = probes.withColumn("begin", begin).withColumn("width", width)
    first = F.greatest(F.lit(0), F.col("begin") - segment, F.col("begin") + more - (F.col("k") - segment))
    last = F.least(F.col("size") - F.col("width"), F.col("begin") + segment, F.col("begin") + more + (F.col("k") - segment))
    probes = probes.withColumn("place", F.explode(F.when(last >= first, F.sequence(first, last))))
    probes = probes.select("name", F.xxhash64("length", "root", "end", "segment", F.substr("name", F.col("place") + 1, F.col("width"))).alias("key"))
    probes = probes.distinct().withColumn("slot", F.pmod(F.xxhash64("name"), F.lit(SLOTS))).join(_large(index), ["key", "slot"], "left")
    probes = probes.select("name", "key", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)) - 1)).alias("block"))
    return probes.join(index.select("suggestion", "key", "block"), ["key", "block"]).select("name", "suggestion").distinct()


def _scored(pairs: DataFrame, ratio: Column | None, least: float, k: int | None = None) -> DataFrame:
    """Pairs of similarity ``least`` or more and, if given, within ``k`` edits."""
    distance = F.levenshtein("name", "suggestion") if k is None else F.levenshtein("name", "suggestion", k)
    longest = F.greatest(F.length("name"), F.length("suggestion"))
    if k is not None or ratio is None:
        pairs = pairs.withColumn("distance", distance).where("distance >= 0")
    score = ratio if ratio is not None else F.when(longest == 0, 1.0).otherwise(1 - F.col("distance") / longest)
    return pairs.withColumn("score", score).where(F.col("score") >= least).select("name", "suggestion", "score")


def _best(scored: DataFrame, best: int) -> DataFrame:
    r = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("score"), "suggestion"))
    return scored.withColumn("rank", r).where(F.col("rank") <= best)


def _numbered(tokens: Column) -> Column:
    """The elements of an array, each with its number among equal ones, so that a multiset becomes a set."""
    nth = lambda t, i: F.size(F.filter(F.slice(tokens, F.lit(1), i + 1), lambda x: x == t))
    return F.transform(tokens, lambda t, i: F.concat_ws("#", t, nth(t, i).cast("string")))


def _by_rare_tokens(names: DataFrame, others: DataFrame, least: float, shortest: float, by_blocks: bool) -> DataFrame:
    """Pairs whose lengths allow ``least`` and that share one of their rarest tokens: similar names share so many tokens
    (pairs of neighbouring characters, for matching blocks single characters) that they must share one among the first
    ``tokens - shared + 1`` of each in the order of rareness. Names that are too short for that are compared by length."""
    size = F.length("name")
    if by_blocks:
        tokens, shared = F.filter(F.split("name", ""), lambda x: x != ""), F.ceil(size * least / (2 - least) - 1e-9)
    else:
        tokens = F.when(size < 2, F.array()).otherwise(F.transform(F.sequence(F.lit(1), size - 1), lambda i: F.substr("name", i, F.lit(2))))
        shared = F.ceil(size * (2 * least - 1) - 1 - 1e-9)
    every = names.select("name", F.lit(0).alias("side")).unionByName(others.select(F.col("suggestion").alias("name"), F.lit(1).alias("side")))
    each = every.select("name", "side", shared.alias("shared"), F.explode(_numbered(tokens)).alias("g"))
    often = each.groupBy("g").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("side", "name").orderBy("n", "g"))
    total = F.count("*").over(Window.partitionBy("side", "name"))
    rare = each.join(often, "g").withColumn("place", place).withColumn("total", total).where(F.col("place") <= F.col("total") - F.greatest(F.col("shared"), F.lit(1)) + 1)
    of = lambda df, side: df.where(F.col("side") == side)
    a, b = of(rare, 0).select("name", "g"), of(rare, 1).select(F.col("name").alias("suggestion"), "g")
    short = every.where(shared <= 0).withColumn("length", size)
    reach = F.explode(F.sequence(F.lit(0), F.ceil(F.col("length") / shortest).cast("int"))).alias("length")
    alike = of(short, 0).select("name", reach).join(of(short, 1).select(F.col("name").alias("suggestion"), "length"), "length").select("name", "suggestion")
    pairs = a.join(b, "g").select("name", "suggestion").unionByName(alike)
    longest, smallest = F.greatest(size, F.length("suggestion")), F.least(size, F.length("suggestion"))
    return pairs.where(smallest >= longest * shortest - 1e-9).distinct()
