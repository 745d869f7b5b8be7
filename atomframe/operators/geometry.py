"""Periodic cells: wrapping and close contacts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from atomframe.functions.expressions import any_of, inverse3, scaled, wrapped


def atoms(frames: DataFrame, *keys: str, coord: str = "coord") -> DataFrame:
    """One row for each atom of each frame: keys, atom (from 0), x, y, z."""
    at = lambda k: F.element_at(coord, F.col("atom") * 3 + k + 1)
    n = F.floor(F.size(coord) / 3).cast("int")
    rows = frames.where(n > 0).select("*", F.explode(F.sequence(F.lit(0), n - 1)).alias("atom"))
    return rows.select(*keys, "atom", at(0).alias("x"), at(1).alias("y"), at(2).alias("z"))


def wrap_positions(rows: DataFrame, box: str = "box", tolerance: float = 1e-8) -> DataFrame:
    """Adds scaled and wrapped coordinates (s0.., w0..) and whether the atom was out of bounds by more than ``tolerance``."""
    s = scaled([F.col("x"), F.col("y"), F.col("z")], inverse3(box))
    out = rows.withColumns({f"s{k}": c for k, c in enumerate(s)})
    outside = any_of([(F.col(f"s{k}") < -tolerance) | (F.col(f"s{k}") > 1 + tolerance) for k in range(3)])
    return out.withColumns({f"w{k}": wrapped(F.col(f"s{k}")) for k in range(3)}).withColumn("out_of_bounds", outside)


def unwrapped_trajectories(frames: DataFrame, system: str, frame: str, flag: str) -> DataFrame:
    """The first frame of each trajectory that has an atom out of bounds."""
    return frames.where(F.col(flag)).groupBy(system).agg(F.min(frame).alias("first_bad_frame"), F.count_distinct(frame).alias("bad_frames"))


def close_contacts(rows: DataFrame, frame: str, cutoff: float, lengths: tuple[float, float, float], periodic: tuple[bool, bool, bool] = (True, True, False)) -> DataFrame:
    """Pairs of atoms (a < b) of a frame nearer than ``cutoff`` in a rectangular cell. Atoms are put in bins at least
    ``cutoff`` wide and compared with their bin and its neighbours only; the distance is that of the nearest image."""
    axes = ("x", "y", "z")
    bins = [max(1, int(math.floor(length / cutoff))) if p else None for length, p in zip(lengths, periodic, strict=True)]
    placed = rows
    for c, length, n in zip(axes, lengths, bins, strict=True):
        cell = F.pmod(F.floor(F.col(c) / (length / n)), F.lit(n)) if n else F.floor(F.col(c) / cutoff)
        placed = placed.withColumn(f"b{c}", cell.cast("int"))
    near = placed
    for c, n in zip(axes, bins, strict=True):
        steps = [0] if n == 1 else [0, 1] if n == 2 else [-1, 0, 1]
        near = near.withColumn(f"b{c}", F.explode(F.array(*[F.pmod(F.col(f"b{c}") + s, F.lit(n)) if n else F.col(f"b{c}") + s for s in steps])))
    other = near.select(F.col(frame), *[F.col(f"b{c}") for c in axes], F.col("atom").alias("atom_b"), *[F.col(c).alias(f"{c}_b") for c in axes])
    pairs = placed.join(other, [frame, *[f"b{c}" for c in axes]]).where(F.col("atom") < F.col("atom_b"))
    square = F.lit(0.0)
    for c, length, p in zip(axes, lengths, periodic, strict=True):
        d = F.col(c) - F.col(f"{c}_b")
        d = d - F.lit(length) * F.bround(d / length) if p else d
        square = square + d * d
    return pairs.select(frame, F.col("atom").alias("atom_a"), "atom_b", F.sqrt(square).alias("distance")).where(F.col("distance") < cutoff)


def _neighbours(rows: DataFrame, k: int, cutoff: float, periodic: bool) -> DataFrame:
    """Each row once for each bin along edge ``k`` that an atom near to it may lie in (``__c``), with the scaled coordinates of
    its images that are within the cutoff of the cell and in this bin or the next ones (``__v``)."""
    s, d = F.col(f"__s{k}"), F.col(f"__d{k}")
    reach, top = F.lit(cutoff) / d, F.floor(d / cutoff).cast("long")
    far = F.ceil(reach).cast("int")
    bin_of = lambda v: F.floor(v * d / cutoff).cast("long")
    places = F.filter(F.transform(F.sequence(-far, far), lambda n: s + n), lambda v: (v >= -reach) & (v < 1 + reach)) if periodic else F.array(s)
    rows = _once(rows, "__all", places)
    around = F.array_distinct(F.flatten(F.transform("__all", lambda v: F.sequence(bin_of(v) - 1, bin_of(v) + 1))))
    around = F.filter(around, lambda c: (c >= 0) & (c <= top)) if periodic else around
    pairs = F.transform(around, lambda c: F.struct(c.alias("c"), F.filter("__all", lambda v: F.abs(bin_of(v) - c) <= 1).alias("v")))
    return rows.withColumn("__n", F.explode(pairs)).withColumns({f"__c{k}": F.col("__n.c"), f"__v{k}": F.col("__n.v")}).drop("__n", "__all")


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is worked out once for each row and not copied into every expression that uses it."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


#: Up to so many images of an atom near to a bin are compared by plain columns, more of them by a function over their array.
SLOTS = 8


def cell_contacts(rows: DataFrame, frame: str, cutoff: float, box: str = "box", periodic: tuple[bool, bool, bool] = (True, True, False)) -> DataFrame:
    """Pairs of atoms (a < b) of a frame nearer than ``cutoff``, at the distance of their nearest images, in cells of any shape
    that may differ from frame to frame (``box``: three rows of a cell). Atoms are binned by scaled coordinates in bins at
    least ``cutoff`` wide between the cell's planes, and each is compared with the others that have an image in its bin or a
    neighbouring one. All images of an atom that are near to a bin go there in one row, so that each pair is made once, at its
    distance, and pairs are neither gathered nor exchanged: what is exchanged grows with the atoms. (Only where a frame names an
    atom twice are they gathered: it counts where it is nearest.) A cell without volume has no contacts."""
    at = lambda c, i: F.element_at(c, i + 1)
    cells = _once(_once(rows, "__cell", F.col(box)), "__inverse", F.array(*inverse3("__cell")))
    inverse = [at("__inverse", i) for i in range(9)]
    # a plane distance is one over the length of the inverse's column
    across = [F.lit(1.0) / F.sqrt(sum((inverse[3 * r + k] * inverse[3 * r + k] for r in range(3)), F.lit(0.0))) for k in range(3)]
    placed = _once(cells, "__p", F.array(*scaled([F.col(x) for x in "xyz"], inverse), *across)).where(at("__p", 3).isNotNull())
    inside = lambda k: wrapped(at("__p", k)) if periodic[k] else at("__p", k)
    home = placed.select(frame, "atom", *[inside(k).alias(f"__s{k}") for k in range(3)], *[at("__p", 3 + k).alias(f"__d{k}") for k in range(3)], *[at("__cell", k).alias(f"__b{k}") for k in range(9)])
    # images of an atom near to a bin: places at distances of 1 in a piece of an edge, by a margin for rounding
    most = [F.floor(F.least(F.lit(3 * cutoff) / F.col(f"__d{k}"), 1 + F.lit(2 * cutoff) / F.col(f"__d{k}")) + 1e-6) + 1 if p else F.lit(1) for k, p in enumerate(periodic)]
    known = home.groupBy(frame, "atom").agg(F.count("*").alias("times"), F.max(most[0] * most[1] * most[2]).alias("images")).agg(F.max("times").alias("times"), F.max("images").alias("images")).first()
    xyz = lambda s: [sum((s[r] * F.col(f"__b{3 * r + k}") for r in range(3)), F.lit(0.0)) for k in range(3)]
    near = home.select(frame, *[F.floor(F.col(f"__s{k}") * F.col(f"__d{k}") / cutoff).cast("long").alias(f"__c{k}") for k in range(3)], "atom", *[c.alias(f"__{x}") for x, c in zip("xyz", xyz([F.col(f"__s{k}") for k in range(3)]), strict=True)])
    images = home
    for k, p in enumerate(periodic):
        images = _neighbours(images, k, cutoff, p)
    flat = F.flatten(F.transform("__v0", lambda u: F.flatten(F.transform("__v1", lambda v: F.flatten(F.transform("__v2", lambda w: F.array(*xyz([u, v, w]))))))))
    other = _once(images, "__i", flat).select(frame, *[f"__c{k}" for k in range(3)], F.col("atom").alias("__other"), *[at("__i", k).alias(f"__i{k}") for k in range(3)], F.when(F.size("__i") > 3, F.slice("__i", F.lit(4), F.size("__i"))).alias("__more"))
    square = lambda p: sum(((F.col(f"__{x}") - p[k]) * (F.col(f"__{x}") - p[k]) for k, x in enumerate("xyz")), F.lit(0.0))
    squares, images_of = [square([F.col(f"__i{k}") for k in range(3)])], known.images or 1
    if images_of <= SLOTS:
        squares += [square([F.get("__more", F.lit(3 * j + k)) for k in range(3)]) for j in range(images_of - 1)]
    else:
        squares.append(F.when(F.col("__more").isNotNull(), F.array_min(F.transform(F.sequence(F.lit(0), F.size("__more") - 3, F.lit(3)), lambda j: square([F.get("__more", j + k) for k in range(3)])))))
    distance = F.sqrt(F.least(*squares) if len(squares) > 1 else squares[0])
    # the side of fewer rows for each bin comes second: it is the one that a task holds
    pairs = other.join(near, [frame, *[f"__c{k}" for k in range(3)]]).where((F.col("atom") < F.col("__other")) & (distance < cutoff))
    out = pairs.select(frame, F.col("atom").alias("atom_a"), F.col("__other").alias("atom_b"), distance.alias("distance"))
    return out.groupBy(frame, "atom_a", "atom_b").agg(F.min("distance").alias("distance")) if (known.times or 1) > 1 else out
