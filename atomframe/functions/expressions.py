"""Column expressions shared by the operators; all of them stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

#: Sort place of names that do not follow the system/frame pattern.
LAST = 10**12


def first_text(*columns: str | Column) -> Column:
    """The first value that is neither null nor blank, trimmed."""
    return F.coalesce(*[F.nullif(F.trim(c if isinstance(c, Column) else F.col(c)), F.lit("")) for c in columns])


def not_finite(x: Column) -> Column:
    return F.isnan(x) | (F.abs(x) == F.lit(float("inf")))


def count_not_finite(array: str) -> Column:
    """Elements that are NaN or infinite; 0 for a null array."""
    return F.when(F.col(array).isNull(), F.lit(0)).otherwise(F.size(F.filter(array, not_finite))).cast("long")


def trailing_number(name: str | Column) -> Column:
    """The number at the end of a name, or null."""
    return F.nullif(F.regexp_extract(name, "([0-9]+)$", 1), F.lit("")).cast("long")


def natural_key(system: str, frame: str) -> list[Column]:
    """Order by system number, frame number and name; names without numbers come last."""
    return [F.coalesce(trailing_number(system), F.lit(LAST)), F.coalesce(trailing_number(frame), F.lit(LAST)), F.col(system), F.col(frame)]


def slug(name: str) -> Column:
    """Lower case, runs of other characters as one underscore, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), F.lit("_"))


def formula(elements: str, counts: str) -> Column:
    """Element names with their counts; a count of one is not written."""
    return F.array_join(F.zip_with(elements, counts, lambda e, n: F.concat(e, F.when(n == 1, F.lit("")).otherwise(n.cast("string")))), "")


def job_name(job: str, system: str, number: str) -> Column:
    """A short job name: s2, four hex digits for the job family, the system's number and the frame's in six digits."""
    family = F.substr(F.md5(F.coalesce(F.col(job), F.lit("stage2"))), F.lit(1), F.lit(4))
    own = F.regexp_extract(F.col(system), "^system_([0-9]+)", 1)
    return F.concat(F.lit("s2"), family, F.lit("_"), F.when(own != "", own).otherwise("0000"), F.lit("_"), F.format_string("%06d", F.col(number)))


def composition_name(elements: str, natoms: str) -> Column:
    """The name of a composition, as comp_h_o_n3."""
    both = F.concat_ws("_", F.lit("comp"), F.array_join(elements, "_"), F.concat(F.lit("n"), F.col(natoms)))
    return F.trim(F.regexp_replace(F.lower(both), "[^a-z0-9]+", "_"), F.lit("_"))


def task_key(path: str, task_name: str | None = None) -> Column:
    """system/frame of a path (or of an explicit task name first); empty if there is none."""
    both = r"(system_[^/_]+)(?:/|__)(frame_[0-9]+)"
    sources = [F.col(c) for c in (task_name, path) if c]
    found = [F.when(F.regexp_extract(s, both, 1) != "", F.concat_ws("/", F.regexp_extract(s, both, 1), F.regexp_extract(s, both, 2))) for s in sources]
    return F.coalesce(*found, F.lit(""))


def task_key_below(path: str, root: str) -> Column:
    """The first two components of a path below ``root``; empty if it is not below, or has fewer."""
    top = root.rstrip("/")
    below = F.split(F.substr(F.rtrim(F.col(path), F.lit("/")), F.lit(len(top) + 2)), "/")
    whole = (F.size(below) >= 2) & (below[0] != "") & (F.get(below, F.lit(1)) != "")
    inside = F.col(path).startswith(top + "/") & F.lit(bool(top))
    return F.when(F.coalesce(inside & whole, F.lit(False)), F.concat_ws("/", below[0], F.get(below, F.lit(1)))).otherwise("")


def remapped(types: str, names: str, target: Column) -> Column:
    """Type indices into ``names`` as indices into ``target``; null where a name is missing from it."""
    return F.transform(types, lambda t: F.nullif(F.array_position(target, F.element_at(names, t + 1)), F.lit(0)) - 1)


def missing_names(names: str, target: Column) -> Column:
    return F.array_except(names, target)


def element_counts(types: str, names: str) -> Column:
    """(element, count) of the elements that occur, in the order of ``names``."""
    every = F.transform(names, lambda e, i: F.struct(e.alias("element"), F.size(F.filter(types, lambda t: t == i)).alias("n")))
    return F.filter(every, lambda x: x.n > 0)


def element_order(elements: str, canonical: list[str]) -> Column:
    """Known elements in canonical order, then the others by name."""
    order = F.array(*[F.lit(e) for e in canonical])
    rank = lambda e: F.when(F.array_contains(order, e), F.array_position(order, e)).otherwise(F.lit(LAST))
    return F.transform(F.array_sort(F.transform(elements, lambda e: F.struct(rank(e).alias("r"), e.alias("e")))), lambda x: x.e)


def _at(array: str, i: int) -> Column:
    return F.element_at(array, i + 1)


def inverse3(box: str) -> list[Column]:
    """The nine elements of the inverse of a row-major 3x3 array."""
    a = [_at(box, i) for i in range(9)]
    cof = [
        a[4] * a[8] - a[5] * a[7], a[2] * a[7] - a[1] * a[8], a[1] * a[5] - a[2] * a[4],
        a[5] * a[6] - a[3] * a[8], a[0] * a[8] - a[2] * a[6], a[2] * a[3] - a[0] * a[5],
        a[3] * a[7] - a[4] * a[6], a[1] * a[6] - a[0] * a[7], a[0] * a[4] - a[1] * a[3],
    ]
    det = a[0] * cof[0] + a[1] * cof[3] + a[2] * cof[6]
    return [c / F.nullif(det, F.lit(0.0)) for c in cof]


def scaled(position: list[Column], inverse: list[Column]) -> list[Column]:
    """A position in units of the cell."""
    return [position[0] * inverse[k] + position[1] * inverse[3 + k] + position[2] * inverse[6 + k] for k in range(3)]


def wrapped(s: Column) -> Column:
    """A scaled coordinate brought into [0, 1)."""
    return s - F.floor(s)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def split_size(n: Column, ratio: float) -> Column:
    """Test members of n: none of one, else the half-even rounded share, at least one and at most n - 1."""
    return F.when(n <= 1, F.lit(0)).otherwise(F.least(F.greatest(F.bround(n * F.lit(ratio), 0).cast("long"), F.lit(1)), n - 1))
