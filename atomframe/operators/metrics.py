"""Prediction errors as mergeable sums, reports by level, worst systems and parity data."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

MEV = 1000.0
PARTS = ("energy", "energy_atom", "force", "virial")


def frame_sums(df: DataFrame) -> DataFrame:
    """Adds each frame's error sums: ``<part>_abs``, ``<part>_sq``, ``<part>_n``. Needs natoms, energy_true, energy_pred;
    force_* and virial_* arrays are optional, and a null one counts as nothing."""
    error = F.col("energy_pred") - F.col("energy_true")
    out = df.withColumns({"energy_abs": F.abs(error), "energy_sq": error * error, "energy_n": F.when(error.isNotNull(), 1).otherwise(0)})
    atom = error / F.col("natoms")
    out = out.withColumns({"energy_atom_abs": F.abs(atom), "energy_atom_sq": atom * atom, "energy_atom_n": F.col("energy_n")})
    for part in ("force", "virial"):
        if f"{part}_pred" in df.columns:
            d = F.zip_with(f"{part}_pred", f"{part}_true", lambda a, b: a - b)
            add = lambda f: F.aggregate(d, F.lit(0.0), f)  # noqa: E731, B023
            out = out.withColumns({f"{part}_abs": add(lambda s, x: s + F.abs(x)), f"{part}_sq": add(lambda s, x: s + x * x), f"{part}_n": F.coalesce(F.when(d.isNotNull(), F.size(d)), F.lit(0))})
        else:
            out = out.withColumns({f"{part}_abs": F.lit(0.0), f"{part}_sq": F.lit(0.0), f"{part}_n": F.lit(0)})
    return out


def _rates(part: str, scale: float) -> tuple[Column, Column]:
    n = F.nullif(F.sum(f"{part}_n"), F.lit(0))
    return F.sum(f"{part}_abs") / n * scale, F.sqrt(F.sum(f"{part}_sq") / n) * scale


def metric_columns(virial: bool = False) -> list[Column]:
    """MAE and RMSE from merged sums and counts, never from averaged rates."""
    out = []
    for part, name, scale in (("energy", "eV", 1.0), ("energy_atom", "meV_per_atom", MEV), ("force", "eV_per_A", 1.0), ("force", "meV_per_A", MEV), *([("virial", "eV", 1.0)] if virial else [])):
        mae, rmse = _rates(part, scale)
        stem = part.replace("_atom", "")
        out += [mae.alias(f"{stem}_mae_{name}"), rmse.alias(f"{stem}_rmse_{name}")]
    return out


def error_metrics(df: DataFrame, *by: str, virial: bool = False) -> DataFrame:
    return frame_sums(df).groupBy(*by).agg(F.count("*").alias("frames"), *metric_columns(virial))


def _by_level(named: DataFrame, family: str, system: str, *figures: Column) -> DataFrame:
    """``figures`` of every system, family and the whole in one pass; blank families are ``unlabeled``. The whole has a row even
    where there is nothing: an empty row goes along, which grouping sets need for it, and its own groups go."""
    rows = named.withColumns({family: F.coalesce(F.nullif(F.trim(F.col(family)), F.lit("")), F.lit("unlabeled")), "__real": F.lit(1)})
    none = named.sparkSession.range(1).select(F.lit(None).cast("int").alias("__real"))
    sets = rows.unionByName(none, allowMissingColumns=True).groupingSets([[F.col(family), F.col(system)], [F.col(family)], []], F.col(family), F.col(system))
    level = F.when(F.grouping(system) == 0, "system").when(F.grouping(family) == 0, "family").otherwise("overall")
    return sets.agg(level.alias("level"), F.count("__real").alias("__n"), *figures).where("__n > 0 or level = 'overall'").drop("__n")


def metrics_by_level(df: DataFrame, family: str = "family", system: str = "system", virial: bool = False) -> DataFrame:
    """One pass over the frames for every system, family and the whole; blank families are ``unlabeled``."""
    return _by_level(frame_sums(df), family, system, F.count("__real").alias("frames"), *metric_columns(virial))


def levels_of_sums(sums: DataFrame, family: str, system: str, virial: bool = False) -> DataFrame:
    """``metrics_by_level`` of rows that hold sums already (as ``frame_sums`` names them, with ``frames``)."""
    frames = F.coalesce(F.sum("frames"), F.lit(0)).alias("frames")
    return _by_level(sums, family, system, F.count_distinct(system).alias("systems"), frames, F.sum("force_n").alias("force_components"), F.sum("virial_n").alias("virial_components"), *metric_columns(virial))


def worst_flags(df: DataFrame, index: str, *metrics: str) -> DataFrame:
    """Adds ``is_worst_<metric>``: the first row, by ``index``, with the largest value. Only two aggregates are gathered."""
    best = df.agg(*[F.max_by(index, F.struct(F.coalesce(m, F.lit(-math.inf)), -F.col(index))).alias(f"__{m}") for m in metrics])
    out = df.crossJoin(F.broadcast(best))  # one row
    return out.withColumns({f"is_worst_{m}": F.col(index) == F.col(f"__{m}") for m in metrics}).drop(*[f"__{m}" for m in metrics])


def evaluation_status(systems: DataFrame, continue_on_error: bool = False) -> DataFrame:
    """One row: systems, errors and FAIL, PARTIAL or PASS from a table with an ``error`` column. Where no system is good, or
    there is none, it is FAIL."""
    bad = F.count_if(F.col("error").isNotNull())
    status = F.when(F.count_if(F.col("error").isNull()) == 0, "FAIL").when(bad == 0, "PASS").when(F.lit(continue_on_error), "PARTIAL").otherwise("FAIL")
    return systems.agg(F.count("*").alias("systems"), bad.alias("errors"), status.alias("status"))


def parity_summary(df: DataFrame, true: str, pred: str, *by: str) -> DataFrame:
    """Points, MAE and RMSE over all points."""
    d = F.col(pred) - F.col(true)
    return df.groupBy(*by).agg(F.count(d).alias("points"), F.avg(F.abs(d)).alias("mae"), F.sqrt(F.avg(d * d)).alias("rmse"))


def parity_hexbin(df: DataFrame, true: str, pred: str, grid: int = 160) -> DataFrame:
    """Hexagonal counts over all points: lattice (0 or 1), cell i, j, points and log10 of the points."""
    x, y = F.col("x"), F.col("y")
    points = df.select(F.col(true).cast("double").alias("x"), F.col(pred).cast("double").alias("y")).where(x.isNotNull() & y.isNotNull())
    box = points.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    nx, ny = grid, int(grid / math.sqrt(3))
    unit = lambda v, a, b, n: (v - F.col(a)) / F.nullif(F.col(b) - F.col(a), F.lit(0.0)) * n
    grid_xy = points.crossJoin(F.broadcast(box)).select(F.coalesce(unit(x, "x0", "x1", nx), F.lit(0.0)).alias("gx"), F.coalesce(unit(y, "y0", "y1", ny), F.lit(0.0)).alias("gy"))
    i1, j1, i2, j2 = F.bround("gx"), F.bround("gy"), F.floor("gx"), F.floor("gy")
    near = lambda i, j, half: (F.col("gx") - i - half) * (F.col("gx") - i - half) + 3 * (F.col("gy") - j - half) * (F.col("gy") - j - half)
    first = near(i1, j1, 0.0) < near(i2, j2, 0.5)
    cells = grid_xy.select(F.when(first, 0).otherwise(1).alias("lattice"), F.when(first, i1.cast("long")).otherwise(i2.cast("long")).alias("i"), F.when(first, j1.cast("long")).otherwise(j2.cast("long")).alias("j"))
    return cells.groupBy("lattice", "i", "j").agg(F.count("*").alias("points")).withColumn("log_points", F.log10("points"))


def parity_points(frames: DataFrame) -> DataFrame:
    """(panel, true, pred) of predicted frames: energy_per_atom, force_components and, where frames have one, virial_components.
    Needs natoms, energy_true, energy_pred, force_true, force_pred; virial_true and virial_pred are optional."""
    def components(part: str) -> DataFrame:
        there = frames.where(F.size(f"{part}_true") == F.size(f"{part}_pred"))
        return there.select(F.lit(f"{part}_components").alias("panel"), F.explode(F.arrays_zip(F.col(f"{part}_true").alias("true"), F.col(f"{part}_pred").alias("pred"))).alias("p")).select("panel", "p.true", "p.pred")

    energy = frames.select(F.lit("energy_per_atom").alias("panel"), (F.col("energy_true") / F.col("natoms")).alias("true"), (F.col("energy_pred") / F.col("natoms")).alias("pred"))
    out = energy.unionByName(components("force"))
    return out.unionByName(components("virial")) if {"virial_true", "virial_pred"} <= set(frames.columns) else out
