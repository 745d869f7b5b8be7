"""Batch inference with a pluggable model."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: A factory gives the model's type names and eval(coords (n, 3 * natoms), boxes (n, 9), types (natoms)) -> energy, force, virial.
Factory = Callable[[], tuple[list[str], Callable]]
OUT = "energy_pred double, force_pred array<double>, virial_pred array<double>, skipped string"


def finite(what: str, *arrays: np.ndarray | None) -> None:
    if not all(np.isfinite(np.asarray(a, dtype=float)).all() for a in arrays if a is not None):
        raise ValueError(f"{what} contains NaN/Inf")


def predict(frames: DataFrame, factory: Factory, keys: list[str], atoms_per_batch: int = 20_000) -> DataFrame:
    """Predictions for frames (keys, natoms, types, type_map, coord, box). The model is built once for each task; frames of
    one composition are evaluated together, in the model's order of types; a batch that fails is reported as skipped."""
    columns = [*keys, "natoms", "types", "type_map", "coord", "box"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frames.select(*keys).schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, evaluate = factory()
        place = {n: i for i, n in enumerate(names)}
        for pdf in batches:
            for (_, _), group in pdf.groupby([pdf["types"].map(tuple), pdf["type_map"].map(tuple)], sort=False):
                natoms = int(group["natoms"].iloc[0])
                size = max(1, atoms_per_batch // max(natoms, 1))
                for a in range(0, len(group), size):
                    part = group.iloc[a : a + size]
                    out = part[keys].reset_index(drop=True)
                    try:
                        types = np.array([place[part["type_map"].iloc[0][t]] for t in part["types"].iloc[0]])
                        coord, box = np.stack(part["coord"].to_list()), np.stack(part["box"].to_list())
                        finite("input", coord, box)
                        energy, force, virial = evaluate(coord, box, types)
                        finite("prediction", energy, force, virial)
                        out["energy_pred"] = np.asarray(energy, dtype=float).ravel()
                        out["force_pred"] = list(np.asarray(force, dtype=float).reshape(len(part), -1))
                        out["virial_pred"] = list(np.asarray(virial, dtype=float).reshape(len(part), -1)) if virial is not None else None
                        out["skipped"] = None
                    except Exception as e:  # noqa: BLE001  a model may fail in any way; the frames are reported
                        out["energy_pred"], out["force_pred"], out["virial_pred"] = np.nan, None, None
                        out["skipped"] = f"{type(e).__name__}: {e}"
                    yield out

    n = int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = frames.select(*columns).repartition(n, F.hash("types", "type_map"), F.pmod(F.xxhash64(*keys), F.lit(64)))
    return spread.mapInPandas(run, f"{kinds}, {OUT}")


SUMS = [f"{part}_{kind}" for part in ("energy", "energy_atom", "force", "virial") for kind in ("abs", "sq", "n")]


def error_sums(frames: DataFrame, factory: Factory, by: list[str], atoms_per_batch: int = 20_000, frames_per_batch: int = 0) -> DataFrame:
    """One row for each task and group (``by``, which names a system) with the sums and counts of a model's errors, so that
    arrays never leave their batch: ``by``, frames, batches, seconds (in the model), the columns of SUMS, and ``error``: what
    was wrong with a batch, if anything was. Needs natoms, types, type_map, coord, box, energy, force, and may have virial
    and error (of frames that could not be read). Frames stay in the tasks that have read them."""
    has = {c: c in frames.columns for c in ("virial", "error")}
    columns = [*by, "natoms", "types", "type_map", "coord", "box", "energy", "force", *[c for c, there in has.items() if there]]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frames.select(*by).schema)
    sums = ", ".join(f"{c} {'long' if c.endswith('_n') else 'double'}" for c in SUMS)

    def errors(d: np.ndarray) -> list:
        return [float(np.abs(d).sum()), float((d * d).sum()), d.size]

    def one(part: pd.DataFrame, place: dict, evaluate: Callable) -> tuple[float, list]:
        """Seconds and SUMS of frames of one composition."""
        names, types = part["type_map"].iloc[0], part["types"].iloc[0]
        if missing := sorted({names[t] for t in types} - set(place)):
            raise ValueError(f"elements missing from the model: {missing}")
        coord, box, force = (np.stack(part[c].to_list()) for c in ("coord", "box", "force"))
        energy, natoms = part["energy"].to_numpy(dtype=float), len(types)
        known = part["virial"].notna() if has["virial"] else np.zeros(len(part), bool)
        virial = np.stack(part["virial"][known].to_list()) if known.any() else None
        finite("input", coord, box, energy, force)
        finite("virial", virial)
        began = time.perf_counter()
        e, f, v = evaluate(coord, box, np.array([place[names[t]] for t in types]))
        seconds = time.perf_counter() - began
        finite("prediction", e, f, v)
        d = np.asarray(e, dtype=float).reshape(len(part)) - energy
        out = errors(d) + errors(d / natoms) + errors(np.asarray(f, dtype=float).reshape(force.shape) - force)
        return seconds, out + (errors(np.asarray(v, dtype=float).reshape(len(part), 9)[np.asarray(known)] - virial) if virial is not None and v is not None else [0.0, 0.0, 0])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, evaluate = factory()
        place = {n: i for i, n in enumerate(names)}
        found: dict[tuple, list] = {}
        for pdf in batches:
            for key, own in pdf.groupby([pdf[c] for c in by], sort=False, dropna=False):
                row = found.setdefault(key, [0, 0, 0.0, *[0] * len(SUMS), None])
                if has["error"] and own["error"].notna().any():
                    row[-1] = row[-1] or str(own["error"].dropna().iloc[0])
                    own = own[own["error"].isna()]
                for (types, _), group in own.groupby([own["types"].map(tuple), own["type_map"].map(tuple)], sort=False):
                    size = max(1, atoms_per_batch // max(len(types), 1))
                    size = min(size, frames_per_batch) if frames_per_batch else size
                    for a in range(0, len(group), size):
                        part = group.iloc[a : a + size]
                        try:
                            seconds, added = one(part, place, evaluate)
                        except Exception as e:  # noqa: BLE001  a model may fail in any way; the system is reported
                            row[-1] = row[-1] or f"{type(e).__name__}: {e}"
                            continue
                        row[:3] = row[0] + len(part), row[1] + 1, row[2] + seconds
                        row[3:-1] = [x + y for x, y in zip(row[3:-1], added, strict=True)]
        rows = [(*k, *v) for k, v in found.items()]
        yield pd.DataFrame(rows, columns=[*by, "frames", "batches", "seconds", *SUMS, "error"])

    return frames.select(*columns).mapInPandas(run, f"{kinds}, frames long, batches long, seconds double, {sums}, error string")
