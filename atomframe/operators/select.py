"""Choosing frames: strides, exclusions with reasons, overlays of records, new candidates, unions and funnels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from atomframe.functions.expressions import natural_key, trailing_number
from atomframe.operators.index import first_per_group, global_index, numbered_within, with_group_size


def stride_selected(index: Column, stride: int, start: int = 0) -> Column:
    """0-based indices start, start + stride ..."""
    return (index >= start) & (F.pmod(index - start, F.lit(stride)) == 0)


def select_frames(df: DataFrame, source: str, index: str, stride: int = 1, start: int = 0, most: int | None = None) -> DataFrame:
    """Frames of each source by start and stride, at most ``most`` of a source; a source's only frame 0 is always chosen."""
    sized = with_group_size(df, [source])
    chosen = sized.where(stride_selected(F.col(index), stride, start) | ((F.col("__n") == 1) & (F.col(index) == 0))).drop("__n")
    return first_per_group(chosen, [source], [index], most) if most else chosen


def stride_by_name(df: DataFrame, frame: str, stride: int, zero_based: str | None = None) -> DataFrame:
    """Frames whose 1-based number (at the end of the name, else from a 0-based column) is 1, 1 + stride ..."""
    number = F.coalesce(trailing_number(frame), F.col(zero_based).cast("long") + 1) if zero_based else trailing_number(frame)
    return df.where((number - 1) % stride == 0)


def natural_top(df: DataFrame, system: str, frame: str, n: int) -> DataFrame:
    """The first n rows in natural order (a top-k, no total sort)."""
    return df.orderBy(*natural_key(system, frame)).limit(n)


def excluded(df: DataFrame, selected: DataFrame, key: str, path: str) -> DataFrame:
    """Adds ``reason`` where a row's key or path is already selected, the key first; null rows stay candidates."""
    keys = selected.select(F.col(key).alias("__key")).where("__key is not null and __key <> ''").distinct().withColumn("__by_key", F.lit(True))
    paths = selected.select(F.col(path).alias("__path")).where("__path is not null and __path <> ''").distinct().withColumn("__by_path", F.lit(True))
    joined = df.join(keys, F.col(key) == F.col("__key"), "left").join(paths, F.col(path) == F.col("__path"), "left")
    reason = F.when(F.col("__by_key"), f"matched_{key}").when(F.col("__by_path"), f"matched_{path}")
    return joined.withColumn("reason", reason).drop("__key", "__path", "__by_key", "__by_path")


def funnel(df: DataFrame, campaign_reason: str, list_reason: str, most: int | None = None) -> DataFrame:
    """Discovered rows, those left after the campaign's and then the list's exclusions, and those selected; one pass."""
    after = F.col(campaign_reason).isNull()
    both = after & F.col(list_reason).isNull()
    left = F.count_if(both)
    return df.agg(F.count("*").alias("discovered"), F.count_if(after).alias("after_campaign"), left.alias("after_list"), (F.least(left, F.lit(most)) if most is not None else left).alias("selected"))


def overlay(runs: DataFrame, pool: DataFrame, keys: list[str], path: str, status: str) -> DataFrame:
    """Run records joined with pool records: the pool's path wins, pool-only rows are planned."""
    other = pool.select(*keys, F.col(path).alias("__pool_path"))
    return runs.join(other, keys, "full").select(*keys, F.coalesce("__pool_path", path).alias(path), F.coalesce(status, F.lit("planned")).alias(status))


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row of each key: the last in the given order. Rows meet as one partial maximum for each task."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return best.select(*keys, *[F.col("__r")[c].alias(c) for c in rest])


def new_candidates(manifest: DataFrame, live: DataFrame, campaign: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates of the manifest, overridden by live records of the same key, without those of the campaign."""
    both = manifest.withColumn("__order", F.lit(0)).unionByName(live.withColumn("__order", F.lit(1)))
    return last_wins(both, keys, ["__order"]).drop("__order").join(campaign.select(*keys).distinct(), keys, "left_anti")


def union_distinct(*tables: DataFrame, on: list[str]) -> DataFrame:
    """All tables under each other, one row for each key: that of the first table that has it."""
    every = [t.withColumn("__order", F.lit(-i)) for i, t in enumerate(tables)]
    out = every[0]
    for t in every[1:]:
        out = out.unionByName(t)
    return last_wins(out, on, ["__order"]).drop("__order")


def exclusion_keys(manifests: DataFrame | None, listed: DataFrame | None, statuses: list[str] | None = None) -> DataFrame:
    """Distinct (kind, key) of everything to be left out: entries of manifests (system, frame, status,
    source_structure_path) with one of the statuses (a blank one always counts), and keys of lists (kind, key)."""
    out = listed.where("kind in ('task_key', 'path') and key is not null").select("kind", "key") if listed is not None else None
    if manifests is not None:
        blank = F.coalesce(F.trim("status"), F.lit("")) == ""
        own = manifests.where(blank | F.col("status").isin(*statuses)) if statuses else manifests
        both = F.array(F.struct(F.lit("task_key").alias("kind"), F.concat_ws("/", "system", "frame").alias("key")), F.struct(F.lit("path").alias("kind"), F.col("source_structure_path").alias("key")))
        own = own.where("system is not null and frame is not null").select(F.explode(both).alias("k")).select("k.*").where("key is not null and key <> ''")
        out = own if out is None else out.unionByName(own)
    return out.distinct()


def capped_examples(df: DataFrame, by: list[str], order: list[str], example: str, k: int) -> DataFrame:
    """The first k examples of each group as one list."""
    return first_per_group(df, by, order, k).groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(*order, F.col(example).alias("__e")))).alias("__l")).select(*by, F.col("__l.__e").alias("examples"))


def member_names(df: DataFrame, group: str, order: list[str], prefix: str = "task_") -> DataFrame:
    """Adds ``member`` (prefix and a three-digit number within the group, from 1)."""
    placed = numbered_within(df, [group], order, "__i")
    return placed.withColumn("member", F.concat(F.lit(prefix), F.lpad((F.col("__i") + 1).cast("string"), 3, "0"))).drop("__i")


def dense_numbers(groups: DataFrame, order: list[str], name: str = "group_number") -> DataFrame:
    """Adds 1-based numbers to a table of groups (one row for each group), in the given order."""
    placed = global_index(groups, order, "__i")
    return placed.withColumn(name, (F.col("__i") + 1).cast("int")).drop("__i")
