"""Row numbers within groups of any size, and what builds on them: frame indices, first N, samples, batches, splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from atomframe.functions.expressions import split_size
from atomframe.session import checkpointed


def numbered_within(df: DataFrame, by: list[str], order: list[str], name: str = "index") -> DataFrame:
    """Adds the 0-based place of each row within its group. Rows are dealt out by range, so that a group, however large,
    is numbered in many tasks: a place within the task plus the counts of the tasks before it."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = checkpointed(df.repartitionByRange(n, *by, *order).withColumn("__part", F.spark_partition_id()))
    local = placed.withColumn("__local", F.row_number().over(Window.partitionBy("__part", *by).orderBy(*order)))
    counts = placed.groupBy("__part", *by).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*by).orderBy("__part")) - F.col("__n")
    starts = counts.select(F.col("__part").alias("__p"), *[F.col(c).alias(f"__{c}") for c in by], before.alias("__before"))
    same = reduce(lambda a, b: a & b, [local[c].eqNullSafe(starts[f"__{c}"]) for c in by], local["__part"] == starts["__p"])
    out = local.join(starts, same).withColumn(name, (F.col("__before") + F.col("__local") - 1).cast("long"))
    return out.select(*df.columns, name)


def global_index(df: DataFrame, order: list[str], name: str = "frame_index") -> DataFrame:
    """Adds a contiguous index over the whole table in the given order, without one task that sees all rows."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = checkpointed(df.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()))
    local = placed.withColumn("__local", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    rows, at = [], 0
    for r in placed.groupBy("__part").agg(F.count("*").alias("n")).orderBy("__part").collect():  # one row for each partition
        rows.append((r[0], at))
        at += r.n
    starts = df.sparkSession.createDataFrame(rows, "__part int, __before long")
    out = local.join(F.broadcast(starts), "__part").withColumn(name, F.col("__before") + F.col("__local") - 1)
    return out.select(*df.columns, name)


def running_total(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` (null: 0) over the rows before, in the given order of the whole table, without one task
    that sees all rows."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = checkpointed(df.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()))
    own = F.coalesce(value, F.lit(0))
    before = F.sum(own).over(Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    rows, at = [], 0
    for r in dealt.groupBy("__part").agg(F.sum(own).alias("n")).orderBy("__part").collect():  # one row for each partition
        rows.append((r[0], at))
        at += r.n
    starts = df.sparkSession.createDataFrame(rows, "__part int, __before long")
    out = dealt.withColumn("__own", F.coalesce(before, F.lit(0))).join(F.broadcast(starts), "__part")
    return out.select(*df.columns, (F.col("__before") + F.col("__own")).cast("long").alias(name))


def first_per_group(df: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of each group. Each task keeps its own first n (a limit within the group) before they meet."""
    salted = df.withColumn("__salt", F.spark_partition_id())
    few = salted.withColumn("__r", F.row_number().over(Window.partitionBy("__salt", *by).orderBy(*order))).where(F.col("__r") <= n)
    best = few.drop("__r", "__salt").withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return best.where(F.col("__r") <= n).drop("__r")


def with_group_size(df: DataFrame, by: list[str], name: str = "__n") -> DataFrame:
    """Adds the number of rows of each group; a null key is a group too."""
    sizes = df.groupBy(*[F.col(c).alias(f"__{c}") for c in by]).agg(F.count("*").alias(name))
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(sizes[f"__{c}"]) for c in by])
    return df.join(sizes, same).select(*df.columns, name)


def even_sample(df: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    """k rows of each group at even distances, the first and the last among them; all rows of smaller groups."""
    placed = with_group_size(numbered_within(df, by, order, "__i"), by)
    n, i = F.col("__n"), F.col("__i")
    # i is chosen if some j in 0..k-1 has j * (n - 1) div (k - 1) = i
    j = F.ceil(i * (k - 1) / F.greatest(n - 1, F.lit(1))) if k > 1 else F.lit(0)
    chosen = (i == 0) if k == 1 else (j < k) & (F.floor(j * (n - 1) / (k - 1)) == i)
    return placed.where((n <= k) | chosen).select(*df.columns)


def train_test_split(df: DataFrame, group: list[str], frame: str, ratio: float = 0.1, seed: int = 0) -> DataFrame:
    """Adds ``role``: test for the rows of least md5(seed, group, frame) of each group, train for the others."""
    key = F.md5(F.concat_ws("/", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in group], F.col(frame).cast("string")))
    placed = with_group_size(numbered_within(df.withColumn("__key", key), group, ["__key", frame], "__i"), group)
    role = F.when(F.col("__i") < split_size(F.col("__n"), ratio), "test").otherwise("train")
    return placed.withColumn("role", role).select(*df.columns, "role")


def split_summary(split: DataFrame, dataset: str, *extra: str) -> DataFrame:
    """Total, train and test rows of each dataset and of all (dataset null)."""
    sets = split.rollup(dataset)
    return sets.agg(F.grouping(dataset).cast("int").alias("is_total"), F.count("*").alias("frames_total"), F.count_if(F.col("role") == "train").alias("frames_train"), F.count_if(F.col("role") == "test").alias("frames_test"))


def atom_batches(df: DataFrame, system: str, order: list[str], natoms: str, budget: int = 20_000, cap: int | None = None) -> DataFrame:
    """Adds ``batch_frames`` and ``batch_id``: batches of a system of at most ``budget`` atoms, one frame at least."""
    size: Column = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col(natoms), F.lit(1)))).cast("long")
    size = F.least(size, F.lit(cap)) if cap else size
    placed = numbered_within(df, [system], order, "__i").withColumn("batch_frames", size)
    return placed.withColumn("batch_id", F.floor(F.col("__i") / F.col("batch_frames")).cast("long")).drop("__i")
