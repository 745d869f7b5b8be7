"""Converted datasets on disk: what their summaries declare and what their files hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from atomframe.operators.dataset import ARRAYS
from atomframe.sources import discovery
from atomframe.sources.records import whole_texts

GROUP = "group_name string, output_dir string, elements array<string>, counts array<int>, frames long, frames_selected long, frames_converted long, frames_skipped long"
SUMMARY = f"{GROUP}, `groups` array<struct<{GROUP.replace(' ', ':').replace(',:', ',')}>>, group_count long"


def _name(path: str) -> Column:
    return F.regexp_extract(path, "([^/]*)/*$", 1)


def _summaries(spark: SparkSession, root: str) -> DataFrame:
    """folder and s (the parsed summary) of each convert_summary.json below ``root``."""
    texts = whole_texts(spark, root, "convert_summary.json")
    return texts.select(F.regexp_extract(F.regexp_replace("file", "^file:/+", "/"), "^(.*)/[^/]*$", 1).alias("folder"), F.from_json("text", SUMMARY).alias("s"))


def has_summary(spark: SparkSession, root: str) -> bool:
    return not _summaries(spark, root.rstrip("/")).isEmpty()


def read_dataset(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``groups``, ``arrays`` and ``totals`` as ``validate_dataset`` wants them. The groups are those that the root's summary
    lists or, where it lists none, those that have a summary of their own; a single group lies in the root itself."""
    top = root.rstrip("/")
    found = _summaries(spark, top)
    mine = F.col("folder") == top
    listed = found.where(mine & (F.size("s.groups") > 0)).select(F.explode("s.groups").alias("g"), (F.size("s.groups") > 1).alias("several"))
    listed = listed.select("g", F.when(F.col("several"), F.concat(F.lit(f"{top}/"), _name("g.output_dir"))).otherwise(top).alias("folder"))
    own = found.where(F.coalesce(F.size("s.groups"), F.lit(0)) < 1).where(F.col("s.elements").isNotNull()).select(F.struct(*[F.col(f"s.{x.split()[0]}") for x in GROUP.split(", ")]).alias("g"), "folder")
    rows = own if listed.isEmpty() else listed
    name = F.coalesce("g.group_name", F.nullif(_name("g.output_dir"), F.lit("")), _name("folder"))
    converted = F.coalesce("g.frames_converted", "g.frames", F.lit(0))
    groups = rows.select(name.alias("group_name"), "folder", "g.elements", "g.counts", converted.alias("converted"), F.coalesce("g.frames_selected", converted).alias("selected"), F.coalesce("g.frames_skipped", F.lit(0)).alias("skipped"))
    headers = discovery.index_folders(groups.select(F.lit("").alias("root"), "folder"))
    held = headers.groupBy(F.col("system_path").alias("folder")).agg(F.when(F.max("error").isNull(), F.sum("frames")).alias("npy"), F.first("elements", True).alias("__e"), F.first("counts", True).alias("__c"), F.bool_and("virial").alias("virial"))
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.raw").text(top)
    path = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/")
    raw = text.where(F.trim("value") != "").groupBy(F.regexp_extract(path, "^(.*)/[^/]*$", 1).alias("folder"), F.regexp_extract(path, r"([^/]*)\.raw$", 1).alias("array")).agg(F.count("*").alias("raw_rows"))
    every = groups.select("group_name", "folder", F.explode(F.array(*[F.lit(a) for a in ARRAYS])).alias("array")).join(held, "folder", "left").join(raw, ["folder", "array"], "left")
    npy = F.when((F.col("array") != "virial") | F.col("virial"), F.col("npy"))
    arrays = every.select("group_name", "array", "raw_rows", npy.alias("npy_rows"))
    # the atoms of each type, as the types of a group with those counts
    types = F.flatten(F.transform("__c", lambda n, i: F.array_repeat(i, n)))
    checked = groups.join(held.select("folder", types.alias("types")), "folder", "left").drop("folder")
    totals = found.where(mine & (F.size("s.groups") > 0)).select("s.group_count", F.col("s.frames_converted"))
    return checked, arrays, totals if not totals.isEmpty() else spark.createDataFrame([(None, None)], "group_count long, frames_converted long")
