"""Tables with versions: each publication writes its data aside and then one numbered entry of a log, which is there or is
not. Of two publishers that start from the same version one gets the next number; the other's data go, and it may read
again and try once more. Nothing is renamed or overwritten, so readers of older versions are not disturbed.

The log is ``_log`` below the table, an entry a JSON file named by the version, from 0. Data of a driver that is lost
between its data and its entry stay as a folder that no entry names.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

ENTRY = "version long, based_on long, folder string, row_count long, published_at string, table_schema string"


class Conflict(RuntimeError):
    """Another publisher was first."""


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    _, log, fs = _hadoop(spark, f"{path}/_log")
    if not fs.exists(log):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(log)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def latest(spark: SparkSession, path: str) -> int | None:
    """The number of the newest version, or None where there is none."""
    return (_numbers(spark, path) or [None])[-1]


def _written_once(spark: SparkSession, path: str, text: str) -> None:
    """A new file with that text, whole or not at all; ``Conflict`` if it is there. A link on local disks; elsewhere the
    file system's own rename, which refuses to overwrite."""
    jvm, at, fs = _hadoop(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            os.link(aside.toUri().getPath(), at.toUri().getPath())
        else:
            none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(aside, at, none)
    except Exception as e:
        if fs.exists(at):
            raise Conflict(f"{path} is there") from e
        raise
    finally:
        fs.delete(aside, False)


def publish_version(df: DataFrame, path: str, validate: Callable[[DataFrame], DataFrame] | None = None, based_on: int | None = None) -> int:
    """Publishes ``df`` as the version after ``based_on`` (None: the first one) and returns its number. ``Conflict`` if that
    number is taken, ValueError if ``validate`` gives rows for the written data; its data are deleted in both cases."""
    spark, version = df.sparkSession, 0 if based_on is None else based_on + 1
    if based_on is not None and based_on not in _numbers(spark, path):
        raise ValueError(f"{path} has no version {based_on}")
    name = f"data-{uuid.uuid4().hex}"
    _, folder, fs = _hadoop(spark, f"{path}/{name}")
    try:
        df.write.mode("errorifexists").parquet(f"{path}/{name}")
        back = spark.read.schema(df.schema).parquet(f"{path}/{name}")
        if validate and (found := [r.asDict() for r in validate(back).limit(20).collect()]):
            raise ValueError(f"not published: {json.dumps(found, default=str)}")
        entry = {"version": version, "based_on": based_on, "folder": name, "row_count": back.count(), "published_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), "table_schema": df.schema.json()}
        _written_once(spark, f"{path}/_log/{version:020d}.json", json.dumps(entry))
    except Exception:
        fs.delete(folder, True)
        raise
    return version


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The log: one row for each version, none where nothing is published."""
    if not _numbers(spark, path):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).json(f"{path}/_log/*.json")


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of a version (None: the newest)."""
    wanted = latest(spark, path) if version is None else version
    entry = versions(spark, path).where(F.col("version") == F.lit(wanted)).first()
    if entry is None:
        raise ValueError(f"{path} has no version {version}")
    return spark.read.schema(StructType.fromJson(json.loads(entry.table_schema))).parquet(f"{path}/{entry.folder}")
