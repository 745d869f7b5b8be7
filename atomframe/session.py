"""Session defaults: UTC, adaptive execution and Arrow transfer."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "atomframe", **conf: str) -> SparkSession:
    """The running session, or a new one with the library's defaults and ``conf`` on top."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the tables in ``sf_dir``, by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Only a local master may do without; it gets a
    temporary one."""
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not path and not re.match(r"local(\[|$)", context.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not context.getCheckpointDir():
        context.setCheckpointDir(path or tempfile.mkdtemp(prefix="spark-"))
    return (path or context.getCheckpointDir()).rstrip("/")


def checkpointed(df):
    """``df`` with its lineage cut in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df, name: str):
    """``df`` computed once, as Parquet in the shared folder, and read again."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
