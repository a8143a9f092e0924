"""Folders that all executors share, and what their Python workers need to find this library."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a folder of our own only in local mode where none is named."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    where = "file://" + tempfile.mkdtemp(prefix="seamfold-")
    spark.conf.set("spark.checkpoint.dir", where) if spark.conf.isModifiable("spark.checkpoint.dir") else None
    return where


def fresh(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/seamfold-{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a table in the shared folder, so that what reads it several times computes it once; deleted when the program ends."""
    spark, path = df.sparkSession, fresh(df.sparkSession, label)
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _delete() -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone already
        for spark, path in _written:
            if getattr(spark.sparkContext, "_jsc", None) is not None:
                at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package, also where it is not installed."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)
    return spark
