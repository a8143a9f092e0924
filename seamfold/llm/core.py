"""What the text operators share: session set-up, scratch tables, words, hashes."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import os
import tempfile
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes per Arrow batch; with the usual tail of document sizes a batch is near 5 MB.
ARROW_ROWS, ARROW_BYTES = 1000, 16 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_tables: list[tuple] = []
_sent: list[Broadcast] = []


def prepare(spark: SparkSession) -> SparkSession:
    """Make the package importable in Python workers and bound the Arrow batches."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a folder of our own only in local mode where none is named."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    where = "file://" + tempfile.mkdtemp(prefix="seamfold-")
    spark.conf.set("spark.checkpoint.dir", where) if spark.conf.isModifiable("spark.checkpoint.dir") else None
    return where


def _delete(spark: SparkSession, path: str, table: str | None = None) -> None:
    if table:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def scratch(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write df as a table in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/seamfold-{label}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    _tables.append((spark, path))
    return spark.read.schema(schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete the scratch tables that df reads directly; nothing that is still to be computed may need them."""
    paths = {os.path.dirname(f) for f in df.inputFiles()}
    for held in [t for t in _tables if any(p.endswith(t[1].split("://")[-1].lstrip("/")) for p in paths)]:
        _tables.remove(held)
        _delete(*held)


def bucketed(df: DataFrame, column: str, label: str) -> DataFrame:
    """Write df as a table in as many buckets of a column as a shuffle has partitions, so that grouping by it needs no shuffle."""
    spark = df.sparkSession
    name, path = f"seamfold_{label}_{uuid.uuid4().hex}", f"{shared_folder(spark)}/seamfold-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("path", path).bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), column).saveAsTable(name)
    _tables.append((spark, path, name))
    return spark.table(name)


def send(spark: SparkSession, value) -> Broadcast:
    """A broadcast that release destroys."""
    out = spark.sparkContext.broadcast(value)
    _sent.append(out)
    trim()  # what it was written through
    return out


class Held:
    """The scratch tables and broadcasts that were made inside a with block, to be freed together."""

    def __enter__(self) -> Held:
        self.since, self.tables, self.sent = (len(_tables), len(_sent)), [], []
        return self

    def __exit__(self, *_) -> None:
        self.tables, self.sent = _tables[self.since[0] :], _sent[self.since[1] :]

    def free(self) -> None:
        """Only when what was built on them is written."""
        for b in self.sent:
            if b in _sent:
                _sent.remove(b)
                b.destroy()
        for t in self.tables:
            if t in _tables:
                _tables.remove(t)
                _delete(*t)
        self.tables, self.sent = [], []


def release() -> None:
    """Delete every scratch table and broadcast made so far; only when what was built on them is written."""
    while _sent:
        _sent.pop().destroy()
    while _tables:
        _delete(*_tables.pop())


@atexit.register
def _at_exit() -> None:
    for spark, *_ in _tables[:1]:
        if getattr(spark.sparkContext, "_jsc", None) is None:
            return
    try:
        _sent.clear()
        release()
    except Exception:  # noqa: BLE001  the JVM may be gone already
        _tables.clear()


def trim() -> None:
    """Give back to the system what a Python worker has freed; workers live on after their tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def trimmed(run):
    """A function over batches that trims its worker's memory when it ends."""

    def call(batches):
        yield from run(batches)
        trim()

    return call


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(32))
    x = x * _MIX
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n consecutive entries; of a shorter sequence, of the whole of it."""
    if len(h) == 0:
        return h
    n = min(n, len(h))
    m = len(h) - n + 1
    g = np.full(m, n, np.uint64)
    for i in range(n):
        g = g * _MIX
        g ^= g >> np.uint64(31)
        g += h[i : i + m]
    return mix(g)


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
