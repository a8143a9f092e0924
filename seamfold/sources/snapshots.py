"""Tables of which every version is a snapshot, and a log that says which one counts.

A version's rows are written first; then a file of its number is created in the log, which
a store does for one writer only. What breaks off before that was never there, and readers
keep the version they have begun with.
"""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamfold.errors import BadDocument, ConcurrentWrite


class Snapshots:
    """The versions of a table under a folder, all of one schema."""

    def __init__(self, spark: SparkSession, path: str, schema: str) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _store(self, name: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def versions(self) -> list[int]:
        """The numbers of all versions, ascending; none if nothing was ever committed."""
        store, log = self._store("log")
        return sorted(int(s.getPath().getName()) for s in store.listStatus(log)) if store.exists(log) else []

    def _folder(self, version: int) -> str:
        store, at = self._store(f"log/{version:012d}")
        stream = store.open(at)
        try:
            name = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        if not name:
            raise BadDocument(f"version {version} of {self.path} names no folder")
        return f"{self.path}/{name}"

    def read(self, version: int | None = None) -> DataFrame:
        """A version, the last one by default; no rows before the first. One that cannot be read is an error, never an empty table."""
        known = self.versions()
        if not known and version is None:
            return self.spark.createDataFrame([], self.schema)
        number = known[-1] if version is None else version
        if number not in known:
            raise BadDocument(f"{self.path} has no version {number}")
        try:
            return self.spark.read.schema(self.schema).parquet(self._folder(number))
        except PySparkException as e:
            raise BadDocument(f"version {number} of {self.path} cannot be read: {e}") from e

    def commit(self, rows: DataFrame, after: int | None = None) -> int:
        """Write rows as the version after `after` (by default the last one there is), and give its number.

        ConcurrentWrite if another writer has committed that version; nothing of this one is then seen.
        """
        known = self.versions()
        number = (after if after is not None else known[-1] if known else 0) + 1
        name = f"data-{uuid.uuid4().hex}"
        rows.select(*self.spark.createDataFrame([], self.schema).columns).write.parquet(f"{self.path}/{name}")
        self._publish(number, name)
        return number

    def _publish(self, number: int, name: str) -> None:
        store, at = self._store(f"log/{number:012d}")
        try:
            stream = store.create(at, False)  # not over a file that is there
        except Exception as e:  # the store's own exception, by way of the gateway
            if store.exists(at):
                raise ConcurrentWrite(f"version {number} of {self.path} is another writer's") from e
            raise
        try:
            stream.write(bytearray(name.encode()))
        finally:
            stream.close()


def rewrite_without(pairs: Snapshots, dropped: DataFrame, keys: list[str], log: Snapshots) -> int:
    """Commit pairs without the dropped ones (keys and why), and add these to the log of dropped pairs; the new version of pairs.

    The log is committed first: if the run breaks off between the two, the same call drops
    the same pairs again, and none of them is in the log twice.
    """
    rows, version = pairs.read(), (pairs.versions() or [0])[-1]
    known = log.read()
    new = rows.join(dropped.dropDuplicates(keys), keys).join(known.select(*keys), keys, "left_anti")
    log.commit(known.unionByName(new.select(*known.columns)))
    return pairs.commit(rows.join(dropped.select(*keys).distinct(), keys, "left_anti"), after=version)


def upserted(manifest: Snapshots, marks: DataFrame, key: str | list[str], order: str) -> int:
    """Commit a manifest in which the last mark of each key, by order among the new ones, takes the place of what was there."""
    keys = [key] if isinstance(key, str) else key
    old = manifest.read()
    rest = [c for c in old.columns if c not in keys]
    new = marks.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("x")).select(*keys, "x.*")
    return manifest.commit(old.join(new.select(*keys), keys, "left_anti").unionByName(new.select(*old.columns)))
