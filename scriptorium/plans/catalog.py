"""Versioned tables: each write is a new folder, and a pointer names the one that counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Catalog:
    """Tables under ``root``; earlier versions stay as backups until ``prune``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self, table: str) -> list[int]:
        """The complete versions: Spark marks them when a write has succeeded."""
        folder = self._path(f"{self.root}/{table}")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        found = [int(n[2:]) for n in names if n.startswith("v=")]
        return sorted(v for v in found if self._fs.exists(self._path(f"{self.root}/{table}/v={v}/_SUCCESS")))

    def exists(self, table: str) -> bool:
        return bool(self.versions(table))

    def read(self, table: str, version: int | None = None) -> DataFrame:
        v = version if version is not None else self.versions(table)[-1]
        return self.spark.read.parquet(f"{self.root}/{table}/v={v}")

    def tagged(self, table: str, tag: str) -> int | None:
        """The version that was written under a tag."""
        marks = (v for v in self.versions(table) if self._fs.exists(self._path(f"{self.root}/{table}/v={v}/_tag-{tag}")))
        return next(marks, None)

    def write(self, table: str, rows: DataFrame, partition_by: tuple[str, ...] = (), tag: str | None = None) -> int:
        """A new version; it may be made from the one that counts so far, as that is left alone.

        What has been written under a ``tag`` is not written again.
        """
        if tag is not None and (done := self.tagged(table, tag)) is not None:
            return done
        v = (self.versions(table) or [0])[-1] + 1
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{self.root}/{table}/v={v}")
        if tag is not None:
            self._fs.create(self._path(f"{self.root}/{table}/v={v}/_tag-{tag}")).close()
        return v

    def prune(self, table: str, keep: int = 3) -> None:
        for v in self.versions(table)[:-keep]:
            self._fs.delete(self._path(f"{self.root}/{table}/v={v}"), True)
