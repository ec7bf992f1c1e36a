"""Session helpers: table access, shared checkpoints, bounded Arrow batches."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def session(app: str = "scriptorium", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are planned for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory; any path that Spark's readers open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, most: int = 32) -> DataFrame:
    """A table's rows over all cores, where it comes in fewer splits than there are cores.

    A file of one row group is read by one task, which would then do all the work on its texts.
    At most ``most`` splits are dealt out anew, so what moves is bounded; larger inputs are left as they are. Filters
    and columns that are not asked for are still left to the scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(cores) if splits < min(cores, most) else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Only in local mode, where one machine is all there is, a temporary folder may stand in.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + os.path.join(tempfile.gettempdir(), f"scriptorium-{os.getuid()}")
    return folder.rstrip("/")


class Durable:
    """Writes intermediate tables to the shared folder, to cut lineage.

    A table written here outlives any executor. ``drop`` removes tables that
    nothing reads any more; what is left of an application is under one folder,
    ``scriptorium/<application id>``, which can go when the application has ended.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/scriptorium/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
        self.count = 0

    def save(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count:03d}"
        df.write.parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        saved._scriptorium_path = path
        return saved

    def drop(self, *saved: DataFrame) -> None:
        for df in saved:
            if path := getattr(df, "_scriptorium_path", None):
                self._delete(path)

    def clear(self) -> None:
        """Removes all tables saved here."""
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def ship(spark: SparkSession | None = None) -> None:
    """Sends this package to the executors, once for each Spark context.

    Python functions there refer to the package's modules, which executors of a
    cluster need not have on their path. The archive is served by the driver.
    """
    spark = spark or SparkSession.getActiveSession()
    if spark is None or getattr(spark.sparkContext, "_scriptorium_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="scriptorium-"), "scriptorium.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    spark.sparkContext._scriptorium_shipped = True


def prepare_batches(spark: SparkSession, rows: int = 1000, size: int = 4 << 20) -> None:
    """Before an Arrow function over texts: ``ship``, and batches of bounded size; smaller settings are left alone."""
    ship(spark)
    for key, most in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", rows),
        ("spark.sql.execution.arrow.maxBytesPerBatch", size),
    ):
        now = "".join(filter(str.isdigit, str(spark.conf.get(key, None) or "")))
        if not now or int(now) == 0 or int(now) > most:
            spark.conf.set(key, str(most))
