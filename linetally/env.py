"""Environments, sessions and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Env:
    """One deployment (dev, prod, ...): a base path and its own masking salt.

    Every environment holds the same layers under its base path, so moving
    from one to the other changes nothing but this object.
    """

    name: str
    base: str
    salt: str
    landing_root: str | None = None

    def path(self, layer: str, table: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}/{table}"

    # landing zone and staged files
    @property
    def landing(self) -> str:
        return self.landing_root or self.path("landing", "orders")

    @property
    def staged(self) -> str:
        return self.path("staged", "orders")

    @property
    def audit(self) -> str:
        return self.path("staged", "_audit/recon")

    @property
    def quarantine(self) -> str:
        return self.path("staged", "_quarantine")

    @property
    def quarantine_csv(self) -> str:
        return self.path("staged", "_quarantine_csv")

    @property
    def quarantine_stream(self) -> str:
        return self.path("staged", "_quarantine_stream")

    @property
    def stream_audit(self) -> str:
        return self.path("staged", "_audit/stream")

    # tables
    @property
    def raw_orders(self) -> str:
        return self.path("raw", "orders")

    @property
    def raw_orders_stream(self) -> str:
        return self.path("raw", "orders_stream")

    @property
    def raw_countries(self) -> str:
        return self.path("raw", "worldbank_countries")

    @property
    def raw_indicators(self) -> str:
        return self.path("raw", "worldbank_indicators")

    @property
    def country_mapping(self) -> str:
        return self.path("staging", "country_mapping")

    @property
    def stg_orders(self) -> str:
        return self.path("staging", "stg_orders")

    @property
    def recon_raw(self) -> str:
        return self.path("ops", "glue_recon_raw")

    def mart(self, name: str) -> str:
        return self.path("marts", name)


def build_session(app_name: str = "linetally", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine is tested with.

    AQE carries most of the physical planning: it picks broadcast joins from
    measured sizes, splits skewed shuffle partitions and sizes output files.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # files of about this size come out of rebalanced writes
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        # daily folders are many and small: a few hundred listing tasks are enough
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "256")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# whether the shuffle files of an execution are removed at its end
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# of the tables the engine writes, but for staged files, which are named by theirs
COMPRESSION = "zstd"

_LOCAL_SCRATCH: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables, shared by all executors.

    The cluster names it in ``spark.checkpoint.dir``. A temporary folder is
    used only for a local master with the setting absent.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="linetally-")
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared scratch folder."""
    return f"{scratch_root(spark)}/linetally/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes and counts inside remove their shuffle files once they end; Spark keeps them until its garbage is collected.

    These have a plan of their own each time, so nothing reads the shuffles again. A frame that is itself collected
    more than once is not meant to be run inside: its second run would have to shuffle again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def forget(df: DataFrame) -> None:
    """Remove the scratch files of a table made by :func:`written`, once nothing reads it any more."""
    spark = df.sparkSession
    root = scratch_root(spark)
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if "/linetally/" in folder and spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath() in folder:
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Cut the lineage: write to shared scratch and read back.

    Used where a result is needed more than once. Unlike a cache it survives
    the loss of executors, and reads of it prune columns and partitions.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_removed(spark):
        df.write.mode("errorifexists").partitionBy(*partition_by).option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
