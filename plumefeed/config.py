"""Session, shared work folder and job settings."""

from __future__ import annotations

import os
import tempfile
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

# Rows that travel to Python together.
BATCH_BYTES = 2 << 20


def session(app_name: str = "plumefeed", **conf: str) -> SparkSession:
    """A session with the settings every job here relies on."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Dedup state outgrows the heap; this store spills to local disk and is
        # checkpointed to the shared folder.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path in the shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="plumefeed-")
        sc.setCheckpointDir(root)
    return "/".join([root.rstrip("/"), "plumefeed", sc.applicationId, *parts])


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session by bytes, as both sides hold one several times."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).removesuffix("b")) > BATCH_BYTES:
        spark.conf.set(name, BATCH_BYTES)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a table that outlives any executor.
    """
    spark = df.sparkSession
    path = work_path(spark, name, os.urandom(6).hex())
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_work(spark: SparkSession) -> None:
    """Remove what this application left in the shared folder; for the end of a job.

    Frames that read those tables are of no use afterwards.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(work_path(spark))
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Use the whole cluster for heavy row-wise work on a poorly split input.

    An input with at least as many splits as the cluster has cores is left alone, so a
    large table is never shuffled by this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *key) if df.rdd.getNumPartitions() < cores else df


@dataclass(frozen=True)
class FeedSettings:
    """Knobs of the ranking; each can be set as ``spark.plumefeed.<name>``."""

    semantic_weight: float = 0.85
    recency_weight: float = 0.15
    decay_hours: float = 24.0
    pool_size: int = 400
    near_duplicate_threshold: float = 0.40
    default_limit: int = 20
    max_limit: int = 100
    max_interests: int = 50

    @classmethod
    def from_conf(cls, spark: SparkSession) -> FeedSettings:
        """Settings from the session; a value that does not parse keeps its default."""
        values = {}
        for f in fields(cls):
            raw = spark.conf.get(f"spark.plumefeed.{f.name}", None)
            if raw is None:
                continue
            try:
                values[f.name] = type(f.default)(raw)
            except ValueError:
                pass
        return cls(**values)
