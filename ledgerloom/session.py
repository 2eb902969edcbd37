"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession

_local_roots: dict[str, str] = {}


def build_session(app_name: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Everything here is a default a cluster may override: adaptive execution splits skewed join
    partitions and sizes shuffles, so no partition count is fixed outside local runs. Where every
    partition of a join's smaller side proves small at run time, hashing it spares sorting the
    larger side.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own; a cluster
    without it is an error, since a machine-local path would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_roots.setdefault(context.applicationId, tempfile.mkdtemp(prefix="ledgerloom-"))
    return os.path.join(root, context.applicationId)


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; paths are never reused, so nothing needs clearing."""
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, label: str, *metrics) -> tuple[DataFrame, dict]:
    """Write ``df`` once to the shared folder and read it back, with ``metrics`` observed on the way.

    Used where several consumers would otherwise repeat an expensive join. The written table
    outlives lost executors and cuts the lineage; the metrics cost no further scan.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    observation = Observation(label)
    observed = df.observe(observation, *metrics) if metrics else df
    observed.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), observation.get if metrics else {}


_databases: dict[str, list[str]] = {}


def new_database(spark: SparkSession, label: str) -> str:
    """A database of this application's own, its tables in the shared folder."""
    name = f"{label}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_path(spark, label)}'")
    _databases.setdefault(spark.sparkContext.applicationId, []).append(name)
    return name


def release(spark: SparkSession) -> None:
    """Remove what this application wrote for itself: its databases and its part of the shared folder.

    Whoever runs the queries owns these and calls this once no result is read any more; results
    are lazy and read the written tables. The folder of another application is never touched.
    """
    for name in _databases.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    context = spark.sparkContext
    own = context._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    own.getFileSystem(context._jsc.hadoopConfiguration()).delete(own, True)
