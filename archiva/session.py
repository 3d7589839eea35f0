"""Session builder and small helpers shared by all queries."""

from __future__ import annotations

import os
import pickle
import uuid

from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession


def build(master: str | None = None, app: str = "archiva", **conf: str) -> SparkSession:
    """A session with the settings every operator assumes: UTC, adaptive execution, Arrow."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for k, v in {**base, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The parquet table ``name``; with ``cols`` only those columns are read."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*cols) if cols else df


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Rows over at least as many partitions as there are cores, so that a small file keeps no core idle.

    Large inputs already have more input splits than that and are left alone.
    """
    n = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n, *cols)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only where none is set and all runs on one machine, as in tests, a folder of the warehouse is used.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        at = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not at and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(at or spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:") + "/checkpoints")
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through reliable storage, see shared_folder()."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stage(df: DataFrame) -> DataFrame:
    """Cut lineage like checkpoint(), through parquet: compressed, and who reads it takes only the columns it needs.

    The files stay until the application ends.
    """
    spark = df.sparkSession
    at = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(path)
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def share(spark: SparkSession, value: object) -> Broadcast:
    """A broadcast of any object, its classes by value, so that executors need no copy of the package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared_value(shared: Broadcast) -> object:
    """What share() sent; read once per worker, so what it remembers lasts from task to task."""
    got = shared.__dict__.get("_object")
    if got is None:
        got = shared.__dict__["_object"] = pickle.loads(shared.value)
    return got
