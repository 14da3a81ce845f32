"""Spark session settings shared by the tests, the bench and the examples."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import SparkSession

#: For large tables that several jobs read at a time.  On disk they are read as a stream.
#: In memory their serialized chunks of 1 MB take two regions each of a collector with regions
#: of 1 MB (heaps under 4 GB), twice what Spark counts, and a block that was dropped
#: comes back as one array.
HELD = StorageLevel.DISK_ONLY


def build_session(app: str = "outcomelab", master: str | None = None,
                  **overrides: str) -> SparkSession:
    """Create a session with the settings the operators are written for.

    Adaptive execution coalesces small shuffle partitions and splits skewed
    join partitions; nothing here depends on the number of cores.
    """
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **overrides,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cut_lineage(df, fallback_dir: str | None = None):
    """Materialise ``df`` in the shared checkpoint folder and return it.

    The folder is the one the cluster names in ``spark.checkpoint.dir``;
    ``fallback_dir`` is used only where that setting is missing. Without either
    the DataFrame is returned as it is.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or fallback_dir
        if folder is None:
            return df
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; the warehouse where that is unset."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def stored(df):
    """``df`` written once to a new folder of the shared folder and read back.

    For a table that is costly to make and read many times: it is made once, a lost
    executor costs a re-read, and every reader takes only the columns it needs.
    """
    path = f"{shared_folder(df.sparkSession)}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
