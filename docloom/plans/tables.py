"""Cutting lineage: tables in the folder that the cluster shares."""

from __future__ import annotations

import uuid
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession

_paths: dict[str, list[str]] = defaultdict(list)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the folder in spark.checkpoint.dir and read it back; a local folder only on a local master without one.

    Stages that are used several times are computed once, and losing executors never recomputes what is above.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "/tmp/docloom-checkpoints"
    path = f"{base.rstrip('/')}/docloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _paths[spark.sparkContext.applicationId].append(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_written(spark: SparkSession) -> None:
    """Delete all tables that this application has ``written``; what was made of them must have been read or saved."""
    for path in _paths.pop(spark.sparkContext.applicationId, []):
        own = spark._jvm.org.apache.hadoop.fs.Path(path)
        own.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(own, True)
