"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Arrow batches handed to Python: rows and bytes at most. A longer single row still travels whole.
BATCH_ROWS = 2000
BATCH_BYTES = 16 << 20


def tune(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for an executor's Python worker.

    Results are lazy, so the settings stay when an operator returns. A caller's smaller batches are kept.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        found = str(spark.conf.get(key))
        if not found.isdigit() or not 0 < int(found) <= most:
            spark.conf.set(key, str(most))
    # Shuffle files of a finished step go at once: what later steps read has been written to the shared folder.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local default only on a local master without one (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "/tmp/docloom-checkpoints"
    return found.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it back.

    A later loss of executors recomputes nothing above the written table.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/docloom-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.docloom_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that only tables written since were made of."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.docloom_path)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def text_values(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    else:
        column = column.cast(pa.binary())
    return [x or b"" for x in column.to_pylist()]


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes in ``column``; one row is never cut."""
    sizes = [len(x) for x in text_values(batch.column(column))]
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > limit:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield batch.slice(begin)


def hash_sample(df: DataFrame, n: int, key: Column) -> DataFrame:
    """At most ``n`` rows of ``df``, the first by a hash of ``key``.

    The rows are counted and only hashes below a share that fits about four times ``n`` rows are sorted, so what meets in
    one task doesn't grow with the number of partitions. Rows with equal keys share a hash.
    """
    h, total = F.xxhash64(key), df.count()
    if total > 4 * n:
        df = df.filter(h < int(4 * n / total * 2**64) - 2**63)
    return df.orderBy(h).limit(n)
