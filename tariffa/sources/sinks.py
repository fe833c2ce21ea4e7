"""Result sinks: tables as Parquet or CSV, one-row metrics as JSON."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tariffa.session import new_table_path


# A scan is cut into tasks between row groups, and what follows it costs far more than reading; Spark's own 128 MB would leave a
# table of a million rows to one task.
ROW_GROUP_BYTES = 8 * 2**20


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if fmt == "parquet":
        writer = writer.option("parquet.block.size", str(ROW_GROUP_BYTES))
    writer.format(fmt).save(path)
    return path


def rewrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    """Write the partitions that ``df`` has rows of, in place of what they held; all others keep their files.

    A month can be run again alone.  Rows that a rerun no longer has leave with their partition's old files, but a partition
    without any row in ``df`` is not emptied.  Rows are brought together by partition first, one that is too large for a task
    in several tasks.
    """
    gathered = df.hint("rebalance", *partition_by)
    gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    return path


def write_metrics(one_row: DataFrame, path: str) -> str:
    """A metrics DataFrame as JSON lines (one row, so one small file)."""
    one_row.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def read_metrics(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def stored(df: DataFrame, name: str = "table", path: str | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a table to the shared folder and read it back: the stage hand-off.

    Everything later sees a plain scan: it reads only the columns it needs, its plan stays
    small, its true size is known to Catalyst, and losing an executor costs a re-read instead
    of a re-run of everything upstream.
    """
    spark = df.sparkSession
    path = path or new_table_path(spark, name)
    write_table(df, path, "parquet", partition_by)
    return spark.read.schema(df.schema).parquet(path)


BYTES_PER_BUCKET = 64 * 2**20
MOST_BUCKETS = 100_000  # Spark's own limit


def bucket_count(df: DataFrame) -> int:
    """Buckets by what the plan reads, at least one for each core."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    read = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    return max(df.sparkSession.sparkContext.defaultParallelism, min(-(-read // BYTES_PER_BUCKET), MOST_BUCKETS))


def stored_bucketed(df: DataFrame, by: Sequence[str], name: str = "table", buckets: int | None = None) -> DataFrame:
    """Like :func:`stored`, with rows of equal ``by`` in one bucket, sorted: joins and groupings on ``by`` need no exchange.

    The rows are dealt once, at the write, so each bucket is one file.  Tables that are to be joined need the same number of
    ``buckets``.  A bucket is read by one task: ``by`` should be a key that hardly repeats.  The table's entry in the session's catalog
    points into the shared folder.
    """
    spark = df.sparkSession
    path = new_table_path(spark, name)
    table = "".join(c if c.isalnum() else "_" for c in os.path.basename(path))
    count = buckets or bucket_count(df)
    dealt = df.repartition(count, *by)
    dealt.write.bucketBy(count, *by).sortBy(*by).option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table)
