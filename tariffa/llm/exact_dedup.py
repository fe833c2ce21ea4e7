"""Exact deduplication by a stateful stream.

A stream of (digest, identifier, locator) rows runs into keyed state on disk (RocksDB) that never
expires.  The state of a digest is the row that stays and the number of rows seen, nothing of the
text; copies are combined inside each task before they reach it, so a digest that a third of all
rows share costs one row a task.  A digest with more than one row is a hit: the full bytes of
its rows are read again and compared, and digests under which texts differ are settled by the bytes.

Null texts count as empty, empty texts are copies of each other, and a null identifier is smaller than
any other.  Of repeated rows (same identifier, same text) the one that lies last in the files stays, so every
class keeps exactly one row.  An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa.llm.common import on_files, with_locator, without_rows
from tariffa.session import new_table_path
from tariffa.sources.sinks import stored

# State on disk, with little memory for each of many small stores: no space set aside for logs, small write buffers, one bounded
# cache for all stores of an executor, and stores of an ended stream are closed soon.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "2",
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
}


def sha256(content: Column) -> Column:
    return F.sha2(F.encode(content, "UTF-8"), 256)


def keyed_state(stream: DataFrame) -> DataFrame:
    """The stateful step, on a stream (or a table) with columns digest, id, _file and _row."""
    return stream.groupBy("digest").agg(
        F.max(F.struct("id", "_file", "_row")).alias("keeper"), F.count(F.lit(1)).alias("size")
    )


def drain(spark: SparkSession, rows: DataFrame, checkpoint: str) -> DataFrame:
    """Run everything that has arrived through the state below ``checkpoint``; give the state's content.

    Called again with the same checkpoint, it goes on where it stopped: the state is kept.
    """
    before = {key: spark.conf.get(key, None) for key in STATE_CONF}
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    try:
        (
            keyed_state(rows)
            .writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
        kept = spark.read.format("statestore").option("path", checkpoint).load()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return kept.select("key.digest", F.col("value.max").alias("keeper"), F.col("value.count").alias("size"))


def deduplicate(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    normalise: Callable[[Column], Column] = lambda content: content,
    digest: Callable[[Column], Column] = sha256,
    files_per_batch: int = 10_000,
    checkpoint: str | None = None,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, digest, with its locator (_file, _row)."""
    spark = docs.sparkSession
    located = with_locator(docs, id, text)
    content = normalise(F.coalesce(F.col(text), F.lit("")))
    full = located.select(F.col(id).alias("id"), digest(content).alias("digest"), content.alias("content"), "_file", "_row")
    arrivals = new_table_path(spark, "arrivals")
    full.drop("content").write.parquet(arrivals)
    rows = spark.read.parquet(arrivals)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files_per_batch).parquet(arrivals)
    state = stored(drain(spark, stream, checkpoint or new_table_path(spark, "state")), "keepers")

    # hits: compare the full bytes under each digest that came more than once
    hits = state.filter("size > 1").select("digest")
    spans = full.join(hits, "digest").groupBy("digest").agg(F.min("content").alias("least"), F.max("content").alias("most"))
    differing = stored(spans.filter("least <> most").select("digest"), "differing")
    joined = rows.join(state, "digest")
    if not differing.isEmpty():
        doubtful = full.join(differing, "digest")
        settled = keyed_state(doubtful.withColumn("digest", F.struct("digest", "content")))
        joined = (
            rows.join(differing, "digest", "left_anti")
            .join(state, "digest")
            .unionByName(
                doubtful.withColumn("pair", F.struct("digest", "content"))
                .join(settled.withColumnRenamed("digest", "pair"), "pair")
                .drop("pair", "content")
            )
        )
    return joined.select(
        F.col("id").alias(id),
        F.col("keeper.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        F.struct("_file", "_row").eqNullSafe(F.struct("keeper._file", "keeper._row")).alias("kept"),
        "digest",
        "_file",
        "_row",
    )


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without copies: all columns of the row that stays of each class."""
    docs = on_files(docs)
    # only copies have to be taken out, so uncopied texts need no partner in the join
    return without_rows(docs, deduplicate(docs, id, text).filter("not kept"))
