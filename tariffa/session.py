"""Session set-up and the shared work folder."""

from __future__ import annotations

import os
import re
import sys
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import SparkConf, cloudpickle, inheritable_thread_target
from pyspark.sql import SparkSession

# Functions that run on workers travel with all they use of this package, so workers need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__.partition(".")[0]])

# Fits that run at the same time; each is a chain of small jobs, so one alone leaves most cores idle.
FITS_AT_ONCE = 8

# Runtime settings the operators rely on.  All are Spark's own switches.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even when that costs one more shuffle downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    master: str | None = None, shuffle_partitions: int | None = None, work: str | None = None
) -> SparkSession:
    """``work`` is the shared folder, unless the cluster's own settings name one."""
    builder = SparkSession.builder.appName("tariffa").config("spark.ui.enabled", "false")
    if work and not SparkConf().contains("spark.checkpoint.dir"):
        builder = builder.config("spark.checkpoint.dir", work)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``.  Only when that is unset and all runs in one process
    (``local`` master, as in tests) is a temporary folder made; anywhere else its absence is an error, as every machine would
    write to a disk of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = context.getCheckpointDir()
        if not named:
            if re.fullmatch(r"local(\[.*\])?", context.master) is None:
                raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
            named = tempfile.mkdtemp(prefix="tariffa-")
            context.setCheckpointDir(named)
    return named


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point Spark's checkpoints at the shared folder if nothing has done so yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_dir(spark))


def drop_tables(spark: SparkSession) -> None:
    """Delete the tables that were written below the shared folder; nothing may read them any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(work_dir(spark), "tables"))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet, below the shared folder."""
    return os.path.join(work_dir(spark), "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def side_by_side(spark: SparkSession, fits: Sequence[Callable[[], object]], most: int = FITS_AT_ONCE) -> list:
    """Run fits at the same time, ``most`` of them at once and each in a scheduler pool of its own; results in order.

    Pools share the cores evenly where ``spark.scheduler.mode`` is FAIR and do no harm elsewhere.
    """

    def run(at: int):
        def job():
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{at}")
            return fits[at]()

        return inheritable_thread_target(spark)(job)()

    with ThreadPoolExecutor(max(1, min(most, len(fits)))) as threads:
        return list(threads.map(run, range(len(fits))))
