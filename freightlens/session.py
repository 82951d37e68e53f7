"""Session settings for tests and benchmarks, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

#: Let AQE split a skewed join also where the next step must then shuffle again.
#: Without it, a join on order_id that feeds an aggregation by order_id keeps a
#: huge order in one task. Set it for the sessions of a cluster, too.
SKEW_SPLITS = {"spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}


def local_session(cores: str = "8", app: str = "freightlens") -> SparkSession:
    """A single-machine session for tests and benchmarks; a cluster's caller brings its own.

    It has a shared folder of its own unless Spark's defaults name one.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("FREIGHTLENS_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config(map=SKEW_SPLITS)
    )
    session = builder.getOrCreate()
    if session.conf.get("spark.checkpoint.dir", None):
        return session
    session.stop()
    return builder.config(
        "spark.checkpoint.dir", tempfile.mkdtemp(prefix="freightlens-")
    ).getOrCreate()


#: Bytes of shuffled data up to which AQE merges partitions into one task. The sorts and hash
#: tables of a task over order items hold some 25 times the compressed bytes that it reads.
FINE_TASK_BYTES = 16 << 20


def session_like(spark: SparkSession, changes: Mapping[str, str]) -> SparkSession:
    """A session with the settings of ``spark`` but for ``changes``; the caller's stays as it is."""
    own = spark.newSession()
    for name, value in {**spark.conf.getAll, **changes}.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    return own


#: Parquet bytes of orders and lines for which a shuffle has one partition more. The widest
#: task, of the fact, reads some five times these bytes from its shuffles.
INPUT_OF_A_PARTITION = 2 << 20


def fine_session(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """A session like ``spark`` whose reduce tasks read ``FINE_TASK_BYTES`` each, or less if set so.

    A shuffle starts with as many partitions as ``input_bytes`` ask for, which AQE then merges, so
    the memory of a task does not grow with the tables.
    """
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    number = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    least = min(size(spark.conf.get(advisory)), FINE_TASK_BYTES)
    given = spark.conf.get(number, None) or spark.conf.get("spark.sql.shuffle.partitions")
    most = max(int(given), -(-input_bytes // INPUT_OF_A_PARTITION))
    return session_like(spark, {advisory: f"{least}b", number: str(most)})


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: the one named in ``spark.checkpoint.dir``.

    A missing setting is an error, since a machine-local folder would be lost
    with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")


_RUN_DIRS: list[str] = []


def new_run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten there."""
    _RUN_DIRS.append(f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}")
    return _RUN_DIRS[-1]


def remove_run_dirs(spark: SparkSession) -> None:
    """Delete every run folder of this process, once no result that reads one is needed."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _RUN_DIRS:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_RUN_DIRS.pop())
        path.getFileSystem(conf).delete(path, True)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again, for what is used more than once."""
    path = new_run_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
