"""Incremental landing as a file stream without duplicates (T-1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from freightlens.session import session_like
from freightlens.sources.incremental import append_new


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files as a stream; each file is read once, also after a restart."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def land_stream(
    stream: DataFrame,
    target_dir: str,
    checkpoint_dir: str,
    key: Sequence[str],
    cursor: str,
) -> StreamingQuery:
    """Append each key once, however late or often it arrives.

    Every micro-batch is compared with what has landed, so no row is given up
    for being late and no state grows. A batch that is repeated after a failure
    appends nothing twice.
    """

    def write(batch: DataFrame, _batch_id: int) -> None:
        append_new(batch, target_dir, key, cursor)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )


#: Provider of the state of streams: on local disk, with changes kept in the checkpoint.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def state_session(spark: SparkSession) -> SparkSession:
    """A session like ``spark`` whose streams keep their state in RocksDB; the caller's stays as it is.

    A stream belongs to the session that made it, so read it with this one.
    """
    return session_like(spark, STATE_ON_DISK)


def land_stream_keyed(
    stream: DataFrame, target_dir: str, checkpoint_dir: str, key: Sequence[str]
) -> StreamingQuery:
    """Append each key once, however late or often it arrives, without reading what has landed.

    All keys that ever came are in the state store, spread over the shuffle
    partitions by their hash; a micro-batch looks up its own keys and touches no
    others. The state grows with the keys, so ``stream`` should come from a
    ``state_session``, which keeps it on disk. Null keys count as equal. Of rows that share a key
    the first to arrive lands; within one micro-batch any of them may be first.
    The file sink lists each micro-batch once, so a repeated one lands nothing twice.
    """
    return (
        stream.dropDuplicates([*key])
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", target_dir)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )


def land_stream_within(
    stream: DataFrame,
    target_dir: str,
    checkpoint_dir: str,
    key: Sequence[str],
    cursor: str,
    max_lateness: str,
) -> StreamingQuery:
    """Append each key once, remembering keys for ``max_lateness`` of event time only.

    For sources that promise such a limit: nothing landed is read again, but a
    row that breaks the promise is dropped. Watermarks need a zoned timestamp, so
    ``timestamp_ntz`` is converted on the way in and back on the way out.
    """
    bare = stream.schema[cursor].dataType
    zoned = stream.withColumn(cursor, F.col(cursor).cast("timestamp"))
    once = zoned.withWatermark(cursor, max_lateness).dropDuplicatesWithinWatermark([*key])
    return (
        once.withColumn(cursor, F.col(cursor).cast(bare))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", target_dir)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
