"""Row numbers within a key, also when one key holds much of the table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freightlens.session import written


def number_rows(df: DataFrame, key: str, order_by: Sequence[str], name: str) -> DataFrame:
    """1-based place of each row within ``key`` in the order of ``order_by``, as a bigint.

    All keys are numbered alike. The rows are sorted into ranges of (key, order),
    so a key of any size is spread over as many ranges as it fills; rows that
    agree in both are told apart by where they were read. One pass over the
    sorted range counts from 1 again at each new key, and the range is written to the
    shared folder: one shuffle and one write of the rows, however often the result is used.
    Only the first key of a range can have rows in earlier ranges. What that adds
    to its counts is one row a range at most, so it is broadcast.
    """
    columns = df.columns
    ranged = (
        df.withColumn("_read", F.monotonically_increasing_id())
        .repartitionByRange(*[F.col(c) for c in (key, *order_by, "_read")])
        .sortWithinPartitions(key, *order_by, "_read")
        .drop("_read")
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_place", F.lit(0).cast("long"))
    )
    at = columns.index(key)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        last, counted = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            runs = pc.run_end_encode(batch.column(at))
            ends = runs.run_ends.to_numpy(zero_copy_only=False).astype(np.int64)
            starts = np.concatenate([[0], ends[:-1]])
            places = np.arange(1, batch.num_rows + 1) - np.repeat(starts, ends - starts)
            first = runs.values[0].as_py()
            if counted and first == last:
                places[: ends[0]] += counted
            last, counted = runs.values[-1].as_py(), int(places[-1])
            arrays = [*batch.columns[:-1], pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    ranged = written(ranged.mapInArrow(count, ranged.schema), "numbered")
    edges = ranged.groupBy("_range").agg(
        F.min(F.struct(key)).alias("first"), F.max(F.struct(key, "_place")).alias("last")
    )
    tail = F.struct(F.col(f"last.{key}").alias("_key"), F.col("last._place").alias("_place"))
    head = F.struct(F.col(f"first.{key}").alias("_key"), F.lit(None).cast("long").alias("_place"))
    ends = edges.select("_range", F.inline(F.array(tail, head)))
    # Of one key in order of the ranges; a range's head comes before its tail.
    earlier = (
        Window.partitionBy("_key")
        .orderBy("_range", F.col("_place").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = written(
        ends.withColumn("_start", F.sum("_place").over(earlier))
        .filter("_place IS NULL AND _start > 0")
        .select("_key", F.col("_range").alias("_start_range"), "_start"),
        "borders",
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_start_range"))
    place = (F.col("_place") + F.coalesce("_start", F.lit(0))).alias(name)
    return ranged.join(F.broadcast(starts), same, "left").select(*columns, place)
