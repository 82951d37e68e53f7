"""Exact deduplication: sorted digest runs that are merged in binomial rounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import ascii_lower, free_name, texts

KEY = ["text_sha256", "text_bytes", "text_check"]


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, length, second digest) of every normalised text."""
    normal = texts(df, id_col, text_col).withColumn("text", ascii_lower(F.col("text")))
    return normal.select(
        "doc_id",
        F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"),
        F.octet_length("text").alias("text_bytes"),
        F.xxhash64("text").alias("text_check"),
    )


def exact_groups(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    runs: int = 256,
    fan_in: int = 16,
) -> DataFrame:
    """One row per distinct text: its digest, keep_id and group_size.

    Every run holds the digests of one share of the rows, sorted and without
    repeats. A round merges ``fan_in`` runs into one, so that a digest shared by
    a third of all rows reaches any task at most ``fan_in`` times, once for each
    run. Each level keeps the extreme doc_id and the count. A group needs equal
    SHA-256, equal length and an equal second hash (``text_check``); rows that
    agree in SHA-256 alone never join.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    level = digests(df, id_col, text_col).select(
        *KEY,
        F.pmod(F.xxhash64("doc_id"), F.lit(runs)).cast("int").alias("run"),
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
    )
    while True:
        # Partial aggregation sorts out repeats before the exchange of each round.
        level = level.groupBy("run", *KEY).agg(
            best("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
        )
        if runs == 1:
            return level.drop("run")
        runs = -(-runs // fan_in)
        level = level.withColumn("run", (F.col("run") / fan_in).cast("int"))


def exact_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. ``keep`` says whether
    the smallest or the largest doc_id of a group stays.

    Nulls and empty texts are one group of empty texts. A null doc_id never
    stays while its group has another; a group of null ids has a null keep_id,
    and all its rows stay. Rows that repeat a doc_id with an equal text stay or
    go together and count one by one in group_size. An empty table gives no
    rows. Other columns are not read.
    """
    groups = exact_groups(df, id_col, text_col, keep)
    copies = groups.filter("group_size > 1").withColumnsRenamed({k: f"_{k}" for k in KEY})
    same = _all(F.col(k) == F.col(f"_{k}") for k in KEY)
    # The rows are the left side, which AQE may split where a digest is hot.
    return digests(df, id_col, text_col).join(copies, same, "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id"))
        .otherwise(F.col("keep_id"))
        .alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def _all(conditions) -> Column:
    first, *rest = conditions
    for c in rest:
        first = first & c
    return first


def without_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """The rows, with all their columns, that stay: one for each distinct text.

    Of rows that repeat both doc_id and text one stays. Of texts that only rows
    without a doc_id hold, one row stays too. Columns may have any name and are all
    kept; a table without rows gives none.
    """
    name = free_name(df, "__kept")
    kept = exact_groups(df, id_col, text_col, keep).select(
        _row_key(F.col("keep_id"), F.col("text_sha256")).alias(name)
    )
    digest = F.sha2(F.encode(ascii_lower(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), "UTF-8"), 256)
    keyed = df.withColumn(name, _row_key(F.col(f"`{id_col}`").cast("long"), digest))
    # The join leaves the rows where dropDuplicates needs them.
    return keyed.join(kept, name, "left_semi").dropDuplicates([name]).drop(name)


def _row_key(doc_id: Column, digest: Column) -> Column:
    return F.concat(F.coalesce(doc_id.cast("string"), F.lit("none")), F.lit(":"), digest)
