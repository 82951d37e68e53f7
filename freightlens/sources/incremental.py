"""Loading one table with filter, projection, limit and a high-water mark (I-6, I-8 … I-13)."""

from __future__ import annotations

import operator
import warnings
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_COMPARE = {
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "in": lambda c, values: c.isin(list(values)),
    "not in": lambda c, values: ~c.isin(list(values)),
}

Condition = tuple[str, str, Any]


@dataclass(frozen=True)
class Cursor:
    """Where the previous load stopped.

    ``newest`` says whether the mark moves up (True) or down (False). The mark
    itself is inclusive, so rows that arrived late with the same cursor value
    are seen; ``end`` is exclusive.
    """

    column: str
    last: Any = None
    end: Any = None
    newest: bool = True
    row_order: str | None = None

    def conditions(self) -> list[Condition]:
        if self.last is None:
            return []
        inclusive, exclusive = (">=", "<") if self.newest else ("<=", ">")
        found = [(self.column, inclusive, self.last)]
        if self.end is not None:
            found.append((self.column, exclusive, self.end))
        return found

    def ordering(self) -> Column | None:
        """The sort that reads rows from the mark onward, or against it for ``desc``."""
        if self.last is None or self.row_order is None:
            return None
        if self.row_order not in ("asc", "desc"):
            raise ValueError(f"row_order must be asc or desc, not {self.row_order!r}")
        ascending = (self.row_order == "asc") == self.newest
        c = F.col(self.column)
        return c.asc() if ascending else c.desc()


def filtered(
    df: DataFrame, where: Sequence[Condition] = (), cursor: Cursor | None = None
) -> DataFrame:
    """Rows that pass the user's conditions and the cursor's (I-8, I-12)."""
    own = cursor.conditions() if cursor else []
    taken = {(field, op) for field, op, _ in own}
    for field, op, value in where:
        if (field, op) in taken:
            raise ValueError(
                f"{field} {op} {value!r} uses an operator that the cursor already puts on {field}"
            )
    for field, op, value in [*own, *where]:
        df = df.filter(_COMPARE[op](F.col(field), value))
    return df


def projected(
    df: DataFrame,
    columns: Iterable[str] | Mapping[str, int] | None,
    key: Sequence[str] = (),
) -> DataFrame:
    """Keep or drop columns; key columns are always kept (I-10)."""
    if columns is None:
        return df
    if isinstance(columns, Mapping):
        if len({bool(flag) for flag in columns.values()}) > 1:
            raise ValueError("a projection either includes or excludes columns")
        including = any(columns.values())
    else:
        including = True
    named = set(columns)
    if including:
        return df.select([c for c in df.columns if c in named or c in key])
    if protected := named.intersection(key):
        warnings.warn(f"key columns {sorted(protected)} stay in the projection", stacklevel=2)
    return df.drop(*named.difference(key))


def limited(
    df: DataFrame, limit: int | None, key: Sequence[str] = (), cursor: Cursor | None = None
) -> DataFrame:
    """At most ``abs(limit)`` rows in cursor or key order; 0 and None mean all (I-9, I-11)."""
    if not limit:
        return df
    order = [F.col(k).asc() for k in key]
    if cursor is not None and (by_cursor := cursor.ordering()) is not None:
        order.insert(0, by_cursor)
    if not order:
        warnings.warn("a limit without an ordering may return different rows", stacklevel=2)
        return df.limit(abs(limit))
    return df.orderBy(*order).limit(abs(limit))


def load_table(
    df: DataFrame,
    where: Sequence[Condition] = (),
    columns: Iterable[str] | Mapping[str, int] | None = None,
    limit: int | None = None,
    cursor: Cursor | None = None,
    key: Sequence[str] = (),
) -> DataFrame:
    """One table with every load option (I-6)."""
    rows = limited(filtered(df, where, cursor), limit, key, cursor)
    return projected(rows, columns, key)


def latest_per_key(
    df: DataFrame, key: Sequence[str], cursor: str | None = None
) -> DataFrame:
    """One row per key, the one with the highest cursor value, or the largest row without one.

    The row is an aggregate, so copies of a key collapse before the shuffle.
    """
    rest = [c for c in df.columns if c not in key and c != cursor]
    if cursor is not None:
        rest.insert(0, cursor)
    if not rest:
        return df.distinct()
    newest = F.max(F.struct(*[F.col(c) for c in rest])).alias("_row")
    picked = df.groupBy(*key).agg(newest)
    return picked.select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def append_new(
    batch: DataFrame, target_dir: str, key: Sequence[str], cursor: str | None = None
) -> None:
    """Append the rows of a batch whose key is not in the target yet.

    The inclusive mark re-reads boundary rows, a retry after a lost run re-reads
    everything since the mark, and a source may deliver a key again with a later
    cursor value or none; all are dropped here, so a key lands once and a load may be
    repeated safely. A key can have landed with any cursor value, so the keys, and no
    other column, of the whole target are read. Null keys count as equal.
    """
    spark = batch.sparkSession
    fresh = latest_per_key(batch, key, cursor)
    try:
        landed = spark.read.parquet(target_dir)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    else:
        keys = landed.select(*[F.col(k).alias(f"_landed_{k}") for k in key])
        same = [F.col(k).eqNullSafe(F.col(f"_landed_{k}")) for k in key]
        fresh = fresh.join(keys, same, "left_anti")
    fresh.write.mode("append").parquet(target_dir)


#: Buckets of a new indexed target. An existing one keeps the number it was made with.
BUCKETS = 64
#: Up to so many keys are sought one by one, with the files' Bloom filters.
FEW_KEYS = 10
_BUCKET = "_bucket_of_"


def _bucket_column(df: DataFrame) -> str:
    """The column that names the bucket; its name says how many there are."""
    found = [c for c in df.columns if c.startswith(_BUCKET)]
    if not found:
        raise ValueError("the target has no key index")
    return found[0]


def _in_bucket(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    n = int(name.removeprefix(_BUCKET))
    return df.withColumn(name, F.pmod(F.xxhash64(*key), F.lit(n)).cast("int"))


def read_indexed(spark: SparkSession, target_dir: str) -> DataFrame:
    """An indexed target without its bucket column."""
    landed = spark.read.parquet(target_dir)
    return landed.drop(_bucket_column(landed))


def new_to_indexed(
    batch: DataFrame, target_dir: str, key: Sequence[str], cursor: str | None = None
) -> tuple[DataFrame, str]:
    """The batch's rows whose key the indexed target lacks, and the name of its bucket column.

    One pass over the batch's keys finds the buckets they fall into, their range,
    and, if they are very few, the keys themselves: a bounded number of values. They become
    filters on the target: buckets that the batch does not touch are not listed,
    row groups outside the range are skipped by their statistics, and those without any of a few
    keys by their Bloom filters. Only the keys of what remains are read.
    """
    spark = batch.sparkSession
    fresh = latest_per_key(batch, key, cursor)
    try:
        landed = spark.read.parquet(target_dir)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        name = f"{_BUCKET}{BUCKETS}"
        return _in_bucket(fresh, key, name), name
    name = _bucket_column(landed)
    fresh = _in_bucket(fresh, key, name)
    first = key[0]
    asked = _in_bucket(batch.select(*key), key, name)
    seen = asked.agg(
        F.collect_set(name).alias("buckets"),
        F.min(first).alias("low"),
        F.max(first).alias("high"),
        F.approx_count_distinct(first).alias("keys"),
        F.count_if(F.col(first).isNull()).alias("nulls"),
    ).first()
    landed = landed.filter(F.col(name).isin(seen["buckets"]))
    wanted = F.col(first).between(F.lit(seen["low"]), F.lit(seen["high"]))
    if seen["keys"] <= FEW_KEYS:
        few = asked.select(first).distinct().limit(FEW_KEYS + 1).collect()
        if len(few) <= FEW_KEYS:
            wanted = F.col(first).isin([r[0] for r in few if r[0] is not None])
    if seen["nulls"]:
        wanted = wanted | F.col(first).isNull()
    landed = landed.filter(wanted)
    keys = landed.select(name, *[F.col(k).alias(f"_landed_{k}") for k in key])
    same = [fresh[name] == keys[name]]
    same += [F.col(k).eqNullSafe(F.col(f"_landed_{k}")) for k in key]
    return fresh.join(keys, same, "left_anti"), name


def append_new_indexed(
    batch: DataFrame, target_dir: str, key: Sequence[str], cursor: str | None = None
) -> None:
    """``append_new`` for a target that is laid out in hash buckets of its key.

    A load reads the keys of the buckets that its batch touches, not of the whole target
    (see ``new_to_indexed``). Each bucket is written by one task, sorted by the key, with
    Bloom filters on the key columns.
    """
    fresh, name = new_to_indexed(batch, target_dir, key, cursor)
    writer = fresh.repartition(name).sortWithinPartitions(name, *key).write
    # As large as each file's keys need.
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for k in key:
        writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
    writer.mode("append").partitionBy(name).parquet(target_dir)


def read_mark(spark: SparkSession, state_dir: str, table: str, newest: bool = True) -> Any:
    """The furthest stored mark of a table, or None before the first load.

    Not the last stored one, which a clock that was set back would mistake. With
    ``newest`` false the marks fall, and the furthest is the lowest.
    """
    try:
        state = spark.read.parquet(f"{state_dir}/{table}")
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    furthest = F.max("mark") if newest else F.min("mark")
    return state.agg(furthest.alias("mark")).first()["mark"]


def load_increment(
    source: DataFrame,
    table: str,
    target_dir: str,
    state_dir: str,
    key: Sequence[str],
    cursor: str,
    end: Any = None,
    newest: bool = True,
    append: Callable[[DataFrame, str, Sequence[str], str], None] = append_new,
) -> Any:
    """Append what lies beyond the stored mark, then store the new mark (I-8).

    Data first, mark second: a run lost in between is repeated from the old
    mark and appends nothing twice. With ``newest`` false the load works its way
    back: the mark is the lowest value so far, rows at or below it are loaded, and
    ``end`` is the value above which they must stay. ``append`` may be ``append_new_indexed``.
    """
    spark = source.sparkSession
    last = read_mark(spark, state_dir, table, newest)
    batch = filtered(source, cursor=Cursor(cursor, last=last, end=end, newest=newest))
    if last is None and end is not None:
        batch = batch.filter(F.col(cursor) < end if newest else F.col(cursor) > end)
    append(batch, target_dir, key, cursor)
    # From what has landed, not from the source, which may have grown meanwhile.
    landed = filtered(
        spark.read.parquet(target_dir), cursor=Cursor(cursor, last=last, newest=newest)
    )
    furthest = F.max(cursor) if newest else F.min(cursor)
    mark = landed.agg(furthest.alias("mark")).filter("mark IS NOT NULL")
    mark.select("mark", F.current_timestamp().alias("loaded_at")).write.mode("append").parquet(
        f"{state_dir}/{table}"
    )
    return read_mark(spark, state_dir, table, newest)
