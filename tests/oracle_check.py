"""Run registered queries and their SQL side by side: python tests/oracle_check.py [folder] [names]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(v: object) -> object:
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def normal_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark_df, con: duckdb.DuckDBPyConnection, text: str) -> str | None:
    """None if both sides agree, else the first difference."""
    result = con.execute(text)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    theirs = normal_rows(names, result.fetchall())
    ours = normal_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    odd = {
        c: (t, types[c]) for c, t in spark_df.dtypes if t in kinds and kinds[t] != types[c]
    }
    if odd:
        return f"types {odd}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} rows differ, such as {wrong[0][0]} against {wrong[0][1]}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from freightlens.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, texts, bad = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if (chosen and name not in chosen) or name not in texts:
            continue
        start = time.time()
        try:
            found = difference(run(spark, folder), con, texts[name])
        except Exception as e:  # noqa: BLE001
            found = f"{type(e).__name__}: {str(e)[:700]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.1f}s {found or ''}")
    print(f"{bad} differ")
