"""Compare registered queries with their DuckDB statements: rows, columns, types, values.

Usage: python tests/parity.py [scale] [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

NUMBERS = ("TINYINT", "SMALLINT", "INTEGER", "BIGINT")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def spark_rows(df) -> tuple[dict[str, str], list[tuple]]:
    names = sorted(df.columns)
    kinds = {"bigint": "whole", "double": "double", "string": "text", "boolean": "boolean"}
    types = {f.name: kinds.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    return types, sorted((tuple(r) for r in df.select(*names).collect()), key=_key)


def duck_rows(con, sql: str) -> tuple[dict[str, str], list[tuple]]:
    rel = con.sql(sql)
    kinds = {"DOUBLE": "double", "VARCHAR": "text", "BOOLEAN": "boolean", **dict.fromkeys(NUMBERS, "whole")}
    types = {n: kinds.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)}
    order = [rel.columns.index(n) for n in sorted(rel.columns)]
    return types, sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=_key)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a description of the first difference."""
    spark_types, ours = spark_rows(df)
    duck_types, theirs = duck_rows(con, sql)
    if spark_types != duck_types:
        only = {k: (spark_types.get(k), duck_types.get(k)) for k in spark_types.keys() | duck_types.keys()
                if spark_types.get(k) != duck_types.get(k)}
        return f"types (spark, duckdb): {only}"
    if len(ours) != len(theirs):
        return f"rows: spark {len(ours)}, duckdb {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if bad:
        a, b = bad[0]
        cells = [(n, x, y) for n, x, y in zip(sorted(spark_types), a, b) if x != y]
        return f"{len(bad)} of {len(ours)} rows differ, first: {cells[:4]}"
    if any(isinstance(x, float) and math.isnan(x) for r in ours for x in r):
        return "NaN in result"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{scale}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, statements, failed = connect(folder), oracle_sql(), 0
    for name, query in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            problem = difference(df, con, statements[name]) if name in statements else f"no statement, {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("differences:", failed)
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main())
