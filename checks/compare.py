"""Run every query and its DuckDB twin side by side and report differences.

    python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

SPARK_TYPES = {
    "INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string",
    "DOUBLE": "double", "BOOLEAN": "boolean",
}


def local_session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{folder}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def plain(value):
        if value is None or (isinstance(value, float) and value != value):
            return ""
        if hasattr(value, "item"):
            value = value.item()
        if isinstance(value, float):
            return f"{value:.6f}"
        return str(value)

    return sorted(tuple(plain(v) for v in row) for row in frame.itertuples(index=False))


def type_difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[tuple]:
    """Columns whose types are not the counterparts of each other."""
    described = con.execute("DESCRIBE " + sql).fetchall()
    expected = sorted((name, SPARK_TYPES.get(kind, kind)) for name, kind, *_ in described)
    actual = sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    return [pair for pair in zip(actual, expected) if pair[0] != pair[1]]


def difference(actual: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(actual.columns)} != {sorted(expected.columns)}"
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    left, right = _rows(actual), _rows(expected)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if not wrong:
        return None
    first = [(x[:200], y[:200]) for x, y in zip(*wrong[0]) if x != y]
    return f"{len(wrong)} rows differ, first: {first}"


def main() -> int:
    from checks.oracles import ORACLES
    from checks.queries import QUERIES

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(), duck(folder)
    bad = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            actual = QUERIES[name](spark, folder).toPandas()
            took = time.time() - start
            if name not in ORACLES:
                result = None
                note = "no oracle"
            else:
                result = difference(actual, con.execute(ORACLES[name]).df())
                note = "same"
        except Exception as error:
            took, actual = time.time() - start, []
            result = f"{type(error).__name__}: {str(error)[:600]}"
        bad += result is not None
        print(f"{name:24} {took:6.1f}s {len(actual):8} {result or note}", flush=True)
    print(f"{bad} of {len(sys.argv[2:] or QUERIES)} wrong")
    return bad


if __name__ == "__main__":
    sys.exit(main())
