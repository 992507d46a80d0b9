"""Reading and writing tables by folder or by catalog name."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Formats whose own overwrite leaves readers whole.
ATOMIC = ("delta", "iceberg")


def read_folder(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def create_database(spark: SparkSession, name: str, folder: str) -> str:
    """A database whose managed tables live under ``folder``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{folder}'")
    return name


def save_table(df: DataFrame, name: str, fmt: str = "parquet", keep: int = 2) -> DataFrame:
    """Replace the table ``name`` (database.table) and return a scan of it.

    The rows are written beside the old ones as a table of their own; ``name`` is a view that is turned to it when all is
    written. A job that fails leaves the old rows as they were, jobs that read them go on, ``df`` may
    read ``name`` itself, and columns may change. The newest ``keep`` versions stay, older ones are dropped.
    A format that replaces tables atomically itself is left to do so.
    """
    spark = df.sparkSession
    if fmt in ATOMIC:
        df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)
        return spark.table(name)
    database, _, table = name.rpartition(".")
    inside = f"`{database}`." if database else ""
    older = _versions(spark, database, table)
    number = 1 + max((int(v[len(table) + 3 :][:6]) for v in older), default=0)
    new = f"{table}__v{number:06d}_{uuid.uuid4().hex[:8]}"
    df.write.format(fmt).saveAsTable(f"{inside}`{new}`")
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        # a plain table of that name becomes a version too
        first = f"{table}__v000000_{uuid.uuid4().hex[:8]}"
        spark.sql(f"ALTER TABLE {inside}`{table}` RENAME TO {inside}`{first}`")
        older.insert(0, first)
    spark.sql(f"CREATE OR REPLACE VIEW {inside}`{table}` AS SELECT * FROM {inside}`{new}`")
    for old in [*older, new][: -max(keep, 1)]:
        spark.sql(f"DROP TABLE IF EXISTS {inside}`{old}`")
    return spark.table(name)


def _versions(spark: SparkSession, database: str, table: str) -> list[str]:
    """The tables that ``save_table`` wrote for a name, from the oldest on."""
    where = f" IN `{database}`" if database else ""
    found = [r.tableName for r in spark.sql(f"SHOW TABLES{where} LIKE '{table.lower()}__v*'").collect()]
    return sorted(t for t in found if re.fullmatch(rf"{re.escape(table.lower())}__v\d{{6}}_[0-9a-f]{{8}}", t.lower()))


def load_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
