"""Bronze tables: policies and circulars as they arrive, every column a string."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

POLICY_COLUMNS = (
    "policy_id", "domain", "section", "title", "policy_text",
    "effective_date", "last_reviewed", "status", "ingested_at",
)
CIRCULAR_COLUMNS = (
    "circular_id", "circular_ref", "subject", "issued_by", "issued_date",
    "effective_date", "circular_text", "category", "compliance_deadline", "ingested_at",
)


def _strings(names: Iterable[str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


POLICY_SCHEMA = _strings(POLICY_COLUMNS)
CIRCULAR_SCHEMA = _strings(CIRCULAR_COLUMNS)


def now_stamp() -> str:
    """UTC time as ISO text; take it once per run so that all rows share it."""
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat()


def rows_to_bronze(spark: SparkSession, rows: Iterable, schema: StructType) -> DataFrame:
    """A bronze table from rows in memory."""
    return spark.createDataFrame(list(rows), schema)


def table_to_bronze(
    df: DataFrame,
    schema: StructType,
    mapping: Mapping[str, str | Column],
    ingested_at: str | None = None,
) -> DataFrame:
    """A bronze table from any table: bronze column → source column or expression.

    Bronze columns without a source are null. A projection only, so the scan reads
    no more than the mapped columns.
    """
    stamp = F.lit(ingested_at or now_stamp())

    def column(name: str) -> Column:
        if name == "ingested_at" and name not in mapping:
            return stamp.alias(name)
        source = mapping.get(name)
        if source is None:
            return F.lit(None).cast("string").alias(name)
        source = F.col(source) if isinstance(source, str) else source
        return source.cast("string").alias(name)

    return df.select(*[column(field.name) for field in schema.fields])


def with_dates(df: DataFrame, *columns: str) -> DataFrame:
    """Typed twins (``<name>_date``) of ISO date columns; text that is no date gives null."""
    return df.withColumns({f"{c}_date": F.try_to_date(F.col(c), "yyyy-MM-dd") for c in columns})
