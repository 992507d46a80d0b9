"""Silver chunks of files as they arrive. Stateless, so there is no state to grow."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def stream_files(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files matching ``path``; each is read once, new ones as they appear."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def append_stream(
    rows: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append ``transform(rows)`` to ``out`` until all files present are done.

    ``checkpoint`` remembers finished files, so a restarted job goes on where it was.
    """
    return (
        transform(rows)
        .writeStream.format(fmt)
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
