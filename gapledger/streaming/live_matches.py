"""Circulars matched against a stored index as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gapledger import constants as C
from gapledger.operators.index import Index
from gapledger.plans.gap_analysis import gap_matches
from gapledger.sources.shared import new_folder

DIGEST = "circular_digest"


def match_stream(
    circulars: DataFrame, index: Index, key: str, text: str, record_columns: list[str],
    out: str, checkpoint: str, k: int = C.PANEL_K, arrival: str | None = None, delay: str = "7 days",
) -> StreamingQuery:
    """Write the matches of every circular of the stream ``circulars`` to ``out``, until all present ones are done.

    A circular that is delivered again with the same text is dropped by the stream's state; one whose text has
    changed is matched again (see ``newest_matches``). The state keeps a digest per circular; with ``arrival``, a
    timestamp column, only of those that came within ``delay``. A batch's matches replace what an earlier
    attempt at the same batch wrote, so a restart neither loses nor repeats a match.
    """
    spark = index.corpus.sparkSession
    rows = circulars.withColumn(DIGEST, F.sha2(F.to_json(F.struct(F.col(key), F.col(text))), 256))
    if arrival is None:
        new = rows.dropDuplicates([DIGEST])
    else:
        new = rows.withWatermark(arrival, delay).dropDuplicatesWithinWatermark([DIGEST])

    def matched(batch: DataFrame, batch_id: int) -> None:
        # written first: the search reads it several times, and is planned as a batch job of its own
        path = new_folder(spark, "arrived")
        batch.drop(DIGEST).write.parquet(path)
        arrived = spark.read.schema(batch.drop(DIGEST).schema).parquet(path)
        # of one circular that comes with several texts at once the first stays, in the order of the texts
        once = arrived.groupBy(key).agg(F.min(text).alias(text))
        hits = gap_matches(index, once, key, text, record_columns, k)
        hits.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        new.writeStream.foreachBatch(matched)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def newest_matches(spark: SparkSession, out: str, key: str) -> DataFrame:
    """The matches of each circular's newest text."""
    rows = spark.read.parquet(out)
    newest = F.max("batch").over(Window.partitionBy(key))
    return rows.withColumn("newest_", newest).where(F.col("batch") == F.col("newest_")).drop("newest_", "batch")
