"""A table derived row by row from another one, kept up to date by the rows that changed.

A folder holds runs. Each run compares the source with what was derived before, by a digest per key, and writes the
keys that are new, changed or gone with their digests, and the rows derived from the new and changed ones; nothing older
is written again. What a run wrote counts once its line in the log stands, which is written last, so a run that fails
is as if it had not been. Bronze → silver and silver → gold are both kept this way: with a fitted gold model only
the chunks of changed documents get vectors anew.

The source is read and shuffled as digests; its texts are read again only for changed keys.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from gapledger.operators.gold import GOLD_POLICY_COLUMNS, gold_vectors
from gapledger.operators.silver import silver_policies

LOG = "run long, path string, changed long, gone long"


def digests(rows: DataFrame, key: str) -> DataFrame:
    """A digest of all rows of a key, in whatever order: two sums of hashes and a count, combined map-side.

    Null keys form one key. Columns may come in any order; a column that is added changes the digests of the rows that
    have a value in it.
    """
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(rows.columns)]))

    def total(hashed: Column) -> Column:
        return F.sum(hashed.cast("decimal(38,0)")).cast("string")

    hashed = rows.select(F.col(key), F.xxhash64(whole).alias("a"), F.xxhash64(whole, F.lit(1)).alias("b"))
    return hashed.groupBy(key).agg(
        F.concat_ws(" ", F.count(F.lit(1)).cast("string"), total(F.col("a")), total(F.col("b"))).alias("digest")
    )


def runs(spark: SparkSession, folder: str) -> list[Row]:
    """The finished runs with their numbers of changed and gone keys, from the oldest on."""
    try:
        return spark.read.schema(LOG).json(f"{folder}/log").orderBy("run").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []  # nothing was derived yet


def _parts(spark: SparkSession, done: list[Row], table: str) -> DataFrame:
    parts = [spark.read.parquet(f"{r.path}/{table}").withColumn("run_", F.lit(r.run)) for r in done]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _state(spark: SparkSession, done: list[Row], key: str) -> DataFrame:
    """The newest run that names a key, and the digest that it has there (null: gone)."""
    newest = F.max(F.struct("run_", "digest")).alias("newest")
    return _parts(spark, done, "keys").groupBy(key).agg(newest).select(key, "newest.*")


def refresh(rows: DataFrame, key: str, make: Callable[[DataFrame], DataFrame], folder: str) -> DataFrame:
    """Bring what ``make`` derives from ``rows`` up to date in ``folder``, and return it.

    ``make`` must keep ``key`` and derive a key's rows from that key's rows alone. The first run derives everything; one
    that finds nothing changed writes nothing. One application changes a folder at a time.
    """
    spark = rows.sparkSession
    done, now = runs(spark, folder), digests(rows, key)
    number = done[-1].run + 1 if done else 0
    path = f"{folder}/runs/{number:06d}-{uuid.uuid4().hex}"
    if done:
        before = _state(spark, done, key).where("digest IS NOT NULL").select(
            F.col(key).alias("key_"), F.col("digest").alias("digest_")
        )
        both = now.join(before, F.col(key).eqNullSafe(F.col("key_")), "full_outer")
        differs = both.where(~F.col("digest").eqNullSafe(F.col("digest_")))
        now = differs.select(
            F.when(F.col("digest").isNull(), F.col("key_")).otherwise(F.col(key)).alias(key), "digest"
        )
    now.write.parquet(f"{path}/keys")
    keys = spark.read.parquet(f"{path}/keys")
    counts = keys.agg(F.count("digest").alias("changed"), F.count(F.lit(1)).alias("all")).first()
    if done and not counts.all:
        return derived(spark, folder, key)
    wanted = rows
    if done:
        changed = keys.where("digest IS NOT NULL").select(F.col(key).alias("key_"))
        wanted = rows.join(changed, F.col(key).eqNullSafe(F.col("key_")), "left_semi")
    make(wanted).write.parquet(f"{path}/rows")
    line = [(number, path, counts.changed, counts.all - counts.changed)]
    spark.createDataFrame(line, LOG).coalesce(1).write.mode("append").json(f"{folder}/log")
    return derived(spark, folder, key)


def derived(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """The derived rows as the last finished run left them.

    Rows that a later run replaced or took away are left out by a join with the keys of the later
    runs alone: the first run's keys, which are all, are not among them.
    """
    done = runs(spark, folder)
    if not done:
        raise ValueError(f"nothing was derived in {folder}")
    rows = _parts(spark, done, "rows")
    if len(done) == 1:
        return rows.drop("run_")
    last = _parts(spark, done[1:], "keys").groupBy(F.col(key).alias("key_")).agg(F.max("run_").alias("last_"))
    stale = F.col(key).eqNullSafe(F.col("key_")) & (F.col("run_") < F.col("last_"))
    return rows.join(last, stale, "left_anti").drop("run_")


def merge_runs(spark: SparkSession, folder: str, key: str, to: str) -> None:
    """Write a folder's present rows and keys into the new folder ``to`` as one run."""
    done = runs(spark, folder)
    path = f"{to}/runs/000000-{uuid.uuid4().hex}"
    _state(spark, done, key).where("digest IS NOT NULL").drop("run_").write.parquet(f"{path}/keys")
    derived(spark, folder, key).write.parquet(f"{path}/rows")
    n = spark.read.parquet(f"{path}/keys").count()
    spark.createDataFrame([(0, path, n, 0)], LOG).coalesce(1).write.json(f"{to}/log")


def refresh_silver(bronze: DataFrame, folder: str) -> DataFrame:
    """Silver chunks of the policies that changed since the last run. A new time of ingestion is no change."""
    return refresh(bronze.drop("ingested_at"), "policy_id", silver_policies, folder)


def refresh_gold(silver: DataFrame, model, folder: str) -> DataFrame:
    """Gold vectors, under a kept model, of the policies whose chunks changed since the last run."""
    return refresh(silver, "policy_id", lambda rows: gold_vectors(model, rows, GOLD_POLICY_COLUMNS), folder)
