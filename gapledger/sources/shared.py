"""Tables that a job writes once and reads several times, in the cluster's shared folder.

Spark may recompute a DataFrame each time it is used; an index that three later joins
read is cheaper written once. Written files also survive the loss of any executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
#: Bytes of a row group of a table that is written once: what a writing task buffers.
ROW_GROUP = 32 << 20
_local_root: dict[str, str] = {}
_databases: dict[str, str] = {}
_built: dict[tuple, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one in local mode only."""
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="gapledger-")
    return _local_root[app]


def new_folder(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/gapledger/{app}/{name}-{uuid.uuid4().hex}"


def write_once(name: str, df: DataFrame) -> DataFrame:
    """Write ``df`` to a new shared folder and read it from there."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _database(spark: SparkSession) -> str:
    """A database of this application whose tables lie in the shared folder."""
    app = spark.sparkContext.applicationId
    if app not in _databases:
        folder = new_folder(spark, "tables")
        name = "gapledger_" + folder.rpartition("-")[2]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{folder}'")
        _databases[app] = name
    return _databases[app]


def build_once(
    spark: SparkSession,
    key: tuple,
    name: str,
    make: Callable[[], DataFrame],
    bucket_by: str | None = None,
    buckets: int = 0,
    sort_by: str | None = None,
    options: dict[str, str | int] | None = None,
) -> DataFrame:
    """Write a table on the first call with ``key`` in this application, read it later.

    With ``bucket_by`` the rows of one value lie in one bucket, so later joins and
    aggregations by that column need no shuffle; with ``sort_by`` a bucket's file is in that order, so that
    a scan with bounds on it skips pages. The caller's key has to tell inputs
    and parameters apart; ``forget`` drops it when an input has changed.
    """
    key = (spark.sparkContext.applicationId, name, *key)
    if key not in _built:
        table = f"{_database(spark)}.{name}_{uuid.uuid4().hex}"
        writer = make().write.format("parquet").options(**(options or {}))
        if bucket_by:
            writer = writer.bucketBy(buckets, bucket_by)
        if sort_by:
            writer = writer.sortBy(sort_by)
        writer.saveAsTable(table)
        _built[key] = table
    return spark.table(_built[key])


def forget(*key) -> None:
    """Make ``build_once`` build anew whatever was built under a key that starts so."""
    for known in [k for k in _built if k[2 : 2 + len(key)] == key]:
        del _built[known]
