"""An index that outlives its application and follows its documents.

A folder holds segments, versions and what was derived from them. A segment has the term counts and digests of the
documents that one change added, and the ids that it took away or replaced (tombstones); it is never
written again. A version lists its segments; it is one small file, written last, so a change that fails leaves the
version before it. A change thus writes in proportion to what changed, and old text is never read again.

Weights follow from the counts of all live documents: N, document frequencies and norms change with every
document. They are derived when a version is first opened and kept for later openings. ``merge_segments``
folds segments into one when there have come to be many. One application changes a folder at a time.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from gapledger.operators.index import (
    CHUNK,
    DOCUMENT,
    DOCUMENT_ALL_WORDS,
    HOT_TERMS,
    POSTING_FILES,
    SHARD_ROWS,
    Index,
    Scheme,
    bucket_count,
    read_postings,
    term_frequency,
    term_table,
    unit_postings,
    weigh,
)

SCHEMES = {s.name: s for s in (DOCUMENT, DOCUMENT_ALL_WORDS, CHUNK)}
VERSIONS = "version long, scheme string, doc_id string, text string, domain string, segments array<string>"
DERIVED = (
    "version long, path string, n_docs long, digest string, buckets int, postings_schema string"
)


def _digest(doc_id: str, text: str):
    return F.xxhash64(doc_id, text)


def fingerprint(corpus: DataFrame, doc_id: str, text: str) -> tuple[int, str]:
    """Number of rows, and a digest of ids and texts that does not depend on their order."""
    return _summed(corpus.select(_digest(doc_id, text).alias("digest")))


def _summed(digests: DataFrame) -> tuple[int, str]:
    total = F.sum(F.col("digest").cast("decimal(38,0)")).cast("string")
    row = digests.agg(F.count("*").alias("n"), total.alias("d")).first()
    return row.n, row.d or "0"


def save_index(
    corpus: DataFrame, doc_id: str, text: str, folder: str, scheme: Scheme = DOCUMENT,
    domain: str | None = None,
) -> None:
    """Index ``corpus`` into ``folder``, which must not exist yet."""
    meta = Row(scheme=scheme.name, doc_id=doc_id, text=text, domain=domain)
    spark = corpus.sparkSession
    name = _write_segment(folder, 0, meta, corpus, corpus.select(doc_id).limit(0))
    _commit(spark, folder, 0, meta, [name])


def append_documents(spark: SparkSession, folder: str, new: DataFrame) -> None:
    """Add documents as a segment; ids that the index has already are refused (see ``update_documents``)."""
    m = _newest(spark, folder)
    known = _live(spark, folder, m, "docs").join(new.select(m.doc_id).distinct(), m.doc_id, "left_semi")
    some = [r[0] for r in known.select(m.doc_id).limit(5).collect()]
    if some:
        raise ValueError(f"{folder} has documents {some} already; update_documents replaces them")
    _add(spark, folder, m, new, new.select(m.doc_id).limit(0))


def update_documents(
    spark: SparkSession, folder: str, changed: DataFrame | None = None, removed: DataFrame | None = None
) -> None:
    """Add or replace the documents of ``changed`` and take out those whose ids ``removed`` holds."""
    m = _newest(spark, folder)
    gone = [df.select(m.doc_id) for df in (changed, removed) if df is not None]
    if not gone:
        return
    _add(spark, folder, m, changed, reduce(DataFrame.union, gone).distinct())


def merge_segments(spark: SparkSession, folder: str) -> None:
    """Fold all segments into one without the documents that are gone; the index stays the same."""
    m = _newest(spark, folder)
    name = f"{m.version + 1:06d}-{uuid.uuid4().hex}"
    for table in ("docs", "counts"):
        _live(spark, folder, m, table).write.parquet(f"{folder}/segments/{name}/{table}")
    nothing = spark.read.parquet(f"{folder}/segments/{name}/docs").select(m.doc_id).limit(0)
    nothing.write.parquet(f"{folder}/segments/{name}/gone")
    _commit(spark, folder, m.version + 1, m, [name])


def segments(spark: SparkSession, folder: str) -> list[str]:
    """Names of the newest version's segments, from the oldest on."""
    return list(_newest(spark, folder).segments)


def open_index(
    spark: SparkSession, folder: str, corpus: DataFrame, check: bool = True
) -> Index:
    """The index in ``folder``. ``corpus`` gives records and texts of hits; it is read once to refuse one
    that differs from what was indexed, unless ``check`` is off."""
    m = _newest(spark, folder)
    d = _derived(spark, folder, m)
    if check and fingerprint(corpus, m.doc_id, m.text) != (d.n_docs, d.digest):
        raise ValueError(f"{folder} was made from other documents")
    name = f"gapledger_postings_{uuid.uuid4().hex}"
    # the bucketing is in the files' names; a table entry of this application tells Spark so
    spark.sql(
        f"CREATE TABLE {name} ({d.postings_schema}) USING parquet "
        f"CLUSTERED BY (`{m.doc_id}`) INTO {d.buckets} BUCKETS LOCATION '{d.path}/postings'"
    )
    return Index(
        corpus, m.doc_id, m.text, SCHEMES[m.scheme], spark.read.parquet(f"{d.path}/terms"),
        read_postings(spark.table(name), m.doc_id, SCHEMES[m.scheme]), d.buckets, _live(spark, folder, m, "counts"), m.domain,
        ("stored", d.path),
    )


def _newest(spark: SparkSession, folder: str) -> Row:
    return spark.read.schema(VERSIONS).json(f"{folder}/versions").orderBy(F.desc("version")).first()


def _commit(spark: SparkSession, folder: str, version: int, meta: Row, names: list[str]) -> None:
    row = (version, meta.scheme, meta.doc_id, meta.text, meta.domain, names)
    spark.createDataFrame([row], VERSIONS).coalesce(1).write.mode("append").json(f"{folder}/versions")


def _add(spark: SparkSession, folder: str, m: Row, rows: DataFrame | None, gone: DataFrame) -> None:
    if rows is None:
        rows = spark.createDataFrame([], f"`{m.doc_id}` string, `{m.text}` string").select(
            F.col(m.doc_id).cast(gone.schema[m.doc_id].dataType), m.text,
            *([F.lit(None).cast("string").alias(m.domain)] if m.domain else []),
        )
    name = _write_segment(folder, m.version + 1, m, rows, gone)
    _commit(spark, folder, m.version + 1, m, [*m.segments, name])


def _write_segment(folder: str, version: int, m: Row, rows: DataFrame, gone: DataFrame) -> str:
    """A new segment's documents, counts and tombstones; its name differs for each attempt."""
    name = f"{version:06d}-{uuid.uuid4().hex}"
    path, carry = f"{folder}/segments/{name}", (m.domain,) if m.domain else ()
    docs = rows.select(m.doc_id, m.text, *carry)
    docs.select(m.doc_id, _digest(m.doc_id, m.text).alias("digest")).write.parquet(f"{path}/docs")
    counts = term_frequency(docs, m.doc_id, m.text, SCHEMES[m.scheme], carry)
    counts.write.parquet(f"{path}/counts")
    gone.write.parquet(f"{path}/gone")
    return name


def _live(spark: SparkSession, folder: str, m: Row, table: str) -> DataFrame:
    """Rows of all segments but for documents that a later segment replaced or took away."""

    def every(of: str) -> DataFrame:
        parts = [
            spark.read.parquet(f"{folder}/segments/{s}/{of}").withColumn("segment", F.lit(i))
            for i, s in enumerate(m.segments)
        ]
        return reduce(DataFrame.unionByName, parts)

    rows = every(table)
    if len(m.segments) > 1:
        last = every("gone").groupBy(m.doc_id).agg(F.max("segment").alias("gone"))
        # a segment's own documents come after its tombstones
        rows = rows.join(last, m.doc_id, "left").where("gone IS NULL OR segment >= gone").drop("gone")
    return rows.drop("segment")


def _derived(spark: SparkSession, folder: str, m: Row) -> Row:
    """Where the terms and postings of a version lie; made if they are not there yet."""
    try:
        known = spark.read.schema(DERIVED).json(f"{folder}/derived_log").where(F.col("version") == m.version).first()
    except AnalysisException:
        known = None
    return known or _derive(spark, folder, m)


def _derive(spark: SparkSession, folder: str, m: Row) -> Row:
    path = f"{folder}/derived/{m.version:06d}-{uuid.uuid4().hex}"
    counts = _live(spark, folder, m, "counts")
    n_docs, digest = _summed(_live(spark, folder, m, "docs"))
    term_table(counts, F.lit(n_docs), SCHEMES[m.scheme], SHARD_ROWS).write.parquet(f"{path}/terms")
    terms = spark.read.parquet(f"{path}/terms")
    buckets = bucket_count(terms)
    scheme = SCHEMES[m.scheme]
    postings = unit_postings(weigh(counts, terms, HOT_TERMS), m.doc_id, buckets, scheme, F.lit(n_docs))
    name = f"gapledger_saved_{uuid.uuid4().hex}"
    writer = postings.write.format("parquet").options(**POSTING_FILES).bucketBy(buckets, m.doc_id)
    writer.sortBy("term_hash").option("path", f"{path}/postings").saveAsTable(name)
    fields = spark.table(name).schema.fields
    # an external table: its entry goes, its files stay
    spark.sql(f"DROP TABLE {name}")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    row = spark.createDataFrame([(m.version, path, n_docs, digest, buckets, schema)], DERIVED)
    row.coalesce(1).write.mode("append").json(f"{folder}/derived_log")
    return row.first()
