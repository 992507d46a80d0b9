import math
from collections import Counter

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from gapledger import constants as C
from gapledger.functions.text import clean_text, sentence_chunks
from gapledger.operators.gold import GOLD_POLICY_COLUMNS, fit_gold, gold_vectors, vector_entries
from gapledger.operators.index import CHUNK, build_index
from gapledger.operators.silver import chunk_rows, silver_policies
from gapledger.plans import medallion as M
from gapledger.sources import bronze as B
from gapledger.sources.shared import new_folder, shared_root
from gapledger.sources.tables import create_database
from gapledger.streaming.silver_stream import append_stream, stream_files


def policies(spark, n=6):
    rows = [
        (f"P{i}", "Lending", f"S{i}", "T", f"Loans number{i} need review. Borrowers must sign item{i}.",
         "2024-01-01", None, "ACTIVE", "now")
        for i in range(n)
    ]
    return B.rows_to_bronze(spark, rows, B.POLICY_SCHEMA)


def test_word_lists(spark):
    assert StopWordsRemover.loadDefaultStopWords("english") == C.ENGLISH_STOPWORDS
    assert len(set(C.INDEX_STOPWORDS)) == len(C.INDEX_STOPWORDS) == 54
    assert len(set(C.BANKING_STOPWORDS)) == len(C.BANKING_STOPWORDS) == 34


def test_bronze_from_table(spark):
    df = spark.createDataFrame([(7, "x")], "id long, body string")
    bronze = B.table_to_bronze(df, B.CIRCULAR_SCHEMA, {"circular_id": "id", "circular_text": "body"})
    assert bronze.columns == list(B.CIRCULAR_COLUMNS)
    assert all(f.dataType.typeName() == "string" for f in bronze.schema.fields)
    row = bronze.first()
    assert (row.circular_id, row.circular_text, row.subject) == ("7", "x", None)
    assert row.ingested_at.startswith("20")


def test_gold_twin_equals_hashed_vectors(spark):
    """With few words and many buckets no two words collide, so the weights agree."""
    silver = silver_policies(policies(spark))
    gold = gold_vectors(fit_gold(silver, 2**18), silver, GOLD_POLICY_COLUMNS)
    assert gold.columns == list(GOLD_POLICY_COLUMNS)
    hashed = vector_entries(gold, "tfidf_features", "chunk_id").collect()
    twin = build_index(silver, "chunk_id", "chunk_text", ("gold-twin",), CHUNK).postings.collect()

    def weights(rows):
        found = {}
        for r in rows:
            found.setdefault(r.chunk_id, []).append(round(r.weight, 9))
        return {k: sorted(v) for k, v in found.items()}

    assert weights(hashed) == weights(twin)
    assert max(r.weight for r in twin) == pytest.approx(math.log(13 / 2))


def test_medallion_tables(spark):
    circulars = B.rows_to_bronze(
        spark,
        [("C1", "R/1", "Sub", "Who", "d", "d", "Review takes fifteen days. Consent is needed.", "Lending", "d", "now")],
        B.CIRCULAR_SCHEMA,
    )
    folder = new_folder(spark, "medallion-test")
    names = M.TableNames(create_database(spark, "medallion_test_" + folder[-8:], folder))
    for _ in range(2):  # a second run replaces the first
        M.run_bronze(policies(spark), circulars, names)
        silver = M.run_silver(spark, names)
        gold = M.run_gold(spark, names)
    assert [t.count() for t in silver] == [12, 2]
    assert [t.count() for t in gold] == [12, 2]
    assert gold[1].first().tfidf_features.size == C.HASH_FEATURES
    assert names.of("gold", "rbi") == f"{names.database}.gold_rbi"


def test_stream_equals_batch_and_continues(spark, tmp_path):
    schema = "doc_id long, text string"
    folder = tmp_path / "in"

    def add(start):
        rows = [(i, f"First sentence {i} here. <b>Second</b> one {i} there.") for i in range(start, start + 3)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))

    def chunks(rows):
        return chunk_rows(rows, ["doc_id"], sentence_chunks(clean_text(F.col("text"))), "t")

    read_schema = spark.createDataFrame([], schema).schema
    for start in (0, 3):
        add(start)
        rows = stream_files(spark, str(folder), read_schema, files_per_batch=1)
        append_stream(rows, chunks, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        streamed = Counter(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
        batch = Counter(map(tuple, chunks(spark.read.parquet(str(folder))).collect()))
        assert streamed == batch


def test_shared_root_comes_from_the_session(spark):
    given = spark.conf.get("spark.checkpoint.dir", None)
    root = shared_root(spark)
    assert root == given.rstrip("/") if given else root
