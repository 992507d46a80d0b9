"""The queries of this package: each runs one operator over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from gapledger.llm import lmscore, oracles
from gapledger.llm.bpe import encode_documents
from gapledger.llm.divergence import divergence
from gapledger.llm.fingerprint import fingerprints
from gapledger.llm.langid import identify_held_out
from gapledger.llm.merkle import audit
from gapledger.llm.neardup import near_duplicates
from gapledger.llm.packing import pack_documents
from gapledger.llm.replytrees import conversation_digests, with_hostile
from gapledger.llm.substrings import remove_repeats
from gapledger.llm.topk import search_embeddings
from gapledger.llm.toxicity import score_held_out
from gapledger.llm.warc import archive_and_read


#: Bytes of a batch of rows that is sent to a Python worker.
BATCH_BYTES = 8 << 20


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer file; it is installed at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def find_package(spark: SparkSession) -> None:
    """Lets Python workers find this package where the driver has it, whatever folder they run in.

    On a cluster it is installed on every machine or sent along with the job. Batches that are sent to workers are
    kept to ``BATCH_BYTES``: they hold whole texts, and several copies of one exist at a time.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token pieces of every document and their places in sequences of 4096 tokens."""
    return pack_documents(read(spark, sf_dir, "documents"), vocabulary())


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return encode_documents(read(spark, sf_dir, "documents"), vocabulary())


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how near they are."""
    return fingerprints(read(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and score of every document, learned from the rows that are not held out."""
    return identify_held_out(read(spark, sf_dir, "documents"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best vectors for every query vector."""
    return search_embeddings(read(spark, sf_dir, "embeddings"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the rows that are not held out."""
    return score_held_out(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document."""
    return near_duplicates(read(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as its record in the archives tells."""
    return archive_and_read(spark, read(spark, sf_dir, "pages"))


def op9_lmscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and log-bilinear score of every document."""
    return lmscore.score_held_out(read(spark, sf_dir, "documents"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat a passage of an earlier one, and what is left."""
    return remove_repeats(read(spark, sf_dir, "documents"), texts=False)


def op11_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, and of one that speaks in control strings, read back from its formatted text."""
    return conversation_digests(with_hostile(read(spark, sf_dir, "conversations")))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every two sources of a language, and the terms that set a source apart."""
    return divergence(read(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and verification of every document."""
    return audit(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_bpe": op2_bpe,
    "op3_fingerprint": op3_fingerprint,
    "op4_language": op4_language,
    "op5_topk": op5_topk,
    "op6_toxicity": op6_toxicity,
    "op7_bagminhash": op7_bagminhash,
    "op8_warc": op8_warc,
    "op9_lmscore": op9_lmscore,
    "op10_substrings": op10_substrings,
    "op11_reply_trees": op11_reply_trees,
    "op12_divergence": op12_divergence,
    "op13_merkle": op13_merkle,
}

ORACLES: dict[str, str] = {
    "op11_reply_trees": oracles.CONVERSATIONS,
    "op12_divergence": oracles.DIVERGENCE,
    "op13_merkle": oracles.merkle(),
    "op10_substrings": r"""
        WITH w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
            FROM documents
        ), s AS (
            SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 11, 1))) AS i FROM w
        ), k AS (
            SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM s
        ), f AS (
            SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) < doc_id AS known FROM k
        ), g AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM f WHERE known
        ), n AS (
            SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
               sha256(CASE WHEN gone IS NULL THEN array_to_string(ws, ' ') ELSE coalesce(array_to_string(
                   [ws[j] for j in range(1, len(ws) + 1) if NOT list_contains(gone, j)], ' '), '') END) AS kept_sha256
        FROM w LEFT JOIN n USING (doc_id)
    """,
    "op5_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
}
