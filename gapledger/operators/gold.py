"""Gold vectors: hashed TF-IDF of silver chunks with Spark MLlib, one model per table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, ElementwiseProduct, HashingTF, RegexTokenizer, StopWordsRemover
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapledger import constants as C

GOLD_POLICY_COLUMNS = (
    "chunk_id", "policy_id", "domain", "section", "title",
    "source_type", "chunk_text", "tfidf_features",
)
GOLD_CIRCULAR_COLUMNS = (
    "chunk_id", "circular_id", "circular_ref", "subject", "category",
    "source_type", "chunk_text", "tfidf_features",
)


def gold_pipeline(
    num_features: int = C.HASH_FEATURES, stopwords: Iterable[str] | None = None
) -> Pipeline:
    """Tokens → stop words out → hashed counts → IDF weights, unfitted.

    Take 2**18 features or more for a real vocabulary; the default is the fixed width.
    """
    words = [*C.ENGLISH_STOPWORDS, *C.BANKING_STOPWORDS] if stopwords is None else list(stopwords)
    return Pipeline(
        stages=[
            RegexTokenizer(
                inputCol="chunk_text", outputCol="tokens_raw", pattern="\\W",
                minTokenLength=C.MIN_TOKEN_LENGTH, toLowercase=True,
            ),
            StopWordsRemover(inputCol="tokens_raw", outputCol="tokens", stopWords=words),
            HashingTF(inputCol="tokens", outputCol="raw_features", numFeatures=num_features),
            IDF(inputCol="raw_features", outputCol="tfidf_features", minDocFreq=1),
        ]
    )


def fit_gold(silver: DataFrame, num_features: int = C.HASH_FEATURES) -> PipelineModel:
    """Fit on one silver table. The model is one number per feature, whatever the rows."""
    return gold_pipeline(num_features).fit(silver)


def gold_vectors(model: PipelineModel, silver: DataFrame, columns: Iterable[str]) -> DataFrame:
    return model.transform(silver).select(*columns)


def tokens_only(silver: DataFrame) -> DataFrame:
    """The first two stages, which need no fitting."""
    tokenizer, remover = gold_pipeline().getStages()[:2]
    return remover.transform(tokenizer.transform(silver))


def hashed_counts(silver: DataFrame, num_features: int = C.HASH_FEATURES) -> DataFrame:
    """The first three stages, which need no fitting."""
    return gold_pipeline(num_features).getStages()[2].transform(tokens_only(silver))


def vector_entries(df: DataFrame, vector: str, *keys: str) -> DataFrame:
    """The stored entries of a sparse vector column as rows (bucket, weight)."""
    sparse = F.unwrap_udt(F.col(vector))
    return df.select(
        *keys,
        F.inline(
            F.arrays_zip(
                sparse["indices"].alias("bucket"), sparse["values"].alias("weight")
            )
        ),
    )


def learn_chunks(silver: DataFrame, folder: str, num_features: int = C.HASH_FEATURES) -> None:
    """Add the document frequencies of new chunks to the model kept in ``folder``; the first call makes it.

    A batch is one row per feature that occurs and a row without feature for the number of chunks: old chunks are not
    read again. A batch is committed as a whole; give the same chunks once only.
    """
    counts = hashed_counts(silver, num_features).select(F.unwrap_udt("raw_features")["indices"].alias("buckets"))
    chunk = F.array(F.lit(None).cast("int"))
    rows = counts.select(F.explode(F.concat("buckets", chunk)).alias("bucket")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("df")
    )
    rows.withColumn("features", F.lit(num_features)).repartition(1).write.mode("append").parquet(folder)


def kept_model(spark: SparkSession, folder: str) -> PipelineModel:
    """The gold model of all chunks learned in ``folder``: same vectors as fitted on them at once.

    One number per feature is fetched, as fitting does. Features that no chunk had weigh 0.
    """
    stored = spark.read.parquet(folder)
    widths = [r.features for r in stored.select("features").distinct().limit(2).collect()]
    if len(widths) != 1:
        raise ValueError(f"{folder} has no chunks, or batches of different numbers of features")
    known = stored.groupBy("bucket").agg(F.sum("df").alias("df"))
    n = known.where("bucket IS NULL").first().df
    idf = F.log((F.lit(n) + 1) / (F.col("df") + 1))
    weights = known.where("bucket IS NOT NULL").select("bucket", idf.alias("idf")).collect()
    scale = Vectors.sparse(widths[0], {r.bucket: r.idf for r in weights}).toArray()
    stages = gold_pipeline(widths[0]).getStages()[:3]
    weigh = ElementwiseProduct(
        scalingVec=Vectors.dense(scale), inputCol="raw_features", outputCol="tfidf_features"
    )
    return PipelineModel([*stages, weigh])
