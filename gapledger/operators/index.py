"""Exact-term TF-IDF index: term counts, document frequencies, weights, norms, query vectors.

Two weightings share the code (see ``Scheme``). An index is three tables written once:

``counts``    one row per (document, term): count and TF
``terms``     term → df, idf, number of shards
``postings``  one row per (document, term), from which its weight is read; bucketed by document

and the searched table itself, untouched.

How the parts behave on a large corpus:

* Term counts come from one row each (no shuffle).
* Document frequencies combine on the map side, so a word found everywhere sends one
  row per task.
* Weights need a document frequency per posting. Words that make up most postings are
  few: at most ``HOT_TERMS`` words can each hold 1/HOT_TERMS of all postings, so that
  part of the table has a fixed size and is broadcast. Only the rare words' postings
  are shuffled, and none of those words is frequent enough to overload a task.
* Norms need a document's postings together: one shuffle by document, into the buckets
  that the table is written in, so that scoring by document shuffles nothing more.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from gapledger.functions.text import ascii_tokens, bind, term_counts, word_tokens
from gapledger.sources.shared import build_once

# No more terms than this are ever broadcast: a term is hot if it holds at least
# this fraction of all postings, and only that many terms can.
HOT_TERMS = 200_000
# Postings of one term that may share a join key during retrieval.
SHARD_ROWS = 1_000_000
# Levels of prefix norms, two per halving; smaller ones share the last level.
LEVELS = 12
# Postings per bucket aimed at, and Spark's own limit on buckets.
BUCKET_ROWS = 1_000_000
MAX_BUCKETS = 100_000
# How postings are written: small pages, so that a scan for few terms skips most of them.
POSTING_FILES = {"parquet.page.row.count.limit": 2_048}


@dataclass(frozen=True)
class Scheme:
    """How tokens become weights."""

    name: str
    tokens: Callable[[Column], Column]
    tf: Callable[[Column, Column], Column]
    idf: Callable[[Column, Column], Column]


# Whole documents: share of the document's tokens, ln(N / df).
DOCUMENT = Scheme(
    "document",
    word_tokens,
    lambda count, size: count / size,
    lambda n, df: F.ln(n / df),
)
DOCUMENT_ALL_WORDS = Scheme(
    "document_all_words",
    lambda text: word_tokens(text, stopwords=()),
    DOCUMENT.tf,
    DOCUMENT.idf,
)
# Sentence chunks: raw count, ln((N + 1) / (df + 1)), as MLlib has it, without hashing.
CHUNK = Scheme(
    "chunk",
    ascii_tokens,
    lambda count, size: count.cast("double"),
    lambda n, df: F.ln((n + 1) / (df + 1)),
)


@dataclass(frozen=True)
class Index:
    corpus: DataFrame
    doc_id: str
    text: str
    scheme: Scheme
    terms: DataFrame
    postings: DataFrame
    buckets: int
    counts: DataFrame
    domain: str | None = None
    key: tuple = ()


def doc_tokens(df: DataFrame, key: str, text: str, scheme: Scheme = DOCUMENT) -> DataFrame:
    """One row per kept token, duplicates included."""
    return df.select(key, F.explode(scheme.tokens(F.col(text))).alias("term"))


def term_frequency(
    df: DataFrame, key: str, text: str, scheme: Scheme = DOCUMENT, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per (document, term): count, the document's token count and TF.

    ``carry`` names columns to keep beside the key.
    """
    counted = bind(
        scheme.tokens(F.col(text)),
        lambda tokens: bind(
            F.size(tokens),
            lambda size: F.transform(
                term_counts(tokens),
                lambda t: F.struct(
                    t["term"].alias("term"), t["n_term"].alias("n_term"), size.alias("n_tokens")
                ),
            ),
        ),
    )
    return df.select(key, *carry, F.inline(counted)).withColumn(
        "tf", scheme.tf(F.col("n_term"), F.col("n_tokens"))
    )


def doc_frequency(tf: DataFrame) -> DataFrame:
    """Documents per term; ``tf`` has one row per (document, term)."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def corpus_size(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery: documents without tokens count too."""
    return df.agg(F.count(F.lit(1)).alias("n_docs")).scalar()


def term_table(
    tf: DataFrame, n_docs: Column, scheme: Scheme = DOCUMENT, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    return doc_frequency(tf).select(
        "term",
        "df",
        scheme.idf(n_docs, F.col("df")).alias("idf"),
        F.ceil(F.col("df") / shard_rows).cast("int").alias("shards"),
    )


def domain_terms(df: DataFrame, domain: str, key: str, text: str) -> DataFrame:
    """Document frequency per (domain, term). A document has one domain, so sums of
    these rows give the frequencies of any choice of domains."""
    return (
        term_frequency(df, key, text, carry=(domain,))
        .groupBy(domain, "term")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def weigh(tf: DataFrame, terms: DataFrame, hot_terms: int = HOT_TERMS) -> DataFrame:
    """Attach df, IDF and shard count to every posting.

    ``terms`` should be a written table: it is read four times.
    """
    total = terms.agg(F.sum("df")).scalar()
    wanted = terms.withColumn("hot", F.col("df") * hot_terms >= total)
    hot = wanted.where("hot").drop("hot")
    rare = wanted.where("NOT hot").drop("hot")
    frequent = tf.join(F.broadcast(hot), "term")
    others = tf.join(F.broadcast(hot.select("term")), "term", "left_anti").join(rare, "term")
    return frequent.unionByName(others).withColumn("weight", F.col("tf") * F.col("idf"))


def doc_norms(weighted: DataFrame, key: str) -> DataFrame:
    return weighted.groupBy(key).agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm")
    )


def level_of(prefix: Column) -> Column:
    """0 for norms near 1, two more per halving, capped; falls as norms grow."""
    return F.least(F.lit(LEVELS), F.floor(F.log2(prefix) * -2).cast("int"))


def term_hash(term: Column) -> Column:
    return F.xxhash64(term)


def by_frequency(key: str) -> WindowSpec:
    """A row's terms from the most frequent in the corpus to the rarest."""
    return Window.partitionBy(key).orderBy(F.desc("df"), "term")


def unit_postings(
    weighted: DataFrame, key: str, buckets: int, scheme: Scheme = DOCUMENT, n_docs: Column | None = None
) -> DataFrame:
    """Postings of one scheme as they are written, ``buckets`` partitions; ``read_postings`` gives their weights.

    A posting is shuffled and written with its counts and what is equal for a whole document or term, which take few bytes;
    ``rest``, the norm of the units that are more frequent, is the one number of its own. With ``n_docs`` the IDF is not
    shuffled either.
    """
    idf = F.col("idf") if n_docs is None else scheme.idf(n_docs, F.col("df"))
    square = F.col("weight") * F.col("weight")
    up_to_here = by_frequency(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the same order, so that one pass over a document's sorted terms gives both sums
    all_of_it = by_frequency(key).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    norm = F.col("norm")
    rest = F.sqrt(F.greatest(F.col("so_far") - square, F.lit(0.0))) / norm
    return (
        weighted.select(key, "term", "n_term", "n_tokens", "df", "shards", *(["idf"] if n_docs is None else []))
        .repartition(buckets, key)
        .withColumn("idf", idf)
        .withColumn("weight", scheme.tf(F.col("n_term"), F.col("n_tokens")) * F.col("idf"))
        .withColumns({"so_far": F.sum(square).over(up_to_here), "norm": F.sqrt(F.sum(square).over(all_of_it))})
        .select(
            key, "term", "n_term", "n_tokens", "idf", "norm", "shards",
            F.when(norm > 0, rest).otherwise(0.0).cast("float").alias("rest"),
            term_hash(F.col("term")).alias("term_hash"),
        )
    )


def read_postings(written: DataFrame, key: str, scheme: Scheme = DOCUMENT) -> DataFrame:
    """Weighted postings with what retrieval needs, from those that ``unit_postings`` gave.

    ``unit``    weight divided by the document's norm
    ``prefix``  norm of the units of this term and all that are more frequent
    ``level``   level of ``prefix``; null for weights of 0, which never match
    ``shard``   part of a frequent term's postings
    ``cell``    the level inside a shard of a frequent term, -1 for all other terms
    ``term_hash``  the order in which a bucket's postings are written, see ``retrieve.narrowed``
    """
    if "weight" in written.columns:
        # an index saved before postings were written with their counts
        return written
    weight = scheme.tf(F.col("n_term"), F.col("n_tokens")) * F.col("idf")
    unit = F.when(F.col("norm") > 0, weight / F.col("norm")).otherwise(0.0)
    # in single precision the whole norm may be off 1
    prefix = F.least(F.lit(1.0), F.sqrt(F.col("rest").cast("double") * F.col("rest") + unit * unit))
    level = F.when(unit > 0, level_of(prefix))
    return written.select(
        key, "term", weight.alias("weight"), unit.alias("unit"), prefix.alias("prefix"), level.alias("level"),
        F.pmod(F.xxhash64(key), F.col("shards")).cast("int").alias("shard"),
        F.when(F.col("shards") > 1, level).otherwise(-1).alias("cell"),
        "term_hash",
    )


def rest_of(prefix: Column, unit: Column) -> Column:
    """Norm of the words more frequent than this one, from the norm up to it and its own unit."""
    return F.sqrt(F.greatest(prefix * prefix - unit * unit, F.lit(0.0)))


def cell_bounds(index: Index) -> DataFrame:
    """Number of postings, greatest unit and greatest norm of more frequent words per (term, shard, cell).

    One row per term and some for each cell of a frequent one. Written when a search first asks for it.
    """

    def bounds() -> DataFrame:
        rest = rest_of(F.col("prefix"), F.col("unit"))
        return (
            index.postings.where(F.col("unit") > 0)
            .groupBy("term", "shard", "cell")
            .agg(
                F.count(F.lit(1)).alias("n_postings"),
                F.max("unit").alias("top_unit"),
                F.max(rest).alias("top_rest"),
            )
        )

    return build_once(index.corpus.sparkSession, index.key, "cells", bounds)


def bucket_count(terms: DataFrame) -> int:
    """Buckets for an index, from the number of its postings; at least one per core."""
    postings = terms.agg(F.sum("df")).first()[0] or 0
    cores = terms.sparkSession.sparkContext.defaultParallelism
    return min(MAX_BUCKETS, max(cores, -(-postings // BUCKET_ROWS)))


def build_index(
    corpus: DataFrame,
    doc_id: str,
    text: str,
    cache_key: tuple,
    scheme: Scheme = DOCUMENT,
    hot_terms: int = HOT_TERMS,
    shard_rows: int = SHARD_ROWS,
    domain: str | None = None,
) -> Index:
    """Write the index of ``corpus`` to the shared folder, or reuse the one written before.

    ``cache_key`` names the corpus (and any filter on it); see ``sources.shared.forget``. With
    ``domain``, a column of the corpus, counts keep it for ``index_of_domains``.
    """
    spark = corpus.sparkSession
    key = (*cache_key, scheme.name, hot_terms, shard_rows, domain)
    tf = stored_counts(corpus, doc_id, text, cache_key, scheme, domain)
    return _weighed(spark, key, tf, corpus, doc_id, text, scheme, hot_terms, shard_rows, domain)


def stored_counts(
    corpus: DataFrame, doc_id: str, text: str, cache_key: tuple,
    scheme: Scheme = DOCUMENT, domain: str | None = None,
) -> DataFrame:
    """The term counts of ``corpus``, the one table that needs its text; written once."""
    carry = (domain,) if domain else ()
    docs = corpus.select(doc_id, text, *carry)
    key = (*cache_key, scheme.name, domain)
    return build_once(
        corpus.sparkSession, key, "counts",
        lambda: term_frequency(docs, doc_id, text, scheme, carry),
    )


def index_of_domains(
    index: Index, chosen: list[str], cache_key: tuple,
    hot_terms: int = HOT_TERMS, shard_rows: int = SHARD_ROWS,
) -> Index:
    """The index of the documents of ``chosen`` domains, from the stored counts of all.

    Frequencies and weights are those of the chosen documents; no text is read.
    """
    if not index.domain:
        raise ValueError("the index was built without a domain column")
    wanted = F.col(index.domain).isin(chosen)
    return _weighed(
        index.corpus.sparkSession, (*cache_key, index.scheme.name, hot_terms, shard_rows, *chosen),
        index.counts.where(wanted), index.corpus.where(wanted), index.doc_id, index.text,
        index.scheme, hot_terms, shard_rows, index.domain,
    )


def _weighed(
    spark, key: tuple, tf: DataFrame, corpus: DataFrame, doc_id: str, text: str,
    scheme: Scheme, hot_terms: int, shard_rows: int, domain: str | None,
) -> Index:
    """Terms and postings from counts; of the corpus only the ids are counted."""
    docs = corpus.select(doc_id)
    terms = build_once(
        spark, key, "terms", lambda: term_table(tf, corpus_size(docs), scheme, shard_rows)
    )
    buckets = bucket_count(terms)
    postings = build_once(
        spark, key, "postings",
        lambda: unit_postings(weigh(tf, terms, hot_terms), doc_id, buckets, scheme, corpus_size(docs)),
        bucket_by=doc_id, buckets=buckets, sort_by="term_hash", options=POSTING_FILES,
    )
    return Index(
        corpus, doc_id, text, scheme, terms, read_postings(postings, doc_id, scheme), buckets, tf, domain, key
    )


def query_vectors(
    queries: DataFrame, query_id: str, text: str, scheme: Scheme = DOCUMENT, binary: bool = False
) -> DataFrame:
    """Query weights: TF only, or 1.0 per distinct token. No shuffle.

    ``unit`` is the weight divided by the norm over all the query's terms, known to the
    corpus or not; both come from the query's own row.
    """

    def entries(counts: Column) -> Column:
        def total(of: Callable[[Column], Column]) -> Column:
            return F.aggregate(counts, F.lit(0.0), lambda so_far, entry: so_far + of(entry))

        def count(entry: Column) -> Column:
            return F.lit(1.0) if binary else entry["n_term"].cast("double")

        size = F.lit(1.0) if binary else total(count)
        norm = F.sqrt(total(lambda entry: count(entry) * count(entry)))
        return bind(
            F.struct(size.alias("size"), norm.alias("norm")),
            lambda whole: F.transform(
                counts,
                lambda entry: F.struct(
                    entry["term"].alias("term"),
                    (count(entry) / whole["size"]).alias("weight"),
                    (count(entry) / whole["norm"]).alias("unit"),
                ),
            ),
        )

    return queries.select(
        query_id, F.inline(bind(term_counts(scheme.tokens(F.col(text))), entries))
    )
