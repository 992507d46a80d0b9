"""Cosine top-k of many queries against an index, in one of two exact ways.

*In place.* The query words are broadcast, each document's scores are summed up in the
bucket where its postings lie, a batch of documents at a time (``scoring.py``), and a task passes on
its best k per query. No join by word, so no word is too frequent for a task, and no (query, document)
pair is shuffled. The work is one step per posting of a query word, per query holding it. Words and
steps are counted beforehand; queries are cut into as many blocks as keep each broadcast and
each task within ``Limits``, and each block scans the index once.

*Pruned.* For more blocks than that, batches that hold none of a query's best k are left out
before they are scored:

1. Each query word's k strongest postings give every query a k-th best score so far,
   ``floor``; the real k-th best is no lower.
2. Take the rarest word that a query and a document share. All they share is at least
   as frequent, so by Cauchy-Schwarz the score is at most the product of the two units of that
   word plus the product of the norms of the more frequent words of each.
3. A frequent word's postings lie in cells, by shard and by the norm up to that word; any other word
   is one cell. The greatest unit and norm of a cell bound all its postings: a query is scored
   only in batches with a cell whose bound reaches its floor, and of their documents those with a posting that reaches it count.

For the floors, query words that very many queries hold are dealt to slices, counted beforehand; a word's
postings are copied to the slices that meet it, so a join key, (word, slice), holds
a bounded number of rows on both sides however frequent a word is in queries and in documents.

Either way only the part of a bucket that may hold a query word is read: its postings lie in the
order of their words' hashes, and the hashes of all query words, as at most ``RANGES`` ranges, bound
the scan. For one question that skips nearly all pages; for very many words the ranges
cover everything and are left out.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, replace
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from gapledger import constants as C
from gapledger.functions.text import strip
from gapledger.operators.index import (
    HOT_TERMS,
    Index,
    by_frequency,
    cell_bounds,
    query_vectors,
    rest_of,
    term_hash,
)
from gapledger.operators.scoring import Block, bars_of, block_of, search, search_blocks
from gapledger.sources.shared import write_once

# Scores are compared after rounding, so that the order of a sum cannot break a tie.
SCORE_DIGITS = 9
# Keeps candidates whose score may still round up to the floor.
SLACK = 1e-6
# Most hits (ids, score, rank: some 40 bytes) that are broadcast to fetch their records.
BROADCAST_HITS = 1_000_000
# Ranges of word hashes that bound a scan, and bits of a hash that tell slots apart while they are sought.
RANGES = 64
SLOT_BITS = 12
# Buckets that a round may search, in those that were searched before it; buckets a core up to which one round does.
GROWTH = 16
FEW_ROUNDS = 4
# The number of the bucket in the name of its file, as Spark reads it.
BUCKET_FILE = re.compile(r"_(\d+)(?:\..*)?$")
# Share of all hashes beyond which bounding a scan saves too little.
WORTHWHILE = 0.5


@dataclass(frozen=True)
class Limits:
    """Bounds on scoring in place (query words per broadcast, steps per task, scans) and on a slice's query words."""

    words: int = 1_000_000
    steps: int = 20_000_000_000
    blocks: int = 32
    slice_rows: int = 4_096


LIMITS = Limits()


def known_words(vectors: DataFrame, index: Index) -> DataFrame:
    """Query words that the corpus holds and that can score, with df and shard count."""
    terms = index.terms.where(F.col("idf") > 0).select("term", "df", "shards")
    return vectors.withColumnRenamed("unit", "query_unit").join(terms, "term")


@dataclass(frozen=True)
class Survey:
    """What a search will take: query words, scoring steps, and the ranges that hold the words' hashes."""

    words: int
    steps: int
    ranges: list[tuple[int, int]]


def survey(known: DataFrame) -> Survey:
    """Counts the query words; at most 2**SLOT_BITS rows are fetched, however many words there are."""
    hashed = known.select("df", term_hash(F.col("term")).alias("h"))
    slots = hashed.groupBy(F.shiftright("h", 64 - SLOT_BITS).alias("slot")).agg(
        F.count(F.lit(1)).alias("words"), F.sum("df").alias("steps"), F.min("h").alias("low"), F.max("h").alias("high")
    ).collect()
    return Survey(
        sum(s.words for s in slots), sum(s.steps for s in slots), widest_apart([(s.low, s.high) for s in slots])
    )


def widest_apart(ranges: list[tuple[int, int]], most: int = RANGES) -> list[tuple[int, int]]:
    """At most ``most`` ranges around the given ones, which do not overlap: the widest gaps stay open."""
    ranges = sorted(ranges)
    gaps = sorted(range(1, len(ranges)), key=lambda i: ranges[i - 1][1] - ranges[i][0])[: most - 1]
    starts = [0, *sorted(gaps)] if ranges else []
    return [(ranges[a][0], ranges[b - 1][1]) for a, b in zip(starts, [*starts[1:], len(ranges)])]


def narrowed(index: Index, ranges: list[tuple[int, int]]) -> Index:
    """The index whose postings are read only where the hash of their term lies in ``ranges``.

    The bounds reach the Parquet reader, which skips row groups and pages by their statistics.
    """
    if sum(high - low + 1 for low, high in ranges) > WORTHWHILE * 2.0**64:
        return index
    bounds = [F.col("term_hash").between(low, high) for low, high in ranges]
    # halves, not a chain: the depth stays small
    while len(bounds) > 1:
        bounds = [reduce(Column.__or__, bounds[i : i + 2]) for i in range(0, len(bounds), 2)]
    return replace(index, postings=index.postings.where(bounds[0] if bounds else F.lit(False)))


def blocks_needed(found: Survey, index: Index, limits: Limits) -> int:
    """Blocks of queries for scoring in place."""
    by_words = -(-found.words // limits.words)
    by_steps = -(-found.steps // (limits.steps * index.buckets))
    return max(1, by_words, by_steps)


def _hits(index: Index) -> DataFrame:
    return index.postings.where(F.col("unit") > 0)


def scored_in_place(
    known: DataFrame, index: Index, query_id: str, k: int | None = None, least: float | None = None
) -> DataFrame:
    """Scores of pairs that share a word, each found in its document's bucket, where a document's postings lie together.

    Of each query a task passes on its best ``k``, or the scores from ``least`` on; without either, all. The query words go
    to the tasks once. Words that carry a floor (``with_floor``) meet only batches of documents with a cell that may reach it.
    """
    asked = ask(known, query_id)

    def scored(batches):
        return search(asked.block.value, batches, names, SCORE_DIGITS, k, least)

    names = [query_id, index.doc_id, "score"]
    words = _hits(index).join(F.broadcast(known.select("term").distinct()), "term", "left_semi")
    return by_document(words, index, "floor" in known.columns).mapInArrow(scored, score_schema(known, index, query_id))


def by_document(words: DataFrame, index: Index, pruned: bool = False) -> DataFrame:
    """A bucket's documents in the order of their ids, each with its postings."""
    rest = rest_of(F.col("prefix"), F.col("unit")).alias("rest")
    entry = F.struct("term", "unit", *([rest, "shard", "cell"] if pruned else []))
    return words.groupBy(index.doc_id).agg(F.collect_list(entry).alias("words")).sortWithinPartitions(index.doc_id)


def score_schema(known: DataFrame, index: Index, query_id: str) -> StructType:
    return StructType(
        [known.schema[query_id], index.postings.schema[index.doc_id], StructField("score", DoubleType())]
    )


@dataclass(frozen=True)
class Asked:
    """Queries whose words were sent to the tasks, and their ids in the tasks' order."""

    block: Broadcast
    ids: pa.Array


def ask(known: DataFrame, query_id: str) -> Asked:
    columns = [c for c in (query_id, "term", "query_unit", "df", "query_rest", "floor") if c in known.columns]
    block = block_of(known.select(*columns).toArrow(), query_id)
    return Asked(known.sparkSession.sparkContext.broadcast(block), block.ids)


def best_of_blocks(
    known: DataFrame, asked: list[Asked], index: Index, query_id: str, k: int, bars: list[np.ndarray] | None
) -> DataFrame:
    """``scored_in_place`` for the best ``k`` of all blocks of queries, with one scan.

    ``bars``: per block, the scores that k documents of its queries are known to have; what scores less is left out.
    """
    names = [query_id, index.doc_id, "score"]
    blocks = [part.block for part in asked]
    reached = None if bars is None else known.sparkSession.sparkContext.broadcast(bars)

    def block(i: int) -> Block:
        found = blocks[i].value
        if len(blocks) > 1:
            # else a worker would keep every block that it has met
            vars(blocks[i]).pop("_value", None)
        return found if reached is None else replace(found, bars=reached.value[i])

    def scored(batches):
        return search_blocks([partial(block, i) for i in range(len(blocks))], batches, names, SCORE_DIGITS, k)

    words = _hits(index)
    if len(blocks) == 1:
        # the words of more queries are most of those that documents have
        words = words.join(F.broadcast(known.select("term").distinct()), "term", "left_semi")
    return by_document(words, index).mapInArrow(scored, score_schema(known, index, query_id))


def query_blocks(known: DataFrame, query_id: str, blocks: int) -> list[DataFrame]:
    """The query words in ``blocks`` parts; a query's words stay together."""
    if blocks == 1:
        return [known]
    block = F.pmod(F.xxhash64(query_id), F.lit(blocks))
    return [known.where(block == i) for i in range(blocks)]


def rounds(buckets: int, cores: int, growth: int = GROWTH) -> list[tuple[int, int]]:
    """Buckets to search one range after the other: one per core, then up to ``growth`` times what was searched before."""
    if buckets <= FEW_ROUNDS * cores:
        return [(0, buckets)]
    steps = math.ceil(math.log(buckets / cores, growth))
    ends = [min(buckets, math.ceil(cores * (buckets / cores) ** (i / steps))) for i in range(steps)] + [buckets]
    return list(zip([0, *ends], ends))


def in_buckets(index: Index, first: int, end: int) -> Index:
    """The index with the postings of some buckets only; files of others are not opened."""
    names = [path.rpartition("/")[2] for path in index.postings.inputFiles()]
    wanted = [name for name in names if first <= int(BUCKET_FILE.search(name)[1]) < end]
    return replace(index, postings=index.postings.where(F.col("_metadata.file_name").isin(wanted)))


def best_in_rounds(known: DataFrame, index: Index, query_id: str, k: int, blocks: int) -> DataFrame:
    """The k best of every query: query id, document id, score, rank.

    With many buckets, each task's k best of every query would be many more rows than all queries' k best. So some buckets
    are searched first, and a query's k-th best score there is what its documents in the others have to reach: of as many buckets as
    ``growth`` times those before, about ``growth`` times k documents do, however many tasks look for them.
    """
    asked = [ask(part, query_id) for part in query_blocks(known, query_id, blocks)]
    best, bars = None, None
    for first, end in rounds(index.buckets, known.sparkSession.sparkContext.defaultParallelism):
        there = index if (first, end) == (0, index.buckets) else in_buckets(index, first, end)
        scored = best_of_blocks(known, asked, there, query_id, k, bars)
        if best is not None:
            scored = scored.unionByName(best.drop("rank"))
        best = best_k(scored, query_id, index.doc_id, k)
        if end < index.buckets:
            best = write_once("best-so-far", best)
            kth = [part.toArrow() for part in query_blocks(best.where(F.col("rank") == k), query_id, blocks)]
            bars = [bars_of(part.ids, found[query_id], found["score"]) for part, found in zip(asked, kth)]
    return best


@dataclass(frozen=True)
class Sliced:
    """Query words with their slice, and the words that have more than one."""

    words: DataFrame
    heavy: DataFrame

    def copied(self, rows: DataFrame) -> DataFrame:
        """``rows`` of terms, once for every slice of the term."""
        slices = F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)).alias("slice")
        return rows.join(F.broadcast(self.heavy), "term", "left").select(*rows.columns, slices)


def sliced(known: DataFrame, query_id: str, slice_rows: int, most: int = HOT_TERMS) -> Sliced:
    """Deals a word's queries to slices of about ``slice_rows``.

    At most ``most`` words can each make up 1/``most`` of all query words, so the table of words with
    slices has a bounded size; it is broadcast.
    """
    load = known.groupBy("term").agg(F.count(F.lit(1)).alias("queries"))
    least = F.greatest(F.lit(slice_rows + 1), load.agg(F.sum("queries")).scalar() / most)
    heavy = write_once(
        "slices",
        load.where(F.col("queries") >= least).select(
            "term", F.ceil(F.col("queries") / slice_rows).cast("int").alias("slices")
        ),
    )
    mine = F.pmod(F.xxhash64(query_id), F.coalesce("slices", F.lit(1))).cast("int")
    words = known.join(F.broadcast(heavy), "term", "left").withColumn("slice", mine).drop("slices")
    return Sliced(words, heavy)


def kth_best(parts: Sliced, index: Index, query_id: str, k: int) -> DataFrame:
    """A score that at least k documents of each query reach; no row if fewer are known.

    Per word the k strongest postings are kept, first within each task.
    """
    strongest = Window.partitionBy("term").orderBy(F.desc("unit"), index.doc_id)
    leaders = (
        _hits(index)
        .select(index.doc_id, "term", "unit")
        .join(parts.words.select("term").distinct(), "term", "left_semi")
        .withColumn("place", F.row_number().over(strongest))
        .where(F.col("place") <= k)
    )
    best = Window.partitionBy(query_id).orderBy(F.desc("partial"))
    return (
        parts.words.join(parts.copied(leaders.drop("place")), ["term", "slice"])
        .groupBy(query_id, index.doc_id)
        .agg(F.sum(F.col("query_unit") * F.col("unit")).alias("partial"))
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") == k)
        .select(query_id, F.col("partial").alias("floor"))
    )


def with_floor(parts: Sliced, query_id: str, floor: DataFrame | float) -> DataFrame:
    """Query words with the score to reach and the norm of the query's more frequent words."""
    up_to_here = by_frequency(query_id).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    square = F.col("query_unit") * F.col("query_unit")
    probes = parts.words.withColumn("query_prefix", F.sqrt(F.sum(square).over(up_to_here)))
    if isinstance(floor, DataFrame):
        probes = probes.join(floor, query_id, "left")
    else:
        probes = probes.withColumn("floor", F.lit(float(floor)))
    return probes.select(
        query_id, "term", "slice", "query_unit",
        rest_of(F.col("query_prefix"), F.col("query_unit")).alias("query_rest"),
        (F.coalesce("floor", F.lit(0.0)) - SLACK).alias("floor"),
    )


def meetings(probes: DataFrame, parts: Sliced, cells: DataFrame) -> DataFrame:
    """The cells that each query word has to look into: those whose bound reaches the floor."""
    at_most = F.col("query_unit") * F.col("top_unit") + F.col("query_rest") * F.col("top_rest")
    return (
        probes.join(parts.copied(cells), ["term", "slice"])
        .where(at_most >= F.col("floor"))
        .drop("top_unit", "top_rest")
    )


def pruned_words(
    known: DataFrame, index: Index, query_id: str, floor: float | int, limits: Limits
) -> DataFrame:
    """Query words with the score that their query has to reach: ``floor``, if it is a float, or that of its ``floor`` best."""
    parts = sliced(known, query_id, limits.slice_rows)
    least = floor if isinstance(floor, float) else kth_best(parts, index, query_id, floor)
    return write_once("query-floors", with_floor(parts, query_id, least))


def search_work(
    index: Index, queries: DataFrame, query_id: str, text: str, k: int = C.DEFAULT_K,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Per query, what a pruned search for its k best looks into: ``cells`` and ``postings`` that hold its
    words, and ``cells_met`` and ``postings_met`` of them. Queries without a known word have no row."""
    known = write_once("query-words", known_words(query_vectors(queries, query_id, text, index.scheme), index))
    cells = cell_bounds(index)
    parts = sliced(known, query_id, limits.slice_rows)
    probes = with_floor(parts, query_id, kth_best(parts, index, query_id, k))

    def work(rows: DataFrame, suffix: str) -> DataFrame:
        return rows.groupBy(query_id).agg(
            F.count(F.lit(1)).alias("cells" + suffix), F.sum("n_postings").alias("postings" + suffix)
        )

    everywhere = probes.withColumn("floor", F.lit(-1.0))
    held = work(meetings(everywhere, parts, cells), "")
    return held.join(work(meetings(probes, parts, cells), "_met"), query_id, "left").fillna(0)


def first_documents(corpus: DataFrame, doc_id: str, k: int) -> DataFrame:
    """The k first documents in corpus order with their place: k rows at most."""
    return (
        corpus.select(doc_id).orderBy(doc_id).limit(k)
        .agg(F.array_sort(F.collect_list(doc_id)).alias("ids"))
        .select(F.posexplode("ids").alias("slot", doc_id))
    )


def _padding(queries: DataFrame, query_id: str, index: Index, k: int) -> DataFrame:
    """k documents per query that stand in for matches it does not have."""
    slots = queries.select(
        query_id, F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("slot")
    )
    first = F.broadcast(first_documents(index.corpus, index.doc_id, k))
    return slots.join(first, "slot").select(query_id, index.doc_id)


def best_k(scored: DataFrame, query_id: str, doc_id: str, k: int) -> DataFrame:
    """Rank by score, then corpus order. Each task keeps k rows per query before the shuffle."""
    order = Window.partitionBy(query_id).orderBy(F.desc("score"), doc_id)
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def retrieve(
    index: Index,
    queries: DataFrame,
    query_id: str,
    text: str,
    k: int = C.DEFAULT_K,
    pad: bool = True,
    binary: bool = False,
    limits: Limits = LIMITS,
) -> DataFrame:
    """The k best documents of every query: query id, document id, score, rank.

    ``pad`` fills up with documents scoring 0 in corpus order, so that every query,
    even a blank one, gets min(k, corpus size) rows.
    """
    vectors = query_vectors(queries, query_id, text, index.scheme, binary)
    # Read by the count below and by every block or pruning step.
    known = write_once("query-words", known_words(vectors, index))
    found = survey(known)
    index = narrowed(index, found.ranges)
    blocks = blocks_needed(found, index, limits)
    if blocks > limits.blocks:
        known = pruned_words(known, index, query_id, k, limits)
        scored = [scored_in_place(part, index, query_id, k=k) for part in query_blocks(known, query_id, blocks)]
        best = reduce(DataFrame.unionByName, [best_k(part, query_id, index.doc_id, k) for part in scored])
    else:
        best = best_in_rounds(known, index, query_id, k, blocks)
    if not pad:
        return best
    # A query with k matches ranks them before any of its k stand-ins; a query with
    # fewer has all its matches here, so that its other stand-ins do score 0.
    filled = (
        best.drop("rank")
        .unionByName(_padding(queries, query_id, index, k).withColumn("score", F.lit(0.0)))
        .groupBy(query_id, index.doc_id)
        .agg(F.max("score").alias("score"))
    )
    return best_k(filled, query_id, index.doc_id, k)


def cosine_scores(
    index: Index,
    queries: DataFrame,
    query_id: str,
    text: str,
    min_score: float,
    binary: bool = False,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Every (query, document) that scores at least ``min_score``.

    The bound has to be positive: without one the result grows as all pairs that share a word.
    """
    if not min_score > 0:
        raise ValueError("min_score has to be positive")
    vectors = query_vectors(queries, query_id, text, index.scheme, binary)
    # Read by the count below and by every block or pruning step.
    known = write_once("query-words", known_words(vectors, index))
    found = survey(known)
    index = narrowed(index, found.ranges)
    blocks = blocks_needed(found, index, limits)
    if blocks > limits.blocks:
        known = pruned_words(known, index, query_id, float(min_score), limits)
    parts = query_blocks(known, query_id, blocks)
    scored = reduce(
        DataFrame.unionByName,
        [scored_in_place(part, index, query_id, least=float(min_score)) for part in parts],
    )
    return scored.where(F.col("score") >= min_score)


def with_records(
    hits: DataFrame, records: DataFrame, doc_id: str, columns: list[str],
    broadcast_rows: int = BROADCAST_HITS,
) -> DataFrame:
    """Attach record columns to hits; hits without a record are dropped.

    Hits are few next to the corpus, but planned side by side Spark would start to shuffle
    the corpus' text before it knows. So hits are written and counted first, and
    broadcast if they are within ``broadcast_rows``: the text is scanned once, in place.
    """
    hits = write_once("hits", hits)
    side = F.broadcast(hits) if hits.count() <= broadcast_rows else hits
    wanted = records.select(doc_id, *[c for c in columns if c != doc_id])
    return wanted.join(side, doc_id)


def in_domains(corpus: DataFrame, domain: str, chosen: list[str]) -> DataFrame:
    """Restrict the corpus; an empty choice restricts nothing. Reaches the scan."""
    return corpus.where(F.col(domain).isin(chosen)) if chosen else corpus


def query_source(custom: Column, fallback: Column) -> Column:
    """Pasted text if it is not blank, else the selected text."""
    return F.when(F.length(strip(custom)) > 0, custom).otherwise(fallback)
