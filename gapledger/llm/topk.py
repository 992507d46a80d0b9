"""Exact top-k inner products by MaxScore.

A dimension is a query's term; its posting list in a shard holds a value for every vector,
in blocks with the least and greatest value. Counted from the least value, a term's
contribution is never negative and has a bound per block, as MaxScore needs it. With the
score of the k-th best so far, terms are split: the smallest bounds that together cannot
reach it are non-essential. Essential postings are traversed for all vectors of the block;
non-essential ones are probed, greatest bound first, only for vectors that can still reach
the k-th score. Blocks that no term can lift that far are not read. Shards are
searched side by side and their best k merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapledger.llm.frames import parts_for

LEAST, MOST = -(1 << 63), (1 << 63) - 1
#: Vectors in a shard, and in a posting block.
SHARD_ROWS = 8_192
BLOCK = 2_048
#: Queries that meet a shard at a time.
QUERY_ROWS = 16_384


def _matrix(rows: pd.Series) -> np.ndarray:
    """Vectors of whole numbers as rows, padded with zeros, in floats that hold their products exactly."""
    width = max((len(v) for v in rows), default=0)
    out = np.zeros((len(rows), width))
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    most = np.abs(out).max(initial=0)
    return out if most * most * max(width, 1) < 2**53 else out.astype(np.longdouble)


class Shard:
    """Posting lists of one shard: values by dimension, in blocks with their bounds."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, block: int = BLOCK):
        order = np.argsort(ids, kind="stable")
        self.ids, self.lists = ids[order], np.ascontiguousarray(vectors[order].T)
        n = len(ids)
        self.blocks = [slice(i, min(i + block, n)) for i in range(0, n, block)]
        self.least = np.stack([self.lists[:, b].min(1) for b in self.blocks], 1)
        self.most = np.stack([self.lists[:, b].max(1) for b in self.blocks], 1)

    def search(self, query: np.ndarray, own: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best, greatest score first, then smallest id; ``own`` is left out."""
        ids, scores = np.zeros(0, np.int64), np.zeros(0, query.dtype)
        lows = np.minimum(query[:, None] * self.least, query[:, None] * self.most)
        bounds = np.maximum(query[:, None] * self.least, query[:, None] * self.most) - lows
        base = lows.sum(0)
        # the block that can score most comes first, so that the k-th score rises early
        for n in np.argsort(-(base + bounds.sum(0)), kind="stable"):
            full = len(ids) == k
            bar = scores[-1] if full else -np.inf
            if base[n] + bounds[:, n].sum() < bar:
                break
            found_ids, found = self._block(n, query, base[n], bounds[:, n], bar)
            if own is not None:
                other = found_ids != own
                found_ids, found = found_ids[other], found[other]
            ids, scores = np.concatenate([ids, found_ids]), np.concatenate([scores, found])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
        return ids, scores

    def _block(self, n: int, query, base: float, bound, bar: float):
        part = self.blocks[n]
        order = np.argsort(bound, kind="stable")
        reach = base + np.cumsum(bound[order])
        split = int(np.searchsorted(reach, bar))  # the terms before it cannot reach the bar together
        essential = order[split:]
        lists = self.lists[:, part]
        score = query[essential] @ lists[essential]
        place = np.arange(lists.shape[1])
        # what the terms not yet read add at most
        rest = np.r_[0, np.cumsum(np.maximum(query[order] * self.least[order, n], query[order] * self.most[order, n]))]
        keep = score + rest[split] >= bar
        place, score = place[keep], score[keep]
        for i in range(split - 1, -1, -1):
            if not len(place):
                break
            score = score + query[order[i]] * lists[order[i], place]
            keep = score + rest[i] >= bar
            place, score = place[keep], score[keep]
        return self.ids[part][place], score


def max_score_top_k(
    rows: DataFrame, queries: DataFrame, k: int, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS
) -> DataFrame:
    """The k best of ``rows`` for each of ``queries`` (both: vec_id long, vector of whole doubles).

    A query never finds rows of its own vec_id. Vectors of different lengths are compared as if
    the shorter had zeros behind it. Returns query_id, rank, vec_id, score (beyond 64 bits: the nearest
    long); ties go to the smaller vec_id, and repeated rows are found as often as they are there. Of queries
    with one vec_id the smallest vector counts. Rows without vec_id take no part; an empty
    table gives an empty one. Queries meet every shard in blocks of a bounded size.
    """
    rows = rows.select("vec_id", "vector").filter("vec_id IS NOT NULL AND vector IS NOT NULL")
    queries = queries.filter("vec_id IS NOT NULL AND vector IS NOT NULL").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    shards, blocks = parts_for(rows.count(), shard_rows), parts_for(queries.count(), query_rows)

    def met(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            both = _matrix(pd.concat([left.vector, right.vector]))
            shard = Shard(left.vec_id.to_numpy(np.int64), both[: len(left)])
            for own, query in zip(right.vec_id, both[len(left) :]):
                ids, scores = shard.search(query, int(own), k)
                out += [(int(own), int(i), max(LEAST, min(MOST, int(s)))) for i, s in zip(ids, scores)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    row_block = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int")
    query_block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    # every (shard, block) pair gets its rows: both sides are copied as often as the other has parts
    dealt_rows = rows.select("*", row_block.alias("shard")).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    )
    dealt_queries = queries.select("*", query_block.alias("block")).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    )
    found = (
        dealt_rows.groupBy("shard", "block")
        .cogroup(dealt_queries.groupBy("shard", "block"))
        .applyInPandas(met, "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def floored(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and floor(scale * x) of every component; vectors with null or non-finite components go."""
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("double"))
    return vectors.filter(x.isNotNull() & ~bad).select("vec_id", whole.alias("vector"))


def search_embeddings(embeddings: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """The k best of all rows of ``embeddings`` for each row whose vec_id is divisible by ``every``."""
    rows = floored(embeddings)
    return max_score_top_k(rows, rows.filter(F.col("vec_id") % every == 0), k)
