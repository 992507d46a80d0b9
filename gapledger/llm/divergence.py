"""Source divergence audit: how far the sources of a language differ in the words they use.

A group is one (lang, source); its terms have exact counts, and a count is a level. With one
indicator column for each (group, level) and a row for each term, the product of the transposed
matrix with itself holds, for every two groups, the table of how many terms stand on level i
in one and level j in the other. Price differences depend on levels only, so the
table times the price of each cell is the divergence of the two groups, in both directions.

Terms are dealt into blocks and groups into tiles, so a task multiplies small dense blocks; its
products are counts below 2**24, which 32-bit floats hold exactly, and prices are 64-bit integers. Terms that
no group of a tile has stand on level 0 of both and are added by their number.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapledger.sources.shared import write_once

#: Documents of a language that a kept term occurs in, and ranks of terms returned per group.
LEAST_DOCS, RANKS = 3, 200
#: Shares are counted in this many parts.
UNIT = 1_000_000_000
#: Terms in a block, groups on one side of a tile, and columns of a dense product aimed at.
TERMS, GROUPS, COLUMNS = 4096, 64, 1024
#: Distinct (group, term) a task counts before it passes them on, and bytes of text it cuts up at a time.
HELD, PIECE = 400_000, 4 << 20

#: ASCII letters in lower case; every other ASCII character separates; bytes of other characters stay.
_LETTERS = bytes(
    b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


def _words(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text in UTF-8, a bounded number at a time."""
    at = 0
    while at < len(text):
        stop = min(len(text), at + PIECE)
        part = text[at:stop].translate(_LETTERS)
        if stop < len(text):
            cut = part.rfind(b" ") + 1
            # a run longer than a piece is one term: it is taken whole
            while not cut and stop < len(text):
                stop = min(len(text), stop + PIECE)
                part = text[at:stop].translate(_LETTERS)
                cut = part.rfind(b" ") + 1 if stop < len(text) else len(part)
            if stop < len(text):
                part, stop = part[:cut], at + cut
        yield part.split()
        at = stop


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, c (occurrences) and d (documents), and a row with a null term for every group.

    Null text, lang and source are ''. Every row of ``docs`` is a document. Counts are added up in
    each task before they are shuffled, so a group with very many rows sends no more than its distinct terms per task.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (times, docs_with) in seen.items():
                terms = list(times)
                n = len(terms) + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()),
                        pa.array([*terms, None], pa.binary()).cast(pa.string()),
                        pa.array([*times.values(), 0], pa.int64()), pa.array([*map(docs_with.__getitem__, terms), 0], pa.int64()),
                    ],
                    ["lang", "source", "term", "c", "d"],
                )
            seen.clear()

        for b in batches:
            for lang, source, text in zip(*(b.column(c).to_pylist() for c in ("lang", "source", "text"))):
                times, docs_with = seen.setdefault((lang, source), (Counter(), Counter()))
                before, own = len(times), set()
                for words in _words(text):
                    times.update(words)
                    own.update(words)
                docs_with.update(own)
                held += len(times) - before
                if held > HELD:
                    yield from flush()
                    held = 0
        yield from flush()

    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    counts = rows.mapInArrow(counted, "lang string, source string, term string, c long, d long")
    return counts.groupBy("lang", "source", "term").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT (count + 1) / (total + terms)), exact for counts of any size."""
    wide = "decimal(19,0)"
    parts = F.lit(UNIT).cast("decimal(10,0)") * (count.cast(wide) + 1)
    quotient = F.call_function("div", parts, total.cast(wide) + terms.cast(wide))
    return F.when(total + terms > 0, quotient + 1)


def price(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / q); both are shares, so the square stays below 2**63."""
    return F.call_function("div", (p - q) * (p - q), q)


def tile(table: pa.Table, i: int, j: int, per_side: int = GROUPS, columns: int = COLUMNS) -> list[tuple[int, int, int, int]]:
    """(a, b, price of a against b, terms seen) for the groups of sides i and j, over one block of terms.

    ``table`` has term (-1: the group's level 0), total, gid, c and p. Terms are taken from
    rare to frequent, as many at a time as have about ``columns`` (group, level) pairs together.
    """
    term, total, gid, c, p = (table.column(n).to_numpy() for n in ("term", "total", "gid", "c", "p"))
    zero = term < 0
    order = np.argsort(gid[zero])
    groups, base = gid[zero][order], p[zero][order]
    m = len(groups)
    term, total, c, p, g = (x[~zero] for x in (term, total, c, p, np.searchsorted(groups, gid)))
    order = np.lexsort((term, total))
    term, c, p, g = term[order], c[order], p[order], g[order]
    starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(term)]))
    ends = np.r_[starts[1:], len(term)]
    value = np.zeros((m, m), np.int64)
    at, many = 0, len(starts)
    while at < len(starts):
        stop = min(len(starts), at + many)
        while True:
            some = slice(starts[at], ends[stop - 1])
            # a column for every level of every group, after the groups' own level 0
            pair = np.stack([g[some], c[some]])
            level, first, which = np.unique(pair, axis=1, return_index=True, return_inverse=True)
            if m + level.shape[1] <= max(columns, 2 * m) or stop == at + 1:
                break
            stop = at + max(1, (stop - at) // 2)
        indicator = np.zeros((stop - at, m + level.shape[1]), np.float32)
        indicator[:, :m] = 1
        rows = row[some] - at
        indicator[rows, g[some]] = 0
        indicator[rows, m + which.reshape(-1)] = 1
        side, cost = np.r_[np.arange(m), level[0]], np.r_[base, p[some][first]]
        left = np.flatnonzero(groups[side] // per_side == i)
        right = np.flatnonzero(groups[side] // per_side == j)
        joint = indicator[:, left].T @ indicator[:, right]
        x, y = np.nonzero(joint)
        times, x, y = joint[x, y].astype(np.int64), left[x], right[y]
        gap = (cost[x] - cost[y]) ** 2
        np.add.at(value, (side[x], side[y]), times * (gap // cost[y]))
        if i != j:
            np.add.at(value, (side[y], side[x]), times * (gap // cost[x]))
        many = max(1, 2 * (stop - at))
        at = stop
    one, other = groups // per_side == i, groups // per_side == j
    wanted = (one[:, None] & other[None, :]) | (other[:, None] & one[None, :])
    np.fill_diagonal(wanted, False)
    a, b = np.nonzero(wanted)
    return list(zip(groups[a].tolist(), groups[b].tolist(), value[a, b].tolist(), [len(starts)] * len(a)))


def _pricer(per_side: int, columns: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def priced(key: tuple, table: pa.Table) -> pa.Table:
        lang, _, i, j = (k.as_py() for k in key)
        found = tile(table, i, j, per_side, columns)
        a, b, value, seen = zip(*found) if found else ((), (), (), ())
        return pa.table({
            "lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()),
            "value": pa.array(value, pa.int64()), "seen": pa.array(seen, pa.int64()),
        })

    return priced


def _dealt(rows: DataFrame, per_side: int) -> DataFrame:
    """Copies of each row for every tile that its group has a side of: as many as there are sides."""
    own, sides = F.floor(F.col("gid") / per_side).cast("int"), F.floor((F.col("groups") - 1) / per_side).cast("int")
    every = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), sides)))
    return every.select(
        "lang", "block", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "term", "total", "gid", "c", "p",
    )


def divergence(
    docs: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = RANKS,
    terms_per_block: int = TERMS, per_side: int = GROUPS, columns: int = COLUMNS,
) -> DataFrame:
    """lang, source, part, item, value and rank for every occurring (lang, source) of ``docs`` (lang, source, text).

    A language keeps the V terms of at least ``least_docs`` of its documents. A group or language with count
    occurrences of a kept term, N of all kept terms, gives it p = 1 + floor(UNIT (count + 1) / (N + V)). Against
    q the price is floor((p - q)**2 / q). Part ``pair``: item is each other source of the language, q its p, value the sum over
    all kept terms. Part ``term``: item is a kept term that the group has and uses more than its language does (q),
    value its price, the first ``ranks`` only. Ranks start at 1, value descending, item ascending.

    Null text, lang and source count as ''; repeated rows are documents of their own; texts of any length
    are read whole; without kept terms all pairs have value 0; a language with one source has no pairs; other
    columns are not read; an empty table gives an empty one. ``terms_per_block``, ``per_side`` and ``columns`` size
    the products and change no result.
    """
    counts = write_once("divergence_counts", count_terms(docs))
    found = counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("c").alias("total"), F.sum("d").alias("docs"))
    # the number of a term is fixed once the table is written
    terms = write_once("divergence_terms", found.filter(F.col("docs") >= least_docs).select(
        "lang", "term", "total", F.monotonically_increasing_id().alias("number")
    ))
    kept = write_once("divergence_kept", counts.join(terms, ["lang", "term"]).select("lang", "source", "term", "number", "c", "total"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    sums = kept.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    nothing = F.lit(0).cast("long")
    groups = (
        counts.filter("term IS NULL").select("lang", "source")
        .join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, nothing).alias(c) for c in ("n", "v", "lang_n")])
    )
    # rows of this table are groups: a language's sources, numbered
    groups = write_once("divergence_groups", groups.select(
        "*", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("gid"),
        F.count("*").over(Window.partitionBy("lang")).alias("groups"),
        share(nothing, F.col("n"), F.col("v")).alias("base"),
    ))
    rows = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("c"), F.col("n"), F.col("v")))
    blocks = F.greatest(F.ceil(F.col("v") / terms_per_block).cast("int"), F.lit(1))
    placed = rows.withColumn("block", F.pmod(F.xxhash64("number"), blocks).cast("int")).withColumn("term", F.col("number"))
    every = groups.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "*", F.lit(-1).cast("long").alias("term"), nothing.alias("total"), nothing.alias("c"), F.coalesce("base", F.lit(1)).alias("p")
    )
    names = ["lang", "block", "gid", "groups", "term", "total", "c", "p"]
    priced = _dealt(placed.select(*names).unionByName(every.select(*names)), per_side).groupBy("lang", "block", "i", "j").applyInArrow(
        _pricer(per_side, columns), "lang string, a int, b int, value long, seen long"
    )
    sums = priced.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    ours = groups.select("lang", "source", F.col("gid").alias("a"), "v", F.col("base").alias("p"))
    theirs = groups.select("lang", F.col("source").alias("item"), F.col("gid").alias("b"), F.col("base").alias("q"))
    unseen = F.when(F.col("v") > 0, (F.col("v") - F.col("seen")) * price(F.col("p"), F.col("q"))).otherwise(0)
    pairs = sums.join(ours, ["lang", "a"]).join(theirs, ["lang", "b"]).select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.when(F.col("v") > 0, F.col("value") + unseen).otherwise(0).alias("value")
    )
    typical = rows.withColumn("q", share(F.col("total"), F.col("lang_n"), F.col("v"))).filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), price(F.col("p"), F.col("q")).alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [x.withColumn("rank", F.row_number().over(order)) for x in (pairs, typical)]
    return ranked[0].unionByName(ranked[1].filter(F.col("rank") <= ranks))
