"""Near-duplicate detection by BagMinHash over weighted shingles.

A text is a bag of five-word shingles. Each (shingle, weight level) emits the points of a
Poisson process: arrival times with a component. Levels are grouped in dyadic bands with one process
each, whose points carry a level of the band, so a weight w costs log2(w) processes; points above w are
thinned out. The earliest point per component is the signature, and two signatures agree in a component
with the probability of the weighted Jaccard similarity. Bands of components find candidates, which
are verified by the overlap of the bags themselves; verified links form classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapledger.llm.frames import WordMemory, free_name, hash64, mix, shingle_hashes, text_blocks, word_hashes
from gapledger.sources.shared import write_once

SHINGLE, SIMILAR = 5, 0.8
#: Components of a signature and of a band: 1 - (1 - 0.8**5)**25 of links at 0.8 share a band.
SIZE, BAND = 125, 5
#: Nodes up to which their names are broadcast to find their texts (24 bytes each); beyond it, a shuffle join.
FEW_NODES = 200_000
#: Times that members which fail with their band's centre get another centre, before all other pairs are looked at.
ROUNDS = 2
#: Bits of a bag's sketch, and members of a bucket that one tile of its pairs holds on a side.
BITS, TILE = 1024, 1024
#: Characters a task signs at a time.
BLOCK = 2 << 20
#: Pairs whose texts a task holds at a time.
PAIRS = 256


def bag(text: str, memory: WordMemory, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted, and how often each occurs; a shorter text is one shingle."""
    words = word_hashes(memory, text.encode("utf-8", "replace").split())
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.unique(shingle_hashes(words, min(size, len(words))), return_counts=True)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of smaller weights over sum of greater ones; two empty bags are equal."""
    total = int(a[1].sum() + b[1].sum())
    if not total:
        return 1.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / (total - both)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], size: int = SIZE) -> np.ndarray:
    """Signature (arrival times) of every bag; a row of infinities for an empty one."""
    first = np.full((len(bags), size), np.inf)
    if not bags or not sum(len(h) for h, _ in bags):
        return first
    doc = np.repeat(np.arange(len(bags)), [len(h) for h, _ in bags])
    item, weight = (np.concatenate(x) for x in zip(*bags))
    parts, band = [], 0
    while True:
        # band 0 is level 1; band k holds the levels above 2**(k - 1) up to 2**k
        below = 0 if band == 0 else 1 << (band - 1)
        here = weight > below
        if not here.any():
            break
        seed = mix(item[here] + np.array([band + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        parts.append((doc[here], seed, np.full(here.sum(), max(below, 1)), np.full(here.sum(), below), weight[here]))
        band += 1
    doc, seed, rate, below, weight = (np.concatenate(x) for x in zip(*parts))
    time, flat, latest = np.zeros(len(doc)), first.reshape(-1), np.full(len(bags), np.inf)
    step, chunk = 0, 1
    while len(doc):
        n = np.arange(step, step + chunk, dtype=np.uint64)
        draw = mix(seed[:, None] + n[None, :] * np.uint64(0xD1B54A32D192ED03))
        gap = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate[:, None]
        times = time[:, None] + np.cumsum(gap, 1)
        second = mix(draw ^ np.uint64(0xA0761D6478BD642F))
        component = (second % np.uint64(size)).astype(np.int64)
        level = below[:, None] + 1 + (((second >> np.uint64(32)) * rate[:, None].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        use = (level <= weight[:, None]) & (times < latest[doc][:, None])
        np.minimum.at(flat, (doc[:, None] * size + component)[use], times[use])
        alive_docs = np.unique(doc)
        latest[alive_docs] = first[alive_docs].max(1)
        time = times[:, -1]
        go = time < latest[doc]
        doc, seed, rate, below, weight, time = (x[go] for x in (doc, seed, rate, below, weight, time))
        step, chunk = step + chunk, min(2 * chunk, 32)
    return first


def band_keys(signature: np.ndarray, rows: int = BAND) -> np.ndarray:
    """One 64-bit key per band of every signature."""
    bits = signature.view(np.uint64).reshape(len(signature), -1, rows)
    key = np.broadcast_to(np.arange(1, bits.shape[1] + 1, dtype=np.uint64), bits.shape[:2]).copy()
    for i in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, i])
    return key


def sketch(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Parities of a bag's shingles (the k-th of equal ones apart) by hash, BITS bits as 64-bit integers.

    Two bags differ in at least as many shingles as their sketches do in bits.
    """
    k = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    each = mix(np.repeat(shingles, counts) + k.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    odd = np.bincount((each % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sign(texts: DataFrame) -> DataFrame:
    """node, its band keys, number of shingles and sketch for rows node binary, text. Texts without words share one key."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordMemory(hash64)
        for b in batches:
            for part, some in text_blocks(b, "text", BLOCK):
                bags = [bag(t, memory) for t in some]
                keys = band_keys(signatures(bags)).view(np.int64)
                rows = [k if len(x[0]) else np.zeros(1, np.int64) for k, x in zip(keys, bags)]
                sizes = pa.array([int(n.sum()) for _, n in bags], pa.int64())
                bits = pa.array([sketch(*x) for x in bags], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array(rows, pa.list_(pa.int64())), sizes, bits], ["node", "bands", "size", "bits"]
                )

    return texts.select("node", "text").mapInArrow(signed, "node binary, bands array<long>, size long, bits array<long>")


def verify(pairs: DataFrame, texts: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """``pairs`` (a, b) with their weighted Jaccard similarity, where it is at least ``similar``."""

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, last = WordMemory(hash64), (None, None)
        for b in batches:
            keep = []
            for at in range(0, b.num_rows, PAIRS):
                some = b.slice(at, PAIRS)
                for a, text_a, text_b in zip(*[some.column(c).to_pylist() for c in ("a", "text_a", "text_b")]):
                    if last[0] != a:
                        last = (a, bag(text_a, memory))
                    keep.append(weighted_jaccard(last[1], bag(text_b, memory)))
            keep = np.array(keep)
            ok = np.flatnonzero(keep >= similar)
            yield pa.RecordBatch.from_arrays(
                [b.column("a").take(pa.array(ok)), b.column("b").take(pa.array(ok)), pa.array(keep[ok], pa.float64())],
                ["a", "b", "similarity"],
            )

    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(checked, "a binary, b binary, similarity double")


def are_stars(edges: DataFrame) -> bool:
    """Whether every node of ``edges`` (u, v) is either on one edge as u, or on edges as v only."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.filter("up > 1 OR (up > 0 AND down > 0)").agg(F.count("*")).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node it is connected with) for every node of ``edges`` (a, b).

    Alternates large-star and small-star steps: neighbours are linked to the smallest one around until
    every node hangs on its root; edges that are so at once take no step. Rows are two nodes wide, and each step is
    written to the shared folder.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = write_once("edges", edges)
    while not are_stars(edges):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # at most a row per edge, so its repeats may wait for the distinct below
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = write_once("edges", small.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def tiles(members: DataFrame, tile: int = TILE) -> DataFrame:
    """``members`` (band, node, root) of buckets with more than one class, with owner and part: the tile they lie in.

    A class of more than ``tile`` members has tiles of its own (owner: its root); smaller ones are pooled, each
    class in one tile.
    """
    sizes = members.groupBy("band", "root").agg(F.count("*").alias("n"))
    pooled = F.sum(F.when(F.col("n") <= tile, F.col("n")).otherwise(0))
    mixed = sizes.groupBy("band").agg(F.count("*").alias("classes"), pooled.alias("pooled")).filter("classes > 1")
    dealt = members.join(sizes.join(mixed, "band"), ["band", "root"])
    own = F.col("n") > tile
    part = F.when(own, F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / tile))).otherwise(
        F.pmod(F.xxhash64("root"), F.greatest(F.lit(1), F.ceil(F.col("pooled") / tile)))
    )
    return dealt.select("band", "node", "root", F.when(own, F.hex("root")).otherwise("").alias("owner"), part.alias("part"))


def tile_pairs(dealt: DataFrame) -> DataFrame:
    """band, x and y: the pairs of tiles of a bucket that hold members of different classes, each once."""
    found = dealt.select("band", "owner", F.concat_ws("/", "owner", "part").alias("tile")).distinct()
    x, y = (found.select("band", F.col("owner").alias(f"{n}_owner"), F.col("tile").alias(n)) for n in "xy")
    other = (F.col("x_owner") == "") | (F.col("x_owner") != F.col("y_owner"))
    return x.join(y, "band").filter(other & (F.col("x") <= F.col("y"))).select("band", "x", "y")


def other_pairs(members: DataFrame, signed: DataFrame, roots: DataFrame, done: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Pairs (a, b) that share a band of ``members``, have different roots, are not in ``done`` and can reach ``similar``.

    Tiles of one class are not compared with one another, so a bucket of many copies and one stranger takes as many
    comparisons as it has members. Bags of x and y shingles reach ``similar`` only if they differ in at most
    (x + y) (1 - similar) / (1 + similar); pairs whose sizes or sketches differ in more are never made.
    """
    rooted = write_once("rooted", members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    dealt = write_once("tiles", tiles(rooted))
    rows = write_once("mixed", dealt.join(signed.select("node", "size", "bits"), "node").withColumn("tile", F.concat_ws("/", "owner", "part")))
    pairs = write_once("tile_pairs", tile_pairs(dealt))
    sides = [rows.withColumnRenamed("tile", n).join(pairs, ["band", n]).alias(n) for n in "xy"]
    most = (F.col("x.size") + F.col("y.size")) * ((1 - similar) / (1 + similar)) + 1e-6
    differ = sum((F.bit_count(F.col("x.bits")[k].bitwiseXOR(F.col("y.bits")[k])) for k in range(BITS // 64)), F.lit(0))
    met = sides[0].join(
        sides[1],
        (F.col("x.band") == F.col("y.band")) & (F.col("x.x") == F.col("y.x")) & (F.col("x.y") == F.col("y.y"))
        & (F.col("x.root") != F.col("y.root")) & ((F.col("x.x") < F.col("x.y")) | (F.col("x.node") < F.col("y.node")))
        & (F.abs(F.col("x.size") - F.col("y.size")) <= most) & (differ <= most),
    )
    found = met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    return found.join(done.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")


def text_node(text: Column) -> Column:
    """Name of a text: its MD5. Equal texts have one node (null counts as empty)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def classes(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """node, class_id, keeper and copies of every distinct text of ``docs`` (doc_id, text).

    class_id is the smallest doc_id among all documents whose texts are connected by links of at
    least ``similar``; keeper marks the one text per class that it names. Texts without words are alike. Every text is signed; in each band
    one centre, drawn anew for every band, is compared with the others, and those it fails to
    match get further centres of their own. Of buckets that are then not of one class all other pairs across
    classes are compared as well, so every pair that shares a band is verified, in one class already,
    or shown by its sketches to be no link. Texts that only
    occur without doc_id are compared like all others; a class without any doc_id has a null class_id.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), text_node(F.col("text")).alias("node"))
    signed = write_once("signed", sign(rows).dropDuplicates(["node"]))
    named = write_once("named", rows.select("node", "doc_id").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")))
    members = signed.select("node", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band")
    members = write_once("members", members.join(shared, "band"))
    left = members

    def verified(pairs: DataFrame) -> DataFrame:
        needed = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = write_once("wanted", needed.join(named, "node").select(F.col("node").alias("wanted"), "doc_id"))
        ids, nameless = wanted.filter("doc_id IS NOT NULL"), wanted.filter("doc_id IS NULL").drop("doc_id")
        if wanted.count() <= FEW_NODES:
            ids, nameless = F.broadcast(ids), F.broadcast(nameless)
        # the text of a node comes from its smallest doc_id, or from any of its rows if none has an id
        texts = rows.join(ids, "doc_id").filter("node = wanted").select("node", "text")
        rest = rows.filter("doc_id IS NULL").join(nameless, F.col("node") == F.col("wanted")).select("node", "text")
        texts = texts.union(rest).groupBy("node").agg(F.first("text").alias("text"))
        return write_once("links", verify(pairs, texts, similar))

    links = None
    done = None
    for _ in range(ROUNDS):
        drawn = F.min(F.struct(F.xxhash64("node", "band").alias("r"), "node"))
        centres = left.groupBy("band").agg(drawn.alias("c")).select("band", F.col("c.node").alias("centre"))
        met = left.join(centres, "band").filter("node <> centre")
        pairs = met.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = write_once("pairs", pairs)
        found = verified(pairs)
        links = found if links is None else links.union(found)
        done = pairs if done is None else done.union(pairs)
        # who does not match its centre stays for the next round, without the centre
        passed = links.select(F.col("a").alias("centre"), F.col("b").alias("node"))
        left = write_once("members", met.join(passed, ["centre", "node"], "left_anti").select("node", "band"))
        again = left.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band")
        left = left.join(again, "band")
    roots = write_once("roots", components(links.select("a", "b")))
    # what no centre connected: all other pairs across classes; their links join whole classes
    found = verified(write_once("pairs", other_pairs(members, signed, roots, done, similar)))
    ends = found.select("a", "b")
    for end in ("a", "b"):
        known = roots.select(F.col("node").alias(end), F.col("root").alias("r"))
        ends = ends.join(known, end, "left").withColumn(end, F.coalesce("r", end)).drop("r")
    joins = components(ends).select(F.col("node").alias("root"), F.col("root").alias("top"))
    roots = named.select("node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    roots = roots.join(joins, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    joined = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # rows without doc_id count last
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("best")
    best = joined.groupBy("root").agg(best).select("root", F.col("best.doc_id").alias("class_id"), F.col("best.node").alias("keeper"))
    out = joined.join(best, "root").select("node", "class_id", (F.col("node") == F.col("keeper")).alias("keeper"), "copies")
    return write_once("classes", out)


def near_duplicates(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id and class_id of every row of ``docs``. See ``classes``; an empty table gives an empty one."""
    rows = docs.select("doc_id", text_node(F.col("text")).alias("node"))
    return rows.join(classes(docs, similar), "node").select("doc_id", "class_id")


def keep_one(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class the row with the smallest doc_id.

    Repeated rows count as copies. Of a class without any doc_id one row stays.
    """
    node = free_name(docs, "node")
    rows = docs.withColumn(node, text_node(F.col("text")))
    kept = classes(docs, similar).filter("keeper").select(F.col("node").alias("k"), F.col("class_id").alias("c"))
    named = rows.join(kept, (F.col("doc_id") == F.col("c")) & (F.col(node) == F.col("k")), "left_semi")
    nth = free_name(rows, "nth")
    order = Window.partitionBy("doc_id", node).orderBy("doc_id")
    first = named.withColumn(nth, F.row_number().over(order)).filter(F.col(nth) == 1)
    nameless = kept.filter("c IS NULL")
    rest = rows.filter("doc_id IS NULL").join(nameless, F.col(node) == F.col("k"), "left_semi")
    return first.select(*docs.columns).unionByName(rest.dropDuplicates([node]).select(*docs.columns))
