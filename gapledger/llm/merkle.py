"""Merkle manifest of a dataset: every row a leaf, one root, and a proof for every row.

Trees have runs of ``ARITY`` nodes. Leaves of a tree are put in order by ranges, numbered, and dealt to
builders of ``BUILDER`` aligned leaves each. A builder appends every node to its log once it is complete, in
postorder, so a node never moves; its place follows from the sizes of the subtrees before
it. The tops of the builders are the leaves of the next round until a tree has one top. The tops of all trees are the
leaves of the last tree.

Proofs are read from the logs from the root down: a builder's log and what its own top needs give what each
of its leaves needs, siblings being found by their computed places.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapledger.llm.frames import crc_mod, parts_for
from gapledger.sources.shared import write_once

#: Nodes in a run, levels a builder completes, and leaves it takes.
ARITY, LEVELS = 16, 3
BUILDER = ARITY**LEVELS
#: Rows that one task puts in order (some 150 bytes each), and fewest it is started for.
RANGE_ROWS, LEAST_ROWS = 1 << 20, 1 << 14
#: Bytes of a digest in a log: hexadecimal text.
DIGEST = 64
#: Key of a null source; every other one starts with "=".
NO_SOURCE = ""


def joined(*digests: bytes) -> bytes:
    """The parent of nodes, as hexadecimal text."""
    return sha256(b"".join(digests)).hexdigest().encode()


def heights(leaves: int) -> int:
    """Levels above ``leaves`` leaves until one node remains."""
    h, width = 0, leaves
    while width > 1:
        width, h = -(-width // ARITY), h + 1
    return h


def place(level: int, index: int, leaves: int) -> int:
    """Position of a node in the postorder log of a tree: what was complete before its first leaf, and its own subtree."""
    first = index * ARITY**level
    below = min(ARITY**level, leaves - first)
    before, power = 0, 1
    while power <= max(first, 1):
        before, power = before + first // power, power * ARITY
    return before + sum(-(-below // ARITY**k) for k in range(level + 1)) - 1


def append_log(leaves: list[bytes], height: int) -> bytes:
    """All nodes up to ``height`` in the order in which they become complete."""
    log, open_runs = [], [[] for _ in range(height + 1)]

    def add(level: int, node: bytes) -> None:
        log.append(node)
        if level < height:
            open_runs[level].append(node)
            if len(open_runs[level]) == ARITY:
                close(level)

    def close(level: int) -> None:
        run, open_runs[level] = open_runs[level], []
        add(level + 1, joined(*run))

    for leaf in leaves:
        add(0, leaf)
    for level in range(height):
        if open_runs[level]:
            close(level)
    return b"".join(log)


def siblings(log: bytes, level: int, index: int, leaves: int) -> tuple[bytes, bytes]:
    """Digests of the others of a node's run, those before it and those after it."""
    run = index - index % ARITY
    last = min(run + ARITY, -(-leaves // ARITY**level))

    def digests(start: int, stop: int) -> bytes:
        if level == 0 and start < stop:  # leaves of a run lie side by side
            at = DIGEST * place(0, start, leaves)
            return log[at : at + DIGEST * (stop - start)]
        places = (DIGEST * place(level, k, leaves) for k in range(start, stop))
        return b"".join(log[at : at + DIGEST] for at in places)

    return digests(run, index), digests(index + 1, last)


def fold(leaf: bytes, steps: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and its siblings, level by level, lead to."""
    for before, after in steps:
        leaf = joined(before, leaf, after)
    return leaf


@dataclass(frozen=True)
class Manifest:
    """Logs of the trees of all sources, and of the tree over them, a table for each round."""

    logs: list[DataFrame]
    root_logs: list[DataFrame]

    def root(self) -> str | None:
        """The digest of the whole dataset; None for an empty one."""
        row = self.root_logs[-1].select("top").first()
        return row.top if row else None


def value_text(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*map(value_text, columns)).cast("binary"), 256)


def number(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (key and others, written) with ``position``, their place within their key by ``order``, and ``leaves``, the key's rows.

    Ranges of (key, *order) are sorted side by side; only the numbers of rows per range and key are added up
    over ranges, so a key may hold any share of the rows.
    """
    spark = rows.sparkSession
    count = rows.count()
    parts = max(parts_for(count, RANGE_ROWS), min(int(spark.conf.get("spark.sql.shuffle.partitions")), parts_for(count, LEAST_ROWS)))
    ranged = rows.repartitionByRange(parts, "key", *order).sortWithinPartitions("key", *order)
    # the number of a row holds its partition and its place there; it is fixed once written
    ranged = write_once("merkle_order", ranged.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)))
    runs = ranged.groupBy("key", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    whole, before = Window.partitionBy("key"), Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "key", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("leaves")
    )
    return ranged.join(runs, ["key", "part"]).withColumn("position", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _height(leaves: int, blocks: int) -> int:
    """Levels that a builder completes: a tree of one builder ends as soon as one node remains."""
    return heights(leaves) if blocks == 1 else LEVELS


def build(leaves: DataFrame, payload: tuple[str, ...] = ()) -> list[DataFrame]:
    """Logs of one tree per key, a table for each round, from rows key, position, leaves, digest and ``payload`` columns.

    A log row is a builder: key, block, leaves (its own), blocks (builders of its tree in this round), log, top and, in
    the first round, the payload columns as arrays in leaf order.
    """
    rows, rounds = leaves, []
    while True:
        kept = payload if not rounds else ()
        kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
        block = F.floor(F.col("position") / BUILDER).cast("long")
        dealt = rows.select("key", block.alias("block"), "position", "leaves", "digest", *kept)
        schema = "key string, block long, leaves int, blocks long, log binary, top string"
        schema += "".join(f", `{c}` array<{kinds[c]}>" for c in kept)
        logs = write_once("merkle_log", dealt.groupBy("key", "block").applyInArrow(_builder(kept), schema))
        rounds.append(logs)
        if (logs.agg(F.max("blocks")).first()[0] or 0) <= 1:
            return rounds
        # trees with one builder are complete
        rows = logs.filter("blocks > 1").select("key", F.col("block").alias("position"), F.col("blocks").alias("leaves"), F.col("top").alias("digest"))


def _builder(payload: tuple[str, ...]) -> Callable[[tuple, pa.Table], pa.Table]:
    def built(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("position").combine_chunks()
        digests = [d.encode() for d in table.column("digest").to_pylist()]
        blocks = -(-table.column("leaves")[0].as_py() // BUILDER)
        log = append_log(digests, _height(len(digests), blocks))
        arrays = {c: table.column(c).combine_chunks() for c in payload}
        return pa.table({
            "key": pa.array([key[0].as_py()], pa.string()), "block": pa.array([key[1].as_py()], pa.int64()),
            "leaves": pa.array([len(digests)], pa.int32()), "blocks": pa.array([blocks], pa.int64()),
            "log": pa.array([log], pa.binary()), "top": pa.array([log[-DIGEST:].decode()], pa.string()),
            **{c: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for c, x in arrays.items()},
        })

    return built


def build_manifest(
    docs: DataFrame, columns: list[str], id_column: str = "doc_id", source_column: str = "source", claim: Column | None = None
) -> Manifest:
    """Logs of the trees of all sources, and of the tree of the sources, for ``docs``.

    ``columns`` make a leaf, in this order. ``claim`` is a digest that is to be verified in place of the
    row's own; null stands for the leaf itself. Digests are made where the rows lie; no text is shuffled.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(f"`{source_column}`").cast("string")), F.lit(NO_SOURCE))
    leaves = write_once("merkle_leaves", docs.select(
        key.alias("key"), F.col(f"`{id_column}`").alias("id"), leaf_digest([F.col(f"`{c}`") for c in columns]).alias("digest"),
        (F.lit(None).cast("string") if claim is None else claim).alias("claim"),
    ))
    logs = build(number(leaves, ["id", "digest"]), ("id", "claim"))
    done = [x.filter("blocks = 1").select(F.lit("").alias("key"), F.col("key").alias("source"), F.col("top").alias("digest")) for x in logs]
    # one row per source; keys sort bytewise, a null source first
    subroots = write_once("merkle_subroots", reduce(DataFrame.unionByName, done))
    return Manifest(logs, build(number(subroots, ["source"]), ("source",)))


_STEP = pa.struct([("before", pa.binary()), ("after", pa.binary())])
_STEPS = "array<struct<before:binary,after:binary>>"


def _walk(table: pa.Table) -> Iterator[tuple[int, bytes, list[tuple[bytes, bytes]]]]:
    """Number, digest and steps up to the root for every leaf of the one log in ``table``."""
    log, n, blocks = (table.column(c)[0].as_py() for c in ("log", "leaves", "blocks"))
    above = [(s["before"], s["after"]) for s in table.column("steps")[0].as_py()]
    height = _height(n, blocks)
    upper: dict[int, list[tuple[bytes, bytes]]] = {}
    for i in range(n):
        at = DIGEST * place(0, i, n)
        run = i // ARITY
        if run not in upper:
            upper = {run: [siblings(log, level, i // ARITY**level, n) for level in range(1, height)] + above}
        yield i, log[at : at + DIGEST], ([siblings(log, 0, i, n)] if height else []) + upper[run]


def _descend(logs: DataFrame, needs: DataFrame, items: str | None) -> DataFrame:
    """What each leaf of ``logs`` needs (key, item, digest, steps, root), from what their tops need (key, block, steps, root).

    ``items`` names a payload column; without it the item is the leaf's number, a builder of the round before.
    """

    def walked(key: tuple, table: pa.Table) -> pa.Table:
        found = list(_walk(table))
        named = table.column(items)[0].as_py() if items else None
        first = key[1].as_py() * BUILDER
        return pa.table({
            "key": pa.array([key[0].as_py()] * len(found), pa.string()),
            "item": pa.array(named) if items else pa.array([first + i for i, _, _ in found], pa.int64()),
            "digest": pa.array([d.decode() for _, d, _ in found], pa.string()),
            "steps": pa.array([[{"before": x, "after": y} for x, y in steps] for _, _, steps in found], pa.list_(_STEP)),
            "root": pa.array([table.column("root")[0].as_py()] * len(found), pa.string()),
        })

    kind = "string" if items else "long"
    rows = logs.select("key", "block", "leaves", "blocks", "log", *([items] if items else [])).join(needs, ["key", "block"])
    return rows.groupBy("key", "block").applyInArrow(walked, f"key string, item {kind}, digest string, steps {_STEPS}, root string")


def _all_needs(logs: list[DataFrame], tops: DataFrame, items: str | None = None) -> DataFrame:
    """What the tops of the first round's builders need, from what whole trees need (key, steps, subroot, root)."""
    needs = None
    for r in range(len(logs) - 1, -1, -1):
        whole = logs[r].filter("blocks = 1").select("key", "block").join(tops, "key")
        needs = whole if needs is None else needs.unionByName(whole)
        if r:
            lower = _descend(logs[r], needs, None).select("key", F.col("item").alias("block"), "steps", "root")
            # the subroot is the tree's, whatever the round
            needs = write_once("merkle_needs", lower.join(tops.select("key", "subroot"), "key").select("key", "block", "steps", "subroot", "root"))
    return needs


def prove(manifest: Manifest, whole: bool = False) -> DataFrame:
    """A row for every leaf: id, leaf, subroot, root, proof_sha256, folded_root, verified; with ``whole`` also proof.

    A proof holds the digests of the other nodes of every run on the way to the root, level by level, left to right.
    folded_root is what the claim (or the leaf, if there is none) leads to with these siblings.
    """
    top = manifest.root_logs[-1].select(
        "key", F.expr(f"CAST(array() AS {_STEPS})").alias("steps"), F.lit("").alias("subroot"), F.col("top").alias("root")
    )
    needs = _all_needs(manifest.root_logs, top).select("key", "block", "steps", "root")
    sources = _descend(manifest.root_logs[0], needs, "source")
    tops = write_once("merkle_needs", sources.select(F.col("item").alias("key"), "steps", F.col("digest").alias("subroot"), "root"))
    first = manifest.logs[0]
    kind = first.schema["id"].dataType.elementType.simpleString()

    def proven(key: tuple, table: pa.Table) -> pa.Table:
        claims = table.column("claim")[0].as_py()
        root, subroot = table.column("root")[0].as_py(), table.column("subroot")[0].as_py()
        leaves, proofs, folded = [], [], []
        for (_, leaf, steps), claim in zip(_walk(table), claims):
            leaves.append(leaf.decode())
            proofs.append(b"".join([x for step in steps for x in step]))
            folded.append(fold(leaf if claim is None else claim.encode(), steps).decode())
        n = len(leaves)
        return pa.table({
            "id": table.column("id").combine_chunks().values, "leaf": pa.array(leaves, pa.string()),
            "subroot": pa.array([subroot] * n, pa.string()), "root": pa.array([root] * n, pa.string()),
            "proof_sha256": pa.array([sha256(p).hexdigest() for p in proofs], pa.string()),
            "folded_root": pa.array(folded, pa.string()), "verified": pa.array([f == root for f in folded], pa.bool_()),
            **({"proof": pa.array([p.decode() for p in proofs], pa.string())} if whole else {}),
        })

    schema = f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    schema += ", proof string" * whole
    rows = first.join(_all_needs(manifest.logs, tops), ["key", "block"])
    return rows.groupBy("key", "block").applyInArrow(proven, schema)


def audit(docs: DataFrame, every: int = 5) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row of ``docs`` (a table like documents).

    Rows whose crc32 of the id is divisible by ``every`` are verified with A-Z of their text in lower case; where
    that changes the text, verification fails. Nulls anywhere make a leaf of their own; rows without id come first
    and count as the empty text for the crc; rows with equal ids are ordered by leaf; repeated rows are leaves of their own. Other columns
    are not read; an empty table gives an empty one.
    """
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    lower = F.translate(F.col("text").cast("string"), ascii_uppercase, ascii_lowercase)
    lowered = leaf_digest([lower if c == "text" else F.col(c) for c in columns])
    claim = F.when(crc_mod(F.col("doc_id"), every) == 0, lowered)
    return prove(build_manifest(docs, columns, claim=claim)).withColumnRenamed("id", "doc_id")


__all__ = ["Manifest", "append_log", "audit", "build_manifest", "fold", "place", "prove", "siblings"]
