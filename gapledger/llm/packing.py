"""Best-fit packing of documents into sequences of a fixed number of tokens, by sum of squares.

A sequence that is filled up to level ``h`` is an open bin. Each piece goes where the sum,
over all levels, of the squared number of open bins becomes smallest: this keeps bins of
every residual gap at hand. Pieces are dealt into shards of a bounded number of rows which
are packed side by side, longest first; what lies in bins that stay open is dealt again into
fewer shards until one shard is left, so cutting the work up costs next to nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapledger.llm.bpe import codec
from gapledger.sources.shared import write_once

#: Pieces that one task packs at a time.
SHARD = 32_768


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every piece, in the order given, and the fill of each bin.

    Moving a bin from level h to h + s changes the sum by 2 (n[h + s] - n[h]) + 2; a new bin
    by 2 n[s] + 1; closing one by 1 - 2 n[h]. Ties go to the fuller bin.
    """
    open_at = np.zeros(size + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    bins, offsets, fill = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    for i, s in enumerate(lengths.tolist()):
        level, place = 0, None
        if 0 < s < size:
            here, there = open_at[1 : size - s + 1], open_at[s + 1 : size + 1]
            change = 2 * (there - here) + 2
            change[-1] = 1 - 2 * here[-1]
            change = np.where(here > 0, change, 1 << 60)
            best = size - s - int(change[::-1].argmin())
            if change[best - 1] <= 2 * open_at[s] + 1:
                level, place = best, stacks[best].pop()
                open_at[best] -= 1
        if place is None:
            place = len(fill)
            fill.append(0)
        bins[i], offsets[i] = place, level
        fill[place] = level + s
        if 0 < level + s < size:
            open_at[level + s] += 1
            stacks[level + s].append(place)
    return bins, offsets, np.array(fill, np.int64)


def token_pieces(
    docs: DataFrame, path: str, size: int = 4096, end_id: int = 1,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Ids of every row of ``docs`` with ``end_id`` behind them, cut into pieces of ``size`` ids.

    Returns id_column, piece int, start long, length long, ids_crc32 long, lot long (a
    number that differs for every piece). Null texts count as empty: their piece holds the end
    only. Null ids and repeated rows have pieces of their own. Written once.
    """
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    last = int(end_id).to_bytes(4, "little")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, lot = codec(path), TaskContext.get().partitionId() << 40
        for b in batches:
            out = []
            for row, text in enumerate(b.column("text").to_pylist()):
                ids = c.encode(text) + last
                for n, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    out.append((row, n, at // 4, len(part) // 4, zlib.crc32(part), lot))
                    lot += 1
            row, *rest = np.array(out, np.int64).reshape(-1, 6).T
            kinds = [pa.int32(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(row)), *[pa.array(x).cast(k) for x, k in zip(rest, kinds)]],
                ["id", "piece", "start", "length", "ids_crc32", "lot"],
            )

    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long, lot long"
    return write_once("pieces", rows.mapInArrow(pieces, schema)).withColumnRenamed("id", id_column)


def pack(pieces: DataFrame, size: int = 4096, shard_rows: int = SHARD) -> DataFrame:
    """Places rows with ``length`` (0 to ``size``) and a distinct ``lot`` into sequences.

    Returns the other columns with sequence_id and offset; an empty table gives an empty table.
    A sequence is full or, for a few per shard of the last round, has a gap at its end.
    """
    columns = [c for c in pieces.columns if c != "lot"]
    left, placed, round_no, count = pieces, [], 0, pieces.count()
    while True:
        shards = max(1, -(-count // shard_rows))
        dealt = left.select("lot", "length", F.pmod(F.xxhash64("lot"), F.lit(shards)).alias("shard"))
        done = write_once(
            "packed",
            dealt.groupBy("shard").applyInPandas(
                _placer(round_no << 56, size), "lot long, sequence_id long, offset long, full boolean"
            ),
        )
        if shards == 1:
            placed.append(done)
            break
        placed.append(done.filter("full"))
        open_ones = done.filter("not full").select("lot")
        left = left.join(open_ones, "lot", "left_semi")
        count, before = open_ones.count(), count
        if count > before // 2:  # does not shrink: the shards' own open bins stay
            placed.append(done.filter("not full"))
            break
        if not count:
            break
        round_no += 1
    every = placed[0]
    for more in placed[1:]:
        every = every.unionByName(more)
    return pieces.join(every.drop("full"), "lot").select(*columns, "sequence_id", "offset")


def _placer(base: int, size: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "lot"], ascending=[False, True])
        bins, offset, fill = sum_of_squares(pdf.length.to_numpy(np.int64), size)
        return pd.DataFrame({
            "lot": pdf.lot, "sequence_id": base + (int(pdf.shard.iloc[0]) << 24) + bins,
            "offset": offset, "full": fill[bins] == size,
        })

    return place


def pack_documents(docs: DataFrame, path: str, size: int = 4096, end_id: int = 1) -> DataFrame:
    """Tokenises, cuts and packs ``docs`` (doc_id, text). See ``token_pieces`` and ``pack``."""
    return pack(token_pieces(docs, path, size, end_id), size)
