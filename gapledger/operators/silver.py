"""Silver chunks: cleaned text, one row per sentence. No shuffle, no Python worker."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapledger import constants as C
from gapledger.functions.text import bind, clean_text, runs, sentence_chunks

POLICY_KEYS = ("policy_id", "domain", "section", "title")
CIRCULAR_KEYS = ("circular_id", "circular_ref", "subject", "category")


def chunk_rows(
    df: DataFrame, keys: Iterable[str], text: Column, source_type: str
) -> DataFrame:
    """One row per element of ``text`` (an array), numbered from 0; the first key names it."""
    keys = list(keys)
    return df.select(
        *keys, F.posexplode(text).alias("chunk_index", "chunk_text")
    ).withColumns(
        {
            "chunk_id": F.concat(
                F.col(keys[0]).cast("string"), F.lit("_"), F.col("chunk_index").cast("string")
            ),
            "source_type": F.lit(source_type),
        }
    )


def silver_chunks(
    df: DataFrame, keys: Iterable[str], text_col: str, source_type: str
) -> DataFrame:
    """Clean ``text_col`` and split it into sentence chunks."""
    return chunk_rows(df, keys, sentence_chunks(clean_text(F.col(text_col))), source_type)


def silver_policies(bronze: DataFrame) -> DataFrame:
    return silver_chunks(bronze, POLICY_KEYS, "policy_text", C.POLICY_TAG)


def silver_circulars(bronze: DataFrame) -> DataFrame:
    return silver_chunks(bronze, CIRCULAR_KEYS, "circular_text", C.CIRCULAR_TAG)


def joined_runs(chunks: Column, starts_here, separator: str = " ") -> Column:
    """Neighbouring chunks joined into longer ones; a run starts where ``starts_here`` says."""

    def join(parts: Column) -> Column:
        return runs(
            F.size(parts),
            lambda i: (i == 0) | starts_here(parts, i),
            lambda i, n: F.array_join(F.slice(parts, i + 1, n), separator),
        )

    return bind(chunks, join)


def sentence_pairs(chunks: Column) -> Column:
    """Two sentences per chunk; the last one may stand alone."""
    return joined_runs(chunks, lambda parts, i: i % 2 == 0)


def directive_blocks(
    chunks: Column, cues: Iterable[str] = ("shall", "must", "required", "supersedes")
) -> Column:
    """A block per sentence that holds a cue word, with the sentences after it."""
    words = "|".join(rf"\Q{cue}\E" for cue in cues)
    pattern = rf"(?i)(?<![\p{{L}}\p{{N}}_])({words})(?![\p{{L}}\p{{N}}_])"
    return joined_runs(chunks, lambda parts, i: F.get(parts, i).rlike(pattern))
