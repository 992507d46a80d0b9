"""Gap analysis of all circulars in one job: matches, prompts, answers, graded sections."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapledger import constants as C
from gapledger.operators import report as R
from gapledger.operators.index import Index
from gapledger.operators.respond import BatchResponder, respond
from gapledger.operators.retrieve import query_source, retrieve, with_records


@dataclass(frozen=True)
class CircularColumns:
    key: str = "circular_id"
    ref: str = "circular_ref"
    subject: str = "subject"
    deadline: str = "compliance_deadline"
    text: str = "text"
    custom: str | None = None


def with_query_text(
    circulars: DataFrame, columns: CircularColumns, prompt_uses_custom: bool = True
) -> DataFrame:
    """Add ``query_text`` (searched) and ``prompt_text`` (quoted).

    Pasted text replaces both; with ``prompt_uses_custom=False`` only the searched one.
    """
    own: Column = F.col(columns.text)
    used = own if columns.custom is None else query_source(F.col(columns.custom), own)
    return circulars.withColumns(
        {"query_text": used, "prompt_text": used if prompt_uses_custom else own}
    )


def gap_matches(
    index: Index, circulars: DataFrame, key: str, text: str, record_columns: list[str],
    k: int = C.PANEL_K,
) -> DataFrame:
    """Top k policies of every circular with bars, tiers and record columns."""
    hits = R.match_bars(retrieve(index, circulars, key, text, k), key)
    return with_records(hits, index.corpus, index.doc_id, record_columns)


def prompts_for(
    index: Index, circulars: DataFrame, columns: CircularColumns, section: str,
    k: int = C.PROMPT_K, prompt_uses_custom: bool = True,
) -> DataFrame:
    """The gap prompt of every circular."""
    wanted = with_query_text(circulars, columns, prompt_uses_custom)
    hits = with_records(
        retrieve(index, wanted, columns.key, "query_text", k),
        index.corpus, index.doc_id, [section, index.text],
    )
    blocks = R.policy_blocks(hits, columns.key, index.doc_id, section, index.text, k)
    return R.gap_prompts(
        wanted, blocks, columns.key,
        F.col(columns.ref), F.col(columns.subject), F.col(columns.deadline),
        F.col("prompt_text"),
    )


def answered(
    prompts: DataFrame, circulars: DataFrame, key: str, reports: DataFrame, default: str,
    answer: BatchResponder | None = None,
) -> DataFrame:
    """A report per circular: the responder's if one is given, canned otherwise or on error."""
    canned = R.lookup_reports(circulars, reports, key, default)
    if answer is None:
        return canned
    replies = respond(prompts, key, "prompt", answer)
    # a failed report is replaced without a note; chat answers have one
    return canned.join(replies, key, "left").withColumn(
        "report", F.coalesce("answer", "report")
    )
