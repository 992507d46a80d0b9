"""Gap reports: labels, match bars, prompts, canned reports, graded sections, export, counts.

Joined tables are small sides only by the caller's choice: nothing here is forced to be
broadcast, Spark measures the sides and picks. Ordered text is put together from at most
k matches per circular.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapledger import constants as C
from gapledger.functions.text import fill, strip


def label(key: Column, subject: Column) -> Column:
    """Picker label: id and the start of the subject, dots always added."""
    return F.concat(
        key.cast("string"), F.lit(" — "), F.substring(subject, 1, C.LABEL_CHARS), F.lit("...")
    )


def preview(text: Column) -> Column:
    return F.concat(F.substring(text, 1, C.PREVIEW_CHARS), F.lit("..."))


def by_label(circulars: DataFrame, key: str, subject: str, labels: DataFrame) -> DataFrame:
    """Records picked by label; ``labels`` has one column, ``label``."""
    shown = circulars.withColumn("label", label(F.col(key), F.col(subject)))
    return labels.join(shown, "label")


def tier(score: Column) -> Column:
    return (
        F.when(score > C.RED_ABOVE, C.TIER_RED)
        .when(score > C.YELLOW_ABOVE, C.TIER_YELLOW)
        .otherwise(C.TIER_WHITE)
    )


def bar_percent(score: Column, top: Column) -> Column:
    """Whole percent of the best score, cut off, not rounded."""
    return (score * 100 / F.greatest(top, F.lit(C.BAR_FLOOR))).cast("int")


def match_bars(hits: DataFrame, query_id: str) -> DataFrame:
    """Bar length and tier per hit; at most k hits share a query."""
    top = F.max("score").over(Window.partitionBy(query_id))
    return hits.withColumns(
        {"bar_pct": bar_percent(F.col("score"), top), "tier": tier(F.col("score"))}
    )


def join_lines(line: Column, order: Column, separator: str) -> Column:
    """Aggregate: lines of one group in the given order. Groups are at most k rows."""
    ordered = F.array_sort(F.collect_list(F.struct(order.alias("o"), line.alias("l"))))
    return F.array_join(F.transform(ordered, lambda x: x["l"]), separator)


def policy_blocks(
    hits: DataFrame, query_id: str, policy_id: str, section: str, text: str,
    top: int = C.PROMPT_K,
) -> DataFrame:
    """The ``top`` best matches of each circular as one text block."""
    line = fill(
        C.GAP_POLICY_TEMPLATE,
        id=F.col(policy_id),
        section=F.col(section),
        score=F.format_string("%.4f", F.col("score")),
        text=F.col(text),
    )
    return (
        hits.where(F.col("rank") <= top)
        .groupBy(query_id)
        .agg(join_lines(line, F.col("rank"), "").alias("policies"))
    )


def gap_prompts(
    circulars: DataFrame, blocks: DataFrame, query_id: str,
    ref: Column, subject: Column, deadline: Column, text: Column,
) -> DataFrame:
    """One prompt per circular, with or without matches."""
    return circulars.join(blocks, query_id, "left").select(
        query_id,
        fill(
            C.GAP_PROMPT_TEMPLATE,
            ref=ref, subject=subject, deadline=deadline, text=text, policies=F.col("policies"),
        ).alias("prompt"),
    )


def short_prompts(hits: DataFrame, query_id: str, text: Column, policy_text: Column) -> DataFrame:
    """The short prompt: the circular and its best match only."""
    return hits.where(F.col("rank") == 1).select(
        query_id, fill(C.SHORT_PROMPT_TEMPLATE, text=text, policy=policy_text).alias("prompt")
    )


def lookup_reports(
    circulars: DataFrame, reports: DataFrame, key: str, default: str
) -> DataFrame:
    """Written report per circular, else the default. ``reports`` has the key and ``report``."""
    return circulars.join(reports, key, "left").withColumn(
        "report", F.coalesce(F.col("report"), F.lit(default))
    )


def fallback(answer: Column, error: Column, canned: Column) -> Column:
    """Responder's answer; canned text if it has none; canned text behind an error note."""
    failed = F.concat(fill(C.ERROR_PREFIX, error=error), canned)
    return F.when(error.isNotNull(), failed).otherwise(F.coalesce(answer, canned))


GRADES = (
    ("critical", C.GRADE_CRITICAL, C.GRADE_SUBJECT),
    ("high", C.GRADE_HIGH, C.GRADE_SUBJECT),
)
# Levels that have a colour but that grading never assigns by itself.
MORE_GRADES = (*GRADES, ("medium", "MEDIUM", C.GRADE_SUBJECT), ("low", "LOW", C.GRADE_SUBJECT))


def grade(section: Column, grades: Iterable[tuple[str, str, str]] = GRADES) -> Column:
    """First grade whose word occurs in any case along with its subject in exact case."""
    result = None
    for name, word, subject in grades:
        hit = F.contains(F.upper(section), F.lit(word)) & F.contains(section, F.lit(subject))
        result = F.when(hit, name) if result is None else result.when(hit, name)
    return result.otherwise("plain")


def report_sections(
    reports: DataFrame, key: str, report: str,
    grades: Iterable[tuple[str, str, str]] = GRADES,
) -> DataFrame:
    """Sections between blank lines, graded, as markup. Blank plain sections are dropped."""
    return (
        reports.select(
            key, F.posexplode(F.split(F.col(report), "\n\n")).alias("section_index", "section")
        )
        .withColumn("grade", grade(F.col("section"), grades))
        .where((F.col("grade") != "plain") | (F.length(strip(F.col("section"))) > 0))
        .withColumn(
            "markup",
            F.when(F.col("grade") == "plain", F.col("section")).otherwise(
                F.replace(F.col("section"), F.lit("\n"), F.lit("<br>"))
            ),
        )
    )


def report_export(reports: DataFrame, key: str, ref: Column, report: Column,
                  as_of: Column | None = None) -> DataFrame:
    """Export text and file name per circular, dated today unless told otherwise."""
    day = F.date_format(F.current_date() if as_of is None else as_of, "yyyyMMdd")
    return reports.select(
        key,
        F.concat(F.lit("gap_analysis_"), F.col(key).cast("string"), F.lit("_"), day, F.lit(".txt"))
        .alias("file_name"),
        fill(C.EXPORT_TEMPLATE, ref=ref, report=report).alias("export_text"),
    )


def write_exports(exports: DataFrame, folder: str) -> None:
    """Write export texts, many per text file."""
    exports.select("export_text").write.mode("overwrite").text(folder)


def gap_matrix(gaps: DataFrame, policies: DataFrame, policy_id: str, section: str) -> DataFrame:
    """Known gaps with the section of the policy they concern, if the policy exists."""
    return gaps.join(policies.select(policy_id, section), policy_id, "left")


def kpis(policies: DataFrame, circulars: DataFrame, matches: DataFrame, gaps: DataFrame,
         provider: str) -> DataFrame:
    """Headline counts as one row, each from a count over its own table."""

    def rows(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    return policies.sparkSession.range(1).select(
        rows(policies).alias("n_policies"),
        rows(circulars).alias("n_circulars"),
        rows(matches).alias("n_matches"),
        rows(gaps).alias("n_open_gaps"),
        F.split_part(F.lit(provider), F.lit(" "), F.lit(1)).alias("provider"),
    )


