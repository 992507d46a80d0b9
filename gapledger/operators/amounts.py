"""Amounts of money and number-with-unit requirements in text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapledger.sources.shared import write_once

#: Matches whose quantities meet in one task.
MATCH_ROWS = 100_000
MONEY = r"(?i)(\b(?:INR|Rs\.?)|₹)\s*([0-9][0-9,]*(?:\.[0-9]+)?)((?:\s+(?:lakh|crore))*)\b"
LAKH = 100_000
CRORE = 10_000_000
_NUMBER = r"[0-9]+(?:,[0-9]+)*(?:\.[0-9]+)?"
# What bounds a number from below or above when it stands before it.
AT_LEAST = ("at least", "minimum of", "not less than", "no less than", "more than", "not under")
AT_MOST = ("within", "at most", "up to", "maximum of", "not more than", "no more than", "less than", "not over")
# Groups: bound, number, second number of a range, unit. A number starts where no digit, point or comma is before it.
QUANTITY = (
    rf"(?i)(?:\b({'|'.join(AT_LEAST + AT_MOST).replace(' ', chr(92) + 's+')})\s+)?(?<![0-9.,])(?<![0-9]-)({_NUMBER})"
    rf"(?:\s*(?:to|-|–)\s*({_NUMBER}))?[\s-]*(%|(?:hour|hr|day|month|year|minute)s?\b)"
)
# Unit in the singular: the unit it is measured in, and how many of that it is.
SCALES = {
    "minute": ("minute", 1), "hour": ("minute", 60), "day": ("minute", 1440),
    "month": ("month", 1), "year": ("month", 12), "%": ("%", 1),
}


def normalize_currency(text: Column) -> Column:
    """``Rs. 1,00,000`` and ``₹ 1,00,000`` to ``INR 100000``, however long; other commas stay."""
    text = F.regexp_replace(text, r"(?i)(?:\bINR|\bRs\.?|₹)\s*(?=[0-9])", "INR ")
    # each match goes on where the one before it ended, from the amount's start to its last comma
    return F.regexp_replace(text, r"(\bINR |(?!^)\G)([0-9]+),(?=[0-9])", "$1$2")


def money_amounts(df: DataFrame, key: str, text: str) -> DataFrame:
    """Every amount in the text in rupees, lakh and crore multiplied out.

    An amount that decimal(20,2) does not hold has no rupees and is marked ``too_large``.
    """
    found = F.regexp_extract_all(F.col(text), F.lit(MONEY), F.lit(0))
    units = F.lower(F.regexp_extract("amount_text", MONEY, 3))
    digits = F.replace(F.regexp_extract("amount_text", MONEY, 2), F.lit(","), F.lit(""))
    lakhs = F.when(F.contains(units, F.lit("lakh")), LAKH).otherwise(1).cast("decimal(8,0)")
    crores = F.when(F.contains(units, F.lit("crore")), CRORE).otherwise(1).cast("decimal(8,0)")
    rupees = (digits.try_cast("decimal(20,2)") * lakhs * crores).try_cast("decimal(20,2)")
    return df.select(
        key, F.posexplode(found).alias("amount_index", "amount_text")
    ).withColumn("rupees", rupees).withColumn("too_large", F.col("rupees").isNull())


def quantities(df: DataFrame, key: str, text: str) -> DataFrame:
    """Distinct quantities per row: number, unit, base, low and high. No shuffle.

    A number is taken whole, with its separators (``1,00,000``). ``unit`` is in the singular; ``base``
    is the unit it is measured in (minutes for minutes, hours and days; months for months and years). ``low``
    and ``high`` bound the quantity in ``base``: both ends of a range (``10 to 15 days``, whose number is its first),
    no upper end after words such as ``at least``, from 0 on after words such as ``within``, else the number itself.
    """

    def read(q: Column) -> Column:
        def digits(group: int) -> Column:
            return F.replace(F.regexp_extract(q, QUANTITY, group), F.lit(","), F.lit("")).try_cast("double")

        unit = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(q, QUANTITY, 4)), "s$", ""), "^hr$", "hour")
        bound = F.regexp_replace(F.lower(F.regexp_extract(q, QUANTITY, 1)), r"\s+", " ")
        return F.struct(bound.alias("bound"), digits(2).alias("number"), digits(3).alias("second"), unit.alias("unit"))

    def measured(q: Column) -> Column:
        scale, base = (F.create_map(*[F.lit(x) for u, v in SCALES.items() for x in (u, v[i])]) for i in (1, 0))
        number, second = q["number"], F.coalesce(q["second"], q["number"])
        times = F.element_at(scale, q["unit"])
        low = F.when(q["bound"].isin(*AT_MOST), 0.0).otherwise(F.least(number, second) * times)
        high = F.when(q["bound"].isin(*AT_LEAST), float("inf")).otherwise(F.greatest(number, second) * times)
        return F.struct(
            number.alias("number"), q["unit"].alias("unit"), F.element_at(base, q["unit"]).alias("base"),
            low.alias("low"), high.alias("high"),
        )

    every = F.regexp_extract_all(F.col(text), F.lit(QUANTITY), F.lit(0))
    return df.select(key, F.inline(F.array_distinct(F.transform(F.transform(every, read), measured))))


def requirement_conflicts(
    matches: DataFrame, query_id: str, doc_id: str,
    query_quantities: DataFrame, doc_quantities: DataFrame,
) -> DataFrame:
    """Best matches whose texts give quantities of one kind that cannot both hold.

    A requirement and a stated quantity agree if their bounds overlap; a requirement that any stated one agrees with
    is dropped. ``stated`` lists the document's numbers in the requirement's unit.

    Many matches are dealt out by their number: quantities repeat and shrink when shuffled, so their
    bytes do not tell Spark how many rows a task will sort.
    """
    best = write_once("best-matches", matches.where(F.col("rank") == 1).select(query_id, doc_id))
    parts = -(-best.count() // MATCH_ROWS)
    cores = best.sparkSession.sparkContext.defaultParallelism

    def dealt(df: DataFrame, *keys: str) -> DataFrame:
        return df.repartition(parts, *keys) if parts > cores else df

    def named(df: DataFrame, number: str) -> DataFrame:
        names = {"number": number, "unit": f"{number}_unit", "low": f"{number}_low", "high": f"{number}_high"}
        return df.withColumnsRenamed(names)

    required = dealt(best, query_id).join(dealt(named(query_quantities, "required"), query_id), query_id)
    pairs = dealt(required, doc_id, "base").join(
        dealt(named(doc_quantities, "stated"), doc_id, "base"), [doc_id, "base"]
    )
    scale = F.create_map(*[F.lit(x) for u, v in SCALES.items() for x in (u, float(v[1]))])
    overlap = (F.col("required_low") <= F.col("stated_high")) & (F.col("stated_low") <= F.col("required_high"))
    converted = F.when(F.col("stated_unit") == F.col("required_unit"), F.col("stated")).otherwise(
        F.col("stated") * F.element_at(scale, F.col("stated_unit")) / F.element_at(scale, F.col("required_unit"))
    )
    # with the base, which the unit gives, the rows of a group lie together already
    asked = [query_id, doc_id, "base", "required_unit", "required", "required_low", "required_high"]
    return (
        pairs.groupBy(*asked)
        .agg(F.max(overlap).alias("met"), F.array_sort(F.collect_set(converted)).alias("stated"))
        .where("NOT met")
        .select(query_id, doc_id, F.col("required_unit").alias("unit"), "required", "stated")
    )
