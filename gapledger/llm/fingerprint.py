"""Document fingerprints: bottom-k sketches of word shingles, in Spark functions only.

A sketch is the sorted list of the ``SIZE`` smallest distinct 64-bit hashes of a text's
shingles of ``WORDS`` words (a shorter text is one shingle). Sketches of parts merge
into the sketch of the whole, and two sketches estimate how far their texts resemble or contain each
other; one sketch estimates how many distinct shingles its text has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapledger.llm.frames import parts_for

#: Words in a shingle, hashes in a sketch.
WORDS, SIZE = 5, 128
#: Hashes are spread over this range.
LEAST, RANGE = -(2.0**63), 2.0**64
#: Rows in a range of ids that one task puts in order.
RANGE_ROWS = 4_096


def sketch(text: Column, words: int = WORDS, size: int = SIZE) -> Column:
    """Bottom-k sketch of a text (null: empty) as array<bigint>; a text without words has an empty one."""
    blank = " \t\n\x0b\x0c\r"
    found = F.split(F.trim(F.coalesce(text, F.lit("")), F.lit(blank)), "[\\x20\\x09-\\x0D]+")

    def smallest(w: Column) -> Column:
        runs = F.transform(
            F.slice(w, F.lit(1), F.greatest(F.size(w) - (words - 1), F.lit(1))),
            lambda first, i: F.xxhash64(first, *[F.get(w, i + n) for n in range(1, words)]),
        )
        return F.when(F.get(w, F.lit(0)) == "", F.array().cast("array<bigint>")).otherwise(
            F.slice(F.sort_array(F.array_distinct(runs)), 1, size)
        )

    # the words are split once: a variable of a lambda, not an expression that is written out again
    return F.element_at(F.transform(F.array(found), smallest), 1)


def merge(a: Column, b: Column, size: int = SIZE) -> Column:
    """Sketch of the union of two parts."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, size)


def merge_parts(parts: DataFrame, key: str, sketch_column: str, size: int = SIZE) -> DataFrame:
    """Sketch per key over any number of parts: columns key, sketch. Keys of empty sketches only are kept.

    Each task keeps its ``size`` smallest hashes per key before rows are shuffled, so a key with
    very many parts is no large group.
    """
    hashes = parts.select(F.col(key).alias("key"), F.explode_outer(sketch_column).alias("hash")).distinct()
    smallest = Window.partitionBy("key").orderBy(F.asc_nulls_last("hash"))
    kept = hashes.withColumn("n", F.row_number().over(smallest)).filter(F.col("n") <= size)
    return kept.groupBy("key").agg(F.sort_array(F.collect_list("hash")).alias("sketch")).withColumnRenamed("key", key)


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated Jaccard similarity: the share of the union's sketch that both have. Two empty sketches: 1."""
    union = merge(a, b, size)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union))


def distinct_shingles(a: Column, size: int = SIZE) -> Column:
    """Estimated number of distinct shingles; exact below ``size``."""
    last = (F.element_at(a, size).cast("double") - LEAST + 1) / RANGE
    return F.when(F.size(a) < size, F.size(a).cast("double")).otherwise((size - 1) / last)


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of a's shingles that b has too. An empty a is contained in everything: 1."""
    shared = resemblance(a, b, size) * distinct_shingles(merge(a, b, size), size)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, size)))


def as_text(a: Column) -> Column:
    """A sketch as a string: 16 hexadecimal digits for each hash, in order."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def with_next(docs: DataFrame, carry: list[tuple[str, Column]] = (), rows_per_range: int = RANGE_ROWS) -> DataFrame:
    """doc_id, text and the text of the next row by ascending doc_id (``next_text``; after the last: the first).

    ``carry`` names further columns, each of which also gets a ``next_`` column.

    Rows with equal ids are ordered by text; rows without id come first. Ids are cut into ranges
    that start at ids of the table, so each range ends with a copy of the first rows of the next one, and
    no task sees more than one range. Null texts count as empty.
    """
    least = -(2**63)
    carried = [c for c, _ in carry]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *[e.alias(c) for c, e in carry], F.coalesce(F.col("doc_id").cast("long"), F.lit(least)).alias("key"))
    keys = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(least)).alias("key"))
    count = keys.count()
    ranges = parts_for(count, rows_per_range)
    # the bounds are ids of the table
    quantiles = [i / ranges for i in range(ranges)]
    found = keys.agg(F.percentile_approx("key", F.array(*map(F.lit, quantiles)), F.lit(10 * ranges + 100)).alias("q"), F.min("key").alias("low")).first()
    bounds = sorted({found.low, *(found.q or [])}) if count else [least]
    table = F.lit(bounds)
    steps = [1 << i for i in range(len(bounds).bit_length() - 1, -1, -1)]
    # the last bound not above the key, found by halving
    place = F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda at, step: F.when((at + step < len(bounds)) & (F.get(table, at + step) <= F.col("key")), at + step).otherwise(at),
    )
    placed = rows.withColumn("range", place)
    first = F.get(table, F.col("range")) == F.col("key")
    before = F.pmod(F.col("range") - 1, F.lit(len(bounds)))
    dealt = placed.select(
        "doc_id", "text", "key", *carried,
        F.explode(
            F.when(first, F.array(F.struct(F.col("range"), F.lit(False).alias("guest")), F.struct(before.alias("range"), F.lit(True).alias("guest"))))
            .otherwise(F.array(F.struct(F.col("range"), F.lit(False).alias("guest"))))
        ).alias("at"),
    ).select("doc_id", "text", "key", *carried, "at.range", "at.guest")
    order = Window.partitionBy("range").orderBy("guest", "key", "text")
    following = {f"next_{c}": F.lead(c).over(order) for c in ("text", *carried)}
    return dealt.withColumns(following).filter("NOT guest").select("doc_id", "text", *carried, *following)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text.

    Edited: the last floor(n / 2) characters are replaced by as many of the next document's
    first ones (all, if it has fewer). Null texts count as empty; a table of one document has
    itself as the next; an empty table gives an empty one. Returns doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, distinct_shingles, contained_in_edited.
    """
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring(F.col("next_text"), F.lit(1), half)
    )
    # a text's sketch travels with it, so that the next row's need not be made anew
    rows = with_next(docs, [("own", sketch(F.col("text")))]).withColumn("n_chars", F.char_length("text").cast("long"))
    # the edited text is written once: a variable of a lambda
    both = F.transform(F.array(edited), lambda t: F.struct(F.sha2(t, 256).alias("sha"), sketch(t).alias("sketch")))
    sketched = rows.select("doc_id", "n_chars", "own", "next_own", F.get(both, F.lit(0)).alias("new"))
    own, new, following = F.col("own"), F.col("new.sketch"), F.col("next_own")
    return sketched.select(
        "doc_id", "n_chars", F.col("new.sha").alias("edited_sha256"),
        as_text(own).alias("fingerprint"), as_text(new).alias("edited_fingerprint"),
        resemblance(own, new).alias("near_edited"), resemblance(own, following).alias("near_next"),
        distinct_shingles(own).alias("distinct_shingles"), containment(own, new).alias("contained_in_edited"),
    )
