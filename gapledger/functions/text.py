"""Text columns: cleaning, sentence chunks, tokens and per-row term counts.

All of it is built from Spark SQL functions, so no row leaves the JVM, and none of
it shuffles: a document's chunks, tokens and term counts depend on that row alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gapledger import constants as C

# One white-space character as Python's ``\s`` sees it (Java's is ASCII only).
SPACE = r"[\s\p{Z}\x{0085}\x{000B}\x{001C}-\x{001F}]"
NON_WORD = r"[^\p{L}\p{N}_]+"
# The patterns below look at the plain characters first, which most of a text is made of: the class of
# white space takes many times longer to say no.
ENDS = rf"(?=[^!-~])(?:^{SPACE}+|{SPACE}+$)"
# White-space runs other than one plain space.
UNEVEN = rf"(?=[^!-~])(?:{SPACE}{{2,}}|(?! ){SPACE})"
TAG = r"<[^>]+>"
CURLY_QUOTES = "‘’“”"
STRAIGHT_QUOTES = "''\"\""


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A plain column used inside a lambda would be computed again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Drop white space of any kind at both ends (``trim`` drops spaces only)."""
    return F.regexp_replace(text, ENDS, "")


def clean_text(text: Column) -> Column:
    """Tags to spaces, curly quotes to straight ones, white-space runs to one space."""

    def straight(t: Column) -> Column:
        curly = reduce(Column.__or__, [F.contains(t, F.lit(quote)) for quote in CURLY_QUOTES])
        return F.when(curly, F.translate(t, CURLY_QUOTES, STRAIGHT_QUOTES)).otherwise(t)

    def untagged(t: Column) -> Column:
        return F.when(F.contains(t, F.lit("<")), F.regexp_replace(t, TAG, " ")).otherwise(t)

    text = bind(bind(F.coalesce(text, F.lit("")), untagged), straight)
    return F.trim(F.regexp_replace(text, UNEVEN, " "))


def sentence_chunks(text: Column, longer_than: int = C.SHORT_SENTENCE) -> Column:
    """Sentences longer than the limit; the whole text if none is, so no row is lost."""

    def keep(whole: Column) -> Column:
        pieces = F.split(whole, rf"(?<=[.!?]){SPACE}+")
        kept = F.filter(F.transform(pieces, strip), lambda s: F.length(s) > longer_than)
        return bind(kept, lambda k: F.when(F.size(k) > 0, k).otherwise(F.array(whole)))

    return bind(F.coalesce(text, F.lit("")), keep)


def _longer(tokens: Column, stopwords: Iterable[str], min_length: int) -> Column:
    words = list(stopwords)

    def wanted(token: Column) -> Column:
        long_enough = F.length(token) >= min_length
        return long_enough & ~token.isin(words) if words else long_enough

    return F.filter(tokens, wanted)


def word_tokens(
    text: Column,
    stopwords: Iterable[str] = C.INDEX_STOPWORDS,
    min_length: int = C.MIN_TOKEN_LENGTH,
) -> Column:
    """Lower-case runs of letters, digits and underscore of any script."""
    return _longer(F.split(F.lower(text), NON_WORD), stopwords, min_length)


def ascii_tokens(
    text: Column,
    stopwords: Iterable[str] = (*C.ENGLISH_STOPWORDS, *C.BANKING_STOPWORDS),
    min_length: int = C.MIN_TOKEN_LENGTH,
) -> Column:
    """What RegexTokenizer(``\\W``) and StopWordsRemover give: ASCII words only."""
    return _longer(F.split(F.lower(text), r"\W"), stopwords, min_length)


def runs(size: Column, starts_here: Callable[[Column], Column], make: Callable) -> Column:
    """Cut positions 0..size-1 into runs and build one element per run.

    ``starts_here(i)`` tells whether a run starts at ``i``; ``make(i, length)`` builds it.
    """
    starts = F.filter(F.sequence(F.lit(0), size - 1), starts_here)
    return bind(
        starts,
        lambda s: F.transform(
            s, lambda i, j: make(i, F.coalesce(F.get(s, j + 1), size) - i)
        ),
    )


def term_counts(tokens: Column) -> Column:
    """Distinct terms of one row with their counts, in term order.

    Sorting the tokens puts equal ones side by side, so a count is the length of a
    run: n log n in the row, where exploding and grouping would shuffle every
    (document, term) pair of the corpus.
    """

    def count(ordered: Column) -> Column:
        size = F.size(ordered)
        return F.when(
            size > 0,
            runs(
                size,
                lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
                lambda i, n: F.struct(F.get(ordered, i).alias("term"), n.alias("n_term")),
            ),
        )

    return bind(F.sort_array(tokens), count)


def fill(template: str, **columns: Column) -> Column:
    """A template with ``{name}`` marks as one concatenation; null columns read as ''."""
    parts: list[Column] = []
    rest = template
    while "{" in rest:
        before, _, after = rest.partition("{")
        name, _, rest = after.partition("}")
        if before:
            parts.append(F.lit(before))
        parts.append(F.coalesce(columns[name].cast("string"), F.lit("")))
    if rest:
        parts.append(F.lit(rest))
    return F.concat(*parts)
