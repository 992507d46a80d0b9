import random

import pytest
from pyspark.sql import functions as F

import brute
from gapledger import constants as C
from gapledger.functions import text as T
from gapledger.functions.text import (
    ascii_tokens,
    clean_text,
    fill,
    sentence_chunks,
    strip,
    term_counts,
    word_tokens,
)
from gapledger.operators.silver import (
    directive_blocks,
    sentence_pairs,
    silver_policies,
)
from gapledger.sources.bronze import POLICY_SCHEMA, rows_to_bronze, with_dates


def apply(spark, function, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    rows = df.select("i", function(F.col("t")).alias("r")).orderBy("i").collect()
    return [r.r for r in rows]


def noise(n, seed):
    rng = random.Random(seed)
    pieces = ["<b>", "<", ">", "é", "A1_", ".", "! ", "?\n", " ", " ", "\x85", "\x1c",
              "\x0b", "‘", "”", " word", "Sentence here", "1.5 ", "\t", "漢字", "ß", "&amp;"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_clean_cases(spark):
    given = [None, "", "   ", "<p>A &amp; B</p>", "a < b > c", "‘x’, “y”", "a \t\nb"]
    wanted = ["", "", "", "A &amp; B", "a c", "'x', \"y\"", "a b"]
    assert apply(spark, clean_text, given) == wanted


def test_chunk_cases(spark):
    cases = {
        None: [""],
        "": [""],
        "   ": ["   "],
        "Short. Tiny.": ["Short. Tiny."],
        "Exactly10. This one is long enough.": ["This one is long enough."],
        "A rate of 1.5 percent applies. Next one follows here.": [
            "A rate of 1.5 percent applies.", "Next one follows here.",
        ],
        "Use a short period (e.g., 12 hours) only.": ["Use a short period (e.g., 12 hours) only."],
        "Order No. 37 applies to all.": ["37 applies to all."],
    }
    assert apply(spark, sentence_chunks, cases) == list(cases.values())


def test_text_rules_on_noise(spark):
    texts = noise(400, 1)
    assert apply(spark, clean_text, texts) == [brute.clean(t) for t in texts]
    assert apply(spark, sentence_chunks, texts) == [brute.chunks(t) for t in texts]
    assert apply(spark, strip, texts) == [t.strip() for t in texts]
    assert apply(spark, word_tokens, texts) == [brute.tokens(t) for t in texts]


def test_token_cases(spark):
    texts = ["The LCR of 100% is due at 10 AM", "Café_1 naïve", "bank must shall"]
    assert apply(spark, word_tokens, texts) == [["lcr", "100", "due"], ["café_1", "naïve"], []]
    assert apply(spark, ascii_tokens, texts) == [["lcr", "100", "due"], ["caf"], ["must"]]
    every = apply(spark, lambda t: word_tokens(t, stopwords=()), texts)
    assert every[2] == ["bank", "must", "shall"]


def test_term_counts_match_a_counter(spark):
    texts = ["b a b c c c", "", "x"]
    counts = apply(spark, lambda t: term_counts(F.split(t, " ")), texts)
    assert [(r.term, r.n_term) for r in counts[0]] == [("a", 1), ("b", 2), ("c", 3)]
    none = apply(spark, lambda t: term_counts(F.filter(F.split(t, " "), lambda x: x == "?")), texts)
    assert none == [None, None, None]


def test_fill(spark):
    got = apply(spark, lambda t: fill("<{x}|{y}> {x}", x=t, y=F.lit(7)), ["a", None])
    assert got == ["<a|7> a", "<|7> "]


def test_silver_policies(spark):
    row = ("P1", "Lending", "S1", "Title", "First long sentence. Second long sentence!",
           None, "2024-02-30", "ACTIVE", "now")
    bronze = rows_to_bronze(spark, [row], POLICY_SCHEMA)
    silver = silver_policies(bronze)
    assert silver.columns == ["policy_id", "domain", "section", "title", "chunk_index",
                              "chunk_text", "chunk_id", "source_type"]
    assert [(r.chunk_id, r.chunk_text, r.source_type) for r in silver.orderBy("chunk_index").collect()] == [
        ("P1_0", "First long sentence.", C.POLICY_TAG),
        ("P1_1", "Second long sentence!", C.POLICY_TAG),
    ]
    assert with_dates(bronze, "last_reviewed").first().last_reviewed_date is None


def test_every_document_has_a_chunk(spark):
    rows = [(i, t) for i, t in enumerate([None, "", " ", "x", "A long sentence. Another one here."])]
    df = spark.createDataFrame(rows, "i int, t string")
    sizes = df.select(F.size(sentence_chunks(clean_text(F.col("t"))))).collect()
    assert all(s[0] >= 1 for s in sizes)


@pytest.mark.parametrize("n, wanted", [(1, ["s0"]), (3, ["s0 s1", "s2"]), (4, ["s0 s1", "s2 s3"])])
def test_sentence_pairs(spark, n, wanted):
    text = "|".join(f"s{i}" for i in range(n))
    assert apply(spark, lambda t: sentence_pairs(F.split(t, r"\|")), [text]) == [wanted]


def test_directive_blocks(spark):
    text = "Intro here|Banks shall act|More on it|They MUST report|Mustard is no cue"
    got = apply(spark, lambda t: directive_blocks(F.split(t, r"\|")), [text])
    assert got == [["Intro here", "Banks shall act More on it", "They MUST report Mustard is no cue"]]


def test_plain_characters_first_gives_the_same(spark):
    """The quick patterns agree with the plain ones on every character around white space, quotes and tags."""
    odd = [chr(c) for c in (*range(0x250), 0x1680, *range(0x2000, 0x2070), 0x3000, 0xFEFF, 0x4E2D, 0x1F600, 0x0661)]
    shapes = ("{0}", "a{0}b", "a {0} b.", "{0}{0}a.{0}{0}b!{0}", "<b{0}>x{0}<y> z<", "“{0}’ it", "a. {0}B?\n{0} c\n", "")
    texts = [shape.format(c) for c in odd for shape in shapes]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    cleaned = F.translate(F.regexp_replace(t, T.TAG, " "), T.CURLY_QUOTES, T.STRAIGHT_QUOTES)
    wanted = {
        "clean": F.trim(F.regexp_replace(cleaned, T.SPACE + "+", " ")),
        "strip": F.regexp_replace(t, rf"^{T.SPACE}+|{T.SPACE}+$", ""),
    }
    got = {"clean": T.clean_text(t), "strip": T.strip(t)}
    for name in wanted:
        assert df.where(~wanted[name].eqNullSafe(got[name])).select("t").collect() == []


def test_plain_text_is_not_searched_for_spaces_letter_by_letter():
    """Every pattern begins with a look at plain characters; the class of white space is slow."""
    for pattern in (T.UNEVEN, T.ENDS):
        assert pattern.startswith("(?=[^")
