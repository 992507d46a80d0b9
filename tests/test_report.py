import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gapledger import constants as C
from gapledger.operators import report as R
from gapledger.operators.amounts import (
    money_amounts,
    normalize_currency,
    quantities,
    requirement_conflicts,
)
from gapledger.operators.index import build_index
from gapledger.operators.respond import respond
from gapledger.plans import gap_analysis as G


@pytest.mark.parametrize(
    "score, top, mark, bar",
    [(0.30, 0.60, "🟡", 50), (0.10, 0.60, "⚪", 16), (0.0, 0.0, "⚪", 0), (0.5, 0.5, "🔴", 100)],
)
def test_tier_and_bar(spark, score, top, mark, bar):
    row = spark.range(1).select(
        R.tier(F.lit(score)).alias("t"), R.bar_percent(F.lit(score), F.lit(top)).alias("b")
    ).first()
    assert (row.t, row.b) == (mark, bar)


def test_label_and_preview(spark):
    row = spark.range(1).select(
        R.label(F.lit("C1"), F.lit("x" * 80)).alias("l"), R.preview(F.lit("short")).alias("p")
    ).first()
    assert row.l == "C1 — " + "x" * 55 + "..." and row.p == "short..."


def test_sections(spark):
    parts = {
        "Gap 1: risk critical\nmore": "critical",
        "This is a CRITICAL gap": "plain",
        "Gap 2: higher limit": "high",
        "Gap 3: CRITICAL and HIGH": "critical",
        "Gap 4: Risk Level: MEDIUM": "plain",
    }
    report = "\n\n".join([*parts, "  "])
    df = spark.createDataFrame([("C1", report)], "id string, report string")
    rows = R.report_sections(df, "id", "report").orderBy("section_index").collect()
    assert [r.grade for r in rows] == list(parts.values())
    assert rows[0].markup == "Gap 1: risk critical<br>more"
    more = R.report_sections(df, "id", "report", R.MORE_GRADES).orderBy("section_index").collect()
    assert [r.grade for r in more][4] == "medium"


def test_lookup_matrix_export_and_counts(spark, tmp_path):
    circulars = spark.createDataFrame([("C1", "R/1"), ("C2", "R/2")], "id string, ref string")
    reports = spark.createDataFrame([("C1", "Gap")], "id string, report string")
    found = R.lookup_reports(circulars, reports, "id", "none yet")
    assert {(r.id, r.report) for r in found.collect()} == {("C1", "Gap"), ("C2", "none yet")}
    exports = R.report_export(
        found, "id", F.col("ref"), F.col("report"), F.to_date(F.lit("2024-05-01"))
    )
    rows = {r.id: r for r in exports.collect()}
    assert rows["C1"].file_name == "gap_analysis_C1_20240501.txt"
    assert rows["C1"].export_text == "GAP ANALYSIS REPORT\n" + "=" * 60 + "\nCircular: R/1\n\nGap"
    R.write_exports(exports, str(tmp_path / "one"))
    lines = spark.read.text(str(tmp_path / "one")).count()
    assert lines == 10
    gaps = spark.createDataFrame([("P1", "g"), ("P9", "h")], "policy_id string, gap string")
    policies = spark.createDataFrame([("P1", "S1")], "policy_id string, section string")
    matrix = {r.policy_id: r.section for r in R.gap_matrix(gaps, policies, "policy_id", "section").collect()}
    assert matrix == {"P1": "S1", "P9": None}
    counts = R.kpis(policies, circulars, found, gaps, "Groq (Free)").first()
    assert tuple(counts) == (1, 2, 2, 2, "Groq")


def test_fallback(spark):
    df = spark.createDataFrame(
        [("yes", None), (None, None), (None, "late")], "answer string, error string"
    )
    got = df.select(R.fallback(F.col("answer"), F.col("error"), F.lit("canned"))).collect()
    assert [r[0] for r in got] == ["yes", "canned", "⚠️ LLM error: late. canned"]


@pytest.fixture(scope="module")
def gap_inputs(spark):
    policies = spark.createDataFrame(
        [
            (1, "Lending", "S1", "borrowers review statement three days"),
            (2, "Payments", "S2", "cooling period twelve hours beneficiaries"),
            (3, "Payments", "S3", "daily limit transaction"),
        ],
        "doc_id long, domain string, section string, text string",
    )
    circulars = spark.createDataFrame(
        [
            ("C1", "R/1", "Cooling", "2024-07-01", "cooling period beneficiaries", " "),
            ("C2", "R/2", "Review", "2024-10-01", "statement review", "daily limit"),
        ],
        "circular_id string, circular_ref string, subject string, compliance_deadline string, "
        "circular_text string, custom string",
    )
    return build_index(policies, "doc_id", "text", ("gap-test",)), circulars


def test_prompts(spark, gap_inputs):
    index, circulars = gap_inputs
    columns = G.CircularColumns(text="circular_text", custom="custom")
    rows = {r[0]: r[1] for r in G.prompts_for(index, circulars, columns, "section", 2).collect()}
    assert "Reference : R/1\nSubject   : Cooling\nDeadline  : 2024-07-01\n" in rows["C1"]
    assert "\n[2 | S2 | Score: 0." in rows["C1"] and "[1 | S1 | Score: 0.0000]" in rows["C1"]
    assert "Text      : daily limit\n" in rows["C2"] and "[3 | S3 | Score: 0." in rows["C2"]
    old = {
        r[0]: r[1]
        for r in G.prompts_for(index, circulars, columns, "section", 2, prompt_uses_custom=False).collect()
    }
    assert "Text      : statement review\n" in old["C2"] and "[3 | S3 |" in old["C2"]


def test_matches_and_answers(spark, gap_inputs):
    index, circulars = gap_inputs
    matches = G.gap_matches(index, circulars, "circular_id", "circular_text", ["section", "domain"])
    best = {r.circular_id: (r.doc_id, r.bar_pct, r.section) for r in matches.where("rank = 1").collect()}
    assert best == {"C1": (2, 100, "S2"), "C2": (1, 100, "S1")}
    assert matches.count() == 6
    reports = spark.createDataFrame([("C1", "canned C1")], "circular_id string, report string")
    prompts = circulars.select("circular_id", F.col("circular_text").alias("prompt"))

    def reply(batch: pd.Series) -> pd.Series:
        if batch.str.contains("cooling").any():
            raise RuntimeError("no service")
        return "reply to " + batch

    for function, wanted in (
        (None, {"C1": "canned C1", "C2": "default"}),
        (reply, {"C1": "canned C1", "C2": "reply to statement review"}),
    ):
        done = G.answered(prompts, circulars, "circular_id", reports, "default", function)
        assert {r.circular_id: r.report for r in done.collect()} == wanted


def test_respond_isolates_failures(spark):
    prompts = spark.createDataFrame([(1, "good"), (2, "bad")], "id long, prompt string").coalesce(1)

    def reply(batch):
        if "bad" in set(batch):
            raise ValueError("refused")
        return batch.str.upper()

    rows = {r.id: (r.answer, r.error) for r in respond(prompts, "id", "prompt", reply).collect()}
    assert rows == {1: ("GOOD", None), 2: (None, "refused")}


def test_respond_halves_failing_batches_and_answers_once(spark, tmp_path):
    prompts = spark.range(40).selectExpr("id", "concat('p', id) AS prompt").coalesce(1)
    calls = str(tmp_path / "calls")

    def reply(batch):
        with open(calls, "a") as log:
            log.write(f"{len(batch)}\n")
        if "p9" in set(batch):
            raise ValueError("nine")
        return batch.str.upper()

    replies = respond(prompts, "id", "prompt", reply, batch_rows=16)
    for _ in range(2):
        rows = {r.id: (r.answer, r.error) for r in replies.collect()}
        assert rows == {i: (None, "nine") if i == 9 else (f"P{i}", None) for i in range(40)}
    sizes = [int(n) for n in open(calls).read().split()]
    assert max(sizes) == 16 and len(sizes) == 3 + 8


def test_money(spark):
    df = spark.createDataFrame(
        [(1, "Cap of INR 1,00,000 and Rs. 25,000.50, over ₹2 crore or INR 1 lakh crore.")],
        "id long, t string",
    )
    rows = money_amounts(df, "id", "t").orderBy("amount_index").collect()
    assert [str(r.rupees) for r in rows] == [
        "100000.00", "25000.50", "20000000.00", "1000000000000.00",
    ]
    text = df.select(normalize_currency(F.col("t"))).first()[0]
    assert text == "Cap of INR 100000 and INR 25000.50, over INR 2 crore or INR 1 lakh crore."


def test_money_needs_a_word_of_its_own(spark):
    long = "INR " + "1," * 60 + "000"
    df = spark.createDataFrame(
        [("years 2024, hours 12 and papers 7, then Rs 5",), (long,), ("1,5 INR 1,2 1,3",)], "t string"
    )
    rows = money_amounts(df.withColumn("id", F.col("t")), "id", "t").collect()
    assert [(r.amount_text, r.too_large) for r in rows] == [("Rs 5", False), (long, True), ("INR 1,2", False)]
    texts = [r[0] for r in df.select(normalize_currency(F.col("t"))).collect()]
    assert texts == ["years 2024, hours 12 and papers 7, then INR 5", "INR " + "1" * 60 + "000", "1,5 INR 12 1,3"]


@pytest.mark.parametrize("text, wanted", [
    ("1,000 days", [(1000.0, "day", 1_440_000.0, 1_440_000.0)]),
    ("1,00,000 hours and 2.5 hrs", [(100_000.0, "hour", 6e6, 6e6), (2.5, "hour", 150.0, 150.0)]),
    ("10 to 15 days, 3-5 months", [(10.0, "day", 14_400.0, 21_600.0), (3.0, "month", 3.0, 5.0)]),
    ("within 6 hrs; At  Least 2 years; NOT more than 7%", [(6.0, "hour", 0.0, 360.0), (2.0, "year", 24.0, math.inf), (7.0, "%", 0.0, 7.0)]),
    ("12-hour limit, x1.2.3 days, a1 day", [(12.0, "hour", 720.0, 720.0), (1.0, "day", 1440.0, 1440.0)]),
    ("no unit 5, 6 daylight", []), ("", []), (None, []),
])
def test_quantities_are_whole_numbers_with_bounds(spark, text, wanted):
    df = spark.createDataFrame([(1, text)], "id int, t string")
    assert [(r.number, r.unit, r.low, r.high) for r in quantities(df, "id", "t").collect()] == wanted


def test_conflicts_against_brute_force(spark):
    r = random.Random(5)
    units = {"minutes": ("m", 1), "hours": ("m", 60), "days": ("m", 1440), "months": ("y", 1), "years": ("y", 12), "%": ("%", 1)}
    words = {"": None, "within ": "high", "at least ": "low"}

    def phrase():
        n, unit, word = r.randint(1, 40), r.choice(list(units)), r.choice(list(words))
        more = f" to {n + r.randint(0, 9)}" if not word and r.random() < 0.4 else ""
        kind, scale = units[unit]
        high = (int(more[4:]) if more else n) * scale
        bounds = {"high": (0, n * scale), "low": (n * scale, math.inf), None: (n * scale, high)}[words[word]]
        return f"{word}{n}{more} {unit}", (kind, *bounds, float(n), unit.rstrip("s"))

    asked = [[phrase() for _ in range(r.randint(0, 4))] for _ in range(150)]
    given = [[phrase() for _ in range(r.randint(0, 4))] for _ in range(150)]
    expected = set()
    for i, (a, b) in enumerate(zip(asked, given)):
        for _, (kind, low, high, n, unit) in a:
            same = [q for _, q in b if q[0] == kind]
            if same and not any(low <= q[2] and q[1] <= high for q in same):
                expected.add((i, unit, n))
    texts = [spark.createDataFrame([(i, "; ".join(p for p, _ in x)) for i, x in enumerate(y)], "id int, t string") for y in (asked, given)]
    matches = spark.range(150).selectExpr("CAST(id AS int) AS id", "CAST(id AS int) AS pid", "1 AS rank")
    found = requirement_conflicts(matches, "id", "pid", quantities(texts[0], "id", "t"), quantities(texts[1], "id", "t").withColumnRenamed("id", "pid"))
    assert {(x.id, x.unit, x.required) for x in found.collect()} == expected and expected


def test_requirement_conflicts(spark):
    circulars = spark.createDataFrame(
        [("C1", "at least 24 HOURS and 100% cover"), ("C2", "within 6 hrs")], "cid string, t string"
    )
    policies = spark.createDataFrame(
        [(1, "12 hours, 12-hour limit, 100%"), (2, "in 6 hours")], "pid long, t string"
    )
    matches = spark.createDataFrame(
        [("C1", 1, 1), ("C1", 2, 2), ("C2", 2, 1)], "cid string, pid long, rank int"
    )
    rows = requirement_conflicts(
        matches, "cid", "pid", quantities(circulars, "cid", "t"), quantities(policies, "pid", "t")
    ).collect()
    assert [(r.cid, r.pid, r.unit, r.required, r.stated) for r in rows] == [
        ("C1", 1, "hour", 24.0, [12.0])
    ]
    assert C.PROMPT_K == 4


def test_many_matches_are_dealt_out_by_their_number(spark, monkeypatch):
    from gapledger.operators import amounts
    from plan import explained

    rows = [(f"C{i}", i, f"Keep {i} days and {i}% of it.", f"Stored {i + i % 2} days, {i} % kept.") for i in range(40)]
    df = spark.createDataFrame(rows, "id string, pid long, asked string, said string")

    def conflicts():
        return requirement_conflicts(
            df.select("id", "pid", F.lit(1).alias("rank")), "id", "pid",
            quantities(df, "id", "asked"), quantities(df, "pid", "said"),
        )

    few = sorted(map(tuple, conflicts().collect()))
    monkeypatch.setattr(amounts, "MATCH_ROWS", 2)
    many = conflicts()
    plan = explained(many)
    assert "base" in plan and ", 20), REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan
    assert sorted(map(tuple, many.collect())) == few and len(few) == 20
