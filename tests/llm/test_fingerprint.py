import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from gapledger.llm.fingerprint import SIZE, containment, distinct_shingles, fingerprints, merge_parts, sketch, with_next

WORDS = 5


def brute_sketch(text, size=SIZE):
    words = [w.encode() for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    found = set()
    for i in range(max(len(words) - WORDS + 1, 1) if words else 0):
        h = 42
        for w in words[i : i + WORDS]:
            h = xxhash.xxh64_intdigest(w, h)
        found.add(h - (1 << 64) if h >> 63 else h)
    return sorted(found)[:size]


def near(a, b):
    union = sorted({*a, *b})[:SIZE]
    return 1.0 if not union else sum(h in a and h in b for h in union) / len(union)


def as_text(s):
    return "".join(f"{h & (1 << 64) - 1:016x}" for h in s)


def brute(docs):
    out = []
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    for (doc_id, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        n = len(text)
        edited = text[: n - n // 2] + after[: n // 2]
        own, new, nxt = map(brute_sketch, (text, edited, after))
        out.append((doc_id, n, hashlib.sha256(edited.encode()).hexdigest(), as_text(own), as_text(new), near(own, new), near(own, nxt)))
    return out


@pytest.fixture(scope="module")
def docs():
    r = random.Random(4)
    made = [(i * 7 - 50, " ".join(f"w{r.randint(0, 400)}" for _ in range(r.choice([0, 1, 4, 5, 6, 40, 700])))) for i in range(60)]
    made += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "é 😀 ü x y z é"), (1003, "same id"), (None, "no id at all here now"),
             (2000, made[5][1]), (2001, made[5][1]), (2002, "  lead and trail \n words here ")]
    return made


def test_against_brute_force(spark, docs):
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, own int, next_text string")
    got = [tuple(r)[:7] for r in fingerprints(df).collect()]
    assert sorted(got, key=str) == sorted(brute(docs), key=str)
    assert fingerprints(df.limit(0)).count() == 0
    one = fingerprints(df.filter("doc_id = 1003 AND text = 'same id'")).first()
    assert (one.near_edited, one.near_next) == (0.0, 1.0)  # "samesam" is another word


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_next_does_not_depend_on_ranges(spark, docs, size):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = [(r.doc_id, r.text, r.next_text) for r in with_next(df, rows_per_range=size).collect()]
    order = sorted(((d, t or "") for d, t in docs), key=lambda d: (d[0] is not None, d[0] or 0, d[1]))
    expected = [(d, t, n) for (d, t), (_, n) in zip(order, order[1:] + order[:1])]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_merged_parts_and_estimates(spark):
    words = [f"w{i}" for i in range(5000)]
    parts = [(1, " ".join(words[i : i + 504])) for i in range(0, 4500, 500)] * 3 + [(2, "")]
    df = spark.createDataFrame(parts, "key long, text string").select("key", sketch(F.col("text")).alias("s"))
    merged = {r.key: r.sketch for r in merge_parts(df, "key", "s").collect()}
    assert merged == {1: brute_sketch(" ".join(words[:4504])), 2: []}
    half, whole = " ".join(words[:2000]), " ".join(words)
    row = spark.createDataFrame([(half, whole)], "a string, b string").select(sketch(F.col("a")).alias("a"), sketch(F.col("b")).alias("b"))
    est = row.select(containment(F.col("a"), F.col("b")), containment(F.col("b"), F.col("a")), distinct_shingles(F.col("b"))).first()
    assert est[0] > 0.8 and abs(est[1] - 0.4) < 0.12 and abs(est[2] / 4996 - 1) < 0.3


def test_plan_is_native(spark, small):
    plan = fingerprints(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan
