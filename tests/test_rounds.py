"""Searches that look at some buckets first, and leave out of the others what cannot be among a query's best."""

import random

import numpy as np
import pyarrow as pa
import pytest
from dataclasses import replace
from pyspark.sql import functions as F

import brute
from plan import explained
from gapledger.operators import index as I
from gapledger.operators import retrieve as R
from gapledger.operators import scoring as S
from test_retrieve import make_index, make_queries, run, same, skewed


def batches(docs, size):
    entry = pa.list_(pa.struct([("term", pa.string()), ("unit", pa.float64())]))
    lists = [[{"term": w, "unit": u} for w, u in d] for d in docs]
    for i in range(0, len(docs), size):
        yield pa.RecordBatch.from_arrays([pa.array(range(i, min(i + size, len(docs)))), pa.array(lists[i : i + size], entry)], ["d", "words"])


@pytest.mark.parametrize("left_out", [0.0, 0.4, 0.95])
def test_scores_to_reach_leave_no_best_document_out(monkeypatch, left_out):
    """Whatever share of a known score is left out, and of equal scores the first document counts although shorter ones come first."""
    monkeypatch.setattr(S, "LEFT_OUT", left_out)
    monkeypatch.setattr(S, "PART_DOCUMENTS", 40)
    monkeypatch.setattr(S, "PART_POSTINGS", 300)
    monkeypatch.setattr(S, "DENSE_SHARE", 0.2)
    r = random.Random(3)

    def entries(longest):
        words = sorted({f"w{min(int(r.expovariate(0.08)), 300)}" for _ in range(r.randint(1, longest))})
        return [(w, r.random() / len(words) ** 0.5) for w in words]

    docs = [entries(25) for _ in range(400)]
    for i in range(0, 390, 7):
        docs[i + 5] = docs[i] + [("elsewhere", 0.1)] * (i % 3)
    queries = {f"q{i}": entries(12) for i in range(30)}
    table = pa.Table.from_pylist([{"q": q, "term": w, "query_unit": u} for q, words in queries.items() for w, u in words])
    block = S.block_of(table, "q")
    wanted = {}
    for q, words in queries.items():
        scores = [(sum(u * v for w, u in words for x, v in d if w == x), i) for i, d in enumerate(docs)]
        wanted[q] = sorted(((-float(S.rounded(np.array(s), 9)), i) for s, i in scores if s > 0))[:3]
    bars = pa.table({"q": [*wanted, "other"], "score": [-hits[-1][0] if len(hits) == 3 else 0.0 for hits in wanted.values()] + [1.0]})
    block = replace(block, bars=S.bars_of(block.ids, bars["q"], bars["score"]))
    found = {}
    for row in pa.Table.from_batches(S.search(block, batches(docs, 150), ["q", "d", "score"], 9, 3, None)).to_pylist():
        found.setdefault(row["q"], []).append((-row["score"], row["d"]))
    for q, hits in wanted.items():
        assert [d for _, d in sorted(found[q])] == [d for _, d in hits]


def test_rounds_cover_all_buckets_and_grow():
    assert R.rounds(15, 8) == [(0, 15)] and R.rounds(32, 8) == [(0, 32)]
    for buckets in (33, 74, 720, 100_000):
        ranges = R.rounds(buckets, 8)
        assert ranges[0][0] == 0 and ranges[-1][1] == buckets and ranges[0][1] == 8
        assert all(a[1] == b[0] and b[1] <= R.GROWTH * a[1] + 1 for a, b in zip(ranges, ranges[1:]))


@pytest.mark.parametrize("limits", [R.LIMITS, R.Limits(words=60)])
def test_rounds_give_the_same_rows(spark, monkeypatch, limits):
    docs, queries = skewed(300, 40, 23)
    index, asked = make_index(spark, docs), make_queries(spark, queries)
    monkeypatch.setattr(R, "rounds", lambda buckets, cores: [(0, 1), (1, 4), (4, buckets)])
    for k in (1, 4):
        same(run(index, asked, k, limits=limits), brute.top_k(docs, queries, k))


def test_later_rounds_pass_few_rows(spark):
    """Tasks used to pass k rows of every query each, however many tasks there were."""
    docs, queries = skewed(2_000, 30, 29)
    docs = {i: f"{text} own{i}" for i, text in docs.items()}
    index = make_index(spark, docs)
    known = R.known_words(I.query_vectors(make_queries(spark, queries), "query_id", "question"), index)
    asked = [R.ask(known, "query_id")]
    everything = R.best_of_blocks(known, asked, index, "query_id", 2, None)
    best = R.best_k(everything, "query_id", "doc_id", 2).where("rank = 2").toArrow()
    bars = [S.bars_of(asked[0].ids, best["query_id"], best["score"])]
    passed = R.best_of_blocks(known, asked, index, "query_id", 2, bars)
    assert passed.count() < everything.count() / 2
    assert passed.where("score < 0").count() == 0 and passed.groupBy("query_id").count().where("count < 2").count() <= 1


def test_one_scan_for_all_blocks(spark):
    docs, queries = skewed(60, 20, 31)
    index, asked = make_index(spark, docs), make_queries(spark, queries)
    known = R.known_words(I.query_vectors(asked, "query_id", "question"), index)
    limits = R.Limits(words=20)
    assert R.blocks_needed(R.survey(known), index, limits) > 2
    plan = explained(R.retrieve(index, asked, "query_id", "question", 2, pad=False, limits=limits))
    assert plan.count("ObjectHashAggregate") + plan.count("SortAggregate") <= 2 * explained(
        R.retrieve(index, asked, "query_id", "question", 2, pad=False)
    ).count("MapInArrow")


def test_files_of_other_buckets_are_not_read(spark):
    docs, _ = skewed(200, 5, 37)
    index = make_index(spark, docs)
    part = R.in_buckets(index, 2, 5).postings
    bucket = F.pmod(F.hash("doc_id"), F.lit(index.buckets))
    rows = part.select("doc_id", "term", bucket.alias("b")).collect()
    wanted = index.postings.where((bucket >= 2) & (bucket < 5)).count()
    assert len(rows) == wanted > 0 and {r.b for r in rows} <= {2, 3, 4}
