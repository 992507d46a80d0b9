import numpy as np
import pytest

from gapledger.llm.queries import ORACLES, QUERIES
from gapledger.llm.topk import Shard, max_score_top_k, search_embeddings


def brute(rows, queries, k):
    out = []
    for q, v in queries:
        width = max(len(v), *(len(x) for _, x in rows))
        full = [int(a) for a in v] + [0] * (width - len(v))
        found = sorted((-sum(a * int(b) for a, b in zip(full, x)), i) for i, x in rows if i != q)
        out += [(q, n, i, -s) for n, (s, i) in enumerate(found[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("spread", [2, 300, 1 << 28])
def test_against_brute_force(spark, spread):
    r = np.random.default_rng(spread)
    rows = [(i, r.integers(-spread, spread, r.integers(0, 9)).astype(float).tolist()) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(90)]  # one vector many times
    queries = rows[::37]
    kind = "vec_id long, vector array<double>"
    got = max_score_top_k(spark.createDataFrame(rows, kind), spark.createDataFrame(queries, kind), 5, 64, 8)
    assert sorted(map(tuple, got.collect())) == brute(rows, queries, 5)


def test_blocks_are_skipped_without_loss():
    r = np.random.default_rng(1)
    x = np.floor(256 * r.normal(size=(900, 16)))
    shard = Shard(np.arange(900), x, block=50)
    for q in range(0, 900, 50):
        ids, scores = shard.search(x[q], q, 5)
        s = x @ x[q]
        best = [i for i in np.lexsort((np.arange(900), -s)) if i != q][:5]
        assert ids.tolist() == best and scores.tolist() == s[best].tolist()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.1], 1), (50, None, 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [None, 1.0], 1),
            (6, [0.25, 0.3], 1), (None, [1.0, 1.0], 1), (7, [0.25, 0.3], 1), (7, [0.25, 0.3], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = [tuple(r) for r in search_embeddings(df).orderBy("rank").collect()]
    score = 128 * 64 + -26 * 76
    assert got == [(0, 1, 6, score), (0, 2, 7, score), (0, 3, 7, score)]
    assert search_embeddings(df.limit(0)).count() == 0


def test_equals_its_twin(spark, small):
    from checks.compare import difference, duck, type_difference

    df, con = QUERIES["op5_topk"](spark, small), duck(small)
    assert type_difference(df, con, ORACLES["op5_topk"]) == []
    assert difference(df.toPandas(), con.execute(ORACLES["op5_topk"]).df()) is None
