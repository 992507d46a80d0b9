import random

import numpy as np
import pyarrow as pa
import pytest

from gapledger.operators import scoring as S


def inputs(n_docs, n_queries, seed, twice=False):
    """Skewed words: documents as (word, unit) and queries as (query, word, unit); exact copies among them."""
    r = random.Random(seed)

    def entries(size, longest):
        words = [f"w{min(int(r.expovariate(0.08)), 300)}" for _ in range(r.randint(1, longest))]
        words = words if twice else sorted(set(words))
        norm = len(words) ** 0.5
        return [(w, r.random() / norm) for w in words]

    docs = [entries(n_docs, 25) for _ in range(n_docs)]
    for i in range(0, n_docs - 3, 9):
        docs[i + 3] = docs[i]
    queries = {f"q{i}": entries(n_queries, 12) for i in range(n_queries)}
    return docs, queries


def searched(docs, queries, k, least=None, size=70):
    table = pa.Table.from_pylist(
        [{"q": q, "term": w, "query_unit": u} for q, words in queries.items() for w, u in words]
    )
    entry = pa.list_(pa.struct([("term", pa.string()), ("unit", pa.float64())]))
    lists = [[{"term": w, "unit": u} for w, u in d] for d in docs]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(range(i, min(i + size, len(docs)))), pa.array(lists[i : i + size], entry)], ["d", "words"])
        for i in range(0, len(docs), size)
    ]
    out = list(S.search(S.block_of(table, "q"), iter(batches), ["q", "d", "score"], 9, k, least))
    found = {}
    for row in pa.Table.from_batches(out).to_pylist() if out else []:
        found.setdefault(row["q"], []).append((row["d"], row["score"]))
    return {q: sorted(hits, key=lambda h: (-h[1], h[0])) for q, hits in found.items()}


def brute(docs, queries, k, least=0.0):
    best = {}
    for q, words in queries.items():
        hits = []
        for d, entries in enumerate(docs):
            shared = [u * v for w, u in words for x, v in entries if w == x]
            if shared and (score := float(S.rounded(np.array(sum(shared)), 9))) >= least:
                hits.append((d, score))
        if hits:
            best[q] = sorted(hits, key=lambda h: (-h[1], h[0]))[:k]
    return best


@pytest.mark.parametrize("twice", [False, True])
@pytest.mark.parametrize("k, least", [(1, None), (3, None), (3, 0.2), (400, None)])
@pytest.mark.parametrize("share, scores", [(1 / 1_000, 1 << 18), (2.0, 100), (0.0, 900)])
def test_best_of_many_queries_at_once(monkeypatch, twice, k, least, share, scores):
    """Whether words are multiplied as a matrix or one by one, and however few scores are held."""
    monkeypatch.setattr(S, "DENSE_SHARE", share)
    monkeypatch.setattr(S, "SCORES", scores)
    docs, queries = inputs(300, 40, 5, twice)
    found, wanted = searched(docs, queries, k, least), brute(docs, queries, k, least or 0.0)
    assert found.keys() == wanted.keys()
    for q, hits in wanted.items():
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in hits], abs=2e-9)
        assert [d for d, _ in found[q]] == [d for d, _ in hits]


def test_few_pairs_are_added_up_word_by_word(monkeypatch):
    """All queries meet a batch together; exact sums are for pairs that may be among a query's best."""
    summed, exact = [], S.Rough.exact

    def counted(self, queries, places):
        summed.append(len(queries))
        return exact(self, queries, places)

    monkeypatch.setattr(S.Rough, "exact", counted)
    docs, queries = inputs(1_000, 50, 7)
    searched(docs, queries, 2, size=1_000)
    assert 100 <= sum(summed) < 50 * 1_000 / 20


def test_tiny_units_and_queries_without_a_match():
    docs = [[("a", 1e-30)], [("b", 1.0)], [("a", 1.0), ("c", 1e-25)]]
    queries = {"x": [("a", 1e-20)], "y": [("none", 1.0)], "z": [("c", 1e-22)]}
    assert searched(docs, queries, 3) == {"x": [(0, 0.0), (2, 0.0)], "z": [(2, 0.0)]}
