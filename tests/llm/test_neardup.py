import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from gapledger.llm import neardup
from gapledger.llm.frames import WordMemory, hash64
from gapledger.llm.neardup import (
    TILE, bag, classes, components, keep_one, near_duplicates, signatures, sketch, tile_pairs, tiles, weighted_jaccard,
)


def jaccard(a, b, size=5):
    def shingles(t):
        w = (t or "").split()
        return Counter(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter()

    x, y = shingles(a), shingles(b)
    return 1.0 if not x and not y else sum((x & y).values()) / sum((x | y).values())


def test_signatures_estimate_weighted_jaccard():
    r = np.random.default_rng(2)
    for top in (1, 3, 40, 1000):
        items = np.arange(300, dtype=np.uint64) * np.uint64(77777) + np.uint64(5)
        a = r.integers(1, top + 1, 300)
        b = np.where(r.random(300) < 0.7, a, r.integers(1, top + 1, 300))
        gone = r.random(300) < 0.1
        bags = [(items, a), (items[~gone], b[~gone])]
        full = np.where(gone, 0, b)
        expected = np.minimum(a, full).sum() / np.maximum(a, full).sum()
        assert abs(weighted_jaccard(*bags) - expected) < 1e-12
        s = signatures(bags, 4096)
        assert abs((s[0] == s[1]).mean() - expected) < 0.035
    assert np.isinf(signatures([(np.zeros(0, np.uint64), np.zeros(0, np.int64))])).all()


def test_bag_counts_repeats():
    memory = WordMemory(hash64)
    assert bag("a b c", memory)[1].tolist() == [1]
    assert sorted(bag("x x x x x x x", memory)[1]) == [3]
    assert weighted_jaccard(bag("", memory), bag(" \n", memory)) == 1


def corpus(seed):
    r = random.Random(seed)
    docs = []
    for _ in range(40):
        base = [f"w{r.randint(0, 5000)}" for _ in range(r.choice([3, 30, 120, 400]))]
        for _ in range(r.choice([1, 1, 2, 6, 25])):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                copy[r.randrange(len(copy))] = f"e{r.randint(0, 10**6)}"
            docs.append(" ".join(copy))
    docs += ["", None, " \n", "same", "same", "a b a b " * 300, "a b a b " * 301]
    r.shuffle(docs)
    return list(enumerate(docs))


def brute_classes(docs):
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(docs):
        for j in range(i):
            if jaccard(a, docs[j][1]) >= 0.8:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {docs[i][0]: docs[find(i)][0] for i in range(len(docs))}


def test_classes_against_brute_force(spark):
    docs = corpus(9)
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, node string, bands int")
    got = {r.doc_id: r.class_id for r in near_duplicates(df).collect()}
    expected = brute_classes(docs)
    assert len(got) == len(docs)
    assert sum(got[i] == expected[i] for i in got) >= 0.99 * len(docs)
    kept = keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))
    assert near_duplicates(df.limit(0)).count() == 0


def test_large_bucket_of_families_and_chains(spark, monkeypatch):
    r = random.Random(4)
    template = [f"t{i}" for i in range(240)]
    texts = []
    for f in range(20):  # three copies of each family; families share about 0.75
        own = [f"f{f}_{i}" for i in range(17)]
        texts += [" ".join(own + template + own + [f"c{f}_{k}" for k in range(k)]) for k in range(3)]
    for k in range(20):  # a chain: neighbours are alike, others are not
        texts.append(" ".join([*template[: 215 - 5 * k], *[f"d{i}" for i in range(25 + 5 * k)]]))
    r.shuffle(texts)
    docs = list(enumerate(texts))
    expected = brute_classes(docs)
    assert len(set(expected.values())) == 21
    # all texts in one bucket of one band, cut into tiles
    monkeypatch.setattr(neardup, "sign", lambda rows, f=neardup.sign: f(rows).withColumn("bands", F.array(F.lit(7).cast("long"))))
    monkeypatch.setattr(neardup, "TILE", 20, raising=False)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {x.doc_id: x.class_id for x in near_duplicates(df).collect()} == expected


def test_sketches_never_differ_in_more_than_bags():
    r = np.random.default_rng(3)
    items = np.arange(400, dtype=np.uint64) * np.uint64(77777) + np.uint64(5)
    for top in (1, 5, 900):
        a, b = r.integers(1, top + 1, 400), r.integers(1, top + 1, 400)
        differ = np.bitwise_count((sketch(items, a) ^ sketch(items, b)).view(np.uint64)).sum()
        assert differ <= np.abs(a - b).sum()
        assert not (sketch(items, a) ^ sketch(items, a)).any()
    assert not sketch(items[:0], np.zeros(0, np.int64)).any()


def test_odd_rows(spark):
    rows = [(1, "one two three four five six"), (1, "one two three four five six"), (1, "another text"), (None, "another text"),
            (None, "only without id"), (None, "only without id"), (5, None), (6, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(map(tuple, keep_one(df).collect()), key=str)
    assert kept == sorted([(1, "one two three four five six"), (1, "another text"), (None, "only without id"), (5, None)], key=str)
    assert {r.copies for r in classes(df).collect()} == {2}


def test_rows_without_id_are_compared(spark):
    one, two = ([f"{c}{i}" for i in range(200)] for c in "ab")
    rows = [(7, " ".join(one), 1), (None, " ".join([*one[:-1], "x"]), 2)]
    rows += [(None, " ".join([*two[:-1], f"y{k}"]), n) for k in range(3) for n in (3, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int")
    assert sorted(((r.doc_id, r.class_id) for r in near_duplicates(df).collect()), key=str) == sorted([(7, 7), (None, 7), *[(None, None)] * 6], key=str)
    assert sorted((r.doc_id, r.text[0]) for r in keep_one(df).collect() if r.doc_id) == [(7, "a")]
    assert [r.text[0] for r in keep_one(df).collect() if r.doc_id is None] == ["b"]


def test_components_of_a_long_chain(spark):
    n = 200
    order = list(range(n))
    random.Random(1).shuffle(order)
    edges = [(bytes([a // 256, a % 256]), bytes([b // 256, b % 256])) for a, b in zip(order, order[1:])]
    got = components(spark.createDataFrame(edges, "a binary, b binary")).collect()
    assert len(got) == n and {bytes(r.root) for r in got} == {b"\0\0"}


def test_components_end_when_edges_are_stars(spark, monkeypatch):
    written, write = [], neardup.write_once
    monkeypatch.setattr(neardup, "write_once", lambda name, df: written.append(name) or write(name, df))

    def roots(*edges):
        written.clear()
        rows = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in edges], "a binary, b binary")
        return sorted((r.node[0], r.root[0]) for r in components(rows).collect())

    # nothing to join: the edges alone are written
    assert roots() == [] and written == ["edges"]
    assert roots((3, 3)) == [] and written == ["edges"]
    assert roots((1, 0), (0, 2), (2, 0), (5, 4)) == [(0, 0), (1, 0), (2, 0), (4, 4), (5, 4)] and written == ["edges"]
    # one step makes a star of a chain, of a node with two roots, and of three nodes in a ring
    for edges in ([(2, 1), (1, 0)], [(2, 1), (2, 0)], [(2, 1), (1, 0), (0, 2)]):
        assert roots(*edges) == [(0, 0), (1, 0), (2, 0)] and written == ["edges", "edges"]


def test_a_bucket_of_copies_and_a_stranger_takes_few_tiles(spark):
    rows = spark.range(100_000).selectExpr("1L AS band", "unhex(md5(string(id))) AS node", "if(id = 7, unhex(md5('7')), unhex('00')) AS root")
    dealt = tiles(rows)
    assert dealt.count() == 100_000
    assert tile_pairs(dealt).count() < 1_000
    most = dealt.groupBy("owner", "part").count().agg({"count": "max"}).first()[0]
    assert most < 2 * TILE
    # pairs of tiles cover all pairs of classes, also where small classes are pooled
    some = spark.createDataFrame([(1, bytes([i]), bytes([i // 3])) for i in range(30)] + [(2, b"x", b"r"), (2, b"y", b"r")], "band long, node binary, root binary")
    dealt = tiles(some, 4)
    assert {r.band for r in dealt.collect()} == {1}
    at = {bytes(r.node): f"{r.owner}/{r.part}" for r in dealt.collect()}
    covered = {(r.x, r.y) for r in tile_pairs(dealt).collect()}
    for i in range(30):
        for j in range(i):
            if i // 3 != j // 3:
                assert tuple(sorted((at[bytes([i])], at[bytes([j])]))) in covered
