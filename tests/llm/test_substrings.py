import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest

from gapledger.llm import substrings
from gapledger.llm.frames import WordMemory, hash64, shingle_hashes, word_hashes
from gapledger.llm.substrings import PIECE, WINDOW, covered, factors, find_pieces, matched, remove_repeats


def brute(docs):
    first, windows = {}, []
    for doc_id, text in docs:
        words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
        own = [tuple(words[i : i + WINDOW]) for i in range(len(words) - WINDOW + 1)]
        windows.append((doc_id, words, own))
        for w in own:
            key = float("inf") if doc_id is None else doc_id
            first[w] = min(first.get(w, key), key)
    out = []
    for doc_id, words, own in windows:
        gone = set()
        for i, w in enumerate(own):
            if first[w] < (float("inf") if doc_id is None else doc_id):
                gone.update(range(i, i + WINDOW))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    r = random.Random(seed)
    passages = [[f"p{r.randint(0, 999)}" for _ in range(r.randint(10, 60))] for _ in range(12)]
    docs = []
    for i in range(120):
        words = []
        for _ in range(r.randint(0, 6)):
            p = r.choice(passages)
            a, b = sorted((r.randint(0, len(p)), r.randint(0, len(p))))
            words += r.choice([p, p[a:b], p[:14], [f"w{r.randint(0, 10**6)}" for _ in range(r.randint(1, 30))]])
        docs.append((i * 3, r.choice([" ", "\n", "  \t"]).join(words)))
    docs += [(1000, None), (1001, ""), (1002, "la " * 400), (1003, "la " * 300), (1004, "é " * 50 + "x"), (1005, " é " * 60)]
    docs += [(1006, " ".join(passages[0])), (1006, " ".join(passages[0]) + " " + "new " * 20), (None, " ".join(passages[1] + passages[2])),
             (None, "free words here " * 10), (None, "free words here " * 10)]
    r.shuffle(docs)
    return docs


@pytest.mark.parametrize("block,part", [(8 << 20, 16 << 20), (700, 3000), (1, 500)])
def test_against_brute_force(spark, block, part):
    docs = corpus(3)
    df = spark.createDataFrame([(*d, 5, "x") for d in docs], "doc_id long, text string, n_words int, row string").repartition(3)
    got = remove_repeats(df, texts=False, block=block, part=part).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs)


def test_windows_of_a_frequent_phrase_are_dealt_out(spark, monkeypatch):
    r = random.Random(6)

    def filler(n):
        return [f"w{r.randint(0, 10**6)}" for _ in range(n)]

    # a phrase of small hash is the anchor of all windows that hold it
    phrases = [f"one phrase that all share{k}".split() for k in range(3000)]
    phrase = min(phrases, key=lambda p: int(shingle_hashes(word_hashes(WordMemory(hash64), [w.encode() for w in p]), 5)[0]))
    words = [[*filler(20), *phrase, *filler(20)] for _ in range(600)]
    docs = [(i, " ".join(w)) for i, w in enumerate([*words, *words[:50]])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(substrings, "HEAVY", 100, raising=False)

    def watched(blob):  # windows that each index part is given
        return pd.DataFrame({"doc_key": [sum(len(x) // substrings.TAIL for x in blob["tails"])], "check": [blob["part"].iloc[0]], "pieces": [b""]})

    with monkeypatch.context() as m:
        m.setattr(substrings, "look_up", watched)
        taken = [x.doc_key for x in find_pieces(df, block=4000).collect()]
    assert sum(taken) > 15_000 and max(taken) < 3 * sum(taken) / 64
    got = remove_repeats(df, texts=False, block=4000).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs)


def test_texts_and_empty(spark):
    docs = corpus(4)
    df = spark.createDataFrame([(*d, 5, "x") for d in docs], "doc_id long, text string, n_words int, check string")
    kept = remove_repeats(df)
    assert kept.columns[:4] == df.columns and len(kept.columns) == 6
    removed = {(d, n): h for d, _, n, h in brute(docs)}
    for r in kept.collect():
        words = (r.text or "").encode().split()
        assert removed[r.doc_id, r.n_removed] == hashlib.sha256(b" ".join(words)).hexdigest() or r.doc_id in (None, 1006)
    assert remove_repeats(df.limit(0)).count() == 0
    assert remove_repeats(df.limit(0), texts=False).count() == 0


def test_factors_point_to_equal_words(spark):
    docs = [d for d in corpus(5) if d[0] is not None and d[0] != 1006]
    words = {d: (t or "").encode().split() for d, t in docs}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    n = straddling = 0
    for r in find_pieces(df, block=900, part=2000).collect():
        found, joints = factors(r.pieces)
        for f in [*found, *joints]:
            a, length = int(f["start"]), int(f["windows"]) + WINDOW - 1
            b = int(f["ref_start"])
            assert words[r.doc_key][a : a + length] == words[int(f["ref"])][b : b + length] and f["ref"] < r.doc_key
        ends = [int(f["start"] + f["windows"]) + WINDOW - 1 for f in found]
        # one behind the other; what is left of the matched windows straddles an end
        assert all(int(f["start"]) >= e for f, e in zip(found[1:], ends))
        assert all(any(int(j["start"]) < e < int(j["start"] + j["windows"]) + WINDOW for e in ends) for j in joints)
        assert matched(r.pieces)["windows"].sum() == found["windows"].sum() + joints["windows"].sum()
        n, straddling = n + len(found), straddling + len(joints)
    assert n > 50 and straddling > 0


def test_greedy_parse():
    def pieces(*rows):
        return [np.array([row], PIECE).tobytes() for row in rows]

    # references go on over parts; the second reference begins inside the first factor, which ends at word 18
    given = pieces((2, 3, 7, 40), (5, 1, 7, 43), (6, 20, 8, 100), (60, 1, 9, 0))
    found, joints = factors(given[::-1])
    assert found.tolist() == [(2, 4, 7, 40), (18, 8, 8, 112), (60, 1, 9, 0)]
    assert joints.tolist() == [(6, 12, 8, 100)]
    assert np.flatnonzero(covered(80, given)).tolist() == [*range(2, 38), *range(60, 73)]
    # a match that lies wholly on a boundary heads no factor, but its words repeat
    found, joints = factors(pieces((0, 1, 1, 0), (4, 2, 2, 9)))
    assert found.tolist() == [(0, 1, 1, 0)] and joints.tolist() == [(4, 2, 2, 9)]
    assert covered(20, pieces((0, 1, 1, 0), (4, 2, 2, 9))).sum() == 18
    assert len(factors([])[0]) == len(factors([])[1]) == covered(3, []).sum() == 0


def test_query_removes_by_factors(spark):
    """Every copy is one factor of the first text, and all its words go."""
    docs = [(i, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen") for i in range(3)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for r in find_pieces(df).collect():
        found, joints = factors(r.pieces)
        assert [f.tolist() for f in found] == [(0, 2, 0, 0)] and not len(joints)
    assert sorted((r.doc_id, r.n_removed) for r in remove_repeats(df, texts=False).collect()) == [(0, 0), (1, 14), (2, 14)]


def test_equals_its_twin(spark, small):
    from checks.compare import difference, duck, type_difference
    from gapledger.llm.queries import ORACLES, QUERIES

    df, con = QUERIES["op10_substrings"](spark, small), duck(small)
    assert type_difference(df, con, ORACLES["op10_substrings"]) == []
    assert difference(df.toPandas(), con.execute(ORACLES["op10_substrings"]).df()) is None
