import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gapledger.llm import lmscore
from gapledger.llm.lmscore import CLASSES, LogBilinear, score_held_out


def brute(docs):
    def tokens(t):
        t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return [w for w in re.split("[\x20\x09-\x0d]+", t) if w] + [" "]

    def held(d):
        return zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0

    c = Counter(w for d, t in docs if not held(d) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    out = []
    for d, t in docs:
        w = tokens(t)
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        out.append((d, held(d), len(w), sum(c[x] > 0 for x in w), n, base))
    return sorted(out, key=str), c


def corpus():
    r = random.Random(8)
    words = [f"w{i}" for i in range(300)] + ["The", "É", "of.", "x,y"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = []
    for i in range(300):
        # a word is mostly followed by the one with the next number
        at, text = r.randrange(300), []
        for _ in range(r.randint(0, 60)):
            at = (at + 1) % 300 if r.random() < 0.8 else r.choices(range(len(words)), weights)[0]
            text.append(words[at])
        docs.append((i, " ".join(text)))
    return docs + [(1000, None), (1001, ""), (1002, "unseen-word-only"), (None, "no id w1"), (1003, "W1 w1\x0bw2"), (1003, "W1 w1\x0bw2")]


@pytest.mark.parametrize("share", [1_000_000, 40])
def test_base_against_brute_force_and_better_score(spark, share, monkeypatch):
    monkeypatch.setattr(lmscore, "SHARE", share)  # 40: most tokens are joined
    docs = corpus()
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, row int, c string")
    got = sorted(map(tuple, score_held_out(df).collect()), key=str)
    expected, _ = brute(docs)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert np.allclose([g[5] for g in got], [e[5] for e in expected], atol=1e-6)
    assert all(g[6] < 0 for g in got)
    some = [g for g in got if g[1]]
    assert sum(g[6] for g in some) > sum(g[5] for g in some)


def test_empty_and_untrained(spark):
    df = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    rows = score_held_out(df).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in sorted(rows)] == [(1, 0, 0), (3, 0, 0)]
    assert score_held_out(df.limit(0)).count() == 0


def test_probabilities_sum_to_one_and_follow_the_data():
    r = np.random.default_rng(1)
    prior = np.full(CLASSES, 1 / CLASSES)
    model = LogBilinear(prior)
    w = r.integers(0, 6, 60_000)
    w[1:] = np.where(r.random(59_999) < 0.9, (w[:-1] + 1) % 6, w[1:])
    for i in range(1, len(w)):  # make the chain depend on what is really there
        if r.random() < 0.9:
            w[i] = (w[i - 1] + 1) % 6
    for _ in range(3):
        model.train(np.r_[0, w[:-1]], np.r_[0, 0, w[:-2]], w, r)
    first, second, z = model.tables()
    p = np.exp(first[2][None, :] + second - z[2][:, None])
    assert np.allclose(p.sum(1), 1, atol=1e-3)
    assert p[1, 3] > 0.6
