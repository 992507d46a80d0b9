import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from checks.compare import difference, duck
from gapledger.llm import divergence as module
from gapledger.llm.divergence import UNIT, divergence, tile
from gapledger.llm.queries import ORACLES, QUERIES


def brute(rows, ranks=200):
    docs = [(lang or "", source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(t for d in own for t in set(d[2]))
        kept = {t for t, n in held.items() if n >= 3}
        counts = defaultdict(Counter)
        for _, source, terms in own:
            counts[source].update(t for t in terms if t in kept)
        total = sum(counts.values(), Counter())

        def share(c):
            n = sum(c.values())
            return {t: 1 + UNIT * (c[t] + 1) // (n + len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(total)
        for s in counts:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in counts if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
                found = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, n + 1) for n, (value, item) in enumerate(found)]
    return sorted(out)


def corpus():
    r = random.Random(6)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150)] + ["É", "straße", "日本", "UPPER", "İx"]
    rows = []
    for i in range(260):
        lang, source = r.choice(["en", "en", "de", None, ""]), f"s{r.choice([0, 0, 0, *range(1, 9)])}"
        text = " ".join(r.choices(words, [1 / (k + 1) for k in range(len(words))], k=r.randint(0, 60)))
        rows.append((lang, r.choice([source, None]) if i % 9 == 0 else source, text))
    rows += [("en", "s0", None), ("en", "s0", ""), ("en", "lonely", "1234 ..."), ("fr", "a", "une deux"), ("fr", "b", "une deux"), ("it", "only", "x y z")]
    rows += [("pt", "a", "igual igual")] * 3 + [("pt", "b", "igual")] * 2 + [("pt", "é", "outro_igual-IGUAL@2"), ("pt", "z", "igual")]
    return rows + rows[:20] + [("en", "s1", "wa " * 60_000)]


@pytest.mark.parametrize("sizes", [{}, {"terms_per_block": 7, "per_side": 2, "columns": 12}, {"ranks": 3, "per_side": 1}])
def test_against_brute_force(spark, sizes):
    rows = corpus()
    df = spark.createDataFrame([(*x, 1, "y") for x in rows], "lang string, source string, text string, term int, p string")
    got = sorted(map(tuple, divergence(df, **sizes).collect()))
    assert got == brute(rows, sizes.get("ranks", 200))


def test_empty_tables(spark):
    df = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence(df).count() == 0
    few = spark.createDataFrame([("en", "a", "x"), ("en", "b", None), (None, None, None)], df.schema)
    assert sorted(map(tuple, divergence(few).collect())) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_tile_is_exact_for_large_shares():
    """Squares near 10**18 and sums over many terms, against whole numbers of any size."""
    r = np.random.default_rng(3)
    p = r.integers(1, UNIT, (3, 400))
    c = r.integers(1, 40, (3, 400))
    p = p[np.arange(3)[:, None], c]  # a group's share follows its level
    rows = [(t, 1, g, int(c[g, t]), int(p[g, t])) for g in range(3) for t in range(400)] + [(-1, 0, g, 0, 1) for g in range(3)]
    table = pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("term", "total", "gid", "c", "p"), zip(*rows))})
    for a, b, value, seen in tile(table, 0, 0):
        assert value == sum((int(x) - int(y)) ** 2 // int(y) for x, y in zip(p[a], p[b])) and seen == 400


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(module, "PIECE", 10)
    text = "Ab cdefghijklmnopqrstuvwxyz  é12x " + "long" * 20 + " end"
    expected = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text.lower())
    assert [w.decode() for words in module._words(text.encode()) for w in words] == expected


def test_query_equals_sql(spark, small):
    assert difference(QUERIES["op12_divergence"](spark, small).toPandas(), duck(small).execute(ORACLES["op12_divergence"]).df()) is None
