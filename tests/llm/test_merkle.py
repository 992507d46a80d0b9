import hashlib
import zlib

import pytest

from checks.compare import difference, duck
from gapledger.llm import merkle
from gapledger.llm.merkle import ARITY, append_log, audit, build_manifest, fold, heights, place, prove, siblings
from gapledger.llm.queries import ORACLES, QUERIES


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def value(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lower(t):
    return t and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def tree(nodes):
    """Root and, per member, the others of each run on its way, from [(digest, members)]."""
    steps = {m: [] for _, ms in nodes for m in ms}
    while len(nodes) > 1:
        above = []
        for i in range(0, len(nodes), ARITY):
            run = nodes[i : i + ARITY]
            for j, (_, ms) in enumerate(run):
                for m in ms:
                    steps[m].append(("".join(h for h, _ in run[:j]), "".join(h for h, _ in run[j + 1 :])))
            above.append((H(*(h for h, _ in run)), [m for _, ms in run for m in ms]))
        nodes = above
    return nodes[0][0], steps


def brute(rows):
    if not rows:
        return []
    leaf = [H(*map(value, r)) for r in rows]
    by = {}
    for i, r in enumerate(rows):
        by.setdefault(r[1], []).append(i)
    tops, steps, subroot = [], {}, {}
    for s in sorted(by, key=lambda s: (s is not None, (s or "").encode())):
        ids = sorted(by[s], key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaf[i]))
        top, own = tree([(leaf[i], [i]) for i in ids])
        steps |= own
        tops.append((top, ids))
        subroot |= dict.fromkeys(ids, top)
    root, more = tree(tops)
    out = []
    for i, r in enumerate(rows):
        way, h = steps[i] + more[i], leaf[i]
        if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 0:
            h = H(*map(value, (*r[:4], lower(r[4]))))
        for before, after in way:
            h = H(before, h, after)
        out.append((r[0], leaf[i], subroot[i], root, H(*[x for step in way for x in step]), h, h == root))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 700])
def test_places_are_those_of_the_log(n):
    """Closed-form positions against a log that is written node by node."""
    leaves = [H(str(i)).encode() for i in range(n)]
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H("".join(x.decode() for x in below[i : i + ARITY])).encode() for i in range(0, len(below), ARITY)])
    assert heights(n) == len(levels) - 1
    log = append_log(leaves, heights(n))
    nodes = [log[i : i + 64] for i in range(0, len(log), 64)]
    assert len(nodes) == sum(map(len, levels))
    for level, row in enumerate(levels):
        for i, digest in enumerate(row):
            assert nodes[place(level, i, n)] == digest
    # a proof from the log alone
    for i in range(0, n, 7):
        steps = [siblings(log, level, i // ARITY**level, n) for level in range(heights(n))]
        assert fold(leaves[i], steps) == log[-64:]


def test_nodes_never_move():
    """A log of more leaves starts with what is complete in a shorter one."""
    leaves = [H(str(i)).encode() for i in range(600)]
    long = append_log(leaves, 3)
    assert long.startswith(append_log(leaves[:512], 3)[: 64 * (512 + 32 + 2)])


CASES = [
    (1, "a", "en", 3, "Abc"), (1, "a", "en", 3, "Abc"), (1, "a", "en", 2, "other"), (None, "a", None, None, None), (2, None, "de", 0, ""),
    (3, "", "de", None, "É"), (4, "é", "fr", 9, "日本"), (5, "Z", "fr", 1, "x"), (-6, "Z", None, 1, "MINUS"), (None, None, None, None, None),
    (7, "b", "en", 5, "-"), (8, "b", "en", 5, None), *[(100 + i, "hot", "en", i, f"Text {i}") for i in range(300)],
    *[(1000 + i, f"s{i:02}", "en", i, "One Row") for i in range(40)], (9, "b", "en", 400_000, "Long " * 80_000),
]


def test_against_brute_force(spark):
    df = spark.createDataFrame([(*c, 1, "x") for c in CASES], SCHEMA + ", key int, digest string")
    assert sorted(map(tuple, audit(df).collect()), key=str) == brute(CASES)
    assert audit(df.limit(0)).count() == 0
    for some in (CASES[:1], CASES[:2], CASES[4:5]):
        assert sorted(map(tuple, audit(spark.createDataFrame(some, SCHEMA)).collect()), key=str) == brute(some)


def test_several_builders_and_ranges(spark, monkeypatch):
    """A source of more than one builder, over several ranges, beside small ones; more sources than a builder takes."""
    monkeypatch.setattr(merkle, "RANGE_ROWS", 1500)
    rows = [(i, "hot", "en", 1, f"T{i}") for i in range(4096 + 257)] + [(i, f"n{i % 4200:05}", "en", 1, "x") for i in range(10_000, 14_300)]
    got = sorted(map(tuple, audit(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == brute(rows)


def test_tampering_shows_and_proofs_hold(spark):
    rows = [(i, "s", "en", 1, "Upper" if i % 2 else "lower") for i in range(200)]
    for r in audit(spark.createDataFrame(rows, SCHEMA)).collect():
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 5 != 0 or r.doc_id % 2 == 0)
    manifest = build_manifest(spark.createDataFrame(rows, SCHEMA), ["doc_id", "text"])
    found = prove(manifest, whole=True).collect()
    assert all(r.verified and r.root == manifest.root() and H(r.proof) == r.proof_sha256 for r in found)


def test_query_equals_sql(spark, small):
    assert difference(QUERIES["op13_merkle"](spark, small).toPandas(), duck(small).execute(ORACLES["op13_merkle"]).df()) is None
