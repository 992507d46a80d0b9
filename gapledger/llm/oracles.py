"""DuckDB SQL for the queries of this package that SQL can express and that are longer than a few lines."""

from __future__ import annotations

CONVERSATIONS = r"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), e AS (
        SELECT *, md5(text) AS digest,
               regexp_replace(role, '([<\[])(\\*)(s>|INST\]|/INST\]|/s>)', '\1\\\2\3', 'g') AS r,
               regexp_replace(text, '([<\[])(\\*)(s>|INST\]|/INST\]|/s>)', '\1\\\2\3', 'g') AS t
        FROM c
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, digest)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, digest) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(3 + sum(length(r) + length(t) + 17) AS BIGINT) AS formatted_chars
    FROM e GROUP BY conv_id
"""

DIVERGENCE = r"""
    WITH w AS (
        SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws
        FROM documents
    ), o AS (
        SELECT lang, source, r, unnest(ws) AS term FROM w
    ), k AS (
        SELECT lang, term, count(*) AS total FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 3
    ), c AS (
        SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY lang, source, term
    ), l AS (
        SELECT lang, count(*) AS v, sum(total) AS ln FROM k GROUP BY lang
    ), g AS (
        SELECT lang, source, any_value(v) AS v, any_value(ln) AS ln, coalesce(sum(n), 0) AS gn
        FROM (SELECT DISTINCT lang, source FROM w) LEFT JOIN l USING (lang) LEFT JOIN c USING (lang, source)
        GROUP BY lang, source
    ), p AS (
        SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
               1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (gn + v) AS p,
               1 + (1000000000::HUGEINT * (k.total + 1)) // (ln + v) AS q
        FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)
    ), d AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
        GROUP BY a.lang, a.source, b.source
    ), e AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(d.value, 0) AS BIGINT) AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q
    ), r AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM e
    )
    SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 200
"""

#: crc32 of a decimal text, bit by bit.
_CRC = """xor(list_reduce(list_transform(string_split({text}, ''), lambda x: CAST(ord(x) AS BIGINT)),
    lambda a, b: list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, xor(a, b)),
    4294967295), 4294967295)"""


def _tree(name: str, depth: int) -> str:
    """CTEs for the trees over ``{name}0`` (k, i, h): levels, and what each leaf needs ({name}s: k, i, before, after, level; {name}top: k, h)."""
    parts = []
    for n in range(depth):
        parts.append(f"""{name}{n + 1} AS MATERIALIZED (
            SELECT k, i // 16 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h
            FROM (SELECT *, count(*) OVER (PARTITION BY k) AS n FROM {name}{n}) WHERE n > 1 GROUP BY k, i // 16
        ), {name}p{n} AS MATERIALIZED (
            SELECT a.k, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS x,
                   coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS y
            FROM {name}{n} a JOIN {name}{n + 1} u ON u.k = a.k AND u.i = a.i // 16
            LEFT JOIN {name}{n} b ON b.k = a.k AND b.i // 16 = a.i // 16 AND b.i <> a.i GROUP BY a.k, a.i
        )""")
    tops = " UNION ALL ".join(
        f"SELECT k, {n} AS level, any_value(h) AS h FROM {name}{n} GROUP BY k" for n in range(depth + 1)
    )
    parts.append(f"{name}top AS MATERIALIZED (SELECT k, arg_max(h, level) AS h FROM ({tops}) GROUP BY k)")
    return ", ".join(parts)


def _folded(name: str, start: str, depth: int) -> str:
    """CTEs that lead ``start`` (r, k, i, h, proof) up the trees of ``name``; the last is {name}f{depth}."""
    parts, before = [], start
    for n in range(depth):
        parts.append(f"""{name}f{n + 1} AS MATERIALIZED (
            SELECT r, f.k, f.i // 16 AS i, f.proof || coalesce(x || y, '') AS proof,
                   CASE WHEN p.k IS NULL THEN f.h ELSE sha256(x || f.h || y) END AS h
            FROM {before} f LEFT JOIN {name}p{n} p ON p.k = f.k AND p.i = f.i
        )""")
        before = f"{name}f{n + 1}"
    return ", ".join(parts)


def merkle(depth: int = 5) -> str:
    """SQL for trees of up to 16**depth leaves."""

    def value(x: str) -> str:
        return f"coalesce(CAST(octet_length(encode(CAST({x} AS VARCHAR))) AS VARCHAR) || ':' || CAST({x} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(value, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = _CRC.format(text="coalesce(CAST(doc_id AS VARCHAR), '')")
    return f"""
    WITH rows AS MATERIALIZED (
        SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS k, {leaf('text')} AS leaf,
               CASE WHEN coalesce({crc}, 0) % 5 = 0 THEN {leaf(low)} ELSE {leaf('text')} END AS claim
        FROM documents
    ), placed AS MATERIALIZED (
        SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM rows
    ), a0 AS MATERIALIZED (SELECT k, i, leaf AS h FROM placed),
    {_tree("a", depth)},
    z0 AS MATERIALIZED (SELECT 'all' AS k, row_number() OVER (ORDER BY k) - 1 AS i, h, k AS source FROM atop),
    {_tree("z", depth)},
    start AS (SELECT r, k, i, claim AS h, '' AS proof FROM placed),
    {_folded("a", "start", depth)},
    next AS (SELECT r, 'all' AS k, z0.i, f.h, f.proof FROM af{depth} f JOIN z0 ON z0.source = f.k),
    {_folded("z", "next", depth)}
    SELECT p.doc_id, p.leaf, atop.h AS subroot, ztop.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = ztop.h AS verified
    FROM placed p JOIN atop ON atop.k = p.k JOIN zf{depth} f ON f.r = p.r CROSS JOIN ztop
    """
