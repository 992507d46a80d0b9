"""DuckDB twins of the queries, over the same tables and written from their definitions."""

from __future__ import annotations

from gapledger import constants as C

SPACE = r"[\s\p{Z}\x{0085}\x{000B}\x{001C}-\x{001F}]"


def text(value: str) -> str:
    """A SQL string literal; line ends are spelled with chr(10)."""
    quoted = "'" + value.replace("'", "''") + "'"
    return "(" + quoted.replace("\n", "' || chr(10) || '") + ")" if "\n" in value else quoted


def words(values) -> str:
    return ", ".join(text(v) for v in dict.fromkeys(values))


def filled(template: str, **parts: str) -> str:
    """A template with braced names replaced by SQL expressions, as a concatenation."""
    sql = text(template)
    for name, expression in parts.items():
        sql = sql.replace("{" + name + "}", f"' || ({expression}) || '")
    return sql


def clean(column: str) -> str:
    return (
        f"trim(regexp_replace(translate(regexp_replace(coalesce({column}, ''), '<[^>]+>', ' ', 'g'), "
        f"'‘’“”', '''''\"\"'), '{SPACE}+', ' ', 'g'))"
    )


def sentences(column: str) -> str:
    pieces = (
        f"string_split(regexp_replace({column}, '([.!?]){SPACE}+', '\\1' || chr(1), 'g'), chr(1))"
    )
    stripped = f"regexp_replace(x, '^{SPACE}+|{SPACE}+$', '', 'g')"
    kept = f"[s for s in [{stripped} for x in {pieces}] if length(s) > {C.SHORT_SENTENCE}]"
    return f"CASE WHEN len({kept}) > 0 THEN {kept} ELSE [{column}] END"


def chunks(source: str, key: str, column: str) -> str:
    """(key, chunk_index, chunk_text) rows."""
    return (
        f"SELECT key, (i - 1)::INT AS chunk_index, parts[i] AS chunk_text FROM ("
        f"SELECT key, parts, unnest(range(1, len(parts) + 1)) AS i FROM ("
        f"SELECT {key} AS key, {sentences('t')} AS parts FROM ("
        f"SELECT {key}, {clean(column)} AS t FROM {source})))"
    )


def tokens(source: str, key: str, column: str, stop=C.INDEX_STOPWORDS) -> str:
    unwanted = f"AND term NOT IN ({words(stop)})" if stop else ""
    return (
        f"SELECT * FROM (SELECT {key}, "
        f"unnest(string_split_regex(lower({column}), '[^\\p{{L}}\\p{{N}}_]+')) AS term FROM {source}) "
        f"WHERE length(term) >= {C.MIN_TOKEN_LENGTH} {unwanted}"
    )


def ascii_list(column: str, stop=()) -> str:
    unwanted = f"AND x NOT IN ({words(stop)})" if stop else ""
    return (
        f"[x for x in string_split(regexp_replace(lower({column}), '\\W', ' ', 'g'), ' ') "
        f"if length(x) >= {C.MIN_TOKEN_LENGTH} {unwanted}]"
    )


def counted(name: str, key: str, token_sql: str) -> str:
    """CTE name(key, term, n_term, n_tokens)."""
    return (
        f"{name} AS (SELECT {key}, term, count(*) AS n_term, "
        f"sum(count(*)) OVER (PARTITION BY {key})::BIGINT AS n_tokens "
        f"FROM ({token_sql}) GROUP BY {key}, term)"
    )


def index_ctes(
    source: str = "documents", key: str = "doc_id", column: str = "text", stop=C.INDEX_STOPWORDS
) -> str:
    return f"""{counted("tf", key, tokens(source, key, column, stop))},
terms AS (SELECT term, count(*) AS df, ln((SELECT count(*) FROM {source}) / count(*)) AS idf
          FROM tf GROUP BY term),
weights AS (SELECT {key}, term, n_term / n_tokens * idf AS weight FROM tf JOIN terms USING (term)),
norms AS (SELECT {key}, sqrt(sum(weight * weight)) AS norm FROM weights GROUP BY {key})"""


QUESTIONS = (
    "questions AS (SELECT conv_id || '-' || turn AS question_id, text AS question, "
    "CASE turn WHEN 2 THEN 'Hindi' WHEN 4 THEN 'Marathi' ELSE 'English' END AS language "
    "FROM conversations WHERE role = 'user')"
)


def ranking(
    queries: str, query_id: str, query_text: str, k: int,
    source: str = "documents", binary: bool = False, pad: bool = True, before: str = "",
    stop=C.INDEX_STOPWORDS,
) -> str:
    """WITH clause ending in hits(query_id, doc_id, score, rank): every document is scored."""
    weight = "1.0" if binary else "n_term / n_tokens"
    return f"""WITH {before}{index_ctes(source, stop=stop)},
{counted("qtf", query_id, tokens(queries, query_id, query_text, stop))},
qw AS (SELECT {query_id}, term, {weight} AS weight FROM qtf),
qnorms AS (SELECT {query_id}, sqrt(sum(weight * weight)) AS norm FROM qw GROUP BY {query_id}),
dots AS (SELECT {query_id}, doc_id, sum(qw.weight * weights.weight) AS dot
         FROM qw JOIN weights USING (term) GROUP BY {query_id}, doc_id),
scores AS (
  SELECT q.{query_id}, d.doc_id,
         round(CASE WHEN qnorms.norm > 0 AND norms.norm > 0
                    THEN coalesce(dot, 0) / (qnorms.norm * norms.norm) ELSE 0 END, 9) AS score
  FROM {queries} q CROSS JOIN {source} d
  LEFT JOIN qnorms USING ({query_id}) LEFT JOIN norms USING (doc_id)
  LEFT JOIN dots USING ({query_id}, doc_id)),
hits AS (
  SELECT * FROM (
    SELECT {query_id}, doc_id, score,
           CAST(row_number() OVER (PARTITION BY {query_id} ORDER BY score DESC, doc_id) AS INT) AS rank
    FROM scores {"" if pad else "WHERE score > 0"})
  WHERE rank <= {k})
"""


CIRCULAR_RANKING = ranking("benchmark", "item_id", "text", C.PANEL_K)
CHAT_RANKING = ranking("questions", "question_id", "question", C.CHAT_K, before=QUESTIONS + ",\n")
TIER = (
    f"CASE WHEN score > {C.RED_ABOVE} THEN '{C.TIER_RED}' "
    f"WHEN score > {C.YELLOW_ABOVE} THEN '{C.TIER_YELLOW}' ELSE '{C.TIER_WHITE}' END"
)
BAR = (
    f"trunc(score * 100 / greatest(max(score) OVER (PARTITION BY item_id), {C.BAR_FLOOR}))::INT"
)
REPLIES = (
    "replies AS (SELECT conv_id AS item_id, arg_max(text, turn) AS report FROM conversations "
    "WHERE role = 'assistant' GROUP BY conv_id)"
)
SUBJECT = "'Subject of circular ' || item_id"
NO_REPORT = "'No report is on file.'"
POLICY_CHUNKS = chunks("documents", "doc_id", "text")
CIRCULAR_CHUNKS = chunks("benchmark", "item_id", "text")
GOLD_STOP = (*C.ENGLISH_STOPWORDS, *C.BANKING_STOPWORDS)
GOLD_COUNTS = f"""chunked AS (
  SELECT key || '_' || chunk_index AS chunk_id, key, {ascii_list("chunk_text", GOLD_STOP)} AS tokens
  FROM ({POLICY_CHUNKS})),
tf AS (SELECT chunk_id, term, count(*) AS n_term FROM
       (SELECT chunk_id, unnest(tokens) AS term FROM chunked) GROUP BY chunk_id, term),
terms AS (SELECT term, count(*) AS df,
          ln(((SELECT count(*) FROM chunked) + 1) / (count(*) + 1)) AS idf FROM tf GROUP BY term)"""
FALLBACK_ANSWER = filled(C.CHAT_FALLBACK, question=f"left(question, {C.QUOTE_CHARS})")
TOPIC = (
    "CASE WHEN contains(q, 'nicht') OR (contains(q, 'heit') AND contains(q, 'keit')) THEN 'german' "
    "WHEN contains(q, 'queau') OR (contains(q, 'ment') AND contains(q, 'eau')) THEN 'french' "
    "WHEN (contains(q, 'tion') AND contains(q, 'the')) OR contains(q, 'whou') THEN 'english' END"
)
TOPIC_ANSWER = (
    "CASE topic WHEN 'german' THEN 'Siehe Abschnitt 1.' WHEN 'french' THEN 'Voir section 2.' "
    f"WHEN 'english' THEN 'See section 3.' ELSE {FALLBACK_ANSWER} END"
)
ROUTED = (
    f"{QUESTIONS}, routed AS (SELECT *, {TOPIC} AS topic FROM "
    "(SELECT *, lower(question) AS q FROM questions))"
)
CONTEXT = f"""context AS (
  SELECT question_id, string_agg({filled(C.CONTEXT_TEMPLATE, id="doc_id", section="source", text="text")},
                                 chr(10) ORDER BY rank) AS context
  FROM hits JOIN documents USING (doc_id) GROUP BY question_id)"""
TRANSCRIPT = (
    "transcript AS (SELECT conv_id, turn, role, text AS content, 'English' AS lang "
    "FROM conversations)"
)
GAPS = (
    "gaps AS (SELECT doc_id, 'Label of ' || doc_id AS gap, quality || '→' || toxic AS change, "
    "CASE WHEN toxic = 1 THEN '🔴 CRITICAL' ELSE '🟠 HIGH' END AS risk FROM labels)"
)


def hashed_terms(terms: str, features: int = C.HASH_FEATURES) -> str:
    """CTEs ending in hashed(term, bucket): 32-bit MurmurHash3 of ASCII terms, seed 42."""

    def times(x: str, factor: int) -> str:
        return f"((({x})::HUGEINT * {factor}) % 4294967296)::BIGINT"

    def rotated(x: str, bits: int) -> str:
        return f"((({x}) * {2**bits}) % 4294967296 + ({x}) // {2**(32 - bits)})"

    def mixed(blocks: str) -> str:
        first = f"[{times('x', 0xCC9E2D51)} for x in {blocks}]"
        turned = f"[{rotated('x', 15)} for x in {first}]"
        return f"[{times('x', 0x1B873593)} for x in {turned}]"

    def byte(position: str, power: int) -> str:
        return f"codes[{position}] * {256**power}"

    block = " + ".join(byte(f"4 * i + {b + 1}", b) for b in range(4))
    rest = " + ".join(f"coalesce({byte(f'4 * (n // 4) + {b + 1}', b)}, 0)" for b in range(3))
    step = f"(({rotated('xor(h, k)', 13)}) * 5 + {0xE6546B64}) % 4294967296"
    return f"""coded AS (SELECT term, length(term) AS n,
  [ord(c)::BIGINT for c in string_split(term, '')] AS codes FROM (SELECT DISTINCT term FROM {terms})),
blocked AS (SELECT *, [{block} for i in range(0, n // 4)] AS blocks, [{rest}] AS rest FROM coded),
body AS (SELECT term, n, rest,
  list_reduce(list_concat([42::BIGINT], {mixed("blocks")}), lambda h, k: {step}) AS h FROM blocked),
tailed AS (SELECT term, xor(CASE WHEN n % 4 > 0 THEN xor(h, {mixed("rest")}[1]) ELSE h END, n) AS h FROM body),
end1 AS (SELECT term, {times("xor(h, h // 65536)", 0x85EBCA6B)} AS h FROM tailed),
end2 AS (SELECT term, {times("xor(h, h // 8192)", 0xC2B2AE35)} AS h FROM end1),
hashed AS (SELECT term, (xor(h, h // 65536) % {features})::INT AS bucket FROM end2),
bucketed AS (SELECT chunk_id, bucket, sum(n_term)::DOUBLE AS n FROM tf JOIN hashed USING (term)
             GROUP BY chunk_id, bucket)"""


def token_totals(stop=()) -> str:
    return f"""SELECT chunk_id, len(t)::INT AS n_tokens, coalesce(list_sum([length(x) for x in t]), 0)::INT AS n_chars,
array_to_string(t, ' ') AS tokens
FROM (SELECT key || '_' || chunk_index AS chunk_id, {ascii_list("chunk_text", stop)} AS t FROM ({POLICY_CHUNKS}))"""


GAP_BLOCKS = f"""blocks AS (
SELECT item_id, string_agg({filled(C.GAP_POLICY_TEMPLATE, id="doc_id", section="source",
    score="printf('%.4f', score)", text="text")}, '' ORDER BY rank) AS policies
FROM hits JOIN documents USING (doc_id) WHERE rank <= {C.PROMPT_K} GROUP BY item_id)"""
GAP_PROMPT = filled(
    C.GAP_PROMPT_TEMPLATE, ref="'REF/' || item_id", subject=SUBJECT, deadline="'2024-07-01'",
    text="text", policies="coalesce(policies, '')",
)
# What the responder of the checks answers to a prompt that it does not refuse.
ANSWER = (
    "('Gap 1: CRITICAL' || chr(10) || 'Digest ' || sha256(prompt) || chr(10) || chr(10) "
    "|| 'Checked ' || length(prompt) || ' characters')"
)
CHAT_PROMPT = filled(
    C.CHAT_PROMPT_TEMPLATE, context="context", question="question",
    language="CASE language WHEN 'Hindi' THEN " + text(C.LANGUAGE_REQUEST["Hindi"])
    + " WHEN 'Marathi' THEN " + text(C.LANGUAGE_REQUEST["Marathi"]) + " ELSE '' END",
)
CANNED = (
    f"CASE language WHEN 'Hindi' THEN {text(C.DEMO_PREFIX['Hindi'])} "
    f"WHEN 'Marathi' THEN {text(C.DEMO_PREFIX['Marathi'])} ELSE '' END || {TOPIC_ANSWER}"
)

GRADE = (
    "CASE WHEN contains(upper(section), 'THERE') AND contains(section, 'The') THEN 'critical' "
    "WHEN contains(upper(section), 'TION') AND contains(section, 'On') THEN 'high' ELSE 'plain' END"
)

ORACLES: dict[str, str] = {
    "bronze_policies": """SELECT doc_id::VARCHAR AS policy_id, lang AS domain, source AS section,
source || '/' || doc_id AS title, text AS policy_text, NULL::VARCHAR AS effective_date,
NULL::VARCHAR AS last_reviewed, 'ACTIVE' AS status, '2024-01-01T00:00:00' AS ingested_at FROM documents""",
    "bronze_circulars": f"""SELECT item_id::VARCHAR AS circular_id, 'REF/' || item_id AS circular_ref,
{SUBJECT} AS subject, NULL::VARCHAR AS issued_by, NULL::VARCHAR AS issued_date,
NULL::VARCHAR AS effective_date, text AS circular_text, NULL::VARCHAR AS category,
'2024-07-01' AS compliance_deadline, '2024-01-01T00:00:00' AS ingested_at FROM benchmark""",
    "medallion_roundtrip": f"""SELECT key::VARCHAR AS policy_id, lang AS domain, source AS section,
source || '/' || key AS title, chunk_index, chunk_text, key || '_' || chunk_index AS chunk_id,
'{C.POLICY_TAG}' AS source_type, NULL::VARCHAR AS circular_id, NULL::VARCHAR AS circular_ref,
NULL::VARCHAR AS subject, NULL::VARCHAR AS category FROM ({POLICY_CHUNKS}) JOIN documents ON key = doc_id
UNION ALL SELECT NULL, NULL, NULL, NULL, chunk_index, chunk_text, key || '_' || chunk_index,
'{C.CIRCULAR_TAG}', key::VARCHAR, 'REF/' || key, {SUBJECT}, NULL
FROM ({chunks("benchmark", "item_id", "text")}) JOIN benchmark ON key = item_id""",
    "kpi_summary": """SELECT (SELECT count(*) FROM documents) AS n_policies,
(SELECT count(*) FROM benchmark) AS n_circulars,
(SELECT count(*) FROM benchmark) * least(5, (SELECT count(*) FROM documents)) AS n_matches,
(SELECT count(*) FROM labels) AS n_open_gaps, 'Mock' AS provider""",
    "circular_labels": f"""SELECT item_id, item_id || ' — ' || left(text, {C.LABEL_CHARS}) || '...' AS label,
left(text, {C.PREVIEW_CHARS}) || '...' AS preview FROM benchmark""",
    "silver_clean_text": f"SELECT doc_id, {clean('text')} AS cleaned_text FROM documents",
    "silver_clean_html": f"SELECT page_id, {clean('html')} AS cleaned_text FROM pages",
    "chunk_fallback": f"""SELECT conv_id, turn, len(parts)::INT AS n_chunks, parts[1] = text AS is_whole
FROM (SELECT conv_id, turn, text, {sentences('text')} AS parts FROM conversations)""",
    "silver_policy_chunks": f"""SELECT key::VARCHAR AS policy_id, lang AS domain, source AS section,
source || '/' || key AS title, chunk_index, chunk_text, key || '_' || chunk_index AS chunk_id,
'{C.POLICY_TAG}' AS source_type FROM ({POLICY_CHUNKS}) JOIN documents ON key = doc_id""",
    "silver_circular_chunks": f"""SELECT key::VARCHAR AS circular_id, 'REF/' || key AS circular_ref,
{SUBJECT} AS subject, NULL::VARCHAR AS category, chunk_index, chunk_text,
key || '_' || chunk_index AS chunk_id, '{C.CIRCULAR_TAG}' AS source_type
FROM ({chunks("benchmark", "item_id", "text")}) JOIN benchmark ON key = item_id""",
    "gold_tokens": token_totals(),
    "gold_tokens_stopped": token_totals(GOLD_STOP),
    "gold_tf_hashed": f"""WITH {GOLD_COUNTS}, {hashed_terms("tf")}
SELECT chunk_id, bucket, n AS weight FROM bucketed""",
    "gold_tfidf_ml": f"""WITH {GOLD_COUNTS}, {hashed_terms("tf")},
widths AS (SELECT bucket, ln(((SELECT count(*) FROM chunked) + 1) / (count(*) + 1)) AS idf
           FROM bucketed GROUP BY bucket)
SELECT chunk_id, bucket, round(n * idf, 6) AS weight FROM bucketed JOIN widths USING (bucket)""",
    "gold_policies_table": f"""WITH {GOLD_COUNTS}, {hashed_terms("tf")},
widths AS (SELECT bucket, ln(((SELECT count(*) FROM chunked) + 1) / (count(*) + 1)) AS idf
           FROM bucketed GROUP BY bucket)
SELECT chunk_id, bucket, round(n * idf, 6) AS weight, key::VARCHAR AS policy_id, lang AS domain,
source AS section, source || '/' || key AS title
FROM bucketed JOIN widths USING (bucket) JOIN chunked USING (chunk_id) JOIN documents ON key = doc_id""",
    "gold_circulars_table": f"""WITH {GOLD_COUNTS.replace(POLICY_CHUNKS, CIRCULAR_CHUNKS)}, {hashed_terms("tf")},
widths AS (SELECT bucket, ln(((SELECT count(*) FROM chunked) + 1) / (count(*) + 1)) AS idf
           FROM bucketed GROUP BY bucket)
SELECT chunk_id, bucket, round(n * idf, 6) AS weight, key::VARCHAR AS circular_id,
'REF/' || key AS circular_ref, 'Subject of circular ' || key AS subject
FROM bucketed JOIN widths USING (bucket) JOIN chunked USING (chunk_id)""",
    "gold_idf": f"WITH {GOLD_COUNTS} SELECT term, df, round(idf, 6) AS idf FROM terms",
    "gold_tfidf_exact": f"""WITH {GOLD_COUNTS}
SELECT chunk_id, term, round(n_term * idf, 6) AS weight FROM tf JOIN terms USING (term)""",
    "doc_tokens": tokens("documents", "doc_id", "text"),
    "doc_tokens_nostop": tokens("documents", "doc_id", "text", ()),
    "term_frequency": f"""WITH {counted("tf", "doc_id", tokens("documents", "doc_id", "text"))}
SELECT doc_id, term, n_term, n_tokens, round(n_term / n_tokens, 6) AS tf FROM tf""",
    "doc_frequency": f"WITH {index_ctes()} SELECT term, df, round(idf, 6) AS idf FROM terms",
    "tfidf_index": f"WITH {index_ctes()} SELECT doc_id, term, round(weight, 6) AS weight FROM weights",
    "index_reopened": f"WITH {index_ctes()} SELECT doc_id, term, round(weight, 6) AS weight FROM weights",
    "index_appended": f"WITH {index_ctes()} SELECT doc_id, term, round(weight, 6) AS weight FROM weights",
    "index_updated": f"WITH {index_ctes()} SELECT doc_id, term, round(weight, 6) AS weight FROM weights",
    "index_deleted": f"""WITH chosen AS (SELECT * FROM documents WHERE doc_id % 4 <> 1), {index_ctes("chosen")}
SELECT doc_id, term, round(weight, 6) AS weight FROM weights""",
    "doc_norms": f"WITH {index_ctes()} SELECT doc_id, round(norm, 6) AS norm FROM norms",
    "query_vectors": f"""WITH {counted("qtf", "item_id", tokens("benchmark", "item_id", "text"))}
SELECT item_id, term, round(n_term / n_tokens, 6) AS weight FROM qtf""",
    "query_vectors_binary": f"""WITH {QUESTIONS}
SELECT DISTINCT question_id, term, 1.0::DOUBLE AS weight
FROM ({tokens("questions", "question_id", "question")})""",
    "cosine_scores": f"""{CIRCULAR_RANKING}
SELECT item_id, doc_id, score FROM scores WHERE score >= {C.YELLOW_ABOVE}""",
    "retrieve_topk": f"""{ranking("benchmark", "item_id", "text", C.PANEL_K, pad=False)}
SELECT item_id, doc_id, rank, score, lang, source FROM hits JOIN documents USING (doc_id)""",
    "retrieve_topk_padded": f"""{ranking("questions", "question_id", "question", C.DEFAULT_K, before=QUESTIONS + ", ")}
SELECT question_id, doc_id, rank, score FROM hits""",
    "retrieve_domain": f"""{ranking("questions", "question_id", "question", C.CHAT_K, source="chosen", binary=True,
    before=QUESTIONS + ", chosen AS (SELECT * FROM documents WHERE lang IN ('de', 'es')), ")}
SELECT question_id, doc_id, rank, score, lang FROM hits JOIN chosen USING (doc_id)""",
    "domain_idf": f"""WITH chosen AS (SELECT * FROM documents WHERE lang IN ('de', 'es')), {index_ctes("chosen")}
SELECT term, df, round(idf, 6) AS idf FROM terms""",
    "match_bars": f"""{CIRCULAR_RANKING}
SELECT item_id, doc_id, rank, {BAR} AS bar_pct, {TIER} AS tier FROM hits""",
    "gap_matches": f"""{CIRCULAR_RANKING}
SELECT item_id, doc_id, rank, score, {BAR} AS bar_pct, {TIER} AS tier, lang, source
FROM hits JOIN documents USING (doc_id)""",
    "gap_prompt": f"""{CIRCULAR_RANKING}, {GAP_BLOCKS}
SELECT item_id, {GAP_PROMPT} AS prompt FROM benchmark LEFT JOIN blocks USING (item_id)""",
    "gap_report_chain": f"""{CIRCULAR_RANKING}, {GAP_BLOCKS}, {REPLIES},
prompts AS (SELECT item_id, {GAP_PROMPT} AS prompt FROM benchmark LEFT JOIN blocks USING (item_id)),
reports AS (SELECT item_id, CASE WHEN sha256(prompt) >= '8' THEN {ANSWER} ELSE coalesce(report, {NO_REPORT}) END AS report
            FROM prompts LEFT JOIN replies USING (item_id)),
parts AS (SELECT item_id, string_split(report, chr(10) || chr(10)) AS parts FROM reports),
sections AS (SELECT item_id, (i - 1)::INT AS section_index, parts[i] AS section
             FROM (SELECT item_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM parts)),
graded AS (SELECT *, CASE WHEN contains(upper(section), 'CRITICAL') AND contains(section, 'Gap') THEN 'critical'
    WHEN contains(upper(section), 'HIGH') AND contains(section, 'Gap') THEN 'high' ELSE 'plain' END AS grade FROM sections)
SELECT item_id, section_index, grade, CASE grade WHEN 'plain' THEN section ELSE replace(section, chr(10), '<br>') END AS markup
FROM graded WHERE grade <> 'plain' OR length(regexp_replace(section, '{SPACE}+', '', 'g')) > 0""",
    "report_files": f"""WITH {REPLIES}, texts AS (
SELECT {filled(C.EXPORT_TEMPLATE, ref="'REF/' || item_id", report=f"coalesce(report, {NO_REPORT})")} AS t
FROM benchmark LEFT JOIN replies USING (item_id))
SELECT value, count(*) AS n_lines FROM (SELECT unnest(string_split(t, chr(10))) AS value FROM texts) GROUP BY value""",
    "gap_prompt_short": f"""{ranking("benchmark", "item_id", "text", C.SHORT_K, stop=())}
SELECT item_id, {filled(C.SHORT_PROMPT_TEMPLATE, text="b.text", policy="d.text")} AS prompt
FROM hits JOIN documents d USING (doc_id) JOIN benchmark b USING (item_id) WHERE rank = 1""",
    "gap_lookup": f"""WITH {REPLIES} SELECT item_id, coalesce(report, {NO_REPORT}) AS report
FROM benchmark LEFT JOIN replies USING (item_id)""",
    "gap_matrix": f"""WITH {GAPS} SELECT doc_id, gap, change, risk, source
FROM gaps LEFT JOIN documents USING (doc_id)""",
    "report_sections": f"""SELECT doc_id, section_index, grade,
CASE grade WHEN 'plain' THEN section ELSE replace(section, chr(10), '<br>') END AS markup
FROM (SELECT *, {GRADE} AS grade FROM (
  SELECT doc_id, (i - 1)::INT AS section_index, parts[i] AS section FROM (
    SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (
      SELECT doc_id, string_split(regexp_replace(text, '\\n([A-M])', chr(10) || chr(10) || '\\1', 'g'), chr(10) || chr(10)) AS parts
      FROM documents))))
WHERE grade <> 'plain' OR length(regexp_replace(section, '{SPACE}+', '', 'g')) > 0""",
    "gap_report_export": f"""WITH {REPLIES}
SELECT item_id, 'gap_analysis_' || item_id || '_20240501.txt' AS file_name,
{filled(C.EXPORT_TEMPLATE, ref="'REF/' || item_id", report=f"coalesce(report, {NO_REPORT})")} AS export_text
FROM benchmark LEFT JOIN replies USING (item_id)""",
    "report_fallback": f"""WITH {REPLIES}, prompts AS (SELECT item_id, text AS prompt FROM benchmark)
SELECT item_id, CASE WHEN sha256(prompt) >= '8' THEN {ANSWER} ELSE coalesce(report, {NO_REPORT}) END AS report
FROM prompts LEFT JOIN replies USING (item_id)""",
    "query_source": f"""SELECT item_id, CASE WHEN length(regexp_replace(custom, '{SPACE}+', '', 'g')) > 0
THEN custom ELSE text END AS query_text FROM benchmark LEFT JOIN (
SELECT conv_id AS item_id, arg_max(CASE role WHEN 'assistant' THEN ' ' || chr(9) ELSE text END, turn) AS custom
FROM conversations GROUP BY conv_id) USING (item_id)""",
    "chat_context": f"{CHAT_RANKING}, {CONTEXT} SELECT question_id, context FROM context",
    "chat_prompt": f"""{CHAT_RANKING}, {CONTEXT}
SELECT question_id, {CHAT_PROMPT} AS prompt FROM questions JOIN context USING (question_id)""",
    "chat_intent": f"WITH {ROUTED} SELECT question_id, topic, {TOPIC_ANSWER} AS answer FROM routed",
    "chat_answered": f"""{CHAT_RANKING}, {CONTEXT},
prompts AS (SELECT *, {CHAT_PROMPT} AS prompt FROM questions JOIN context USING (question_id)),
routed AS (SELECT *, {TOPIC} AS topic FROM (SELECT *, lower(question) AS q FROM prompts))
SELECT question_id, CASE WHEN sha256(prompt) >= '8' THEN {ANSWER}
ELSE {filled(C.ERROR_PREFIX, error="'refused'")} || {CANNED} END AS answer FROM routed""",
    "chat_answers": f"""WITH {ROUTED} SELECT question_id, topic, {CANNED} AS answer
FROM routed WHERE length(regexp_replace(question, '{SPACE}+', '', 'g')) > 0""",
    "chat_sources": f"""{CHAT_RANKING}
SELECT question_id, rank, doc_id, source, n_chars, lang, score
FROM hits JOIN documents USING (doc_id)""",
    "transcript_append": f"""WITH {TRANSCRIPT},
ends AS (SELECT conv_id, max(turn) AS last_turn FROM transcript GROUP BY conv_id),
asked AS (SELECT conv_id, arg_max(content, turn) AS question FROM transcript WHERE role = 'user' GROUP BY conv_id)
SELECT * FROM transcript UNION ALL
SELECT conv_id, last_turn + 1, 'user', question, 'English' FROM asked JOIN ends USING (conv_id) UNION ALL
SELECT conv_id, last_turn + 2, 'assistant', {FALLBACK_ANSWER}, 'English' FROM asked JOIN ends USING (conv_id)""",
    "transcript_start": """SELECT DISTINCT conv_id, 0::BIGINT AS turn, 'assistant' AS role,
'Ask about the policies.' AS content, 'English' AS lang FROM conversations""",
    "transcript_tagged": """SELECT conv_id, turn, CASE WHEN role = 'user' OR turn % 3 = 0 THEN text
WHEN turn % 3 = 1 THEN text || ' [Hindi]' ELSE text || ' [EN]' END AS shown FROM conversations""",
    "currency_amounts": """SELECT o_orderkey, 0 AS amount_index, 'Rs. ' || format('{:,.2f}', o_totalprice) AS amount_text,
round(o_totalprice, 2)::DOUBLE AS rupees, false AS too_large FROM orders
UNION ALL SELECT o_orderkey, 1, 'INR' || format('{:.2f}', o_totalprice), round(o_totalprice, 2), false FROM orders
UNION ALL SELECT o_orderkey, 2, '₹' || o_custkey || ' crore', o_custkey * 1e7, false FROM orders""",
    "currency_normalized": """SELECT o_orderkey, 'For years 2024, hours 12: INR ' || format('{:.2f}', o_totalprice)
|| ' or INR ' || format('{:.2f}', o_totalprice) || ', at most INR ' || o_custkey || ' crore, 1,000 papers.' AS note FROM orders""",
    "requirement_conflicts": """SELECT 'C' || p_partkey AS circular, p_partkey, 'day' AS unit,
(p_size + 2)::DOUBLE AS required, p_size || '.0' AS stated FROM part WHERE p_partkey % 2 = 0""",
    "requirement_intervals": """SELECT 'C' || p_partkey AS circular, p_partkey, 'day' AS unit, p_size::DOUBLE AS required,
  (p_size * 20 / 24.0)::DOUBLE::VARCHAR AS stated FROM part WHERE p_partkey % 3 = 0 AND p_size * 20 > p_size * 24
UNION ALL SELECT 'C' || p_partkey, p_partkey, 'hour', 1000.0, (p_size * 20) || '.0' FROM part WHERE p_partkey % 3 = 1 AND p_size * 20 < 1000
UNION ALL SELECT 'C' || p_partkey, p_partkey, 'month', p_size::DOUBLE,
  CASE WHEN p_size + 5 + p_partkey % 9 < 36 THEN (p_size + 5 + p_partkey % 9) || '.0,36.0'
       WHEN p_size + 5 + p_partkey % 9 > 36 THEN '36.0,' || (p_size + 5 + p_partkey % 9) || '.0' ELSE '36.0' END
FROM part WHERE p_partkey % 3 = 2 AND 5 + p_partkey % 9 > 10 AND NOT (36 BETWEEN p_size AND p_size + 10)""",
    "transcript_clear": f"""WITH {TRANSCRIPT} SELECT conv_id, turn, role, content, lang FROM transcript
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1""",
    "respond": f"""{CHAT_RANKING}, {CONTEXT},
prompts AS (SELECT question_id, {CHAT_PROMPT} AS prompt FROM questions JOIN context USING (question_id))
SELECT question_id, CASE WHEN sha256(prompt) >= '8' THEN {ANSWER} END AS answer,
CASE WHEN sha256(prompt) < '8' THEN 'refused' END AS error FROM prompts""",
    "sentence_pairs": f"""SELECT key::VARCHAR AS policy_id, (chunk_index // 2)::INT AS chunk_index,
string_agg(chunk_text, ' ' ORDER BY chunk_index) AS chunk_text,
key || '_' || (chunk_index // 2) AS chunk_id, '{C.POLICY_TAG}' AS source_type
FROM ({POLICY_CHUNKS}) GROUP BY key, chunk_index // 2""",
    "directive_blocks": f"""WITH sentences AS (SELECT *, sum(CASE WHEN chunk_index = 0 OR
  regexp_matches(chunk_text, '(?i)(^|[^\\p{{L}}\\p{{N}}_])(there|nicht|avec|los)($|[^\\p{{L}}\\p{{N}}_])')
  THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY chunk_index) - 1 AS block FROM ({POLICY_CHUNKS}))
SELECT key::VARCHAR AS policy_id, block::INT AS chunk_index,
string_agg(chunk_text, ' ' ORDER BY chunk_index) AS chunk_text,
key || '_' || block AS chunk_id, '{C.POLICY_TAG}' AS source_type FROM sentences GROUP BY key, block""",
    "stream_silver": f"""SELECT key AS doc_id, lang, chunk_index, chunk_text,
key || '_' || chunk_index AS chunk_id, '{C.POLICY_TAG}' AS source_type
FROM ({POLICY_CHUNKS}) JOIN documents ON key = doc_id""",
    "gold_scored_later": f"""WITH {GOLD_COUNTS}, {hashed_terms("tf")},
learned AS (SELECT chunk_id FROM chunked WHERE key % 2 = 0),
widths AS (SELECT bucket, ln(((SELECT count(*) FROM learned) + 1) / (count(*) + 1)) AS idf
           FROM bucketed JOIN learned USING (chunk_id) GROUP BY bucket)
SELECT chunk_id, bucket, round(n * coalesce(idf, 0), 6) AS weight
FROM bucketed JOIN chunked USING (chunk_id) LEFT JOIN widths USING (bucket) WHERE key % 2 = 1""",
    "topic_rules": f"""WITH {QUESTIONS}, rules AS (
SELECT doc_id, 'pair' AS alternative, lower(substr(text, 1, 4)) AS word FROM documents
UNION SELECT doc_id, 'pair', lower(substr(text, 12, 3)) FROM documents
UNION SELECT doc_id, 'one', lower(substr(text, 25, 6)) FROM documents),
sets AS (SELECT doc_id % 97 AS priority, 'T' || doc_id AS topic, list(DISTINCT word) AS words
         FROM rules WHERE word <> '' GROUP BY doc_id, alternative),
hits AS (SELECT question_id, min({{'priority': priority, 'topic': topic}}).topic AS topic
         FROM questions JOIN sets ON len([w for w in words if NOT contains(lower(question), w)]) = 0
         GROUP BY question_id)
SELECT question_id, topic FROM questions LEFT JOIN hits USING (question_id)""",
}
# What is reached in several steps equals what one step gives.
ORACLES |= {
    "silver_incremental": ORACLES["silver_policy_chunks"],
    "respond_resumed": ORACLES["respond"],
    "stream_matches": ORACLES["gap_matches"],
    "cosine_scores_pruned": ORACLES["cosine_scores"],
    "retrieve_topk_pruned": ORACLES["retrieve_topk"],
}
