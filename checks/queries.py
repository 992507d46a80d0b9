"""Every operator over the given tables, by name.

documents stand for policies (lang: domain, source: section), benchmark items for
circulars, user turns of conversations for chat questions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapledger import constants as C
from gapledger.functions.text import clean_text, sentence_chunks
from gapledger.operators import chat as Q
from gapledger.operators import report as R
from gapledger.operators.gold import (
    fit_gold,
    hashed_counts,
    kept_model,
    learn_chunks,
    tokens_only,
    vector_entries,
)
from gapledger.operators.index import (
    CHUNK,
    DOCUMENT_ALL_WORDS,
    Index,
    build_index,
    corpus_size,
    doc_norms,
    doc_tokens,
    index_of_domains,
    query_vectors,
    stored_counts,
    term_frequency,
    term_table,
    weigh,
)
from gapledger.operators.respond import respond, respond_durably
from gapledger.operators.retrieve import (
    Limits,
    cosine_scores,
    query_source,
    retrieve,
    with_records,
)
from gapledger.operators.silver import (
    chunk_rows,
    directive_blocks,
    sentence_pairs,
    silver_circulars,
    silver_policies,
)
from gapledger.operators import amounts as A
from gapledger.operators.stored_index import (
    append_documents,
    merge_segments,
    open_index,
    save_index,
    update_documents,
)
from gapledger.plans.chat_batch import canned_answers, chat_answered, chat_hits, chat_prompts
from gapledger.plans.gap_analysis import CircularColumns, answered, gap_matches, prompts_for
from gapledger.plans.incremental import refresh_silver
from gapledger.plans.medallion import TableNames, run_bronze, run_gold, run_silver
from gapledger.sources.bronze import (
    CIRCULAR_SCHEMA,
    POLICY_SCHEMA,
    table_to_bronze,
)
from gapledger.sources.shared import build_once, new_folder, write_once
from gapledger.sources.tables import create_database, load_table, read_folder
from gapledger.streaming.live_matches import match_stream, newest_matches
from gapledger.streaming.silver_stream import append_stream, stream_files

STAMP = "2024-01-01T00:00:00"
DEADLINE = "2024-07-01"
DEFAULT_REPORT = "No report is on file."
DOMAINS = ["de", "es"]
EXPORT_DAY = "2024-05-01"
# Limits under which every search takes the pruned way.
PRUNED = Limits(blocks=0)
# Word lists that occur in the given texts, in the shape of the library's own.
TOPICS = (
    ("german", (("nicht",), ("heit", "keit"))),
    ("french", (("queau",), ("ment", "eau"))),
    ("english", (("tion", "the"), ("whou",))),
)
ANSWERS = {"german": "Siehe Abschnitt 1.", "french": "Voir section 2.", "english": "See section 3."}
CUES = ("there", "nicht", "avec", "los")
GRADES = (("critical", "THERE", "The"), ("high", "TION", "On"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """The given files are one split each; a table of the size the library is for has many, and is read as it lies."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if not df.isStreaming and df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(read_folder(spark, d, "documents"), "doc_id")


def circulars(spark: SparkSession, d: str) -> DataFrame:
    return read_folder(spark, d, "benchmark")


def questions(spark: SparkSession, d: str) -> DataFrame:
    turn = F.col("turn")
    return (
        read_folder(spark, d, "conversations")
        .where(F.col("role") == "user")
        .select(
            F.concat("conv_id", F.lit("-"), "turn").alias("question_id"),
            F.col("text").alias("question"),
            F.when(turn == 2, "Hindi").when(turn == 4, "Marathi").otherwise("English")
            .alias("language"),
        )
    )


def document_index(spark: SparkSession, d: str, domains: list[str] | None = None) -> Index:
    index = build_index(documents(spark, d), "doc_id", "text", (d, "documents"), domain="lang")
    return index_of_domains(index, domains, (d, "documents")) if domains else index


def subject() -> F.Column:
    """The circulars at hand have no subject column."""
    return F.concat(F.lit("Subject of circular "), "item_id")


def bronze_policies(spark, d):
    mapping = {
        "policy_id": "doc_id", "domain": "lang", "section": "source",
        "title": F.concat("source", F.lit("/"), "doc_id"), "policy_text": "text",
        "status": F.lit("ACTIVE"),
    }
    return table_to_bronze(documents(spark, d), POLICY_SCHEMA, mapping, STAMP)


def bronze_circulars(spark, d):
    mapping = {
        "circular_id": "item_id", "circular_ref": F.concat(F.lit("REF/"), "item_id"),
        "subject": subject(), "circular_text": "text",
        "compliance_deadline": F.lit(DEADLINE),
    }
    return table_to_bronze(circulars(spark, d), CIRCULAR_SCHEMA, mapping, STAMP)


def _medallion(spark, d) -> TableNames:
    """Bronze and silver tables of both corpora in a database of their own."""
    folder = new_folder(spark, "medallion")
    database = create_database(spark, folder.rpartition("/")[2].replace("-", "_"), folder)
    names = TableNames(database)
    run_bronze(bronze_policies(spark, d), bronze_circulars(spark, d), names)
    run_silver(spark, names)
    return names


def medallion_roundtrip(spark, d):
    """Both silver tables, all columns, as they come back from their scan."""
    names = _medallion(spark, d)
    policies = load_table(spark, names.of("silver", names.policies))
    circular_chunks = load_table(spark, names.of("silver", names.circulars))
    return policies.unionByName(circular_chunks, allowMissingColumns=True)


def _gold_table(spark, d, policies: bool, columns):
    names = _medallion(spark, d)
    run_gold(spark, names)
    table = load_table(spark, names.of("gold", names.policies if policies else names.circulars))
    entries = vector_entries(table, "tfidf_features", "chunk_id")
    return entries.join(table.select("chunk_id", *columns), "chunk_id").withColumn(
        "weight", F.round("weight", 6)
    )


def gold_policies_table(spark, d):
    return _gold_table(spark, d, True, ["policy_id", "domain", "section", "title"])


def gold_circulars_table(spark, d):
    return _gold_table(spark, d, False, ["circular_id", "circular_ref", "subject"])


def kpi_summary(spark, d):
    items = circulars(spark, d)
    hits = retrieve(document_index(spark, d), items, "item_id", "text", C.PANEL_K)
    return R.kpis(
        read_folder(spark, d, "documents"), items, hits, labelled_gaps(spark, d),
        "Mock (No Key Needed)",
    )


def circular_labels(spark, d):
    items = circulars(spark, d)
    labels = items.select(R.label(F.col("item_id"), F.col("text")).alias("label"))
    return R.by_label(items, "item_id", "text", labels).select(
        "item_id", "label", R.preview(F.col("text")).alias("preview")
    )


def silver_clean_text(spark, d):
    return documents(spark, d).select("doc_id", clean_text(F.col("text")).alias("cleaned_text"))


def silver_clean_html(spark, d):
    pages = spread(read_folder(spark, d, "pages"), "page_id")
    return pages.select("page_id", clean_text(F.col("html")).alias("cleaned_text"))


def chunk_fallback(spark, d):
    """Chunks per message, of any role; a message without a long sentence keeps its text."""
    chunks = read_folder(spark, d, "conversations").select(
        "conv_id", "turn", "text", sentence_chunks(F.col("text")).alias("chunks")
    )
    return chunks.select(
        "conv_id", "turn",
        F.size("chunks").alias("n_chunks"),
        (F.get("chunks", F.lit(0)) == F.col("text")).alias("is_whole"),
    )


def silver_policy_chunks(spark, d):
    return silver_policies(bronze_policies(spark, d))


def silver_circular_chunks(spark, d):
    return silver_circulars(bronze_circulars(spark, d))


def silver_table(spark, d):
    """The silver table that all gold steps read, written once."""
    return build_once(spark, (d,), "silver", lambda: silver_policy_chunks(spark, d))


def _token_totals(df, tokens):
    lengths = F.aggregate(
        F.col(tokens), F.lit(0), lambda total, token: total + F.length(token)
    )
    return df.select(
        "chunk_id", F.size(tokens).alias("n_tokens"), lengths.alias("n_chars"),
        F.array_join(tokens, " ").alias("tokens"),
    )


def gold_tokens(spark, d):
    return _token_totals(tokens_only(silver_table(spark, d)), "tokens_raw")


def gold_tokens_stopped(spark, d):
    return _token_totals(tokens_only(silver_table(spark, d)), "tokens")


def gold_tf_hashed(spark, d):
    return vector_entries(
        hashed_counts(silver_table(spark, d)), "raw_features", "chunk_id"
    )


def gold_tfidf_ml(spark, d):
    silver = silver_table(spark, d)
    vectors = fit_gold(silver).transform(silver)
    return vector_entries(vectors, "tfidf_features", "chunk_id").withColumn(
        "weight", F.round("weight", 6)
    )


def _gold_counts(spark, d):
    return stored_counts(silver_table(spark, d), "chunk_id", "chunk_text", (d, "chunks"), CHUNK)


def _gold_terms(spark, d):
    size = corpus_size(silver_table(spark, d))
    return build_once(
        spark, (d,), "gold_terms", lambda: term_table(_gold_counts(spark, d), size, CHUNK)
    )


def gold_idf(spark, d):
    return _gold_terms(spark, d).select("term", "df", F.round("idf", 6).alias("idf"))


def gold_tfidf_exact(spark, d):
    weighed = weigh(_gold_counts(spark, d), _gold_terms(spark, d))
    return weighed.select("chunk_id", "term", F.round("weight", 6).alias("weight"))


def doc_tokens_query(spark, d):
    return doc_tokens(documents(spark, d), "doc_id", "text")


def doc_tokens_nostop(spark, d):
    return doc_tokens(documents(spark, d), "doc_id", "text", DOCUMENT_ALL_WORDS)


def term_frequency_query(spark, d):
    return term_frequency(documents(spark, d), "doc_id", "text").select(
        "doc_id", "term", F.col("n_term").cast("long"), F.col("n_tokens").cast("long"),
        F.round("tf", 6).alias("tf"),
    )


def _document_counts(spark, d):
    return stored_counts(documents(spark, d), "doc_id", "text", (d, "documents"), domain="lang")


def doc_frequency_query(spark, d):
    size = corpus_size(read_folder(spark, d, "documents"))
    terms = term_table(_document_counts(spark, d), size)
    return terms.select("term", "df", F.round("idf", 6).alias("idf"))


def tfidf_index(spark, d):
    return document_index(spark, d).postings.select(
        "doc_id", "term", F.round("weight", 6).alias("weight")
    )


def _saved_weights(index):
    return index.postings.select("doc_id", "term", F.round("weight", 6).alias("weight"))


def index_reopened(spark, d):
    """The index saved to a folder and opened from there."""
    folder = new_folder(spark, "saved")
    save_index(documents(spark, d), "doc_id", "text", folder, domain="lang")
    return _saved_weights(open_index(spark, folder, read_folder(spark, d, "documents")))


def index_appended(spark, d):
    """Documents with even ids indexed first, those with odd ids added."""
    docs, folder = documents(spark, d), new_folder(spark, "grown")
    save_index(docs.where(F.col("doc_id") % 2 == 0), "doc_id", "text", folder)
    append_documents(spark, folder, docs.where(F.col("doc_id") % 2 == 1))
    return _saved_weights(open_index(spark, folder, docs))


def index_updated(spark, d):
    """A third of the documents indexed with other texts first, then replaced; segments folded at the end."""
    docs, folder = documents(spark, d), new_folder(spark, "updated")
    third = F.col("doc_id") % 3 == 0
    old = docs.withColumn("text", F.when(third, F.concat(F.lit("superseded wording "), "lang", F.lit(" "), F.substring("text", 1, 40))).otherwise(F.col("text")))
    save_index(old, "doc_id", "text", folder, domain="lang")
    update_documents(spark, folder, docs.where(third & (F.col("doc_id") % 2 == 0)))
    update_documents(spark, folder, docs.where(third & (F.col("doc_id") % 2 == 1)))
    merge_segments(spark, folder)
    return _saved_weights(open_index(spark, folder, docs))


def index_deleted(spark, d):
    """All documents indexed, a quarter of them taken out again."""
    docs, folder = documents(spark, d), new_folder(spark, "deleted")
    quarter = F.col("doc_id") % 4 == 1
    save_index(docs, "doc_id", "text", folder)
    update_documents(spark, folder, removed=docs.where(quarter))
    return _saved_weights(open_index(spark, folder, docs.where(~quarter)))


def doc_norms_query(spark, d):
    norms = doc_norms(document_index(spark, d).postings, "doc_id")
    return norms.select("doc_id", F.round("norm", 6).alias("norm"))


def query_vectors_query(spark, d):
    vectors = query_vectors(circulars(spark, d), "item_id", "text")
    return vectors.select("item_id", "term", F.round("weight", 6).alias("weight"))


def query_vectors_binary(spark, d):
    vectors = query_vectors(questions(spark, d), "question_id", "question", binary=True)
    return vectors.select("question_id", "term", "weight")


def cosine_scores_query(spark, d):
    index, items = document_index(spark, d), circulars(spark, d)
    scores = cosine_scores(index, items, "item_id", "text", min_score=C.YELLOW_ABOVE)
    return scores.select("item_id", "doc_id", "score")


def _records(spark, d, hits, *columns):
    return with_records(hits, read_folder(spark, d, "documents"), "doc_id", list(columns))


def retrieve_topk(spark, d):
    hits = retrieve(
        document_index(spark, d), circulars(spark, d), "item_id", "text", C.PANEL_K, pad=False
    )
    return _records(spark, d, hits, "lang", "source").select(
        "item_id", "doc_id", "rank", "score", "lang", "source"
    )


def retrieve_topk_padded(spark, d):
    hits = retrieve(
        document_index(spark, d), questions(spark, d), "question_id", "question", C.DEFAULT_K
    )
    return hits.select("question_id", "doc_id", "rank", "score")


def cosine_scores_pruned(spark, d):
    index, items = document_index(spark, d), circulars(spark, d)
    scores = cosine_scores(index, items, "item_id", "text", min_score=C.YELLOW_ABOVE, limits=PRUNED)
    return scores.select("item_id", "doc_id", "score")


def retrieve_topk_pruned(spark, d):
    hits = retrieve(
        document_index(spark, d), circulars(spark, d), "item_id", "text", C.PANEL_K, pad=False, limits=PRUNED
    )
    return _records(spark, d, hits, "lang", "source").select(
        "item_id", "doc_id", "rank", "score", "lang", "source"
    )


def retrieve_domain(spark, d):
    hits = chat_hits(
        document_index(spark, d, DOMAINS), questions(spark, d), "question_id", "question",
        ["lang"], binary=True,
    )
    return hits.select(
        "question_id", "doc_id", "rank", "score", "lang"
    )


def domain_idf(spark, d):
    """IDF of chosen domains from the counts stored for all."""
    chosen = F.col("lang").isin(DOMAINS)
    n_docs = corpus_size(read_folder(spark, d, "documents").where(chosen))
    terms = term_table(_document_counts(spark, d).where(chosen), n_docs)
    return terms.select("term", "df", F.round("idf", 6).alias("idf"))


def match_bars(spark, d):
    hits = retrieve(document_index(spark, d), circulars(spark, d), "item_id", "text", C.PANEL_K)
    return R.match_bars(hits, "item_id").select("item_id", "doc_id", "rank", "bar_pct", "tier")


def gap_matches_query(spark, d):
    matches = gap_matches(
        document_index(spark, d), circulars(spark, d), "item_id", "text", ["lang", "source"]
    )
    return matches.select(
        "item_id", "doc_id", "rank", "score",
        "bar_pct", "tier", "lang", "source",
    )


def _circular_rows(spark, d):
    return circulars(spark, d).select(
        "item_id", F.concat(F.lit("REF/"), "item_id").alias("circular_ref"),
        subject().alias("subject"),
        F.lit(DEADLINE).alias("compliance_deadline"), F.col("text").alias("circular_text"),
    )


def gap_prompt(spark, d):
    return prompts_for(
        document_index(spark, d), _circular_rows(spark, d),
        CircularColumns("item_id", text="circular_text"), "source",
    )


def gap_prompt_short(spark, d):
    """The search of the short prompt keeps every word."""
    rows = _circular_rows(spark, d)
    index = build_index(
        documents(spark, d), "doc_id", "text", (d, "documents"), DOCUMENT_ALL_WORDS
    )
    hits = retrieve(index, rows, "item_id", "circular_text", C.SHORT_K)
    found = _records(spark, d, hits, "text").join(rows, "item_id")
    return R.short_prompts(found, "item_id", F.col("circular_text"), F.col("text"))


def _replies(spark, d):
    """The last reply of every conversation."""
    return (
        read_folder(spark, d, "conversations")
        .where(F.col("role") == "assistant")
        .groupBy(F.col("conv_id").alias("item_id"))
        .agg(F.max_by("text", "turn").alias("report"))
    )


def gap_lookup(spark, d):
    found = R.lookup_reports(circulars(spark, d), _replies(spark, d), "item_id", DEFAULT_REPORT)
    return found.select("item_id", "report")


def report_sections(spark, d):
    """Every document as a report; a line that starts with A to M begins a section."""
    lines = F.regexp_replace("text", "\n([A-M])", "\n\n$1")
    reports = documents(spark, d).select("doc_id", lines.alias("report"))
    return R.report_sections(reports, "doc_id", "report", GRADES).select(
        "doc_id", "section_index", "grade", "markup"
    )


def gap_report_export(spark, d):
    reports = R.lookup_reports(
        _circular_rows(spark, d), _replies(spark, d), "item_id", DEFAULT_REPORT
    )
    return R.report_export(
        reports, "item_id", F.col("circular_ref"), F.col("report"), F.to_date(F.lit(EXPORT_DAY))
    )


def responder():
    """Answers from the whole prompt; refuses those whose digest starts below 8."""

    def answer(prompts):
        import hashlib

        digests = [hashlib.sha256(p.encode()).hexdigest() for p in prompts]
        if any(x < "8" for x in digests):
            raise ValueError("refused")
        lines = "Gap 1: CRITICAL\nDigest {}\n\nChecked {} characters"
        return prompts.map(dict(zip(prompts, map(lines.format, digests, prompts.str.len()))))

    return answer


def report_fallback(spark, d):
    """Circulars sent as they are; a refused one gets its last reply, or the default."""
    items = circulars(spark, d).withColumn("prompt", F.col("text"))
    return answered(
        items, items, "item_id", _replies(spark, d), DEFAULT_REPORT, responder()
    ).select("item_id", "report")


def gap_report_chain(spark, d):
    """Matches, prompts, answers, canned reports, graded sections."""
    rows = _circular_rows(spark, d)
    reports = answered(
        gap_prompt(spark, d), rows, "item_id", _replies(spark, d), DEFAULT_REPORT, responder()
    )
    return R.report_sections(reports, "item_id", "report").select(
        "item_id", "section_index", "grade", "markup"
    )


def report_files(spark, d):
    """Export texts written to files, and their lines read back."""
    folder = new_folder(spark, "exports")
    R.write_exports(gap_report_export(spark, d), folder)
    return spark.read.text(folder).groupBy("value").agg(F.count("*").alias("n_lines"))


def labelled_gaps(spark, d):
    return read_folder(spark, d, "labels").select(
        "doc_id",
        F.concat(F.lit("Label of "), "doc_id").alias("gap"),
        F.concat("quality", F.lit("→"), "toxic").alias("change"),
        F.when(F.col("toxic") == 1, "🔴 CRITICAL").otherwise("🟠 HIGH").alias("risk"),
    )


def gap_matrix(spark, d):
    return R.gap_matrix(
        labelled_gaps(spark, d), read_folder(spark, d, "documents"), "doc_id", "source"
    )


def chat_context(spark, d):
    hits = retrieve(
        document_index(spark, d), questions(spark, d), "question_id", "question", C.CHAT_K
    )
    return Q.contexts(
        _records(spark, d, hits, "source", "text"), "question_id", "doc_id", "source", "text"
    )


def chat_prompt(spark, d):
    return chat_prompts(
        document_index(spark, d), questions(spark, d), "question_id", "question",
        "source", "language",
    )


def chat_intent(spark, d):
    asked = questions(spark, d)
    found = asked.withColumn("topic", Q.topic(F.col("question"), TOPICS))
    return found.select(
        "question_id", "topic",
        Q.topic_answer(F.col("question"), F.col("topic"), ANSWERS).alias("answer"),
    )


def chat_answers(spark, d):
    return canned_answers(
        questions(spark, d), "question_id", "question", "language", ANSWERS, TOPICS
    )


def chat_answered_query(spark, d):
    """Prompts to the responder; a refused one gets an error note and the canned answer."""
    return chat_answered(
        chat_prompt(spark, d), chat_answers(spark, d), "question_id", responder()
    )


def chat_sources(spark, d):
    hits = chat_hits(
        document_index(spark, d), questions(spark, d), "question_id", "question",
        ["lang", "source", "n_chars"],
    )
    return Q.sources(hits, "question_id", ["doc_id", "source", "n_chars", "lang"])


def _transcript(spark, d):
    return read_folder(spark, d, "conversations").select(
        "conv_id", "turn", "role", F.col("text").alias("content"), F.lit("English").alias("lang")
    )


def transcript_append(spark, d):
    """Each conversation's last question asked once more, and its answer."""
    transcript = _transcript(spark, d)
    last = Q.latest_questions(transcript, "conv_id")
    again = last.select("conv_id", F.lit(1).alias("offset"), "role", "content", "lang")
    answer = last.select(
        "conv_id", F.lit(2).alias("offset"), F.lit("assistant").alias("role"),
        Q.no_topic_answer(F.col("content")).alias("content"), "lang",
    )
    return Q.append_messages(transcript, again.unionByName(answer), "conv_id")


def transcript_start(spark, d):
    conversations = read_folder(spark, d, "conversations").select("conv_id").distinct()
    return Q.start_transcript(conversations, "conv_id", "Ask about the policies.")


def transcript_tagged(spark, d):
    """Messages as shown: answers in another language end with its name."""
    language = F.element_at(
        F.array(F.lit("English"), F.lit("Hindi"), F.lit(None)), (F.col("turn") % 3 + 1).cast("int")
    )
    return read_folder(spark, d, "conversations").select(
        "conv_id", "turn", Q.language_tag(F.col("text"), F.col("role"), language).alias("shown")
    )


def transcript_clear(spark, d):
    return Q.clear_transcript(_transcript(spark, d), "conv_id")


def query_source_query(spark, d):
    """The last turn of each conversation as pasted text; an assistant's counts as blank."""
    custom = F.when(F.col("role") == "assistant", " \t").otherwise(F.col("text"))
    pasted = (
        read_folder(spark, d, "conversations")
        .groupBy(F.col("conv_id").alias("item_id"))
        .agg(F.max_by(custom, "turn").alias("custom"))
    )
    return circulars(spark, d).join(pasted, "item_id", "left").select(
        "item_id", query_source(F.col("custom"), F.col("text")).alias("query_text")
    )


def respond_query(spark, d):
    return respond(chat_prompt(spark, d), "question_id", "prompt", responder(), batch_rows=16)


def _money_texts(spark, d):
    """Every order's price as amounts in words: with commas, without, and in crore."""
    price = F.format_number("o_totalprice", 2)
    return spread(read_folder(spark, d, "orders"), "o_orderkey").select(
        "o_orderkey",
        F.concat(
            F.lit("For years 2024, hours 12: Rs. "), price, F.lit(" or INR"),
            F.regexp_replace(price, ",", ""), F.lit(", at most ₹"), "o_custkey", F.lit(" crore, 1,000 papers."),
        ).alias("note"),
    )


def currency_amounts(spark, d):
    found = A.money_amounts(_money_texts(spark, d), "o_orderkey", "note")
    return found.withColumn("rupees", F.col("rupees").cast("double"))


def currency_normalized(spark, d):
    return _money_texts(spark, d).select(
        "o_orderkey", A.normalize_currency(F.col("note")).alias("note")
    )


def requirement_conflicts_query(spark, d):
    """Every part asks for what it states itself, but in days two sizes more for even keys."""
    parts = spread(read_folder(spark, d, "part"), "p_partkey")
    asked = F.col("p_size") + F.when(F.col("p_partkey") % 2 == 0, 2).otherwise(0)
    circular = parts.select(
        F.concat(F.lit("C"), "p_partkey").alias("circular"),
        F.concat(F.lit("Keep "), asked.cast("string"), F.lit(" days and "), "p_size", F.lit("% of it.")).alias("t"),
    )
    policy = parts.select(
        "p_partkey", F.concat(F.lit("Stored for "), "p_size", F.lit("-day terms, "), "p_size", F.lit(" % kept.")).alias("t")
    )
    matches = parts.select(F.concat(F.lit("C"), "p_partkey").alias("circular"), "p_partkey", F.lit(1).alias("rank"))
    found = A.requirement_conflicts(
        matches, "circular", "p_partkey",
        A.quantities(circular, "circular", "t"), A.quantities(policy, "p_partkey", "t"),
    )
    return found.withColumn("stated", F.array_join(F.col("stated").cast("array<string>"), ","))


def requirement_intervals(spark, d):
    """Parts ask for limits and ranges in one unit and state numbers in another."""
    parts = spread(read_folder(spark, d, "part"), "p_partkey")
    size, key = F.col("p_size"), F.col("p_partkey")
    asked = F.when(key % 3 == 0, F.concat(F.lit("Answer within "), size, F.lit(" days."))).when(
        key % 3 == 1, F.concat(F.lit("Keep records at least 1,000 hours."))
    ).otherwise(F.concat(size, F.lit(" to "), size + 10, F.lit(" months")))
    stated = F.when(key % 3 == 2, F.concat(size + 5 + key % 9, F.lit("-month term or 3 years"))).otherwise(
        F.concat(F.lit("Done in "), size * 20, F.lit(" hrs"))
    )
    circular = parts.select(F.concat(F.lit("C"), key).alias("circular"), asked.alias("t"))
    policy = parts.select("p_partkey", stated.alias("t"))
    matches = parts.select(F.concat(F.lit("C"), key).alias("circular"), "p_partkey", F.lit(1).alias("rank"))
    found = A.requirement_conflicts(
        matches, "circular", "p_partkey",
        A.quantities(circular, "circular", "t"), A.quantities(policy, "p_partkey", "t"),
    )
    return found.withColumn("stated", F.array_join(F.col("stated").cast("array<string>"), ","))


def sentence_pairs_query(spark, d):
    chunks = sentence_pairs(sentence_chunks(clean_text(F.col("policy_text"))))
    return chunk_rows(bronze_policies(spark, d), ["policy_id"], chunks, C.POLICY_TAG)


def directive_blocks_query(spark, d):
    """Blocks start at sentences that hold a cue word of one of the four languages."""
    sentences = sentence_chunks(clean_text(F.col("policy_text")))
    blocks = directive_blocks(sentences, CUES)
    return chunk_rows(bronze_policies(spark, d), ["policy_id"], blocks, C.POLICY_TAG)


def stream_silver(spark, d):
    """The documents file as a stream; what it appended, read back."""
    present = read_folder(spark, d, "documents")
    out, checkpoint = new_folder(spark, "stream"), new_folder(spark, "stream-state")

    def chunks(rows):
        text = sentence_chunks(clean_text(F.col("text")))
        return chunk_rows(rows, ["doc_id", "lang"], text, C.POLICY_TAG)

    rows = stream_files(spark, f"{d}/documents*.parquet", present.schema)
    rows = spread(rows.select("doc_id", "lang", "text"), "doc_id")
    append_stream(rows, chunks, out, checkpoint).awaitTermination()
    return spark.read.parquet(out)


def silver_incremental(spark, d):
    """Silver of older bronze rows (other texts, some missing, some since taken away), then brought up to date."""
    bronze, folder, key = bronze_policies(spark, d), new_folder(spark, "incremental"), F.col("policy_id").cast("long")
    older = F.when(key % 3 == 0, F.concat(F.lit("An older wording of it. "), "policy_text")).otherwise(F.col("policy_text"))
    gone = bronze.where(key % 7 == 2).withColumn("policy_id", F.concat(F.lit("gone-"), "policy_id"))
    refresh_silver(bronze.where(key % 5 != 1).withColumn("policy_text", older).unionByName(gone), folder)
    return refresh_silver(bronze, folder)


def gold_scored_later(spark, d):
    """A model learned from the documents of even id, in two batches, and kept; the others scored with it."""
    silver, folder, key = silver_table(spark, d), new_folder(spark, "gold-model"), F.col("policy_id").cast("long")
    for rest in (0, 2):
        learn_chunks(silver.where(key % 4 == rest), folder)
    scored = kept_model(spark, folder).transform(silver.where(key % 2 == 1))
    return vector_entries(scored, "tfidf_features", "chunk_id").withColumn("weight", F.round("weight", 6))


def respond_resumed(spark, d):
    """Half of the prompts answered by an earlier run, the rest by a later one; replies are kept."""
    prompts, folder = write_once("prompts", chat_prompt(spark, d)), new_folder(spark, "kept-replies")
    half = prompts.where(F.pmod(F.xxhash64("question_id"), F.lit(2)) == 0)
    respond_durably(half, "question_id", "prompt", responder(), folder, batch_rows=16)
    replies = respond_durably(prompts, "question_id", "prompt", responder(), folder, batch_rows=16, time_limit=60)
    return replies.select("question_id", "answer", "error")


def stream_matches(spark, d):
    """Circulars that arrive as files, each delivered twice, matched against an index kept in a folder."""
    docs, items, inbox = documents(spark, d), circulars(spark, d), new_folder(spark, "inbox")
    for _ in range(2):
        items.coalesce(1).write.mode("append").parquet(inbox)
    folder, out = new_folder(spark, "live-index"), new_folder(spark, "live-matches")
    save_index(docs, "doc_id", "text", folder, domain="lang")
    index = open_index(spark, folder, read_folder(spark, d, "documents"))
    arriving = stream_files(spark, inbox, items.schema, files_per_batch=1)
    match_stream(
        arriving, index, "item_id", "text", ["lang", "source"], out, new_folder(spark, "live-state")
    ).awaitTermination()
    return newest_matches(spark, out, "item_id").select(
        "item_id", "doc_id", "rank", "score", "bar_pct", "tier", "lang", "source"
    )


def topic_rules(spark, d):
    """Every document gives two rules, of two words and of one, for the topics of all questions."""
    docs, text = documents(spark, d), F.col("text")

    def rule(name, at, n):
        return docs.select(
            F.concat(F.lit("T"), "doc_id").alias("topic"), (F.col("doc_id") % 97).alias("priority"),
            F.lit(name).alias("alternative"), F.lower(F.substring(text, at, n)).alias("word"),
        )

    rules = rule("pair", 1, 4).unionByName(rule("pair", 12, 3)).unionByName(rule("one", 25, 6))
    return Q.topics_by_rules(questions(spark, d), "question_id", "question", rules)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_policies": bronze_policies,
    "bronze_circulars": bronze_circulars,
    "medallion_roundtrip": medallion_roundtrip,
    "kpi_summary": kpi_summary,
    "circular_labels": circular_labels,
    "silver_clean_text": silver_clean_text,
    "silver_clean_html": silver_clean_html,
    "chunk_fallback": chunk_fallback,
    "silver_policy_chunks": silver_policy_chunks,
    "silver_circular_chunks": silver_circular_chunks,
    "gold_tokens": gold_tokens,
    "gold_tokens_stopped": gold_tokens_stopped,
    "gold_tf_hashed": gold_tf_hashed,
    "gold_tfidf_ml": gold_tfidf_ml,
    "gold_idf": gold_idf,
    "gold_tfidf_exact": gold_tfidf_exact,
    "doc_tokens": doc_tokens_query,
    "doc_tokens_nostop": doc_tokens_nostop,
    "term_frequency": term_frequency_query,
    "doc_frequency": doc_frequency_query,
    "tfidf_index": tfidf_index,
    "index_reopened": index_reopened,
    "index_appended": index_appended,
    "index_updated": index_updated,
    "index_deleted": index_deleted,
    "doc_norms": doc_norms_query,
    "query_vectors": query_vectors_query,
    "query_vectors_binary": query_vectors_binary,
    "cosine_scores": cosine_scores_query,
    "cosine_scores_pruned": cosine_scores_pruned,
    "retrieve_topk": retrieve_topk,
    "retrieve_topk_pruned": retrieve_topk_pruned,
    "retrieve_topk_padded": retrieve_topk_padded,
    "retrieve_domain": retrieve_domain,
    "domain_idf": domain_idf,
    "match_bars": match_bars,
    "gap_matches": gap_matches_query,
    "gap_prompt": gap_prompt,
    "gap_prompt_short": gap_prompt_short,
    "gap_lookup": gap_lookup,
    "gap_matrix": gap_matrix,
    "gap_report_chain": gap_report_chain,
    "report_files": report_files,
    "gold_policies_table": gold_policies_table,
    "gold_circulars_table": gold_circulars_table,
    "currency_amounts": currency_amounts,
    "currency_normalized": currency_normalized,
    "requirement_conflicts": requirement_conflicts_query,
    "requirement_intervals": requirement_intervals,
    "chat_answered": chat_answered_query,
    "transcript_start": transcript_start,
    "transcript_tagged": transcript_tagged,
    "report_sections": report_sections,
    "gap_report_export": gap_report_export,
    "report_fallback": report_fallback,
    "query_source": query_source_query,
    "chat_context": chat_context,
    "chat_prompt": chat_prompt,
    "chat_intent": chat_intent,
    "chat_answers": chat_answers,
    "chat_sources": chat_sources,
    "transcript_append": transcript_append,
    "transcript_clear": transcript_clear,
    "respond": respond_query,
    "sentence_pairs": sentence_pairs_query,
    "directive_blocks": directive_blocks_query,
    "stream_silver": stream_silver,
    "silver_incremental": silver_incremental,
    "gold_scored_later": gold_scored_later,
    "respond_resumed": respond_resumed,
    "stream_matches": stream_matches,
    "topic_rules": topic_rules,
}
