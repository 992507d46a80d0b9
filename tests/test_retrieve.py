import random

import pytest
from pyspark.sql import functions as F

import brute
from plan import explained
from gapledger.operators import index as I
from gapledger.operators import retrieve as R
from gapledger.operators.index import index_of_domains
from gapledger.operators.stored_index import (
    append_documents,
    merge_segments,
    open_index,
    save_index,
    segments,
    update_documents,
)

BLOCKS = R.Limits(words=60)
PRUNED = R.Limits(blocks=0)
SLICED = R.Limits(blocks=0, slice_rows=3)
RARE = [f"rare{i}" for i in range(60)]
TINY = {1: "alpha beta", 2: "alpha gamma"}


def make_index(spark, docs, **options):
    rows = [(d, t, "d%d" % (d % 3)) for d, t in docs.items()]
    corpus = spark.createDataFrame(rows, "doc_id long, text string, domain string")
    return I.build_index(corpus, "doc_id", "text", (random.random(),), **options)


def make_queries(spark, queries):
    return spark.createDataFrame(list(queries.items()), "query_id string, question string")


def run(index, queries, k, **options):
    rows = R.retrieve(index, queries, "query_id", "question", k, **options).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.doc_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    return found


def same(found, wanted):
    assert {q: [d for d, _ in hits] for q, hits in found.items()} == {
        q: [d for d, _ in hits] for q, hits in wanted.items()
    }
    for q, hits in wanted.items():
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in hits], abs=2e-9)


def skewed(n_docs, n_queries, seed):
    """Words of very different frequency; a third of the documents are copies."""
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(80)]
    weights = [1 / (i + 1) for i in range(80)]

    def text(longest):
        return " ".join(rng.choices(words, weights, k=rng.randint(0, longest)))

    docs = {i: text(40) for i in range(n_docs)}
    for i in range(0, n_docs, 3):
        docs[i] = "word0 word1 word0 word7"
    queries = {f"q{i:03}": text(12) for i in range(n_queries)}
    queries["unknown"] = "nothing known here"
    queries["hot"] = "word0"
    return docs, queries


def test_tiny_cases(spark):
    index = make_index(spark, TINY)
    weights = {(r.doc_id, r.term): r.weight for r in index.postings.collect()}
    assert weights[1, "alpha"] == 0
    assert weights[1, "beta"] == pytest.approx(0.346574, abs=1e-6)
    queries = {"a": "beta alpha", "b": "beta zeta", "c": "beta beta alpha", "d": "alpha", "e": ""}
    found = run(index, make_queries(spark, queries), 2)
    same(found, brute.top_k(TINY, queries, 2))
    assert found["a"][0] == (1, pytest.approx(0.707107, abs=1e-6))
    assert found["c"][0] == (1, pytest.approx(0.894427, abs=1e-6))
    assert found["d"] == found["e"] == [(1, 0.0), (2, 0.0)]
    binary = run(index, make_queries(spark, {"c": "beta beta alpha"}), 2, binary=True)
    assert binary["c"][0] == (1, pytest.approx(0.707107, abs=1e-6))
    assert set(run(index, make_queries(spark, queries), 2, pad=False)) == {"a", "b", "c"}


def test_one_document_scores_zero(spark):
    index = make_index(spark, {1: "alpha beta"})
    assert run(index, make_queries(spark, {"q": "beta"}), 3) == {"q": [(1, 0.0)]}


@pytest.mark.parametrize("binary", [False, True])
@pytest.mark.parametrize("limits", [R.LIMITS, BLOCKS, PRUNED, SLICED])
def test_all_ways_equal_brute_force(spark, limits, binary):
    docs, queries = skewed(120, 25, 3)
    index = make_index(spark, docs, hot_terms=20, shard_rows=7)
    found = run(index, make_queries(spark, queries), 5, binary=binary, limits=limits)
    same(found, brute.top_k(docs, queries, 5, binary))


def test_hot_terms_and_shards(spark):
    docs, _ = skewed(120, 1, 5)
    index = make_index(spark, docs, hot_terms=20, shard_rows=7)
    assert index.terms.where("shards > 1").count() > 0
    total = index.terms.agg(F.sum("df")).first()[0]
    hot = index.terms.where(F.col("df") * 20 >= total).count()
    assert 0 < hot <= 20 and index.terms.count() > hot
    wanted = {(d, t): w for d, ws in brute.index(docs).items() for t, w in ws.items()}
    got = {(r.doc_id, r.term): r.weight for r in index.postings.collect()}
    assert got.keys() == wanted.keys()
    assert all(got[k] == pytest.approx(w, abs=1e-12) for k, w in wanted.items())
    big = index.postings.where("unit > 0").groupBy("term", "shard", "level").count()
    assert big.agg(F.max("count")).first()[0] < 120 / 2


def test_a_word_in_all_queries_and_nearly_all_documents(spark):
    rng = random.Random(29)
    docs = {i: f"common {' '.join(rng.choices(RARE, k=rng.randint(1, 9)))}" for i in range(2_000)}
    docs[0] = "nothing shared"
    queries = {f"q{i:03}": f"common {rng.choice(RARE)}" for i in range(300)}
    index = make_index(spark, docs, hot_terms=20, shard_rows=100)
    limits = R.Limits(blocks=0, slice_rows=50)
    asked = make_queries(spark, queries)
    same(run(index, asked, 5, limits=limits), brute.top_k(docs, queries, 5))
    known = R.known_words(I.query_vectors(asked, "query_id", "question"), index)
    parts = R.sliced(known, "query_id", limits.slice_rows)
    on_queries = parts.words.where("term = 'common'").groupBy("slice").count().collect()
    assert len(on_queries) == 6 and max(r["count"] for r in on_queries) < 100
    hits = index.postings.where("unit > 0 AND term = 'common'")
    on_documents = hits.groupBy("shard", "cell").count().collect()
    assert max(r["count"] for r in on_documents) < 200
    copies = parts.copied(hits.select("term", "doc_id")).groupBy("doc_id").count().collect()
    assert len(copies) == 1_999 and {r["count"] for r in copies} == {6}


def test_bounds_hold_and_skip(spark):
    docs, queries = skewed(400, 20, 31)
    index = make_index(spark, docs, hot_terms=20, shard_rows=7)
    bounds = {(r.term, r.shard, r.cell): r for r in I.cell_bounds(index).collect()}
    counted = dict.fromkeys(bounds, 0)
    for r in index.postings.where("unit > 0").collect():
        at = bounds[r.term, r.shard, r.cell]
        counted[r.term, r.shard, r.cell] += 1
        assert r.unit <= at.top_unit and max(r.prefix**2 - r.unit**2, 0) ** 0.5 <= at.top_rest + 1e-12
    assert all(bounds[c].n_postings == n for c, n in counted.items())
    work = R.search_work(index, make_queries(spark, queries), "query_id", "question", 2, SLICED).collect()
    assert work and all(0 < r.cells_met <= r.cells and r.postings_met <= r.postings for r in work)
    assert sum(r.postings_met for r in work) < 0.9 * sum(r.postings for r in work)


@pytest.mark.parametrize("least", [1e-9, 0.3])
@pytest.mark.parametrize("limits", [R.LIMITS, BLOCKS, PRUNED, SLICED])
def test_scores_above_a_minimum(spark, least, limits):
    docs, queries = skewed(60, 10, 8)
    index = make_index(spark, docs, shard_rows=5)
    rows = R.cosine_scores(
        index, make_queries(spark, queries), "query_id", "question", least, limits=limits
    ).collect()
    wanted = {
        (q, d): s for q, hits in brute.top_k(docs, queries, 60).items() for d, s in hits
        if s > 0 and s >= least
    }
    assert {(r.query_id, r.doc_id): r.score for r in rows} == pytest.approx(wanted, abs=2e-9)
    assert all(0 <= r.score <= 1 for r in rows)


def test_copies_score_equally_and_row_order_does_not_matter(spark):
    docs, queries = skewed(45, 8, 11)
    shuffled = list(docs.items())
    random.Random(1).shuffle(shuffled)
    first = run(make_index(spark, docs), make_queries(spark, queries), 4)
    second = run(make_index(spark, dict(shuffled)), make_queries(spark, queries), 4)
    assert first == second
    assert first["hot"] == sorted(first["hot"], key=lambda h: (-h[1], h[0]))


def test_domains(spark):
    docs, queries = skewed(60, 6, 13)
    index = make_index(spark, docs)
    chosen = R.in_domains(index.corpus, "domain", ["d0", "d2"])
    assert R.in_domains(index.corpus, "domain", []) is index.corpus
    part = {d: t for d, t in docs.items() if d % 3 != 1}
    sub = I.build_index(chosen, "doc_id", "text", ("domains", random.random()))
    found = run(sub, make_queries(spark, queries), 3, binary=True)
    same(found, brute.top_k(part, queries, 3, binary=True))
    per_domain = I.domain_terms(index.corpus, "domain", "doc_id", "text")
    summed = per_domain.where("domain <> 'd1'").groupBy("term").agg(F.sum("df").alias("df"))
    assert {(r.term, r.df) for r in summed.collect()} == {
        (r.term, r.df) for r in sub.terms.collect()
    }


def test_no_pair_is_shuffled_in_place(spark):
    index = make_index(spark, TINY)
    queries = make_queries(spark, {"q": "beta"})
    vectors = I.query_vectors(queries, "query_id", "question")
    known = R.known_words(vectors, index)
    plan = explained(R.scored_in_place(known, index, "query_id"))
    assert "Bucketed: true" in plan and "Exchange hashpartitioning(query_id" not in plan


@pytest.mark.parametrize("limits", [R.LIMITS, PRUNED])
def test_tasks_pass_on_the_best_only(spark, limits):
    """However many pairs share a word, k rows per query and task leave it, and no pair is joined or shuffled before that."""
    docs = {i: f"common word{i % 7} word{i % 11}" for i in range(600)} | {600: "other"}
    queries = {f"q{i}": f"common word{i}" for i in range(5)}
    index, asked = make_index(spark, docs), make_queries(spark, queries)
    assert "hashpartitioning(query_id" not in explained(
        R.retrieve(index, asked, "query_id", "question", 2, pad=False, limits=limits)
    ).split("MapInArrow")[-1]
    known = R.known_words(I.query_vectors(asked, "query_id", "question"), index)
    best = R.scored_in_place(known, index, "query_id", k=2).groupBy("query_id").count().collect()
    assert {r.query_id for r in best} == set(queries) and all(r["count"] <= 2 * index.buckets for r in best)
    same(run(index, asked, 2, limits=limits), brute.top_k(docs, queries, 2))


def test_documents_and_queries_that_come_twice(spark):
    """The rows of one id are one document or one query."""
    rows = [(i % 40, f"word{i % 7} word{i % 5} word{i % 3}") for i in range(120)] + [(7, "word1 word2")] * 2
    corpus = spark.createDataFrame(rows, "doc_id long, text string")
    index = I.build_index(corpus, "doc_id", "text", (random.random(),))
    asked = spark.createDataFrame([("a", "word1 word2"), ("a", "word1"), ("b", "word4")], "query_id string, question string")
    pairs = R.scored_in_place(R.known_words(I.query_vectors(asked, "query_id", "question"), index), index, "query_id")
    wanted = R.best_k(pairs, "query_id", "doc_id", 3).collect()
    found = R.retrieve(index, asked, "query_id", "question", 3, pad=False).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, wanted))
    units = {(r.term, r.doc_id): r.u for r in index.postings.groupBy("term", "doc_id").agg(F.sum("unit").alias("u")).collect()}
    words = R.known_words(I.query_vectors(asked, "query_id", "question"), index).collect()
    for r in pairs.collect():
        total = sum(w.query_unit * units.get((w.term, r.doc_id), 0) for w in words if w.query_id == r.query_id)
        assert r.score == pytest.approx(total, abs=2e-9)


def test_postings_are_sorted_once_in_buckets_of_bounded_size(spark):
    index = make_index(spark, TINY)
    rows = I.unit_postings(I.weigh(index.counts, index.terms), "doc_id", 3)
    plan = explained(rows)
    assert plan.count("- Window [") == 1
    # counts are kept beside the postings, not in them
    assert not {"n_term", "n_tokens", "norm"} & set(index.postings.columns)
    many = spark.createDataFrame([("a", 20_000_000), ("b", 30_000_000)], "term string, df long")
    assert I.bucket_count(many) >= 50


def test_postings_are_written_with_few_numbers_of_their_own(spark):
    """Weights are read from counts, and from what is equal for a document or a term."""
    docs, _ = skewed(60, 10, 3)
    index = make_index(spark, docs, shard_rows=5)
    written = spark.read.parquet(*index.postings.inputFiles())
    assert {f.name for f in written.schema if f.dataType.simpleString() == "double"} == {"idf", "norm"}
    for r in index.postings.where("unit > 0").withColumn("rest", I.rest_of(F.col("prefix"), F.col("unit"))).collect():
        assert 0 < r.unit <= r.prefix <= 1 and 0 <= r.level <= I.LEVELS and r.rest < 1
    norms = index.postings.groupBy("doc_id").agg(F.max("prefix").alias("top"), F.sum(F.col("unit") * F.col("unit")).alias("all"))
    assert all(r.top == pytest.approx(1, abs=1e-6) and r["all"] == pytest.approx(1) for r in norms.where("top > 0").collect())
    rows = I.unit_postings(I.weigh(index.counts, index.terms), "doc_id", 3, n_docs=F.lit(60))
    shuffled = explained(rows).split("REPARTITION_BY_NUM")[1].split("Project [")[1].split("]")[0]
    assert not any(c in shuffled for c in ("weight", "tf", "idf", "domain"))


def test_blocks_follow_words_and_steps(spark):
    docs, queries = skewed(60, 10, 17)
    index = make_index(spark, docs)
    vectors = I.query_vectors(make_queries(spark, queries), "query_id", "question")
    known = R.known_words(vectors, index)
    words, steps = known.agg(F.count("*"), F.sum("df")).first()
    assert R.blocks_needed(R.survey(known), index, R.LIMITS) == 1
    assert R.blocks_needed(R.survey(known), index, R.Limits(words=words - 1)) == 2
    per_task = -(-steps // (3 * index.buckets))
    assert R.blocks_needed(R.survey(known), index, R.Limits(steps=per_task)) == 3
    parts = R.query_blocks(known, "query_id", 3)
    ids = [{r.query_id for r in part.select("query_id").distinct().collect()} for part in parts]
    assert sum(map(len, ids)) == len(set().union(*ids))
    assert sum(part.count() for part in parts) == words


def test_index_is_written_once(spark):
    from gapledger.sources.shared import forget

    corpus = spark.createDataFrame(list(TINY.items()), "doc_id long, text string")
    first = I.build_index(corpus, "doc_id", "text", ("once",)).postings.inputFiles()
    assert I.build_index(corpus, "doc_id", "text", ("once",)).postings.inputFiles() == first
    forget("once")
    assert I.build_index(corpus, "doc_id", "text", ("once",)).postings.inputFiles() != first


def test_query_source_and_records(spark):
    df = spark.createDataFrame(
        [(1, "pasted", "own"), (2, "  \n", "own"), (3, None, "own")], "i int, c string, t string"
    )
    got = df.select("i", R.query_source(F.col("c"), F.col("t")).alias("q")).orderBy("i").collect()
    assert [r.q for r in got] == ["pasted", "own", "own"]
    hits = spark.createDataFrame([("q", 1), ("q", 9)], "query_id string, doc_id long")
    records = spark.createDataFrame([(1, "S1")], "doc_id long, section string")
    assert R.with_records(hits, records, "doc_id", ["section"]).count() == 1


def test_scores_need_a_minimum(spark):
    index = make_index(spark, {1: "alpha beta"})
    with pytest.raises(ValueError):
        R.cosine_scores(index, make_queries(spark, {1: "alpha"}), "query_id", "question", 0)


def test_domain_index_reads_no_text(spark, small):
    from checks.queries import document_index

    index = document_index(spark, small, ["de", "es"])
    for table in (index.terms, index.postings, index.counts):
        assert "text" not in explained(table)
    with pytest.raises(ValueError):
        index_of_domains(make_index(spark, {1: "alpha"}), ["x"], ("no domain",))


def best_hits(index, asked):
    return {
        (r.query_id, r["rank"]): (r.doc_id, r.score)
        for r in R.retrieve(index, asked, "query_id", "question", 5).collect()
    }


def test_saved_index_follows_its_documents(spark, tmp_path):
    docs, queries = skewed(40, 6, 4)
    rows = [(d, t, "d%d" % (d % 3)) for d, t in docs.items()]
    corpus = spark.createDataFrame(rows, "doc_id long, text string, domain string")
    asked, folder = make_queries(spark, queries), str(tmp_path / "index")
    first, second = corpus.where("doc_id % 3 = 0"), corpus.where("doc_id % 3 <> 0")
    save_index(first, "doc_id", "text", folder)
    whole = spark.read.parquet(f"{folder}/segments/*/counts").count()
    open_index(spark, folder, first)
    append_documents(spark, folder, second)
    index = open_index(spark, folder, corpus)
    once = I.build_index(corpus, "doc_id", "text", (random.random(),))
    assert best_hits(index, asked) == best_hits(once, asked)
    assert "Bucketed: true" in explained(index.postings.groupBy("doc_id").count())
    # what was written is in proportion to what came: the new rows' postings and nothing else
    old, new = segments(spark, folder)
    assert spark.read.parquet(f"{folder}/segments/{old}/counts").count() == whole
    assert spark.read.parquet(f"{folder}/segments/{new}/counts").count() == once.counts.join(second, "doc_id", "left_semi").count()
    with pytest.raises(ValueError, match="other documents"):
        open_index(spark, folder, first)
    with pytest.raises(ValueError, match="already"):
        append_documents(spark, folder, second.limit(1))
    # replaced, taken out, brought back, and folded
    changed = corpus.where("doc_id % 5 = 0").withColumn("text", F.lit("w1 w2 altogether new words"))
    update_documents(spark, folder, changed, corpus.where("doc_id % 5 = 1"))
    update_documents(spark, folder, removed=corpus.where("doc_id = 10"))
    update_documents(spark, folder, corpus.where("doc_id IN (10, 11)"))
    update_documents(spark, folder)
    now = corpus.where("doc_id % 5 > 1").union(changed.where("doc_id <> 10")).union(corpus.where("doc_id IN (10, 11)"))
    expected = best_hits(I.build_index(now, "doc_id", "text", (random.random(),)), asked)
    assert len(segments(spark, folder)) == 5
    assert best_hits(open_index(spark, folder, now), asked) == expected
    merge_segments(spark, folder)
    assert len(segments(spark, folder)) == 1
    assert best_hits(open_index(spark, folder, now), asked) == expected


def test_a_change_that_fails_leaves_the_version_before(spark, tmp_path):
    folder = str(tmp_path / "index")
    corpus = spark.createDataFrame(list(TINY.items()), "doc_id long, text string")
    save_index(corpus, "doc_id", "text", folder)
    broken = corpus.withColumn("text", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        update_documents(spark, folder, broken)
    assert len(segments(spark, folder)) == 1
    assert open_index(spark, folder, corpus).terms.count() == 3


def rows_read(df):
    """Rows that the scans of a collected DataFrame handed on."""
    plan, total, todo = df._jdf.queryExecution().executedPlan(), 0, []
    todo.append(plan)
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if name.startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        if "QueryStage" in name:
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_one_question_skips_most_pages(spark, tmp_path):
    """The scan is bounded by the words' hashes; pages without them are not read, and nothing is lost."""
    r = random.Random(3)
    docs = {d: " ".join(f"word{r.randrange(20_000)}" for _ in range(120)) for d in range(2_000)}
    index = make_index(spark, docs)
    total = index.postings.count()
    asked = make_queries(spark, {"q": "word17 word400 word9000 word12345"})
    known = R.known_words(I.query_vectors(asked, "query_id", "question"), index)
    found = R.survey(known)
    assert found.words == 4 and len(found.ranges) == 4
    few = R.narrowed(index, found.ranges).postings
    assert "PushedFilters: [" in explained(few) and "term_hash" in explained(few).split("PushedFilters")[1]
    few.collect()
    assert 0 < rows_read(few) < total / 3
    best = R.retrieve(index, asked, "query_id", "question", 3, pad=False).collect()
    brute = R.best_k(R.scored_in_place(known, index, "query_id"), "query_id", "doc_id", 3).collect()
    assert sorted(map(tuple, best)) == sorted(tuple(x[c] for c in ("query_id", "doc_id", "score", "rank")) for x in brute)


def test_ranges_keep_the_widest_gaps_open():
    r = random.Random(1)
    for n in (0, 1, 5, 64, 65, 900):
        points = [(p, p) for p in (r.randrange(-(2**63), 2**63) for _ in range(n))]
        ranges = R.widest_apart(points)
        assert len(ranges) == min(n, R.RANGES)
        assert all(any(a <= p <= b for a, b in ranges) for p, _ in points)
        assert all(x[1] < y[0] for x, y in zip(ranges, ranges[1:]))
    assert R.widest_apart([(0, 1), (5, 6), (100, 120)], 2) == [(0, 6), (100, 120)]
