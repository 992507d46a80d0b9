"""Tables, models, replies and matches that are kept between runs."""

import random
import time
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gapledger.operators import chat as Q
from gapledger.operators.gold import fit_gold, gold_vectors, kept_model, learn_chunks
from gapledger.operators.index import build_index
from gapledger.operators.respond import known_replies, respond_durably
from gapledger.operators.silver import silver_policies
from gapledger.plans import incremental as I
from gapledger.sources import bronze as B
from gapledger.sources.shared import new_folder, write_once
from gapledger.sources.tables import create_database, save_table
from gapledger.streaming.live_matches import match_stream, newest_matches
from gapledger.streaming.silver_stream import stream_files


@pytest.fixture()
def database(spark):
    folder = new_folder(spark, "kept-test")
    return create_database(spark, "kept_" + folder[-8:], folder)


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_failed_overwrite_leaves_the_old_rows(spark, database):
    name = f"{database}.t"
    save_table(spark.range(5), name)
    bad = spark.range(100).repartition(4).select(
        F.when(F.col("id") == 70, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id")
    )
    with pytest.raises(Exception, match="no"):
        save_table(bad, name)
    assert ids(spark.table(name)) == [0, 1, 2, 3, 4]
    reader = spark.table(name)
    # made from itself, with other columns, while a reader holds the old rows
    after = save_table(spark.table(name).withColumn("more", F.lit("x")).where("id > 2"), name)
    assert after.columns == ["id", "more"] and ids(after) == [3, 4] and ids(reader) == [0, 1, 2, 3, 4]


def test_old_versions_go(spark, database):
    name = f"{database}.t"
    spark.range(9).write.saveAsTable(name)  # a plain table
    for n in (1, 2, 3):
        save_table(spark.range(n), name)
        save_table(spark.range(7), f"{database}.t__v_other")
    assert ids(spark.table(name)) == [0, 1, 2] and spark.table(f"{database}.t__v_other").count() == 7
    tables = [r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()]
    assert sum(t.startswith("t__v0") for t in tables) == 2


def policies(spark, rows):
    full = [(i, "Lending", "S", "T", text, None, None, "ACTIVE", uuid.uuid4().hex) for i, text in rows]
    return B.rows_to_bronze(spark, full, B.POLICY_SCHEMA)


def text(i, version=0):
    return f"Policy {i} asks for a review now. Version {version} needs a signature."


def test_refresh_writes_what_changed(spark):
    folder, n = new_folder(spark, "refresh"), 30
    rows = {str(i): text(i) for i in range(n)}

    def run():
        bronze = policies(spark, [*rows.items(), (None, rows.get("3", "")), ("0", rows["0"])])
        got = I.refresh_silver(bronze, folder)
        wanted = silver_policies(bronze.drop("ingested_at"))
        assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))
        return bronze

    run()
    run()  # rows at other times of ingestion are the same rows
    assert [(r.changed, r.gone) for r in I.runs(spark, folder)] == [(n + 1, 0)]
    rows |= {"4": text(4, 1), "5": text(5, 1), "new": text(99)}
    del rows["7"]
    run()
    last = I.runs(spark, folder)[-1]
    assert (last.changed, last.gone) == (3, 1)
    assert spark.read.parquet(f"{last.path}/rows").select("policy_id").distinct().count() == 3
    rows["7"] = text(7)  # comes back
    rows["3"] = text(3, 2)  # and with it the row without a key
    bronze = run()
    assert [(r.changed, r.gone) for r in I.runs(spark, folder)][-1] == (3, 0)

    def fails(changed):
        return silver_policies(changed).withColumn("title", F.raise_error(F.lit("stopped")).cast("string"))

    bronze = policies(spark, [("only", text(1))]).drop("ingested_at")
    before = I.derived(spark, folder, "policy_id").count()
    with pytest.raises(Exception, match="stopped"):
        I.refresh(bronze, "policy_id", fails, folder)
    assert I.derived(spark, folder, "policy_id").count() == before
    merged = new_folder(spark, "merged")
    I.merge_runs(spark, folder, "policy_id", merged)
    assert I.derived(spark, merged, "policy_id").count() == before
    assert I.refresh_silver(policies(spark, []), merged).count() == 0
    assert I.runs(spark, merged)[-1].gone == n + 2


def test_refresh_of_nothing(spark):
    folder = new_folder(spark, "refresh")
    assert I.refresh_silver(policies(spark, []), folder).count() == 0
    assert I.refresh_silver(policies(spark, [("1", text(1))]), folder).count() == 2
    with pytest.raises(ValueError):
        I.derived(spark, new_folder(spark, "none"), "policy_id")


def test_kept_model_equals_a_fitted_one(spark):
    silver = silver_policies(policies(spark, [(str(i), text(i, i % 3)) for i in range(20)])).cache()
    half, later = silver.where("cast(policy_id as int) < 12"), silver.where("cast(policy_id as int) >= 12")
    folder = new_folder(spark, "model")
    for low, high in ((0, 5), (5, 12)):
        learn_chunks(silver.where(f"cast(policy_id as int) >= {low} AND cast(policy_id as int) < {high}"), folder, 512)
    columns = ["chunk_id", "tfidf_features"]

    def vectors(model):
        return {r[0]: [round(x, 9) for x in r[1].toArray()] for r in gold_vectors(model, later, columns).collect()}

    assert vectors(kept_model(spark, folder)) == vectors(fit_gold(half, 512))
    gold = new_folder(spark, "gold")
    model = kept_model(spark, folder)
    I.refresh_gold(silver.where("policy_id <> '3'"), model, gold)
    assert I.refresh_gold(silver, model, gold).count() == silver.count()
    assert [r.changed for r in I.runs(spark, gold)] == [19, 1]
    learn_chunks(half, folder, 256)
    with pytest.raises(ValueError, match="different numbers"):
        kept_model(spark, folder)


def test_replies_are_kept(spark, tmp_path):
    folder, log = new_folder(spark, "replies"), tmp_path / "calls"
    log.mkdir()
    broken = tmp_path / "broken"
    broken.touch()

    def reply(batch):
        if broken.exists() and any("7" in p for p in batch):
            raise ValueError("sevens")
        for p in batch:
            (log / f"{p}-{uuid.uuid4().hex}").touch()
        return batch.str.upper()

    rows = [(i, f"p{i % 40}") for i in range(60)] + [(60, None), (61, "")]
    prompts = spark.createDataFrame(rows, "id long, prompt string")

    def run(some):
        return respond_durably(some, "id", "prompt", reply, folder, batch_rows=8, commit_rows=10)

    first = run(prompts.where("id < 20"))
    assert {r.id for r in first.collect() if r.error == "sevens"} == {7, 17}
    assert all(r.seconds >= 0 for r in first.collect())
    broken.unlink()
    everything = {r.id: (r.answer, r.error) for r in run(prompts).collect()}
    assert everything == {i: ((p or "").upper(), None) for i, p in rows}
    # the first run's answers were not asked for again, equal prompts once, failed ones again
    assert len(list(log.iterdir())) == 41
    run(prompts)
    assert len(list(log.iterdir())) == 41
    assert known_replies(spark, folder).where("error IS NOT NULL").count() == 0
    assert run(prompts.limit(0)).count() == 0


def test_interrupted_run_repeats_little(spark, tmp_path):
    folder, log, stop = new_folder(spark, "replies"), tmp_path / "calls", tmp_path / "stop"
    log.mkdir()
    stop.touch()

    def reply(batch):
        for p in batch:
            (log / f"{p}-{uuid.uuid4().hex}").touch()
        if stop.exists() and len(list(log.iterdir())) > 25:
            return []  # the wrong number of answers ends the job
        return batch

    prompts = spark.createDataFrame([(i, f"p{i}") for i in range(60)], "id long, prompt string").coalesce(1)
    args = ("id", "prompt", reply, folder)
    with pytest.raises(Exception, match="answers to"):
        respond_durably(prompts, *args, batch_rows=4, commit_rows=10)
    kept = known_replies(spark, folder).count()
    assert 0 < kept < 60
    stop.unlink()
    before = len(list(log.iterdir()))
    assert respond_durably(prompts, *args, commit_rows=10).where("answer IS NULL").count() == 0
    assert len(list(log.iterdir())) - before == 60 - kept


def test_a_call_may_take_so_long(spark):
    def reply(batch):
        if any(p == "slow" for p in batch):
            time.sleep(30)
        return batch

    prompts = spark.createDataFrame([(1, "a"), (2, "slow"), (3, "b")], "id long, prompt string").coalesce(1)
    done = respond_durably(prompts, "id", "prompt", reply, new_folder(spark, "replies"), time_limit=0.5)
    rows = {r.id: r for r in done.collect()}
    assert (rows[1].answer, rows[3].answer) == ("a", "b")
    assert rows[2].answer is None and rows[2].error == "no answer within 0.5 s" and rows[2].seconds < 5


def test_matches_of_a_stream(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"loans number{i} review deposit{i % 3}", "d") for i in range(12)], "doc_id long, text string, lang string")
    index = build_index(docs, "doc_id", "text", ("live", uuid.uuid4().hex))
    inbox, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = "item_id long, text string, stamp timestamp"

    def deliver(*rows):
        df = spark.createDataFrame(rows, "item_id long, text string").withColumn("stamp", F.current_timestamp())
        df.coalesce(1).write.mode("append").parquet(inbox)

    def run(**more):
        rows = stream_files(spark, inbox, spark.createDataFrame([], schema).schema, files_per_batch=1)
        match_stream(rows, index, "item_id", "text", ["lang"], out, state, k=2, **more).awaitTermination()
        best = newest_matches(spark, out, "item_id").where("rank = 1").collect()
        return {r.item_id: r.doc_id for r in best}

    deliver((1, "number3 loans"), (2, "number5"))
    deliver((1, "number3 loans"), (3, "number7"))
    assert run() == {1: 3, 2: 5, 3: 7}
    written = spark.read.parquet(out).count()
    assert written == 6  # the circular that came twice was matched once
    assert run() == {1: 3, 2: 5, 3: 7} and spark.read.parquet(out).count() == written
    deliver((2, "number8"), (3, "number7"), (4, None))
    assert run() == {1: 3, 2: 8, 3: 7, 4: 0}
    assert len(list(Path(out).iterdir())) >= 3


def test_stream_state_with_a_watermark(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"loans number{i}") for i in range(5)], "doc_id long, text string")
    index = build_index(docs, "doc_id", "text", ("live", uuid.uuid4().hex))
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    for _ in range(2):
        spark.createDataFrame([(1, "number3")], "item_id long, text string").withColumn(
            "stamp", F.to_timestamp(F.lit("2024-01-01"))
        ).write.mode("append").parquet(inbox)
    rows = stream_files(spark, inbox, spark.read.parquet(inbox).schema)
    match_stream(rows, index, "item_id", "text", [], out, str(tmp_path / "s"), k=1, arrival="stamp").awaitTermination()
    assert [(r.item_id, r.doc_id) for r in spark.read.parquet(out).collect()] == [(1, 3)]


@pytest.mark.parametrize("broadcast_words", [1_000_000, 0])
def test_many_rules(spark, broadcast_words):
    r = random.Random(2)
    letters = "abcdé 😀"

    def word(low, high):
        return "".join(r.choice(letters) for _ in range(r.randint(low, high)))

    rules = [(f"t{r.randint(0, 400)}", r.randint(0, 50), f"a{i // 2}", word(0, 6)) for i in range(10_000)]
    asked = [(i, word(0, 30).upper() if i % 2 else word(0, 30)) for i in range(40)] + [(40, None), (41, "")]
    sets = {}
    for topic, priority, alternative, w in rules:
        if w:
            sets.setdefault((priority, topic, alternative), set()).add(w)
    wanted = {}
    for i, q in asked:
        hits = [(p, t) for (p, t, _), words in sets.items() if q is not None and all(w in q.lower() for w in words)]
        wanted[i] = min(hits)[1] if hits else None
    df = spark.createDataFrame(rules, "topic string, priority int, alternative string, word string")
    questions = spark.createDataFrame(asked, "id long, question string")
    found = Q.topics_by_rules(questions, "id", "question", df, broadcast_words)
    assert {x.id: x.topic for x in found.collect()} == wanted
    assert 5 < len(set(wanted.values())) and None in wanted.values()
    none = Q.topics_by_rules(questions, "id", "question", df.limit(0), broadcast_words)
    assert {x.topic for x in none.collect()} == {None} and none.count() == len(asked)


def test_rules_that_share_a_word_meet_few_questions(spark, monkeypatch):
    """Equal sets are one, and later sets of a word are not looked at by questions that have an earlier one."""
    from gapledger.operators import chat

    written = {}

    def counted(name, df):
        written.setdefault(name, []).append(write_once(name, df))
        return written[name][-1]

    monkeypatch.setattr(chat, "write_once", counted)
    rules = [(f"t{i:04}", i, "a", w) for i in range(600) for w in ("the", f"w{i % 300:03}")]
    asked = [(i, f"the {i} the w{i % 3:03} w299") for i in range(90)] + [(90, "the")]
    found = Q.topics_by_rules(
        spark.createDataFrame(asked, "id long, question string"), "id", "question",
        spark.createDataFrame(rules, "topic string, priority int, alternative string, word string"),
    )
    assert {r.id: r.topic for r in found.collect()} == {i: f"t{i % 3:04}" for i in range(90)} | {90: None}
    assert written["rule-sets"][0].count() == 300
    assert written["sought-sets"][0].where("word = 'the'").count() <= 1
