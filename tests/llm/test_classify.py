import numpy as np
import pytest

from gapledger.llm import langid, toxicity
from gapledger.llm.queries import QUERIES
from gapledger.llm.toxicity import KINDS, MOVES, STATES, ToxicityModel, compose, insult, negation, target

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op4_language"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    held = [r for r in rows if r.held_out]
    assert np.mean([docs[r.doc_id].lang == r.lang_pred for r in held]) >= 0.98
    assert np.mean([r.accepted for r in rows]) >= 0.99
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit(spark.read.parquet(f"{SF}/documents.parquet"), max_rows=600)


def test_language_of_odd_texts(spark, model):
    rows = [(1, None), (2, ""), (3, "123 !?\n"), (4, "The of and that is with"), (4, "The of and that is with"), (None, "der die und ist"),
            (5, "x" * 200_000), (6, "\U0001f600"), (7, "Привет мир это другое письмо, совсем другое")]
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, lang_pred string, score double")
    out = langid.identify(df, model)
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r)
    for doc_id in (1, 2, 3, 6):
        assert [(r.lang_pred, r.score, r.accepted) for r in got[doc_id]] == [("und", 0.0, False)]
    assert [r.lang_pred for r in got[4]] == ["en", "en"] and got[None][0].lang_pred == "de"
    assert not got[7][0].accepted
    assert langid.keep_accepted(df, model).columns == df.columns
    assert langid.identify(df.limit(0), model).count() == 0


def test_language_without_labels(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, "12", None)], "doc_id long, text string, lang string")
    found = {r.doc_id: (r.lang_pred, r.accepted) for r in langid.identify_held_out(df).collect()}
    assert found == {1: ("und", True), 2: ("und", False)}


def test_sums_do_not_depend_on_blocks(model, monkeypatch):
    texts = ["the of and", "", "der die das", "x", "la que de los"] * 40
    whole = model.totals(texts)
    monkeypatch.setattr(langid, "BLOCK", 17)
    for a, b in zip(whole, model.totals(texts)):
        assert np.allclose(a, b)


def test_grammar():
    states, moves = compose(insult, target, negation)
    assert len(states) == 4 * 2 * 3 and len(moves) == len(states)

    def kind(symbols):
        s = 0
        for a in symbols:
            s = MOVES[s][a]
        return dict(zip(("strong", "middling", "weak", "directed", "threat", "negated", "reported"), KINDS[s]))

    assert kind("oyi") == {"strong": 1, "middling": 0, "weak": 0, "directed": 1, "threat": 0, "negated": 0, "reported": 0}
    assert kind("yni")["negated"] == 1 and kind("yin")["negated"] == 0
    assert kind("royki")["reported"] == 1 and kind("royki")["strong"] == 1 and kind("royki")["weak"] == 0
    assert kind("ty")["threat"] == 1 and kind("t")["threat"] == 0
    assert not any(kind("oynr").values()) and len(STATES) == len(KINDS)


def test_clauses_are_scored():
    m = ToxicityModel({"idiot": "i", "lowe*": "j"})
    plain, direct, negated, two = m.scores(["an idea, idiot", "you idiot!", "you are not an idiot", "idiot. idiot. LOWEfoo!"], m.memory())
    assert direct > plain > 0.5 and negated < direct and two > plain
    assert m.scores(["nothing. here"], m.memory())[0] < 0.1


def test_toxicity_held_out(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES["op6_toxicity"](spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    toxic = [p for y, p in held if y == 1]
    assert np.mean(toxic) >= 0.8
    assert np.mean([p for y, p in held if y == 0]) <= 0.03


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 9), (2, "", 9), (None, "text", 9), (2, "", 9)], "doc_id long, text string, label int")
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, 5)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == 4 and all(r.predicted == 0 for r in rows)
    assert toxicity.keep_clean(docs, model).columns == docs.columns
    assert toxicity.score_held_out(docs.limit(0), labels).count() == 0
    assert toxicity.score_held_out(docs, labels.limit(0)).count() == 4


def test_copies_do_not_make_a_term(spark):
    rows = [(1, "bad words zzqq here again")] * 500 + [(0, "plain words here again"), (0, "other words")] * 50
    assert "zzqq" not in toxicity.learn_terms(spark.createDataFrame(rows, "label int, text string"))
    rows = [(1, f"a{i} zzqq b{i}") for i in range(300)] + [(0, f"a{i} c{i} b{i}") for i in range(300)]
    found = toxicity.learn_terms(spark.createDataFrame(rows, "label int, text string"))
    assert "zzqq" in found
