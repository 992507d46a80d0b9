import hashlib

import pytest

import corpus_pipeline
from gapledger.llm.bpe import Codec
from test_neardup import brute_classes
from test_substrings import brute as brute_repeats
from test_tokens import check_packing


@pytest.fixture(scope="module")
def stages(spark, small):
    """What goes into each stage, and what the last one returns."""
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append(docs.toPandas())
        docs = spark.createDataFrame(stage(spark, docs, small).toPandas())
    return [*out, docs.toPandas()]


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "toxicity", "near_dedup", "substring_dedup", "packing"]
    for frame in stages[:-1]:
        assert list(frame.columns) == ["doc_id", "text", "lang", "source", "n_chars"]
    assert len(stages[1]) >= 0.99 * len(stages[0])
    assert len(stages[0]) > len(stages[2])


def test_toxic_documents_go_and_clean_ones_stay(spark, small, stages):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    before, after = set(stages[1].doc_id), set(stages[2].doc_id)
    clean = [d for d in before if labels.get(d) == 0]
    toxic = [d for d in before if labels.get(d) == 1]
    assert sum(d in after for d in clean) >= 0.97 * len(clean)
    assert sum(d in after for d in toxic) <= 0.4 * len(toxic)


def test_near_dedup_equals_brute_force(stages):
    docs = sorted(zip(stages[2].doc_id, stages[2].text))
    assert sorted(stages[3].doc_id) == sorted(set(brute_classes(docs).values()))


def test_substring_dedup_equals_brute_force(stages):
    expected = {r[0]: r for r in brute_repeats(list(zip(stages[3].doc_id, stages[3].text)))}
    assert sorted(stages[4].doc_id) == sorted(expected)
    for doc_id, text, n in zip(stages[4].doc_id, stages[4].text, stages[4].n_chars):
        kept = hashlib.sha256(b" ".join(text.encode().split())).hexdigest()
        assert kept == expected[doc_id][3] and n == len(text)


def test_packing_holds_every_token(stages, vocabulary):
    rows = list(stages[5].itertuples(index=False))
    check_packing(Codec(vocabulary), list(zip(stages[4].doc_id, stages[4].text)), rows, 4096)


def test_run(spark, small, stages):
    assert corpus_pipeline.run(spark, small).count() == len(stages[5])


def test_stages_take_empty_tables_and_other_columns(spark, small):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, label int, row int, n_words int")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        assert out.count() == 0
        if name != "packing":
            assert out.columns == docs.columns
