"""The pipeline against a brute-force version of its stages, on a small folder of tables."""

import os
import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from odsflow.llm import classifier, mixing, packed
from odsflow.llm.common import LEAN, forget, lean_workers, small_table
from odsflow.llm.tokens import Remembered

from .conftest import SCHEMA, bag, prose
from .test_classifier import junk
from .test_contamination import brute as brute_contamination
from .test_mixing import brute_targets
from .test_packed import expected_ids
from .test_simhash import brute_groups


def small_corpus(rows):
    good = [(i, prose(1000 + i, 55), "en", f"s{i % 4}") for i in range(200, 260)]
    bad = [(300 + i, junk(i, 60), "en", f"s{i % 4}") for i in range(20)]
    return rows + good + bad


@pytest.fixture(scope="module")
def tables(spark, rows, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    corpus = small_corpus(rows)
    made = [(i, t, lang, s, None, "r", "b", "z", "p") for i, t, lang, s in corpus]
    spark.createDataFrame(made, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i < 300), 0) for i, *_ in corpus if i is not None and i >= 200 and i % 3]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, prose(1210, 55)), (2, prose(100, 70)), (3, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, corpus, items


def stage_rows(spark, tables, corpus, number):
    name, stage = corpus_pipeline.STAGES[number]
    docs = spark.createDataFrame([(i, t, lang, s, None, "r", "b", "z", "p") for i, t, lang, s in corpus], SCHEMA)
    return stage(spark, docs, tables[0])


def as_rows(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect()]


def brute_quality(spark, tables, corpus):
    docs = spark.createDataFrame([(i, t) for i, t, *_ in corpus], "doc_id long, text string")
    model = classifier.train(docs, spark.read.parquet(f"{tables[0]}/labels.parquet"))
    weight = Remembered(lambda w: float(model.weights[list(classifier.places(w))].sum()))
    scores = model.scores(pa.array([r[1] or "" for r in corpus], pa.string()), weight)
    return [r for r, score in zip(corpus, scores) if score >= 0.3]


def brute_near(corpus):
    groups, seen, kept = brute_groups(corpus), set(), []
    for row, (doc_id, print_, component) in sorted(zip(corpus, groups), key=lambda x: repr(x[0])):
        mark = component if component is not None else print_
        if (component is None or doc_id == component) and mark not in seen:
            seen.add(mark)
            kept.append(row)
    return kept


def brute_clean(corpus, items):
    return [row for row, found in zip(corpus, brute_contamination(corpus, items)) if found[2] == 0]


def mixed_words(rows):
    words = {}
    for _, text, _, source in rows:
        words[source] = words.get(source, 0) + len((text or "").encode().split())
    return words


def test_each_stage(spark, tables):
    folder, corpus, items = tables
    first = as_rows(stage_rows(spark, tables, corpus, 0))
    assert bag(first) == bag(brute_quality(spark, tables, corpus))
    assert not any(i is not None and i >= 300 for i, *_ in first) and {i for i, *_ in first} >= set(range(200, 260))
    second = as_rows(stage_rows(spark, tables, first, 1))
    assert bag(r[:1] for r in second) == bag(r[:1] for r in brute_near(first))
    third = as_rows(stage_rows(spark, tables, second, 2))
    assert bag(third) == bag(brute_clean(second, items))
    fourth = as_rows(stage_rows(spark, tables, third, 3))
    before, after = mixed_words(third), mixed_words(fourth)
    names = sorted(before, key=lambda s: (s is None, s or ""))
    targets = brute_targets([before[n] for n in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5 * sum(before.values()), 2)
    longest = max(len((t or "").split()) for _, t, *_ in third)
    assert all(abs(after.get(n, 0) - t) <= longest / 2 + 1 for n, t in zip(names, targets))
    assert set(fourth) <= set(third) and max(fourth.count(r) for r in set(fourth)) <= 2
    fifth = stage_rows(spark, tables, fourth, 4).collect()
    expected = [(i, s, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, s, ids in expected_ids(fourth)]
    assert sorted((tuple(r) for r in fifth), key=lambda r: r[1]) == expected


def test_the_whole_run(spark, tables):
    got = corpus_pipeline.run(spark, tables[0])
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    ids = {r["doc_id"] for r in got.collect()}
    assert ids & set(range(200, 260)) and not ids & {20, 210, 300, 40}


@pytest.mark.parametrize("number", range(5))
def test_stages_pass_empty_tables_on(spark, tables, number):
    got = stage_rows(spark, tables, [], number)
    assert got.collect() == []
    if number < 4:
        assert len(got.columns) == 9


def test_sources_beyond_the_bound_are_refused(spark, tables, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_PATTERNS", 1)
    with pytest.raises(ValueError):
        stage_rows(spark, tables, tables[1], 3)


def test_stages_give_their_python_workers_lean_settings(spark):
    def seen(session):
        return session.range(2).repartition(2).mapInArrow(
            lambda batches: (pa.RecordBatch.from_arrays([pa.array([",".join(f"{k}={os.environ.get(k)}" for k in LEAN)])], names=["x"]) for _ in batches), "x string"
        )

    before = dict(spark.sparkContext.environment)
    got = {r["x"] for r in lean_workers(seen)(spark).collect()}
    assert got == {",".join(f"{k}={v}" for k, v in LEAN.items())}
    assert dict(spark.sparkContext.environment) == before
    assert all(hasattr(stage, "__wrapped__") and hasattr(stage.__wrapped__, "__wrapped__") for _, stage in corpus_pipeline.STAGES)


def test_features_drop_what_the_token_ids_remember():
    packed.encoder("word_bpe_49k.json").ids(b"some words")
    assert packed._quick.cache_info().currsize == 1
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["a text"])], names=["doc_id", "body"])
    assert [b.num_rows for b in classifier.feature_rows(iter([batch]))] == [1]
    assert packed._quick.cache_info().currsize == 0
    forget()


def test_a_small_table_needs_no_python_worker(spark):
    made = small_table(spark, [(None, 2), ("b", None)], x=pa.string(), y=pa.int64())
    assert bag(made.collect()) == bag([(None, 2), ("b", None)])
    assert [t for _, t in made.dtypes] == ["string", "bigint"] and "Python" not in made._jdf.queryExecution().toString()
    assert small_table(spark, [], x=pa.string(), y=pa.int64()).collect() == []
