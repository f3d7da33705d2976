import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from odsflow.llm import classifier
from odsflow.llm.classifier import (
    MEASURED, PLACES, Block, Model, Sums, block_sums, class_prior, feature_rows, fit, held_out, pack, places, positive_features, shape, train,
    with_quality,
)

from .conftest import prose


def junk(seed, n):
    return " ".join(w.upper() + "!!" for w in prose(seed, n).split())


def corpus(n=400):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        rows.append((i, prose(i, 60) if good else junk(i, 60)))
        if rng.random() < 0.5:
            labels.append((i, int(good)))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = corpus()
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_folds(spark):
    got = spark.range(50).select("id", held_out(F.col("id")).alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in got)


def test_held_out_accuracy(tables):
    docs, labels = tables
    scored = with_quality(docs, train(docs, labels)).join(labels, "doc_id").where(held_out(F.col("doc_id"))).collect()
    assert len(scored) > 20
    assert np.mean([r["predicted"] == r["quality"] for r in scored]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in scored)


def test_held_out_labels_and_texts_are_not_looked_at(tables):
    docs, labels = tables
    flipped = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("text", F.when(held_out(F.col("doc_id")), F.lit("zzz")).otherwise(F.col("text")))
    first, second = train(docs, labels), train(other.repartition(5), flipped)
    assert first.bias == pytest.approx(second.bias) and np.allclose(first.weights, second.weights, atol=1e-6)  # sums in another order


def brute_features(text):
    """Measures, then the share of the text's words and shapes that fall on each place."""
    words, body = text.encode().split(), text.encode()
    n, lines = len(words), [line for line in body.split(b"\n") if line and not line.isspace()]
    size = max(1, len(body))
    count = lambda signs: sum(c in signs for c in body) / size
    dense = np.zeros(PLACES)
    dense[:MEASURED] = [
        min(1.0, np.log1p(n) / 10), len(set(words)) / max(1, n), 1 - len(set(lines)) / max(1, len(lines)),
        count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), count(b"#*$%&|<>{}[]\\^~_=+@"), count(b"0123456789"), min(1.0, size / max(1, n) / 20), n == 0,
        sum(a == b for a, b in zip(words, words[1:])) / max(1, n), 1 - len(set(zip(words, words[1:]))) / max(1, n - 1),
    ]
    for word in words:
        for place in places(word):
            dense[place] += 1 / n
    return dense


def blocks_of(texts, good):
    """The features of some texts as the fit reads them."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["doc_id", "body"])
    made = pa.Table.from_batches(feature_rows(iter([batch])))
    made = made.append_column("good", pa.array(good, pa.bool_())).combine_chunks()
    return [Block(row) for part in pack(iter(made.to_batches())) for row in part.to_pylist()]


def test_features_equal_plain_counts(rows):
    texts = [t or "" for _, t, *_ in rows]
    for some in (texts, [""], ["a A\n\na A 1"]):
        block, = blocks_of(some, [None] * len(some))
        dense = np.zeros((len(some), PLACES))
        dense[:, :MEASURED] = block.measured
        np.add.at(dense, (block.rows, block.places.astype(int)), block.values)
        assert np.allclose(dense, [brute_features(t) for t in some], atol=1e-6)


def dense_fit(x, good, prior, steps, rate, ridge):
    """The same risk with dense features and a written-out Adam."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    w[-1] = np.log(prior / (1 - prior))
    speed = np.where((np.arange(len(w)) >= MEASURED) & (np.arange(len(w)) < len(w) - 1), 20.0, 1.0)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = x @ w
        s = 1 / (1 + np.exp(-z))
        risk_n = np.logaddexp(0, z).mean() - prior * np.logaddexp(0, z[good]).mean()
        grad_p1 = (x[good] * (s[good] - 1)[:, None]).mean(axis=0)  # positives as 1
        grad_n = (x * s[:, None]).mean(axis=0) - prior * (x[good] * s[good][:, None]).mean(axis=0)
        grad = prior * grad_p1 + grad_n if risk_n >= 0 else -grad_n
        grad[:-1] += ridge * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - rate * speed * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


@pytest.mark.parametrize("prior", [0.4, 0.97])
def test_fit_equals_a_dense_gradient(prior):
    texts = [prose(i, 40) for i in range(12)] + [junk(i, 40) for i in range(8)]
    good = [i % 3 == 0 and i < 12 for i in range(20)]
    blocks = blocks_of(texts, good)
    model = fit(lambda w, _: Sums.of(block_sums(iter(blocks), w)), [positive_features(iter(blocks))], prior, steps=25)
    expected = dense_fit(np.array([brute_features(t) for t in texts]), np.array(good), prior, 25, classifier.RATE, classifier.RIDGE)
    assert np.allclose(np.append(model.weights, model.bias), expected, atol=1e-5)


def test_spark_adds_up_what_one_array_does(tables):
    docs, labels = tables
    rows, known = docs.collect(), {r["doc_id"]: r["quality"] for r in labels.collect()}
    own = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5]
    blocks = blocks_of([r["text"] for r in own], [known.get(r["doc_id"]) == 1 for r in own])
    learnt = [q for i, q in known.items() if zlib.crc32(str(i).encode()) % 5]
    alone = fit(lambda w, _: Sums.of(block_sums(iter(blocks), w)), [positive_features(iter(blocks))], sum(learnt) / len(learnt), steps=8)
    model = train(docs.repartition(5), labels, steps=8)
    assert np.allclose(model.weights, alone.weights, atol=1e-6) and model.bias == pytest.approx(alone.bias)


def test_with_a_label_on_every_document_junk_still_scores_lower(tables):
    docs, _ = tables
    every = docs.select("doc_id", F.when(F.col("text").contains("!!"), 0).otherwise(1).alias("quality"))
    scored = with_quality(docs, train(docs, every)).join(every, "doc_id").where(held_out(F.col("doc_id"))).collect()
    assert min(r["score"] for r in scored if r["quality"]) > max(r["score"] for r in scored if not r["quality"])
    assert {r["predicted"] for r in scored if not r["quality"]} == {0}


def test_the_risk_never_turns_the_negative_part_below_zero_for_long():
    """With a prior far too high, unlabelled junk still scores lower than the positives."""
    texts = [prose(i, 50) for i in range(40)] + [prose(100 + i, 50) for i in range(20)] + [junk(i, 50) for i in range(20)]
    blocks = blocks_of(texts, [i < 40 for i in range(80)])
    model = fit(lambda w, _: Sums.of(block_sums(iter(blocks), w)), [positive_features(iter(blocks))], prior=0.95)
    margins = blocks[0].margins(np.append(model.weights, model.bias))
    assert margins[:40].mean() > margins[60:].mean() and np.isfinite(model.weights).all()


def test_scores_are_the_sum_over_features(rows):
    rng = np.random.default_rng(1)
    model = Model(rng.normal(size=PLACES), 0.3)
    texts = [t or "" for _, t, *_ in rows]
    got = model.scores(pa.array(texts, pa.string()), {w: float(model.weights[list(places(w))].sum()) for t in texts for w in t.encode().split()})
    margins = np.array([brute_features(t) for t in texts]) @ model.weights + model.bias
    assert np.allclose(got, 1 / (1 + np.exp(-np.clip(margins, -30, 30))), atol=1e-5)


def test_places_of_many_words_are_those_of_each(rows, monkeypatch):
    words = sorted({w for _, t, *_ in rows for w in (t or "").split(" ")} | {"", "ABC!!", "x1234", "*****", "É́é", "Foo", "fOO"} | {f"{w}x" for w in ("Bar", "Baz")})
    drawn = []
    monkeypatch.setattr(classifier, "shape", lambda w: drawn.append(w) or shape(w))
    found = classifier.all_places(pa.array(["no", *words], pa.string()).slice(1))
    assert len(drawn) == len(set(drawn)) < len(words)  # one shape of words drawn alike
    assert [tuple(f) for f in found.tolist()] == [places(w.encode()) for w in words]
    assert classifier.all_places(pa.array([], pa.string())).shape == (0, 2)


def test_shapes():
    assert [shape(w) for w in (b"Hello,", b"ABC!!", b"x1234", b"***", b"*****", "é".encode())] == [b"Aaa,", b"AA!!", b"a00", b"***", b"***", b"aa"]


def test_texts_reach_the_workers_in_small_batches(spark, monkeypatch):
    before = spark.conf.get(classifier.BATCH_SETTING)
    monkeypatch.setattr(classifier, "BATCH", 1 << 14)
    try:
        classifier.small_batches(spark)
        docs = spark.range(0, 400, 1, 1).select(F.lpad(F.lit("a"), 1000, "b").alias("body"))
        sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long").collect()
        assert sum(r["n"] for r in sizes) == 400 and max(r["n"] for r in sizes) <= 40
        spark.conf.set(classifier.BATCH_SETTING, "100")
        classifier.small_batches(spark)
        assert spark.conf.get(classifier.BATCH_SETTING) == "100"
    finally:
        spark.conf.set(classifier.BATCH_SETTING, before)


def test_no_labels_no_texts(spark, docs, no_docs, rows):
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    model = train(docs, nothing)
    assert not model.weights.any() and class_prior(nothing.withColumnRenamed("quality", "good")) == 0.5
    assert with_quality(no_docs, model).collect() == []
    scored = with_quality(docs.withColumnRenamed("size", "score"), model)
    assert scored.columns.count("score") == 1 and scored.count() == len(rows)
    labels = spark.createDataFrame([(0, 1), (1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    assert len(train(docs, labels).weights) == PLACES


def test_batches_take_turns():
    """Two batches in turn: each step sees its own batch alone; one without positives is passed over."""
    texts = [prose(i, 40) for i in range(12)] + [junk(i, 40) for i in range(8)]
    halves = [blocks_of(texts[i::2], [k < 6 for k in range(10)]) for i in (0, 1)] + [blocks_of(texts[:4], [False] * 4)]
    seen = []

    def sums_of(weights, batch):
        seen.append(batch)
        return Sums.of(block_sums(iter(halves[batch]), weights))

    model = fit(sums_of, [positive_features(iter(h)) for h in halves], 0.6, steps=40)
    assert set(seen) == {0, 1} and seen.count(0) == seen.count(1) == 20
    margins = [h[0].margins(np.append(model.weights, model.bias)) for h in halves[:2]]
    assert min(m[:6].min() for m in margins) > max(m[6:].max() for m in margins)


def test_many_texts_are_fitted_in_batches(spark, tables, monkeypatch):
    docs, labels = tables
    monkeypatch.setattr(classifier, "ROWS_A_BATCH", 1)
    made = []
    plain = classifier.fit
    monkeypatch.setattr(classifier, "fit", lambda sums, base, *more: made.append(len(base)) or plain(sums, base, *more))
    scored = with_quality(docs, train(docs.repartition(6), labels, steps=24)).join(labels, "doc_id").where(held_out(F.col("doc_id"))).collect()
    assert made[0] > 1
    assert np.mean([r["predicted"] == r["quality"] for r in scored]) >= 0.9
