"""The class model: counts against plain Python, clustering against a brute-force exchange, probabilities that sum to 1."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from odsflow.llm import brown

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [None]


def brute_base(docs, learnt):
    """(doc_id, n_tokens, n_known, train_tokens, base_score) of each row."""
    counts = Counter(w for i, t in docs if learnt(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return [
        (i, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)))
        for i, t in docs
    ]


def same_counts(got, expected):
    key = lambda r: (repr(r[0]), r[1], r[2], round(r[4], 6))
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=key)
    assert [r[:4] for r in got] == [r[:4] for r in sorted(expected, key=key)]
    assert np.allclose([r[4] for r in got], [r[4] for r in sorted(expected, key=key)])


def test_counts_and_base_score(spark, docs, rows):
    got = brown.score_texts(docs, F.pmod("doc_id", F.lit(3)) != 1).collect()
    same_counts(got, brute_base([(i, t) for i, t, _, _ in rows], lambda i: i is not None and i % 3 != 1))
    assert all(r["score"] <= 0 and math.isfinite(r["score"]) for r in got)


def test_rarer_words_take_the_long_way_to_the_same_counts(spark, docs, rows, monkeypatch):
    """With a share above most words', nearly all are rarer words; blocks of a few hundred bytes are looked up apart."""
    monkeypatch.setattr(brown, "SHARE", 0.01)
    monkeypatch.setattr(brown, "BLOCK", 500)
    monkeypatch.setattr(brown, "CHUNK", 300)
    got = brown.score_texts(docs, F.pmod("doc_id", F.lit(3)) != 1).collect()
    same_counts(got, brute_base([(i, t) for i, t, _, _ in rows], lambda i: i is not None and i % 3 != 1))


def test_no_training_texts_and_no_rows(spark, docs, no_docs):
    assert {r["score"] for r in brown.score_texts(docs, F.lit(False)).collect()} == {0.0}
    assert brown.score_texts(no_docs, F.lit(True)).collect() == []


def test_tokens_of_arrow_texts(rows):
    bodies = [t or "" for _, t, _, _ in rows]
    words, sizes = brown.tokens_of(pa.array(bodies))
    assert words.to_pylist() == [w for b in bodies for w in tokens(b)[:-1]]
    assert sizes.tolist() == [len(tokens(b)) - 1 for b in bodies]


# --- exchange ----------------------------------------------------------------------------------

def pairs_of(line, classes):
    pairs = np.zeros((brown.CLASSES, brown.CLASSES), np.int64)
    np.add.at(pairs, (classes[line[:-1]], classes[line[1:]]), 1)
    return pairs


@pytest.fixture
def line():
    rng = np.random.default_rng(3)
    return np.concatenate([[9], rng.integers(1, 9, 400), [9]])  # numbers 1 to 8 between ends


def test_gain_is_the_difference_of_the_likelihoods(line):
    classes = np.array([1, 2, 3, 4, 2, 3, 4, 5, 5, 0])
    own = 6
    before, behind = (np.bincount(classes[x], minlength=brown.CLASSES).astype(float) for x in (line[:-1][line[1:] == own], line[1:][line[:-1] == own]))
    twice = int(((line[:-1] == own) & (line[1:] == own)).sum())
    sides = brown.alone(classes[own], before, behind, twice)
    current = brown.Pairs(pairs_of(line, classes))
    current.move(classes[own], *sides, twice, -1)
    gains, likelihoods = current.gains(*sides, twice), []
    for to in range(2, 7):
        changed = classes.copy()
        changed[own] = to
        likelihoods.append(brown.log_likelihood(pairs_of(line, changed)))
    assert np.allclose(np.diff(gains[2:7]), np.diff(likelihoods))
    current.move(5, *sides, twice, 1)
    changed = classes.copy()
    changed[own] = 5
    after = pairs_of(line, changed)
    assert (current.n == after).all() and (current.out == after.sum(axis=1)).all() and (current.into == after.sum(axis=0)).all()
    assert np.allclose(current.f, brown.xlogx(after))


def grammar(seed, n):
    """Sentences of nouns, verbs and adjectives: what follows a word depends on its kind alone."""
    rng = random.Random(seed)
    kinds = {k: [f"{k}{i}" for i in range(30)] for k in ("noun", "verb", "adj")}
    return [(i, " ".join(rng.choice(kinds[k]) for _ in range(12) for k in ("adj", "noun", "verb"))) for i in range(n)]


def test_classes_follow_the_grammar_and_beat_single_words(spark):
    docs = spark.createDataFrame(grammar(5, 300), "doc_id long, text string").repartition(3)
    texts = dict(grammar(5, 300))
    got = brown.score_texts(docs, F.col("doc_id") % 7 != 2).collect()
    held = [r for r in got if r["doc_id"] % 7 == 2]
    base, score, n = (sum(r[c] for r in held) for c in ("base_score", "score", "n_tokens"))
    assert score / n > base / n + 0.3  # a third of the words can follow: log10(3) = 0.48
    assert all(r["n_tokens"] == len(texts[r["doc_id"]].split()) + 1 for r in got)


def test_probabilities_sum_to_one_behind_every_word():
    rng = np.random.default_rng(4)
    counts = rng.integers(1, 6, 40)  # words 1 to 40
    classes = rng.integers(2, 8, 40)
    line = np.concatenate([[0], rng.permutation(np.repeat(classes, counts)), [0]])
    pairs = np.zeros((brown.CLASSES, brown.CLASSES), np.int64)
    np.add.at(pairs, (line[:-1], line[1:]), 1)
    totals = np.bincount(classes, counts, brown.CLASSES).astype(np.int64)
    kinds = np.bincount(classes, minlength=brown.CLASSES)
    totals[0], kinds[0] = 1, 1
    emissions = brown.Emissions(int(counts.sum()) + 1, 41, 0.4, totals, kinds)
    logs = brown.score_logs(pairs, emissions)
    for before in [0, brown.OTHER, *np.unique(classes)]:
        known = 10 ** (logs[before, classes] + emissions.word_log(classes, counts))
        end = 10 ** (logs[before, 0] + emissions.word_log(np.array([0]), np.array([1]))[0])
        assert known.sum() + end + 10 ** logs[before, brown.OTHER] == pytest.approx(1)


def test_rarer_words_are_placed_by_all_their_contexts():
    """Words over any number of batches, against a plain sum."""
    rng, logs = random.Random(1), np.log(np.random.default_rng(0).random((brown.CLASSES, brown.CLASSES)))
    rows = [
        (f"w{i:03}", rng.randrange(10), bytes(rng.randrange(brown.CLASSES) for _ in range(2 * rng.choice([0, 1, 3]))))
        for i in range(200) for _ in range(rng.randint(1, 5))
    ]
    contexts, blocks, expected = {}, {}, []
    for word, block, found in rows:
        contexts[word] = contexts.get(word, b"") + found
        blocks.setdefault(word, []).append(block)
    for word, found in contexts.items():
        n = len(found) // 2
        sums = sum((logs[found[2 * i]] + logs[:, found[2 * i + 1]] for i in range(n)), np.zeros(brown.CLASSES))
        own = brown.FIRST + int(np.argmax(sums[brown.FIRST:])) if n else brown.OTHER
        expected += [(block, word, own, n) for block in [*blocks[word], None]]
    schema = pa.schema([("word", pa.string()), ("block", pa.int64()), ("contexts", pa.binary())])
    for size in (1, 2, 7, 5000):
        parts = [pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i:i + size]), schema)], schema=schema) for i in range(0, len(rows), size)]
        got = [r for part in brown.place_words(logs)(iter(parts)) for r in zip(*[c.to_pylist() for c in part.columns])]
        assert sorted(got, key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("most", [1, 30, 5000])
def test_packed_words_are_the_placed_ones(monkeypatch, most):
    """However much is packed at once: each block's words with class and count, and the sums of each class over the words."""
    monkeypatch.setattr(brown, "PACKED", most)
    rng = random.Random(2)
    words = [(f"w{i}é", rng.randrange(brown.FIRST, 6), rng.choice([1, 3, 255, 256, 70_000, 1 << 40])) for i in range(120)] + [("never", brown.OTHER, 0)]
    rows = [(rng.choice([0, 1, 1 << 32, (7 << 32) + 5]), *w) for w in words for _ in range(3)]
    parts = [(rows[i:i + 17], pa.int64()) for i in range(0, len(rows), 17)] + [([(None, *w) for w in words], pa.int64())]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), (kind, pa.string(), pa.int32(), pa.int64()))], names=["block", "word", "class", "n"])
        for part, kind in parts
    ]
    got = pa.Table.from_batches(brown.pack_words(iter(batches)))
    found = []
    for block in {b for b, *_ in rows}:
        each, classes, counts = brown.unpacked(got.filter(pa.compute.equal(got.column("block"), block)))
        found += zip([block] * len(each), each.to_pylist(), classes.tolist(), counts.tolist())
    assert sorted(found) == sorted(rows)
    sums = got.filter(pa.compute.is_null(got.column("block"))).to_pylist()
    expected = {c: (sum(n for _, k, n in words if k == c), sum(k == c for _, k, _ in words)) for c in range(brown.FIRST, 6)}
    assert {r["class"]: (r["n"], r["v"]) for r in sums} == expected and len(sums) == len(expected)


def test_numbers_are_whole_from_their_halves():
    numbers, lists = np.array([0, 1, 65_535, 65_536, 99_999, 0, 131_072], "<u4"), [(0, 2), (2, 2), (2, 7)]
    halves = [[h[a:b].astype("<u2").tobytes() for a, b in lists] for h in (numbers & 0xFFFF, numbers >> 16)]
    got, sizes = brown.sequence(pa.table({"low": pa.array(halves[0], pa.binary()), "high": pa.array(halves[1], pa.binary())}))
    assert got.tolist() == numbers.tolist() and sizes.tolist() == [2, 0, 5]


def test_tables_on_disk_are_small(spark, monkeypatch, tmp_path):
    """Texts take less than two bytes a frequent word; the words placed are a few rows a task and block, not one a word and block."""
    made, own = {}, brown.written

    def seen(df, label, *args):
        made[label] = own(df, label, *args)
        return made[label]

    monkeypatch.setattr(brown, "written", seen)
    monkeypatch.setattr(brown, "SHARE", 1e-4)
    rng = random.Random(8)
    texts = [(i, " ".join([*(f"w{rng.randrange(4000)}" for _ in range(900)), *(f"r{rng.randrange(1 << 30)}" for _ in range(20))])) for i in range(240)]
    spark.createDataFrame(texts, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/texts")
    got = brown.score_texts(spark.read.parquet(f"{tmp_path}/texts"), F.lit(True)).collect()
    same_counts(got, brute_base(texts, lambda i: True))
    size = sum(spark._jvm.java.io.File(f.split(":", 1)[1]).length() for f in made["coded"].inputFiles())
    rare = sum(len(w) + 1 for _, t in texts for w in t.split() if w[0] == "r")
    assert size < 2 * 900 * len(texts) + rare
    assert made["placed"].count() < 200  # rarer words: about 4,800
