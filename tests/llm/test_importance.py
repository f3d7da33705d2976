"""Importance resampling against plain sums, and bit planes against plain products."""

import math
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from odsflow.llm import importance

from .conftest import bag

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text, longest):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, longest=1, buckets=10_000, least=20, percent=10, seed=2024):
    found = [(i, *runs(t, longest)) for i, t in docs]
    s = Counter(crc32(f.encode()) % buckets for _, _, fs in found for f in fs)
    t = Counter(crc32(f.encode()) % buckets for text in target for f in runs(text, longest)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (all_s + buckets) / ((s[b] + 1.0) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for i, n_words, fs in found:
        weight = sum(gain[crc32(f.encode()) % buckets] for f in fs) // len(fs) if fs else 0
        h = int(sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n_words, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for rank, row in enumerate(fit[:percent * len(fit) // 100], 1):
        row[5] = rank
    return [tuple(r) for r in rows]


@pytest.mark.parametrize("longest, buckets", [(1, 10_000), (2, 257), (3, 64)])
def test_equals_plain_sums(spark, docs, rows, longest, buckets):
    target = [(None,), ("",), ("kan lora. Ruti téra, 2 son",), (rows[3][1],)]
    items = spark.createDataFrame(target, "text string")
    got = importance.resample(docs, items, longest=longest, buckets=buckets, percent=40, seed=7)
    assert bag(got.collect()) == bag(brute([(i, t) for i, t, _, _ in rows], [t for t, in target], longest, buckets, 20, 40, 7))


def test_empty_tables(spark, docs, rows, no_docs):
    items = spark.createDataFrame([], "text string")
    assert bag(importance.resample(docs, items).collect()) == bag(brute([(i, t) for i, t, _, _ in rows], []))
    assert importance.resample(no_docs, items).collect() == []


def test_bit_planes_give_exact_sums():
    rng = np.random.default_rng(1)
    for buckets, most, high in ((1, 1, 1), (64, 3, 5), (130, 70_000, 12_000), (1000, 1, 1)):
        gain = rng.integers(-high, high, buckets)
        counts = rng.integers(0, most + 1, (5, buckets))
        assert importance.sliced_sums(counts, *importance.gain_planes(gain)).tolist() == (counts @ gain).tolist()


def test_extreme_gains_fit_their_planes():
    for gain in ([0], [-1], [1], [-8], [7, -8], [8], [-9, 3]):
        gain = np.array(gain)
        assert importance.sliced_sums(np.full((1, len(gain)), 3), *importance.gain_planes(gain)).tolist() == [3 * gain.sum()]


def test_target_like_texts_are_drawn_more_often(spark):
    wanted, other = "alpha beta gamma delta", "one two three four"
    docs = spark.createDataFrame([(i, " ".join([wanted if i % 2 else other] * 6)) for i in range(400)], "doc_id long, text string")
    items = spark.createDataFrame([(wanted,)] * 30, "text string")
    drawn = [r["doc_id"] % 2 for r in importance.resample(docs, items, percent=25).collect() if r["rank"]]
    assert len(drawn) == 100 and sum(drawn) > 60
