import random

import pytest
from pyspark.sql import functions as F

from odsflow.llm import mixing
from odsflow.llm.mixing import mix, route, share_targets, word_count

from .conftest import bag


def brute_targets(sizes, weights, total, most):
    targets, open_ones = [0.0] * len(sizes), set(range(len(sizes)))
    left = total
    while open_ones:
        weight = sum(weights[i] for i in open_ones)
        over = {i for i in open_ones if left * weights[i] / weight > most * sizes[i]}
        if not over:
            for i in open_ones:
                targets[i] = left * weights[i] / weight
            break
        for i in over:
            targets[i] = most * sizes[i]
        left -= sum(targets[i] for i in over)
        open_ones -= over
    return targets


def test_targets_match_resharing_step_by_step():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randint(1, 9)
        sizes, weights = [rng.choice([0, 1, 5, 100, 1000, 40_000]) for _ in range(n)], [(5, 2, 1)[i % 3] for i in range(n)]
        got = share_targets(sizes, weights, 1.5 * sum(sizes), 2)
        assert got == pytest.approx(brute_targets(sizes, weights, 1.5 * sum(sizes), 2))
        assert sum(got) == pytest.approx(1.5 * sum(sizes))
    assert share_targets([], [], 0, 2) == []


def best_by_trial(patterns, quotas, copies):
    """Most words, then the least cost, over all whole splits of tiny sizes."""
    arcs = [(i, s) for i, (members, _) in enumerate(patterns) for s in members]
    best = (0, 0)

    def go(k, used, filled):
        nonlocal best
        if k == len(arcs):
            cost = sum(max(0, u - level * patterns[i][1]) for i, u in used.items() for level in range(1, copies))
            best = max(best, (sum(filled.values()), -cost))
            return
        i, s = arcs[k]
        for f in range(min(patterns[i][1] * copies - used.get(i, 0), quotas.get(s, 0) - filled.get(s, 0)) + 1):
            go(k + 1, {**used, i: used.get(i, 0) + f}, {**filled, s: filled.get(s, 0) + f})

    go(0, {}, {})
    return best


def test_flow_is_largest_and_cheapest():
    rng = random.Random(6)
    for _ in range(60):
        patterns = [(frozenset(rng.sample("abc", rng.randint(1, 2))), rng.randint(0, 3)) for _ in range(3)]
        quotas = {s: rng.randint(0, 4) for s in "abc"}
        sent = route(patterns, quotas, 2)
        taken = sum(t for t, _ in sent)
        cost = sum(max(0, t - size) for (t, _), (_, size) in zip(sent, patterns))
        assert (taken, -cost) == best_by_trial(patterns, quotas, 2)
        for (t, split), (members, size) in zip(sent, patterns):
            assert t == sum(split.values()) <= 2 * size and set(split) == members


def test_repeats_only_where_a_quota_needs_them():
    sent = route([(frozenset("a"), 10), (frozenset("ab"), 10)], {"a": 15, "b": 10}, 2)
    taken = [t for t, _ in sent]
    assert sum(taken) == 25 and min(taken) >= 10  # all words once, five of them again
    assert sent == route([(frozenset("a"), 10), (frozenset("ba"), 10)], {"b": 10, "a": 15}, 2)


def test_words_are_counted(spark):
    texts = [None, "", " ", "a", " a\tb\n\x0b c\x0cd\re ", "a b", "x  y"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", word_count(F.col("t"))).collect()
    assert [r[1] for r in sorted(got)] == [len((t or "").encode().split()) for t in texts]


def mixture(spark, n, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice([["a"], ["a"], ["a", "b"], ["b"], [None], [], None]), rng.choice([0, 1, 7, 30, None])) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, members array<string>, size long").withColumn("hash_", F.lit("own"))


@pytest.mark.parametrize("digits", [1, 3])
def test_mix_comes_near_its_quotas_and_reruns_agree(spark, monkeypatch, digits):
    monkeypatch.setattr(mixing, "BIN_DIGITS", digits)
    table = mixture(spark, 300, 7).drop("hash_")
    sizes = {r["m"]: r["s"] for r in table.groupBy(F.to_json("members").alias("m")).agg(F.sum("size").alias("s")).collect()}
    total = {"a": sizes['["a"]'], "b": sizes['["b"]'] + sizes['["a","b"]'], None: sizes["[null]"]}
    quotas = {"a": 1.4 * total["a"], "b": 0.5 * total["b"], None: 2.0 * total[None]}
    first, again = (mix(table.repartition(n), quotas, 2).collect() for n in (2, 5))
    assert bag(first) == bag(again) and len(first) == 300
    assert all(r["copies_taken"] in (0, 1, 2) for r in first)
    assert all(r["copies_taken"] == 0 for r in first if not r["members"] or not r["size"])
    taken = sum(r["copies_taken"] * (r["size"] or 0) for r in first)
    assert abs(taken - sum(quotas.values())) <= 3 * 30
    assert sum(r["copies_taken"] * (r["size"] or 0) for r in first if r["members"] == [None]) == 2 * total[None]


def test_mix_of_nothing_and_of_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, members array<string>, size long")
    assert mix(empty, {"a": 5}).collect() == []
    rows = [(None, ["a"], 4)] * 3 + [(9, ["a"], 4)] * 2 + [(9, ["b"], 4)]
    got = mix(spark.createDataFrame(rows, "doc_id long, members array<string>, size long"), {"a": 20, "b": 100}, 2).collect()
    assert {r["copies_taken"] for r in got if r["members"] == ["b"]} == {2}
    assert len({r["copies_taken"] for r in got if r["doc_id"] is None}) == 1


def test_too_many_patterns_are_refused(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_PATTERNS", 2)
    rows = [(i, [str(i)], 1) for i in range(3)]
    with pytest.raises(ValueError):
        mix(spark.createDataFrame(rows, "doc_id long, members array<string>, size long"), {})


def test_columns_of_any_name_stay(spark):
    names = ["base", "cut_", "chosen_", "size_", "hash_", "pattern_", "members_", "row", "extra", "pattern", "copies_taken"]
    rows = [(i, [f"s{i % 3}"], 10 + i, *[f"{n}{i}" for n in names]) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, members array<string>, size long, " + ", ".join(f"{n} string" for n in names))
    mixed = mix(docs, {"s0": 120, "s1": 400, "s2": 0})
    assert mixed.columns == [c for c in docs.columns if c != "copies_taken"] + ["copies_taken"]
    plain = mix(docs.select("doc_id", "members", "size"), {"s0": 120, "s1": 400, "s2": 0})
    got = {r["doc_id"]: r for r in mixed.collect()}
    assert {i: r["copies_taken"] for i, r in got.items()} == {r["doc_id"]: r["copies_taken"] for r in plain.collect()}
    assert all(r[n] == f"{n}{i}" for i, r in got.items() for n in names[:-1])
