"""The Merkle manifest against a plain tree of hashes."""

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from odsflow.llm import merkle

from .conftest import bag

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes):
    """Levels of a tree, from the leaves to its only node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, place):
    for nodes in levels[:-1]:
        start = place // 8 * 8
        yield "".join(nodes[start:place]), "".join(nodes[place + 1:start + 8])
        place //= 8


def brute(rows, claim):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    made = [(r[0], r[2], h(*map(field, r)), h(*map(field, claim(r)))) for r in rows]
    langs = sorted({m[1] for m in made}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: sorted((m for m in made if m[1] == lang), key=lambda m: (m[0] is not None, m[0] or 0, m[2], m[3])) for lang in langs}
    levels = {lang: climb([m[2] for m in trees[lang]]) for lang in langs}
    upper = climb([levels[lang][-1][0] for lang in langs])
    found = []
    for at, lang in enumerate(langs):
        for place, (doc_id, _, leaf, claimed) in enumerate(trees[lang]):
            steps = [*path(levels[lang], place), *path(upper, at)]
            for before, behind in steps:
                claimed = h(before, claimed, behind)
            root = upper[-1][0]
            found.append((doc_id, leaf, levels[lang][-1][0], root, h(*[s for pair in steps for s in pair]), claimed, claimed == root))
    return found


def tampered(row):
    return (*row[:4], row[4] and row[4].upper()) if row[0] is not None and row[0] % 3 == 0 else row


def claims():
    return {"text": F.when(F.col("doc_id") % 3 == 0, F.upper("text")).otherwise(F.col("text"))}


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    assert bag(merkle.manifest(df, FIELDS, claimed=claims()).collect()) == bag(brute(rows, tampered))


@pytest.mark.parametrize("n", [1, 2, 8, 9, 65, 600])
def test_trees_of_many_sizes(spark, n):
    rows = [(i * 7 % n, f"s{i % 2}", ["en", "de", None, "é", "en"][i % 5] if i % 2 else "en", i, f"text {i % 40}") for i in range(n)]
    check(spark, rows)


def test_a_single_tree_has_no_upper_levels(spark):
    check(spark, [(i, "s", "en", i, "x") for i in range(17)])


def test_more_groups_than_a_run(spark):
    check(spark, [(i, "s", f"l{i % 30}", i, "x") for i in range(70)])


def test_several_superblocks(spark):
    """More leaves than one superblock has, in one of three trees."""
    check(spark, [(i, "s", None if i % 2000 == 1 else "en" if i % 100 else "fr", i, f"t{i}") for i in range(9000)])


def test_odd_rows(spark, docs, rows):
    made = [(i, s, lang, None if t is None else len(t), t) for i, t, lang, s in rows]
    assert bag(merkle.manifest(docs, FIELDS, claimed=claims()).collect()) == bag(brute(made, tampered))


def test_no_rows(spark, no_docs):
    assert merkle.manifest(no_docs, FIELDS).collect() == []


def test_a_moved_boundary_between_fields_is_seen(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, ""), ("", None), ("-", "")], "x string, y string")
    assert df.select(merkle.leaf(F.col("x"), F.col("y")).alias("leaf")).distinct().count() == 5
