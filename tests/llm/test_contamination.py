import re

import pytest

from odsflow.llm import contamination as module
from odsflow.llm.contamination import contamination, index_for, proximity_matches, phrase_windows, without_contaminated

from .conftest import bag, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def items_of():
    return [
        (1, prose(4, 40)), (2, prose(200, 30)), (10, "one"), (11, None), (12, "  "), (13, prose(2, 74).upper()[:120]),
        (None, prose(6, 12)), (2, prose(200, 30)), (14, "ka2 ka2"), (15, prose(100, 70)),
    ]


def brute(rows, items, size=10):
    phrases = {}
    for item_id, text in items:
        words = split(text)
        for i in range(max(1, len(words) - size + 1) if words else 0):
            phrases.setdefault(tuple(words[i:i + size]), set()).add(item_id)
    found = []
    for doc_id, text, *_ in rows:
        words, hit, listed = split(text), set(), set()
        for n in {len(p) for p in phrases}:
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) in phrases:
                    hit.update(range(i, i + n))
                    listed |= phrases[tuple(words[i:i + n])]
        found.append((doc_id, len(words), len(hit), sorted(str(i) for i in listed if i is not None)))
    return found


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in items_of()], "item_id long, text string, term string")


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_contamination_matches_brute_force(docs, rows, items, monkeypatch, broadcast_rows):
    monkeypatch.setattr(module, "BROADCAST_ROWS", broadcast_rows)
    got = contamination(docs, items).select("doc_id", "n_words", "n_hit", "items").collect()
    expected = brute(rows, items_of())
    assert bag(got) == bag(expected)
    assert sum(r[2] > 0 for r in expected) > 5


def test_other_window_sizes(docs, rows, items):
    got = contamination(docs, items, window=4).select("doc_id", "n_words", "n_hit", "items").collect()
    assert bag(got) == bag(brute(rows, items_of(), 4))


def test_empty_tables(spark, docs, no_docs, items, rows):
    nothing = spark.createDataFrame([], "item_id long, text string")
    got = contamination(docs, nothing)
    assert got.count() == len(rows) and got.where("n_hit > 0 OR size(items) > 0").count() == 0
    assert contamination(no_docs, items).collect() == []
    assert without_contaminated(docs, nothing).count() == len(rows)


def test_contaminated_rows_go(docs, rows, items):
    kept = without_contaminated(docs, items)
    assert kept.columns == docs.columns
    clean = [r[0] for r, b in zip(rows, brute(rows, items_of())) if b[2] == 0]
    assert bag((r["doc_id"],) for r in kept.collect()) == bag((i,) for i in clean)


def test_proximity_matches(spark):
    docs = spark.createDataFrame([(1, "zig one zag"), (2, "zig zag"), (3, "zig a b c d e f g zag"), (4, "zag zig"), (5, "zig")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "zig zag")], "item_id long, text string")
    index, rarest = index_for(docs, phrase_windows(items))
    near = proximity_matches(index, rarest, slack=3).select("doc_id", "moved").collect()
    assert sorted((r["doc_id"], abs(r["moved"])) for r in near) == [(1, 1), (2, 0), (4, 2)]


def test_the_main_path_is_native(docs, items):
    plan = contamination(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
