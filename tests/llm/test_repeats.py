import hashlib
import random

import numpy as np
import pytest

from odsflow.llm import repeats, substrings, windows
from odsflow.llm.repeats import merge_pieces
from odsflow.llm.windows import ByteUnits, WordUnits, cells, gram_hashes, text_cells

from .conftest import bag


def brute_words(rows, window):
    first = {}
    for doc_id, text, *_ in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1):
            run, rank = tuple(words[i:i + window]), windows.NO_ID if doc_id is None else doc_id
            first[run] = min(rank, first.get(run, rank))
    found = []
    for doc_id, text, *_ in rows:
        words, rank, gone = (text or "").encode().split(), windows.NO_ID if doc_id is None else doc_id, set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i:i + window])] < rank:
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        found.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return found


def brute_bytes(rows, window):
    texts, count = [(r[1] or "").encode() for r in rows], {}
    for t in texts:
        for i in range(len(t) - window + 1):
            count[t[i:i + window]] = count.get(t[i:i + window], 0) + 1
    found = []
    for (doc_id, *_), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, dtype=bool)
        for i in range(len(t) - window + 1):
            if count[t[i:i + window]] > 1:
                gone[i:i + window] = True
        spans = int((gone[:-1] & np.append(True, ~gone[:-2])).sum()) if len(t) else 0
        kept = bytes(b for b, g in zip(t, gone) if not g)
        found.append((doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return found


def shared_corpus(seed, n):
    """Texts cut from a few passages with changed words, so that cells agree, half agree and differ."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)]
    passages = [[rng.choice(vocabulary) for _ in range(160)] for _ in range(3)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(1, 3)):
            p, a = rng.choice(passages), rng.randint(0, 100)
            part = p[a:a + rng.randint(20, 120)]
            if rng.random() < 0.5 and part:
                part = [*part]
                part[rng.randrange(len(part))] = "changed"
            words += part + [rng.choice(vocabulary) for _ in range(rng.randint(0, 15))]
        rows.append((rng.choice([i, i, i, i // 2, None]), " ".join(words)))
    return rows


@pytest.mark.parametrize("per_part", [10_000, 3])
def test_word_repeats_match_brute_force(spark, monkeypatch, per_part):
    monkeypatch.setattr(windows, "PIECES_PER_PART", per_part)
    rows = shared_corpus(11, 60)
    kept = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), window=50)
    got = [(r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept"]).hexdigest()) for r in kept.collect()]
    assert bag(got) == bag(brute_words(rows, 50))
    assert any(r[2] for r in got)


@pytest.mark.parametrize("per_part", [10_000, 3])
def test_byte_repeats_match_brute_force(spark, monkeypatch, per_part):
    monkeypatch.setattr(windows, "PIECES_PER_PART", per_part)
    rows = shared_corpus(12, 40)
    kept = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), window=200)
    got = [tuple(r[k] for k in ("doc_id", "n_bytes", "n_removed", "n_spans")) + (hashlib.sha256(r["kept"]).hexdigest(),) for r in kept.collect()]
    assert bag(got) == bag(brute_bytes(rows, 200))
    assert any(r[3] > 1 for r in got)


def test_odd_rows(docs, rows, no_docs):
    kept = substrings.remove_repeats(docs).collect()
    assert bag((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept"]).hexdigest()) for r in kept) == bag(brute_words(rows, 50))
    kept = repeats.remove_repeats(docs).collect()
    assert bag(
        (r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in kept
    ) == bag(brute_bytes(rows, 200))
    assert substrings.remove_repeats(no_docs).collect() == [] == repeats.remove_repeats(no_docs).collect()


def test_merged_transforms_find_all_repeats(monkeypatch):
    rng = random.Random(3)
    for _ in range(80):
        window = rng.choice([1, 2, 3, 5, 8, 9])
        pieces = list(dict.fromkeys(
            bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(window, 40))) for _ in range(rng.randint(1, 12))
        ))
        monkeypatch.setattr(repeats, "SHARD", rng.choice([10, 50, 1000]))
        where = {}
        for i, p in enumerate(pieces):
            for a in range(len(p) - window + 1):
                where.setdefault(p[a:a + window], []).append((i, a))
        found = [(int(i), int(a) + j) for i, a, n in zip(*merge_pieces(pieces, window)) for j in range(n)]
        assert sorted(found) == sorted(x for v in where.values() if len(v) > 1 for x in v)


def test_the_interleave_is_refined_by_doubling(monkeypatch):
    rng, rounds = random.Random(5), []
    base = bytes(rng.choice(b"abcd ") for _ in range(700))
    pieces = [base[:400], base[100:500], base[90:300] + b"x" + base[301:700], b"y" * 450, base[250:449], base[250:450]]
    deal = repeats.in_blocks
    shards = [repeats.Shard(pieces[:3], [0, 1, 2]), repeats.Shard(pieces[3:], [3, 4, 5])]
    monkeypatch.setattr(repeats, "in_blocks", lambda keys: rounds.append(len(keys)) or deal(keys))
    for window in (200, 128, 199, 256):
        where = {}
        for i, p in enumerate(pieces):
            for a in range(len(p) - window + 1):
                where.setdefault(p[a:a + window], []).append((i, a))
        rounds.clear()
        found = repeats.repeated_starts(shards, window)
        assert sorted(zip(*(x.tolist() for x in found))) == sorted(x for v in where.values() if len(v) > 1 for x in v)
        assert len(rounds) <= 8 and rounds == sorted(rounds, reverse=True)


@pytest.mark.parametrize("top", [1 << 8, 1 << 62])
def test_blocks_of_narrow_and_wide_keys(top):
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 40, 500) * (top // 64)
    order, border = repeats.in_blocks(keys)
    assert order.tolist() == np.argsort(keys, kind="stable").tolist()
    assert np.flatnonzero(border).tolist() == [*np.unique(np.sort(keys), return_index=True)[1].tolist(), 500]
    assert [len(x) for x in repeats.in_blocks(keys[:0])] == [0, 1]


def test_a_transform_can_be_read_back():
    pieces = [b"banana", b"ananas", b"", b"\x00\xff"]
    shard = repeats.Shard(pieces, [0, 1, 2, 3])
    for number, piece in enumerate(pieces):
        row = int(np.flatnonzero((shard.piece == number) & (shard.at == len(piece)))[0])
        text = []
        for _ in piece:
            text.append(int(shard.bwt[row]) - 1)
            row = int(shard.back[row])
        assert bytes(reversed(text)) == piece


@pytest.mark.parametrize("segment", [1 << 22, 37])
def test_equal_windows_have_equal_anchors(monkeypatch, segment):
    monkeypatch.setattr(windows, "SEGMENT", segment)
    rng = random.Random(8)
    for _ in range(40):
        base = bytes(rng.choice(b"abc ") for _ in range(300))
        anchors = {}
        for _ in range(4):
            text = base[rng.randint(0, 40):][:rng.randint(30, 250)] + bytes(rng.choice(b"abc ") for _ in range(50))
            hashes = gram_hashes(ByteUnits(text).hashes, 8)
            places, firsts, counts = cells(hashes, 40 - 8 + 1)
            assert counts.sum() == max(0, len(text) - 39)
            for p, a, n in zip(places.tolist(), firsts.tolist(), counts.tolist()):
                for i in range(a, a + n):
                    mark = (int(hashes[p]), p - i)
                    assert anchors.setdefault(text[i:i + 40], mark) == mark


def test_short_texts_have_no_cells():
    assert all(len(c) == 0 for c in text_cells(WordUnits(b"a b c"), 50, 16))
    assert all(len(c) == 0 for c in text_cells(ByteUnits(b""), 200, 32))


def test_factors_are_greedy_and_checked_at_their_ends():
    reference = substrings.Reference(3)
    reference.add(b"a b c d e".split())
    reference.add(b"d e f g".split())
    assert list(substrings.factors(b"a b c d e f g x".split(), reference)) == [(0, 5), (3, 4)]
    assert list(substrings.factors(b"x y z".split(), reference)) == []
