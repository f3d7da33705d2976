import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from odsflow.llm.packed import BLOCK, IDS_PER_OFFSET, pack, read_digests, read_ids, unpack, write_ids
from odsflow.llm import packed

from .test_tokens import library_ids


def round_trip(values):
    values = np.array(values, dtype=np.uint64)
    words, offsets = pack(values)
    assert unpack(words, offsets, len(values)).tolist() == values.tolist()
    return words, offsets


@pytest.mark.parametrize("n", [0, 1, 2, 239, 240, 241, IDS_PER_OFFSET - 1, IDS_PER_OFFSET, IDS_PER_OFFSET + 1, 3000])
@pytest.mark.parametrize("high", [1, 2, 50, 50_000, 1 << 30, (1 << 30) + 5, 1 << 63])
def test_round_trips(n, high):
    round_trip(np.random.default_rng(n).integers(0, high, n, dtype=np.uint64))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 1 << 16), st.integers(0, (1 << 64) - 1)), max_size=400))
def test_round_trips_of_any_values(values):
    round_trip(values)


def test_words_hold_what_their_selector_says():
    assert len(round_trip([0] * 240)[0]) == 1
    assert len(round_trip([1] * 60)[0]) == 1
    assert len(round_trip([32767] * 4)[0]) == 1
    assert len(round_trip([(1 << 64) - 1])[0]) == 2  # the escape and its value


def test_a_short_last_word_is_the_fullest_too():
    assert len(round_trip([1 << 29, *[0] * 50])[0]) == 2


def test_each_offset_decodes_alone():
    values = np.random.default_rng(4).integers(0, 50_000, 5 * IDS_PER_OFFSET + 9, dtype=np.uint64)
    words, offsets = pack(values)
    for i, start in enumerate(offsets.tolist()):
        stop = offsets[i + 1] if i + 1 < len(offsets) else len(words)
        own = values[i * IDS_PER_OFFSET:(i + 1) * IDS_PER_OFFSET]
        assert unpack(words[start:stop], np.zeros(1, dtype=np.int64), len(own)).tolist() == own.tolist()


def expected_ids(rows, end=2):
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode()))
    found, start = [], 0
    for doc_id, text, *_ in ordered:
        ids = library_ids("word_bpe_49k.json", text or "") + [end]
        found.append((doc_id, start, ids))
        start += len(ids)
    return found


@pytest.mark.parametrize("per_block", [1 << 18, 300])
def test_files_hold_all_documents_in_order(spark, docs, rows, tmp_path, monkeypatch, per_block):
    monkeypatch.setattr(packed, "IDS_PER_BLOCK", per_block)
    path = str(tmp_path / "ids")
    write_ids(docs, path)
    expected = expected_ids(rows)
    read = sorted(read_ids(spark, path).collect(), key=lambda r: r["start"])
    assert [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in read] == expected
    digests = sorted(read_digests(spark, path).collect(), key=lambda r: r["start"])
    crcs = [(i, s, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, s, ids in expected]
    assert [tuple(r) for r in digests] == crcs


def test_each_different_chunk_is_encoded_once_for_all_texts(monkeypatch):
    texts = ["The cat, the HAT.", "", "the cat, the\x0bhat. \n", "x<|endoftext|>y Kelvin ÀÉ×÷ª", "  ", "日本 the cat, x<|endoftext|>y", "'s don't 12"]
    encode, asked = packed.encoder("word_bpe_49k.json"), []
    plain = encode._chunks
    monkeypatch.setattr(encode, "_chunks", lambda chunks: asked.extend(chunks) or plain(chunks))
    for some in (texts, texts[:3], [""], []):
        asked.clear()
        ids, counts = encode.many(pa.array(some, pa.string()))
        assert [part.tolist() for part in np.split(ids, np.cumsum(counts))[:-1]] == [library_ids("word_bpe_49k.json", t) for t in some]
        assert sorted(asked) == sorted({c for t in some for c in t.split()})


def test_no_documents_no_blocks(spark, no_docs, tmp_path):
    write_ids(no_docs, str(tmp_path / "ids"))
    assert spark.read.schema(BLOCK).parquet(str(tmp_path / "ids")).count() == 0
    assert read_digests(spark, str(tmp_path / "ids")).collect() == []
