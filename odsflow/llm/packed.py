"""Token ids as word-aligned Simple-8b blocks in files."""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from odsflow.llm.common import in_chunks, named, remembered, utf8
from odsflow.llm.ngrams import Words
from odsflow.llm.tokens import Remembered, byte_symbols, load_tokenizer, tokenizer_path

# --- the word code ---------------------------------------------------------------------------

#: Values per 64-bit word and bits per value, by selector (fixed values of the code). Selector 15 is
#: the escape: the word's low bits say nothing, the next word is one value of up to 64 bits.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 64], dtype=np.int64)
ESCAPE, ESCAPE_MARK = 15, np.uint64(15 << 60)
#: Ids from one word offset to the next; a block of ids is decoded from any of them.
IDS_PER_OFFSET = 1024


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values as 64-bit words, and the word offset of every IDS_PER_OFFSET-th value.

    Each word takes as many of the next values as some selector fits, the fullest first; a word
    never spans an offset, so the values behind each offset decode alone. Values of over 30 bits
    are escaped. Short last words are padded with zeros that the known number of values cuts off.
    """
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    chunks = -(-n // IDS_PER_OFFSET)
    if not n:
        return np.zeros(0, dtype="<u8"), np.zeros(0, dtype="<i8")
    here = np.arange(n, dtype=np.int32)
    ends = np.minimum((here // IDS_PER_OFFSET + 1) * IDS_PER_OFFSET, n).astype(np.int32)
    choice = _fullest(values, chunks)
    step = np.minimum(here + COUNTS[choice].astype(np.int32), ends)
    first, at = np.zeros(n, dtype=bool), here[::IDS_PER_OFFSET]
    while len(at):  # the words of all stretches between offsets, side by side
        first[at] = True
        following = step[at]
        at = following[following < ends[at]]
    starts = np.flatnonzero(first)
    selectors = choice[starts].astype(np.int64)
    size = np.where(selectors == ESCAPE, 2, 1)
    places = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), dtype="<u8")
    for selector in np.unique(selectors).tolist():
        mine = selectors == selector
        first, place = starts[mine], places[mine]
        if selector == ESCAPE:
            words[place], words[place + 1] = ESCAPE_MARK, values[first]
            continue
        word = np.full(len(first), selector << 60, dtype=np.uint64)
        if WIDTHS[selector]:
            for i in range(int(COUNTS[selector])):
                inside = first + i < ends[first]
                value = np.where(inside, values[np.minimum(first + i, n - 1)], np.uint64(0))
                word |= value << np.uint64(i * int(WIDTHS[selector]))
        words[place] = word
    offsets = places[np.searchsorted(starts, np.arange(chunks) * IDS_PER_OFFSET)]
    return words, offsets.astype("<i8")


def _fullest(values: np.ndarray, chunks: int) -> np.ndarray:
    """The fullest selector for a word that starts at each value: the one of most values whose largest still fits.

    The values between two offsets are a row with zeros behind it, as short last words are padded with them.
    """
    n, most = len(values), int(COUNTS[0])
    kind = np.uint32 if values.max() < 1 << 32 else np.uint64
    rows = np.zeros((chunks, IDS_PER_OFFSET + most), kind)
    whole = n // IDS_PER_OFFSET
    rows[:whole, :IDS_PER_OFFSET] = values[:whole * IDS_PER_OFFSET].reshape(whole, IDS_PER_OFFSET)
    rows[whole:, :n % IDS_PER_OFFSET] = values[whole * IDS_PER_OFFSET:]
    choice = np.full((chunks, IDS_PER_OFFSET), ESCAPE, dtype=np.int8)
    top, span = rows, 1  # the largest of the `span` values from each place on
    for selector in range(ESCAPE - 1, -1, -1):  # the fullest that fits is set last
        count = int(COUNTS[selector])
        while 2 * span <= count:
            top, span = np.maximum(top[:, :-span], top[:, span:]), 2 * span
        largest = np.maximum(top[:, :IDS_PER_OFFSET], top[:, count - span:count - span + IDS_PER_OFFSET])
        fits = largest < kind(1 << int(WIDTHS[selector]))
        if not fits.any():
            break  # a fuller selector takes more values of fewer bits
        choice[fits] = selector
    return choice.ravel()[:n]


def unpack(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The n values of packed words; all words of a selector are decoded at once."""
    if not n:
        return np.zeros(0, dtype=np.uint64)
    words = np.ascontiguousarray(words, dtype=np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    raw = _escaped(selectors)
    heads = np.flatnonzero(~raw)
    kinds = selectors[heads]
    ends = np.minimum((np.arange(len(offsets)) + 1) * IDS_PER_OFFSET, n)
    chunk = np.searchsorted(offsets, heads, side="right") - 1
    room = np.cumsum(COUNTS[kinds]) - COUNTS[kinds]
    first_of_chunk = np.searchsorted(heads, offsets)
    starts = chunk * IDS_PER_OFFSET + room - room[first_of_chunk[chunk]]
    out = np.zeros(n, dtype=np.uint64)
    for selector in np.unique(kinds).tolist():
        mine = kinds == selector
        at, end = starts[mine], ends[chunk[mine]]
        if selector == ESCAPE:
            out[at] = words[heads[mine] + 1]
            continue
        width = int(WIDTHS[selector])
        if not width:
            continue
        shifts = np.arange(int(COUNTS[selector]), dtype=np.uint64) * np.uint64(width)
        values = (words[heads[mine]][:, None] >> shifts) & np.uint64((1 << width) - 1)
        places = at[:, None] + np.arange(int(COUNTS[selector]))
        inside = places < end[:, None]
        out[places[inside]] = values[inside]
    return out


def _escaped(selectors: np.ndarray) -> np.ndarray:
    """Which words are the raw values behind an escape (a raw value may look like an escape itself)."""
    raw = np.zeros(len(selectors), dtype=bool)
    for at in np.flatnonzero(selectors == ESCAPE).tolist():
        if not raw[at]:
            raw[at + 1] = True
    return raw


# --- token ids -------------------------------------------------------------------------------

#: Characters for which the quick path splits and lower-cases as the library does; other chunks go to the library.
PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
#: The vocabulary's published pre-token pattern, for those characters (fixed value).
PRE_TOKENS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
#: Pre-tokens whose ids one worker remembers per generation, and bytes of text whose ids are found together.
PARTS_REMEMBERED, CHUNK = 100_000, 1 << 22


class WordIds:
    """Ids of a text as little-endian 32-bit bytes, each pre-token's worked out once while it is remembered.

    The vocabulary's normaliser and pattern never join what white space parts. So texts are cut at white space, and the
    library encodes just the chunks with odd characters or the text of an added token as a whole.
    """

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.symbols = byte_symbols()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.parts, self.odd = Remembered(self._part, PARTS_REMEMBERED), Remembered(self._whole_chunk, PARTS_REMEMBERED)

    def _part(self, part: str) -> bytes:
        symbols = part if part.isascii() else "".join([self.symbols[b] for b in part.encode()])  # printable ASCII stands for itself
        return array("I", [t.id for t in self.tokenizer.model.tokenize(symbols)]).tobytes()

    def _whole_chunk(self, chunk: str) -> bytes:
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def _plain(self, text: str) -> bool:
        return PLAIN.fullmatch(text) is not None and not any(a in text for a in self.added)

    def _plain_chunks(self, lower: list[str]) -> list[bytes]:
        parts, cut = self.parts, PRE_TOKENS.findall
        return [parts[c] if c.isalpha() else b"".join([parts[p] for p in cut(c)]) for c in lower]  # letters alone are one pre-token

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of some chunks without white space."""
        whole = "\n".join(chunks)
        if chunks and self._plain(whole):
            return self._plain_chunks(whole.lower().split("\n"))
        plain = iter(self._plain_chunks([c.lower() for c in chunks if self._plain(c)]))
        return [next(plain) if self._plain(c) else self.odd[c] for c in chunks]

    def ids(self, text: bytes) -> bytes:
        return b"".join(self._chunks([c.decode() for c in text.split()]))

    def many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (strings), one behind the other, and how many each has; each different chunk is worked out once."""
        words = Words(texts)
        found = self._chunks(words.each.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        each, starts = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
        n = sizes[words.which]
        ends = np.cumsum(n)
        ids = each[np.repeat(starts[words.which] - ends + n, n) + np.arange(n.sum())]
        return ids, np.diff(np.append(0, ends)[np.append(0, np.cumsum(words.sizes))])


@remembered(2)
def _quick(path: str) -> WordIds:
    return WordIds(path)


class WholeTextIds:
    """Ids of any tokenizer of the library, text by text."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)

    def ids(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, dtype="<u4").tobytes()

    def many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (strings), one behind the other, and how many each has."""
        found = [self.ids(t) for t in texts.cast(pa.binary()).to_numpy(zero_copy_only=False)]
        return np.frombuffer(b"".join(found), "<u4"), np.array([len(f) // 4 for f in found], np.int64)


def encoder(name: str):
    """The encoder of a vocabulary: by chunks where its file says that white space parts all tokens."""
    path = tokenizer_path(name)
    return _quick(path) if _parted_by_space(path) else WholeTextIds(path)


@lru_cache(maxsize=4)
def _parted_by_space(path: str) -> bool:
    """True for the normaliser and pattern that `WordIds` is written for."""
    stated = json.loads(load_tokenizer(path).to_str())
    split = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # fixed value
    first = ((stated.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    steps = [n.get("type") for n in (stated.get("normalizer") or {}).get("normalizers") or []]
    return steps == ["NFC", "Replace", "Lowercase"] and first.get("pattern") == {"Regex": split} and first.get("invert") is True


# --- files -----------------------------------------------------------------------------------

#: Ids of a file block: documents are added to a block until it has as many; a longer document has its own.
IDS_PER_BLOCK = 1 << 18
BLOCK = (
    "shard int, block int, local_start long, doc_ids array<long>, counts array<long>, n_ids long, "
    "word_offsets binary, words binary"
)


def _block(shard: int, number: int, start: int, docs: list[tuple[int | None, np.ndarray]]) -> dict:
    ids = np.concatenate([ids for _, ids in docs])
    words, offsets = pack(ids)
    return {
        "shard": shard, "block": number, "local_start": start, "doc_ids": [d for d, _ in docs],
        "counts": [len(ids) for _, ids in docs], "n_ids": len(ids),
        "word_offsets": offsets.tobytes(), "words": words.astype("<u8").tobytes(),
    }


def _block_schema() -> pa.Schema:
    return pa.schema([
        ("shard", pa.int32()), ("block", pa.int32()), ("local_start", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("word_offsets", pa.binary()), ("words", pa.binary()),
    ])


def packer(tokenizer: str, end_id: int):
    """For mapInArrow over (shard, doc_id, body) in id order: tokenises and packs, a block at a time."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, schema = encoder(tokenizer).many, _block_schema()
        docs, size, start, number, shard = [], 0, 0, 0, 0
        for batch in in_chunks(batches, CHUNK):
            shard = batch.column("shard")[0].as_py()  # a partition is one shard
            ids, counts = encode(batch.column("body").cast(pa.string()))
            ids = np.insert(ids, np.cumsum(counts), end_id)
            parts = np.split(ids, np.cumsum(counts + 1)[:-1])
            for doc_id, part in zip(batch.column("doc_id").to_pylist(), parts):
                if docs and size + len(part) > IDS_PER_BLOCK:
                    yield pa.RecordBatch.from_pylist([_block(shard, number, start, docs)], schema)
                    docs, size, start, number = [], 0, start + size, number + 1
                docs.append((doc_id, part))
                size += len(part)
        if docs:
            yield pa.RecordBatch.from_pylist([_block(shard, number, start, docs)], schema)

    return blocks


def write_ids(
    docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json", end_id: int = 2,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Writes the token ids of all texts, each followed by `end_id`, in ascending doc_id order.

    The files at `path` are Parquet containers of packed blocks: shards are ranges of doc_id, each
    block holds whole documents with their ids and counts, the Simple-8b words and a word offset for
    every IDS_PER_OFFSET ids. Spark's commit protocol makes them complete or absent. A NULL text is
    empty (the end id alone); NULL doc_ids come last; equal doc_ids stand together, the smaller text
    first, so a rerun writes the same order. Other columns are ignored; no rows, no blocks.
    """
    ordered = docs.select(named(id_col).cast("long").alias("doc_id"), utf8(named(text_col)).alias("body"))
    by_id = [F.col("doc_id").asc_nulls_last(), F.col("body").asc()]
    # rows of one id, or without one, are dealt by the beginning of their text, in the order they are written in
    spread = ordered.repartitionByRange(F.isnull("doc_id"), "doc_id", F.substring("body", 1, 64)).sortWithinPartitions(*by_id)
    sharded = spread.select(F.spark_partition_id().alias("shard"), "doc_id", "body")
    sharded.mapInArrow(packer(tokenizer, end_id), BLOCK).write.parquet(path)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            shard, start, doc_ids, counts, n, offsets, words = (
                batch.column(k)[row].as_py()
                for k in ("shard", "local_start", "doc_ids", "counts", "n_ids", "word_offsets", "words")
            )
            ids = unpack(np.frombuffer(words, "<u8"), np.frombuffer(offsets, "<i8"), n).astype("<u4")
            ends = np.cumsum(counts)
            starts = ends - counts
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * len(doc_ids), pa.int32()), pa.array(doc_ids, pa.int64()), pa.array(start + starts, pa.int64()),
                 pa.array([ids[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())], pa.binary())],
                names=["shard", "doc_id", "local_start", "ids"],
            )


def shard_starts(blocks: DataFrame) -> DataFrame:
    """The ids before each shard: one row per shard, from the block headers alone."""
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("shard_start"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document in files of `write_ids`; ids as little-endian 32-bit bytes."""
    blocks = spark.read.schema(BLOCK).parquet(path)
    decoded = blocks.mapInArrow(_decoded, "shard int, doc_id long, local_start long, ids binary")
    return decoded.join(shard_starts(blocks), "shard").select(
        "doc_id", (F.col("shard_start") + F.col("local_start")).alias("start"), "ids"
    )


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and CRC-32 of each document's ids."""
    for batch in _decoded(batches):
        ids = [v.as_py() for v in batch.column("ids")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("shard"), batch.column("doc_id"), batch.column("local_start"),
             pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([zlib.crc32(i) for i in ids], pa.int64())],
            names=["shard", "doc_id", "local_start", "n_tokens", "ids_crc32"],
        )


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files read back."""
    blocks = spark.read.schema(BLOCK).parquet(path)
    read = blocks.mapInArrow(digests, "shard int, doc_id long, local_start long, n_tokens long, ids_crc32 long")
    return read.join(shard_starts(blocks), "shard").select(
        "doc_id", (F.col("shard_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )
