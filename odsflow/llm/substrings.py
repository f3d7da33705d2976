"""Removal of passages that an earlier document has, by relative Lempel-Ziv factors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from odsflow.llm.common import group_starts, same_row, text_rows
from odsflow.llm.windows import WordUnits, covered_units, piece_groups, repeated_spans

WINDOW, GRAM = 50, 16


class Reference:
    """One indexed reference block: where each window of its pieces stands first."""

    def __init__(self, window: int):
        self.window = window
        self.pieces: list[list[bytes]] = []
        self.places: dict[bytes, tuple[int, int]] = {}

    def window_key(self, words: list[bytes], at: int) -> bytes:
        return xxhash.xxh3_128_digest(b" ".join(words[at:at + self.window]))

    def add(self, words: list[bytes]) -> None:
        number = len(self.pieces)
        self.pieces.append(words)
        for at in range(len(words) - self.window + 1):
            self.places.setdefault(self.window_key(words, at), (number, at))

    def longest(self, words: list[bytes], at: int) -> int:
        """Words of the factor that begins at `at`: those that run along with the window's first place; 0 for none."""
        place = self.places.get(self.window_key(words, at))
        if place is None:
            return 0
        source, j = self.pieces[place[0]], place[1]
        n = 0
        while at + n < len(words) and j + n < len(source) and words[at + n] == source[j + n]:
            n += 1
        return n if n >= self.window else 0


def factors(words: list[bytes], reference: Reference) -> Iterator[tuple[int, int]]:
    """Greedy factors (start, words) of at least a window.

    A factor settles the windows inside it. The next try is the first window across its end, so
    windows at factor boundaries, which no single factor holds, are checked one by one.
    """
    at = 0
    while at + reference.window <= len(words):
        n = reference.longest(words, at)
        if n:
            yield at, n
        at += max(1, n - reference.window + 1)


def parse_block(window: int):
    """For mapInArrow over pieces sorted by rank within (anchor, part, other): the windows that pieces of smaller rank have."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in piece_groups(batches):
            anchors, digests, ranks = (batch.column(k).to_numpy() for k in ("anchor", "digest", "rank"))
            parts, others = (batch.column(k).to_numpy() for k in ("part", "other"))
            starts = group_starts(anchors, parts, others).tolist()
            out: list[tuple[int, int, int, int]] = []
            pieces = batch.column("piece")
            for start, end in zip(starts, [*starts[1:], batch.num_rows]):
                reference, waiting, seen = Reference(window), [], set()
                for i in range(start, end):
                    if digests[i] in seen:
                        continue
                    seen.add(digests[i])
                    if waiting and ranks[waiting[-1][0]] < ranks[i]:
                        for _, words in waiting:
                            reference.add(words)
                        waiting = []
                    words = pieces[i].as_py().split(b" ")
                    out += [(anchors[i], digests[i], at, n - window + 1) for at, n in factors(words, reference)]
                    waiting.append((i, words))
            columns = list(zip(*out)) if out else [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(c, dtype=np.int64)).cast(k) for c, k in zip(columns, kinds)], names=["anchor", "digest", "at", "n"]
            )

    return parse


KEPT = "doc_id long, text_key long, n_words long, n_removed long, kept binary"


def keep_words(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = []
            for body, spans in zip(batch.column("body"), batch.column("spans")):
                words = body.as_py().split()
                gone = covered_units(spans.as_py(), len(words), window)
                kept = b" ".join([words[i] for i in np.flatnonzero(~gone)]) if gone.any() else b" ".join(words)
                columns.append((len(words), int(gone.sum()), kept))
            made = list(zip(*columns)) if columns else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(made[0], pa.int64()), pa.array(made[1], pa.int64()),
                 pa.array(made[2], pa.binary())], names=["doc_id", "text_key", "n_words", "n_removed", "kept"],
            )

    return rows


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, n_words, n_removed, kept) of every row.

    `kept` holds, as bytes, the words outside every window of `window` words that also starts in a
    document with a smaller id, joined by one space; windows are judged on the input. NULL and
    wordless texts keep nothing. A NULL id counts as greater than all others, and equal ids are
    not earlier than each other, so repeated rows keep their words. Other columns are ignored; an
    empty table gives no rows.
    """
    texts = text_rows(docs, id_col, text_col)
    spans = repeated_spans(texts, WordUnits, window, GRAM, parse_block(window), earlier_only=True)
    joined = texts.join(spans, same_row(texts, spans), "left").select(texts["doc_id"], texts["text_key"], "body", "spans")
    return joined.mapInArrow(keep_words(window), KEPT)

