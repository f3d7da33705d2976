"""Removal of byte strings that stand more than once, by merged Burrows-Wheeler transforms."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from odsflow.llm.common import group_starts, same_row, text_rows
from odsflow.llm.windows import ByteUnits, covered_units, piece_groups, repeated_spans

WINDOW, GRAM = 200, 32
#: Bytes of the pieces that make one shard, and of the shards merged at once.
SHARD, MERGED = 1 << 16, 1 << 18


class Shard:
    """The Burrows-Wheeler transform of some pieces, each ended by a mark below all bytes.

    `bwt[r]` is the symbol before the r-th rotation (0 for the mark, else byte + 1); `back[r]` is
    the row of the rotation one symbol longer. `piece[r]` and `at[r]` say where row r begins.
    """

    def __init__(self, pieces: list[bytes], numbers: list[int]):
        lengths = np.array([len(p) + 1 for p in pieces])
        text = np.zeros(int(lengths.sum()), dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        joined = np.frombuffer(b"\0".join(pieces) + b"\0", dtype=np.uint8)
        text[:] = joined
        text += 1
        text[starts + lengths - 1] = 0
        self.piece = np.repeat(np.array(numbers), lengths)
        self.at = np.arange(len(text)) - np.repeat(starts, lengths)
        after, before = np.arange(1, len(text) + 1), np.arange(-1, len(text) - 1)
        after[starts + lengths - 1], before[starts] = starts, starts + lengths - 1
        order = self._sorted_rotations(text, after, int(lengths.max()))
        self.bwt = text.take(before.take(order)).astype(np.int16)
        self.piece, self.at = self.piece[order], self.at[order]
        # The k-th row with some symbol before it comes back as the k-th row that begins with that symbol.
        self.back = np.empty(len(order), dtype=np.int64)
        self.back[np.argsort(self.bwt, kind="stable")] = np.arange(len(order))

    @staticmethod
    def _sorted_rotations(text: np.ndarray, after: np.ndarray, longest: int) -> np.ndarray:
        """Positions by the rotation of their piece, by doubling the length that ranks tell apart; those alone in their block are in place.

        `after` is the position behind each one in its piece, where the mark comes before the first.
        """
        keys, size = text, 1
        while size < 4:
            keys = keys * 257**size + keys.take(after)
            after, size = after.take(after), 2 * size
        order, ranks = np.empty(len(text), dtype=np.int64), np.empty(len(text), dtype=np.int64)
        rows = slots = np.arange(len(text))
        while True:
            deal, border = in_blocks(keys)
            rows = rows[deal]
            order[slots] = rows
            firsts = np.flatnonzero(border[:-1])
            ranks[rows] = np.repeat(slots[firsts], np.diff(np.append(firsts, len(rows))))
            together = ~(border[:-1] & border[1:])
            rows, slots = rows[together], slots[together]
            if size >= longest or not len(rows):
                return order
            keys = ranks.take(rows) * len(text) + ranks.take(after.take(rows))
            after, size = after.take(after), 2 * size


def in_blocks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of some keys (0 or above), stable, and whether a new key begins at each place of that order (and at its end)."""
    n = len(keys)
    low = max(1, (n - 1).bit_length())
    if n and int(keys.max()) < 1 << (63 - low):  # key and place in one number, which numpy sorts several times as fast as places by keys
        both = np.sort(keys.astype(np.int64) << low | np.arange(n))
        order, keys = both & ((1 << low) - 1), both >> low
    else:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
    border = np.ones(n + 1, dtype=bool)
    border[1:-1] = keys[1:] != keys[:-1]
    return order, border


def repeated_starts(shards: list[Shard], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece and place of every string of `window` bytes that the shards' pieces have twice or more.

    The shards' transforms are merged by refining their interleave: rows stand in blocks of equal
    prefixes, numbered in sorted order. A row whose prefix of k symbols is followed, k rows back, by
    another prefix of k symbols has the pair of both blocks as its prefix of 2 k symbols, so each
    round doubles what the blocks tell apart (the last one overlaps, to make `window` symbols), and
    a block holds the rows of all shards that agree in that many symbols. No suffix is compared with
    another. Rows alone in their block stay alone and are set aside, with all whose prefix holds
    theirs. Only rows with so many symbols before them in their piece are followed.
    """
    sizes = [len(s.bwt) for s in shards]
    offsets = np.cumsum([0, *sizes[:-1]])
    bwt = np.concatenate([s.bwt for s in shards])
    back = np.concatenate([s.back + o for s, o in zip(shards, offsets.tolist())])
    piece, at = (np.concatenate([getattr(s, k) for s in shards]) for k in ("piece", "at"))
    rest = window - (1 << window.bit_length() - 1)  # what doubling leaves to the last round
    symbols, size = (bwt - 1).astype(np.uint8).astype(np.int64), 1  # of the rows followed, none meets a mark
    power, far = back, np.arange(len(bwt))  # the rows `size` symbols back, and as many of `rest` as `size` has passed
    while size < 4 and 2 * size <= window:
        symbols = symbols.take(power) << 8 * size | symbols
        far = power.take(far) if rest & size else far
        power, size = power.take(power), 2 * size
    rows = np.flatnonzero(at >= size)
    symbols = symbols[rows]
    while True:
        deal, border = in_blocks(symbols)
        together = ~(border[:-1] & border[1:])
        rows = rows[deal[together]]
        if size == window or not len(rows):
            return piece.take(rows), at.take(rows) - window
        block = np.full(len(bwt), -1, dtype=np.int32)
        block[rows] = np.cumsum(border[:-1][together]) - 1
        ahead = (power if 2 * size <= window else far).take(rows)
        both = block.take(ahead) >= 0
        rows, ahead = rows[both], ahead[both]
        symbols = block.take(ahead).astype(np.int64) << len(bwt).bit_length() | block.take(rows)
        if 2 * size <= window:
            far = power.take(far) if rest & size else far
            power, size = power.take(power), 2 * size
        else:
            size = window


def _runs(pieces: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Piece, first place and length of the runs of places next to each other."""
    order = np.lexsort((places, pieces))
    pieces, places = pieces[order], places[order]
    starts = np.ones(len(pieces), dtype=bool)
    starts[1:] = (pieces[1:] != pieces[:-1]) | (places[1:] != places[:-1] + 1)
    firsts = np.flatnonzero(starts)
    return pieces[firsts], places[firsts], np.diff(np.append(firsts, len(pieces)))


def merge_pieces(pieces: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (piece, at, n) of windows that stand twice or more in different pieces."""
    shards, held, size = [], [], 0
    for number, piece in enumerate(pieces):
        held.append(number)
        size += len(piece) + 1
        if size >= SHARD or number == len(pieces) - 1:
            shards.append(Shard([pieces[i] for i in held], held))
            held, size = [], 0
    return _runs(*repeated_starts(shards, window))


def merge_block(window: int):
    """For mapInArrow over pieces sorted by (anchor, part, other): the repeated windows of each cell."""

    def judged(anchors, digests, pieces) -> pa.RecordBatch:
        numbers, at, n = merge_pieces(pieces, window)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(anchors, dtype=np.int64)[numbers]), pa.array(np.array(digests, dtype=np.int64)[numbers]),
             pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))], names=["anchor", "digest", "at", "n"],
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, digests, pieces, seen, size = [], [], [], set(), 0
        for batch in piece_groups(batches):
            columns = [batch.column(k).to_numpy() for k in ("anchor", "part", "other")]
            starts = group_starts(*columns).tolist()
            own_digests = batch.column("digest").to_numpy()
            for start, end in zip(starts, [*starts[1:], batch.num_rows]):
                for i in range(start, end):
                    key = (columns[0][i], own_digests[i])
                    if key not in seen:  # a cell meets itself nowhere
                        seen.add(key)
                        anchors.append(key[0])
                        digests.append(key[1])
                        pieces.append(batch.column("piece")[i].as_py())
                        size += len(pieces[-1])
                if size >= MERGED:
                    yield judged(anchors, digests, pieces)
                    anchors, digests, pieces, seen, size = [], [], [], set(), 0
        if pieces:
            yield judged(anchors, digests, pieces)

    return merge


KEPT = "doc_id long, text_key long, n_bytes long, n_removed long, n_spans long, kept binary"


def keep_bytes(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for body, spans in zip(batch.column("body"), batch.column("spans")):
                text, spans = body.as_py(), spans.as_py()
                if not spans:
                    made.append((len(text), 0, 0, text))
                    continue
                gone = covered_units(spans, len(text), window)
                kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
                made.append((len(text), int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()), kept))
            columns = list(zip(*made)) if made else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), *[pa.array(c, pa.int64()) for c in columns[:3]],
                 pa.array(columns[3], pa.binary())], names=["doc_id", "text_key", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return rows


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, n_bytes, n_removed, n_spans, kept) of every row.

    `kept` holds the bytes outside every string of `window` bytes that also starts anywhere else, in
    another row or in the same one; `n_spans` counts the runs taken out. Strings are judged on the
    input and never cross rows. NULL is the empty text. Repeated rows are rows like any other, so
    copies of `window` bytes or more lose all of them. Other columns are ignored; an empty table
    gives no rows.
    """
    texts = text_rows(docs, id_col, text_col)
    spans = repeated_spans(texts, ByteUnits, window, GRAM, merge_block(window), earlier_only=False)
    joined = texts.join(spans, same_row(texts, spans), "left").select(texts["doc_id"], texts["text_key"], "body", "spans")
    return joined.mapInArrow(keep_bytes(window), KEPT)
