"""N-gram models of each language over code points, in tables that grow with the input, and texts' scores under them.

There are two models a language, both of ORDER code points. ACROSS runs over whole lines, words joined by a blank, letters of any script
without case. WITHIN sees each word by itself, between blanks, in an alphabet of 32 signs. A model's rows are (slot, gram, log0, log1), the
slot being model and language. Frequent rows, at most 1 / FREQUENT, go to every task as sorted hash arrays; the others stay in
hash partitions, where they are sorted hash arrays too, and texts' rarer n-grams are sent to them.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from odsflow.llm.common import group_starts, written

#: Code points in the longest n-grams.
ORDER = 5
#: Texts are dealt to two folds by their hash; across words each is scored under the counts of the other fold, so no text
#: (nor a copy of it) vouches for itself.
FOLDS = 2
ACROSS, WITHIN = "a", "w"
#: Rows with at least this share of all counted n-grams are frequent: at most 10 million, 160 MB.
FREQUENT = 1e-7
#: Bytes of text whose n-grams are found together, and counted n-grams a task holds before it sends them on.
CHUNK, HELD = 1 << 20, 1 << 20
#: Rows of the model in one hash partition, about.
PART = 400_000
#: A text's row number is its scan task's number above this many bits, and its place in the task.
ROW_BITS = 40
#: What rarer n-grams add to a text's sums.
MORE = ("more_across", "more_within")


# --- signs -------------------------------------------------------------------------------------

@lru_cache(maxsize=1 << 16)
def folded(code: int) -> int:
    """Letters of any script without case, digits as 0, sentence marks as a full stop, other ASCII signs as #; the rest as it is."""
    char = chr(code)
    if char.isalpha():
        return ord(char.lower()[0])
    if char.isdigit():
        return ord("0")
    if char in ".,;:!?'\"()-":
        return ord(".")
    return ord("#") if "!" <= char <= "~" else code


@lru_cache(maxsize=1 << 16)
def symbol(code: int) -> int:
    """One of 32 signs: blank, a-z without accents, 0, a full stop, other ASCII signs as #, letters of other scripts as @, the rest as ~."""
    char = chr(code)
    if char == " ":
        return code
    base = unicodedata.normalize("NFKD", char)[0].lower()
    if "a" <= base <= "z":
        return ord(base)
    if char.isdigit():
        return ord("0")
    if char in ".,;:!?'\"()-":
        return ord(".")
    if char < "\x7f":
        return ord("#")
    return ord("@" if char.isalpha() else "~")


SIGNS = {ACROSS: folded, WITHIN: symbol}


# --- words and n-grams of some texts -------------------------------------------------------------

class Words:
    """The words of some texts: `each` (different ones), `which` (the number of each word in a row), `sizes` (words of each text)."""

    def __init__(self, bodies: pa.Array):
        split = pc.ascii_split_whitespace(bodies)
        words = pc.list_flatten(split)
        there = pc.not_equal(words, "")
        text = pc.list_parent_indices(split).filter(there).to_numpy()
        found = words.filter(there).dictionary_encode()
        self.each, self.which = found.dictionary, found.indices.to_numpy()
        self.sizes = np.bincount(text, minlength=len(bodies))
        self.text = np.repeat(np.arange(len(bodies)), self.sizes)

    def lines(self) -> pa.Array:
        """Each text's words, joined by one blank, with blanks for the first context and one behind; a text without words is empty."""
        offsets = pa.array(np.append(0, np.cumsum(self.sizes)).astype(np.int32))
        joined = pc.binary_join(pa.ListArray.from_arrays(offsets, self.each.take(pa.array(self.which))), " ")
        return pc.if_else(pa.array(self.sizes > 0), pc.binary_join_element_wise(" " * (ORDER - 1), joined, " ", ""), "")


def word_lines(words: pa.Array) -> pa.Array:
    """Each word as a line of its own."""
    return pc.binary_join_element_wise(" " * (ORDER - 1), words, " ", "")


class Grams:
    """The different n-grams of some lines: `codes` (rows of code points), `which` (the number of each gram in a row), `counts` (grams of each line)."""

    def __init__(self, lines: pa.Array, sign: Callable[[int], int]):
        text = b"".join(lines.cast(pa.binary()).to_pylist()).decode()
        codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        sizes = pc.utf8_length(lines).to_numpy().astype(np.int64)
        self.counts = np.maximum(sizes - ORDER + 1, 0)
        self.codes, self.which = np.zeros((0, ORDER), np.uint32), np.zeros(0, np.int64)
        if len(codes) < ORDER:
            return
        top = int(codes.max()) + 1
        seen = np.zeros(top, dtype=bool)
        seen[codes] = True
        each = np.flatnonzero(seen)
        signs, dense_of = np.unique([sign(c) for c in each.tolist()], return_inverse=True)
        to = np.zeros(top, dtype=np.int64)
        to[each] = dense_of
        bits = max(1, int(len(signs) - 1).bit_length())
        dense = to.astype(np.int32 if ORDER * bits < 32 else np.int64)[codes]  # half the memory for all but the largest alphabets
        inside = np.ones(len(codes) - ORDER + 1, dtype=bool)
        ends = np.cumsum(sizes)[:-1]
        for back in range(1, ORDER):  # windows that reach from one line into the next
            at = ends - back
            inside[at[(at >= 0) & (at < len(inside))]] = False
        number, width = dense[:len(inside)], bits
        for i in range(1, ORDER):
            if width + bits > 62:
                number = pa.array(number).dictionary_encode().indices.to_numpy().astype(np.int64)
                width = max(1, int(number.max()).bit_length())
            number, width = number << bits | dense[i:i + len(inside)], width + bits
        at = np.flatnonzero(inside)
        found = pa.array(number[at]).dictionary_encode()
        self.which = found.indices.to_numpy()
        first = np.zeros(len(found.dictionary), dtype=np.int64)
        first[self.which] = at
        self.codes = signs.astype(np.uint32)[dense[first[:, None] + np.arange(ORDER)]]

    def line(self) -> np.ndarray:
        """The line of each gram in a row."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def strings(codes: np.ndarray) -> pa.Array:
    """Rows of code points as strings."""
    width = 1 + (codes >= 0x80).astype(np.int32) + (codes >= 0x800) + (codes >= 0x10000)
    offsets = np.append(0, np.cumsum(width.sum(axis=1))).astype(np.int32)
    body = np.ascontiguousarray(codes, "<u4").tobytes().decode("utf-32-le").encode()
    return pa.StringArray.from_buffers(len(codes), pa.py_buffer(offsets), pa.py_buffer(body))


def code_rows(grams: pa.Array) -> np.ndarray:
    """Strings of ORDER code points as rows of them."""
    return np.frombuffer("".join(grams.to_pylist()).encode("utf-32-le"), "<u4").reshape(-1, ORDER)


def by_language(batches: Iterator[pa.RecordBatch], most: int = CHUNK) -> Iterator[tuple[str, pa.RecordBatch]]:
    """The rows of each batch by their `lang`, in groups of some MB of text."""
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        numbers = langs.indices.to_numpy()
        sizes = pc.binary_length(batch.column("body")).to_numpy()
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            rows = np.flatnonzero(numbers == i)
            group = np.cumsum(sizes[rows]) // most
            for at in np.split(rows, np.flatnonzero(np.diff(group)) + 1):
                yield lang, batch.take(pa.array(at))


# --- counts ------------------------------------------------------------------------------------

COUNTED = "slot string, gram string, c0 long, c1 long"


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slot, gram, c0, c1): how often a task's texts of either fold have each n-gram; the same gram can come in several rows."""
    held: list[pa.Table] = []

    def folded_up() -> pa.Table:
        whole = pa.concat_tables(held).group_by(["slot", "gram"]).aggregate([("c0", "sum"), ("c1", "sum")])
        return whole.select(["slot", "gram", "c0_sum", "c1_sum"]).rename_columns(["slot", "gram", "c0", "c1"])

    for lang, batch in by_language(batches):
        words, fold = Words(batch.column("body")), batch.column("fold").to_numpy()
        across = Grams(words.lines(), folded)
        within = Grams(word_lines(words.each), symbol)
        weights = [np.bincount(words.which[fold[words.text] == f], minlength=len(words.each)) for f in range(FOLDS)]
        for model, found, of_fold in (
            (ACROSS, across, [np.bincount(across.which[fold[across.line()] == f], minlength=len(across.codes)) for f in range(FOLDS)]),
            (WITHIN, within, [np.bincount(within.which, w[within.line()], len(within.codes)) for w in weights]),
        ):
            held.append(pa.table({
                "slot": pa.array([model + lang], pa.string()).take(pa.array(np.zeros(len(found.codes), np.int32))), "gram": strings(found.codes),
                **{f"c{f}": pa.array(n.astype(np.int64)) for f, n in enumerate(of_fold)},
            }))
        if sum(map(len, held)) > HELD:
            held = [folded_up()]
            if len(held[0]) > HELD // 2:
                yield from held[0].to_batches()
                held = []
    if held:
        yield from folded_up().to_batches()


# --- sorted hash arrays ------------------------------------------------------------------------

def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def slot_seed(slot: str) -> np.uint64:
    seed = np.array([len(slot)], np.uint64)
    for code in slot.encode():
        seed = _mixed(seed + np.uint64(code + 1))
    return seed[0]


def hashes(codes: np.ndarray, seeds) -> np.ndarray:
    """64-bit keys of rows of code points, with the seed of their slot."""
    keys = np.zeros(len(codes), np.uint64) + np.uint64(seeds) if np.isscalar(seeds) else seeds.astype(np.uint64)
    for i in range(codes.shape[1]):
        keys = _mixed(keys + codes[:, i].astype(np.uint64) + np.uint64(1))
    return keys


def table_hashes(rows: pa.Table) -> np.ndarray:
    """The keys of rows with slot and gram."""
    slots = rows.column("slot").combine_chunks().dictionary_encode()
    seeds = np.array([slot_seed(s) for s in slots.dictionary.to_pylist()], np.uint64)
    return hashes(code_rows(rows.column("gram").combine_chunks()), seeds[slots.indices.to_numpy()])


def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the model as (key, log0, log1), the key as Spark's long."""
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if len(rows):
            yield pa.RecordBatch.from_arrays(
                [pa.array(table_hashes(rows).view(np.int64)), *[rows.column(f"log{f}").cast(pa.float32()).combine_chunks() for f in range(FOLDS)]],
                names=["key", "log0", "log1"],
            )


def frequent_arrays(model: DataFrame, counted: DataFrame) -> HashArrays:
    """The model's rows of the frequent n-grams, on the driver: at most 1 / FREQUENT rows of 16 bytes."""
    total = counted.agg(F.coalesce(F.sum(F.col("c0") + F.col("c1")), F.lit(0))).first()[0]
    often = counted.where(F.col("c0") + F.col("c1") >= FREQUENT * total).select("slot", "gram")
    rows = model.join(often, ["slot", "gram"], "left_semi").mapInArrow(keyed, "key long, log0 float, log1 float").toArrow()
    return HashArrays(rows.column("key").to_numpy().view(np.uint64), [rows.column(f"log{f}").to_numpy() for f in range(FOLDS)])


class HashArrays:
    """Rows of the model in arrays sorted by key."""

    def __init__(self, keys: np.ndarray, logs: list[np.ndarray]):
        order = np.argsort(keys)
        self.keys, self.logs = keys[order], [log[order].astype(np.float32) for log in logs]

    @classmethod
    def of(cls, rows: pa.Table) -> HashArrays:
        return cls(table_hashes(rows), [rows.column(f"log{f}").to_numpy() for f in range(FOLDS)])

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each key is, and whether it is there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys


def scored(found: Grams, slot: str, arrays: HashArrays) -> tuple[list[np.ndarray], np.ndarray]:
    """Of each different gram the logarithm by either fold's texts (0 where the arrays lack it), and whether they lack it."""
    at, there = arrays.find(hashes(found.codes, slot_seed(slot)))
    logs = [np.where(there, log[at].astype(np.float64) if len(log) else 0.0, 0.0) for log in arrays.logs]
    return logs, ~there


def look_up(rows: pa.Table, model: pa.Table) -> pa.Table:
    """The sums of n * log of a hash partition's rarer n-grams, by row of the texts and model, packed by scan task."""
    arrays = HashArrays.of(model)
    at, there = arrays.find(table_hashes(rows))
    if not there.all():
        raise ValueError("an n-gram is in no row of the model")
    fold = rows.column("fold").to_numpy()
    logs = np.where(fold == 0, *[log[at] for log in arrays.logs]) if len(at) else np.zeros(0)
    across = pc.starts_with(rows.column("slot"), ACROSS).to_numpy()
    weighed = logs.astype(np.float64) * rows.column("n").to_numpy()
    each, row = np.unique(rows.column("row").to_numpy(), return_inverse=True)
    sums = [np.bincount(row, weighed * part, len(each)).astype(np.float64) for part in (across, ~across)]
    source = each >> ROW_BITS
    cuts = [*group_starts(source), len(each)] if len(each) else []
    cells = [[column[i:j].tobytes() for i, j in zip(cuts, cuts[1:])] for column in (each, *sums)]
    return pa.table({"source": pa.array(source[np.array(cuts[:-1], np.int64)], pa.int64()), **{n: pa.array(c, pa.binary()) for n, c in zip(("rows", *MORE), cells)}})


def add_rows(sums: pa.Table) -> pa.Table:
    """The sums of the rows of one scan task over all hash partitions."""
    rows = np.frombuffer(b"".join(sums.column("rows").to_pylist()), np.int64)
    each, at = np.unique(rows, return_inverse=True)
    added = [np.bincount(at, np.frombuffer(b"".join(sums.column(n).to_pylist()), np.float64), len(each)) for n in MORE]
    return pa.table({"row": pa.array(each), **{n: pa.array(v, pa.float64()) for n, v in zip(MORE, added)}})


def rarer_sums(rare: DataFrame, model: DataFrame, n_rows: int) -> DataFrame:
    """(row, more_across, more_within): what the rarer n-grams (row, slot, gram, fold, n) add to their texts' sums.

    Both sides are dealt to hash partitions of about PART of the `n_rows` rows of the larger one. What a partition answers is
    packed by the scan task that the rows come from, and added up there.
    """
    parts = max(1, -(-n_rows // PART))

    def dealt(df: DataFrame):
        return df.withColumn("part", F.pmod(F.xxhash64("slot", "gram"), F.lit(parts))).groupBy("part")

    found = dealt(rare).cogroup(dealt(model)).applyInArrow(look_up, "source long, rows binary, more_across binary, more_within binary")
    return found.groupBy("source").applyInArrow(add_rows, "row long, more_across double, more_within double")


# --- modified Kneser-Ney, each fold by the other's counts ------------------------------------

def _discounts(level: DataFrame, c: str) -> list[Column]:
    """Aggregates: discounts for counts of 1, 2 and 3 or more, from the counts of counts."""
    n = {k: F.sum(F.when(F.col(c) == k, 1.0).otherwise(0.0)) for k in (1, 2, 3, 4)}
    y = F.when(n[1] + 2 * n[2] > 0, n[1] / (n[1] + 2 * n[2])).otherwise(0.5)
    return [
        F.greatest(F.lit(0.05), F.least(F.lit(k - 0.05), F.when(n[k] > 0, k - (k + 1) * y * n[k + 1] / n[k]).otherwise(0.5 * k)))
        .alias(f"d{k}_{c}") for k in (1, 2, 3)
    ]


def log_table(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(slot, gram, log0, log1): natural logarithms of the probability of each gram's last code point after the others.

    `counts` has slot, gram (of `order` code points), c0 and c1, the counts in either fold. log0 comes
    from c1 and log1 from c0. The top order uses the counts, lower orders the number of different
    code points before a gram; a context the other fold never has leaves it to the order below.
    The lowest order is mixed with the uniform distribution over the code points of the language.
    """
    levels = [counts.select("slot", "gram", *[F.col(c).cast("double").alias(c) for c in ("c0", "c1")])]
    for _ in range(order - 1):
        levels.append(written(levels[-1].groupBy("slot", F.expr("substring(gram, 2)").alias("gram")).agg(
            *[F.sum(F.when(F.col(c) > 0, 1.0).otherwise(0.0)).alias(c) for c in ("c0", "c1")]
        ), "level"))
    size = written(levels[-1].groupBy("slot").agg((1.0 / F.count(F.lit(1))).alias("uniform")), "size")
    below = None
    for n, level in zip(range(1, order + 1), reversed(levels)):
        per_slot = written(level.groupBy("slot").agg(*_discounts(level, "c0"), *_discounts(level, "c1")), "discounts")  # one row a slot
        own = level.join(per_slot, "slot").withColumn("context", F.col("gram").substr(1, n - 1))
        for c in ("c0", "c1"):
            taken = F.when(F.col(c) >= 3, F.col(f"d3_{c}")).when(F.col(c) >= 2, F.col(f"d2_{c}")).otherwise(F.col(f"d1_{c}"))
            own = own.withColumn(f"off_{c}", F.least(taken, F.col(c)))
        own = own.select("slot", "gram", "context", "c0", "c1", "off_c0", "off_c1")
        sums = own.groupBy("slot", "context").agg(
            *[F.sum(c).alias(f"total_{c}") for c in ("c0", "c1")], *[F.sum(f"off_{c}").alias(f"freed_{c}") for c in ("c0", "c1")]
        )
        own = own.join(sums, ["slot", "context"])
        if below is None:
            own = own.join(size, "slot").withColumns({"low0": F.col("uniform"), "low1": F.col("uniform")})
        else:
            own = own.withColumn("lower_gram", F.expr("substring(gram, 2)")).join(below, ["slot", "lower_gram"])

        def p(c: str, low: str) -> Column:
            mixed = (F.col(c) - F.col(f"off_{c}") + F.col(f"freed_{c}") * F.col(low)) / F.col(f"total_{c}")
            return F.when(F.col(f"total_{c}") > 0, mixed).otherwise(F.col(low))

        made = written(own.select("slot", "gram", p("c1", "low0").alias("p0"), p("c0", "low1").alias("p1")), f"order-{n}")
        below = made.select("slot", F.col("gram").alias("lower_gram"), F.col("p0").alias("low0"), F.col("p1").alias("low1"))
    return made.select("slot", "gram", F.log("p0").alias("log0"), F.log("p1").alias("log1"))
