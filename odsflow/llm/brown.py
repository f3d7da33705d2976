"""Class-based bigram language model: exchange clustering of all words, class transitions, word emissions, text scores."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from odsflow.llm.common import group_starts, named, utf8, written

#: Classes: END has the end of a text, which also stands before its first word; OTHER the words that have no class (yet).
CLASSES, END, OTHER, FIRST = 64, 0, 1, 2
#: Words with at least this share of the training tokens shape the classes, so at most 1 / SHARE words at any size.
SHARE = 1e-5
#: Passes over the training texts that exchange words between classes; the best of their outcomes is kept.
PASSES = 5
#: Bytes of text whose words are found together, and in one block: the rarer words of a block are looked up together.
CHUNK, BLOCK = 4 << 20, 16 << 20
#: A word's count is lowered by this at most for words never seen.
MOST_OFF = 0.9
#: Words that a task counts before it sends them on.
HELD = 1 << 20
#: Words whose best exchange is sought in one task.
SHARD = 256

#: Of the tables that lie on disk beside the shuffles.
COMPRESSION = "zstd"
#: Bytes of placed words that a task holds before it packs them.
PACKED = 8 << 20

CODED = "doc_id long, learnt boolean, block long, low binary, high binary, rare string, n_rare long"
PLACED = "block long, words string, classes binary, counts binary, class int, n long, v long"


# --- tokens ------------------------------------------------------------------------------------

def tokens_of(bodies: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts in a row (A-Z in lower case, split at ASCII white space) and the number of each text's."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(bodies))
    lists = pc.list_parent_indices(split).to_numpy()
    words = pc.list_flatten(split)
    there = pc.not_equal(words, "")
    return words.filter(there), np.bincount(lists[there.to_numpy(zero_copy_only=False)], minlength=len(bodies))


def in_groups(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a group's values have about `most` bytes."""
    for batch in batches:
        sizes = pc.coalesce(pc.binary_length(batch.column(column)), 0).to_numpy()
        group = np.cumsum(sizes) // most
        starts = [*group_starts(group), len(group)] if len(group) else []
        for first, end in zip(starts, starts[1:]):
            yield batch.slice(first, end - first)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of the training texts, counted by group of texts; a task holds up to HELD words before it sends them on."""
    held: list[pa.Table] = []

    def added() -> pa.Table:
        return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])

    for batch in in_groups(batches, "body", CHUNK):
        counted = tokens_of(batch.column("body"))[0].value_counts()
        held.append(pa.table({"word": counted.field("values"), "n": counted.field("counts")}))
        if sum(map(len, held)) > HELD:
            held = [added()]
            if len(held[0]) > HELD // 2:
                yield from held[0].to_batches()
                held = []
    if held:
        yield from added().to_batches()


# --- texts as numbers of the frequent words, beside their rarer words --------------------------

def code_texts(frequent: pa.Array) -> Callable:
    """A function that writes texts as numbers: 0 for a rarer word, i + 1 for `frequent[i]`; rarer words follow in `rare`.

    The halves of the numbers are apart, two bytes a word each: `high` is nearly always 0 and takes next to no room once compressed.
    """

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, filled = TaskContext.get().partitionId() << 32, 0
        for batch in in_groups(batches, "body", CHUNK):
            words, sizes = tokens_of(batch.column("body"))
            found = words.dictionary_encode()
            number = pc.fill_null(pc.index_in(found.dictionary, value_set=frequent), -1).to_numpy().astype("<u4") + np.uint32(1)
            codes = number[found.indices.to_numpy()]
            is_rare = codes == 0
            low, high = (half.astype("<u2").tobytes() for half in (codes & 0xFFFF, codes >> 16))
            ends = 2 * np.cumsum(sizes)
            starts = ends - 2 * sizes
            text = np.repeat(np.arange(len(sizes)), sizes)
            n_rare = np.bincount(text[is_rare], minlength=len(sizes))
            rare = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_rare)).astype(np.int32)), words.filter(pa.array(is_rare)))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("learnt"), pa.array(np.full(len(sizes), block, np.int64)),
                *[pa.array([half[a:b] for a, b in zip(starts, ends)], pa.binary()) for half in (low, high)], pc.binary_join(rare, " "), pa.array(n_rare),
            ], names=["doc_id", "learnt", "block", "low", "high", "rare", "n_rare"])
            filled += int(pc.sum(pc.binary_length(batch.column("body"))).as_py() or 0)
            if filled >= BLOCK:
                block, filled = block + 1, 0

    return coded


def sequence(texts: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all texts in a row and how many each has."""
    low, high = (np.frombuffer(b"".join(texts.column(half).to_pylist()), "<u2") for half in ("low", "high"))
    numbers = low.astype(np.int64)
    if high.any():
        numbers += high.astype(np.int64) << 16
    return numbers, pc.binary_length(texts.column("low")).to_numpy() // 2


def with_ends(values: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """The texts in a row with an end before the first and behind each."""
    line = np.full(len(values) + len(sizes) + 1, end, values.dtype)
    line[np.arange(len(values)) + np.repeat(np.arange(len(sizes)), sizes) + 1] = values
    return line


# --- exchange of the frequent words ------------------------------------------------------------

def neighbours(classes: np.ndarray) -> Callable:
    """A function that counts, for each frequent word, the classes before and behind it, and itself behind itself.

    `classes` has the class of each number (0: the rarer words, the last one: the end). A task holds one count a
    number and class, at most 2 * CLASSES / SHARE.
    """
    n = len(classes)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, behind, twice = np.zeros(n * CLASSES, np.int64), np.zeros(n * CLASSES, np.int64), np.zeros(n, np.int64)
        for batch in in_groups(batches, "low", CHUNK // 2):
            line = with_ends(*sequence(batch), n - 1)
            left, right = line[:-1], line[1:]
            before += np.bincount(right * CLASSES + classes[left], minlength=n * CLASSES)
            behind += np.bincount(left * CLASSES + classes[right], minlength=n * CLASSES)
            twice += np.bincount(left[left == right], minlength=n)
        for shard in range(-(-n // SHARD)):
            own = slice(shard * SHARD, (shard + 1) * SHARD)
            wide = slice(own.start * CLASSES, own.stop * CLASSES)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard])] + [pa.array([part.astype(np.uint32).tobytes()], pa.binary()) for part in (before[wide], behind[wide], twice[own])],
                names=["shard", "before", "behind", "twice"],
            )

    return counted


SUMS = "shard long, before binary, behind binary, twice binary"


def add_up(shard: pa.Table) -> pa.Table:
    """The sums of a shard's words over all tasks."""
    sums = {}
    for name in ("before", "behind", "twice"):
        total = 0
        for part in shard.column(name):
            total = total + np.frombuffer(part.as_buffer(), np.uint32).astype(np.int64)
        sums[name] = pa.array([total.tobytes()], pa.binary())
    return pa.table({"shard": shard.column("shard").slice(0, 1), **sums})


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Numbers, counts before and behind (a row a number) and twice of each shard."""
    for batch in batches:
        for row in batch.to_pylist():
            before, behind, twice = (np.frombuffer(row[c], np.int64) for c in ("before", "behind", "twice"))
            yield row["shard"] * SHARD + np.arange(len(twice)), before.reshape(-1, CLASSES), behind.reshape(-1, CLASSES), twice


def class_pairs(classes: np.ndarray) -> Callable:
    """A function that sums the words' rows to the pairs of classes: (pair, n), at most CLASSES ** 2 a task."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((CLASSES, CLASSES), np.int64)
        for numbers, _, behind, _ in shards(batches):
            np.add.at(total, classes[numbers], behind)
        yield pairs_batch(total.ravel())

    return counted


def pairs_batch(total: np.ndarray) -> pa.RecordBatch:
    seen = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["pair", "n"])


def pair_matrix(pairs: DataFrame) -> np.ndarray:
    """The sums of (pair, n) as a square of CLASSES by CLASSES."""
    total = np.zeros(CLASSES * CLASSES, np.int64)
    for row in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect():  # one row a pair of classes
        total[row["pair"]] = row["n"]
    return total.reshape(CLASSES, CLASSES)


def xlogx(values: np.ndarray) -> np.ndarray:
    return values * np.log(np.maximum(values, 1))


def log_likelihood(pairs: np.ndarray) -> float:
    """Of the class bigrams, but for what the words' own counts add."""
    return float(xlogx(pairs).sum() - xlogx(pairs.sum(axis=0)).sum() - xlogx(pairs.sum(axis=1)).sum())


def alone(own: int, before: np.ndarray, behind: np.ndarray, twice: int) -> tuple[np.ndarray, np.ndarray]:
    """A word's counts without itself as a neighbour."""
    before, behind = before.astype(np.float64), behind.astype(np.float64)
    before[own] -= twice
    behind[own] -= twice
    return before, behind


class Pairs:
    """Counts of class pairs from which words leave and which they join; n * log n of each is at hand."""

    def __init__(self, pairs: np.ndarray):
        self.n = pairs.astype(np.float64)
        self.f = xlogx(self.n)
        self.out, self.into = self.n.sum(axis=1), self.n.sum(axis=0)

    def move(self, own: int, before: np.ndarray, behind: np.ndarray, twice: int, sign: int) -> None:
        """A word (its counts without itself as a neighbour) joins the class, or leaves it with sign -1."""
        self.n[own] += sign * behind
        self.n[:, own] += sign * before
        self.n[own, own] += sign * twice
        self.f[own], self.f[:, own] = xlogx(self.n[own]), xlogx(self.n[:, own])
        self.out += sign * before
        self.out[own] += sign * (behind.sum() + twice)
        self.into += sign * behind
        self.into[own] += sign * (before.sum() + twice)

    def gains(self, before: np.ndarray, behind: np.ndarray, twice: int) -> np.ndarray:
        """What the log likelihood gains when a word that is in no class joins each of them; only pairs that change are looked at."""
        at, left, right = np.arange(CLASSES), np.flatnonzero(before), np.flatnonzero(behind)
        rows = xlogx(self.n[:, right] + behind[right]) - self.f[:, right]
        columns = xlogx(self.n[left] + before[left, None]) - self.f[left]
        corner = np.diagonal(self.n)
        gain = rows.sum(axis=1) + columns.sum(axis=0)
        gain[right] -= rows[right, np.arange(len(right))]
        gain[left] -= columns[np.arange(len(left)), left]
        gain += xlogx(corner + before + behind + twice) - self.f[at, at]
        out, into = self.out + before, self.into + behind  # the word's neighbours have it beside them, whatever its class
        gain -= xlogx(out + behind.sum() + twice) - xlogx(out)
        return gain - (xlogx(into + before.sum() + twice) - xlogx(into))


def exchange(classes: np.ndarray, pairs: np.ndarray) -> Callable:
    """A function that gives each word of its shards the class of the highest likelihood, one word after the other.

    A task starts from the counts of all words and follows its own moves; those of other tasks show in the next pass.
    """

    def exchanged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = Pairs(pairs)
        for numbers, all_before, all_behind, all_twice in shards(batches):
            best = classes[numbers]
            for i, (own, twice) in enumerate(zip(best.tolist(), all_twice.tolist())):
                if own == END or not numbers[i]:
                    continue
                sides = alone(own, all_before[i], all_behind[i], twice)
                current.move(own, *sides, twice, -1)
                gain = current.gains(*sides, twice)
                to = FIRST + int(np.argmax(gain[FIRST:]))
                best[i] = to if own == OTHER or gain[to] > gain[own] + 1e-6 else own
                current.move(int(best[i]), *sides, twice, 1)
            yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(best)], names=["number", "class"])

    return exchanged


def frequent_classes(coded: DataFrame, n_frequent: int, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """The class of each number, and the pairs of classes counted with them.

    At first the most frequent words have a class each and all others are in OTHER; every pass counts the corpus anew and
    exchanges words. The outcome of the highest likelihood stays (words in OTHER are no outcome).
    """
    classes = np.full(n_frequent + 2, OTHER, np.int64)
    classes[-1] = END
    seeds = min(CLASSES - FIRST, n_frequent)
    classes[1:1 + seeds] = np.arange(FIRST, FIRST + seeds)
    learnt, best = coded.where("learnt").select("low", "high"), None
    for step in range(passes + 1):
        sums = learnt.mapInArrow(neighbours(classes), SUMS).groupBy("shard").applyInArrow(add_up, SUMS)
        sums = written(sums, "neighbours", COMPRESSION)
        pairs = pair_matrix(sums.mapInArrow(class_pairs(classes), "pair long, n long"))
        likelihood = log_likelihood(pairs)
        if step and (best is None or likelihood > best[0]):
            best = likelihood, classes, pairs
        elif step > 1 or step == passes:
            break
        if step < passes:
            classes = classes.copy()
            dealt = sums.repartition(-(-len(classes) // SHARD), "shard")  # a task a shard: it is little data and much work
            found = dealt.mapInArrow(exchange(classes.copy(), pairs), "number long, class long").toArrow()  # one row a frequent word
            classes[found.column("number").to_numpy()] = found.column("class").to_numpy()
    return (best or (0, classes, pairs))[1:]


# --- the rarer words ---------------------------------------------------------------------------

def rare_contexts(classes: np.ndarray) -> Callable:
    """A function that gives, by block and rarer word, the classes around its training occurrences, two bytes each."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_groups(batches, "low", BLOCK // 2):
            numbers = with_ends(*sequence(batch), len(classes) - 1)
            line, at = classes[numbers].astype(np.uint8), np.flatnonzero(numbers == 0)
            around = np.stack([line[at - 1], line[at + 1]], axis=1)
            n_rare = batch.column("n_rare").to_numpy()
            texts = batch.column("rare").filter(pa.array(n_rare > 0))
            words = pc.list_flatten(pc.split_pattern(texts, " ")).dictionary_encode()
            block = np.repeat(batch.column("block").to_numpy(), n_rare)
            learnt = np.repeat(batch.column("learnt").to_numpy(zero_copy_only=False), n_rare)
            which = words.indices.to_numpy()
            if not len(which):
                continue
            order = np.lexsort((which, block))
            starts = group_starts(block[order], which[order])
            first = order[starts]
            kept = learnt[order]
            lengths = 2 * np.add.reduceat(kept.astype(np.int64), starts)
            offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
            contexts = pa.Array.from_buffers(
                pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(around[order][kept].tobytes())]
            )
            yield pa.RecordBatch.from_arrays(
                [words.dictionary.take(pa.array(which[first])), pa.array(block[first]), contexts], names=["word", "block", "contexts"]
            )

    return found


def place_words(logs: np.ndarray) -> Callable:
    """A function that gives each rarer word, from its rows in a row, the class its contexts speak for most.

    Rows (block, word, class, n), n being its training tokens; one more row a word has no block.
    `logs` has the logarithm of each class behind each other. Sums of an open word are carried from batch to batch, with its
    blocks; a word that no training text has stays in OTHER.
    """
    into = logs.astype(np.float32)  # into[l] is a row of the classes behind l
    out = np.ascontiguousarray(logs.T.astype(np.float32))  # out[r] is a row of the classes before r

    def rows(words: pa.Array, which: np.ndarray, blocks: pa.Array, classes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [blocks, words.take(pa.array(which)), pa.array(classes[which].astype(np.int32)), pa.array(counts[which])],
            names=["block", "word", "class", "n"],
        )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, blocks, total, n = None, [], np.zeros(CLASSES), 0  # of the open word

        def closed(words: pa.Array, which: np.ndarray, own_blocks: np.ndarray, sums: np.ndarray, counts: np.ndarray):
            classes = np.where(counts > 0, FIRST + np.argmax(sums[:, FIRST:], axis=1), OTHER)
            yield rows(words, which, pa.array(own_blocks), classes, counts)
            yield rows(words, np.arange(len(words)), pa.nulls(len(words), pa.int64()), classes, counts)

        def open_word():
            own = np.concatenate(blocks)
            return closed(pa.array([word]), np.zeros(len(own), np.int64), own, total[None, :], np.array([n]))

        for batch in in_groups(batches, "contexts", 1 << 20):
            column = batch.column("word")
            starts = group_starts(column.dictionary_encode().indices.to_numpy())
            words = column.take(pa.array(starts))
            each = pc.binary_length(batch.column("contexts")).to_numpy().astype(np.int64) // 2
            flat = np.frombuffer(b"".join(batch.column("contexts").to_pylist()), np.uint8).reshape(-1, 2)
            sums, sizes = np.zeros((len(starts), CLASSES)), np.diff(np.append(starts, len(column)))
            row_word = np.repeat(np.arange(len(starts)), sizes)
            group = np.repeat(row_word, each)
            for some in (slice(i, i + 32768) for i in range(0, len(flat), 32768)):
                part = into[flat[some, 0]]
                part += out[flat[some, 1]]
                cuts = group_starts(group[some])
                sums[group[some][cuts]] += np.add.reduceat(part, cuts, axis=0)
            counts, own_blocks = np.add.reduceat(each, starts), batch.column("block").to_numpy()
            if word is not None and words[0].as_py() != word:
                yield from open_word()
                word, blocks, total, n = None, [], np.zeros(CLASSES), 0
            sums[0] += total
            counts[0] += n
            last = int(starts[-1])
            if len(starts) > 1:
                carried = np.concatenate(blocks) if blocks else np.zeros(0, np.int64)
                which = np.concatenate([np.zeros(len(carried), np.int64), row_word[:last]])
                yield from closed(words.slice(0, len(words) - 1), which, np.concatenate([carried, own_blocks[:last]]), sums[:-1], counts[:-1])
                blocks = []
            word, total, n = words[len(words) - 1].as_py(), sums[-1], int(counts[-1])
            blocks.append(own_blocks[last:])
        if word is not None:
            yield from open_word()

    return placed


def pack_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of `place_words` as few: a block's words in one row for about PACKED bytes, and (class, n, v), its tokens and words, without block.

    The words are space-joined, their classes have a byte each, their counts follow as planes of their eight bytes: most are 0
    and take next to no room once compressed.
    """
    schema = pa.schema([
        ("block", pa.int64()), ("words", pa.string()), ("classes", pa.binary()), ("counts", pa.binary()), ("class", pa.int32()), ("n", pa.int64()), ("v", pa.int64()),
    ])
    tokens, kinds, held, size = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64), [], 0

    def packed() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        blocks = rows.column("block").to_numpy()
        order = np.argsort(blocks, kind="stable")
        starts = group_starts(blocks[order])
        cuts = list(zip(starts, np.append(starts[1:], len(order))))
        words = rows.column("word").combine_chunks().take(pa.array(order))
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(order)).astype(np.int32)), words)
        classes, counts = rows.column("class").to_numpy()[order].astype(np.uint8), rows.column("n").to_numpy()[order]
        nothing = [pa.nulls(len(starts), kind) for kind in (pa.int32(), pa.int64(), pa.int64())]
        return pa.RecordBatch.from_arrays([
            pa.array(blocks[order][starts]), pc.binary_join(lists, " "), pa.array([classes[a:b].tobytes() for a, b in cuts], pa.binary()),
            pa.array([planes(counts[a:b]) for a, b in cuts], pa.binary()), *nothing,
        ], schema=schema)

    for batch in batches:
        if batch.column("block").null_count:  # a row a word
            own, n = batch.column("class").to_numpy(), batch.column("n").to_numpy()
            np.add.at(tokens, own, n)
            np.add.at(kinds, own, n > 0)
            continue
        held.append(batch)
        size += batch.nbytes
        if size >= PACKED:
            yield packed()
            held, size = [], 0
    if size:
        yield packed()
    seen = np.flatnonzero(kinds)
    nothing = [pa.nulls(len(seen), kind) for kind in schema.types[:4]]
    yield pa.RecordBatch.from_arrays([*nothing, pa.array(seen.astype(np.int32)), pa.array(tokens[seen]), pa.array(kinds[seen])], schema=schema)


def planes(counts: np.ndarray) -> bytes:
    """The first bytes of all counts, then the second ones, and so on."""
    return counts.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(words: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words, classes and counts of a block's packed rows."""
    counts = [np.frombuffer(row, np.uint8).reshape(8, -1).T.copy().view("<i8").ravel() for row in words.column("counts").to_pylist()]
    classes = np.frombuffer(b"".join(words.column("classes").to_pylist()), np.uint8)
    each = pc.list_flatten(pc.split_pattern(words.column("words").combine_chunks(), " "))
    return each, classes.astype(np.int64), np.concatenate([np.zeros(0, np.int64), *counts])


def transition_logs(pairs: np.ndarray) -> np.ndarray:
    """Logarithms of the probability of each class behind each other, discounted and mixed with the classes' own shares.

    A class that no token has gets minus infinity.
    """
    seen, total = pairs.sum(axis=0), pairs.sum()
    share = seen / max(total, 1)
    out = pairs.sum(axis=1, keepdims=True)
    off = np.minimum(pairs, 0.5)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.log(np.where(out > 0, (pairs - off) / out + off.sum(axis=1, keepdims=True) / out * share, share))


# --- the model ---------------------------------------------------------------------------------

@dataclass
class Emissions:
    """What of the model is one number a class or a corpus; counts of words stay with Spark."""

    n: int  # training tokens
    v: int  # distinct ones
    off: float  # taken off each word's count for words never seen
    totals: np.ndarray  # tokens of each class
    kinds: np.ndarray  # distinct words of each class

    def base_log(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1.0) / (self.n + (self.v + 1.0)))

    def word_log(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Logarithm (base 10) of a known word in its class; 0 for unknown ones, which `score_logs` weighs."""
        known = counts > 0
        return np.where(known, np.log10(np.where(known, counts - self.off, 1.0) / np.where(known, self.totals[classes], 1.0)), 0.0)


def score_logs(pairs: np.ndarray, emissions: Emissions) -> np.ndarray:
    """Logarithms (base 10) of classes behind each other, with unknown words as the class OTHER.

    An unknown word comes out of each class with what its words' counts were lowered by; behind it, classes follow as
    behind the words it may stand for, each class by its number of different words.
    """
    if not emissions.n:
        return np.zeros((CLASSES, CLASSES))
    p = np.exp(transition_logs(pairs))
    free = np.where(emissions.totals > 0, emissions.off * emissions.kinds / np.maximum(emissions.totals, 1), 0.0)
    p[OTHER] = (emissions.kinds / emissions.kinds.sum()) @ p
    p[:, OTHER] = p @ free
    with np.errstate(divide="ignore"):
        return np.log10(p)


SCORED = "doc_id long, learnt boolean, n_tokens long, n_known long, base_score double, emitted double, classes binary"


def spell(classes: np.ndarray, counts: np.ndarray, emissions: Emissions) -> Callable:
    """A function that turns a block's texts into their classes, with the sums over their tokens that need counts.

    `classes` and `counts` have those of the frequent numbers; the block's rarer words come packed in the second table.
    """

    def spelt(texts: pa.Table, words: pa.Table) -> pa.Table:
        texts, words = texts.combine_chunks(), words.combine_chunks()
        numbers, sizes = sequence(texts)
        own, n = classes[numbers], counts[numbers]
        rare_texts = texts.column("rare").combine_chunks().filter(pa.array(texts.column("n_rare").to_numpy() > 0))
        rare = pc.list_flatten(pc.split_pattern(rare_texts, " "))
        if len(rare):
            listed, placed, seen = unpacked(words)
            at = pc.index_in(rare, value_set=listed).to_numpy(zero_copy_only=False)
            own[numbers == 0] = placed[at]
            n[numbers == 0] = seen[at]
        text = np.repeat(np.arange(len(sizes)), sizes)
        ended = np.append(0, np.cumsum(sizes))
        line = own.astype(np.uint8).tobytes()

        def sums(values: np.ndarray, end: float) -> np.ndarray:
            return np.bincount(text, values, len(sizes)) + end

        end = np.array([END]), counts[-1:]
        return pa.table({
            "doc_id": texts.column("doc_id"), "learnt": texts.column("learnt"), "n_tokens": pa.array(sizes.astype(np.int64) + 1),
            "n_known": pa.array((sums(n > 0, 0) + (counts[-1] > 0)).astype(np.int64)),
            "base_score": pa.array(sums(emissions.base_log(n), emissions.base_log(end[1])[0])),
            "emitted": pa.array(sums(emissions.word_log(own, n), emissions.word_log(*end)[0])),
            "classes": pa.array([line[a:b] for a, b in zip(ended, ended[1:])], pa.binary()),
        })

    return spelt


def class_line(classes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The classes of all texts in a row, ends among them, and the number of tokens of each text."""
    sizes = pc.binary_length(classes).to_numpy().astype(np.int64)
    return with_ends(np.frombuffer(b"".join(classes.to_pylist()), np.uint8).astype(np.int64), sizes, END), sizes + 1


def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CLASSES * CLASSES, np.int64)
    for batch in batches:
        line, _ = class_line(batch.column("classes"))
        total += np.bincount(line[:-1] * CLASSES + line[1:], minlength=CLASSES * CLASSES)
    yield pairs_batch(total)


def add_transitions(logs: np.ndarray) -> Callable:
    """A function that adds the transitions of each text to what its words emit."""
    flat = logs.ravel()

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            line, sizes = class_line(batch.column("classes"))
            text = np.repeat(np.arange(len(sizes)), sizes)
            score = np.bincount(text, flat[line[:-1] * CLASSES + line[1:]], len(sizes)) + batch.column("emitted").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "learnt", "n_tokens", "n_known", "base_score")], pa.array(score)],
                names=["doc_id", "learnt", "n_tokens", "n_known", "base_score", "score"],
            )

    return added


def score_texts(docs: DataFrame, learnt: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row doc_id, learnt, n_tokens, n_known, train_tokens, base_score, score, perplexity (of the score, a token).

    Tokens are the words of the whole text, split at ASCII white space, A-Z in lower case, and one end. The model is learnt from the rows for which
    `learnt` holds: P(word | word before) = P(class | class before) * P(word | class). Exchange clustering finds the classes: words with a
    share of SHARE or more of the tokens (at most 1 / SHARE of them) move between classes in PASSES passes over all training texts; then every
    rarer training word joins the class its contexts speak for most. Transitions are counted over all training texts with
    all words' classes, discounted and mixed with the classes' shares; emissions leave what they are discounted by to words never
    seen, which count as one further word, so the probabilities of all words sum to 1 behind every word. `base_score` is the
    text's log10 probability by single words with one added to each count. Scores are log10.

    Counts, contexts and look-ups are Spark tables and shuffles that grow with the input; the driver holds the frequent words and CLASSES ** 2
    counts. NULL texts are empty: one end. `learnt` counts as false where it is NULL. Without training texts every score is 0. Repeated
    rows each get theirs; other columns are ignored; an empty table gives no rows.
    """
    own = docs.select(
        named(id_col).cast("long").alias("doc_id"), F.coalesce(learnt, F.lit(False)).alias("learnt"), utf8(named(text_col)).cast("string").alias("body")
    )
    counted = own.where("learnt").select("body").mapInArrow(count_words, "word string, n long")
    vocabulary = written(counted.groupBy("word").agg(F.sum("n").alias("n")), "vocabulary", COMPRESSION)
    counts_of = [F.sum(F.when(F.col("n") == k, 1).otherwise(0)).alias(f"n{k}") for k in (1, 2)]
    sums = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"), *counts_of).first()
    ends = own.where("learnt").count()
    n = sums["n"] + ends
    frequent = vocabulary.where(F.col("n") >= SHARE * n).toArrow()  # at most 1 / SHARE words
    frequent = frequent.sort_by([("n", "descending"), ("word", "ascending")])
    listed = frequent.column("word").combine_chunks()
    counts = np.concatenate([[0], frequent.column("n").to_numpy(), [ends]]).astype(np.int64)

    coded = written(own.mapInArrow(code_texts(listed), CODED), "coded", COMPRESSION)
    classes, pairs = frequent_classes(coded, len(listed))
    contexts = coded.where("n_rare > 0").mapInArrow(rare_contexts(classes), "word string, block long, contexts binary")
    logs = np.maximum(transition_logs(pairs), -1e9)
    at_once = contexts.repartition("word").sortWithinPartitions("word")
    place = place_words(logs)
    placed = written(at_once.mapInArrow(lambda batches: pack_words(place(batches)), PLACED), "placed", COMPRESSION)

    totals, kinds = np.bincount(classes, counts, CLASSES).astype(np.int64), np.bincount(classes[1:], minlength=CLASSES)
    totals[OTHER], kinds[OTHER] = 0, 0
    each = placed.where("block IS NULL")
    for row in each.groupBy("class").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():  # one row a class
        totals[row["class"]] += row["n"]
        kinds[row["class"]] += row["v"]
    if not ends:
        kinds[END] = 0
    off = min(sums["n1"] / (sums["n1"] + 2 * sums["n2"]), MOST_OFF) if sums["n1"] else 0.5
    emissions = Emissions(int(n), int(sums["v"] + (ends > 0)), float(off), totals, kinds)
    blocks = coded.groupBy("block").cogroup(placed.where("block IS NOT NULL").select("block", "words", "classes", "counts").groupBy("block"))
    scored = written(blocks.applyInArrow(spell(classes, counts, emissions), SCORED), "classes", COMPRESSION)
    pairs = pair_matrix(scored.where("learnt").select("classes").mapInArrow(count_pairs, "pair long, n long"))
    found = scored.mapInArrow(
        add_transitions(score_logs(pairs, emissions)),
        "doc_id long, learnt boolean, n_tokens long, n_known long, base_score double, score double",
    )
    return found.select(
        "doc_id", "learnt", "n_tokens", "n_known", F.lit(int(n)).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
