"""A quality classifier from trusted positives and unlabelled texts (non-negative PU learning)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from odsflow.llm.common import forget, in_chunks, named, utf8, written
from odsflow.llm.ngrams import Words

#: Hashed features: words and the shapes of words share this many places; a few measured ones come first.
PLACES = 1 << 15
MEASURED = 10
STEPS, RATE, RIDGE = 60, 0.1, 1e-5
FOLDS = 5
#: Bytes of text whose features are found together, and texts in one row of the feature table.
CHUNK, TEXTS = 1 << 19, 256
#: Bytes of rows that a Python worker is given at once.
BATCH_SETTING, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", 1 << 21
#: Pieces in which the gradients of all tasks are added up, rows of the feature table in a batch and in a task of a step at least, and
#: steps that every text is in at least.
PIECES, ROWS_A_BATCH, ROWS_A_TASK, LEAST_STEPS = 16, 128, 32, 4

SHAPES = bytes(
    ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b for b in range(256)
)
UPPER, SIGNS, DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#*$%&|<>{}[]\\^~_=+@", b"0123456789"


# --- features --------------------------------------------------------------------------------

def shape(word: bytes) -> bytes:
    """Letters as A or a, digits as 0, other signs as they are; runs of up to three equal signs, longer ones as three."""
    drawn = word.translate(SHAPES)
    short = bytearray()
    for b in drawn:
        if len(short) < 2 or b != short[-1] or b != short[-2]:
            short.append(b)
        elif b not in b"Aa0" and (len(short) < 3 or b != short[-3]):
            short.append(b)
    return bytes(short)


def places(word: bytes) -> tuple[int, int]:
    """The places of a word and of its shape."""
    spread = PLACES - MEASURED
    return (
        MEASURED + xxhash.xxh64_intdigest(word.lower(), 1) % spread, MEASURED + xxhash.xxh64_intdigest(shape(word), 2) % spread,
    )


def all_places(words: pa.Array) -> np.ndarray:
    """The places of some words (strings) and of their shapes, a row a word; a shape is worked out once for all words drawn alike."""
    spread, each = PLACES - MEASURED, words.cast(pa.binary())
    own = [xxhash.xxh64_intdigest(w, 1) % spread for w in pc.ascii_lower(words).cast(pa.binary()).to_numpy(zero_copy_only=False)]
    ends = np.append(0, np.cumsum(pc.binary_length(each).to_numpy())).astype(np.int32)
    flat = pa.py_buffer(b"".join(each.to_numpy(zero_copy_only=False)).translate(SHAPES))
    drawn = pa.Array.from_buffers(pa.binary(), len(each), [None, pa.py_buffer(ends), flat]).dictionary_encode()
    shapes = np.array([xxhash.xxh64_intdigest(shape(d), 2) % spread for d in drawn.dictionary.to_pylist()], np.int64)
    return MEASURED + np.stack([np.array(own, np.int64), shapes[drawn.indices.to_numpy()]], axis=1)


class Measures:
    """Words and measures of some texts, found for all of them together.

    `pair_text`, `pair_word`, `pair_n`: how often a text has a word; `values`: MEASURED numbers between 0 and about 1 a text.
    """

    def __init__(self, bodies: pa.Array):
        self.words = words = Words(bodies)
        texts = bodies.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        kinds, n = max(1, len(words.each)), words.sizes
        pairs = pa.array(words.text.astype(np.int64) * kinds + words.which).value_counts()
        values = pairs.field("values").to_numpy()
        self.pair_text, self.pair_word, self.pair_n = values // kinds, values % kinds, pairs.field("counts").to_numpy()
        own, behind = words.which[:-1].astype(np.int64), words.which[1:]
        inside = words.text[:-1] == words.text[1:]
        text = words.text[:-1][inside]
        doubles = pa.array(((text.astype(np.int64) * kinds) + own[inside]) * kinds + behind[inside]).unique().to_numpy() // (kinds * kinds)
        lines = [[line for line in t.split(b"\n") if line and not line.isspace()] for t in texts]
        size = np.maximum(1, np.array([len(t) for t in texts], np.float64))
        some = np.maximum(1, n)

        def share(signs: bytes) -> np.ndarray:
            return np.array([len(t) - len(t.translate(None, signs)) for t in texts], np.float64) / size

        self.values = np.stack([
            np.minimum(1.0, np.log1p(n) / 10), np.bincount(self.pair_text, minlength=len(texts)) / some,
            np.array([1 - len(set(x)) / max(1, len(x)) for x in lines], np.float64), share(UPPER), share(SIGNS), share(DIGITS),
            np.minimum(1.0, size / some / 20), n == 0,
            np.bincount(text[(own == behind)[inside]], minlength=len(texts)) / some,
            1 - np.bincount(doubles, minlength=len(texts)) / np.maximum(1, n - 1),
        ], axis=1).astype(np.float32) if texts else np.zeros((0, MEASURED), np.float32)


FEATURES = "doc_id long, n_words long, measured binary, places binary, counts binary"


def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a text: its measures, and its places in rising order (as differences) with the words on each."""
    forget()
    for batch in in_chunks(batches, CHUNK):
        found = Measures(batch.column("body"))
        both = all_places(found.words.each)
        at = np.concatenate([found.pair_text * PLACES + both[found.pair_word, i] for i in (0, 1)])
        each, which = np.unique(at, return_inverse=True)
        counts = np.bincount(which, np.tile(found.pair_n, 2)).astype(np.uint32) if len(at) else np.zeros(0, np.uint32)
        text, place = each // PLACES, each % PLACES
        ends = np.append(0, np.cumsum(np.bincount(text, minlength=batch.num_rows)))
        steps = np.diff(place, prepend=0)
        firsts = ends[:-1][np.diff(ends) > 0]
        steps[firsts] = place[firsts]
        steps = steps.astype(np.uint16)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(found.words.sizes.astype(np.int64)), pa.array([v.tobytes() for v in found.values], pa.binary()),
            *[pa.array([part[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()) for part in (steps, counts)],
        ], names=["doc_id", "n_words", "measured", "places", "counts"])


BLOCKS = "number long, n long, good binary, n_words binary, measured binary, sizes binary, places binary, counts binary"


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some texts' features as one row, so that a step of the fit reads a few long arrays; rows are numbered on from the task's number."""
    context = TaskContext.get()
    number = context.partitionId() if context else 0
    for batch in batches:
        for first in range(0, batch.num_rows, TEXTS):
            part = batch.slice(first, TEXTS)
            sizes = pc.binary_length(part.column("places")).to_numpy() // 2
            steps = np.frombuffer(b"".join(part.column("places").to_pylist()), np.uint16).astype(np.int64)
            whole = np.cumsum(steps)
            starts = np.append(0, np.cumsum(sizes))[:-1]
            before = np.repeat(np.where(sizes > 0, np.append(0, whole)[starts], 0), sizes)
            cells = [
                pc.fill_null(part.column("good"), False).to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                part.column("n_words").to_numpy().astype(np.int64).tobytes(), b"".join(part.column("measured").to_pylist()),
                sizes.astype(np.int32).tobytes(), (whole - before).astype(np.uint16).tobytes(), b"".join(part.column("counts").to_pylist()),
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([part.num_rows]), *[pa.array([c], pa.binary()) for c in cells]],
                names=["number", "n", "good", "n_words", "measured", "sizes", "places", "counts"],
            )
            number += 1


class Block:
    """The features of some texts, as flat arrays."""

    def __init__(self, row: dict):
        self.n, self.good = row["n"], np.frombuffer(row["good"], np.uint8).astype(bool)
        sizes = np.frombuffer(row["sizes"], np.int32).astype(np.int64)
        self.measured = np.frombuffer(row["measured"], np.float32).reshape(-1, MEASURED).astype(np.float64)
        self.places = np.frombuffer(row["places"], np.uint16).astype(np.int64)
        self.rows = np.repeat(np.arange(self.n), sizes)
        words = np.maximum(1, np.frombuffer(row["n_words"], np.int64)).astype(np.float64)
        self.values = np.frombuffer(row["counts"], np.uint32) / words[self.rows]

    def margins(self, weights: np.ndarray) -> np.ndarray:
        """`weights` has one a place, and the bias at the end."""
        return weights[-1] + self.measured @ weights[:MEASURED] + np.bincount(self.rows, self.values * weights[self.places], self.n)

    def pull(self, slopes: np.ndarray) -> np.ndarray:
        """Sums of slope * feature of each place, and of the slopes."""
        pulled = np.bincount(self.places, self.values * slopes[self.rows], PLACES).astype(np.float64)
        pulled[:MEASURED] += slopes @ self.measured
        return np.append(pulled, slopes.sum())


# --- the fit ---------------------------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    """Weights of the places, and their sum at the start."""

    weights: np.ndarray
    bias: float

    def scores(self, bodies: pa.Array, word_weight=None) -> np.ndarray:
        """Scores of some texts (strings without NULLs); `word_weight`, if given, has the sum of a word's weights."""
        found = Measures(bodies)
        if word_weight is None:
            each = self.weights[all_places(found.words.each)].sum(axis=1)
        else:
            each = np.array([word_weight[w] for w in found.words.each.cast(pa.binary()).to_pylist()], np.float64)
        sums = np.bincount(found.pair_text, each[found.pair_word] * found.pair_n, len(bodies)) if len(each) else np.zeros(len(bodies))
        margins = self.bias + found.values.astype(np.float64) @ self.weights[:MEASURED] + sums / np.maximum(1, found.words.sizes)
        return _sigmoid(margins)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Sums:
    """What one step needs of all texts: numbers, losses and pulls of the positives and of the unlabelled texts."""

    n_positive: float
    n_unlabelled: float
    loss_positive: float  # of the positives, taken as 0
    loss_unlabelled: float
    pull_positive: np.ndarray  # sums of score * feature
    pull_unlabelled: np.ndarray

    SIZE = 4 + 2 * (PLACES + 1)

    @classmethod
    def of(cls, vector: np.ndarray) -> Sums:
        return cls(*vector[:4].tolist(), vector[4:4 + PLACES + 1], vector[4 + PLACES + 1:cls.SIZE])


def block_sums(blocks: Iterator[Block], weights: np.ndarray) -> np.ndarray:
    """The sums of some blocks as one vector (see Sums). Every text is an unlabelled one, whatever its label says; the positives count as such too."""
    total = np.zeros(Sums.SIZE)
    for block in blocks:
        margins = block.margins(weights)
        scores, losses = _sigmoid(margins), np.logaddexp(0, margins)
        total[:4] += (block.good.sum(), block.n, losses[block.good].sum(), losses.sum())
        total[4:4 + PLACES + 1] += block.pull(np.where(block.good, scores, 0.0))
        total[4 + PLACES + 1:] += block.pull(scores)
    return total


def fit(
    sums_of: Callable[[np.ndarray, int], Sums], features_of_positives: list[np.ndarray], prior: float, steps: int = STEPS, rate: float = RATE,
    ridge: float = RIDGE,
) -> Model:
    """Minimises the non-negative unbiased risk of the logistic loss with Adam.

    risk = prior * loss(positives as 1) + max(0, loss(unlabelled as 0) - prior * loss(positives as 0)).
    Where the second part falls below zero, which no true negative risk can, the step goes back
    along that part alone. The texts are dealt to batches, which the steps take in turn: `sums_of` gives the sums over a batch for some
    weights, `features_of_positives` each batch's sums of the positives' features, with their number at the end. A batch
    without positives is passed over; without any the weights stay zero and the prior alone speaks.
    """
    weights = np.zeros(PLACES + 1)
    weights[-1] = np.log(prior / (1 - prior))
    usable = [i for i, features in enumerate(features_of_positives) if features[-1]]
    if not usable:
        return Model(weights[:-1], float(weights[-1]))
    scale = np.full(PLACES + 1, 1.0)
    scale[MEASURED:PLACES] = 20.0  # shares are small numbers, so their weights may move faster
    kept = np.append(np.full(PLACES, ridge), 0.0)
    first, second = np.zeros(PLACES + 1), np.zeros(PLACES + 1)
    for step in range(1, steps + 1):
        batch = usable[step % len(usable)]
        sums = sums_of(weights, batch)
        positive, unlabelled = sums.pull_positive / sums.n_positive, sums.pull_unlabelled / sums.n_unlabelled
        negative = sums.loss_unlabelled / sums.n_unlabelled - prior * sums.loss_positive / sums.n_positive
        if negative >= 0:
            pull = unlabelled - prior * features_of_positives[batch] / sums.n_positive
        else:
            pull = prior * positive - unlabelled
        pull = pull + kept * weights
        first = 0.9 * first + 0.1 * pull
        second = 0.999 * second + 0.001 * pull * pull
        weights = weights - rate * scale * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(weights[:-1], float(weights[-1]))


# --- on tables -------------------------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt: crc32 of the id as text leaves no remainder by FOLDS."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS) == 0


def class_prior(labels: DataFrame) -> float:
    """The estimated share of good texts among unlabelled ones: that of the learnt labels, kept off 0 and 1."""
    good, n = labels.agg(F.sum("good"), F.count(F.lit(1))).first()
    return min(0.99, max(0.01, (good or 0) / n)) if n else 0.5


def _pieces(vector: np.ndarray) -> pa.RecordBatch:
    parts = np.array_split(vector, PIECES)
    return pa.RecordBatch.from_arrays([pa.array(range(PIECES)), pa.array([p.tobytes() for p in parts], pa.binary())], names=["piece", "part"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):  # one row's arrays at a time
            yield Block({name: batch.column(name)[i].as_py() for name in batch.schema.names})


def added(table: pa.Table) -> pa.Table:
    """The sum of a piece over all tasks."""
    total = 0
    for part in table.column("part"):
        total = total + np.frombuffer(part.as_buffer(), np.float64)
    return pa.table({"piece": table.column("piece").slice(0, 1), "part": pa.array([total.tobytes()], pa.binary())})


def total_of(blocks: DataFrame, vector_of: Callable) -> np.ndarray:
    """A vector summed over all blocks: per task, then piece by piece; one vector comes to the driver, whatever the input."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _pieces(vector_of(_blocks(batches)))

    rows = blocks.mapInArrow(summed, "piece long, part binary").groupBy("piece").applyInArrow(added, "piece long, part binary").collect()
    parts = {r["piece"]: np.frombuffer(r["part"], np.float64) for r in rows}
    return np.concatenate([parts[i] for i in range(PIECES)]) if parts else np.zeros(0)


def positive_features(blocks: Iterator[Block]) -> np.ndarray:
    total = np.zeros(PLACES + 1)
    for block in blocks:
        total += block.pull(block.good.astype(np.float64))
    return total


def small_batches(spark: SparkSession) -> None:
    """Texts go to the Python workers BATCH bytes at a time from now on, or fewer if the session says so: by Spark's default some ten
    thousand texts of any length are held at once, by the executor beside its heap and by the worker."""
    said = spark.conf.get(BATCH_SETTING).lower().removesuffix("b")
    held = int(said) if said.lstrip("-").isdigit() else 0
    spark.conf.set(BATCH_SETTING, str(min(held, BATCH) if held > 0 else BATCH))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", steps: int = STEPS
) -> Model:
    """The classifier, from all texts, those labelled 1 being the trusted positives; held-out rows are not looked at.

    Every row that is not held out is an unlabelled text, whatever its label, so junk is learnt from also where every
    document has a label. Features are made once, where the texts are, and written (without the texts, some hundred bytes a
    text); the steps of the fit add up risk and gradient on the executors, over batches of ROWS_A_BATCH * TEXTS texts or more in turn, so that every
    text is in LEAST_STEPS steps or more. Only sums of PLACES numbers reach the driver. Labels of 0 serve the class prior alone. Several labels of one id count by the largest; NULL ids or labels are
    left out, and texts with a NULL id are held out.
    """
    small_batches(docs.sparkSession)
    key = named(id_col).cast("long")
    known = labels.select(named(id_col).cast("long").alias("id"), named(label_col).cast("int").alias("good")).where(
        F.col("id").isNotNull() & F.col("good").isNotNull() & ~held_out(F.col("id"))
    ).groupBy("id").agg(F.max("good").alias("good"))
    known = written(known, "labels")
    texts = docs.select(key.alias("doc_id"), utf8(named(text_col)).cast("string").alias("body")).where(~held_out(F.col("doc_id")))
    made = texts.mapInArrow(feature_rows, FEATURES).join(known.hint("merge"), F.col("doc_id") == F.col("id"), "left")  # sorted, so that `pack` is in another stage
    packed = made.select((F.col("good") == 1).alias("good"), "n_words", "measured", "places", "counts").mapInArrow(pack, BLOCKS)
    blocks = written(packed, "features")
    n_rows = blocks.count()
    n_batches = max(1, min(steps // LEAST_STEPS, n_rows // ROWS_A_BATCH))
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, n_rows // n_batches // ROWS_A_TASK)  # each leaves a vector a step
    parts = [blocks.where(F.col("number") % n_batches == i).coalesce(tasks) for i in range(n_batches)]
    none = np.zeros(PLACES + 1)
    base = [found if len(found) else none for found in (total_of(part, positive_features) for part in parts)]

    def sums_of(weights: np.ndarray, batch: int) -> Sums:
        return Sums.of(total_of(parts[batch], lambda some: block_sums(some, weights)))

    return fit(sums_of, base, class_prior(known), steps)


def score_udf(model):
    """Scores of texts; `model` is a broadcast of a Model."""
    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([pc.fill_null(texts, "")], names=["body"])
        found = [model.value.scores(part.column("body")) for part in in_chunks(iter([batch]), CHUNK)]
        return pa.array(np.concatenate(found) if found else np.zeros(0))

    return scores


def with_quality(
    docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text"
) -> DataFrame:
    """The rows with `score` (0 to 1, higher: better) and `predicted` (1 if the score reaches the threshold).

    Only the text is looked at; a NULL text is the empty text, which has a score like any other. All other
    columns stay; columns that already have one of the two names are replaced. Nothing is shuffled.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = docs.withColumn("score", score_udf(shared)(utf8(named(text_col)).cast("string")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
