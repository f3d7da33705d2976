"""Quality rules: counts of a text, and perplexity under n-gram models of its language."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from odsflow.llm import ngrams
from odsflow.llm.common import named, text_key, utf8, written
from odsflow.llm.ngrams import ACROSS, WITHIN, Grams, HashArrays, Words, word_lines

SYMBOLS, WHITE = b"#*$%&|<>", b" \t\n\x0b\x0c\r"
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50

# --- counts of some texts ----------------------------------------------------------------------


def base_counts(bodies: pa.Array, words: Words) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    chars = pc.utf8_length(words.each).to_numpy()[words.which]
    texts = [b.as_py().encode() for b in bodies]
    lines = [[line for line in text.split(b"\n") if line and not line.isspace()] for text in texts]
    return {
        "n_words": words.sizes, "word_chars": np.bincount(words.text, chars, len(texts)).astype(np.int64),
        "n_symbols": np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64), "n_repeat_words": repeated_words(words),
    }


def repeated_words(words: Words, size: int = 3) -> np.ndarray:
    """Words of each text inside windows of `size` words that the text has twice or more."""
    n = len(words.which) - size + 1
    if n < 1:
        return np.zeros(len(words.sizes), np.int64)
    number = words.text[:n].astype(np.int64)
    for i in range(size):  # windows and their texts as numbers, dense again after each word
        number = number * len(words.each) + words.which[i:i + n]
        number = pa.array(number).dictionary_encode().indices.to_numpy().astype(np.int64)
    whole = words.text[:n] == words.text[size - 1:]
    again = whole & (np.bincount(number[whole], minlength=int(number.max()) + 1)[number] > 1)
    covered = np.zeros(len(words.which), dtype=bool)
    for i in range(size):
        covered[i:n + i] |= again
    return np.bincount(words.text[covered], minlength=len(words.sizes))


def language(lang_col: str) -> Column:
    return F.coalesce(named(lang_col).cast("string"), F.lit("")).alias("lang")


# --- scores ------------------------------------------------------------------------------------

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
SCORED = f"row long, doc_id long, text_key long, lang string, fold int, {COUNTS}, across double, n_across long, within double, n_within long"
#: A rarer n-gram of a text is a row of its own, with `row` and `fold` of the text.
RARE = "slot string, gram string, n long"


def _rare_rows(slot: str, found: Grams, lacking: np.ndarray, line: np.ndarray, which: np.ndarray, rows: np.ndarray, folds: np.ndarray) -> pa.Table:
    """(row, fold, slot, gram, n) of the n-grams that the arrays lack; `line` and `which` are text and gram of each occurrence."""
    at = np.flatnonzero(lacking[which])
    pairs = pa.array(line[at].astype(np.int64) * len(found.codes) + which[at]).value_counts()
    values = pairs.field("values").to_numpy()
    text, gram = values // max(1, len(found.codes)), values % max(1, len(found.codes))
    return pa.table({
        "row": pa.array(rows[text]), "fold": pa.array(folds[text], pa.int32()),
        "slot": pa.array([slot], pa.string()).take(pa.array(np.zeros(len(text), np.int32))),
        "gram": ngrams.strings(found.codes[gram]), "n": pairs.field("counts"),
    })


def score_chunks(model) -> Callable:
    """A function that measures texts and sums the logarithms of their frequent n-grams; rarer ones come as rows of their own.

    `model` is a broadcast of the frequent rows' HashArrays.
    """
    names = [c.split()[0] for c in f"{SCORED}, {RARE}".split(", ")]
    schema = pa.schema([(n, {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}[c.split()[1]])
                        for n, c in zip(names, f"{SCORED}, {RARE}".split(", "))])

    def whole(table: pa.Table) -> pa.Table:
        """All columns; those that the table lacks are NULL."""
        columns = [table.column(f.name).cast(f.type) if f.name in table.column_names else pa.nulls(len(table), f.type) for f in schema]
        return pa.table(columns, schema=schema)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays: HashArrays = model.value
        next_row = TaskContext.get().partitionId() << ngrams.ROW_BITS
        for lang, batch in ngrams.by_language(batches):
            rows = np.arange(next_row, next_row + batch.num_rows)
            next_row += batch.num_rows
            folds, bodies = batch.column("fold").to_numpy(), batch.column("body")
            words = Words(bodies)
            across, within = Grams(words.lines(), ngrams.folded), Grams(word_lines(words.each), ngrams.symbol)
            sums, rare = {}, []

            logs, lacking = ngrams.scored(across, ACROSS + lang, arrays)
            line = across.line()
            each = np.where(folds[line] == 0, logs[0][across.which], logs[1][across.which])
            sums["across"], sums["n_across"] = np.bincount(line, each, len(rows)), across.counts
            rare.append(_rare_rows(ACROSS + lang, across, lacking, line, across.which, rows, folds))

            logs, lacking = ngrams.scored(within, WITHIN + lang, arrays)
            word = within.line()
            of_words = [np.bincount(word, log[within.which], len(words.each)) for log in logs]
            each = np.where(folds[words.text] == 0, of_words[0][words.which], of_words[1][words.which])
            sums["within"] = np.bincount(words.text, each, len(rows))
            sums["n_within"] = np.bincount(words.text, within.counts[words.which], len(rows)).astype(np.int64)
            starts = np.append(0, np.cumsum(within.counts))
            odd = np.bincount(word, lacking[within.which], len(words.each)) > 0  # words with a gram that is lacking
            at = np.flatnonzero(odd[words.which])
            sizes = within.counts[words.which[at]]
            places = np.repeat(starts[words.which[at]] - np.append(0, np.cumsum(sizes))[:-1], sizes) + np.arange(sizes.sum())
            rare.append(_rare_rows(WITHIN + lang, within, lacking, np.repeat(words.text[at], sizes), within.which[places], rows, folds))

            kept = {name: batch.column(name) for name in ("doc_id", "text_key", "lang", "fold")}
            own = pa.table({"row": rows, **kept, **base_counts(bodies, words), **sums})
            for table in (own, *rare):
                yield from whole(table).to_batches()

    return measured


#: The bands reach this many scaled median deviations from a language's median, down and up.
BAND = 4.0
#: The median deviation times this is a standard deviation, for normal data (fixed value).
NORMAL = 1.4826
#: For a language of (nearly) equal texts only: a band reaches this part of the median at least.
LEAST = 0.01
#: With fewer texts a language's own deviation says little, so that of all languages counts if it is larger.
FEW_TEXTS = 20


def bands(scored: DataFrame, band: float = BAND) -> DataFrame:
    """(slot, lower, upper): limits of the mean surprise per code point in each language (`slot`).

    Median and median deviation over the distinct texts of the slot that pass the base rules, so
    copies and a few percent of odd texts hardly move them and no fixed share of the texts is
    rejected. There is one row a language, in small written tables that Spark may broadcast by their size.
    """
    usable = scored.where("NOT base_failed AND surprise IS NOT NULL").groupBy("slot", "text_key").agg(F.min("surprise").alias("surprise"))
    usable = written(usable, "usable")
    middle = written(usable.groupBy("slot").agg(F.percentile_approx("surprise", 0.5, 10_000).alias("middle")), "middle")
    apart = F.abs(F.col("surprise") - F.col("middle"))
    off = written(usable.join(middle, "slot").select("slot", "middle", apart.alias("apart")), "apart")
    spread = off.groupBy("slot", "middle").agg(F.percentile_approx("apart", 0.5, 10_000).alias("own"), F.count(F.lit(1)).alias("n"))
    common = off.agg(F.percentile_approx(F.col("apart") / F.col("middle"), 0.5, 10_000).alias("common"))
    middle_of, own = F.col("middle"), F.col("own")
    reach = F.when(F.col("n") < FEW_TEXTS, F.greatest(own, F.col("common") * middle_of)).otherwise(own)
    wide = F.greatest(F.lit(band * NORMAL) * reach, F.lit(LEAST) * middle_of)
    limits = spread.crossJoin(F.broadcast(common))  # one row
    return written(limits.select("slot", (middle_of - wide).alias("lower"), (middle_of + wide).alias("upper")), "bands")


def off_middle(value: str, lower: str, upper: str) -> Column:
    """How far a value lies from the middle of its band, in halves of the band's width: above 1 outside it."""
    apart = F.try_divide(F.abs(2 * F.col(value) - F.col(lower) - F.col(upper)), F.col(upper) - F.col(lower))
    return F.coalesce(apart, F.lit(0.0))


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", band: float = BAND
) -> DataFrame:
    """Per row the text's counts, `surprise`, its perplexity per code point, the bands and the verdict.

    Columns: doc_id, text_key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, surprise, perplexity, lower, upper, kept. Each language has two modified Kneser-Ney models, made of all its
    texts and stored in sorted hash arrays (see `ngrams`): over code points across words, where a text is scored by the counts of the
    fold it is not in, and over 32 signs within words, by the counts of all texts. A text has to lie in the bands of both
    models; its row shows surprise and band of the one in which it lies farther from the middle. A text fails the base rules with fewer than
    MIN_WORDS words or more than MAX_REPEATED_PERCENT percent of them in repeated windows; others
    are kept if their surprise lies in the band of their language: each lang value has models and a
    band of its own, NULL those of the empty name. NULL texts are empty and fail. Repeated rows each get
    their row; other columns are ignored; an empty table gives no rows.
    """
    own = docs.select(
        named(id_col).cast("long").alias("doc_id"), text_key(text_col), language(lang_col),
        F.pmod(text_key(text_col), F.lit(ngrams.FOLDS)).cast("int").alias("fold"), utf8(named(text_col)).cast("string").alias("body"),
    )
    counted = own.select("lang", "fold", "body").mapInArrow(ngrams.count_grams, ngrams.COUNTED)
    counted = counted.groupBy("slot", "gram").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
    own_fold, both = F.col("slot").startswith(ACROSS), F.col("c0") + F.col("c1")
    counted = counted.select("slot", "gram", *[F.when(own_fold, F.col(c)).otherwise(both).alias(c) for c in ("c0", "c1")])
    counted = written(counted, "counts")
    model = written(ngrams.log_table(counted), "model")
    shared = docs.sparkSession.sparkContext.broadcast(ngrams.frequent_arrays(model, counted))
    found = written(own.mapInArrow(score_chunks(shared), f"{SCORED}, {RARE}"), "scored")
    rare = found.where("gram IS NOT NULL").select("row", "slot", "gram", "fold", "n")
    more = ngrams.rarer_sums(rare, model, max(rare.count(), model.count()))
    scored = found.where("gram IS NULL").drop("slot", "gram", "n").join(more, "row", "left")
    zero, repeated = F.lit(0.0), F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT
    scored = scored.select(
        "doc_id", "text_key", F.col("lang").alias("slot"), *[c.split()[0] for c in COUNTS.split(", ")],
        ((F.col("n_words") < MIN_WORDS) | repeated).alias("base_failed"), *[
            F.when(F.col(f"n_{m}") > 0, -(F.col(m) + F.coalesce(f"more_{m}", zero)) / F.col(f"n_{m}")).alias(n)
            for m, n in (("within", "surprise"), ("across", "across"))
        ],
    )
    scored = written(scored, "judged")
    far = bands(scored.withColumn("surprise", F.col("across")), band).select(
        "slot", F.col("lower").alias("lower_across"), F.col("upper").alias("upper_across")
    )
    judged = scored.join(bands(scored, band), "slot", "left").join(far, "slot", "left")
    farther = off_middle("across", "lower_across", "upper_across") > off_middle("surprise", "lower", "upper")
    judged = judged.withColumns({
        name: F.when(farther, F.col(other)).otherwise(F.col(name))
        for name, other in (("surprise", "across"), ("lower", "lower_across"), ("upper", "upper_across"))
    })
    inside = F.col("surprise").between(F.col("lower"), F.col("upper"))
    return judged.select(
        "doc_id", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "surprise", F.exp("surprise").alias("perplexity"), "lower", "upper",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
    )
