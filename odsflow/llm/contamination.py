"""Benchmark decontamination with a positional inverted index of the documents' tokens.

Everything here is DataFrame work on built-in functions. Three steps:
1. count how often each test term stands in the documents;
2. store the postings (document, position) of the two rarest terms of every test window;
3. intersect each window's two lists after taking off the terms' offsets, rarest first, and compare
   what is left with the words around the posting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from odsflow.llm.common import named, text_key, with_key, written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words are runs of digits, lower-case ASCII letters and characters beyond ASCII.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The term of the posting that ends each document: its position is the document's number of words.
END = ""
#: Tables of test terms are broadcast up to this many rows (a term and two numbers); larger ones are shuffled.
BROADCAST_ROWS = 100_000
WINDOW = 10


def words_of(text: Column) -> Column:
    """The words of a text with A-Z lower-cased; none for NULL."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(lowered, NO_WORD), "")


def checked_broadcast(df: DataFrame) -> DataFrame:
    """`df` for a broadcast if it is counted to be small; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def phrase_windows(items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, phrase, length) of each item's windows of `window` words; a shorter item is one window, one without words none."""
    words = items.select(named(id_col).alias("item_id"), words_of(named(text_col)).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    return (
        words.select("item_id", "words", F.explode(starts).alias("start"))
        .select("item_id", F.slice("words", F.col("start"), F.lit(window)).alias("part"))
        .select("item_id", F.array_join("part", " ").alias("phrase"), F.size("part").alias("length"))
        .distinct()
    )


def term_counts(docs: DataFrame, terms: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, n): how often each of `terms` stands in the documents; terms that never do are left out.

    Words are counted before the join, so what is shuffled is a row a task and different word, however many terms there are.
    """
    found = docs.select(F.explode(words_of(named(text_col))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return found.join(terms, "term")


def rarest_terms(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(phrase, length, term, at, second, second_at): the two rarest terms of each phrase and their offsets.

    A phrase with a term that no document has cannot occur and is left out. A phrase of one word
    has no second term.
    """
    phrases = windows.select("phrase", "length").distinct()
    placed = phrases.select("phrase", "length", F.posexplode(F.split("phrase", " ")).alias("at", "term"))
    ranked = placed.join(counts, "term", "left").withColumn(
        "place", F.row_number().over(Window.partitionBy("phrase").orderBy(F.coalesce("n", F.lit(0)), "at"))
    )
    best = ranked.where("place <= 2").groupBy("phrase", "length").agg(
        F.min(F.when(F.col("place") == 1, F.coalesce("n", F.lit(0)))).alias("n"),
        *[F.min(F.when(F.col("place") == p, F.col(c))).alias(name)
          for p, c, name in ((1, "term", "term"), (1, "at", "at"), (2, "term", "second"), (2, "at", "second_at"))],
    )
    return best.where("n > 0").drop("n")


def build_index(docs: DataFrame, terms: DataFrame, reach: int = WINDOW - 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index: (term, doc_id, text_key, pos, near, near_at) for each place of a term of `terms`.

    `terms` has `term` and `wide`: postings of wide terms keep the words up to `reach` places off
    (`near`, beginning at position `near_at`). Each document also has one posting of END, at the
    position after its last word. Postings are written to the shared folder, one pass over the
    texts, nothing shuffled.
    """
    own = docs.select(named(id_col).cast("long").alias("doc_id"), text_key(text_col), words_of(named(text_col)).alias("words"))
    every = own.select("doc_id", "text_key", "words", F.posexplode(F.array_append("words", END)).alias("pos", "term"))
    ends = terms.sparkSession.range(1).select(F.lit(END).alias("term"), F.lit(False).alias("wide"))
    chosen = every.join(checked_broadcast(terms.select("term", "wide").unionByName(ends)), "term")
    near_at = F.greatest(F.col("pos") - reach, F.lit(0))
    near = F.when(F.col("wide"), F.slice("words", near_at + 1, F.lit(2 * reach + 1)))
    return written(chosen.select("term", "doc_id", "text_key", "pos", near.alias("near"), near_at.alias("near_at")), "postings")


def document_lengths(index: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_words) of every indexed row, repeats included."""
    return index.where(F.col("term") == END).select("doc_id", "text_key", F.col("pos").cast("long").alias("n_words"))


def phrase_matches(index: DataFrame, rarest: DataFrame) -> DataFrame:
    """(doc_id, text_key, phrase, start, length): every place of every phrase, as distinct rows.

    The rarest term's list, less the term's offset, gives the possible starts; those that the
    second term's list does not confirm are dropped by a join; the words around the first posting
    decide the rest.
    """
    first = index.where(F.col("near").isNotNull()).join(checked_broadcast(rarest), "term").select(
        "doc_id", "text_key", "phrase", "length", "second", "near", "near_at", "second_at", (F.col("pos") - F.col("at")).alias("start")
    ).where("start >= 0")
    first = first.withColumn("second_pos", F.col("start") + F.col("second_at"))
    lists = index.where(F.col("term") != END).select(
        F.col("term").alias("term2"), F.col("doc_id").alias("doc2"), F.col("text_key").alias("key2"), F.col("pos").alias("pos2")
    )
    confirmed = first.join(
        lists,
        (F.col("second") == F.col("term2")) & F.col("doc_id").eqNullSafe(F.col("doc2"))
        & (F.col("text_key") == F.col("key2")) & (F.col("second_pos") == F.col("pos2")),
        "left_semi",
    ).unionByName(first.where("second IS NULL"))
    here = F.array_join(F.slice("near", F.col("start") - F.col("near_at") + 1, F.col("length")), " ")
    return confirmed.where((F.col("start") >= F.col("near_at")) & (here == F.col("phrase"))).select(
        "doc_id", "text_key", "phrase", F.col("start").cast("long").alias("start"), "length"
    ).distinct()


def proximity_matches(index: DataFrame, rarest: DataFrame, slack: int = 5) -> DataFrame:
    """(doc_id, text_key, phrase, start, moved): places where a phrase's two rarest terms stand at most `slack` words nearer or further than in the phrase.

    Positions are dealt into bins wider than the slack, and the second list's into its bin and both
    neighbours, so the join stays on equality. Phrases of one word match where the word stands.
    """
    bin_of = lambda pos: F.floor(pos / F.lit(slack + 1))
    first = index.where(F.col("near").isNotNull()).join(checked_broadcast(rarest), "term").withColumn("start", F.col("pos") - F.col("at"))
    first = first.withColumn("expected", F.col("start") + F.coalesce("second_at", F.lit(0))).withColumn("bin", bin_of(F.col("expected")))
    other = index.where(F.col("term") != END).select(
        F.col("term").alias("term2"), F.col("doc_id").alias("doc2"), F.col("text_key").alias("key2"), F.col("pos").alias("pos2"),
        F.explode(F.array(*[bin_of(F.col("pos")) + d for d in (-1, 0, 1)])).alias("bin2"),
    )
    near = first.join(
        other,
        (F.col("second") == F.col("term2")) & F.col("doc_id").eqNullSafe(F.col("doc2")) & (F.col("text_key") == F.col("key2"))
        & (F.col("bin") == F.col("bin2")) & (F.abs(F.col("pos2") - F.col("expected")) <= slack),
    ).select("doc_id", "text_key", "phrase", "start", (F.col("pos2") - F.col("expected")).alias("moved"))
    single = first.where("second IS NULL").select("doc_id", "text_key", "phrase", "start", F.lit(0).alias("moved"))
    return near.unionByName(single).distinct()


def index_for(docs: DataFrame, windows: DataFrame, reach: int = WINDOW - 1, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The index that the windows need, and their rarest terms."""
    terms = written(windows.select(F.explode(F.split("phrase", " ")).alias("term")).distinct(), "test-terms")
    rarest = written(rarest_terms(windows, written(term_counts(docs, terms, text_col), "term-counts")), "rarest")
    needed = rarest.select("term", F.lit(True).alias("wide")).unionByName(
        rarest.where("second IS NOT NULL").select(F.col("second").alias("term"), F.lit(False).alias("wide"))
    ).groupBy("term").agg(F.max("wide").alias("wide"))
    return build_index(docs, needed, reach, id_col, text_col), rarest


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, items) of every row: words inside a test window, and the items found.

    `items` lists, as sorted distinct strings, the ids of items with a window in the text; a NULL
    item id hits words but is not listed. NULL texts have no words; an empty `items` table hits
    nothing. Repeated rows each get their row; other columns are ignored.
    """
    windows = written(phrase_windows(items, window, item_id_col, item_text_col), "windows")
    index, rarest = index_for(docs, windows, window - 1, id_col, text_col)
    matches = written(phrase_matches(index, rarest), "matches")
    key = ["doc_id", "text_key"]
    covered = matches.groupBy(*key, "start").agg(F.max("length").alias("length")).select(
        *key, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("place")
    )
    hits = covered.groupBy(*key, "place").agg(F.lit(1).alias("one")).groupBy(*key).agg(F.count(F.lit(1)).alias("n_hit"))
    listed = matches.join(windows.select("phrase", F.col("item_id").cast("string").alias("item_id")), "phrase")
    listed = listed.select(*key, "item_id").distinct().groupBy(*key).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    found = hits.join(listed, hits["doc_id"].eqNullSafe(listed["doc_id"]) & (hits["text_key"] == listed["text_key"])).select(
        hits["doc_id"].alias("found_id"), hits["text_key"].alias("found_key"), "n_hit", "items"
    )
    docs_read = document_lengths(index)
    return docs_read.join(
        found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key")), "left"
    ).select(
        *key, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs` in which no test window occurs; columns and their order stay."""
    hit = contamination(docs, items).where("n_hit > 0").select("doc_id", "text_key").distinct()
    keyed, hit = with_key(docs), written(hit, "contaminated")
    same = keyed["doc_id"].eqNullSafe(hit["doc_id"]) & (keyed["text_key"] == hit["text_key"])
    return keyed.join(hit, same, "left_anti").select("row.*")
