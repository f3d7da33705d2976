"""The training-data pipeline over `documents`: rejects, de-duplicates, decontaminates, mixes and tokenises.

STAGES lists (name, function). A function takes (spark, docs, sf_dir) and returns the rows that go
on, with the columns of `docs`; the last returns one row per document of the token files. `run` writes each stage's rows
to the cluster's shared folder as Parquet and hands the reread rows to the next.

NULL texts are empty texts in every stage, empty tables pass through as empty tables, and further
columns of `docs`, whatever their names, stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from odsflow.llm import classifier, contamination, mixing, packed, simhash
from odsflow.llm.common import for_workers, lean_workers, named, written
from odsflow.llm.queries import MOST, source_targets
from odsflow.session import scratch_path
from odsflow.sources.tables import read_table


def _rows(docs: DataFrame, **columns) -> DataFrame:
    """Each whole row as the struct `row`, beside columns of its own for a stage to work on."""
    return docs.select(F.struct(*[named(c) for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in columns.items()])


@for_workers
@lean_workers
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out what the classifier rejects (a score below 0.3), fitted on the labelled and unlabelled rows of `docs`."""
    model = classifier.train(docs, read_table(spark, sf_dir, "labels"))
    scored = classifier.with_quality(_rows(docs, text=F.col("text")), model, threshold=0.3)
    return scored.where("predicted = 1").select("row.*")


@for_workers
@lean_workers
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves the document of the smallest id of each near-duplicate group: 3-word shingles, at most 3 differing bits."""
    return simhash.keep_one(docs, shingle=3, radius=3)


@for_workers
@lean_workers
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents in which a ten-word window of `benchmark` occurs."""
    return contamination.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


@for_workers
@lean_workers
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document 0, 1 or 2 times, so that the sources come near their shares of 150 % of all words; twice means two rows."""
    own = _rows(docs, doc_id=F.col("doc_id"), source=F.col("source"), size=mixing.word_count(F.col("text")))
    quotas, _ = source_targets(written(own.select("source", "size"), "sizes"))
    mixed = mixing.mix(own.withColumn("members", F.array("source")), quotas, copies=MOST)
    return mixed.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies_taken")))).select("row.*")


@for_workers
@lean_workers
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns (doc_id, start, n_tokens, ids_crc32) of every row, read back from them."""
    path = f"{scratch_path(spark, 'token-ids')}/ids"
    packed.write_ids(docs, path, "word_bpe_49k.json", end_id=2)
    return packed.read_digests(spark, path)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mix),
    ("token ids", token_ids),
]

#: SQL can express neither the classifier nor SimHash; tests/llm compare with a brute-force version.
ORACLE_SQL = None


@for_workers
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the rows of the last."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
