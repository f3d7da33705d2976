"""URL filters: rules for hosts and paths, and logistic regression on character n-grams for the rest."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from odsflow.llm.common import named

PLACES = 1 << 14
SHORTEST, LONGEST = 3, 5
STEPS, RATE, RIDGE = 400, 1.0, 1e-3
#: The labelled table is read on the driver; a larger one is refused.
MAX_LABELLED = 100_000

#: A small table of invented addresses, used unless another is named: label 1 is wanted, 0 is not.
LABELLED = Path(__file__).with_name("labelled_urls.csv")

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _after_scheme(url: Column) -> Column:
    """What follows the first `://`; empty without one or for NULL."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    found = F.instr(text, "://")
    return F.when(found > 0, F.substr(text, found + 3)).otherwise("")


def host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, UPPER.lower())


def path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def matched_rule(host_col: Column, path_col: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or NULL.

    A rule (verdict, host, path) fits its host and all subdomains if the path starts with the
    rule's. Longest is by the rule's characters; of equally long ones the smaller text wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict_text, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), _reversed(r[1] + r[2]))):
        fits = ((host_col == rule_host) | host_col.endswith("." + rule_host)) & path_col.startswith(rule_path)
        rule, verdict = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule), F.when(fits, F.lit(verdict_text)).otherwise(verdict)
    return rule, verdict


def _reversed(text: str) -> tuple:
    return tuple(-ord(c) for c in text)


# --- logistic regression ---------------------------------------------------------------------

def gram_places(host_text: str, path_text: str) -> np.ndarray:
    """Places of the character n-grams of a host and of a path (each with its edges), repeats included."""
    found = []
    for seed, text in ((1, f"^{host_text}$"), (2, f"^{path_text}$")):
        body = text.encode()
        for n in range(SHORTEST, LONGEST + 1):
            found += [xxhash.xxh64_intdigest(body[i:i + n], seed) % PLACES for i in range(len(body) - n + 1)]
    return np.array(found, dtype=np.int64)


def fit(rows: Sequence[tuple[str, str, int]], steps: int = STEPS, rate: float = RATE, ridge: float = RIDGE) -> np.ndarray:
    """Weights (the last is the bias) of logistic regression with a ridge, by gradient descent; both classes weigh alike."""
    weights = np.zeros(PLACES + 1)
    labels = np.array([r[2] for r in rows], dtype=np.float64)
    if not len(rows):
        return weights
    each = [gram_places(h, p) for h, p, _ in rows]
    owner = np.repeat(np.arange(len(each)), [len(e) for e in each])
    flat = np.concatenate(each)
    value = np.repeat([1 / np.sqrt(max(1, len(e))) for e in each], [len(e) for e in each])
    share = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    for _ in range(steps):
        margin = np.bincount(owner, value * weights[flat], len(each)) + weights[-1]
        slope = share * (1 / (1 + np.exp(-margin)) - labels)
        pull = np.append(np.bincount(flat, value * slope[owner], PLACES), slope.sum())
        pull[:-1] += ridge * weights[:-1]
        weights = weights - rate * pull
    return weights


def score(weights: np.ndarray, host_text: str, path_text: str) -> float:
    """The probability that an address is wanted."""
    at = gram_places(host_text, path_text)
    margin = weights[-1] + weights[at].sum() / np.sqrt(max(1, len(at)))
    return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def labelled_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Labelled addresses (url, label) from a CSV file with a header; without a path, the small table beside this module."""
    if path:
        return spark.read.schema("url string, label int").csv(path, header=True)
    with LABELLED.open(newline="") as lines:
        rows = [(r["url"], int(r["label"])) for r in csv.DictReader(lines)]
    return spark.createDataFrame(rows, "url string, label int")


def train(labelled: DataFrame) -> np.ndarray:
    """Weights from a small table (url, label 0/1); NULL labels are left out, tables over MAX_LABELLED rows refused."""
    rows = (
        labelled.where("label IS NOT NULL").select(host(F.col("url")).alias("h"), path(F.col("url")).alias("p"), F.col("label").cast("int"))
        .limit(MAX_LABELLED + 1).collect()
    )
    if len(rows) > MAX_LABELLED:
        raise ValueError(f"the labelled table has more than {MAX_LABELLED} rows")
    return fit(sorted(tuple(r) for r in rows))


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]], weights: np.ndarray, url_col: str = "url", threshold: float = 0.5
) -> DataFrame:
    """The rows with `host`, `path`, `rule`, `wanted` and `verdict` (allow or block).

    The longest fitting rule decides; without one the classifier does, by the probability `wanted`
    that the address is wanted. NULL and odd urls have an empty host and path, which the
    classifier judges like any other. Other columns stay; those with one of the five names are
    replaced. Nothing is shuffled.
    """
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def wanted(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        found = [score(shared.value, h.as_py() or "", p.as_py() or "") for h, p in zip(hosts, paths)]
        return pa.array(found, pa.float64())

    url = named(url_col)
    rule, verdict = matched_rule(host(url), path(url), rules)
    scored = pages.withColumns({"host": host(url), "path": path(url), "rule": rule, "verdict": verdict})
    scored = scored.withColumn("wanted", wanted(F.col("host"), F.col("path")))
    by_score = F.when(F.col("wanted") >= threshold, "allow").otherwise("block")
    return scored.withColumn("verdict", F.coalesce("verdict", by_score))
