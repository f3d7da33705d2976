import random

import pytest

from odsflow.llm.common import for_workers

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, body string, size string, print string"
WORDS = [a + b for a in ("ka", "lo", "mi", "Ru", "té", "so") for b in ("n", "ra", "ti.", "s", "é", "2")]


@pytest.fixture(scope="session", autouse=True)
def package_on_workers(spark):
    for_workers(lambda session: None)(spark)


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def odd_texts() -> list[tuple]:
    """(doc_id, text, lang, source): copies, near copies, shared passages, NULLs, empty, blank, very long, ties, repeats."""
    passage = prose(100, 70)
    rows = [(i, prose(i, 60 + 7 * i), "en", f"s{i % 3}") for i in range(8)]
    rows += [(20 + i, prose(1, 67), "en", "s1") for i in range(3)]  # copies of 1
    rows += [(30, prose(2, 74) + " extra", "de", "s2"), (31, "Odd " + prose(2, 74), "de", None)]
    rows += [(40 + i, prose(50 + i, 30) + "\n" + passage + "\t" + prose(60 + i, 20 * i), "fr", "s0") for i in range(4)]
    rows += [(50, passage + " " + passage, None, "s0"), (51, "ab " * 400, "en", "s1"), (52, "x" * 900, "en", "s1")]
    rows += [(60, None, None, None), (61, "", "en", "s0"), (62, " \n\t\x0b\x0c\r ", "en", "s0"), (63, "one", "en", "s9")]
    rows += [(None, prose(3, 81), "en", "s0"), (None, "no id here ½ 日本 <|endoftext|> A'LL", "xx", ""), (70, prose(70, 9000), "en", "s0")]
    rows += [(71, prose(5, 95), "en", "s2"), (71, prose(5, 95), "en", "s2"), (71, prose(6, 102), "en", "s2")]  # repeated rows, one id
    rows += [(80, "\n".join(["same line here"] * 9), "en", "s1"), (-5, prose(4, 88), "en", "s1")]
    return rows


@pytest.fixture(scope="session")
def rows():
    return odd_texts()


@pytest.fixture(scope="session")
def docs(spark, rows):
    made = [(i, t, lang, s, None if t is None else len(t), "r", "b", "z", "p") for i, t, lang, s in rows]
    return spark.createDataFrame(made, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(rows):
    return sorted((tuple(r) for r in rows), key=repr)
