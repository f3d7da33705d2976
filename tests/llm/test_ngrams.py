import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from odsflow.llm import ngrams
from odsflow.llm.ngrams import ACROSS, ORDER, WITHIN, Grams, HashArrays, Words, folded, log_table, symbol, word_lines
from odsflow.llm.quality import BAND, FEW_TEXTS, LEAST, NORMAL, quality_rules

from .conftest import bag
from .test_quality import brute_counts


def line_of(text):
    words = (text or "").encode().split()
    return " " * (ORDER - 1) + b" ".join(words).decode() + " " if words else ""


def cut(line, sign):
    line = "".join(chr(sign(ord(c))) for c in line)
    return [line[i:i + ORDER] for i in range(len(line) - ORDER + 1)]


def brute_grams(text):
    """The n-grams of a text under either model."""
    words = (text or "").encode().split()
    return {
        ACROSS: cut(line_of(text), folded),
        WITHIN: [g for w in words for g in cut(" " * (ORDER - 1) + w.decode() + " ", symbol)],
    }


def brute_log(counts):
    """log p of every gram under `counts`, by recursion."""
    levels = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        levels[n] = {g: 0 for g in {h[1:] for h in levels[n + 1]}}
        for h, c in levels[n + 1].items():
            levels[n][h[1:]] += c > 0
    followers = {n: defaultdict(list) for n in levels}
    for n, level in levels.items():
        for h, c in level.items():
            followers[n][h[:-1]].append(c)
    discounts = {}
    for n, level in levels.items():
        have = Counter(level.values())
        y = have[1] / (have[1] + 2 * have[2]) if have[1] + 2 * have[2] else 0.5
        discounts[n] = {k: max(0.05, min(k - 0.05, k - (k + 1) * y * have[k + 1] / have[k] if have[k] else 0.5 * k)) for k in (1, 2, 3)}

    def p(g):
        n = len(g)
        if not n:
            return 1 / len(levels[1])
        d, after = discounts[n], followers[n][g[:-1]]
        if not sum(after):
            return p(g[1:])
        off = [min(d[min(3, max(1, c))], c) for c in after]
        c = levels[n][g]
        return (c - min(d[min(3, max(1, c))], c) + sum(off) * p(g[1:])) / sum(after)

    return {g: math.log(p(g)) for g in counts}


TEXTS = ["The cat sat", "", "日本 ok\U0001f600 Ёлка", "a", "\u0000x y\u0000", "the #1 «cat»", "Дом", " \n"]


def test_grams_run_across_words_over_true_code_points():
    words = Words(pa.array(TEXTS))
    found = Grams(words.lines(), folded)
    spelled = ngrams.strings(found.codes).to_pylist()
    assert [spelled[i] for i in found.which] == [g for t in TEXTS for g in brute_grams(t)[ACROSS]]
    assert found.counts.tolist() == [len(brute_grams(t)[ACROSS]) for t in TEXTS]
    assert len(set(spelled)) == len(spelled) and "t sat" in spelled and " дом " in spelled
    assert [len(x) for x in (Grams(pa.array([], pa.string()), folded).codes, Grams(pa.array(["", "abc"]), folded).which)] == [0, 0]


def test_grams_within_words():
    words = Words(pa.array(TEXTS))
    found = Grams(word_lines(words.each), symbol)
    spelled = ngrams.strings(found.codes).to_pylist()
    each = np.split(found.which, np.cumsum(found.counts)[:-1])
    assert [spelled[i] for w in words.which for i in each[w]] == [g for t in TEXTS for g in brute_grams(t)[WITHIN]]
    assert [symbol(ord(c)) for c in "aZé7.#д日\u2028 "] == [ord(c) for c in "aze0.#@@~ "]


def test_alphabets_too_large_for_one_number():
    many = "".join(chr(0x4E00 + i) for i in range(6000)) * 2
    found = Grams(Words(pa.array([many])).lines(), folded)
    spelled = ngrams.strings(found.codes).to_pylist()
    assert [spelled[i] for i in found.which] == brute_grams(many)[ACROSS]
    assert (ngrams.code_rows(pa.array(spelled)) == found.codes).all()


def test_counts_do_not_depend_on_batches(spark, docs, rows):
    own = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.pmod(F.hash("doc_id"), F.lit(2)).alias("fold"), F.coalesce("text", F.lit("")).alias("body"))
    expected = Counter()
    for lang, fold, body in own.collect():
        for model, found in brute_grams(body).items():
            expected.update((model + lang, g, fold) for g in found)
    got = Counter()
    for slot, gram, c0, c1 in own.mapInArrow(ngrams.count_grams, ngrams.COUNTED).collect():
        got.update({(slot, gram, 0): c0, (slot, gram, 1): c1})
    assert +got == expected


def test_full_tasks_send_counts_on(monkeypatch):
    monkeypatch.setattr(ngrams, "HELD", 4)
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "de"] * 3, "fold": pa.array([0, 0, 1] * 2, pa.int32()), "body": ["ab cd", "ef", "ab", "", "x y", "ab"]})
    total = Counter()
    for part in ngrams.count_grams(iter([batch] * 3)):
        for slot, gram, c0, c1 in zip(*[c.to_pylist() for c in part.columns]):
            total.update({(slot, gram, 0): c0, (slot, gram, 1): c1})
    expected = Counter()
    for lang, fold, body in zip(*batch.to_pydict().values()):
        for model, found in brute_grams(body).items():
            expected.update((model + lang, g, fold) for g in found * 3)
    assert +total == expected


def test_probabilities_come_from_the_other_fold(spark):
    rng = random.Random(3)
    folds = [Counter(g for _ in range(30) for g in brute_grams(" ".join(rng.choice(("aba", "bad", "cab", "da")) for _ in range(6)))[ACROSS]) for _ in (0, 1)]
    folds[1].update(brute_grams("ddd zz")[ACROSS])
    every = sorted(set(folds[0]) | set(folds[1]))
    table = spark.createDataFrame([("aen", g, folds[0][g], folds[1][g]) for g in every], "slot string, gram string, c0 long, c1 long")
    got = {r["gram"]: (r["log0"], r["log1"]) for r in log_table(table).collect()}
    by0, by1 = (brute_log({g: f[g] for g in every}) for f in folds)
    assert got == {g: (pytest.approx(by1[g]), pytest.approx(by0[g])) for g in every}


def test_probabilities_after_a_context_sum_to_one(spark):
    """Over the code points of a language; those never counted after the context come from the orders below."""
    rng = random.Random(5)
    counts = Counter("".join(rng.choice("abc") for _ in range(ORDER)) for _ in range(150))
    alphabet = "abc"
    every = {g[:-1] + c for g in counts for c in alphabet}
    logs = brute_log({g: counts[g] for g in every})
    table = spark.createDataFrame([("a", g, counts[g], counts[g]) for g in every], "slot string, gram string, c0 long, c1 long")
    got = {r["gram"]: r["log0"] for r in log_table(table).collect()}
    assert got == {g: pytest.approx(x) for g, x in logs.items()}
    for context in {g[:-1] for g in counts}:
        assert sum(math.exp(got[context + c]) for c in alphabet) == pytest.approx(1.0)


def test_hash_arrays_find_what_they_hold():
    grams = ["abcde", "bcdef", "日本 ok", "\U0001f600bcde"]
    rows = pa.table({"slot": ["aen", "aen", "wde", "aen"], "gram": grams, "log0": [-1.0, -2.0, -3.0, -4.0], "log1": [-5.0, -6.0, -7.0, -8.0]})
    arrays = HashArrays.of(rows)
    assert (np.diff(arrays.keys.astype(object)) > 0).all()
    at, there = arrays.find(ngrams.hashes(ngrams.code_rows(pa.array(grams)), ngrams.slot_seed("aen")))
    assert there.tolist() == [True, True, False, True] and arrays.logs[1][at[there]].tolist() == [-5.0, -6.0, -8.0]
    empty = HashArrays.of(rows.slice(0, 0))
    assert not empty.find(np.array([5], np.uint64))[1].any()


# --- the verdict against a dictionary-based model --------------------------------------------------

def lower_median(values):
    values = sorted(values)
    return values[(len(values) + 1) // 2 - 1]


def brute_verdicts(rows, fold_of):
    """Per row (doc_id, base_failed, kept) by dictionaries and lists."""
    texts = [(i, t or "", lang or "") for i, t, lang in rows]
    scores = {}
    for model in (ACROSS, WITHIN):
        for lang in {x[2] for x in texts}:
            own = [x for x in texts if x[2] == lang]
            counts = [Counter(g for _, t, _ in own if model == WITHIN or fold_of[t] == f for g in brute_grams(t)[model]) for f in (0, 1)]
            every = set(counts[0]) | set(counts[1])
            logs = [brute_log({g: counts[1 - f][g] for g in every}) if every else {} for f in (0, 1)]
            for _, t, _ in own:
                found = brute_grams(t)[model]
                scores[model, lang, t] = -sum(logs[fold_of[t]][g] for g in found) / len(found) if found else None
    failed = {t: brute_counts(t)[0] < 50 or 100 * brute_counts(t)[4] > 50 * brute_counts(t)[0] for _, t, _ in texts}
    limits = {}
    for model in (ACROSS, WITHIN):
        usable = {lang: [scores[model, lang, t] for t in {x[1] for x in texts if x[2] == lang} if not failed[t]] for lang in {x[2] for x in texts}}
        usable = {lang: v for lang, v in usable.items() if v}
        middle = {lang: lower_median(v) for lang, v in usable.items()}
        common = lower_median([abs(x - middle[lang]) / middle[lang] for lang, v in usable.items() for x in v])
        for lang, v in usable.items():
            own = lower_median([abs(x - middle[lang]) for x in v])
            reach = max(own, common * middle[lang]) if len(v) < FEW_TEXTS else own
            wide = max(BAND * NORMAL * reach, LEAST * middle[lang])
            limits[model, lang] = middle[lang] - wide, middle[lang] + wide
    return [
        (i, failed[t], not failed[t] and all(limits[m, lang][0] <= scores[m, lang, t] <= limits[m, lang][1] for m in (ACROSS, WITHIN)))
        for i, t, lang in texts
    ]


def varied_rows():
    rng = random.Random(21)
    words = {"en": ["the", "cat", "sat", "Matter", "on", "of."], "fr": ["lé", "chat", "dort,", "sur", "là"], None: ["日本", "ok", "Ёлка"]}
    rows = []
    for n in range(70):
        lang = rng.choice([*words, "en", "fr"])
        odd = n % 9 == 0
        made = ["".join(rng.choice("qxz#é7") for _ in range(4)) if odd and rng.random() < 0.6 else rng.choice(words[lang]) + rng.choice("abcd") for _ in range(rng.randrange(40, 90))]
        rows.append((n, " ".join(made), lang))
    return [*rows, (900, rows[3][1], rows[3][2]), (901, None, "en"), (902, "", None)]


@pytest.mark.parametrize("share", [ngrams.FREQUENT, 0.004])
def test_verdicts_equal_those_of_dictionaries(spark, monkeypatch, share):
    """Also with most n-grams looked up in hash partitions."""
    monkeypatch.setattr(ngrams, "FREQUENT", share)
    rows = varied_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    keyed = df.select(F.coalesce("text", F.lit("")).alias("t"), F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(2)).alias("fold"))
    expected = brute_verdicts(rows, {r["t"]: r["fold"] for r in keyed.collect()})
    got = [(r["doc_id"], r["base_failed"], r["kept"]) for r in quality_rules(df).collect()]
    assert bag(got) == bag(expected)
    assert {True, False} == {kept for _, failed, kept in expected if not failed}


def judged(spark, rows):
    found = quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    return {r["doc_id"]: r for r in found if not r["base_failed"]}


def test_shuffled_words_and_gibberish_of_another_script_are_rejected(spark):
    rng = random.Random(11)
    letters = {"en": ("trnmld", "aeiou", "sghkpb"), "ru": ("трнмлд", "аеиоу", "сгхкпб")}  # the words of place k begin and end with letter k
    parts = {
        lang: [[first + "".join(rng.choice(inner) for _ in range(3)) + last for _ in range(20)] for first, last in zip(begin, end)]
        for lang, (begin, inner, end) in letters.items()
    }
    rows = [(i + 1000 * k, " ".join(rng.choice(p) for _ in range(40) for p in parts[lang]), lang) for k, lang in enumerate(parts) for i in range(80)]
    for i in range(4):
        words = rows[i][1].split()
        rng.shuffle(words)
        rows.append((500 + i, " ".join(words), "en"))
        signs = list("".join(rows[80 + i][1].split()))
        rng.shuffle(signs)
        ends = [len(w) for w in rows[80 + i][1].split()]
        rows.append((1500 + i, " ".join("".join(signs.pop() for _ in range(n)) for n in ends), "ru"))
    found = judged(spark, rows)
    assert not any(found[i]["kept"] for i in (*range(500, 504), *range(1500, 1504)))
    assert sum(i % 1000 < 80 for i in found) > 150
    assert sum(r["kept"] for i, r in found.items() if i % 1000 < 80) >= 0.97 * sum(i % 1000 < 80 for i in found)
