import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from odsflow.operators.conform import Field, conform, fields_from_metadata, fill_absent
from odsflow.operators.quality import (
    REASONS, BudgetExceeded, ErrorBudget, KeySpec, budget_report, enforce_budget, in_domain, key_report, key_specs,
    key_violations, max_length, not_null, split_good_bad, with_reasons,
)


def conformed(spark, value, source_type, target, mode="lossless", **options):
    df = spark.createDataFrame([(value,)], f"v {source_type}")
    row = conform(df, [Field("v", target, **options)], mode).first()
    return row["v"], row[REASONS]


@pytest.mark.parametrize(
    "value, source_type, target, expected, reasons",
    [
        ("12.34", "string", "decimal(12,2)", Decimal("12.34"), []),
        ("12.345", "string", "decimal(12,2)", Decimal("12.35"), ["v:changed"]),
        ("1.2345e1", "string", "decimal(12,2)", Decimal("12.35"), ["v:changed"]),
        ("12.340", "string", "decimal(12,2)", Decimal("12.34"), []),
        ("99999999999", "string", "int", None, ["v:type"]),
        ("abc", "string", "int", None, ["v:type"]),
        (None, "string", "int", None, []),
        (12.5, "double", "int", 12, ["v:changed"]),
        (12.0, "double", "int", 12, []),
        (12.35, "double", "decimal(12,2)", Decimal("12.35"), []),
        (Decimal("1.25"), "decimal(10,2)", "decimal(10,1)", Decimal("1.3"), ["v:changed"]),
        (Decimal("1000.00"), "decimal(10,2)", "tinyint", None, ["v:type"]),
        (300, "bigint", "tinyint", None, ["v:type"]),
        ("2024-13-01", "string", "date", None, ["v:type"]),
        ("2024-12-01", "string", "date", dt.date(2024, 12, 1), []),
        (True, "boolean", "tinyint", 1, []),
        ("0.1234567890123456789012345678901234567800", "string", "decimal(38,38)",
         Decimal("0.12345678901234567890123456789012345678"), []),
        ("0.123456789012345678901234567890123456789", "string", "decimal(38,38)",
         Decimal("0.12345678901234567890123456789012345679"), ["v:changed"]),
    ],
)
def test_casts_and_losses(spark, value, source_type, target, expected, reasons):
    assert conformed(spark, value, source_type, target) == (expected, reasons)


def test_reference_mode_lets_rounding_pass(spark):
    assert conformed(spark, "12.345", "string", "decimal(12,2)", "reference") == (Decimal("12.35"), [])


def test_rules_of_a_field(spark):
    assert conformed(spark, None, "string", "string", required=True)[1] == ["v:null"]
    assert conformed(spark, "abcd", "string", "string", length=3)[1] == ["v:length"]
    assert conformed(spark, "x", "string", "string", domain=("a", "b"))[1] == ["v:domain"]
    assert conformed(spark, None, "string", "string", domain=("a", "b"))[1] == []


def test_defaults_fill_absent_columns_only(spark):
    df = spark.createDataFrame([(1, None)], "id int, kept string")
    fields = [
        Field("id", "int"),
        Field("kept", "string", default="x"),
        Field("flag", "int", default="7"),
        Field("none", "string", default="NULL"),
        Field("nothing", "date"),
        Field("stamp", "timestamp", default="CURRENT_TIMESTAMP"),
    ]
    row = fill_absent(df, fields).first()
    assert (row["kept"], row["flag"], row["none"], row["nothing"]) == (None, 7, None, None)
    assert row["stamp"] is not None


def test_comments_travel_with_the_table(spark, tmp_path):
    df = spark.range(2).select(F.col("id").cast("string").alias("ID"))
    good, _ = split_good_bad(conform(df, [Field("id", "bigint", source="ID", comment="the key")]))
    good.write.parquet(str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).schema["id"].metadata == {"comment": "the key"}


def test_fields_from_metadata():
    rows = [
        {"column_name": "ID", "column_type": "int(10) unsigned", "is_nullable": "NO", "column_comment": None},
        {"column_name": "Price", "column_type": "decimal(8,3)", "is_nullable": "YES", "column_default": "0.5"},
    ]
    first, second = fields_from_metadata(rows)
    assert (first.name, first.source, first.type, first.required) == ("id", "ID", "bigint", True)
    assert (second.type, second.required, second.default) == ("decimal(8,3)", False, "0.5")


def test_split_keeps_every_row_and_names_all_reasons(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("abcdef", 3), ("z", 4)], "s string, n int")
    rules = [not_null("s"), max_length("s", 3), in_domain("s", ["a", "abcdef"])]
    good, bad = split_good_bad(df, rules)
    assert [tuple(r) for r in good.collect()] == [("a", 1)]
    found = {r["n"]: r[REASONS] for r in bad.collect()}
    assert found == {2: ["s:null"], 3: ["s:length"], 4: ["s:domain"]}
    again = with_reasons(with_reasons(df, rules[:1]), rules[1:])
    assert again.filter(F.size(REASONS) > 0).count() == 3


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "d"), (None, "d")], "k int, s string")
    primary = {(r["k"], r["s"], r["row_cnt"]) for r in key_violations(df, ["k", "s"]).collect()}
    assert primary == {(1, "a", 2), (None, "c", 1), (None, "d", 2)}
    unique = {tuple(r) for r in key_violations(df, ["k", "s"], primary=False).collect()}
    assert unique == {(1, "a", 2)}


@pytest.mark.parametrize(
    "budget, fits",
    [
        (ErrorBudget(), False),
        (ErrorBudget(records=None, share=0.02), True),
        (ErrorBudget(records=2, share=None), True),
        (ErrorBudget(records=1, share=None), False),
        (ErrorBudget(records=None, share=0.019), False),
        (ErrorBudget(None, None), True),
    ],
)
def test_budget(spark, budget, fits):
    df = with_reasons(spark.range(100), [])
    df = df.withColumn(REASONS, F.when(F.col("id") < 2, F.array(F.lit("bad"))).otherwise(F.col(REASONS)))
    assert budget_report(df, budget).first()["within_budget"] is fits
    if fits:
        assert enforce_budget(df, budget) == (100, 2)
    else:
        with pytest.raises(BudgetExceeded):
            enforce_budget(df, budget)


def test_budget_of_an_empty_table(spark):
    assert enforce_budget(with_reasons(spark.range(0), []), ErrorBudget()) == (0, 0)


def test_keys_declared_by_an_index_listing(spark):
    listing = spark.createDataFrame(
        [("Users", "PRIMARY", 0, 2, "B"), ("Users", "PRIMARY", 0, 1, "A"), ("Users", "uk_c", 0, 1, "C"),
         ("Users", "ix", 1, 1, "A"), ("Other", "PRIMARY", 0, 1, "A")],
        "TABLE_NAME string, INDEX_NAME string, NON_UNIQUE int, SEQ_IN_INDEX int, COLUMN_NAME string",
    )
    specs = key_specs(listing, "users")
    assert specs == [KeySpec("PRIMARY", ("a", "b"), True), KeySpec("uk_c", ("c",))]
    df = spark.createDataFrame([(1, 1, None), (1, 1, None), (1, 2, "x"), (None, 1, "x"), (3, 1, "y")], "a int, b int, c string")
    rows = {r["key_name"]: (r["key_columns"], r["broken_keys"], r["rows_hit"]) for r in key_report(df, specs).collect()}
    assert rows == {"PRIMARY": ("a,b", 2, 3), "uk_c": ("c", 1, 2)}
    assert [r["broken_keys"] for r in key_report(df.limit(0), specs).collect()] == [0, 0]
