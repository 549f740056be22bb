from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import D, rows
from tallyframe import RunParams
from tallyframe.functions import (
    account_class, apply_mask, classify, explode_json_array, json_field, map_value, money_round, norm_id, render,
    report_dates, safe_name, signed, to_flag,
)
from tallyframe.params import previous_month


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(name) for name, c in cols.items()]).first().asDict()


def test_report_dates_on_the_last_day_of_a_year(spark):
    params = RunParams.for_offset(date(2022, 1, 1), -1, datetime(2022, 1, 1, 6, 5, 4))
    got = one(spark, **report_dates(F.lit(params.as_of), F.lit(params.run_ts)))
    assert got == {
        "DT": "2021-12-31", "DT_SLASH": "2021/12/31", "PREV_CYR_MONTH": "ноябрь 2021",
        "PREV_CYR_MONTH_SLASH": "2021/11", "CYR_DT": '"31" декабря 2021', "CYR_DT_1ST": '"01" декабря 2021',
        "DTTM": "2022-01-01 06_05_04",
    }


def test_previous_month_crosses_the_year():
    assert previous_month(date(2024, 1, 31)) == (date(2023, 12, 1), date(2024, 1, 1))
    assert previous_month(date(2024, 3, 1)) == (date(2024, 2, 1), date(2024, 3, 1))


@pytest.mark.parametrize("template, fields, slash, expected", [
    ("{area}: {level}", {"area": "north", "level": "17", "unused": "z"}, None, "north: 17"),
    ("{path}", {"path": "x/y/z"}, None, "x/y/z"),
    ("keep/{path}", {"path": "x/y/z"}, "+", "keep/x+y+z"),
    ("{n} of {n}", {"n": 7}, None, "7 of 7"),
    ("plain", {}, None, "plain"),
    ("<{a}>", {"a": None}, None, "<>"),
])
def test_render(spark, template, fields, slash, expected):
    got = one(spark, t=render(template, {k: F.lit(v) for k, v in fields.items()}, slash))
    assert got["t"] == expected


def test_render_refuses_unknown_fields(spark):
    with pytest.raises(KeyError):
        render("{known} {unknown}", {"known": F.lit("x")})


def test_ids_and_flags(spark):
    df = spark.createDataFrame(
        [("123.0000000000", "1"), ("45", "0"), ("12x", "true"), (None, None), ("7.5", "2")], "id string, flag string")
    assert [tuple(r) for r in df.select(norm_id(F.col("id")), to_flag(F.col("flag"))).collect()] == [
        (123, True), (45, False), (None, True), (None, None), (None, None)]
    numbers = spark.createDataFrame([(D("12.0000000000"), 1, True), (D("3.0000000000"), 0, False)],
                                    "id decimal(38,10), flag int, b boolean")
    assert [tuple(r) for r in numbers.select(
        norm_id(F.col("id")), to_flag(F.col("flag")), to_flag(F.col("b"))).collect()] == [(12, True, True), (3, False, False)]
    assert one(spark, c=account_class(F.lit("30232810500000000001")))["c"] == "30232"


def test_masks(spark):
    got = one(
        spark, money=apply_mask(F.lit(D("1234567.50")), "N", "#,#0.00"), plain=apply_mask(F.lit(21.1234), "N", "%.2f"),
        zero=apply_mask(F.lit(D("0.00")), "N", "#,#0.00"), day=apply_mask(F.lit(date(2025, 3, 17)), "D", "yyyy-mm-dd"),
        text=apply_mask(F.lit("x"), "S"))
    assert got == {"money": "1,234,567.50", "plain": "21.12", "zero": "0.00", "day": "2025-03-17", "text": "x"}
    with pytest.raises(ValueError):
        apply_mask(F.lit(1), "Z")


def test_rules_take_the_first_match(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    cls = classify([("small", F.col("x") < 3), ("any", F.col("x").isNotNull())], "none")
    assert [r[0] for r in df.select(cls).collect()] == ["small", "any", "none"]
    assert [r[0] for r in df.select(map_value(F.col("x"), {1: "one"})).collect()] == ["one", None, None]


def test_money(spark):
    df = spark.createDataFrame([(D("2.50"), True), (D("2.50"), False), (D("2.50"), None)], "x decimal(18,2), r boolean")
    assert [r[0] for r in df.select(signed(F.col("x"), F.col("r"))).collect()] == [D("-2.50"), D("2.50"), D("2.50")]
    assert one(spark, x=money_round(F.lit(D("1.005"))))["x"] == D("1.01")


def test_json(spark):
    df = spark.createDataFrame([
        (1, '{"result": " ok ", "paths": ["a.csv", "b/c.csv"]}'), (2, '{"paths": []}'), (3, "{}"), (4, "no json")],
        "id int, etc string")
    fields = df.select("id", json_field(F.col("etc"), "result").alias("result"), json_field(F.col("etc"), "paths").alias("paths"))
    paths = F.when(F.col("paths") != "", F.col("paths"))
    assert rows(explode_json_array(fields, paths, "path"), "id", "result", "path") == [
        (1, "ok", "a.csv"), (1, "ok", "b/c.csv"), (2, "", ""), (3, "", ""), (4, "", "")]
    assert one(spark, n=safe_name(F.lit("10/7 A")))["n"] == "10_7 A"


def test_sql_args_bind_dates(spark):
    args = RunParams(date(2024, 10, 2), datetime(2024, 10, 3)).sql_args()
    row = spark.sql("SELECT :as_of AS d, :month_lo AS lo, :month_hi AS hi, '{x}' AS brace", args=args).first()
    assert tuple(row) == (date(2024, 10, 2), date(2024, 9, 1), date(2024, 10, 1), "{x}")
