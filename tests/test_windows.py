from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helpers import at, day, plan, rows
from tallyframe.operators.aggregates import check_nonzero
from tallyframe.operators.filters import filter_by_window, for_report_dates, select_named
from tallyframe.operators.joins import densify, left_join, semi_chain
from tallyframe.operators.sorting import sample_n
from tallyframe.operators.windows import (
    close_intervals, day_running_sum, holiday_islands, latest_version, partition_total,
    running_sum,
)
from tallyframe.plans.calendar import calendar_of, next_workday
from tallyframe.plans.payments import posting_window

import pytest


def test_latest_version_breaks_ties_by_the_second_key(spark):
    log = spark.createDataFrame([
        ("a", at("2024-01-01 10:00"), 1, "old"), ("a", at("2024-01-01 10:00"), 2, "new"),
        ("b", None, 9, "no time"), ("b", at("2023-01-01"), 1, "timed"), (None, at("2024-01-01"), 1, "null key")],
        "k string, ts timestamp, id int, v string")
    out = latest_version(log, ["k"], ["ts", "id"])
    assert rows(out, "k", "v") == [("a", "new"), ("b", "timed"), (None, "null key")]
    assert plan(out).count("WindowGroupLimit") >= 2  # one before the shuffle, one after


def calendar(spark, flags, start="2024-01-01"):
    first = day(start)
    return spark.createDataFrame(
        [(first + timedelta(days=i), f == "T") for i, f in enumerate(flags)], "calendar_date date, holiday_flag boolean")


def test_islands_with_a_one_day_gap(spark):
    out = holiday_islands(calendar(spark, "FTTFTF"))
    assert rows(out) == [(day("2024-01-01"), day("2024-01-04")), (day("2024-01-04"), day("2024-01-06"))]


@pytest.mark.parametrize("flags, expected", [
    ("TTFFT", [(1, 3), (4, 6)]),  # a run that opens the calendar, and one that ends it
    ("FFFF", []), ("FTFTFTF", [(1, 3), (3, 5), (5, 7)]), ("TFT", [(1, 2), (2, 4)]), ("FFTTTTFFTTF", [(2, 7), (8, 11)]),
])
def test_islands_by_hand(spark, flags, expected):
    found = holiday_islands(calendar(spark, flags))
    assert rows(found) == [(day(f"2024-01-{a:02d}"), day(f"2024-01-{b:02d}")) for a, b in expected]


@pytest.mark.parametrize("as_of, expected", [
    ("2024-01-13", [("2024-01-12", "2024-01-14")]), ("2024-01-15", [("2024-01-12", "2024-01-14")]),
    ("2024-01-12", []), ("2024-01-16", []),
])
def test_posting_window(spark, as_of, expected):
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-31')) AS d")
    got = rows(posting_window(calendar_of(days, "d"), day(as_of)))
    assert got == [(day(a), day(b)) for a, b in expected]


def test_filter_by_window_falls_back_to_a_day(spark):
    facts = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-10')) AS d")
    window = spark.sql("SELECT DATE'2024-01-03' AS a, DATE'2024-01-05' AS b")
    assert filter_by_window(facts, "d", window, "a", "b", day("2024-01-08")).count() == 3
    assert rows(filter_by_window(facts, "d", window.where("false"), "a", "b", day("2024-01-08"))) == [(day("2024-01-08"),)]


def test_next_workday(spark):
    cal = calendar(spark, "FTTF")
    assert rows(next_workday(cal, day("2024-01-02"))) == [(day("2024-01-04"), 4)]
    assert rows(next_workday(cal, day("2024-01-05"))) == [(None, None)]


events = st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", None]), st.integers(0, 200), st.integers(-50, 50)),
                  min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events)
def test_blocked_forms_equal_plain_windows(spark, data):
    df = spark.createDataFrame([(k, m, i, v) for i, (k, m, v) in enumerate(data)], "k string, m int, id int, v bigint")
    upto = W.partitionBy("k").orderBy("m", "id").rowsBetween(W.unboundedPreceding, 0)
    plain = df.withColumn("s", F.sum("v").over(upto))
    blocked = running_sum(df, ["k"], ["m", "id"], "v", "s", F.floor(F.col("m") / 10))
    assert rows(blocked, "k", "m", "id", "s") == rows(plain, "k", "m", "id", "s")

    totals = df.withColumn("t", F.sum("v").over(W.partitionBy("k")))
    assert rows(partition_total(df, ["k"], t=F.sum("v")), "k", "id", "t") == rows(totals, "k", "id", "t")

    by_day = df.withColumn("s", F.sum("v").over(W.partitionBy("k").orderBy("m"))).select("k", "m", "s").distinct()
    assert rows(day_running_sum(df, ["k"], "m", F.col("v"), "s"), "k", "m", "s") == rows(by_day, "k", "m", "s")


def test_close_intervals(spark):
    df = spark.createDataFrame([("a", day("2024-01-05")), ("a", day("2024-01-01")), ("b", day("2024-01-03"))], "k string, s date")
    assert rows(close_intervals(df, ["k"], "s", "e")) == [
        ("a", day("2024-01-01"), day("2024-01-04")), ("a", day("2024-01-05"), date(2100, 12, 31)),
        ("b", day("2024-01-03"), date(2100, 12, 31))]


def test_left_join_equals_the_built_in(spark):
    a = spark.createDataFrame([(1,), (2,), (3,), (None,)], "x int")
    b = spark.createDataFrame([(1, "p"), (1, "q"), (4, "r"), (None, "n")], "y int, v string")
    expected = rows(a.join(b, a.x == b.y, "left"), "x", "y", "v")
    assert rows(left_join(a, b, "x", "y"), "x", "y", "v") == expected


def test_semi_chain_does_not_multiply(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id int, fk int")
    link = spark.createDataFrame([(10, 7), (10, 7), (20, 8)], "a int, b int")
    end = spark.createDataFrame([(7,), (7,)], "c int")
    out = semi_chain(facts, "fk", [(link, "a", "b"), (end, "c", None)])
    assert rows(out) == [(1, 10)]
    assert plan(out).count("LeftSemi") >= 2


def test_densify_fills_every_type(spark):
    facts = spark.createDataFrame([("x", "A", 5)], "k string, t string, v int")
    out = densify(spark.createDataFrame([("x",), ("y",)], "k string"), "t", ["A", "B"], facts, ["k"], {"v": F.lit(0)})
    assert rows(out, "k", "t", "v") == [("x", "A", 5), ("x", "B", 0), ("y", "A", 0), ("y", "B", 0)]
    assert "Cartesian" not in plan(out) and "NestedLoop" not in plan(out)


def test_net_zero_hides_differences_that_gross_shows(spark):
    df = spark.createDataFrame([(5,), (-5,)], "diff int")
    assert rows(check_nonzero(df, "diff")) == [(False, True, 2)]
    assert rows(check_nonzero(df.where("false"), "diff")) == [(False, False, 0)]


def test_select_named(spark):
    df = spark.createDataFrame([("a",), ("b",)], "name string")
    assert select_named(df, None).count() == 2
    assert select_named(df, []).count() == 0
    assert select_named(df, ["b", "unknown"]).count() == 1


def test_for_report_dates(spark):
    df = spark.createDataFrame([(day("2024-02-10"),), (day("2024-03-10"),), (day("2020-01-01"),)], "d date")
    out = for_report_dates(df, "d", [day("2024-03-05"), day("2024-03-20"), day("2024-04-01")])
    assert rows(out) == [(day("2024-02-10"), day("2024-03-05")), (day("2024-02-10"), day("2024-03-20")),
                         (day("2024-03-10"), day("2024-04-01"))]
    assert rows(for_report_dates(df, "d", [])) == []


def test_sample_needs_an_order(spark):
    with pytest.raises(ValueError):
        sample_n(spark.range(3), 1)
