"""Sources, sinks, delivery and contracts."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import at, day, plan, rows
from tallyframe import session
from tallyframe.delivery import (
    check_contract, contract_problems, deliver, digest, display_contract, fill_rows, freshness, log_row, log_run,
    log_view, outbox, outcome, route, run_status, satisfied, undelivered, upsert_actions,
)
from tallyframe.delivery.catalogue import CONTRACTS
from tallyframe.sources.columns import SOURCE_COLUMNS, canonical
from tallyframe.sources.jdbc import jdbc_options
from tallyframe.sources.sinks import append_history, write_report, write_table
from tallyframe.operators.filters import for_report_dates
from tallyframe.sources.tables import cdc_window, load_sources, merge_on_read, read_latest, read_snapshot


@pytest.fixture
def two_rows(spark):
    return spark.createDataFrame([("north", 17), ("south", -4)], "area string, level bigint")


def test_sources_become_views(spark, two_rows, tmp_path):
    two_rows.write.parquet(str(tmp_path / "dt=2023-05-08"))
    load_sources(spark, {"src": f"{tmp_path}/dt={{today}}"}, as_of=day("2023-05-08"))
    assert [tuple(r) for r in spark.sql("SELECT count(*) AS cnt FROM src").collect()] == [(2,)]


def test_table_files(spark, tmp_path):
    write_table(spark.range(100), str(tmp_path / "t"), files=5)
    assert len([n for n in os.listdir(tmp_path / "t") if n.endswith(".parquet")]) == 5
    write_table(spark.range(100).withColumn("dt", F.lit("x")), str(tmp_path / "p"), by="dt")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 100


def test_history_repeats_no_run(spark, two_rows, tmp_path):
    path, run = str(tmp_path / "h"), datetime(2023, 5, 9, 7, 15, 40)
    for on in ("2023-05-08", "2023-05-08", "2023-05-09"):
        append_history(two_rows, path, run, day(on))
    append_history(two_rows, path, datetime(2023, 5, 10), day("2023-05-08"))
    assert rows(spark.read.parquet(path).groupBy("report_dt", "processing_dttm").count().selectExpr(
        "cast(report_dt as string)", "cast(processing_dttm as string)", "count")) == [
        ("2023-05-08", "2023-05-09 07_15_40", 2), ("2023-05-08", "2023-05-10 00_00_00", 2), ("2023-05-09", "2023-05-09 07_15_40", 2)]


def test_partitions_are_pruned(spark, tmp_path):
    df = spark.sql("SELECT id, date_add(DATE'2024-01-01', cast(id % 40 AS int)) AS dt FROM range(400)")
    write_table(df, str(tmp_path), by="dt")
    stored = spark.read.parquet(str(tmp_path))
    for cut, n in ((read_snapshot(stored, day("2024-01-05")), 10), (cdc_window(stored, day("2024-02-05"), 30), 300),
                   (read_latest(stored), 10)):
        assert cut.count() == n
        assert "PartitionFilters: [isnotnull(dt" in plan(cut)


def test_merge_on_read(spark):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, v int, s string")
    changes = spark.createDataFrame([("a", 2, "z"), ("c", 1, "n")], "k string, v int, s string")
    assert rows(merge_on_read(base, changes, ["k"], ["v"]), "k", "s") == [("a", "z"), ("b", "y"), ("c", "n")]


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "select 1", user="u")
    assert plain == {"url": "jdbc:x", "query": "select 1", "user": "u"}
    ranged = jdbc_options("jdbc:x", "select id from t", ("id", 1, 900, 8))
    assert ranged["dbtable"] == "(select id from t) src" and ranged["numPartitions"] == "8" and "query" not in ranged


def test_canonical_columns(spark):
    raw = spark.createDataFrame([("7.0000000000", "3.0000000000", "1", at("2024-01-01"))], "ID string, collection_id string, C_DT string, C_DATE timestamp")
    out = canonical(raw, "journal")
    assert rows(out, "id", "collection_id", "is_debit") == [(7, 3, True)]
    odd = spark.createDataFrame([(1, 2)], "COLLECTION_ID int, `C_ACCOUNT_DOG#1#2` int")
    assert canonical(odd, "contract_account").columns == ["account_link", "account_id"]
    assert all(SOURCE_COLUMNS.values())


def test_work_dir_is_shared_and_can_be_dropped(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = session.work_dir(spark, "a"), session.work_dir(spark, "a")
    assert one != two and one.startswith(f"{shared}/_work/a-")
    path = session.work_dir(spark, "a", f"file://{tmp_path}")
    kept = session.materialize(spark.range(3), "a", path)
    assert kept.count() == 3 and len(os.listdir(tmp_path / "_work")) == 1
    session.drop_work(spark, path)
    assert os.listdir(tmp_path / "_work") == []


def test_reads_are_pruned(spark, tmp_path):
    """The newest partition is a literal; report dates and change days reach the scan; unchanged base rows are not sorted."""
    df = spark.sql("SELECT id, date_add(DATE'2024-01-01', cast(id % 40 AS int)) AS dt FROM range(400)")
    write_table(df, str(tmp_path / "t"), by="dt")
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert "(dt#" in plan(read_latest(stored)) and "= 2024-02-09)" in plan(read_latest(stored))
    assert cdc_window(stored, day("2024-01-20"), 10).agg(F.max("dt"), F.min("dt")).first() == (day("2024-01-20"), day("2024-01-11"))
    df.write.parquet(str(tmp_path / "p"))
    plain = spark.read.parquet(str(tmp_path / "p"))
    assert "PushedFilters: [IsNotNull(dt), GreaterThanOrEqual(dt,2024-01-01), LessThan(dt,2024-03-01)" in plan(
        for_report_dates(plain, "dt", [day("2024-02-05"), day("2024-03-05")]))
    base = spark.range(100).selectExpr("id AS k", "0 AS v")
    folded = merge_on_read(base, spark.createDataFrame([(5, 1), (5, 2), (200, 1)], "k long, v int"), ["k"], ["v"])
    assert folded.count() == 101 and rows(folded.where("v > 0"), "k", "v") == [(200, 1), (5, 2)]


# -- routes, gates, ledger -------------------------------------------------------------------

@pytest.fixture
def acts(spark):
    return spark.createDataFrame([("a", 1, 10), ("b", 0, 20), ("c", None, 30), ("a", 0, 5)], "k string, condition int, id int")


def test_gate_needs_a_truthy_value(spark):
    df = spark.createDataFrame([(1,), (0,), (None,), (-2,)], "c int")
    assert [r[0] for r in df.select(satisfied(F.col("c"))).collect()] == [True, False, False, True]
    words = spark.createDataFrame([("yes",), ("",), (None,), ("0",)], "c string")
    kind = words.schema["c"].dataType
    assert [r[0] for r in words.select(satisfied(F.col("c"), kind)).collect()] == [True, False, False, True]
    days = spark.createDataFrame([(day("2024-01-01"),), (None,)], "c date")
    assert [r[0] for r in days.select(satisfied(F.col("c"), days.schema["c"].dataType)).collect()] == [True, False]
    flags = spark.createDataFrame([(True,), (False,), (None,)], "c boolean")
    assert [r[0] for r in flags.select(satisfied(F.col("c"))).collect()] == [True, False, False]


def test_route_takes_the_first_row_and_keeps_routes_without_one(spark, acts):
    routes = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("d", "y")], "k string, recipient string")
    out = route(acts, routes, "k", F.col("condition"), [F.col("id")])
    assert rows(out, "k", "id", "found", "attach") == [
        ("a", 5, True, False), ("b", 20, True, False), ("c", 30, True, False), ("d", None, False, False)]
    late = route(acts, routes, "k", F.col("condition"), [F.col("id").desc()])
    assert rows(late.where("attach"), "k", "id") == [("a", 10)]
    assert rows(fill_rows(acts, routes, "k", [F.col("id")]).where("NOT found"), "k", "condition") == [("d", None)]


@pytest.mark.parametrize("n, kind, expected", [
    (2, "failure", "FAILED"), (0, "failure", "SUCCESS"), (1, "success", "SUCCESS"), (0, "success", "FAILED"),
    (None, "success", "FAILED"), (3, "none", None),
])
def test_outcome(spark, n, kind, expected):
    df = spark.createDataFrame([(n, kind)], "n int, kind string")
    assert df.select(outcome(F.col("n"), F.col("kind"))).first()[0] == expected


def test_second_run_delivers_nothing(spark, tmp_path):
    items = spark.createDataFrame([(c, f"file {c}") for c in "abcde"], "k string, file string")
    ledger, out = str(tmp_path / "ledger"), str(tmp_path / "out")
    spark.createDataFrame([("a",), ("b",)], "k string").write.parquet(ledger)
    written = []

    def write(df):
        written.append(df.count())
        df.write.mode("append").parquet(out)

    deliver(items, ledger, ["k"], write)
    deliver(items, ledger, ["k"], write)
    assert written == [3, 0]
    assert rows(spark.read.parquet(out), "k") == [("c",), ("d",), ("e",)]
    assert undelivered(items, spark.read.parquet(ledger), ["k"]).count() == 0


def test_a_failed_write_leaves_the_ledger_as_it_was(spark, tmp_path):
    items = spark.createDataFrame([("a",)], "k string")
    ledger = str(tmp_path / "ledger")

    def broken(df):
        raise OSError("disk")

    with pytest.raises(OSError):
        deliver(items, ledger, ["k"], broken)
    assert not os.path.exists(ledger)
    deliver(items, ledger, ["k"], lambda df: None)
    assert spark.read.parquet(ledger).count() == 1


def test_outbox_is_rows_however_many_files(spark):
    items = spark.range(2500).selectExpr("if(id < 2300, 'hot', 'b') AS r", "concat('f', id) AS file", "if(id = 7, NULL, concat('t', id)) AS text")
    out = outbox(items, "r", "file", "text", F.lit("Hello"))
    assert rows(out.where("part = 'message'"), "r", "content", "n_files") == [("b", "Hello", 200), ("hot", "Hello", 2300)]
    files = out.where("part = 'file'")
    assert files.select("file").distinct().count() == files.count() == 2500
    assert rows(files.where("file IN ('f7', 'f9')"), "r", "file", "content") == [("hot", "f7", None), ("hot", "f9", "t9")]


def test_ticket_upsert(spark):
    tickets = spark.createDataFrame([("q", "old"), ("q", "new")], "queue string, summary string")
    known = spark.createDataFrame([("q", "old", "K-2"), ("q", "old", "K-1"), ("z", "new", "K-9")], "queue string, summary string, ticket_key string")
    assert rows(upsert_actions(tickets, known, day("2024-03-01")), "summary", "action", "ticket_key", "deadline") == [
        ("new", "create", None, day("2024-03-06")), ("old", "comment", "K-1", None)]


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    start = log_row(spark, "r1", "job", "START", datetime(2024, 1, 1, 9))
    end = log_row(spark, "r1", "job", "END", datetime(2024, 1, 1, 10), result="SUCCESS", ticket_key="T-1", attachment_paths=["a.csv", "b.csv"])
    bad = log_row(spark, "r2", "job", "ERROR", datetime(2024, 1, 1, 11), result="SUCCESS", error_msg="no disk")
    log_run(path, start, end)
    log_run(path, bad)
    events = spark.read.parquet(path)
    assert rows(run_status(events), "run_id", "status", "n_events") == [("r1", "END", 2), ("r2", "ERROR", 1)]
    same = [("s", "START"), ("s", "END"), ("e", "END"), ("e", "ERROR"), ("e", "START")]
    tied = spark.createDataFrame([(r, datetime(2024, 1, 1, 9), e) for r, e in same], "run_id string, event_ts timestamp, event_type string")
    assert rows(run_status(tied), "run_id", "status") == [("e", "ERROR"), ("s", "END")]
    assert rows(log_view(events, "REPORTS"), "run_id", "result", "ticket_key", "error_msg", "filepath") == [
        ("r1", "", "", "", ""), ("r1", "SUCCESS", "T-1", "", "a.csv"), ("r1", "SUCCESS", "T-1", "", "b.csv"),
        ("r2", "ERROR", "", "no disk", "")]
    assert log_view(events, "OTHER").count() == 0
    with pytest.raises(ValueError):
        log_row(spark, "r", "job", "PAUSE", datetime(2024, 1, 1))


def test_freshness_and_digest(spark):
    df = spark.createDataFrame([(at("2024-01-02 10:00"),)], "ts timestamp")
    out = freshness({"new": (df, "ts"), "none": (df.where("false"), "ts")}, day("2024-01-02"))
    assert rows(out, "source", "is_fresh") == [("new", True), ("none", False)]
    found = spark.createDataFrame([("x",), ("x",), ("?",)], "e string")
    assert rows(digest(found, "e", {"x": "n_x", "y": "n_y"})) == [(2, 0)]


# -- contracts ---------------------------------------------------------------------------------

def test_there_are_eleven_contracts_with_masks_for_dates_and_money():
    assert len(CONTRACTS) == 11
    for contract in CONTRACTS.values():
        names = [c.name for c in contract.columns]
        assert len(names) == len(set(names))
        assert all((c.kind == "S") == (c.mask is None) for c in contract.columns)


def test_contract_display_and_check(spark, tmp_path):
    contract = CONTRACTS["agreements"]
    df = spark.createDataFrame([("e", "1", day("2024-03-17"), None, None, None)],
                               "error_name string, agr_number string, a_open_date date, b_open_date date, a_close_date date, b_close_date date")
    assert check_contract(df, contract) == []
    shown = display_contract(df, contract)
    assert shown.columns == [c.label for c in contract.columns]
    assert tuple(shown.first())[:3] == ("e", "1", "2024-03-17")
    assert check_contract(df.drop("error_name").withColumn("x", F.lit(1)), contract) == ["missing column error_name", "unexpected column x"]
    wrong = df.withColumn("agr_number", F.lit(5)).withColumn("a_open_date", F.lit("2024"))
    assert check_contract(wrong, contract) == [
        "column agr_number is int, expected kind S", "column a_open_date is string, expected kind D"]
    write_report(df, contract, str(tmp_path / "r"))
    assert spark.read.csv(str(tmp_path / "r"), header=True).first()["Номер договора"] == "1"


def test_contract_problems_count_values_that_do_not_fit(spark):
    payments = CONTRACTS["merchants_payments"]
    texts = spark.createDataFrame(
        [("a", "c", "t", "n", "1.50", "x", None), ("a", None, "t", "n", "1,5", "2", "3")],
        ", ".join(f"{c.name} string" for c in payments.columns))
    got = {r.column_name: (r.n_rows, r.n_null, r.n_unfit) for r in contract_problems(texts, payments).collect()}
    assert got["out_balance_amount"] == (2, 0, 1)
    assert got["payment_documents_amount"] == (2, 0, 1)
    assert got["diff_amount"] == (2, 1, 0)
    assert got["client_name"] == (2, 1, 0)
