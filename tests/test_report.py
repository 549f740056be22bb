"""Whole reports, from source files to file, history and log details."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import D, at, day, rows
from tallyframe import RunParams
from tallyframe.delivery.catalogue import CONTRACTS
from tallyframe.delivery.contracts import Contract, amount, text
from tallyframe.delivery.report import Attachment, NoticeReport, StageReport, run_reports, select_reports, with_result
from tallyframe.delivery.routed import RoutedReport
from tallyframe.delivery.runlog import log_view, run_status
from tallyframe.plans import agreements_check, payments_check, red_balance, turnover
from tallyframe.session import shuffle_partitions
from tallyframe.sources.columns import canonical

PARAMS = RunParams(day("2023-05-08"), datetime(2023, 5, 9, 7, 15, 40))
DIFFS = Contract("diffs", (text("k", "Ключ"), amount("diff", "Разность")))


@pytest.fixture
def source(spark, tmp_path):
    path = tmp_path / "src" / "dt=2023-05-08"
    spark.createDataFrame([("a/1", D("5.00")), ("b", D("-5.00"))], "k string, diff decimal(18,2)").write.parquet(str(path))
    return str(tmp_path / "src" / "dt={today}")


def notice(tmp_path, source, **changes):
    given = dict(
        name="diffs", query="SELECT k, diff, :as_of AS d FROM src WHERE :as_of >= :month_hi", sources={"src": source},
        contract=DIFFS, folder=str(tmp_path / "out"), file_name="{DT_SLASH}/Сверка {first}.csv",
        condition="SELECT sum(abs(diff)) <> 0 FROM result", filler="SELECT count(*) AS cnt, max(k) AS k, min(k) AS first FROM result",
        text="Расхождений за {DT}: {cnt} ({k})", indicator="failure", history=str(tmp_path / "history"))
    given["query"] = given["query"].replace(", :as_of AS d", "")
    return NoticeReport(**{**given, **changes})


def test_notice_with_differences_goes_out_and_has_failed(spark, tmp_path, source):
    out = notice(tmp_path, source).run(spark, PARAMS)
    assert out["result"] == "FAILED" and out["text"] == "Расхождений за 2023-05-08: 2 (b)"
    [path] = out["attachment_paths"]
    assert path.endswith("/out/2023/05/08/Сверка a_1.csv")
    assert rows(spark.read.csv(path, header=True)) == [("a/1", "5.00"), ("b", "-5.00")]
    assert spark.read.parquet(str(tmp_path / "history")).count() == 2
    assert not spark.catalog.tableExists("result")


def test_net_condition_lets_opposites_cancel(spark, tmp_path, source):
    out = notice(tmp_path, source, condition="SELECT sum(diff) <> 0 FROM result").run(spark, PARAMS)
    assert out == {"attachment_paths": [], "text": None, "result": "SUCCESS"}
    empty = notice(tmp_path, source, query="SELECT * FROM src WHERE false").run(spark, PARAMS)
    assert empty["result"] == "SUCCESS"  # a sum over no rows is NULL: not met


def test_text_without_a_filler_row_is_empty(spark, tmp_path, source):
    out = notice(tmp_path, source, filler="SELECT k, k AS first, 1 AS cnt FROM result WHERE false").run(spark, PARAMS)
    assert out["text"] == "Расхождений за 2023-05-08:  ()"


def test_notice_checks_its_contract_first(spark, tmp_path, source):
    with pytest.raises(ValueError, match="missing column diff"):
        notice(tmp_path, source, query="SELECT k FROM src").run(spark, PARAMS)
    assert not (tmp_path / "out").exists()


def test_notice_without_a_contract(spark, tmp_path, source):
    [path] = notice(tmp_path, source, contract=None).run(spark, PARAMS)["attachment_paths"]
    assert spark.read.csv(path, header=True).columns == ["k", "diff"]


def test_text_conditions_count_unless_empty(spark, tmp_path, source):
    assert notice(tmp_path, source, condition="SELECT 'yes'").run(spark, PARAMS)["result"] == "FAILED"
    assert notice(tmp_path, source, condition="SELECT ''").run(spark, PARAMS)["result"] == "SUCCESS"


def test_each_attachment_has_its_own_condition(spark, tmp_path, source):
    parts = (
        Attachment("plus.csv", "SELECT max(diff) > 0 FROM result", "SELECT k FROM result WHERE diff > 0", "up {k}"),
        Attachment("none.csv", "SELECT count(*) > 9 FROM result", text="never"),
        Attachment("", "SELECT min(diff) < 0 FROM result", "SELECT k FROM result WHERE diff < 0", "down {k}"),
    )
    out = notice(tmp_path, source, attachments=parts).run(spark, PARAMS)
    assert [p.rsplit("/", 1)[1] for p in out["attachment_paths"]] == ["plus.csv"]
    assert out["text"] == "up a/1<br/>down b" and out["result"] == "FAILED"


def test_reports_of_a_run_are_logged_up_to_the_first_error(spark, tmp_path, source):
    log = str(tmp_path / "log")
    good, bad = notice(tmp_path, source), notice(tmp_path, source, name="bad", query="SELECT k FROM src")
    with pytest.raises(ValueError):
        run_reports(spark, [good, bad, notice(tmp_path, source, name="later")], PARAMS, log, "run-1")
    events = spark.read.parquet(log)
    assert rows(events, "job_name", "event_type") == [("bad", "ERROR"), ("bad", "START"), ("diffs", "END"), ("diffs", "START")]
    assert rows(run_status(events), "run_id", "status") == [("run-1", "ERROR")]
    shown = log_view(events).where("event_type = 'END'").first()
    assert shown["result"] == "FAILED" and shown["filepath"].endswith(".csv")


def monthly_acts(spark, folder, **changes):
    acts = spark.createDataFrame([("A/1", 1, 10), ("A/2", 0, 20), ("A/3", 1, 30)], "agr string, condition int, total int")
    routes = spark.createDataFrame([
        ("A/1", "one@x", "email_file", None), ("A/1", "one@x", "email_text", None), ("A/2", "two@x", "email_file", None),
        ("A/3", "Акт 3", "ticket_file", "Q"), ("A/9", "nine@x", "email_file", None)],
        "agr string, recipient string, attach_kind string, queue string")
    given = dict(
        query=lambda tables, params: acts, routes=lambda s: routes, key="agr", order=["total"], folder=folder,
        file_name="акт {agr} за {DT}", text="итог {total}", body="Акты", indicator="success", nothing=("ops@x", "nothing to send"))
    return RoutedReport("acts", **{**given, **changes})


def test_monthly_acts_run_twice_deliver_once(spark, tmp_path):
    folder = str(tmp_path / "acts")
    report = monthly_acts(spark, folder)
    assert report.run(spark, PARAMS) == {"result": "SUCCESS", "n_delivered": 3}
    again = RunParams(PARAMS.as_of, datetime(2023, 5, 9, 8))
    assert report.run(spark, again) == {"result": "FAILED", "n_delivered": 0}
    mails = spark.read.parquet(f"{folder}/outbox").where("recipient <> 'ops@x'")
    assert rows(mails, "recipient", "part", "file", "content", "n_files") == [
        ("one@x", "file", "акт A_1 за 2023-05-08", None, None), ("one@x", "file", None, "итог 10", None), ("one@x", "message", None, "Акты", 1)]
    assert rows(spark.read.parquet(f"{folder}/outbox").where("recipient = 'ops@x'"), "content") == [("nothing to send",)]
    assert rows(spark.read.parquet(f"{folder}/tickets"), "queue", "summary", "action") == [("Q", "Акт 3", "create")]
    assert spark.read.parquet(f"{folder}/ledger").count() == 3
    lines = spark.read.option("header", True).csv(f"{folder}/files").where("file IS NOT NULL")
    assert rows(lines, "agr", "file") == [("A/1", "акт A_1 за 2023-05-08"), ("A/3", "акт A_3 за 2023-05-08")]
    assert report.run(spark, RunParams(day("2023-06-08"), datetime(2023, 6, 9)))["n_delivered"] == 3  # another month


def test_stage_feeds_the_next_report(spark, tmp_path, source):
    path = str(tmp_path / "stage")
    StageReport("s", "SELECT k, diff FROM src", {"src": source}, path).run(spark, PARAMS)
    out = notice(tmp_path, path, text=None).run(spark, PARAMS)
    assert out["result"] == "FAILED" and out["text"] is None


def test_a_plan_can_be_the_query(spark, tmp_path):
    data = spark.createDataFrame([("ag1", day("2023-05-08"), None)], "C_GUID string, C_DATE_BEG date, C_DATE_CLOSE date")
    data.write.parquet(str(tmp_path / "p"))

    def check(t, params):
        products = canonical(t["product"], "product")
        none = products.where("false")
        agreements = none.select("agr_number", F.col("open_date").alias("signature_date"), F.col("close_date").alias("closing_date"))
        return agreements_check(products, none, agreements, params.as_of)

    report = NoticeReport("agreements", check, {"product": str(tmp_path / "p")}, contract=CONTRACTS["agreements"],
                          folder=str(tmp_path / "o"), file_name="{DT}.csv", filler="SELECT count(*) AS cnt FROM result",
                          text="{cnt}", indicator="failure")
    assert report.run(spark, PARAMS)["text"] == "1"


def test_select_reports(tmp_path):
    all_of_them = [StageReport("a", "x"), StageReport("b", "y")]
    assert [r.name for r in select_reports(all_of_them, None)] == ["a", "b"]
    assert select_reports(all_of_them, []) == []
    assert [r.name for r in select_reports(all_of_them, ["b", "unknown"])] == ["b"]


def test_with_result_cleans_up_after_an_error(spark):
    with pytest.raises(RuntimeError):
        with with_result(spark.range(3)) as kept:
            assert spark.sql("SELECT count(*) AS n FROM result").first().n == 3
            raise RuntimeError
    assert not spark.catalog.tableExists("result")


def test_turnover_from_tables_under_source_names(spark):
    zero = ".0000000000"
    money = "decimal(18,2)"
    journal = spark.createDataFrame([
        (f"1{zero}", f"7{zero}", f"9{zero}", at("2024-03-05 09:00"), at("2024-03-05 09:00"), "1", D("10"), D("4"), D("100"), D("40"),
         1, 1, day("2024-03-05"))],
        f"ID string, COLLECTION_ID string, C_DOC string, C_DATE timestamp, C_STAMP timestamp, C_DT string, C_START_SUM {money}, "
        f"C_SUMMA {money}, C_START_SUM_NAT {money}, C_SUMMA_NAT {money}, txn_ts int, txn_id int, dt date")
    accounts = spark.createDataFrame([(f"70{zero}", f"7{zero}", "40702810500000000001")], "ID string, C_ARC_MOVE string, C_MAIN_V_ID string")
    legacy = spark.createDataFrame(
        [(70, day("2024-01-01"), day("2100-12-31"), *[D("100"), D("0"), D("0"), D("100")] * 2, True, day("2100-12-31"))],
        "account_nk long, account_balance_effective_from_date date, account_balance_effective_to_date date, "
        + ", ".join(f"{c} {money}" for c in [
            "account_balance_in_amount", "account_debit_turn_amount", "account_credit_turn_amount", "account_balance_out_amount",
            "account_balance_in_currency_amount", "account_debit_turn_currency_amount", "account_credit_turn_currency_amount",
            "account_balance_out_currency_amount"]) + ", closed_date_flag boolean, valid_to_date date")
    days = spark.createDataFrame([(day("2024-03-05"), 3)], "C_OP_DAY date, `C_CHANGE_POSS#0` int")
    tables = {
        "journal_changes": canonical(journal, "journal"), "ledger_account": canonical(accounts, "ledger_account"),
        "legacy_balance": canonical(legacy, "legacy_balance"), "op_day": canonical(days, "op_day"),
    }
    # quiet for over 30 days: the balance after the cut-over stays
    for on, out in (("2024-03-04", "100"), ("2024-03-05", "60"), ("2024-03-09", "60"), ("2024-04-20", "60")):
        got = turnover(tables, day(on), day("2024-03-01"))
        assert rows(got, "account_id", "out_amount") == [(70, D(out))]
    literal = turnover(tables, day("2024-04-20"), day("2024-03-01"), days=30)
    assert rows(literal, "out_amount") == [(D("100"),)]

    classes = canonical(spark.createDataFrame([(f"3{zero}", "П")], "ID string, C_CODE string"), "account_type")
    users = canonical(spark.createDataFrame([(f"4{zero}", "Иванова")], "ID string, C_NAME string"), "account_user")
    typed = canonical(spark.createDataFrame(
        [(f"70{zero}", f"7{zero}", "40702810500000000001", f"3{zero}", f"4{zero}")],
        "ID string, C_ARC_MOVE string, C_MAIN_V_ID string, C_VID string, C_OTV string"), "ledger_account")
    red = red_balance(turnover(tables, day("2024-03-09"), day("2024-03-01")), typed, classes, users)
    assert rows(red, "account_number", "acc_type_code") == [("40702810500000000001", "П")]


def test_payments_from_tables_under_source_names(spark):
    zero, money, at_ten = ".0000000000", "decimal(18,2)", at("2024-03-06 10:00")
    number = "30232810510000000001"
    journal = spark.createDataFrame([
        (f"1{zero}", f"7{zero}", f"9{zero}", at("2024-03-05 09:00"), "0", D("10"), D("4"), D("10"), D("4"), 1, 1, day("2024-03-05"))],
        f"ID string, COLLECTION_ID string, C_DOC string, C_DATE timestamp, C_DT string, C_START_SUM {money}, C_SUMMA {money}, "
        f"C_START_SUM_NAT {money}, C_SUMMA_NAT {money}, txn_ts int, txn_id int, dt date")
    documents = spark.createDataFrame(
        [(f"5{zero}", at_ten, number, "40702810500000000001", "PROV", D("25"), f"70{zero}", "11451550", 1, 1, day("2024-03-06"))],
        f"id string, C_DATE_DOC timestamp, C_NUM_DT string, C_NUM_KT string, STATE_ID string, C_SUM {money}, C_ACC_DT string, "
        "C_VID_DOC string, txn_ts int, txn_id int, dt date")
    one = {
        "journal_changes": ("journal", journal), "document_changes": ("document", documents),
        "ledger_account": ("ledger_account", spark.createDataFrame([(f"70{zero}", f"7{zero}", number)], "ID string, C_ARC_MOVE string, C_MAIN_V_ID string")),
        "merchant_contract": ("merchant_contract", spark.createDataFrame(
            [("D-1", f"8{zero}", f"2{zero}", f"3{zero}")], "C_NUM_DOG string, C_ACCOUNT_DOG string, C_CLIENT string, C_TYPE_DOG string")),
        "contract_account": ("contract_account", spark.createDataFrame([(f"8{zero}", f"70{zero}")], "COLLECTION_ID string, `C_ACCOUNT_DOG#1#2` string")),
        "client": ("client", spark.createDataFrame([(f"2{zero}", "ООО")], "ID string, C_NAME string")),
        "agreement_type": ("agreement_type", spark.createDataFrame([(f"3{zero}", "эквайринг")], "ID string, C_NAME string")),
        "calendar": ("calendar", spark.createDataFrame([(day(f"2024-03-0{k}"), False) for k in range(1, 8)], "calendar_date date, holiday_flag boolean")),
    }
    out = payments_check({name: canonical(df, table) for name, (table, df) in one.items()}, day("2024-03-06"))
    assert rows(out, "agreement_number", "client_name", "agreement_type", "out_balance_amount", "payment_documents_amount", "diff_amount") == [
        ("D-1", "ООО", "эквайринг", D("14"), D("25"), D("11"))]



def test_shuffle_partitions_grow_with_the_data():
    assert shuffle_partitions(1) == 200
    assert shuffle_partitions(100 << 40) == 819_200


def test_many_files_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    n = 450
    acts = spark.range(n).selectExpr("concat('A/', id) AS agr", "1 AS condition", "CAST(id AS int) AS total")
    acts = acts.unionByName(acts.withColumn("total", -F.col("total"))).coalesce(1)
    routes = acts.selectExpr("agr", "'one@x' AS recipient", "'email_file' AS attach_kind", "CAST(NULL AS string) AS queue").distinct()
    folder = str(tmp_path / "many")
    report = monthly_acts(spark, folder, query=lambda tables, params: acts, routes=lambda s: routes)
    assert report.run(spark, PARAMS)["n_delivered"] == n
    files = spark.read.option("header", True).csv(f"{folder}/files").where("file IS NOT NULL").withColumn(
        "task", F.regexp_extract(F.input_file_name(), r"/part-(\d+)", 1))
    counts = files.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("task").alias("tasks"))
    assert counts.where("n = 2 AND tasks = 1").count() == counts.count() == n
    assert files.select("task").distinct().count() > 1

    from tallyframe.delivery import routed

    monkeypatch.setattr(routed, "ROWS_A_TASK", 100)  # a file of many rows is several parts
    one = spark.range(1000).selectExpr("'A' AS agr", "id")
    spread = routed.spread(one, spark.createDataFrame([("A", "a file")], "agr string, file string"), "agr", 2000)
    assert spread.columns == ["agr", "id", "file"] and spread.select("id").distinct().count() == 1000
    assert spread.select(F.spark_partition_id()).distinct().count() > 3
