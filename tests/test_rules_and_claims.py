"""Rule tables, the variant log, claims of deliveries, whole error texts."""

import random
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from tallyframe.delivery.claims import ClaimLedger
from tallyframe.delivery.report import run_reports
from tallyframe.delivery.runlog import log_row, log_view
from tallyframe.delivery.variant_log import variant_fields, variant_log_view, write_variant_log
from tallyframe.functions.rules import classify
from tallyframe.operators.rule_table import match_rules
from tallyframe.params import RunParams

# -- rule tables ----------------------------------------------------------------------

PATTERNS = [
    ("40702%", "a", 5), ("407%", "b", 3), ("4070281051%", "c", 9), ("%77", "d", 4), ("4_702%", "e", 6), ("", "empty", 1), ("30%", "f", 2),
    ("30%", "g", 7), (None, "none", 0), ("ü%", "u", 8), ("exact", "x", 8), ("a\\b%", "back", 8), ("407", "only", 10),
]
TEXTS = ["40702810510000077", "40702", "407", "4070", "30232", "", None, "üx", "exact", "exactly", "a\\bc", "zzz77", "z\n77", "4"]


def matches(text, pattern):
    if text is None or pattern is None:
        return False
    return re.fullmatch("".join({"%": ".*", "_": "."}.get(c, re.escape(c)) for c in pattern), text, re.S) is not None


def test_rules_match_like_a_chain(spark):
    rules = spark.createDataFrame(PATTERNS, "pattern string, label string, rank int")
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS * 2)], "id int, text string").withColumn("label", F.lit("old")).drop("label")
    first = {r.id: r.label for r in match_rules(frame, "text", rules, "pattern", "label", "rank").collect()}
    longest = {r.id: r.label for r in match_rules(frame, "text", rules, "pattern", "label").collect()}
    chain = [(label, F.like(F.col("text"), F.lit(p), F.lit("\x01"))) for p, label, _ in sorted((x for x in PATTERNS if x[0] is not None), key=lambda x: x[2])]
    want = {r.id: r.label for r in frame.withColumn("label", classify(chain)).collect()}
    assert first == want and len(first) == 2 * len(TEXTS)
    for k, t in enumerate(TEXTS * 2):
        own = [(-len(re.match("[^%_]*", p)[0]), p, label) for p, label, _ in PATTERNS if matches(t, p)]
        assert longest[k] == (min(own)[2] if own else None)


def test_plan_does_not_grow_with_the_rules(spark):
    rng = random.Random(1)
    made = {("".join(rng.choices("abc", k=rng.randint(1, 9))) + "%", k) for k in range(3000)}
    rules = spark.createDataFrame([(p, f"r{k}", k) for p, k in made], "pattern string, label string, rank int")
    frame = spark.createDataFrame([("".join(rng.choices("abc", k=12)),) for _ in range(200)], "text string")
    many, few = match_rules(frame, "text", rules, "pattern", "label", "rank"), match_rules(frame, "text", rules.limit(5), "pattern", "label", "rank")
    length = lambda df: len(plan(df).split("\n\n")[0].splitlines())
    assert abs(length(many) - length(few)) <= 4 and len(plan(many)) < 20_000
    assert not [x for x in ("NestedLoop", "Cartesian") if x in plan(many)]
    best = {r.text: r.label for r in many.collect()}
    for text, label in best.items():
        own = [k for p, k in made if text.startswith(p[:-1])]
        assert label == (f"r{min(own)}" if own else None)


def test_rules_of_nothing(spark):
    rules = spark.createDataFrame([], "pattern string, label string, rank int")
    frame = spark.createDataFrame([("a",), (None,)], "text string")
    assert rows(match_rules(frame, "text", rules, "pattern", "label")) == rows(frame.withColumn("label", F.lit(None).cast("string")))


# -- variant log ---------------------------------------------------------------------------

AT = datetime(2024, 1, 15, 9, 30)


def events(spark):
    out = log_row(spark, "1", "a", "START", AT)
    for k in range(4):
        out = out.unionByName(log_row(spark, str(k), "b", "END", AT, result=" SUCCESS ", ticket_key=f"T-{k}", attachment_paths=[f"out/{n}.csv" for n in range(k)]))
    odd = [("9", "REPORTS", "c", "END", AT, x) for x in (None, "no json", '{"result": {"a": 1}}', '{"attachment_paths": null, "error_msg": null}', "{}")]
    return out.unionByName(log_row(spark, "8", "b", "ERROR", AT, error_msg="bad")).unionByName(
        spark.createDataFrame(odd, out.schema)).unionByName(log_row(spark, "7", "b", "END", AT, service="OTHER"))


def test_variant_log_shows_what_the_text_log_shows(spark, tmp_path):
    log = events(spark)
    stored = write_variant_log(log, f"file://{tmp_path}/log")
    names = ["run_id", "job_name", "event_type", "result", "ticket_key", "error_msg", "filepath"]
    assert rows(variant_log_view(stored, "REPORTS"), *names) == rows(log_view(log, "REPORTS"), *names)
    assert rows(variant_log_view(stored), *names) == rows(log_view(log), *names)


def test_only_fields_that_are_asked_for_are_read(spark, tmp_path):
    stored = write_variant_log(events(spark), f"file://{tmp_path}/log")
    one = variant_fields(stored, "details", ["result"]).select("run_id", "result")
    text = plan(one)
    assert re.search(r"ReadSchema: struct<run_id:string,details:struct<0:string>>", text)  # one field, as text
    assert "parse_json" not in text and "get_json_object" not in text


# -- claims ---------------------------------------------------------------------------------


def test_two_runs_at_once_deliver_each_item_once(spark, tmp_path, monkeypatch):
    ledger = ClaimLedger(spark, f"file://{tmp_path}/ledger", ["id"])
    sent = []

    def send(items, claim):
        sent.extend((r.id, claim) for r in items.collect())

    items = lambda *ids: spark.createDataFrame([(k, f"i{k}") for k in ids], "id int, what string")
    create, other = ClaimLedger._create, []

    def late(self, *parts, text):
        if parts[0] == "versions" and not other:  # the second run claims between the first one's look and its claim
            other.append(1)
            assert ledger.deliver(items(2, 3, 4), send)
        return create(self, *parts, text=text)

    monkeypatch.setattr(ClaimLedger, "_create", late)
    ledger.deliver(items(1, 2, 3), send)
    assert sorted(k for k, _ in sent) == [1, 2, 3, 4] and len(ledger.claims()) == 2 and ledger.open_claims() == []
    assert ledger.deliver(items(1, 2, 3, 4), send) is None and len(sent) == 4


def test_a_run_that_broke_off_is_resumed(spark, tmp_path):
    ledger = ClaimLedger(spark, f"file://{tmp_path}/ledger", ["id"])
    items = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, what string")
    with pytest.raises(ZeroDivisionError):
        ledger.deliver(items, lambda *_: 1 / 0)
    (claim,) = ledger.open_claims()
    assert ledger.claim(items.where("id IS NOT NULL")) is None  # nobody else takes them
    out = []
    ledger.resume(claim, lambda x, name: out.extend(r.what for r in x.collect()))
    assert sorted(out) == ["a", "b", "c"] and ledger.open_claims() == []


# -- whole error texts ------------------------------------------------------------------------


class Broken:
    name = "broken"

    def run(self, spark, params):
        raise RuntimeError("long " * 2000 + "end")


def test_errors_are_logged_whole(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    with pytest.raises(RuntimeError):
        run_reports(spark, [Broken()], RunParams(date(2024, 1, 15), AT), path, "r1")
    (row,) = log_view(spark.read.parquet(path)).where("event_type = 'ERROR'").collect()
    assert row.error_msg == ("long " * 2000 + "end")
