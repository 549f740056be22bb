"""Mechanisms for large tables: digest tree, carried values, allocation, containment, turnover state, bucketed versions."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta
from functools import reduce

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import D, day, plan, rows
from tallyframe.operators import allocation, carry, digest_tree
from tallyframe.operators.allocation import allocate_fifo
from tallyframe.operators.carry import asof_join, carry_last, in_parts
from tallyframe.operators.compare import full_compare, missing_in
from tallyframe.operators.digest_tree import tree_compare
from tallyframe.operators.intervals import containment_join
from tallyframe.operators.windows import latest_version
from tallyframe.plans import turnover
from tallyframe.plans.turnover_state import TurnoverState
from tallyframe.sources.buckets import BucketedTable
from tallyframe.streaming import follow_versions

# -- digest tree ------------------------------------------------------------------

REGISTER = "number long, part string, amount decimal(18,2), note string"


def registers(spark, n=4000):
    rng = random.Random(4)
    a = [(k, "x" if k % 2 else "y", D(k), None if k % 3 == 0 else f"n{k}") for k in range(n)]
    b = [r if rng.random() > 0.003 else (r[0], r[1], r[2] + 1, r[3]) for r in a[5:]] + [(n + 1, "x", None, None)]
    return a, b


def as_full(spark, a, b):
    values = ["amount", "note"]
    both = full_compare(a, b, ["number", "part"])
    same = F.col("in_a") & F.col("in_b")
    for v in values:
        same = same & F.col(f"a_{v}").eqNullSafe(F.col(f"b_{v}"))
    return rows(both.where(~same))


@pytest.mark.parametrize("bits", [2, 6, 12])
def test_tree_finds_what_a_full_join_finds(spark, monkeypatch, bits):
    monkeypatch.setattr(digest_tree, "BITS", bits)
    a, b = registers(spark)
    left, right = spark.createDataFrame(a, REGISTER), spark.createDataFrame(b, REGISTER)
    found = tree_compare(left, right, ["number", "part"])
    assert rows(found) == as_full(spark, left, right) and found.count() > 10


def test_equal_ranges_send_no_row(spark):
    a, b = registers(spark)
    left, right = spark.createDataFrame(a, REGISTER), spark.createDataFrame(b, REGISTER)
    level, ranges = digest_tree.differing_ranges(left, right, ["number", "part"])
    differing = as_full(spark, left, right)
    assert ranges.count() <= len(differing)
    # only rows of differing ranges are left for the join: few more than the differing ones
    left_rows = digest_tree.open_rows(left, ["number", "part"], level, ranges).count()
    assert len(differing) - 6 <= left_rows <= 3 * len(differing)
    assert "SortMergeJoin [_range" not in plan(digest_tree.open_rows(left, ["number", "part"], level, ranges))
    level, ranges = digest_tree.differing_ranges(left, left, ["number", "part"])
    assert (level, ranges) == (1, None) and tree_compare(left, left, ["number", "part"]).count() == 0


def test_tree_tells_null_places_apart_and_handles_empty_sides(spark):
    schema = "k long, a string, b string"
    one, other = spark.createDataFrame([(1, None, "x"), (None, "y", "y")], schema), spark.createDataFrame([(1, "x", None)], schema)
    assert rows(tree_compare(one, other, ["k"])) == [(1, None, "x", True, "x", None, True)]
    assert tree_compare(one, one.where("false"), ["k"]).count() == 1
    assert tree_compare(one.where("false"), one.where("false"), ["k"]).count() == 0


def test_everything_differs(spark):
    a = spark.range(3000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    assert tree_compare(a, a.withColumn("v", F.lit(2)), ["k"]).count() == 3000


# -- carried values -----------------------------------------------------------------


def moves(n=3000, keys=(1, 1, 1, 2, None)):
    """One key has most rows, many at one time."""
    rng = random.Random(7)
    return [(rng.choice(keys), rng.choice([1, 5, 5, 5, rng.randint(0, 400)]), k, None if rng.random() < 0.9 else k) for k in range(n)]


def test_last_value_of_a_hot_key_comes_from_many_parts(spark):
    data = moves()
    frame = spark.createDataFrame(data, "k int, at int, id int, v int")
    parts = in_parts(frame, ["k"], ["at", "id"], 8).where("k = 1").groupBy("_part").count().collect()
    assert len(parts) > 3 and max(r["count"] for r in parts) < 0.4 * len(data)
    want, last = {}, {}
    for k, at, i, v in sorted(data, key=lambda r: (r[1], r[2])):
        last[k] = v if v is not None else last.get(k)
        want[i] = last[k]
    found = carry_last(frame, ["k"], ["at", "id"], "v", "seen", parts=8)
    assert found.columns == ["k", "at", "id", "v", "seen"]
    assert {r.id: r.seen for r in found.collect()} == want


def test_asof_join(spark):
    rng = random.Random(2)
    left = [(rng.choice([1, 1, 1, 2, None, 9]), rng.choice([None, rng.randint(0, 60)]), k) for k in range(400)]
    right = [(rng.choice([1, 1, 2, None, 3]), rng.choice([None, rng.randint(0, 60)]), k, f"p{k}") for k in range(200)]
    found = asof_join(
        spark.createDataFrame(left, "k int, at int, id int"), spark.createDataFrame(right, "k int, seen int, no int, what string"),
        ["k"], "at", "seen", ["no", "what"], "no", parts=6)
    assert found.columns == ["k", "at", "id", "no", "what"]
    for r in found.collect():
        known = [x for x in right if x[0] == r.k and x[1] is not None and r.at is not None and x[1] <= r.at]
        best = max(known, key=lambda x: (x[1], x[2]), default=(None, None, None, None))
        assert (r.no, r.what) == (best[2], best[3])
    assert found.count() == len(left)


# -- allocation -------------------------------------------------------------------------


def allocated(payments, documents):
    """Plain queue per account."""
    out = Counter()
    for account in {r[0] for r in payments + documents}:
        pay = [[i, a] for k, _, i, a in sorted(payments, key=lambda r: (r[1], r[2])) if k == account and a and a > 0]
        doc = [[i, a] for k, _, i, a in sorted(documents, key=lambda r: (r[1], r[2])) if k == account and a and a > 0]
        while pay and doc:
            part = min(pay[0][1], doc[0][1])
            out[account, pay[0][0], doc[0][0], part] += 1
            for side in (pay, doc):
                side[0][1] -= part
                if not side[0][1]:
                    side.pop(0)
        for i, a in pay:
            out[account, i, None, a] += 1
        for i, a in doc:
            out[account, None, i, a] += 1
    return out


@pytest.mark.parametrize("parts", [1, 5])
def test_allocation_is_a_queue(spark, parts):
    rng = random.Random(parts)
    accounts, amounts = [1] * 6 + [2, 3, None], [D("1.00"), D("2.50"), D("7.01"), D("100.00"), D(0), D("-3.00"), None]
    payments = [(rng.choice(accounts), rng.randint(0, 9), k, rng.choice(amounts)) for k in range(150)] + [(7, 0, 900, D(5))]
    documents = [(rng.choice(accounts), rng.randint(0, 9), k, rng.choice(amounts)) for k in range(170)] + [(8, 0, 901, D(5))]
    schema = "account int, at int, id int, amount decimal(18,2)"
    found = allocate_fifo(*(spark.createDataFrame(x, schema) for x in (payments, documents)), ["account"], ["at", "id"], "id", parts=parts)
    assert Counter((r.account, r.payment, r.document, r.allocated) for r in found.collect()) == allocated(payments, documents)
    sums = {r.payment: r.s for r in found.groupBy("payment").agg(F.sum("allocated").alias("s")).collect() if r.payment is not None}
    assert sums == {i: a for _, _, i, a in payments if a and a > 0}


@pytest.mark.parametrize("large", [None, 30])
def test_allocation_goes_through_ranges_for_large_accounts_only(spark, monkeypatch, large):
    rng = random.Random(11)
    accounts, amounts = [1] * 6 + [2, 3, 4, None], [D("1.00"), D("2.50"), D("7.01"), D("100.00"), D(0), D("-3.00"), None]
    payments = [(rng.choice(accounts), rng.choice([None, *range(9)]), k, rng.choice(amounts)) for k in range(150)] + [(7, 0, 900, D(5))]
    documents = [(rng.choice(accounts), rng.choice([None, *range(9)]), k, rng.choice(amounts)) for k in range(170)] + [(8, 0, 901, D(5))]
    ranged = []

    def watched(df, keys, *rest):
        ranged.append({r[0] for r in df.select(*keys).distinct().collect()})
        return in_parts(df, keys, *rest)

    for module in (allocation, carry):
        monkeypatch.setattr(module, "in_parts", watched)
    if large:
        monkeypatch.setattr(allocation, "ACCOUNT_ROWS", large)
    schema = "account int, at int, id int, amount decimal(18,2)"
    found = allocate_fifo(*(spark.createDataFrame(x, schema) for x in (payments, documents)), ["account"], ["at", "id"], "id")
    nulls_first = [[(a, -1 if t is None else t, i, m) for a, t, i, m in side] for side in (payments, documents)]
    assert Counter((r.account, r.payment, r.document, r.allocated) for r in found.collect()) == allocated(*nulls_first)
    assert set().union(*ranged) == ({1} if large else set())


def test_allocation_of_nothing(spark):
    none = spark.createDataFrame([], "account int, at int, id int, amount decimal(18,2)")
    one = spark.createDataFrame([(1, 1, 1, D(3))], none.schema)
    assert allocate_fifo(none, none, ["account"], ["at", "id"], "id").count() == 0
    assert [tuple(r) for r in allocate_fifo(none, one, ["account"], ["at", "id"], "id").collect()] == [(1, None, 1, D("3.0000"))]


# -- containment ----------------------------------------------------------------------------

BASE = datetime(2024, 1, 1)


@pytest.mark.parametrize("kind", ["bigint", "date", "timestamp_ntz"])
def test_points_in_intervals(spark, kind):
    rng = random.Random(3)
    make = {"bigint": int, "date": lambda n: (BASE + timedelta(days=n)).date(), "timestamp_ntz": lambda n: BASE + timedelta(seconds=n)}[kind]
    points = [(rng.choice([1, 2, None]), rng.choice([None, rng.randint(-300, 3000)]), k) for k in range(250)]
    spans = []
    for k in range(120):
        lo = rng.choice([None, rng.randint(-300, 3000)])
        spans.append((rng.choice([1, 2, None]), lo, rng.choice([None, (lo or 0) + rng.choice([-5, 0, 1, 3, 15, 16, 17, 900, 3000])]), k))
    at = lambda n: None if n is None else make(n)
    left = spark.createDataFrame([(k, at(t), i) for k, t, i in points], f"k int, t {kind}, point int")
    right = spark.createDataFrame([(k, at(a), at(b), i) for k, a, b, i in spans], f"k int, a {kind}, b {kind}, span int")
    hit = lambda t, a, b: t is not None and a is not None and a <= t and (b is None or t <= b)
    for keys in ([], ["k"]):
        found = containment_join(left if keys else left.drop("k"), right if keys else right.drop("k"), "t", "a", "b", keys)
        want = Counter((p, s) for pk, t, p in points for sk, a, b, s in spans if hit(t, a, b) and (not keys or pk == sk and pk is not None))
        assert Counter((r.point, r.span) for r in found.collect()) == want
        assert not [x for x in ("NestedLoop", "Cartesian") if x in plan(found)]


def test_containment_of_nothing(spark):
    points, spans = spark.createDataFrame([(1,)], "t long"), spark.createDataFrame([], "a long, b long")
    assert containment_join(points, spans, "t", "a", "b").count() == 0 and containment_join(points.where("false"), spans, "t", "a", "b").count() == 0


# -- turnover from a state ------------------------------------------------------------------

K = day("2024-01-01")


def ledger(spark, changes):
    money = "decimal(18,2)"
    make = spark.createDataFrame
    return {
        "journal_changes": make(changes, f"id long, collection_id long, doc_id long, posted_at timestamp_ntz, stamped_at timestamp_ntz, is_debit boolean, "
                                f"in_balance_rub {money}, amount_rub {money}, in_balance {money}, amount {money}, txn_ts timestamp_ntz, txn_id long, dt date"),
        "legacy_balance": make(
            [(a, day("2023-12-01"), day("2100-12-31"), day("2100-12-31"), *[D(a)] * 8, True) for a in range(6)],
            "account_id long, effective_from date, effective_to date, valid_to_date date, " + ", ".join(
                f"{c} {money}" for c in ("in_amount", "debit_amount", "credit_amount", "out_amount", "in_currency_amount", "debit_currency_amount",
                                         "credit_currency_amount", "out_currency_amount")) + ", closed_date_flag boolean"),
        "op_day": make([(K, 3)], "op_day date, day_status int"),
        # account 0 has two collections
        "ledger_account": make([(c, c // 2, f"3023281051{c // 2:010d}") for c in range(12)], "collection_id long, account_id long, account_number string"),
    }


def month(seed=5):
    """A month of versions: most known on their day, some corrected days later, some posted ahead, quiet days."""
    rng, out = random.Random(seed), []
    for n in range(160):
        posted = K + timedelta(days=rng.choice([0, 1, 1, 2, 3, 8, 9, 15, 22, 28]))
        for _ in range(rng.choice([1, 1, 2, 3])):
            known = posted + timedelta(days=rng.choice([-1, 0, 0, 0, 1, 6, 13]))
            at, i = datetime(posted.year, posted.month, posted.day, 9, n % 60), len(out)
            amount, opening = D(rng.randint(1, 500)), D(rng.randint(1, 500))
            out.append((i, n % 9, n, at, at, rng.random() < 0.5, opening, amount, opening * 2, amount * 2,
                        datetime(known.year, known.month, known.day, 12) if known.year == 2024 else at, i, max(known, K)))
    return out


def test_steps_equal_full_runs_on_every_day(spark, tmp_path):
    tables = ledger(spark, month())
    tables["journal_changes"] = tables["journal_changes"].cache()
    state = TurnoverState(spark, f"file://{tmp_path}/state", K)
    days = [K + timedelta(days=n) for n in (0, 1, 2, 3, 4, 9, 10, 16, 21, 22, 30)]
    for as_of in days:
        state.advance(tables, as_of)
        assert rows(state.turnover(tables)) == rows(turnover(tables, as_of, K)), as_of
    with pytest.raises(ValueError):
        state.advance(tables, days[-1])


def test_a_step_reads_its_own_changes_and_touched_days(spark, tmp_path):
    tables = ledger(spark, month())
    state = TurnoverState(spark, f"file://{tmp_path}/state", K)
    state.advance(tables, K + timedelta(days=20))
    seen = tables["journal_changes"].where(F.col("dt") <= F.lit(K + timedelta(days=20))).count()
    new = state.new_changes(tables["journal_changes"], K + timedelta(days=21)).count()
    assert 0 < new < seen / 5
    before = {p.name: max(f.stat().st_mtime_ns for f in p.iterdir()) for p in (tmp_path / "state/versions").glob("day=*")}
    touched = {f"day={r.d}" for r in state.new_changes(tables["journal_changes"], K + timedelta(days=21)).select(F.to_date("posted_at").alias("d")).collect()}
    state.advance(tables, K + timedelta(days=21))
    after = {p.name: max(f.stat().st_mtime_ns for f in p.iterdir()) for p in (tmp_path / "state/versions").glob("day=*")}
    assert {p for p in after if after[p] != before.get(p)} == touched and len(touched) < len(after)


def test_a_broken_step_is_run_again(spark, tmp_path, monkeypatch):
    tables = ledger(spark, month(6))
    state = TurnoverState(spark, f"file://{tmp_path}/state", K)
    state.advance(tables, K + timedelta(days=2))
    with monkeypatch.context() as broken:
        broken.setattr(TurnoverState, "_carry_last", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            state.advance(tables, K + timedelta(days=9))
    assert state.done() == K + timedelta(days=2)
    state.advance(tables, K + timedelta(days=9))
    assert rows(state.turnover(tables)) == rows(turnover(tables, K + timedelta(days=9), K))


def test_state_without_changes(spark, tmp_path):
    tables = ledger(spark, [])
    state = TurnoverState(spark, f"file://{tmp_path}/state", K)
    assert rows(state.turnover(tables)) == rows(turnover(tables, K, K))
    state.advance(tables, K)
    assert rows(state.turnover(tables)) == rows(turnover(tables, K, K))


# -- versions in buckets, and as a stream ------------------------------------------------------

VERSIONS = "k int, part string, ts int, no int, v string"


def versions(seed, n, keys=30):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(keys), 1, 1, 1, 1, 1, 1, 1, 1]), rng.choice(["a", "b"]), rng.choice([None, rng.randint(0, 9)]), seed * 1000 + j, f"v{j}")
            for j in range(n)]


def newest(spark, *lists):
    return rows(latest_version(spark.createDataFrame([r for x in lists for r in x if r[0] is not None], VERSIONS), ["k", "part"], ["ts", "no"]))


def table_in(spark, tmp_path):
    return BucketedTable(spark, f"file://{tmp_path}/table", ["k", "part"], ["ts", "no"], buckets=4)


def test_bucketed_merge_does_not_shuffle_the_base(spark, tmp_path):
    first, second, third = versions(1, 200), versions(2, 80), versions(3, 40)
    table = table_in(spark, tmp_path)
    assert table.merged() is None
    table.create(spark.createDataFrame(first, VERSIONS))
    assert rows(table.merged()) == newest(spark, first)
    table.add_batch(spark.createDataFrame(second, VERSIONS), 0)
    found = table.merged()
    assert rows(found) == newest(spark, first, second)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(table.merged())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = text.split("\n\n")[0].splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    base = next(k for k, line in enumerate(tree) if "base_" in line)
    above, here = [], depth(tree[base])
    for line in reversed(tree[:base]):  # the operators over the base's scan
        if depth(line) < here:
            above, here = [*above, line], depth(line)
    assert any("SortMergeJoin" in x for x in above) and not any("Exchange" in x for x in above)
    table.compact()
    table.add_batch(spark.createDataFrame(third, VERSIONS), 1)
    assert table.held() == 0 and table.batches() == [1] and rows(table.merged()) == newest(spark, first, second, third)
    table.add_batch(spark.createDataFrame(second, VERSIONS), 0)  # again, and in the base already
    table.add_batch(spark.createDataFrame(third, VERSIONS), 1)
    assert rows(table.merged()) == newest(spark, first, second, third)
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("base_")]:
        spark.sql(f"DROP TABLE {name}")  # as in another session
    assert rows(table_in(spark, tmp_path).merged()) == newest(spark, first, second, third)


def test_stream_of_files_with_a_repeated_batch(spark, tmp_path):
    lists = [versions(k, 50) for k in range(5)]
    for k, x in enumerate(lists):
        spark.createDataFrame(x, VERSIONS).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    table = table_in(spark, tmp_path)
    stream = spark.readStream.schema(VERSIONS).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in")
    follow_versions(stream, table, f"file://{tmp_path}/checkpoint", compact_every=3, availableNow=True).awaitTermination()
    assert table.held() == 2 and table.batches() == [3, 4]
    want = newest(spark, *lists)
    assert rows(table.merged()) == want
    for batch in (1, 4):  # Spark may give a batch twice; one is in the base, one in the log
        table.add_batch(spark.createDataFrame(lists[batch], VERSIONS), batch)
    assert rows(table.merged()) == want
    spark.createDataFrame(versions(9, 60), VERSIONS).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    follow_versions(stream, table, f"file://{tmp_path}/checkpoint", compact_every=3, availableNow=True).awaitTermination()
    assert table.held() == 5 and rows(table.merged()) == newest(spark, *lists, versions(9, 60))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4), st.integers(1, 9)), max_size=12),
       st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4), st.integers(1, 9)), max_size=12))
def test_allocated_parts_add_up(spark, pay, doc):
    schema = "account int, at int, id int, amount decimal(18,2)"
    frames = [spark.createDataFrame([(a, t, k, D(m)) for k, (a, t, m) in enumerate(x)], schema) for x in (pay, doc)]
    found = allocate_fifo(*frames, ["account"], ["at", "id"], "id", parts=2).collect()
    sums = defaultdict(D)
    for r in found:
        assert r.allocated > 0
        sums["p", r.payment] += r.allocated
        sums["d", r.document] += r.allocated
    assert all(sums["p", k] == m for k, (_, _, m) in enumerate(pay)) and all(sums["d", k] == m for k, (_, _, m) in enumerate(doc))


def test_acts_read_the_invoiced_chain_once(spark, sf_dir, tmp_path):
    """Each table of the chain is scanned once for sales, fees and disputes together."""
    from tallyframe.plans.acts import ACT_FAMILIES, txn_facts
    from tallyframe.workload.tables import AS_OF, Given

    tables = Given(spark, sf_dir).act_tables("base")
    names = ["txn", "fee_txn", "invoice", "invoice_item", "invoice_entry", "txn_type"]
    for name in names:
        tables[name].write.parquet(f"file://{tmp_path}/chain_{name}")
    stored = {**tables, **{name: spark.read.parquet(f"file://{tmp_path}/chain_{name}") for name in names}}
    facts = txn_facts(stored, AS_OF, ACT_FAMILIES["base"])
    text = plan(facts)
    assert {name: len([x for x in text.splitlines() if x.startswith("Location") and x.endswith(f"chain_{name}]")]) for name in names} == dict.fromkeys(names, 1)
    assert rows(facts) == rows(txn_facts(tables, AS_OF, ACT_FAMILIES["base"]))


def test_windows_meet_days_instead_of_orders(spark, sf_dir, monkeypatch):
    """What meets the customers' windows is a row per day, however many orders a day has."""
    from tallyframe.workload import atsize
    from tallyframe.workload.tables import Given

    met = []

    def watched(points, *rest):
        met.append(points)
        return containment_join(points, *rest)

    monkeypatch.setattr(atsize, "containment_join", watched)
    g = Given(spark, sf_dir)
    g.orders = reduce(lambda a, b: a.unionByName(b), [g.orders] * 3)
    found = atsize.join_interval_containment(g)
    days = g.orders.select(F.to_date("o_orderdate")).distinct().count()
    assert met[0].count() == days < g.orders.count()
    assert found.agg(F.sum("n")).first()[0] == 3 * Given(spark, sf_dir).orders.join(
        atsize.join_interval_containment(Given(spark, sf_dir)), F.to_date("o_orderdate").between(
            F.col("opens"), F.coalesce("closes", F.lit(day("9999-12-31"))))).count()


def test_missing_keys_are_looked_up_in_all_partitions(spark):
    """Keys take few bytes, so Spark would merge the partitions of the join into one task's sort."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        some = spark.range(5000).selectExpr("IF(id % 100 = 0, NULL, id) AS k", "id % 2 AS v")
        known = spark.range(6000).selectExpr("IF(id % 3 = 0, 3, id) AS k").where("k < 4000")
        found = missing_in(some, known, ["k"]).withColumn("task", F.spark_partition_id()).collect()
        want = [(None if i % 100 == 0 else i, i % 2) for i in range(5000) if i % 100 == 0 or i >= 4000 or (i % 3 == 0 and i != 3)]
        assert Counter((r.k, r.v) for r in found) == Counter(want)
        assert len({r.task for r in found if r.k is not None}) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set(threshold, before)
