"""Balance and turnover of every account on one day."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import account_class
from ..operators.filters import valid_on
from ..operators.ledger import turnover_of, turnover_parts
from ..operators.setops import union_sources
from ..operators.windows import close_intervals, first_in, latest_version
from ..params import OPEN_END
from ..sources.tables import cdc_since, cdc_window, scd2_current
from . import fixed_values as fv

AMOUNTS = ["in_amount", "debit_amount", "credit_amount", "out_amount"]
CURRENCY = [f"{c.removesuffix('_amount')}_currency_amount" for c in AMOUNTS]
COLUMNS = [
    "account_id", "account_number", "second_order_account_number", "effective_from", "effective_to",
    *AMOUNTS, *CURRENCY, "closed_date_flag",
]
Tables = Mapping[str, DataFrame]


def _accounts(t: Tables) -> DataFrame:
    return t["ledger_account"].select(
        F.col("collection_id").alias("acc_collection"), "account_id", "account_number",
        account_class(F.col("account_number")).alias("second_order_account_number"),
    )


def daily_turnover(t: Tables, as_of: date, cutover: date, until: date | None = None, days: int | None = None) -> DataFrame:
    """One row per account and day with movement, from the change log of the journal.

    The newest version of a row counts. A journal row is a debit only if flagged so. All changes
    since the cut-over are read, so an account that was quiet for long keeps its balance; ``days`` reads the
    last days only, as the plain SQL does.
    """
    changes = t["journal_changes"]
    changes = cdc_since(changes, cutover, as_of) if days is None else cdc_window(changes, as_of, days)
    journal = latest_version(changes, ["doc_id", "collection_id"], ["txn_ts", "txn_id"]).where(F.col("posted_at") >= F.lit(cutover))
    if until is not None:
        journal = journal.where(F.col("posted_at") < F.lit(until + timedelta(days=1)))
    return account_days(t, collection_days(journal))


def collection_days(journal: DataFrame) -> DataFrame:
    """Newest versions of journal rows, shrunk to collections and days before they meet the accounts."""
    moves = journal.withColumns({
        "effective_from": F.to_date("posted_at"),
        "is_debit": F.coalesce("is_debit", F.lit(False)),
    })
    amounts = {"_amount": ("in_balance_rub", "amount_rub"), "_currency_amount": ("in_balance", "amount")}
    return turnover_parts(moves, ["collection_id", "effective_from"], ["posted_at", "stamped_at", "id"], amounts)


def account_days(t: Tables, parts: DataFrame) -> DataFrame:
    """Collections and days folded to accounts and days, with the status of the day."""
    owned = parts.join(_accounts(t), F.col("collection_id") == F.col("acc_collection"))
    daily = turnover_of(
        owned, ["account_id", "account_number", "second_order_account_number", "effective_from"], ["_amount", "_currency_amount"])
    closed_days = t["op_day"].groupBy("op_day").agg(
        F.max(F.col("day_status") == fv.DAY_CLOSED).alias("closed_date_flag")
    )
    return (
        daily.join(closed_days, F.col("effective_from") == F.col("op_day"), "left")
        .withColumn("closed_date_flag", F.coalesce("closed_date_flag", F.lit(False)))
        .drop("op_day")
    )


def legacy_balances(t: Tables, cutover: date) -> DataFrame:
    """Current intervals of the former balance table that start before the cut-over."""
    legacy = scd2_current(t["legacy_balance"]).where(F.col("effective_from") < F.lit(cutover))
    return legacy.join(_accounts(t), "account_id").select(*COLUMNS)


def _both(t: Tables, as_of: date, cutover: date, until: date | None, days: int | None) -> DataFrame:
    """Former intervals and days with movement in one frame, told apart by ``is_new``."""
    return _with_legacy(t, daily_turnover(t, as_of, cutover, until, days), cutover)


def _with_legacy(t: Tables, daily: DataFrame, cutover: date) -> DataFrame:
    new = daily.withColumn("effective_to", F.lit(OPEN_END))
    return union_sources(
        legacy_balances(t, cutover).withColumn("is_new", F.lit(False)),
        new.select(*COLUMNS, F.lit(True).alias("is_new")),
    )


def balance_intervals(t: Tables, as_of: date, cutover: date, days: int | None = None, overlap: bool = False) -> DataFrame:
    """All balance intervals: the former table, then the journal from the cut-over on.

    A former interval ends the day before the account's first new one; ``overlap`` leaves
    it as stored, so an account may have two rows on a day.
    """
    rows = _both(t, as_of, cutover, None, days)
    first_new = F.min(F.when(F.col("is_new"), F.col("effective_from"))).over(W.partitionBy("account_id"))
    rows = rows.withColumn("_first_new", first_new).withColumnRenamed("effective_to", "_stored_to")
    closed = close_intervals(rows, ["account_id", "is_new"], "effective_from", "_next")
    former_end = F.col("_stored_to") if overlap else F.least("_stored_to", F.date_sub("_first_new", 1))
    ended = closed.withColumn("effective_to", F.when(F.col("is_new"), F.col("_next")).otherwise(former_end))
    return ended.where(F.col("effective_to") >= F.col("effective_from")).select(*COLUMNS)


def turnover(t: Tables, as_of: date, cutover: date, days: int | None = None, overlap: bool = False) -> DataFrame:
    """Balance of each account on ``as_of``; a quiet day carries the last closing balance.

    Only each account's last day with movement is needed, so no intervals are built: that
    day, where there is one, comes before a former interval that is still open.
    """
    return turnover_of_days(t, daily_turnover(t, as_of, cutover, as_of, days), as_of, cutover, overlap)


def turnover_of_days(t: Tables, daily: DataFrame, as_of: date, cutover: date, overlap: bool = False) -> DataFrame:
    """The report from days with movement: of each account, at least the last one up to ``as_of``."""
    rows = valid_on(_with_legacy(t, daily, cutover), as_of, "effective_from", "effective_to")
    key = ["account_id", "is_new"] if overlap else ["account_id"]
    current = first_in(rows, key, [F.col("is_new").desc(), F.col("effective_from").desc()])
    return _on_day(current.withColumn("balance_date", F.lit(as_of)))


def turnover_for_dates(t: Tables, dates: Iterable[date], cutover: date, overlap: bool = False) -> DataFrame:
    """``turnover`` for several days in one pass: the intervals are built once, and each is shown for
    the days that it holds. The days are a short list. Changes are read up to the last of them, so an earlier day
    shows corrections that came later; a run for that day alone does not."""
    days = sorted(set(dates))
    intervals = balance_intervals(t, days[-1], cutover, overlap=overlap)
    held = F.filter(
        F.array(*[F.lit(d) for d in days]), lambda d: (d >= F.col("effective_from")) & (d <= F.col("effective_to")))
    return _on_day(intervals.withColumn("balance_date", F.explode(held)))


def _on_day(rows: DataFrame) -> DataFrame:
    """The balance on ``balance_date``: with the day's turnovers if it moved, else carried on."""
    moved = F.col("effective_from") == F.col("balance_date")
    return rows.select(
        "balance_date", "account_id", "second_order_account_number", "account_number",
        F.when(moved, F.col("in_amount")).otherwise(F.col("out_amount")).alias("in_amount"),
        F.col("out_amount"),
        F.when(moved, F.col("debit_amount")).otherwise(F.lit(0)).alias("debit_amount"),
        F.when(moved, F.col("credit_amount")).otherwise(F.lit(0)).alias("credit_amount"),
    )
