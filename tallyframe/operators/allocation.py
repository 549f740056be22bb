"""First-in-first-out allocation of payments to documents.

Prefix sums lay both sides out along one axis of money per account: a payment covers the interval from the sum
before it to the sum with it, and so does a document. Where the two intervals overlap, the payment pays the document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .carry import carry_last, in_parts
from .joins import same_key

AXIS = "decimal(38,4)"


def money_axis(rows: DataFrame, account: Sequence[str], order: Sequence[str], amount: str, parts: int | None = None) -> DataFrame:
    """Rows with a positive amount and their ``_from`` and ``_to`` on the account's axis; a hot account is many parts."""
    placed = in_parts(rows.where(F.col(amount) > 0), account, order, parts)
    inside = W.partitionBy(*account, "_part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    sums = placed.groupBy(*account, "_part").agg(F.sum(amount).alias("_sum"))
    before = W.partitionBy(*account).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    bases = sums.select(*account, "_part", F.sum("_sum").over(before).alias("_base")).where(F.col("_base").isNotNull())
    both = placed.withColumn("_inside", F.sum(amount).over(inside)).alias("r").join(
        bases.alias("s"), same_key([*account, "_part"], "r", "s"), "left")
    upto = (F.coalesce("s._base", F.lit(0)) + F.col("r._inside")).cast(AXIS)
    return both.select("r.*", upto.alias("_to")).withColumn("_from", F.col("_to") - F.col(amount)).drop("_part", "_inside")


#: Rows of an account that one window holds; accounts of more rows are cut into ranges. Rows of a task.
ACCOUNT_ROWS, TASK_ROWS = 100_000, 500_000


def allocate_fifo(
    payments: DataFrame, documents: DataFrame, account: Sequence[str], order: Sequence[str], key: str, amount: str = "amount",
    parts: int | None = None,
) -> DataFrame:
    """(account, payment, document, allocated): each payment goes to the account's oldest document that is still open.

    Both frames have the account columns, the ``order`` columns (a total order within an account), ``key`` and ``amount``.
    What documents do not need has no document; what payments do not cover has no payment; so the
    parts of a payment add up to it and so do those of a document. Amounts that are NULL, zero or negative pay nothing
    and ask for nothing: they are left out. Neither side is compared with the other row by row: a part ends where a
    payment or a document ends, and the other side's row there is the next one along the axis.

    Both sides are written once. Accounts of up to ``ACCOUNT_ROWS`` rows are exchanged once, whole; only larger ones go
    through ranges of rows (``parts``: all accounts do, in so many ranges), which exchange and write every row several times.
    """
    columns = list(dict.fromkeys([*order, key]))

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.where(F.col(amount) > 0).select(*account, F.struct(*columns).alias(name), F.col(amount).alias("_amount"))

    def unpacked(rows: DataFrame, name: str) -> DataFrame:
        given = [F.col(f"{name}.{c}").alias(c) for c in columns if c not in account]
        return rows.where(F.col(name).isNotNull()).select(*account, *given, F.col("_amount").alias(amount))

    if parts:
        return _in_ranges(payments, documents, account, order, key, amount, parts)
    both = materialize(side(payments, "pay").unionByName(side(documents, "doc"), allowMissingColumns=True), "sides")
    large = both.groupBy(*account).count().where(F.col("count") > ACCOUNT_ROWS).select(*account)
    large = materialize(large, "large")
    if large.isEmpty():
        return _in_accounts(both, account, order, key)
    of = same_key(account, "r", "s")
    small = both.alias("r").join(large.alias("s"), of, "left_anti")
    rest = both.alias("r").join(large.alias("s"), of, "left_semi")
    return _in_accounts(small, account, order, key).unionByName(
        _in_ranges(unpacked(rest, "pay"), unpacked(rest, "doc"), account, order, key, amount))


def _in_accounts(both: DataFrame, account: Sequence[str], order: Sequence[str], key: str) -> DataFrame:
    """The allocation of accounts that a window can hold: one exchange by account serves all windows."""
    dealt = both.repartition(max(1, -(-both.count() // TASK_ROWS)), *account)
    upto = W.partitionBy(*account, F.col("pay").isNull()).orderBy(
        *[f"{name}.{c}" for name in ("pay", "doc") for c in order]).rowsBetween(W.unboundedPreceding, 0)
    laid = dealt.withColumn("_end", F.sum("_amount").over(upto).cast(AXIS))
    # the payment and the document that end at or after each end, next to it: going back along the axis, the last ones
    whole = W.partitionBy(*account)
    back = whole.orderBy(F.col("_end").desc()).rangeBetween(W.unboundedPreceding, 0)

    def here(name: str):
        return F.when(F.col(name).isNotNull(), F.struct(
            F.col(f"{name}.{key}").alias("key"), (F.col("_end") - F.col("_amount")).alias("_from"), F.col("_end").alias("_to")))

    rows = laid.withColumns({"next_pay": F.last(here("pay"), True).over(back), "next_doc": F.last(here("doc"), True).over(back)})
    rows = rows.withColumns({
        "_paid": F.max(F.when(F.col("pay").isNotNull(), F.col("_end"))).over(whole),
        "_asked": F.max(F.when(F.col("doc").isNotNull(), F.col("_end"))).over(whole)})
    return _allocated(rows, account)


def _allocated(rows: DataFrame, account: Sequence[str]) -> DataFrame:
    """The part that ends at each row's ``_end``, from what stands next there and from the sums of both sides."""
    zero = F.lit(0).cast(AXIS)
    start = F.greatest(
        F.coalesce("next_pay._from", "_paid", zero), F.coalesce("next_doc._from", "_asked", zero))
    # where both end together, the payment's row tells the part
    twice = F.col("doc").isNotNull() & F.col("next_pay._to").eqNullSafe(F.col("_end"))
    return rows.where(~twice).select(
        *account, F.col("next_pay.key").alias("payment"), F.col("next_doc.key").alias("document"), (F.col("_end") - start).alias("allocated"))


def _in_ranges(
    payments: DataFrame, documents: DataFrame, account: Sequence[str], order: Sequence[str], key: str, amount: str,
    parts: int | None = None,
) -> DataFrame:
    """The allocation of accounts of any size, in ranges of their rows."""
    def side(rows: DataFrame, name: str) -> DataFrame:
        laid = money_axis(rows.select(*dict.fromkeys([*account, *order, key, amount])), account, order, amount, parts)
        return laid.select(*account, F.struct(F.col(key).alias("key"), "_from", "_to").alias(name), F.col("_to").alias("_end"))

    paid, asked = side(payments, "pay"), side(documents, "doc")
    ends = paid.unionByName(asked, allowMissingColumns=True).withColumns({
        "_back": -F.col("_end"), "_kind": F.col("doc").isNotNull().cast("int")})
    # the next payment and the next document at or after each end: the last one, going back along the axis
    for name, other in (("pay", "doc"), ("doc", "pay")):
        ends = carry_last(ends.withColumn("_rank", F.col(other).isNotNull().cast("int")), account, ["_back", "_rank"], name, f"next_{name}", parts)
    totals = paid.groupBy(*account).agg(F.max("_end").alias("_paid")).alias("p").join(
        asked.groupBy(*account).agg(F.max("_end").alias("_asked")).alias("d"), same_key(account, "p", "d"), "full").select(
        *[F.coalesce(f"p.{c}", f"d.{c}").alias(c) for c in account], "_paid", "_asked")
    rows = ends.alias("e").join(totals.alias("t"), same_key(account, "e", "t"), "left").select("e.*", "_paid", "_asked")
    return _allocated(rows, account)
