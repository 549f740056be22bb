"""Accounts whose balance has the wrong sign for their class."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify, map_value
from ..operators.aggregates import violation_summary
from ..operators.sorting import rank_sort
from . import fixed_values as fv


def violations(
    balances: DataFrame, accounts: DataFrame, types: DataFrame, users: DataFrame,
    severity_from: Mapping[str, float] = fv.SEVERITY_FROM,
) -> DataFrame:
    """Every balance with its class, direction, violation type and severity."""
    typed = (
        balances.join(accounts.select("account_id", "type_id", "user_id"), "account_id")
        .join(types.select("type_id", F.col("type_code").alias("acc_type_code")), "type_id")
        .join(users.select("user_id", F.col("user_name").alias("responsible")), "user_id", "left")
    )
    out, code = F.col("out_amount"), F.col("acc_type_code")
    sized = typed.withColumns({
        "balance_direction": classify([("DEBIT", out > 0), ("CREDIT", out < 0)], "ZERO"),
        "abs_amount": F.abs(out),
    })
    direction, size = F.col("balance_direction"), F.col("abs_amount")
    pure = code.isin(fv.ACTIVE, fv.PASSIVE)
    levels = sorted(severity_from.items(), key=lambda kv: -kv[1])
    return sized.withColumns({
        "violation_type": classify([
            ("RED_BALANCE_ACTIVE", (code == fv.ACTIVE) & (direction == "CREDIT")),
            ("RED_BALANCE_PASSIVE", (code == fv.PASSIVE) & (direction == "DEBIT")),
            ("NON_ZERO_ACTIVE_PASSIVE", (code == fv.MIXED) & (direction != "ZERO")),
        ], fv.COMPLIANT),
        "severity_level": classify(
            [(level, pure & (size >= F.lit(bound))) for level, bound in levels]
            + [(fv.MEDIUM, (code == fv.MIXED) & (size > 0))], fv.LOW,
        ),
    })


def red_balance(
    balances: DataFrame, accounts: DataFrame, types: DataFrame, users: DataFrame,
    severity_from: Mapping[str, float] = fv.SEVERITY_FROM, ordered: bool = True,
) -> DataFrame:
    """The violations by section, severity and amount.

    Both sections come from one filtered pass. Each class has its own section, the active
    one included.
    """
    found = violations(balances, accounts, types, users, severity_from).where(
        F.col("violation_type") != fv.COMPLIANT
    )
    report = found.select(
        map_value(F.col("acc_type_code"), fv.SECTIONS).alias("section_name"),
        "balance_date", "second_order_account_number", "account_number", "acc_type_code",
        map_value(F.col("violation_type"), fv.VIOLATIONS).alias("violation_description"),
        "severity_level", "out_amount", "abs_amount", "debit_amount", "credit_amount", "violation_type",
    )
    if not ordered:
        return report
    return rank_sort(
        report,
        {"section_name": list(fv.SECTIONS.values()), "severity_level": [fv.CRITICAL, fv.HIGH, fv.MEDIUM]},
        [F.col("abs_amount").desc(), F.col("account_number")],
    )


def red_summary(found: DataFrame) -> DataFrame:
    """Violations by account class."""
    bad = found.where(F.col("violation_type") != fv.COMPLIANT)
    levels = {fv.CRITICAL: "critical_count", fv.HIGH: "high_count", fv.MEDIUM: "medium_count"}
    return violation_summary(bad, "acc_type_code", "abs_amount", "severity_level", levels).withColumn(
        "account_type_name", map_value(F.col("acc_type_code"), fv.CLASS_NAMES)
    )
