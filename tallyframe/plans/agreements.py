"""Two registers of agreements on one day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.compare import compare_registers, differs, merge_registers
from ..operators.joins import semi
from ..operators.setops import union_sources
from . import fixed_values as fv

LABELS = ("missing_in_b", "missing_in_a", "open_date_differs", "close_date_differs")


def _dated(register: DataFrame, opened: str, closed: str) -> DataFrame:
    return register.select(
        "agr_number", F.to_date(opened).alias("open_date"), F.to_date(closed).alias("close_date")
    )


def agreements_check(
    products: DataFrame, internal_products: DataFrame, agreements: DataFrame, as_of: date,
    null_safe: bool = False, labels: tuple[str, str, str, str] = LABELS,
) -> DataFrame:
    """Agreements opened on ``as_of`` that the two systems do not hold alike.

    Register A is ``products`` completed by the internal products with an agreement code,
    register B is ``agreements``; an agreement number has one row in each. The first class
    that applies names the row. A NULL date is no difference unless ``null_safe``.

    Only agreements that some table opens on the day can be reported: every register is cut to
    their numbers by a semi join before the full joins, and AQE sees how few they are.
    """
    day = F.lit(as_of)
    coded = internal_products.where(F.col("agr_number").like(fv.INTERNAL_PRODUCT_PATTERN))
    sides = [
        _dated(products, "open_date", "close_date"), _dated(coded, "open_date", "close_date"),
        _dated(agreements, "signature_date", "closing_date"),
    ]
    opened = union_sources(*[s.where(F.col("open_date") == day).select("agr_number") for s in sides])
    first, second, b = (semi(s, "agr_number", opened, "agr_number").distinct() for s in sides)
    a = merge_registers(first, second, ["agr_number"])
    a_open, b_open = F.col("a_open_date") == day, F.col("b_open_date") == day
    on_day = F.coalesce(a_open, F.lit(False)) | F.coalesce(b_open, F.lit(False))
    both = F.col("in_a") & F.col("in_b")
    rules = [
        (labels[0], a_open & ~F.col("in_b")),
        (labels[1], b_open & ~F.col("in_a")),
        (labels[2], both & on_day & differs("a_open_date", "b_open_date", null_safe)),
        (labels[3], both & on_day & differs("a_close_date", "b_close_date", null_safe)),
    ]
    return compare_registers(a, b, ["agr_number"], rules).select(
        "error_name", "agr_number", "a_open_date", "b_open_date", "a_close_date", "b_close_date"
    )
