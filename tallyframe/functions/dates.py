"""Date columns of a report, computed per row so many report dates can run at once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Russian month names. The JVM's default locale is English, so the
# names come from these lists and not from date_format.
MONTHS_NOMINATIVE = [
    "январь", "февраль", "март", "апрель", "май", "июнь",
    "июль", "август", "сентябрь", "октябрь", "ноябрь", "декабрь",
]
MONTHS_GENITIVE = [
    "января", "февраля", "марта", "апреля", "мая", "июня",
    "июля", "августа", "сентября", "октября", "ноября", "декабря",
]


def month_bounds(as_of: Column) -> tuple[Column, Column]:
    """Half-open bounds of the month before ``as_of``."""
    hi = F.trunc(as_of, "MM")
    return F.add_months(hi, -1), hi


def _month_name(day: Column, names: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.month(day))


def report_dates(as_of: Column, run_ts: Column) -> dict[str, Column]:
    """The date texts that file names, subjects and bodies may refer to."""
    previous = F.add_months(as_of, -1)
    genitive = F.concat_ws(" ", _month_name(as_of, MONTHS_GENITIVE), F.year(as_of).cast("string"))
    return {
        "DT": F.date_format(as_of, "yyyy-MM-dd"),
        "DT_SLASH": F.date_format(as_of, "yyyy/MM/dd"),
        "PREV_CYR_MONTH": F.concat_ws(
            " ", _month_name(previous, MONTHS_NOMINATIVE), F.year(previous).cast("string")
        ),
        "PREV_CYR_MONTH_SLASH": F.date_format(previous, "yyyy/MM"),
        "CYR_DT": F.concat(F.lit('"'), F.dayofmonth(as_of).cast("string"), F.lit('" '), genitive),
        "CYR_DT_1ST": F.concat(F.lit('"01" '), genitive),
        "DTTM": F.date_format(run_ts, "yyyy-MM-dd HH_mm_ss"),
    }
