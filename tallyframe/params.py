"""Run parameters: every report takes its date explicitly instead of reading the clock."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

OPEN_END = date(2100, 12, 31)  # fixed value: "still valid" in validity intervals


def first_of_month(day: date) -> date:
    return day.replace(day=1)


def previous_month(as_of: date) -> tuple[date, date]:
    """Half-open bounds [lo, hi) of the month before the one holding ``as_of``."""
    hi = first_of_month(as_of)
    return first_of_month(hi - timedelta(days=1)), hi


@dataclass(frozen=True)
class RunParams:
    as_of: date
    run_ts: datetime

    @classmethod
    def for_offset(cls, today: date, days: int, run_ts: datetime) -> RunParams:
        """The report date ``days`` away from today (negative = past)."""
        return cls(today + timedelta(days=days), run_ts)

    @property
    def month(self) -> tuple[date, date]:
        return previous_month(self.as_of)

    def sql_args(self) -> dict[str, object]:
        """Arguments to bind into ``spark.sql(query, args=...)``."""
        lo, hi = self.month
        return {"as_of": self.as_of, "run_ts": self.run_ts, "month_lo": lo, "month_hi": hi}
