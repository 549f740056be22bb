"""Small frames and order-free comparison."""

from datetime import date, datetime
from decimal import Decimal

D = Decimal


def day(text):
    return date.fromisoformat(text)


def at(text):
    return datetime.fromisoformat(text)


def rows(df, *cols):
    """Rows as sorted tuples; decimals as they are."""
    out = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in out.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
