"""A report whose result goes out by routes: one join decides all of them.

Each route names an entity of the result, a recipient and how it is attached. The first result row of
an entity decides by its condition whether the route is taken and fills its file name and text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import render, report_dates
from ..params import RunParams
from .ledger import deliver
from .outbox import outbox, upsert_actions
from .report import Report, with_result
from .routing import outcome, route

EMAIL_FILE, EMAIL_TEXT, TICKET_FILE, TICKET_TEXT = "email_file", "email_text", "ticket_file", "ticket_text"
FILES, TEXTS, TICKETS = (EMAIL_FILE, TICKET_FILE), (EMAIL_TEXT, TICKET_TEXT), (TICKET_FILE, TICKET_TEXT)

#: Files that a task writes, one after the other, and rows of a file that a task writes.
FILES_A_TASK, ROWS_A_TASK = 200, 1_000_000


def spread(result: DataFrame, names: DataFrame, key: str, n_files: int) -> DataFrame:
    """The result's rows with the ``file`` they go to, dealt to tasks by files: opening a file takes longer than its few
    rows, and by bytes all small files would be one task's. A file of very many rows is several parts."""
    parts = result.groupBy(key).agg((F.count(F.lit(1)) / ROWS_A_TASK).cast("int").alias("__parts"))
    rows = result.join(names.join(parts, key), key)
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in result.columns]), F.col("__parts") + 1)
    return rows.repartition(max(1, -(-n_files // FILES_A_TASK)), "file", part).drop("__parts")


@dataclass(frozen=True)
class RoutedReport(Report):
    """Routes have the columns ``key``, ``recipient`` (an address, or a ticket's summary), ``queue`` (tickets only),
    ``attach_kind`` and whatever the templates use. ``folder`` holds all that a run leaves: ``files``,
    ``outbox``, ``tickets`` and the ``ledger`` of what was delivered for which report date.

    What the ledger holds is left out before anything is rendered, so a second run for a date delivers
    nothing again. Files and rows are written first and the ledger last: a failed run is repeated, and its
    rows overwrite those of the attempt.
    """

    routes: Callable[[SparkSession], DataFrame] | None = None
    key: str = ""
    condition: str = "condition"
    order: Sequence[str] = ()
    file_name: str = ""
    text: str = ""
    body: str = ""
    folder: str = ""
    indicator: str = "none"
    open_tickets: DataFrame | None = None
    nothing: tuple[str, str] | None = None

    def run(self, spark: SparkSession, params: RunParams) -> dict[str, object]:
        base = self.folder.rstrip("/")
        with with_result(self.result(spark, params)) as result:
            taken = route(result, self.routes(spark), self.key, F.col(self.condition), [F.col(c) for c in self.order])
            items = taken.where("attach").withColumn("report_dt", F.lit(params.as_of))
            counted: dict[str, int] = {}

            def write(todo: DataFrame) -> None:
                counted["n"] = todo.count()
                rendered = todo.withColumns({
                    "file": F.when(F.col("attach_kind").isin(*FILES), self._render(self.file_name, params, "_")),
                    "content": F.when(F.col("attach_kind").isin(*TEXTS), self._render(self.text, params)),
                })
                where = f"report_dt={params.as_of.isoformat()}/run={params.run_ts:%Y%m%dT%H%M%S}"
                names = rendered.where("file IS NOT NULL").select(self.key, "file").distinct()
                spread(result, names, self.key, counted["n"]).write.mode("overwrite").partitionBy("file").option("header", True).csv(
                    f"{base}/files/{where}")
                mails = rendered.where(~F.col("attach_kind").isin(*TICKETS))
                self._messages(mails, counted["n"], spark).write.mode("overwrite").parquet(f"{base}/outbox/{where}")
                self._tickets(rendered.where(F.col("attach_kind").isin(*TICKETS)), spark, params).write.mode("overwrite").parquet(f"{base}/tickets/{where}")

            deliver(items, f"{base}/ledger", [self.key, "recipient", "attach_kind", "report_dt"], write)
        verdict = spark.range(1).select(outcome(F.lit(counted["n"]), F.lit(self.indicator))).first()[0]
        return {"result": verdict, "n_delivered": counted["n"]}

    def _render(self, template: str, params: RunParams, slash: str | None = None) -> Column:
        fields = {c: F.col(f"`{c}`") for c in self._fields(template)}
        return render(template, {**fields, **report_dates(F.lit(params.as_of), F.lit(params.run_ts))}, slash)

    @staticmethod
    def _fields(template: str) -> list[str]:
        from string import Formatter

        dates = report_dates(F.lit(None), F.lit(None))
        return [name for _, name, _, _ in Formatter().parse(template) if name and name not in dates]

    def _messages(self, mails: DataFrame, delivered: int, spark: SparkSession) -> DataFrame:
        rows = outbox(mails, "recipient", "file", "content", F.lit(self.body))
        if delivered or self.nothing is None:
            return rows
        recipient, said = self.nothing
        empty = spark.range(1).select(
            F.lit(recipient).alias("recipient"), F.lit("message").alias("part"), F.lit(None).cast("string").alias("file"),
            F.lit(said).alias("content"), F.lit(0).cast("bigint").alias("n_files"))
        return rows.unionByName(empty)

    def _tickets(self, rows: DataFrame, spark: SparkSession, params: RunParams) -> DataFrame:
        wanted = rows.groupBy("queue", F.col("recipient").alias("summary")).agg(F.count("file").alias("n_files"))
        known = self.open_tickets
        if known is None:
            known = spark.createDataFrame([], "queue string, summary string, ticket_key string")
        return upsert_actions(wanted, known, params.as_of)
