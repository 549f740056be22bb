"""Reports as a whole: read sources, run a query, hand its result on.

A stage writes its result as a table for later reports, an extract writes the result of a
database query, a notice decides by a condition whether its result goes out. The query is
SQL with ``:as_of``, ``:run_ts``, ``:month_lo`` and ``:month_hi``, or a function of the tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import render, report_dates, safe_name
from ..params import RunParams
from ..session import drop_work, materialize, work_dir
from ..sources.jdbc import read_jdbc
from ..sources.sinks import append_history, write_report, write_table
from ..sources.tables import load_sources
from .contracts import Contract, check_contract
from .routing import outcome, satisfied
from .runlog import log_row, log_run

Query = str | Callable[[dict[str, DataFrame], RunParams], DataFrame]


def select_reports(reports: Iterable, names: Sequence[str] | None) -> list:
    """Reports by name: None selects all, an empty list none, unknown names nothing."""
    return [r for r in reports if names is None or r.name in names]


@contextmanager
def with_result(df: DataFrame, view: str = "result") -> Iterator[DataFrame]:
    """A result that several queries read, written once to the shared folder and under a view name as long as they run."""
    spark = df.sparkSession
    path = work_dir(spark, view)
    kept = materialize(df, view, path)
    kept.createOrReplaceTempView(view)
    try:
        yield kept
    finally:
        spark.catalog.dropTempView(view)
        drop_work(spark, path)


@dataclass(frozen=True)
class Report:
    name: str
    query: Query
    sources: Mapping[str, str] = field(default_factory=dict)

    def result(self, spark: SparkSession, params: RunParams) -> DataFrame:
        tables = load_sources(spark, self.sources, params.as_of)
        if callable(self.query):
            return self.query(tables, params)
        return spark.sql(self.query, args=params.sql_args())


@dataclass(frozen=True)
class StageReport(Report):
    path: str = ""

    def run(self, spark: SparkSession, params: RunParams) -> None:
        write_table(self.result(spark, params), self.path)


@dataclass(frozen=True)
class ExtractReport:
    name: str
    url: str
    query: str
    path: str
    partition: tuple[str, object, object, int] | None = None

    def run(self, spark: SparkSession, params: RunParams) -> None:
        rows = read_jdbc(spark, self.url, self.query, self.partition)
        rows.write.mode("overwrite").csv(fill(spark, self.path, params), header=True)


def fill(spark: SparkSession, template: str, params: RunParams, row: DataFrame | None = None,
         slash: str | None = None) -> str:
    """A template filled with the date texts and the fields of a one-row frame.

    ``slash`` replaces "/" in the fields, which may hold any text; dates keep theirs, so a
    file name can have folders by date.
    """
    source = row if row is not None else spark.range(1).select()
    fields = {c: F.col(f"`{c}`") for c in source.columns}
    if slash:
        fields = {c: safe_name(value, slash) for c, value in fields.items()}
    dates = report_dates(F.lit(params.as_of), F.lit(params.run_ts))
    return source.select(render(template, {**fields, **dates})).first()[0]


@dataclass(frozen=True)
class Attachment:
    """What a notice may send. ``condition`` and ``filler`` are queries over the view ``result``: the first
    cell of the condition decides, the first row of the filler completes the file name and the text."""

    file_name: str = ""
    condition: str = "SELECT 1"
    filler: str | None = None
    text: str | None = None


@dataclass(frozen=True)
class NoticeReport(Report):
    """A result that goes out when a condition holds, as one attachment or several.

    ``condition``, ``filler``, ``file_name`` and ``text`` describe a single one; ``attachments`` lists several.
    Without a contract the result is written as it is.
    """

    contract: Contract | None = None
    folder: str = ""
    file_name: str = ""
    condition: str = "SELECT 1"
    filler: str | None = None
    text: str | None = None
    attachments: tuple[Attachment, ...] = ()
    indicator: str = "none"
    history: str | None = None

    def run(self, spark: SparkSession, params: RunParams) -> dict[str, object]:
        parts = self.attachments or (Attachment(self.file_name, self.condition, self.filler, self.text),)
        paths, texts, attached = [], [], 0
        with with_result(self.result(spark, params)) as result:
            if self.contract:
                problems = check_contract(result, self.contract)
                if problems:
                    raise ValueError(f"{self.name}: {'; '.join(problems)}")
            for part in parts:
                if not holds(spark, part.condition):
                    continue
                attached += 1
                row = filler_row(spark, part.filler)
                if part.file_name:
                    path = f"{self.folder.rstrip('/')}/{fill(spark, part.file_name, params, row, slash='_')}"
                    if self.contract:
                        write_report(result, self.contract, path)
                    else:
                        result.write.mode("overwrite").csv(path, header=True)
                    paths.append(path)
                if part.text:
                    texts.append(fill(spark, part.text, params, row))
            if self.history:
                append_history(result, self.history, params.run_ts, params.as_of)
        verdict = spark.range(1).select(outcome(F.lit(attached), F.lit(self.indicator)))
        return {"attachment_paths": paths, "text": "<br/>".join(texts) or None, "result": verdict.first()[0]}


def holds(spark: SparkSession, condition: str) -> bool:
    """Is the first cell of the condition's first row met? (No row: no.)"""
    answer = spark.sql(condition)
    cell = answer.columns[0]
    first = answer.select(satisfied(F.col(f"`{cell}`"), answer.schema[cell].dataType)).first()
    return first is not None and first[0]


def filler_row(spark: SparkSession, filler: str | None) -> DataFrame | None:
    """The first row of a filler query; without a row every field is empty."""
    if filler is None:
        return None
    row = spark.sql(filler).limit(1)
    return spark.range(1).select().join(row.withColumn("_found", F.lit(True)), F.col("_found"), "left").drop("_found")


def run_reports(spark: SparkSession, reports: Sequence, params: RunParams, log: str, run_id: str) -> None:
    """Run reports one after the other; START and END or ERROR of each go to the log at ``log``.

    The first error ends the run: it is logged and raised again, later reports do not start.
    """
    for report in reports:
        started = log_row(spark, run_id, report.name, "START", params.run_ts)
        log_run(log, started)
        try:
            out = report.run(spark, params) or {}
        except Exception as error:
            log_run(log, log_row(spark, run_id, report.name, "ERROR", params.run_ts, error_msg=str(error)))
            raise
        log_run(log, log_row(
            spark, run_id, report.name, "END", params.run_ts, result=out.get("result"), ticket_key=out.get("ticket_key"),
            attachment_paths=out.get("attachment_paths")))
