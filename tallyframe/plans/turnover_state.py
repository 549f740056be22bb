"""Turnover day by day from a stored state, instead of all changes since the cut-over."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import first_in, latest_version
from ..session import drop_work, materialize, work_dir
from ..sources.sinks import write_table
from ..sources.tables import cdc_since
from .turnover import account_days, collection_days, turnover_of_days

_KEY, _NEWEST = ["doc_id", "collection_id"], ["txn_ts", "txn_id"]


class TurnoverState:
    """Tables in a shared folder that ``advance`` carries from one report day to the next.

    ``versions``: the newest version of every journal row, by its day; ``parts``: opening balance, debits and credits by
    collection, by day; ``last``: of each collection the last day with movement, by report day; ``done``: report days
    that are complete. A step reads the changes since the step before, the days that they touch, and one row per
    collection: not the history. A late correction re-opens the day it is posted to and no other.

    A journal row keeps its day: its versions are posted to one day (a row that must move is withdrawn by an amount
    of zero and booked anew). Steps go forward; one that broke off is run again and ends alike, for a step only replaces
    whole days by what follows from the newest versions, and is ``done`` last.
    """

    def __init__(self, spark: SparkSession, folder: str, cutover: date):
        self.spark, self.folder, self.cutover = spark, folder.rstrip("/"), cutover

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def _exists(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def done(self) -> date | None:
        """The last report day that is complete."""
        return self._read("done").agg(F.max("as_of")).first()[0] if self._exists("done") else None

    def new_changes(self, changes: DataFrame, as_of: date) -> DataFrame:
        """Change rows that no step has seen, up to and with ``as_of``."""
        done = self.done()
        return cdc_since(changes, self.cutover if done is None else done + timedelta(days=1), as_of)

    def advance(self, t: Mapping[str, DataFrame], as_of: date) -> None:
        """Take in all changes up to and with ``as_of``."""
        done = self.done()
        if done is not None and as_of <= done:
            raise ValueError(f"the state is at {done}, it cannot go to {as_of}")
        seen = latest_version(self.new_changes(t["journal_changes"], as_of), _KEY, _NEWEST).where(F.col("posted_at") >= F.lit(self.cutover))
        work = work_dir(self.spark, "turnover-step")
        new = materialize(seen.withColumn("day", F.to_date("posted_at")), "new", f"{work}/new")
        touched = [r["day"] for r in new.select("day").distinct().collect()]  # days, not rows
        if touched:
            if self._exists("versions"):
                held = self._read("versions").where(F.col("day").isin(touched)).select(*new.columns)
                # written aside first: the days that are read are the days that are replaced
                new = materialize(latest_version(held.unionByName(new), _KEY, _NEWEST), "merged", f"{work}/merged")
            write_table(new, f"{self.folder}/versions", by="day")
            parts = collection_days(new.drop("day")).withColumn("day", F.col("effective_from"))
            write_table(parts, f"{self.folder}/parts", by="day")
        self._carry_last(done, as_of, touched)
        self.spark.createDataFrame([(as_of,)], "as_of date").write.mode("append").parquet(f"{self.folder}/done")
        drop_work(self.spark, work)

    def _carry_last(self, done: date | None, as_of: date, touched: list[date]) -> None:
        """Each collection's last day: from the re-opened and the new days, else as it was."""
        rows = None
        if self._exists("parts"):
            day = F.col("day")
            since = F.lit(False) if done is None else day > F.lit(done)
            rows = self._read("parts").where((day.isin(touched) | since) & (day <= F.lit(as_of))).drop("day")
        if done is not None and self._exists(f"last/as_of={done}"):
            before = self._read(f"last/as_of={done}").where(~F.col("effective_from").isin(touched))
            rows = before.unionByName(rows)
        if rows is not None:
            last = first_in(rows, ["collection_id"], [F.col("effective_from").desc()])
            last.write.mode("overwrite").parquet(f"{self.folder}/last/as_of={as_of}")

    def turnover(self, t: Mapping[str, DataFrame], overlap: bool = False) -> DataFrame:
        """``turnover`` of the report day that the state is at."""
        as_of = self.done()
        last = self._read(f"last/as_of={as_of}") if as_of and self._exists(f"last/as_of={as_of}") else collection_days(
            t["journal_changes"].where("false"))
        return turnover_of_days(t, account_days(t, last), as_of or self.cutover, self.cutover, overlap)
