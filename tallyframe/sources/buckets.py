"""A table of newest versions whose base lies in buckets, with a log of changes beside it."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import latest_version

_NONE = -1


class BucketedTable:
    """The newest version of every key: ``base`` in buckets of the keys, ``log`` of batches since.

    Reading merges on the fly: the log shrinks to one row per key and is dealt out by the same hash into as many
    parts as the base has buckets, so the base is read where it lies and never shuffled. ``compact`` writes the
    merge as the next base, bucket by bucket. A base's name tells the last batch that it holds; a batch that
    comes again is written over itself, or is passed over when a base holds it.

    ``keys`` and ``newest`` order versions as ``latest_version`` does; versions of equal order should be equal.
    Rows that lack a key column are versions of nothing and left out. One bucket should fit an executor's disk: choose ``buckets`` for the size expected.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], newest: Sequence[str], buckets: int):
        self.spark, self.folder, self.keys, self.newest, self.buckets = spark, folder.rstrip("/"), list(keys), list(newest), buckets

    def _listed(self, name: str, mark: str) -> list[int]:
        """Numbers of the complete folders ``<mark><number>`` below a folder."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        path = hadoop(f"{self.folder}/{name}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        found = [x.getPath() for x in files.listStatus(path) if x.getPath().getName().startswith(mark)]
        return sorted(int(p.getName()[len(mark):]) for p in found if files.exists(hadoop(p, "_SUCCESS")))

    def held(self) -> int | None:
        """The last batch that the base holds; None without a base."""
        return max(self._listed("base", "upto="), default=None)

    def batches(self) -> list[int]:
        """Batches of the log that are not in the base."""
        held = self.held()
        return [b for b in self._listed("log", "batch=") if b > (_NONE if held is None else held)]

    def _table(self, upto: int) -> str:
        name = "base_" + "".join(c if c.isalnum() else "_" for c in self.folder[-60:]) + f"_{upto + 1}"
        if not self.spark.catalog.tableExists(name):  # a base of an earlier session
            path = f"{self.folder}/base/upto={upto}"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(path).schema)
            by = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return name

    def _write_base(self, df: DataFrame, upto: int) -> None:
        path = f"{self.folder}/base/upto={upto}"
        name = f"new_base_{uuid.uuid4().hex}"
        df.write.mode("overwrite").bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", path).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay; reading names them by what they hold

    def create(self, rows: DataFrame) -> None:
        """The first base, from versions of any number per key."""
        self._write_base(latest_version(rows.dropna(subset=self.keys), self.keys, self.newest).repartition(self.buckets, *self.keys), _NONE)

    def add_batch(self, rows: DataFrame, batch: int) -> None:
        """A batch of changes, shrunk to one row per key. The same number again changes nothing."""
        held = self.held()
        if held is None or batch > held:
            latest_version(rows.dropna(subset=self.keys), self.keys, self.newest).write.mode("overwrite").parquet(f"{self.folder}/log/batch={batch}")

    def merged(self) -> DataFrame | None:
        """The newest version of every key; None while there is neither base nor log."""
        held, log = self.held(), self.batches()
        base = None if held is None else self.spark.table(self._table(held))
        if not log:
            return base
        rows = self.spark.read.parquet(*[f"{self.folder}/log/batch={b}" for b in log])
        changes = latest_version(rows.repartition(self.buckets, *self.keys), self.keys, self.newest)
        if base is None:
            return changes
        # plain equality: only that is the hash by which the base lies in buckets
        both = base.withColumn("_in", F.lit(True)).alias("b").join(
            changes.withColumn("_in", F.lit(True)).alias("c"), [F.col(f"b.{k}") == F.col(f"c.{k}") for k in self.keys], "full")
        # a change counts unless the base is newer; NULLs are older than any value, as in latest_version
        order = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in self.newest])
        changed = F.col("c._in").isNotNull() & (F.col("b._in").isNull() | (order("c") >= order("b")))
        return both.select(*[F.when(changed, F.col(f"c.`{c}`")).otherwise(F.col(f"b.`{c}`")).alias(c) for c in base.columns])

    def compact(self) -> None:
        """Write the merge as the next base. It is complete before anything reads it; the log before it is then unused."""
        log = self.batches()
        if log:
            self._write_base(self.merged(), log[-1])
