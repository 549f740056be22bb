"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Joins are never hinted: Spark broadcasts a side only when its measured size is
# under autoBroadcastJoinThreshold, and AQE re-checks that with real shuffle sizes.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs a further shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # no Python call site per column expression: plans here have thousands of them
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def shuffle_partitions(shuffled_bytes: int, per_partition: int = 128 << 20) -> int:
    """Enough shuffle partitions to fit each in an executor's memory; AQE merges spare ones."""
    return max(200, -(-shuffled_bytes // per_partition))


def build_session(
    app_name: str = "tallyframe", master: str | None = None, shuffled_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the defaults above. ``shuffled_bytes`` is the largest shuffle expected,
    for reports of terabytes; any setting can be given in ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sized = {"spark.sql.shuffle.partitions": str(shuffle_partitions(shuffled_bytes))} if shuffled_bytes else {}
    for key, value in {**DEFAULTS, **sized, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str, root: str | None = None) -> str:
    """A fresh folder for ``name`` that the driver and every executor can reach.

    It lies below ``root``, else below the shared folder named in ``spark.checkpoint.dir``, else
    below the warehouse, which Spark shares too. It is deleted when the Spark application ends;
    ``drop_work`` deletes it earlier.
    """
    shared = root or spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{shared.rstrip('/')}/_work/{name}-{uuid.uuid4().hex}"
    where, files = _files(spark, path)
    files.deleteOnExit(where)
    return path


def drop_work(spark: SparkSession, path: str) -> None:
    """Delete a work folder whose rows nobody will read again."""
    where, files = _files(spark, path)
    files.delete(where, True)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A file in any folder that Spark can write."""
    where, files = _files(spark, path)
    out = files.create(where)
    out.write(bytearray(data))
    out.close()


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives Spark the true size of the frame
    when it chooses a join.
    """
    path = path or work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
