"""Pattern rules as a table: thousands of them match by joins, not by a chain of conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands for no escape character: patterns do not hold it.
_NO_ESCAPE = "\x01"


def literal_prefix(pattern: Column) -> Column:
    """What a LIKE pattern says before its first wildcard."""
    return F.regexp_extract(pattern, "^[^%_]*", 0)


def match_rules(
    df: DataFrame, text: str, rules: DataFrame, pattern: str, label: str, priority: str | None = None, name: str = "label",
) -> DataFrame:
    """Every row with the label of the rule that its text matches; NULL without one.

    ``rules`` has LIKE patterns (``%`` and ``_`` are wildcards, none can be escaped). With ``priority`` the matching rule of least
    priority counts, as in a chain of conditions; without it the one with the longest literal prefix, as in a routing
    table. Ties: the longer prefix, then the least pattern and label. NULL texts and patterns match nothing.

    Different texts are matched once, however many rows have them. A text meets the rules whose literal prefix it has: it is
    cut to the prefix lengths that occur, and the prefixes are joined. The plan is the same for two rules and for two
    million; the driver sees the lengths only. A rule that starts with a wildcard meets every different text.
    """
    own = rules.where(F.col(pattern).isNotNull()).select(
        literal_prefix(F.col(pattern)).alias("_prefix"), F.col(pattern).alias("_pattern"), F.col(label).alias("_label"),
        (F.col(priority) if priority else F.lit(0)).alias("_priority"))
    own = own.withColumn("_length", F.length("_prefix"))
    lengths = sorted(r["_length"] for r in own.select("_length").distinct().collect())
    texts = df.where(F.col(text).isNotNull()).select(F.col(text).alias("_text")).distinct()
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("_text")),
        lambda n: F.substring(F.col("_text"), F.lit(1), n))
    met = texts.withColumn("_prefix", F.explode(prefixes)).join(own, "_prefix").where(F.like(F.col("_text"), F.col("_pattern"), F.lit(_NO_ESCAPE)))
    first = F.min(F.struct("_priority", (-F.col("_length")).alias("_less"), "_pattern", "_label")).alias("_best")
    best = met.groupBy("_text").agg(first).select("_text", F.col("_best._label").alias(name))
    return df.join(best, F.col(text) == F.col("_text"), "left").drop("_text")
