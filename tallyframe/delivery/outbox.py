"""Messages and tickets as rows. Sending them is left to whoever reads the rows."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def outbox(items: DataFrame, recipient: str, file: str, text: str, body: Column) -> DataFrame:
    """Messages as rows: per recipient one header row and one row per file.

    A header row has ``part`` 'message', the body as content and the number of files; a file row has
    ``part`` 'file', the file and its text as content. Who sends them joins the rows of a recipient; a recipient with
    many files is many rows, never one long list.
    """
    files = items.select(
        recipient, F.lit("file").alias("part"), F.col(file).alias("file"), F.col(text).alias("content"),
        F.lit(None).cast("bigint").alias("n_files"))
    heads = items.groupBy(recipient).agg(F.count(file).alias("n_files")).select(
        recipient, F.lit("message").alias("part"), F.lit(None).cast("string").alias("file"), body.alias("content"), "n_files")
    return heads.unionByName(files)


def upsert_actions(tickets: DataFrame, open_tickets: DataFrame, as_of: date, days: int = 5) -> DataFrame:
    """Comment on an open ticket with the same queue and summary, or create one with a
    deadline. Of several equal open tickets the first key is used."""
    known = open_tickets.groupBy("queue", "summary").agg(F.min("ticket_key").alias("ticket_key"))
    found = F.col("ticket_key").isNotNull()
    return tickets.join(known, ["queue", "summary"], "left").withColumns({
        "action": F.when(found, "comment").otherwise("create"),
        "deadline": F.when(~found, F.lit(as_of + timedelta(days=days))),
    })
