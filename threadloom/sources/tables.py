"""Views of the driver's parquet tables in the shapes the library works on.

``events`` stands in for a chat export's message table, ``customer`` for the
user directory and ``conversations`` for formatted conversations/transcripts.
The mapping is the same in Spark and in the DuckDB oracle SQL
(``threadloom.plans.catalogue``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.text import epoch_micros

NBSP = "\u00a0"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c) -> F.Column:
    return F.col(c).cast("string")


def event_text() -> F.Column:
    """Chat text built from an event row, with markup of every kind the cleaner
    handles (known and unknown mentions, channel refs with and without label,
    wrapped and greedy URLs, tabs/newlines), and blank texts for small values.
    One SQL expression (the same text as the DuckDB view)."""
    u = "CAST(user_id AS STRING)"
    return F.expr(
        "CASE WHEN value < 0.5 THEN '' WHEN value < 1.0 THEN concat(char(160), char(9), ' ') "
        f"ELSE concat('Hi <@', {u}, '>, ping <@U', {u}, '> in <#C', {u}, '|', event_type, '> and <#C', {u}, "
        "'>:', char(9), 'see <http://ex.com/', event_type, '/', CAST(event_id AS STRING), '> or <http://a.io/', "
        f"{u}, '>,<http://b.io|b>', char(10), char(10), ' ok  ', event_type, ' ') END")


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message view of ``events``: one chat message per event.

    event_id (tie-break), ts_us, ts_num (epoch seconds, double), channel
    (event_type), date (yyyy-MM-dd), user (NULL when user_id % 10 = 0),
    thread_ts ('0' for k < 50, '1' for k in 50..59, else NULL), is_system
    (event_type = 'error', stands for a subtype/bot message), text.
    """
    ev = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return ev.select(
        "event_id",
        epoch_micros("ts").alias("ts_us"),
        (epoch_micros("ts") / F.lit(1e6)).alias("ts_num"),
        F.col("event_type").alias("channel"),
        F.col("ts").cast("date").cast("string").alias("date"),
        F.when(F.col("user_id") % 10 != 0, _s("user_id")).alias("user"),
        F.when(k < 50, F.lit("0")).when(k < 60, F.lit("1")).alias("thread_ts"),
        (F.col("event_type") == "error").alias("is_system"),
        event_text().alias("text"),
    )


def customer_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User directory: id (string), real_name, ord (directory order)."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(_s("c_custkey").alias("id"), F.col("c_name").alias("real_name"),
                    F.col("c_custkey").alias("ord"))
