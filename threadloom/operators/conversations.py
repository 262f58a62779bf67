"""From grouped messages to formatted conversations.

A conversation holds at most ``max_messages`` rows (the sessionizer's cap), so
grouping by conversation never builds an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.template import with_system_prompt


def assign_roles(df: DataFrame, conv: str = "conv_id", pos: str = "conv_pos",
                 content: str = "content", system_prompt: str | None = None) -> DataFrame:
    """W5 (long form): drop messages that are empty after cleaning (F12), then
    alternate ``user``/``assistant`` by position; the first kept message is
    ``user`` with or without a system prompt.  Adds ``msg_idx`` (0-based among
    kept messages, the system row not counted) and ``role``."""
    kept = df.filter(F.col(content) != F.lit(""))
    w = Window.partitionBy(conv).orderBy(pos)
    idx = (F.row_number().over(w) - 1).cast("long")
    return (kept.withColumn("msg_idx", idx)
                .withColumn("role", F.when(F.col("msg_idx") % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))))


def collect_conversations(df: DataFrame, conv: str = "conv_id", pos: str = "conv_pos",
                          content: str = "content", system_prompt: str | None = None) -> DataFrame:
    """A1 + F12 + W5 + N1 + N2 + A2 in one aggregation: per conversation the
    ordered, non-empty messages as ``array<struct<role, content>>`` with roles
    by position and the optional system message first; ``length`` = number of
    messages including the system one."""
    g = df.groupBy(conv).agg(
        F.sort_array(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(content).alias("c")))).alias("_m"))
    kept = F.filter(F.col("_m"), lambda m: m["c"] != F.lit(""))
    msgs = F.transform(kept, lambda m, i: F.struct(
        F.when(i % 2 == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        m["c"].alias("content")))
    out = g.select(F.col(conv), with_system_prompt(msgs, system_prompt).alias("messages"))
    return out.withColumn("length", F.size("messages"))


def messages_text(messages) -> F.Column:
    """Flat ``role: content`` lines of a messages array (for display/compare)."""
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")


def clean_and_collect(grouped: DataFrame, users: DataFrame, text: str = "text", conv: str = "conv_id",
                      pos: str = "conv_pos", system_prompt: str | None = None) -> DataFrame:
    """T1-T6 + A1/W5/N1/N2 with one shuffle.

    Rows are hash-partitioned by conversation once.  Mentions are exploded
    and looked up with an equi-join on the user directory (rows without a
    mention under a spread key); the names are then gathered in the conversation aggregate
    itself, next to the messages, so no per-message regroup is needed.  Each
    message's text is rebuilt inside the conversation (at most
    ``max_messages`` messages), cleaned, and numbered."""
    from threadloom.functions.text import MENTION_RE, clean_rest, rejoin_mentions
    from threadloom.operators import authors
    # CPU-bound stage (regexes per message): an explicit partition count keeps
    # AQE from coalescing it by bytes into a couple of tasks
    spark = grouped.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    x = grouped.repartition(n, conv)
    d = authors.dedup_users(users).select(F.col("id").alias("_mid"), F.col("real_name").alias("_mname"))
    t = F.coalesce(F.col(text), F.lit(""))
    ex = x.select(F.col(conv), F.col(pos).alias("_p"), t.alias("_t"),
                  F.posexplode_outer(F.regexp_extract_all(t, F.lit(MENTION_RE), 1)).alias("_i", "_mid"))
    ex = (ex.withColumn("_key", authors.spread_key(F.col("_mid"), F.col(conv), F.col("_p")))
          .join(d.withColumnRenamed("_mid", "_key"), "_key", "left"))
    first_row = F.coalesce(F.col("_i"), F.lit(0)) == 0
    g = ex.groupBy(conv).agg(
        F.sort_array(F.collect_list(F.when(first_row, F.struct(F.col("_p").alias("p"), F.col("_t").alias("t")))))
        .alias("_m"),
        F.sort_array(F.collect_list(F.when(F.col("_i").isNotNull(), F.struct(
            F.col("_p").alias("p"), F.col("_i").alias("i"),
            F.concat(F.lit("@"), F.coalesce("_mname", "_mid")).alias("n"))))).alias("_n"))
    names = F.col("_n")
    cleaned = F.transform(F.col("_m"), lambda m: F.struct(
        m["p"].alias("p"),
        clean_rest(rejoin_mentions(m["t"], F.transform(F.filter(names, lambda n: n["p"] == m["p"]),
                                                       lambda n: n["n"]))).alias("c")))
    kept = F.filter(cleaned, lambda m: m["c"] != F.lit(""))
    msgs = F.transform(kept, lambda m, i: F.struct(
        F.when(i % 2 == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        m["c"].alias("content")))
    out = g.select(F.col(conv), with_system_prompt(msgs, system_prompt).alias("messages"))
    return out.withColumn("length", F.size("messages"))
