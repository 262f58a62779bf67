"""J1 (author name) and J2 (mentions inside text): lookups into the user
directory, by equi-joins whose strategy is left to the optimizer's own size
check.  Rows without an id get a spread key of their own that no user has, so
they are no hot key when the join shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import MENTION_RE, UNKNOWN_USER, clean_rest, rejoin_mentions

#: Messages whose mentions are looked up together.
BLOCK_MESSAGES = 16


def dedup_users(users: DataFrame) -> DataFrame:
    """First entry per id wins (the reference scans the list in order);
    ``real_name`` missing or null falls back to the id."""
    first = F.min(F.struct(F.col("ord").alias("o"), F.col("real_name").alias("n")))
    return users.groupBy("id").agg(F.coalesce(first["n"], F.col("id")).alias("real_name"))


def spread_key(id_col: Column, *by: Column) -> Column:
    """The id, or for a null or empty one a key by ``by`` that is no id."""
    return F.when(id_col.isNull() | (id_col == ""), F.concat(F.lit("\u0000"), F.xxhash64(*by).cast("string"))).otherwise(id_col)


def resolve_author(df: DataFrame, users: DataFrame, user_col: str = "user",
                   out: str = "user_name") -> DataFrame:
    """``user`` id -> real name; empty/missing id -> ``Unknown User``;
    unknown id -> the id itself."""
    u = dedup_users(users).select(F.col("id").alias("_uid"), F.col("real_name").alias("_uname"))
    by = [F.col(c) for c, kind in df.dtypes if not kind.startswith("map") and c != user_col]
    j = df.join(u, spread_key(F.col(user_col), *(by or [F.lit(0)])) == F.col("_uid"), "left")
    name = (F.when(F.col(user_col).isNull() | (F.col(user_col) == ""), F.lit(UNKNOWN_USER))
             .otherwise(F.coalesce(F.col("_uname"), F.col(user_col))))
    return j.withColumn(out, name).drop("_uid", "_uname")


def resolve_mentions(df: DataFrame, users: DataFrame, key: Sequence[str], text: str = "text",
                     out: str = "text", blocks: int | None = None) -> DataFrame:
    """Every ``<@ID>`` in ``text`` -> ``@name``.

    Messages that hold a mention are dealt into blocks of about ``BLOCK_MESSAGES``
    (``blocks`` sets their number) by a hash of ``key``, a row key.  A block's distinct ids are looked up once
    and come back as one map, and the messages take their names from the map of
    their block: no message is regrouped and its text crosses at most one shuffle (none
    where the maps are small enough for the optimizer to broadcast).  An id that very
    many messages mention is asked for once a block.  All other messages pass
    by untouched.  A map holds the known ids of one block, few on purpose: it is
    searched entry by entry.
    """
    marked = F.coalesce(F.contains(F.col(text), F.lit("<@")), F.lit(False))
    plain = df.filter(~marked).withColumn(out, F.col(text))
    n = F.lit(blocks) if blocks else F.greatest(
        F.lit(1), F.ceil(df.filter(marked).agg(F.count(F.lit(1))).scalar() / F.lit(BLOCK_MESSAGES)))
    held = df.filter(marked).withColumns({
        "_ids": F.regexp_extract_all(F.col(text), F.lit(MENTION_RE), 1),
        "_block": F.pmod(F.xxhash64(*[F.col(c) for c in key]), n).cast("long")})
    directory = dedup_users(users).select(F.col("id").alias("_mid"), F.col("real_name").alias("_mname"))
    asked = held.select("_block", F.explode("_ids").alias("_mid")).distinct()
    maps = asked.join(directory, "_mid").groupBy(F.col("_block").alias("_of")).agg(
        F.map_from_entries(F.collect_list(F.struct("_mid", "_mname"))).alias("_map"))
    name = lambda i: F.concat(F.lit("@"), F.coalesce(F.try_element_at("_map", i), i))
    named = held.join(maps, F.col("_block") == F.col("_of"), "left").withColumn(
        out, F.when(F.size("_ids") == 0, F.col(text)).otherwise(rejoin_mentions(F.col(text), F.transform("_ids", name))))
    return named.select(*plain.columns).unionByName(plain)


def clean_messages(df: DataFrame, users: DataFrame, key: Sequence[str], text: str = "text",
                   out: str = "content") -> DataFrame:
    """T6 on a message table: T5 (non-string -> ''), mentions, channel refs,
    URLs, whitespace - in this order."""
    df = df.withColumn(out, F.coalesce(F.col(text), F.lit("")))
    df = resolve_mentions(df, users, key, text=out, out=out)
    return df.withColumn(out, clean_rest(F.col(out)))
