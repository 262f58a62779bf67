"""Threads by their root (the README's grouping by thread, as a table).

A message whose ``thread_ts`` is its own ``ts`` is a root, one with another
``thread_ts`` a reply to the root of its channel with that ``ts``; a message
without is a thread of its own.  A thread holding a third of all messages is
cut into time buckets for its positions, and its replies meet their one root in
a join that may be split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators.scan import prefix_scan

BUCKET_SECONDS = 3600.0
_ADDED = ["thread_id", "is_root", "orphan", "root_user", "thread_pos"]


def thread_messages(df: DataFrame, *, channel: str = "channel", ts: str = "ts", ts_num: str = "ts_num",
                    thread: str = "thread_ts", user: str = "user", order: Sequence[str] = (),
                    bucket_seconds: float = BUCKET_SECONDS) -> DataFrame:
    """Adds ``thread_id`` (the root's ``ts``; null for a message without ``ts`` and
    thread), ``is_root``, ``orphan`` (a reply whose root is not in the table),
    ``root_user`` (of the root; null for an orphan) and ``thread_pos`` (1-based, by
    ``(ts_num, *order)``, a total order).  An empty ``thread`` counts as none.
    Of several roots with one ``ts`` the first by that order is the root asked for."""
    c = F.col
    x = df.withColumn("thread_id", F.coalesce(F.when(c(thread) != "", c(thread)), c(ts)))
    x = x.withColumn("is_root", F.coalesce(c("thread_id") == c(ts), F.lit(False)))
    by = F.struct(*[c(o) for o in (ts_num, *order)])
    roots = (x.filter("is_root").groupBy(c(channel).alias("_rc"), c("thread_id").alias("_rt"))
             .agg(F.min_by(F.struct(c(user).alias("u")), by).alias("_root")))
    same = c(channel).eqNullSafe(c("_rc")) & (c("thread_id") == c("_rt"))
    x = x.join(roots, same, "left").withColumns({
        "orphan": c("_root").isNull() & c("thread_id").isNotNull(), "root_user": c("_root")["u"], "_one": F.lit(1)}).drop("_rc", "_rt", "_root")
    bucket = F.floor(F.coalesce(c(ts_num), F.lit(0.0)) / F.lit(float(bucket_seconds)))
    x = prefix_scan(x.withColumn("_at", F.coalesce(c(ts_num), F.lit(0.0))), [channel, "thread_id"], ["_at", *order], bucket,
                    {"thread_pos": ("sum", "_one")})
    return x.select(*df.columns, *[c(a).cast("long").alias(a) if a == "thread_pos" else c(a) for a in _ADDED])


def next_in_thread(threads: DataFrame, *, channel: str = "channel", text: str = "text", user: str = "user") -> DataFrame:
    """Pairs of neighbours in a thread: each message with the one after it
    (``reply``, ``reply_user``; its answer in a training example).  The join is on
    (channel, thread, position), so a long thread is no hot key."""
    c = F.col
    after = threads.select(c(channel).alias("_c"), c("thread_id").alias("_t"), (c("thread_pos") - 1).alias("_p"),
                           c(text).alias("reply"), c(user).alias("reply_user"))
    same = c(channel).eqNullSafe(c("_c")) & (c("thread_id") == c("_t")) & (c("thread_pos") == c("_p"))
    return threads.join(after, same).drop("_c", "_t", "_p")
