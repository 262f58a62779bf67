"""Group time-ordered messages into conversations.

The reference walks one globally sorted list and closes the current
conversation when (a) the gap to the previous message reaches the window,
(b) the thread id differs from the previous message's, or (c) the conversation
already holds ``max_messages``; conversations below ``min_messages`` are
dropped.  That greedy loop equals

    break   = first row | ts - lag(ts) >= window | NOT thread <=> lag(thread)
    run     = running max of the row number of the last break
    chunk   = floor((rn - run_start) / max(1, max_messages))

Computed naively this is one window over the whole key (for the global scope:
over the whole table, in one task).  Here it is a *two-level scan*:

1. rows are cut into ``(key, time bucket)`` partitions; one window per bucket
   gives the local row number, local lag and local break positions;
2. a summary with one row per ``(key, bucket)`` (count, first row, last row,
   first/last local break) is carried across buckets by a window over the
   summary (its size is #keys x #buckets, never the rows);
3. the summary is joined back on ``(key, bucket)``; the join keeps the rows'
   hash partitioning.  The summary side repeats the shuffle with the ordering
   columns only.

A hot key (a channel holding a third of all messages) is spread over its time
buckets, and a crowded bucket (a burst, a bulk import under one timestamp) is
cut along the order key.  Conversation size is derived arithmetically from the
next break, so no shuffle by conversation is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.session import cut_lineage

DEFAULT_BUCKET_SECONDS = 3600.0
DEFAULT_BUCKET_ROWS = 2_000_000   # rows per window partition above which a time bucket is split
SAMPLES_PER_CUT = 256             # sampled rows between two cuts of a crowded time bucket
_INTERNAL = {"_sbk", *[f"_sk{i}" for i in range(16)], "_bk", "_thr", "_lrn", "_lprev_ts", "_lprev_thr", "_lbrk", "_lmax", "_lnext",
             "_off", "_tot", "_fbrk", "_cmax", "_cmin", "_prev_last", "_run_len"}


def _coarse(ts: str, bucket_seconds: float) -> Column:
    return F.floor(F.col(ts) / F.lit(float(bucket_seconds))).cast("long")


def hot_splitters(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], bucket_seconds: float,
                  bucket_rows: int) -> DataFrame:
    """Cut points of the time buckets that hold more than ``bucket_rows`` rows.

    One row per such bucket: its keys (``_hk<i>``), ``_hcb`` and ``_cuts``, the
    ascending order keys at which it is cut.  The cuts are every
    ``SAMPLES_PER_CUT``-th row of a sample chosen by a hash of the whole order
    key, so they follow the rows and not the clock: rows that share a second,
    or one timestamp, are cut too.  The sample depends on the rows alone, hence
    every evaluation finds the same cuts."""
    ts = order_cols[0]
    cb = _coarse(ts, bucket_seconds).alias("_hcb")
    hk = [f"_hk{i}" for i in range(len(keys))]
    # half-size pieces: a piece above bucket_rows then needs a sample off by 2x
    every = max(1, int(bucket_rows) // (2 * SAMPLES_PER_CUT))
    picked = F.pmod(F.xxhash64(*[F.col(c) for c in order_cols]), F.lit(every)) == 0
    row = F.struct(*[F.col(c) for c in order_cols])
    rows = df.select(*[F.col(k).alias(a) for k, a in zip(keys, hk)], cb, row.alias("_row"), picked.alias("_picked"))
    hot = (rows.groupBy(*hk, "_hcb").agg(F.count(F.lit(1)).alias("_n"))
               .filter(F.col("_n") > F.lit(int(bucket_rows))).drop("_n"))
    same = F.lit(True)
    r, h = rows.filter("_picked").alias("r"), hot.alias("h")
    for k in [*hk, "_hcb"]:
        same = same & F.col(f"r.{k}").eqNullSafe(F.col(f"h.{k}"))
    step = max(1, min(SAMPLES_PER_CUT, int(bucket_rows) // (2 * every)))
    w = Window.partitionBy(*hk, "_hcb").orderBy("_row")
    cuts = (r.join(h, same, "left_semi").withColumn("_i", F.row_number().over(w))
             .filter(F.pmod(F.col("_i"), F.lit(step)) == 0))
    return cuts.groupBy(*hk, "_hcb").agg(F.array_sort(F.collect_list("_row")).alias("_cuts"))


def with_buckets(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], bucket_seconds: float,
                 bucket_rows: int | None) -> DataFrame:
    """Adds ``_bk``, the window partition within a key: non-decreasing along
    ``order_cols``.  It is the time bucket and, within a bucket of more than
    ``bucket_rows`` rows, the number of cuts at or before the row.

    The cuts are written once and joined: the optimizer broadcasts them if the
    written table is small, else it shuffles (there is one for about ``bucket_rows / 2``
    rows of crowded buckets).  A row finds its place among its bucket's cuts by bisection."""
    coarse = _coarse(order_cols[0], bucket_seconds)
    whole = df.withColumn("_bk", F.struct(coarse.alias("bucket"), F.lit(0).alias("sub")))
    if not bucket_rows:
        return whole
    if df.groupBy(*keys, coarse.alias("_cb")).count().filter(F.col("count") > F.lit(int(bucket_rows))).isEmpty():
        return whole  # no bucket to cut
    hot = cut_lineage(hot_splitters(df, keys, order_cols, bucket_seconds, bucket_rows))
    x = df.withColumn("_cb", coarse)
    cond = x["_cb"] == hot["_hcb"]
    for i, k in enumerate(keys):
        cond = cond & x[k].eqNullSafe(hot[f"_hk{i}"])
    own = F.struct(*[F.col(c) for c in order_cols])
    sub = F.when(F.col("_cuts").isNull(), 0).otherwise(at_or_before(F.col("_cuts"), own))
    bk = F.struct(F.col("_cb").alias("bucket"), sub.cast("int").alias("sub"))
    return x.join(hot, cond, "left").select(*[x[c] for c in df.columns], bk.alias("_bk"))


def at_or_before(ascending: Column, value: Column) -> Column:
    """How many entries of an ascending array are at most ``value``, by bisection."""
    n = F.size(ascending)
    steps = F.sequence(F.lit(0), F.ceil(F.log2(n + 1)).cast("int"))

    def halve(found: Column, _: Column) -> Column:
        low, high = found["low"], found["high"]
        mid = F.floor((low + high) / 2).cast("int")
        right = F.coalesce((low < high) & (F.get(ascending, mid) <= value), F.lit(False))
        return F.struct(F.when(right, mid + 1).otherwise(low).alias("low"), F.when(right, high).otherwise(F.when(low < high, mid).otherwise(high)).alias("high"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), n.alias("high")), halve, lambda found: found["low"])


def key_texts(keys: Sequence[Column]) -> list[Column]:
    """Keys as parts of a conversation id: ":" and "\\" escaped.  Of several keys
    a null one is "\\N"; a single null key is null, which leaves the id a part
    short and so as unlike any other."""
    texts = [F.replace(F.replace(k.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit(":"), F.lit("\\:")) for k in keys]
    return texts if len(texts) == 1 else [F.coalesce(t, F.lit("\\N")) for t in texts]


def sessionize(
    df: DataFrame,
    *,
    keys: Sequence[str] = (),
    ts: str = "ts_num",
    order: Sequence[str] = (),
    thread: str | None = "thread_ts",
    window: float = 7200.0,
    max_messages: int = 40,
    min_messages: int = 2,
    bucket_seconds: float = DEFAULT_BUCKET_SECONDS,
    keep_prev: bool = False,
    bucket_rows: int | None = DEFAULT_BUCKET_ROWS,
) -> DataFrame:
    """Assign every row to a conversation.

    ``keys`` is the scope: ``()`` = global (the reference), ``("channel",)`` =
    per channel, any columns otherwise.  ``(ts, *order)`` must be a total order
    within a key.  Rows with a NULL ``ts`` must be removed beforehand.

    Adds ``rn`` (1-based position within the key), ``run_start``, ``chunk``,
    ``conv_id`` (string), ``conv_pos`` (1-based), ``conv_size``; keeps only
    conversations with ``conv_size >= min_messages``.
    """
    keys = list(keys)
    order_cols = [ts] + list(order)
    cap = max(1, int(max_messages))
    win = F.lit(float(window))
    thr = F.col(thread) if thread else F.lit(None).cast("string")
    c = F.col

    wl = Window.partitionBy(*keys, "_bk").orderBy(*order_cols)
    x = with_buckets(df, keys, order_cols, bucket_seconds, bucket_rows).withColumn("_thr", thr)
    # the one shuffle of the rows, with an explicit count: the windows below are
    # CPU work that AQE would otherwise coalesce by bytes into few tasks
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    x = x.repartition(n, *keys, "_bk")
    x = x.withColumns({"_lrn": F.row_number().over(wl), "_lprev_ts": F.lag(ts).over(wl),
                       "_lprev_thr": F.lag("_thr").over(wl)})
    # a break inside the bucket (rows 2..n); row 1 is decided by the carry
    lbrk = (c("_lrn") > 1) & ((c(ts) - c("_lprev_ts") >= win) | ~c("_thr").eqNullSafe(c("_lprev_thr")))
    x = x.withColumn("_lbrk", F.when(lbrk, c("_lrn")))
    # "next break after this row" as a running min in descending order: a
    # growing frame is evaluated incrementally, while a frame ending at
    # UNBOUNDED FOLLOWING is re-aggregated for every row (quadratic)
    wl_desc = Window.partitionBy(*keys, "_bk").orderBy(*[c(k).desc() for k in order_cols])
    x = x.withColumns({
        "_lmax": F.max("_lbrk").over(wl.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_lnext": F.min("_lbrk").over(wl_desc.rowsBetween(Window.unboundedPreceding, -1))})

    # one row per (key, bucket); x is already hash-partitioned on these columns
    row = F.struct(*[c(k) for k in order_cols], c("_thr").alias("thr"))
    s = x.groupBy(*keys, "_bk").agg(
        F.count(F.lit(1)).alias("_cnt"), F.min(row).alias("_first"), F.max(row).alias("_last"),
        F.max("_lbrk").alias("_bmax_l"), F.min("_lbrk").alias("_bmin_l"))
    wk = Window.partitionBy(*keys).orderBy("_bk") if keys else Window.orderBy("_bk")
    wk_desc = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(c("_bk").desc())
    wk_all = Window.partitionBy(*keys) if keys else Window.partitionBy()
    s = s.withColumns({
        "_off": F.coalesce(F.sum("_cnt").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long"),
        "_tot": F.sum("_cnt").over(wk_all).cast("long"),
        "_prev_last": F.lag("_last").over(wk)})
    fbrk = (c("_prev_last").isNull() | (c("_first")[ts] - c("_prev_last")[ts] >= win)
            | ~c("_first")["thr"].eqNullSafe(c("_prev_last")["thr"]))
    s = s.withColumn("_fbrk", fbrk)
    s = s.withColumns({
        "_bmax": F.coalesce(c("_off") + c("_bmax_l"), F.when(c("_fbrk"), c("_off") + 1)),
        "_bmin": F.coalesce(F.when(c("_fbrk"), c("_off") + 1), c("_off") + c("_bmin_l"))})
    # summary keys renamed: s derives from x, and the join must not be ambiguous
    sk = [f"_sk{i}" for i in range(len(keys))] + ["_sbk"]
    s = s.select(*[c(k).alias(a) for k, a in zip(keys + ["_bk"], sk)], "_off", "_tot", "_fbrk", "_prev_last",
                 F.max("_bmax").over(wk.rowsBetween(Window.unboundedPreceding, -1)).alias("_cmax"),
                 F.min("_bmin").over(wk_desc.rowsBetween(Window.unboundedPreceding, -1)).alias("_cmin"))
    cond = None
    for k, a in zip(keys + ["_bk"], sk):
        e = x[k].eqNullSafe(s[a])
        cond = e if cond is None else cond & e
    j = x.join(s, cond, "inner")
    rn = c("_off") + c("_lrn")
    run_start = F.coalesce(c("_off") + c("_lmax"), F.when(c("_fbrk"), c("_off") + 1), c("_cmax"))
    run_end = F.coalesce(F.coalesce(c("_off") + c("_lnext"), c("_cmin")) - 1, c("_tot"))
    chunk = F.floor((rn - run_start) / F.lit(cap))
    first = c("_lrn") == 1
    extra = {}
    if keep_prev:
        extra = {"has_prev": ~first | c("_prev_last").isNotNull(),
                 "prev_ts": F.when(first, c("_prev_last")[ts]).otherwise(c("_lprev_ts")),
                 "prev_thread": F.when(first, c("_prev_last")["thr"]).otherwise(c("_lprev_thr"))}
    out = j.select(
        x["*"],
        rn.cast("long").alias("rn"),
        run_start.cast("long").alias("run_start"),
        chunk.cast("long").alias("chunk"),
        (rn - run_start - chunk * cap + 1).cast("long").alias("conv_pos"),
        F.least(F.lit(cap).cast("long"), run_end - run_start + 1 - chunk * cap).cast("long").alias("conv_size"),
        F.concat_ws(":", *key_texts([x[k] for k in keys]), run_start.cast("long").cast("string"),
                    chunk.cast("long").cast("string")).alias("conv_id"),
        *[v.alias(k) for k, v in extra.items()])
    out = out.filter(c("conv_size") >= F.lit(int(min_messages)))
    return out.drop(*[k for k in out.columns if k in _INTERNAL])


def break_flags(df: DataFrame, *, keys: Sequence[str] = (), ts: str = "ts_num",
                order: Sequence[str] = (), thread: str | None = "thread_ts",
                window: float = 7200.0) -> DataFrame:
    """W1/W2 as flags on every row (long form): ``gap_break``, ``thread_break``,
    ``is_break``.  Uses the same bucketed scan: the previous row of the first
    row of a bucket comes from the summary carry."""
    out = sessionize(df, keys=keys, ts=ts, order=order, thread=thread, window=window,
                     max_messages=2 ** 62, min_messages=0, keep_prev=True)
    thr = F.col(thread) if thread else F.lit(None).cast("string")
    return (out.withColumn("gap_break", F.col("has_prev") & (F.col(ts) - F.col("prev_ts") >= F.lit(float(window))))
               .withColumn("thread_break", F.col("has_prev") & ~thr.eqNullSafe(F.col("prev_thread")))
               .withColumn("is_break", F.col("rn") == F.col("run_start")))
