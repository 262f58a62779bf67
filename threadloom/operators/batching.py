"""The trainer-side data layout of the reference, over tables.

* R4 ``length_batches``: length-grouped batching - examples are spread over
  seeded hash "megabatches" of about ``50 * batch_size`` rows, sorted by token
  count (longest first) inside each and cut into batches.  The window is
  partitioned by megabatch, whose size is bounded by construction.
* R6 ``fixed_length``: token rows of length ``L`` - truncate on the left
  (keep the last ``L`` tokens), pad on the right with ``pad``; the attention
  mask is 0 wherever the token equals ``pad`` (pad = eos, so a real eos is
  masked too, as in the reference).
* R5 ``pack_examples``: examples laid end to end in rows of ``max_tokens``
  tokens, separately in seeded hash buckets of about ``bucket_rows`` examples.
* R5 ``pack_whole``: whole examples in rows of at most ``max_tokens`` tokens,
  planned by first-fit-decreasing on the histogram of lengths.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.operators.scan import prefix_scan
from threadloom.operators.split import split_hash_key

MEGABATCH_FACTOR = 50
#: Hex digits of the split hash that bucket a length's examples (4,096 buckets).
RANK_PREFIX = 3


def length_batches(df: DataFrame, id_col: str = "conv_id", length: str = "n_tokens",
                   batch_size: int = 4, seed: int = 42) -> DataFrame:
    n = df.agg(F.count(F.lit(1))).scalar()
    n_mega = F.greatest(F.lit(1), F.ceil(n / F.lit(MEGABATCH_FACTOR * batch_size)))
    u = F.conv(F.substring(split_hash_key(id_col, seed), 1, 8), 16, 10).cast("long")
    x = df.withColumn("megabatch", F.floor(u * n_mega / F.lit(float(1 << 32))).cast("long"))
    w = Window.partitionBy("megabatch").orderBy(F.col(length).desc(), F.col(id_col))
    x = x.withColumn("_r", F.row_number().over(w))
    return x.withColumn("batch", F.floor((F.col("_r") - 1) / F.lit(batch_size)).cast("long")).drop("_r")


def fixed_length(df: DataFrame, tokens: str = "tokens", length: int = 2048, pad: int = 0,
                 out_ids: str = "input_ids", out_mask: str = "attention_mask") -> DataFrame:
    t = F.col(tokens)
    kept = F.slice(t, F.greatest(F.size(t) - F.lit(length) + 1, F.lit(1)), F.lit(length))
    padded = F.concat(kept, F.array_repeat(F.lit(pad), F.greatest(F.lit(length) - F.size(kept), F.lit(0))))
    return (df.withColumn(out_ids, padded)
              .withColumn(out_mask, F.transform(F.col(out_ids), lambda v: F.when(v == F.lit(pad), 0).otherwise(1))))


def pack_examples(df: DataFrame, id_col: str = "conv_id", length: str = "n_tokens", max_tokens: int = 2048,
                  seed: int = 42, bucket_rows: int = 100_000) -> DataFrame:
    """Adds ``bucket``, ``first_row``/``last_row`` (the packed rows of the
    bucket that hold the example's first and last token) and ``row_offset`` (its
    first token's place in ``first_row``).  The order in a bucket is that of the
    split hash; only the last row of a bucket is padded.  An example without
    tokens lies where the next one starts."""
    n = df.agg(F.count(F.lit(1))).scalar()
    n_buckets = F.greatest(F.lit(1), F.ceil(n / F.lit(bucket_rows)))
    key = split_hash_key(id_col, seed)
    u = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    x = df.withColumns({"_key": key, "bucket": F.floor(u * n_buckets / F.lit(float(1 << 32))).cast("long")})
    before = Window.partitionBy("bucket").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("_start", F.coalesce(F.sum(length).over(before), F.lit(0)).cast("long"))
    last = F.col("_start") + F.greatest(F.col(length), F.lit(1)) - 1
    return x.withColumns({"first_row": F.floor(F.col("_start") / max_tokens).cast("long"),
                          "last_row": F.floor(last / max_tokens).cast("long"),
                          "row_offset": (F.col("_start") % max_tokens).cast("long")}).drop("_key", "_start")


def first_fit_plan(histogram: Iterable[tuple[int, int]], max_tokens: int) -> list[tuple[int, int, int, int, int, int]]:
    """First-fit-decreasing of (length, count) classes, all lengths from 1 to
    ``max_tokens``, without a step per example.

    Rows filled alike stand in runs (first row, rows, free tokens), in the order of
    the rows.  A class goes through the runs in that order: each row takes as many of
    its examples as fit, so a run is taken whole, or cut behind the last row that
    takes some.  Result: (length, first rank, examples, first row, examples a
    row, tokens used in those rows before)."""
    runs: list[list[int]] = []
    plan, rows = [], 0
    for length, left in sorted(histogram, reverse=True):
        rank, kept = 0, []
        for first, n, free in runs:
            each = free // length
            if not left or not each:
                kept.append([first, n, free])
                continue
            full = min(n, left // each)
            if full:
                plan.append((length, rank, full * each, first, each, max_tokens - free))
                kept.append([first, full, free - each * length])
                rank, left = rank + full * each, left - full * each
            if full < n:
                some = int(left > 0)
                if some:
                    plan.append((length, rank, left, first + full, left, max_tokens - free))
                    kept.append([first + full, 1, free - left * length])
                    rank, left = rank + left, 0
                if n > full + some:
                    kept.append([first + full + some, n - full - some, free])
        each = max_tokens // length
        for take, n in ((each, left // each), (left % each, 1 if left % each else 0)):  # rows opened for the rest
            if n:
                plan.append((length, rank, take * n, rows, take, 0))
                kept.append([rows, n, max_tokens - take * length])
                rank, rows = rank + take * n, rows + n
        runs = kept
    return plan


def pack_whole(df: DataFrame, id_col: str = "conv_id", length: str = "n_tokens", max_tokens: int = 2048,
               seed: int = 42) -> DataFrame:
    """Adds ``packed_row`` and ``row_offset``: no example is cut and no row
    holds more than ``max_tokens`` tokens.  The assignment is that of first-fit-decreasing
    over all examples, ties of length in the order of the split hash.

    The plan is made from the histogram of lengths, at most ``max_tokens`` rows on the
    driver however many examples there are; an example finds its row by its rank
    among those of its length, which is counted in buckets of the hash, so a
    length that most examples have is no single task's work.  An example over
    ``max_tokens`` or without a length gets null (the length filter F14 drops it);
    one without tokens lies at the start of row 0."""
    fits = F.col(length).between(1, max_tokens)
    histogram = df.filter(fits).groupBy(F.col(length).cast("long").alias("n")).count().collect()
    plan = first_fit_plan([(r["n"], r["count"]) for r in histogram], max_tokens)
    steps = df.sparkSession.createDataFrame(
        plan, "_length long, _rank0 long, _count long, _row0 long, _each long, _used long")
    key = split_hash_key(id_col, seed)
    x = df.withColumns({"_key": key, "_one": F.lit(1)})
    bucket = F.conv(F.substring("_key", 1, RANK_PREFIX), 16, 10)
    ranked = prefix_scan(x.filter(fits), [length], ["_key", id_col], bucket, {"_rank": ("sum", "_one")})
    rank = F.col("_rank") - 1
    own = (ranked[length] == steps["_length"]) & (rank >= F.col("_rank0")) & (rank < F.col("_rank0") + F.col("_count"))
    nth = rank - F.col("_rank0")
    placed = ranked.join(steps, own).select(
        *df.columns, (F.col("_row0") + F.floor(nth / F.col("_each"))).cast("long").alias("packed_row"),
        (F.col("_used") + (nth % F.col("_each")) * F.col("_length")).cast("long").alias("row_offset"))
    empty = F.when(F.col(length) == 0, F.lit(0)).cast("long")
    rest = df.filter(~F.coalesce(fits, F.lit(False))).withColumns({"packed_row": empty, "row_offset": empty})
    return placed.unionByName(rest)
