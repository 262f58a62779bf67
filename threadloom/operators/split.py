"""X1 (train/test split) and O2 (sample).

The reference shuffles and takes ``ceil(0.1 * n)`` rows as test.  Here the
shuffle is a seeded hash order: ``h = md5(seed ':' id)``.

* ``split_exact`` returns exactly ``ceil(fraction * n)`` test rows without a
  global sort: a histogram over the first 16 bits of ``h`` (at most 65,536
  rows) locates the bucket holding the k-th smallest hash, a second one over
  its next 16 bits the part of that bucket; only that part (about n / 2^32
  rows) is ranked to find the threshold hash ``h*``; then ``test = h <= h*``.
  Each step is a scalar subquery over the hash column - no join, no collect.
* ``split_hash`` is the single-pass form: ``test`` when the first 32 bits of
  ``h`` fall below ``fraction * 2^32`` (share is approximate).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.session import cut_lineage

HIST_BITS_HEX = 4  # 16 bits -> 65,536 buckets a level


def split_hash_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def _n_test(n: Column, fraction: float) -> Column:
    # float arithmetic as in the reference (ceil(0.1 * 30) == 4)
    return F.ceil(n.cast("double") * F.lit(float(fraction))).cast("long")


def _kth_bucket(h: DataFrame, bucket: str, k: Column) -> Column:
    """Struct of the bucket ``b`` holding the ``k``-th smallest hash and of that
    hash's rank ``r`` in it.  The unpartitioned window has one row per bucket."""
    hist = h.groupBy(bucket).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = hist.withColumn("_cum", F.sum("_c").over(w)).filter((k > 0) & (F.col("_cum") >= k))
    rank = (k - F.col("_cum") + F.col("_c")).alias("r")
    return hist.agg(F.min_by(F.struct(F.col(bucket).alias("b"), rank), bucket)).scalar()


def split_exact(df: DataFrame, id_col: str = "conv_id", seed: int = 42, fraction: float = 0.1,
                out: str = "split", materialize: bool = True, table: str | None = None) -> DataFrame:
    """Exact split.  The threshold needs the whole input before any row can be
    labelled, so with ``materialize`` the input is first written as a table
    (``table``, or one in the session's checkpoint folder).  The threshold
    passes read its hash column only; the rows are read once, when labelled."""
    x = df.withColumn("_h", split_hash_key(id_col, seed))
    if materialize:
        x = cut_lineage(x, table)
    h = x.select("_h", *[F.substring("_h", i * HIST_BITS_HEX + 1, HIST_BITS_HEX).alias(f"_b{i}") for i in (0, 1)])
    k = _n_test(h.agg(F.count(F.lit(1))).scalar(), fraction)
    for level in ("_b0", "_b1"):
        hit = _kth_bucket(h, level, k)
        h, k = h.filter(F.col(level) == hit["b"]), hit["r"]
    hstar = (h.withColumn("_rn", F.row_number().over(Window.orderBy("_h")))
              .filter(F.col("_rn") == k).agg(F.max("_h"))).scalar()
    test = F.coalesce(F.col("_h") <= hstar, F.lit(False))
    return x.withColumn(out, F.when(test, F.lit("test")).otherwise(F.lit("train"))) \
            .withColumnRenamed("_h", "split_hash")


def split_hash(df: DataFrame, id_col: str = "conv_id", seed: int = 42, fraction: float = 0.1,
               out: str = "split") -> DataFrame:
    h = split_hash_key(id_col, seed)
    u = F.conv(F.substring(h, 1, 8), 16, 10).cast("long")
    thr = int(fraction * (1 << 32))
    return df.withColumn(out, F.when(u < F.lit(thr), F.lit("test")).otherwise(F.lit("train")))


def sample(df: DataFrame, n: int = 5, order: str = "split_hash", split: str | None = "train") -> DataFrame:
    """O2: the first ``n`` rows of a split in its (hash) order - a top-k
    (TakeOrderedAndProject), never a collect of the split."""
    x = df if split is None else df.filter(F.col("split") == F.lit(split))
    return x.orderBy(order).limit(n)
