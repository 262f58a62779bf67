"""Running (prefix) aggregates over an ordered key without one window
partition per key.

Rows are cut into ``(keys, bucket)`` window partitions; each bucket's total is
carried to later buckets by a window over a per-bucket summary (#keys x
#buckets rows) that is joined back on ``(keys, bucket)``.  ``sum``, ``max``
and ``min`` are supported (associative, so local + carry is exact), and ``prev``,
the value of the row before (``lag``), whose carry is the last row of the
bucket before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_COMBINE = {
    "sum": lambda carry, local: F.coalesce(carry, F.lit(0)) + local,
    "max": lambda carry, local: F.greatest(carry, local),
    "min": lambda carry, local: F.least(carry, local),
}
_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def prefix_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column,
                aggs: dict[str, tuple[str, str]]) -> DataFrame:
    """Add one column per ``aggs`` entry ``out -> (fn, value column)``: the
    aggregate over all rows of the key up to and including the current row in
    ``order``.  ``bucket`` must be non-decreasing in ``order`` within a key."""
    keys = list(keys)
    x = df.withColumn("_pb", bucket.cast("long"))
    wo = Window.partitionBy(*keys, "_pb").orderBy(*order)
    wl = wo.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lags = [out for out, (fn, _) in aggs.items() if fn == "prev"]
    for out, (fn, col) in aggs.items():
        x = x.withColumn(f"_l_{out}", F.lag(col).over(wo) if fn == "prev" else _AGG[fn](col).over(wl))
    if lags:
        x = x.withColumn("_l_", F.row_number().over(wo) == 1)
    at = F.struct(*[F.col(c) for c in order])
    s = x.groupBy(*keys, "_pb").agg(*[(F.max_by(col, at) if fn == "prev" else _AGG[fn](col)).alias(f"_b_{out}")
                                      for out, (fn, col) in aggs.items()])
    ws = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("_pb")
    wk = ws.rowsBetween(Window.unboundedPreceding, -1)
    s = s.select(*keys, "_pb", *[(F.lag(f"_b_{out}").over(ws) if fn == "prev" else _AGG[fn](f"_b_{out}").over(wk)).alias(f"_c_{out}")
                                 for out, (fn, _) in aggs.items()])
    cond = None
    for c in keys + ["_pb"]:
        e = x[c].eqNullSafe(s[c])
        cond = e if cond is None else cond & e
    j = x.join(s, cond, "inner").select(x["*"], *[s[f"_c_{o}"] for o in aggs])
    for out, (fn, _) in aggs.items():
        carry, local = F.col(f"_c_{out}"), F.col(f"_l_{out}")
        j = j.withColumn(out, F.when(F.col("_l_"), carry).otherwise(local) if fn == "prev" else _COMBINE[fn](carry, local))
    return j.drop("_pb", "_l_", *[f"_l_{o}" for o in aggs], *[f"_c_{o}" for o in aggs])
