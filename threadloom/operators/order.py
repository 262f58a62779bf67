"""O1: the global order of a table, with every row's position in it.

The rows are dealt once by ranges of the whole order key (the splitters come
from a sample of the rows, so equal timestamps are cut by the columns behind
them), sorted inside each range and written; a range's first position is the
count of rows in the ranges before it.  No window and no sort sees more than
one range, and the driver only sees one count a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.session import cut_lineage


def sort_keys(df: DataFrame, order: Sequence[str]) -> list[Column]:
    """The order key, and behind it a hash of the row, so that rows equal in
    ``order`` are cut too and lie the same way in every run (rows equal in all
    columns are interchangeable)."""
    hashed = [F.col(c) for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    return [F.col(c).asc_nulls_first() for c in order] + [F.xxhash64(*(hashed or [F.lit(0)])).asc()]


def ordered_table(df: DataFrame, order: Sequence[str], table: str | None = None, ranges: int | None = None) -> DataFrame:
    """``df`` sorted globally by ``order`` (nulls first) and written as Parquet,
    one file a range, in the order of the files.  Adds ``_range`` and
    ``_range_row``, a row's range and its place there, both from 0.

    ``table`` is a folder on shared storage that the caller removes; the default is
    a new one below the checkpoint folder."""
    keys = sort_keys(df, order)
    dealt = df.repartitionByRange(ranges, *keys) if ranges else df.repartitionByRange(*keys)
    at = dealt.sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    split = cut_lineage(at, table)
    low = F.lit((1 << 33) - 1)
    return split.withColumns({"_range": F.shiftright("_at", 33), "_range_row": F.col("_at").bitwiseAND(low)}).drop("_at")


def global_order(df: DataFrame, order: Sequence[str], out: str = "position", table: str | None = None,
                 ranges: int | None = None) -> DataFrame:
    """``df`` with ``out``, the 1-based position of each row in the global order:
    ``row_number() OVER (ORDER BY order)`` without its single task."""
    rows = ordered_table(df, order, table, ranges)
    counts = rows.groupBy("_range").count().collect()  # one row a range
    starts, total = [], 0
    for r in sorted(counts, key=lambda r: r["_range"]):
        starts.append((r["_range"], total))
        total += r["count"]
    base = df.sparkSession.createDataFrame(starts, "_start_range long, _start long")
    joined = rows.join(base, rows["_range"] == base["_start_range"])
    return joined.select(*df.columns, (F.col("_start") + F.col("_range_row") + 1).cast("long").alias(out))


def order_messages(messages: DataFrame, ts: str = "ts_num", order: Sequence[str] = ("channel", "date", "pos"),
                   out: str = "position", **how) -> DataFrame:
    """O1 on a message table: ascending by numeric ``ts``, an absent one as 0,
    ties in the order of the export's files (``order``)."""
    timed = messages.withColumn("_ts", F.coalesce(F.col(ts), F.lit(0.0)))
    return global_order(timed, ["_ts", *order], out, **how).drop("_ts")
