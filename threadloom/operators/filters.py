"""Message predicates and projections.

All are plain ``filter``/``select`` expressions, so Catalyst pushes the
channel/date predicates into partition pruning of the bronze table and the
rest into the parquet scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.functions.text import is_nonblank


def human_only(df: DataFrame, markers: Sequence[str] = ("has_subtype", "has_bot_id")) -> DataFrame:
    """keep messages where none of the marker keys is present
    (``has_subtype``/``has_bot_id`` record key *presence*, so a ``null``
    subtype still excludes)."""
    cond = F.lit(True)
    for c in markers:
        cond = cond & ~F.coalesce(F.col(c), F.lit(False))
    return df.filter(cond)


def nonblank(df: DataFrame, text: str = "text") -> DataFrame:
    """text present and not only whitespace (Python's definition)."""
    return df.filter(is_nonblank(text))


def valid_messages(df: DataFrame, markers: Sequence[str] = ("has_subtype", "has_bot_id"),
                   text: str = "text") -> DataFrame:
    """F1 and F2 together (what ``get_messages`` returns)."""
    return nonblank(human_only(df, markers), text)


def by_channel(df: DataFrame, channel: str) -> DataFrame:
    """one channel; an unknown channel gives an empty result."""
    return df.filter(F.col("channel") == F.lit(channel))


def where(df: DataFrame, predicate: Column | str | Callable[[dict], bool]) -> DataFrame:
    """arbitrary predicate.  A Column or SQL string stays in the JVM; a
    Python callable receives each row as a dict, in Arrow batches (slow path:
    select the columns it needs first)."""
    if isinstance(predicate, (Column, str)):
        return df.filter(predicate)

    def keep(batches):
        import pyarrow as pa
        for batch in batches:
            yield batch.filter(pa.array([bool(predicate(r)) for r in batch.to_pylist()], pa.bool_()))

    return df.mapInArrow(keep, df.schema)


def by_date(df: DataFrame, y: int, m: int, d: int) -> DataFrame:
    """calendar date, month/day zero-padded, year as given."""
    return df.filter(F.col("date") == F.lit(f"{y}-{m:02d}-{d:02d}"))


def by_datestring(df: DataFrame, date: str) -> DataFrame:
    """exact date string."""
    return df.filter(F.col("date") == F.lit(date))


def by_date_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """date string prefix ("2024-11" = a month, "" = everything)."""
    return df.filter(F.col("date").startswith(F.lit(prefix)))


def by_user(df: DataFrame, user: str) -> DataFrame:
    """F8: author id present and equal."""
    return df.filter(F.col("user") == F.lit(user))


def channel_names(channels: DataFrame) -> DataFrame:
    """channel names in ``channels.json`` order (not from directories)."""
    return channels.select("ord", "name").orderBy("ord")


def union_exports(*exports: DataFrame) -> DataFrame:
    """O3: the messages of several exports as one table; a column that an
    export lacks is null there."""
    out = exports[0]
    for e in exports[1:]:
        out = out.unionByName(e, allowMissingColumns=True)
    return out
