"""Query catalogue: one Spark query per operator of the survey, each paired
with an equivalent DuckDB SQL text (the correctness oracle).

Every query reads whole driver tables (``events``, ``customer``, ``documents``,
``pages``, ``conversations``) and returns flat, aliased columns (BIGINT counts,
strings) so results hash the same in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators import sessionize as sz
from threadloom.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------------------
# DuckDB side: the same message view as ``tables.event_messages``
# ---------------------------------------------------------------------------
_U = "CAST(user_id AS VARCHAR)"
_EVENT_TEXT = (
    "CASE WHEN value < 0.5 THEN '' WHEN value < 1.0 THEN chr(160) || chr(9) || ' ' "
    f"ELSE 'Hi <@' || {_U} || '>, ping <@U' || {_U} || '> in <#C' || {_U} || '|' || event_type "
    f"|| '> and <#C' || {_U} || '>:' || chr(9) || 'see <http://ex.com/' || event_type || '/' "
    f"|| CAST(event_id AS VARCHAR) || '> or <http://a.io/' || {_U} || '>,<http://b.io|b>' "
    "|| chr(10) || chr(10) || ' ok  ' || event_type || ' ' END"
)
MSG_VIEW = f"""
m AS (
  SELECT event_id,
         epoch_us(ts) AS ts_us,
         epoch_us(ts) / 1e6 AS ts_num,
         event_type AS channel,
         strftime(ts, '%Y-%m-%d') AS date,
         CASE WHEN user_id % 10 <> 0 THEN {_U} END AS "user",
         CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 50 THEN '0'
              WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 60 THEN '1' END AS thread_ts,
         event_type = 'error' AS is_system,
         {_EVENT_TEXT} AS text
  FROM events)"""


def _sessionize_sql(part: str | None, window: float, cap: int, min_n: int, thread: bool,
                    src: str = "m", order: str = "ts_num, event_id") -> str:
    """Single-window reference form of the greedy grouping, as CTEs s1..s4."""
    p = f"PARTITION BY {part} " if part else ""
    thr = " OR (thread_ts IS DISTINCT FROM pthr)" if thread else ""
    key = f"{part}, " if part else ""
    return f"""
s1 AS (SELECT *, row_number() OVER w AS rn, lag(ts_num) OVER w AS pts, lag(thread_ts) OVER w AS pthr
       FROM {src} WINDOW w AS ({p}ORDER BY {order})),
s2 AS (SELECT *, CASE WHEN rn = 1 OR ts_num - pts >= {float(window)}{thr} THEN rn END AS brk FROM s1),
s3 AS (SELECT *, max(brk) OVER ({p}ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_start
       FROM s2),
s4 AS (SELECT *, (rn - run_start) // {max(1, cap)} AS chunk FROM s3),
s5 AS (SELECT *, concat_ws(':', {key}CAST(run_start AS VARCHAR), CAST(chunk AS VARCHAR)) AS conv_id,
              (rn - run_start) - chunk * {max(1, cap)} + 1 AS conv_pos,
              count(*) OVER (PARTITION BY {part + ', ' if part else ''}run_start, chunk) AS conv_size FROM s4),
s6 AS (SELECT * FROM s5 WHERE conv_size >= {min_n})"""


def _conv_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.max("conv_size").alias("conv_size"),
        F.min("event_id").alias("first_event"),
        F.max("event_id").alias("last_event"))


_CONV_SUMMARY_SQL = """
SELECT conv_id, count(*) AS n_messages, max(conv_size) AS conv_size,
       min(event_id) AS first_event, max(event_id) AS last_event
FROM s6 GROUP BY conv_id"""


# ---------------------------------------------------------------------------
# Grouping messages into conversations
# ---------------------------------------------------------------------------
@register("sessionize_channel",
          "WITH " + MSG_VIEW + "," + _sessionize_sql("channel", 7200, 40, 2, False) + _CONV_SUMMARY_SQL)
def q_sessionize_channel(spark: SparkSession, sf: str) -> DataFrame:
    m = tables.event_messages(spark, sf)
    out = sz.sessionize(m, keys=["channel"], order=["event_id"], thread=None,
                        window=7200, max_messages=40, min_messages=2)
    return _conv_summary(out)


@register("sessionize_global",
          "WITH " + MSG_VIEW + "," + _sessionize_sql(None, 7200, 40, 2, True) + _CONV_SUMMARY_SQL)
def q_sessionize_global(spark: SparkSession, sf: str) -> DataFrame:
    m = tables.event_messages(spark, sf)
    out = sz.sessionize(m, order=["event_id"], thread="thread_ts",
                        window=7200, max_messages=40, min_messages=2)
    return _conv_summary(out)


from threadloom.plans.catalogue_more import *  # noqa: E402,F401,F403  (registers the rest)
from threadloom.plans.catalogue_export import *  # noqa: E402,F401,F403
from threadloom.plans.catalogue_dataset import *  # noqa: E402,F401,F403
from threadloom.plans.catalogue_order import *  # noqa: E402,F401,F403


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
