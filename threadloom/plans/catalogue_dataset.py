"""Catalogue, dataset side: sessionization by keys with nulls and under bursts,
example isolation, templates, the sample log, run logs and packed rows.
Registered on import."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.template import render_template
from threadloom.functions.tokens import octet_proxy, python_counter
from threadloom.operators import batching, examples, inventory, split
from threadloom.operators import sessionize as sz
from threadloom.plans.catalogue import _CONV_SUMMARY_SQL, MSG_VIEW, _conv_summary, _sessionize_sql, register
from threadloom.plans.catalogue_more import _RENDER_SQL, _table_convs
from threadloom.sinks import dataset as sinks
from threadloom.sources import tables

__all__: list[str] = []


# ---------------------------------------------------------------------------
# W1-W4 where it is hard: null keys, crowded seconds, far-off timestamps
# ---------------------------------------------------------------------------
@register("sessionize_two_keys", f"""WITH {MSG_VIEW},
mk AS (SELECT *, coalesce("user", '\\N') AS uk FROM m),"""
          + _sessionize_sql("channel, uk", 86400, 5, 1, True, src="mk") + _CONV_SUMMARY_SQL)
def q_sessionize_two_keys(spark: SparkSession, sf: str) -> DataFrame:
    m = tables.event_messages(spark, sf)
    return _conv_summary(sz.sessionize(m, keys=["channel", "user"], order=["event_id"], window=86400, max_messages=5,
                                       min_messages=1, bucket_seconds=7 * 86400.0))


#: 98 of 100 messages share one timestamp, one of 100 comes within that second, one in nanoseconds
_BURST = ("CASE WHEN event_id % 100 = 0 THEN 1.7e18 + event_id * 1.0e6 "
          "WHEN event_id % 100 = 1 THEN 1000000.0 + event_id / 1.0e9 ELSE 1000000.0 END")


@register("sessionize_burst", f"""WITH {MSG_VIEW},
mb AS (SELECT * REPLACE (CAST({_BURST} AS DOUBLE) AS ts_num) FROM m),"""
          + _sessionize_sql(None, 7200, 40, 2, True, src="mb") + _CONV_SUMMARY_SQL)
def q_sessionize_burst(spark: SparkSession, sf: str) -> DataFrame:
    m = tables.event_messages(spark, sf).withColumn("ts_num", F.expr(f"CAST({_BURST} AS DOUBLE)"))
    return _conv_summary(sz.sessionize(m, order=["event_id"], window=7200, max_messages=40, min_messages=2,
                                       bucket_rows=500))


# ---------------------------------------------------------------------------
# A counter that fails on some texts, a template of one's own
# ---------------------------------------------------------------------------
def _failing_counter(text: str) -> int:
    if len(text) % 5 == 0:
        raise ValueError("cannot be counted")
    return len(text)


@register("error_isolation", f"WITH {_RENDER_SQL} SELECT conv_id, length(text) AS n_tokens FROM r "
                             "WHERE length(text) % 5 <> 0 AND length(text) <= 4000 AND length >= 2")
def q_error_isolation(spark: SparkSession, sf: str) -> DataFrame:
    ex = examples.to_examples(_table_convs(spark, sf), python_counter(_failing_counter), max_length=4000, min_size=2)
    return ex.select("conv_id", F.col("n_tokens").cast("long").alias("n_tokens"))


@register("custom_template", """SELECT conv_id, '<s>' || string_agg(CASE role WHEN 'system' THEN '[sys] ' || text || '|'
WHEN 'user' THEN '[user] ' || text || chr(10) ELSE '' END, '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id""")
def q_custom_template(spark: SparkSession, sf: str) -> DataFrame:
    form = {"system": ("[sys] ", "|"), "user": ("[user] ", "\n")}
    return _table_convs(spark, sf).select("conv_id", render_template(F.col("messages"), bos="<s>", role_format=form).alias("text"))


# ---------------------------------------------------------------------------
# K2, R5, R8
# ---------------------------------------------------------------------------
@register("sample_log", f"""WITH {_RENDER_SQL},
h AS (SELECT text, md5('42:' || CAST(conv_id AS VARCHAR)) AS h FROM r),
x AS (SELECT text, h, row_number() OVER (ORDER BY h) AS n, ceil(count(*) OVER () * CAST(0.1 AS DOUBLE)) AS k FROM h),
t AS (SELECT text, row_number() OVER (ORDER BY h) AS i FROM x WHERE n > k)
SELECT 'Dataset Sample:' || chr(10) || chr(10) || string_agg('Example ' || i || ':' || chr(10) || text || chr(10)
       || repeat('-', 80) || chr(10), '' ORDER BY i) AS value FROM t WHERE i <= 5""")
def q_sample_log(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.sample_log_text(split.split_exact(examples.render(_table_convs(spark, sf)), "conv_id"))


@register("pack_examples", f"""WITH {_RENDER_SQL},
e AS (SELECT conv_id, CAST(ceil(strlen(text) / 4) AS BIGINT) AS n, md5('42:' || CAST(conv_id AS VARCHAR)) AS h,
             greatest(1, ceil(count(*) OVER () / 50)) AS nb FROM r),
b AS (SELECT *, CAST(floor(CAST('0x' || substr(h, 1, 8) AS BIGINT) * nb / 4294967296.0) AS BIGINT) AS bucket FROM e),
s AS (SELECT *, CAST(sum(n) OVER (PARTITION BY bucket ORDER BY h) - n AS BIGINT) AS s FROM b)
SELECT conv_id, bucket, s // 2048 AS first_row, (s + greatest(n, 1) - 1) // 2048 AS last_row, s % 2048 AS row_offset FROM s""")
def q_pack_examples(spark: SparkSession, sf: str) -> DataFrame:
    ex = examples.with_token_count(examples.render(_table_convs(spark, sf)), octet_proxy)
    out = batching.pack_examples(ex, "conv_id", "n_tokens", max_tokens=2048, seed=42, bucket_rows=50)
    return out.select("conv_id", "bucket", "first_row", "last_row", "row_offset")


_LOG_LEVEL = "CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END"
_LOG_TEXT = "CASE WHEN event_id % 50 = 20 THEN 'Starting training pipeline:' ELSE event_type END"


@register("run_log", f"""WITH l AS (SELECT event_id AS line_no, epoch_us(ts) // 1000 AS ms, {_LOG_LEVEL} AS level, {_LOG_TEXT} AS message
                                    FROM events WHERE event_id % 7 <> 3),
r AS (SELECT *, CAST(sum(CASE WHEN message = 'Starting training pipeline:' THEN 1 ELSE 0 END) OVER (ORDER BY line_no) AS BIGINT)
      AS run FROM l)
SELECT line_no, level, message, run, (ms - lag(ms) OVER (PARTITION BY run ORDER BY line_no)) / 1e3 AS since_prev_s FROM r""")
def q_run_log(spark: SparkSession, sf: str) -> DataFrame:
    """One log line per event; every seventh line has no time and is no log line."""
    e = tables.read_table(spark, sf, "events")
    line = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"), F.lit(" - "), F.expr(_LOG_LEVEL), F.lit(" - "),
                    F.expr(_LOG_TEXT))
    raw = e.select(F.col("event_id").alias("line_no"), F.when(F.col("event_id") % 7 != 3, line).otherwise("-- no time --").alias("value"))
    return inventory.parse_log(raw).select("line_no", "level", "message", "run", "since_prev_s")
