"""Catalogue, export side: day files built as JSON text from ``events`` go
through the export reader's own functions.  Registered on import."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions import text as tx
from threadloom.operators import authors, filters, transcripts
from threadloom.plans.catalogue import MSG_VIEW, register
from threadloom.plans.catalogue_more import (CHAT_PROMPT, MSG_COLS, MSG_COLS_SQL, VALID_SQL, _SEG_SQL, _transcript,
                                             _valid, sql_strip)
from threadloom.session import cut_lineage
from threadloom.sources import export, tables

__all__: list[str] = []

ROOT = "/data/export"


def _day() -> F.Column:
    return F.substring("date", 9, 2).cast("int")


def _day_files(m: DataFrame, *copies: tuple[str, F.Column | None, F.Column | None]) -> DataFrame:
    """JSON texts per channel and day, messages in event order, as the reader
    gets them; a file for each copy ``(folder, part, breaks)`` that has messages.
    ``part`` tells by a message's ``event_id`` whether it is in that copy (None:
    all are); ``breaks`` turns a file's text into something undecodable.

    ``m`` is read once for all copies.  Its rows go to their day's task before
    they are collected: a partial list would be built, sorted and sent again.
    """
    sec = F.floor(F.col("ts_us") / 1_000_000)
    ts = F.concat(sec.cast("string"), F.lit("."), F.lpad((F.col("ts_us") - sec * 1_000_000).cast("string"), 6, "0"))
    one = F.struct("event_id", "user", ts.alias("ts"), "thread_ts", "text",
                   F.when(F.col("is_system"), F.lit("note")).alias("subtype"))
    day = (m.select("channel", "date", one.alias("_one")).repartition("channel", "date")
           .groupBy("channel", "date").agg(F.sort_array(F.collect_list("_one")).alias("_all")))
    # the folder is a row's, not the day's: what follows is then worked out per file, not pushed down to the events
    day = day.select("*", F.explode(F.array(*[F.lit(folder) for folder, _, _ in copies])).alias("_folder"))
    msgs = value = F.lit(None)
    for folder, part, _ in copies:
        own = F.col("_all") if part is None else F.filter("_all", lambda x: part(x["event_id"]))
        msgs = F.when(F.col("_folder") == folder, own).otherwise(msgs)
    day = day.withColumn("_all", msgs).filter(F.size("_all") > 0).withColumn("value", F.to_json("_all"))
    broken = F.lit(False)
    for folder, _, breaks in copies:
        if breaks is not None:
            broken = F.when(F.col("_folder") == folder, breaks).otherwise(broken)
    value = F.when(broken, F.concat("value", F.lit("]"))).otherwise(F.col("value"))
    path = F.concat(F.lit(f"file:{ROOT}/"), F.col("channel"), F.col("_folder"), F.col("date"), F.lit(".json"))
    raw = day.select(path.alias("path"), value.alias("value"))
    return export._eligible(export._path_columns(raw, ROOT, "path"))


def _broken() -> F.Column:
    return F.pmod(_day(), F.lit(7)) == 3


_FILES_SQL = f"""WITH {MSG_VIEW},
f AS (SELECT *, row_number() OVER (PARTITION BY channel, date ORDER BY event_id) - 1 AS pos,
             CAST(substr(date, 9, 2) AS INTEGER) % 7 = 3 AS broken FROM m)"""


@register("decode_files", _FILES_SQL + """
SELECT channel, date, CAST(pos AS INTEGER) AS pos, "user", thread_ts, text, ts_num, is_system AS has_subtype
FROM f WHERE NOT broken""")
def q_decode_files(spark: SparkSession, sf: str) -> DataFrame:
    _, messages, _ = export.decode_files(_day_files(tables.event_messages(spark, sf), ("/", None, _broken())))
    return messages.select("channel", "date", "pos", "user", "thread_ts", "text", "ts_num", "has_subtype")


@register("file_report", _FILES_SQL + """
SELECT channel, count(DISTINCT date) AS n_files, count(DISTINCT CASE WHEN broken THEN date END) AS n_failed,
       CAST(count(*) FILTER (WHERE NOT broken) AS BIGINT) AS n_messages FROM f GROUP BY channel""")
def q_file_report(spark: SparkSession, sf: str) -> DataFrame:
    files, _, _ = export.decode_files(_day_files(tables.event_messages(spark, sf), ("/", None, _broken())))
    return export.file_report(files)


@register("latest_file", _FILES_SQL + f""",
w AS (SELECT *, max(CASE WHEN event_id % 2 = 0 AND NOT broken THEN 1 ELSE 0 END) OVER (PARTITION BY channel, date) = 1 AS sub
      FROM f)
SELECT channel, date, channel || CASE WHEN sub THEN '/sub/' ELSE '/' END || date || '.json' AS rel_path, count(*) AS n_messages
FROM w WHERE NOT sub OR event_id % 2 = 0 GROUP BY ALL""")
def q_latest_file(spark: SparkSession, sf: str) -> DataFrame:
    """The even events of a day come again in a deeper file, broken on some days."""
    m = tables.event_messages(spark, sf)
    raw = _day_files(m, ("/", None, None), ("/sub/", lambda event_id: event_id % 2 == 0, _broken()))
    # decoded once, into a row per message: four passes read it (messages, both sides of the losing files, the files' names)
    files, messages, _ = export.element_tables(cut_lineage(export.element_rows(export.decode(raw))))
    # written, so that their size is known: few go to every task, instead of every file's messages going through a shuffle
    kept = messages.join(cut_lineage(export.losing_files(files)), "path", "left_anti")
    counts = kept.groupBy("path", "channel", "date").agg(F.count(F.lit(1)).alias("n_messages"))
    return counts.join(files.select("path", "rel_path"), "path").select("channel", "date", "rel_path", "n_messages")


@register("path_columns", f"""WITH {MSG_VIEW}
SELECT channel || '/a b%/part.' || date || '.json' AS rel_path, channel, date, CAST(2 AS INTEGER) AS depth, count(*) AS n
FROM m GROUP BY channel, date""")
def q_path_columns(spark: SparkSession, sf: str) -> DataFrame:
    m = tables.event_messages(spark, sf)
    paths = m.select(F.concat(F.lit(f"file://{ROOT}/"), F.col("channel"), F.lit("/a%20b%25/part."), F.col("date"),
                              F.lit(".json")).alias("path"))
    return (export._eligible(export._path_columns(paths, ROOT, "path"))
            .groupBy("rel_path", "channel", "date", "depth").agg(F.count(F.lit(1)).alias("n")))


@register("where_field", _FILES_SQL + """
SELECT channel, count(*) AS n FROM f WHERE NOT broken AND event_id % 3 = 0 GROUP BY channel""")
def q_where_field(spark: SparkSession, sf: str) -> DataFrame:
    _, messages, _ = export.decode_files(_day_files(tables.event_messages(spark, sf), ("/", None, _broken())))
    got = filters.where(messages, F.col("fields")["event_id"].cast("long") % 3 == 0)
    return got.groupBy("channel").agg(F.count(F.lit(1)).alias("n"))


@register("where_callable", f"WITH {MSG_VIEW}, {VALID_SQL} SELECT {MSG_COLS_SQL} FROM v WHERE channel = 'view'")
def q_where_callable(spark: SparkSession, sf: str) -> DataFrame:
    return filters.where(_valid(spark, sf), lambda r: r["channel"] == "view").select(*MSG_COLS)


@register("by_datestring", f"WITH {MSG_VIEW}, {VALID_SQL} SELECT {MSG_COLS_SQL} FROM v WHERE date = '2024-01-07'")
def q_by_datestring(spark: SparkSession, sf: str) -> DataFrame:
    return filters.by_datestring(_valid(spark, sf), "2024-01-07").select(*MSG_COLS)


_TS_SQL = "CASE event_id % 5 WHEN 0 THEN 'nan' WHEN 1 THEN '5d' WHEN 2 THEN ' 12.5 ' ELSE CAST(event_id AS VARCHAR) || '.25' END"


@register("parse_ts", """SELECT event_id, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 12.5
ELSE event_id + 0.25 END::DOUBLE AS ts_num FROM events""")
def q_parse_ts(spark: SparkSession, sf: str) -> DataFrame:
    text = F.expr(_TS_SQL.replace("VARCHAR", "STRING"))
    return tables.read_table(spark, sf, "events").select("event_id", tx.parse_ts(text).alias("ts_num"))


@register("date_string", """SELECT event_id, CAST(year(ts) AS VARCHAR) || '-' || lpad(CAST(month(ts) AS VARCHAR), 2, '0')
|| '-' || lpad(CAST(day(ts) AS VARCHAR), 2, '0') AS date FROM events""")
def q_date_string(spark: SparkSession, sf: str) -> DataFrame:
    e = tables.read_table(spark, sf, "events").select("event_id", F.year("ts").alias("y"), F.month("ts").alias("m"),
                                                      F.dayofmonth("ts").alias("d"))
    return e.select("event_id", tx.date_string("y", "m", "d").alias("date"))


@register("real_name_default", """SELECT CAST(c_custkey AS VARCHAR) AS id,
CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE c_name END AS real_name FROM customer""")
def q_real_name_default(spark: SparkSession, sf: str) -> DataFrame:
    users = tables.customer_users(spark, sf)
    return authors.dedup_users(users.withColumn("real_name", F.when(F.col("ord") % 3 != 0, F.col("real_name"))))


@register("non_string_text", f"""WITH {MSG_VIEW}
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN '' ELSE 'x y' END AS content FROM m""")
def q_non_string_text(spark: SparkSession, sf: str) -> DataFrame:
    m = tables.event_messages(spark, sf).select("event_id", F.when(F.col("event_id") % 4 != 0, F.lit(" x \t y ")).alias("text"))
    return authors.clean_messages(m, tables.customer_users(spark, sf), key=["event_id"]).select("event_id", "content")


@register("context_messages", f"""WITH {_SEG_SQL},
c AS (SELECT session_id, turn, role, list(role || ': ' || {sql_strip('text')}) OVER (PARTITION BY session_id, segment
             ORDER BY turn ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS ctx FROM seg)
SELECT session_id, turn, 'system: {CHAT_PROMPT}' || chr(10) || array_to_string(ctx, chr(10)) AS context
FROM c WHERE role = 'user'""")
def q_context_messages(spark: SparkSession, sf: str) -> DataFrame:
    seg = transcripts.reset_segments(_transcript(spark, sf))
    got = transcripts.context_messages(seg, 4, system_prompt=CHAT_PROMPT)
    lines = F.transform("context", lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return got.select("session_id", "turn", F.array_join(lines, "\n").alias("context"))
