"""Reading a chat export directory.

Layout::

    <root>/users.json                  array of users (required)
    <root>/channels.json               array of channels (required)
    <root>/<channel>/.../<name>.json   array of messages, any depth

* Discovery (S3): every ``*.json`` (case-sensitive) at least one directory
  below the root, except the names in ``SKIP_FILES`` at any depth.
* Decode (S4/S5): each file is one row (``wholetext``) decoded with
  ``from_json`` into ``array<map<string,string>>`` - the map keeps a key that
  is present with a ``null`` value, which the human-message filter needs.  A
  file that is not UTF-8, not exactly one JSON array of objects in strict
  syntax, or has a ``null`` element is quarantined whole, as the reference
  skips it.  Of a repeated key the last value counts.
* Path columns (S6): ``channel`` = first directory under the root (nested
  folders roll up), ``date`` = second-to-last dot part of the file name,
  always a string.
* One file per ``(channel, date)`` (S7): among the decodable files the deepest
  path wins, then the greatest path (:func:`losing_files`, one rule for batch
  and stream); the few losing files are left out by an anti join.

The Hadoop file source ignores names starting with ``_`` or ``.``; such
folders, at any depth, are passed as extra roots; such files are quarantined
as ``hidden name``, so nothing is skipped unreported.  A decoded export should be written once as the bronze table
(:func:`write_bronze`) and read from there: JSON text cannot be pruned.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.text import parse_ts
from threadloom.sources.paths import qualified_root, relative_path

# ---------------------------------------------------------------------------
# Fixed values (file names the export reader skips at any depth)
# ---------------------------------------------------------------------------
SKIP_FILES = ("integration_logs.json", "users.json", "channels.json", "file_conversations.json", "canvases.json")
# ---------------------------------------------------------------------------

MESSAGE_SCHEMA = "array<map<string,string>>"
USER_SCHEMA = "array<struct<id:string,profile:struct<real_name:string>>>"
CHANNEL_SCHEMA = "array<struct<name:string>>"
JSON_WS = "[ \\t\\n\\r]*"
BRONZE_SCHEMA = ("channel string, pos int, path string, depth int, user string, ts string, ts_num double, "
                 "thread_ts string, text string, has_text boolean, has_subtype boolean, has_bot_id boolean, "
                 "fields map<string,string>, date string")


@dataclass
class Export:
    users: DataFrame       # id, real_name, ord
    channels: DataFrame    # name, ord
    files: DataFrame       # path, rel_path, channel, date, depth, status, n_messages
    messages: DataFrame    # channel, date, pos, path, user, ts, ts_num, thread_ts, text, has_text, has_subtype, has_bot_id, fields
    quarantine: DataFrame  # path, channel, date, reason


def _strip_slash(p: str) -> str:
    return p[:-1] if p.endswith("/") and len(p) > 1 else p


def _escaped(path: str) -> str:
    """A path as a literal glob pattern."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def export_roots(spark: SparkSession, root: str) -> tuple[list[str], list[str]]:
    """The root and every folder below it whose name the file source would skip
    (``_`` or ``.`` in front), found level by level; and the ``.json`` files with
    such names, which it cannot be made to read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        raise FileNotFoundError(f"export directory not found: {root}")  # S8
    base, level = _escaped(qualified_root(spark, root)), ""
    out, unread = [_escaped(_strip_slash(root))], []
    while True:
        for st in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{base}{level}/[._]*")) or []:
            name = st.getPath().getName()
            if st.isDirectory():
                out.append(_escaped(st.getPath().toString()))
            elif name.endswith(".json") and level:
                unread.append(st.getPath().toUri().toString())
        level += "/*"
        if not len(fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(base + level)) or []):
            return out, unread


def _json_array_file(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def strict_array(value: str, schema: str) -> Column:
    """The column's one JSON array, or null: strict quotes, and nothing but white
    space around the array.  The text is parsed as a member of an object whose
    last member, a hash of the text, must still be reached.  The result is looked
    at inside a filter of one element: named twice, it would be parsed twice."""
    mark = F.xxhash64(value)
    inside = F.concat(F.lit('{"a":'), F.col(value), F.lit(',"z":'), mark.cast("string"), F.lit("}"))
    parsed = F.from_json(inside, f"a {schema}, z long", {"allowSingleQuotes": "false"})
    return F.get(F.filter(F.array(parsed), lambda p: p["z"] == mark), 0)["a"]


def _required(value: str, schema: str, name: str) -> Column:
    """A directory file that is no JSON array stops the read."""
    got = strict_array(value, schema)
    return F.when(got.isNull(), F.raise_error(F.lit(f"{name} is not a JSON array"))).otherwise(got)


def read_users(spark: SparkSession, root: str) -> DataFrame:
    """``users.json``; array order is kept as ``ord`` (first match wins)."""
    f = _json_array_file(spark, f"{_strip_slash(root)}/users.json")
    e = f.select(F.posexplode(_required("value", USER_SCHEMA, "users.json")).alias("ord", "u"))
    return e.select(F.col("u.id").alias("id"), F.col("u.profile.real_name").alias("real_name"),
                    F.col("ord").cast("long").alias("ord"))


def read_channels(spark: SparkSession, root: str) -> DataFrame:
    """``channels.json`` with its array order."""
    f = _json_array_file(spark, f"{_strip_slash(root)}/channels.json")
    e = f.select(F.posexplode(_required("value", CHANNEL_SCHEMA, "channels.json")).alias("ord", "c"))
    return e.select(F.col("c.name").alias("name"), F.col("ord").cast("long").alias("ord"))


def _path_columns(df: DataFrame, root: str, path_col: str) -> DataFrame:
    rel = relative_path(path_col, root)
    parts = F.split(rel, "/")
    fname = F.element_at(parts, -1)
    return (df.withColumn("rel_path", rel)
              .withColumn("depth", (F.size(parts) - 1).cast("int"))
              .withColumn("file_name", fname)
              .withColumn("channel", F.element_at(parts, 1))
              .withColumn("date", F.element_at(F.split(fname, "\\.", -1), -2)))


def _eligible(df: DataFrame) -> DataFrame:
    return df.filter((F.col("depth") >= 1) & ~F.col("file_name").isin(*SKIP_FILES))


def large_files(spark: SparkSession, root: str, large_bytes: int) -> list[str]:
    """Message files of more than ``large_bytes``: their count is bounded by the
    export's size through it."""
    roots, _ = export_roots(spark, root)
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(roots)
              .filter(F.col("length") > large_bytes).select(F.col("_metadata.file_path").alias("path")))
    return [r.path for r in _eligible(_path_columns(listed, qualified_root(spark, root), "path")).select("path").distinct().collect()]


def read_files(spark: SparkSession, root: str, without: list[str] | None = None) -> DataFrame:
    """S3: every message file as (path, rel_path, depth, file_name, channel, date,
    value); value is null for a file that cannot be read because of its name."""
    roots, unread = export_roots(spark, root)
    raw = (spark.read.option("recursiveFileLookup", True)
           .option("pathGlobFilter", "*.json").text(roots, wholetext=True))
    if without:  # (on file metadata: such a file is not opened)
        raw = raw.filter(~F.col("_metadata.file_path").isin(without))
    raw = raw.select(F.col("_metadata.file_path").alias("path"), "value")
    if unread:
        raw = raw.unionByName(spark.createDataFrame([(p, None) for p in unread], "path string, value string"))
    return _eligible(_path_columns(raw, qualified_root(spark, root), "path"))


def losing_files(files: DataFrame) -> DataFrame:
    """Paths of the decodable files that another one of their (channel,
    date) replaces.  Two aggregates on narrow rows, no window over a channel-day."""
    ok = files.filter("status = 'ok'").select("channel", "date", "path", "depth")
    best = (ok.groupBy("channel", "date").agg(F.max(F.struct("depth", "path")).alias("_best"), F.count(F.lit(1)).alias("_n"))
            .filter("_n > 1"))
    return ok.join(best, ["channel", "date"]).filter(F.col("path") != F.col("_best")["path"]).select("path")


def read_export(spark: SparkSession, root: str, decoded_path: str | None = None, large_bytes: int | None = None) -> Export:
    """The export's tables.  With ``decoded_path`` the files are decoded once
    into a parquet table there, from which the three outputs are read.  Files of
    more than ``large_bytes`` are read in pieces by many tasks
    (``sources/large.py``), with the same result; None reads every file as one row."""
    large = large_files(spark, root, large_bytes) if large_bytes is not None else []
    decoded = decode(read_files(spark, root, large))
    if decoded_path is not None:
        rows = element_rows(decoded)
        rows.write.mode("overwrite").parquet(decoded_path)
        tables = element_tables(spark.read.schema(rows.schema).parquet(decoded_path))
    else:
        tables = decoded_tables(decoded)
    if large:
        from threadloom.sources.large import read_in_pieces
        more = read_in_pieces(spark, large, qualified_root(spark, root), decoded_path and f"{decoded_path}-pieces")
        tables = tuple(a.unionByName(b) for a, b in zip(tables, more))
    files, messages, quarantine = tables
    messages = messages.join(losing_files(files), "path", "left_anti").select(*messages.columns)
    return Export(read_users(spark, root), read_channels(spark, root), files, messages, quarantine)


def decode(raw: DataFrame) -> DataFrame:
    """S4 on rows ``(path, rel_path, channel, date, depth, value)``: the decoded
    array, or the reason for quarantine.  Only what stands before the first ``[``
    and after the last ``]`` meets a pattern, not the whole text."""
    value = F.col("value")
    opens = value.contains("[") & F.substring_index("value", "[", 1).rlike("^" + JSON_WS + "\\z")
    closes = value.contains("]") & F.substring_index("value", "]", -1).rlike("^" + JSON_WS + "$")
    reason = (F.when(F.col("value").isNull(), F.lit("hidden name"))
               .when(~F.is_valid_utf8("value"), F.lit("not utf-8"))
               .when(~opens | ~closes, F.lit("not a json array"))
               .when(F.col("_arr").isNull(), F.lit("invalid json"))
               .when(F.exists("_arr", lambda m: m.isNull()), F.lit("non-object element")))
    got = raw.withColumn("_arr", strict_array("value", MESSAGE_SCHEMA)).withColumn("reason", reason)
    return got.select("path", "rel_path", "channel", "date", "depth", "reason",
                      F.when(F.col("reason").isNull(), F.col("_arr")).alias("arr"))


def decode_files(raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The file table with its status, the exploded messages and the
    quarantine.  Shared by the batch reader and the streaming ingest."""
    return decoded_tables(decode(raw))


def decoded_tables(decoded: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    quarantine = decoded.filter(F.col("reason").isNotNull()).select("path", "channel", "date", "reason")
    files = decoded.select("path", "rel_path", "channel", "date", "depth",
                           F.coalesce("reason", F.lit("ok")).alias("status"),
                           F.coalesce(F.size("arr"), F.lit(0)).alias("n_messages"))
    ex = (decoded.filter(F.col("reason").isNull())
          .select("channel", "date", "path", "depth", F.posexplode("arr").alias("pos", "m")))
    return files, message_rows(ex), quarantine


def element_rows(decoded: DataFrame) -> DataFrame:
    """Decoded files as rows to be written: a row per message, and one for a
    file without any.  (A row per file would be read back in batches of
    thousands of whole files.)"""
    return decoded.select("path", "rel_path", "channel", "date", "depth", "reason", F.coalesce(F.size("arr"), F.lit(0)).alias("n_messages"),
                          F.posexplode_outer("arr").alias("pos", "m"))


def element_tables(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The tables of :func:`decoded_tables` from written :func:`element_rows`."""
    first = rows.filter(F.coalesce("pos", F.lit(0)) == 0)  # one row of each file
    quarantine = first.filter(F.col("reason").isNotNull()).select("path", "channel", "date", "reason")
    files = first.select("path", "rel_path", "channel", "date", "depth",
                         F.coalesce("reason", F.lit("ok")).alias("status"), "n_messages")
    messages = rows.filter(F.col("pos").isNotNull()).select("channel", "date", "path", "depth", "pos", "m")
    return files, message_rows(messages), quarantine


def message_rows(elements: DataFrame) -> DataFrame:
    """Messages from ``(channel, date, path, depth, pos, m)``, ``m`` an element's map."""
    m = F.col("m")

    def last(key: str) -> Column:  # of a repeated key the last value
        return F.try_element_at(F.filter(F.map_entries(m), lambda e: e["key"] == F.lit(key)), F.lit(-1))["value"]

    return elements.select(
        "channel", "date", F.col("pos").cast("int").alias("pos"), "path", "depth",
        last("user").alias("user"), last("ts").alias("ts"), parse_ts(last("ts")).alias("ts_num"),
        last("thread_ts").alias("thread_ts"), last("text").alias("text"),
        F.map_contains_key(m, "text").alias("has_text"),
        F.map_contains_key(m, "subtype").alias("has_subtype"),
        F.map_contains_key(m, "bot_id").alias("has_bot_id"),
        m.alias("fields"))  # every field, for predicates on other keys


def file_report(files: DataFrame) -> DataFrame:
    """A4: per channel the number of files, decode failures and messages."""
    return files.groupBy("channel").agg(
        F.count(F.lit(1)).cast("long").alias("n_files"),
        F.count_if(F.col("status") != "ok").cast("long").alias("n_failed"),
        F.sum("n_messages").cast("long").alias("n_messages"))


def write_bronze(messages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the decoded messages once (the lineage cut of a build).
    Partitioned by ``date`` only: channel x date would make millions of tiny
    folders at scale; rows are clustered by channel and time inside.  No
    shuffle: each input split holds whole day files, so a task writes few
    dates."""
    (messages.sortWithinPartitions("date", "channel", "ts_num")
     .write.mode(mode).partitionBy("date").parquet(path))


def read_bronze(spark: SparkSession, path: str, latest_file_only: bool = False) -> DataFrame:
    """The bronze table; ``date`` stays the string of the file name.
    ``latest_file_only`` applies S7 at read time (for a table filled
    incrementally, where a later file for the same channel and day replaces the
    earlier one)."""
    b = spark.read.schema(BRONZE_SCHEMA).parquet(path)
    if not latest_file_only:
        return b
    files = b.select("channel", "date", "path", "depth").distinct().withColumn("status", F.lit("ok"))
    return b.join(losing_files(files), "path", "left_anti").select(*b.columns)
