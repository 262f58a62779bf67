"""S3-S5 for array files too large for one task.

A file is read as records that end at "}" (the text source splits it into byte
ranges and finds the records itself), so no task holds more of it than a range.
Where a record begins, inside a string or outside and how deep, follows from
the records before it: the parity of their unescaped quotes, then the sum of
their brackets outside strings, both running sums over the byte ranges.  An
array element ends at a "}" that is outside strings and leaves depth one; the
records up to it are put together again, an element a row, and parsed as the
whole-text reader parses them.  The verdict over a file comes last: its
elements' messages count only if everything in it was in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators.scan import prefix_scan
from threadloom.session import cut_lineage
from threadloom.sources.export import JSON_WS, MESSAGE_SCHEMA, _path_columns, message_rows, strict_array

_NULLS_BEFORE = f"(null{JSON_WS},{JSON_WS})*"
FIRST_LEAD = f"^{JSON_WS}\\[{JSON_WS}{_NULLS_BEFORE}\\z"
NEXT_LEAD = f"^{JSON_WS},{JSON_WS}{_NULLS_BEFORE}\\z"
REST = f"^{JSON_WS}(,{JSON_WS}null{JSON_WS})*\\]{JSON_WS}\\z"
REST_ALONE = f"^{JSON_WS}\\[{JSON_WS}(null{JSON_WS}(,{JSON_WS}null{JSON_WS})*)?\\]{JSON_WS}\\z"


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign)))


def records(spark: SparkSession, paths: list[str], table: str | None = None) -> DataFrame:
    """(path, size, block, nth, value): the pieces of the files, in the order of
    (block, nth); written, since ``nth`` is a place in this one scan."""
    raw = spark.read.option("lineSep", "}").text([_literal(p) for p in paths])
    return cut_lineage(raw.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth"), "value"), table)


def _literal(uri: str) -> str:
    """A file URI as the reader's path: decoded, glob signs escaped."""
    import re
    from urllib.parse import unquote
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", unquote(uri))


def elements(pieces: DataFrame) -> DataFrame:
    """(path, pos, whole, text): a row an element of the outer array, and a last
    one (``whole`` false) of what follows the last element."""
    c = F.col
    at = ["block", "nth"]
    bare = F.regexp_replace("value", r"(?s)\\.", "")  # escapes and what they escape
    x = pieces.withColumn("_quotes", _count(bare, '"').cast("long"))
    x = prefix_scan(x, ["path"], at, c("block"), {"_seen": ("sum", "_quotes")})
    inside = (c("_seen") - c("_quotes")) % 2 == 1
    after = F.when(inside, F.regexp_replace(bare, r'^[^"]*("|\z)', "")).otherwise(bare)
    code = F.regexp_replace(after, r'"[^"]*("|\z)', "")  # outside strings
    outside = c("_seen") % 2 == 0  # at the piece's end, where its "}" stands
    delta = _count(code, "[") + _count(code, "{") - _count(code, "]") - outside.cast("int")
    x = x.withColumn("_outside", outside).withColumn("_delta", delta.cast("long"))
    x = prefix_scan(x, ["path"], at, c("block"), {"_depth": ("sum", "_delta")})
    x = x.withColumn("_ends", (c("_outside") & (c("_depth") == 1)).cast("long"))
    x = prefix_scan(x, ["path"], at, c("block"), {"_ended": ("sum", "_ends")})
    x = x.withColumn("pos", c("_ended") - c("_ends"))
    g = x.groupBy("path", "pos").agg(F.sort_array(F.collect_list(F.struct(*at, "value"))).alias("_parts"), F.max("_ends").alias("_whole"))
    text = F.array_join(F.transform("_parts", lambda p: F.coalesce(p["value"], F.lit(""))), "}")
    return g.select("path", "pos", (c("_whole") == 1).alias("whole"), F.when(c("_whole") == 1, F.concat(text, F.lit("}"))).otherwise(text).alias("text"))


def read_in_pieces(spark: SparkSession, paths: list[str], root: str, table: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Files, messages and quarantine of ``paths``, as ``export.decode_files``
    gives them.  ``table`` is the prefix of two scratch folders on shared storage
    that the caller removes."""
    c = F.col
    pieces = records(spark, paths, table and f"{table}-records")
    lead = F.regexp_extract("text", r"^[^{]*", 0)
    fits = F.when(~c("whole"), F.when(c("pos") == 0, c("text").rlike(REST_ALONE)).otherwise(c("text").rlike(REST))) \
        .otherwise(F.when(c("pos") == 0, lead.rlike(FIRST_LEAD)).otherwise(lead.rlike(NEXT_LEAD)))
    body = F.when(c("whole"), F.concat(F.lit("["), F.substr("text", F.length(lead) + 1), F.lit("]")))
    parsed = (elements(pieces).withColumns({"_fits": fits, "_nulls": F.when(c("whole"), lead).otherwise(c("text")).contains("null"), "_body": body})
              .withColumn("_arr", strict_array("_body", MESSAGE_SCHEMA)))
    parsed = cut_lineage(parsed.select("path", "pos", "whole", "_nulls", F.element_at("_arr", 1).alias("m"),
                                       F.coalesce(c("_fits") & (~c("whole") | (F.size("_arr") == 1)), F.lit(False)).alias("_good")), table and f"{table}-elements")
    seen = parsed.groupBy("path").agg(
        F.count_if("whole").alias("n"), F.count_if(~c("whole")).alias("_rest"), F.bool_and("_good").alias("_good"),
        F.bool_or("_nulls").alias("_nulls"))
    order = F.struct("block", "nth", "value")
    shape = pieces.groupBy("path").agg(
        F.bool_and(F.is_valid_utf8(F.coalesce("value", F.lit("")))).alias("_utf8"), F.min(order)["value"].alias("_first"),
        F.max(order)["value"].alias("_last"), (F.sum(F.octet_length("value")) + F.count(F.lit(1)) - F.max("size")).alias("_over"))
    listed = spark.read.format("binaryFile").load([_literal(p) for p in paths]).select(c("_metadata.file_path").alias("path"))
    # _over: 1 if the last piece has no "}" behind it, 0 if it has, else bytes were left out (a byte order mark)
    array = (c("_over") == 1) & c("_first").rlike("^" + JSON_WS + "\\[") & c("_last").rlike("\\]" + JSON_WS + "$")
    reason = (F.when(~F.coalesce("_utf8", F.lit(True)), F.lit("not utf-8"))
               .when(~F.coalesce(array, F.lit(False)), F.lit("not a json array"))
               .when((c("_rest") != 1) | ~F.coalesce("_good", F.lit(False)), F.lit("invalid json"))
               .when(c("_nulls"), F.lit("non-object element")))
    verdict = _path_columns(listed.join(shape, "path", "left").join(seen, "path", "left"), root, "path").withColumn("reason", reason)
    verdict = verdict.select("path", "rel_path", "channel", "date", "depth", "reason", "n")
    files = verdict.select("path", "rel_path", "channel", "date", "depth", F.coalesce("reason", F.lit("ok")).alias("status"),
                           F.when(c("reason").isNull(), c("n")).otherwise(0).cast("int").alias("n_messages"))
    good = verdict.filter(c("reason").isNull()).select("path", "channel", "date", "depth")
    messages = message_rows(parsed.filter("whole").join(good, "path").select("channel", "date", "path", "depth", "pos", "m"))
    return files, messages, verdict.filter(c("reason").isNotNull()).select("path", "channel", "date", "reason")
