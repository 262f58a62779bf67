"""R7 (artifact inventory of an output folder) and R8 (run-log table).

R7 reads only file metadata, so the size of a multi-GB model folder is summed
without reading it.  R8
parses ``time - LEVEL - message`` lines and measures stage durations from
the line before in each run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.text import epoch_micros
from threadloom.operators.scan import prefix_scan

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
# shard files the reference counts (it saves safetensors, so it counts none)
SHARD_PATTERN = r"^pytorch_model.*\.bin$"
LOG_LINE_RE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}),(\d{3}) - ([A-Z]+) - (.*)$"
RUN_START = "Starting training pipeline:"
GIB = 1024 ** 3
# ---------------------------------------------------------------------------

#: A window partition holds the lines of a run whose numbers agree but for these bits.
LINE_BUCKET_BITS = 20


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def artifact_inventory(spark: SparkSession, path: str, shard_pattern: str = SHARD_PATTERN) -> DataFrame:
    """One row: ``size_gb`` and ``n_files`` (all files, recursive, names starting
    with ``_`` or ``.`` too), ``num_shards`` (top-level files matching
    ``shard_pattern``).  From file metadata alone; the names of the top level
    are all that is listed by name."""
    p, fs = _folder(spark, path)
    whole = fs.getContentSummary(p)
    names = [(f.getPath().getName(),) for f in fs.listStatus(p) if f.isFile()]
    shards = spark.createDataFrame(names, "name string").agg(
        F.count_if(F.col("name").rlike(shard_pattern)).alias("num_shards"))
    return shards.select(F.lit(whole.getLength() / GIB).alias("size_gb"),
                         F.lit(whole.getFileCount()).cast("long").alias("n_files"), F.col("num_shards").cast("long"))


def model_info(spark: SparkSession, path: str, shard_pattern: str = SHARD_PATTERN) -> DataFrame:
    """R7 whole: the inventory with ``model_card`` and ``training_config`` as the
    text of ``model_card.json`` and ``training_config.json``, null where the
    folder has no such file."""
    info = artifact_inventory(spark, path, shard_pattern)
    for name in ("model_card", "training_config"):
        doc, fs = _folder(spark, f"{path}/{name}.json")
        text = F.lit(None).cast("string")
        if fs.exists(doc):
            text = spark.read.text(f"{path}/{name}.json", wholetext=True).scalar()
        info = info.withColumn(name, text)
    return info


def read_json_doc(spark: SparkSession, path: str) -> DataFrame:
    """A card/config JSON file as a one-row DataFrame (schema inferred)."""
    return spark.read.option("multiLine", True).json(path)


def run_log(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, ts, level, message, run, since_prev_s`` for each parsed
    line.  ``run`` counts ``Starting training pipeline:`` lines; the duration
    is the time since the previous line of the same run."""
    return parse_log(spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), "value"))


def parse_log(raw: DataFrame) -> DataFrame:
    """:func:`run_log` over lines ``line_no, value`` from anywhere."""
    ts = F.to_timestamp_ntz(F.concat(F.regexp_extract("value", LOG_LINE_RE, 1), F.lit("."),
                                     F.regexp_extract("value", LOG_LINE_RE, 2)), F.lit("yyyy-MM-dd HH:mm:ss.SSS"))
    x = (raw.filter(F.col("value").rlike(LOG_LINE_RE))
            .select("line_no", ts.alias("ts"), F.regexp_extract("value", LOG_LINE_RE, 3).alias("level"),
                    F.regexp_extract("value", LOG_LINE_RE, 4).alias("message")))
    # running count of run starts, bucketed by input split (upper bits of the id)
    x = x.withColumn("_start", F.when(F.col("message") == RUN_START, 1).otherwise(0))
    x = prefix_scan(x, [], ["line_no"], F.shiftright(F.col("line_no"), 33), {"run": ("sum", "_start")})
    x = x.withColumn("run", F.col("run").cast("long")).drop("_start").withColumn("_us", epoch_micros("ts"))
    # the line before in the same run, whatever the run's length: carried over the buckets too
    x = prefix_scan(x, ["run"], ["line_no"], F.shiftright(F.col("line_no"), LINE_BUCKET_BITS), {"_before": ("prev", "_us")})
    return x.withColumn("since_prev_s", (F.col("_us") - F.col("_before")) / F.lit(1e6)).drop("_us", "_before")


def stage_durations(log: DataFrame) -> DataFrame:
    """Per run: total seconds from the first to the last line, and lines."""
    us = epoch_micros("ts")
    return log.groupBy("run").agg(
        ((F.max(us) - F.min(us)) / F.lit(1e6)).alias("seconds"),
        F.count(F.lit(1)).cast("long").alias("n_lines"))
