"""Incremental export ingest with Structured Streaming.

New day files dropped under an export root are picked up by the file stream
source (``wholetext``: one row per file), decoded with the same expressions as
the batch reader (S3-S6) and appended to the bronze table and the quarantine
table by the parquet file sink, which is exactly-once through its own commit
log as long as a restart finds the same state folder: ``state_path`` is the
caller's, belongs to the two output tables and has no default.  Two queries
share the source definition: one for messages, one for quarantined files.
Channel folders with hidden names (``_``, ``.``) are read; hidden names inside
a channel are seen by the batch reader (``read_export``) only.

S7 (a later file for the same channel and day replaces the earlier one) is
applied when the bronze table is read: ``read_bronze(..., latest_file_only=True)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threadloom.sources.export import _eligible, _path_columns, decode_files
from threadloom.sources.paths import qualified_root


def export_file_stream(spark: SparkSession, root: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming rows ``(path, rel_path, channel, date, depth, value)``."""
    # every channel folder is a root of its own, hidden names included; re-globbed at each trigger
    raw = (spark.readStream.format("text").option("wholetext", True)
           .option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
           .option("maxFilesPerTrigger", max_files_per_trigger)
           .load(f"{root.rstrip('/')}/*")
           .select(F.col("_metadata.file_path").alias("path"), "value"))
    return _eligible(_path_columns(raw, qualified_root(spark, root), "path")).drop("file_name")


def start_ingest(spark: SparkSession, root: str, bronze_path: str, quarantine_path: str,
                 state_path: str, name: str = "export", available_now: bool = True,
                 processing_time: str | None = None) -> list[StreamingQuery]:
    """Start the two ingest queries; ``available_now`` processes what is there
    and stops, otherwise ``processing_time`` (e.g. ``"1 minute"``) polls."""
    ck = state_path.rstrip("/")
    _, messages, quarantine = decode_files(export_file_stream(spark, root))
    out = []
    for df, path, tag, part in ((messages, bronze_path, "messages", "date"),
                                (quarantine, quarantine_path, "quarantine", None)):
        w = df.writeStream.format("parquet").option("path", path) \
            .option("checkpointLocation", f"{ck}/ingest-{name}-{tag}").outputMode("append")
        if part:
            w = w.partitionBy(part)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
        out.append(w.queryName(f"ingest_{name}_{tag}").start())
    return out
