"""A bronze table without replaced files, kept up to date from the ingest's log.

The ingest stream only appends (``ingest.py``): a day that is exported anew lies
beside its former self.  ``refresh`` folds the log into a table of snapshots: the dates
whose files have changed are rewritten with one file for each channel and day
(S7), all other dates stay where they are, and a manifest names the folder of
every date.  The manifest becomes current by the rename of one pointer file, so
a reader sees the snapshot before or the one after, never a mixture, and
needs no rule at read time.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.plans.dataset import commit_version, current_version, drop_old_versions
from threadloom.sources.export import BRONZE_SCHEMA, losing_files
from threadloom.sources.paths import decoded_path

MANIFEST = "date string, folder string, files bigint, print decimal(38,0)"


def _manifest(spark: SparkSession, table: str) -> DataFrame:
    version = current_version(spark, table)
    if version is None:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{version}/manifest")


def log_prints(log: DataFrame) -> DataFrame:
    """(date, files, print) of the log: which files hold a date, from file
    metadata alone.  Files of the log are never changed, only added or compacted."""
    held = log.select("date", F.col("_metadata.file_path").alias("f")).distinct()
    return held.groupBy("date").agg(F.count(F.lit(1)).alias("files"), F.sum(F.xxhash64("f").cast("decimal(38,0)")).alias("print"))


def refresh(spark: SparkSession, bronze_path: str, table: str, keep_versions: int = 1) -> int:
    """Bring ``table`` up to the log; returns the number of dates rewritten.  A
    refresh that dies leaves the former snapshot current; the next one does its work."""
    log = spark.read.schema(BRONZE_SCHEMA).parquet(bronze_path)
    before = _manifest(spark, table)
    now = log_prints(log)
    same = now["date"].eqNullSafe(before["date"]) & (now["files"] == before["files"]) & (now["print"] == before["print"])
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    home, data = f"{table}/versions/{version}", f"{table}/data/version={version}"
    now.join(before, same, "left_anti").write.parquet(f"{home}/changed")
    changed = spark.read.schema(now.schema).parquet(f"{home}/changed")  # one row a date
    n = changed.count()
    if n:
        dates = changed.select(F.col("date").alias("_date"))
        touched = log.join(dates, log["date"].eqNullSafe(F.col("_date")), "left_semi")
        files = touched.select("channel", "date", "path", "depth").distinct().withColumn("status", F.lit("ok"))
        (touched.join(losing_files(files), "path", "left_anti").select(*log.columns)
         .repartition("date", F.pmod(F.xxhash64("channel", "path"), F.lit(8)))  # few files a date, no date in one task alone
         .sortWithinPartitions("date", "channel", "ts_num").write.partitionBy("date").parquet(data))
        folders = (spark.read.schema(BRONZE_SCHEMA).parquet(data)
                   .select("date", F.regexp_extract(decoded_path("_metadata.file_path"), f"(version={version}/.*)/[^/]*$", 1).alias("folder")).distinct())
        written = changed.join(folders, changed["date"].eqNullSafe(folders["date"])).select(changed["date"], "folder", "files", "print")
        kept = before.join(changed.select(F.col("date").alias("_date")), before["date"].eqNullSafe(F.col("_date")), "left_anti")
        kept.unionByName(written).write.parquet(f"{home}/manifest")
        commit_version(spark, table, version)
    else:
        path = spark._jvm.org.apache.hadoop.fs.Path(home)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    vacuum(spark, table, keep_versions)
    return n


def read_snapshot(spark: SparkSession, table: str) -> DataFrame:
    """The current snapshot in the bronze schema.  The manifest has one row a date."""
    folders = sorted(r.folder for r in _manifest(spark, table).select("folder").collect())
    if not folders:
        return spark.createDataFrame([], BRONZE_SCHEMA)
    columns = [f.name for f in spark.createDataFrame([], BRONZE_SCHEMA).schema]
    return (spark.read.schema(BRONZE_SCHEMA + ", version string").option("basePath", f"{table}/data").parquet(*[f"{table}/data/{f}" for f in folders])
            .select(*columns))


def vacuum(spark: SparkSession, table: str, keep_versions: int = 1) -> None:
    """Remove all manifests but the current one and ``keep_versions`` others, and
    the data that none of the manifests left names."""
    drop_old_versions(spark, table, keep_versions)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(table).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(Path(f"{table}/data")):
        return
    left = [st.getPath().getName() for st in fs.listStatus(Path(f"{table}/versions"))]
    named: set[str] = set()
    for v in left:
        if not fs.exists(Path(f"{table}/versions/{v}/manifest/_SUCCESS")):  # a refresh under way
            named.add(f"version={v}")
            continue
        rows = spark.read.schema(MANIFEST).parquet(f"{table}/versions/{v}/manifest").select("folder").collect()
        named |= {r.folder.split("/")[0] for r in rows}
    for st in fs.listStatus(Path(f"{table}/data")):
        if st.getPath().getName() not in named:
            fs.delete(st.getPath(), True)
