"""Scratch tables in the shared folder the cluster names in
``spark.checkpoint.dir``: lineage is cut by writing a parquet table there and
reading it back, so a lost executor costs a re-read, never a wrong row."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys of 64 bits that are broadcast at most (about 50 MB as a hash table).
BROADCAST_KEYS = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.  Unset: a temp folder on a
    local master (tests), an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="threadloom-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


class Scratch:
    """One run's folder of scratch tables.  Results of operators read it lazily; as
    a context manager, around the operator and the write of its result, it is
    removed at the end: ``with Scratch(spark, "near") as s: near_duplicates(docs,
    scratch=s).write.parquet(path)``."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/threadloom-{name}-{uuid.uuid4().hex}"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def keep(self, df: DataFrame, table: str, codec: str = "zstd", **options) -> DataFrame:
        df.write.options(compression=codec, **options).parquet(self.path(table))
        return self.spark.read.schema(df.schema).parquet(self.path(table))

    def _delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def drop(self, table: str) -> None:
        """Remove a table nothing lazy reads any more."""
        self._delete(self.path(table))

    def release(self) -> None:
        """Remove the run's folder, once its result is written."""
        self._delete(self.root)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure) -> None:
        self.release()


def only_wanted(rows: DataFrame, wanted: DataFrame, key: str, bound: int | None = None) -> DataFrame:
    """``rows`` without those whose 64-bit ``key`` is not in the written table
    ``wanted``, as a broadcast filter next to the scan, so that wide columns of
    the others are never shuffled.  Beyond ``bound`` distinct keys all rows pass:
    callers use it to move less, and settle the exact set themselves."""
    bound = BROADCAST_KEYS if bound is None else bound
    if wanted.count() > bound:
        return rows
    return rows.join(F.broadcast(wanted.select(key)), key, "left_semi")
