"""Session helpers: a configured local session for tests and benches, and the
checkpoint folder rule (read ``spark.checkpoint.dir`` from the session; only set
one when the session has none, as in tests)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8,
              app_name: str = "threadloom", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is (or the context already has it); unset, it is an error there.  On a
    local master (tests) a fresh temp folder is made.  The context's folder is
    set once.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="threadloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def cut_lineage(df: DataFrame, table: str | None = None) -> DataFrame:
    """``df`` written once as Parquet and read back, so that later passes read
    only the columns they need and a lost executor never goes back further.
    ``table`` is a folder on shared storage that the caller removes; the
    default is a new one below the checkpoint folder, which the result reads."""
    spark = df.sparkSession
    path = table or f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
