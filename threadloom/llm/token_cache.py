"""Token counts through a digest cache: texts meet stored counts by
(content digest, tokenizer version); only distinct misses are encoded, and
their counts are appended to the cache."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import fragments, textbuf
from threadloom.llm.fragments import TokenizerFile
from threadloom.llm.store import Scratch, only_wanted

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"
_ASCII_SPACE = " \t\n\u000b\f\r"


def normalised(text: str | F.Column):
    """White space at either end is dropped by the tokenizer, so it is not part
    of the content a digest stands for; null is the empty text."""
    return F.trim(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(_ASCII_SPACE))


def _counter(json_text) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = fragments.encoder(json_text.value)
        for batch in batches:
            for part, text in textbuf.slices(batch, "text"):
                _, off = fragments.word_ids(enc, text)
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index("digest")), pa.array(np.diff(off))],
                    ["digest", "n_tokens"])
    return run


def _read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    return (spark.read.schema(CACHE_SCHEMA).parquet(path)
            .where(F.col("tokenizer") == version)
            .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def misses(docs: DataFrame, missing: DataFrame | None, text: str = "text", bound: int | None = None) -> DataFrame:
    """(digest, text) of each distinct content of ``docs``, or of those whose
    digest is in ``missing`` alone.  Texts of other contents stay at the scan as
    long as the missing digests may be broadcast (``only_wanted``); what is left meets
    in an aggregate with map-side combine, so a content holding most rows is one
    row per map task."""
    content = docs.select(normalised(text).alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    if missing is not None:
        keys = missing.select(F.xxhash64("digest").alias("key")).distinct()
        content = only_wanted(content.withColumn("key", F.xxhash64("digest")), keys, "key", bound)
    found = content.groupBy("digest").agg(F.first("text").alias("text"))
    return found if missing is None else found.join(missing, "digest", "left_semi")


def fill_cache(docs: DataFrame, cache_path: str, tokenizer: TokenizerFile, text: str = "text",
               bound: int | None = None) -> None:
    """Encode the distinct contents of ``docs`` that the cache does not hold and
    append their counts.  Digests alone are looked up first; without misses no
    text is read again and nothing is appended."""
    spark = docs.sparkSession
    missing = None
    if exists(spark, cache_path):
        digests = docs.select(F.unhex(F.sha2(normalised(text), 256)).alias("digest")).distinct()
        known = _read_cache(spark, cache_path, tokenizer.version)
        missing = Scratch(spark, "token-misses").keep(digests.join(known, "digest", "left_anti"), "missing")
        if missing.isEmpty():
            return
    shared = spark.sparkContext.broadcast(tokenizer.text)  # one file, fixed size
    (misses(docs, missing, text, bound).select("digest", "text")
     .mapInArrow(_counter(shared), "digest binary, n_tokens long")
     .select("digest", F.lit(tokenizer.version).alias("tokenizer"), "n_tokens")
     .write.mode("append").parquet(cache_path))


def count_tokens(docs: DataFrame, cache_path: str, tokenizer: TokenizerFile,
                 text: str = "text", limit: int = 2048) -> DataFrame:
    """``docs`` plus n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    For tokenizers that drop white space and lower-case (see
    ``fragments.word_ids``).  Null text counts as empty: 0 bytes, 0 tokens.
    Repeated rows each keep their row; an empty table gives no rows.  Columns
    of ``docs`` named like the added ones are replaced.  The cache is a parquet
    table on shared storage; appends are committed by Spark, so a failed or
    repeated run leaves at worst repeated equal rows, which are read as one.
    """
    spark = docs.sparkSession
    fill_cache(docs, cache_path, tokenizer, text)
    key = "__digest"
    # written, so that the join below is dealt out on its own and can split a hot content
    cache = Scratch(spark, "token-counts").keep(
        _read_cache(spark, cache_path, tokenizer.version).select(
            F.col("digest").alias(key), F.col("n_tokens").alias("__n")), "counts")
    out = (docs.drop("n_bytes", "n_tokens", "over_limit")
           .withColumn(key, F.unhex(F.sha2(normalised(text), 256)))
           .withColumn("n_bytes", F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long")))
    keep = [c for c in out.columns if c != key]
    return (out.join(cache, key, "left")
            .select(*keep, F.col("__n").alias("n_tokens"), (F.col("__n") > limit).alias("over_limit")))
