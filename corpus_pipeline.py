"""The corpus pipeline: quality selection, exact dedup, near dedup, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``docs``.  ``run`` writes each
stage's rows to the shared scratch folder and rereads them, so a lost executor
never goes back further than the stage before.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import exact_dedup, near_dup, packing, quality
from threadloom.llm.fragments import TokenizerFile
from threadloom.llm.store import Scratch


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows drawn by importance resampling; labels come from ``sf_dir``.
    Null, empty and blank texts have no n-grams and go; repeated rows are judged
    alike; an empty table gives no rows; the columns are those of ``docs``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.draw(docs, labels).where("kept").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text: the one with the largest doc_id.  Rows that repeat
    both doc_id and text count as one."""
    seen = (exact_dedup.exact_dedup(docs).groupBy("doc_id", "text_sha256")
            .agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")))
    gone = seen.where("NOT kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    out = docs.join(gone, docs["doc_id"].eqNullSafe(F.col("__id")) & (sha == F.col("__sha")), "left_anti")
    if not seen.where("kept AND n > 1").isEmpty():
        out = out.dropDuplicates(["doc_id", "text"])
    return out


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate component: of the smallest doc_id, and of
    several such rows the one whose text has the least SHA-256.  Rows are told
    apart by doc_id and text, never by doc_id alone, so an unrelated text of a
    repeated doc_id stays; of rows that repeat both one stays.  Null, empty and
    blank texts are near nothing and stay.  Rows without an id go if their
    shingle set is that of a row with an id, else they stay; an empty table gives no
    rows; the columns are those of ``docs``.
    """
    scratch = Scratch(spark, "pipeline-near")
    sha = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    found = scratch.keep(near_dup.near_duplicates(docs, mark=sha).select("doc_id", "mark", "class_id"), "found")
    # (written before the join, so that it is dealt out on its own and can split a large component)
    stays = scratch.keep(found.where("class_id IS NOT NULL AND doc_id IS NOT NULL")
                         .groupBy("class_id").agg(F.min(F.struct("doc_id", "mark")).alias("first")), "stays")
    gone = (found.join(stays, "class_id").where(~F.struct("doc_id", "mark").eqNullSafe(F.col("first")))
            .select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")).distinct())
    out = docs.join(gone, docs["doc_id"].eqNullSafe(F.col("__id")) & (sha == F.col("__mark")), "left_anti")
    if not found.groupBy("doc_id", "mark").count().where("count > 1").isEmpty():
        out = out.dropDuplicates(["doc_id", "text"])
    return out.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens, every row's text and its end token cut
    freely.  Null and empty texts are their end token alone; texts of any length
    and repeated rows are packed like any; an empty table gives no rows."""
    tokenizer = TokenizerFile.read(public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(docs, tokenizer)


STAGES = [("quality", keep_quality), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("packing", pack)]

#: A hashed n-gram model and tokenization are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"{i}-{name}")
    return docs
