"""K1-K3, A3: writing the dataset, its sample log, its card and counters.

Writes are distributed (``partitionBy('split')``); the sample log is a top-k
of five rows (``limit`` is the feature there) and the card is a one-row
aggregate.  Nothing is collected to the driver except those fixed-size rows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (sample-log layout)
# ---------------------------------------------------------------------------
SAMPLE_HEADER = "Dataset Sample:\n\n"
SAMPLE_RULE = "-" * 80
SAMPLE_SIZE = 5
# ---------------------------------------------------------------------------


def dataset_card(examples: DataFrame, split: str = "split") -> DataFrame:
    """K3: one row ``train_samples``, ``eval_samples`` (BIGINT)."""
    return examples.agg(
        F.count_if(F.col(split) == "train").cast("long").alias("train_samples"),
        F.count_if(F.col(split) == "test").cast("long").alias("eval_samples"))


def stage_counters(messages: DataFrame, flagged: DataFrame, examples: DataFrame) -> DataFrame:
    """A3 as a table ``(stage, n)``: messages found, conversations grouped,
    conversations formatted, examples skipped (length/error), train, test.
    ``flagged`` is ``examples.flag_examples`` output (one row per grouped
    conversation); ``examples`` carries ``split``."""
    found = messages.agg(F.count(F.lit(1)).cast("long").alias("messages_found"))
    conv = flagged.agg(F.count(F.lit(1)).cast("long").alias("conversations_grouped"),
                       F.count_if("formatted").cast("long").alias("conversations_formatted"),
                       F.count_if("skipped").cast("long").alias("examples_skipped"))
    spl = examples.agg(F.count_if(F.col("split") == "train").cast("long").alias("train"),
                       F.count_if(F.col("split") == "test").cast("long").alias("test"))
    def rows(agg: DataFrame) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("stage"), F.col(c).alias("n")) for c in agg.columns]
        return agg.select(F.explode(F.array(*pairs)).alias("r")).select("r.stage", "r.n")
    return rows(found).unionByName(rows(conv)).unionByName(rows(spl))


def sample_log_text(examples: DataFrame, n: int = SAMPLE_SIZE, order: str = "split_hash") -> DataFrame:
    """K2 body as one row: header, then ``Example i:``/text/rule for the first
    ``n`` train rows in dataset order."""
    top = examples.filter(F.col("split") == "train").orderBy(order).limit(n)
    from pyspark.sql import Window
    numbered = top.withColumn("_i", F.row_number().over(Window.orderBy(order)))
    block = F.concat(F.lit("Example "), F.col("_i").cast("string"), F.lit(":\n"), F.col("text"), F.lit("\n"),
                     F.lit(SAMPLE_RULE), F.lit("\n"))
    body = numbered.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_i", block.alias("b")))),
                                                 lambda s: s["b"]), "").alias("b"))
    return body.select(F.concat(F.lit(SAMPLE_HEADER), F.coalesce(F.col("b"), F.lit(""))).alias("value"))


def write_sample_log(examples: DataFrame, path: str) -> None:
    """K2: the sample log as a single text file (five rows at most)."""
    body = sample_log_text(examples)
    # the text writer ends the (single) row with a newline: drop the body's last one
    body = body.select(F.expr("substr(value, 1, length(value) - 1)").alias("value"))
    body.coalesce(1).write.mode("overwrite").text(path)


def write_card(examples: DataFrame, path: str) -> dict:
    """K3: dataset card JSON (one aggregate row)."""
    row = dataset_card(examples).first()
    card = {"train_samples": int(row["train_samples"]), "eval_samples": int(row["eval_samples"])}
    examples.sparkSession.createDataFrame([(json.dumps(card),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)
    return card
