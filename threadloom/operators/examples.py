"""From formatted conversations to training examples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions.template import render_template
from threadloom.functions.tokens import TokenCounter, octet_proxy


def min_formatted(convs: DataFrame, min_size: int = 2) -> DataFrame:
    """at least ``min_size`` messages, the system message included."""
    return convs.filter(F.size("messages") >= F.lit(int(min_size)))


def render(convs: DataFrame, newline: str = "literal") -> DataFrame:
    """Rendered chat-template text in ``text``."""
    return convs.withColumn("text", render_template(F.col("messages"), newline))


def with_token_count(df: DataFrame, counter: TokenCounter = octet_proxy, text: str = "text") -> DataFrame:
    """``n_tokens`` of the rendered text (counter is pluggable)."""
    return df.withColumn("n_tokens", counter(F.col(text)).cast("int"))


def flag_examples(convs: DataFrame, counter: TokenCounter = octet_proxy, max_length: int = 2048,
                  min_size: int = 2, newline: str = "literal") -> DataFrame:
    """Every conversation with ``formatted`` (passes F13) and ``skipped``
    (formatted, but too long or without text/token count: F14/F15) - one
    table from which all stage counters can be read."""
    x = with_token_count(render(convs, newline), counter)
    formatted = F.size("messages") >= F.lit(int(min_size))
    ok = F.col("text").isNotNull() & F.col("n_tokens").isNotNull() & (F.col("n_tokens") <= F.lit(int(max_length)))
    return x.withColumns({"formatted": formatted, "skipped": formatted & ~ok})


def to_examples(convs: DataFrame, counter: TokenCounter = octet_proxy, max_length: int = 2048,
                min_size: int = 2, newline: str = "literal", keep_skipped: bool = False) -> DataFrame:
    """F13 -> N3 -> N4 -> F14/F15.

    Rows whose text or token count cannot be produced (NULL) are skipped like
    over-long ones (F15).  With ``keep_skipped`` all rows are returned with a
    ``skipped`` flag, so callers can count them in the same pass."""
    x = with_token_count(render(min_formatted(convs, min_size), newline), counter)
    ok = F.col("text").isNotNull() & F.col("n_tokens").isNotNull() & (F.col("n_tokens") <= F.lit(int(max_length)))
    if keep_skipped:
        return x.withColumn("skipped", ~ok)
    return x.filter(ok)
