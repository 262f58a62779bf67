"""T1-T8 on golden strings."""

import sys

from pyspark.sql import functions as F

from threadloom.functions import text as tx
from threadloom.operators import authors


def _one(spark, col_fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.o for r in df.select("i", col_fn(F.col("t")).alias("o")).orderBy("i").collect()]


def test_ws_class_is_python_isspace(spark):
    py = [chr(c) for c in range(1, sys.maxunicode + 1) if chr(c).isspace()]
    # Spark's reading of the fixed class agrees with str.isspace on every char below U+3100
    spark_ws = _one(spark, lambda c: c.rlike("^" + tx.WS_CLASS + "$"), [chr(c) for c in range(1, 0x3100)])
    assert [chr(c) for c, ok in zip(range(1, 0x3100), spark_ws) if ok] == [c for c in py if ord(c) < 0x3100]
    # the derived non-whitespace class is its exact complement
    chars = [chr(c) for c in range(0, 0x3100)] + ["\U0001F600", "\U0010FFFF"]
    non_ws = _one(spark, lambda c: c.rlike("^" + tx.NON_WS_CLASS + "$"), chars)
    assert non_ws == [not ch.isspace() for ch in chars]


def test_collapse_and_blank(spark):
    vals = ["```x\n  y```\tz　w", "  a b \x1c", "", "   "]
    assert _one(spark, tx.collapse_ws, vals) == [" ".join(v.split()) for v in vals]
    assert _one(spark, tx.is_nonblank, vals + [None]) == [bool(v.strip()) for v in vals] + [False]
    assert _one(spark, tx.strip_ws, vals) == [v.strip() for v in vals]


def test_channels_and_urls(spark):
    assert _one(spark, tx.replace_channel_refs, ["see <#C1|gen> and <#C2>"]) == ["see #gen and <#C2>"]
    got = _one(spark, tx.unwrap_urls, ["<http://a>", "<http://c|lab>", "<http://a>,<http://b>", "<mailto:x@y>",
                                        "<http://n x>"])
    assert got == ["http://a", "http://c|lab", "http://a>,<http://b", "<mailto:x@y>", "<http://n x>"]


def test_mentions(spark):
    users = spark.createDataFrame([("U1", "Ann $2 \\Lee", 0), ("U2", None, 1), ("U1", "Second", 2)],
                                  "id string, real_name string, ord long")
    msgs = spark.createDataFrame([(1, "hi <@U1> and <@U9>"), (2, "<@U1|ann> <@U1><@U2>"), (3, ""), (4, None)],
                                 "k long, text string")
    want = {1: "hi @Ann $2 \\Lee and @U9", 2: "<@U1|ann> @Ann $2 \\Lee@U2", 3: "", 4: ""}
    got = {r.k: r.content for r in authors.clean_messages(msgs, users, key=["k"]).collect()}
    assert got == want


def test_author_lookup(spark):
    users = spark.createDataFrame([("U1", "Ann", 0), ("U3", None, 1), ("U1", "Second", 2)],
                                  "id string, real_name string, ord long")
    msgs = spark.createDataFrame([(1, "U1"), (2, "U3"), (3, "U9"), (4, None), (5, "")], "k long, user string")
    got = {r.k: r.user_name for r in authors.resolve_author(msgs, users).collect()}
    assert got == {1: "Ann", 2: "U3", 3: "U9", 4: "Unknown User", 5: "Unknown User"}


def test_parse_ts_and_dates(spark):
    got = _one(spark, tx.parse_ts, ["1731801692.715000", "", "abc", "nan", "inf", "5d", " 12.5 ", "1e3", None])
    assert got == [1731801692.715, None, None, None, None, None, 12.5, 1000.0, None]
    df = spark.createDataFrame([(2024, 1, 5), (999, 12, 31)], "y int, m int, d int")
    assert [r.s for r in df.select(tx.date_string("y", "m", "d").alias("s")).collect()] == ["2024-01-05", "999-12-31"]


def test_cleaning_golden_table(spark):
    """SURVEY T1-T5: each kind of markup alone, side by side, nested and with every kind of white space."""
    users = spark.createDataFrame([("U1", "Ann $2 \\Lee", 0), ("U2", "Bo\tB", 1)], "id string, real_name string, ord long")
    table = [
        ("<@U1><@U2>", "@Ann $2 \\Lee@Bo B"), ("<@U9>", "@U9"), ("<@U1|x>", "<@U1|x>"), ("<@ U1>", "<@ U1>"),
        ("<#C1|gen>", "#gen"), ("<#C2>", "<#C2>"), ("<#C1|a b> c", "#a b c"), ("<#C1|<http://x>", "#<http://x"),
        ("<http://a>", "http://a"), ("<http://b|lab>,<http://c>", "http://b|lab>,<http://c"), ("<http://a b>", "<http://a b>"),
        ("<https://x>\u3000<http>", "https://x <http>"), ("<httpx>", "httpx"), ("<@U1> <#C1|g> <http://a>", "@Ann $2 \\Lee #g http://a"),
        (" a \t\n b\u00a0\u1680c\x1cd\u0085 ", "a b c d"), ("a\u200bb", "a\u200bb"), ("\u2028", ""), ("", ""), (None, ""),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(table)], "k long, text string")
    got = {r.k: r.content for r in authors.clean_messages(df, users, key=["k"]).collect()}
    assert got == {i: w for i, (_, w) in enumerate(table)}

