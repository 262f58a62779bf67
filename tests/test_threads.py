"""Threads by root, the line before in a long run, names by block maps."""

import random

from pyspark.sql import functions as F

from threadloom.operators import authors, inventory, threads
from threadloom.sources import tables

from .conftest import SF001
from .test_plans import _plan


def test_threads_and_orphans(spark):
    rows = [("c", "1", 1.0, None, "U1", "root"), ("c", "2", 2.0, "1", "U2", "first"), ("c", "2", 2.5, "1", "U3", "second"),
            ("c", "9", 9.0, "7", "U4", "lost"), ("d", "3", 3.0, "1", "U5", "other channel"), ("c", "5", 5.0, "", "U6", "alone"),
            (None, "1", 1.0, None, "U7", "no channel"), (None, "4", 4.0, "1", "U8", "reply there"), ("c", None, None, None, None, "nothing"),
            ("c", "1", 1.5, "1", "U9", "second root")]
    df = spark.createDataFrame(rows, "channel string, ts string, ts_num double, thread_ts string, user string, text string")
    got = threads.thread_messages(df, order=["text"], bucket_seconds=1.0)
    found = {r.text: (r.thread_id, r.is_root, r.orphan, r.root_user, r.thread_pos) for r in got.collect()}
    assert found == {
        "root": ("1", True, False, "U1", 1), "second root": ("1", True, False, "U1", 2), "first": ("1", False, False, "U1", 3),
        "second": ("1", False, False, "U1", 4), "lost": ("7", False, True, None, 1), "other channel": ("1", False, True, None, 1),
        "alone": ("5", True, False, "U6", 1), "no channel": ("1", True, False, "U7", 1), "reply there": ("1", False, False, "U7", 2),
        "nothing": (None, False, False, None, 1)}
    pairs = {(r.text, r.reply) for r in threads.next_in_thread(got).collect()}
    assert pairs == {("root", "second root"), ("second root", "first"), ("first", "second"), ("no channel", "reply there")}


def test_a_long_thread_is_cut(spark):
    """A thread holding a third of the rows: no window partition holds more than its time bucket."""
    n = 6000
    df = spark.range(n).select(F.lit("c").alias("channel"), F.col("id").cast("string").alias("ts"), F.col("id").cast("double").alias("ts_num"),
                               F.when(F.col("id") % 3 == 0, "0").alias("thread_ts"), F.lit("U").alias("user"), F.lit("t").alias("text"))
    got = threads.thread_messages(df, bucket_seconds=60.0)
    plan = _plan(got)
    assert plan.count("_pb") and all("_pb" in line for line in plan.split("\n") if "Window [" in line and "thread_pos" in line and "_c_" not in line)
    long = got.where("thread_id = '0'").select("ts", "thread_pos").collect()
    assert {int(r.ts): r.thread_pos for r in long} == {3 * k: k + 1 for k in range(n // 3)}


def test_line_before_in_one_long_run(spark, monkeypatch):
    monkeypatch.setattr(inventory, "LINE_BUCKET_BITS", 3)
    rng = random.Random(1)
    ms, lines = 0, []
    for i in range(300):
        ms += rng.randint(0, 900)
        text = inventory.RUN_START + " x" if i == 200 else "step"
        lines.append((i, f"2024-01-01 10:{ms // 60000:02d}:{ms // 1000 % 60:02d},{ms % 1000:03d} - INFO - {text}" if i % 7 else "noise"))
    got = inventory.parse_log(spark.createDataFrame(lines, "line_no long, value string").repartition(5)).collect()
    got.sort(key=lambda r: r.line_no)
    for a, b in zip([None, *got], got):
        want = None if a is None or a.run != b.run else (b.ts - a.ts).total_seconds()
        assert b.since_prev_s == want, b
    assert len({r.run for r in got}) <= 2 and len(got) > 200


def test_names_need_no_regroup(spark):
    m = tables.event_messages(spark, SF001).select("event_id", "text", "user")
    extra = spark.createDataFrame([(-1, None, "a"), (-2, "<@ no id", "b"), (-3, "<@U9|x> <@1><@1>", "c"), (-3, "<@2>", "c")], m.schema)
    df = m.union(extra)
    users = tables.customer_users(spark, SF001)
    small = sorted(map(tuple, authors.resolve_mentions(df, users, ["event_id"], out="o").collect()), key=repr)
    assert [r for r in small if r[0] == -2] == [(-2, "<@ no id", "b", "<@ no id")] and len([r for r in small if r[0] == -3]) == 2
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        out = authors.resolve_mentions(df, users, ["event_id"], out="o", blocks=5)
        assert sorted(map(tuple, out.collect()), key=repr) == small
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "first(" not in plan and not any("Aggregate" in line and "text" in line for line in plan.split("\n"))
        exchanges = [line for line in _plan(out).split("\n") if "Exchange hashpartitioning(_block" in line]
        assert len(exchanges) >= 1
    finally:
        for k in keys:
            spark.conf.unset(k)
