"""The stream's conversations equal the batch operator's over the whole table."""

import random

import pytest

from threadloom.operators.sessionize import sessionize
from threadloom.sources import tables
from threadloom.streaming.sessions import sessionize_stream, start_sessionize

from .conftest import SF001

ADDED = ["rn", "run_start", "chunk", "conv_pos", "conv_size", "conv_id"]
END = 4e9  # a message of its own channel that moves the watermark past all others


def write_in_order(df, path, parts, first=0):
    """One file a batch: the rows in order of time, but some come a batch late."""
    rows = df.collect()
    rng = random.Random(1)
    cut = [[] for _ in range(parts + 1)]
    for i, r in enumerate(sorted(rows, key=lambda r: r["ts_num"])):
        cut[i * parts // len(rows) + (rng.random() < 0.2)].append(r)
    for k, part in enumerate(cut):
        if part:
            (df.sparkSession.createDataFrame(part, df.schema).coalesce(1).write.mode("append").parquet(f"{path}/{first + k:03d}"))


def stream(spark, schema, path):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
            .option("latestFirst", False).parquet(path))


def end_of(df):
    row = {"channel": "~end", "ts_num": END}
    return df.sparkSession.createDataFrame([tuple(row.get(c) for c in df.columns)], df.schema)


def same(spark, got, want):
    columns = [c for c in want.columns if c in got.columns]
    assert set(ADDED) <= set(columns)
    key = lambda r: repr(tuple(r))
    a = sorted(got.where("channel IS NULL OR channel <> '~end'").select(*columns).collect(), key=key)
    assert a == sorted(want.select(*columns).collect(), key=key) and a


def test_replayed_events_and_restart(spark, tmp_path):
    m = tables.event_messages(spark, SF001).select("event_id", "ts_num", "channel", "thread_ts", "user")
    span = m.selectExpr("max(ts_num) - min(ts_num) AS s").first().s
    how = dict(keys=["channel"], order=["event_id"], window=7200.0, max_messages=5, min_messages=2,
               delay=f"{int(span)} seconds")
    want = sessionize(m, keys=["channel"], order=["event_id"], window=7200.0, max_messages=5, min_messages=2)
    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    rows = sorted(m.collect(), key=lambda r: r["ts_num"])
    half = spark.createDataFrame(rows[:400], m.schema)
    rest = spark.createDataFrame(rows[400:], m.schema)
    write_in_order(half, src, 3)
    start_sessionize(stream(spark, m.schema, src), out, state, **how).awaitTermination()
    before = spark.read.parquet(out).count() if list((tmp_path / "out").glob("*.parquet")) else 0
    write_in_order(rest, src, 3, first=10)
    end_of(m).coalesce(1).write.parquet(f"{src}/999")
    start_sessionize(stream(spark, m.schema, src), out, state, **how).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() > before
    same(spark, got, want)


def test_small_delay_emits_early(spark, tmp_path):
    """In order of arrival a delay of a second is enough; conversations come out before the stream's end."""
    rng = random.Random(4)
    rows, ts = [], 1_000_000.0
    for i in range(300):
        ts += rng.choice([0.0, 0.25, 10.0, 59.75, 60.0, 400.0])
        rows.append((i, ts, rng.choice(["a", "b:\\c", None]), rng.choice(["t", "t", "u", None])))
    schema = "event_id long, ts_num double, channel string, thread_ts string"
    df = spark.createDataFrame(rows, schema)
    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for k in range(3):
        spark.createDataFrame(rows[k * 100:(k + 1) * 100], schema).coalesce(1).write.parquet(f"{src}/{k}")
    how = dict(keys=["channel"], order=["event_id"], window=60.0, max_messages=3, min_messages=2, delay="1 second")
    start_sessionize(stream(spark, df.schema, src), out, state, **how).awaitTermination()
    assert spark.read.parquet(out).count() > 0
    end_of(df).coalesce(1).write.parquet(f"{src}/9")
    start_sessionize(stream(spark, df.schema, src), out, state, **how).awaitTermination()
    same(spark, spark.read.parquet(out), sessionize(df, keys=["channel"], order=["event_id"], window=60.0, max_messages=3, min_messages=2))


def test_scope_is_required(spark):
    with pytest.raises(ValueError):
        sessionize_stream(spark.readStream.format("rate").load(), keys=[])
