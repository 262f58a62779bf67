"""The two-level sessionizer against a brute-force greedy loop."""

import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators.scan import prefix_scan
from threadloom.operators.sessionize import break_flags, sessionize, with_buckets


def brute_force(rows, window, min_n, max_n):
    """W1-W4 as defined: positions of gap and thread breaks, runs between them
    cut into chunks of the cap, chunks below the minimum size left out."""
    at = [0] + [i for i in range(1, len(rows))
                if rows[i][1] - rows[i - 1][1] >= window or rows[i][2] != rows[i - 1][2]] + [len(rows)]
    cap = max(1, max_n)
    chunks = [rows[k:min(k + cap, b)] for a, b in zip(at, at[1:]) for k in range(a, b, cap)]
    return [[r[0] for r in c] for c in chunks if len(c) >= min_n]


def _random_rows(rng, n, span=60.0):
    rows = []
    for i in range(n):
        ts = float(rng.randint(0, int(span))) if rng.random() < 0.3 else round(rng.uniform(0, span), 3)
        rows.append((i, ts, rng.choice([None, None, "a", "b"])))
    return rows


PARAMS = [(w, lo, hi) for w in (1.0, 5.0, 20.0) for lo, hi in ((0, 1), (2, 3), (1, 40), (4, 6), (2, 0))]


@pytest.mark.parametrize("window,min_n,max_n", PARAMS)
def test_matches_greedy_loop(spark, window, min_n, max_n):
    rng = random.Random(hash((window, min_n, max_n)) & 0xFFFF)
    data = []
    expect = set()
    for trial in range(12):
        rows = _random_rows(rng, rng.randint(0, 40))
        data += [(f"t{trial}", rid, ts, thr) for rid, ts, thr in rows]
        ordered = sorted(rows, key=lambda r: (r[1], r[0]))
        expect |= {(f"t{trial}", tuple(c)) for c in brute_force(ordered, window, min_n, max_n)}
    df = spark.createDataFrame(data, "trial string, id long, ts double, thr string")
    for bucket, rows in ((3.0, None), (1000.0, None), (1000.0, 7)):
        out = sessionize(df, keys=["trial"], ts="ts", order=["id"], thread="thr", window=window,
                         max_messages=max_n, min_messages=min_n, bucket_seconds=bucket, bucket_rows=rows)
        got = {}
        for r in out.select("trial", "conv_id", "conv_pos", "conv_size", "id").collect():
            got.setdefault((r.trial, r.conv_id), []).append((r.conv_pos, r.id, r.conv_size))
        convs = set()
        for (trial, _), items in got.items():
            items.sort()
            assert [p for p, _, _ in items] == list(range(1, len(items) + 1))
            assert all(s == len(items) for _, _, s in items)
            convs.add((trial, tuple(i for _, i, _ in items)))
        assert convs == expect, (bucket, window, min_n, max_n)


def test_global_scope_equals_single_key(spark):
    rng = random.Random(7)
    rows = _random_rows(rng, 300, span=400.0)
    df = spark.createDataFrame(rows, "id long, ts double, thr string")
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    expect = {tuple(c) for c in brute_force(ordered, 7.0, 2, 5)}
    out = sessionize(df, ts="ts", order=["id"], thread="thr", window=7.0, max_messages=5, min_messages=2,
                     bucket_seconds=10.0)
    got = {}
    for r in out.collect():
        got.setdefault(r.conv_id, []).append((r.conv_pos, r.id))
    assert {tuple(i for _, i in sorted(v)) for v in got.values()} == expect


def test_burst_bucket_is_split(spark):
    # 600 messages inside one hour of one channel: with bucket_rows=50 the hour is
    # cut into sub-buckets; the grouping equals the brute force
    rng = random.Random(5)
    rows = [(i, round(rng.uniform(0, 3000), 2), rng.choice([None, "a"])) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, ts double, thr string")
    b = with_buckets(df, [], ["ts", "id"], 3600.0, 50)
    sizes = [r["count"] for r in b.groupBy("_bk").count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 120
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    expect = {tuple(c) for c in brute_force(ordered, 3.0, 2, 4)}
    out = sessionize(df, ts="ts", order=["id"], thread="thr", window=3.0, max_messages=4, min_messages=2,
                     bucket_rows=50)
    got = {}
    for r in out.collect():
        got.setdefault(r.conv_id, []).append((r.conv_pos, r.id))
    assert {tuple(i for _, i in sorted(v)) for v in got.values()} == expect


@pytest.mark.parametrize("times", ["one second", "one timestamp"])
def test_crowded_second_is_split(spark, times):
    n, limit = 40_000, 2_000
    burst = F.col("id") < n * 99 // 100
    at = F.lit(50.0) if times == "one timestamp" else 50.0 + F.col("id") / n
    df = spark.range(n).select("id", F.when(burst, at).otherwise(F.col("id") * 1.0).alias("ts"),
                               F.lit(None).cast("string").alias("thr"))
    sizes = [r["count"] for r in with_buckets(df, [], ["ts", "id"], 3600.0, limit).groupBy("_bk").count().collect()]
    assert sum(sizes) == n and max(sizes) <= 2 * limit
    kw = dict(ts="ts", order=["id"], thread="thr", window=3.0, max_messages=7, min_messages=2)
    cut = sessionize(df, bucket_rows=limit, **kw).select("id", "conv_id", "conv_pos", "conv_size")
    whole = sessionize(df, bucket_rows=None, **kw).select("id", "conv_id", "conv_pos", "conv_size")
    assert cut.exceptAll(whole).isEmpty() and whole.exceptAll(cut).isEmpty()


def test_partition_count_invariance(spark):
    rng = random.Random(11)
    rows = _random_rows(rng, 200, span=300.0)
    df = spark.createDataFrame(rows, "id long, ts double, thr string")
    res = []
    for n in ("1", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out = sessionize(df.repartition(int(n)), ts="ts", order=["id"], thread="thr", window=9.0,
                         max_messages=4, min_messages=2, bucket_seconds=5.0)
        res.append(sorted((r.id, r.conv_id, r.conv_pos) for r in out.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert res[0] == res[1]


def test_break_flags(spark):
    # gaps of 7199.999999 and 7200.0: strict comparison (W1); threads A, none, A
    rows = [(1, 0.0, "A"), (2, 7199.999999, "A"), (3, 14399.999999, "A"), (4, 14400.0, None), (5, 14401.0, "A")]
    df = spark.createDataFrame(rows, "id long, ts double, thr string")
    out = {r.id: r for r in break_flags(df, ts="ts", order=["id"], thread="thr", window=7200.0).collect()}
    assert [out[i].gap_break for i in range(1, 6)] == [False, False, True, False, False]
    assert [out[i].thread_break for i in range(1, 6)] == [False, False, False, True, True]
    assert [out[i].is_break for i in range(1, 6)] == [True, False, True, True, True]


def test_conversation_ids_with_null_and_marked_keys(spark):
    pairs = [(None, "a"), ("a", None), ("a:1", "b"), ("a", "1:b"), ("\\N", "a"), ("", "a"), (None, None), ("a\\", ":b")]
    df = spark.createDataFrame([(*p, 1.0) for p in pairs], "k string, l string, ts double")
    for keys, n in ((["k", "l"], len(pairs)), (["k"], len({k for k, _ in pairs}))):
        out = sessionize(df, keys=keys, order=["l"], ts="ts", thread=None, max_messages=9, min_messages=1)
        assert out.select("conv_id").distinct().count() == n


def test_cap_81_messages(spark):
    rows = [(i, float(i), None) for i in range(81)]
    df = spark.createDataFrame(rows, "id long, ts double, thr string")
    out = sessionize(df, ts="ts", order=["id"], thread="thr", window=7200, max_messages=40, min_messages=2)
    sizes = sorted(r.conv_size for r in out.select("conv_id", "conv_size").distinct().collect())
    assert sizes == [40, 40]  # the 81st message alone is dropped


def test_prefix_scan(spark):
    rng = random.Random(3)
    rows = [(k, i, rng.randint(-5, 5)) for k in ("a", "b", None) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, i long, v long")
    out = prefix_scan(df, ["k"], ["i"], F.floor(F.col("i") / 7), {"s": ("sum", "v"), "mx": ("max", "v")})
    got = {(r.k, r.i): (r.s, r.mx) for r in out.collect()}
    for k in ("a", "b", None):
        s, mx = 0, None
        for _, i, v in [r for r in rows if r[0] == k]:
            s += v
            mx = v if mx is None else max(mx, v)
            assert got[(k, i)] == (s, mx)


def test_bisection_equals_a_count(spark):
    from pyspark.sql import functions as F

    from threadloom.operators.sessionize import at_or_before
    df = spark.range(45).crossJoin(spark.range(12).withColumnRenamed("id", "n"))
    cuts = F.transform(F.sequence(F.lit(0), F.col("n")), lambda i: F.struct((i * 3).alias("a"), F.lit(1).alias("b")))
    cuts = F.slice(cuts, 1, F.col("n").cast("int"))
    own = F.struct(F.col("id").alias("a"), F.lit(1).alias("b"))
    got = df.select(at_or_before(cuts, own).alias("x"), F.size(F.filter(cuts, lambda c: c <= own)).alias("y")).where("NOT x <=> y")
    assert got.count() == 0
