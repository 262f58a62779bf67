"""O1, R3 within a budget and R5 whole examples against plain recomputation."""

import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators import batching, order, transcripts
from threadloom.session import cut_lineage

from .test_plans import _plan


def test_global_order_cuts_one_timestamp(spark):
    rows = [(float(i % 3 == 0), f"c{i % 2}", i % 700, i) for i in range(3000)] + [(None, "c0", 1, 5000), (0.0, "c0", 1, 5001)]
    df = spark.createDataFrame(rows, "ts_num double, channel string, pos long, id long").repartition(7)
    got = order.order_messages(df, order=("channel", "pos", "id"), ranges=9)
    want = sorted(rows, key=lambda r: (r[0] or 0.0, r[1], r[2], r[3]))
    assert {r.id: r.position for r in got.collect()} == {r[3]: k + 1 for k, r in enumerate(want)}
    sizes = [r["count"] for r in order.ordered_table(df, ["ts_num"], ranges=9).groupBy("_range").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 1500  # 2,000 rows share one timestamp
    assert "Window" not in _plan(got) and "SinglePartition" not in _plan(got)


def test_global_order_of_equal_and_no_rows(spark):
    same = spark.createDataFrame([(1.0, "a")] * 50, "ts_num double, position string")
    assert sorted(r.p for r in order.global_order(same, ["ts_num"], out="p").collect()) == list(range(1, 51))
    assert order.global_order(same.where("false"), ["ts_num"], out="p").count() == 0


@pytest.mark.parametrize("bucket", [1 << 18, 16])
def test_context_window_equals_a_search_per_turn(spark, monkeypatch, bucket):
    monkeypatch.setattr(transcripts, "TOKEN_BUCKET", bucket)
    monkeypatch.setattr(transcripts, "TURN_BUCKET", 8)
    rng = random.Random(3)
    rows = [(s, t, 0, rng.choice(["user", "assistant", "other"]), "x" * rng.choice([0, 1, 7, 40, 90, 400])) for s in "ab" for t in range(90)]
    df = spark.createDataFrame(rows, "session_id string, turn int, segment long, role string, text string")

    def counter(text):
        return F.length(text)

    got = transcripts.context_window(df, [30, 100, 1000], counter, system_prompt="be kind")
    system = counter_len = len(transcripts.BOS + transcripts.render_message_text("system", "be kind"))
    want = []
    for s in "ab":
        own = [(t, role, len(transcripts.render_message_text(role, text))) for x, t, _, role, text in rows if x == s]
        for t, role, n in own:
            for b in (30, 100, 1000) if role == "user" else ():
                fits = [f for f in range(t + 1) if sum(x[2] for x in own[f:t + 1]) + system <= b]
                first = min(fits, default=t)
                cut = 0 if fits else min(n, n + system - b)
                total = sum(x[2] for x in own[first:t + 1]) + counter_len - cut
                want.append((s, 0, t, b, first, t - first + 2, total, cut))
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert any(w[-1] for w in want) and any(w[4] < w[2] for w in want)


def first_fit(items, limit):
    """(row, offset) of each of ``items`` in the given order."""
    free, out = [], []
    for n in items:
        row = next((k for k, f in enumerate(free) if f >= n), len(free))
        if row == len(free):
            free.append(limit)
        out.append((row, limit - free[row]))
        free[row] -= n
    return out


def test_plan_is_first_fit_decreasing():
    rng = random.Random(8)
    for _ in range(400):
        limit = rng.randint(1, 60)
        items = sorted((rng.choice([rng.randint(1, limit), 1, limit // 2 or 1]) for _ in range(rng.randint(0, 120))), reverse=True)
        plan = batching.first_fit_plan([(n, items.count(n)) for n in set(items)], limit)
        got = []
        for n in sorted(set(items), reverse=True):
            for rank in range(items.count(n)):
                (_, r0, _, row, each, used), = [p for p in plan if p[0] == n and p[1] <= rank < p[1] + p[2]]
                got.append((row + (rank - r0) // each, used + (rank - r0) % each * n))
        assert got == first_fit(items, limit)


def test_pack_whole(spark):
    rng = random.Random(2)
    lengths = [rng.choice([7, 7, 7, 30, 64, rng.randint(1, 64)]) for _ in range(600)] + [0, 0, 65, 900, None]
    df = cut_lineage(spark.createDataFrame(list(enumerate(lengths)), "conv_id long, n_tokens int"))
    got = {r.conv_id: r for r in batching.pack_whole(df, max_tokens=64).collect()}
    assert sorted(got) == list(range(len(lengths)))
    by_row = {}
    for k, n in enumerate(lengths):
        r = got[k]
        if n is None or n > 64:
            assert r.packed_row is None and r.row_offset is None
        elif n == 0:
            assert (r.packed_row, r.row_offset) == (0, 0)
        else:
            by_row.setdefault(r.packed_row, []).append((r.row_offset, n))
    for row in by_row.values():  # gapless, nothing cut, nothing over
        at = 0
        for offset, n in sorted(row):
            assert offset == at
            at += n
        assert at <= 64
    assert sorted(by_row) == list(range(len(by_row)))
    whole = [n for n in lengths if n and n <= 64]
    next_fit, free = 0, 0
    for n in whole:
        next_fit, free = (next_fit, free - n) if n <= free else (next_fit + 1, 64 - n)
    assert len(by_row) == 1 + max(r for r, _ in first_fit(sorted(whole, reverse=True), 64)) < next_fit
    assert batching.pack_whole(df.where("false"), max_tokens=64).count() == 0


@pytest.mark.parametrize("last_k", [1, 3, 6])
def test_last_messages_of_a_long_segment_are_cut_into_runs(spark, monkeypatch, last_k):
    """One session with nearly all messages, turns with holes, runs shorter than the context."""
    monkeypatch.setattr(transcripts, "TURN_BUCKET", 5)
    rng = random.Random(last_k)
    rows = [("long", t, 0, rng.choice(["user", "assistant"]), f" m{t} ") for t in range(0, 400, 3)]
    rows += [(s, t, g, rng.choice(["user", "assistant"]), None if t == 2 else f"{s}{t}") for s in ("a", None) for g in (0, 1)
             for t in range(4 * g, 4 * g + 4)]
    df = spark.createDataFrame(rows, "session_id string, turn int, segment int, role string, text string").repartition(4)
    got = transcripts.context_messages(df, last_k, system_prompt="be kind")
    assert got.columns == [*df.columns, "context"]
    want = []
    for s, t, g, role, text in rows:
        if role == "user":
            own = sorted((r for r in rows if r[0] == s and r[2] == g and r[1] <= t), key=lambda r: r[1])[-last_k:]
            want.append((s, t, [("system", "be kind")] + [(r[3], r[4] and r[4].strip()) for r in own]))
    found = [(r.session_id, r.turn, [tuple(m) for m in r.context]) for r in got.collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    windows = [line for line in _plan(got).splitlines() if "Window" in line and "collect_list" in line]
    assert windows and all("_run" in line for line in windows)
    assert transcripts.context_messages(df.where("false"), last_k).isEmpty()
    with pytest.raises(ValueError):
        transcripts.context_messages(df, 0)
