"""W5, A1, N1-N4, F12-F15, X1, O2, K1-K3, R1-R6 on small inputs."""

import math

from pyspark.sql import functions as F

from threadloom.functions.template import BOS, render_template, truncate_at_stop
from threadloom.functions.tokens import octet_proxy, word_proxy
from threadloom.operators import batching, conversations, examples, split, transcripts
from threadloom.sinks import dataset as sinks


TRAINING_PROMPT = "You are a helpful assistant."


def _convs(spark):
    rows = [("c1", 1, "a"), ("c1", 2, ""), ("c1", 3, "b"), ("c1", 4, "c"), ("c2", 1, "solo")]
    return spark.createDataFrame(rows, "conv_id string, conv_pos long, content string")


def test_roles_by_position_and_empty_drop(spark):
    long = {(r.conv_id, r.content): r.role for r in conversations.assign_roles(_convs(spark)).collect()}
    assert long == {("c1", "a"): "user", ("c1", "b"): "assistant", ("c1", "c"): "user", ("c2", "solo"): "user"}
    c = {r.conv_id: r for r in conversations.collect_conversations(_convs(spark), system_prompt="S").collect()}
    assert [(m.role, m.content) for m in c["c1"].messages] == [
        ("system", "S"), ("user", "a"), ("assistant", "b"), ("user", "c")]
    assert c["c1"].length == 4 and c["c2"].length == 2
    # one message + system prompt passes min 2; without prompt it does not
    assert examples.min_formatted(conversations.collect_conversations(_convs(spark), system_prompt="S")).count() == 2
    assert examples.min_formatted(conversations.collect_conversations(_convs(spark))).count() == 1


def test_render_literal_and_real_newlines(spark):
    conv = conversations.collect_conversations(_convs(spark), system_prompt="S").filter("conv_id = 'c2'")
    lit = conv.select(render_template(F.col("messages")).alias("t")).first().t
    assert lit == BOS + "System: S\\n\\nHuman: solo\\n"
    real = conv.select(render_template(F.col("messages"), newline="real").alias("t")).first().t
    assert real == BOS + "System: S\n\nHuman: solo\n"


def test_length_filter_and_errors(spark):
    conv = conversations.collect_conversations(_convs(spark), system_prompt=TRAINING_PROMPT)
    allx = examples.to_examples(conv, octet_proxy, max_length=60, keep_skipped=True)
    rows = {r.conv_id: r for r in allx.collect()}
    for r in rows.values():
        assert r.n_tokens == math.ceil(len(r.text.encode()) / 4)
        assert r.skipped == (r.n_tokens > 60)
    # a counter that fails (NULL) skips the row
    none = examples.to_examples(conv, lambda c: F.lit(None).cast("int"), keep_skipped=True)
    assert all(r.skipped for r in none.collect())
    df = spark.createDataFrame([("a bb  ccc\n d",)], "t string")
    assert df.select(word_proxy(F.col("t")).alias("n")).first().n == 4


def test_split_exact_sizes(spark):
    for n, test in ((0, 0), (1, 1), (10, 1), (11, 2), (100, 10), (1000, 100)):
        df = spark.range(n).withColumnRenamed("id", "conv_id")
        out = split.split_exact(df, "conv_id", seed=42)
        got = out.filter("split = 'test'").count()
        assert got == test, (n, got)
        if n:
            # the test rows are the smallest hashes
            rows = sorted(out.collect(), key=lambda r: r.split_hash)
            assert all(r.split == "test" for r in rows[:test]) and all(r.split == "train" for r in rows[test:])


def test_split_hash_and_sample(spark):
    df = spark.range(2000).withColumnRenamed("id", "conv_id")
    share = split.split_hash(df, "conv_id").filter("split = 'test'").count() / 2000
    assert 0.07 < share < 0.13
    ex = split.split_exact(df, "conv_id")
    s = split.sample(ex, 5).collect()
    assert len(s) == 5 and all(r.split == "train" for r in s)
    card = sinks.dataset_card(ex).first()
    assert (card.train_samples, card.eval_samples) == (1800, 200)


def test_sample_log_layout(spark):
    rows = [(f"c{i}", f"text {i}", "train" if i else "test", f"{i:02d}") for i in range(8)]
    ex = spark.createDataFrame(rows, "conv_id string, text string, split string, split_hash string")
    body = sinks.sample_log_text(ex).first().value
    assert body.startswith("Dataset Sample:\n\nExample 1:\ntext 1\n" + "-" * 80 + "\n")
    assert body.count("Example ") == 5 and "text 0" not in body


def test_stop_markers(spark):
    df = spark.createDataFrame([(1, " Sure. Human: next"), (2, "no marker "), (3, "a assistant: b Human: c")],
                               "i int, t string")
    got = [r.o for r in df.select(truncate_at_stop(F.col("t")).alias("o")).orderBy("i").collect()]
    assert got == ["Sure. Human:", "no marker", "a assistant:"]


def test_reset_segments_and_context(spark):
    rows = [("s", 0, "user", "hi"), ("s", 1, "assistant", "yo"), ("s", 2, "user", " NEW "),
            ("s", 3, "user", "again"), ("s", 4, "user", "info"), ("s", 5, "assistant", "x"),
            ("s", 6, "user", "exit"), ("s", 7, "user", "after")]
    t = spark.createDataFrame(rows, "session_id string, turn long, role string, text string")
    seg = transcripts.reset_segments(t)
    assert sorted((r.turn, r.segment) for r in seg.collect()) == [(0, 0), (1, 0), (3, 1), (5, 1)]
    ctx = {r.turn: r for r in transcripts.turn_context(seg, system_prompt="P").collect()}
    assert set(ctx) == {0, 3}
    sys_part = len(BOS) + len("System: P\\n\\n")
    assert ctx[0].n_context == 2 and ctx[0].context_chars == sys_part + len("Human: hi\\n")
    assert ctx[3].n_context == 2 and ctx[3].context_chars == sys_part + len("Human: again\\n")


def test_batches_and_fixed_length(spark):
    df = spark.createDataFrame([(f"c{i}", i % 17) for i in range(450)], "conv_id string, n_tokens long")
    b = batching.length_batches(df, batch_size=4).collect()
    per = {}
    for r in b:
        per.setdefault((r.megabatch, r.batch), []).append(r.n_tokens)
    assert max(len(v) for v in per.values()) == 4
    assert len({r.megabatch for r in b}) == 3
    t = spark.createDataFrame([([1, 2, 3, 9],), ([5, 6, 7, 8, 9, 1],)], "tokens array<int>")
    out = batching.fixed_length(t, length=5, pad=9).collect()
    assert [list(r.input_ids) for r in out] == [[1, 2, 3, 9, 9], [6, 7, 8, 9, 1]]
    assert [list(r.attention_mask) for r in out] == [[1, 1, 1, 0, 0], [1, 1, 1, 0, 1]]


def test_custom_role_table(spark):
    conv = conversations.collect_conversations(_convs(spark), system_prompt="S").filter("conv_id = 'c1'")
    fmt = {"system": ("<s>", "</s>"), "user": ("[U]", "|"), "assistant": ("[A]", "|")}
    t = conv.select(render_template(F.col("messages"), bos="", role_format=fmt).alias("t")).first().t
    assert t == "<s>S</s>[U]a|[A]b|[U]c|"
