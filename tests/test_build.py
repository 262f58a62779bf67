"""End-to-end build on the golden export, counters conservation, sinks."""

import json
import os

import pytest

from threadloom.plans import dataset
from threadloom.plans.dataset import Options, build_dataset


def test_build_dataset(spark, mini_export, tmp_path):
    res = build_dataset(spark, mini_export, str(tmp_path / "out"), Options(window=100.0, system_prompt="Be brief."))
    c = res.counters
    assert c["messages_found"] >= c["bad_ts"] > 0
    assert c["conversations_formatted"] - c["examples_skipped"] == c["train"] + c["test"]
    assert c["test"] == -(-(c["train"] + c["test"]) // 10)
    ex = spark.read.parquet(res.paths["dataset"] + "/parquet")
    assert ex.count() == c["train"] + c["test"]
    for r in ex.collect():
        assert r.text.startswith("<|begin_of_text|>System: ")
        assert r.length == len(r.messages) and r.messages[0].role == "system"
        assert [m.role for m in r.messages[1:]] == ["user", "assistant"] * (len(r.messages[1:]) // 2) + \
            (["user"] if len(r.messages[1:]) % 2 else [])
    sample = "".join(open(os.path.join(res.paths["sample"], f)).read()
                     for f in sorted(os.listdir(res.paths["sample"])) if f.startswith("part-"))
    assert sample.startswith("Dataset Sample:\n\n")
    card = [json.loads(line) for f in os.listdir(res.paths["card"]) if f.startswith("part-")
            for line in open(os.path.join(res.paths["card"], f))]
    assert card == [{"train_samples": c["train"], "eval_samples": c["test"]}]
    jl = spark.read.json(res.paths["dataset"] + "/jsonl")
    assert jl.count() == ex.count()


def test_build_channel_scope(spark, mini_export, tmp_path):
    res = build_dataset(spark, mini_export, str(tmp_path / "out"), Options(window=1e9, scope="channel", system_prompt="Be brief."))
    # unbounded gap: each channel is one conversation; only "general" has >= 2
    # valid messages with a parseable ts (4 of them, + the system message)
    assert res.counters["conversations_grouped"] == 1
    ex = spark.read.parquet(res.paths["dataset"] + "/parquet").collect()
    assert [r.length for r in ex] == [5]
    assert ex[0].conv_id.startswith("general:")


def test_guards(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        build_dataset(spark, str(tmp_path / "missing"), str(tmp_path / "out"))
    empty = tmp_path / "empty"
    (empty / "general").mkdir(parents=True)
    (empty / "users.json").write_text("[]")
    (empty / "channels.json").write_text("[]")
    (empty / "general" / "2024-01-01.json").write_text("[]")
    with pytest.raises(ValueError, match="no messages"):
        build_dataset(spark, str(empty), str(tmp_path / "out2"))


def test_failed_build_keeps_the_former_output(spark, mini_export, tmp_path):
    out = str(tmp_path / "out")
    first = build_dataset(spark, mini_export, out, Options(window=100.0))
    assert first.failed_files == 5 and sum(r["n_files"] for r in first.file_report) >= 6
    assert spark.read.parquet(first.paths["quarantine"]).count() == 5
    n = spark.read.parquet(first.paths["dataset"] + "/parquet").count()
    bots = tmp_path / "bots"
    (bots / "general").mkdir(parents=True)
    (bots / "users.json").write_text("[]")
    (bots / "channels.json").write_text("[]")
    (bots / "general" / "2024-01-01.json").write_text('[{"text": "x", "ts": "1.0", "bot_id": "B"}]')
    with pytest.raises(ValueError, match="no messages"):
        build_dataset(spark, str(bots), out)
    assert spark.read.parquet(first.paths["dataset"] + "/parquet").count() == n
    assert len(os.listdir(f"{out}/versions")) == 1 and dataset.table_paths(spark, out) == first.paths


@pytest.mark.parametrize("step", ["write_bronze", "write_card", "write_sample_log", "pointer", "rename", "after"])
def test_a_build_that_dies_leaves_one_whole_version(spark, mini_export, tmp_path, monkeypatch, step):
    """Between any two steps a reader finds all tables of one version."""
    out = str(tmp_path / "out")
    first = build_dataset(spark, mini_export, out, Options(window=100.0))

    def whole():
        paths = dataset.table_paths(spark, out)
        assert len({p.rsplit("/", 1)[0] for p in paths.values()}) == 1
        rows = {n: spark.read.parquet(p + ("/parquet" if n == "dataset" else "")).count() for n, p in paths.items()
                if n in ("bronze", "quarantine", "dataset")}
        assert rows["bronze"] and rows["dataset"] and os.listdir(paths["card"]) and os.listdir(paths["sample"])
        return paths

    def die(*a, **k):
        raise KeyboardInterrupt(step)

    if step in ("write_card", "write_sample_log"):
        monkeypatch.setattr(dataset.sinks, step, die)
    elif step == "write_bronze":
        monkeypatch.setattr(dataset.src, step, die)
    elif step == "after":
        monkeypatch.setattr(dataset, "drop_old_versions", die)
    elif step == "pointer":  # dies with the new pointer file written but not renamed
        def half(spark, out_dir, version):
            with open(f"{out_dir}/_CURRENT-{version}", "w") as f:
                f.write(version)
            die()

        monkeypatch.setattr(dataset, "commit_version", half)
    else:
        monkeypatch.setattr(dataset, "commit_version", die)
    with pytest.raises(KeyboardInterrupt):
        build_dataset(spark, mini_export, out, Options(window=100.0, system_prompt="New."))
    assert (whole() == first.paths) == (step != "after")
    monkeypatch.undo()
    last = build_dataset(spark, mini_export, out, Options(window=100.0, system_prompt="Newer.", keep_versions=0))
    assert whole() == last.paths and os.listdir(f"{out}/versions") == [last.paths["bronze"].split("/")[-2]]


def test_no_version_yet(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        dataset.table_paths(spark, str(tmp_path))
