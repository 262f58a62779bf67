"""Snapshots of the ingest log: replaced days, untouched dates, builds that die."""

import json
import os

import pytest

from threadloom.sources import export as src
from threadloom.streaming import snapshot
from threadloom.streaming.ingest import start_ingest


def drop_file(root, path, *texts):
    os.makedirs(os.path.dirname(f"{root}/{path}"), exist_ok=True)
    with open(f"{root}/{path}", "w") as f:
        json.dump([{"user": "U", "text": t, "ts": f"{1.7e9 + i}"} for i, t in enumerate(texts)], f, indent=1)


def ingest(spark, root, tmp_path):
    for q in start_ingest(spark, root, str(tmp_path / "log"), str(tmp_path / "bad"), str(tmp_path / "state")):
        q.awaitTermination()


def rows(df):
    return sorted((r.channel, r.date, r.pos, r.text) for r in df.collect())


def test_replaced_days(spark, tmp_path, monkeypatch):
    root, log, table = str(tmp_path / "export"), str(tmp_path / "log"), str(tmp_path / "table")
    drop_file(root, "a/2024-01-01.json", "old one", "old two")
    drop_file(root, "a/2024-01-02.json", "second day")
    drop_file(root, "b/2024-01-01.json", "other channel")
    drop_file(root, "b/x.odd day.json", "odd name")
    ingest(spark, root, tmp_path)
    assert snapshot.refresh(spark, log, table) == 3
    first = rows(snapshot.read_snapshot(spark, table))
    assert len(first) == 5 and first == rows(src.read_bronze(spark, log, latest_file_only=True))
    assert snapshot.refresh(spark, log, table) == 0 and rows(snapshot.read_snapshot(spark, table)) == first

    drop_file(root, "a/sub/2024-01-01.json", "new one")  # deeper: replaces the day
    drop_file(root, "c/2024-01-03.json", "third day")
    ingest(spark, root, tmp_path)
    assert rows(snapshot.read_snapshot(spark, table)) == first  # until it is refreshed

    def die(*a, **k):
        raise KeyboardInterrupt

    monkeypatch.setattr(snapshot, "commit_version", die)
    with pytest.raises(KeyboardInterrupt):
        snapshot.refresh(spark, log, table)
    monkeypatch.undo()
    assert rows(snapshot.read_snapshot(spark, table)) == first
    held = snapshot.read_snapshot(spark, table)  # a reader of the version before
    assert snapshot.refresh(spark, log, table, keep_versions=9) == 2
    want = [("a", "2024-01-01", 0, "new one"), ("a", "2024-01-02", 0, "second day"), ("b", "2024-01-01", 0, "other channel"),
            ("b", "odd day", 0, "odd name"), ("c", "2024-01-03", 0, "third day")]
    assert rows(snapshot.read_snapshot(spark, table)) == want == rows(src.read_bronze(spark, log, latest_file_only=True))
    assert rows(held) == first
    snapshot.vacuum(spark, table, keep_versions=0)
    assert rows(snapshot.read_snapshot(spark, table)) == want
    assert len(os.listdir(f"{table}/versions")) == 1
    assert len([d for d in os.listdir(f"{table}/data") if d.startswith("version=")]) == 2  # dates that stayed, dates rewritten
