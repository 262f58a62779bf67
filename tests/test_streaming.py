"""Streaming ingest: two rounds of new files land in the bronze table once."""

import json
import os
import uuid

from threadloom.operators import filters
from threadloom.sources import export as src
from threadloom.streaming.ingest import start_ingest


def _day(root, chan, date, texts, t0):
    os.makedirs(f"{root}/{chan}", exist_ok=True)
    msgs = [{"user": "U1", "text": t, "ts": f"{t0 + i}.000100"} for i, t in enumerate(texts)]
    with open(f"{root}/{chan}/{date}.json", "w") as f:
        json.dump(msgs, f)


def test_incremental_ingest(spark, tmp_path):
    root = str(tmp_path / "export")
    os.makedirs(root)
    _day(root, "general", "2024-01-01", ["a", "b"], 1_700_000_000)
    _day(root, "random", "2024-01-01", ["c"], 1_700_000_100)
    with open(f"{root}/users.json", "w") as f:
        json.dump([], f)
    bronze, quar = str(tmp_path / "bronze"), str(tmp_path / "quarantine")
    name = uuid.uuid4().hex[:8]
    for q in start_ingest(spark, root, bronze, quar, state_path=str(tmp_path / "state"), name=name):
        q.awaitTermination()
    assert src.read_bronze(spark, bronze).count() == 3
    # second round: one new day, one broken file, one replacement of an old day (deeper)
    _day(root, "general", "2024-01-02", ["d", " "], 1_700_100_000)
    with open(f"{root}/random/bad.json", "w") as f:
        f.write("[{")
    _day(f"{root}/general", "sub", "2024-01-01", ["a2"], 1_700_000_050)  # general/sub/2024-01-01.json
    for q in start_ingest(spark, root, bronze, quar, state_path=str(tmp_path / "state"), name=name):
        q.awaitTermination()
    b = src.read_bronze(spark, bronze)
    assert b.count() == 3 + 2 + 1  # nothing read twice
    latest = src.read_bronze(spark, bronze, latest_file_only=True)
    texts = sorted(r.text for r in filters.valid_messages(latest).collect())
    assert texts == ["a2", "c", "d"]
    assert [r.reason for r in spark.read.parquet(quar).collect()] == ["not a json array"]


RUN = """
import sys
from threadloom.session import get_spark
from threadloom.streaming.ingest import start_ingest
root, bronze, quar, state = sys.argv[1:]
for q in start_ingest(get_spark("local[2]", 2), root, bronze, quar, state_path=state):
    q.awaitTermination()
"""


def test_restart_in_another_application(spark, tmp_path):
    import subprocess
    import sys

    root = str(tmp_path / "export")
    args = [root, *(str(tmp_path / x) for x in ("bronze", "quarantine", "state"))]
    for n, (chan, text) in enumerate([("general", "a"), ("_hidden", "b"), ("100%", "c")]):
        _day(root, chan, f"2024-01-0{n + 1}", [text], 1_700_000_000)
        subprocess.run([sys.executable, "-c", RUN, *args], check=True, timeout=240,
                       env=os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))})
    b = src.read_bronze(spark, args[1])
    assert sorted((r.channel, r.text) for r in b.collect()) == [("100%", "c"), ("_hidden", "b"), ("general", "a")]
