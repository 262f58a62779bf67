"""S1-S8, A4, F1-F9 on the golden mini-export."""

from pyspark.sql import functions as F

from threadloom.operators import filters
from threadloom.sources import export as src


def test_users_and_channels(spark, mini_export):
    u = src.read_users(spark, mini_export).orderBy("ord").collect()
    assert [(r.id, r.real_name, r.ord) for r in u] == [
        ("U1", "Ann $2 \\Lee", 0), ("U2", None, 1), ("U3", None, 2), ("U1", "Second", 3)]
    ch = filters.channel_names(src.read_channels(spark, mini_export)).orderBy("ord").collect()
    assert [r.name for r in ch] == ["chan-b", "chan-a"]  # channels.json order, not directories


def test_discovery_and_path_columns(spark, mini_export):
    exp = src.read_export(spark, mini_export)
    files = {r.rel_path: r for r in exp.files.collect()}
    # skipped: canvases.json (name), UP.JSON (case), extra.json (root level)
    assert not any(p.endswith(("canvases.json", "UP.JSON")) or p == "extra.json" for p in files)
    # the shallower general/2024-01-01.json loses against general/sub/2024-01-01.json
    lost = {r.path for r in src.losing_files(exp.files).collect()}
    assert [p for p in files if files[p].path in lost] == ["general/2024-01-01.json"]
    assert files["general/sub/2024-01-02.json"].channel == "general"
    assert files["general/a.2024-01-03.json"].date == "2024-01-03"
    assert files["a b+c/2024-01-01.json"].channel == "a b+c"
    assert files["_under/2024-01-01.json"].channel == "_under"


def test_quarantine(spark, mini_export):
    exp = src.read_export(spark, mini_export)
    q = {r.path.rsplit("/", 1)[-1]: r.reason for r in exp.quarantine.collect()}
    assert set(q) == {"bad.json", "latin.json", "dict.json", "mixed.json", "nullelem.json"}
    assert q["latin.json"] == "not utf-8"
    rep = {r.channel: r for r in src.file_report(exp.files).collect()}
    assert rep["random"].n_failed == 5 and rep["random"].n_files == 6


def test_messages_filters(spark, mini_export):
    exp = src.read_export(spark, mini_export)
    m = exp.messages
    assert m.filter("channel = 'general' AND date = '2024-01-01'").count() == 2  # the winning file only
    valid = filters.valid_messages(m)
    texts = {r.text for r in valid.collect()}
    assert "bot says" not in texts and "joined" not in texts  # bot_id, subtype: null
    for blank in ("", "   ", " ", "\x1c"):
        assert blank not in texts
    assert None not in texts
    assert "kept" in texts
    # Unparseable ts become NULL (dropped before grouping, counted)
    bad = {r.text: r.ts_num for r in m.filter("channel = 'random'").collect() if r.text}
    assert bad["empty ts"] is None and bad["bad ts"] is None and bad["nan ts"] is None and bad["5d ts"] is None
    assert bad["kept"] is not None
    # F3-F8
    assert filters.by_channel(valid, "nope").count() == 0
    assert filters.by_date(valid, 2024, 1, 3).count() == 1
    assert filters.by_datestring(valid, "2024-01-02").count() == 1
    assert filters.by_date_prefix(valid, "2024-01").count() == valid.filter("date like '2024-01%'").count()
    assert filters.by_date_prefix(valid, "").count() == valid.count()
    assert filters.by_user(valid, "U2").count() == 1  # "no ts" (dropped later, at grouping)
    assert filters.by_user(valid, "U7").count() == 0
    # F4 with a Python callable (slow path) equals the Column form
    a = filters.where(valid, lambda r: r["channel"] == "general").count()
    assert a == filters.where(valid, F.col("channel") == "general").count() == 4


def test_bronze_roundtrip(spark, mini_export, tmp_path):
    exp = src.read_export(spark, mini_export)
    src.write_bronze(exp.messages, str(tmp_path / "bronze"))
    b = src.read_bronze(spark, str(tmp_path / "bronze"))
    assert b.count() == exp.messages.count()
    plan = b.filter("date = '2024-01-02'").select("text")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "date" in plan


def _write(root, path, text):
    import os
    os.makedirs(os.path.dirname(f"{root}/{path}"), exist_ok=True)
    with open(f"{root}/{path}", "w") as f:
        f.write(text)


GOOD = '[{"user": "U1", "text": "%s", "ts": "1700000000.5", "reactions": [1]}]'


def test_winner_names_and_strict_json(spark, tmp_path):
    _write(tmp_path / "data", "users.json", "[]")
    _write(tmp_path / "data", "channels.json", "[]")
    _write(tmp_path / "data", "general/2024-01-01.json", GOOD % "good")
    _write(tmp_path / "data", "general/sub/2024-01-01.json", "[{broken")  # deeper, but not decodable
    _write(tmp_path / "data", "general/_x/2024-01-02.json", GOOD % "hidden folder")
    _write(tmp_path / "data", "general/.2024-01-03.json", GOOD % "hidden file")
    _write(tmp_path / "data", "100%/a%41.2024-01-04.json", GOOD % "percent")
    _write(tmp_path / "data", "general/2024-01-05.json", "[{'text': 'single'}]")
    _write(tmp_path / "data", "general/2024-01-06.json", GOOD % "one" + GOOD % "two")
    _write(tmp_path / "data", "general/2024-01-07.json", '[{"text": "first", "text": "last"}]')
    _write(tmp_path / "data", "general/2024-01-09.json", '[\n  {\n "text":\n "lines"\n}\n]\n')
    _write(tmp_path / "data", "users.json", '[\n{"id": "U1"},\n{"id": "U2"}\n]\n')
    _write(tmp_path / "data", "general/2024-01-08.json", '[{"text": "a"}]}{"a":[{"text": "b"}]')
    exp = src.read_export(spark, str(tmp_path / "data"))
    got = {(r.channel, r.date): r.text for r in exp.messages.collect()}
    assert got == {("general", "2024-01-01"): "good", ("general", "2024-01-02"): "hidden folder",
                   ("100%", "2024-01-04"): "percent",
                   ("general", "2024-01-07"): "last", ("general", "2024-01-09"): "lines"}
    assert [r.id for r in exp.users.orderBy("ord").collect()] == ["U1", "U2"]
    bad = {r.date: r.reason for r in exp.quarantine.collect()}
    assert set(bad) == {"2024-01-01", "2024-01-03", "2024-01-05", "2024-01-06", "2024-01-08"}
    assert bad["2024-01-03"] == "hidden name"
    assert exp.messages.where("fields['reactions'] = '[1]'").count() == 3


def test_relative_root_and_bad_directory(spark, tmp_path):
    import os

    import pytest
    root = str(tmp_path / "tmp" / "data")
    _write(root, "users.json", "{not json")
    _write(root, "channels.json", "[]")
    _write(root, "tmp/0042.json", GOOD % "x")
    exp = src.read_export(spark, "./" + os.path.relpath(root))
    assert [(r.channel, r.date) for r in exp.messages.collect()] == [("tmp", "0042")]
    with pytest.raises(Exception, match="users.json is not a JSON array"):
        exp.users.collect()
    src.write_bronze(exp.messages, str(tmp_path / "bronze"))
    b = src.read_bronze(spark, str(tmp_path / "bronze"))
    assert [r.date for r in b.collect()] == ["0042"] and filters.by_datestring(b, "2024-13").count() == 0


def test_decode_parses_a_text_once(spark):
    raw = spark.createDataFrame([], "path string, rel_path string, channel string, date string, depth int, value string")
    plan = src.decode(raw.repartition(2))._jdf.queryExecution().analyzed().toString()
    assert plan.count("from_json") == 1 and "RLIKE(value" not in plan


def test_decoded_files_as_a_row_per_message(spark, tmp_path):
    """The same tables as from whole files, and the verdict on what stands around the array."""
    bad, ok = "not a json array", "ok"
    texts = [("[]", ok), (' \n[{"user":"a","text":null},{"user":"b"}]\r\n ', ok), ("", bad), ("[", bad), ("]", bad), ("x[]", bad), ("[]x", bad), ("{}", bad),
             ("][", bad), ("[1]", "invalid json"), ('[{"a":"]"}', bad), ('[{"a":"["}]', ok), ("[null]", "non-object element"), ("[{},null]", "non-object element"),
             ("[]\u2028", "invalid json"), ("\u2028[]", bad), ("[]]", "invalid json"), ("[{}]{}]", "invalid json"), (None, "hidden name")]
    raw = spark.createDataFrame([(f"p{i}", f"r{i}", "c", f"d{i % 3}", i % 2, v) for i, (v, _) in enumerate(texts)],
                                "path string, rel_path string, channel string, date string, depth int, value string")
    whole = src.decode_files(raw)
    rows = src.element_rows(src.decode(raw))
    rows.write.parquet(str(tmp_path / "rows"))
    assert rows.count() == len(texts) + 1
    for a, b in zip(whole, src.element_tables(spark.read.schema(rows.schema).parquet(str(tmp_path / "rows")))):
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert {r.path: r.status for r in whole[0].collect()} == {f"p{i}": want for i, (_, want) in enumerate(texts)}
    assert whole[1].count() == 3
