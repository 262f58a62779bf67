"""Files read in pieces give what the whole-text reader gives, at any chunk size."""

import json
import os
import random

import pytest

from threadloom.sources import export as src

CHUNK = "spark.sql.files.maxPartitionBytes"


def message(rng, depth=0):
    signs = ['"', "\\", "}", "{", "[", "]", ",", "a", "é", "\U0001F600", "\n", " ", "null", " ", "}]", '\\"}']
    text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 25)))
    out = {"user": "U1", "text": text, "ts": f"{rng.randint(0, 10 ** 9)}.5"}
    for _ in range(rng.randint(0, 2)):
        out[rng.choice(["thread_ts", "subtype", "bot_id", "}x"])] = rng.choice([None, 3, "}", [1, {"a": ["}"]}], {"b": {}}])
    if depth < 2 and rng.random() < 0.3:
        out["nested"] = [message(rng, depth + 1)]
    return out


def texts():
    rng = random.Random(6)
    arrays = [[message(rng) for _ in range(n)] for n in (0, 1, 2, 30, 200)]
    out = [json.dumps(a, ensure_ascii=k % 2 == 0, indent=k or None) for k, a in enumerate(arrays)]
    good = json.dumps([message(rng) for _ in range(5)])
    out += [good + "\n \t", " \r\n" + good, good[:-1], good[:-2], good + "x", good + good, "[" + good + "]", good[:-1] + ",]",
            good[:-1] + ",null]", "[null," + good[1:], "[null]", "[ null , null ]", "[]", " [ ] ", "", " ", "{}", "}", "[}", "[{]", '[{"a":[1]}',
            '[{"a":[1]', '[{"a":1}}]', '[{"a":1}{"a":2}]', '[{"a":1},1]', '["s",{"a":1}]', '[{"a":1},"}"]', '[{"a":"\\}"}]', '[{"a":"\\\\"}]',
            '[{"a":"\\u007d\\""}]', "[{'a':1}]", '[{"a":1,}]', '[{"a":1} {"b":2}]', '[,{"a":1}]', '[{"a":1},,{"a":2}]', '[{"a":"x\ty"}]',
            '[{"text":"first","text":"last"}]', '{"a":[{"b":1}]}', '[{"a":1}]]', '[[{"a":1}]]', "﻿" + good, '[{"a":NaN}]', '[{}]', '[{},{}]']
    return out


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("large") / "data")
    os.makedirs(f"{root}/a b%41+c")
    for name in ("users.json", "channels.json"):
        with open(f"{root}/{name}", "w") as f:
            f.write("[]")
    for k, t in enumerate(texts()):
        with open(f"{root}/a b%41+c/{k:03d}.json", "wb") as f:
            f.write(t.encode())
    with open(f"{root}/a b%41+c/900.json", "wb") as f:
        f.write('[{"text": "café}"}]'.encode("latin-1"))
    return root


def tables(spark, root, **how):
    e = src.read_export(spark, root, **how)
    rows = lambda df: sorted((str(r.asDict()) for r in df.collect()))
    return rows(e.files), rows(e.messages), rows(e.quarantine)


@pytest.mark.parametrize("chunk", [700, 1 << 20])
def test_any_chunk_size(spark, root, chunk, tmp_path):
    whole = tables(spark, root)
    assert len(whole[1]) > 240 and len(whole[2]) > 20
    before = spark.conf.get(CHUNK)
    try:
        spark.conf.set(CHUNK, str(chunk))
        pieces = tables(spark, root, large_bytes=-1, decoded_path=str(tmp_path / "decoded"))
    finally:
        spark.conf.set(CHUNK, before)
    for a, b in zip(whole, pieces):
        assert a == b


def test_only_large_files_go_in_pieces(spark, root, tmp_path):
    assert tables(spark, root, large_bytes=2000) == tables(spark, root)
    large = src.large_files(spark, root, 2000)
    assert 0 < len(large) < 10
    # (the file source passes over the one empty file)
    assert src.read_files(spark, root, large).count() == len(texts()) - len(large)
