from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from threadloom.session import checkpoint_dir, get_spark
    s = get_spark("local[4]", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s


def _w(path: str, obj=None, raw: bytes | None = None) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(raw if raw is not None else json.dumps(obj).encode("utf-8"))


NBSP = "\u00a0"


def build_mini_export(root: str) -> str:
    """The golden mini-export of FIXTURES.md section B."""
    _w(f"{root}/users.json", [
        {"id": "U1", "profile": {"real_name": "Ann $2 \\Lee"}},
        {"id": "U2", "profile": {}},
        {"id": "U3", "profile": {"real_name": None}},
        {"id": "U1", "profile": {"real_name": "Second"}},
    ])
    _w(f"{root}/channels.json", [{"name": "chan-b"}, {"name": "chan-a"}])
    t0 = 1_700_000_000.0

    def msg(i, text="hello", user="U1", thread=None, **kw):
        m = {"type": "message", "user": user, "text": text, "ts": f"{t0 + i:.6f}"}
        if thread is not None:
            m["thread_ts"] = thread
        m.update(kw)
        return m

    _w(f"{root}/general/2024-01-01.json", [
        msg(0, "hi <@U1> and <@U9>, <@U1|ann> <@U1><@U2>"),
        msg(10, "see <#C1|gen> and <#C2>"),
        msg(20, "<http://a> <http://c|lab> <http://a>,<http://b> <mailto:x@y> <http://n" + NBSP + "x>"),
        msg(30, "```x\n  y```\tz\u3000w"),
        msg(40, "bot says", bot_id="B1"),
        msg(50, "joined", subtype=None),
    ])
    # same (channel, date) deeper: this one wins
    _w(f"{root}/general/sub/2024-01-01.json", [msg(60, "deeper wins"), msg(61, "second")])
    _w(f"{root}/general/sub/2024-01-02.json", [msg(100, "nested day")])
    _w(f"{root}/general/a.2024-01-03.json", [msg(200, "dotted name")])
    _w(f"{root}/general/canvases.json", [msg(300, "skipped by name")])
    _w(f"{root}/general/UP.JSON", [msg(301, "skipped by case")])
    _w(f"{root}/extra.json", [msg(302, "root file skipped")])
    _w(f"{root}/random/bad.json", raw=b'[{"a":')
    _w(f"{root}/random/latin.json", raw='[{"text": "café"}]'.encode("latin-1"))
    _w(f"{root}/random/dict.json", {"a": 1})
    _w(f"{root}/random/mixed.json", [msg(400), "s"])
    _w(f"{root}/random/nullelem.json", [None, msg(401)])
    _w(f"{root}/random/2024-02-01.json", [
        msg(1000, None), {"user": "U1", "ts": f"{t0 + 1001:.6f}"}, msg(1002, ""), msg(1003, "   "),
        msg(1004, NBSP), msg(1005, "\x1c"), msg(1006, "kept"),
        {"user": "U2", "text": "no ts"}, msg(1008, "empty ts"), msg(1009, "bad ts"), msg(1010, "nan ts"),
        msg(1011, "5d ts"),
    ])
    # fix the ts strings of the last four messages
    p = f"{root}/random/2024-02-01.json"
    arr = json.load(open(p))
    arr[8]["ts"], arr[9]["ts"], arr[10]["ts"], arr[11]["ts"] = "", "abc", "nan", "5d"
    _w(p, arr)
    _w(f"{root}/a b+c/2024-01-01.json", [msg(2000, "spaced path")])
    _w(f"{root}/_under/2024-01-01.json", [msg(2001, "hidden-looking channel")])
    return root


@pytest.fixture(scope="session")
def mini_export():
    d = tempfile.mkdtemp(prefix="threadloom-export-")
    return build_mini_export(f"{d}/export")
