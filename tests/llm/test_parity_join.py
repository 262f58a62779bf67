"""The parity-sketch join against brute force, and its bounds."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from threadloom.llm import parity_join
from threadloom.llm.components import components, extended
from threadloom.llm.parity_join import Settings
from threadloom.llm.store import Scratch

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def brute(texts, words=4, percent=85):
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows, ids not null."""
    sets = []
    for _, t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(LOWER))
        sets.append(frozenset(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset())
    first = {}
    for k, s in enumerate(sets):
        first.setdefault(s, k)
    distinct = [s for s in first if s]
    parent = {s: s for s in distinct}

    def top(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    by_shingle = {}
    for k, s in enumerate(distinct):
        for x in s:
            by_shingle.setdefault(x, []).append(k)
    for i, s in enumerate(distinct):
        for j in {j for x in s for j in by_shingle[x] if j < i}:
            if 100 * len(s & distinct[j]) >= percent * len(s | distinct[j]):
                parent[top(s)] = top(distinct[j])
    least = {}
    for (i, _), s in zip(texts, sets):
        if s:
            least[top(s)] = min(i, least.get(top(s), i))
    return sorted((i, len(s), least[top(s)] if s else i) for (i, _), s in zip(texts, sets))


def rows(df):
    return sorted(map(tuple, df.collect()))


def variants(rng, n):
    """Drifting variants of some texts, and texts that share a passage."""
    vocabulary = [f"W{i}" for i in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(25)]
    out, bases = [], [[rng.choice(vocabulary) for _ in range(k)] for k in (3, 4, 7, 9, 12, 20, 60, 150, 400)]
    for i in range(n):
        kind = i % 10
        if kind == 9:
            out.append((i, " ".join(passage + [rng.choice(vocabulary) for _ in range(rng.randint(0, 30))])))
            continue
        base = bases[kind]
        for _ in range(rng.randint(0, max(1, len(base) // 40))):
            base[rng.randrange(len(base))] = rng.choice(vocabulary)
        extra = [rng.choice(vocabulary) for _ in range(rng.randint(0, len(base) // 8))]
        out.append((i, " ".join(base + extra if rng.random() < 0.7 else extra + base)))
    return out


@pytest.mark.parametrize("how", [Settings(), Settings(tile=5), Settings(words=2, percent=60, band=200)])
def test_links_are_whole(spark, how):
    texts = variants(random.Random(3), 500)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = rows(parity_join.jaccard_components(df, how))
    assert got == brute(texts, how.words, how.percent)
    assert len({r[2] for r in got}) < 480


def test_small_sets_at_the_bound(spark):
    """All sets of few words over a small vocabulary, where the bound is met exactly."""
    rng = random.Random(5)
    texts = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))) for i in range(700)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert rows(parity_join.jaccard_components(df, Settings(words=1, percent=60, band=200))) == brute(texts, 1, 60)
    assert rows(parity_join.jaccard_components(df, Settings(words=2))) == brute(texts, 2)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "a b c d"), (7, "A b\tc d"), (8, long), (9, long + " tail"),
             (5, "one"), (5, "quite other words than those"), (8, long)]
    df = spark.createDataFrame([(i, t, 1, "k", 2) for i, t in texts], "doc_id long, text string, n_shingles int, key string, member int")
    assert rows(parity_join.jaccard_components(df.repartition(3))) == brute(texts)
    assert parity_join.jaccard_components(df.where("false")).count() == 0
    free = spark.createDataFrame([(None, "a b c d e"), (7, "a b c d e"), (None, "f g h i j"), (None, None)], "doc_id long, text string")
    got = [tuple(r) for r in parity_join.jaccard_components(free).collect()]
    assert sorted(got, key=repr) == sorted([(None, 2, 7), (7, 2, 7), (None, 2, None), (None, 0, None)], key=repr)


def test_query_on_small_tables(spark):
    from threadloom.llm.queries import QUERIES
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
        assert rows(QUERIES["op13_jaccard_join"](spark, sf)) == brute(docs)


def test_distances_bound_the_difference():
    rng = np.random.default_rng(4)
    for n in (3, 40, 900):
        x = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[n // 10:], rng.integers(0, 2 ** 63, 2 * n).astype(np.uint64)]))
        p, q = parity_join.sketch([x, y])
        for width in {min(len(p), len(q)), 8}:
            both = parity_join.folded([p, q], width)
            assert np.bitwise_count(both[0] ^ both[1]).sum() <= len(np.setxor1d(x, y))


def test_linked_sets_share_a_key():
    """Pairs just above the bound, in any band, with few and many segments."""
    rng = np.random.default_rng(6)
    how = Settings()
    for _ in range(3000):
        n = int(rng.integers(6, 400))
        x = rng.integers(0, 2 ** 63, n).astype(np.uint64)
        cut, more = int(rng.integers(0, n // 6 + 1)), int(rng.integers(0, n // 6 + 1))
        y = np.concatenate([x[cut:], rng.integers(0, 2 ** 63, more).astype(np.uint64)])
        if 100 * (n - cut) >= how.percent * (n + more) and cut + more:
            keys, off = parity_join.join_keys([np.sort(x), np.sort(y)], how)
            assert set(keys[:off[1]]) & set(keys[off[1]:])


def test_tiles_over_batches_and_distances():
    """Tiles cut anywhere by batches of rows, with sketches of several widths, against one pair at a time."""
    how, rng = Settings(), np.random.default_rng(7)
    base = rng.integers(0, 2**63, 900).astype(np.uint64)
    got = []
    for key in range(40):
        for member in rng.choice(400, rng.integers(2, 40), replace=False).tolist():
            n = 1 + member * 2
            stray = member % 3 == 0
            if stray:
                got.append((key, key % 2, 0, member, member % 7, True, parity_join.sketch([base[:n]])[0], n, True))
            got.append((key, key % 2, 0, member, member % 7, stray, parity_join.sketch([base[:n]])[0], n, False))
    names = ("key", "i", "j", "member", "comp", "stray", "sketch", "n", "left")
    table = pa.table({c: list(x) for c, x in zip(names, zip(*got))})
    want = set()
    for tile in range(40):
        rows = [r for r in got if r[0] == tile]
        for x in (r for r in rows if r[8]):
            for y in (r for r in rows if not r[8]):
                both = parity_join.folded([x[6], y[6]], min(len(x[6]), len(y[6])))
                apart = max(np.bitwise_count(both[0] ^ both[1]).sum(), abs(x[7] - y[7]))
                if x[4] != y[4] and (not y[5] or x[3] < y[3]) and apart <= how.differ(x[7] + y[7]):
                    want.add((min(x[3], y[3]), max(x[3], y[3])))
    assert len(want) > 50
    for size in (1, 7, 64, 10_000):
        pairs = [p for b in parity_join._meet(how)(iter(table.to_batches(size))) for p in zip(*(c.to_pylist() for c in b.columns))]
        assert set(pairs) == want
    assert not list(parity_join._meet(how)(iter([])))


@pytest.mark.parametrize("n", [0, 1, 60])
def test_links_found_later_extend_components(spark, n, monkeypatch):
    """Components of all links are those of the first, extended by the later ones; stars need no round."""
    written = []
    keep = Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df, table, codec="zstd": written.append(table) or keep(self, df, table, codec))
    rng = random.Random(n)
    first = [(rng.randrange(200), rng.randrange(200)) for _ in range(80)]
    more = [(rng.randrange(200), rng.randrange(200)) for _ in range(n)]
    a, b = (spark.createDataFrame(x, "a long, b long") for x in (first, more))
    scratch = Scratch(spark, "extended-test")
    merged = components(a, scratch, "merged")
    got = rows(extended(merged, b, scratch, "final"))
    assert got == rows(components(a.union(b), scratch, "whole"))
    assert rows(components(merged.toDF("a", "b"), scratch, "again")) == rows(merged)
    assert [w for w in written if w.startswith("again")] == ["again0"]
