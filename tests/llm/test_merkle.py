"""The manifest against a plain recomputation of the trees, and its log's places."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from threadloom.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, root string, tree int, i string"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(rows):
    """Expected rows, from every level written out."""
    def leaf(r, more=0):
        out = ""
        for v in (r[0], r[3], r[2], None if r[4] is None else r[4] + more, r[1]):
            out += "-" if v is None else f"{len(str(v).encode())}:{v}"
        return h(out)

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h("".join(out[-1][k:k + 2])) for k in range(0, len(out[-1]), 2)])
        return out

    def way(tree, i):
        return [tuple(lev[(i >> k) ^ 1:((i >> k) ^ 1) + 1]) + ((i >> k) & 1,) for k, lev in enumerate(tree[:-1])]

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    by = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs}
    trees = {x: levels([leaf(r) for r in by[x]]) for x in langs}
    top = levels([trees[x][-1][0] for x in langs])
    out = []
    for k, x in enumerate(langs):
        for i, r in enumerate(by[x]):
            path = way(trees[x], i) + way(top, k)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            node = leaf(r, int(hit))
            for step in path:
                node = h(node) if len(step) == 1 else h(step[0] + node) if step[1] else h(node + step[0])
            out.append((r[0], leaf(r), trees[x][-1][0], top[-1][0], h("".join(s[0] for s in path if len(s) == 2)), node, not hit))
    return sorted(out, key=repr)


def manifest(spark, rows, levels):
    df = spark.createDataFrame([(*r, "x", "y", 3, "z") for r in rows], SCHEMA).repartition(5)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle.manifest(df, tampered, levels)


@pytest.mark.parametrize("levels", [1, 3, 8])
def test_manifest(spark, levels):
    rng = random.Random(1)
    rows = [(i, f"text {i}", "en", rng.choice(["web", None]), i) for i in range(70)]  # three rounds of builders of 8
    rows += [(5, "text 5", "en", "web", 5)] * 3 + [(5, "other", "en", "web", 5), (None, None, None, None, None)]
    rows += [(None, "", None, "", 0), (None, None, "en", None, None), (7, "é\U0001F600" * 9, "é", "s", 2 ** 63 - 1)]
    rows += [(8, "x " * 400_000, "z", "s", 800_000), (200, "", "", "", 0), (-3, "n", "z", "s", -1), (14, "a", "\U0001F600", "s", None)]
    rows += [(1000 + i, "t", f"l{i}", "s", 1) for i in range(20)]  # lone leaves
    proofs, trees, top = manifest(spark, rows, levels)
    assert sorted(map(tuple, proofs.collect()), key=repr) == brute(rows)
    for forest in (trees, top):
        for tree, places in {r.tree: r.places for r in forest.log().groupBy("tree").agg(
                F.sort_array(F.collect_list("place")).alias("places")).collect()}.items():
            n = forest.segments[0].where(f"tree = {tree} AND block = 0").first().n
            size = sum(((n - 1) >> k) + 1 for k in range(merkle.height(n) + 1))
            assert places == list(range(size)) == list(range(merkle.place(n - 1, merkle.height(n)) + 1))


def test_log_is_in_completion_order(spark):
    rows = [(i, "t", "en", "s", 1) for i in range(21)]
    _, trees, _ = manifest(spark, rows, 2)
    log = {r.place: r.node for r in trees.log().collect()}
    leaves = [log[merkle.place(i, 0)] for i in range(21)]
    whole = merkle.append_log([x.encode() for x in leaves], merkle.height(21))
    assert [whole[k:k + 64].decode() for k in range(0, len(whole), 64)] == [log[k] for k in range(len(log))]


def test_empty_table(spark):
    assert manifest(spark, [], 3)[0].count() == 0


def test_any_change_is_found(spark):
    rows = [(i, f"t{i}", "en" if i % 3 else None, "s", i) for i in range(30)]
    root = {r.root for r in manifest(spark, rows, 3)[0].collect()}
    for k, other in ((4, (4, "t5", "en", "s", 4)), (3, (3, "t3", "en", "s", 3)), (29, (29, "t29", "en", "t", 29))):
        changed = [other if i == k else r for i, r in enumerate(rows)]
        assert {r.root for r in manifest(spark, changed, 3)[0].collect()} != root
