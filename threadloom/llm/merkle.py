"""Merkle manifest of a dataset as a postorder append log.

A tree's leaves are dealt to aligned builders of ``2**levels`` consecutive
leaves.  A builder writes its nodes in the order in which they are completed
(each leaf, then every node whose last leaf that was); the builders' roots are
the leaves of the next round.  A node's place in a log is closed form: with the
last leaf below it being number i of the tree, 2 i - popcount(i) nodes were
complete before that leaf, and the node of level h comes h places after it.
So a sibling is addressed, never searched, and a proof is extracted from one
segment of the log a round."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.store import Scratch

#: A builder's leaves are 2 to this power.
LEVELS = 8
_HEX = 64
#: Bytes of a path entry: a flag and the sibling's digest.
_STEP = 1 + _HEX
ALONE, LEFT, RIGHT = 0, 1, 2


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def place(i: int, level: int) -> int:
    """Place in its tree's log of the node of ``level`` whose last leaf is number ``i``."""
    return 2 * i - i.bit_count() + level


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return (n - 1).bit_length()


def last_leaf(level: int, j: int, n: int) -> int:
    """The last leaf below node ``j`` of ``level``."""
    return min((j + 1) << level, n) - 1


def append_log(leaves: list[bytes], top: int) -> bytes:
    """The nodes of a tree in completion order, up to level ``top``; a node
    alone at the end of its level is hashed alone."""
    n, log, open_ = len(leaves), [], []
    for i, leaf in enumerate(leaves):
        node, level = leaf, 0
        log.append(node)
        while level < top and ((i >> level) & 1 or i == n - 1):
            node = digest(open_.pop() + node if (i >> level) & 1 else node)
            log.append(node)
            level += 1
        open_.append(node)
    return b"".join(log)


def path_in(log: bytes, n: int, top: int, i: int) -> bytes:
    """Leaf ``i``'s way to level ``top``: per level a flag and the sibling's
    digest (zeros for a node alone)."""
    out = []
    for level in range(top):
        j = (i >> level) ^ 1
        if j > (n - 1) >> level:
            out.append(bytes(_STEP))
        else:
            at = place(last_leaf(level, j, n), level) * _HEX
            out.append(bytes([RIGHT if j & 1 else LEFT]) + log[at:at + _HEX])
    return b"".join(out)


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path lead to."""
    for at in range(0, len(path), _STEP):
        flag, sibling = path[at], path[at + 1:at + _STEP]
        leaf = digest(leaf if flag == ALONE else sibling + leaf if flag == LEFT else leaf + sibling)
    return leaf


def siblings(path: bytes) -> bytes:
    """The siblings of a path, concatenated."""
    return b"".join(path[at + 1:at + _STEP] for at in range(0, len(path), _STEP) if path[at] != ALONE)


def numbered(df: DataFrame, group: str | None, order: list[Column], scratch: Scratch, name: str,
             labels: DataFrame | None = None) -> DataFrame:
    """``df`` with ``i``, the number of a row in its group from 0 in ``order``
    (which begins with the group), ``n``, the group's size, and the columns of
    ``labels``, which has one row a group, its first column named as the group and ``_``.  One range
    shuffle; counts per (partition, group) are summed up, so no group is one
    task's work."""
    laid = scratch.keep(df.repartitionByRange(*order).sortWithinPartitions(*order)
                        .withColumn("__at", F.monotonically_increasing_id()), name)
    laid = laid.withColumn("__part", F.shiftright("__at", 33))
    key = ["__part"] + ([group] if group else [])
    runs = laid.groupBy(*key).agg(F.count(F.lit(1)).alias("__rows"), F.min("__at").alias("__first"))
    over = Window.partitionBy(group) if group else Window.partitionBy()
    runs = runs.select(
        *[F.col(c).alias(f"{c}_") for c in key], "__first", F.sum("__rows").over(over).alias("n"),
        (F.sum("__rows").over(over.orderBy("__part")) - F.col("__rows")).alias("__base"))
    named = []
    if labels is not None:
        own, *named = labels.columns
        runs = runs.join(labels.withColumnRenamed(own, "__group"), F.col(own).eqNullSafe(F.col("__group"))).drop("__group")
    runs = scratch.keep(runs, f"{name}-runs")
    same = F.col("__part") == F.col("__part_")
    if group:
        same = same & F.col(group).eqNullSafe(F.col(f"{group}_"))
    return laid.join(runs, same).select(*df.columns, (F.col("__base") + F.col("__at") - F.col("__first")).alias("i"), "n", *named)


_SEGMENT = "tree long, block long, n long, log binary, ids array<long>, changed array<binary>"


def _build(levels: int):
    """A builder: its leaves -> one segment of the log.  A tree that fits is built whole."""
    def run(key: tuple[pa.Scalar, ...], got: pa.Table) -> pa.Table:
        got = got.sort_by("i")
        n = got.column("n")[0].as_py()
        log = append_log([x.encode() for x in got.column("node").to_pylist()], min(levels, height(n)))
        changed = pa.array([[None if x is None else x.encode() for x in got.column("changed").to_pylist()]], pa.list_(pa.binary()))
        return pa.table({"tree": pa.array([key[0].as_py()], pa.int64()), "block": pa.array([key[1].as_py()], pa.int64()),
                         "n": pa.array([n], pa.int64()), "log": pa.array([log], pa.binary()),
                         "ids": pa.array([got.column("id").to_pylist()], pa.list_(pa.int64())), "changed": changed})
    return run


@dataclass
class Forest:
    """Segments of each round and every tree's root (tree, root)."""

    segments: list[DataFrame]
    roots: DataFrame
    levels: int

    def log(self) -> DataFrame:
        """(tree, place, node): the whole log."""
        levels = self.levels

        def place_all(round_: int):
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                low = round_ * levels
                for batch in batches:
                    tree, at, node = [], [], []
                    for r in batch.to_pylist():
                        mine, total = len(r["ids"]), r["n"]
                        for level in range(1 if round_ else 0, min(levels, height(total)) + 1):
                            for j in range(((mine - 1) >> level) + 1):
                                own = place(last_leaf(level, j, mine), level) * _HEX
                                end = last_leaf(low + level, (r["block"] << (levels - level)) + j, r["leaves"])
                                tree.append(r["tree"])
                                at.append(place(end, low + level))
                                node.append(r["log"][own:own + _HEX].decode())
                    yield pa.RecordBatch.from_arrays([pa.array(tree, pa.int64()), pa.array(at, pa.int64()), pa.array(node, pa.string())],
                                                     ["tree", "place", "node"])
            return run

        leaves = self.segments[0].where("block = 0").select("tree", F.col("n").alias("leaves"))
        out = None
        for r, s in enumerate(self.segments):
            part = (s.select("tree", "block", "n", "log", "ids").join(leaves, "tree")
                    .mapInArrow(place_all(r), "tree long, place long, node string"))
            out = part if out is None else out.union(part)
        return out


def build(leaves: DataFrame, scratch: Scratch, name: str, levels: int = LEVELS) -> Forest:
    """Trees over ``leaves`` (tree, i, n, node, id, changed), i from 0 to n - 1 in each tree."""
    segments, round_ = [], 0
    while True:
        block = F.shiftright("i", levels).alias("block")
        seg = scratch.keep(leaves.select("tree", block, "i", "n", "node", "id", "changed").groupBy("tree", "block")
                           .applyInArrow(_build(levels), _SEGMENT), f"{name}-{round_}")
        segments.append(seg)
        root = F.expr(f"decode(substring(log, length(log) - {_HEX - 1}, {_HEX}), 'UTF-8')")
        if seg.where(F.col("n") > 1 << levels).isEmpty():
            break
        leaves = (seg.where(F.col("n") > 1 << levels)
                  .select("tree", F.col("block").alias("i"), (F.shiftright(F.col("n") - 1, levels) + 1).alias("n"),
                          root.alias("node"), F.col("block").alias("id"), F.lit(None).cast("string").alias("changed")))
        round_ += 1
    roots = None
    for seg in segments:
        own = seg.where(F.col("n") <= 1 << levels).select("tree", root.alias("root"))
        roots = own if roots is None else roots.union(own)
    return Forest(segments, scratch.keep(roots, f"{name}-roots"), levels)


def _paths(levels: int):
    """Segments with the path above them -> their leaves (the builders of the
    round before) with their whole paths."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, block, path = [], [], []
            for r in batch.to_pylist():
                top = min(levels, height(r["n"]))
                for i, x in enumerate(r["ids"]):
                    tree.append(r["tree"])
                    block.append(x)
                    path.append(path_in(r["log"], len(r["ids"]), top, i) + r["path"])
            yield pa.RecordBatch.from_arrays([pa.array(tree, pa.int64()), pa.array(block, pa.int64()), pa.array(path, pa.binary())],
                                             ["tree", "block", "path"])
    return run


def with_paths(forest: Forest, above: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The first round's segments with ``path``: from the segment's root up
    through its tree and then ``above`` (tree, path)."""
    known = None
    for r in range(len(forest.segments) - 1, -1, -1):
        seg = forest.segments[r]
        whole = seg.where(F.col("n") <= 1 << forest.levels).join(above, "tree")
        part = whole if known is None else whole.unionByName(
            seg.where(F.col("n") > 1 << forest.levels).join(known, ["tree", "block"]))
        if r == 0:
            return part
        known = scratch.keep(part.select("tree", "n", "log", "ids", "path")
                             .mapInArrow(_paths(forest.levels), "tree long, block long, path binary"), f"{name}-paths{r}")


_PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove(levels: int):
    """Segments with paths and roots -> a row a leaf; a changed leaf is folded in place of the leaf."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n, log = len(r["ids"]), r["log"]
                top = min(levels, height(r["n"]))
                leaf, proof, folded = [], [], []
                for i, changed in enumerate(r["changed"]):
                    at = place(i, 0) * _HEX
                    own = log[at:at + _HEX]
                    path = path_in(log, n, top, i) + r["path"]
                    leaf.append(own.decode())
                    proof.append(digest(siblings(path)).decode())
                    folded.append(fold(own if changed is None else changed, path).decode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["ids"], pa.int64()), pa.array(leaf), pa.array([r["subroot"]] * n), pa.array([r["root"]] * n),
                     pa.array(proof), pa.array(folded), pa.array([x == r["root"] for x in folded], pa.bool_())],
                    [c.split()[0] for c in _PROOFS.split(", ")])
    return run


def field(value: Column) -> Column:
    """A leaf's input: ``-`` for null, else the UTF-8 byte count, ``:``, the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def manifest(docs: DataFrame, tampered: Column | None = None, levels: int = LEVELS,
             scratch: Scratch | None = None) -> tuple[DataFrame, Forest, Forest]:
    """(proofs, trees, top): one row per row of ``docs`` with doc_id, leaf, subroot,
    root, proof_sha256, folded_root, verified; the trees per lang; the tree over
    their roots.

    A leaf is the SHA-256 (lowercase hex) of doc_id, source, lang, n_chars and
    text, each ``-`` if null.  Leaves of a lang (null is a lang of its own, the
    first) ascend by doc_id, null first, equal ids by leaf; a run of two nodes or
    a last one alone is hashed to one.  ``proof_sha256`` is of the siblings' digests,
    bottom up.  Where ``tampered`` holds, the root is recomputed from a
    leaf with n_chars one greater (null stays null), else from the leaf itself,
    and ``verified`` tells whether it is the root.  Repeated rows are leaves of
    their own; empty and very long texts are hashed like any; an empty table
    gives no rows; other columns of ``docs`` do not take part.  Texts are read once and
    never shuffled.
    """
    scratch = scratch or Scratch(docs.sparkSession, "merkle")
    c = F.col

    def leaf(n_chars: Column) -> Column:
        return F.sha2(F.concat(field(c("doc_id")), field(c("source")), field(c("lang")), field(n_chars), field(c("text"))), 256)

    changed = F.lit(None).cast("string")
    if tampered is not None:
        changed = F.when(tampered, leaf((c("n_chars").cast("decimal(20,0)") + 1)))
    leaves = scratch.keep(docs.select(c("doc_id").alias("id"), "lang", leaf(c("n_chars")).alias("node"), changed.alias("changed"))
                          .withColumn("rid", F.monotonically_increasing_id()), "leaves")
    first = [c(x).asc_nulls_first() for x in ("lang", "id", "node", "rid")]
    langs = numbered(leaves.select("lang").distinct(), None, [c("lang").asc_nulls_first()], scratch, "langs")
    langs = scratch.keep(langs.select(c("lang").alias("lang_"), c("i").alias("tree"), c("n").alias("langs")), "trees")
    trees = build(numbered(leaves, "lang", first, scratch, "laid", langs), scratch, "tree", levels)
    top = build(trees.roots.join(langs, "tree")
                .select(F.lit(0).cast("long").alias("tree"), c("tree").alias("i"), c("langs").alias("n"), c("root").alias("node"),
                        c("tree").alias("id"), F.lit(None).cast("string").alias("changed")), scratch, "top", levels)
    over = top.roots.select("tree", F.lit(b"").alias("path"))
    above = with_paths(top, over, scratch, "top").select("tree", "n", "log", "ids", "path")
    above = scratch.keep(above.mapInArrow(_paths(levels), "tree long, block long, path binary")
                         .select(c("block").alias("tree"), "path"), "above")
    root = top.roots.first()  # one row; none of an empty table
    whole = (with_paths(trees, above, scratch, "tree").select("tree", "n", "log", "ids", "changed", "path")
             .join(trees.roots.select("tree", c("root").alias("subroot")), "tree")
             .withColumn("root", F.lit(root.root if root else None).cast("string")))
    return whole.mapInArrow(_prove(levels), _PROOFS), trees, top
