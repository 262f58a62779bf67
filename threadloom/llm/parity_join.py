"""Jaccard join on word n-grams by parity sketches.

Every shingle flips one place of a sketch, so two sketches differ in at most as
many places as the sets have shingles in one but not the other: their distance
is a lower bound of the symmetric difference, which similarity bounds from
above by d = (100 - p) / (100 + p) * (|x| + |y|).

Two sketches serve.  A wide one has a 64-bit word per segment, into which each
of the segment's shingles is XORed; texts of one size band use the same number
of segments.  Linked texts differ in at most d segments, so among the d + 1
segments that come first in an order both share (most shingles first) one is
equal (pigeonhole, and the prefix filter on top of it): only those become join
keys.  A compact one has a bit per place and drops candidates by their Hamming
distance.  What remains is verified on the full sets.

Keys of all members of a bucket meet its most connected member first; links
merge, and only members outside that member's component meet the others."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm import textbuf
from threadloom.llm.components import components, extended
from threadloom.llm.near_dup import shingles
from threadloom.llm.store import Scratch

_U64 = np.uint64
_THIN = _U64(0x7A1D5C3B9E2F4601)
#: Words of sketches compared at once; pairs formed at once (those of one member at least).
_STEP_WORDS = 1 << 18
_STEP_PAIRS = 1 << 16


@dataclass(frozen=True)
class Settings:
    """Words of a shingle; similarity of a link in percent; growth of a size
    band in percent (more than 10,000 / ``percent``); segments for each that may
    differ, in tenths; members of a tile."""

    words: int = 4
    percent: int = 85
    band: int = 150
    room: int = 13
    tile: int = 512

    def bands(self, largest: int) -> np.ndarray:
        """Least sizes of the bands up to that of ``largest`` and two more."""
        out = [1]
        while out[-1] <= largest or len(out) < 3:
            out.append(max(out[-1] + 1, -(-out[-1] * self.band // 100)))
        return np.array([*out, -(-out[-1] * self.band // 100) + 1], np.int64)

    def differ(self, sizes):
        """Most shingles that only one of two linked sets has, by their sizes' sum."""
        return (100 - self.percent) * sizes // (100 + self.percent)

    def segments(self, band_end):
        """Segments of a band whose sets have fewer shingles than ``band_end``."""
        return (self.differ(2 * (band_end - 1)) + 1) * self.room // 10 + 1


def bits_of(size: np.ndarray) -> np.ndarray:
    """Places of the compact sketch: a power of two, 64 to 65,536."""
    return np.int64(1) << np.clip(np.ceil(np.log2(np.maximum(2 * size, 1))), 6, 16).astype(np.int64)


def sketch(sets: list[np.ndarray]) -> list[bytes]:
    """The compact parity sketch of each set; its first half XOR its second is the next shorter one."""
    size = np.array([len(s) for s in sets], np.int64)
    width = bits_of(size)
    base = np.append(0, np.cumsum(width))
    flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
    place = np.repeat(base[:-1], size) + (flat & np.repeat((width - 1).astype(np.uint64), size)).astype(np.int64)
    packed = np.packbits((np.bincount(place, minlength=base[-1]) & 1).astype(bool), bitorder="little").tobytes()
    return [packed[a:b] for a, b in zip((base[:-1] // 8).tolist(), (base[1:] // 8).tolist())]


def folded(sketches: list[bytes], width: int) -> np.ndarray:
    """Sketches, shortened to ``width`` bytes, as rows of uint64."""
    flat, off = packed(pa.array(sketches, pa.large_binary()))
    rows = [shortened(flat, off[k:k + 1], int(off[k + 1] - off[k]), width // 8) for k in range(len(sketches))]
    return np.concatenate([np.zeros((0, width // 8), np.uint64), *rows])


def packed(sketches: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The sketches' words behind one another, and their n+1 offsets."""
    raw, off = textbuf.buffers(sketches.cast(pa.large_binary()))
    return raw.view(np.uint64), off // 8


def shortened(flat: np.ndarray, start: np.ndarray, width: int, to: int) -> np.ndarray:
    """Sketches of ``width`` words, shortened to ``to`` words, as rows."""
    x = flat[start[:, None] + np.arange(width)]
    while x.shape[1] > to:
        x = x[:, :x.shape[1] // 2] ^ x[:, x.shape[1] // 2:]
    return x


def apart(x: tuple[np.ndarray, np.ndarray], i: np.ndarray, y: tuple[np.ndarray, np.ndarray], j: np.ndarray) -> np.ndarray:
    """Hamming distances of the packed sketches ``x[i]`` and ``y[j]``, the longer shortened to the other."""
    widths = np.diff(x[1])[i] << 16 | np.diff(y[1])[j]
    out = np.zeros(len(i), np.int64)
    for kind in np.unique(widths).tolist():
        at, p, q = np.flatnonzero(widths == kind), kind >> 16, kind & 0xFFFF
        step = max(1, _STEP_WORDS // max(p, q))
        for k in range(0, len(at), step):
            s = at[k:k + step]
            out[s] = np.bitwise_count(shortened(x[0], x[1][i[s]], p, min(p, q)) ^ shortened(y[0], y[1][j[s]], q, min(p, q))).sum(axis=1, dtype=np.int64)
    return out


def join_keys(sets: list[np.ndarray], how: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Join keys of the sets (ascending shingle hashes each) and their n+1
    offsets.  A set whose partners may be in the next band has keys there too."""
    size = np.array([len(s) for s in sets], np.int64)
    low = how.bands(int(size.max(initial=1)))
    band = np.searchsorted(low, size, "right") - 1
    most = size * 100 // how.percent  # shingles of the largest partner
    row, own_band, differ = [], [], []
    for step in (0, 1):
        b = band + step
        d = how.differ(size + np.minimum(most, low[b + 1] - 1))
        here = np.flatnonzero((size > 0) & (d > 0) & (most >= low[b]))
        row.append(here)
        own_band.append(b[here])
        differ.append(d[here])
    row, own_band, differ = np.concatenate(row), np.concatenate(own_band), np.concatenate(differ)
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(len(sets) + 1, np.int64)
    n = size[row]
    flat = np.concatenate([sets[r] for r in row.tolist()])
    segments = how.segments(low[own_band + 1])
    base = np.append(0, np.cumsum(segments))
    place = np.repeat(base[:-1], n) + ((flat >> _U64(32)) % np.repeat(segments.astype(np.uint64), n)).astype(np.int64)
    order = np.argsort(place)
    place = place[order]
    start = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    word = np.bitwise_xor.reduceat(textbuf.mix(flat ^ _U64(0x3C6EF372FE94F82B))[order], start)
    held = np.diff(np.append(start, len(place)))
    segment = place[start]
    owner = np.searchsorted(base, segment, "right") - 1
    salt = textbuf.mix(own_band.astype(np.uint64) << _U64(40))
    key = textbuf.mix(word ^ textbuf.mix(salt[owner] + (segment - base[owner]).astype(np.uint64)))
    first = np.searchsorted(owner, np.arange(len(row) + 1))  # segments that are not empty, by owner
    order = np.lexsort((key, -held, owner))
    key = key[order]
    rank = np.arange(len(key)) - np.repeat(first[:-1], np.diff(first))
    kept = rank <= np.repeat(differ, np.diff(first))
    keys, owners = [key[kept]], [owner[kept]]
    # sets with too few segments for the pigeonhole meet each other by their first shingles
    for r in np.flatnonzero(np.diff(first) <= differ).tolist():
        few = sets[row[r]][:differ[r] + 1]
        keys.append(textbuf.mix(few ^ _THIN ^ salt[r]))
        owners.append(np.full(len(few), r))
    keys, owners = np.concatenate(keys), row[np.concatenate(owners)]
    order = np.argsort(owners, kind="stable")
    return keys[order].view(np.int64), np.searchsorted(owners[order], np.arange(len(sets) + 1))


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sign(how: Settings):
    """Texts -> doc_id, n_shingles, digest of the set, compact sketch, join keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, text in textbuf.slices(batch, "text", 2 << 20):
                sets = list(shingles(*textbuf.buffers(text), how.words))
                keys, off = join_keys(sets, how)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(rows.schema.get_field_index("doc_id")), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()), pa.array(sketch(sets), pa.binary()),
                     pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(keys))],
                    ["doc_id", "n_shingles", "digest", "sketch", "keys"])
    return run


def _sets(how: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, text in textbuf.slices(batch, "text", 2 << 20):
                member, digest = (rows.column(rows.schema.get_field_index(c)) for c in ("member", "digest"))
                own, kept = [], []
                for k, s in enumerate(shingles(*textbuf.buffers(text), how.words)):
                    if len(s) and _digest(s) == digest[k].as_py():
                        own.append(s.tobytes())
                        kept.append(k)
                yield pa.RecordBatch.from_arrays([member.take(pa.array(kept, pa.int64())), pa.array(own, pa.binary())], ["member", "set"])
    return run


def _near(how: Settings):
    """Pairs with both sketches and sizes -> those whose distance allows a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y, m, n = batch.columns
            each = np.arange(len(a))
            kept = pa.array(np.flatnonzero(apart(packed(x), each, packed(y), each) <= how.differ(m.to_numpy() + n.to_numpy())))
            yield pa.RecordBatch.from_arrays([a.take(kept), b.take(kept)], ["a", "b"])
    return run


def _verify(how: Settings):
    """Pairs with both sets -> links: 100 |x & y| >= percent |x | y|."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = batch.columns
            kept = []
            for k in range(len(a)):
                p, q = (np.frombuffer(s[k].as_buffer(), np.uint64) for s in (x, y))
                both = np.sort(np.concatenate([p, q]))
                same = int((both[1:] == both[:-1]).sum())
                if 100 * same >= how.percent * (len(p) + len(q) - same):
                    kept.append(k)
            kept = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([a.take(kept), b.take(kept)], ["a", "b"])
    return run


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Runs of whole tiles of rows sorted by tile (key, i, j), with their n+1 offsets."""
    held, none = None, True
    for batch in batches:
        held = batch if none else pa.concat_batches([held, batch])
        none = False
        new = np.zeros(max(0, len(held) - 1), bool)
        for c in ("key", "i", "j"):
            x = held.column(held.schema.get_field_index(c)).to_numpy()
            new |= x[1:] != x[:-1]
        at = np.flatnonzero(new) + 1
        if len(at):  # the last tile may go on in the next batch
            yield held.slice(0, int(at[-1])), np.append(0, at)
            held = held.slice(int(at[-1]))
    if not none and len(held):
        yield held, np.array([0, len(held)])


def _meet(how: Settings):
    """Tiles, each of strays (``left``) and of any members of one bucket -> pairs of
    different components whose sketches allow a link, of two strays once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in _tiles(batches):
            member, comp, size, left, stray = (rows.column(rows.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
                                               for c in ("member", "comp", "n", "left", "stray"))
            words = packed(rows.column(rows.schema.get_field_index("sketch")))
            lefts, others = np.flatnonzero(left), np.flatnonzero(~left)
            tile = np.searchsorted(bounds, lefts, "right") - 1
            first, last = (np.searchsorted(others, bounds[tile + end]) for end in (0, 1))
            ends, at = np.cumsum(last - first), 0
            while at < len(lefts):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _STEP_PAIRS, "right")))
                held = last[at:to] - first[at:to]
                i = np.repeat(lefts[at:to], held)
                j = others[np.arange(len(i)) + np.repeat(first[at:to] - (np.cumsum(held) - held), held)]
                most = how.differ(size[i] + size[j])
                fits = np.flatnonzero((comp[i] != comp[j]) & (~stray[j] | (member[i] < member[j])) & (np.abs(size[i] - size[j]) <= most))
                i, j, at = i[fits], j[fits], to
                near = apart(words, i, words, j) <= most[fits]
                a, b = member[i[near]], member[j[near]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
    return run


def _both(pairs: DataFrame, side: DataFrame, *columns: str) -> DataFrame:
    """Pairs (a, b) with columns of both ends, named x.. and y.. in turn."""
    out = pairs
    for end, names in (("a", "xm"), ("b", "yn")):
        out = out.join(side.select(F.col("member").alias(end), *[F.col(c).alias(n) for c, n in zip(columns, names)]), end)
    return out.select("a", "b", *[n for two in zip("xm", "yn") for n in two][:2 * len(columns)])


def jaccard_components(docs: DataFrame, how: Settings = Settings(), doc_id: str = "doc_id", text: str = "text",
                       scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a set holds the
    distinct shingles, or the whole sequence if it is shorter.  Rows are linked
    when 100 |x & y| >= percent |x | y|; component_id is the smallest doc_id
    reachable by links.  A text that is null, empty or without words has no
    shingles and is linked with nothing: its component is its doc_id.  Repeated
    rows each keep their row; rows of one doc_id with different texts are linked
    only if their sets are.  A null doc_id is never a component_id: such a row takes
    that of the rows it is linked with, null if none has an id, and links of its
    own are not followed unless another row has the same set.  An
    empty table gives no rows; other columns of ``docs`` do not take part.
    """
    scratch = scratch or Scratch(docs.sparkSession, "parity-join")
    c = F.col
    texts = docs.select(c(doc_id).alias("doc_id"), F.coalesce(c(text), F.lit("")).alias("text"))
    signed = scratch.keep(texts.mapInArrow(
        _sign(how), "doc_id long, n_shingles long, digest binary, sketch binary, keys array<long>"), "signed")
    # equal sets fold to one member
    members = scratch.keep(
        signed.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"),
             F.first("keys").alias("keys")).withColumn("member", F.monotonically_increasing_id()), "members")
    rows = scratch.keep(signed.select("doc_id", "n_shingles", "digest"), "rows")
    scratch.drop("signed")

    # tables are written before a join, so that it is dealt out on its own and can split a hot key
    keys = members.select("member", F.explode("keys").alias("key"))
    shared = scratch.keep(keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "shared")
    buckets = scratch.keep(keys.join(shared, "key").select("key", "member", "members"), "buckets")
    weight = scratch.keep(buckets.groupBy("member").agg(F.sum("members").alias("weight")), "weight")
    pivots = scratch.keep(buckets.join(weight, "member").groupBy("key").agg(
        F.max(F.struct("weight", "member")).alias("pivot")).select("key", c("pivot.member").alias("pivot")), "pivots")
    sets = scratch.keep(
        texts.join(members.join(weight.select("member"), "member").select("doc_id", "member", "digest"), "doc_id")
        .select("member", "digest", "text").mapInArrow(_sets(how), "member long, set binary"), "sets")
    if not sets.groupBy("member").count().where("count > 1").isEmpty():  # repeated rows
        sets = scratch.keep(sets.dropDuplicates(["member"]), "sets-once")
    sketches = members.select("member", "sketch", "n")

    def links_among(pairs: DataFrame, name: str) -> DataFrame:
        return scratch.keep(_both(pairs, sets, "set").mapInArrow(_verify(how), "a long, b long"), name)

    # every member meets its bucket's pivot
    of_pivot = scratch.keep(buckets.join(pivots, "key"), "of-pivot")
    met = of_pivot.where("member <> pivot").select(F.least("member", "pivot").alias("a"), F.greatest("member", "pivot").alias("b"))
    near = scratch.keep(_both(met.distinct(), sketches, "sketch", "n").mapInArrow(_near(how), "a long, b long"), "near")
    links = links_among(near, "links")
    merged = components(links, scratch, "merged")

    # members outside the pivot's component meet the rest of their bucket
    placed = (of_pivot.join(merged.select(c("u").alias("member"), c("v").alias("own")), "member", "left")
              .join(merged.select(c("u").alias("pivot"), c("v").alias("main")), "pivot", "left")
              .select("key", "member", "members", F.coalesce("own", "member").alias("comp"), F.coalesce("main", "pivot").alias("main")))
    placed = scratch.keep(placed.withColumn("stray", c("comp") != c("main")), "placed")
    mixed = scratch.keep(placed.groupBy("key").agg(F.count_if("stray").alias("strays")).where("strays > 0"), "mixed")
    open_ = placed.join(mixed, "key").join(sketches, "member")
    tiles = lambda n: F.ceil(n / F.lit(how.tile)).cast("int")
    mine = lambda n: F.pmod(F.xxhash64("member"), tiles(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), tiles(n) - 1))
    body = ("key", "member", "comp", "stray", "sketch", "n")
    tiled = (open_.where("stray").select(*body, F.lit(True).alias("left"), mine(c("strays")).alias("i"), each(c("members")).alias("j"))
             .union(open_.select(*body, F.lit(False).alias("left"), each(c("strays")).alias("i"), mine(c("members")).alias("j"))))
    tiled = tiled.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    more = tiled.mapInArrow(_meet(how), "a long, b long").distinct()
    more = scratch.keep(more.join(near, ["a", "b"], "left_anti"), "more")
    final = extended(merged, links_among(more, "late"), scratch, "final")

    root = members.select("digest", "doc_id", "member").join(
        final.select(c("u").alias("member"), c("v")), "member", "left").select("digest", "doc_id", F.coalesce("v", "member").alias("root"))
    root = scratch.keep(root, "root")
    least = scratch.keep(root.groupBy("root").agg(F.min("doc_id").alias("component")), "least")
    group = scratch.keep(root.select("digest", "root").join(least, "root").select("digest", "component"), "group")
    own = F.when(c("digest").isNull(), c("doc_id")).otherwise(c("component"))
    return rows.join(group, "digest", "left").select("doc_id", "n_shingles", own.alias("component_id"))
