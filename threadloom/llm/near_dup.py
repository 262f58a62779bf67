"""Near duplicates: MinHash bands propose, sequential Bayesian comparison of
signature batches prunes, the full shingle sets decide.

Texts with one and the same shingle set fold to a representative first.  In a
bucket (representatives agreeing on a band) not all pairs are formed: every
member meets one pivot, the links found so merge into components, and only
members outside their bucket's main component then meet the others, in tiles of
bounded size that compare signatures and emit survivors alone."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm import textbuf
from threadloom.llm.components import components
from threadloom.llm.store import Scratch

_U64 = np.uint64


@dataclass(frozen=True)
class Settings:
    """Words of a shingle; similarity of a link in percent; bands and rows of the
    signature; further places of one byte for comparing only; posterior
    probability below which a pair is given up; places compared at a time, of
    the signature and of the others; members of a tile.

    A pair at the similarity itself is in no common bucket with probability
    (1 - 0.75^4)^32, about 5 in a million, and given up with ``miss`` at most
    per batch.
    """

    words: int = 5
    percent: int = 75
    bands: int = 32
    rows: int = 4
    fine: int = 1024
    miss: float = 1e-4
    batch: int = 32
    fine_batch: int = 128
    tile: int = 256

    @property
    def places(self) -> int:
        return self.bands * self.rows

    @property
    def steps(self) -> list[int]:
        """Places compared by the end of each batch."""
        coarse = {*range(self.batch, self.places + 1, self.batch), self.places}
        return sorted(coarse | {self.places + n for n in (*range(self.fine_batch, self.fine + 1, self.fine_batch), self.fine)})


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Each text's distinct shingle hashes, ascending: of ``width`` consecutive
    words, or of the whole sequence if it is shorter."""
    words, off = textbuf.word_hashes(data, offsets)
    factor = textbuf.stream(31, width) | _U64(1)
    run = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for i in range(width):
        run += words[i:i + len(run)] * factor[i]
    run = textbuf.mix(run)
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        if b - a >= width:
            yield np.unique(run[a:b - width + 1])
        elif b > a:
            short = np.add.reduce(words[a:b] * factor[:b - a]) + _U64(b - a)
            yield textbuf.mix(np.array([short], np.uint64) ^ _U64(0x5DEECE66D))
        else:
            yield np.zeros(0, np.uint64)


def signature(hashes: np.ndarray, places: int, seed_of: int = 32) -> np.ndarray:
    """MinHash: the least value of each place's permutation of 32-bit values."""
    seed = textbuf.stream(seed_of, 2 * places)
    flip, factor = (seed[:places] >> _U64(32)).astype(np.uint32), (seed[places:] >> _U64(32)).astype(np.uint32) | np.uint32(1)
    short = (hashes >> _U64(32)).astype(np.uint32)
    least = np.full(places, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 4096):
        mixed = (short[at:at + 4096][None, :] ^ flip[:, None]) * factor[:, None]
        np.minimum(least, mixed.min(axis=1), out=least)
    return least


def _digest(shingle_set: bytes) -> bytes:
    return hashlib.blake2b(shingle_set, digest_size=16).digest()


def sketch(hashes: np.ndarray, how: Settings) -> bytes:
    """The signature and the low bytes of the further places."""
    return signature(hashes, how.places).tobytes() + signature(hashes, how.fine, 35).astype(np.uint8).tobytes()


def sketches(column: pa.Array, how: Settings) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 4 * how.places + how.fine)
    return np.ascontiguousarray(raw[:, :4 * how.places]).view(np.uint32), raw[:, 4 * how.places:]


def _sign(how: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, text in textbuf.slices(batch, "text", 2 << 20):
                size, digest, sign = [], [], []
                for s in shingles(*textbuf.buffers(text), how.words):
                    size.append(len(s))
                    digest.append(_digest(s.tobytes()) if len(s) else None)
                    sign.append(signature(s, how.places).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(rows.schema.get_field_index(c)) for c in ("doc_id", "mark")), pa.array(size, pa.int64()),
                     pa.array(digest, pa.binary()), pa.array(sign, pa.binary())],
                    ["doc_id", "mark", "n_shingles", "digest", "sign"])
    return run


def band_keys(bands: np.ndarray, how: Settings) -> np.ndarray:
    """Bucket keys of signatures given as (text, band, row)."""
    factor = textbuf.stream(33, how.rows) | _U64(1)
    return textbuf.mix((bands.astype(np.uint64) * factor).sum(axis=2, dtype=np.uint64) + textbuf.stream(34, how.bands))


def _band_keys(how: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, sign = batch.columns
            raw = np.frombuffer(b"".join(sign.to_pylist()), np.uint32).reshape(len(rep), how.bands, how.rows)
            key = band_keys(raw, how)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(rep.to_numpy(), how.bands)), pa.array(key.ravel().view(np.int64))], ["rep", "key"])
    return run


def least_matches(how: Settings) -> list[tuple[int, int]]:
    """(places compared, matches needed).  With a uniform prior and m of n places
    equal, similarity is Beta(m + 1, n - m + 1); it reaches t with the
    probability that at most m of n + 1 trials of chance t succeed."""
    t, out = how.percent / 100, []
    for n in how.steps:
        tail, need = 0.0, 0
        for m in range(n + 1):
            tail += exp(lgamma(n + 2) - lgamma(m + 1) - lgamma(n + 2 - m) + m * log(t) + (n + 1 - m) * log(1 - t))
            if tail >= how.miss:
                need = m
                break
        out.append((n, need))
    return out


def survivors(left, right, i: np.ndarray, j: np.ndarray, steps) -> np.ndarray:
    """Positions of the pairs (i, j) of two lists of sketches that no batch of
    places gives up.  (Equal low bytes of different values only add survivors.)"""
    alive = np.arange(len(i))
    matches = np.zeros(len(i), np.int32)
    done, coarse = 0, left[0].shape[1]
    for n, need in steps:
        if not len(alive):
            break
        fine = int(done >= coarse)
        places = slice(done - fine * coarse, n - fine * coarse)
        x, y = left[fine][:, places], right[fine][:, places]
        for at in range(0, len(alive), 1 << 15):
            part = alive[at:at + (1 << 15)]
            matches[part] += (x[i[part]] == y[j[part]]).sum(axis=1, dtype=np.int32)
        alive, done = alive[matches[alive] >= need], n
    return alive


def _prune(how: Settings):
    """Pairs with both sketches -> surviving pairs."""
    steps = least_matches(how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = batch.columns
            all_ = np.arange(len(a))
            kept = pa.array(survivors(sketches(x, how), sketches(y, how), all_, all_, steps))
            yield pa.RecordBatch.from_arrays([a.take(kept), b.take(kept)], ["a", "b"])
    return run


def _meet(how: Settings):
    """A tile of stragglers and a tile of any members of one bucket -> surviving
    pairs of different components.  Such a pair meets in every bucket it shares;
    it is emitted by the first band alone, and of two stragglers once."""
    steps = least_matches(how)

    def run(key: tuple[pa.Scalar, ...], got: pa.Table) -> pa.Table:
        got = got.combine_chunks()
        rep, comp = got.column("rep").to_numpy(), got.column("comp").to_numpy()
        astray = got.column("astray").to_numpy().astype(bool)
        both = sketches(got.column("sketch"), how)
        x, y = np.flatnonzero(astray), np.flatnonzero(~astray)
        i, j = np.repeat(x, len(y)), np.tile(y, len(x))
        lost = got.column("lost").to_numpy().astype(bool)
        open_ = (comp[i] != comp[j]) & (~lost[j] | (rep[i] < rep[j]))
        i, j = i[open_], j[open_]
        kept = survivors(both, both, i, j, steps)
        i, j = i[kept], j[kept]
        bands = both[0].reshape(len(rep), how.bands, how.rows)
        here = int(np.argmax(band_keys(bands[:1], how)[0].view(np.int64) == key[0].as_py()))
        first = np.array([(bands[p] == bands[q]).all(axis=1).argmax() == here for p, q in zip(i, j)], dtype=bool)
        a, b = rep[i[first]], rep[j[first]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})
    return run


def _confirm(how: Settings):
    """Pairs with both shingle sets -> links: 100 |x & y| >= percent |x | y|."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, sa, sb = batch.columns
            kept = []
            for k in range(len(a)):
                x, y = (np.frombuffer(s[k].as_buffer(), np.uint64) for s in (sa, sb))
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= how.percent * (len(x) + len(y) - both):
                    kept.append(k)
            kept = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([a.take(kept), b.take(kept)], ["a", "b"])
    return run


def _sets(how: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, text in textbuf.slices(batch, "text", 2 << 20):
                found = list(shingles(*textbuf.buffers(text), how.words))
                sets = [s.tobytes() for s in found]
                rep, digest = (rows.column(rows.schema.get_field_index(c)) for c in ("rep", "digest"))
                own = [k for k, x in enumerate(sets) if _digest(x) == digest[k].as_py()]
                yield pa.RecordBatch.from_arrays(
                    [rep.take(pa.array(own, pa.int64())), pa.array([sets[k] for k in own], pa.binary()),
                     pa.array([sketch(found[k], how) for k in own], pa.binary())], ["rep", "shingles", "sketch"])
    return run


def _with_both(pairs: DataFrame, side: DataFrame, column: str) -> DataFrame:
    """Pairs (a, b) with ``column`` of both ends."""
    x = side.select(F.col("rep").alias("a"), F.col(column).alias("x"))
    y = side.select(F.col("rep").alias("b"), F.col(column).alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")


def near_duplicates(docs: DataFrame, how: Settings = Settings(), doc_id: str = "doc_id", text: str = "text",
                    scratch: Scratch | None = None, mark: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept (with
    ``mark``, a binary column over ``docs``, also ``mark`` and ``class_id``, equal for the
    rows of one component and null for rows without shingles or, among their equals, without any id).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.  Documents are linked
    when 100 |x & y| >= percent |x | y| of their shingle sets; component_id is
    the smallest doc_id reachable.  A text that is null, empty or without words
    has no shingles and is linked with nothing: its component is itself.  A row
    with a null doc_id takes the component of its shingle set's other rows (null if there
    is none) and is not kept.  Repeated rows each keep their row; rows of one doc_id
    with different texts are linked only if their sets are, so one may be kept and the
    other not; an empty table gives no rows; other columns of ``docs`` do not take part.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "near-dup")
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                        (F.lit(None).cast("binary") if mark is None else mark).alias("mark"))
    signed = scratch.keep(
        texts.mapInArrow(_sign(how), "doc_id long, mark binary, n_shingles long, digest binary, sign binary"), "signed")
    # equal shingle sets fold: one representative each, with a number of its own, since a doc_id may have
    # several texts (of one digest all signatures are the same)
    reps = scratch.keep(
        signed.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"), F.first("sign").alias("sign"))
        .withColumn("rep", F.monotonically_increasing_id()), "reps")
    rows = scratch.keep(signed.select("doc_id", "mark", "n_shingles", "digest"), "rows")
    scratch.drop("signed")

    keys = reps.select("rep", "sign").mapInArrow(_band_keys(how), "rep long, key long")
    # a bucket's pivot is its least member in an order that differs from bucket to bucket
    # (written before a join, so that the join is dealt out on its own and can split a hot bucket)
    shared = scratch.keep(keys.groupBy("key").agg(F.count(F.lit(1)).alias("members"),
                                      F.min(F.col("rep").bitwiseXOR(F.col("key"))).alias("least"))
              .where("members > 1")
              .select("key", "members", F.col("least").bitwiseXOR(F.col("key")).alias("pivot")), "shared")
    buckets = scratch.keep(keys.join(shared, "key").select("key", "rep", "members", "pivot"), "buckets")
    in_buckets = buckets.select("rep").distinct()
    sets = scratch.keep(
        texts.join(reps.join(in_buckets, "rep").select("doc_id", "rep", "digest"), "doc_id")
        .select("rep", "digest", "text").mapInArrow(_sets(how), "rep long, shingles binary, sketch binary"), "sets")
    if not sets.groupBy("rep").count().where("count > 1").isEmpty():
        sets = scratch.keep(sets.dropDuplicates(["rep"]), "sets-once")  # repeated rows

    # every member meets its bucket's pivot
    met = buckets.where("rep <> pivot").select(
        F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()
    tried = scratch.keep(_with_both(met, sets, "sketch").mapInArrow(_prune(how), "a long, b long"), "tried")
    links = scratch.keep(_with_both(tried, sets, "shingles").mapInArrow(_confirm(how), "a long, b long"), "links")
    merged = components(links, scratch, "merged")

    # members outside the pivot's component meet the rest of their bucket
    placed = (buckets.join(merged.select(F.col("u").alias("rep"), F.col("v").alias("c")), "rep", "left")
              .join(merged.select(F.col("u").alias("pivot"), F.col("v").alias("main")), "pivot", "left")
              .select("key", "rep", "members", F.coalesce("c", "rep").alias("comp"),
                      F.coalesce("main", "pivot").alias("main")))
    placed = scratch.keep(placed.withColumn("astray", F.col("comp") != F.col("main")), "placed")
    mixed = scratch.keep(placed.groupBy("key").agg(F.count_if("astray").alias("strays")).where("strays > 0"), "mixed")
    open_ = placed.join(mixed, "key").join(sets.select("rep", "sketch"), "rep")
    tiles = lambda n: F.ceil(n / F.lit(how.tile)).cast("int")
    mine = lambda n: F.pmod(F.xxhash64("rep"), tiles(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), tiles(n) - 1))
    members, strays = F.col("members"), F.col("strays")
    body = ("key", "rep", "comp", "sketch")
    rows_of_tile = (open_.where("astray").select(*body, F.lit(True).alias("astray"), F.lit(True).alias("lost"), mine(strays).alias("i"),
                                                 each(members).alias("j"))
                    .union(open_.select(*body, F.lit(False).alias("astray"), F.col("astray").alias("lost"), each(strays).alias("i"),
                                        mine(members).alias("j"))))
    more = rows_of_tile.groupBy("key", "i", "j").applyInArrow(_meet(how), "a long, b long").distinct()
    more = scratch.keep(more.join(tried, ["a", "b"], "left_anti"), "more")
    late = scratch.keep(_with_both(more, sets, "shingles").mapInArrow(_confirm(how), "a long, b long"), "late")
    final = components(links.union(late), scratch, "final")

    classes = scratch.keep(
        reps.select("digest", "doc_id", "rep").join(final.select(F.col("u").alias("rep"), "v"), "rep", "left")
        .select("digest", "doc_id", F.coalesce("v", "rep").alias("class_id")), "classes")
    least = scratch.keep(classes.groupBy("class_id").agg(F.min("doc_id").alias("component")), "least")
    group = scratch.keep(classes.select("digest", "class_id").join(least, "class_id"), "group")
    own = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return (rows.join(group, "digest", "left")
            .select("doc_id", "n_shingles", own.alias("component_id"),
                    F.coalesce(F.col("doc_id") == own, F.lit(False)).alias("kept"),
                    *([] if mark is None else ["mark", "class_id"])))
