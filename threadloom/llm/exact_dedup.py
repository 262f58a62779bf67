"""Exact duplicates by composable polynomial fingerprints.

A text is hashed in chunks; the hash of a concatenation is
``H(ab) = H(a) * B^len(b) + H(b)``, so chunk hashes are formed independently
and combined by length-shifted arithmetic.  Texts of equal fingerprint and
length are then compared chunk by chunk: equal chunks fold together in an
aggregate with map-side combine, and a chunk position with two different
contents exposes a collision, whose texts are told apart by their chunks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm import textbuf
from threadloom.llm.store import Scratch, only_wanted

CHUNK_BYTES = 1 << 16
#: Bytes hashed, or handed on as chunks, at once.
BLOCK_BYTES = 1 << 20


@dataclass(frozen=True)
class Fingerprint:
    """Two polynomial hashes over primes below 2^31, 62 bits together."""

    primes: tuple[int, int] = (2147483647, 2147483629)
    bases: tuple[int, int] = (1103515245, 1664525)
    chunk: int = CHUNK_BYTES

    def combine(self, left: tuple[int, int], right: tuple[int, int], right_len: int) -> tuple[int, int]:
        """The fingerprint of a concatenation."""
        return tuple((a * pow(b, right_len, p) + c) % p
                     for a, c, p, b in zip(left, right, self.primes, self.bases, strict=True))

    def powers(self, base: int, prime: int, n: int) -> np.ndarray:
        out = np.ones(max(1, n), np.uint64)
        known = 1
        while known < n:  # doubling: B^(i+known) = B^i * B^known
            step = min(known, n - known)
            out[known:known + step] = out[:step] * np.uint64(pow(base, known, prime)) % np.uint64(prime)
            known += step
        return out


def chunk_bounds(offsets: np.ndarray, chunk: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text row, start, end) of every chunk; an empty text has none."""
    size = np.diff(offsets)
    n = -(-size // chunk)
    row = np.repeat(np.arange(len(size)), n)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = offsets[row] + nth * chunk
    return row, start, np.minimum(start + chunk, offsets[row + 1])


def runs(start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of neighbouring chunks with at most ``BLOCK_BYTES`` (or one chunk)."""
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + BLOCK_BYTES, "right")))
        yield at, to
        at = to


def fingerprints(data: np.ndarray, offsets: np.ndarray, how: Fingerprint) -> np.ndarray:
    """The 62-bit fingerprint of every text; 0 for an empty one.  Chunks are
    hashed a block at a time, so memory beside the texts does not grow with them."""
    row, start, end = chunk_bounds(offsets, how.chunk)
    out = np.zeros(len(offsets) - 1, np.int64)
    if not len(row):
        return out
    behind = offsets[row + 1] - end  # bytes of the text after the chunk
    heads = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    for prime, base in zip(how.primes, how.bases, strict=True):
        p = np.uint64(prime)
        small = how.powers(base, prime, how.chunk)
        large = how.powers(pow(base, how.chunk, prime), prime, int(behind.max()) // how.chunk + 1)
        own = np.empty(len(row), np.uint64)
        for i, j in runs(start, end):
            lo, hi = start[i], end[j - 1]
            exponent = np.repeat(end[i:j] - lo, end[i:j] - start[i:j]) - 1 - np.arange(hi - lo)
            own[i:j] = np.add.reduceat((data[lo:hi] + np.uint64(1)) * small[exponent], start[i:j] - lo) % p
        shift = large[behind // how.chunk] * small[behind % how.chunk] % p
        whole = np.add.reduceat(own * shift % p, heads) % p
        out[row[heads]] = (out[row[heads]] << 31) | whole.astype(np.int64)
    return out


def _digest_rows(how: Fingerprint):
    """The rows' columns, with length, fingerprint and SHA-256 of their text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, text in textbuf.slices(batch, "text"):
                data, off = textbuf.buffers(text)
                raw = memoryview(data)
                sha = [hashlib.sha256(raw[a:b]).digest() for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(np.diff(off)), pa.array(fingerprints(data, off, how)),
                     pa.array(sha, pa.binary())], [*part.schema.names, "n_bytes", "fp", "sha"])
    return run


def _narrow(run):
    """``run`` without the text column."""
    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield batch.select([c for c in batch.schema.names if c != "text"])
    return narrow


def _chunk_rows(how: Fingerprint, carried: tuple[str, ...] = ()):
    """A row a chunk: fp and n_bytes of its text, its place and its bytes, and
    the ``carried`` columns of the text's row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, text in textbuf.slices(batch, "text"):
                data, off = textbuf.buffers(text)
                row, start, end = chunk_bounds(off, how.chunk)
                fp, size = fingerprints(data, off, how), np.diff(off)
                for i, j in runs(start, end):
                    lo, at = start[i], row[i:j]
                    bounds = np.append(start[i:j], end[j - 1]) - lo
                    content = pa.Array.from_buffers(
                        pa.binary(), j - i, [None, pa.py_buffer(bounds.astype(np.int32)),
                                             pa.py_buffer(np.ascontiguousarray(data[lo:end[j - 1]]))])
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(part.schema.get_field_index(c)).take(pa.array(at)) for c in carried),
                         pa.array(fp[at]), pa.array(size[at]), pa.array((start[i:j] - off[at]) // how.chunk), content],
                        [*carried, "fp", "n_bytes", "nth", "content"])
    return run


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))


def collisions(docs: DataFrame, how: Fingerprint = Fingerprint(), text: str = "text") -> DataFrame:
    """(fp, n_bytes) shared by different texts, found by chunkwise comparison.
    Copies fold in the map-side combine, so a group holding most rows is one
    row per chunk and map task when it is shuffled."""
    return (_texts(docs, text)
            .mapInArrow(_chunk_rows(how), "fp long, n_bytes long, nth long, content binary")
            .groupBy("fp", "n_bytes", "nth", "content").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("fp", "n_bytes", "nth").agg(F.count(F.lit(1)).alias("variants"))
            .where("variants > 1").select("fp", "n_bytes").distinct())


def told_apart(suspects: DataFrame, how: Fingerprint, scratch: Scratch) -> DataFrame:
    """``suspects`` (rid, text, fp, n_bytes, ...; a written table) without the
    text, plus ``variant``: the same for rows of one text, different for others.
    Every chunk is named by the least rid holding it; the names of a text's
    chunks, in order, are its variant."""
    parts = suspects.select("rid", "text").mapInArrow(
        _chunk_rows(how, ("rid",)), "rid long, fp long, n_bytes long, nth long, content binary")
    place = ["fp", "n_bytes", "nth", "content"]
    names = scratch.keep(parts.groupBy(*place).agg(F.min("rid").alias("name")), "chunk-names")
    variants = (parts.join(names, place).groupBy("rid")
                .agg(F.sort_array(F.collect_list(F.struct("nth", "name"))).alias("variant")))  # a text's chunks
    return suspects.drop("text").join(variants, "rid")


def _grouped(rows: DataFrame, key: list[str], scratch: Scratch, table: str) -> DataFrame:
    """Rows of each key, as written: the last row and how many there are."""
    return scratch.keep(rows.groupBy(*key).agg(
        F.max(F.struct("doc_id", "rid")).alias("last"), F.count(F.lit(1)).alias("group_size")), table)


def _judged(rows: DataFrame, groups: DataFrame, key: list[str]) -> DataFrame:
    # (groups are written, so that this join is dealt out on its own and can split a hot group)
    return rows.join(groups, key).select(
        "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("last.rid")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def exact_dedup(docs: DataFrame, how: Fingerprint = Fingerprint(), doc_id: str = "doc_id", text: str = "text",
                scratch: Scratch | None = None, bound: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical byte for byte; null counts as empty, and
    empty texts are one group.  The row with the largest doc_id stays; among
    repeated rows with that doc_id exactly one stays.  A null doc_id is smaller
    than any other (keep_id is null only if the whole group has none).  An
    empty table gives no rows; other columns of ``docs`` do not take part.

    Only texts whose fingerprint repeats are compared: a 64-bit key of their
    content, broadcast if few enough (``bound``), keeps the others at the scan.
    Different texts of one fingerprint are told apart by their chunks.
    """
    scratch = scratch or Scratch(docs.sparkSession, "exact-dedup")
    rows = (docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .withColumn("mark", F.xxhash64("text")))
    found = "n_bytes long, fp long, sha binary"
    digests = scratch.keep(
        rows.mapInArrow(_narrow(_digest_rows(how)), f"doc_id long, mark long, {found}")
        .withColumn("rid", F.monotonically_increasing_id()), "digests")
    key = ["fp", "n_bytes"]
    groups = _grouped(digests, key, scratch, "groups")
    repeated = groups.where("group_size > 1 AND n_bytes > 0").select(*key)
    marks = scratch.keep(digests.join(repeated, key, "left_semi").select("mark").distinct(), "marks")
    alike = only_wanted(rows, marks, "mark", bound)
    mixed = scratch.keep(collisions(alike, how), "collisions")
    if mixed.isEmpty():
        return _judged(digests, groups, key)
    suspects = scratch.keep(
        alike.select("doc_id", "text").mapInArrow(_digest_rows(how), f"doc_id long, text string, {found}")
        .join(mixed, key, "left_semi").withColumn("rid", F.monotonically_increasing_id()), "suspects")
    apart = scratch.keep(told_apart(suspects, how, scratch), "apart")
    exact = [*key, "variant"]
    return (_judged(digests.join(mixed, key, "left_anti"), groups, key)
            .unionByName(_judged(apart, _grouped(apart, exact, scratch, "variants"), exact)))
