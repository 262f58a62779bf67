"""Alignment of two tokenizers over a corpus, and how often their ids meet.

Byte offsets where tokens of both end cut a text into groups; tokens of one
group are linked.  The distinct (A id, B id) pairs of the corpus are indexed by
a minimal perfect hash; every task counts its documents into a dense vector by
that index, the vectors are summed in a tree, and a second pass aligns the
documents anew and looks the counts up.  Texts are encoded once and kept as ids.

Both tokenizers are cut at every space that follows a character which is no
white space: neither has a token across such a place, so the fragment between
two of them has an alignment of its own; each distinct one is aligned once a slice."""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm import textbuf
from threadloom.llm.bpe import byte_alphabet
from threadloom.llm.fragments import TokenizerFile
from threadloom.llm.perfect_hash import PairIndex, build_shard, shard_hash
from threadloom.llm.store import Scratch

#: Fragments a worker remembers at most; the rest is aligned again when met.
MEMO_FRAGMENTS = 150_000
#: Bytes of texts aligned at once, and of written groups hashed at once.
SLICE_BYTES, WRITTEN_BYTES = 3 << 20, 4 << 20
#: Links of a group that are written out; links, and fragments of texts, held in numbers at once.
LINKS_AT_ONCE, PART_LINKS, PART_FRAGMENTS = 256, 1 << 17, 1 << 16
#: Slices of a written file, which a task takes up as a whole.
FILE_SLICES = 4
#: Pairs of a shard of the hash, on average.
SHARD_PAIRS = 4096
#: Entries of a piece of a count vector; vectors summed by one task.
CHUNK, FAN_IN = 1 << 16, 16
#: Pairs indexed in a worker's memory at once; more are taken in turns.
PAIRS_AT_ONCE = 4_000_000

_SPACE_MARK = "▁"


@dataclass(frozen=True)
class PieceModel:
    """A ``sentencepiece`` model by content.  For models that change no
    character but the space (identity normaliser, byte fallback), put a space
    first and have no piece with a space after another character."""

    content: bytes

    @classmethod
    def read(cls, path: str) -> "PieceModel":
        with open(path, "rb") as f:
            return cls(f.read())


@dataclass
class Coded:
    """Texts as numbers: the token ids of each distinct fragment on both sides
    (with the n+1 offsets), the fragment at every occurrence, and the n+1
    occurrence offsets of the texts."""

    a: np.ndarray
    a_off: np.ndarray
    b: np.ndarray
    b_off: np.ndarray
    at: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        """Distinct fragments."""
        return len(self.a_off) - 1

    def per_text(self, of_fragment: np.ndarray) -> np.ndarray:
        """Sums over each text's fragments."""
        total = np.append(0, np.cumsum(of_fragment[self.at], dtype=np.int64))
        return total[self.first[1:]] - total[self.first[:-1]]


@dataclass
class Groups:
    """The alignment of a ``Coded``'s fragments: of each group the fragment, the
    first token on both sides and the tokens on both sides."""

    fragment: np.ndarray
    start_a: np.ndarray
    start_b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray

    def of_fragments(self, values: np.ndarray, fragments: int) -> np.ndarray:
        """Sums of the groups' values over each fragment."""
        total = np.append(0, np.cumsum(values, dtype=np.int64))
        at = np.searchsorted(self.fragment, np.arange(fragments + 1))
        return total[at[1:]] - total[at[:-1]]


class Aligner:
    """Both tokenizers in a worker.  A pair's key is A id * ``width`` + B id."""

    def __init__(self, a: str, b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        import json

        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        alphabet, vocabulary = byte_alphabet(), json.loads(a)["model"]["vocab"]
        a_bytes = [b""] * (1 + max(vocabulary.values()))
        for t, i in vocabulary.items():
            if all(c in alphabet for c in t):
                a_bytes[i] = bytes(alphabet[c] for c in t)
        self.b = SentencePieceProcessor(model_proto=b)
        self.width = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.width)]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE_MARK, " ").encode()
                   for i, p in enumerate(pieces)]
        self.mark = pieces.index(_SPACE_MARK)
        self.bytes_of = [pa.array(x, pa.large_binary()) for x in (a_bytes, b_bytes)]
        self.length_of = [np.array([len(t) for t in x], np.int64) for x in (a_bytes, b_bytes)]
        ids = range(max(len(a_bytes), len(b_bytes)))
        self.ids = len(ids)
        self.written = pa.array([f"{mark}{i}".encode() for mark in ",;|" for i in ids], pa.large_binary())
        self.memo: dict[str, tuple[bytes, bytes]] = {}

    def encode(self, fragments: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of both sides, as little-endian uint32, of texts that begin with a space."""
        out = list(map(self.memo.get, fragments))
        new = [f for f, known in zip(fragments, out) if known is None]
        fresh: dict[str, tuple[bytes, bytes]] = {}
        for at in range(0, len(new), 4096):
            part = new[at:at + 4096]
            left = self.a.encode_batch_fast(part, add_special_tokens=False)
            right = self.b.encode([x[1:] for x in part], num_threads=1)
            for x, e, ids in zip(part, left, right, strict=True):
                fresh[x] = array("I", e.ids).tobytes(), array("I", ids if x != " " else [self.mark]).tobytes()
        room = MEMO_FRAGMENTS - len(self.memo)
        if room > 0:
            self.memo.update((f, fresh[f]) for f in new[:room])
        return [fresh[f] if known is None else known for f, known in zip(fragments, out)]

    def code(self, texts: pa.Array) -> Coded:
        """Encode whole texts; one whose bytes a side does not give back has no fragments."""
        data, off = space_first(*textbuf.buffers(texts))
        bounds = cuts(data, off) if len(data) else np.zeros(1, np.int64)
        parts = pa.LargeStringArray.from_buffers(
            len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
        coded = pc.dictionary_encode(parts)
        both = self.encode(coded.dictionary.to_pylist())
        sides = []
        for side in (0, 1):
            ids = np.frombuffer(b"".join(x[side] for x in both), "<u4").astype(np.int64)
            sides += [ids, np.append(0, np.cumsum(np.array([len(x[side]) // 4 for x in both], np.int64)))]
        out = Coded(*sides, coded.indices.to_numpy().astype(np.int64), np.searchsorted(bounds, off))
        return self.without_broken(out, coded.dictionary)

    def without_broken(self, c: Coded, fragments: pa.Array) -> Coded:
        """(No token is longer than what it stands for, so one fragment that is
        not given back shortens its whole text.)"""
        raw, off = textbuf.buffers(fragments)
        broken = np.zeros(len(c), dtype=bool)
        for side, (ids, at) in enumerate(((c.a, c.a_off), (c.b, c.b_off))):
            length = np.append(0, np.cumsum(self.length_of[side][ids]))
            broken |= np.diff(length[at]) != np.diff(off)
        if not broken.any():
            for side, ids in enumerate((c.a, c.b)):
                back, _ = textbuf.buffers(pc.take(self.bytes_of[side], pa.array(ids)))
                differ = np.flatnonzero(back != raw)
                broken[np.searchsorted(off, differ, "right") - 1] = True
        if not broken.any():
            return c
        bad = np.append(0, np.cumsum(broken[c.at]))
        whole = bad[c.first[1:]] == bad[c.first[:-1]]
        size = np.diff(c.first)
        used, at = np.unique(c.at[np.repeat(whole, size)], return_inverse=True)
        pick = [(ids[np.repeat(np.isin(np.arange(len(c)), used), np.diff(x))], np.append(0, np.cumsum(np.diff(x)[used])))
                for ids, x in ((c.a, c.a_off), (c.b, c.b_off))]
        rest = Coded(*pick[0], *pick[1], at, np.append(0, np.cumsum(np.where(whole, size, 0))))
        return self.without_broken(rest, fragments.take(pa.array(used)))

    def align(self, c: Coded) -> Groups:
        """Cut at the byte offsets where tokens of both sides end."""
        ends = [np.cumsum(self.length_of[side][ids]) for side, ids in enumerate((c.a, c.b))]
        size = int(ends[0][-1]) + 1 if len(c.a) else 1
        common = np.ones(size, dtype=bool)
        last = []
        for e in ends:
            here = np.zeros(size, dtype=bool)
            here[e] = True
            common &= here
        for e in ends:
            last.append(np.flatnonzero(common[e]))
        starts = [np.append(0, x[:-1] + 1) if len(x) else x for x in last]
        fragment = np.searchsorted(c.a_off, starts[0], "right") - 1
        return Groups(fragment, *starts, *(x + 1 - s for x, s in zip(last, starts)))

    def pairs(self, c: Coded, g: Groups) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each fragment the distinct pair keys and how often each is linked,
        and the n+1 offsets of the fragments."""
        first = np.searchsorted(g.fragment, np.arange(len(c) + 1))  # group of each fragment
        ends = np.append(0, np.cumsum(np.minimum(g.n_a * g.n_b, LINKS_AT_ONCE + 1)))[first]
        parts, lo = [], 0
        while lo < len(c):  # whole fragments, about PART_LINKS of their links at once
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + PART_LINKS, "right")) - 1)
            keys, times, n = self._pairs(c, g, lo, first[lo], first[hi])
            parts.append((keys, times, np.bincount(n, minlength=hi - lo)))
            lo = hi
        key, times, n = (np.concatenate(x) for x in zip(*parts)) if parts else [np.zeros(0, np.int64)] * 3
        return key, times, np.append(0, np.cumsum(n))

    def _pairs(self, c: Coded, g: Groups, base: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Key, times and fragment (from ``base`` on) of the pairs in the groups ``lo`` to ``hi``."""
        span = self.ids * self.width
        links = g.n_a[lo:hi] * g.n_b[lo:hi]
        few = lo + np.flatnonzero(links <= LINKS_AT_ONCE)
        n = links[few - lo]
        group = np.repeat(few, n)
        nth = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
        right = g.n_b[group]
        key = c.a[g.start_a[group] + nth // right] * self.width + c.b[g.start_b[group] + nth % right]
        codes, times = np.unique((g.fragment[group] - base) * span + key, return_counts=True)
        for k in lo + np.flatnonzero(links > LINKS_AT_ONCE):  # all links of a long group at once would be quadratic
            a, m = np.unique(c.a[g.start_a[k]:g.start_a[k] + g.n_a[k]], return_counts=True)
            b, n = np.unique(c.b[g.start_b[k]:g.start_b[k] + g.n_b[k]], return_counts=True)
            more = (a[:, None] * self.width + b[None, :]).ravel() + (g.fragment[k] - base) * span
            codes, back = np.unique(np.concatenate([codes, more]), return_inverse=True)
            times = np.bincount(back, np.concatenate([times, np.outer(m, n).ravel()])).astype(np.int64)
        return codes % span, times, codes // span

    def write(self, c: Coded, g: Groups) -> tuple[np.ndarray, np.ndarray]:
        """Each fragment's groups as ``;a1,a2|b1;a3|b2``: bytes and n+1 offsets."""
        mark = [np.zeros(len(ids), np.int64) for ids in (c.a, c.b)]
        mark[0][g.start_a], mark[1][g.start_b] = 1, 2
        before_b = np.repeat(g.start_b, g.n_a)  # B tokens of the groups before
        before_a = np.repeat(g.start_a + g.n_a, g.n_b)  # A tokens of the groups up to this
        token = np.empty(len(c.a) + len(c.b), np.int64)
        token[np.arange(len(c.a)) + before_b] = c.a + mark[0] * self.ids
        token[np.arange(len(c.b)) + before_a] = c.b + mark[1] * self.ids
        raw, off = textbuf.buffers(pc.take(self.written, pa.array(token)))
        return raw, off[c.a_off + c.b_off]


_PER_WORKER: dict[str, Aligner] = {}


def aligner(files) -> Aligner:
    """The worker's aligner of a broadcast (A text, B content), made once."""
    a, b = files.value
    key = hashlib.sha256(a.encode() + b).hexdigest()
    if key not in _PER_WORKER:
        _PER_WORKER[key] = Aligner(a, b)
    return _PER_WORKER[key]


def ascending(x: np.ndarray) -> np.ndarray:
    """The distinct values, by sorting (``np.unique`` hashes, which is slower on millions)."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def space_first(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every text that is not empty with a space before it."""
    some = np.diff(offsets) > 0
    return np.insert(data, offsets[:-1][some], 0x20), offsets + np.append(0, np.cumsum(some))


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ascending places that no token of either side spans: text starts, the
    end, and spaces after a character that is neither white space nor U+2581."""
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    cut[-1] = True
    at = np.flatnonzero(data == 0x20)
    at = at[at > 2]
    last, lead2, lead3 = data[at - 1], data[at - 2], data[at - 3]
    wide = (lead2 == 0xC2) | ((lead3 >= 0xE1) & (lead3 <= 0xE3))  # where white space beyond ASCII and U+2581 begin
    spacing = (last <= 0x20) | (last == 0x7F) | ((last >= 0x80) & wide)
    cut[at[~spacing]] = True
    return np.flatnonzero(cut)


_CODED = ("slice long, doc_ids array<long>, a binary, a_n binary, b binary, b_n binary, at binary, first binary, "
          "new_keys array<long>")


def _encode(files):
    """Texts -> a row a slice: its texts as numbers, and the pair keys the task has not met before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who, seen = aligner(files), np.zeros(0, np.int64)
        nth = TaskContext.get().partitionId() << 33
        for batch in batches:
            for rows, text in textbuf.slices(batch, "text", SLICE_BYTES):
                c = who.code(text)
                keys = ascending(who.pairs(c, who.align(c))[0])
                new = np.setdiff1d(keys, seen, assume_unique=True)
                seen = np.union1d(seen, new)
                ids = rows.column(rows.schema.get_field_index("doc_id")).to_pylist()
                stored = [_narrow(x) for x in (c.a, np.diff(c.a_off), c.b, np.diff(c.b_off), c.at, c.first)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([nth], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                     *(pa.array([x], pa.binary()) for x in stored),
                     pa.ListArray.from_arrays([0, len(new)], pa.array(new, pa.int64()))],
                    ["slice", "doc_ids", "a", "a_n", "b", "b_n", "at", "first", "new_keys"])
                nth += 1
    return run


def _slices(files, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Coded, Aligner]]:
    who = aligner(files)
    who.memo.clear()  # nothing is encoded any more
    for batch in batches:
        for k in range(batch.num_rows):
            r = batch.slice(k, 1).to_pylist()[0]
            x = {c: _wide(r.pop(c)) for c in ("a", "a_n", "b", "b_n", "at", "first")}
            n = [np.append(0, np.cumsum(x[c])) for c in ("a_n", "b_n")]
            yield r, Coded(x["a"], n[0], x["b"], n[1], x["at"], x["first"]), who


def _with_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key = batch.column(0)
        yield pa.RecordBatch.from_arrays([key, pa.array(shard_hash(key.to_numpy()))], ["key", "h"])


def _hash_shard(key: tuple[pa.Scalar, ...], got: pa.Table) -> pa.Table:
    keys, sizes, bits = build_shard(np.sort(got.column("key").to_numpy()))
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "keys": pa.array([keys.tobytes()], pa.binary()),
                     "sizes": pa.array([sizes], pa.list_(pa.int64())), "bits": pa.array([bits], pa.binary())})


def _narrow(vector: np.ndarray) -> bytes:
    """The vector behind the number of bytes of an entry."""
    kind = np.min_scalar_type(int(vector.max(initial=0)))
    return bytes([kind.itemsize]) + vector.astype(kind).tobytes()


def _wide(stored: bytes) -> np.ndarray:
    return np.frombuffer(stored, f"<u{stored[0]}", offset=1).astype(np.int64)


def _count(files, index):
    """Slices -> the task's dense count vector, in pieces: documents holding each pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: PairIndex = index.value
        vector = np.zeros(len(held), np.uint32)
        for _, c, who in _slices(files, batches):
            keys, _, off = who.pairs(c, who.align(c))
            distinct, where = np.unique(keys, return_inverse=True)
            place = held.find(distinct)[where]
            text = np.repeat(np.arange(len(c.first) - 1), np.diff(c.first))
            once = ascending(text * max(1, len(c)) + c.at)  # each fragment once a text
            text, part = once // max(1, len(c)), once % max(1, len(c))
            lo = 0
            while lo < len(text):  # whole texts, about PART_FRAGMENTS of their fragments at once
                hi = int(np.searchsorted(text, text[min(lo + PART_FRAGMENTS, len(text)) - 1], "right"))
                n = np.diff(off)[part[lo:hi]]
                nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                pair = place[np.repeat(off[part[lo:hi]], n) + nth]
                of = np.repeat(text[lo:hi], n)[pair >= 0]
                pair = ascending(of * max(1, len(held)) + pair[pair >= 0]) % max(1, len(held))  # each pair once a text
                np.add.at(vector, pair, 1)
                lo = hi
        task = TaskContext.get().partitionId()
        for chunk in range(-(-len(vector) // CHUNK)):
            piece = vector[chunk * CHUNK:(chunk + 1) * CHUNK]
            if piece.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), pa.array([task], pa.int64()), pa.array([_narrow(piece)], pa.binary())],
                    ["chunk", "task", "vector"])
    return run


def _sum(key: tuple[pa.Scalar, ...], got: pa.Table) -> pa.Table:
    total = None
    for x in got.column("vector"):
        total = _wide(x.as_py()) if total is None else total + _wide(x.as_py())
    return pa.table({"chunk": pa.array([key[0].as_py()], pa.int64()), "task": pa.array([key[1].as_py()], pa.int64()),
                     "vector": pa.array([_narrow(total)], pa.binary())})


def tree_sum(vectors: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(chunk, vector): pieces of all tasks, FAN_IN of them summed by a task at a time."""
    level = 0
    while True:
        vectors = scratch.keep(vectors.withColumn("task", F.floor(F.col("task") / FAN_IN)).groupBy("chunk", "task")
                               .applyInArrow(_sum, "chunk long, task long, vector binary"), f"{name}-{level}")
        level += 1
        if not (vectors.agg(F.max("task")).first()[0] or 0):
            return vectors.select("chunk", "vector")


_ROWS = ("slice long, nth long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
         "count_sum long, groups_sha256 string")


def _look_up(files, index, counts, full: bool):
    """Slices, aligned anew -> result rows; pairs the index does not hold add nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: PairIndex = index.value
        count, best = counts.value
        for r, c, who in _slices(files, batches):
            g = who.align(c)
            keys, times, off = who.pairs(c, g)
            distinct, where = np.unique(keys, return_inverse=True)
            place = held.find(distinct)
            own, top = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
            own[place >= 0], top[place >= 0] = count[place[place >= 0]], best[place[place >= 0]]
            sums = [np.append(0, np.cumsum(times * x[where], dtype=np.int64)) for x in (top, own)]
            n_best, count_sum = (x[off[1:]] - x[off[:-1]] for x in sums)
            raw, at = who.write(c, g)
            size = np.diff(at)[c.at]
            ends = np.append(0, np.cumsum(size))[c.first].tolist()
            written = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(c), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(raw))])
            groups, lo = [], 0
            while lo < len(c.first) - 1:
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + WRITTEN_BYTES, "right")) - 1)
                part, _ = textbuf.buffers(pc.take(written, pa.array(c.at[c.first[lo]:c.first[hi]])))
                groups += [part[a - ends[lo] + 1:b - ends[lo]].tobytes() if b > a else b"" for a, b in zip(ends[lo:hi], ends[lo + 1:hi + 1])]
                if not full:
                    groups[lo:] = [hashlib.sha256(x).hexdigest() if x else "" for x in groups[lo:]]
                lo = hi
            digests = [hashlib.sha256(x).hexdigest() if x else "" for x in groups] if full else groups
            n = len(r["doc_ids"])
            fragments = (np.diff(c.a_off), np.diff(c.b_off), g.of_fragments(np.ones(len(g.n_a), np.int64), len(c)),
                         g.of_fragments(g.n_a * g.n_b, len(c)), n_best, count_sum)
            columns = [pa.array(np.full(n, r["slice"])), pa.array(np.arange(n)), pa.array(r["doc_ids"], pa.int64())]
            columns += [pa.array(c.per_text(x)) for x in fragments] + [pa.array(digests, pa.string())]
            names = [x.split()[0] for x in _ROWS.split(", ")]
            if full:
                columns.append(pa.array([x.decode() for x in groups], pa.string()))
                names.append("groups")
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


@dataclass
class Counted:
    """Consecutive shards of the hash with their pairs' counts."""

    index: PairIndex
    counts: np.ndarray

    def top_of(self, best: np.ndarray, width: int) -> np.ndarray:
        """``best`` count of each A id, with these pairs."""
        a = self.index.keys // width
        out = np.zeros(max(len(best), int(a.max(initial=-1)) + 1), np.int64)
        out[:len(best)] = best
        np.maximum.at(out, a, self.counts)
        return out


def _vector_of(summed: DataFrame, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    for r in summed.collect():  # n entries, at most PAIRS_AT_ONCE
        part = _wide(bytes(r.vector))
        out[r.chunk * CHUNK:r.chunk * CHUNK + len(part)] = part
    return out


def align(docs: DataFrame, a: TokenizerFile, b: PieceModel, full: bool = False, doc_id: str = "doc_id", text: str = "text",
          pairs_at_once: int = PAIRS_AT_ONCE, scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256 (with ``full`` also groups).

    Side A (a byte-level BPE file) encodes a space and the text, side B the
    text, to which the model adds the space; strings of special tokens are plain
    text.  A null or empty text, or one whose bytes a side does not give back
    (U+2581 becomes a space), has no tokens: zeros and an empty string.  A
    pair's count is the number of rows with the pair linked; ``n_best`` counts the links
    whose count is the highest of their A id.  Repeated rows and repeated or null
    doc_ids each are a document of their own; an empty table gives no rows;
    other columns of ``docs`` do not take part.  Neither texts nor ids are shuffled.

    The indexed pairs and counts are held by every worker, about 17 bytes a
    pair: at most ``pairs_at_once`` of them, else the shards of the hash are
    taken in turns and the rows' partial sums added up.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "alignment")
    files = spark.sparkContext.broadcast((a.text, b.content))  # two files, fixed size
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    coded = scratch.keep(texts.mapInArrow(_encode(files), _CODED), "coded", maxRecordsPerFile=FILE_SLICES)
    pairs = coded.select(F.explode("new_keys").alias("key")).distinct()
    pairs = scratch.keep(pairs.mapInArrow(_with_hash, "key long, h long"), "pairs")
    n_pairs = pairs.count()
    total = max(1, -(-n_pairs // SHARD_PAIRS))
    shards = scratch.keep(pairs.groupBy((F.col("h") % total).alias("shard")).applyInArrow(
        _hash_shard, "shard long, keys binary, sizes array<long>, bits binary"), "shards")
    coded = coded.drop("new_keys")
    step = -(-total // max(1, -(-n_pairs // pairs_at_once)))
    width = Aligner(a.text, b.content).width

    best, counted = np.zeros(0, np.int64), []
    for first in range(0, total, step):
        part = [(r.shard, bytes(r.keys), r.sizes, bytes(r.bits)) for r in
                shards.where((F.col("shard") >= first) & (F.col("shard") < first + step)).orderBy("shard").collect()]
        held = PairIndex.of(first, total, part)
        index = spark.sparkContext.broadcast(held)  # at most about pairs_at_once pairs
        vectors = coded.mapInArrow(_count(files, index), "chunk long, task long, vector binary")
        counts = tree_sum(vectors, scratch, f"counts{first}")
        best = Counted(held, _vector_of(counts, len(held))).top_of(best, width)
        counted.append((index, counts))

    names = [c.split()[0] for c in _ROWS.split(", ")] + (["groups"] if full else [])
    out = None
    for index, counts in counted:
        held = index.value
        own = _vector_of(counts, len(held))
        flags = spark.sparkContext.broadcast((own.astype(np.min_scalar_type(int(own.max(initial=0)))), own == best[held.keys // width]))
        rows = coded.mapInArrow(_look_up(files, index, flags, full), _ROWS + (", groups string" if full else ""))
        out = rows if out is None else out.union(rows)
    if len(counted) > 1:  # a row's partial sums meet again by its place
        sums = ("n_best", "count_sum")
        out = out.groupBy("slice", "nth").agg(*[(F.sum if c in sums else F.first)(c).alias(c) for c in names[2:]])
    return out.select(*names[2:])
