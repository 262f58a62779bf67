"""Byte-level BPE by forced-boundary splitting: a byte pair that occurs inside
no vocabulary token is never joined, so the text may be cut there; the
fragments are encoded independently and their ids concatenated."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm import fragments, textbuf
from threadloom.llm.fragments import Encoder, TokenizerFile


def byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other
    bytes for the code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def joined_pairs(text: str) -> np.ndarray:
    """65,536 flags: byte pairs that occur inside some token of the file."""
    spec, alphabet = json.loads(text), byte_alphabet()
    seen = np.zeros(1 << 16, dtype=bool)
    tokens = [bytes(alphabet[c] for c in t) for t in spec["model"]["vocab"] if all(c in alphabet for c in t)]
    for token in [*tokens, *(t["content"].encode() for t in spec["added_tokens"])]:
        raw = np.frombuffer(token, np.uint8).astype(np.int64)
        seen[raw[:-1] << 8 | raw[1:]] = True
    return seen


#: Last bytes of characters that may be white space (U+0085, U+00A0, U+1680,
#: U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000), besides ASCII controls and space.
_MAYBE_SPACE = np.zeros(256, dtype=bool)
_MAYBE_SPACE[[*range(0x00, 0x21), 0x7F, *range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True


def forced_cuts(data: np.ndarray, offsets: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Ascending cut positions: text starts, and places between two characters
    whose meeting bytes no token joins.  Not cut after a possible white-space
    character (its run decides by what follows) nor before an apostrophe (a
    contraction would begin there)."""
    cut = np.zeros(len(data) + 1, dtype=bool)
    if len(data) > 1:
        left, right = data[:-1], data[1:]
        cut[1:-1] = ~joined[left.astype(np.uint16) << 8 | right] & ((right & 0xC0) != 0x80)
        cut[1:-1] &= ~_MAYBE_SPACE[left] & (right != 0x27)
    cut[offsets] = True
    return np.flatnonzero(cut)


class ByteEncoder(Encoder):
    """Fragments as (ids as ",1,22,333", decoded text)."""

    def __init__(self, text: str):
        super().__init__(text)
        self.joined = joined_pairs(text)
        self.memo = {"": ("", "")}

    def encode(self, fragments_: list[str]) -> list[tuple[str, str]]:
        memo = self.memo
        new = [f for f in fragments_ if f not in memo]
        fresh: dict[str, tuple[str, str]] = {}
        for at in range(0, len(new), 4096):
            part = new[at:at + 4096]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            back = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
            for f, i, t in zip(part, ids, back, strict=True):
                fresh[f] = ("," + ",".join(map(str, i)), f if t == f else t)
        room = fragments.MEMO_ENTRIES - len(memo)
        if room > 0:
            memo.update((f, fresh[f]) for f in new[:room])
        return [memo[f] if f in memo else fresh[f] for f in fragments_]


def encode_texts(enc: ByteEncoder, texts: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """(ids as ",1,22,...", decoded text) per fragment, and the n+1 fragment offsets of the texts."""
    data, off = textbuf.buffers(texts)
    cuts = forced_cuts(data, off, enc.joined)
    bounds = cuts if len(cuts) and cuts[-1] == len(data) else np.append(cuts, len(data))
    parts = pa.LargeStringArray.from_buffers(
        len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
    coded = pc.dictionary_encode(parts)
    known = enc.encode(coded.dictionary.to_pylist())
    ids = pc.take(pa.array([k[0] for k in known], pa.large_string()), coded.indices)
    back = pc.take(pa.array([k[1] for k in known], pa.large_string()), coded.indices)
    return ids, back, np.searchsorted(bounds, off)


def _encode(json_text, full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = fragments.encoder(json_text.value, ByteEncoder)
        for batch in batches:
            for rows, text in textbuf.slices(batch, "text"):
                ids, back, first = encode_texts(enc, text)
                id_raw, id_off = textbuf.buffers(ids)
                back_raw, back_off = textbuf.buffers(back)
                id_at, back_at = id_off[first].tolist(), back_off[first].tolist()
                commas = np.append(0, np.cumsum(id_raw == 0x2C))
                n = np.diff(commas[id_off[first]])
                id_bytes = [id_raw[a + 1:b].tobytes() for a, b in zip(id_at[:-1], id_at[1:])]
                texts = [back_raw[a:b].tobytes() for a, b in zip(back_at[:-1], back_at[1:])]
                columns = [rows.column(rows.schema.get_field_index("doc_id")), pa.array(n, pa.int64()),
                           pa.array([hashlib.sha256(x).hexdigest() for x in id_bytes]),
                           pa.array([hashlib.sha256(x).hexdigest() for x in texts])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if full:
                    columns += [pa.array([x.decode() for x in id_bytes]), pa.array([x.decode() for x in texts])]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)
    return run


def encode_decode(docs: DataFrame, tokenizer: TokenizerFile, full: bool = False,
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256
    (with ``full`` also ids, decimal and joined by commas, and decoded).

    For byte-level BPE files.  Null counts as empty: no ids, digests of the
    empty string.  Strings of special tokens inside a text become their ids, as
    by the library's default.  No shuffle; repeated rows each keep their row; an
    empty table gives no rows; other columns of ``docs`` do not take part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer.text)  # one file, fixed size
    return (docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .mapInArrow(_encode(shared, full), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
                        + (", ids string, decoded string" if full else "")))
