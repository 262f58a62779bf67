"""Concatenate-and-cut packing.  Pass 1 tokenizes each scan partition once and
keeps every text's ids with the count of tokens before it in the partition;
prefix sums over the partition totals give global offsets.  Pass 2 cuts the
stream at multiples of the window; a text crossing a boundary gets one boundary
record (piece) per window it touches."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm import fragments, textbuf
from threadloom.llm.fragments import TokenizerFile
from threadloom.llm.store import Scratch

_PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
           "sequence_id long, offset long")


def _tokenize(json_text, end_id: int, wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = fragments.encoder(json_text.value)
        kind = np.dtype("<u4") if wide else np.dtype("<u2")
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows, text in textbuf.slices(batch, "text"):
                ids, off = fragments.word_ids(enc, text)
                n = len(text)
                # the end id after each text
                ids = np.insert(ids.astype(kind), off[1:], end_id)
                off = off + np.arange(n + 1)
                stored = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), n, [None, pa.py_buffer(off * kind.itemsize), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part)), pa.array(before + off[:-1]),
                     rows.column(rows.schema.get_field_index("doc_id")), pa.array(np.diff(off)),
                     stored.cast(pa.binary())],
                    ["part", "before", "doc_id", "n", "ids"])
                before += int(off[-1])
    return run


def _cut(window: int, wide: bool, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = "<u4" if wide else "<u2"
        for batch in batches:
            doc, at, n, ids = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "at", "n", "ids"))
            at, n = at.to_numpy(), n.to_numpy()
            pieces = (at + n - 1) // window - at // window + 1
            row = np.repeat(np.arange(len(n)), pieces)
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = at[row] // window + nth
            first = np.maximum(at[row], sequence * window)
            last = np.minimum(at[row] + n[row], (sequence + 1) * window)
            start = first - at[row]
            bodies, held = [], -1
            for r, a, b in zip(row.tolist(), start.tolist(), (last - at[row]).tolist()):
                if r != held:
                    whole, held = np.frombuffer(ids[r].as_py(), kind).astype("<u4"), r
                bodies.append(whole[a:b].tobytes())
            columns = [doc.take(pa.array(row)), pa.array(start), pa.array(last - first),
                       pa.array([zlib.crc32(b) for b in bodies], pa.int64()), pa.array(n[row]),
                       pa.array(sequence), pa.array(first - sequence * window)]
            names = [c.split()[0] for c in _PIECES.split(", ")]
            if with_ids:
                columns.append(pa.array(bodies, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


def pack(docs: DataFrame, tokenizer: TokenizerFile, window: int = 4096, end_id: int = 2, with_ids: bool = False,
         doc_id: str = "doc_id", text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (and ids, little-endian uint32, with ``with_ids``).

    Every sequence but the last is full, so the only padding is the last one's.
    A null or empty text is its end id alone.  Repeated rows and repeated or
    null doc_ids each are a text of their own; an empty table gives no rows;
    other columns of ``docs`` do not take part.  The order of texts is that of
    the scan (stored in pass 1, so that a recomputed task cannot change it).
    For tokenizers that drop white space and lower-case.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "packing")
    wide = max(tokenizer.vocabulary_size, end_id + 1) > 1 << 16
    shared = spark.sparkContext.broadcast(tokenizer.text)  # one file, fixed size
    stored = scratch.keep(
        docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .mapInArrow(_tokenize(shared, end_id, wide), "part long, before long, doc_id long, n long, ids binary"),
        "ids")
    totals = stored.groupBy("part").agg(F.sum("n").alias("total"))
    # one row per scan partition; written, so that its size on disk decides whether it is broadcast
    base = scratch.keep(
        totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base")), "base")
    placed = stored.join(base, "part").select("doc_id", (F.col("base") + F.col("before")).alias("at"), "n", "ids")
    return placed.mapInArrow(_cut(window, wide, with_ids), _PIECES + (", ids binary" if with_ids else ""))
