"""Quality selection by importance resampling.  Two hashed n-gram models, one
of target texts (labelled good) and one of all texts, give every document the
log ratio of its likelihoods; the documents to keep are drawn without
replacement by Gumbel top-k on these log weights."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from threadloom.llm import textbuf
from threadloom.llm.store import Scratch

#: Hash buckets of words and of word pairs, each.
BUCKETS = 10_000
#: Labelled rows used at most (those of smallest id hash): four fifths fit the target model, a fifth the cut.
LABELLED_ROWS = 20_000
SMOOTHING = 1.0
#: Rows of one last histogram bin that are ranked together.
RANKED_ROWS = 100_000
#: Bytes of text whose n-grams are formed at once.
SLICE_BYTES = 2 << 20
_BINS = 4096
_PAIR = np.uint64(int(textbuf.stream(21, 1)[0]) | 1)


@dataclass(frozen=True)
class Model:
    """Log ratios per bucket (words, then pairs), and the cut per n-gram."""

    log_ratio: np.ndarray
    cut: float = 0.0


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each text's words (runs of letters and digits, runs of
    signs) and pairs of neighbours; a word followed by itself is one bucket
    whatever the word."""
    words, off = textbuf.word_hashes(data, offsets, textbuf.WORDS_AND_SIGNS)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    if not len(words):
        return row, np.zeros(0, np.int64)
    same = row[1:] == row[:-1]
    pair = textbuf.mix(words[:-1] * _PAIR + words[1:]) % np.uint64(BUCKETS - 1) + np.uint64(BUCKETS + 1)
    pair[words[:-1] == words[1:]] = BUCKETS
    return (np.concatenate([row, row[1:][same]]),
            np.concatenate([words % np.uint64(BUCKETS), pair[same]]).astype(np.int64))


def _count(targets):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(2 * BUCKETS, np.int64), np.zeros(2 * BUCKETS, np.int64)
        for batch in batches:
            for rows, text in textbuf.slices(batch, "text", SLICE_BYTES):
                row, bucket = ngrams(*textbuf.buffers(text))
                ids = rows.column(rows.schema.get_field_index("doc_id"))
                target = np.isin(ids.fill_null(0).to_numpy(), targets.value) & ids.is_valid().to_numpy(zero_copy_only=False)
                raw += np.bincount(bucket, minlength=2 * BUCKETS)
                good += np.bincount(bucket[target[row]], minlength=2 * BUCKETS)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(raw[seen]), pa.array(good[seen])], ["bucket", "raw", "good"])
    return run


def _score(log_ratio, text_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, text in textbuf.slices(batch, text_column, SLICE_BYTES):
                row, bucket = ngrams(*textbuf.buffers(text))
                n = np.bincount(row, minlength=len(text))
                total = np.bincount(row, log_ratio.value[bucket], minlength=len(text))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(n), pa.array(total)], [*rows.schema.names, "__n", "__total"])
    return run


def labelled_sample(labels: DataFrame, limit: int) -> list:
    """(doc_id, good, fold) of at most ``limit`` labelled documents, chosen by id
    hash; a document with contradicting labels is not good."""
    return (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
            .groupBy("doc_id").agg((F.min("quality") == 1).alias("good"))
            .withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(limit)
            .select("doc_id", "good", F.pmod("h", F.lit(5)).alias("fold")).collect())


def best_cut(scores: list[tuple[float, bool]]) -> float:
    """The cut between held-out scores with the least loss: rejecting a share of
    the good counts three times keeping the same share of the bad.  Midway in
    the widest best gap; minus infinity if either kind is missing."""
    good = np.sort([s for s, g in scores if g])
    bad = np.sort([s for s, g in scores if not g])
    if not len(good) or not len(bad):
        return float("-inf")
    edges = np.unique(np.concatenate([good, bad]))
    cuts = np.concatenate([[edges[0] - 1], (edges[1:] + edges[:-1]) / 2, [edges[-1] + 1]])
    loss = 3 * np.searchsorted(good, cuts) / len(good) + 1 - np.searchsorted(bad, cuts) / len(bad)
    best = np.flatnonzero(loss <= loss.min() + 1e-12)
    gap = np.diff(np.concatenate([[edges[0] - 2], edges, [edges[-1] + 2]]))
    return float(cuts[best[np.argmax(gap[best])]])


def fit(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS) -> Model:
    """The raw model counts the n-grams of all ``docs``; the target model those
    of the good documents of the labelled sample.  The cut is the log ratio per
    n-gram that best tells held-out good documents from bad ones."""
    spark = docs.sparkSession
    sample = labelled_sample(labels, labelled_rows)
    targets = spark.sparkContext.broadcast(np.array([r.doc_id for r in sample if r.good and r.fold], np.int64))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counts = (rows.mapInArrow(_count(targets), "bucket long, raw long, good long")
              .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).collect())  # <= 2 x BUCKETS
    raw, good = np.zeros(2 * BUCKETS), np.zeros(2 * BUCKETS)
    for r in counts:
        raw[r.bucket], good[r.bucket] = r.raw, r.good
    if not good.any():
        return Model(np.zeros(2 * BUCKETS), float("-inf"))
    ratio = np.concatenate([
        np.log((g + SMOOTHING) / (g.sum() + SMOOTHING * BUCKETS)) - np.log((a + SMOOTHING) / (a.sum() + SMOOTHING * BUCKETS))
        for g, a in zip(good.reshape(2, -1), raw.reshape(2, -1), strict=True)])
    held = spark.createDataFrame([(r.doc_id, r.good) for r in sample if not r.fold] or [(None, False)],
                                 "doc_id long, good boolean")  # a fifth of the labelled sample
    scored = score(rows.join(F.broadcast(held), "doc_id"), Model(ratio))
    points = scored.where("n_ngrams > 0").select(F.col("log_weight") / F.col("n_ngrams"), "good").collect()
    return Model(ratio, best_cut([(s, g) for s, g in points]))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus n_ngrams and log_weight (its log ratios, each less the cut)."""
    shared = docs.sparkSession.sparkContext.broadcast(model.log_ratio)  # 2 x BUCKETS numbers
    plain = docs.drop("n_ngrams", "log_weight")
    schema = StructType([*plain.schema.fields, StructField("__n", LongType()), StructField("__total", DoubleType())])
    cut = F.lit(model.cut if np.isfinite(model.cut) else -1e6)
    return (plain.mapInArrow(_score(shared, text), schema)
            .withColumn("n_ngrams", F.col("__n"))
            .withColumn("log_weight", F.col("__total") - cut * F.col("__n")).drop("__n", "__total"))


def gumbel_key(log_weight: Column, doc_id: str = "doc_id") -> Column:
    """log weight plus standard Gumbel noise, fixed by the document's id: the
    greatest keys are a draw without replacement by weight."""
    u = (F.pmod(F.xxhash64(F.lit("gumbel"), F.col(doc_id)), F.lit((1 << 52) - 1)) + 1) / F.lit(float(1 << 52))
    return log_weight - F.log(-F.log(u))


@dataclass(frozen=True)
class Threshold:
    """Keys above ``key`` are drawn, and those equal to it up to ``doc_id``."""

    key: float
    doc_id: int | None

    def drawn(self, key: Column, doc_id: str = "doc_id") -> Column:
        tie = F.col(doc_id) <= F.lit(self.doc_id) if self.doc_id is not None else F.col(doc_id).isNull()
        return (key > self.key) | ((key == self.key) & F.coalesce(tie, F.lit(False)))


def kth(keys: DataFrame, k: int) -> Threshold:
    """The k-th row of (key, doc_id) by key descending, then doc_id: histograms
    narrow the key's range until few rows share its bin, which are ranked.
    (Rows of one key and one doc_id are drawn together.)"""
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    above = 0
    while True:
        width = (high - low) / _BINS
        within = keys.where(F.col("key").between(low, high))
        if width <= abs(high) * 1e-12:
            break
        slot = F.least(F.floor((F.col("key") - low) / width), F.lit(_BINS - 1))
        counts = dict(within.groupBy(slot.alias("b")).count().collect())  # <= _BINS rows
        run = above
        for b in sorted(counts, reverse=True):
            if run + counts[b] >= k:
                break
            run += counts[b]
        low, high = within.where(slot == b).agg(F.min("key"), F.max("key")).first()
        above = run
        if counts[b] <= RANKED_ROWS or low == high:
            break
    last = (keys.where(F.col("key").between(low, high)).orderBy(F.desc("key"), F.asc_nulls_last("doc_id"))
            .limit(k - above).agg(F.min_by(F.struct("key", "doc_id"), F.struct("key", F.coalesce(
                -F.col("doc_id"), F.lit(-(1 << 63)))))).first()[0])
    return Threshold(last.key, last.doc_id)


def draw(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, text: str = "text",
         scratch: Scratch | None = None) -> DataFrame:
    """``docs`` plus n_ngrams, log_weight, gumbel_key, kept.

    As many documents are drawn as have a positive log weight (more like the
    good than the cut asks); which ones, the noisy keys decide.  A null or empty text has no n-grams and is not
    drawn.  Without labelled good documents, or without bad ones held out,
    everything with n-grams is drawn.  Repeated rows each keep their row; a null
    doc_id takes part with one common noise; an empty table gives no rows;
    columns of ``docs`` named like the added ones are replaced.  The labelled
    sample is bounded (``labelled_rows``); counts and scores cover all rows.
    """
    scratch = scratch or Scratch(docs.sparkSession, "quality")
    model = fit(docs.select("doc_id", F.col(text).alias("text")), labels, labelled_rows)
    scored = score(docs.drop("gumbel_key", "kept"), model, text).withColumn("gumbel_key", gumbel_key(F.col("log_weight")))
    narrow = score(docs.select("doc_id", F.col(text).alias("text")), model).where("n_ngrams > 0")
    keys = scratch.keep(narrow.select("doc_id", "log_weight", gumbel_key(F.col("log_weight")).alias("key")), "keys")
    k = keys.where("log_weight > 0").count()
    if k == 0:
        return scored.withColumn("kept", F.lit(False))
    drawn = kth(keys, k).drawn(F.col("gumbel_key"))
    return scored.withColumn("kept", (F.col("n_ngrams") > 0) & drawn)
