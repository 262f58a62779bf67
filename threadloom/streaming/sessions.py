"""W1-W4 incrementally: a message stream to closed conversations, the same
that ``sessionize`` finds in the whole table.

State of a key (a channel): the messages of the open conversation, at most
``max_messages``; the messages newer than the watermark, which wait until
none older can come; the last message's time and thread, and how many there
were.  A conversation is emitted, whole, when a message breaks it, when it is
full, or when the watermark has passed its last message by the window.  A
message older than the watermark on arrival is dropped by the engine
(``numRowsDroppedByWatermark`` of the query's progress counts them): choose the
delay so that there are none, or rebuild such days in batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EVENT_US, _EVENT_TIME = "_event_us", "_event_time"
_ADDED = [("rn", T.LongType()), ("run_start", T.LongType()), ("chunk", T.LongType()), ("conv_pos", T.LongType()),
          ("conv_size", T.LongType()), ("conv_id", T.StringType())]
_LAST = "rn long, run_start long, chunk long, ts double, thread string"


def conversation_id(key: tuple, run_start: int, chunk: int) -> str:
    """The batch operator's id: ":" and "\\" escaped in the key; of several parts a
    null one is "\\N", a single null one is left out."""
    parts = [None if k is None else str(k).replace("\\", "\\\\").replace(":", "\\:") for k in key]
    parts = [p for p in parts if p is not None] if len(parts) == 1 else ["\\N" if p is None else p for p in parts]
    return ":".join([*parts, str(run_start), str(chunk)])


class OpenConversations(StatefulProcessor):
    """``message`` is the schema of a message as it is kept and emitted."""

    def __init__(self, message: T.StructType, ts: str, order: Sequence[str], thread: str | None, window: float,
                 max_messages: int, min_messages: int):
        self.message, self.ts, self.order, self.thread = message, ts, list(order), thread
        self.window, self.cap, self.least = float(window), max(1, int(max_messages)), int(min_messages)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", _LAST)
        self.open = handle.getListState("open", self.message)
        self.waiting = handle.getListState("waiting", self.message)
        names = self.message.fieldNames()
        self.at = {n: i for i, n in enumerate(names)}
        self.sort_by = [self.at[c] for c in (self.ts, *self.order)]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [tuple(r[n] for n in self.at) for r in rows]
        yield from self.advance(key, [*self.stored(self.waiting), *new], timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self.advance(key, self.stored(self.waiting), timerValues.getCurrentWatermarkInMs())

    @staticmethod
    def stored(state) -> list[tuple]:
        return [tuple(r) for r in state.get()] if state.exists() else []

    def order_of(self, row: tuple) -> tuple:
        """Ascending, nulls first, as the batch windows sort."""
        return tuple((row[i] is not None, row[i] if row[i] is not None else 0) for i in self.sort_by)

    def advance(self, key, waiting: list[tuple], watermark_ms: int) -> Iterator[Row]:
        """Take the messages that the watermark has reached, in order; close what it has left behind."""
        us = self.at[_EVENT_US]
        ready = sorted((r for r in waiting if r[us] <= watermark_ms * 1000), key=self.order_of)
        waiting = [r for r in waiting if r[us] > watermark_ms * 1000]
        last = tuple(self.last.get()) if self.last.exists() else None
        open_ = self.stored(self.open)
        for r in ready:
            ts, thread = r[self.at[self.ts]], r[self.at[self.thread]] if self.thread else None
            rn, start, chunk = (last[0] + 1, last[1], last[2]) if last else (1, 1, 0)
            if last and (ts - last[3] >= self.window or thread != last[4]):
                yield from self.closed(key, open_, last)
                open_, start, chunk = [], rn, 0
            elif len(open_) == self.cap:
                yield from self.closed(key, open_, last)
                open_, chunk = [], chunk + 1
            open_.append(r)
            last = (rn, start, chunk, ts, thread)
        close_us = None
        if open_:
            close_us = open_[-1][us] + int(self.window * 1e6) + 1  # (a microsecond of rounding)
            if close_us <= watermark_ms * 1000:  # every message to come breaks it
                yield from self.closed(key, open_, last)
                open_, close_us = [], None
        for state, rows in ((self.open, open_), (self.waiting, waiting)):
            if rows:
                state.put(rows)
            elif state.exists():
                state.clear()
        if last:
            self.last.update(last)
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        due = [r[us] for r in waiting] + ([close_us] if close_us is not None else [])
        if due:
            self.handle.registerTimer(max(-(-min(due) // 1000), watermark_ms + 1))

    def closed(self, key, rows: list[tuple], last: tuple) -> Iterator[Row]:
        """An open conversation's rows; a conversation whose messages went out full before is empty here."""
        if len(rows) < max(1, self.least):
            return
        first_rn = last[0] - len(rows) + 1
        own = conversation_id(tuple(key), last[1], last[2])
        names = [n for n in self.at if n != _EVENT_US]
        for i, r in enumerate(rows):
            yield Row(**{n: r[self.at[n]] for n in names}, rn=first_rn + i, run_start=last[1], chunk=last[2],
                      conv_pos=i + 1, conv_size=len(rows), conv_id=own)

    def close(self) -> None:
        pass


def sessionize_stream(messages: DataFrame, *, keys: Sequence[str], ts: str = "ts_num", order: Sequence[str] = (),
                      thread: str | None = "thread_ts", window: float = 7200.0, max_messages: int = 40,
                      min_messages: int = 2, delay: str = "1 hour") -> DataFrame:
    """A streaming ``messages`` -> the rows of closed conversations, with
    the columns that ``sessionize`` adds (``rn, run_start, chunk, conv_pos, conv_size,
    conv_id``).  ``keys`` is the scope, at least one column; ``(ts, *order)`` a total
    order within a key; messages without ``ts`` are left out.  Messages may come in
    any order within ``delay`` of the newest one."""
    if not keys:
        raise ValueError("a stream is grouped by key: the whole stream as one conversation scope is one task")
    spark = messages.sparkSession
    if spark.conf.get(PROVIDER, None) != ROCKSDB:
        spark.conf.set(PROVIDER, ROCKSDB)  # the only store with timers and several states a key
    kept = T.StructType([*messages.schema.fields, T.StructField(_EVENT_US, T.LongType())])
    out = T.StructType([*messages.schema.fields, *[T.StructField(n, kind) for n, kind in _ADDED]])
    timed = (messages.filter(F.col(ts).isNotNull())
             .withColumn(_EVENT_US, F.round(F.col(ts) * F.lit(1e6)).cast("long"))
             .withColumn(_EVENT_TIME, F.timestamp_micros(_EVENT_US)).withWatermark(_EVENT_TIME, delay))
    work = OpenConversations(kept, ts, order, thread, window, max_messages, min_messages)
    return timed.groupBy(*keys).transformWithState(work, out, "Append", "EventTime")


def start_sessionize(messages: DataFrame, out_path: str, state_path: str, *, available_now: bool = True,
                     processing_time: str = "1 minute", **how) -> StreamingQuery:
    """Append closed conversations to the Parquet table ``out_path``.  ``state_path``
    belongs to that table: a restart with it goes on where the stream stopped."""
    writer = (sessionize_stream(messages, **how).writeStream.format("parquet").option("path", out_path)
              .option("checkpointLocation", state_path).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
