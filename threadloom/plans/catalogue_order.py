"""Queries over the whole order of a table: the global message order, contexts
cut to a token budget, whole-example packing.  Registered into
``threadloom.plans.catalogue`` on import."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.template import BOS
from threadloom.functions.tokens import octet_proxy
from threadloom.operators import batching, examples, order, threads, transcripts
from threadloom.plans.catalogue import MSG_VIEW, register
from threadloom.plans.catalogue_more import (CHAT_PROMPT, NL, _RENDER_SQL, _SEG_SQL, _table_convs, _transcript, sql_render_part,
                                             sql_strip)
from threadloom.sources import tables

__all__: list[str] = []


@register("global_order", f"""WITH {MSG_VIEW}
SELECT event_id, row_number() OVER (ORDER BY ts_num, channel, date, event_id) AS "position" FROM m""")
def q_global_order(spark: SparkSession, sf: str) -> DataFrame:
    messages = tables.event_messages(spark, sf).select("ts_num", "channel", "date", "event_id")
    return order.order_messages(messages, order=("channel", "date", "event_id")).select("event_id", "position")


BUDGETS = (40, 120, 400)
_SYSTEM_TOKENS = -(-len((BOS + "System: " + CHAT_PROMPT + NL + NL).encode()) // 4)


@register("context_window", f"""WITH {_SEG_SQL},
p AS (SELECT session_id, segment, turn, role, CAST(ceil(strlen({sql_render_part('role', sql_strip('text'))}) / 4) AS BIGINT) AS n FROM seg),
q AS (SELECT p.*, CAST(sum(n) OVER (PARTITION BY session_id, segment ORDER BY turn) AS BIGINT) AS s FROM p),
a AS (SELECT t.*, b.budget, (SELECT min(f.turn) FROM q f WHERE f.session_id = t.session_id AND f.segment = t.segment
                             AND f.turn <= t.turn AND t.s - f.s + f.n + {_SYSTEM_TOKENS} <= b.budget) AS first
      FROM q t, (VALUES {', '.join(f'({b})' for b in BUDGETS)}) b(budget) WHERE t.role = 'user')
SELECT session_id, segment, turn, CAST(budget AS BIGINT) AS budget, coalesce(first, turn) AS first_turn,
       (SELECT count(*) + 1 FROM q f WHERE f.session_id = a.session_id AND f.segment = a.segment
        AND f.turn BETWEEN coalesce(first, a.turn) AND a.turn) AS n_context,
       CASE WHEN first IS NULL THEN greatest(budget, {_SYSTEM_TOKENS})
            ELSE {_SYSTEM_TOKENS} + (SELECT CAST(sum(f.n) AS BIGINT) FROM q f WHERE f.session_id = a.session_id
                 AND f.segment = a.segment AND f.turn BETWEEN first AND a.turn) END AS context_tokens,
       CASE WHEN first IS NULL THEN least(n, n + {_SYSTEM_TOKENS} - budget) ELSE 0 END AS cut_tokens FROM a""")
def q_context_window(spark: SparkSession, sf: str) -> DataFrame:
    seg = transcripts.reset_segments(_transcript(spark, sf))
    return transcripts.context_window(seg, BUDGETS, octet_proxy, system_prompt=CHAT_PROMPT)


ROW_TOKENS = 512


@register("pack_whole", f"""WITH RECURSIVE {_RENDER_SQL},
e AS (SELECT conv_id, CAST(ceil(strlen(text) / 4) AS BIGINT) AS n, md5('42:' || CAST(conv_id AS VARCHAR)) AS h FROM r),
o AS (SELECT *, row_number() OVER (ORDER BY n DESC, h) AS k FROM e WHERE n BETWEEN 1 AND {ROW_TOKENS}),
st(k, free, place, lead) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
  UNION ALL
  SELECT k, CASE WHEN p IS NULL THEN list_append(free, {ROW_TOKENS} - n)
                 ELSE list_concat(free[:p - 1], [free[p] - n], free[p + 1:]) END,
         coalesce(p, len(free) + 1) - 1, CASE WHEN p IS NULL THEN 0 ELSE {ROW_TOKENS} - free[p] END
  FROM (SELECT o.k, free, o.n, nullif(list_position(list_transform(free, lambda f: f >= o.n), true), 0) AS p FROM st JOIN o ON o.k = st.k + 1))
SELECT conv_id, n AS n_tokens, place AS packed_row, lead AS row_offset FROM o JOIN st USING (k)
UNION ALL SELECT conv_id, n, NULL, NULL FROM e WHERE n > {ROW_TOKENS}""")
def q_pack_whole(spark: SparkSession, sf: str) -> DataFrame:
    ex = examples.with_token_count(examples.render(_table_convs(spark, sf)), octet_proxy)
    return batching.pack_whole(ex.select("conv_id", "n_tokens"), max_tokens=ROW_TOKENS).selectExpr(
        "conv_id", "cast(n_tokens AS bigint) AS n_tokens", "packed_row", "row_offset")


# a thread view of the events: a message is named by its id; a third of them reply in one thread of their
# channel, others to the message whose id is theirs less some (another channel's or not there: an orphan)
_THREADS = f"""{MSG_VIEW},
n AS (SELECT event_id, ts_num, channel, "user", CAST(event_id AS VARCHAR) AS ts, text,
             CASE WHEN event_id % 3 = 0 THEN '12' WHEN thread_ts IS NOT NULL THEN CAST(event_id - event_id % 20 AS VARCHAR) END AS thread_ts
      FROM m),
i AS (SELECT *, coalesce(thread_ts, ts) AS thread_id FROM n),
h AS (SELECT i.*, i.thread_id = i.ts AS is_root, o.event_id IS NULL AS orphan, o."user" AS root_user,
             row_number() OVER (PARTITION BY i.channel, i.thread_id ORDER BY i.ts_num, i.event_id) AS thread_pos
      FROM i LEFT JOIN i o ON o.channel = i.channel AND o.ts = i.thread_id AND o.thread_id = o.ts)"""


def _threads(spark: SparkSession, sf: str) -> DataFrame:
    m = tables.event_messages(spark, sf)
    named = F.when(F.col("event_id") % 3 == 0, F.lit("12")).when(
        F.col("thread_ts").isNotNull(), (F.col("event_id") - F.col("event_id") % 20).cast("string"))
    m = m.select("event_id", "ts_num", "channel", "user", F.col("event_id").cast("string").alias("ts"), "text", named.alias("thread_ts"))
    return threads.thread_messages(m, order=["event_id"])


@register("thread_messages", f"""WITH {_THREADS}
SELECT event_id, channel, thread_id, is_root, orphan, root_user, thread_pos FROM h""")
def q_thread_messages(spark: SparkSession, sf: str) -> DataFrame:
    return _threads(spark, sf).select("event_id", "channel", "thread_id", "is_root", "orphan", "root_user", "thread_pos")


@register("next_in_thread", f"""WITH {_THREADS}
SELECT a.event_id, a.thread_id, a.text, b.text AS reply, b."user" AS reply_user
FROM h a JOIN h b ON b.channel = a.channel AND b.thread_id = a.thread_id AND b.thread_pos = a.thread_pos + 1""")
def q_next_in_thread(spark: SparkSession, sf: str) -> DataFrame:
    return threads.next_in_thread(_threads(spark, sf)).select("event_id", "thread_id", "text", "reply", "reply_user")
