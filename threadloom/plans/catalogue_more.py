"""The rest of the query catalogue (filters, lookups, cleaning, conversations,
examples, split, transcripts, batching, end to end).  Registered into
``threadloom.plans.catalogue`` on import."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions import text as tx
from threadloom.functions.template import BOS, render_template
from threadloom.functions.tokens import char_tokens, octet_proxy
from threadloom.operators import authors, batching, conversations, examples, filters, split, transcripts
from threadloom.operators import sessionize as sz
from threadloom.plans.catalogue import MSG_VIEW, _conv_summary, _CONV_SUMMARY_SQL, _sessionize_sql, register
from threadloom.sources import tables

__all__: list[str] = []

# Query parameters: the system prompts the catalogue's queries use (any text works;
# the same strings are used by the Spark queries and their SQL oracles).
TRAINING_PROMPT = "You are a helpful assistant that answers in the style of these conversations."
CHAT_PROMPT = "You are a helpful assistant. Keep answers short."

# ---------------------------------------------------------------------------
# SQL fragments (same patterns as threadloom.functions.text)
# ---------------------------------------------------------------------------


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_nonblank(x: str) -> str:
    return "regexp_matches(" + x + ", " + _lit(tx.NON_WS_CLASS) + ")"


def sql_collapse(x: str) -> str:
    return "trim(regexp_replace(" + x + ", " + _lit(tx.WS_CLASS + "+") + ", ' ', 'g'), ' ')"


def sql_channels(x: str) -> str:
    return "regexp_replace(" + x + ", " + _lit(tx.CHANNEL_RE) + ", '#\\2', 'g')"


def sql_urls(x: str) -> str:
    return "regexp_replace(" + x + ", " + _lit(tx.URL_RE) + ", '\\1', 'g')"


def sql_strip(x: str) -> str:
    return ("regexp_replace(regexp_replace(" + x + ", " + _lit(tx.WS_LEADING) + ", ''), "
            + _lit(tx.WS_TRAILING) + ", '')")


def sql_clean_rest(x: str) -> str:
    return sql_collapse(sql_urls(sql_channels(x)))


USERS_SQL = "mu AS (SELECT CAST(c_custkey AS VARCHAR) AS id, arg_min(c_name, c_custkey) AS real_name FROM customer GROUP BY 1)"


def sql_mentions(src: str, key: str, text: str, out: str) -> str:
    """CTEs resolving ``<@ID>`` mentions of ``src.text`` into ``out(key, txt)``."""
    return (USERS_SQL + ",\n"
            f"mp AS (SELECT {key}, string_split_regex(coalesce({text}, ''), {_lit(tx.MENTION_SPLIT_RE)}) AS parts, "
            f"regexp_extract_all(coalesce({text}, ''), {_lit(tx.MENTION_RE)}, 1) AS ids FROM {src}),\n"
            f"mi AS (SELECT {key}, parts, ids, unnest(range(1, len(parts) + 1)) AS i FROM mp),\n"
            f"mj AS (SELECT mi.{key} AS {key}, mi.i AS i, mi.parts[mi.i] || CASE WHEN mi.i <= len(mi.ids) "
            f"THEN '@' || coalesce(mu.real_name, mi.ids[mi.i]) ELSE '' END AS piece "
            f"FROM mi LEFT JOIN mu ON mu.id = mi.ids[mi.i]),\n"
            f"{out} AS (SELECT {key}, string_agg(piece, '' ORDER BY i) AS txt FROM mj GROUP BY {key})")


VALID_SQL = "v AS (SELECT * FROM m WHERE NOT is_system AND " + sql_nonblank("text") + ")"
NL = "\\n"  # the template's two characters backslash + n


def sql_render_part(role: str, content: str) -> str:
    return (f"CASE WHEN {role} = 'system' THEN 'System: ' || {content} || '{NL}{NL}' "
            f"WHEN {role} = 'user' THEN 'Human: ' || {content} || '{NL}' "
            f"WHEN {role} = 'assistant' THEN 'Assistant: ' || {content} || '{NL}{NL}' ELSE '' END")


def _valid(spark: SparkSession, sf: str) -> DataFrame:
    return filters.valid_messages(tables.event_messages(spark, sf), markers=["is_system"])


MSG_COLS = ["event_id", "channel", "date", "user", "ts_us"]
MSG_COLS_SQL = 'event_id, channel, date, "user", ts_us'

# ---------------------------------------------------------------------------
# Message filters
# ---------------------------------------------------------------------------


@register("human_messages", f"WITH {MSG_VIEW}, {VALID_SQL} SELECT {MSG_COLS_SQL} FROM v")
def q_human_messages(spark: SparkSession, sf: str) -> DataFrame:
    return _valid(spark, sf).select(*MSG_COLS)


@register("messages_by_channel", f"WITH {MSG_VIEW}, {VALID_SQL} SELECT {MSG_COLS_SQL} FROM v WHERE channel = 'click'")
def q_messages_by_channel(spark: SparkSession, sf: str) -> DataFrame:
    return filters.by_channel(_valid(spark, sf), "click").select(*MSG_COLS)


@register("by_date", f"WITH {MSG_VIEW}, {VALID_SQL} SELECT {MSG_COLS_SQL} FROM v WHERE date = '2024-01-05'")
def q_by_date(spark: SparkSession, sf: str) -> DataFrame:
    return filters.by_date(_valid(spark, sf), 2024, 1, 5).select(*MSG_COLS)


@register("by_date_prefix", f"WITH {MSG_VIEW}, {VALID_SQL} SELECT {MSG_COLS_SQL} FROM v WHERE starts_with(date, '2024-01-0')")
def q_by_date_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return filters.by_date_prefix(_valid(spark, sf), "2024-01-0").select(*MSG_COLS)


@register("by_user", f"WITH {MSG_VIEW}, {VALID_SQL} SELECT {MSG_COLS_SQL} FROM v WHERE \"user\" = '42'")
def q_by_user(spark: SparkSession, sf: str) -> DataFrame:
    return filters.by_user(_valid(spark, sf), "42").select(*MSG_COLS)


@register("where", f"WITH {MSG_VIEW}, {VALID_SQL} SELECT {MSG_COLS_SQL} FROM v "
                   "WHERE channel IN ('view', 'purchase') AND thread_ts IS NULL")
def q_where(spark: SparkSession, sf: str) -> DataFrame:
    pred = F.col("channel").isin("view", "purchase") & F.col("thread_ts").isNull()
    return filters.where(_valid(spark, sf), pred).select(*MSG_COLS)


@register("channel_names", "SELECT min(event_id) AS ord, event_type AS name FROM events GROUP BY event_type")
def q_channel_names(spark: SparkSession, sf: str) -> DataFrame:
    ch = tables.read_table(spark, sf, "events").groupBy("event_type").agg(F.min("event_id").alias("ord"))
    return filters.channel_names(ch.withColumnRenamed("event_type", "name"))


@register("union_exports", f"""WITH {MSG_VIEW}, {VALID_SQL},
a AS (SELECT channel, text, event_id FROM v UNION ALL SELECT role, text, NULL FROM conversations)
SELECT channel, count(*) AS n_messages, count(event_id) AS n_events, CAST(sum(length(text)) AS BIGINT) AS n_chars
FROM a GROUP BY channel""")
def q_union_exports(spark: SparkSession, sf: str) -> DataFrame:
    turns = tables.read_table(spark, sf, "conversations").select(F.col("role").alias("channel"), "text")
    return filters.union_exports(_valid(spark, sf).select("channel", "text", "event_id"), turns).groupBy("channel").agg(
        F.count(F.lit(1)).alias("n_messages"), F.count("event_id").alias("n_events"),
        F.sum(F.length("text")).alias("n_chars"))


# ---------------------------------------------------------------------------
# Author lookup and message projection
# ---------------------------------------------------------------------------
@register("author_name", f"""WITH {MSG_VIEW}, {VALID_SQL}, {USERS_SQL}
SELECT v.event_id, v.thread_ts, v.ts_us,
       CASE WHEN v."user" IS NULL OR v."user" = '' THEN 'Unknown User' ELSE coalesce(mu.real_name, v."user") END AS user_name
FROM v LEFT JOIN mu ON mu.id = v."user\"""")
def q_author_name(spark: SparkSession, sf: str) -> DataFrame:
    v = authors.resolve_author(_valid(spark, sf), tables.customer_users(spark, sf))
    return v.select("event_id", "thread_ts", "ts_us", "user_name")


# ---------------------------------------------------------------------------
# Text cleaning
# ---------------------------------------------------------------------------
@register("clean_mentions", f"WITH {MSG_VIEW}, {sql_mentions('m', 'event_id', 'text', 'cm')} "
                            "SELECT event_id, txt AS cleaned FROM cm")
def q_clean_mentions(spark: SparkSession, sf: str) -> DataFrame:
    m = tables.event_messages(spark, sf)
    out = authors.resolve_mentions(m, tables.customer_users(spark, sf), text="text", out="cleaned",
                                   key=["event_id"])
    return out.select("event_id", "cleaned")


_DOC_CH = "'<#C' || CAST(doc_id AS VARCHAR) || '|' || lang || '> ' || text || ' <#C' || CAST(doc_id AS VARCHAR) || '>'"


@register("clean_channels", f"SELECT doc_id, {sql_channels(_DOC_CH)} AS cleaned FROM documents")
def q_clean_channels(spark: SparkSession, sf: str) -> DataFrame:
    d = tables.read_table(spark, sf, "documents")
    did = F.col("doc_id").cast("string")
    t = F.concat(F.lit("<#C"), did, F.lit("|"), F.col("lang"), F.lit("> "), F.col("text"), F.lit(" <#C"), did, F.lit(">"))
    return d.select("doc_id", tx.replace_channel_refs(t).alias("cleaned"))


_PAGE_URL = ("'<' || url || '> <' || url || '|page> <' || url || '>,<' || url || '> <mailto:a@b.c> <' || url "
             "|| chr(160) || 'x> ' || html")


@register("clean_urls", f"SELECT page_id, {sql_urls(_PAGE_URL)} AS cleaned FROM pages")
def q_clean_urls(spark: SparkSession, sf: str) -> DataFrame:
    p = tables.read_table(spark, sf, "pages")
    u = F.col("url")
    t = F.concat(F.lit("<"), u, F.lit("> <"), u, F.lit("|page> <"), u, F.lit(">,<"), u, F.lit("> <mailto:a@b.c> <"),
                 u, F.lit(" x> "), F.col("html"))
    return p.select("page_id", tx.unwrap_urls(t).alias("cleaned"))


@register("clean_whitespace", f"SELECT doc_id, {sql_collapse('text')} AS cleaned FROM documents")
def q_clean_whitespace(spark: SparkSession, sf: str) -> DataFrame:
    d = tables.read_table(spark, sf, "documents")
    return d.select("doc_id", tx.collapse_ws("text").alias("cleaned"))


@register("clean_text", f"WITH {MSG_VIEW}, {sql_mentions('m', 'event_id', 'text', 'cm')} "
                        f"SELECT event_id, {sql_clean_rest('txt')} AS content FROM cm")
def q_clean_text(spark: SparkSession, sf: str) -> DataFrame:
    m = tables.event_messages(spark, sf)
    out = authors.clean_messages(m, tables.customer_users(spark, sf), text="text", out="content", key=["event_id"])
    return out.select("event_id", "content")


# ---------------------------------------------------------------------------
# More grouping settings
# ---------------------------------------------------------------------------
@register("gap_break", f"""WITH {MSG_VIEW},
b AS (SELECT *, lag(ts_num) OVER (PARTITION BY channel ORDER BY ts_num, event_id) AS pts FROM m)
SELECT event_id, CAST(pts IS NOT NULL AND ts_num - pts >= 1800.0 AS BIGINT) AS gap_break FROM b""")
def q_gap_break(spark: SparkSession, sf: str) -> DataFrame:
    m = tables.event_messages(spark, sf)
    out = sz.break_flags(m, keys=["channel"], order=["event_id"], thread=None, window=1800)
    return out.select("event_id", F.col("gap_break").cast("long").alias("gap_break"))


@register("thread_break", f"""WITH {MSG_VIEW},
b AS (SELECT *, row_number() OVER w AS rn, lag(thread_ts) OVER w AS pthr FROM m WINDOW w AS (ORDER BY ts_num, event_id))
SELECT event_id, CAST(rn > 1 AND thread_ts IS DISTINCT FROM pthr AS BIGINT) AS thread_break FROM b""")
def q_thread_break(spark: SparkSession, sf: str) -> DataFrame:
    m = tables.event_messages(spark, sf)
    out = sz.break_flags(m, order=["event_id"], thread="thread_ts", window=7200)
    return out.select("event_id", F.col("thread_break").cast("long").alias("thread_break"))


@register("cap_chunks", "WITH " + MSG_VIEW + "," + _sessionize_sql(None, 600, 3, 2, True)
          + " SELECT event_id, conv_id, conv_pos, conv_size FROM s6")
def q_cap_chunks(spark: SparkSession, sf: str) -> DataFrame:
    m = tables.event_messages(spark, sf)
    out = sz.sessionize(m, order=["event_id"], thread="thread_ts", window=600, max_messages=3, min_messages=2)
    return out.select("event_id", "conv_id", "conv_pos", "conv_size")


@register("min_size", "WITH " + MSG_VIEW + "," + _sessionize_sql('"user"', 86400, 5, 2, False) + _CONV_SUMMARY_SQL)
def q_min_size(spark: SparkSession, sf: str) -> DataFrame:
    m = tables.event_messages(spark, sf)
    out = sz.sessionize(m, keys=["user"], order=["event_id"], thread=None, window=86400,
                        max_messages=5, min_messages=2)
    return _conv_summary(out)


@register("sessionize_user", "WITH " + MSG_VIEW + "," + _sessionize_sql('"user"', 7200, 40, 2, False) + _CONV_SUMMARY_SQL)
def q_sessionize_user(spark: SparkSession, sf: str) -> DataFrame:
    m = tables.event_messages(spark, sf)
    out = sz.sessionize(m, keys=["user"], order=["event_id"], thread=None, window=7200,
                        max_messages=40, min_messages=2)
    return _conv_summary(out)


# ---------------------------------------------------------------------------
# Roles and conversations on events
# ---------------------------------------------------------------------------
_HUMAN_SQL = "h AS (SELECT * FROM m WHERE NOT is_system)"


def _grouped_clean(spark: SparkSession, sf: str, nonblank: bool) -> DataFrame:
    m = tables.event_messages(spark, sf)
    m = filters.valid_messages(m, markers=["is_system"]) if nonblank else filters.human_only(m, markers=["is_system"])
    s = sz.sessionize(m, order=["event_id"], thread="thread_ts", window=7200, max_messages=40, min_messages=2)
    return authors.clean_messages(s, tables.customer_users(spark, sf), text="text", out="content", key=["event_id"])


def _grouped_clean_sql(src: str) -> str:
    return (f"{MSG_VIEW}, {_HUMAN_SQL}, {VALID_SQL}," + _sessionize_sql(None, 7200, 40, 2, True, src=src) + ",\n"
            + sql_mentions("s6", "event_id", "text", "cm") + ",\n"
            f"c AS (SELECT s6.event_id, s6.conv_id, s6.conv_pos, {sql_clean_rest('cm.txt')} AS content "
            "FROM s6 JOIN cm ON cm.event_id = s6.event_id)")


@register("assign_roles", "WITH " + _grouped_clean_sql("h") + """,
k AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY conv_pos) - 1 AS msg_idx FROM c WHERE content <> '')
SELECT event_id, conv_id, msg_idx, CASE WHEN msg_idx % 2 = 0 THEN 'user' ELSE 'assistant' END AS role FROM k""")
def q_assign_roles(spark: SparkSession, sf: str) -> DataFrame:
    c = _grouped_clean(spark, sf, nonblank=False)
    return conversations.assign_roles(c).select("event_id", "conv_id", "msg_idx", "role")


@register("conversation_messages", "WITH " + _grouped_clean_sql("v") + """,
k AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY conv_pos) - 1 AS msg_idx FROM c WHERE content <> '')
SELECT conv_id, string_agg(CASE WHEN msg_idx % 2 = 0 THEN 'user' ELSE 'assistant' END || ': ' || content, chr(10)
                           ORDER BY msg_idx) AS messages
FROM k GROUP BY conv_id""")
def q_conversation_messages(spark: SparkSession, sf: str) -> DataFrame:
    m = _valid(spark, sf)
    s = sz.sessionize(m, order=["event_id"], thread="thread_ts", window=7200, max_messages=40, min_messages=2)
    conv = conversations.clean_and_collect(s, tables.customer_users(spark, sf))
    return conv.select("conv_id", conversations.messages_text(F.col("messages")).alias("messages"))


@register("conversation_length", "WITH " + _grouped_clean_sql("h") + """
SELECT conv_id, count(*) FILTER (WHERE content <> '') + 1 AS length FROM c GROUP BY conv_id""")
def q_conversation_length(spark: SparkSession, sf: str) -> DataFrame:
    c = _grouped_clean(spark, sf, nonblank=False)
    conv = conversations.collect_conversations(c, system_prompt=TRAINING_PROMPT)
    return conv.select("conv_id", F.col("length").cast("long").alias("length"))


# ---------------------------------------------------------------------------
# N1-N4, F13, F14 on the conversations table
# ---------------------------------------------------------------------------
def _table_convs(spark: SparkSession, sf: str) -> DataFrame:
    """Formatted conversations from ``conversations``: messages ordered by turn
    with their given roles."""
    c = tables.read_table(spark, sf, "conversations")
    g = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("_t"))
    msgs = F.transform(F.col("_t"), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    return g.select("conv_id", msgs.alias("messages"))


_RENDER_SQL = ("r AS (SELECT conv_id, count(*) AS length, '" + BOS + "' || string_agg("
               + sql_render_part("role", "text") + ", '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id)")


@register("with_system_prompt", """
WITH u AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS idx
           FROM conversations WHERE text <> '')
SELECT conv_id, CAST(0 AS BIGINT) AS idx, 'system' AS role, """ + _lit(TRAINING_PROMPT) + """ AS content
FROM conversations GROUP BY conv_id
UNION ALL
SELECT conv_id, idx, CASE WHEN idx % 2 = 1 THEN 'user' ELSE 'assistant' END AS role, text AS content FROM u""")
def q_with_system_prompt(spark: SparkSession, sf: str) -> DataFrame:
    c = tables.read_table(spark, sf, "conversations")
    c = c.select("conv_id", F.col("turn").alias("conv_pos"), F.col("text").alias("content"))
    conv = conversations.collect_conversations(c, system_prompt=TRAINING_PROMPT)
    return conv.select("conv_id", F.posexplode("messages").alias("idx", "m")).select(
        "conv_id", F.col("idx").cast("long").alias("idx"), F.col("m.role").alias("role"), F.col("m.content").alias("content"))


@register("render_template", f"WITH {_RENDER_SQL} SELECT conv_id, text FROM r")
def q_render_template(spark: SparkSession, sf: str) -> DataFrame:
    return _table_convs(spark, sf).select("conv_id", render_template(F.col("messages")).alias("text"))


@register("token_count", f"WITH {_RENDER_SQL} SELECT conv_id, CAST(ceil(strlen(text) / 4) AS BIGINT) AS n_tokens FROM r")
def q_token_count(spark: SparkSession, sf: str) -> DataFrame:
    ex = examples.with_token_count(examples.render(_table_convs(spark, sf)), octet_proxy)
    return ex.select("conv_id", F.col("n_tokens").cast("long").alias("n_tokens"))


@register("length_filter", f"WITH {_RENDER_SQL} SELECT conv_id, CAST(ceil(strlen(text) / 4) AS BIGINT) AS n_tokens "
                           "FROM r WHERE ceil(strlen(text) / 4) <= 512")
def q_length_filter(spark: SparkSession, sf: str) -> DataFrame:
    ex = examples.to_examples(_table_convs(spark, sf), octet_proxy, max_length=512, min_size=2)
    return ex.select("conv_id", F.col("n_tokens").cast("long").alias("n_tokens"))


@register("min_formatted", "SELECT conv_id, count(*) AS length FROM conversations GROUP BY conv_id HAVING count(*) >= 4")
def q_min_formatted(spark: SparkSession, sf: str) -> DataFrame:
    ex = examples.min_formatted(_table_convs(spark, sf).withColumn("length", F.size("messages")), 4)
    return ex.select("conv_id", F.col("length").cast("long").alias("length"))


# ---------------------------------------------------------------------------
# Split, sample, card, counters
# ---------------------------------------------------------------------------
_SPLIT_SQL = """sp AS (SELECT conv_id, md5('42:' || CAST(conv_id AS VARCHAR)) AS h FROM conversations GROUP BY conv_id),
sx AS (SELECT conv_id, h, CASE WHEN row_number() OVER (ORDER BY h) <= ceil(count(*) OVER () * CAST(0.1 AS DOUBLE))
                           THEN 'test' ELSE 'train' END AS split FROM sp)"""


def _split_convs(spark: SparkSession, sf: str) -> DataFrame:
    ids = tables.read_table(spark, sf, "conversations").select("conv_id").distinct()
    return split.split_exact(ids, "conv_id", seed=42, fraction=0.1)


@register("split_exact", f"WITH {_SPLIT_SQL} SELECT conv_id, split FROM sx")
def q_split_exact(spark: SparkSession, sf: str) -> DataFrame:
    return _split_convs(spark, sf).select("conv_id", "split")


@register("split_hash", """SELECT conv_id, CASE WHEN CAST('0x' || substr(md5('42:' || CAST(conv_id AS VARCHAR)), 1, 8) AS BIGINT)
       < 429496729 THEN 'test' ELSE 'train' END AS split FROM conversations GROUP BY conv_id""")
def q_split_hash(spark: SparkSession, sf: str) -> DataFrame:
    ids = tables.read_table(spark, sf, "conversations").select("conv_id").distinct()
    return split.split_hash(ids, "conv_id", seed=42, fraction=0.1).select("conv_id", "split")


@register("sample", f"WITH {_SPLIT_SQL} SELECT conv_id, h AS split_hash FROM sx WHERE split = 'train' ORDER BY h LIMIT 5")
def q_sample(spark: SparkSession, sf: str) -> DataFrame:
    return split.sample(_split_convs(spark, sf), 5).select("conv_id", "split_hash")


@register("dataset_card", f"""WITH {_SPLIT_SQL}
SELECT count(*) FILTER (WHERE split = 'train') AS train_samples, count(*) FILTER (WHERE split = 'test') AS eval_samples FROM sx""")
def q_dataset_card(spark: SparkSession, sf: str) -> DataFrame:
    from threadloom.sinks.dataset import dataset_card
    return dataset_card(_split_convs(spark, sf))


# ---------------------------------------------------------------------------
# Transcripts (conversations table with injected replies/commands)
# ---------------------------------------------------------------------------
_REPLY_SQL = ("CASE WHEN role = 'assistant' THEN text || chr(10) || 'Human: ' || text "
              "WHEN role = 'user' THEN '  ' || text || ' assistant: ok ' ELSE text || chr(10) END")


def _replies(spark: SparkSession, sf: str) -> DataFrame:
    c = tables.read_table(spark, sf, "conversations")
    t = F.col("text")
    reply = (F.when(F.col("role") == "assistant", F.concat(t, F.lit("\nHuman: "), t))
              .when(F.col("role") == "user", F.concat(F.lit("  "), t, F.lit(" assistant: ok ")))
              .otherwise(F.concat(t, F.lit("\n"))))
    return c.withColumn("text", reply)


_STOP_SQL = ("regexp_extract(" + _REPLY_SQL + ", '(?s)^(.*?(?:Human:|human:|Assistant:|assistant:))', 1)")


@register("stop_marker", f"SELECT conv_id, turn, {sql_strip(f'CASE WHEN {_STOP_SQL} <> {chr(39)}{chr(39)} THEN {_STOP_SQL} ELSE {_REPLY_SQL} END')} AS reply "
                         "FROM conversations")
def q_stop_marker(spark: SparkSession, sf: str) -> DataFrame:
    return transcripts.truncate_replies(_replies(spark, sf)).select("conv_id", "turn", "reply")


# control turns injected into user turns: turn 2 -> ' New ', turn 4 -> 'clear_history',
# turn 5 (assistant, not a command), turn 6 -> 'EXIT' in conversations whose id ends in 3
_CMD_SQL = ("CASE WHEN role = 'user' AND turn = 2 THEN ' New ' WHEN role = 'user' AND turn = 4 THEN 'clear_history' "
            "WHEN role = 'user' AND turn = 6 AND CAST(conv_id AS VARCHAR) LIKE '%3' THEN 'EXIT' ELSE text END")


def _transcript(spark: SparkSession, sf: str) -> DataFrame:
    c = tables.read_table(spark, sf, "conversations")
    r, turn = F.col("role") == "user", F.col("turn")
    t = (F.when(r & (turn == 2), F.lit(" New "))
          .when(r & (turn == 4), F.lit("clear_history"))
          .when(r & (turn == 6) & F.col("conv_id").cast("string").endswith("3"), F.lit("EXIT"))
          .when(F.col("turn") % 3 == 1, F.concat(F.lit("  "), F.col("text"), F.lit(" \n")))
          .otherwise(F.col("text")))
    return c.select(F.col("conv_id").alias("session_id"), "turn", "role", t.alias("text"))


_SEG_SQL = f"""t AS (SELECT conv_id AS session_id, turn, role, {_CMD_SQL} AS text FROM conversations),
tc AS (SELECT *, CASE WHEN role = 'user' THEN lower({sql_strip('text')}) END AS cmd FROM t),
ts AS (SELECT *, sum(CASE WHEN cmd IN ('new', 'clear_history') THEN 1 ELSE 0 END) OVER w AS segment,
              sum(CASE WHEN cmd = 'exit' THEN 1 ELSE 0 END) OVER w AS exited
       FROM tc WINDOW w AS (PARTITION BY session_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
seg AS (SELECT session_id, turn, role, text, CAST(segment AS BIGINT) AS segment FROM ts
        WHERE exited = 0 AND coalesce(cmd NOT IN ('new', 'clear_history', 'exit', 'info'), true))"""


@register("reset_segments", f"WITH {_SEG_SQL} SELECT session_id, turn, role, segment FROM seg")
def q_reset_segments(spark: SparkSession, sf: str) -> DataFrame:
    return transcripts.reset_segments(_transcript(spark, sf)).select("session_id", "turn", "role", "segment")


_SYS_LEN = len(BOS) + len("System: " + CHAT_PROMPT + NL + NL)


@register("turn_context", f"""WITH {_SEG_SQL},
cx AS (SELECT *, count(*) OVER w AS n, sum(length({sql_render_part('role', sql_strip('text'))})) OVER w AS chars
       FROM seg WINDOW w AS (PARTITION BY session_id, segment ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT session_id, turn, segment, CAST(n + 1 AS BIGINT) AS n_context, CAST(chars + {_SYS_LEN} AS BIGINT) AS context_chars
FROM cx WHERE role = 'user'""")
def q_turn_context(spark: SparkSession, sf: str) -> DataFrame:
    seg = transcripts.reset_segments(_transcript(spark, sf))
    ctx = transcripts.turn_context(seg, system_prompt=CHAT_PROMPT)
    return ctx.select("session_id", "turn", "segment", "n_context", "context_chars")


# ---------------------------------------------------------------------------
# Batching and fixed-length token rows
# ---------------------------------------------------------------------------
@register("length_batches", f"""WITH {_RENDER_SQL},
e AS (SELECT conv_id, CAST(ceil(strlen(text) / 4) AS BIGINT) AS n_tokens,
             CAST('0x' || substr(md5('42:' || CAST(conv_id AS VARCHAR)), 1, 8) AS BIGINT) AS u,
             greatest(1, ceil(count(*) OVER () / 200)) AS nm FROM r),
g AS (SELECT conv_id, n_tokens, CAST(floor(u * nm / 4294967296.0) AS BIGINT) AS megabatch FROM e)
SELECT conv_id, n_tokens, megabatch,
       CAST((row_number() OVER (PARTITION BY megabatch ORDER BY n_tokens DESC, conv_id) - 1) // 4 AS BIGINT) AS batch
FROM g""")
def q_length_batches(spark: SparkSession, sf: str) -> DataFrame:
    ex = examples.with_token_count(examples.render(_table_convs(spark, sf)), octet_proxy)
    ex = ex.withColumn("n_tokens", F.col("n_tokens").cast("long"))
    return batching.length_batches(ex, "conv_id", "n_tokens", batch_size=4, seed=42).select(
        "conv_id", "n_tokens", "megabatch", "batch")


@register("fixed_length_rows", """WITH t AS (SELECT conv_id, turn, list_transform(string_split(text, ''), lambda c: unicode(c)) AS tok
                                    FROM conversations),
k AS (SELECT conv_id, turn, list_slice(tok, greatest(len(tok) - 64 + 1, 1), greatest(len(tok) - 64 + 1, 1) + 63) AS kept FROM t),
p AS (SELECT conv_id, turn, list_concat(kept, list_transform(range(greatest(64 - len(kept), 0)), lambda i: 10)) AS ids FROM k)
SELECT conv_id, turn, array_to_string(ids, ',') AS input_ids,
       array_to_string(list_transform(ids, lambda x: CASE WHEN x = 10 THEN 0 ELSE 1 END), ',') AS attention_mask FROM p""")
def q_fixed_length_rows(spark: SparkSession, sf: str) -> DataFrame:
    c = tables.read_table(spark, sf, "conversations").withColumn("tokens", char_tokens(F.col("text")))
    out = batching.fixed_length(c, "tokens", length=64, pad=10)
    return out.select("conv_id", "turn", F.array_join("input_ids", ",").alias("input_ids"),
                      F.array_join("attention_mask", ",").alias("attention_mask"))


# ---------------------------------------------------------------------------
# End to end: events + customer -> examples with split
# ---------------------------------------------------------------------------
def end_to_end_examples(spark: SparkSession, sf: str, max_length: int = 2048) -> DataFrame:
    users = tables.customer_users(spark, sf)
    s = sz.sessionize(_valid(spark, sf), order=["event_id"], thread="thread_ts", window=7200, max_messages=40,
                      min_messages=2)
    convs = conversations.clean_and_collect(s, users, system_prompt=TRAINING_PROMPT)
    ex = examples.to_examples(convs, octet_proxy, max_length=max_length, min_size=2)
    return split.split_exact(ex, "conv_id", seed=42, fraction=0.1)


_E2E_SQL = ("WITH " + _grouped_clean_sql("v") + ",\n"
            "k AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY conv_pos) - 1 AS idx FROM c WHERE content <> ''),\n"
            "r AS (SELECT conv_id, count(*) + 1 AS length, '" + BOS + "' || 'System: ' || " + _lit(TRAINING_PROMPT)
            + " || '" + NL + NL + "' || string_agg(CASE WHEN idx % 2 = 0 THEN 'Human: ' || content || '" + NL
            + "' ELSE 'Assistant: ' || content || '" + NL + NL + "' END, '' ORDER BY idx) AS text FROM k GROUP BY conv_id),\n"
            "f AS (SELECT *, CAST(ceil(strlen(text) / 4) AS BIGINT) AS n_tokens FROM r WHERE length >= 2),\n"
            "sp AS (SELECT *, md5('42:' || conv_id) AS h FROM f WHERE n_tokens <= 2048)\n")


@register("end_to_end", _E2E_SQL + """SELECT conv_id, length, n_tokens, text,
       CASE WHEN row_number() OVER (ORDER BY h) <= ceil(count(*) OVER () * CAST(0.1 AS DOUBLE)) THEN 'test' ELSE 'train' END AS split
FROM sp""")
def q_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    ex = end_to_end_examples(spark, sf)
    return ex.select("conv_id", F.col("length").cast("long").alias("length"),
                     F.col("n_tokens").cast("long").alias("n_tokens"), "text", "split")


@register("stage_counters", _E2E_SQL + """,
sg AS (SELECT conv_id FROM s6 GROUP BY conv_id),
sx AS (SELECT CASE WHEN row_number() OVER (ORDER BY h) <= ceil(count(*) OVER () * CAST(0.1 AS DOUBLE)) THEN 'test' ELSE 'train' END AS split FROM sp)
SELECT 'messages_found' AS stage, count(*) AS n FROM v
UNION ALL SELECT 'conversations_grouped', count(*) FROM sg
UNION ALL SELECT 'conversations_formatted', count(*) FROM f
UNION ALL SELECT 'examples_skipped', count(*) FILTER (WHERE n_tokens > 2048) FROM f
UNION ALL SELECT 'train', count(*) FILTER (WHERE split = 'train') FROM sx
UNION ALL SELECT 'test', count(*) FILTER (WHERE split = 'test') FROM sx""")
def q_stage_counters(spark: SparkSession, sf: str) -> DataFrame:
    from threadloom.session import cut_lineage
    from threadloom.sinks.dataset import stage_counters
    users = tables.customer_users(spark, sf)
    v = _valid(spark, sf)
    s = sz.sessionize(v, order=["event_id"], thread="thread_ts", window=7200, max_messages=40, min_messages=2)
    convs = conversations.clean_and_collect(s, users, system_prompt=TRAINING_PROMPT)
    flagged = cut_lineage(examples.flag_examples(convs, octet_proxy, max_length=2048, min_size=2))
    ex = split.split_exact(flagged.filter(F.col("formatted") & ~F.col("skipped")), "conv_id", seed=42,
                           fraction=0.1, materialize=False)
    return stage_counters(v, flagged, ex)
