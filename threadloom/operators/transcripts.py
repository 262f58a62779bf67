"""The chat loop's data steps over a transcript table
``(session_id, turn, role, text)``.

* R1 ``truncate_replies``: a generated reply is cut after the first stop
  marker and stripped.
* R2 ``reset_segments``: user turns ``new``/``clear_history`` (trimmed,
  case-folded) start a new segment, ``exit`` ends the session, ``info`` is a
  no-op; control turns are removed.
* R3 ``turn_context``: for each user turn, the model context is the system
  message, every earlier turn of the segment and the turn itself.  The output
  is linear in the input: the number of context messages and the rendered
  context length (prefix sums), not a copy of the history per turn.

* R3 ``context_window``: the same cut to a token budget, as one row a user turn
  with the first message that still fits.

Running counts use the bucketed prefix scan, so a long session is spread over
many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.template import BOS, CONTROL_COMMANDS, render_message, truncate_at_stop
from threadloom.functions.text import strip_ws
from threadloom.functions.tokens import TokenCounter, octet_proxy
from threadloom.operators.scan import prefix_scan

TURN_BUCKET = 4096
TOKEN_BUCKET = 1 << 18


def truncate_replies(df: DataFrame, text: str = "text", out: str = "reply") -> DataFrame:
    return df.withColumn(out, truncate_at_stop(F.col(text)))


def _command(text: str) -> F.Column:
    return F.lower(strip_ws(F.col(text)))


def reset_segments(df: DataFrame, session: str = "session_id", turn: str = "turn",
                   role: str = "role", text: str = "text") -> DataFrame:
    """Adds ``segment`` (0-based) and removes control turns and everything
    from ``exit`` on."""
    cmd = F.when(F.col(role) == F.lit("user"), _command(text))
    x = (df.withColumn("_reset", F.when(cmd.isin("new", "clear_history"), 1).otherwise(0))
           .withColumn("_exit", F.when(cmd == F.lit("exit"), 1).otherwise(0))
           .withColumn("_ctrl", F.coalesce(cmd.isin(*CONTROL_COMMANDS), F.lit(False))))
    x = prefix_scan(x, [session], [turn], F.floor(F.col(turn) / TURN_BUCKET),
                    {"segment": ("sum", "_reset"), "_exited": ("sum", "_exit")})
    return (x.filter((F.col("_exited") == 0) & ~F.col("_ctrl"))
             .withColumn("segment", F.col("segment").cast("long"))
             .drop("_reset", "_exit", "_ctrl", "_exited"))


def turn_context(df: DataFrame, system_prompt: str = "", session: str = "session_id",
                 turn: str = "turn", role: str = "role", text: str = "text",
                 newline: str = "literal") -> DataFrame:
    """R3 on the output of :func:`reset_segments`: for every user turn,
    ``n_context`` (messages in the model input, system included) and
    ``context_chars`` (length of the rendered input).  Texts enter the context
    without surrounding white space, as the chat loop strips input and reply."""
    part = render_message(F.col(role), strip_ws(F.col(text)), newline)
    sys_len = len(BOS) + len(render_message_text("system", system_prompt, newline))
    x = (df.withColumn("_one", F.lit(1))
           .withColumn("_len", F.length(part).cast("long")))
    x = prefix_scan(x, [session, "segment"], [turn], F.floor(F.col(turn) / TURN_BUCKET),
                    {"_n": ("sum", "_one"), "_chars": ("sum", "_len")})
    return (x.filter(F.col(role) == F.lit("user"))
             .withColumn("n_context", (F.col("_n") + 1).cast("long"))
             .withColumn("context_chars", (F.col("_chars") + F.lit(sys_len)).cast("long"))
             .drop("_one", "_len", "_n", "_chars"))


def context_messages(df: DataFrame, last_k: int, system_prompt: str = "", session: str = "session_id",
                     turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """R3 itself, bounded: for every user turn the ``context`` array the model
    gets - the system message and the last ``last_k`` messages of the segment,
    the turn included, stripped.

    A segment is cut into runs of messages, and the last ``last_k - 1`` of a run also
    lead the next one, so a long segment is spread over its runs."""
    if last_k < 1:
        raise ValueError("last_k must be at least 1")
    own = F.struct(F.col(role).alias("role"), strip_ws(F.col(text)).alias("content"))
    size = max(TURN_BUCKET, last_k)
    x = prefix_scan(df.withColumn("_one", F.lit(1)), [session, "segment"], [turn], F.floor(F.col(turn) / TURN_BUCKET),
                    {"_no": ("sum", "_one")})
    run = F.floor((F.col("_no") - 1) / size)
    leads = F.pmod(F.col("_no") - 1, F.lit(size)) > size - last_k
    x = x.withColumn("_run", F.explode(F.when(leads, F.array(run, run + 1)).otherwise(F.array(run))))
    w = Window.partitionBy(session, "segment", "_run").orderBy("_no").rowsBetween(-(last_k - 1), Window.currentRow)
    x = (x.withColumn("context", F.collect_list(own).over(w))
          .filter((F.col(role) == F.lit("user")) & (F.col("_run") == run)).drop("_one", "_no", "_run"))
    system = F.struct(F.lit("system").alias("role"), F.lit(system_prompt).alias("content"))
    return x.withColumn("context", F.concat(F.array(system), F.col("context")))


def context_window(df: DataFrame, budget: int | Sequence[int], counter: TokenCounter = octet_proxy, system_prompt: str = "",
                   session: str = "session_id", turn: str = "turn", role: str = "role", text: str = "text",
                   newline: str = "literal") -> DataFrame:
    """R3 within a token budget, on the output of :func:`reset_segments`: for
    every user turn (and every budget, if several are given) the longest run of
    whole messages that ends with it and fits beside the system message.

    One row a turn and budget: session, ``segment``, turn, ``budget``, ``first_turn``
    (of that run), ``n_context`` (its messages and the system's), ``context_tokens``
    (of the context as cut) and ``cut_tokens``: 0, or by how much the turn alone is
    over the budget (``first_turn`` is then the turn itself, of which so much is to be
    cut; all of it beside a system message over the budget).  A message's tokens are
    those of its rendered form.

    With P(f) the tokens before message f and S(t) those up to t, f is the first
    with P(f) >= S(t) + system - budget.  P grows with f, so the search is one
    running minimum over messages and turns laid out by P and that bound
    together, cut into buckets of tokens: output and shuffles are linear, and a
    long session is spread over its buckets."""
    budgets = [int(budget)] if isinstance(budget, int) else sorted({int(b) for b in budget})
    c = F.col
    part = render_message(c(role), strip_ws(c(text)), newline)
    system = counter(F.lit(BOS + render_message_text("system", system_prompt, newline))).cast("long")
    key = [session, "segment"]
    x = df.select(*key, turn, (c(role) == F.lit("user")).alias("_user"),
                  F.coalesce(counter(part), F.lit(0)).cast("long").alias("_n"), F.lit(1).alias("_one"))
    x = prefix_scan(x, key, [turn], F.floor(c(turn) / TURN_BUCKET), {"_sum": ("sum", "_n"), "_no": ("sum", "_one")})
    before = c("_sum") - c("_n")
    # descending by the value: a message at P, and behind it, at the same value, the turns that ask for it
    messages = x.select(*key, (-before).alias("_v"), F.lit(0).alias("_asks"),
                        F.struct(c("_no").alias("no"), c(turn).alias("turn"), before.alias("before")).alias("_m"),
                        *[F.lit(None).cast(kind).alias(name) for name, kind in x.dtypes if name not in key],
                        F.lit(None).cast("long").alias("budget"))
    asks = (x.filter("_user").withColumn("budget", F.explode(F.array(*[F.lit(b).cast("long") for b in budgets])))
            .withColumns({"_v": c("budget") - c("_sum") - system, "_asks": F.lit(1),
                          "_m": F.lit(None).cast(messages.schema["_m"].dataType)}))
    laid = messages.unionByName(asks)
    found = prefix_scan(laid, key, ["_v", "_asks"], F.floor(c("_v") / TOKEN_BUCKET), {"_first": ("min", "_m")}).filter("_asks = 1")
    alone = c("_first").isNull() | (c("_first")["no"] > c("_no"))  # not even the turn itself fits
    cut = F.when(alone, F.least(c("_n"), c("_n") + system - c("budget"))).otherwise(F.lit(0))
    tokens = F.when(alone, c("_n")).otherwise(c("_sum") - c("_first")["before"])
    return found.select(*key, turn, "budget", F.when(alone, c(turn)).otherwise(c("_first")["turn"]).alias("first_turn"),
                        F.when(alone, F.lit(2)).otherwise(c("_no") - c("_first")["no"] + 2).cast("long").alias("n_context"),
                        (tokens + system - cut).cast("long").alias("context_tokens"), cut.cast("long").alias("cut_tokens"))


def render_message_text(role: str, content: str, newline: str = "literal") -> str:
    from threadloom.functions.template import role_parts
    pre, suf = role_parts(newline).get(role, ("", ""))
    return pre + content + suf if role in role_parts(newline) else ""
