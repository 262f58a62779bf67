"""Chat-template rendering and stop-marker truncation as Column
expressions (higher-order array functions, no Python)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom.functions.text import strip_ws

# ---------------------------------------------------------------------------
# Fixed values (the chat template and markers the reference uses)
# ---------------------------------------------------------------------------
BOS = "<|begin_of_text|>"
# The template text holds a backslash followed by "n" (two characters), not a
# newline; ``newline="real"`` renders real newlines instead.
LITERAL_NL = "\\n"
# role -> (prefix, suffix); any other role renders nothing
ROLE_FORMAT = {
    "system": ("System: ", "{nl}{nl}"),
    "user": ("Human: ", "{nl}"),
    "assistant": ("Assistant: ", "{nl}{nl}"),
}
STOP_MARKERS = ("Human:", "human:", "Assistant:", "assistant:")
CONTROL_COMMANDS = ("exit", "new", "clear_history", "info")
# ---------------------------------------------------------------------------


def role_parts(newline: str = "literal") -> dict[str, tuple[str, str]]:
    nl = LITERAL_NL if newline == "literal" else "\n"
    return {r: (p, s.format(nl=nl)) for r, (p, s) in ROLE_FORMAT.items()}


def render_message(role: Column, content: Column, newline: str = "literal",
                   role_format: dict[str, tuple[str, str]] | None = None) -> Column:
    parts = role_format or role_parts(newline)
    expr = None
    for r, (pre, suf) in parts.items():
        piece = F.concat(F.lit(pre), content, F.lit(suf))
        expr = F.when(role == F.lit(r), piece) if expr is None else expr.when(role == F.lit(r), piece)
    return expr.otherwise(F.lit(""))


def render_template(messages: Column, newline: str = "literal", bos: str = BOS,
                    role_format: dict[str, tuple[str, str]] | None = None) -> Column:
    """``bos`` + each message rendered by role, joined without separator."""
    body = F.array_join(F.transform(messages, lambda m: render_message(m["role"], m["content"], newline, role_format)), "")
    return F.concat(F.lit(bos), body)


def with_system_prompt(messages: Column, prompt: str | None) -> Column:
    """Prepend ``{"role": "system", "content": prompt}`` when the prompt is
    non-empty."""
    if not prompt:
        return messages
    sys_msg = F.struct(F.lit("system").alias("role"), F.lit(prompt).alias("content"))
    return F.concat(F.array(sys_msg), messages)


def truncate_at_stop(text: Column, markers=STOP_MARKERS) -> Column:
    """Cut a generated reply after the first stop marker (the marker is
    kept), then strip surrounding whitespace as the reply decoding does."""
    alt = "|".join(re.escape(m) for m in markers)
    pat = "(?s)^(.*?(?:" + alt + "))"
    cut = F.regexp_extract(text, pat, 1)
    return strip_ws(F.when(cut != F.lit(""), cut).otherwise(text))
