"""Token counters, pluggable.

``octet_proxy`` and ``word_proxy`` are native Column expressions (checkable in
SQL).  ``tokenizer_counter`` runs a real tokenizer (a ``tokenizers`` JSON file)
as an Arrow-batched iterator pandas UDF; the tokenizer is loaded once per
Python worker, never per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.functions.text import NON_WS_CLASS

TokenCounter = Callable[[Column], Column]


def octet_proxy(text: Column) -> Column:
    """``ceil(octet_length / 4)``: a byte-based estimate of BPE tokens."""
    return F.ceil(F.octet_length(text) / F.lit(4)).cast("int")


def word_proxy(text: Column) -> Column:
    """Number of whitespace-separated words."""
    return F.size(F.regexp_extract_all(text, F.lit(NON_WS_CLASS + "+"), 0)).cast("int")


_TOKENIZERS: dict[str, object] = {}


def _load(path: str):
    tok = _TOKENIZERS.get(path)
    if tok is None:
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        _TOKENIZERS[path] = tok
    return tok


def _isolated(values: list, run) -> list:
    """``run`` over the batch; if that fails, one by one with null for a failing value."""
    if not values:
        return []
    try:
        return run(values)
    except Exception:
        if len(values) == 1:
            return [None]
        return [x for v in values for x in _isolated([v], run)]


def python_counter(count: Callable[[str], int]) -> TokenCounter:
    """Any Python function as a token counter, in Arrow batches.  A text on
    which it raises yields NULL, so one bad text skips one example (F15)."""

    @F.pandas_udf(T.IntegerType())
    def count_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([None if v is None else _isolated([v], lambda one: [count(one[0])])[0] for v in s],
                            dtype="Int32")

    return count_tokens


def tokenizer_counter(path: str, add_special_tokens: bool = True) -> TokenCounter:
    """Token count with a real tokenizer file.  With ``add_special_tokens`` the
    tokenizer's post-processor adds its BOS, as ``encode`` does in the
    reference (so a rendered text that already starts with BOS counts it
    twice).  A text the tokenizer cannot handle yields NULL (F15)."""

    @F.pandas_udf(T.IntegerType())
    def count_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tok = _load(path)
        for s in batches:
            vals = s.where(s.notna(), None).tolist()
            ok = [v for v in vals if v is not None]
            it = iter(_isolated(ok, lambda part: [len(e.ids) for e in tok.encode_batch(
                part, add_special_tokens=add_special_tokens)]))
            yield pd.Series([next(it) if v is not None else None for v in vals], dtype="Int32")

    return count_tokens


def tokenizer_ids(path: str, add_special_tokens: bool = True) -> TokenCounter:
    """Token ids with a real tokenizer file (array<int>)."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tok = _load(path)
        for s in batches:
            ok = [v for v in s if v is not None]
            it = iter(_isolated(ok, lambda part: [e.ids for e in tok.encode_batch(
                part, add_special_tokens=add_special_tokens)]))
            yield pd.Series([next(it) if v is not None else None for v in s], dtype=object)

    return ids


def char_tokens(text: Column) -> Column:
    """A vocabulary-free stand-in tokenizer: one id per character (its code
    point).  Used where token arrays are needed without a model vocabulary."""
    return F.transform(F.split(text, "", -1), lambda c: F.ascii(c))
