"""Fold a chat ``messages`` array into (user text, assistant text) (P5).

Works on ``ARRAY<STRUCT<...>>`` columns whose struct carries any subset of
``role``, ``from``, ``content``, ``value``.  Uses only native higher-order
functions (``filter``/``transform``/``array_join``), so each row is folded in
place with no shuffle.  Turn-per-row chat tables are folded by
:mod:`sftforge.operators.fold` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftforge.functions.text import normalize_text, quote

# Role names recognised on each side (compared case-sensitively).
USER_ROLES = ("user", "human")
ASSISTANT_ROLES = ("assistant", "gpt")
PART_SEPARATOR = "\n"


def _first_set(m: Column, fields: set[str], first: str, second: str) -> Column:
    """``m.first or m.second`` with Python truthiness for strings (null/'' fall through)."""
    a = m[first].cast("string") if first in fields else None
    b = m[second].cast("string") if second in fields else None
    if a is None and b is None:
        return F.lit(None).cast("string")
    if a is None:
        return b
    if b is None:
        return a
    return F.when(F.coalesce(a, F.lit("")) != "", a).otherwise(b)


def message_role(m: Column, fields: set[str]) -> Column:
    return _first_set(m, fields, "role", "from")


def message_content(m: Column, fields: set[str]) -> Column:
    return _first_set(m, fields, "content", "value")


def fold_side(messages: Column, fields: set[str], roles: tuple[str, ...]) -> Column:
    """Normalized non-empty contents of messages with one of ``roles``, newline-joined."""
    picked = F.filter(messages, lambda m: m.isNotNull() & message_role(m, fields).isin(*roles))
    parts = F.transform(picked, lambda m: normalize_text(message_content(m, fields)))
    kept = F.filter(parts, lambda p: p != "")
    return F.coalesce(F.array_join(kept, PART_SEPARATOR), F.lit(""))


def fold_messages(df: DataFrame, column: str = "messages") -> tuple[Column, Column] | None:
    """(user text, assistant text) for ``df[column]``; None when it is not a list column."""
    if column not in df.columns:
        return None
    dtype = df.schema[column].dataType
    if not isinstance(dtype, T.ArrayType):
        return None
    elem = dtype.elementType
    if not isinstance(elem, T.StructType):
        # A list of non-objects: every element is skipped.
        return F.lit(""), F.lit("")
    fields = set(elem.fieldNames())
    if not ({"role", "from"} & fields) or not ({"content", "value"} & fields):
        return F.lit(""), F.lit("")
    msgs = F.col(quote(column))
    return fold_side(msgs, fields, USER_ROLES), fold_side(msgs, fields, ASSISTANT_ROLES)
