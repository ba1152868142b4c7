"""Text normalization (P1), candidate-column picking (P2-P4) and strip.

All functions return native Spark ``Column`` expressions, so they stay inside
whole-stage codegen and also work on streaming DataFrames.
"""

from __future__ import annotations

import logging
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# Fixed values.  Python's str regex ``\s`` matches exactly the code points for
# which ``str.isspace()`` is true: U+0009-U+000D, U+001C-U+0020, U+0085, U+00A0,
# U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.  Java's ``\s``
# covers only the ASCII ones, so the class spells them all out as ranges.
WHITESPACE_CLASS = (
    "[\\t-\\r\\x1c- \\x85\\xa0\\u1680\\u2000-\\u200a"
    "\\u2028\\u2029\\u202f\\u205f\\u3000]"
)
# The same class for RE2 (DuckDB oracles); RE2's \s lacks \x0b.
WHITESPACE_CLASS_RE2 = (
    "[\\s\\x{0b}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
)
REPLACEMENT_CHAR = "\ufffd"

# The candidate column names, in priority order.
INSTRUCTION_CANDIDATES = (
    "instruction", "question", "query", "prompt", "input", "ask", "user", "title",
)
OUTPUT_CANDIDATES = (
    "output", "answer", "response", "chosen", "assistant", "content", "target",
)

_ATOMIC = (T.StringType, T.NumericType, T.BooleanType, T.DateType,
           T.TimestampType, T.TimestampNTZType, T.BinaryType)


def quote(name: str) -> str:
    """Backtick-quote a column name so dots and spaces are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def normalize_text(c: Column) -> Column:
    """null -> '', every whitespace run -> one space, ends stripped."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.trim(F.regexp_replace(text, F.lit(WHITESPACE_CLASS + "+"), F.lit(" ")))


def strip_text(c: Column) -> Column:
    """Python ``str.strip()``: remove leading and trailing Unicode whitespace."""
    pattern = f"\\A{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+\\z"
    return F.regexp_replace(F.coalesce(c, F.lit("")), F.lit(pattern), F.lit(""))


def exact_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Make raw column names safe for case-sensitive lookup.

    Spark resolves names case-insensitively, so a table holding both
    ``Question`` and ``question`` makes ``col('question')`` ambiguous.  When that
    happens every column is renamed positionally to a unique internal name; the
    returned map goes from the raw (exact) name to the name to use.
    """
    cols = df.columns
    if all(n == 1 for n in Counter(c.lower() for c in cols).values()):
        return df, {c: c for c in cols}
    internal = [f"__raw{i}" for i in range(len(cols))]
    return df.toDF(*internal), dict(zip(cols, internal))


def candidate_columns(df: DataFrame, names: tuple[str, ...] | list[str],
                      name_map: dict[str, str] | None = None) -> list[str]:
    """Internal names of the candidates present in ``df``, in priority order.

    Matching is exact and case-sensitive.  Non-atomic columns (arrays, structs,
    maps) are skipped with a warning.
    """
    name_map = name_map or {c: c for c in df.columns}
    types = {f.name: f.dataType for f in df.schema.fields}
    picked = []
    for raw in names:
        if raw not in name_map:
            continue
        internal = name_map[raw]
        if not isinstance(types[internal], _ATOMIC):
            log.warning("candidate column %r has non-atomic type %s; skipped",
                        raw, types[internal].simpleString())
            continue
        picked.append(internal)
    return picked


def pick_first(df: DataFrame, names, name_map: dict[str, str] | None = None) -> Column:
    """First non-empty normalized value among the candidate columns, else '' (P2).

    Each candidate is normalized exactly once: ``nullif``/``when`` would run
    the winner's regex twice (test and result), since Spark does not share
    subexpressions across conditional branches.
    """
    present = candidate_columns(df, names, name_map)
    if not present:
        return F.lit("")
    values = F.array(*[normalize_text(F.col(quote(c))) for c in present])
    return F.coalesce(F.get(F.filter(values, lambda v: v != ""), 0), F.lit(""))
