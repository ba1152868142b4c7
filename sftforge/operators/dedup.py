"""First-wins deduplication (P10).

``groupBy(digest of keys).agg(min_by(struct(row), order))``: the aggregate has a
partial (map-side) phase, so a hot key collapses to one row per input partition
before the shuffle, and the survivor is fixed by ``order`` rather than by task
timing (``dropDuplicates`` gives no such promise).  What is hashed, shuffled and
sorted by is a SHA-256 of the keys, 32 bytes, never the texts; of two keys with
one SHA-256 none is known, so equal digests are equal keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftforge.functions.text import quote


def key_digest(df: DataFrame, keys) -> Column:
    """SHA-256 of the keys, each with its length before it (null: told from any value), so that no two lists read alike."""
    parts = []
    for k in keys:
        nested = isinstance(df.schema[k].dataType, (T.ArrayType, T.StructType, T.MapType))
        text = F.to_json(F.struct(F.col(quote(k)))) if nested else F.col(quote(k)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def dedup_first(df: DataFrame, keys=("instruction", "input"),
                order: str | Column = "_ord", drop_order: bool = False) -> DataFrame:
    """Keep, for every distinct ``keys`` tuple, the row with the smallest ``order``.

    ``order`` must be unique per row (a long, or a struct such as the
    ``(split, file, block, row)`` key the readers attach); the output keeps the
    input's column order.  Nulls are equal to each other, as in a ``groupBy``.
    """
    keys = list(keys)
    order_col = F.col(quote(order)) if isinstance(order, str) else order
    kept = [c for c in df.columns if not (isinstance(order, str) and drop_order and c == order)]
    first = F.min_by(F.struct(*[F.col(quote(c)) for c in kept]), order_col).alias("_first")
    grouped = df.groupBy(key_digest(df, keys).alias("_digest")).agg(first)
    return grouped.select(*[F.col("_first").getField(c).alias(c) for c in kept])
