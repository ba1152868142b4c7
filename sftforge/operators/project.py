"""Projection helpers that keep expensive columns evaluated once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftforge.functions.text import quote


def evaluate_once(df: DataFrame) -> DataFrame:
    """Return ``df`` unchanged, but with its computed columns fixed as values.

    Catalyst pushes a filter below the projection that defines the columns it
    reads and substitutes their expressions into the condition.  For a
    whole-document regex read by a multi-branch predicate (the quality checks)
    that runs the regex once per reference in the filter and once more in the
    projection.  A one-element ``inline`` is a Generate node, which predicates
    on its output cannot cross, so downstream filters read the values computed
    here.  Measured 3x faster on the quality filter at sf0.1.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(quote(c)) for c in df.columns]))))
