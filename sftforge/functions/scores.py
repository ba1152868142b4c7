"""Answer scores E1, E3-E5 and the bound of E2, all native expressions; E2 itself is in :mod:`similarity`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hint phrases that mark an answer as carrying a risk caveat.
RISK_HINT_TOKENS = (
    "建议咨询专业律师",
    "建议咨询律师",
    "需结合具体情况",
    "结合具体事实",
    "以法院认定为准",
    "以生效裁判为准",
    "需结合证据",
)

SCORE_DIGITS = 4


def keyword_hit_rate(answer: Column, keywords: Column) -> Column:
    """Share of keywords contained in the answer; 0.0 for no keywords.

    Empty keywords count in the denominator but never hit; duplicates count
    separately; matching is a case-sensitive substring test.
    """
    kws = F.coalesce(keywords, F.array().cast("array<string>"))
    ans = F.coalesce(answer, F.lit(""))
    hits = F.size(F.filter(kws, lambda k: (F.coalesce(k, F.lit("")) != "") & ans.contains(k)))
    n = F.size(kws)
    return F.when(n == 0, F.lit(0.0)).otherwise(hits.cast("double") / n.cast("double"))


def has_risk_hint(answer: Column, tokens=RISK_HINT_TOKENS) -> Column:
    """True when any hint phrase is contained in the answer."""
    ans = F.coalesce(answer, F.lit(""))
    flag = F.lit(False)
    for t in tokens:
        flag = flag | ans.contains(F.lit(t))
    return flag


def answer_length(answer: Column) -> Column:
    """Length in code points."""
    return F.length(F.coalesce(answer, F.lit(""))).cast("int")


def similarity_upper_bound(answer: Column, reference: Column) -> Column:
    """``2*min(la,lb)/(la+lb)``, 1.0 when both are empty: what lengths alone allow of a matching-blocks ratio."""
    la = F.length(F.coalesce(answer, F.lit(""))).cast("double")
    lb = F.length(F.coalesce(reference, F.lit(""))).cast("double")
    return F.when(la + lb == 0, F.lit(1.0)).otherwise(2.0 * F.least(la, lb) / (la + lb))


def round_score(x: Column) -> Column:
    """Round to 4 places for display (E5), as the decimal value of the double says exactly; ties go to the even digit.

    ``x * 20000`` is computed as the unevaluated sum of two doubles (by splitting
    x in two halves), so whether x lies above, below or on the middle of two
    4-place numbers is decided without an error.  Values of 2**37 and more, whose
    places beyond the fourth a double hardly holds, stay as they are.
    """
    x = x.cast("double")
    size = F.abs(x)
    twice = 2.0 * 10.0 ** SCORE_DIGITS
    large = size * F.lit(134217729.0)
    high = large - (large - size)
    product = size * F.lit(twice)
    error = (high * F.lit(twice) - product) + (size - high) * F.lit(twice)
    half = product / 2.0
    low = F.floor(half).cast("double")
    low = F.when((low == half) & (error < 0), low - 1.0).otherwise(low)
    above = (product - 2.0 * low - 1.0) + error  # the sign of x less the middle
    up = (above > 0) | ((above == 0) & (low % 2.0 == 1.0))
    rounded = F.when(up, low + 1.0).otherwise(low) / (10.0 ** SCORE_DIGITS)
    return F.when(size < float(1 << 37), F.signum(x) * rounded).otherwise(x)
