"""Reproducible shuffle-and-cap (P11, P13) and the holdout split (H1).

The order is ``md5(seed | instruction | input)``: identical in Spark, DuckDB and
Python, and independent of partitioning (``orderBy(rand(seed))`` is not).

A cap of n is a threshold on the key: :func:`cap_threshold` finds the n-th
smallest distinct key by counting distinct keys per next four hex digits and
descending into the bucket that holds it (at most 65,536 counts a step, over the
key column alone), and every row below the threshold stays.  No ranking, no
window, no single-task limit, and the filter applies *before* the dedup shuffle,
as every copy of a key has the same key.

Distinct md5 keys equal distinct dedup keys unless two of them collide in md5
(about 1e-19 at 10**10 keys); a collision would let one extra row through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP_DIGITS = 4
KEY_DIGITS = 32
HOLDOUT_BUCKETS = 10_000
KEY = "_skey"


def sample_key(seed: int, *cols: Column) -> Column:
    """32-hex-digit order key ``md5(seed|c1|c2...)``."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *cols))


def key_counts(keyed: DataFrame, prefix: str = "", key_name: str = KEY) -> list[tuple[str, int]]:
    """Sorted (prefix and four more digits, distinct keys) of the keys that begin with ``prefix``."""
    k = F.col(key_name)
    rows = (keyed.where(k.startswith(prefix)) if prefix else keyed).select(k)
    counts = rows.groupBy(F.substring(k, 1, len(prefix) + STEP_DIGITS).alias("p")).agg(F.count_distinct(k).alias("n"))
    return sorted((r["p"], int(r["n"])) for r in counts.collect())


def cap_threshold(keyed: DataFrame, n: int, key_name: str = KEY) -> str | None:
    """A string above exactly the ``n`` smallest distinct keys; None if there are no more than ``n``."""
    if n <= 0:
        return ""
    prefix, before = "", 0
    while True:
        for bucket, count in key_counts(keyed, prefix, key_name):
            if before + count >= n:
                break
            before += count
        else:
            return None
        if before + count == n or len(bucket) == KEY_DIGITS:
            return bucket + "g"  # above every hex digit
        prefix = bucket


def below(keyed: DataFrame, threshold: str | None, key_name: str = KEY) -> DataFrame:
    """Rows whose key lies below the threshold of :func:`cap_threshold`."""
    return keyed if threshold is None else keyed.where(F.col(key_name) < F.lit(threshold))


def first_n_by_key(df: DataFrame, key: Column, n: int, key_name: str = KEY) -> DataFrame:
    """The rows of the ``n`` smallest keys (runs the counting jobs now)."""
    keyed = df.withColumn(key_name, key)
    return below(keyed, cap_threshold(keyed, n, key_name), key_name)


def holdout_split(seed: int, *cols: Column, val_size: float = 0.02) -> Column:
    """'eval' for about ``val_size`` of the keys, else 'train' (H1).

    Bucket = first 8 hex digits of ``md5(seed|holdout|cols)`` mod 10,000, so the
    split is stable per key and independent of the sample order.
    """
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("holdout"), *cols))
    bucket = F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") % HOLDOUT_BUCKETS
    cut = int(round(val_size * HOLDOUT_BUCKETS))
    return F.when(bucket < cut, F.lit("eval")).otherwise(F.lit("train"))
