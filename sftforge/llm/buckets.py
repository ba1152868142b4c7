"""Pairs within groups of equal keys, with large groups dealt to many tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (members' and probes' values, which are probes, block of each, are two blocks crossed) -> pairs
Match = Callable[[np.ndarray, np.ndarray, np.ndarray, bool], tuple[np.ndarray, np.ndarray]]


def dealt(rows: DataFrame, keys: list[str], own: list[str], block: int) -> DataFrame:
    """``rows`` with block numbers ``p`` <= ``q`` and ``own``: groups of equal (keys, p, q) meet all pairs of a key.

    A key of more than ``block`` rows is cut into blocks by the hash of the
    columns ``own``, and each pair of blocks is a group, so no group is larger
    than about two blocks.  Smaller keys are one group.
    """
    hot = (rows.groupBy(*keys).count().where(F.col("count") > block)
           .select(*keys, F.ceil(F.col("count") / F.lit(block)).cast("int").alias("blocks")))
    blocks = F.coalesce("blocks", F.lit(1))
    cut = (rows.join(hot, keys, "left").withColumn("own", F.pmod(F.xxhash64(*own), blocks).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))))
    return (cut.withColumn("p", F.least("own", "other")).withColumn("q", F.greatest("own", "other"))
            .drop("blocks", "other"))


def pairs_of(signs: DataFrame, match: Match, block: int) -> DataFrame:
    """Pairs (a, b) that ``match`` finds within the groups of ``signs(part, key, value, probe)``, dealt in blocks."""
    keys = ("part", "key", "p", "q")
    groups = dealt(signs, ["part", "key"], ["value"], block).select(*keys, "value", "probe", "own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, keys):
            c = {k: t.column(k).to_numpy() for k in (*keys, "own")}
            value, probe = t.column("value").to_numpy(), np.array(t.column("probe").to_numpy(), bool)
            first, last = group_bounds([c[k] for k in keys])
            found = [match(value[s:e], probe[s:e], c["own"][s:e], bool(c["p"][s] != c["q"][s]))
                     for s, e in zip(first.tolist(), last.tolist()) if e - s > 1]
            cat = lambda i: pa.array(np.concatenate([x[i] for x in found]) if found else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([cat(0), cat(1)], names=["a", "b"])

    return groups.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def group_bounds(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First row and end of each run of equal keys."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    return first, np.append(first[1:], n)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Join batches sorted by ``keys`` so that no group is cut between two tables."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[-1] for k in keys]
        same = np.ones(batch.num_rows, bool)
        for k, v in zip(keys, last):
            same &= batch.column(k).to_numpy(zero_copy_only=False) == v.as_py()
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif held and [held[-1].column(k)[-1] for k in keys] != last:
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)
