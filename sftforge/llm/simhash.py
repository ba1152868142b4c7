"""Operator 8, SimHash near-duplicates by the generalised pigeonhole principle.

A document's fingerprint has a bit set if over half of its shingle hashes have
it.  To find all fingerprints within ``max_bits`` of each other, the 64 bits are
grouped into partitions of correlated bits, and every partition gets a threshold
t of its own (-1: not probed) with sum(t + 1) = max_bits + 1.  Two fingerprints
within max_bits must then agree up to t bits in some partition, so probing each
partition for all values within t flips finds every link.  Number of partitions
and thresholds come from a dynamic programme over estimated candidate counts,
which are taken over all fingerprints.  Candidates are verified on all 64 bits.

Equal fingerprints are one node; only distinct ones are probed.  A key that more
than ``BLOCK`` rows share is cut into blocks whose pairs are verified in separate
tasks, and a task hands on a spanning forest of the links it finds, never all pairs.

Edge cases: a null or empty text has no words and fingerprint zero, and links
like any other; rows with equal ids or equal texts each give a row; null ids
pass through and never become a component id unless all ids there are null; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftforge.llm.buckets import pairs_of
from sftforge.llm.common import (documents, fresh, lowered, materialize, prepare, sliced,
                                 text_bytes, words)
from sftforge.llm.graph import connected_components

SHINGLE, MAX_BITS, SEED = 4, 4, 42
BLOCK = 1024
PART_COUNTS = (3, 4, 5)


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprint of each text as uint64."""
    rows = len(offsets) - 1
    out = np.zeros(rows, np.uint64)
    data = lowered(data)
    starts, ends, row = words(data, offsets)
    if not len(starts):
        return out
    # The words of each text with one blank between two, back to back.
    sizes = ends - starts + 1
    begin = np.cumsum(sizes) - sizes
    where = np.arange(begin[-1] + sizes[-1]) + np.repeat(starts - begin, sizes)
    joined = np.append(data, np.uint8(0))[where]
    joined[begin + sizes - 1] = 0x20
    raw = joined.tobytes()
    count = np.bincount(row, minlength=rows)
    first = np.cumsum(count) - count
    n = np.where(count >= shingle, count - shingle + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(rows), n)
    head = first[doc] + np.arange(len(doc)) - (np.cumsum(n) - n)[doc]
    tail = head + np.minimum(count[doc], shingle) - 1
    digest = xxhash.xxh64_intdigest
    stop = (begin + sizes - 1)[tail]
    h = np.array([digest(raw[s:e], SEED) for s, e in zip(begin[head].tolist(), stop.tolist())], np.uint64)
    some = np.flatnonzero(n)
    bounds = (np.cumsum(n) - n)[some]
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.add.reduceat(bits, bounds, axis=0, dtype=np.int32)
    over = 2 * sums > n[some][:, None]
    out[some] = np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep: tuple[str, ...] = ("doc_id",),
                 text_col: str = "text") -> DataFrame:
    """The ``keep`` columns and ``fp`` (the 64 bits as a long) of each row."""
    prepare(docs.sparkSession)
    words_of = fresh(keep, "__text")
    frame = docs.select(*keep, F.col(text_col).cast("string").alias(words_of))
    schema = frame.drop(words_of).withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, words_of):
            fp = fingerprints_of(*text_bytes(batch.column(words_of)), shingle)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in keep] + [pa.array(fp.view(np.int64))], names=[*keep, "fp"])

    return frame.mapInArrow(run, schema)


# ---------------------------------------------------------------- partitions and thresholds

def bit_counts(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for bits i and j, of those that have both (64 rows)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64)), 0
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            n += len(fp)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(64), pa.int32()), pa.array([n] * 64, pa.int64()), pa.array(total.tolist(), pa.list_(pa.float64()))],
            names=["bit", "n", "both"])

    sums = (distinct.select("fp").mapInArrow(run, "bit int, n long, both array<double>")
            .groupBy("bit").agg(F.sum("n").alias("n"), *[F.sum(F.col("both")[j]).alias(f"b{j}") for j in range(64)])
            .orderBy("bit").collect())
    if not sums:
        return 0, np.zeros((64, 64))
    return int(sums[0]["n"]), np.array([[r[f"b{j}"] for j in range(64)] for r in sums])


def correlated_parts(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """Deal the bits into ``m`` parts of nearly equal size, each grown by the bit most correlated with it."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, parts = set(range(64)), []
    for k in range(m):
        size = -(-len(left) // (m - k))
        part = [max(sorted(left), key=lambda b: corr[b, list(left)].sum())]
        left.discard(part[0])
        while len(part) < size:
            part.append(max(sorted(left), key=lambda b: corr[b, part].sum()))
            left.discard(part[-1])
        parts.append(sorted(part))
    return parts


def mask_of(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def within(p: np.ndarray, bits: list[int], most: int) -> list[float]:
    """Probability that two fingerprints differ in 0, at most 1, ... of the bits, were these independent."""
    dist = np.zeros(most + 2)
    dist[0] = 1
    for b in bits:
        q = 2 * p[b] * (1 - p[b])
        dist[1:] = dist[1:] * (1 - q) + dist[:-1] * q
        dist[0] *= 1 - q
    return np.cumsum(dist)[:most + 1].tolist()


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t >= -1 with sum(t + 1) = total and least cost; costs[i][t + 1]."""
    best: list[tuple[float, list[int]]] = [(0.0, [])] + [(float("inf"), [])] * total
    for row in costs:
        best = [min(((best[u - k][0] + row[k], best[u - k][1] + [k - 1])
                     for k in range(min(u, len(row) - 1) + 1)), key=lambda x: x[0])
                for u in range(total + 1)]
    return best[total]


def plan(distinct: DataFrame, max_bits: int = MAX_BITS) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition that is probed."""
    if not 0 <= max_bits <= 64:
        raise ValueError("max_bits must be from 0 to 64")
    n, both = bit_counts(distinct)
    if n < 2:
        return []
    p = np.diag(both) / n
    # Thresholds go up to 2, so a partition takes 3 of the max_bits + 1 that have to be dealt out.
    counts = sorted({*PART_COUNTS, max(*PART_COUNTS, -(-(max_bits + 1) // 3))})
    options = [correlated_parts(n, both, m) for m in counts]
    flat = [(m, i, bits) for m, parts in enumerate(options) for i, bits in enumerate(parts)]
    keyed = distinct.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(mask_of(bits))).alias("v"))
        for k, (_, _, bits) in enumerate(flat)])).alias("s")).select("s.*")
    squares = {r["k"]: r["pairs"] for r in keyed.groupBy("k", "v").count().groupBy("k").agg(
        F.sum(F.col("count") * (F.col("count") - 1) / 2).alias("pairs")).collect()}
    found = []
    for m, parts in enumerate(options):
        costs = []
        for bits in parts:
            exact = squares[next(k for k, f in enumerate(flat) if f[2] is bits and f[0] == m)]
            near = within(p, bits, min(max_bits, 2))
            row = [0.0]
            for t in range(min(max_bits, 2) + 1):
                probes = n * sum(comb(len(bits), k) for k in range(t + 1))
                row.append(300 * probes + exact * near[t] / max(near[0], 1e-30))
            costs.append(row)
        cost, thresholds = allocate(costs, max_bits + 1)
        found.append((cost, [(bits, t) for bits, t in zip(parts, thresholds) if t >= 0]))
    return min(found, key=lambda x: x[0])[1]


# ---------------------------------------------------------------- probe and verify

def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links a-b (each node with its component's smallest node)."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = index[:len(a)], index[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = label.copy()
        np.minimum.at(low, x, label[y])
        np.minimum.at(low, y, label[x])
        np.minimum.at(low, label, low)  # also pull the old roots
        low = low[low]
        if (low == label).all():
            break
        label = low
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[own], nodes[label[own]]


def links(distinct: DataFrame, parts: list[tuple[list[int], int]], max_bits: int = MAX_BITS,
          block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints connected by links of at most ``max_bits``."""
    if not parts:
        return distinct.sparkSession.createDataFrame([], "a long, b long")
    signs = None
    for k, (bits, t) in enumerate(parts):
        value = F.col("fp").bitwiseAND(F.lit(mask_of(bits)))
        flips = [mask_of(list(c)) for size in range(1, t + 1) for c in combinations(bits, size)]
        rows = distinct.select(F.lit(k).alias("part"), value.alias("key"), F.col("fp").alias("value"), F.lit(False).alias("probe"))
        if flips:
            rows = rows.unionByName(distinct.select(
                F.lit(k).alias("part"),
                F.explode(F.transform(F.array(*map(F.lit, flips)), lambda f: value.bitwiseXOR(f))).alias("key"),
                F.col("fp").alias("value"), F.lit(True).alias("probe")))
        signs = signs.unionByName(rows) if signs else rows

    def match(value, probe, side, cross):
        """Members of a key within max_bits of each other or of the probes, as a spanning forest."""
        at = np.flatnonzero(~probe)
        differ = (value[at][:, None] ^ value[None, :]).view(np.uint64)
        near = (np.bitwise_count(differ) <= max_bits) & (differ != 0)
        if cross:
            near &= side[at][:, None] != side[None, :]
        i, j = np.nonzero(near)
        return forest(value[at[i]], value[j]) if len(i) > 1 else (value[at[i]], value[j])

    return pairs_of(signs, match, block)


def near_duplicates(prints: DataFrame, max_bits: int = MAX_BITS, id_col: str = "doc_id") -> DataFrame:
    """``prints`` (with ``fp`` and the id), ``root`` (a key of the component) and ``component_id``, its smallest id."""
    distinct = materialize(prints.groupBy("fp").agg(F.min(id_col).alias("first_id")), "simhash-distinct")
    edges = links(distinct, plan(distinct, max_bits), max_bits)
    roots = connected_components(edges).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.join(rooted.join(least, "root").select("fp", "root", "component_id"), "fp")


def op8_simhash_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = materialize(fingerprints(documents(spark, sf_dir)), "simhash")
    return near_duplicates(prints).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest id (null ids last).

    Rows of equal ids are told apart by their place in the input, which must be
    stored data (files), so that every read gives the same places.
    """
    row = fresh(docs.columns, "__row")
    docs = docs.withColumn(row, F.monotonically_increasing_id())
    prints = materialize(fingerprints(docs, shingle, ("doc_id", row)), "simhash")
    first = near_duplicates(prints, max_bits).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(row).alias("row"))).alias("keep"))
    return docs.join(first.select(F.col("keep.row").alias(row)), row, "left_semi").drop(row)
