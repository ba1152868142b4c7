"""Operator 10, exact top-k search over an impact-ordered, score-at-a-time index.

A vector's components are integers, floor(scale * x).  A block of vectors keeps,
for each dimension d, how far each component lies above the block's least:
b = a - low(d).  That offset is split into impacts 2**k, and the index stores the
posting segments of one impact side by side: for each dimension, which vectors
of the block have that impact.  A query walks the segments from the largest
impact down; where its component is negative, a vector scores by the impacts it
lacks.  All contributions so are at least 0, and after the segments of impact
2**k a vector's score is known up to sum(|q|) * (2**k - 1).

The walk stops only on proof: once the vectors whose upper bound reaches the
k-th best lower bound (of the block, or of exact scores found before) are few,
no other vector can be a member.  Their remaining segments are read and they are
scored exactly, ties included.  Nothing is pruned by guess; recall is 1.

Queries and index blocks meet in a grid of cells: queries are dealt by hash into
groups of about ``QUERY_BLOCK``, blocks into groups of about ``CELL``, and a cell
holds one group of each whatever the input's size.  Its task keeps the best k per
query of all its blocks, and the cells' lists meet in a window that Spark limits
before and after the shuffle.  The plan is of one size, and nothing passes the
driver but the two counts.

Edge cases: vectors that are null or hold null, infinite or not-a-number
components take no part; shorter vectors are continued by zeros, an empty one is
all zeros; rows of equal id are rows of their own and find each other; a null id
is no query, and as a candidate comes last among ties; scores beyond a long stop
at its bounds; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sftforge.llm.common import documents, materialize, prepare

K, SCALE, EVERY = 5, 256, 50
BLOCK, QUERY_BLOCK, CELL, STEP = 4096, 8192, 4, 512
_LAST = np.iinfo(np.int64).max
INDEX = "rows array<long>, ids array<long>, low array<long>, impacts array<binary>, wide binary"
FOUND = "query_row long, query_id long, vec_row long, vec_id long, score long"


def integer_matrix(column: pa.Array, scale: int) -> np.ndarray:
    """floor(scale * x) of all vectors, shorter ones continued by zeros; int64, or Python integers if any is large."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    large = len(flat) and np.abs(flat).max() > 1 << 24
    values = np.array([int(x) for x in flat], object) if large else flat.astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), object if large else np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = values
    return out


def usable(vectors: DataFrame, vector_col: str, id_col: str) -> DataFrame:
    """(row, vec_id, v) of the vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    bad: Column = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("v").isNotNull()).where(~F.coalesce(bad, F.lit(True)) | (F.size("v") == 0)))


def build_index(rows: DataFrame, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """One row per block: its ids, each dimension's least, and a bit matrix for each impact, largest first.

    ``wide``: the raw components of a block whose numbers are too large for impacts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, block):
                part = batch.slice(s, block)
                a = integer_matrix(part.column("v"), scale)
                impacts, wide, low = [], None, np.zeros(a.shape[1], np.int64)
                if a.dtype == object:
                    wide = repr(a.tolist()).encode()
                elif a.size:
                    low = a.min(axis=0)
                    b = a - low
                    impacts = [np.packbits((b >> k & 1).astype(np.uint8), axis=1).tobytes()
                               for k in range(int(b.max()).bit_length() - 1, -1, -1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.column("row").to_pylist()], pa.list_(pa.int64())),
                     pa.array([part.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                     pa.array([low.tolist()], pa.list_(pa.int64())), pa.array([impacts], pa.list_(pa.binary())),
                     pa.array([wide], pa.binary())], names=["rows", "ids", "low", "impacts", "wide"])

    return rows.mapInArrow(run, INDEX)


class Block:
    def __init__(self, batch: pa.RecordBatch, i: int):
        self.rows = np.array(batch.column("rows")[i].as_py(), np.int64)
        self.ids = batch.column("ids")[i].as_py()
        self.order = np.array([_LAST if x is None else x for x in self.ids], np.int64)
        self.low = np.array(batch.column("low")[i].as_py(), np.int64)
        wide = batch.column("wide")[i].as_py()
        self.wide = None if wide is None else _numbers(wide)
        shape = (len(self.rows), -(-len(self.low) // 8))
        self.segments = [np.frombuffer(x.as_py(), np.uint8).reshape(shape) for x in batch.column("impacts")[i]] \
            if len(self.low) else []

    def bits(self, k: int, rows=slice(None)) -> np.ndarray:
        return np.unpackbits(self.segments[k][rows], axis=1, count=len(self.low))

    def members(self, q: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, vector, exact score) of all that may be among the k best; ``floor``: a score known to be reached."""
        if self.wide is not None or q.dtype == object:
            mine = self.wide if self.wide is not None else self.exact(np.arange(len(self.rows)))
            width = min(q.shape[1], mine.shape[1])
            s = q[:, :width].astype(object) @ mine[:, :width].astype(object).T if width else np.zeros((len(q), len(self.rows)), object)
            s = np.array([[max(-_LAST - 1, min(_LAST, int(x))) for x in row] for row in s], np.int64).reshape(len(q), -1)
            i, j = np.nonzero(s >= floor[:, None])
            return i, j, s[i, j]
        n, width = len(self.rows), min(q.shape[1], len(self.low))
        q, top = q[:, :width], len(self.segments)
        # A score is sum(|q| * impacts) + fixed: by low where q > 0, by the largest offset's complement where q < 0.
        size = np.abs(q).sum(axis=1)
        lacks = np.where(q < 0, -q, 0).sum(axis=1)
        fixed = q @ self.low[:width] - lacks * ((1 << top) - 1)
        kind = np.float32 if int(size.max(initial=0)) << top < 1 << 23 else np.float64
        known = np.zeros((len(q), n), kind)
        rest = size * ((1 << top) - 1)
        want = floor - fixed
        for step, k_left in enumerate(range(top - 1, -1, -1)):
            segment = self.bits(step)[:, :width].astype(kind)
            known += ((q.astype(kind) @ segment.T) + lacks[:, None].astype(kind)) * kind(1 << k_left)
            rest = size * ((1 << k_left) - 1)
            if k_left > top - 3 and k_left:
                continue
            sure = np.partition(known, n - k, axis=1)[:, n - k] if n >= k else np.full(len(q), -np.inf)
            low = np.maximum(want, np.where(np.isfinite(sure), sure, -float(_LAST))) - rest
            maybe = known >= low[:, None]
            if maybe.sum() <= 4 * k * len(q):
                break
        else:
            maybe = known >= (want - rest)[:, None] if not top else maybe
        i, j = np.nonzero(maybe)
        score = np.zeros(len(i), np.int64)
        for s in range(0, len(i), 1 << 16):  # the members' remaining segments
            e = slice(s, s + (1 << 16))
            score[e] = (q[i[e]] * self.exact(j[e])[:, :width]).sum(axis=1)
        return i, j, score

    def exact(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), len(self.low)), np.int64)
        for k in range(len(self.segments)):
            out = out * 2 + self.bits(k, rows)
        return out + self.low


def _numbers(wide: bytes) -> np.ndarray:
    import ast

    rows = ast.literal_eval(wide.decode())
    return np.array(rows, object).reshape(len(rows), -1)


def best(query: np.ndarray, score: np.ndarray, order: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's k best: highest score, smallest id, first row."""
    by = np.lexsort((row, order, -score.astype(object) if (score == -_LAST - 1).any() else -score, query))
    q = query[by]
    first = np.r_[True, q[1:] != q[:-1]] if len(q) else np.zeros(0, bool)
    place = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
    return by[place < k]


class Asked:
    """The queries of a cell and the best k found for each."""

    def __init__(self, rows: list[int], ids: list, vectors: list, scale: int, k: int):
        self.rows, self.ids, self.k = np.array(rows, np.int64), ids, k
        self.q = integer_matrix(pa.array(vectors, pa.list_(pa.float64())), scale)
        self.have = [np.zeros(0, np.int64) for _ in range(5)]  # query, score, order, row, is the id null
        self.floor = np.full(len(rows), -float(_LAST))

    def meet(self, block: Block) -> None:
        for s in range(0, len(self.q), STEP):
            # One more than k: the query's own row may be among them.
            i, j, score = block.members(self.q[s:s + STEP], self.floor[s:s + STEP], self.k + 1)
            other = block.rows[j] != self.rows[s + i]
            i, j, score = i[other] + s, j[other], score[other]
            got = [i, score, block.order[j], block.rows[j], np.array([block.ids[x] is None for x in j], np.int64)]
            own = (self.have[0] >= s) & (self.have[0] < s + STEP)
            all_ = [np.concatenate([h[own], g]) for h, g in zip(self.have, got)]
            top = best(*all_[:4], self.k)
            self.have = [np.concatenate([h[~own], a[top]]) for h, a in zip(self.have, all_)]
        count = np.bincount(self.have[0], minlength=len(self.q))
        least = np.full(len(self.q), _LAST, np.int64)
        np.minimum.at(least, self.have[0], self.have[1])
        self.floor = np.where(count >= self.k, least.astype(float), -float(_LAST))

    def found(self) -> pa.RecordBatch:
        query, score, order, row, no_id = self.have
        return pa.RecordBatch.from_arrays(
            [pa.array(self.rows[query], pa.int64()), pa.array([self.ids[x] for x in query], pa.int64()), pa.array(row),
             pa.array(order, pa.int64(), mask=no_id.astype(bool)), pa.array(score)],
            names=["query_row", "query_id", "vec_row", "vec_id", "score"])


def search(asked: DataFrame, index: DataFrame, counts: tuple[int, int], k: int = K, scale: int = SCALE,
           query_block: int = QUERY_BLOCK, per_cell: int = CELL) -> DataFrame:
    """The best k of each cell's blocks for each of its queries; ``counts`` of the queries and blocks set the cells' number."""
    down, across = max(1, -(-counts[0] // query_block)), max(1, -(-counts[1] // per_cell))
    each = lambda n: F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
    queries = asked.select(F.pmod(F.xxhash64("row"), F.lit(down)).alias("r"), F.explode(each(across)).alias("c"),
                           F.col("row").alias("query"), "vec_id", "v")
    blocks = index.withColumn("block", F.col("rows")[0]).select(
        F.explode(each(down)).alias("r"), F.pmod(F.xxhash64("block"), F.lit(across)).alias("c"), "*")
    cells = (queries.unionByName(blocks, allowMissingColumns=True).repartition(down * across, "r", "c")
             .sortWithinPartitions("r", "c", F.asc_nulls_first("block"), "query"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, group, wait = None, None, ([], [], [])
        for batch in batches:
            where = list(zip(batch.column("r").to_pylist(), batch.column("c").to_pylist()))
            query = batch.column("query").to_pylist()
            for i, now in enumerate(where):
                if now != cell:
                    if group is not None:
                        yield group.found()
                    cell, group, wait = now, None, ([], [], [])
                if query[i] is not None:
                    for to, name in zip(wait, ("query", "vec_id", "v")):
                        to.append(batch.column(name)[i].as_py())
                elif wait[0]:
                    group = group or Asked(*wait, scale, k)
                    group.meet(Block(batch, i))
        if group is not None:
            yield group.found()

    return cells.mapInArrow(run, FOUND)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, vector_col: str = "embedding",
          id_col: str = "vec_id", block: int = BLOCK, query_block: int = QUERY_BLOCK, per_cell: int = CELL) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of each row for which ``is_query`` (on vec_id) holds."""
    prepare(vectors.sparkSession)
    rows = materialize(usable(vectors, vector_col, id_col), "top-rows")
    index = materialize(build_index(rows, scale, block), "impact-index")
    asked = rows.where(F.coalesce(is_query, F.lit(False)))
    found = search(asked, index, (asked.count(), index.count()), k, scale, query_block, per_cell)
    w = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "vec_row")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op10_impact_ordered_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(documents(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS a FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.a, c.a) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % {EVERY} = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
