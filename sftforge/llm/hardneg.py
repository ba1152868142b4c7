"""Operator 13, hard-negative mining by the threshold algorithm over sorted lists.

An anchor's positives are its best rows of its own label; a positive's negatives
are the best rows of other labels whose score lies in a window below the
positive's.  Both are found by one walk.  Rows of one label form blocks; a block
keeps, for every dimension, the list of its rows sorted by that component.  An
anchor reads each list from the end that its own component's sign favours,
anchors of a group in step; a row that one of them meets is scored at once, as an
integer inner product (random access).  The values at the lists' present depth
bound every unmet row's score: an anchor is done with a block when that
threshold lies strictly below the k-th score of each of its windows (or below
the window), so a row of equal score and smaller id is never missed.  Nothing is
pruned by guess.

Groups of anchors meet blocks in a grid of cells, both dealt by hash: a cell
holds about ``ANCHORS`` anchors and ``CELL`` blocks whatever the input's size, a
task streams its cells block by block, and the cells' best k meet in a window
that Spark limits before the shuffle.  Nothing is broadcast or sent to the driver.

Edge cases: rows whose label or vector is null, or whose vector holds a null,
infinite or not-a-number component, take no part; shorter vectors are continued
by zeros, an empty one is all zeros; rows of equal id are rows of their own and
may be each other's positives; a null id is no anchor, and comes last among ties;
equal scores go by id, then by place in the table; scores beyond a long stop at
its bounds; an empty table, one label alone or positives of negative score give
no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sftforge.llm.common import documents, materialize, prepare
from sftforge.llm.topk import integer_matrix

POSITIVES, NEGATIVES, SCALE, EVERY = 5, 3, 256, 50
LEAST, MOST = 50, 95  # a negative scores this many hundredths of the positive's score
BLOCK, CELL, ANCHORS, STEP = 2048, 16, 4096, 256
DEPTHS = (16, 64, 256, 1024)
_MIN, _MAX = -(1 << 63), (1 << 63) - 1
INDEX = "block long, label long, rows array<long>, ids array<long>, kind string, components binary, lists binary"
FOUND = "anchor_row long, slot int, row long, vec_id long, score long"


def usable(vectors: DataFrame, vector_col: str, id_col: str, label: Column) -> DataFrame:
    """(row, vec_id, label, v) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"),
                           label.cast("long").alias("label"), v.alias("v"))
            .where(F.col("v").isNotNull() & F.col("label").isNotNull())
            .where(~F.coalesce(bad, F.lit(True)) | (F.size("v") == 0)))


def build_index(rows: DataFrame, count: int, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """Blocks of one label each: ids in order, integer components, and every dimension's rows by component."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            label = batch.column("label").to_numpy()
            edges = np.r_[0, np.flatnonzero(label[1:] != label[:-1]) + 1, len(label)] if len(label) else np.zeros(1, int)
            for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()):
                for at in range(s, e, block):
                    part = batch.slice(at, min(block, e - at))
                    yield _block(part, number, int(label[at]), scale)
                    number += 1

    return (rows.repartitionByRange(max(1, -(-count // (4 * block))), "label", F.xxhash64("row"))
            .sortWithinPartitions("label", F.asc_nulls_last("vec_id"), "row").mapInArrow(cut, INDEX))


def _block(part: pa.RecordBatch, number: int, label: int, scale: int) -> pa.RecordBatch:
    a = integer_matrix(part.column("v"), scale)
    if a.dtype == object:
        kind, data, lists = "wide", repr(a.tolist()).encode(), b""
    else:
        kind = "int16" if np.abs(a).max(initial=0) < 1 << 15 else "int64"
        data = a.astype(kind).tobytes()
        lists = np.argsort(a, axis=0, kind="stable").T.astype(np.uint16).tobytes()
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.array([label]), pa.array([part.column("row").to_pylist()], pa.list_(pa.int64())),
         pa.array([part.column("vec_id").to_pylist()], pa.list_(pa.int64())), pa.array([kind]),
         pa.array([data], pa.binary()), pa.array([lists], pa.binary())], names=[c.split()[0] for c in INDEX.split(", ")])


class Block:
    def __init__(self, batch: pa.RecordBatch, i: int):
        self.label = batch.column("label")[i].as_py()
        self.rows = np.array(batch.column("rows")[i].as_py(), np.int64)
        ids = batch.column("ids")[i].as_py()
        self.no_id = np.array([x is None for x in ids])
        self.ids = np.array([_MAX if x is None else x for x in ids], np.int64)
        kind, data = batch.column("kind")[i].as_py(), batch.column("components")[i].as_py()
        n = len(self.rows)
        if kind == "wide":
            import ast

            self.v = np.array(ast.literal_eval(data.decode()), object).reshape(n, -1)
        else:
            self.v = np.frombuffer(data, kind).reshape(n, -1).astype(np.int64)
            self.lists = np.frombuffer(batch.column("lists")[i].as_py(), np.uint16).reshape(-1, n)
            self.sorted = np.take_along_axis(self.v, self.lists.T.astype(np.int64), axis=0)

    def walk(self, q: np.ndarray, own: np.ndarray, low: np.ndarray, high: np.ndarray, floor: np.ndarray, k: int):
        """Per anchor and window the best k rows' (score, position), score -inf where there are fewer.

        ``low`` and ``high``: the windows' bounds (anchors x windows); ``floor``: a k-th score known already.
        """
        width = min(q.shape[1], self.v.shape[1])
        q, v, n = q[:, :width], self.v[:, :width], len(self.rows)
        big = int(np.abs(q).max(initial=0)) * int(np.abs(v).max(initial=0)) * max(width, 1) if n else 0
        if big >= 1 << 53:
            return self._whole(q.astype(object), own, low, high, k)
        q, low, high = q.astype(np.float64), low.astype(np.float64), high.astype(np.float64)
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        tops, bottoms = np.flatnonzero((up > 0).any(axis=0)), np.flatnonzero((down < 0).any(axis=0))
        scores = np.full((len(q), n), -np.inf)
        met = np.zeros(n, bool)
        best = np.full((*low.shape, k), -np.inf)
        where = np.zeros((*low.shape, k), np.int64)
        live = np.arange(len(q))
        before = 0
        # At depth 0 the lists' ends bound all rows: a block out of reach of all windows is left unread.
        for depth in (0, *[d for d in DEPTHS if d < n], n):
            if depth == n:
                new = np.flatnonzero(~met)
            else:
                ends = [self.lists[tops, n - depth:n - before].ravel(), self.lists[bottoms, before:depth].ravel()]
                new = np.unique(np.concatenate(ends)).astype(np.int64)
                new = new[~met[new]]
            if len(new):
                met[new] = True
                scores[np.ix_(live, new)] = q[live] @ v[new].T
                scores[live[:, None], new] = np.where(self.rows[new] == own[live, None], -np.inf, scores[live[:, None], new])
                best[live], where[live] = _best(scores[live], low[live], high[live], k)
            if depth == n:
                break
            at = max(depth, 1)
            bound = up[live] @ self.sorted[n - at, :width] + down[live] @ self.sorted[at - 1, :width]
            need = np.maximum(np.maximum(floor[live], best[live][:, :, k - 1]), low[live])
            live = live[(bound[:, None] >= need).any(axis=1)]
            if not len(live):
                break
            before = depth
        return best, where

    def _whole(self, q, own, low, high, k):
        """All rows scored in Python integers, for numbers that doubles can't hold."""
        v = self.v[:, :q.shape[1]].astype(object)
        best = np.full((*low.shape, k), -np.inf, object)
        where = np.zeros((*low.shape, k), np.int64)
        for i in range(len(q)):
            s = [max(_MIN, min(_MAX, sum(x * y for x, y in zip(q[i], row)))) for row in v]
            for w in range(low.shape[1]):
                fit = [j for j, x in enumerate(s) if self.rows[j] != own[i] and low[i, w] <= x <= high[i, w]]
                for place, j in enumerate(sorted(fit, key=lambda j: (-s[j], j))[:k]):
                    best[i, w, place], where[i, w, place] = s[j], j
        return best, where


def _best(scores: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores of each window and their positions; the first position of equal scores first."""
    best = np.full((*low.shape, k), -np.inf)
    where = np.zeros((*low.shape, k), np.int64)
    each = np.arange(len(scores))
    for w in range(low.shape[1]):
        fit = np.where((scores >= low[:, w, None]) & (scores <= high[:, w, None]), scores, -np.inf)
        for place in range(k):
            at = fit.argmax(axis=1)
            best[:, w, place], where[:, w, place] = fit[each, at], at
            fit[each, at] = -np.inf
    return best, where


class Anchors:
    """The anchors of a cell and the best rows found for each of their windows."""

    def __init__(self, rows: list[int], labels: list[int], vectors: list, positives: list, scale: int, k: int):
        self.rows, self.labels = np.array(rows, np.int64), np.array(labels, np.int64)
        self.q = integer_matrix(pa.array(vectors, pa.list_(pa.float64())), scale)
        n = max([1, *[len(p) for p in positives if p is not None]])
        self.low = np.full((len(rows), n), _MAX, object)
        self.high = np.full((len(rows), n), _MIN, object)
        for i, scores in enumerate(positives):
            if scores is None:
                self.low[i, 0], self.high[i, 0] = _MIN, _MAX
            for w, s in enumerate(scores or []):
                self.low[i, w], self.high[i, w] = -(-LEAST * s // 100), MOST * s // 100
        self.k = k
        self.score = np.full((len(rows), n, k), -np.inf, object)
        self.id = np.full((len(rows), n, k), _MAX, np.int64)
        self.row = np.zeros((len(rows), n, k), np.int64)
        self.no_id = np.zeros((len(rows), n, k), bool)

    def meet(self, block: Block, same: bool) -> None:
        mine = np.flatnonzero((self.labels == block.label) == same)
        for s in range(0, len(mine), STEP):
            i = mine[s:s + STEP]
            best, where = block.walk(self.q[i], self.rows[i], self.low[i], self.high[i], self.score[i][:, :, -1].astype(float), self.k)
            has = (best.astype(float) > -np.inf).any(axis=(1, 2))
            for a, b, w in zip(i[has].tolist(), best[has], where[has]):
                self._merge(a, b, w, block)

    def _merge(self, a: int, best: np.ndarray, where: np.ndarray, block: Block) -> None:
        for w in range(best.shape[0]):
            fresh = [(-int(s), bool(block.no_id[j]), int(block.ids[j]), int(block.rows[j])) for s, j in zip(best[w], where[w]) if s > -np.inf]
            if not fresh:
                continue
            old = [(-s, bool(z), int(d), int(r)) for s, z, d, r in
                   zip(self.score[a, w], self.no_id[a, w], self.id[a, w], self.row[a, w]) if s > -np.inf]
            for place, (s, z, d, r) in enumerate(sorted(old + fresh)[:self.k]):
                self.score[a, w, place], self.no_id[a, w, place], self.id[a, w, place], self.row[a, w, place] = -s, z, d, r

    def found(self) -> pa.RecordBatch:
        a, w, place = np.nonzero(self.score.astype(float) > -np.inf)
        take = lambda x: x[a, w, place]
        return pa.RecordBatch.from_arrays(
            [pa.array(self.rows[a]), pa.array(w.astype(np.int32)), pa.array(take(self.row)),
             pa.array(take(self.id), pa.int64(), mask=take(self.no_id)), pa.array([int(x) for x in take(self.score)], pa.int64())],
            names=["anchor_row", "slot", "row", "vec_id", "score"])


def best_in_cells(anchors: DataFrame, index: DataFrame, counts: tuple[int, int], k: int, same: bool, scale: int,
                  per_cell: tuple[int, int] = (ANCHORS, CELL)) -> DataFrame:
    """(anchor_row, slot, rank, row, vec_id, score): each window's best k rows among blocks of the same or of other labels.

    ``anchors``: (row, label, v, positives), null positives for one window without bounds.
    ``counts``: of the anchors and of the blocks, which set the number of cells.
    """
    down, across = max(1, -(-counts[0] // per_cell[0])), max(1, -(-counts[1] // per_cell[1]))
    each = lambda n: F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
    asked = anchors.select(F.pmod(F.xxhash64("row"), F.lit(down)).alias("r"), F.explode(each(across)).alias("c"),
                           F.col("row").alias("anchor"), "label", "v", "positives")
    held = index.select(F.explode(each(down)).alias("r"), F.pmod(F.xxhash64("block"), F.lit(across)).alias("c"),
                        "*")
    cells = (asked.unionByName(held, allowMissingColumns=True).repartition(down * across, "r", "c")
             .sortWithinPartitions("r", "c", F.asc_nulls_first("block"), "anchor"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, group, wait = None, None, ([], [], [], [])
        for batch in batches:
            where = list(zip(batch.column("r").to_pylist(), batch.column("c").to_pylist()))
            anchor = batch.column("anchor").to_pylist()
            for i, now in enumerate(where):
                if now != cell:
                    if group is not None:
                        yield group.found()
                    cell, group, wait = now, None, ([], [], [], [])
                if anchor[i] is not None:
                    for to, name in zip(wait, ("anchor", "label", "v", "positives")):
                        to.append(batch.column(name)[i].as_py())
                elif wait[0]:
                    group = group or Anchors(*wait, scale, k)
                    group.meet(Block(batch, i), same)
        if group is not None:
            yield group.found()

    w = Window.partitionBy("anchor_row", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return cells.mapInArrow(run, FOUND).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   scale: int = SCALE, vector_col: str = "embedding", id_col: str = "vec_id", block: int = BLOCK,
                   per_cell: tuple[int, int] = (ANCHORS, CELL)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor``: a condition on ``vec_id``; ``label``: an expression over the columns of ``vectors``.
    """
    prepare(vectors.sparkSession)
    rows = materialize(usable(vectors, vector_col, id_col, label), "negative-rows")
    index = materialize(build_index(rows, rows.count(), scale, block), "negative-index")
    anchors = rows.where(F.coalesce(is_anchor, F.lit(False)))
    counts = (anchors.count(), index.count())
    nothing = F.lit(None).cast("array<long>").alias("positives")
    near = materialize(best_in_cells(anchors.select("row", "label", "v", nothing), index, counts, positives, True, scale, per_cell)
                       .select("anchor_row", (F.col("rank") - 1).cast("int").alias("slot"), F.col("vec_id").alias("positive_id"),
                               F.col("score").alias("positive_score")), "negative-positives")
    # At most ``positives`` rows an anchor.
    listed = near.groupBy("anchor_row").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "positive_score"))),
                                                        lambda p: p["positive_score"]).alias("positives"))
    windows = anchors.join(listed, anchors["row"] == listed["anchor_row"]).select("row", "label", "v", "positives")
    far = best_in_cells(windows, index, counts, negatives, False, scale, per_cell)
    return (far.withColumnRenamed("vec_id", "negative_id").withColumnRenamed("score", "negative_score").drop("row")
            .join(near, ["anchor_row", "slot"]).join(anchors.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id")), "anchor_row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def op13_threshold_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(documents(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0, moved)


SQL = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS a
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, CAST(list_dot_product(q.a, c.a) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % {EVERY} = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
), n AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND {LEAST} * p.positive_score <= 100 * s.score AND 100 * s.score <= {MOST} * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}
"""
