import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sftforge.llm import hardneg as H

from .helpers import SF, rows_of, stored, table

LAST = float("inf")


def brute(rows, is_anchor, positives=5, negatives=3, scale=256):
    """rows: (vec_id, vector, label) in the table's order."""
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    live = [(r, i, lab, [math.floor(scale * x) for x in v]) for r, (i, v, lab) in enumerate(rows)
            if v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for r, i, lab, q in live:
        if i is None or not is_anchor(i):
            continue
        score = [(-clip(sum(a * b for a, b in zip(q, v))), LAST if j is None else j, s, same == lab, j) for s, j, same, v in live if s != r]
        score.sort(key=lambda x: x[:3])
        for p, _, _, _, pid in [x for x in score if x[3]][:positives]:
            fit = [x for x in score if not x[3] and 50 * -p <= 100 * -x[0] <= 95 * -p][:negatives]
            out += [(i, pid, n + 1, x[4], -p, -x[0]) for n, x in enumerate(fit)]
    return sorted(out, key=str)


def got(df):
    cols = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted((tuple(r[c] for c in cols) for r in rows_of(df)), key=str)


def test_query_matches_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in table("embeddings")]
    want = brute(rows, lambda i: i % 50 == 0)
    assert want and got(H.op13_threshold_hard_negatives(spark, SF)) == want


@pytest.mark.parametrize("block,per_cell", [(2048, (4096, 16)), (7, (3, 2))])
def test_edge_cases(spark, tmp_dir, block, per_cell):
    rng = np.random.default_rng(5)
    base = [[float(np.float32(x)) for x in rng.normal(0.1, 0.3, 6)] for _ in range(14)]
    rows = [(i, base[i % 14 if i % 3 else 1], i % 4) for i in range(90)]  # many ties
    rows += [(200, None, 1), (201, [0.1, None], 1), (202, [0.1, float("nan")], 2), (203, [float("inf")], 2), (205, base[0], None),
             (None, base[0], 1), (None, base[1], 2), (10, base[3], 2), (10, base[3], 2), (210, [], 1), (215, [0.5], 0), (220, [0.0] * 6, 3),
             (-10, [0.3, 0.2, 0.1, 0.0, 0.0, 0.0, 0.7], 1)]
    frame = stored(spark, [(*r, 1.5, "x", 3) for r in rows], "vec_id long, embedding array<double>, label int, score double, row string, slot int",
                   tmp_dir).coalesce(1)
    order = [(r["vec_id"], r["embedding"], r["label"]) for r in frame.collect()]
    asked, kw = F.col("vec_id") % 5 == 0, {"block": block, "per_cell": per_cell}
    want = brute(order, lambda i: i % 5 == 0)
    assert want and got(H.hard_negatives(frame, asked, F.col("label"), **kw)) == want
    assert got(H.hard_negatives(frame, asked, F.col("label"), 2, 50, **kw)) == brute(order, lambda i: i % 5 == 0, 2, 50)
    assert got(H.hard_negatives(frame.where("vec_id > 900"), asked, F.col("label"), **kw)) == []
    assert got(H.hard_negatives(frame, asked, F.lit(1), **kw)) == []


def test_numbers_beyond_doubles(spark, tmp_dir):
    rows = [(i, [1e30 if i % 3 else -2.0, float(i), 1e9], i % 2) for i in range(12)] + [(50, [0.1, 0.2, 0.3], 1)]
    rows += [(60 + i, [3e6 + i, 2e6 - i, 1.0], i % 2) for i in range(9)]
    frame = stored(spark, rows, "vec_id long, embedding array<double>, label int", tmp_dir).coalesce(1)
    order = [(r["vec_id"], r["embedding"], r["label"]) for r in frame.collect()]
    assert got(H.hard_negatives(frame, F.col("vec_id") % 5 == 0, F.col("label"), block=4)) == brute(order, lambda i: i % 5 == 0)


def test_walk_stops_before_the_lists_end():
    """A block far below the known k-th score is not read; one that reaches it is."""
    import pyarrow as pa

    v = [[float(x), 0.0] for x in range(100)]
    part = pa.RecordBatch.from_arrays([pa.array(list(range(100))), pa.array(list(range(100))), pa.array(v, pa.list_(pa.float64()))],
                                      names=["row", "vec_id", "v"])
    block = H.Block(H._block(part, 0, 1, 1), 0)
    q, own, low, high = np.array([[2, 0]]), np.array([-1]), np.array([[H._MIN]]), np.array([[H._MAX]])
    best, where = block.walk(q, own, low, high, np.array([[500.0]]), 2)
    assert (best == -np.inf).all()  # 2 * 99 < 500
    best, where = block.walk(q, own, low, high, np.array([[-np.inf]]), 2)
    assert best.tolist() == [[[198.0, 196.0]]] and where.tolist() == [[[99, 98]]]
    best, where = block.walk(q, own, np.array([[0]]), np.array([[21]]), np.array([[-np.inf]]), 3)
    assert best.tolist() == [[[20.0, 18.0, 16.0]]]
