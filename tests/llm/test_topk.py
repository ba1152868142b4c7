import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sftforge.llm import topk as T

from .helpers import SF, rows_of, stored, table


def brute(rows, is_query, k=5, scale=256):
    live = []
    for r, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            live.append((r, i, [math.floor(scale * x) for x in v]))
    out = []
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    for r, i, q in live:
        if i is None or not is_query(i):
            continue
        found = sorted((-clip(sum(a * b for a, b in zip(q, v))), j is None, j or 0, s) for s, j, v in live if s != r)[:k]
        out += [(i, n + 1, None if none else j, -s) for n, (s, none, j, _) in enumerate(found)]
    return sorted(out, key=str)


def got(df):
    return sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows_of(df)), key=str)


def test_query_matches_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table("embeddings")]
    assert got(T.op10_impact_ordered_topk(spark, SF)) == brute(rows, lambda i: i % 50 == 0)


@pytest.mark.parametrize("block,query_block,per_cell", [(4096, 8192, 4), (7, 5, 1), (3, 4, 2)])
def test_edge_cases(spark, tmp_dir, block, query_block, per_cell):
    rng = np.random.default_rng(2)
    base = [[float(np.float32(x)) for x in rng.normal(0, 0.2, 6)] for _ in range(12)]
    rows = [(i, base[i % 12 if i % 3 else 0]) for i in range(60)]  # many ties
    rows += [(100, None), (101, [0.1, None]), (102, [0.1, float("nan")]), (103, [float("inf")]), (None, base[0]), (None, base[1]),
             (10, base[3]), (104, []), (105, [0.5]), (-10, [-0.3, 0.2, 0.1, 0.0, 0.0, 0.0, 0.7]), (106, [0.0] * 6)]
    frame = stored(spark, [(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, score int, row string", tmp_dir).coalesce(1)
    order = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    asked = F.col("vec_id") % 5 == 0
    assert got(T.top_k(frame, asked, block=block, query_block=query_block, per_cell=per_cell)) == brute(order, lambda i: i % 5 == 0)
    assert got(T.top_k(frame, asked, k=100, block=block)) == brute(order, lambda i: i % 5 == 0, 100)
    assert got(T.top_k(frame.where("vec_id > 900"), asked)) == []
    assert got(T.top_k(frame.where("vec_id = 5"), asked)) == []


def test_large_numbers_and_all_equal(spark, tmp_dir):
    rows = [(i, [1e30 if i % 3 else -2.0, float(i), 1e9]) for i in range(12)] + [(50, [0.1, 0.2, 0.3])]
    frame = stored(spark, rows, "vec_id long, embedding array<double>", tmp_dir).coalesce(1)
    order = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    assert got(T.top_k(frame, F.col("vec_id") % 5 == 0, block=4)) == brute(order, lambda i: i % 5 == 0)
    same = stored(spark, [(i, [0.25, -0.5]) for i in range(30)], "vec_id long, embedding array<float>", tmp_dir)
    assert got(T.top_k(same, F.col("vec_id") < 4)) == brute([(i, [0.25, -0.5]) for i in range(30)], lambda i: i < 4)
