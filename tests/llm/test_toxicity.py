import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sftforge.llm import toxicity as T

from .helpers import rows_of, stored

CLEAN = ["the sun is warm today", "a boat on the lake", "we read books, the sun sets", "rivers run to the lake today"]
BAD = ["you are a vile toad today", "vile toad on the lake", "a vile vile toad", "the toad is a vile toad"]


def test_ratios_match_plain_models(spark):
    rows = [(t, 0) for t in CLEAN * 3] + [(t, 1) for t in BAD * 3]
    got = T.learn(T.pair_counts(spark.createDataFrame(rows, "text string, toxic int")), 1.0, 2.0)
    uni, bi = [Counter(), Counter()], [Counter(), Counter()]
    split = lambda t: re.findall(r"[^\s.,]+", t.lower())
    for t, c in rows:
        w = split(t)
        uni[c].update(w)
        bi[c].update(zip(["<s>", *w], w))
    kinds = set(bi[0]) | set(bi[1])
    cont = Counter(w for _, w in kinds)
    vocab = len(cont)

    def p(c, u, w):
        n = sum(uni[c].values())
        low = max(uni[c][w] - 1.0, 0) / n + sum(min(x, 1.0) for x in uni[c].values()) / n * (cont[w] + 1) / (len(kinds) + vocab + 1)
        after = {k[1]: x for k, x in bi[c].items() if k[0] == u}
        if not after:
            return low
        total = sum(after.values())
        return max(after.get(w, 0) - 2.0, 0) / total + sum(min(x, 2.0) for x in after.values()) / total * low

    texts = [*CLEAN, *BAD, "Unknown vile lake", "x", "", None]
    x = got.features(pa.array(texts))
    for t, f in zip(texts, x):
        w = split(t or "")
        r = [math.log(p(1, u, v) / p(0, u, v)) for u, v in zip(["<s>", *w], w)]
        n = max(len(r), 1)
        excess = sum(max(v - T.MARGIN, 0) for v in r) / n
        assert f == pytest.approx([1, math.sqrt(excess), excess, sum(r) / n], abs=1e-9)


def test_edge_cases(spark, tmp_dir):
    rows = [(i, (CLEAN if i % 2 else BAD)[i // 2 % 4], 0.5, "en") for i in range(400)]
    rows += [(400, None, 0.5, None), (401, "", 0.5, None), (None, "vile toad", 0.5, None), (402, "vile toad " * 20000, 0.5, "x"),
             (1, CLEAN[0], 0.5, "en")]
    docs = stored(spark, rows, "doc_id long, text string, score double, fit string", tmp_dir)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(400)] + [(7, 1), (None, 1), (9, None)], "doc_id long, toxic int")
    model = T.train(docs, labels)
    got = rows_of(T.score(docs, model))
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(r["predicted"] == 1 - r["doc_id"] % 2 for r in got if r["doc_id"] is not None and r["doc_id"] < 400)
    by = {r["doc_id"]: r for r in got}
    assert by[400]["score"] == by[401]["score"] and by[402]["predicted"] == 1 and by[None]["held_out"]
    kept = T.keep_ordinary(docs, model)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in rows_of(kept)) == sorted([i for i in range(400) if i % 2] + [400, 401, 1])
    # no labels, empty tables
    bare = T.train(docs, labels.where("toxic > 5"))
    assert {r["predicted"] for r in rows_of(T.score(docs, bare))} == {0}
    assert rows_of(T.score(docs.where("doc_id < -1"), model)) == []


def test_held_out_rows_are_not_learned_from(spark):
    import zlib

    labels = spark.createDataFrame([(i, i % 2) for i in range(500)], "doc_id long, toxic int")
    chosen = rows_of(T.sample(labels, 100))
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in chosen)
    assert max(Counter(r["toxic"] for r in chosen).values()) == 100


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = T.op7_kneser_ney_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    held = got[got.held_out]
    assert np.mean(held.predicted == held.toxic) > 0.95
