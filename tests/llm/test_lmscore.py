import math
import re
import sys
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sftforge.llm import lmscore as M

from .helpers import SF, rows_of, stored, table


def split(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "</s>"]


def brute(docs, order, mu):
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs]
    c = Counter()
    for (d, t), h in zip(docs, held):
        if d is None or h:
            continue
        w = ["<s>", *split(t)]
        c[("<s>",)] += 1
        for k in range(1, order + 1):
            c.update(tuple(w[i - k + 1:i + 1]) for i in range(1, len(w)) if i >= k - 1)
    uni = {g[0]: n for g, n in c.items() if len(g) == 1 and g != ("<s>",)}
    total, vocab = sum(uni.values()), len(uni)

    def p(h, w):
        if not h:
            return (uni.get(w, 0) + 1) / (total + vocab + 1)
        return (c[(*h, w)] + mu * p(h[1:], w)) / (c[h] + mu)

    out = []
    for (d, t), h in zip(docs, held):
        w = ["<s>", *split(t)]
        out.append((d, h, len(w) - 1, sum(x in uni for x in w[1:]), total,
                    sum(math.log10(p((), x)) for x in w[1:]),
                    sum(math.log10(p(tuple(w[max(0, i - order + 1):i]), w[i])) for i in range(1, len(w)))))
    return out


def compare(df, want):
    key = lambda r: (str(r[0]), r[2], r[5])
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])
                  for r in rows_of(df)), key=key)
    want = sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def test_query_matches_brute_force(spark):
    compare(M.op4_backoff_automaton(spark, SF), brute([(d["doc_id"], d["text"]) for d in table("documents")], M.ORDER, M.MU))


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_edge_cases_over_many_shards(spark, tmp_dir, order):
    texts = ["a b a b c", "A  b\tc\x0bd", None, "", " ", "é b a", "a b c d e f " * 700, "a b c d", "c\x1cd a b"]
    docs = [(i, texts[i % len(texts)]) for i in range(40)] + [(None, "a b z"), (3, "a b a")]
    frame = stored(spark, [(*d, 1, "x") for d in docs], "doc_id long, text string, level int, shard string", tmp_dir)
    compare(M.lm_scores(frame, order, 2.5, shard_bytes=3000, buckets=5), brute(docs, order, 2.5))


def test_no_training_and_empty(spark, tmp_dir):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    compare(M.lm_scores(stored(spark, [(held, "a b")], "doc_id long, text string", tmp_dir)),
            [(held, True, 3, 0, 0, 0.0, 0.0)])
    assert rows_of(M.lm_scores(stored(spark, [], "doc_id long, text string", tmp_dir))) == []


def test_a_shard_takes_little_memory_and_counts_beyond_32_bits_hold():
    rnd = np.random.default_rng(1)
    texts = pa.array([" ".join(map(str, rnd.zipf(1.3, 1000) % 50_000)) for _ in range(200)])
    tracemalloc.start()
    grams = M.Grams([texts.slice(i, 10) for i in range(0, 200, 10)], 3, 64, sending=False)
    counts = [M._unpacked(M._packed(rnd.integers(0, 3, n)), n) for n in grams.n]
    counts[0] = counts[0].astype(np.int64) + (1 << 40)
    auto = M.Automaton(grams, counts, 1 << 50, 50_000, M.MU)
    scores = auto.scores(grams)
    assert tracemalloc.get_traced_memory()[1] < 130 * len(grams.row)
    tracemalloc.stop()
    assert np.isfinite(scores).all() and (scores < 0).all()


def _automaton(texts, order):
    grams = M.Grams([pa.array(texts)], order, 64, sending=False)
    learned = (np.arange(grams.docs) % 3 > 0)[grams.row]
    counts = [np.bincount(p[(p >= 0) & learned], minlength=n) for p, n in zip(grams.place, grams.n)]
    return grams, M.Automaton(grams, counts, int(counts[0].sum()), int((counts[0] > 0).sum()), 2.5)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_the_traversal_is_one_from_left_to_right_however_it_is_cut(order, monkeypatch):
    rnd = np.random.default_rng(2)
    grams, auto = _automaton([" ".join(map(str, rnd.integers(0, 9, n))) for n in (0, 1, 2, 90, 0, 400, 7)], order)
    want = []
    for first, size in zip(grams.first.tolist(), grams.size.tolist()):
        state, total = auto.begin, 0.0
        for t in range(first + 1, first + 1 + size):
            while (arc := auto.arcs[auto.depth[state]][grams.place[auto.depth[state]][t]]) < 0:
                total += auto.fail_weight[state]
                state = auto.fail[state]
            total += auto.weights[arc]
            state = auto.nexts[arc]
        want.append(total)
    assert auto.scores(grams).tolist() == want
    monkeypatch.setattr(M, "STEP_TOKENS", 7)
    assert auto.scores(grams).tolist() == want


def test_a_long_text_takes_no_step_of_the_worker_for_each_of_its_tokens():
    rnd = np.random.default_rng(3)
    grams, auto = _automaton([" ".join(map(str, rnd.zipf(1.3, 20_000))), "1 2 3", "2 1"], 3)
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        auto.scores(grams)
    finally:
        sys.setprofile(None)
    assert calls < 1000
