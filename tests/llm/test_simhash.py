import re

import numpy as np
import pytest
import xxhash

from sftforge.llm import simhash as S
from sftforge.llm.graph import connected_components

from .helpers import SF, rows_of, stored, table


def brute_fp(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[i:i + 4]) for i in range(max(len(w) - 3, 1))] if w else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(items, bits=4):
    parent = list(range(len(items)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if (items[i][1] ^ items[j][1]).bit_count() <= bits:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(items)):
        groups.setdefault(find(i), []).append(items[i][0])
    least = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return [least[find(i)] for i in range(len(items))]


def test_query_matches_brute_force(spark):
    docs = table("documents")
    items = [(d["doc_id"], brute_fp(d["text"])) for d in docs]
    want = {(d, f"{fp:016x}", c) for (d, fp), c in zip(items, brute_components(items))}
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows_of(S.op8_simhash_pigeonhole(spark, SF))}
    assert got == want


def test_edge_cases_and_clashing_columns(spark, tmp_dir):
    long = " ".join(f"w{i}" for i in range(5000))
    rows = [(1, None, "x", 1), (2, "", "x", 1), (3, "One two", "x", 1), (None, "one TWO", "x", 1), (5, long, "x", 1),
            (6, long + " tail", "x", 1), (6, long + " tail", "x", 1), (None, " ", None, 1), (8, "a  b\tc\nd e", None, 1)]
    docs = stored(spark, rows, "doc_id long, text string, root string, fp int", tmp_dir)
    prints = S.fingerprints(docs)
    got = sorted((str(r["doc_id"]), r["fp"] % (1 << 64), str(r["component_id"])) for r in rows_of(S.near_duplicates(prints)))
    items = [(r[0], brute_fp(r[1])) for r in rows]
    want = sorted((str(d), fp, str(c)) for (d, fp), c in zip(items, brute_components(items)))
    assert got == want
    kept = S.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in rows_of(kept)) == sorted(["1", "3", "5", "None", "8"])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert rows_of(S.near_duplicates(S.fingerprints(docs))) == []


@pytest.mark.parametrize("block", [7, 4096])
@pytest.mark.parametrize("parts", [None, [2, 1], [1, 1, 0], [0] * 5, [1, -1, 2]])
def test_links_lose_none_with_hot_keys(spark, block, parts):
    """Dense balls (one hot key), any thresholds, blocks or none: the same components as brute force."""
    rng = np.random.default_rng(3)
    fps = set()
    for _ in range(6):
        c = int(rng.integers(1 << 63))
        for _ in range(25):
            x = c
            for b in rng.integers(0, 64, rng.integers(0, 6)):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    distinct = spark.createDataFrame([(x,) for x in signed], "fp long")
    chosen = S.plan(distinct) if parts is None else [
        (b, t) for b, t in zip(S.correlated_parts(*S.bit_counts(distinct), len(parts)), parts) if t >= 0]
    assert sum(t + 1 for _, t in chosen) >= 5
    edges = S.links(distinct, chosen, block=block)
    root = {r["node"]: r["root"] for r in rows_of(connected_components(edges))}
    comp = brute_components(list(zip(range(len(fps)), fps)))
    got = [root.get(x, x) for x in signed]
    assert len(set(zip(got, comp))) == len(set(comp)) == len(set(got))


def test_allocate_is_least_cost():
    cost, t = S.allocate([[0, 5, 9], [0, 1, 2], [0, 4, 40]], 3)
    assert (cost, t) == (6, [-1, 1, 0])


@pytest.mark.parametrize("bits", [15])
def test_many_bits_match_brute_force(spark, bits):
    rng = np.random.default_rng(bits)
    items = []
    for i in range(30):
        fp = int(rng.integers(0, 1 << 64, dtype=np.uint64))
        for differ in (0, bits - 1, bits, bits + 1):  # from the first of the four
            near = fp
            for b in rng.permutation(64)[:differ].tolist():
                near ^= 1 << b
            items.append((len(items), near))
    signed = [(i, fp - (1 << 64) if fp >> 63 else fp) for i, fp in items]
    got = sorted((r["doc_id"], r["component_id"]) for r in rows_of(S.near_duplicates(spark.createDataFrame(signed, "doc_id long, fp long"), bits)))
    assert got == [(i, c) for (i, _), c in zip(items, brute_components(items, bits))]


def test_bits_out_of_range(spark):
    for bits in (-1, 65):
        with pytest.raises(ValueError):
            S.plan(spark.createDataFrame([(1,), (2,)], "fp long"), bits)
