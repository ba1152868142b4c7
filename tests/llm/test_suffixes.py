import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sftforge.llm import suffixes as S
from sftforge.llm.buckets import whole_groups  # noqa: F401

from .helpers import SF, rows_of, stored, table


def brute(docs, length):
    texts = [(t or "").encode() for _, t in docs]
    seen = Counter(b[i:i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for (d, _), b in zip(docs, texts):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        gone[-1] = False
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(0)
    for t in range(120):
        n, length = int(rng.integers(1, 120)), int(rng.integers(8, 14))
        d = rng.integers(97, 99, n).astype(np.uint8)
        if t % 3 == 0:
            d[:] = 97
        raw = d.tobytes()
        word = S.eight_bytes(d, length + 16)
        sa, place = S.suffix_array(word, n)
        assert sa.tolist() == sorted(range(n), key=lambda i: raw[i:]) and (place[sa] == np.arange(n)).all()
        shared = S.common_prefixes(word, sa, place, length, 7)
        whole = np.arange(n) + length <= n
        seen = Counter(raw[i:i + length] for i in range(n - length + 1))
        assert S.repeated(d, whole, length).tolist() == [bool(whole[i] and seen[raw[i:i + length]] > 1) for i in range(n)]
        for k in range(1, n):
            a, b = raw[sa[k - 1]:], raw[sa[k]:]
            same = next((m for m, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[k] >= min(same, length)


def test_search_pairs():
    rng = np.random.default_rng(1)
    pairs = np.unique(rng.integers(0, 5, (2, 60)).astype(np.uint64), axis=1)
    at = S.search_pairs(pairs, pairs[:, ::3], None)
    assert (pairs[:, at] == pairs[:, ::3]).all()


def documents_with_repeats(rng):
    vocab = ["ab", "ba", "é", "日", "\x00", " ", "x\n"]
    say = lambda n: "".join(rng.choice(vocab) for _ in range(n))
    shared = [say(40) for _ in range(4)]
    docs = []
    for i in range(70):
        parts = [say(rng.randint(0, 25))]
        for _ in range(rng.randint(0, 2)):
            s = rng.choice(shared)
            a = rng.randint(0, 20)
            parts += [s[a:a + rng.randint(5, 40)], say(rng.randint(0, 15))]
        docs.append((i, "".join(parts)))
    docs += [(80, "a" * 90), (81, None), (82, ""), (None, docs[3][1]), (3, docs[3][1]), (83, say(2500)), (84, docs[5][1] * 3)]
    return docs


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 300, "buckets": 5}, {"shard_bytes": 300, "buckets": 2, "block": 3}])
def test_brute_force_over_shards(spark, tmp_dir, sizes):
    docs = documents_with_repeats(random.Random(8))
    frame = stored(spark, [(*d, 1, "x") for d in docs], "doc_id long, text string, spans int, row string", tmp_dir)
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]) // 2, hashlib.sha256(r["kept"]).hexdigest())
                  for r in rows_of(S.drop_repeated(frame, 16, gram=9, **sizes))), key=str)
    assert got == brute(docs, 16)


def test_query_matches_brute_force(spark):
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                  for r in rows_of(S.op2_suffix_array_dedup(spark, SF))), key=str)
    assert got == brute([(d["doc_id"], d["text"]) for d in table("documents")], 200)


def test_empty_table(spark, tmp_dir):
    assert rows_of(S.drop_repeated(stored(spark, [], "doc_id long, text string", tmp_dir))) == []


def test_unequal_segments_that_a_polynomial_confuses(spark, tmp_dir):
    """The Thue-Morse word and its complement agree under any polynomial modulo a power of two; their strings all differ in place."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    texts = [word, word.translate(str.maketrans("ab", "ba"))]
    docs = [(i, "x" * i + t + "y" * i) for i, t in enumerate(texts)]
    for length in (200, 600):
        out = [tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in rows_of(
            S.drop_repeated(stored(spark, docs, "doc_id long, text string", tmp_dir), length, shard_bytes=2048).selectExpr(
                "doc_id", "n_bytes", "n_bytes - octet_length(kept) AS n_removed", "CAST(size(spans) / 2 AS long) AS n_spans", "sha2(kept, 256) AS kept_sha256"))]
        assert sorted(out, key=str) == brute(docs, length)
