"""E1-E5 against the Python definitions."""

import difflib
import math
import random
import time

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sftforge.functions.scores import (
    has_risk_hint, keyword_hit_rate, round_score, similarity_upper_bound, RISK_HINT_TOKENS)
from sftforge.functions.similarity import ratio, reference_similarity
from sftforge.queries import QUERIES


def py_kw(answer, keywords):
    if not keywords:
        return 0.0
    return sum(1 for k in keywords if k and k in answer) / len(keywords)


def test_keyword_hit_rate_cases(spark):
    cases = [("abc", []), ("abc", ["", "a"]), ("abc", ["a", "a", "b"]), ("abc", ["A"]),
             ("abc", None), ("", ["x"])]
    df = spark.createDataFrame(cases, "a string, k array<string>")
    got = [r[0] for r in df.select(keyword_hit_rate(F.col("a"), F.col("k"))).collect()]
    assert got == [py_kw(a, k or []) for a, k in cases]


def test_risk_hint_default_tokens(spark):
    df = spark.createDataFrame([("前文" + RISK_HINT_TOKENS[4] + "。",), ("无",), (None,)], "a string")
    assert [r[0] for r in df.select(has_risk_hint(F.col("a"))).collect()] == [True, False, False]


def py_ratio(a, b):
    return difflib.SequenceMatcher(None, a, b).ratio()


def random_pairs(n, seed):
    """Unrelated pairs and near copies, on both sides of the length from which characters can be popular."""
    rnd = random.Random(seed)
    for _ in range(n):
        alpha = rnd.choice(["ab", "abcdef", "the quick brown fox.", "abcde fgh的了是😀XYZ0123456789"])
        b = "".join(rnd.choice(alpha) for _ in range(rnd.choice([0, 1, 3, 12, 40, 120, 199, 200, 201, 260, 420])))
        a = "".join(rnd.choice(alpha) for _ in range(rnd.choice([0, 1, 5, 30, 90, 210])))
        if rnd.random() < 0.4:
            cut = list(b)
            for _ in range(rnd.randint(0, 6)):
                p = rnd.randint(0, len(cut))
                cut[p:p + rnd.randint(0, 3)] = rnd.choice(["", "x", alpha[:2]])
            a = "".join(cut)
        yield a, b


def test_ratio_equals_the_definition_on_random_pairs():
    for a, b in random_pairs(10_000, 5):
        assert ratio(a, b) == py_ratio(a, b), (a, b)


def test_ratio_of_long_texts():
    docs = [r["text"] for r in pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist()][:60]
    for a, b in zip(docs, docs[1:]):
        assert ratio(a[:4000], b[:4000]) == py_ratio(a[:4000], b[:4000])
        assert ratio(b + a[:50], b) == py_ratio(b + a[:50], b)


def test_ratio_of_near_copies_takes_steps_as_their_length():
    """Single characters of all kinds, so none is popular and the blocks are long; and words, whose letters are."""
    rnd = random.Random(9)
    for size, letter in ((150_000, lambda: chr(rnd.randrange(0x4E00, 0x9000))), (600_000, lambda: rnd.choice("etaoin shrdlu") if rnd.random() < 0.97 else chr(rnd.randrange(65, 90)))):
        b = "".join(letter() for _ in range(size))
        began = time.process_time()
        assert ratio("  " + b[:-5], b) == 2 * (size - 5) / (2 * size - 3)
        assert time.process_time() - began < 5


def test_ratio_equals_the_definition_with_odd_code_points():
    rnd = random.Random(4)
    for alpha in ("\U0010ffff\ud800ab", "".join(map(chr, range(0x4E00, 0x4F00))), "".join(map(chr, range(0x1F600, 0x1F640))) + "abc " * 40):
        for _ in range(40):
            b = "".join(rnd.choice(alpha) for _ in range(rnd.choice([200, 500, 1500])))
            p, q = sorted(rnd.randrange(len(b)) for _ in range(2))
            for a in (b[q:] + b[:p], b[:p] + "\U0010fffe~" + b[q:], b[p:q] * 3, "".join(rnd.choice(alpha) for _ in range(300))):
                assert ratio(a, b) == py_ratio(a, b), (a, b)


def test_similarity_and_bound(spark):
    pairs = [("", ""), ("tide", "diet"), ("diet", "tide"), ("abc", ""), ("a", "a"), ("a", "ab"), ("x" * 5000, "x" * 4000)]
    pairs += list(random_pairs(150, 3))
    df = spark.createDataFrame(pairs, "a string, b string").repartition(3)
    a, b = F.col("a"), F.col("b")
    got = df.select("a", "b", reference_similarity(a, b).alias("s"), similarity_upper_bound(a, b).alias("u"),
                    reference_similarity(a, b, at_least=0.6).alias("t")).collect()
    assert {(r["a"], r["b"]): r["s"] for r in got}["tide", "diet"] == 0.25
    for r in got:
        la, lb = len(r["a"]), len(r["b"])
        assert r["s"] == py_ratio(r["a"], r["b"]) <= r["u"] == (2 * min(la, lb) / (la + lb) if la + lb else 1.0)
        assert r["t"] == (r["s"] if r["u"] >= 0.6 else None)
    nulls = spark.createDataFrame([(None, None), (None, "x")], "a string, b string")
    assert [r[0] for r in nulls.select(reference_similarity(a, b)).collect()] == [1.0, 0.0]


def test_similarity_query_over_whole_documents(spark):
    rows = QUERIES["similarity_documents"](spark, "/root/testdata/sf0.001").collect()
    answers = {(r["model_name"], r["item_seq"]): r for r in QUERIES["similarity_documents"].__globals__["_answers"](spark, "/root/testdata/sf0.001").collect()}
    assert len(rows) == len(answers)
    for r in rows:
        x = answers[r["model_name"], r["item_seq"]]
        assert r["reference_similarity"] == py_ratio(x["answer"], x["reference"])


def test_round_equals_python(spark):
    rnd = random.Random(7)
    vals = [k / n for n in range(1, 501) for k in range(n + 1)] + [k / n for n in (625, 1250, 1999, 2000) for k in range(n + 1)]
    vals += [k / 32 for k in range(200)] + [rnd.random() for _ in range(20_000)] + [rnd.uniform(-1e6, 1e6) for _ in range(5000)]
    vals += [rnd.randrange(1 << 20) / (1 << 20) for _ in range(5000)] + [0.00005, -0.00005, 2 / 3, 1.0, -0.0, 0.0, 5e-324, 1e300, float(1 << 36)]
    df = spark.createDataFrame([(v,) for v in dict.fromkeys(vals)], "x double")
    assert [(r[0], r[1]) for r in df.select("x", round_score(F.col("x"))).collect() if r[1] != round(r[0], 4)] == []
    odd = spark.createDataFrame([(None,), (float("inf"),), (float("nan"),)], "x double").select(round_score(F.col("x"))).collect()
    assert odd[0][0] is None and odd[1][0] == math.inf and math.isnan(odd[2][0])
