"""P1, P2, B4 against plain-Python statements of the same rules."""

import random
import re

from pyspark.sql import functions as F

from sftforge.functions.text import (
    INSTRUCTION_CANDIDATES, exact_names, normalize_text, pick_first, strip_text)

WS_POINTS = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isspace()]


def py_normalize(v):
    return re.sub(r"\s+", " ", "" if v is None else str(v)).strip()


def random_texts(n, seed=7):
    rnd = random.Random(seed)
    pool = [chr(c) for c in WS_POINTS] + list("ab é😀,.​﻿") + ["�"]
    return [None] + ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 30)))
                     for _ in range(n)]


def test_every_python_whitespace_code_point(spark):
    rows = [(i, f"a{chr(c)}{chr(c)}b{chr(c)}") for i, c in enumerate(WS_POINTS)]
    rows.append((len(rows), "a​b"))  # zero-width space is not whitespace
    df = spark.createDataFrame(rows, "i int, t string")
    got = dict(df.select("i", normalize_text(F.col("t"))).collect())
    for i, t in rows:
        assert got[i] == py_normalize(t), (i, t)


def test_normalize_and_strip_match_python_on_random_text(spark):
    texts = random_texts(400)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    out = df.select("i", normalize_text(F.col("t")).alias("n"),
                    strip_text(F.col("t")).alias("s")).collect()
    for r in out:
        t = texts[r["i"]]
        assert r["n"] == py_normalize(t)
        assert r["s"] == ("" if t is None else t.strip())


def test_pick_first_priority_blank_and_case(spark):
    df = spark.createDataFrame(
        [(" ", "q1", "Q-upper", "p"), (None, None, "x", "  prompt\t here "),
         ("inst", "q", None, None), (None, None, None, None)],
        "instruction string, question string, Question string, prompt string")
    safe, names = exact_names(df)
    got = [r[0] for r in safe.select(pick_first(safe, INSTRUCTION_CANDIDATES, names)).collect()]
    # `Question` is not a candidate name: matching is case-sensitive.
    assert got == ["q1", "prompt here", "inst", ""]


def test_pick_first_numbers_and_skips_non_atomic(spark):
    df = spark.createDataFrame([(12, ["x"], "ans")], "question int, instruction array<string>, output string")
    got = df.select(pick_first(df, INSTRUCTION_CANDIDATES)).first()[0]
    assert got == "12"
