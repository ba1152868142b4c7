"""P9-P13, H1 and the prepare plan: fixtures, brute force and invariance."""

import hashlib

import pytest
from pyspark.sql import functions as F

from sftforge.operators.dedup import dedup_first
from sftforge.operators.sample import below, cap_threshold, first_n_by_key, key_counts, sample_key
from sftforge.plans.prepare import (
    PrepareConfig, prepare, prepare_turns, run_prepare, to_records, with_holdout)
from sftforge.functions.prompts import DEFAULT_SYSTEM_PROMPT
from tests.conftest import SF

A20 = "a long enough answer!"  # 21 chars


def raw_rows(spark):
    rows = [
        (0, "What is X?", None, None, A20, None),
        (1, "What is X?", None, None, "another long answer here", None),  # duplicate key
        (2, "Short?", None, None, "too short", None),                       # rejected
        (3, "Short?", None, None, "now this one is long enough", None),    # later copy wins
        (4, None, "only input", None, None, "answer from the answer col"),
        (5, "both", "ctx", None, "x" * 25, None),
        (6, None, None, "title only q", "N/A", "fallback answer text ok"),
    ]
    schema = "_ord long, instruction string, input string, title string, output string, answer string"
    return spark.createDataFrame(rows, schema)


def test_records_and_first_wins(spark):
    cfg = PrepareConfig(max_samples=100, prompt_samples=100)
    recs = to_records(raw_rows(spark), cfg)
    got = {r["_ord"]: (r["instruction"], r["input"], r["output"], r["reject_reason"])
           for r in recs.collect()}
    assert got[2][3] == "short" and got[3][3] is None
    assert got[4][:3] == ("only input", "", "answer from the answer col")
    assert got[5][:2] == ("both", "")  # input is only an instruction candidate
    assert got[6][2] == "N/A"          # NA words are a CSV reader concern
    train = {r["instruction"]: r["output"] for r in prepare(raw_rows(spark), cfg).training.collect()}
    assert train["What is X?"] == A20
    assert train["Short?"] == "now this one is long enough"
    assert got[5][3] == "short" and got[6][3] == "short"  # 4-char instruction, 3-char output
    assert len(train) == 3


def test_keep_input_opt_in(spark):
    cfg = PrepareConfig(keep_input=True)
    got = {r["_ord"]: (r["instruction"], r["input"]) for r in to_records(raw_rows(spark), cfg).collect()}
    assert got[5] == ("both", "ctx") and got[4] == ("only input", "")


def py_sample(pairs, seed, n):
    keyed = sorted((hashlib.md5(f"{seed}|{i}|{inp}".encode()).hexdigest(), i, inp)
                   for i, inp in pairs)
    return keyed[:max(n, 0)]


@pytest.mark.parametrize("n", [0, 1, 7, 50, 199, 200, 5000])
def test_cap_equals_brute_force(spark, n):
    pairs = [(f"question number {i}", "") for i in range(200)]
    df = spark.createDataFrame(pairs, "instruction string, input string")
    key = sample_key(42, F.col("instruction"), F.col("input"))
    got = sorted((r["_skey"], r["instruction"], r["input"]) for r in
                 first_n_by_key(df, key, n).collect())
    assert got == py_sample(pairs, 42, n)


def test_key_counts_by_prefix(spark):
    df = spark.createDataFrame([("abcdef01",), ("abcdef01",), ("abcd00ff",), ("abce0000",)], "_skey string")
    assert key_counts(df) == [("abcd", 2), ("abce", 1)]
    assert key_counts(df, "abcd") == [("abcd00ff", 1), ("abcdef01", 1)]


def test_all_rows_are_kept_unless_a_cap_is_set(spark):
    raw = spark.range(100_000).selectExpr("id AS _ord", "concat('question number ', id) AS question",
                                          "concat('an answer that is long enough ', id) AS answer")
    got = prepare(raw)
    assert got.training.count() == 100_000 and got.prompts.count() == 100_000
    capped = prepare(raw, PrepareConfig(prompt_samples=7))
    assert capped.training.count() == 100_000 and capped.prompts.count() == 7


def test_prompts_are_a_prefix_of_training_and_partition_invariant(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    cfg = PrepareConfig(max_samples=10, prompt_samples=4)
    results = []
    for parts in (1, 4, 37):
        prep = prepare_turns(turns.repartition(parts), cfg, persist=False)
        train = sorted(tuple(r) for r in prep.training.collect())
        prompts = sorted(tuple(r) for r in prep.prompts.collect())
        results.append((train, prompts))
        keys = [t[-1] for t in train]
        assert len(train) == 10 and len(prompts) == 4
        assert sorted(p[-1] for p in prompts) == sorted(keys)[:4]
        assert all(t[3] == DEFAULT_SYSTEM_PROMPT for t in train)
    assert results[0] == results[1] == results[2]


def test_prepare_is_idempotent_and_holdout_partitions(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    train = prepare_turns(turns, PrepareConfig(), persist=False).training
    again = dedup_first(train.withColumn("_o", F.monotonically_increasing_id()),
                        ("instruction", "input"), "_o", drop_order=True)
    assert train.count() == again.count()
    split = with_holdout(train, PrepareConfig(val_size=0.2))
    counts = {r[0]: r[1] for r in split.groupBy("split").count().collect()}
    assert sum(counts.values()) == train.count() and set(counts) <= {"train", "eval"}


def test_run_prepare_writes_sorted_tables(spark, tmp_dir):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    cfg = PrepareConfig(max_samples=12, prompt_samples=5)
    counts = run_prepare(prepare_turns(turns, cfg), f"{tmp_dir}/out", cfg)
    assert counts == {"train": 12, "prompts": 5}
    back = spark.read.json(f"{tmp_dir}/out/train")
    assert sorted(back.columns) == ["input", "instruction", "output", "system"]
    prompts = spark.read.json(f"{tmp_dir}/out/prompts").collect()
    assert {r["instruction"] for r in prompts} <= {r["instruction"] for r in back.collect()}


def test_flat_columns_and_messages_together(spark):
    msgs = [{"role": "user", "content": "user turn question?"},
            {"role": "assistant", "content": "assistant turn answer, long enough"}]
    rows = [
        (0, None, "a flat answer that is long enough", msgs),   # no flat question: dropped
        (1, "flat question here", None, msgs),                   # flat q + assistant turns
        (2, None, None, msgs),                                   # both from messages
        (3, None, None, None),                                   # null list: missing
    ]
    schema = ("_ord long, instruction string, output string, "
              "messages array<struct<role:string,content:string>>")
    got = {r["_ord"]: (r["instruction"], r["output"], r["reject_reason"])
           for r in to_records(spark.createDataFrame(rows, schema)).collect()}
    assert got[0] == ("", "a flat answer that is long enough", "missing")
    assert got[1] == ("flat question here", "assistant turn answer, long enough", None)
    assert got[2] == ("user turn question?", "assistant turn answer, long enough", None)
    assert got[3][2] == "missing"


def test_run_prepare_flat_rows_with_holdout(spark, tmp_dir):
    from sftforge.sources.testdata import flat_rows
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cfg = PrepareConfig(max_samples=40, prompt_samples=15, val_size=0.25)
    counts = run_prepare(prepare(flat_rows(docs), cfg, order="doc_id"), f"{tmp_dir}/flat", cfg,
                         fmt="parquet", holdout=True)
    assert counts == {"train": 40, "prompts": 15}
    back = spark.read.parquet(f"{tmp_dir}/flat/train")
    assert set(r[0] for r in back.select("split").distinct().collect()) <= {"train", "eval"}
    assert back.select("instruction").distinct().count() == 40


def test_cap_descends_into_a_crowded_bucket(spark):
    # many (unique) keys share a prefix, so the threshold lies some steps down
    keys = ([f"aaaa{i:028x}" for i in range(40)] + [f"aaab{i:028x}" for i in range(25)]
            + [f"0000{i:028x}" for i in range(5)])
    df = spark.createDataFrame([(k,) for k in keys * 2], "_skey string")
    for n in (0, 1, 5, 6, 44, 45, 46, 70, 71):
        got = sorted({r[0] for r in below(df, cap_threshold(df, n)).collect()})
        assert got == sorted(keys)[:n]


def test_persisted_prepare_equals_two_pass_prepare(spark):
    from sftforge.sources.testdata import flat_rows
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cfg = PrepareConfig(max_samples=30, prompt_samples=9)
    a = prepare(flat_rows(docs), cfg, order="doc_id")
    b = prepare(flat_rows(docs), cfg, order="doc_id", persist=True)
    assert sorted(tuple(r) for r in a.training.collect()) == \
        sorted(tuple(r) for r in b.training.collect())
    assert sorted(tuple(r) for r in a.prompts.collect()) == \
        sorted(tuple(r) for r in b.prompts.collect())


def test_dedup_sorts_and_shuffles_by_digest_only(spark, tmp_dir):
    import re

    from tests.test_streaming_plans import plan_text

    rows = [(1, "a", "b:c"), (2, "a", "b:c"), (3, "a1:b", "c"), (4, None, "x"), (5, None, "x"), (6, "", "x"), (7, "-", "x"),
            (8, "1:a", ""), (9, "1", "a"), (10, "é", "x"), (11, "é", "x")]
    df = spark.createDataFrame(rows, "n long, instruction string, input string")
    got = sorted(r["n"] for r in dedup_first(df, ("instruction", "input"), "n").collect())
    assert got == [1, 3, 4, 6, 7, 8, 9, 10]
    df.write.parquet(f"{tmp_dir}/rows")
    plan = plan_text(dedup_first(spark.read.parquet(f"{tmp_dir}/rows"), ("instruction", "input"), "n"))
    for line in plan.splitlines():
        if re.search(r"\b(Sort|Exchange)\b", line):
            assert "instruction" not in line and "input" not in line
