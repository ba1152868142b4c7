"""G1-G3, J1-J3, M1, A1-A5, R1-R7."""

import pytest
from pyspark.sql import functions as F

from sftforge.functions.models import model_rows, model_spec_columns, models_frame
from sftforge.operators.compare import (
    blank_missing, comparison, detail_report, long_report, model_summary, score_answers, summary_report)
from sftforge.operators.generate import generate
from sftforge.plans.distill import distill, run_distill
from sftforge.plans.evaluate import answers, run_evaluate
from tests.stubs import (
    STUB_MODELS, FailingGenerator, RecordingFactory, StubGenerator)
from sftforge.queries import QUERIES
from sftforge.sources.testdata import benchmark_items
from tests.conftest import SF


def test_model_spec_column(spark):
    df = spark.createDataFrame([(" a :: b :: - ",), ("x::y::lora",)], "spec string")
    got = [tuple(r) for r in df.select(*model_spec_columns(F.col("spec"))).collect()]
    assert got == [("a", "b", None), ("x", "y", "lora")]
    for bad in ("a::b", "a::b::c::d", " ::b::c", "a:: ::c"):
        with pytest.raises(Exception, match="model spec"):
            model_rows(spark, [bad])


def test_duplicate_model_names_raise(spark):
    with pytest.raises(ValueError):
        model_rows(spark, ["a::b::-", "a::c::-"])


def test_generator_loaded_once_per_task_and_model(spark, tmp_dir):
    items = benchmark_items(spark.read.parquet(f"{SF}/benchmark.parquet")).repartition(2)
    log = f"{tmp_dir}/loads.txt"
    out = answers(items, ["m1::x::-", "m2::y::-"], RecordingFactory(log), {"batch_size": 3})
    rows = out.collect()
    assert len(rows) == 2 * 40
    loads = open(log).read().split()
    assert sorted(set(loads)) == ["m1", "m2"]
    # one model per task: a load for each model and input partition, never one per row
    assert len(loads) == 2 * 2


def test_generation_options_reach_the_factory(spark, tmp_dir):
    import json
    from tests.stubs import OptionsRecorder
    df = spark.createDataFrame([("q",)], "instruction string")
    for temperature, sampled in ((0.0, False), (0.2, True)):
        log = f"{tmp_dir}/opts{temperature}.jsonl"
        distill(df, OptionsRecorder(log), {"temperature": temperature}).collect()
        opts = [json.loads(line) for line in open(log)]
        assert opts and all(o["do_sample"] is sampled for o in opts)
        assert all(o["max_new_tokens"] == 768 and o["batch_size"] == 2 for o in opts)


def test_wrong_number_of_answers_fails(spark):
    df = spark.createDataFrame([("q",)], "instruction string")
    bad = lambda options: (lambda prompts: [])
    with pytest.raises(Exception):
        distill(df, bad).collect()


def test_run_distill_resumes_without_duplicates(spark, tmp_dir):
    prompts = spark.createDataFrame([(f"q{i}", "", "") for i in range(30)],
                                    "instruction string, input string, system string")
    path = f"{tmp_dir}/distilled"
    first = run_distill(spark, prompts.where("instruction < 'q2'"), path, StubGenerator, chunks=2)
    total = run_distill(spark, prompts, path, StubGenerator, chunks=3)
    back = spark.read.parquet(path)
    assert first + total == 30 and back.count() == 30
    assert back.select("instruction").distinct().count() == 30


def scores_fixture(spark):
    rows = [
        ("a", 0, 0, "10", "q10", "ref", ["x"], "x 建议咨询律师"),
        ("a", 0, 1, "2", "q2", "ref", ["x", "y"], "y"),
        ("a", 0, 2, "2", "q2", "ref", ["x", "y"], "x y"),        # duplicate id: last wins
        ("b", 1, 0, "10", "q10-b", "ref", ["x"], "none"),        # item 2 missing for b
    ]
    df = spark.createDataFrame(rows, "model_name string, model_ord int, item_seq long, id string, "
                               "instruction string, reference string, keywords array<string>, answer string")
    return score_answers(df)


def test_pivot_last_wins_missing_null_and_metadata(spark):
    comp = {r["id"]: r for r in comparison(scores_fixture(spark), ["a", "b"]).collect()}
    assert sorted(comp) == ["10", "2"]
    assert comp["2"]["a_answer"] == "x y" and comp["2"]["a_keyword_hit_rate"] == 1.0
    assert comp["2"]["b_answer"] is None
    assert comp["10"]["instruction"] == "q10"  # first model holding the id
    assert comp["10"]["a_has_risk_hint"] is True and comp["10"]["model_order"] == ["a", "b"]
    single = comparison(scores_fixture(spark), ["a"], metrics=("answer",))
    assert single.columns[-1] == "a_answer"


def test_summary_counts_duplicates_and_empty_benchmark(spark):
    scores = scores_fixture(spark)
    models = models_frame(spark, ["a::base::-", "b::base::lora", "c::base::none"])
    s = {r["model_name"]: r for r in model_summary(scores, models, "t").collect()}
    assert s["a"]["num_examples"] == 3 and s["c"]["num_examples"] == 0
    assert s["c"]["avg_keyword_hit_rate"] == 0.0 and s["b"]["adapter"] == "lora"
    assert abs(s["a"]["avg_keyword_hit_rate"] - (1 + 0.5 + 1) / 3) < 1e-12
    empty = scores.limit(0)
    e = model_summary(empty, models, "t").collect()
    assert len(e) == 3 and all(r["num_examples"] == 0 and r["risk_hint_rate"] == 0.0 for r in e)
    rep = summary_report(model_summary(scores, models, "t")).orderBy("model_ord").collect()
    assert [r["model_name"] for r in rep] == ["a", "b", "c"]
    assert rep[0]["avg_keyword_hit_rate"] == round((1 + 0.5 + 1) / 3, 4)


def test_reports(spark):
    comp = comparison(scores_fixture(spark), ["a", "b"])
    det = {r["id"]: r for r in detail_report(comp, ["a", "b"]).collect()}
    assert det["2"]["keywords"] == "x, y" and det["2"]["b_answer"] is None
    assert list(detail_report(comp, ["a", "b"]).columns[4:9]) == [
        "a_keyword_hit_rate", "a_reference_similarity", "a_has_risk_hint", "a_answer", "b_keyword_hit_rate"]
    text = {r["id"]: r for r in blank_missing(detail_report(comp, ["a", "b"])).collect()}
    assert text["2"]["b_answer"] == "" and text["2"]["a_has_risk_hint"] == "false"
    long = long_report(comp, ["a", "b"]).collect()
    assert len(long) == 4 and {r["model_name"] for r in long} == {"a", "b"}


def test_run_evaluate_end_to_end(spark, tmp_dir):
    items = benchmark_items(spark.read.parquet(f"{SF}/benchmark.parquet"))
    counts = run_evaluate(spark, items, STUB_MODELS, f"{tmp_dir}/eval", StubGenerator)
    assert counts["answers"] == counts["scores"] == 120 and counts["summary"] == 3
    summary = spark.read.json(f"{tmp_dir}/eval/models/summary").collect()
    assert {r["model_name"] for r in summary} == {"echo", "lead", "tail"}
    # The default mode keeps what is there; a resumed rerun reuses it and loads no generator.
    with pytest.raises(Exception):
        run_evaluate(spark, items, STUB_MODELS, f"{tmp_dir}/eval", StubGenerator)
    log = f"{tmp_dir}/loads.txt"
    again = run_evaluate(spark, items, STUB_MODELS, f"{tmp_dir}/eval", RecordingFactory(log), resume=True)
    assert again["answers"] == 120
    import os
    assert not os.path.exists(log)
    # Other items, models or options never meet stored answers.
    for other in ((items.limit(4), STUB_MODELS, None), (items, STUB_MODELS[:2], None), (items, STUB_MODELS, {"temperature": 1.0})):
        with pytest.raises(ValueError):
            run_evaluate(spark, other[0], other[1], f"{tmp_dir}/eval", StubGenerator, other[2], resume=True)
    fresh = run_evaluate(spark, items.limit(4), STUB_MODELS[:1], f"{tmp_dir}/eval", StubGenerator, mode="overwrite")
    assert fresh["answers"] == 4 and spark.read.parquet(f"{tmp_dir}/eval/answers").count() == 4
    run_evaluate(spark, items, STUB_MODELS, f"{tmp_dir}/eval", StubGenerator, mode="overwrite")
    detail = (spark.read.option("header", True).option("multiLine", True)
              .option("escape", '"').csv(f"{tmp_dir}/eval/comparison"))
    assert detail.count() == 40 and "echo_reference_similarity" in detail.columns


def test_summary_does_not_depend_on_partitioning(spark):
    rows = [("m", 0, i, str(i), "q", "r", [f"k{j}" for j in range(i % 7 + 1)],
             " ".join(f"k{j}" for j in range(i % 3))) for i in range(300)]
    df = spark.createDataFrame(rows, "model_name string, model_ord int, item_seq long, id string, "
                               "instruction string, reference string, keywords array<string>, "
                               "answer string")
    models = models_frame(spark, ["m::b::-"])
    seen = set()
    for parts in (1, 4, 37):
        scores = score_answers(df.repartition(parts))
        r = model_summary(scores, models, "t").first()
        seen.add((r["avg_keyword_hit_rate"], r["risk_hint_rate"]))
    assert len(seen) == 1


def test_run_distill_resumes_after_a_failed_chunk(spark, tmp_dir):
    prompts = spark.createDataFrame([(f"prompt {i:02d}", "", "") for i in range(40)],
                                    "instruction string, input string, system string")
    path = f"{tmp_dir}/distilled"
    # fail on a prompt of the last chunk, so earlier chunks commit first
    chunk = F.pmod(F.xxhash64("instruction", "input", "system"), F.lit(4))
    victim = prompts.where(chunk == 3).orderBy("instruction").first()["instruction"]
    with pytest.raises(Exception):
        run_distill(spark, prompts, path, FailingGenerator, {"fail_on": victim}, chunks=4)
    done_before = spark.read.parquet(path).count()
    assert 0 < done_before < 40  # earlier chunks kept, the failing one committed nothing
    written = run_distill(spark, prompts, path, StubGenerator, chunks=4)
    back = spark.read.parquet(path)
    assert done_before + written == 40 == back.count()
    assert back.select("instruction").distinct().count() == 40


def test_a_worker_holds_few_responses_at_a_time(spark):
    def rss_writer(options):
        def answer(_):
            with open("/proc/self/statm") as f:
                return f"{int(f.read().split()[1]) * 4096:>20}" + "x" * 300_000
        return lambda prompts: [answer(p) for p in prompts]

    rows = spark.range(0, 900, 1, 1).selectExpr("id", "array(named_struct('role', 'user', 'content', string(id))) AS messages")
    used = generate(rows, rss_writer, {"batch_size": 4}).selectExpr("id", "bigint(trim(substr(response, 1, 20))) AS used", "length(response) AS n").collect()
    assert sorted(r["id"] for r in used) == list(range(900)) and {r["n"] for r in used} == {300_020}
    assert max(r["used"] for r in used) - min(r["used"] for r in used) < 100 << 20  # all responses: 270 MB


def test_scores_of_a_table_in_one_row_group_take_several_tasks(spark, tmp_dir, monkeypatch):
    queries = QUERIES["comparison_pivot"].__globals__
    parts = spark.range(0, 100, 1, 1).selectExpr("IF(id = 7, NULL, id % 90) AS p_partkey", "concat('part ', id) AS p_name", "'Brand#1' AS p_brand",
                                                "'SMALL TIN' AS p_type", "int(id) AS p_size")
    parts.write.parquet(f"{tmp_dir}/part.parquet")
    together = sorted(map(str, queries["_scores"](spark, tmp_dir).collect()))
    monkeypatch.setitem(queries, "SCORED_PARTS", 10)
    dealt = queries["_scores"](spark, tmp_dir)
    assert dealt.rdd.getNumPartitions() == 10
    assert sorted(map(str, dealt.collect())) == together
