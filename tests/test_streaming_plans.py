"""Streaming stage and plan-shape assertions."""

from sftforge.plans.prepare import PrepareConfig, prepare_turns, to_records
from sftforge.queries import QUERIES
from sftforge.sources.testdata import flat_rows
from sftforge.streaming.incremental import clean_stream, start_clean_stream
from tests.conftest import SF


def test_stream_equals_batch(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    flat_rows(docs).drop("doc_id").write.parquet(f"{tmp_dir}/in")
    src = spark.readStream.schema(spark.read.parquet(f"{tmp_dir}/in").schema).parquet(f"{tmp_dir}/in")
    q = start_clean_stream(src, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/out").collect())
    want = sorted(tuple(r) for r in clean_stream(spark.read.parquet(f"{tmp_dir}/in")).collect())
    assert got == want and len(got) > 0


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_prepare_has_no_python_and_prunes_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    recs = to_records(flat_rows(docs), PrepareConfig(), "doc_id")
    plan = plan_text(recs)
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "n_chars" not in plan.split("ReadSchema")[1].split("\n")[0]
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    train = prepare_turns(turns, PrepareConfig(max_samples=5), persist=False).training
    assert "Python" not in plan_text(train)


def test_every_query_builds(spark):
    for name in ("messages_fold", "quality_filter", "comparison_pivot", "bench_cross_models"):
        df = QUERIES[name](spark, SF)
        assert df.columns
    assert "CartesianProduct" not in plan_text(QUERIES["bench_cross_models"](spark, SF))
    assert "NestedLoopJoin" not in plan_text(QUERIES["bench_cross_models"](spark, SF))


def test_cap_plan_has_no_window_sort_or_single_task_limit(spark):
    from sftforge.plans.prepare import select_training
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    recs = to_records(flat_rows(docs), PrepareConfig(), "doc_id")
    prep = select_training(recs, PrepareConfig(max_samples=50, prompt_samples=10), "doc_id")
    for df in (prep.training, prep.prompts):
        plan = plan_text(df)
        assert "TakeOrderedAndProject" not in plan and "GlobalLimit" not in plan and "Window" not in plan
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
        assert plan.split("+- == Initial Plan")[0].count("Exchange hashpartitioning") <= 2
        assert "LessThan(_skey" in plan  # the threshold reaches the scan


def test_only_similarity_and_generation_run_python(spark):
    for name in ("keyword_hit_rate", "detail_report_text", "similarity_bound", "risk_flag", "distilled_round_trip", "model_specs", "prepare_train"):
        plan = plan_text(QUERIES[name](spark, SF))
        assert "Python" not in plan and "ArrowEval" not in plan and "Pandas" not in plan


def test_bounded_fold_drops_heavy_conversations_with_a_broadcast_anti_join(spark):
    from sftforge.operators.fold import fold_turns_bounded
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    plan = plan_text(fold_turns_bounded(turns))
    assert "LeftAnti" in plan and "BroadcastExchange" in plan
