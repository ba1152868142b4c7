"""The three jobs chained through files, as a user would run them."""

from sftforge.plans.distill import run_distill
from sftforge.plans.evaluate import run_evaluate
from sftforge.plans.prepare import PrepareConfig, prepare_turns, run_prepare
from tests.stubs import STUB_MODELS, StubGenerator
from sftforge.sources.readers import read_prompts
from sftforge.sources.testdata import benchmark_items
from tests.conftest import SF


def test_prepare_then_distill_then_evaluate(spark, tmp_dir):
    cfg = PrepareConfig(max_samples=12, prompt_samples=8)  # 16 conversations pass at sf0.001
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    assert run_prepare(prepare_turns(turns, cfg), f"{tmp_dir}/prep", cfg) == \
        {"train": 12, "prompts": 8}

    prompts = read_prompts(spark, f"{tmp_dir}/prep/prompts")
    assert run_distill(spark, prompts, f"{tmp_dir}/distilled", StubGenerator,
                       {"base_model": "stub-tail"}, chunks=2) == 8
    distilled = spark.read.parquet(f"{tmp_dir}/distilled").collect()
    assert len(distilled) == 8
    for r in distilled:  # the tail stub answers with the user content from char 41
        assert r["output"] == r["instruction"][40:].strip() and r["input"] == ""

    items = benchmark_items(spark.read.parquet(f"{SF}/benchmark.parquet"))
    counts = run_evaluate(spark, items, STUB_MODELS, f"{tmp_dir}/eval", StubGenerator)
    assert counts["answers"] == 3 * 40 and counts["summary"] == 3
