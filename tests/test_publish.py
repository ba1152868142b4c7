"""Several tables published at once."""

import os

import pytest

from sftforge.plans.prepare import PrepareConfig, prepare_turns, run_prepare
from sftforge.sources import publish, published, published_counts, write_table
from tests.conftest import SF


def test_a_crash_between_two_writes_leaves_the_former_run(spark, tmp_dir):
    def write(n, fail=False):
        def tables(folder):
            counts = {"train": write_table(spark.range(n), f"{folder}/train", "parquet")}
            if fail:
                raise RuntimeError("lost")
            return counts | {"prompts": write_table(spark.range(n // 2), f"{folder}/prompts", "parquet")}
        return tables

    def rows():
        here = published(spark, tmp_dir)
        return [spark.read.parquet(f"{here}/{t}").count() for t in ("train", "prompts")]

    with pytest.raises(FileNotFoundError):
        published(spark, tmp_dir)
    with pytest.raises(RuntimeError):
        publish(spark, tmp_dir, write(4, fail=True))
    with pytest.raises(FileNotFoundError):
        published(spark, tmp_dir)
    first = publish(spark, tmp_dir, write(10))
    assert rows() == [10, 5] and published_counts(spark, tmp_dir) == {"train": 10, "prompts": 5}
    with pytest.raises(RuntimeError):
        publish(spark, tmp_dir, write(20, fail=True))
    assert published(spark, tmp_dir) == first and rows() == [10, 5]
    second = publish(spark, tmp_dir, write(30))
    assert published(spark, tmp_dir) == second != first and rows() == [30, 15]
    assert os.path.exists(f"{first}/train")  # still there for its readers
    publish(spark, tmp_dir, write(40), keep=2)
    assert rows() == [40, 20] and os.path.exists(second) and not os.path.exists(first)


def test_prepare_published(spark, tmp_dir):
    turns, config = spark.read.parquet(f"{SF}/conversations.parquet"), PrepareConfig(prompt_samples=5)
    here = publish(spark, tmp_dir, lambda folder: run_prepare(prepare_turns(turns, config), folder, config))
    counts = published_counts(spark, tmp_dir)
    assert counts["prompts"] == 5 == spark.read.json(f"{here}/prompts").count()
    assert counts["train"] == spark.read.json(f"{published(spark, tmp_dir)}/train").count()
