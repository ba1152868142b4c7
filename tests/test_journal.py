"""Generation that survives lost tasks, and one model at a time."""

import glob
import os
import subprocess
import sys

import pytest

from sftforge.operators.generate import generate
from sftforge.operators.journal import Journal
from sftforge.plans.distill import distill
from sftforge.plans.evaluate import run_evaluate
from tests.stubs import Counted

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def prompts_of(spark, n, parts):
    return spark.range(n, numPartitions=parts).selectExpr("concat('prompt ', id) AS instruction", "'' AS input", "'' AS system")


def seen(folder, kind):
    return [open(f, encoding="utf-8").read() for f in glob.glob(f"{folder}/{kind}-*")]


def test_a_killed_task_repeats_one_batch(tmp_dir):
    """In a session with retries, a task whose Python process dies goes on at the batch it was killed in."""
    script = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate())
from tests.stubs import Counted
from tests.test_journal import prompts_of
from sftforge.plans.distill import distill
rows = distill(prompts_of(spark, 60, 2), Counted({tmp_dir!r}, "prompt 47"), {{"batch_size": 5}}, journal={tmp_dir + "/journal"!r}).collect()
assert sorted(r["output"] for r in rows) == sorted(f"prompt {{i}}"[::-1] for i in range(60)), rows
spark.stop()
"""
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300,
                          env={**os.environ, "PYTHONPATH": ROOT})
    assert done.returncode == 0, done.stderr[-2000:]
    assert os.path.exists(f"{tmp_dir}/dead")
    batches = seen(tmp_dir, "batch")
    assert len(batches) == len(set(batches)) == 12  # none was generated twice
    assert len(seen(tmp_dir, "load")) == 3  # two tasks, and the killed one again


def test_a_later_run_takes_up_the_journal(spark, tmp_dir):
    rows, journal = prompts_of(spark, 40, 3), f"{tmp_dir}/journal"
    with pytest.raises(Exception):
        distill(rows, Counted(tmp_dir, "prompt 33"), {"batch_size": 4}, journal=journal).collect()
    before = set(seen(tmp_dir, "batch"))
    assert before
    out = distill(rows, Counted(tmp_dir, "prompt 33"), {"batch_size": 4}, journal=journal).collect()
    assert sorted(r["output"] for r in out) == sorted(f"prompt {i}"[::-1] for i in range(40))
    batches = seen(tmp_dir, "batch")
    assert len(batches) == len(set(batches))
    loads = len(seen(tmp_dir, "load"))
    assert len(distill(rows, Counted(tmp_dir), {"batch_size": 4}, journal=journal).collect()) == 40
    assert len(seen(tmp_dir, "load")) == loads  # all found: no generator was built
    distill(rows, Counted(tmp_dir), {"batch_size": 4, "temperature": 0.9}, journal=journal).collect()
    assert len(seen(tmp_dir, "batch")) > len(batches)  # other options are other batches


def test_journal_files(tmp_dir):
    j = Journal(f"file:{tmp_dir}/j")
    key = Journal.key({"a": 1, "b": None}, [[{"role": "user", "content": "\ud83d\ude00"}]])
    assert j.get(key) is None
    j.put(key, ["x", None, ""])
    assert Journal(f"{tmp_dir}/j").get(key) == ["x", None, ""]
    assert key != Journal.key({"a": 2, "b": None}, [[{"role": "user", "content": "\ud83d\ude00"}]])


def test_wrong_counts_stay_out_of_the_journal(spark, tmp_dir):
    rows = prompts_of(spark, 4, 1).selectExpr("array(named_struct('role', 'user', 'content', instruction)) AS messages")
    with pytest.raises(Exception, match="responses for"):
        generate(rows, lambda options: (lambda prompts: ["one"]), {"batch_size": 4}, journal=f"{tmp_dir}/journal").collect()
    assert glob.glob(f"{tmp_dir}/journal/*/*") == []


def test_models_are_resident_one_after_another(spark, tmp_dir):
    items = spark.range(24, numPartitions=4).selectExpr("id AS item_seq", "cast(id AS string) AS id", "concat('item ', id) AS instruction", "'r' AS reference")
    notes = f"{tmp_dir}/notes"
    os.mkdir(notes)
    run_evaluate(spark, items, ["a::x::-", "b::y::-", "c::z::-"], f"{tmp_dir}/eval", Counted(notes), {"batch_size": 2})
    events = []
    for kind in ("load", "batch"):
        for f in glob.glob(f"{notes}/{kind}-*"):
            events.append((int(f.rsplit("-", 1)[1]), kind, open(f, encoding="utf-8").read()))
    loads = [(t, m) for t, kind, m in sorted(events) if kind == "load"]
    assert len(loads) == 12  # one a task and model
    assert [m for _, m in loads] == ["a"] * 4 + ["b"] * 4 + ["c"] * 4
    for now, then in (("a", "b"), ("b", "c")):
        first = min(t for t, m in loads if m == then)
        assert sum(t < first for t, kind, _ in events if kind == "batch") == 12 * ("abc".index(now) + 1)
