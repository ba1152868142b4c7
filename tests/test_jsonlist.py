"""Large JSON lists read by byte range."""

import json
import random

import pytest

from sftforge.sources.jsonlist import effect
from sftforge.sources.readers import BENCHMARK_SCHEMA, read_benchmark, read_json_rows

NASTY = ["a}b", '{"x": "]"}', 'quote " and \\ back\\', "line\nbreak", "é日😀", "[{", "", "\\\"}", "}" * 5, "x" * 300]


def items(n, seed):
    rnd = random.Random(seed)
    return [{"instruction": f"i{i} " + rnd.choice(NASTY), "output": rnd.choice(NASTY) * rnd.randint(0, 3),
             "nested": {"a": [{"b": rnd.choice(NASTY)}, {}], "c": {"d": i}}} for i in range(n)]


def test_effect_of_fragments():
    assert effect(b'{"a": [1, {', False) == (False, 3)
    assert effect(b'{"a": "[[{', False) == (True, 1)
    assert effect(b'still " , [', True) == (False, 1)
    assert effect(b'\\" \\\\" [', True) == (False, 1)


@pytest.mark.parametrize("indent", [None, 2])
def test_rows_equal_those_of_one_task(spark, tmp_dir, indent):
    rows = items(3000, 7)
    path = f"{tmp_dir}/list.json"
    with open(path, "w", encoding="utf-8") as f:
        json.dump(rows, f, ensure_ascii=False, indent=indent)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # many ranges, so many objects over an edge
    try:
        parts = read_json_rows(spark, path, large=0)
        got = parts.orderBy("_ord").collect()
        assert len({r["_ord"]["block"] for r in got}) > 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = read_json_rows(spark, path, large=1 << 40)
    assert parts.drop("_ord").schema == whole.drop("_ord").schema
    assert [r["instruction"] for r in got] == [r["instruction"] for r in rows]
    key = lambda r: json.dumps(r.asDict(True), sort_keys=True)
    assert sorted(map(key, parts.drop("_ord").collect())) == sorted(map(key, whole.drop("_ord").collect()))


def test_an_object_over_several_ranges(spark, tmp_dir):
    rows = [{"instruction": "short"}, {"instruction": "long " + "}\"" * 30_000}, {"instruction": "end"}]
    with open(f"{tmp_dir}/list.json", "w", encoding="utf-8") as f:
        json.dump(rows, f)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        got = read_json_rows(spark, f"{tmp_dir}/list.json", large=0).orderBy("_ord").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r["instruction"] for r in got] == [r["instruction"] for r in rows]


def test_elements_that_are_no_objects_stay_as_corrupt_records(spark, tmp_dir):
    with open(f"{tmp_dir}/list.json", "w", encoding="utf-8") as f:
        f.write('[{"instruction": "a"}, 12, {"instruction": "b"} ,{"instruction": tru}]\n')
    got = read_json_rows(spark, f"{tmp_dir}/list.json", schema=BENCHMARK_SCHEMA, large=0).orderBy("_ord").collect()
    assert [r["instruction"] for r in got] == ["a", None, "b", None]
    assert [r["_corrupt_record"] is not None for r in got] == [False, True, False, True]
    with open(f"{tmp_dir}/empty.json", "w", encoding="utf-8") as f:
        f.write("[ ]")
    assert read_json_rows(spark, f"{tmp_dir}/empty.json", schema=BENCHMARK_SCHEMA, large=0).count() == 0


def test_benchmark_places(spark, tmp_dir):
    for k in range(2):
        with open(f"{tmp_dir}/{k}.json", "w", encoding="utf-8") as f:
            json.dump([{"id": 1000 * k + i, "instruction": "x}" * 20, "keywords": ["a}", "b"]} for i in range(500)], f)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        got = read_benchmark(spark, tmp_dir, large=0).orderBy("item_seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(r["item_seq"], r["id"]) for r in got] == list(enumerate([str(1000 * k + i) for k in range(2) for i in range(500)]))
    assert set(got[0].asDict()) == set(BENCHMARK_SCHEMA.fieldNames()) | {"item_seq"}
