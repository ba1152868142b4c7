"""S1-S7, K1-K5 round trips and the format traps."""

import json

import pytest

from sftforge.plans.prepare import PrepareConfig, prepare
from sftforge.sources.readers import (
    read_benchmark, read_csv_rows, read_json_rows, union_splits)
from sftforge.sources.registry import load_registered
from sftforge.sources.sinks import write_table


def test_csv_quotes_newlines_and_na_words(spark, tmp_dir):
    path = f"{tmp_dir}/raw.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write('question,output,answer\n')
        f.write('"He said ""hi""\nand left",N/A,"an answer that is long enough"\n')
        f.write('plain question here,"multi\nline output, long enough",\n')
        f.write('"",,\n')
    df = read_csv_rows(spark, path, multi_line=True)
    rows = df.orderBy("_ord").collect()
    assert len(rows) == 3
    assert rows[0]["question"] == 'He said "hi"\nand left' and rows[0]["output"] is None
    prep = prepare(df, PrepareConfig())
    got = {r["instruction"]: r["output"] for r in prep.training.collect()}
    assert got == {'He said "hi" and left': "an answer that is long enough",
                   "plain question here": "multi line output, long enough"}


def test_json_array_and_jsonl(spark, tmp_dir):
    items = [{"instruction": f"q{i}", "output": "o"} for i in range(5)]
    with open(f"{tmp_dir}/a.json", "w") as f:
        json.dump(items, f, indent=2)
    with open(f"{tmp_dir}/b.jsonl", "w") as f:
        f.write("\n".join(json.dumps(x) for x in items))
    assert read_json_rows(spark, f"{tmp_dir}/a.json").count() == 5
    assert read_json_rows(spark, f"{tmp_dir}/b.jsonl").count() == 5


def test_malformed_jsonl_line_is_kept_and_rejected(spark, tmp_dir):
    from sftforge.plans.prepare import to_records
    from sftforge.sources.readers import PROMPT_SCHEMA
    with open(f"{tmp_dir}/bad.jsonl", "w") as f:
        f.write('{"instruction": "fine question", "output": "a fine answer, long enough"}\n')
        f.write('{"instruction": "broken\n')
    df = read_json_rows(spark, f"{tmp_dir}/bad.jsonl")
    # Spark refuses queries that reference only the corrupt-record column.
    bad = df.where("_corrupt_record IS NOT NULL").select("instruction", "_corrupt_record")
    assert len(bad.collect()) == 1
    reasons = sorted(str(r[0]) for r in to_records(df).select("reject_reason").collect())
    assert reasons == ["None", "missing"]
    typed = read_json_rows(spark, f"{tmp_dir}/bad.jsonl", schema=PROMPT_SCHEMA)
    bad = typed.where("_corrupt_record IS NOT NULL").select("instruction", "_corrupt_record")
    assert len(bad.collect()) == 1


def test_benchmark_must_be_a_list_and_ids_are_strings(spark, tmp_dir):
    with open(f"{tmp_dir}/bench.json", "w") as f:
        json.dump([{"id": 10, "instruction": "a", "keywords": ["k"]},
                   {"id": "2", "instruction": "b"}], f)
    df = read_benchmark(spark, f"{tmp_dir}/bench.json")
    assert [r["id"] for r in df.orderBy("item_seq").collect()] == ["10", "2"]
    with open(f"{tmp_dir}/obj.json", "w") as f:
        f.write('{"id": 1}\n')
    with pytest.raises(ValueError):
        read_benchmark(spark, f"{tmp_dir}/obj.json")


def test_union_splits_and_registry(spark, tmp_dir):
    a = spark.createDataFrame([(1, "x")], "_ord int, question string")
    b = spark.createDataFrame([(2, "y")], "_ord int, prompt string")
    u = union_splits([a, b])
    assert sorted(u.columns) == ["_ord", "prompt", "question"] and u.count() == 2
    df = spark.createDataFrame([("q", None)], "instruction string, system string")
    n = write_table(df, f"{tmp_dir}/reg/data.jsonl", "json")
    assert n == 1
    with open(f"{tmp_dir}/reg/dataset_info.json", "w") as f:
        json.dump({"mine": {"file_name": "data.jsonl"}}, f)
    loaded = load_registered(spark, f"{tmp_dir}/reg/dataset_info.json")
    assert spark.table("mine").count() == 1 and "mine" in loaded
    raw = spark.read.text(f"{tmp_dir}/reg/data.jsonl").first()[0]
    assert '"system":null' in raw  # null fields are kept


def test_write_refuses_existing_target_by_default(spark, tmp_dir):
    df = spark.createDataFrame([(1,)], "a int")
    write_table(df, f"{tmp_dir}/t", "parquet")
    with pytest.raises(Exception):
        write_table(df, f"{tmp_dir}/t", "parquet")
    assert write_table(df, f"{tmp_dir}/t", "parquet", "overwrite") == 1


def test_read_raw_dataset_dispatch_and_split_order(spark, tmp_dir):
    from sftforge.sources.readers import read_raw_dataset
    for i in range(2):
        with open(f"{tmp_dir}/p{i}.csv", "w") as f:
            f.write("question,answer\n" + "".join(f"q{i}{j},a{i}{j}\n" for j in range(3)))
    df = read_raw_dataset(spark, "csv", [f"{tmp_dir}/p1.csv", f"{tmp_dir}/p0.csv"])
    assert [r["question"] for r in df.orderBy("_ord").collect()] == \
        ["q10", "q11", "q12", "q00", "q01", "q02"]
    spark.createDataFrame([("x", "y")], "question string, answer string") \
        .createOrReplaceTempView("raw_named")
    assert read_raw_dataset(spark, "raw_named", order_by="question").count() == 1
    with pytest.raises(ValueError):
        read_raw_dataset(spark, "json")


def test_csv_files_go_by_column_name(spark, tmp_dir):
    for name, header, row in (("x1", "question,answer", "q1,a1"), ("x2", "answer,question", "a2,q2")):
        with open(f"{tmp_dir}/{name}.csv", "w") as f:
            f.write(f"{header}\n{row}\n")
    for paths in ([f"{tmp_dir}/x1.csv", f"{tmp_dir}/x2.csv"], f"{tmp_dir}/*.csv"):
        rows = read_csv_rows(spark, paths).select("question", "answer").collect()
        assert sorted(tuple(r) for r in rows) == [("q1", "a1"), ("q2", "a2")]


def test_json_format_is_found_for_each_file(spark, tmp_dir):
    import os
    os.mkdir(f"{tmp_dir}/mixed")
    with open(f"{tmp_dir}/mixed/a.json", "w") as f:
        json.dump([{"instruction": f"q{i}"} for i in range(300)], f, indent=1)
    with open(f"{tmp_dir}/mixed/b.jsonl", "w") as f:
        f.write("\n".join(json.dumps({"instruction": f"r{i}"}) for i in range(5)))
    for paths in (f"{tmp_dir}/mixed", [f"{tmp_dir}/mixed/b.jsonl", f"{tmp_dir}/mixed/a.json"]):
        assert read_json_rows(spark, paths).select("instruction").distinct().count() == 305


def test_tables_need_an_order(spark):
    from sftforge.sources.readers import read_table_rows
    spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string").createOrReplaceTempView("no_files")
    with pytest.raises(ValueError):
        read_table_rows(spark, "no_files")
    got = read_table_rows(spark, "no_files", order_by="k").orderBy("_ord").collect()
    assert [r["v"] for r in got] == ["a", "b"]


def test_chat_rows_keep_every_turn(spark):
    from sftforge.sources.testdata import chat_rows
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "b"), (1, 1, "assistant", "c"), (1, 1, "assistant", "d")],
                                  "conv_id long, turn long, role string, text string")
    assert [len(r["messages"]) for r in chat_rows(turns).collect()] == [4]
