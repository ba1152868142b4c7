"""Many input files, large one-line lists, and places of rows."""

import gzip
import json

from pyspark.sql import functions as F

from sftforge.sources.readers import first_lines, read_benchmark, read_json_rows, read_raw_dataset, with_positions


def test_heads_are_short_and_whole_headers(spark, tmp_dir):
    big = "[" + ",".join(json.dumps({"instruction": f"q{i}", "output": "x" * 50}) for i in range(20_000)) + "]"
    for name, text in {"list.json": " \n" + big, "rows.jsonl": '{"instruction": "a"}\n', "blank.json": " \n \n", "bom.json": "\ufeff[1]",
                       "wide.csv": "\n" + ",".join(f"column{i}" for i in range(20_000)) + "\n1\n"}.items():
        with open(f"{tmp_dir}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    with gzip.open(f"{tmp_dir}/packed.jsonl.gz", "wt") as f:
        f.write('{"instruction": "z"}\n')
    heads = {k.rsplit("/", 1)[1]: v for k, v in first_lines(spark, tmp_dir, whole=False).items()}
    assert heads["list.json"].startswith("[") and len(heads["list.json"]) < 1 << 17 and "blank.json" not in heads
    assert heads["bom.json"] == "[1]" and heads["packed.jsonl.gz"].startswith("{")
    whole = {k.rsplit("/", 1)[1]: v for k, v in first_lines(spark, tmp_dir).items()}
    assert whole["wide.csv"].endswith("column19999")
    rows = read_json_rows(spark, [f"{tmp_dir}/list.json", f"{tmp_dir}/rows.jsonl", f"{tmp_dir}/packed.jsonl.gz"])
    assert rows.count() == 20_002


def test_positions_are_dense_over_partitions_and_files(spark, tmp_dir):
    spark.range(1000, numPartitions=37).selectExpr("id", "concat('row ', id) AS t").write.json(f"{tmp_dir}/rows")
    rows = with_positions(spark.read.schema("id long, t string").json(f"{tmp_dir}/rows"), "place").orderBy("place").collect()
    assert [r["place"] for r in rows] == list(range(1000)) and [r["id"] for r in rows] == list(range(1000))


def test_benchmark_folder_in_order(spark, tmp_dir):
    for k in range(4):
        with open(f"{tmp_dir}/part-{k}.json", "w", encoding="utf-8") as f:
            json.dump([{"id": 10 * k + i, "instruction": f"i{k}-{i}"} for i in range(k + 1)], f)
    rows = read_benchmark(spark, tmp_dir).orderBy("item_seq").collect()
    assert [(r["item_seq"], r["id"]) for r in rows] == list(enumerate(["0", "10", "11", "20", "21", "22", "30", "31", "32", "33"]))


def test_a_list_of_files_is_one_scan(spark, tmp_dir):
    """A plan of constant size, rows in the order of the list, columns by name."""
    files = []
    for k in range(300):
        files.append(f"{tmp_dir}/in {299 - k}.csv")
        with open(files[-1], "w", encoding="utf-8") as f:
            f.write("question,answer\n" if k % 2 else "answer,question\n")
            f.write(f"q{k},a{k}\n" if k % 2 else f"a{k},q{k}\n")
    rows = read_raw_dataset(spark, "csv", files)
    assert rows._jdf.queryExecution().toString().count("FileScan csv") <= 6
    got = rows.orderBy("_ord").select("question", "answer", F.col("_ord.split").alias("split")).collect()
    assert [(r["question"], r["answer"], r["split"]) for r in got] == [(f"q{k}", f"a{k}", k) for k in range(300)]
    twice = read_raw_dataset(spark, "csv", [files[0], files[1], files[0]]).orderBy("_ord").collect()
    assert [r["question"] for r in twice] == ["q0", "q1", "q0"]
