"""Writers for training, prompt, distilled and result tables (K1-K5).

Jobs that write several tables can be published whole: :func:`publish` has them
write a folder of their own and then names it as the current one in one step.

Output is JSONL (UTF-8, non-ASCII kept as is) or parquet, written by all tasks
in parallel.  Row counts come from an ``Observation`` on the write itself (K5),
so no second job re-reads the output.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sftforge.session import remove_path


def write_table(df: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists",
                order_by=None, partition_by=None, name: str = "rows", drop=()) -> int:
    """Write ``df`` and return the number of rows written.

    ``mode`` defaults to failing on an existing target; pass ``"overwrite"`` to
    replace it.  ``order_by`` sorts the output (a distributed range sort).  Null
    fields are written as JSON nulls rather than dropped.
    """
    out = df
    if order_by:
        out = out.orderBy(*([order_by] if isinstance(order_by, str) else order_by))
    if drop:
        out = out.drop(*drop)  # after the sort: the written order is kept
    # Observed above the sort: the range partitioner's sampling job runs the
    # plan below the sort and would otherwise be counted too.
    obs = Observation(name)
    out = out.observe(obs, F.count(F.lit(1)).alias("n"))
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str)
                                      else partition_by))
    if fmt == "json":
        writer.option("ignoreNullFields", False).json(path)
    elif fmt == "csv":
        # Missing report cells render as '' (R4).
        writer.option("header", True).option("escape", '"').option("nullValue", "").csv(path)
    else:
        writer.format(fmt).save(path)
    return int(obs.get["n"])


def write_model_results(scores: DataFrame, summary: DataFrame, path: str,
                        mode: str = "errorifexists") -> dict[str, int]:
    """Per model: its summary row and its score rows, partitioned by model (K4)."""
    n_rows = write_table(scores, f"{path}/results", "json", mode,
                         partition_by="model_name", name="results")
    n_sum = write_table(summary, f"{path}/summary", "json", mode,
                        partition_by="model_name", name="summary")
    return {"results": n_rows, "summary": n_sum}


def _commits(spark: SparkSession, out_dir: str) -> list[tuple[int, str]]:
    """(number, version) of the commits of ``out_dir``, oldest first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/commits")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted((int(n.split("-", 1)[0]), n.split("-", 1)[1]) for n in names)


def publish(spark: SparkSession, out_dir: str, write: Callable[[str], dict[str, int]], keep: int | None = None) -> str:
    """Have ``write`` write tables into a new version folder, then make it the current one; returns the folder.

    ``write`` gets the folder and returns the rows written by table.  The commit
    is the creation of one empty file whose name holds a number and the version,
    which every file system and object store does whole or not at all: readers
    (:func:`published`) see the tables of one version, and a job that fails leaves
    the version before as it was.  Of writers at a time the higher number, or at
    equal numbers the greater version name, is the current one.  ``keep`` removes
    all but the last so many committed versions; readers of older ones must be done.
    """
    version = uuid.uuid4().hex
    folder = f"{out_dir}/versions/{version}"
    counts = write(folder)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def put(path: str, text: str) -> None:
        target = jvm.org.apache.hadoop.fs.Path(path)
        stream = target.getFileSystem(conf).create(target, False)
        stream.write(bytearray(text.encode()))
        stream.close()

    put(f"{folder}/counts.json", json.dumps(counts, sort_keys=True))
    before = _commits(spark, out_dir)
    put(f"{out_dir}/commits/{before[-1][0] + 1 if before else 0:012d}-{version}", "")
    if keep is not None:
        for number, old in _commits(spark, out_dir)[:-max(1, keep)]:
            remove_path(spark, f"{out_dir}/commits/{number:012d}-{old}")  # first the name, then what it names
            remove_path(spark, f"{out_dir}/versions/{old}")
    return folder


def published(spark: SparkSession, out_dir: str) -> str:
    """The folder of the current version of ``out_dir``; without one an error."""
    commits = _commits(spark, out_dir)
    if not commits:
        raise FileNotFoundError(f"{out_dir} holds no published version")
    return f"{out_dir}/versions/{commits[-1][1]}"


def published_counts(spark: SparkSession, out_dir: str) -> dict[str, int]:
    """Rows by table of the current version."""
    return json.loads("".join(r["value"] for r in spark.read.text(f"{published(spark, out_dir)}/counts.json").collect()))
