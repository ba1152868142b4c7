"""Readers for raw Q/A rows, prompt tables and benchmarks.

Every raw reader attaches ``_ord``, a struct that sorts rows in input order:
``(split_ord, file path, block start, row id)``.  It is taken from the file
scan's hidden ``_metadata`` column, which exists only directly on the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from sftforge.functions.text import quote
from sftforge.session import materialize
from sftforge.sources.csvparts import read_csv_parts
from sftforge.sources.jsonlist import read_list_parts

# The words pandas' CSV reader turns into missing values by default.
CSV_NA_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

CORRUPT = "_corrupt_record"

BENCHMARK_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("instruction", T.StringType()),
    T.StructField("input", T.StringType()),
    T.StructField("reference", T.StringType()),
    T.StructField("keywords", T.ArrayType(T.StringType())),
    T.StructField("system", T.StringType()),
])
PROMPT_SCHEMA = T.StructType([
    T.StructField("instruction", T.StringType()),
    T.StructField("input", T.StringType()),
    T.StructField("system", T.StringType()),
])


def _with_order(df: DataFrame, split_ord: int) -> DataFrame:
    return df.withColumn("_ord", F.struct(
        F.lit(split_ord).alias("split"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row")))


HEAD_BYTES = 1 << 16
LARGE_LIST = 64 << 20
LARGE_CSV = 64 << 20


def _largest(spark: SparkSession, paths) -> int:
    """Bytes of the largest file that ``paths`` name."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = 0
    for file in spark.read.text(paths).inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        out = max(out, path.getFileSystem(conf).getFileStatus(path).getLen())
    return out


def _head(spark: SparkSession, file: str, need_line: bool) -> str:
    """The start of a file, decompressed by its codec: up to its first line's end, or a first sign."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    raw = path.getFileSystem(conf).open(path)
    stream = codec.createInputStream(raw) if codec is not None else raw
    try:
        data = b""
        while True:
            more = bytes(stream.readNBytes(HEAD_BYTES))
            data += more
            said = data.decode("utf-8", "replace").lstrip("\ufeff \t\r\n")
            if not more or (said and not (need_line and "\n" not in said)):
                return said.split("\n", 1)[0]
    finally:
        stream.close()


def first_lines(spark: SparkSession, paths, whole: bool = True) -> dict[str, str]:
    """The start of the first line that isn't blank of every file of ``paths``; files without one are left out.

    A few kilobytes of each file are read, by a few threads of the driver: with
    ``whole`` up to the line's end (a header), else whatever the first block holds.
    """
    from concurrent.futures import ThreadPoolExecutor

    jvm = spark.sparkContext._jvm
    files = sorted(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).toString() for f in set(spark.read.text(paths).inputFiles()))
    with ThreadPoolExecutor(16) as pool:
        heads = pool.map(lambda f: _head(spark, f, whole), files)
        return {f: h for f, h in zip(files, heads) if h}


def _by_first_line(spark: SparkSession, paths, kind, read, whole: bool = True) -> DataFrame:
    """Read files alike in ``kind(first line)`` together, and union the groups by column name."""
    groups: dict = {}
    for file, line in sorted(first_lines(spark, paths, whole).items()):
        groups.setdefault(kind(line), []).append(file)
    if not groups:
        return read(paths, None)
    if len(groups) == 1:  # as given: a folder's files needn't be named one by one
        return read(paths, next(iter(groups)))
    return union_splits([read(files, k) for k, files in groups.items()])


def with_positions(df: DataFrame, name: str) -> DataFrame:
    """Adds each row's place, 0 to n - 1, by (file, block, row): a running sum of the splits' counts, and the place in the split.

    ``df`` must come right from a file scan.  The counts are one row a split.
    """
    scan = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_id"))
    ordered = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (scan.groupBy(F.col("_file").alias("file"), F.col("_block").alias("block"))
              .agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("first"))
              .select("file", "block", "first", F.coalesce(F.sum("n").over(ordered), F.lit(0)).alias("before")))
    return (scan.join(splits, (F.col("_file") == F.col("file")) & (F.col("_block") == F.col("block")))
            .withColumn(name, F.col("before") + F.col("_id") - F.col("first"))
            .select(*df.columns, name))


def read_csv_rows(spark: SparkSession, paths, split_ord: int = 0,
                  na_values=CSV_NA_WORDS, multi_line: bool = False, large: int = LARGE_CSV) -> DataFrame:
    """CSV with a header; doubled quotes; every column a string.

    Columns go by name: files whose headers differ are read apart and unioned.
    ``na_values`` (default: pandas' NA words) become null, so a candidate such
    as ``output = "N/A"`` falls through to the next one.  ``multi_line`` is
    needed for newlines inside quoted fields; files of ``large`` bytes or more are
    then read in many tasks, by byte range (:mod:`csvparts`), smaller ones a task each.
    """
    def read(files, _) -> DataFrame:
        options = {"multiLine": str(multi_line).lower(), "escape": '"', "quote": '"', "mode": "PERMISSIVE"}
        df = spark.read.options(header=True, inferSchema=False, **options).csv(files)
        if multi_line and _largest(spark, files) >= large:
            rows = read_csv_parts(spark, files, df.schema, options)
            return rows.withColumn("_ord", F.struct(F.lit(split_ord).alias("split"), "_at.file", "_at.block", "_at.row")).drop("_at")
        return _with_order(df, split_ord)

    df = _by_first_line(spark, paths, lambda line: line.strip().lstrip("\ufeff"), read)
    if na_values:
        words = list(na_values)
        df = df.select(*[
            F.when(F.col(quote(c)).isin(*words), F.lit(None).cast("string"))
            .otherwise(F.col(quote(c))).alias(c) if c != "_ord" else F.col("_ord")
            for c in df.columns])
    return df


def read_json_rows(spark: SparkSession, paths, split_ord: int = 0,
                   schema: T.StructType | None = None,
                   json_lines: bool | None = None, large: int = LARGE_LIST) -> DataFrame:
    """JSON array files, JSONL files or a mixture of raw rows.

    ``multiLine`` is required for an array file and wrong for JSONL (it would
    read one row), so unless ``json_lines`` is given each file's format is taken
    from its first sign and the files of each format are read together.
    Array files of ``large`` bytes or more are read in many tasks, by byte range
    (:mod:`jsonlist`), smaller ones a task each.
    Malformed records are kept with their text in ``_corrupt_record`` (all
    other fields null, so prepare rejects them as missing) rather than lost.
    """
    if schema is not None and CORRUPT not in schema.fieldNames():
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])

    def read(files, array) -> DataFrame:
        if array and _largest(spark, files) >= large:
            rows = read_list_parts(spark, files, schema, CORRUPT)
            return rows.withColumn("_ord", F.struct(F.lit(split_ord).alias("split"), "_at.file", "_at.block", "_at.row")).drop("_at")
        reader = (spark.read.option("multiLine", bool(array)).option("mode", "PERMISSIVE")
                  .option("columnNameOfCorruptRecord", CORRUPT))
        return _with_order((reader.schema(schema) if schema else reader).json(files), split_ord)

    if json_lines is not None:
        return read(paths, not json_lines)
    return _by_first_line(spark, paths, lambda line: line.startswith("["), read, whole=False)


def read_table_rows(spark: SparkSession, name_or_path: str, fmt: str | None = None,
                    split_ord: int = 0, order_by=None) -> DataFrame:
    """A named table, or a path in any Spark format (S3).

    Rows are in the order of the columns ``order_by`` (unique together), which a
    table without files of its own must be given; else in file order.
    """
    df = spark.table(name_or_path) if fmt is None else spark.read.format(fmt).load(name_or_path)
    if order_by:
        keys = [order_by] if isinstance(order_by, str) else list(order_by)
        return df.withColumn("_ord", F.struct(F.lit(split_ord).alias("split"), F.struct(*keys).alias("key")))
    try:
        return _with_order(df, split_ord)
    except AnalysisException as no_files:
        raise ValueError(f"rows of {name_or_path!r} have no input order; name their order in order_by") from no_files


def union_splits(splits) -> DataFrame:
    """Union all splits by column name; columns missing in a split become null.

    Each split should already carry its ``_ord`` (whose first field is the
    split's position), so input order runs split by split.
    """
    splits = list(splits)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), splits)


def read_prompts(spark: SparkSession, paths, json_lines: bool | None = None) -> DataFrame:
    """Prompt records; ``input`` and ``system`` may be absent."""
    return read_json_rows(spark, paths, schema=PROMPT_SCHEMA, json_lines=json_lines)


def read_benchmark(spark: SparkSession, path: str, large: int = LARGE_LIST) -> DataFrame:
    """A benchmark file, or a folder of them, each one JSON list of items.

    Ids are kept as strings.  ``item_seq`` is the item's place, 0 to n - 1, files in
    order of their names.
    """
    if not all(line.startswith("[") for line in first_lines(spark, path, whole=False).values()):
        raise ValueError("benchmark file must contain a JSON list")
    if _largest(spark, path) >= large:
        rows = materialize(read_list_parts(spark, [path], BENCHMARK_SCHEMA, CORRUPT, "FAILFAST"), "benchmark")
        # The counts a block, then the place in the block.
        blocks = (rows.groupBy("_at.file", "_at.block").agg(F.count(F.lit(1)).alias("n"))
                  .select(F.struct("file", "block").alias("_of"), F.coalesce(F.sum("n").over(
                      Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")))
        # Rows of a block are numbered from 0, or from 1 if it begins inside an object.
        first = rows.groupBy(F.struct("_at.file", "_at.block").alias("_in")).agg(F.min("_at.row").alias("first"))
        at = rows.withColumn("_of", F.struct("_at.file", "_at.block")).join(blocks, "_of").join(first.withColumnRenamed("_in", "_of"), "_of")
        return at.withColumn("item_seq", F.col("before") + F.col("_at.row") - F.col("first")).drop("_at", "_of", "before", "first")
    df = (spark.read.schema(BENCHMARK_SCHEMA).option("multiLine", True)
          .option("mode", "FAILFAST").json(path))
    return with_positions(df, "item_seq")


def read_raw_dataset(spark: SparkSession, dataset: str = "csv", data_file=None, order_by=None) -> DataFrame:
    """Raw rows by dataset kind: ``"csv"`` / ``"json"`` read ``data_file`` (one path
    or a list, each file one split in order); any other value is a table name, whose
    rows are in the order of ``order_by``."""
    if dataset in ("csv", "json"):
        files = [data_file] if isinstance(data_file, str) else list(data_file or [])
        if not files:
            raise ValueError(f"dataset={dataset!r} needs data_file")
        read = read_csv_rows if dataset == "csv" else read_json_rows
        owner = files_of(spark, files)
        if len(files) == 1 or owner is None:
            return union_splits([read(spark, f, split_ord=i) for i, f in enumerate(files)])
        # One scan for all files of a kind; a file's place in the list is joined by its name.
        places = spark.createDataFrame(list(owner.items()), "file string, split int")
        rows = read(spark, files)
        named = rows.withColumn("_file", F.regexp_replace("_ord.file", "^file:/+", "file:/"))
        ord_ = F.struct("split", F.col("_ord.file").alias("file"), F.col("_ord.block").alias("block"), F.col("_ord.row").alias("row"))
        return named.join(places.withColumnRenamed("file", "_file"), "_file").withColumn("_ord", ord_).select(*rows.columns)
    return read_table_rows(spark, dataset, order_by=order_by)


def files_of(spark: SparkSession, paths: list[str]) -> dict[str, int] | None:
    """Each file below ``paths`` (files, folders, patterns) and the place of the path that names it; None if two do."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out: dict[str, int] = {}
    for i, p in enumerate(paths):
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        for status in fs.globStatus(path) or []:
            if status.isDirectory():
                below = fs.listFiles(status.getPath(), True)
                found = []
                while below.hasNext():
                    found.append(below.next().getPath())
            else:
                found = [status.getPath()]
            for f in found:
                name = f.toUri().toString()
                name = "file:/" + name[len("file:"):].lstrip("/") if name.startswith("file:") else name
                if out.setdefault(name, i) != i:
                    return None
    return out
