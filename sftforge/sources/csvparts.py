"""CSV files with line breaks inside quotes, read in many tasks, one byte range each.

Spark's text reader hands out physical lines by byte range.  Whether a line
begins inside a quoted field depends on all before it, but a line's effect is
known from the line alone for either beginning: does it end inside quotes.  One
pass composes these effects over each range, the ranges' effects composed in
order give each range its beginning, and a second pass cuts the records out.  A
record over a range's edge comes as pieces, joined at the end.

A field is quoted if its first sign is a quote; a doubled quote inside it is one
of its signs; what follows the closing quote up to the separator belongs to it.
Quotes inside unquoted fields are signs like others.  A quote that nothing closes
takes the rest of its file into one record, as it does for a reader of whole files
(which also keeps the file's last line break then).  As there, line breaks inside
fields are as the file's own: those of a record that ends in CR LF become LF.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftforge.session import materialize, same_splits, ship_package

_BOM = b"\xef\xbb\xbf"


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a physical line that begins inside a quoted field, or not, ends inside one."""
    at = 0
    if not inside:
        line = line.removeprefix(_BOM)
        at = 1 if line.startswith(b'"') else line.find(b',"') + 2
        if at == 1 and not line.startswith(b'"'):
            return False
    while True:
        at = line.find(b'"', at)
        if at < 0:
            return True
        if line[at + 1:at + 2] == b'"':
            at += 2
            continue
        at = line.find(b',"', at + 1) + 2
        if at == 1:
            return False


def _by_range(batches: Iterator[pa.RecordBatch]):
    """(file, block, lines, batch, place in it) of each run of lines of one byte range; a range may come in several runs."""
    for batch in batches:
        places = list(zip(batch.column("file").to_pylist(), batch.column("block").to_pylist()))
        lines = batch.column("value").to_pylist()
        start = 0
        while start < len(places):
            end = start + 1
            while end < len(places) and places[end] == places[start]:
                end += 1
            yield *places[start], lines[start:end], batch, start
            start = end


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ends: dict = {}
    for file, block, lines, _, _ in _by_range(batches):
        state = ends.setdefault((file, block), [False, True])
        for line in lines:
            if b'"' in line:  # a line without quotes ends as it begins
                state[:] = [ends_inside(line, s) for s in state]
    keys = list(ends)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()),
         pa.array([ends[k][0] for k in keys], pa.bool_()), pa.array([ends[k][1] for k in keys], pa.bool_())],
        names=["file", "block", "outside", "inside"])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (file, block, row, value, piece): piece 0 whole, 1 begun, 2 gone on, 3 ended in this range."""
    now, inside, held, row, mine = None, False, [], 0, True
    out: list[tuple] = []

    def batch_of(rows):
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                          names=["file", "block", "row", "value", "piece"])

    for file, block, lines, batch, at in _by_range(batches):
        if now != (file, block):
            if held:
                out.append((*now, row, b"\n".join(held), 1 if mine else 2))
            now, held, row = (file, block), [], 0
            inside = batch.column("in_quotes")[at].as_py()
            mine = not inside
        for line in lines:
            if not held and not inside and line in (b"", b"\r"):
                continue
            held.append(line)
            if b'"' in line:
                inside = ends_inside(line, inside)
            if not inside:
                out.append((*now, row, b"\n".join(held), 0 if mine else 3))
                row, held, mine = row + 1, [], True
        if len(out) >= 1000:
            yield batch_of(out)
            out = []
    if held:
        out.append((*now, row, b"\n".join(held), 1 if mine else 2))
    if out:
        yield batch_of(out)


def records(spark: SparkSession, files) -> DataFrame:
    """(file, block, row, value): every record's bytes, headers too, blank lines left out; the first three sort them.

    A file's header is its record of block 0 and row 0.
    """
    ship_package(spark)
    lines = spark.read.option("lineSep", "\n").text(files).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))
    with same_splits(spark):
        ranges = materialize(lines.mapInArrow(_effects, "file string, block long, outside boolean, inside boolean"), "csv-ranges")
        # A range whose two ends agree sets the state; one that swaps them flips it; any other keeps it.
        before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        upto = Window.partitionBy("file").orderBy("block")
        steps = (ranges.withColumn("sets", F.when(F.col("outside") == F.col("inside"), F.col("outside")))
                 .withColumn("flips", F.sum(F.when(F.col("outside") & ~F.col("inside"), 1).otherwise(0)).over(upto)))
        at_set = F.last(F.when(F.col("sets").isNotNull(), F.struct("sets", "flips")), ignorenulls=True).over(before)
        starts = (steps.withColumn("set", at_set).withColumn("so_far", F.coalesce(F.lag("flips").over(upto), F.lit(0)))
                  .select("file", "block", ((F.coalesce(F.col("set.sets"), F.lit(False)).cast("int")
                                             + F.col("so_far") - F.coalesce(F.col("set.flips"), F.lit(0))) % 2 == 1).alias("in_quotes")))
        # One row a byte range; the broadcast keeps the lines in order.
        found = materialize(lines.join(F.broadcast(starts), ["file", "block"])
                            .mapInArrow(_records, "file string, block long, row long, value binary, piece int"), "csv-records")
    order = Window.partitionBy("file").orderBy("block", "row")
    parts = found.where("piece > 0").withColumn("begun", F.last(F.when(F.col("piece") == 1, F.struct("block", "row")), ignorenulls=True).over(order))
    # Pieces in order, a line break between two; in hexadecimal, as they need not be whole UTF-8 texts.
    joined = (parts.groupBy("file", "begun").agg(F.array_sort(F.collect_list(F.struct("block", "row", F.hex("value").alias("hex")))).alias("p"))
              .select("file", "begun.block", "begun.row", F.unhex(F.array_join(F.col("p.hex"), "0A")).alias("value")))
    return found.where("piece = 0").select("file", "block", "row", "value").unionByName(joined)


def read_csv_parts(spark: SparkSession, files, schema: T.StructType, options: dict) -> DataFrame:
    """The records as rows of ``schema`` (strings, by place), with (file, block, row) as ``_at``; headers left out."""
    rows = records(spark, files).where(~((F.col("block") == 0) & (F.col("row") == 0)))
    ddl = ", ".join(f"`_c{i}` string" for i in range(len(schema)))
    text = F.col("value").cast("string")
    text = F.when(text.endswith("\r"), F.replace(F.expr("left(string(value), length(string(value)) - 1)"), F.lit("\r\n"), F.lit("\n"))).otherwise(text)
    parsed = F.from_csv(text, ddl, options)
    return rows.select(parsed.alias("_row"), F.struct("file", "block", "row").alias("_at")).select(
        *[F.col(f"_row._c{i}").alias(f.name) for i, f in enumerate(schema)], "_at")
