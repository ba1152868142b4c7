"""JSON lists read in many tasks, one byte range each.

The file is cut at every closing brace, which Spark's text reader does by byte
range, so a range's task sees whole fragments of its own.  Whether a fragment
lies inside a string, and how deep, depends on all before it; but a range's
effect is known from the range alone for either answer: does it hold an odd
number of quotes, and by how much does the depth change if it begins outside, or
inside, a string.  One pass gathers these three numbers a range, running sums
over the ranges give each one's start, and a second pass cuts the objects out.
An object over a range's edge comes as pieces, joined at the end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sftforge.session import materialize, same_splits, scratch_path, ship_package

_ESCAPE = re.compile(rb"\\.", re.S)
_OPEN, _CLOSE = re.compile(rb"[{\[]"), re.compile(rb"[}\]]")
_BETWEEN = b" \t\r\n,[]\xef\xbb\xbf"


def effect(fragment: bytes, inside: bool) -> tuple[bool, int]:
    """(inside a string at the end, change of depth) of a fragment that holds no closing brace outside strings."""
    bare = _ESCAPE.sub(b"", fragment) if b"\\" in fragment else fragment
    parts = bare.split(b'"')
    depth = 0
    for p in parts[int(inside)::2]:
        if b"{" in p or b"[" in p or b"]" in p:
            depth += len(_OPEN.findall(p)) - len(_CLOSE.findall(p))
    return inside ^ (len(parts) % 2 == 0), depth


def _ranges(batches: Iterator[pa.RecordBatch]):
    """(file, block, fragments) of each byte range, batch by batch; fragments of one range may come in several."""
    for batch in batches:
        files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        values = batch.column("value").to_pylist()
        start = 0
        for i in range(1, len(files) + 1):
            if i == len(files) or (files[i], blocks[i]) != (files[start], blocks[start]):
                yield files[start], blocks[start], values[start:i], batch, start
                start = i


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict = {}
    for file, block, values, _, _ in _ranges(batches):
        state = total.setdefault((file, block), [False, 0, True, 0])
        for v in values:
            for at in (0, 2):
                state[at], depth = effect(v, state[at])
                state[at + 1] += depth - (not state[at])
    rows = list(total.items())
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.int64()), pa.array([s[0] for _, s in rows], pa.bool_()),
         pa.array([s[1] for _, s in rows], pa.int64()), pa.array([s[3] for _, s in rows], pa.int64())],
        names=["file", "block", "odd", "outside", "inside"])


def _objects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (file, block, row, value, piece): piece 0 whole, 1 begun, 2 gone on, 3 ended in this range."""
    now, inside, depth, held, row, mine = None, False, 0, [], 0, True
    out: list[tuple] = []

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
            (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int32()))], names=["file", "block", "row", "value", "piece"])

    def left_open():
        if held:
            out.append((*now, row, b"".join(held), 1 if mine else 2))

    for file, block, values, batch, at in _ranges(batches):
        if now != (file, block):
            left_open()
            now, held, row = (file, block), [], 0
            inside, depth = batch.column("in_string")[at].as_py(), batch.column("depth")[at].as_py()
            mine = depth < 2
        for v in values:
            if depth < 2 and not inside:
                begin = v.find(b"{")
                between = (v if begin < 0 else v[:begin]).strip(_BETWEEN)
                if between:  # an element that is no object: kept, as a record that can't be read
                    out.append((file, block, row, between, 0))
                    row += 1
                if begin < 0:
                    inside, change = effect(v, inside)
                    depth += change - (not inside)
                    continue
                change = effect(v[:begin], False)[1]
                depth += change
                v = v[begin:]
                mine = True
            inside, change = effect(v, inside)
            depth += change - (not inside)
            held.append(v + b"}")
            if depth < 2 and not inside:
                out.append((file, block, row, b"".join(held), 0 if mine else 3))
                row, held, mine = row + 1, [], True
        if len(out) >= 1000:
            yield batch_of(out)
            out = []
    left_open()
    if out:
        yield batch_of(out)


def objects(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file, block, row, value): the text of every element of lists of objects; the first three sort them."""
    ship_package(spark)
    fragments = spark.read.option("lineSep", "}").text(files).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))
    with same_splits(spark):
        ranges = materialize(fragments.mapInArrow(_effects, "file string, block long, odd boolean, outside long, inside long"), "list-ranges")
        before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        in_string = (F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0)) % 2 == 1).alias("in_string")
        starts = (ranges.select("*", in_string).withColumn("change", F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside")))
                  .select("file", "block", "in_string", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth")))
        # One row a byte range; the broadcast keeps the fragments in order.
        found = materialize(fragments.join(F.broadcast(starts), ["file", "block"])
                            .mapInArrow(_objects, "file string, block long, row long, value binary, piece int"), "list-objects")
    order = Window.partitionBy("file").orderBy("block", "row")
    parts = found.where("piece > 0").withColumn("begun", F.last(F.when(F.col("piece") == 1, F.struct("block", "row")), ignorenulls=True).over(order))
    joined = (parts.groupBy("file", "begun").agg(F.array_sort(F.collect_list(F.struct("block", "row", F.hex("value").alias("hex")))).alias("p"))
              .select("file", "begun.block", "begun.row", F.unhex(F.array_join(F.col("p.hex"), "")).alias("value")))
    return found.where("piece = 0").select("file", "block", "row", "value").unionByName(joined)


def read_list_parts(spark: SparkSession, files: list[str], schema, corrupt: str, mode: str = "PERMISSIVE") -> DataFrame:
    """The lists' objects as rows, with (file, block, row) as ``_at``; without a schema it is inferred from all of them."""
    lines = objects(spark, files).select(F.struct("file", "block", "row").alias("_at"),
                                         F.translate(F.col("value").cast("string"), "\r\n", "  ").alias("value"))
    if schema is None:
        lines = materialize(lines, "list-lines")
        path = scratch_path(spark, "list-text")
        lines.select("value").write.text(path)
        schema = spark.read.option("columnNameOfCorruptRecord", corrupt).json(path).schema
    parsed = F.from_json("value", schema, {"mode": mode, "columnNameOfCorruptRecord": corrupt})
    return lines.select(parsed.alias("_row"), "_at").select("_row.*", "_at")
