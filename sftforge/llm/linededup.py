"""Operator 9, line dedup by a segment-partition edit join.

Lines (cut at line feeds) of at least ``SHORTEST`` code points are compared.
Lines within ``EDITS`` edits are linked; of each class (equal and linked lines,
links followed) the first line by document id, then line number, stays and the
others go.  Two lines within t edits share one of the t + 1 segments of the
shorter, at a place that the edits before and after it bound.  So each distinct
line is indexed under its t + 1 segments, and probes the indexes of its own and
the up to t smaller lengths with the few substrings that the bounds leave.
Matches whose letter parities differ in over 2t bits can't be within t edits (an
edit changes two letters' counts at most); the rest is verified by a banded
bit-parallel edit distance.

Signatures travel as packed arrays, one per task slice and bucket, with equal
lines sent once a slice, so a very common line costs a row or so a slice.  A
signature under which many lines meet many isn't written out as pairs: its lines
are dealt in blocks, and each group's task compares only lines that it hasn't
joined yet and hands on the links that join them.  A bucket beyond ``CROWDED``
signatures goes that way whole, so no task holds a hot segment.

Edge cases: null and empty texts have no line to compare and stay; shorter and
blank lines always stay; equal ids are told apart by their place in the stored
input, null ids come last; an empty table gives no rows; other columns are
ignored by ``line_report`` and kept by ``drop_lines``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftforge.llm.buckets import dealt, group_bounds, whole_groups
from sftforge.llm.common import PrefixHash, code_points, digests, documents, fresh, materialize, mix, prepare, sliced, spread
from sftforge.llm.graph import connected_components

EDITS, SHORTEST = 2, 20
BUCKET_BYTES = 8 << 20
LINE_SLICE = 1 << 20
COMMON = 10_000
CROWDED = 2_000_000
BLOCK = 256
#: Mean of the numbers of lines on both sides (harmonic, halved) beyond which a signature's pairs aren't written out.
DENSE = 12
FILTER_BITS = 1 << 27
_U = np.uint64


# ---------------------------------------------------------------- lines, segments, distance

class Lines:
    """The lines of a slice of texts: place, length, id and sketch.

    The id is XXH3 of the line's code points, 64 bits, and lines of equal ids count
    as equal: if it spreads lines like a random function, 1e8 distinct lines hold a
    clash with odds of about 3e-4.  The sketch is the parity of how often each of
    32 groups of letters occurs.
    """

    def __init__(self, column: pa.Array, shortest: int):
        self.points, offsets = code_points(column)
        n = len(self.points)
        feed = self.points == 10
        starts = np.concatenate([offsets[:-1], np.flatnonzero(feed) + 1])
        ends = np.concatenate([offsets[1:], np.flatnonzero(feed)])
        starts, ends = np.sort(starts), np.sort(ends)
        self.count = np.bincount(np.searchsorted(offsets, np.flatnonzero(feed), side="right") - 1,
                                 minlength=len(offsets) - 1) + 1
        row = np.repeat(np.arange(len(offsets) - 1), self.count)
        number = spread(self.count)[1]
        keep = ends - starts >= shortest
        self.start, self.end, self.row, self.number = starts[keep], ends[keep], row[keep], number[keep]
        if len(self.start):
            bit = _U(1) << (mix(self.points.astype(_U)) & _U(31))
            upto = np.zeros(n + 1, _U)
            np.bitwise_xor.accumulate(bit, out=upto[1:])
            self.sketch = (upto[self.end] ^ upto[self.start]).astype(np.uint32)
            self.id = digests(self.points, self.start, self.end).view(np.int64)
        else:
            self.id, self.sketch = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    @cached_property
    def hash(self) -> PrefixHash:
        """For the substrings of segments, whose candidates are verified."""
        return PrefixHash(self.points)

    def distinct(self) -> np.ndarray:
        return np.unique(self.id, return_index=True)[1]

    def text(self, i: int) -> str:
        return self.points[self.start[i]:self.end[i]].tobytes().decode("utf-32-le")


def segment(length: np.ndarray, i: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of the i-th of ``parts`` nearly equal segments (the later ones are longer)."""
    small, longer = length // parts, length % parts
    extra = np.maximum(i - (parts - longer), 0)
    return i * small + extra, small + (i >= parts - longer)


def signatures(lines: Lines, at: np.ndarray, probe: bool, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of (length, segment, substring) and the line of each."""
    start, length = lines.start[at], lines.end[at] - lines.start[at]
    out, who = [], []
    parts = edits + 1
    for i in range(parts):
        for delta in range(edits + 1) if probe else [0]:
            other = length - delta  # the indexed line's length
            p, size = segment(other, i, parts)
            low = np.maximum(p - i, p + delta - (edits - i)) if probe else p
            high = np.minimum(p + i, p + delta + (edits - i)) if probe else p
            low, high = np.maximum(low, 0), np.minimum(high, length - size)
            for k in range(2 * edits + 1 if probe else 1):
                ok = np.flatnonzero((low + k <= high) & (other >= parts))
                if len(ok):
                    s = start[ok] + low[ok] + k
                    out.append(mix(lines.hash.raw(s, s + size[ok]) + other[ok].astype(_U) * _U(0xA24BAED4963EE407)
                                   + _U((i + 1) * 0x9FB21C651E98DF25 % (1 << 64))))
                    who.append(at[ok])
    if not out:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(who)


def edit_distance(a: str, b: str, most: int) -> int:
    """Edit distance of a and b, or most + 1 if it is larger.

    The states reachable with k edits are one integer each, whose bits are the
    2 * most + 1 diagonals of the band; a column is a few operations on them.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    low, high = 0, min(len(a), len(b))
    while low < high:  # longest common prefix
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    a, b = a[low:], b[low:]
    low, high = 0, min(len(a), len(b))
    while low < high:  # longest common suffix
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[len(a) - mid:] == b[len(b) - mid:] else (low, mid - 1)
    a, b = a[:len(a) - low], b[:len(b) - low]
    t, band = most, (1 << (2 * most + 1)) - 1
    state = [sum(1 << (t + i) for i in range(k + 1)) for k in range(t + 1)]
    n = len(a)
    for j, c in enumerate(b):
        same = 0
        for d in range(max(0, t - j), min(2 * t, n - 1 - j + t) + 1):
            if a[j + d - t] == c:
                same |= 1 << d
        new = [state[0] & same]
        for k in range(1, t + 1):
            new.append(((state[k] & same) | state[k - 1] | state[k - 1] >> 1 | new[k - 1] << 1) & band)
        state = new
        if not state[t]:
            return most + 1
    end = 1 << (n - len(b) + t)
    return next((k for k in range(t + 1) if state[k] & end), most + 1)


# ---------------------------------------------------------------- candidates

def _alike(sketch: np.ndarray, other: np.ndarray, edits: int) -> np.ndarray:
    return np.bitwise_count(sketch ^ other) <= 2 * edits


def _once(sig: np.ndarray, line: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (signature, line) once, ascending, and the lines' sketches."""
    by = np.lexsort((line, sig))
    by = by[group_bounds([sig[by], line[by]])[0]]
    return np.stack([sig[by], line[by]]), sketch[by]


def join_bucket(sig: np.ndarray, line: np.ndarray, sketch: np.ndarray, probe: np.ndarray, edits: int):
    """Candidate pairs of one bucket (equal signatures, one side indexed, sketches near), then what is too dense for pairs.

    A signature under which many lines meet many is handed on as (signature, line).
    """
    sig = sig.view(np.int64)
    index, index_sketch = _once(sig[~probe], line[~probe], sketch[~probe])
    asked, asked_sketch = _once(sig[probe], line[probe], sketch[probe])
    low = np.searchsorted(index[0], asked[0], "left")
    count = np.searchsorted(index[0], asked[0], "right") - low
    asks = np.searchsorted(asked[0], asked[0], "right") - np.searchsorted(asked[0], asked[0], "left")
    dense = count * asks > DENSE * (count + asks)
    who, k = spread(np.where(dense, count, 0))
    crowd = np.unique(np.concatenate([asked[:, dense], index[:, low[who] + k]], axis=1), axis=1)
    count = np.where(dense, 0, count)
    ends = np.cumsum(count)
    s = 0
    while s < len(count):  # a few million comparisons at a time
        e = max(s + 1, int(np.searchsorted(ends, (ends[s - 1] if s else 0) + 4_000_000, "right")))
        who, k = spread(count[s:e])
        at = low[s:e][who] + k
        x, y = asked[1][s:e][who], index[1][at]
        ok = _alike(asked_sketch[s:e][who], index_sketch[at], edits) & (x != y)
        yield np.minimum(x[ok], y[ok]), np.maximum(x[ok], y[ok]), True
        s = e
    yield crowd[0], crowd[1], False


def candidates(rows: DataFrame, edits: int, shortest: int, buckets: int, crowded: int = CROWDED) -> DataFrame:
    """(a, b, pair): pairs of line ids (a < b) that may be within ``edits``, or lines b under dense signatures a."""
    entry = np.dtype([("sig", "<u4"), ("line", "<i8"), ("sketch", "<u4")])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, limit=LINE_SLICE):
            lines = Lines(batch.column("text"), shortest)
            at = lines.distinct()
            out = {"bucket": [], "probe": [], "n": [], "data": []}
            for probe in (False, True):
                sig, who = signatures(lines, at, probe, edits)
                bucket = (sig >> _U(32)).astype(np.int64) % buckets
                by = np.argsort(bucket, kind="stable")
                packed = np.empty(len(sig), entry)
                packed["sig"], packed["line"], packed["sketch"] = sig[by].astype(np.uint32), lines.id[who[by]], lines.sketch[who[by]]
                first, last = group_bounds([bucket[by]]) if len(by) else ((), ())
                for s, e in zip(first, last):
                    out["bucket"].append(int(bucket[by[s]]))
                    out["probe"].append(probe)
                    out["n"].append(int(e - s))
                    out["data"].append(packed[s:e].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["bucket"], pa.int32()), pa.array(out["probe"], pa.bool_()), pa.array(out["n"], pa.int64()),
                 pa.array(out["data"], pa.binary())], names=["bucket", "probe", "n", "data"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(a, b, pair):
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(len(a), pair, bool))],
                                              names=["a", "b", "pair"])

        def unpacked(bucket, parts):
            data = [np.frombuffer(d, entry) for d, _ in parts]
            all_ = np.concatenate(data)
            probe = np.repeat([p for _, p in parts], [len(d) for d in data])
            return all_["sig"].astype(_U) + (_U(bucket) << _U(32)), all_["line"], all_["sketch"], probe

        def close(bucket, parts):
            for a, b, pair in join_bucket(*unpacked(bucket, parts), edits):
                yield result(a, b, pair)

        bucket, parts, held, crowd = None, [], 0, False
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.column("bucket")[i].as_py()
                if own != bucket:
                    if parts:
                        yield from close(bucket, parts)
                    bucket, parts, held, crowd = own, [], 0, False
                parts.append((batch.column("data")[i].as_buffer(), batch.column("probe")[i].as_py()))
                held += batch.column("n")[i].as_py()
                crowd = crowd or held > crowded
                if crowd:  # hand all signatures on
                    sig, line, _, _ = unpacked(bucket, parts)
                    yield result(sig.view(np.int64), line, False)
                    parts = []
        if parts:
            yield from close(bucket, parts)

    return (rows.mapInArrow(pack, "bucket int, probe boolean, n long, data binary")
            .repartition(buckets, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(join, "a long, b long, pair boolean").distinct())


def wanted_pages(ids: DataFrame) -> dict[int, np.ndarray]:
    """A bitmap of ``FILTER_BITS`` bits, by pages, with the bit of each id set: a filter of bounded size.

    It lets all wanted ids pass, and few others unless ids are more than the bits.
    """
    bits = ids.select(F.expr(f"id & {FILTER_BITS - 1}").alias("bit")).withColumn("page", F.expr("bit >> 16").cast("int"))

    def page(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ("page",)):
            pages, bit = t.column("page").to_numpy(), t.column("bit").to_numpy()
            first, last = group_bounds([pages])
            out = []
            for s, e in zip(first, last):
                one = np.zeros(1 << 16, np.uint8)
                one[bit[s:e] & 0xFFFF] = 1
                out.append(np.packbits(one).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(pages[first], pa.int32()), pa.array(out, pa.binary())], names=["page", "bits"])

    pages = bits.repartition("page").sortWithinPartitions("page").mapInArrow(page, "page int, bits binary").collect()
    return {r["page"]: np.frombuffer(r["bits"], np.uint8) for r in pages}


def passes(pages: dict[int, np.ndarray], ids: np.ndarray) -> np.ndarray:
    bit = ids & (FILTER_BITS - 1)
    out = np.zeros(len(ids), bool)
    for p, rows in ((p, np.flatnonzero(bit >> 16 == p)) for p in np.unique(bit >> 16).tolist() if p in pages):
        low = bit[rows] & 0xFFFF
        out[rows] = pages[p][low >> 3] >> (7 - (low & 7)) & 1
    return out


def family_links(ids: np.ndarray, sketches: np.ndarray, texts: list[str], side: np.ndarray, cross: bool, edits: int):
    """Verified links that connect exactly the lines connected by links of one group; lines already joined aren't compared."""
    n = len(ids)
    family = np.arange(n)
    a, b = [], []
    for x in range(1, n):
        near = np.flatnonzero(_alike(sketches[:x], sketches[x], edits) & (ids[:x] != ids[x]) & ((side[:x] != side[x]) | (not cross)))
        while len(near):
            y = int(near[0])
            if edit_distance(texts[x], texts[y], edits) <= edits:
                a.append(ids[x])
                b.append(ids[y])
                family[family == family[y]] = family[x]
            near = near[1:]
            near = near[family[near] != family[x]]
    return np.array(a, np.int64), np.array(b, np.int64)


def line_links(rows: DataFrame, edits: int, shortest: int, buckets: int, block: int = BLOCK, **sizes) -> DataFrame:
    """(a, b): verified links of distinct lines that connect exactly those connected by links within ``edits``."""
    spark = rows.sparkSession
    found = materialize(candidates(rows, edits, shortest, buckets, **sizes), "line-candidates")
    pairs, crowd = found.where("pair"), found.where("NOT pair").selectExpr("a AS key", "b AS id")
    wanted = materialize(pairs.select(F.explode(F.array("a", "b")).alias("id")).unionByName(crowd.select("id")).distinct(), "line-wanted")
    pages = spark.sparkContext.broadcast(wanted_pages(wanted))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, limit=LINE_SLICE):
            lines = Lines(batch.column("text"), shortest)
            at = lines.distinct()
            at = at[passes(pages.value, lines.id[at])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(lines.id[at]), pa.array(lines.sketch[at].view(np.int32)), pa.array([lines.text(i) for i in at], pa.string())],
                names=["id", "sketch", "line"])

    text = materialize(rows.mapInArrow(texts, "id long, sketch int, line string").join(wanted, "id", "left_semi")
                       .groupBy("id").agg(F.first("sketch").alias("sketch"), F.first("line").alias("line")), "line-texts")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = pa.array([edit_distance(x, y, edits) <= edits for x, y in
                           zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], names=["a", "b"])

    single = (pairs.select("a", "b").join(text.selectExpr("id AS a", "line AS x"), "a")
              .join(text.selectExpr("id AS b", "line AS y"), "b")
              .select("a", "b", "x", "y").mapInArrow(verify, "a long, b long"))

    def family(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ("key", "p", "q")):
            c = {k: t.column(k).to_numpy() for k in ("key", "p", "q", "own", "id", "sketch")}
            line = t.column("line").to_pylist()
            first, last = group_bounds([c[k] for k in ("key", "p", "q")])
            for s, e in zip(first.tolist(), last.tolist()):
                a, b = family_links(c["id"][s:e], c["sketch"][s:e].view(np.uint32), line[s:e], c["own"][s:e], bool(c["p"][s] != c["q"][s]), edits)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    groups = dealt(crowd, ["key"], ["id"], block).join(text, "id").select("key", "p", "q", "own", "id", "sketch", "line")
    dense = (groups.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "id").mapInArrow(family, "a long, b long"))
    return single.unionByName(dense)


# ---------------------------------------------------------------- documents

def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def line_report(docs: DataFrame, edits: int = EDITS, shortest: int = SHORTEST, buckets: int | None = None,
                **sizes) -> DataFrame:
    """row, doc_id, n_lines, n_removed, removed, kept_in of each row of a stored table.

    ``removed``: numbers of the lines that go, ascending; ``kept_in``: for each,
    its class id, the id of the document whose line stays for it.  ``row``: the
    row's place.
    """
    prepare(docs.sparkSession)
    if shortest <= edits:
        raise ValueError("lines must be longer than the number of edits")
    rows = _rows(docs)
    if buckets is None:  # about 0.9 bytes of signatures a byte of text
        size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
        buckets = max(64, int(size) // BUCKET_BYTES)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, limit=LINE_SLICE):
            lines = Lines(batch.column("text"), shortest)
            take = lambda c, i: batch.column(c).take(pa.array(i))
            yield pa.RecordBatch.from_arrays(
                [pa.array(lines.id), take("row", lines.row), take("doc_id", lines.row), pa.array(lines.number.astype(np.int32))],
                names=["id", "row", "doc_id", "line"])
            yield pa.RecordBatch.from_arrays(  # a row for the document itself: its number of lines
                [pa.nulls(batch.num_rows, pa.int64()), batch.column("row"), batch.column("doc_id"),
                 pa.array(lines.count.astype(np.int32))], names=["id", "row", "doc_id", "line"])

    at = materialize(rows.mapInArrow(places, "id long, row long, doc_id long, line int"), "line-places")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "line")
    lines = at.where("id IS NOT NULL").groupBy("id").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    roots = connected_components(line_links(rows, edits, shortest, buckets, **sizes)).selectExpr("node AS id", "root")
    linked = materialize(lines.join(roots, "id"), "line-classes")
    classes = linked.select("id", "root").join(linked.groupBy("root").agg(F.min("first").alias("keep")), "root").select("id", "keep")
    known = materialize(lines.join(classes, "id", "left").where("n > 1 OR keep IS NOT NULL")
                        .select("id", "n", F.coalesce("keep", "first").alias("keep")), "line-known")
    # A line with over a COMMON-th of all occurrences isn't met in one task: by counting there are at most COMMON of those.
    often = F.col("n") > at.count() / COMMON
    hot, rare = F.broadcast(known.where(often)), known.where(~often)
    stands = at.where("id IS NOT NULL")
    met = stands.join(hot, "id").unionByName(stands.join(hot.select("id"), "id", "left_anti").join(rare, "id"))
    goes = ~((F.col("keep.row") == F.col("row")) & (F.col("keep.line") == F.col("line")))
    # Lines that no other equals or resembles need no join; a document's own row has no line id and takes no part in it.
    gone = (met.where(goes)
            .select("row", F.struct("line", F.col("keep.doc_id").alias("doc")).alias("gone")))
    per = (at.where("id IS NULL").selectExpr("row", "doc_id", "line AS n_lines", "CAST(NULL AS STRUCT<line: INT, doc: BIGINT>) AS gone")
           .unionByName(gone.selectExpr("row", "CAST(NULL AS BIGINT) AS doc_id", "CAST(NULL AS INT) AS n_lines", "gone"))
           .groupBy("row").agg(F.min("doc_id").alias("doc_id"), F.max("n_lines").alias("n_lines"),
                               F.sort_array(F.collect_list("gone")).alias("gone")))
    return per.select("row", "doc_id", "n_lines", F.size("gone").alias("n_removed"),
                      F.col("gone.line").alias("removed"), F.col("gone.doc").alias("kept_in"))


def drop_lines(docs: DataFrame, edits: int = EDITS, shortest: int = SHORTEST) -> DataFrame:
    """All rows and columns of a stored table, texts without the lines that go; ``n_chars``, if there, is made anew."""
    row, removed = fresh(docs.columns, "__row"), fresh(docs.columns, "__removed")
    report = line_report(docs, edits, shortest).where("n_removed > 0").select(F.col("row").alias(row), F.col("removed").alias(removed))
    joined = docs.withColumn(row, F.monotonically_increasing_id()).join(report, row, "left")
    lines = F.split("text", "\n", -1)
    left = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains(removed, i)), "\n")
    out = joined.withColumn("text", F.when(F.col(removed).isNull(), F.col("text")).otherwise(left))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(removed).isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(kind)))
    return out.select(*docs.columns)


def op9_segment_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(documents(spark, sf_dir)).drop("row")
