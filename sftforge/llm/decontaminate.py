"""Operator 3, benchmark decontamination by spaced-seed hashing.

Texts are words of letters, digits and non-ASCII signs, lower-cased.  A window
of ``SPAN`` words of a text that equals a window of a benchmark item but for at
most ``SUBSTITUTIONS`` words is a leak.  Fixed masks each ignore the window's
positions of two residues modulo 4, so whichever two positions are substituted,
some mask ignores both and the masked hashes of the two windows are equal: no
leak is missed.  Hits are verified word by word over the whole window, and
verified windows are joined into overlaps.  Items of fewer words must stand in
the text whole; those of ``ONE_FROM`` words or more may differ in one word (two
masks, each without every other position), shorter ones must be unchanged, and
items under ``LEAST`` words are no evidence and never matched.

The documents are read once and never shuffled, however hot a passage is.  The
benchmark's hashes are broadcast in blocks of at most about ``BLOCK_BYTES`` of
text, each with its own pass over the rows in the same stage, so a large
benchmark makes more passes and not a larger broadcast.  Items of one text are
one entry with the list of their ids, so copies of an item add 8 bytes each and
no work; a block's text and ids both count towards its size.

Edge cases: null and empty texts are clean; null items match nothing; an item
without id counts, and stands in ``item_ids`` as null, last; each of repeated items
is listed by its id, each of repeated rows reported; an empty benchmark or table gives clean or no rows; other
columns are ignored (``keep_clean`` returns them all).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftforge.llm.common import (PrefixHash, documents, lowered, materialize, mix, prepare, sliced,
                                 spread, text_bytes, words)

SPAN, SUBSTITUTIONS = 13, 2
ONE_FROM, LEAST = 7, 3
RESIDUES = 4
BLOCK_BYTES = 4 << 20

#: Everything but ASCII letters and digits and the bytes of non-ASCII signs ends a word.
BREAKS = np.ones(256, bool)
BREAKS[48:58] = BREAKS[65:91] = BREAKS[97:123] = BREAKS[128:] = False

#: Positions that each mask keeps.
MASKS = [[i for i in range(SPAN) if i % RESIDUES not in ignored]
         for ignored in combinations(range(RESIDUES), SUBSTITUTIONS)]


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Hash and row of each word."""
    data, offsets = text_bytes(column)
    data = lowered(data)
    starts, ends, row = words(data, offsets, BREAKS)
    return PrefixHash(data).of(starts, ends), row, len(offsets) - 1


def masked(w: np.ndarray, at: np.ndarray, keep: list[int], salt: int) -> np.ndarray:
    """Hash of the kept words of the windows that start at ``at``."""
    h = np.full(len(at), salt, np.uint64)
    for i in keep:
        h += w[at + i] * np.uint64(pow(0x9E3779B97F4A7C15, i + 1, 1 << 64))
    return mix(h)


def window_starts(row: np.ndarray, span: int) -> np.ndarray:
    """Windows that lie within one text."""
    if len(row) < span:
        return np.zeros(0, np.int64)
    return np.flatnonzero(row[span - 1:] == row[:len(row) - span + 1])


class Index:
    """Masked hashes of a block of the benchmark: distinct texts, each with the ids of its items."""

    def __init__(self, ids: list[list], texts: list[str]):
        self.ids = ids
        self.words, self.row, n = tokens(pa.array(texts, pa.string()))
        size = np.bincount(self.row, minlength=n)
        #: (span, substitutions, kept positions, salt, sorted hashes, window starts, filter)
        self.masks = []
        kinds = [(SPAN, SUBSTITUTIONS, m) for m in MASKS]
        for s in sorted({int(s) for s in size if LEAST <= s < SPAN}):
            if s >= ONE_FROM:
                kinds += [(s, 1, list(range(odd, s, 2))) for odd in (0, 1)]
            else:
                kinds.append((s, 0, list(range(s))))
        for salt, (span, most, keep) in enumerate(kinds):
            at = window_starts(self.row, span)
            if span < SPAN:
                at = at[size[self.row[at]] == span]
            h = masked(self.words, at, keep, salt)
            by = np.argsort(h, kind="stable")
            seen = np.zeros(1 << 20, bool)
            seen[h >> np.uint64(44)] = True
            self.masks.append((span, most, keep, salt, h[by], at[by], seen))

    def overlaps(self, w: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Verified windows: start in ``w``, span, item."""
        found = []
        starts = {span: window_starts(row, span) for span in {m[0] for m in self.masks}}
        for span, most, keep, salt, hashes, places, seen in self.masks:
            at = starts[span]
            h = masked(w, at, keep, salt)
            maybe = seen[h >> np.uint64(44)]
            at, h = at[maybe], h[maybe]
            low = np.searchsorted(hashes, h, "left")
            count = np.searchsorted(hashes, h, "right") - low
            hit, k = spread(count)
            mine, theirs = at[hit], places[low[hit] + k]
            same = (w[mine[:, None] + np.arange(span)] == self.words[theirs[:, None] + np.arange(span)]).sum(axis=1)
            good = same >= span - most
            found.append(np.stack([mine[good], np.full(good.sum(), span), self.row[theirs[good]]]))
        return tuple(np.unique(np.concatenate(found, axis=1), axis=1)) if found else (np.zeros(0, np.int64),) * 3

    def leaks(self, column: pa.Array) -> tuple[list[list], list[list[int]]]:
        """For each text: item ids, and the leaked word positions as flat [start, end) pairs."""
        w, row, n = tokens(column)
        at, span, item = self.overlaps(w, row)
        first = np.searchsorted(row, np.arange(n))
        met, spans = [set() for _ in range(n)], [[] for _ in range(n)]
        for p, s, i in zip(at.tolist(), span.tolist(), item.tolist()):
            r = int(row[p])
            met[r].add(i)
            spans[r] += [p - int(first[r]), p - int(first[r]) + s]
        return [[x for i in items for x in self.ids[i]] for items in met], spans

    def dirty(self, column: pa.Array) -> np.ndarray:
        w, row, n = tokens(column)
        out = np.zeros(n, bool)
        out[row[self.overlaps(w, row)[0]]] = True
        return out


def indexes(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list:
    """Broadcast indexes of the benchmark, a block each; the driver holds one block at a time."""
    spark = benchmark.sparkSession
    text = F.col("text").cast("string")
    # A struct, as collect_set leaves out nulls.
    classes = materialize(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), text.alias("text")).where("text IS NOT NULL")
        .groupBy(F.sha2("text", 256).alias("class"))
        .agg(F.first("text").alias("text"), F.collect_set(F.struct("item_id")).alias("ids")), "benchmark-classes")
    size = classes.agg(F.sum(F.octet_length("text") + 8 * F.size("ids"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    out = []
    for b in range(blocks):
        rows = classes.where(F.pmod(F.xxhash64("class"), F.lit(blocks)) == b).collect()
        out.append(spark.sparkContext.broadcast(Index([[i["item_id"] for i in r["ids"]] for r in rows], [r["text"] for r in rows])))
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, contaminated, item_ids (ascending, each once), leaked_words, n_words of each row."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.array().cast("array<long>").alias("items"), F.array().cast("array<long>").alias("spans"))

    def search(index) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches):
                ids, spans = index.value.leaks(batch.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text"),
                     pa.array([a + b for a, b in zip(batch.column("items").to_pylist(), ids)], pa.list_(pa.int64())),
                     pa.array([a + b for a, b in zip(batch.column("spans").to_pylist(), spans)], pa.list_(pa.int64()))],
                    names=["doc_id", "text", "items", "spans"])

        return rows.mapInArrow(run, "doc_id long, text string, items array<long>, spans array<long>")

    for index in indexes(benchmark, block_bytes):
        rows = search(index)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            n = np.bincount(tokens(batch.column("text"))[1], minlength=batch.num_rows)
            ids, leaked = [], []
            for items, spans in zip(batch.column("items").to_pylist(), batch.column("spans").to_pylist()):
                ids.append(sorted(set(items), key=lambda x: (x is None, x or 0)))
                covered = 0
                upto = 0
                for s, e in sorted(zip(spans[::2], spans[1::2])):
                    covered += max(0, e - max(s, upto))
                    upto = max(upto, e)
                leaked.append(covered)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x > 0 for x in leaked], pa.bool_()), pa.array(ids, pa.list_(pa.int64())),
                 pa.array(leaked, pa.int64()), pa.array(n.astype(np.int64))],
                names=["doc_id", "contaminated", "item_ids", "leaked_words", "n_words"])

    return rows.mapInArrow(close, "doc_id long, contaminated boolean, item_ids array<long>, leaked_words long, n_words long")


def keep_clean(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows, all columns, without any leak."""
    prepare(docs.sparkSession)

    def drop(rows: DataFrame, index) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches):
                yield batch.filter(pa.array(~index.value.dirty(batch.column("text"))))

        return rows.mapInArrow(run, docs.schema)

    out = docs
    for index in indexes(benchmark, block_bytes):
        out = drop(out, index)
    return out


def op3_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
