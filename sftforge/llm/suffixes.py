"""Operator 2, exact substring dedup with suffix arrays.

Texts are UTF-8 bytes.  Every byte that a string of ``LENGTH`` bytes covers goes
if that string also starts anywhere else in the corpus, the same text included.

Per shard (a megabyte of texts): a suffix array by Larsson-Sadakane
refinement (groups that are tied so far are sorted by the rank of what follows
them, the depth doubling each round), then Kasai's common prefixes of its
neighbours; strings in a run of common prefixes of at least LENGTH repeat.

Across shards: each string belongs to the smallest hash of its ``GRAM``-byte
substrings, so equal strings in any two shards have the same key.  Consecutive
strings of one key form a segment, and a shard sends the sorted list of its
distinct segments as (key, digest).  A bucket of keys merges the lists by binary
search: a segment found in another shard's list repeats whole; of a key whose
segments differ, one shard each sends the bytes, and the suffix array of these
few segments together shows which of their strings meet.  Common passages cost
one entry a shard, and a key with very many different segments is dealt in
blocks, each pair of blocks a group.

Edge cases: a null text is empty; texts of fewer than LENGTH bytes lose nothing;
rows of equal ids or texts count each for itself (copies lose all that is long
enough); null ids pass through; a text longer than a shard is read in parts that
overlap; an empty table gives no rows; other columns are ignored.  Digests and
keys are 64-bit hashes of which both must agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftforge.llm.buckets import dealt, group_bounds, whole_groups
from sftforge.llm.common import PrefixHash, documents, materialize, mix, prepare, release, sliced, spread, text_bytes
from sftforge.llm.linededup import passes, wanted_pages

LENGTH, GRAM = 200, 32
SHARD_BYTES = 1 << 20
BUCKET_BYTES = 16 << 20
BLOCK = 2048
_U = np.uint64


# ---------------------------------------------------------------- suffix array and common prefixes

def eight_bytes(data: np.ndarray, pad: int) -> np.ndarray:
    """The eight bytes from each position as a big-endian number, zeros behind the end."""
    n = len(data) + pad
    wide = np.zeros(n + 8, _U)
    wide[:len(data)] = data
    for step in (1, 2, 4):
        wide[:n + 8 - step] = wide[:n + 8 - step] << _U(8 * step) | wide[step:]
    return wide[:n]


def suffix_array(word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order, and each one's place.

    Larsson-Sadakane: a suffix's rank is the place where its group of ties
    begins.  Each round sorts the suffixes still tied by the rank of the suffix
    that many bytes on; groups of one are done and never touched again.  Ties are
    followed to their end, since Kasai's bound holds for the full order only.
    """
    sa = np.argsort(word[:n]).astype(np.int64)
    begins = np.ones(n, bool)
    begins[1:] = word[sa[1:]] != word[sa[:-1]]
    # A suffix of under eight bytes may equal a longer one by the zeros behind its end: it goes before that, alone.
    ordered = word[sa]
    for value in np.unique(word[max(n - 7, 0):n]):
        s, e = np.searchsorted(ordered, value, "left"), np.searchsorted(ordered, value, "right")
        group = sa[s:e]
        short = np.sort(group[group > n - 8])[::-1]
        sa[s:e] = np.concatenate([short, group[group <= n - 8]])
        begins[s:min(s + len(short) + 1, e)] = True
    rank = np.zeros(n + 1, np.int64)  # 0 behind the end
    rank[sa] = np.maximum.accumulate(np.where(begins, np.arange(n), 0)) + 1
    h = 8
    while True:
        alone = begins & np.append(begins[1:], True)
        tied = np.flatnonzero(~alone)
        if not len(tied):
            break
        at = sa[tied]
        key = rank[at] << 32 | rank[np.minimum(at + h, n)]
        order = np.argsort(key)
        at, key = at[order], key[order]
        sa[tied] = at
        new = np.ones(len(tied), bool)
        new[1:] = key[1:] != key[:-1]
        begins[tied] = new
        rank[at] = np.maximum.accumulate(np.where(new, tied, 0)) + 1
        h *= 2
    place = np.empty(n, np.int64)
    place[sa] = np.arange(n)
    return sa, place


def common_prefixes(word: np.ndarray, sa: np.ndarray, place: np.ndarray, most: int, stride: int = 64) -> np.ndarray:
    """Kasai: for each place, the bytes its suffix shares with the one before, ``most`` at most.

    A suffix shares with its neighbour at least one byte less than the suffix one
    position earlier shares with its own.  ``n / stride`` positions go at a time:
    first every stride-th from nothing, then their successors from what they had.
    """
    n = len(sa)
    shared = np.zeros(n, np.int64)
    before = np.empty(n, np.int64)  # by position: the suffix one place earlier
    before[sa[1:]] = sa[:-1]
    if n:
        before[sa[0]] = -1
    have = None
    for first in range(min(stride, n)):
        i = np.arange(first, n, stride)
        j = before[i]
        length = np.zeros(len(i), np.int64) if have is None else np.maximum(have[:len(i)] - 1, 0)
        live = np.flatnonzero((j >= 0) & (length < most))
        length[j < 0] = 0
        while len(live):
            differ = word[i[live] + length[live]] ^ word[j[live] + length[live]]
            same = differ == 0
            part = differ[~same]
            bytes_ = np.zeros(len(part), np.int64)
            for b in range(1, 8):
                bytes_ += part < _U(1 << (64 - 8 * b))
            length[live[~same]] += bytes_
            live = live[same]
            length[live] += 8
            live = live[length[live] < most]
        have = np.minimum(length, most)
        shared[i] = have
    out = np.zeros(n, np.int64)
    out[place] = shared
    return out


def repeated(data: np.ndarray, whole: np.ndarray, length: int) -> np.ndarray:
    """Whether the string of ``length`` bytes at each position, ``whole`` within its text, starts at another such one."""
    n = len(data)
    out = np.zeros(n, bool)
    at = np.flatnonzero(whole)
    if len(at) < 2:
        return out
    word = eight_bytes(data, length + 16)
    sa, place = suffix_array(word, n)
    run = np.cumsum(common_prefixes(word, sa, place, length) < length) - 1
    count = np.bincount(run, weights=whole[sa], minlength=int(run[-1]) + 1)
    out[sa] = count[run] >= 2
    return out & whole


# ---------------------------------------------------------------- keys and segments

def gram_hashes(hashes: PrefixHash, n: int, gram: int) -> np.ndarray:
    return mix((hashes.sums[gram:] - hashes.sums[:max(n - gram + 1, 0)]) * hashes.inverse[:max(n - gram + 1, 0)])


def least_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` successive hashes (running minima block by block)."""
    grams = len(h)
    if grams < width:
        return np.zeros(0, _U)
    blocks = -(-grams // width)
    padded = np.full(blocks * width, np.iinfo(_U).max, _U)
    padded[:grams] = h
    table = padded.reshape(blocks, width)
    left = np.minimum.accumulate(table, axis=1).ravel()
    right = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    count = grams - width + 1
    return np.minimum(right[:count], left[width - 1:width - 1 + count])


class Shard:
    """Parts of texts back to back: rows, first byte of each part in its text, and the strings that are whole."""

    def __init__(self, rows: np.ndarray, begins: np.ndarray, data: np.ndarray, offsets: np.ndarray, length: int):
        self.rows, self.begins, self.data, self.offsets, self.length = rows, begins, data, offsets, length
        n = len(data)
        size = np.diff(offsets)
        self.text = np.repeat(np.arange(len(size)), size)
        self.whole = offsets[1:][self.text] - np.arange(n) >= length

    def segments(self, gram: int) -> None:
        """Runs of strings of one key: start, number of strings, key, digest; ``pairs``: the distinct (key, digest)."""
        n = len(self.data)
        hashes = PrefixHash(self.data)
        self.grams, self.width = gram_hashes(hashes, n, gram), self.length - gram + 1
        key = least_hashes(self.grams, self.width)
        at = np.flatnonzero(self.whole)
        k = key[at] if len(at) else np.zeros(0, _U)
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | (k[1:] != k[:-1]) | (self.text[at[1:]] != self.text[at[:-1]])
        first = np.flatnonzero(new)
        self.start = at[first]
        self.count = np.diff(np.append(first, len(at)))
        self.key = k[first]
        self.digest = hashes.of(self.start, self.start + self.count + self.length - 1)
        order = np.lexsort((self.digest, self.key))
        fresh = np.ones(len(order), bool)
        a, b = self.key[order], self.digest[order]
        fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        self.pairs = np.stack([a[fresh], b[fresh]])
        self.pair = np.empty(len(order), np.int64)  # of each segment
        self.pair[order] = np.cumsum(fresh) - 1

    def repeats(self) -> np.ndarray:
        """Strings that repeat within the shard, from a suffix array over those that can.

        Equal strings have one key, so they lie in segments whose key another
        segment has too, or in one whose least gram stands in it twice.
        """
        out = np.zeros(len(self.data), bool)
        if not len(self.start):
            return out
        _, number, times = np.unique(self.key, return_inverse=True, return_counts=True)
        able = times[number] > 1
        rest = np.flatnonzero(~able)
        for s in range(0, len(rest), 4096):
            part = rest[s:s + 4096]
            size = self.count[part] + self.width - 1
            which, k = spread(size)
            same = self.grams[self.start[part][which] + k] == self.key[part][which]
            able[part] = np.bincount(which, same, minlength=len(part)) > 1
        able = np.flatnonzero(able)
        if not len(able):
            return out
        # The bytes of these segments, overlaps of neighbours once.
        cover = np.zeros(len(self.data) + 1, np.int64)
        np.add.at(cover, self.start[able], 1)
        np.add.at(cover, self.start[able] + self.count[able] + self.length - 1, -1)
        at = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
        string = np.zeros(len(self.data) + 1, np.int64)
        np.add.at(string, self.start[able], 1)
        np.add.at(string, self.start[able] + self.count[able], -1)
        out[at] = repeated(self.data[at], np.cumsum(string[:-1])[at] > 0, self.length)
        return out

    def spans(self, marked: np.ndarray) -> pa.RecordBatch:
        """Rows (row, spans): runs of marked string starts as flat [first, end) pairs, places within the text."""
        at = np.flatnonzero(marked)
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | (self.text[at[1:]] != self.text[at[:-1]])
        first = at[new]
        last = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)] if len(at) else at
        return spans_batch(self.rows, self.text[first], first - self._shift(first), last + 1 - self._shift(first))

    def _shift(self, at: np.ndarray) -> np.ndarray:
        return self.offsets[self.text[at]] - self.begins[self.text[at]]

    def place(self, at: np.ndarray) -> np.ndarray:
        """Places within the texts."""
        return at - self._shift(at)


def spans_batch(rows: np.ndarray, text: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    first, last = group_bounds([text]) if len(text) else (np.zeros(0, int), np.zeros(0, int))
    flat = np.stack([start, end], axis=1).ravel()
    lists = pa.ListArray.from_arrays(pa.array(np.append(2 * first, len(flat)), pa.int32()), pa.array(flat, pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(rows[text[first]], pa.int64()), lists], names=["row", "spans"])


def shards(batches: Iterator[pa.RecordBatch], length: int, most: int) -> Iterator[tuple[int, Shard]]:
    """Numbered shards of a partition, the same in every pass; a longer text makes shards of its own."""
    number = 0
    for batch in sliced(batches, limit=most):
        data, offsets = text_bytes(batch.column("text"))
        rows = batch.column("row").to_numpy()
        part = batch.column("part")[0].as_py() << 32
        if batch.num_rows == 1 and len(data) > most + length:
            for begin in range(0, len(data) - length + 1, most):
                piece = data[begin:begin + most + length - 1]
                yield part + number, Shard(rows, np.array([begin]), piece, np.array([0, len(piece)]), length)
                number += 1
        else:
            yield part + number, Shard(rows, np.zeros(len(rows), np.int64), data, offsets, length)
            number += 1


# ---------------------------------------------------------------- Spark jobs

def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES,
                   buckets: int | None = None, block: int = BLOCK) -> DataFrame:
    """(row, spans): starts of all repeated strings, as lists of flat [first, end) pairs; several rows a text."""
    if not 8 <= gram <= length:
        raise ValueError("gram must lie between 8 and length")
    prepare(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("text").cast("string").alias("text"),
                       F.spark_partition_id().alias("part"))
    if buckets is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(64, int(size) // BUCKET_BYTES)
    null = lambda n, t: pa.nulls(n, t)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Spans that repeat within a shard, and the shard's sorted list of segments by bucket."""
        for number, shard in shards(batches, length, shard_bytes):
            shard.segments(gram)
            own = shard.spans(shard.repeats())
            shard.grams = None
            n = own.num_rows
            yield pa.RecordBatch.from_arrays([*own.columns, null(n, pa.int64()), null(n, pa.int32()), null(n, pa.binary())], names=_LOCAL)
            bucket = ((shard.pairs[0] >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int32)
            first, last = group_bounds([bucket]) if len(bucket) else (np.zeros(0, int), ())
            data = [shard.pairs[:, s:e].tobytes() for s, e in zip(first, last)]
            # Bucket -1: where the shard's segments lie, to meet the answers.
            table = np.zeros(len(shard.start), _SEGMENT)
            if len(table):
                table["row"], table["start"] = shard.rows[shard.text[shard.start]], shard.place(shard.start)
                table["count"], table["pair"], table["key"] = shard.count, shard.pair, shard.key
            n = len(data) + 1
            yield pa.RecordBatch.from_arrays(
                [null(n, pa.int64()), null(n, pa.list_(pa.int64())), pa.array([number] * n, pa.int64()),
                 pa.array([*bucket[first].tolist(), -1], pa.int32()), pa.array([*data, table.tobytes()], pa.binary())], names=_LOCAL)
            del shard, own, data, table  # not held while the next shard is made
            release()

    found = materialize(rows.mapInArrow(local, "row long, spans array<long>, shard long, bucket int, data binary"), "suffix-local")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each shard's list: 1 for segments that another shard has, plus 2 for those whose bytes it shall send."""
        def close(bucket, parts):
            lists = [np.frombuffer(d, _U).reshape(2, -1) for _, d in parts]
            all_ = np.concatenate(lists, axis=1)
            order = np.lexsort((all_[1], all_[0]))
            key, digest = all_[0][order], all_[1][order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (digest[1:] != digest[:-1])
            union = np.stack([key[new], digest[new]])
            held_by = np.diff(np.append(np.flatnonzero(new), len(key)))
            # Per key: does it have several segments, one of them in a single shard only?
            first, last = group_bounds([union[0]])
            lone = np.add.reduceat(held_by == 1, first) if len(first) else first
            mixed = np.repeat((last - first > 1) & (lone > 0), last - first)
            sent = np.zeros(union.shape[1], bool)
            low = np.searchsorted(union[0], union[0], "left")
            answers = []
            for own in lists:
                # Binary search of the shard's sorted pairs in the union: by key, then by digest within the key.
                at = search_pairs(union, own, low)
                code = (held_by[at] > 1).astype(np.uint8)
                send = mixed[at] & ~sent[at]
                sent[at[send]] = True
                answers.append((code + 2 * send).astype(np.uint8).tobytes())
            n = len(parts)
            return pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in parts], pa.int64()), pa.array([bucket] * n, pa.int32()), pa.array(answers, pa.binary())],
                names=["shard", "bucket", "data"])

        now, parts = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.column("bucket")[i].as_py()
                if parts and own != now:
                    yield close(now, parts)
                    parts = []
                now = own
                parts.append((batch.column("shard")[i].as_py(), batch.column("data")[i].as_py()))
        if parts:
            yield close(now, parts)

    codes = (found.where("bucket >= 0").select("shard", "bucket", "data")
             .repartition(buckets, "bucket").sortWithinPartitions("bucket", "shard")
             .mapInArrow(merge, "shard long, bucket int, data binary"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Spans of segments that other shards have, and the places of those to be compared byte by byte."""
        def close(table, codes_):
            code = np.frombuffer(b"".join(codes_), np.uint8)
            full = table[(code[table["pair"]] & 1) > 0]
            first, last = group_bounds([full["row"]]) if len(full) else (np.zeros(0, int), np.zeros(0, int))
            flat = np.stack([full["start"], full["start"] + full["count"]], axis=1).ravel()
            n = len(first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(full["row"][first], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.append(2 * first, len(flat)), pa.int32()), pa.array(flat, pa.int64())),
                 *[null(n, pa.int64())] * 3], names=_APPLIED)
            _, one = np.unique(table["pair"], return_index=True)  # a segment of each pair, by its number
            send = table[one[(code & 2) > 0]]
            n = len(send)
            yield pa.RecordBatch.from_arrays(
                [pa.array(send["row"], pa.int64()), null(n, pa.list_(pa.int64())), pa.array(send["key"].view(np.int64)),
                 pa.array(send["start"], pa.int64()), pa.array(send["count"] + (length - 1), pa.int64())], names=_APPLIED)

        now, table, codes_ = None, None, []
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("bucket")[i].as_py() < 0:
                    if table is not None and len(table):
                        yield from close(table, codes_)
                    now = batch.column("shard")[i].as_py()
                    table, codes_ = np.frombuffer(batch.column("data")[i].as_py(), _SEGMENT), []
                elif batch.column("shard")[i].as_py() != now:
                    raise RuntimeError("answers without their shard")
                else:
                    codes_.append(batch.column("data")[i].as_py())
        if table is not None and len(table):
            yield from close(table, codes_)

    applied = materialize(
        found.where("bucket = -1").select("shard", "bucket", "data").unionByName(codes)
        .repartition(buckets, "shard").sortWithinPartitions("shard", "bucket")
        .mapInArrow(apply, "row long, spans array<long>, key long, start long, size long"), "suffix-applied")

    # The bytes of the segments to be compared, from those documents alone (a bounded filter keeps most others back).
    asked = (applied.where("key IS NOT NULL").groupBy("row")
             .agg(F.collect_list(F.struct("key", "start", "size")).alias("asked")))
    pages = docs.sparkSession.sparkContext.broadcast(wanted_pages(asked.select(F.xxhash64("row").alias("id"))))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(iter([batch])):
                yield part.filter(pa.array(passes(pages.value, part.column("hash").to_numpy()))).select(["row", "text"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = {"key": [], "row": [], "start": [], "data": []}
            for row, text, places in zip(*(batch.column(c).to_pylist() for c in ("row", "text", "asked"))):
                raw = text.encode()
                for place in places:
                    out["key"].append(place["key"])
                    out["row"].append(row)
                    out["start"].append(place["start"])
                    out["data"].append(raw[place["start"]:place["start"] + place["size"]])
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(out[c], pa.int64()) for c in ("key", "row", "start")), pa.array(out["data"], pa.binary())], names=list(out))

    segments = materialize(
        rows.select("row", "text", F.xxhash64("row").alias("hash")).mapInArrow(some, "row long, text string")
        .join(asked, "row").select("row", "text", "asked")
        .mapInArrow(fetch, "key long, row long, start long, data binary"), "suffix-segments")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One suffix array over the segments of whole keys, a shard's worth at a time."""
        def close(held):
            t = pa.Table.from_batches(held)
            # Blocks meet several others: a segment counts once among those compared.
            place = np.stack([t.column("row").to_numpy(), t.column("start").to_numpy()])
            t = t.take(pa.array(np.unique(place, axis=1, return_index=True)[1]))
            blob = t.column("data").to_pylist()
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in blob])])
            shard = Shard(t.column("row").to_numpy(), t.column("start").to_numpy(), np.frombuffer(b"".join(blob), np.uint8), offsets, length)
            return shard.spans(repeated(shard.data, shard.whole, length))

        held, size = [], 0
        for t in whole_groups(batches, ("key", "p", "q")):
            first, last = group_bounds([t.column(k).to_numpy() for k in ("key", "p", "q")])
            upto = np.cumsum([len(x) for x in t.column("data").to_pylist()])
            s = 0
            for e in last.tolist():
                if e == last[-1] or upto[e - 1] - (upto[s - 1] if s else 0) > shard_bytes:
                    held += t.slice(s, e - s).to_batches()
                    size += int(upto[e - 1] - (upto[s - 1] if s else 0))
                    s = e
                    if size > shard_bytes:
                        yield close(held)
                        held, size = [], 0
        if held:
            yield close(held)

    parts = dealt(segments, ["key"], ["row", "start"], block)
    met = (parts.select("key", "p", "q", "row", "start", "data").repartition(buckets, "key", "p", "q").sortWithinPartitions("key", "p", "q")
           .mapInArrow(compare, "row long, spans array<long>"))
    return (found.where("row IS NOT NULL").select("row", "spans").unionByName(applied.where("spans IS NOT NULL").select("row", "spans"))
            .unionByName(met))


_LOCAL = ["row", "spans", "shard", "bucket", "data"]
_APPLIED = ["row", "spans", "key", "start", "size"]
_SEGMENT = np.dtype([("row", "<i8"), ("start", "<i8"), ("count", "<i4"), ("pair", "<i4"), ("key", "<u8")])


def search_pairs(union: np.ndarray, own: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Places of the (key, digest) pairs ``own`` in the sorted ``union``, by binary search."""
    at = np.searchsorted(union[0], own[0], "left")
    end = np.searchsorted(union[0], own[0], "right")
    while True:  # within a key, halve until the digest is found
        todo = np.flatnonzero(end - at > 1)
        if not len(todo):
            return at
        mid = (at[todo] + end[todo]) // 2
        up = union[1][mid] <= own[1][todo]
        at[todo[up]] = mid[up]
        end[todo[~up]] = mid[~up]


def drop_repeated(docs: DataFrame, length: int = LENGTH, **sizes) -> DataFrame:
    """doc_id, n_bytes, spans (removed byte runs as flat [first, end) pairs) and kept (the bytes that stay) of each row."""
    spans = (repeated_spans(docs, length, **sizes).groupBy("row")
             .agg(F.flatten(F.collect_list("spans")).alias("spans")))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            data, offsets = text_bytes(batch.column("text"))
            raw = data.tobytes()
            out = {"spans": [], "kept": []}
            for i, spans_ in enumerate(batch.column("spans").to_pylist()):
                gone: list[int] = []
                for s, e in sorted(zip((spans_ or [])[::2], (spans_ or [])[1::2])):
                    if gone and s <= gone[-1]:
                        gone[-1] = max(gone[-1], e + length - 1)
                    else:
                        gone += [s, e + length - 1]
                base, end = int(offsets[i]), int(offsets[i + 1])
                edges = [base, *[base + x for x in gone], end]
                out["spans"].append(gone)
                out["kept"].append(b"".join(raw[s:e] for s, e in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(out["spans"], pa.list_(pa.int64())),
                 pa.array(out["kept"], pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    return (rows.join(spans, "row", "left").select("doc_id", "text", "spans")
            .mapInArrow(cut, "doc_id long, n_bytes long, spans array<long>, kept binary"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT r, s, array_slice(b, s, s + {LENGTH - 1}) AS x
      FROM d, unnest(generate_series(1, octet_length(b) - {LENGTH - 1})) AS g(s)),
again AS (SELECT x FROM w GROUP BY x HAVING count(*) > 1),
hit AS (SELECT r, s FROM w SEMI JOIN again USING (x)),
step AS (SELECT r, s, coalesce(CAST(s > lag(s) OVER o + {LENGTH} AS INTEGER), 1) AS fresh FROM hit WINDOW o AS (PARTITION BY r ORDER BY s)),
numbered AS (SELECT r, s, sum(fresh) OVER (PARTITION BY r ORDER BY s) AS k FROM step),
gone AS (SELECT r, k, min(s) AS a, max(s) + {LENGTH} AS z FROM numbered GROUP BY r, k),
kept AS (SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 1) AS since FROM gone),
sums AS (SELECT r, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last,
                string_agg(hex(array_slice(b, since, a - 1)), '' ORDER BY a) AS front
         FROM kept JOIN d USING (r) GROUP BY r)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(front, '') || hex(array_slice(b, coalesce(last, 1), octet_length(b))))) AS kept_sha256
FROM d LEFT JOIN sums USING (r)
"""
