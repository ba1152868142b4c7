"""Operator 4, language-model scoring with a weighted backoff automaton.

The model gives a word w after a history h

    P(w | h) = (c(hw) + MU * P(w | h')) / (c(h) + MU),

h' being h without its oldest word and P(w) the add-one unigram.  It is smoothed
towards shorter histories and sums to one over known words and one unknown.  As
an automaton: a state for each history seen in training, an arc for each word
seen after it, weighted log10 P(w | h), and a failure arc to the state of h'
weighted log10(MU / (c(h) + MU)).  A text is scored in one traversal from left
to right that carries its state: take the word's arc, or failure arcs until
there is one.  An arc leads to one state whatever came before, and a shard's
tokens know which n-grams end there, so a worker finds each token's arc by the
n-gram's number, its state from the arc before, and moves all tokens at once.

No worker ever holds the whole model.  Documents are dealt into shards of at
most ``SHARD_BYTES``; a shard sends its distinct n-grams, with what they count
in its training texts, as packed arrays to hash buckets; a bucket adds them up
over all shards and answers each shard in its own order; a shard then builds the
part of the automaton that its texts can reach.  An n-gram costs one entry a
shard however common it is, so no hot word or pair makes a large task.

Words are known by 64-bit hashes, longer n-grams by their bucket and 40 more
bits (two of a bucket's clash with odds of about one in a million each).

Edge cases: null and empty texts are one end token; rows without id are scored
but not learned from, held_out false; repeated rows count and are scored each;
an empty table gives no rows; without training text N and V are 0 and every
token has probability 1; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sftforge.llm.buckets import group_bounds
from sftforge.llm.common import (PrefixHash, documents, lowered, materialize, mix, prepare, release, sliced,
                                 text_bytes, words)

ORDER, MU = 3, 50.0
MODULUS, HELD = 7, 2
SHARD_BYTES = 8 << 20
# Texts are hashed in slices of so many bytes: a byte takes some 60 of memory meanwhile.
SLICE_BYTES = 1 << 19
# So many tokens go through the automaton at a time, with some 100 bytes each.
STEP_TOKENS = 1 << 17
BUCKET_BYTES = 16 << 20
_U = np.uint64
_START, _END = _U(0x5354415254), _U(0x454E44)


def _remainder() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % MODULUS


def rows_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.coalesce(_remainder() != HELD, F.lit(False)).alias("train"),
                       F.coalesce(_remainder() == HELD, F.lit(False)).alias("held_out"),
                       F.spark_partition_id().alias("part"))


def shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Number the slices of a partition by shards of about ``most`` text bytes; the same in every pass."""
    held, number = 0, 0
    for batch in sliced(batches, limit=min(most, SLICE_BYTES)):
        size = int(text_bytes(batch.column("text"))[1][-1])
        if held and held + size > most:
            held, number = 0, number + 1
        held += size
        yield (batch.column("part")[0].as_py() << 32) + number, batch


class Grams:
    """The tokens of a shard's texts, each text behind a start mark, and its distinct n-grams.

    ``place[k]``: for each token the number of the (k + 1)-gram that ends there,
    -1 if its text begins later (a lone start mark is no gram).  ``keys[k]`` and
    ``bucket[k]``: the grams, by bucket and key (``sending``; else just their
    number, ``n[k]``).  ``at[k]``: a token where each ends.  ``end``: the end
    token's number among the words, None without one.  Numbers take 32 bits.
    """

    def __init__(self, columns: list[pa.Array], order: int, buckets: int, sending: bool = True):
        tokens, sizes = [], []
        for column in columns:
            data, offsets = text_bytes(column)
            data = lowered(data)
            starts, ends, row = words(data, offsets)
            size = np.bincount(row, minlength=len(offsets) - 1) + 2
            last = np.cumsum(size) - 1
            all_ = np.empty(int(size.sum()), _U)
            word = np.ones(len(all_), bool)
            word[last] = word[last - size + 1] = False
            all_[word] = PrefixHash(data).of(starts, ends)
            all_[last], all_[last - size + 1] = _END, _START
            tokens.append(all_)
            sizes.append(size)
        tokens, sizes = np.concatenate(tokens), np.concatenate(sizes)
        self.docs, self.size = len(sizes), sizes - 1
        self.first = np.cumsum(sizes) - sizes
        self.row = np.repeat(np.arange(self.docs, dtype=np.int32), sizes)
        self.depth = np.arange(len(tokens), dtype=np.int32) - np.repeat(self.first.astype(np.int32), sizes)
        self.place, self.keys, self.bucket, self.at, self.n = [], [], [], [], []
        gram = tokens
        for k in range(order):
            if k:
                gram = np.append(_START, gram[:-1])
                gram *= _U(0x9E3779B97F4A7C15)
                gram += tokens
                gram = mix(gram)
            live = np.flatnonzero(self.depth >= max(k, 1)).astype(np.int32)
            sort = gram[live]
            if k:
                bucket = ((sort >> _U(32)) * _U(buckets)) >> _U(32)
                sort &= _U((1 << 40) - 1)
                bucket <<= _U(40)
                sort |= bucket
                del bucket
            by = np.argsort(sort, kind="stable").astype(np.int32)
            sort = sort[by]
            new = np.ones(len(sort), bool)
            np.not_equal(sort[1:], sort[:-1], out=new[1:])
            place = np.full(len(gram), -1, np.int32)
            place[live[by]] = np.cumsum(new, dtype=np.int32) - 1
            self.place.append(place)
            self.at.append(live[by[new]])
            del live, by
            keys = sort[new]
            del sort, new
            self.n.append(len(keys))
            if k == 0:
                end = np.flatnonzero(keys == _END)
                self.end = int(end[0]) if len(end) else None
            if sending:
                self.bucket.append(((((keys >> _U(32)) * _U(buckets)) >> _U(32)) if k == 0 else keys >> _U(40)).astype(np.int32))
                self.keys.append(keys if k == 0 else keys & _U((1 << 40) - 1))


def _packed(values: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs."""
    size = np.min_scalar_type(int(values.max(initial=0))).itemsize
    return values.astype(f"<u{size}").tobytes()


def _unpacked(data: bytes, n: int) -> np.ndarray:
    size = len(data) // n
    return np.frombuffer(data, f"<u{size}").astype(np.int32 if size < 4 else np.int64)


def _key_bytes(keys: np.ndarray, level: int) -> bytes:
    raw = keys.astype("<u8")
    return raw.tobytes() if level == 0 else np.ascontiguousarray(raw.view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _keys(data: bytes, level: int) -> np.ndarray:
    if level == 0:
        return np.frombuffer(data, "<u8")
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def counted(rows: DataFrame, order: int, buckets: int, shard_bytes: int) -> DataFrame:
    """(level, bucket, shard, data) for each shard: what the corpus' training texts count of its n-grams."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(shard, held):
            release()
            grams = Grams([b.column("text") for b in held], order, buckets)
            train = np.concatenate([b.column("train").to_numpy(zero_copy_only=False) for b in held])
            learned = train[grams.row]
            out = {"level": [], "bucket": [], "keys": [], "counts": []}
            for k in range(order):
                use = grams.place[k][learned]
                count = np.bincount(use[use >= 0], minlength=grams.n[k])
                first, last = group_bounds([grams.bucket[k]])
                for s, e in zip(first.tolist(), last.tolist()):
                    out["level"].append(k)
                    out["bucket"].append(int(grams.bucket[k][s]))
                    out["keys"].append(_key_bytes(grams.keys[k][s:e], k))
                    out["counts"].append(_packed(count[s:e]))
            n = len(out["level"])
            return pa.RecordBatch.from_arrays(
                [pa.array(out["level"], pa.int32()), pa.array(out["bucket"], pa.int32()), pa.array([shard] * n, pa.int64()),
                 pa.array(out["keys"], pa.binary()), pa.array(out["counts"], pa.binary())],
                names=["level", "bucket", "shard", "keys", "counts"])

        now, held = None, []
        for shard, batch in shards(batches, shard_bytes):
            if held and shard != now:
                yield close(now, held)
                held = []
            now = shard
            held.append(batch)
        if held:
            yield close(now, held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(level, bucket, parts):
            keys = [_keys(k, level) for _, k, _ in parts]
            sizes = [len(k) for k in keys]
            distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(inverse, np.concatenate([_unpacked(c, n) for (_, _, c), n in zip(parts, sizes)]),
                                minlength=len(distinct)).astype(np.int64)
            answers = np.split(total[inverse], np.cumsum(sizes)[:-1])
            n = len(parts)
            known = [int((total > 0).sum()) if level == 0 and i == 0 else 0 for i in range(n)]
            seen = [int(total.sum()) if level == 0 and i == 0 else 0 for i in range(n)]
            return pa.RecordBatch.from_arrays(
                [pa.array([level] * n, pa.int32()), pa.array([bucket] * n, pa.int32()), pa.array([s for s, _, _ in parts], pa.int64()),
                 pa.array([_packed(a) for a in answers], pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(known, pa.int64()), pa.array(seen, pa.int64())],
                names=["level", "bucket", "shard", "data", "n", "known", "seen"])

        now, parts = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                own = (batch.column("level")[i].as_py(), batch.column("bucket")[i].as_py())
                if parts and own != now:
                    yield close(*now, parts)
                    parts = []
                now = own
                parts.append((batch.column("shard")[i].as_py(), batch.column("keys")[i].as_py(), batch.column("counts")[i].as_py()))
        if parts:
            yield close(*now, parts)

    sent = rows.mapInArrow(send, "level int, bucket int, shard long, keys binary, counts binary")
    return (sent.repartition(order * buckets, "level", "bucket").sortWithinPartitions("level", "bucket")
            .mapInArrow(add, "level int, bucket int, shard long, data binary, n long, known long, seen long"))


class Automaton:
    """The states and arcs that a shard's texts can reach, with log10 weights.

    ``arcs[k]``: the arc of each (k + 1)-gram, from the state of its history, -1
    if training lacks it (a word always has one, from the root); a last -1 stands
    for no gram.  ``weights`` and ``nexts``: of each arc.  ``fail``,
    ``fail_weight`` and ``depth`` (words of the history): of each state.
    """

    ROOT, BEGIN = 0, 1

    def __init__(self, grams: Grams, counts: list[np.ndarray], tokens: int, known: int, mu: float):
        order = len(counts)
        texts = int(counts[0][grams.end]) if grams.end is not None else 0  # training texts: starts as many as ends
        self.begin = self.BEGIN if texts and order > 1 else self.ROOT
        p = (counts[0].astype(np.float64) + 1) / (tokens + (known + 1))
        self.base = np.log10(p)
        # States: the root, a text's start, then the histories of each length that training has.
        state, fail, fail_weight, n = [], [np.array([0, 0], np.int32)], [np.array([0.0, np.log10(mu / (texts + mu))])], 2
        depth = [np.array([0, 1], np.int8)]
        for j in range(order - 1):
            seen = counts[j] > 0
            number = np.where(seen, n + np.cumsum(seen, dtype=np.int32) - 1, self.ROOT).astype(np.int32)
            n += int(seen.sum())
            shorter = state[j - 1][grams.place[j - 1][grams.at[j]]] if j else np.zeros(len(seen), np.int32)
            state.append(number)
            fail.append(shorter[seen])
            fail_weight.append(np.log10(mu / (counts[j][seen] + mu)))
            depth.append(np.full(len(fail[-1]), j + 1, np.int8))
        self.fail, self.fail_weight, self.depth = np.concatenate(fail), np.concatenate(fail_weight), np.concatenate(depth)
        self.arcs, n = [np.append(np.arange(len(p), dtype=np.int32), np.int32(-1))], len(p)
        weights, nexts = [self.base], [state[0] if order > 1 else np.zeros(len(p), np.int32)]
        for k in range(1, order):
            at = grams.at[k]
            before = grams.place[k - 1][at - 1]
            start = before < 0  # only pairs begin with the start mark alone
            history = np.where(start, float(texts), counts[k - 1][before].astype(np.float64))
            p = (counts[k] + mu * p[grams.place[k - 1][at]]) / (history + mu)
            del history, before, start
            seen = counts[k] > 0
            self.arcs.append(np.append(np.where(seen, n + np.cumsum(seen, dtype=np.int32) - 1, np.int32(-1)), np.int32(-1)))
            n += int(seen.sum())
            weights.append(np.log10(p[seen]))
            j = min(k, order - 2)
            nexts.append(state[j][grams.place[j][at[seen]]])
        del p, state
        self.weights, self.nexts = np.concatenate(weights), np.concatenate(nexts)

    def scores(self, grams: Grams) -> np.ndarray:
        """log10 probability of each text: all tokens of a shard go through the automaton together.

        A token's arc is that of the longest gram seen that ends there: who sees a
        gram sees its history, so the traversal is in that history's state or a
        longer one, and falls back to it.  The arc before thus tells the state.
        """
        arc, level = self.arcs[0][grams.place[0]], np.zeros(len(grams.row), np.int8)
        for k in range(1, len(self.arcs)):
            own = self.arcs[k][grams.place[k]]
            hit = own >= 0
            arc[hit] = own[hit]
            level[hit] = k
        out = np.zeros(grams.docs)
        tokens = np.flatnonzero(grams.depth)
        for s in range(0, len(tokens), STEP_TOKENS):
            at = tokens[s:s + STEP_TOKENS]
            state = np.where(grams.depth[at] == 1, self.begin, self.nexts[arc[at - 1]])
            # A token's weights in their order, so that a text's sum is that of one traversal from left to right.
            weight = np.zeros((len(at), len(self.arcs)))
            todo = np.flatnonzero(self.depth[state] > level[at])
            for k in range(len(self.arcs) - 1):
                weight[todo, k] = self.fail_weight[state[todo]]
                state[todo] = self.fail[state[todo]]
                todo = todo[self.depth[state[todo]] > level[at[todo]]]
            weight[:, -1] = self.weights[arc[at]]
            np.add.at(out, np.repeat(grams.row[at], len(self.arcs)), weight.ravel())
        return out


def lm_scores(docs: DataFrame, order: int = ORDER, mu: float = MU, shard_bytes: int = SHARD_BYTES,
              buckets: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of a stored table."""
    if order < 1 or mu <= 0:
        raise ValueError("order must be at least 1 and mu above 0")
    prepare(docs.sparkSession)
    rows = rows_of(docs)
    if buckets is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(64, int(size) // BUCKET_BYTES)
    answers = materialize(counted(rows, order, buckets, shard_bytes), "lm-counts")
    total = answers.agg(F.sum("known").alias("known"), F.sum("seen").alias("seen")).first()
    known, tokens = total["known"] or 0, total["seen"] or 0

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, batch in shards(batches, shard_bytes):
            yield pa.RecordBatch.from_arrays([pa.array([shard] * batch.num_rows, pa.int64()), *[batch.column(k) for k in ("doc_id", "text", "held_out")]],
                                             names=["shard", "doc_id", "text", "held_out"])

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(held, parts):
            release()
            grams = Grams([b.column("text") for b in held], order, buckets, sending=False)
            counts = []
            for k in range(order):
                own = [_unpacked(d, n) for level, d, n in parts if level == k]
                counts.append(np.concatenate(own) if own else np.zeros(0, np.int64))
                if len(counts[k]) != grams.n[k]:
                    raise RuntimeError("a shard's texts differ between two reads of the input")
            auto = Automaton(grams, counts, tokens, known, mu)
            scored = grams.depth > 0
            place, row = grams.place[0][scored], grams.row[scored]
            base = np.bincount(row, auto.base[place], minlength=grams.docs)
            n_known = np.bincount(row, counts[0][place] > 0, minlength=grams.docs).astype(np.int64)
            cat = lambda c: pa.concat_arrays([b.column(c) for b in held])
            return pa.RecordBatch.from_arrays(
                [cat("doc_id"), cat("held_out"), pa.array(grams.size), pa.array(n_known),
                 pa.array(np.full(grams.docs, tokens, np.int64)), pa.array(base), pa.array(auto.scores(grams))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        now, held, parts = None, [], []
        for batch in batches:
            first, last = group_bounds([batch.column("shard").to_numpy()])
            for s, e in zip(first.tolist(), last.tolist()):
                own = batch.column("shard")[s].as_py()
                if own != now and held:
                    yield close(held, parts)
                if own != now:
                    now, held, parts = own, [], []
                run = batch.slice(s, e - s)
                answer = run.filter(run.column("data").is_valid())
                parts += zip(answer.column("level").to_pylist(), answer.column("data").to_pylist(), answer.column("n").to_pylist())
                texts = run.filter(run.column("data").is_null())
                held += sliced(iter([texts]), limit=SLICE_BYTES)
        if held:
            yield close(held, parts)

    texts = (rows.mapInArrow(deal, "shard long, doc_id long, text string, held_out boolean")
             .selectExpr("shard", "CAST(NULL AS INT) AS level", "CAST(NULL AS INT) AS bucket", "CAST(NULL AS BINARY) AS data",
                         "CAST(NULL AS LONG) AS n", "doc_id", "text", "held_out"))
    counts = answers.selectExpr("shard", "level", "bucket", "data", "n", "CAST(NULL AS LONG) AS doc_id",
                                "CAST(NULL AS STRING) AS text", "CAST(NULL AS BOOLEAN) AS held_out")
    return (texts.unionByName(counts).repartition(buckets, "shard")
            .sortWithinPartitions("shard", F.col("level").asc_nulls_last(), "bucket")
            .mapInArrow(traverse, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                  "base_score double, score double"))


def op4_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir))
