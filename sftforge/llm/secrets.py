"""Operator 6, secret scans: base patterns and a linear-chain conditional random field.

The base finds assignments, access keys and long hexadecimal runs by patterns.
The field tags the words of each line as begin, inside or outside of a secret
and adds spans that the base doesn't have.  A word is seen by its shape (length,
digits, letter case, signs, hexadecimal only, non-ASCII), what stands between it
and the word before, the words before and after it, and two features of its file
(how many of its words hold digits, how many signs of assignment it has).  Lines
are decoded by Viterbi, all lines of a slice in step.

The weights are learned from the base's own findings: likelihood by forward and
backward sums on at most ``WINDOWS`` stretches of ``STRETCH`` words that hold a
finding and as many that hold none, those of the smallest hashes of document,
line and stretch.  Beside them it learns from about ``VARIED`` copies of stretches
with a finding, in which the word before the secret, what stands between and the
secret's own shape are drawn anew (:func:`varied`), so that it doesn't repeat the
patterns but finds what is made like a secret where they don't look.  Without
findings the field adds nothing.

Edge cases: null and empty texts have no spans; null ids pass through; repeated
rows are each scanned; long texts and lines are scanned whole; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftforge.llm.common import PrefixHash, documents, lowered, materialize, mix, prepare, sliced, spread, text_bytes, words

#: Fixed patterns of the base; the assignment's value is group 2.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "crf")
LEAST = {"assign": 6, "access": 20, "hex": 24}
WINDOWS, STRETCH, VARIED = 1500, 32, 2000
WORD_ROOM = 1 << 12
OUT, BEGIN, INSIDE = 0, 1, 2
_NEVER = -1e9
_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_HEX_MAP = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))

#: A word: letters, digits, non-ASCII signs and the signs that secrets are made of, but those of assignment.
BREAKS = np.ones(256, bool)
BREAKS[48:58] = BREAKS[65:91] = BREAKS[97:123] = BREAKS[128:] = False
BREAKS[[ord(c) for c in "+/_.-"]] = False


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, value's start), by start, then kind."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYS):
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    if b"x" * LEAST["hex"] in text.encode().translate(_HEX_MAP):
        out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return sorted(out)


def span_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


# ---------------------------------------------------------------- features

SHAPES, GAPS, FILES = 6 * 4 * 3 * 2 * 2 * 2, 6, 16


class Words:
    """The words of a slice of texts with their features, and the lines that they make up."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = text_bytes(column)
        data = self.data
        self.start, self.end, self.row = words(data, self.offsets, BREAKS)
        n = len(self.start)
        sums = lambda mask: np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        digit = (data >= 48) & (data < 58)
        upper = (data >= 65) & (data < 91)
        counts = {}
        for name, mask in (("digit", digit), ("upper", upper), ("sign", np.isin(data, [ord(c) for c in "+/_.-"])),
                           ("wide", data >= 128), ("hex", digit | ((data >= 97) & (data < 103)))):
            upto = sums(mask)
            counts[name] = upto[self.end] - upto[self.start]
        size = self.end - self.start
        length = np.searchsorted([3, 6, 12, 20, 32], size, "right")
        share = np.searchsorted([0.0001, 0.3, 0.7], counts["digit"] / np.maximum(size, 1), "right")
        case = np.where(counts["upper"] == 0, 0, np.where((counts["upper"] == 1) & upper[self.start], 1, 2)) if n else size
        shape = shape_of(length, share, case, counts["sign"] > 0, counts["wide"] > 0, counts["hex"] == size)
        # Between a word and the one before it in its text: nothing, blanks, quotes, assignment, line end, other signs.
        blank, feed = sums((data == 32) | (data == 9)), sums(data == 10)
        quote, equal = sums((data == 34) | (data == 39)), sums((data == 61) | (data == 58))
        before = np.where(np.append(-1, self.row[:-1])[:n] == self.row, np.append(0, self.end[:-1])[:n], self.offsets[self.row]) if n else size
        inside = lambda upto: upto[self.start] - upto[before]
        gap = np.select([inside(feed) > 0, inside(equal) > 0, inside(quote) > 0, self.start == before, inside(blank) == self.start - before],
                        [4, 3, 2, 0, 1], 5) if n else size
        new_line = np.ones(n, bool)
        new_line[1:] = (self.row[1:] != self.row[:-1]) | (inside(feed)[1:] > 0) if n else False
        self.line = np.flatnonzero(new_line)
        self.line_size = np.diff(np.append(self.line, n))
        h = (PrefixHash(lowered(data)).of(self.start, self.end) % np.uint64(WORD_ROOM - 1)).astype(np.int64) + 1
        prev, after = np.append(0, h[:-1])[:n], np.append(h[1:], 0)[:n]
        prev[new_line] = 0
        after[np.append(new_line[1:], True)[:n]] = 0
        # Features of the file, the same for all its words.
        rows = len(self.offsets) - 1
        per = np.maximum(np.bincount(self.row, minlength=rows), 1)
        numeric = np.searchsorted([0.002, 0.02, 0.2], np.bincount(self.row, counts["digit"] > 0, minlength=rows) / per, "right")
        signs = np.searchsorted([0.0005, 0.005, 0.05], (equal[self.offsets[1:]] - equal[self.offsets[:-1]]) / per, "right")
        #: Rows of feature numbers, one family each.
        self.features = np.stack([shape, gap, prev, after, (numeric * 4 + signs)[self.row]]).astype(np.int64)


FAMILIES = (SHAPES, GAPS, WORD_ROOM, WORD_ROOM, FILES)


class Field:
    """Weights of a linear chain over begin, inside and outside."""

    def __init__(self, weights: list[np.ndarray], steps: np.ndarray):
        self.weights = weights  # per family: feature x label
        self.steps = steps.copy()  # label before x label
        self.steps[OUT, INSIDE] = _NEVER

    def emissions(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((*features.shape[1:], 3))
        for weight, number in zip(self.weights, features):
            out += weight[number]
        return out

    def viterbi(self, emission: np.ndarray, line: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Best label of each word; lines go word by word, all in step."""
        label = np.zeros(len(emission), np.int8)
        back = np.zeros((len(emission), 3), np.int8)
        order = np.argsort(-size, kind="stable")
        first, size = line[order], size[order]
        if not len(first):
            return label
        score = emission[first].copy()
        score[:, INSIDE] += _NEVER
        last = np.zeros(len(first), np.int8)
        live = len(first)
        for step in range(1, int(size[0])):
            on = int(np.searchsorted(-size[:live], -step, "left"))
            last[on:live] = score[on:live].argmax(axis=1)
            live = on
            ways = score[:live, :, None] + self.steps[None]
            back[first[:live] + step] = ways.argmax(axis=1)
            score[:live] = ways.max(axis=1) + emission[first[:live] + step]
        last[:live] = score[:live].argmax(axis=1)
        now = last.copy()
        live = 0
        for step in range(int(size[0]) - 1, -1, -1):
            live = int(np.searchsorted(-size, -step, "left"))
            at = first[:live] + step
            label[at] = now[:live]
            now[:live] = back[at, now[:live]]
        return label


def learn(features: np.ndarray, label: np.ndarray, real: np.ndarray, rounds: int = 50, rate: float = 0.5,
          ridge: float = 2e-4) -> Field:
    """Maximum likelihood by adaptive gradient steps.  features: family x window x word; real: words that are there.

    Windows begin at word 0; words that aren't there come last and are outside.
    """
    windows, size = label.shape
    weights = [np.zeros((n, 3)) for n in FAMILIES]
    steps = np.zeros((3, 3))
    total = [np.zeros_like(w) for w in (*weights, steps)]
    hot = (label[..., None] == np.arange(3)).astype(float) * real[..., None]
    pairs = np.zeros((3, 3))
    both = real[:, 1:]
    np.add.at(pairs, (label[:, :-1][both], label[:, 1:][both]), 1)
    for _ in range(rounds):
        field = Field(weights, steps)
        e = field.emissions(features)
        e[~real] = [0, _NEVER, _NEVER]
        e[:, 0, INSIDE] = _NEVER
        t = field.steps
        forward = np.empty_like(e)
        forward[:, 0] = e[:, 0]
        for k in range(1, size):
            x = forward[:, k - 1, :, None] + t
            m = x.max(axis=1)
            forward[:, k] = m + np.log(np.exp(x - m[:, None]).sum(axis=1)) + e[:, k]
        backward = np.zeros_like(e)
        for k in range(size - 2, -1, -1):
            x = t + (e[:, k + 1] + backward[:, k + 1])[:, None, :]
            m = x.max(axis=2)
            backward[:, k] = m + np.log(np.exp(x - m[..., None]).sum(axis=2))
        m = forward[:, -1].max(axis=1)
        z = m + np.log(np.exp(forward[:, -1] - m[:, None]).sum(axis=1))
        p = np.exp(forward + backward - z[:, None, None])
        off = (hot - p) * real[..., None]
        grads = [np.stack([np.bincount(number.ravel(), off[..., y].ravel(), minlength=len(w)) for y in range(3)], axis=1)
                 for w, number in zip(weights, features)]
        q = np.exp(forward[:, :-1, :, None] + t + (e[:, 1:] + backward[:, 1:])[:, :, None, :] - z[:, None, None, None])
        grads.append(pairs - (q * both[..., None, None]).sum(axis=(0, 1)))
        for w, g, s in zip((*weights, steps), grads, total):
            g -= ridge * windows * w
            s += g * g
            w += rate * g / np.sqrt(s + 1e-8)
    return Field(weights, steps)


def shape_of(length, share, case, sign, wide, hexadecimal):
    """The number of a shape: classes of length and of digits' share, letter case, and three marks."""
    shape = length
    for value, room in ((share, 4), (case, 3), (sign, 2), (wide, 2), (hexadecimal, 2)):
        shape = shape * room + value
    return shape


def varied(features: np.ndarray, label: np.ndarray, real: np.ndarray, most: int = VARIED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows, and copies of those that hold a secret, ``most`` in all, its looks and its surroundings drawn anew (always alike).

    Drawn are, for a secret's words: a shape of letters and digits, or of both cases
    with signs, or hexadecimal, of 12 characters or more after a sign of assignment
    and 20 or more elsewhere; what stands before the secret (a blank, a quote, an
    assignment); and the words before and after it, any at all.  As many windows
    without a secret are copied, in which some ordinary word stands after a quote or
    an assignment, behind any word.  Words that begin a line stay without a word before.
    """
    rng = np.random.default_rng(20)
    have = (label > 0).any(axis=1)
    some, none = np.flatnonzero(have), np.flatnonzero(~have)
    out = [(features, label, real)]
    any_word = lambda n: rng.integers(1, WORD_ROOM, n)
    for _ in range(most // max(1, len(some))):
        f, y, r = features[:, some].copy(), label[some], real[some]
        w, k = np.nonzero(y == BEGIN)
        f[1, w, k] = np.where(k > 0, rng.choice([1, 2, 3], len(w)), f[1, w, k])
        f[2, w, k] = np.where(k > 0, any_word(len(w)), 0)
        assigned = np.zeros(y.shape, bool)
        assigned[w, k] = f[1, w, k] == 3
        w, k = np.nonzero(y > 0)
        f[3, w, k] = np.where(f[3, w, k] > 0, any_word(len(w)), 0)
        kind = rng.integers(0, 4, len(w))  # lower case and digits, both cases, both with signs, hexadecimal
        least = np.where(assigned[w, k], 3, 4)
        f[0, w, k] = shape_of(least + rng.integers(0, 6 - least), rng.integers(1, np.where(kind == 3, 4, 3)), np.isin(kind, (1, 2)) * 2, kind == 2, 0, kind == 3)
        out.append((f, y, r))
        if len(none):
            w = rng.choice(none, len(some))
            f, k = features[:, w].copy(), rng.integers(0, real[w].sum(axis=1))
            at = np.flatnonzero(k > 0)
            f[1, at, k[at]], f[2, at, k[at]] = rng.choice([2, 3], len(at)), any_word(len(at))
            out.append((f, label[w], real[w]))
    return tuple(np.concatenate(parts, axis=int(i == 0)) for i, parts in enumerate(zip(*out)))


# ---------------------------------------------------------------- Spark jobs

def hash_bound(rows: DataFrame, n: int) -> int:
    """A value of ``hash`` (long) up to which the n smallest lie and few others, by exact counts of ever finer ranges.

    All rows lie up to it if they are no more than n.  Each range counted holds a
    row, so the first n of them reach the n-th hash: a step sends the driver n rows.
    """
    low, high, before = -(1 << 63), (1 << 63) - 1, 0
    for shift in (48, 32, 16, 0):
        counts = (rows.where(F.col("hash").between(low, high)).groupBy(F.shiftright("hash", shift).alias("range"))
                  .agg(F.count(F.lit(1)).alias("n")).orderBy("range").limit(n).collect())
        for r in counts:
            if before + r["n"] >= n:
                break
            before += r["n"]
        else:
            return high
        low, high = r["range"] << shift, (r["range"] + 1 << shift) - 1
        if before + r["n"] <= 2 * n:
            break
    return high


def train(docs: DataFrame, windows: int = WINDOWS, stretch: int = STRETCH) -> Field | None:
    """The field from stretches of words of ``docs``; None where the base finds nothing."""
    prepare(docs.sparkSession)
    rows = docs.select(F.xxhash64("doc_id", "text").alias("hash"), F.col("text").cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            w = Words(batch.column("text"))
            label = np.zeros(len(w.start), np.int8)
            first = np.searchsorted(w.row, np.arange(len(w.offsets)))
            for r, text in enumerate(batch.column("text").to_pylist()):
                found = base_spans(text or "")
                if not found:
                    continue
                lead = np.flatnonzero((w.data[w.offsets[r]:w.offsets[r + 1]] & 0xC0) != 0x80)
                byte = np.append(lead, w.offsets[r + 1] - w.offsets[r]) + w.offsets[r]
                for _, _, end, value in found:
                    a, z = byte[value], byte[end]
                    hit = first[r] + np.flatnonzero((w.start[first[r]:first[r + 1]] < z) & (w.end[first[r]:first[r + 1]] > a))
                    label[hit] = INSIDE
                    label[hit[:1]] = BEGIN
            # Lines in stretches; a stretch that begins inside a secret is left out.
            count = -(-w.line_size // stretch)
            line, k = spread(count)
            start = w.line[line] + k * stretch
            size = np.minimum(w.line_size[line] - k * stretch, stretch)
            good = label[start] != INSIDE if len(start) else np.zeros(0, bool)
            start, size = start[good], size[good]
            some = np.add.reduceat(np.append(label > 0, False), start) if len(start) else start
            upto = np.concatenate([[0], np.cumsum(label > 0)])
            some = upto[start + size] > upto[start]
            h = batch.column("hash").to_numpy().view(np.uint64)
            order = mix(h[w.row[start]] + start.astype(np.uint64) - w.start[first[w.row[start]]].astype(np.uint64) if len(start) else start)
            # Only the smallest hashes of this slice can be among the smallest of all.
            keep = np.concatenate([np.flatnonzero(some == v)[np.argsort(order[some == v])[:windows]] for v in (False, True)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(some[keep].astype(bool)), pa.array(order[keep].view(np.int64)),
                 pa.array([label[s:s + n].tolist() for s, n in zip(start[keep], size[keep])], pa.list_(pa.int32())),
                 pa.array([w.features[:, s:s + n].ravel().tolist() for s, n in zip(start[keep], size[keep])], pa.list_(pa.int32()))],
                names=["some", "hash", "label", "features"])

    found = materialize(rows.mapInArrow(cut, "some boolean, hash long, label array<int>, features array<int>"), "secret-stretches")
    got = []
    for v in (True, False):
        # The bound first, so that tasks send the driver little more than is taken.
        rows = found.where(F.col("some") == v)
        got += rows.where(F.col("hash") <= F.lit(hash_bound(rows, windows))).orderBy("hash", "features").limit(windows).collect()
    if not any(r["some"] for r in got):
        return None
    features = np.zeros((len(FAMILIES), len(got), stretch), np.int64)
    label, real = np.zeros((len(got), stretch), np.int64), np.zeros((len(got), stretch), bool)
    for i, r in enumerate(got):
        n = len(r["label"])
        label[i, :n], real[i, :n] = r["label"], True
        features[:, i, :n] = np.array(r["features"]).reshape(len(FAMILIES), n)
    return learn(*varied(features, label, real))


def scan(docs: DataFrame, field: Field | None) -> DataFrame:
    """doc_id, spans (structs kind, start, end; code points, by start, then kind; the field's as kind crf) of each row."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [[(s, k, e) for s, k, e, _ in base_spans(t or "")] for t in batch.column("text").to_pylist()]
            if shared.value is not None:
                for r, s, e in tagged(shared.value, batch.column("text")):
                    if all(e <= a or z <= s for a, k, z in found[r] if k < 3):
                        found[r].append((s, 3, e))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([[{"kind": KINDS[k], "start": s, "stop": e} for s, k, e in sorted(f)] for f in found], kind)],
                names=["doc_id", "spans"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, spans array<struct<kind string, start long, stop long>>"))


def tagged(field: Field, column: pa.Array) -> list[tuple[int, int, int]]:
    """(row, start, end) in code points of the spans that the field finds."""
    w = Words(column)
    label = field.viterbi(field.emissions(w.features), w.line, w.line_size)
    begin = np.flatnonzero(label == BEGIN)
    if not len(begin):
        return []
    other = np.append(np.flatnonzero(label != INSIDE), len(label))  # a span ends before the next word that isn't inside it
    last = other[np.searchsorted(other, begin, "right")] - 1
    upto = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
    base = upto[w.offsets[w.row[begin]]]
    return list(zip(w.row[begin].tolist(), (upto[w.start[begin]] - base).tolist(), (upto[w.end[last]] - base).tolist()))


def op6_crf_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = scan(docs, train(docs))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
