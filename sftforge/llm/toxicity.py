"""Operator 7, toxicity by two class-conditional Kneser-Ney bigram models.

One model is learned from toxic, one from ordinary labelled texts.  Both give a
word after a context by discounted counts of their own class and pass the mass
they take off to the class's word distribution, and from there to continuation
counts (in how many contexts a word stands) that both classes share.  Rare
expressions therefore weigh alike in both, and only what one class really uses
more often tells them apart.  A text is compared by its log-likelihood ratio,
normalised by its length: the mean over its words of the ratio beyond
``MARGIN``, so that the many words that hardly differ do not drown the few that
do, and the plain mean beside it.  A logistic curve, fitted on labelled rows
kept from the counts, turns both into a score.

Learned from at most ``MOST`` labelled rows a class (those of the smallest id
hashes).  Counting and scoring are Spark jobs; the driver gets the expressions
seen more often than the discount, a number bounded by the sample.

Edge cases: null and empty texts have no words and get the curve's value at
zero evidence; rows without id are scored but never learned from; repeated rows
are scored each for itself, and of rows of one id one is learned from; several labels of an id: the highest holds; without
labelled rows of both classes every score is that of zero evidence under
``DEFAULT``; other columns are ignored (``keep_ordinary`` returns them all).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sftforge.llm.common import (WORD_BREAK, PrefixHash, documents, lowered, materialize, mix,
                                 prepare, sliced, text_bytes, words)

MOST = 20_000
DISCOUNT, PAIR_DISCOUNT = 1.0, 8.0
MARGIN = 2.5
HOLD_OUT, CALIBRATE = 5, 4
#: Curve where too few labelled rows are kept back to fit one: bias, then weights of root excess, excess, mean.
DEFAULT = np.array([-4.0, 24.0, 0.0, 0.0])
_START = np.uint64(1)

#: White space and the ASCII signs that border words.
BREAKS = WORD_BREAK.copy()
BREAKS[[ord(c) for c in ".,;:!?\"()[]{}"]] = True


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Hash of each word, of the word before it in its text (or the start mark), and its row."""
    data, offsets = text_bytes(column)
    data = lowered(data)
    starts, ends, row = words(data, offsets, BREAKS)
    w = PrefixHash(data).of(starts, ends)
    before = np.empty_like(w)
    if len(w):
        before[0], before[1:] = _START, w[:-1]
        before[1:][row[1:] != row[:-1]] = _START
    return w, before, row, len(offsets) - 1


def pair(before: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + w)


def crc(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string"))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that nothing is learned from (null ids among them)."""
    return F.coalesce(crc(id_col) % HOLD_OUT == 0, F.lit(True))


def sample(labels: DataFrame, most: int = MOST) -> DataFrame:
    """(doc_id, toxic, fit): at most ``most`` rows a class; ``fit`` false: kept for the curve."""
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
            .where(F.col("toxic").isin(0, 1)).where(~held_out())
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    parts = [rows.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for c in (0, 1)]
    fit = F.floor(crc("doc_id") / HOLD_OUT) % CALIBRATE != 0
    return parts[0].unionByName(parts[1]).withColumn("fit", fit)


def pair_counts(labelled: DataFrame) -> DataFrame:
    """(u, w, c0, c1): how often word w follows u in each class, over rows (text, toxic)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            w, u, row, _ = word_hashes(batch.column("text"))
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)[row]
            _, first, inverse = np.unique(pair(u, w), return_index=True, return_inverse=True)
            c = [np.bincount(inverse[toxic == k], minlength=len(first)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[first].view(np.int64)) for x in (u, w)] + [pa.array(x.astype(np.int64)) for x in c],
                names=["u", "w", "c0", "c1"])

    return (labelled.mapInArrow(run, "u long, w long, c0 long, c1 long")
            .groupBy("u", "w").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")))


class Ratios:
    """Log-likelihood ratios (toxic to ordinary) of words, contexts and pairs, by hash."""

    def __init__(self, words_: tuple, contexts: tuple, pairs: tuple, unseen: float):
        self.tables = [words_, contexts, pairs]  # (sorted keys, values)
        self.unseen = unseen

    @staticmethod
    def _look(table: tuple, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        have, value = table
        if not len(have):
            return np.zeros(len(keys)), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
        hit = have[at] == keys
        return np.where(hit, value[at], 0.0), hit

    def features(self, column: pa.Array) -> np.ndarray:
        """Rows of (1, root of mean excess, mean excess, mean ratio)."""
        w, u, row, n = word_hashes(column)
        # A slice repeats most words: each distinct one is looked up once.
        distinct, inverse = np.unique(w, return_inverse=True)
        value, hit = self._look(self.tables[0], distinct)
        ratio = np.where(hit, value, self.unseen)[inverse]
        value, _ = self._look(self.tables[1], u)
        ratio += value
        value, hit = self._look(self.tables[2], pair(u, w))
        ratio = np.where(hit, value, ratio)
        count = np.maximum(np.bincount(row, minlength=n), 1)
        excess = np.bincount(row, np.maximum(ratio - MARGIN, 0), minlength=n) / count
        return np.stack([np.ones(n), np.sqrt(excess), excess, np.bincount(row, ratio, minlength=n) / count], axis=1)


def learn(pairs: DataFrame, discount: float = DISCOUNT, pair_discount: float = PAIR_DISCOUNT) -> Ratios:
    """The models' ratios from pair counts; only counts above the discounts come to the driver."""
    pairs = materialize(pairs, "toxic-pairs")
    low = lambda c, d: F.sum(F.least(F.col(c).cast("double"), F.lit(d)))
    single = materialize(pairs.groupBy("w").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"),
                                                F.count(F.lit(1)).alias("contexts")), "toxic-words")
    t = single.agg(F.sum("c0").alias("n0"), F.sum("c1").alias("n1"), low("c0", discount).alias("l0"),
                   low("c1", discount).alias("l1"), F.sum("contexts").alias("k"), F.count(F.lit(1)).alias("v")).first()
    none = (np.zeros(0, np.uint64), np.zeros(0))
    if not t["n0"] or not t["n1"]:
        return Ratios(none, none, none, 0.0)
    n, lam = (t["n0"], t["n1"]), (t["l0"] / t["n0"], t["l1"] / t["n1"])
    shared = lambda k: (k + 1) / (t["k"] + t["v"] + 1)

    def word_p(c, k, cls):
        return np.maximum(c - discount, 0) / n[cls] + lam[cls] * shared(k)

    often = lambda d: (F.col("c0") > d) | (F.col("c1") > d)
    got = single.where(often(discount)).toPandas()
    key = got["w"].to_numpy(np.int64).view(np.uint64)
    value = np.log(word_p(got["c1"].to_numpy(float), got["contexts"].to_numpy(float), 1)
                   / word_p(got["c0"].to_numpy(float), got["contexts"].to_numpy(float), 0))
    by = np.argsort(key)
    word_table = (key[by], value[by])
    # Mass that a context leaves to the words; 1 where no pair of it outlives the discount.
    left = pairs.groupBy("u").agg(F.sum("c0").alias("t0"), F.sum("c1").alias("t1"),
                                  low("c0", pair_discount).alias("l0"), low("c1", pair_discount).alias("l1"))
    left = left.where("l0 < t0 OR l1 < t1")
    ctx = left.toPandas()
    rest = [np.where(ctx[f"t{c}"] > 0, ctx[f"l{c}"] / np.maximum(ctx[f"t{c}"], 1), 1.0) for c in (0, 1)]
    key = ctx["u"].to_numpy(np.int64).view(np.uint64)
    by = np.argsort(key)
    context_table = (key[by], np.log(rest[1] / rest[0])[by])
    two = (pairs.where(often(pair_discount)).join(left, "u")
           .join(single.select("w", F.col("c0").alias("w0"), F.col("c1").alias("w1"), "contexts"), "w").toPandas())
    p = []
    for c in (0, 1):
        total = np.maximum(two[f"t{c}"].to_numpy(float), 1)
        back = np.where(two[f"t{c}"] > 0, two[f"l{c}"] / total, 1.0)
        p.append(np.maximum(two[f"c{c}"].to_numpy(float) - pair_discount, 0) / total
                 + back * word_p(two[f"w{c}"].to_numpy(float), two["contexts"].to_numpy(float), c))
    key = pair(two["u"].to_numpy(np.int64).view(np.uint64), two["w"].to_numpy(np.int64).view(np.uint64))
    by = np.argsort(key)
    return Ratios(word_table, context_table, (key[by], np.log(p[1] / p[0])[by]), float(np.log(lam[1] / lam[0])))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Weights of a logistic curve by Newton steps; DEFAULT if there are too few rows of a class."""
    if min((y == 1).sum(), (y == 0).sum()) < 5:
        return DEFAULT
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - penalty @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w)), grad)
        w = w + step / max(1.0, np.abs(step).max() / 10)
    return w


class Model:
    def __init__(self, ratios: Ratios, curve: np.ndarray):
        self.ratios, self.curve = ratios, curve

    def score(self, column: pa.Array) -> np.ndarray:
        z = self.ratios.features(column) @ self.curve
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, most: int = MOST) -> Model:
    prepare(docs.sparkSession)
    chosen = materialize(sample(labels, most), "toxic-sample")
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .join(chosen, "doc_id").withColumn("text", F.coalesce("text", F.lit("")))
            .groupBy("doc_id", "toxic", "fit").agg(F.min(F.struct(F.sha2("text", 256).alias("digest"), "text"))["text"].alias("text"))
            .select("text", "toxic", "fit"))
    ratios = learn(pair_counts(rows.where("fit").select("text", "toxic")))
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(shared.value.features(batch.column("text")).tolist(), pa.list_(pa.float64()))],
                names=["toxic", "x"])

    kept = rows.where("NOT fit").select("text", "toxic").mapInArrow(run, "toxic int, x array<double>").collect()
    x = np.array([r["x"] for r in kept]).reshape(-1, len(DEFAULT))
    return Model(ratios, fit_curve(x, np.array([r["toxic"] for r in kept], float)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            s = shared.value.score(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])

    scored = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
              .mapInArrow(run, "doc_id long, score double, predicted int"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def keep_ordinary(docs: DataFrame, model: Model) -> DataFrame:
    """The rows, all columns, that are not predicted toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield batch.filter(pa.array(shared.value.score(batch.column("text")) < 0.5))

    return docs.mapInArrow(run, docs.schema)


def op7_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score(docs, train(docs, documents(spark, sf_dir, "labels")))
