"""Scoring, per-model summary, side-by-side pivot and report tables.

E6 score rows, A1-A5 summary, R1-R3 comparison, R5-R7 reports, J3 merge.

Input "answers" table: one row per (model, benchmark item) with columns
``model_name, model_ord, item_seq, id, instruction, reference, keywords, answer``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftforge.functions.scores import (
    RISK_HINT_TOKENS, answer_length, has_risk_hint, keyword_hit_rate, round_score)
from sftforge.functions.similarity import reference_similarity
from sftforge.functions.text import quote

# Per-model cells of a comparison row, and their order in the
# detail report.
PIVOT_METRICS = ("answer", "keyword_hit_rate", "reference_similarity", "has_risk_hint")
DETAIL_METRICS = ("keyword_hit_rate", "reference_similarity", "has_risk_hint", "answer")
RATE_COLUMNS = ("keyword_hit_rate", "reference_similarity")
# Averages are kept to 12 decimal places: a floating-point sum depends on the
# order rows meet (partitioning, task timing) in its last bits; 12 places is
# far beyond the 4 the reports show and makes the summary reproducible.
SUMMARY_DIGITS = 12


def score_answers(answers: DataFrame, tokens=RISK_HINT_TOKENS) -> DataFrame:
    """Add E1-E4 to each answer row (E6).  Scores are kept unrounded."""
    ans, kws = F.col("answer"), F.col("keywords")
    return answers.select(
        "*", keyword_hit_rate(ans, kws).alias("keyword_hit_rate"),
        reference_similarity(ans, F.col("reference")).alias("reference_similarity"),
        has_risk_hint(ans, tokens).alias("has_risk_hint"), answer_length(ans).alias("answer_length"))


def model_summary(scores: DataFrame, models: DataFrame, template: str) -> DataFrame:
    """One row per model, in model order, zeros for a model without rows (A1-A5).

    ``models`` is the small model dimension (``model_ord, model_name,
    base_model, adapter``), bounded by the number of models the caller lists.
    Averages are rounded to ``SUMMARY_DIGITS`` places so that they do not
    depend on partitioning.
    """
    def mean(c):
        return F.round(F.avg(c), SUMMARY_DIGITS)
    per_model = scores.groupBy("model_name").agg(
        F.count(F.lit(1)).alias("num_examples"),
        mean(F.col("keyword_hit_rate")).alias("avg_keyword_hit_rate"),
        mean(F.col("reference_similarity")).alias("avg_reference_similarity"),
        mean(F.col("has_risk_hint").cast("double")).alias("risk_hint_rate"))
    joined = models.join(per_model, "model_name", "left")
    rates = ("avg_keyword_hit_rate", "avg_reference_similarity", "risk_hint_rate")
    return joined.select(
        "model_ord", "model_name", "base_model", "adapter", F.lit(template).alias("template"),
        F.coalesce("num_examples", F.lit(0).cast("long")).alias("num_examples"),
        *[F.coalesce(F.col(r), F.lit(0.0)).alias(r) for r in rates])


def comparison(scores: DataFrame, model_names, metrics=PIVOT_METRICS) -> DataFrame:
    """One row per ``str(id)`` with ``<model>_<metric>`` cells.

    A single ``groupBy(id)`` with one conditional ``max_by`` of all metrics per
    model: every aggregate has a partial phase, so duplicates of an id collapse
    before the shuffle.
    Item metadata comes from the first model (then first row) holding the id;
    a duplicate id inside one model keeps its last answer.  Ids missing for a
    model give null cells.  ``model_order`` lists the models.
    """
    metrics = [m for m in metrics if m in scores.columns]
    names = list(model_names)
    meta = F.min_by(F.struct("instruction", "reference", "keywords"),
                    F.struct("model_ord", "item_seq")).alias("_meta")
    cells = []
    for i, name in enumerate(names):
        last = F.when(F.col("model_name") == F.lit(name), F.col("item_seq"))
        cells.append(F.max_by(F.struct(*metrics), last).alias(f"_cell{i}"))
    grouped = scores.groupBy(F.col("id").cast("string").alias("id")).agg(meta, *cells)
    return grouped.select(
        "id", "_meta.instruction", "_meta.reference", "_meta.keywords",
        F.array(*[F.lit(n) for n in names]).alias("model_order"),
        *[F.col(f"_cell{i}").getField(m).alias(f"{n}_{m}") for i, n in enumerate(names) for m in metrics])


def _cell(name: str, metric: str) -> Column:
    c = F.col(quote(f"{name}_{metric}"))
    return round_score(c) if metric in RATE_COLUMNS else c


def blank_missing(report: DataFrame) -> DataFrame:
    """The report as display text: every cell a string, missing ones '' (R4)."""
    return report.select(*[F.coalesce(F.col(quote(c)).cast("string"), F.lit("")).alias(c)
                           for c in report.columns])


def detail_report(comp: DataFrame, model_names, metrics=DETAIL_METRICS) -> DataFrame:
    """id, instruction, reference, joined keywords, then per model the four cells.

    Rates are rounded to 4 places.  Missing cells stay null here; ``blank_missing``
    renders them as '' (R4).
    """
    present = [m for m in metrics if f"{model_names[0]}_{m}" in comp.columns] \
        if model_names else []
    return comp.select(
        "id", "instruction", "reference",
        F.array_join(F.coalesce("keywords", F.array().cast("array<string>")), ", ")
        .alias("keywords"),
        *[_cell(n, m).alias(f"{n}_{m}") for n in model_names for m in present])


def long_report(comp: DataFrame, model_names, metrics=DETAIL_METRICS) -> DataFrame:
    """Per item, per model listing, missing pairs included.

    Unpivots the comparison rows with ``inline`` -- a narrow step, no join.
    """
    present = [m for m in metrics if model_names and f"{model_names[0]}_{m}" in comp.columns]
    per_model = [
        F.struct(F.lit(i).alias("model_ord"), F.lit(n).alias("model_name"),
                 *[_cell(n, m).alias(m) for m in present])
        for i, n in enumerate(model_names)
    ]
    return comp.select("id", "instruction", "reference",
                       F.array_join(F.coalesce("keywords", F.array().cast("array<string>")),
                                    ", ").alias("keywords"),
                       F.inline(F.array(*per_model)))


def summary_report(summary: DataFrame) -> DataFrame:
    """model_name, num_examples and the rates to 4 places, in model order."""
    rates = [c for c in ("avg_keyword_hit_rate", "avg_reference_similarity", "risk_hint_rate")
             if c in summary.columns]
    return summary.select("model_ord", "model_name", "num_examples",
                          *[round_score(F.col(r)).alias(r) for r in rates])
