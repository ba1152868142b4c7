"""Evaluate: benchmark x models -> answers -> scores -> summary, pivot, reports.

Plan: benchmark scan -> prompt messages (B1-B3) -> one job per model of the small
model list (J2, no join) -> ``mapInArrow`` generation, one model at a time in the
whole cluster (G1, G2) -> answers stored by model -> native scores (E1-E6) stored -> summary (A1-A5) and
comparison (R1) from the same scores -> reports (R5-R7) -> write (K4).
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftforge.functions.models import model_rows, models_frame
from sftforge.functions.prompts import (
    DEFAULT_SYSTEM_PROMPT, prompt_messages, system_content, user_content)
from sftforge.functions.text import strip_text
from sftforge.operators.compare import (
    blank_missing, comparison, detail_report, long_report, model_summary, score_answers, summary_report)
from sftforge.operators.generate import EVALUATE_OPTIONS, generate
from sftforge.session import path_exists, remove_path
from sftforge.sources.sinks import write_table

ANSWER_COLUMNS = ("model_name", "model_ord", "item_seq", "id", "instruction",
                  "reference", "keywords", "answer")


def _opt(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else None


def items_by_model(items: DataFrame, models) -> DataFrame:
    """Every benchmark item once per model (J2), as a per-row ``inline``.

    ``models``: rows of :func:`model_rows`.  The list is the caller's (a handful),
    so it is a literal array: no cross join and no shuffle.
    """
    listed = F.array(*[
        F.struct(F.lit(m["model_ord"]).alias("model_ord"), F.lit(m["model_name"]).alias("model_name"),
                 F.lit(m["base_model"]).alias("base_model"),
                 F.lit(m["adapter"]).cast("string").alias("adapter"))
        for m in models])
    return items.select("*", F.inline(listed))


def prompts_for(items: DataFrame, default_system: str = DEFAULT_SYSTEM_PROMPT) -> DataFrame:
    """Add the [system, user] prompt; the domain prompt when an item has no system."""
    return items.withColumn("messages", prompt_messages(
        system_content(_opt(items, "system"), default_system),
        user_content(F.col("instruction"), _opt(items, "input"))))


def answers(items: DataFrame, specs, make_generator, options: dict | None = None) -> DataFrame:
    """One answer per (model, item): ``ANSWER_COLUMNS``.

    Each model is its own branch over the items' partitions, and the branches are
    unioned into one job: all models generate in parallel, every task loads
    exactly one model, and the number of tasks follows the benchmark's size.
    """
    return reduce(DataFrame.unionByName, [model_answers(items, m, make_generator, options) for m in model_rows(items.sparkSession, specs)])


def model_answers(items: DataFrame, model, make_generator, options: dict | None = None, **how) -> DataFrame:
    """One model's answers (a row of :func:`model_rows`); ``how``: as in :func:`generate`."""
    rows = prompts_for(items).select("*", F.lit(model["model_ord"]).alias("model_ord"), F.lit(model["model_name"]).alias("model_name"))
    opts = EVALUATE_OPTIONS | (options or {}) | {k: model[k] for k in ("model_name", "base_model", "adapter")}
    return answer_rows(generate(rows, make_generator, opts, **how), "response")


def answer_rows(out: DataFrame, response: str) -> DataFrame:
    """``ANSWER_COLUMNS`` of rows that hold a model's ``response`` beside the item's columns."""
    no_keywords = F.array().cast("array<string>")

    def present(name, empty):
        return F.coalesce(F.col(name), empty) if name in out.columns else empty
    return out.select(
        "model_name", "model_ord", "item_seq", F.col("id").cast("string").alias("id"),
        present("instruction", F.lit("")).cast("string").alias("instruction"),
        present("reference", F.lit("")).cast("string").alias("reference"),
        present("keywords", no_keywords).alias("keywords"),
        strip_text(F.col(response)).alias("answer"))


def _committed(spark: SparkSession, path: str) -> bool:
    """Whether a job committed the folder (``_SUCCESS``); an unreadable store raises."""
    return path_exists(spark, f"{path}/_SUCCESS")


def _fingerprint(items: DataFrame, models, opts: dict) -> str:
    """What the answers depend on: the items' rows, the models in order, the options."""
    row = F.xxhash64(*[F.to_json(F.struct(c)) for c in sorted(items.columns)])
    total = items.agg(F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(38,0)")).alias("h")).first()
    return json.dumps({"items": total["n"], "hash": str(total["h"]), "models": [m.asDict() for m in models], "options": opts},
                      sort_keys=True, ensure_ascii=True, default=str)


def run_evaluate(spark: SparkSession, items: DataFrame, specs, out_dir: str, make_generator,
                 options: dict | None = None, mode: str = "errorifexists",
                 resume: bool = False, journal: str | None = None, profile=None) -> dict[str, int]:
    """Generate once, persist, score once, persist, then derive and write reports.

    Each model's answers are a job and a folder of their own, one after another, so
    no two models are ever loaded at a time, and a rerun with ``resume`` begins with
    the first model whose answers aren't committed.  ``journal`` and ``profile`` go
    to :func:`generate`.

    ``mode`` holds for every table.  With ``resume`` a rerun takes up what the run
    before committed and writes the rest; it raises unless items, models and
    options are those that ``out_dir`` was begun with.
    """
    opts = EVALUATE_OPTIONS | (options or {})
    models = model_rows(spark, specs)
    names = [m["model_name"] for m in models]
    stamp = spark.createDataFrame([(_fingerprint(items, models, opts),)], "value string")
    if resume and _committed(spark, f"{out_dir}/manifest"):
        if spark.read.text(f"{out_dir}/manifest").first() != stamp.first():
            raise ValueError(f"{out_dir} holds a run over other items, models or options")
    else:
        stamp.coalesce(1).write.mode(mode).text(f"{out_dir}/manifest")

    def store(name: str, make, fmt: str, **how) -> int:
        path = f"{out_dir}/{name}"
        if resume and _committed(spark, path):
            return spark.read.format(fmt).load(path).count()
        # What an interrupted run of the same manifest left uncommitted is replaced.
        return write_table(make(), path, fmt, "overwrite" if resume else mode, name=name.replace("/", "_").replace("=", "_"), **how)

    if mode == "overwrite" and not resume:
        remove_path(spark, f"{out_dir}/answers")  # a former run's may be of more models
    folders = [f"answers/model_ord={m['model_ord']}" for m in models]
    counts = {"answers": sum(
        store(folder, lambda m=m: model_answers(items, m, make_generator, opts, journal=journal, profile=profile).drop("model_ord"), "parquet")
        for folder, m in zip(folders, models))}
    stored = spark.read.option("basePath", f"{out_dir}/answers").parquet(*[f"{out_dir}/{f}" for f in folders])
    counts["scores"] = store("scores", lambda: score_answers(stored), "parquet")
    scores = spark.read.parquet(f"{out_dir}/scores")
    summary = model_summary(scores, models_frame(spark, specs), opts["template"])
    comp = comparison(scores, names)
    counts["results"] = store("models/results", lambda: scores, "json", partition_by="model_name")
    counts["summary"] = store("models/summary", lambda: summary, "json", partition_by="model_name")
    store("summary_report", lambda: blank_missing(summary_report(summary)), "csv", order_by="model_ord")
    store("comparison", lambda: blank_missing(detail_report(comp, names)), "csv", order_by="id")
    store("long_report", lambda: long_report(comp, names), "json", order_by=["id", "model_ord"])
    return counts
