"""Distill: prompt table -> generated responses -> training records.

Plan: scan -> project prompt messages -> ``mapInArrow`` (generator built once
per task) -> strip and project -> write.  No shuffle.  Work is split into
``chunks`` by a hash of the prompt key; each chunk is one job whose output is
committed on its own, so a rerun after a failure skips finished chunks' rows
(``left_anti`` on the key) instead of generating everything again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftforge.functions.prompts import (
    distilled_columns, prompt_messages, system_content, user_content)
from sftforge.operators.generate import GENERATE_OPTIONS, generate, pending
from sftforge.session import path_exists
from sftforge.sources.sinks import write_table

KEY_COLUMNS = ("instruction", "input", "system")


def _opt(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else None


def distill(prompts: DataFrame, make_generator, options: dict | None = None, **how) -> DataFrame:
    """``instruction, input, output, system`` with ``output`` = stripped response; ``how``: as in :func:`generate`."""
    opts = GENERATE_OPTIONS | (options or {})
    inp, sysc = _opt(prompts, "input"), _opt(prompts, "system")
    msgs = prompt_messages(system_content(sysc, ""),
                           user_content(F.col("instruction"), inp))
    generated = generate(prompts.withColumn("messages", msgs), make_generator, opts, **how)
    return generated.select(*distilled_columns(
        F.col("instruction"), _opt(generated, "input"), F.col("response"),
        _opt(generated, "system")))


def run_distill(spark: SparkSession, prompts: DataFrame, out_path: str, make_generator,
                options: dict | None = None, chunks: int = 8, fmt: str = "parquet", journal: str | None = None) -> int:
    """Generate for every prompt not yet in ``out_path``; return rows written now.

    Prompts are split into ``chunks`` by a hash of their key; each chunk is one
    job that appends its output, so a failure loses at most one chunk's work, or
    with ``journal`` (see :func:`generate`) the batches in hand: then one chunk will do.
    What the runs before have written is listed once, as this run's chunks don't
    share keys; an output that can't be read as ``fmt`` raises.
    """
    def text(name):
        return F.coalesce(F.col(name), F.lit("")) if name in prompts.columns else F.lit("")
    keyed = prompts.select(*[text(c).alias(c) for c in KEY_COLUMNS])
    n_chunks = max(1, chunks)
    written = 0
    before = _existing(spark, out_path, fmt)
    for chunk in range(n_chunks):
        part = keyed.where(F.pmod(F.xxhash64(*KEY_COLUMNS), F.lit(n_chunks)) == chunk)
        done = before
        if done is not None:
            done = done.where(F.pmod(F.xxhash64(*KEY_COLUMNS), F.lit(n_chunks)) == chunk)
        todo = pending(part, done, list(KEY_COLUMNS))
        written += write_table(distill(todo, make_generator, options, journal=journal), out_path, fmt, "append",
                               name=f"distill{chunk}")
    return written


def _existing(spark: SparkSession, path: str, fmt: str):
    """Keys already written to ``path``, or None before the first chunk lands."""
    if not path_exists(spark, path):
        return None
    return spark.read.format(fmt).load(path).select(*KEY_COLUMNS)
