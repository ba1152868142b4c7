"""Prepare: raw rows -> training table + prompt table.

Plan: scan -> project (P1-P5, P9) -> filter (P6-P8) -> exchange on the dedup key
(P10, partial aggregate first) -> write.  All rows are kept unless the caller
sets a cap; then the kept rows are written once with their md5 order key, the
cap's threshold is counted from the key column alone (P11, P13), and the rows
below it are read back and deduplicated, so the full-width shuffle carries about
``max_samples`` rows.

Filtering runs before dedup, so a rejected first copy does not hide a valid
later one.  Nothing in this plan is evaluated in Python.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftforge.functions.chat import fold_messages
from sftforge.functions.prompts import DEFAULT_SYSTEM_PROMPT
from sftforge.functions.quality import DEFAULT_BOUNDS, QualityBounds, reject_reason
from sftforge.functions.text import (
    INSTRUCTION_CANDIDATES, OUTPUT_CANDIDATES, exact_names, normalize_text, pick_first, quote)
from sftforge.operators.dedup import dedup_first
from sftforge.operators.fold import fold_stats, fold_turns_bounded
from sftforge.operators.project import evaluate_once
from sftforge.operators.sample import (
    KEY, below, cap_threshold, holdout_split, sample_key)
from sftforge.session import materialize
from sftforge.sources.sinks import write_table

RECORD_COLUMNS = ("instruction", "input", "output", "system")
PROMPT_COLUMNS = ("instruction", "input", "system")


@dataclass(frozen=True)
class PrepareConfig:
    # Defaults of the prepare step.
    system: str = DEFAULT_SYSTEM_PROMPT
    max_samples: int | None = None      # None: all rows
    prompt_samples: int | None = None   # None: as many as training rows
    seed: int = 42
    bounds: QualityBounds = field(default_factory=lambda: DEFAULT_BOUNDS)
    keep_input: bool = False
    val_size: float = 0.02


@dataclass
class Prepared:
    records: DataFrame      # per raw row / conversation: reject_reason (null = kept)
    training: DataFrame     # deduplicated kept rows (capped if asked for), with the order key `_skey`
    prompts: DataFrame      # the first prompt_samples of the same order
    rejects: DataFrame      # reject_reason, n


def _instruction_and_input(df: DataFrame, names: dict, keep_input: bool) -> tuple[Column, Column]:
    if not keep_input or "input" not in names:
        return pick_first(df, INSTRUCTION_CANDIDATES, names), F.lit("")
    # Opt-in: `input` stays context when a higher-priority candidate holds the question.
    cut = INSTRUCTION_CANDIDATES.index("input")
    high = pick_first(df, INSTRUCTION_CANDIDATES[:cut], names)
    low = pick_first(df, INSTRUCTION_CANDIDATES[cut:], names)
    inp = normalize_text(F.col(quote(names["input"])))
    return (F.when(high != "", high).otherwise(low),
            F.when(high != "", inp).otherwise(F.lit("")))


def to_records(raw: DataFrame, config: PrepareConfig = PrepareConfig(),
               order: str = "_ord") -> DataFrame:
    """Map raw rows to ``instruction, input, output, system, reject_reason, <order>``."""
    df, names = exact_names(raw)
    instruction, input_ = _instruction_and_input(df, names, config.keep_input)
    output = pick_first(df, OUTPUT_CANDIDATES, names)
    folded = fold_messages(df, names["messages"]) if "messages" in names else None
    if folded is not None:
        user, assistant = folded
        via_messages = output == ""
        instruction = F.when(via_messages & (instruction == ""), user).otherwise(instruction)
        output = F.when(via_messages, assistant).otherwise(output)
    order_col = F.col(quote(names.get(order, order)))
    records = evaluate_once(df.select(instruction.alias("instruction"), input_.alias("input"),
                                      output.alias("output"), order_col.alias(order)))
    return records.select(
        "instruction", "input", "output", F.lit(config.system).alias("system"),
        reject_reason(F.col("instruction"), F.col("output"), config.bounds)
        .alias("reject_reason"), order)


def select_training(records: DataFrame, config: PrepareConfig, order: str) -> Prepared:
    kept = records.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return _select(records, kept, config, order)


def _caps(config: PrepareConfig) -> tuple[int | None, int | None]:
    """Caps of the training and the prompt table, the second no more than the first."""
    n, m = config.max_samples, config.prompt_samples
    return n, (n if m is None else m if n is None else min(m, n))


def _select(records: DataFrame, kept: DataFrame, config: PrepareConfig,
            order: str, stored: bool = False) -> Prepared:
    """Dedup (P10) and, if asked for, cap (P11, P13) ``kept`` rows; ``stored``: they are files already."""
    keyed = kept if KEY in kept.columns else kept.withColumn(
        KEY, sample_key(config.seed, F.col("instruction"), F.col("input")))
    n, m = _caps(config)
    if not stored and (n is not None or m is not None):
        keyed = materialize(keyed, "kept")
    rows = keyed if n is None else below(keyed, cap_threshold(keyed, n))
    def first(some: DataFrame) -> DataFrame:
        return dedup_first(some, ("instruction", "input"), order, drop_order=True)

    # The sample key is a function of the dedup's: rows beyond a cap go before the shuffle.
    unique = first(rows)
    asked = unique if m is None or m == n else first(below(rows, cap_threshold(keyed, m)))
    rejects = (records.where(F.col("reject_reason").isNotNull())
               .groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n")))
    return Prepared(records, unique.select(*RECORD_COLUMNS, KEY), asked.select(*PROMPT_COLUMNS, KEY), rejects)


def prepare(raw: DataFrame, config: PrepareConfig = PrepareConfig(),
            order: str = "_ord", persist: bool = False) -> Prepared:
    """Prepare from raw flat / chat-array rows carrying an input-order column.

    ``persist=True`` writes the kept rows once under ``spark.checkpoint.dir``, each
    file sorted by the sample key -- worth it when the raw scan is expensive (many
    small JSON files, remote storage).  With a cap they are always written once.
    """
    records = to_records(raw, config, order)
    if not persist:
        return select_training(records, config, order)
    kept = (records.where(F.col("reject_reason").isNull()).drop("reject_reason")
            .withColumn(KEY, sample_key(config.seed, F.col("instruction"), F.col("input"))))
    return _select(records, materialize(kept.sortWithinPartitions(KEY), "kept"), config, order, True)


def prepare_turns(turns: DataFrame, config: PrepareConfig = PrepareConfig(),
                  conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text", order: str | None = None,
                  persist: bool = True) -> Prepared:
    """Prepare from a turn-per-row chat table (one conversation = one raw row).

    Quality checks run on per-conversation lengths and flags first; only the
    surviving conversations are text-joined (see :mod:`sftforge.operators.fold`).
    Input order of conversations is ``order`` (default: the conversation id).
    With ``persist`` the folded rows are written once to the shared checkpoint
    folder with their sample key, each file sorted by it: counting for a cap then
    reads one 32-byte column, and the cap's key filter reaches the parquet scan
    (row groups past the threshold are skipped by their min/max statistics).
    """
    stats = fold_stats(turns, conv, turn, role, text, config.bounds)
    folded = fold_turns_bounded(turns, conv, turn, role, text, config.bounds, stats)
    order = order or conv
    kept = folded.select(
        F.col("instruction"), F.lit("").alias("input"), F.col("output"),
        F.lit(config.system).alias("system"), F.col(quote(order)).alias("_ord"))
    kept = kept.withColumn(KEY, sample_key(config.seed, F.col("instruction"), F.col("input")))
    if persist:
        kept = materialize(kept.sortWithinPartitions(KEY), "folded")
    records = stats.select(F.col(conv), F.col("reject_reason"))
    return _select(records, kept, config, "_ord", persist)


def with_holdout(training: DataFrame, config: PrepareConfig = PrepareConfig()) -> DataFrame:
    """Add ``split`` = 'train' / 'eval' (about ``val_size`` of rows), stable per key (H1)."""
    return training.withColumn(
        "split", holdout_split(config.seed, F.col("instruction"), F.col("input"),
                               val_size=config.val_size))


def run_prepare(prep: Prepared, out_dir: str, config: PrepareConfig = PrepareConfig(),
                fmt: str = "json", mode: str = "errorifexists",
                holdout: bool = False) -> dict[str, int]:
    """Write the training table sorted by the sample key, then the prompt table.

    Prompts are the rows of the written training table up to the prompt cap, so
    the raw input is not read again.  With ``holdout`` the training rows carry
    ``split`` ('train' / 'eval', about ``val_size`` eval rows, H1).
    """
    spark = prep.training.sparkSession
    training = with_holdout(prep.training, config) if holdout else prep.training
    n_train = write_table(training, f"{out_dir}/train", fmt, mode,
                          order_by=[KEY, "instruction", "input"], name="train",
                          drop=[KEY])
    train = spark.read.schema("instruction string, input string, output string, "
                              "system string").format(fmt).load(f"{out_dir}/train")
    n, m = _caps(config)
    prompts = train.withColumn(KEY, sample_key(config.seed, F.col("instruction"), F.col("input")))
    if m is not None and m != n:
        prompts = below(prompts, cap_threshold(prompts, m))
    n_prompts = write_table(prompts.select(*PROMPT_COLUMNS, KEY), f"{out_dir}/prompts", fmt,
                            mode, order_by=[KEY, "instruction", "input"], name="prompts",
                            drop=[KEY])
    return {"train": n_train, "prompts": n_prompts}
