"""DataFrame-to-DataFrame steps."""

from sftforge.operators.compare import (
    comparison, detail_report, long_report, model_summary, score_answers, summary_report)
from sftforge.operators.dedup import dedup_first
from sftforge.operators.fold import fold_stats, fold_turns, fold_turns_bounded, turn_parts
from sftforge.operators.generate import generate, pending
from sftforge.operators.sample import first_n_by_key, holdout_split, sample_key

__all__ = [
    "comparison", "detail_report", "long_report", "model_summary", "score_answers",
    "summary_report", "dedup_first", "fold_stats", "fold_turns", "fold_turns_bounded",
    "turn_parts", "generate", "pending", "first_n_by_key", "holdout_split", "sample_key",
]
