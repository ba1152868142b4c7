"""End-to-end jobs: prepare, distill, evaluate."""

from sftforge.plans.distill import distill, run_distill
from sftforge.plans.evaluate import answer_rows, answers, items_by_model, run_evaluate
from sftforge.plans.prepare import (
    PrepareConfig, Prepared, prepare, prepare_turns, run_prepare, to_records, with_holdout)

__all__ = [
    "distill", "run_distill", "answer_rows", "answers", "items_by_model", "run_evaluate",
    "PrepareConfig", "Prepared", "prepare", "prepare_turns", "run_prepare", "to_records",
    "with_holdout",
]
