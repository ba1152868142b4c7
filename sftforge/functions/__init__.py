"""Column expressions: normalize, pick, fold, filter, prompt, score, model specs."""

from sftforge.functions.chat import fold_messages
from sftforge.functions.models import model_rows, model_spec_columns, models_frame
from sftforge.functions.prompts import (
    DEFAULT_SYSTEM_PROMPT, INPUT_SEPARATOR, distilled_columns, prompt_messages,
    system_content, user_content)
from sftforge.functions.quality import DEFAULT_BOUNDS, QualityBounds, reject_reason
from sftforge.functions.scores import (
    RISK_HINT_TOKENS, answer_length, has_risk_hint, keyword_hit_rate,
    round_score, similarity_upper_bound)
from sftforge.functions.similarity import reference_similarity
from sftforge.functions.text import (
    INSTRUCTION_CANDIDATES, OUTPUT_CANDIDATES, exact_names, normalize_text,
    pick_first, strip_text)

__all__ = [
    "fold_messages", "model_rows", "model_spec_columns", "models_frame",
    "DEFAULT_SYSTEM_PROMPT", "INPUT_SEPARATOR", "distilled_columns", "prompt_messages",
    "system_content", "user_content", "DEFAULT_BOUNDS", "QualityBounds",
    "reject_reason", "RISK_HINT_TOKENS", "answer_length", "has_risk_hint",
    "keyword_hit_rate", "reference_similarity", "round_score", "similarity_upper_bound",
    "INSTRUCTION_CANDIDATES", "OUTPUT_CANDIDATES", "exact_names", "normalize_text",
    "pick_first", "strip_text",
]
