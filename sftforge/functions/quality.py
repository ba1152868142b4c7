"""Quality predicates P6-P8 as one ``reject_reason`` column.

The reasons are tested in the reference's order, so each rejected row carries
exactly one reason and the counts per reason add up to the rejected total.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sftforge.functions.text import REPLACEMENT_CHAR


@dataclass(frozen=True)
class QualityBounds:
    # Inclusive length bounds, in code points, after normalization.
    min_instruction: int = 6
    max_instruction: int = 4000
    min_output: int = 20
    max_output: int = 6000


DEFAULT_BOUNDS = QualityBounds()

# Reason labels.
MISSING, GARBLED, SHORT, LONG = "missing", "garbled", "short", "long"


def reject_reason(instruction: Column, output: Column,
                  bounds: QualityBounds = DEFAULT_BOUNDS) -> Column:
    """Null when the pair is kept, else the first failing check."""
    li, lo = F.length(instruction), F.length(output)
    return (
        F.when((instruction == "") | (output == ""), F.lit(MISSING))
        .when(instruction.contains(REPLACEMENT_CHAR) | output.contains(REPLACEMENT_CHAR),
              F.lit(GARBLED))
        .when((li < bounds.min_instruction) | (lo < bounds.min_output), F.lit(SHORT))
        .when((li > bounds.max_instruction) | (lo > bounds.max_output), F.lit(LONG))
    )
