"""Prompt building (B1-B3) and the distilled-record projection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sftforge.functions.text import strip_text

# The domain system prompt used as the training-table default and
# as the evaluation default, and the separator placed before supplementary input.
DEFAULT_SYSTEM_PROMPT = (
    "你是一名严谨的领域助手。回答应尽量准确、清晰，说明适用条件、边界和风险；"
    "不确定时应明确说明信息不足。"
)
INPUT_SEPARATOR = "\n\n补充信息：\n"

MESSAGE_TYPE = "array<struct<role:string,content:string>>"


def user_content(instruction: Column, input_: Column | None) -> Column:
    """Instruction, plus separator and input when the input is non-empty (B1)."""
    inst = F.coalesce(instruction.cast("string"), F.lit(""))
    if input_ is None:
        return inst
    inp = F.coalesce(input_.cast("string"), F.lit(""))
    return F.when(inp != "", F.concat(inst, F.lit(INPUT_SEPARATOR), inp)).otherwise(inst)


def system_content(system: Column | None, default: str) -> Column:
    """The item's system prompt, or ``default`` when absent (B2).

    Generation passes ``default=""``; evaluation passes the domain prompt.
    """
    if system is None:
        return F.lit(default)
    return F.coalesce(system.cast("string"), F.lit(default))


def prompt_messages(system: Column, user: Column) -> Column:
    """The two-message chat prompt [system, user]."""
    return F.array(
        F.struct(F.lit("system").alias("role"), system.alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )


def distilled_columns(instruction: Column, input_: Column | None, response: Column,
                      system: Column | None) -> list[Column]:
    """Training record from a prompt and its raw response."""
    def text_or_empty(c):
        return F.lit("") if c is None else F.coalesce(c.cast("string"), F.lit(""))
    return [
        F.coalesce(instruction.cast("string"), F.lit("")).alias("instruction"),
        text_or_empty(input_).alias("input"),
        strip_text(response).alias("output"),
        text_or_empty(system).alias("system"),
    ]
