"""Fold turn-per-row chat tables into (instruction, output) per conversation (P5).

A conversation is a group of rows ``(conv_id, turn, role, text)``.  The fold is
the newline join, in turn order (ties broken by text, so repeated turn numbers
still fold deterministically), of the normalized non-empty texts of the user
turns (instruction) and of the assistant turns (output).

Two plans:

* :func:`fold_turns` keeps every conversation whole and joins in two levels --
  first per ``(conversation, side, block of turns)``, then the block strings per
  conversation -- so the turns of a long one are spread over many tasks.  A block
  that is itself large (many rows of one turn number) is sorted by range first and
  joined piece by piece.
* :func:`fold_turns_bounded` is what the prepare job uses.  The quality checks
  only need lengths, counts and a U+FFFD flag, which are plain partial
  aggregates.  Conversations that fail are rejected from those numbers alone;
  only the survivors, whose texts are bounded by the length limits, are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftforge.functions.chat import ASSISTANT_ROLES, PART_SEPARATOR, USER_ROLES
from sftforge.functions.quality import (
    DEFAULT_BOUNDS, GARBLED, LONG, MISSING, SHORT, QualityBounds)
from sftforge.functions.text import REPLACEMENT_CHAR, normalize_text, quote
from sftforge.session import materialize

TURN_BLOCK = 1024
# Non-empty parts from which a conversation counts as heavy.  A trillion parts
# hold at most a million such ids, a few megabytes to broadcast.
HEAVY_PARTS = 1_000_000
# Rows and bytes of one conversation's block of turns from which it is joined by pieces.
LARGE_ROWS, LARGE_BYTES = 200_000, 64 << 20
# What the sort by range compares of a part; sampled keys come to the driver.
PREFIX = 256
# Up to so many blocks are told apart by broadcast, a few megabytes; more by a shuffled join.
BROADCAST_BLOCKS = 200_000


def turn_parts(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
               role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn: ``(conv, turn, side, part)``; side null for other roles."""
    r = F.col(quote(role))
    side = (F.when(r.isin(*USER_ROLES), F.lit("user"))
            .when(r.isin(*ASSISTANT_ROLES), F.lit("assistant")))
    return turns.select(
        F.col(quote(conv)).alias(conv), F.col(quote(turn)).alias("_turn"),
        side.alias("_side"), normalize_text(F.col(quote(text))).alias("_part"))


def _join_ordered(value: str, order: str, cond: str) -> Column:
    sep = PART_SEPARATOR.replace("\n", "\\n")
    return F.expr(
        f"listagg({value}, '{sep}') WITHIN GROUP (ORDER BY {order}) FILTER (WHERE {cond})")


def _block(block: int) -> Column:
    return F.floor(F.col("_turn") / F.lit(block)).alias("_blk")


def large_blocks(turns: DataFrame, conv: str, turn: str, text: str, block: int, rows: int, size: int) -> DataFrame:
    """(_id, _at, n, bytes): the blocks of turns of over ``rows`` rows or ``size`` bytes, by one aggregate without the texts."""
    keyed = turns.select(F.col(quote(conv)).alias("_id"), F.col(quote(turn)).alias("_turn"),
                         F.octet_length(F.col(quote(text)).cast("string")).alias("_size"))
    return (keyed.groupBy("_id", _block(block).alias("_at")).agg(F.count(F.lit(1)).alias("n"), F.sum("_size").alias("bytes"))
            .where((F.col("n") > rows) | (F.col("bytes") > size)))


def sorted_pieces(parts: DataFrame, conv: str, pieces: int) -> DataFrame:
    """Distinct parts with their count ``_n``, in ranges of (conversation, side, turn, text); ``_piece`` numbers the ranges in order.

    Equal parts are counted before anything is sorted.  Parts of one turn whose
    first ``PREFIX`` characters are equal but whose rest differs share a range.
    """
    distinct = (parts.where("_part <> ''").groupBy(conv, "_side", "_blk", "_turn", "_part").agg(F.count(F.lit(1)).alias("_n")))
    return (distinct.repartitionByRange(pieces, conv, "_side", "_turn", F.substring("_part", 1, PREFIX))
            .withColumn("_piece", F.spark_partition_id()))


def _fold_pieces(parts: DataFrame, conv: str, pieces: int) -> DataFrame:
    sep = PART_SEPARATOR.replace("\n", "\\n")
    runs = sorted_pieces(parts, conv, pieces).withColumn("_part", F.expr(f"concat(repeat(concat(_part, '{sep}'), int(_n - 1)), _part)"))
    return (runs.groupBy(conv, "_side", "_blk", "_piece").agg(_join_ordered("_part", "_turn, _part", "true").alias("_run"))
            .groupBy(conv, "_side", "_blk").agg(_join_ordered("_run", "_piece", "true").alias("_chunk")))


def fold_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
               role: str = "role", text: str = "text", block: int = TURN_BLOCK,
               rows: int = LARGE_ROWS, size: int = LARGE_BYTES) -> DataFrame:
    """``(conv, instruction, output)`` for every conversation, texts whole.

    Always in two levels: first per side and block of ``block`` turn numbers,
    whose strings then join per conversation, so the turns of a long conversation
    spread over many tasks.  Blocks of over ``rows`` rows or ``size`` bytes of text
    (null turns are a block of their own) are counted first; their rows are sorted
    by range and joined by range, then block.  Only a conversation's result, which
    is one value, is put together in one task.  Rows without an id are one conversation.
    """
    # At most the table's rows / `rows` + its bytes / `size` of them: 5 million of a trillion rows, in narrow rows.
    large = materialize(large_blocks(turns, conv, turn, text, block, rows, size), "large-blocks")
    total = large.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).first()
    # Rows of other roles are kept (side null) so that a conversation without
    # any user/assistant text still yields a row with empty strings.
    parts = turn_parts(turns, conv, turn, role, text).withColumn("_blk", _block(block))
    if total["n"] is None:
        chunks = _fold_blocks(parts, conv)
    else:
        at = F.col(conv).eqNullSafe(F.col("_id")) & F.col("_blk").eqNullSafe(F.col("_at"))
        few = large.count() <= BROADCAST_BLOCKS
        keys = F.broadcast(large.select("_id", "_at")) if few else large.select("_id", "_at")
        spark = turns.sparkSession
        pieces = int(max(total["n"] // rows, (total["bytes"] or 0) // size, int(spark.conf.get("spark.sql.shuffle.partitions"))))
        chunks = (_fold_blocks(parts.join(keys, at, "left_anti"), conv)
                  .unionByName(_fold_pieces(parts.join(keys, at, "left_semi"), conv, pieces)))
        # A conversation of empty parts only has no chunk there, but a row of its own.
        chunks = chunks.unionByName(large.select(F.col("_id").alias(conv), F.lit(None).cast("string").alias("_side"),
                                                 F.col("_at").alias("_blk"), F.lit(None).cast("string").alias("_chunk")))
    folded = chunks.groupBy(conv).agg(
        _join_ordered("_chunk", "_blk", "_side = 'user' AND _chunk IS NOT NULL")
        .alias("instruction"),
        _join_ordered("_chunk", "_blk", "_side = 'assistant' AND _chunk IS NOT NULL")
        .alias("output"))
    return folded.select(conv, F.coalesce("instruction", F.lit("")).alias("instruction"),
                         F.coalesce("output", F.lit("")).alias("output"))


def _fold_blocks(parts: DataFrame, conv: str) -> DataFrame:
    return (parts.groupBy(conv, "_side", "_blk")
            .agg(_join_ordered("_part", "_turn, _part", "_part <> ''").alias("_chunk")))


def _side_stats(side: str, prefix: str) -> list[Column]:
    on_side = (F.col("_side") == side) & (F.col("_part") != "")
    return [
        F.count(F.when(on_side, F.lit(1))).alias(f"{prefix}_n"),
        F.coalesce(F.sum(F.when(on_side, F.length("_part"))), F.lit(0)).alias(f"{prefix}_chars"),
        F.coalesce(F.max(F.when(on_side, F.col("_part").contains(REPLACEMENT_CHAR))),
                   F.lit(False)).alias(f"{prefix}_bad"),
    ]


def fold_stats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
               role: str = "role", text: str = "text",
               bounds: QualityBounds = DEFAULT_BOUNDS) -> DataFrame:
    """Per conversation: folded lengths and the reject reason, without joining text."""
    parts = turn_parts(turns, conv, turn, role, text)
    stats = parts.groupBy(conv).agg(*_side_stats("user", "u"), *_side_stats("assistant", "a"))
    ilen = F.col("u_chars") + F.greatest(F.col("u_n") - 1, F.lit(0))
    olen = F.col("a_chars") + F.greatest(F.col("a_n") - 1, F.lit(0))
    reason = (F.when((F.col("u_n") == 0) | (F.col("a_n") == 0), F.lit(MISSING))
              .when(F.col("u_bad") | F.col("a_bad"), F.lit(GARBLED))
              .when((ilen < bounds.min_instruction) | (olen < bounds.min_output), F.lit(SHORT))
              .when((ilen > bounds.max_instruction) | (olen > bounds.max_output), F.lit(LONG)))
    return stats.select(conv, (F.col("u_n") + F.col("a_n")).alias("parts"),
                        ilen.alias("instruction_chars"), olen.alias("output_chars"),
                        reason.alias("reject_reason"))


def fold_turns_bounded(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                       role: str = "role", text: str = "text",
                       bounds: QualityBounds = DEFAULT_BOUNDS,
                       stats: DataFrame | None = None) -> DataFrame:
    """``(conv, instruction, output)`` for conversations that pass P6-P8 only.

    Skew: a conversation with more non-empty parts than
    ``max_instruction + max_output`` cannot pass the length bounds (each part
    adds at least one character).  Those of over ``HEAVY_PARTS`` parts are
    removed by a broadcast anti join *before* the shuffle, so a hot conversation
    is dropped where it is read; any other is at most that many rows of one task,
    of at most a side's length limit each: a longer part's conversation fails anyway.
    Rows without an id are one conversation and are joined null-safely.
    """
    stats = stats if stats is not None else fold_stats(turns, conv, turn, role, text, bounds)
    max_parts = bounds.max_instruction + bounds.max_output
    keep = stats.where(F.col("reject_reason").isNull()).select(F.col(conv).alias("_keep"))
    heavy = stats.where(F.col("parts") > F.lit(max(max_parts, HEAVY_PARTS))).select(F.col(conv).alias("_heavy"))
    parts = turn_parts(turns, conv, turn, role, text)
    longest = F.lit(max(bounds.max_instruction, bounds.max_output))
    useful = parts.where(F.col("_side").isNotNull() & (F.col("_part") != "") & (F.length("_part") <= longest))
    kept = (useful.join(F.broadcast(heavy), F.col(conv).eqNullSafe(F.col("_heavy")), "left_anti")
            .join(keep, F.col(conv).eqNullSafe(F.col("_keep")), "left_semi"))
    return kept.groupBy(conv).agg(
        _join_ordered("_part", "_turn, _part", "_side = 'user' AND _part <> ''")
        .alias("instruction"),
        _join_ordered("_part", "_turn, _part", "_side = 'assistant' AND _part <> ''")
        .alias("output"))
