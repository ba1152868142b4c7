"""Normalize, pick, fold and filter raw rows as they arrive.

The per-row part of prepare (P1-P9 and the reject reason) is made of
stateless column expressions, so it runs unchanged on a streaming DataFrame.
First-wins dedup, the seeded cap and the pivot need the whole table and stay
batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sftforge.plans.prepare import PrepareConfig, to_records


def clean_stream(raw: DataFrame, config: PrepareConfig = PrepareConfig()) -> DataFrame:
    """Kept training records of a (streaming or batch) raw-row DataFrame."""
    src = raw if "_ord" in raw.columns else raw.withColumn("_ord", F.lit(0))
    return (to_records(src, config, "_ord")
            .where(F.col("reject_reason").isNull())
            .select("instruction", "input", "output", "system"))


def start_clean_stream(raw: DataFrame, path: str, checkpoint: str,
                       config: PrepareConfig = PrepareConfig(),
                       available_now: bool = True, fmt: str = "parquet") -> StreamingQuery:
    """Start writing cleaned records to ``path`` (exactly-once via ``checkpoint``)."""
    writer = (clean_stream(raw, config).writeStream.format(fmt)
              .option("path", path).option("checkpointLocation", checkpoint)
              .outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
