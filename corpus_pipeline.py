"""Corpus pipeline: clean a document table stage by stage and pack what stays.

A stage takes (spark, docs, sf_dir); docs is the stored output of the stage
before.  All but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sftforge.llm import decontaminate, linededup, packing, simhash, toxicity
from sftforge.llm.common import documents, materialize


def ordinary(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models don't reject; the models learn from the labelled rows of docs."""
    return toxicity.keep_ordinary(docs, toxicity.train(docs, documents(spark, sf_dir, "labels")))


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand earlier, exactly or nearly."""
    return linededup.drop_lines(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.drop_near_duplicates(docs)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.keep_clean(docs, documents(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens, each a sequence of a power-of-two length."""
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [("toxicity", ordinary), ("line dedup", own_lines), ("SimHash near-dedup", one_of_each),
          ("benchmark decontamination", unleaked), ("packing", packed)]

#: SQL has no learned models, XXH64 fingerprints or tokenizers; the tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
