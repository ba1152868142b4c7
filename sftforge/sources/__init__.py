"""Readers, writers and the dataset registry."""

from sftforge.sources.readers import (
    CSV_NA_WORDS, read_benchmark, read_csv_rows, read_json_rows, read_prompts,
    read_raw_dataset, read_table_rows, union_splits)
from sftforge.sources.registry import load_registered, read_registry
from sftforge.sources.sinks import publish, published, published_counts, write_model_results, write_table

__all__ = [
    "CSV_NA_WORDS", "read_benchmark", "read_csv_rows", "read_json_rows", "read_prompts",
    "read_raw_dataset",
    "read_table_rows", "union_splits", "load_registered", "read_registry",
    "publish", "published", "published_counts", "write_model_results", "write_table",
]
