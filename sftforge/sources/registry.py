"""Dataset registry: name -> file, resolved to temp views.

Registry format: ``{"<name>": {"file_name": "<path>"}, ...}``; relative paths
are resolved against the registry's folder.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from sftforge.sources.readers import read_json_rows


def read_registry(spark: SparkSession, path: str) -> dict[str, dict]:
    """Parse a registry file (a few lines of JSON, read through Spark's file system)."""
    text = spark.read.text(path, wholetext=True).take(1)
    return json.loads(text[0]["value"]) if text else {}


def _resolve(base: str, file_name: str) -> str:
    if "://" in file_name or file_name.startswith("/"):
        return file_name
    return f"{base.rstrip('/')}/{file_name}"


def load_registered(spark: SparkSession, registry: dict | str, base_dir: str | None = None,
                    names=None) -> dict[str, DataFrame]:
    """Read every (or the named) registered dataset and expose it as a temp view."""
    if isinstance(registry, str):
        base_dir = base_dir or registry.rsplit("/", 1)[0]
        registry = read_registry(spark, registry)
    out = {}
    for name, entry in registry.items():
        if names is not None and name not in names:
            continue
        path = _resolve(base_dir or ".", entry["file_name"])
        fmt = entry.get("format") or ("parquet" if path.endswith(".parquet") else "json")
        df = (spark.read.parquet(path) if fmt == "parquet"
              else read_json_rows(spark, path).drop("_ord"))
        df.createOrReplaceTempView(name)
        out[name] = df
    return out
