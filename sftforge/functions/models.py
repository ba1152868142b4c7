"""Model specs, strings of ``name::base_model::adapter`` (M1).

The only parser is a column expression, so a table of specs of any size parses
in the JVM; the jobs' short model lists go through the same expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from sftforge.functions.text import strip_text

# Adapter spellings that mean "no adapter".
NO_ADAPTER = ("", "-", "none", "null")
SPEC_SEPARATOR = "::"


def model_spec_columns(spec: Column) -> list[Column]:
    """``model_name``, ``base_model`` and ``adapter`` (null for none) of a spec column.

    A spec without exactly three fields, or with a blank name or base model,
    fails the query when it is evaluated.
    """
    fields = F.transform(F.split(spec, SPEC_SEPARATOR, -1), strip_text)
    usable = (F.size(fields) == 3) & (F.get(fields, 0) != "") & (F.get(fields, 1) != "")
    checked = F.when(usable, fields).otherwise(F.raise_error(
        F.format_string("model spec '%s' must have a name, a base model and an adapter, separated by '::'", spec)))
    adapter = F.get(checked, 2)
    return [F.get(checked, 0).alias("model_name"), F.get(checked, 1).alias("base_model"),
            F.when(~adapter.isin(*NO_ADAPTER), adapter).alias("adapter")]


def models_frame(spark: SparkSession, specs) -> DataFrame:
    """The dimension table ``model_ord, model_name, base_model, adapter`` of a model list."""
    listed = spark.createDataFrame(list(enumerate(specs)), "model_ord int, spec string")
    return listed.select("model_ord", *model_spec_columns(F.col("spec")))


def model_rows(spark: SparkSession, specs) -> list[Row]:
    """The same as rows in list order (a handful); a name used twice raises."""
    rows = models_frame(spark, specs).orderBy("model_ord").collect()
    seen: set[str] = set()
    for r in rows:
        if r["model_name"] in seen:
            raise ValueError(f"model name {r['model_name']!r} is listed twice")
        seen.add(r["model_name"])
    return rows
