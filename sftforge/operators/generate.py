"""Batched generation through a caller-supplied generator.

Contract: ``make_generator(options) -> generate``, where ``generate`` maps a
list of chat prompts (each a list of ``{"role", "content"}`` dicts) to a list of
response strings of the same length.  The factory must be picklable; it is
called once per task (``mapInArrow`` hands each task an iterator of Arrow
batches), never once per row.  Prompt columns are carried through the same
batch, so responses are paired positionally without a join (J1); a generator
returning the wrong number of answers fails the task.

No model ships with this package; the tests use deterministic stubs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftforge.operators.journal import Journal

GeneratorFactory = Callable[[dict], Callable[[list], list]]

# Generation defaults (generate step / evaluate step).
GENERATE_OPTIONS = {
    "batch_size": 2, "max_new_tokens": 768, "temperature": 0.2, "top_p": 0.9,
    "repetition_penalty": 1.05,
}
EVALUATE_OPTIONS = {
    "batch_size": 1, "max_new_tokens": 384, "temperature": 0.0, "top_p": 0.9,
    "repetition_penalty": 1.05, "template": "qwen3_nothink",
}
# Rows are handed back whenever their responses have so many characters, so that a
# worker holds the batch it was sent and few Python strings beside it.
OUTPUT_CHARS = 1 << 20


def _as_messages(value) -> list[dict]:
    out = []
    for m in list(value) if value is not None else []:
        if m is None:
            continue
        get = m.get if isinstance(m, dict) else (lambda k, _m=m: getattr(_m, k, None))
        out.append({"role": get("role"), "content": get("content")})
    return out


def generate(df: DataFrame, make_generator: GeneratorFactory, options: dict | None = None,
             messages_col: str = "messages", output_col: str = "response",
             group_col: str | None = None,
             group_options: dict | None = None,
             partitions: int | None = None, journal: str | None = None, profile=None) -> DataFrame:
    """Add ``output_col`` with one generated response per row, same order.

    With ``group_col`` (e.g. the model name) rows are sorted by it inside each
    partition -- a local sort, no shuffle -- and the factory is called once per
    group value per task with ``options | {group_col: value}``, so only one
    generator (model) is resident at a time.  ``group_options`` maps a group
    value to extra options (e.g. the model's base model and adapter).

    The input keeps its partitions, so the number of tasks follows the data;
    ``partitions`` deals the rows out anew by the prompts' hash, for a prompt table
    that is read from too few files.

    With ``journal`` (a folder that all tasks see) each batch's answers are kept
    there as soon as they are there, and a retried task or a later run generates
    only batches that aren't (:mod:`journal`); a task that finds all of its batches
    builds no generator.  Rows are sorted by their prompt's hash, so a partition's
    batches are the same in every attempt.  ``profile``: a Spark ``ResourceProfile``
    for the stage, say one GPU a task.
    """
    opts = dict(options or {})
    # Sampling only when the temperature is positive; greedy decoding otherwise.
    opts.setdefault("do_sample", float(opts.get("temperature") or 0) > 0)
    per_group = dict(group_options or {})
    batch_size = max(1, int(opts.get("batch_size", 1)))
    schema = T.StructType(df.schema.fields + [T.StructField(output_col, T.StringType(), True)])
    source = df.repartition(partitions, F.xxhash64(messages_col)) if partitions else df
    order = ([group_col] if group_col else []) + ([F.xxhash64(messages_col)] if journal else [])
    source = source.sortWithinPartitions(*order) if order else source

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current_key, gen = object(), None
        done = Journal(journal) if journal else None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(group_col).to_pylist() if group_col else [None] * batch.num_rows
            responses: list = []
            start = first = held = 0
            while start < batch.num_rows:
                key = keys[start]
                if key != current_key:
                    gen = None  # release the previous generator before loading the next
                    current_key = key
                extra = {group_col: key, **per_group.get(key, {})} if group_col else {}
                stop = start
                while stop < batch.num_rows and stop - start < batch_size and keys[stop] == key:
                    stop += 1
                chunk = [_as_messages(v) for v in batch.column(messages_col).slice(start, stop - start).to_pylist()]
                name = done.key(opts | extra, chunk) if done else None
                out = done.get(name) if done else None
                if out is None:
                    gen = gen or make_generator(opts | extra)
                    out = list(gen(chunk))
                    if done and len(out) == len(chunk):
                        done.put(name, out)
                if len(out) != len(chunk):
                    raise ValueError(
                        f"generator returned {len(out)} responses for {len(chunk)} prompts")
                responses.extend(out)
                held += sum(len(x) for x in out if x is not None)
                start = stop
                if held >= OUTPUT_CHARS or start == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([*batch.slice(first, start - first).columns, pa.array(responses, pa.string())],
                                                     names=[*batch.schema.names, output_col])
                    responses, first, held = [], start, 0

    from sftforge.session import ship_package
    ship_package(df.sparkSession)
    return source.mapInArrow(run, schema, profile=profile)


def pending(df: DataFrame, done: DataFrame | None, keys) -> DataFrame:
    """Rows of ``df`` whose ``keys`` are not yet in ``done`` (resume after a failure)."""
    if done is None:
        return df
    return df.join(done.select(*keys), list(keys), "left_anti")


__all__ = ["generate", "pending", "GENERATE_OPTIONS", "EVALUATE_OPTIONS"]
