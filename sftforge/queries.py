"""Driver queries: one per operator family of the survey, over the driver tables.

Every query reads the given parquet tables (or data Spark derives from them)
in full.  ``ORACLE_SQL`` in :mod:`sftforge.driver_sql` restates each one for
DuckDB; queries without an entry there are checked by rows only and by the
unit tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftforge.functions.chat import fold_messages
from sftforge.functions.models import model_rows, model_spec_columns, models_frame
from sftforge.functions.prompts import DEFAULT_SYSTEM_PROMPT, distilled_columns
from sftforge.functions.quality import reject_reason
from sftforge.functions.scores import has_risk_hint, answer_length, similarity_upper_bound
from sftforge.functions.text import (
    INSTRUCTION_CANDIDATES, OUTPUT_CANDIDATES, normalize_text)
from sftforge.functions.text import pick_first as pick_candidates
from sftforge.operators.compare import (
    blank_missing, comparison, detail_report, long_report, model_summary, score_answers, summary_report)
from sftforge.operators.dedup import dedup_first
from sftforge.operators.fold import fold_stats, fold_turns
from sftforge.operators.generate import EVALUATE_OPTIONS
from sftforge.operators.sample import holdout_split
from sftforge.plans.distill import distill
from sftforge.plans.evaluate import answers, items_by_model, prompts_for
from sftforge.plans.prepare import PrepareConfig, prepare, prepare_turns, run_prepare, select_training
from sftforge.session import scratch_path
from sftforge.sources.readers import (
    read_benchmark, read_csv_rows, read_json_rows, read_prompts, read_table_rows, union_splits)
from sftforge.sources.registry import load_registered
from sftforge.sources.sinks import publish, published, published_counts, write_model_results, write_table
from sftforge.sources.testdata import (
    MODEL_SPECS, benchmark_items, chat_rows, derived_answers, document_items, document_pairs, flat_rows, part_items, prompt_writer,
    table)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the driver checks.
SEED = 42
SAMPLE_CAP = 500
PROMPT_CAP = 200
LICENSE_HINTS = ("MIT License", "Apache License", "General Public License")
TEMPLATE = EVALUATE_OPTIONS["template"]
MODEL_NAMES = ("echo", "lead", "rest")
# A task compares the answers to about so many bytes of documents.
COMPARED_BYTES = 4 << 20
# A task scores the answers to about so many parts; to at most so many tasks Spark deals rows without keeping any in memory.
SCORED_PARTS, DEALT_MOST = 10_000, 200


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _kw(c="keywords"):
    return F.array_join(F.coalesce(F.col(c), F.array().cast("array<string>")), ", ")


# ---- text, pick, fold, filter (P1-P9) -------------------------------------

@query
def normalize_text_docs(spark, sf):
    docs = table(spark, sf, "documents")
    norm = normalize_text(F.col("text"))
    return docs.select("doc_id", norm.alias("text"), F.length(norm).alias("n_chars"))


@query
def pick_first(spark, sf):
    raw = flat_rows(table(spark, sf, "documents"))
    return raw.select("doc_id",
                      pick_candidates(raw, INSTRUCTION_CANDIDATES).alias("instruction"),
                      pick_candidates(raw, OUTPUT_CANDIDATES).alias("output"))


@query
def messages_fold(spark, sf):
    return fold_turns(table(spark, sf, "conversations"))


@query
def messages_fold_one_turn(spark, sf):
    """Turns without numbers of two conversations (ids even and odd): large blocks, joined by ranges of their texts."""
    turns = table(spark, sf, "conversations").select(
        (F.col("conv_id") % 2).alias("conv_id"), F.lit(None).cast("int").alias("turn"), "role", "text")
    return fold_turns(turns, rows=500, size=1 << 20).select(
        "conv_id", *[c for side in ("instruction", "output")
                     for c in (F.length(side).cast("long").alias(f"{side}_chars"), F.md5(side).alias(f"{side}_md5"))])


@query
def messages_array_fold(spark, sf):
    rows = chat_rows(table(spark, sf, "conversations"))
    user, assistant = fold_messages(rows)
    return rows.select("conv_id", "pair", user.alias("instruction"), assistant.alias("output"))


def _doc_records(spark, sf):
    pairs = document_pairs(table(spark, sf, "documents"))
    return pairs.withColumn("reject_reason",
                            reject_reason(F.col("instruction"), F.col("output")))


@query
def quality_filter(spark, sf):
    return (_doc_records(spark, sf).where(F.col("reject_reason").isNull())
            .select("doc_id", "instruction", "output"))


@query
def reject_counts(spark, sf):
    return (_doc_records(spark, sf)
            .groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("reject_reason"))
            .agg(F.count(F.lit(1)).alias("n")))


@query
def alpaca_project(spark, sf):
    return (_doc_records(spark, sf).where(F.col("reject_reason").isNull())
            .select("doc_id", "instruction", F.lit("").alias("input"), "output",
                    F.lit(DEFAULT_SYSTEM_PROMPT).alias("system")))


# ---- dedup, sample, holdout, union (P10-P13, H1, S4) -----------------------

@query
def dedup_first_docs(spark, sf):
    docs = table(spark, sf, "documents")
    keyed = docs.select(normalize_text(F.col("text")).alias("instruction"),
                        F.lit("").alias("input"), "doc_id", "lang", "source")
    return dedup_first(keyed, ("instruction", "input"), "doc_id")


def _doc_prepared(spark, sf):
    recs = _doc_records(spark, sf).select(
        "instruction", F.lit("").alias("input"), "output",
        F.lit(DEFAULT_SYSTEM_PROMPT).alias("system"), "reject_reason", "doc_id")
    config = PrepareConfig(seed=SEED, max_samples=SAMPLE_CAP, prompt_samples=PROMPT_CAP)
    return select_training(recs, config, "doc_id")


@query
def sample_cap(spark, sf):
    return _doc_prepared(spark, sf).training.select(
        "instruction", "input", "output", "system", F.col("_skey").alias("sample_key"))


@query
def prompt_subset(spark, sf):
    return _doc_prepared(spark, sf).prompts.select(
        "instruction", "input", "system", F.col("_skey").alias("sample_key"))


@query
def holdout_split_docs(spark, sf):
    pairs = document_pairs(table(spark, sf, "documents"), ("instruction",))
    return pairs.select("doc_id", holdout_split(SEED, F.col("instruction"), F.lit(""))
                        .alias("split"))


@query
def union_splits_docs_pages(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.lit(0).alias("split_ord"), F.col("doc_id").alias("row_id"), "text", "lang", "source")
    pages = table(spark, sf, "pages").select(
        F.lit(1).alias("split_ord"), F.col("page_id").alias("row_id"), "url", "html")
    return union_splits([docs, pages])


# ---- full prepare (P1-P13) --------------------------------------------------

def _prepared_conversations(spark, sf):
    return prepare_turns(table(spark, sf, "conversations"), PrepareConfig(seed=SEED))


@query
def prepare_train(spark, sf):
    return _prepared_conversations(spark, sf).training.select(
        "instruction", "input", "output", "system")


@query
def prepare_prompts(spark, sf):
    return _prepared_conversations(spark, sf).prompts.select("instruction", "input", "system")


def _run_prepare(spark, sf):
    path, config = scratch_path(spark, "prepare"), PrepareConfig(seed=SEED, prompt_samples=PROMPT_CAP)
    counts = run_prepare(prepare_turns(table(spark, sf, "conversations"), config), path, config, holdout=True)
    return path, counts


@query
def run_prepare_written(spark, sf):
    """The job's written training table with its holdout split."""
    path, _ = _run_prepare(spark, sf)
    return spark.read.json(f"{path}/train").select("instruction", "input", "output", "system", "split")


@query
def run_prepare_counts(spark, sf):
    """The counts that the writes of the job report."""
    _, counts = _run_prepare(spark, sf)
    return spark.createDataFrame(sorted(counts.items()), "name string, n long")


@query
def prepare_published(spark, sf):
    """The job published twice into one place, the second time with a cap: what a reader finds is the second's tables whole."""
    out, turns = scratch_path(spark, "published"), table(spark, sf, "conversations")
    for cap in (None, PROMPT_CAP):
        config = PrepareConfig(seed=SEED, prompt_samples=cap)
        publish(spark, out, lambda folder, c=config: run_prepare(prepare_turns(turns, c), folder, c), keep=1)
    here, counts = published(spark, out), published_counts(spark, out)
    tables = [spark.read.json(f"{here}/{name}").select(
        F.lit(name).alias("name"), F.lit(counts[name]).cast("long").alias("n"), "instruction", "system") for name in ("train", "prompts")]
    return union_splits(tables)


@query
def prepare_rejects(spark, sf):
    # The rejects of the conversation prepare job are its per-conversation stats.
    stats = fold_stats(table(spark, sf, "conversations"))
    return (stats.groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("reject_reason"))
            .agg(F.count(F.lit(1)).alias("n")))


@query
def prepare_chat_train(spark, sf):
    rows = chat_rows(table(spark, sf, "conversations"))
    ordered = rows.withColumn("_ord", F.struct("conv_id", "pair"))
    return prepare(ordered, PrepareConfig(seed=SEED)).training.select(
        "instruction", "input", "output", "system")


@query
def prepare_flat_train(spark, sf):
    raw = flat_rows(table(spark, sf, "documents"))
    return prepare(raw, PrepareConfig(seed=SEED), order="doc_id").training.select(
        "instruction", "input", "output", "system")


# ---- sources and sinks (S1-S7, K1-K5) ---------------------------------------

def _items(spark, sf):
    return benchmark_items(table(spark, sf, "benchmark"))


@query
def json_round_trip(spark, sf):
    path = scratch_path(spark, "bench-json")
    write_table(_items(spark, sf), path, "json", "overwrite")
    back = read_json_rows(spark, path)
    return back.select("id", "instruction", "input", "reference",
                       _kw().alias("keywords"), "system")


@query
def registry_load(spark, sf):
    base = scratch_path(spark, "registry")
    write_table(_items(spark, sf), f"{base}/benchmark_items.jsonl", "json", "overwrite")
    load_registered(spark, {"bench_items": {"file_name": "benchmark_items.jsonl"}}, base)
    return spark.table("bench_items").select("id", "instruction", "reference")


@query
def prompts_round_trip(spark, sf):
    path = scratch_path(spark, "prompts")
    prompts = _prepared_conversations(spark, sf).prompts.select("instruction", "input", "system")
    write_table(prompts, path, "json", "overwrite")
    return read_prompts(spark, path).select("instruction", "input", "system")


def _model_results(spark, sf):
    path = scratch_path(spark, "model-results")
    scores = _scores(spark, sf)
    write_model_results(scores, model_summary(scores, models_frame(spark, MODEL_SPECS), TEMPLATE), path, "overwrite")
    return path


@query
def model_results_round_trip(spark, sf):
    back = spark.read.json(f"{_model_results(spark, sf)}/summary")
    return back.select(F.col("model_ord").cast("int").alias("model_ord"), "model_name",
                       "base_model", "adapter", "template",
                       F.col("num_examples").cast("bigint").alias("num_examples"),
                       "avg_keyword_hit_rate", "avg_reference_similarity", "risk_hint_rate")


@query
def model_result_rows(spark, sf):
    back = spark.read.json(f"{_model_results(spark, sf)}/results")
    return back.select("model_name", "id", "item_seq", "answer", "keyword_hit_rate", "reference_similarity",
                       "has_risk_hint", F.col("answer_length").cast("int").alias("answer_length"))


@query
def csv_round_trip(spark, sf):
    path = scratch_path(spark, "pages-csv")
    pages = table(spark, sf, "pages")
    write_table(pages, path, "csv", "overwrite")
    back = read_csv_rows(spark, path, multi_line=True)  # pages hold line breaks
    return back.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")


@query
def csv_by_range(spark, sf):
    """Whole documents as CSV, line breaks in quotes, read back by byte range."""
    path = scratch_path(spark, "documents-csv")
    write_table(table(spark, sf, "documents").select("doc_id", "text", "lang"), path, "csv", "overwrite")
    back = read_csv_rows(spark, path, na_values=(), multi_line=True, large=0)
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")


@query
def table_scan(spark, sf):
    table(spark, sf, "lineitem").createOrReplaceTempView("lineitem_scan")
    return read_table_rows(spark, "lineitem_scan", order_by=["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", F.col("_ord.key.l_orderkey").alias("ord_key"), "l_quantity")


@query
def benchmark_scan(spark, sf):
    """The items as a folder of JSON lists by range of id, read back in file order."""
    path = scratch_path(spark, "benchmark-list")
    items = _doc_items(spark, sf)
    count = items.count()
    # A list holds about a thousand items, so neither a row nor a task grows with the table.
    ranges = items.repartitionByRange(max(1, -(-count // 1000)), "item_seq").withColumn("part", F.spark_partition_id())
    listed = ranges.groupBy("part").agg(F.to_json(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("item_seq").alias("n"), F.struct(*[c for c in items.columns if c != "item_seq"]).alias("item")))),
        lambda x: x["item"])).alias("value"))
    listed.withColumn("part", F.format_string("%010d", "part")).write.partitionBy("part").text(path)
    return read_benchmark(spark, path).select("id", "instruction", "input", "reference", _kw().alias("keywords"), "system", "item_seq")


@query
def model_specs(spark, sf):
    """Specs of a whole table parsed by the column expression."""
    s = table(spark, sf, "supplier")
    adapter = F.when(F.col("s_suppkey") % 3 == 0, F.lit(" - ")).when(F.col("s_suppkey") % 3 == 1, F.lit("none")) \
        .otherwise(F.concat(F.lit("adapters/"), F.col("s_suppkey").cast("string")))
    spec = F.concat(F.lit(" "), F.col("s_name"), F.lit(" :: base-"), F.col("s_nationkey").cast("string"), F.lit("::"), adapter)
    return s.select("s_suppkey", *model_spec_columns(spec))


# ---- prompts and generation (J2, B1-B5, G1-G3) ------------------------------

def _doc_items(spark, sf):
    return document_items(table(spark, sf, "documents"))


@query
def bench_cross_models(spark, sf):
    return items_by_model(_doc_items(spark, sf), model_rows(spark, MODEL_SPECS)).select(
        "id", "model_ord", "model_name", "base_model", "adapter")


@query
def build_prompt(spark, sf):
    p = prompts_for(_doc_items(spark, sf))
    return p.select("id", F.col("messages")[0]["role"].alias("role0"),
                    F.col("messages")[0]["content"].alias("system_content"),
                    F.col("messages")[1]["role"].alias("role1"),
                    F.col("messages")[1]["content"].alias("user_content"))


def _distilled(spark, sf):
    """Distilled records of all items, the padded reference standing for a response."""
    items = _doc_items(spark, sf)
    response = F.concat(F.lit(" \u3000"), F.col("reference"), F.lit("\n "))
    return items.select(*distilled_columns(F.col("instruction"), F.col("input"), response, F.col("system")))


@query
def batch_generate(spark, sf):
    """Every document's prompt through the generation operator: batches, a journal, answers paired by place."""
    prompts = _doc_items(spark, sf).select("instruction", "input", "system")
    return distill(prompts, prompt_writer, {"batch_size": 64}, journal=scratch_path(spark, "journal"))


@query
def model_answers_generated(spark, sf):
    """The evaluation's answers of two models to every part's item, by name, base model and adapter."""
    items = part_items(table(spark, sf, "part"))
    return answers(items, MODEL_SPECS[1:], prompt_writer, {"batch_size": 64}).select("model_name", "model_ord", "item_seq", "id", "answer")


@query
def distilled_round_trip(spark, sf):
    path = scratch_path(spark, "distilled")
    write_table(_distilled(spark, sf), path, "json", "append")
    return spark.read.json(path).select("instruction", "input", "output", "system")


# ---- scores and reports (E1-E6, A1-A5, R1-R7) -------------------------------

def _answers(spark, sf):
    return derived_answers(_doc_items(spark, sf), model_rows(spark, MODEL_SPECS))


def _doc_scores(spark, sf):
    return score_answers(_answers(spark, sf))


def _scores(spark, sf):
    """Scores of three models' answers to the parts' items, whose texts are short enough for SQL to match block by block.

    The table may be one row group, which one task reads: the parts are dealt out
    first, so that the tasks that score and sort the answers follow the parts' number.
    """
    part = table(spark, sf, "part")
    tasks = min(DEALT_MOST, -(-part.count() // SCORED_PARTS))
    dealt = part.repartition(max(1, tasks), "p_partkey", "p_name")
    return score_answers(derived_answers(part_items(dealt), model_rows(spark, MODEL_SPECS)))


@query
def keyword_hit_rate(spark, sf):
    return _doc_scores(spark, sf).select("id", "model_name", "item_seq", "keyword_hit_rate")


@query
def risk_flag(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", has_risk_hint(F.col("text"), LICENSE_HINTS).alias("has_risk_hint"),
                       answer_length(F.col("text")).alias("answer_length"))


@query
def similarity(spark, sf):
    return _scores(spark, sf).select("id", "model_name", "item_seq", "reference_similarity")


@query
def similarity_documents(spark, sf):
    """The ratio of whole documents' answers, by the rules for long texts too (no SQL: matching them there takes hours)."""
    # Comparing is dear and the table may be one row group: the documents are dealt out first, and the answers to
    # one are compared in the same task.
    docs = table(spark, sf, "documents")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // COMPARED_BYTES))
    dealt = document_items(docs.repartition(tasks, "doc_id", "text"))
    return score_answers(derived_answers(dealt, model_rows(spark, MODEL_SPECS))).select("id", "model_name", "item_seq", "reference_similarity")


@query
def similarity_bound(spark, sf):
    a = _answers(spark, sf)
    return a.select("id", "model_name", "item_seq",
                    similarity_upper_bound(F.col("answer"), F.col("reference"))
                    .alias("similarity_bound"))


@query
def score_rows(spark, sf):
    s = _scores(spark, sf)
    return s.select("model_name", "id", "item_seq", "instruction", "reference", _kw().alias("keywords"),
                    "answer", "keyword_hit_rate", "reference_similarity", "has_risk_hint", "answer_length")


def _summary(spark, sf):
    return model_summary(_scores(spark, sf), models_frame(spark, MODEL_SPECS), TEMPLATE)


@query
def model_summary_stub(spark, sf):
    return _summary(spark, sf)


def _comparison(spark, sf):
    return comparison(_scores(spark, sf), MODEL_NAMES)


@query
def comparison_pivot(spark, sf):
    c = _comparison(spark, sf)
    return c.withColumn("keywords", _kw()).withColumn(
        "model_order", F.array_join("model_order", ","))


@query
def detail_report_stub(spark, sf):
    return detail_report(_comparison(spark, sf), list(MODEL_NAMES))


@query
def detail_report_text(spark, sf):
    """The report's texts and flags as display text, '' where a model has no answer."""
    metrics = ("has_risk_hint", "answer")
    return blank_missing(detail_report(comparison(_doc_scores(spark, sf), MODEL_NAMES, metrics), list(MODEL_NAMES), metrics))


@query
def long_report_stub(spark, sf):
    return long_report(_comparison(spark, sf), list(MODEL_NAMES))


@query
def summary_report_stub(spark, sf):
    return summary_report(_summary(spark, sf))


@query
def evaluate_full(spark, sf):
    """Scores stored, then summary and report from the stored rows."""
    path = scratch_path(spark, "scores")
    write_table(_scores(spark, sf), path, "parquet", "overwrite")
    return summary_report(model_summary(spark.read.parquet(path), models_frame(spark, MODEL_SPECS), TEMPLATE))
