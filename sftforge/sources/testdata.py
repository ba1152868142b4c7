"""Shape the driver's parquet tables into the reference's input layouts.

The driver tables (``documents``, ``conversations``, ``benchmark``, ...) are not
in the shapes the reference reads.  These adapters derive those shapes with
plain Spark expressions, so every derived row comes from (and grows with) the
given tables.  Each adapter has a DuckDB twin in :mod:`sftforge.driver_sql`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftforge.functions.prompts import user_content
from sftforge.functions.scores import RISK_HINT_TOKENS
from sftforge.functions.text import REPLACEMENT_CHAR, normalize_text
from sftforge.operators.project import evaluate_once
from sftforge.plans.evaluate import answer_rows, items_by_model

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# The models whose answers the driver checks derive.
MODEL_SPECS = ("echo::base-a::-", " lead :: base-b :: none", "rest::base-b::adapters/rest")
LATER_COPY = 1_000_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_text(documents: DataFrame):
    """The text, with a letter of the German ones as U+FFFD, as from a wrong decoding."""
    return F.when(F.col("lang") == "de", F.replace(F.col("text"), F.lit("ß"), F.lit(REPLACEMENT_CHAR))).otherwise(F.col("text"))


def document_pairs(documents: DataFrame, columns=("instruction", "output")) -> DataFrame:
    """``(doc_id, instruction, output)``: each the whole normalized text."""
    return evaluate_once(documents.select("doc_id", normalize_text(raw_text(documents)).alias("_text"))).select(
        "doc_id", *[F.col("_text").alias(c) for c in columns])


def flat_rows(documents: DataFrame) -> DataFrame:
    """Raw flat Q/A rows whose column naming depends on the document's language.

    en: instruction/output; fr: blank instruction, question/answer;
    de: query/response with a whitespace-only output; other: prompt/chosen.
    ``title`` (the source) is the last-resort instruction candidate.
    """
    lang, line, text = F.col("lang"), F.col("text"), F.col("text")

    def on(cond, value):
        return F.when(cond, value)
    en, fr, de = lang == "en", lang == "fr", lang == "de"
    other = ~(en | fr | de) | lang.isNull()
    return documents.select(
        "doc_id",
        on(en, line).alias("instruction"),
        on(fr, F.lit("")).alias("instruction_blank"),
        on(fr, line).alias("question"),
        on(de, line).alias("query"),
        on(other, line).alias("prompt"),
        F.col("source").alias("title"),
        on(en, text).alias("output"),
        on(de, F.lit(" \t ")).alias("output_blank"),
        on(fr, text).alias("answer"),
        on(de, text).alias("response"),
        on(other, text).alias("chosen"),
    ).withColumn("instruction", F.coalesce("instruction", "instruction_blank")) \
     .withColumn("output", F.coalesce("output", "output_blank")) \
     .drop("instruction_blank", "output_blank")


def _items(source: DataFrame, key: str, system) -> DataFrame:
    """Items of a text: its first sentence is the instruction (whose words are the
    keywords), the rest the input, the whole the reference."""
    first = F.substring_index(F.col("text"), ".", 1)
    return source.select(
        F.col(key).cast("string").alias("id"),
        first.alias("instruction"),
        F.expr("substring(text, length(substring_index(text, '.', 1)) + 2)").alias("input"),
        F.col("text").alias("reference"),
        F.split(first, " ", -1).alias("keywords"),
        system.alias("system"),
        F.col(key).cast("long").alias("item_seq"),
    )


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    return _items(benchmark, "item_id", F.lit(None).cast("string"))


def document_items(documents: DataFrame) -> DataFrame:
    """Items of all documents; every third has a system prompt of its own."""
    return _items(documents, "doc_id", F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("Answer in "), F.col("lang"))))


def part_items(part: DataFrame) -> DataFrame:
    """Items of all parts, their columns as a short text."""
    text = F.concat("p_name", F.lit(". "), "p_brand", F.lit(", type "), F.lower("p_type"), F.lit(", size "), F.col("p_size").cast("string"))
    return _items(part.select("p_partkey", text.alias("text")), "p_partkey", F.lit(None).cast("string"))


def derived_answers(items: DataFrame, models) -> DataFrame:
    """Answers of three models as expressions over the items, in the jobs' answer columns.

    echo: the user content between blanks; lead: the instruction, with a hint where
    the content has an even length; rest: the input.  ``lead`` has no answer for
    every fifth item, ``rest`` a second, later one (the reference) for every seventh.
    """
    user = user_content(F.col("instruction"), F.col("input"))
    twice = (F.col("model_name") == "rest") & (F.col("item_seq") % 7 == 0)
    rows = items_by_model(items, models).where(~((F.col("model_name") == "lead") & (F.col("item_seq") % 5 == 3)))
    rows = rows.withColumn("_copy", F.explode(F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    hint = F.when(F.length(user) % 2 == 0, F.lit(" " + RISK_HINT_TOKENS[1])).otherwise(F.lit(""))
    response = (F.when(F.col("_copy") == 1, F.col("reference"))
                .when(F.col("model_name") == "echo", F.concat(F.lit("  "), user, F.lit(" \n")))
                .when(F.col("model_name") == "lead", F.concat("instruction", hint))
                .otherwise(F.col("input")))
    return answer_rows(rows.withColumn("response", response)
                       .withColumn("item_seq", F.col("item_seq") + F.col("_copy") * F.lit(LATER_COPY)), "response")


def prompt_writer(options: dict):
    """A generator whose answers SQL can restate: the model's name, then system and user content between blanks."""
    name = options.get("model_name") or "teacher"

    def answer(messages: list[dict]) -> str:
        system, user = (m["content"] for m in messages)
        return f" \u3000{name}|{system}|{user}\n "

    return lambda prompts: [answer(p) for p in prompts]


MESSAGE_SCHEMA = "struct<role:string,content:string,`from`:string,value:string>"


def _message(role, text):
    """A chat message in the mixed layouts of public chat sets: user turns use
    ``from``/``value`` with an empty ``role``; others use ``role``/``content``."""
    is_user = role == "user"
    return F.struct(
        F.when(is_user, F.lit("")).otherwise(role).alias("role"),
        F.when(is_user, F.lit(None).cast("string")).otherwise(text).alias("content"),
        F.when(is_user, F.lit("human")).alias("from"),
        F.when(is_user, text).alias("value"))


def chat_rows(conversations: DataFrame) -> DataFrame:
    """Raw chat rows ``(conv_id, pair, messages)``: all rows of turns 2k and 2k+1 together, in turn order."""
    turn = F.struct("turn", F.col("text").alias("t"), F.col("role").alias("r"))
    grouped = conversations.groupBy("conv_id", F.floor(F.col("turn") / 2).alias("pair")).agg(
        F.array_sort(F.collect_list(turn)).alias("turns"))
    return grouped.select("conv_id", "pair", F.transform("turns", lambda x: _message(x["r"], x["t"])).alias("messages"))
