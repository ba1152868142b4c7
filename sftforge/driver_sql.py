"""DuckDB restatements of :mod:`sftforge.queries` (the correctness oracle).

Written independently of the Spark code: each statement spells out the
operator's semantics in plain SQL over the driver's views.
"""

from __future__ import annotations

from sftforge.functions.prompts import DEFAULT_SYSTEM_PROMPT, INPUT_SEPARATOR
from sftforge.functions.scores import RISK_HINT_TOKENS
from sftforge.functions.text import WHITESPACE_CLASS_RE2 as WS
from sftforge.queries import (
    LICENSE_HINTS, PROMPT_CAP, SAMPLE_CAP, SEED, TEMPLATE)

SYSTEM = "'" + DEFAULT_SYSTEM_PROMPT.replace("'", "''") + "'"
SEP = "'" + INPUT_SEPARATOR.replace("'", "''") + "'"
HINT = "' " + RISK_HINT_TOKENS[1] + "'"
NL = "chr(10)"


def norm(x: str) -> str:
    return f"trim(regexp_replace(coalesce(CAST({x} AS VARCHAR), ''), '{WS}+', ' ', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '\\A{WS}+|{WS}+\\z', '', 'g')"


def reason(i: str, o: str) -> str:
    return (f"CASE WHEN {i} = '' OR {o} = '' THEN 'missing' "
            f"WHEN contains({i}, chr(65533)) OR contains({o}, chr(65533)) THEN 'garbled' "
            f"WHEN length({i}) < 6 OR length({o}) < 20 THEN 'short' "
            f"WHEN length({i}) > 4000 OR length({o}) > 6000 THEN 'long' END")


def skey(i: str = "instruction", inp: str = "input") -> str:
    return f"md5('{SEED}|' || {i} || '|' || {inp})"


def round4(x: str) -> str:
    """By the exact decimal value of the double, as C's printf prints it."""
    return f"CAST(printf('%.4f', {x}) AS DOUBLE)"


RAW = "CASE WHEN lang = 'de' THEN replace(text, 'ß', chr(65533)) ELSE text END"

PAIRS = f"""(SELECT doc_id, {norm(RAW)} AS instruction, {norm(RAW)} AS output FROM documents)"""

RECORDS = f"""(SELECT doc_id, instruction, output, {reason('instruction', 'output')} AS reject_reason
   FROM {PAIRS})"""

KEPT_UNIQUE = f"""(SELECT instruction, input, output, system FROM (
   SELECT instruction, '' AS input, output, {SYSTEM} AS system,
          row_number() OVER (PARTITION BY instruction ORDER BY doc_id) AS rn
   FROM {RECORDS} WHERE reject_reason IS NULL) WHERE rn = 1)"""

FLAT = f"""(SELECT doc_id,
   coalesce(CASE WHEN lang = 'en' THEN text END,
            CASE WHEN lang = 'fr' THEN '' END) AS instruction,
   CASE WHEN lang = 'fr' THEN text END AS question,
   CASE WHEN lang = 'de' THEN text END AS query,
   CASE WHEN lang NOT IN ('en', 'fr', 'de') OR lang IS NULL
        THEN text END AS prompt,
   source AS title,
   coalesce(CASE WHEN lang = 'en' THEN text END,
            CASE WHEN lang = 'de' THEN ' ' || chr(9) || ' ' END) AS output,
   CASE WHEN lang = 'fr' THEN text END AS answer,
   CASE WHEN lang = 'de' THEN text END AS response,
   CASE WHEN lang NOT IN ('en', 'fr', 'de') OR lang IS NULL THEN text END AS chosen
 FROM documents)"""


def first_nonempty(*cols: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({norm(c)}, '')" for c in cols) + ", '')"


PICKED = f"""(SELECT doc_id,
   {first_nonempty('instruction', 'question', 'query', 'prompt', 'title')} AS instruction,
   {first_nonempty('output', 'answer', 'response', 'chosen')} AS output FROM {FLAT})"""

PARTS = f"""(SELECT conv_id, turn,
   CASE WHEN role IN ('user', 'human') THEN 'user'
        WHEN role IN ('assistant', 'gpt') THEN 'assistant' END AS side,
   {norm('text')} AS part FROM conversations)"""

FOLDED = f"""(SELECT conv_id,
   coalesce(string_agg(part, {NL} ORDER BY turn, part) FILTER (WHERE side = 'user' AND part <> ''), '')
     AS instruction,
   coalesce(string_agg(part, {NL} ORDER BY turn, part) FILTER (WHERE side = 'assistant' AND part <> ''), '')
     AS output
 FROM {PARTS} GROUP BY conv_id)"""

CONV_RECORDS = f"""(SELECT conv_id, instruction, output,
   {reason('instruction', 'output')} AS reject_reason FROM {FOLDED})"""

CONV_UNIQUE = f"""(SELECT instruction, input, output, system FROM (
   SELECT instruction, '' AS input, output, {SYSTEM} AS system,
          row_number() OVER (PARTITION BY instruction ORDER BY conv_id) AS rn
   FROM {CONV_RECORDS} WHERE reject_reason IS NULL) WHERE rn = 1)"""

FLAT_UNIQUE = f"""(SELECT instruction, input, output, system FROM (
   SELECT instruction, '' AS input, output, {SYSTEM} AS system,
          row_number() OVER (PARTITION BY instruction ORDER BY doc_id) AS rn
   FROM {PICKED} WHERE {reason('instruction', 'output')} IS NULL) WHERE rn = 1)"""

CHAT_FOLDED = f"""(SELECT conv_id, turn // 2 AS pair,
   coalesce(string_agg(part, {NL} ORDER BY turn, text, role) FILTER (WHERE side = 'user' AND part <> ''), '') AS instruction,
   coalesce(string_agg(part, {NL} ORDER BY turn, text, role) FILTER (WHERE side = 'assistant' AND part <> ''), '') AS output
 FROM (SELECT *, CASE WHEN role = 'user' THEN 'user' WHEN role IN ('assistant', 'gpt') THEN 'assistant' END AS side,
              {norm('text')} AS part FROM conversations)
 GROUP BY conv_id, turn // 2)"""

CHAT_UNIQUE = f"""(SELECT instruction, input, output, system FROM (
   SELECT instruction, '' AS input, output, {SYSTEM} AS system,
          row_number() OVER (PARTITION BY instruction ORDER BY conv_id, pair) AS rn
   FROM {CHAT_FOLDED} WHERE {reason('instruction', 'output')} IS NULL) WHERE rn = 1)"""

def items(source: str, key: str, system: str) -> str:
    return f"""(SELECT CAST({key} AS VARCHAR) AS id, {key} AS item_seq,
   split_part(text, '.', 1) AS instruction,
   substr(text, length(split_part(text, '.', 1)) + 2) AS input,
   text AS reference, string_split(split_part(text, '.', 1), ' ') AS keywords, {system} AS system
 FROM {source})"""


ITEMS = items("benchmark", "item_id", "CAST(NULL AS VARCHAR)")
PART_TEXT = "p_name || '. ' || p_brand || ', type ' || lower(p_type) || ', size ' || p_size"
PART_ITEMS = items(f"(SELECT p_partkey, {PART_TEXT} AS text FROM part)", "p_partkey", "CAST(NULL AS VARCHAR)")
DOC_ITEMS = items("documents", "doc_id", "CASE WHEN doc_id % 3 = 0 THEN 'Answer in ' || lang END")

USER = (f"CASE WHEN coalesce(input, '') <> '' THEN instruction || {SEP} || input "
        f"ELSE instruction END")

MODELS = """(SELECT * FROM (VALUES
   (0, 'echo', 'base-a', CAST(NULL AS VARCHAR)),
   (1, 'lead', 'base-b', CAST(NULL AS VARCHAR)),
   (2, 'rest', 'base-b', 'adapters/rest'))
 AS m(model_ord, model_name, base_model, adapter))"""

LEAD = f"{strip(f'instruction || CASE WHEN length(u) % 2 = 0 THEN {HINT} ELSE {chr(39)}{chr(39)} END')}"

def answers(source: str) -> str:
    return f"""(WITH it AS (SELECT *, {USER} AS u FROM {source})
 SELECT 'echo' AS model_name, 0 AS model_ord, item_seq, id, instruction, reference, keywords,
        {strip(f"'  ' || u || ' ' || {NL}")} AS answer FROM it
 UNION ALL
 SELECT 'lead', 1, item_seq, id, instruction, reference, keywords, {LEAD} FROM it WHERE item_seq % 5 <> 3
 UNION ALL
 SELECT 'rest', 2, item_seq, id, instruction, reference, keywords, {strip('input')} FROM it
 UNION ALL
 SELECT 'rest', 2, item_seq + 1000000000000, id, instruction, reference, keywords, {strip('reference')} FROM it
 WHERE item_seq % 7 = 0)"""


ANSWERS, PART_ANSWERS = answers(DOC_ITEMS), answers(PART_ITEMS)

# The longest common substring of a and b, first in a, then first in b.  For texts of under 200
# characters, as these are, in which no character is kept from starting a block.
LONGEST = """list_sort(list_filter(flatten(list_transform(range(1, length(a) + 1), lambda i:
   list_transform(range(1, length(a) - i + 2), lambda k: CASE WHEN contains(b, substr(a, i, k)) THEN {'k': -k, 'i': i} END))),
   lambda x: x IS NOT NULL))[1]"""

RATIOS = f"""(WITH RECURSIVE blocks AS (
   SELECT answer, reference, a, b, {LONGEST} AS best FROM (SELECT DISTINCT answer, reference, answer AS a, reference AS b FROM {PART_ANSWERS})
   UNION ALL
   SELECT answer, reference, a, b, {LONGEST} AS best FROM (
     SELECT answer, reference, part.a AS a, part.b AS b FROM (
       SELECT answer, reference, unnest([{{'a': substr(a, 1, best.i - 1), 'b': substr(b, 1, j - 1)}},
                                         {{'a': substr(a, best.i - best.k), 'b': substr(b, j - best.k)}}]) AS part
       FROM (SELECT *, instr(b, substr(a, best.i, -best.k)) AS j FROM blocks WHERE best IS NOT NULL)))
   WHERE a <> '' AND b <> '')
 SELECT answer, reference, CASE WHEN length(answer) + length(reference) = 0 THEN 1.0
        ELSE 2.0 * coalesce(sum(-best.k), 0) / (length(answer) + length(reference)) END AS reference_similarity
 FROM blocks GROUP BY answer, reference)"""

KW_RATE = ("CASE WHEN len(keywords) = 0 THEN 0.0 ELSE "
           "CAST(len(list_filter(keywords, lambda k: k <> '' AND contains(answer, k))) AS DOUBLE)"
           " / len(keywords) END")

HINTS = " OR ".join(f"contains(answer, '{t}')" for t in RISK_HINT_TOKENS)

RATED = f"""{KW_RATE} AS keyword_hit_rate, ({HINTS}) AS has_risk_hint, CAST(length(answer) AS INTEGER) AS answer_length"""
DOC_SCORES = f"(SELECT *, {RATED} FROM {ANSWERS})"
SCORES = f"(SELECT *, {RATED} FROM {PART_ANSWERS} JOIN {RATIOS} AS ratios USING (answer, reference))"

SUMMARY = f"""(SELECT m.model_ord, m.model_name, m.base_model, m.adapter,
   '{TEMPLATE}' AS template, coalesce(s.n, 0) AS num_examples,
   coalesce(s.kw, 0.0) AS avg_keyword_hit_rate, coalesce(s.sim, 0.0) AS avg_reference_similarity,
   coalesce(s.rr, 0.0) AS risk_hint_rate
 FROM {MODELS} m LEFT JOIN (
   SELECT model_name, count(*) AS n, round(avg(keyword_hit_rate), 12) AS kw,
          round(avg(reference_similarity), 12) AS sim,
          round(avg(CAST(has_risk_hint AS DOUBLE)), 12) AS rr FROM {SCORES} GROUP BY model_name) s
 USING (model_name))"""

MODEL_NAMES = ("echo", "lead", "rest")


def _cells(metrics) -> str:
    out = []
    for m in MODEL_NAMES:
        for x in metrics:
            out.append(f"arg_max({x}, item_seq) FILTER (WHERE model_name = '{m}') AS {m}_{x}")
    return ",\n   ".join(out)


def compared(scores: str, metrics) -> str:
    return f"""(SELECT id,
   first(instruction ORDER BY model_ord, item_seq) AS instruction,
   first(reference ORDER BY model_ord, item_seq) AS reference,
   first(keywords ORDER BY model_ord, item_seq) AS keywords,
   {_cells(metrics)}
 FROM {scores} GROUP BY id)"""


COMPARISON = compared(SCORES, ('answer', 'keyword_hit_rate', 'reference_similarity', 'has_risk_hint'))
DOC_COMPARISON = compared(DOC_SCORES, ('answer', 'has_risk_hint'))


def _detail_cols() -> str:
    out = []
    for m in MODEL_NAMES:
        out += [f"{round4(f'{m}_keyword_hit_rate')} AS {m}_keyword_hit_rate",
                f"{round4(f'{m}_reference_similarity')} AS {m}_reference_similarity",
                f"{m}_has_risk_hint", f"{m}_answer"]
    return ", ".join(out)


def _long_rows() -> str:
    parts = []
    for i, m in enumerate(MODEL_NAMES):
        parts.append(
            f"SELECT id, instruction, reference, array_to_string(keywords, ', ') AS keywords, "
            f"{i} AS model_ord, '{m}' AS model_name, "
            f"{round4(f'{m}_keyword_hit_rate')} AS keyword_hit_rate, "
            f"{round4(f'{m}_reference_similarity')} AS reference_similarity, "
            f"{m}_has_risk_hint AS has_risk_hint, {m}_answer AS answer FROM {COMPARISON}")
    return "\nUNION ALL\n".join(parts)


def split(instruction: str) -> str:
    return (f"CASE WHEN CAST('0x' || substr(md5('{SEED}|holdout|' || {instruction} || '|'), 1, 8) AS BIGINT) "
            f"% 10000 < 200 THEN 'eval' ELSE 'train' END")


ORACLE_SQL: dict[str, str] = {
    "normalize_text_docs": f"""SELECT doc_id, {norm('text')} AS text,
        CAST(length({norm('text')}) AS INTEGER) AS n_chars FROM documents""",
    "pick_first": f"SELECT doc_id, instruction, output FROM {PICKED}",
    "messages_fold": f"SELECT conv_id, instruction, output FROM {FOLDED}",
    "messages_fold_one_turn": f"""SELECT conv_id, length(instruction) AS instruction_chars, md5(instruction) AS instruction_md5,
        length(output) AS output_chars, md5(output) AS output_md5 FROM (SELECT conv_id % 2 AS conv_id,
        coalesce(string_agg(part, {NL} ORDER BY part) FILTER (WHERE side = 'user' AND part <> ''), '') AS instruction,
        coalesce(string_agg(part, {NL} ORDER BY part) FILTER (WHERE side = 'assistant' AND part <> ''), '') AS output
        FROM {PARTS} GROUP BY 1)""",
    "messages_array_fold": f"SELECT conv_id, pair, instruction, output FROM {CHAT_FOLDED}",
    "prepare_chat_train": f"""SELECT instruction, input, output, system FROM {CHAT_UNIQUE}""",
    "quality_filter": f"SELECT doc_id, instruction, output FROM {RECORDS} WHERE reject_reason IS NULL",
    "reject_counts": f"""SELECT coalesce(reject_reason, 'kept') AS reject_reason, count(*) AS n
        FROM {RECORDS} GROUP BY 1""",
    "alpaca_project": f"""SELECT doc_id, instruction, '' AS input, output, {SYSTEM} AS system
        FROM {RECORDS} WHERE reject_reason IS NULL""",
    "dedup_first_docs": f"""SELECT instruction, input, doc_id, lang, source FROM (
        SELECT {norm('text')} AS instruction, '' AS input, doc_id, lang, source,
               row_number() OVER (PARTITION BY {norm('text')} ORDER BY doc_id) AS rn
        FROM documents) WHERE rn = 1""",
    "sample_cap": f"""SELECT instruction, input, output, system, {skey()} AS sample_key
        FROM {KEPT_UNIQUE} ORDER BY sample_key, instruction, input LIMIT {SAMPLE_CAP}""",
    "prompt_subset": f"""SELECT instruction, input, system, {skey()} AS sample_key
        FROM {KEPT_UNIQUE} ORDER BY sample_key, instruction, input LIMIT {PROMPT_CAP}""",
    "holdout_split_docs": f"SELECT doc_id, {split('instruction')} AS split FROM {PAIRS}",
    "union_splits_docs_pages": """SELECT 0 AS split_ord, doc_id AS row_id, text, lang, source
        FROM documents
        UNION ALL BY NAME
        SELECT 1 AS split_ord, page_id AS row_id, url, html FROM pages""",
    "prepare_train": f"""SELECT instruction, input, output, system FROM {CONV_UNIQUE}""",
    "prepare_prompts": f"SELECT instruction, input, system FROM {CONV_UNIQUE}",
    "run_prepare_written": f"""SELECT instruction, input, output, system, {split('instruction')} AS split
        FROM {CONV_UNIQUE}""",
    "run_prepare_counts": f"""SELECT 'train' AS name, count(*) AS n FROM {CONV_UNIQUE}
        UNION ALL SELECT 'prompts', least(count(*), {PROMPT_CAP}) FROM {CONV_UNIQUE}""",
    "prepare_published": f"""WITH t AS (SELECT *, {skey()} AS k FROM {CONV_UNIQUE}),
        p AS (SELECT * FROM t ORDER BY k, instruction, input LIMIT {PROMPT_CAP})
        SELECT 'train' AS name, (SELECT count(*) FROM t) AS n, instruction, system FROM t
        UNION ALL SELECT 'prompts', (SELECT count(*) FROM p), instruction, system FROM p""",
    "prepare_rejects": f"""SELECT coalesce(reject_reason, 'kept') AS reject_reason, count(*) AS n
        FROM {CONV_RECORDS} GROUP BY 1""",
    "prepare_flat_train": f"""SELECT instruction, input, output, system FROM {FLAT_UNIQUE}""",
    "json_round_trip": f"""SELECT id, instruction, input, reference,
        array_to_string(keywords, ', ') AS keywords, system FROM {ITEMS}""",
    "registry_load": f"SELECT id, instruction, reference FROM {ITEMS}",
    "csv_round_trip": "SELECT page_id, url, html FROM pages",
    "csv_by_range": "SELECT doc_id, text, lang FROM documents",
    "prompts_round_trip": f"SELECT instruction, input, system FROM {CONV_UNIQUE}",
    "model_results_round_trip": f"""SELECT model_ord, model_name, base_model, adapter,
        template, num_examples, avg_keyword_hit_rate, avg_reference_similarity, risk_hint_rate FROM {SUMMARY}""",
    "table_scan": "SELECT l_orderkey, l_linenumber, l_orderkey AS ord_key, l_quantity FROM lineitem",
    "benchmark_scan": f"""SELECT id, instruction, input, reference, array_to_string(keywords, ', ') AS keywords, system,
        row_number() OVER (ORDER BY item_seq) - 1 AS item_seq FROM {DOC_ITEMS}""",
    "model_specs": """SELECT s_suppkey, trim(s_name) AS model_name, 'base-' || s_nationkey AS base_model,
        CASE WHEN s_suppkey % 3 = 2 THEN 'adapters/' || s_suppkey END AS adapter FROM supplier""",
    "similarity": f"SELECT id, model_name, item_seq, reference_similarity FROM {SCORES}",
    "model_result_rows": f"""SELECT model_name, id, item_seq, answer, keyword_hit_rate, reference_similarity,
        has_risk_hint, answer_length FROM {SCORES}""",
    "evaluate_full": f"""SELECT model_ord, model_name, num_examples,
        {round4('avg_keyword_hit_rate')} AS avg_keyword_hit_rate,
        {round4('avg_reference_similarity')} AS avg_reference_similarity,
        {round4('risk_hint_rate')} AS risk_hint_rate FROM {SUMMARY}""",
    "detail_report_text": "SELECT id, instruction, reference, coalesce(array_to_string(keywords, ', '), '') AS keywords, "
        + ", ".join(f"coalesce(CAST({m}_{x} AS VARCHAR), '') AS {m}_{x}" for m in MODEL_NAMES
                    for x in ("has_risk_hint", "answer")) + f" FROM {DOC_COMPARISON}",
    "bench_cross_models": f"""SELECT i.id, m.model_ord, m.model_name, m.base_model, m.adapter
        FROM {DOC_ITEMS} i, {MODELS} m""",
    "build_prompt": f"""SELECT id, 'system' AS role0, coalesce(system, {SYSTEM}) AS system_content,
        'user' AS role1, {USER} AS user_content FROM {DOC_ITEMS}""",
    "batch_generate": f"""SELECT instruction, coalesce(input, '') AS input,
        {strip(f"'teacher|' || coalesce(system, '') || '|' || {USER}")} AS output, coalesce(system, '') AS system FROM {DOC_ITEMS}""",
    "model_answers_generated": f"""SELECT model_name, model_ord - 1 AS model_ord, item_seq, id,
        {strip(f"model_name || '|' || {SYSTEM} || '|' || {USER}")} AS answer FROM {PART_ITEMS}, {MODELS} WHERE model_ord > 0""",
    "distilled_round_trip": f"""SELECT instruction, coalesce(input, '') AS input,
        {strip(f"' ' || chr(12288) || reference || {NL} || ' '")} AS output, coalesce(system, '') AS system FROM {DOC_ITEMS}""",
    "keyword_hit_rate": f"SELECT id, model_name, item_seq, keyword_hit_rate FROM {DOC_SCORES}",
    "risk_flag": "SELECT doc_id, (" + " OR ".join(
        f"contains(coalesce(text, ''), '{t}')" for t in LICENSE_HINTS)
        + ") AS has_risk_hint, CAST(length(coalesce(text, '')) AS INTEGER) AS answer_length "
          "FROM documents",
    "similarity_bound": f"""SELECT id, model_name, item_seq,
        CASE WHEN length(answer) + length(reference) = 0 THEN 1.0
             ELSE 2.0 * least(length(answer), length(reference))
                  / CAST(length(answer) + length(reference) AS DOUBLE) END AS similarity_bound
        FROM {ANSWERS}""",
    "score_rows": f"""SELECT model_name, id, item_seq, instruction, reference,
        array_to_string(keywords, ', ') AS keywords, answer, keyword_hit_rate, reference_similarity, has_risk_hint,
        answer_length FROM {SCORES}""",
    "model_summary_stub": f"SELECT * FROM {SUMMARY}",
    "comparison_pivot": f"""SELECT * REPLACE (array_to_string(keywords, ', ') AS keywords),
        'echo,lead,rest' AS model_order FROM {COMPARISON}""",
    "detail_report_stub": f"""SELECT id, instruction, reference,
        array_to_string(keywords, ', ') AS keywords, {_detail_cols()} FROM {COMPARISON}""",
    "long_report_stub": _long_rows(),
    "summary_report_stub": f"""SELECT model_ord, model_name, num_examples,
        {round4('avg_keyword_hit_rate')} AS avg_keyword_hit_rate,
        {round4('avg_reference_similarity')} AS avg_reference_similarity,
        {round4('risk_hint_rate')} AS risk_hint_rate FROM {SUMMARY}""",
}
