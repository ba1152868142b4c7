"""P5 (array and turn-table folds) and P6-P8."""

from pyspark.sql import functions as F

from sftforge.functions.chat import fold_messages
from sftforge.functions.quality import reject_reason
from sftforge.operators.fold import fold_stats, fold_turns, fold_turns_bounded
from tests.conftest import SF

MSG = "array<struct<role:string,content:string,`from`:string,value:string>>"


def fold(spark, msgs, schema=MSG):
    df = spark.createDataFrame([(msgs,)], f"messages {schema}")
    u, a = fold_messages(df)
    return tuple(df.select(u, a).first())


def test_role_and_content_fallbacks(spark):
    msgs = [
        {"role": "", "content": None, "from": "human", "value": " hi\tthere "},
        {"role": "assistant", "content": "  ", "from": None, "value": "x"},
        {"role": "gpt", "content": "first", "from": None, "value": None},
        None,
        {"role": "User", "content": "ignored", "from": None, "value": None},
        {"role": "system", "content": "sys", "from": None, "value": None},
        {"role": "user", "content": "again", "from": None, "value": None},
        {"role": None, "content": "answer 2", "from": "gpt", "value": None},
    ]
    # whitespace-only content does not fall back to value: an empty part, dropped
    assert fold(spark, msgs) == ("hi there\nagain", "first\nanswer 2")


def test_subset_schemas(spark):
    assert fold(spark, [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}],
                "array<struct<role:string,content:string>>") == ("q", "a")
    assert fold(spark, [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}],
                "array<struct<`from`:string,value:string>>") == ("q", "a")
    assert fold(spark, None) == ("", "")


def py_fold(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, role, text))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        norm = [(r, " ".join((t or "").split())) for _, r, t in turns]
        u = "\n".join(p for r, p in norm if r in ("user", "human") and p)
        a = "\n".join(p for r, p in norm if r in ("assistant", "gpt") and p)
        out[conv] = (u, a)
    return out


def test_fold_turns_matches_python_and_small_blocks(spark):
    conv = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in conv.collect()]
    want = py_fold(rows)
    for block in (1, 3, 1024):
        got = {r[0]: (r[1], r[2]) for r in fold_turns(conv, block=block).collect()}
        assert got == want


def test_conversation_without_user_or_assistant_text(spark):
    df = spark.createDataFrame([(1, 0, "system", "s"), (2, 0, "user", "  "),
                                (2, 1, "assistant", "x")], "conv_id long, turn long, role string, text string")
    got = {r[0]: (r[1], r[2]) for r in fold_turns(df).collect()}
    assert got == {1: ("", ""), 2: ("", "x")}


def test_bounded_fold_equals_fold_then_filter(spark):
    conv = spark.read.parquet(f"{SF}/conversations.parquet")
    full = fold_turns(conv)
    want = {r[0]: (r[1], r[2]) for r in full.where(
        reject_reason(F.col("instruction"), F.col("output")).isNull()).collect()}
    got = {r[0]: (r[1], r[2]) for r in fold_turns_bounded(conv).collect()}
    assert got == want
    reasons = {r[0]: r[1] for r in full.select(
        "conv_id", reject_reason(F.col("instruction"), F.col("output"))).collect()}
    stats = {r["conv_id"]: r["reject_reason"] for r in fold_stats(conv).collect()}
    assert stats == reasons


def test_length_bounds_and_garbled(spark):
    i6, o20 = "x" * 6, "y" * 20
    cases = [
        ("x" * 5, o20, "short"), (i6, o20, None), ("x" * 4000, o20, None), ("x" * 4001, o20, "long"),
        (i6, "y" * 19, "short"), (i6, "y" * 6000, None), (i6, "y" * 6001, "long"),
        ("", o20, "missing"), (i6, "", "missing"), (i6 + "�", o20, "garbled"),
        (i6, o20 + "�", "garbled"), ("😀" * 6, o20, None),
    ]
    df = spark.createDataFrame([(i, o) for i, o, _ in cases], "i string, o string")
    got = [r[0] for r in df.select(reject_reason(F.col("i"), F.col("o"))).collect()]
    assert got == [w for _, _, w in cases]


def test_heavy_conversation_is_dropped_before_the_join(spark):
    from sftforge.functions.quality import QualityBounds
    bounds = QualityBounds(min_instruction=1, max_instruction=10, min_output=1, max_output=10)
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", "w") for t in range(60)]  # 60 parts
    rows += [(2, 0, "user", "hello"), (2, 1, "assistant", "world")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    stats = {r["conv_id"]: (r["parts"], r["reject_reason"]) for r in fold_stats(df, bounds=bounds).collect()}
    assert stats == {1: (60, "long"), 2: (2, None)}
    got = [tuple(r) for r in fold_turns_bounded(df, bounds=bounds).collect()]
    assert got == [(2, "hello", "world")]


def test_rows_without_an_id_are_one_conversation(spark):
    rows = [(None, 0, "user", "a question"), (None, 1, "assistant", "an answer that is long enough"),
            (2, 0, "user", "b question"), (2, 1, "assistant", "an answer that is long enough")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert {r[0] for r in fold_turns_bounded(df).collect()} == {None, 2} == {r[0] for r in fold_turns(df).collect()}
    assert {r["conv_id"] for r in fold_stats(df).where("reject_reason IS NULL").collect()} == {None, 2}


def test_large_blocks_fold_as_others(spark):
    conv = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in conv.collect()]
    rows = [(c % 3 if c % 3 else None, None if c % 2 else t // 4, r, x) for c, t, r, x in rows] + [(9, 0, "user", " ")] * 40 + [(8, 0, "system", "s")] * 40
    df = spark.createDataFrame(rows, conv.schema)
    want = {r[0]: tuple(r)[1:] for r in fold_turns(df).collect()}
    for limits in ({"rows": 10}, {"size": 100}, {"rows": 10, "block": 2}):
        assert {r[0]: tuple(r)[1:] for r in fold_turns(df, **limits).collect()} == want
    assert want[9] == want[8] == ("", "")


def test_one_hot_turn_is_spread_over_tasks(spark):
    """90 % of the rows are one conversation's, all of one turn number."""
    from sftforge.operators.fold import _block, sorted_pieces, turn_parts

    hot = spark.range(90_000).selectExpr("1L AS conv_id", "0L AS turn", "'user' AS role", "concat('text ', md5(string(id % 60000))) AS text")
    rest = spark.range(10_000).selectExpr("10 + id AS conv_id", "0L AS turn", "'assistant' AS role", "string(id) AS text")
    turns = hot.unionByName(rest)
    parts = turn_parts(turns.where("conv_id = 1")).withColumn("_blk", _block(1024))
    sizes = sorted(r["count"] for r in sorted_pieces(parts, "conv_id", 8).groupBy("_piece").count().collect())
    assert len(sizes) == 8 and sum(sizes) == 60_000 and sizes[-1] <= 2 * sizes[4]
    got = {r[0]: tuple(r)[1:] for r in fold_turns(turns, rows=1000).collect()}
    texts = sorted(r[0] for r in hot.select("text").collect())
    assert len(got) == 10_001 and got[1] == ("\n".join(texts), "") and got[11] == ("", "1")
