import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sftforge.llm import chat as C

from .helpers import rows_of, stored


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in groups.items():
        turns.sort()
        said = "".join(t[3] for t in turns if t[2] == "assistant")
        size = sum(len(f"<|turn|>{C.escape(t[2])}<|says|>{C.escape(t[3])}<|end|>\n") for t in turns)
        out[conv] = (len(turns), sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns)), len(said), sha(said), size)
    return out


def got(df):
    rows = rows_of(df)
    out = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["formatted_chars"]) for r in rows}
    assert len(out) == len(rows)
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<", "|", "\\", "[", "]", "INST", "/", "s>", "SYS", ">>", "turn|>", "<|end|>\n", "é", "x\n"])))
def test_escape_is_reversible_and_leaves_no_control_string(parts):
    text = "".join(parts)
    escaped = C.escape(text)
    assert C.unescape(escaped) == text
    for mark in ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]"):
        assert mark not in escaped
    turn = C.format_turn(text, [{"kind": "text", "text": text}])["formatted"]
    assert C.read_turn(turn) == (text, text, [])


def test_visitor_flattens_typed_parts():
    parts = [{"kind": "text", "text": "see <"}, {"kind": "text", "text": "|x"}, {"kind": "image", "ref": "a.png", "width": 30, "height": 14},
             None, {"kind": "video"}, {"kind": "text", "text": None}, {"kind": "audio", "ref": "b.wav", "seconds": 1.5},
             {"kind": "text", "text": "</s>"}, {"kind": "document", "ref": "c.pdf", "pages": 2}, {"kind": "image", "ref": None}]
    turn = C.format_turn("assistant", parts)
    f = turn["formatted"]
    assert f == "<|turn|>assistant<|says|>see <\\|x<|image|><|audio|><\\/s><|document|><|image|><|end|>\n"
    assert [f[s["start"]:s["stop"]] for s in turn["loss"]] == ["see <\\|x", "<\\/s>"]
    assert [(a["kind"], a["ref"], a["tokens"]) for a in turn["attachments"]] == [
        ("image", "a.png", 3), ("audio", "b.wav", 38), ("document", "c.pdf", 1024), ("image", None, 0)]
    assert all(f[a["at"]:].startswith(f"<|{a['kind']}|>") for a in turn["attachments"])
    assert turn["expanded_tokens"] == 1065
    assert C.read_turn(f) == ("assistant", "see <|x</s>", ["image", "audio", "document", "image"])
    assert C.format_turn("user", parts)["loss"] == [] and C.format_turn(None, None)["formatted"] == "<|turn|><|says|><|end|>\n"


@pytest.mark.parametrize("ranges", [1, 7])
def test_edge_cases(spark, tmp_dir, ranges):
    rng = random.Random(6)
    says = [None, "", "</s>[INST] ok [/INST]", "é日\n", "<|turn|>user", "long " * 4000, "x"]
    rows = [(rng.choice([1, 2, 3, None, 5, 5, 5, 5]), rng.choice([0, 1, 2, 3, None]), rng.choice(["user", "assistant", None, "[INST]"]),
             rng.choice(says), "f", 1) for _ in range(120)]
    rows += [(9, i, "assistant", f"t{i}", "f", 1) for i in range(3000)]  # spans ranges
    frame = stored(spark, rows, "conv_id long, turn long, role string, text string, formatted string, range int", tmp_dir)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(C.read_back(C.text_turns(frame))) == brute([r[:4] for r in rows])
        assert rows_of(C.read_back(C.text_turns(frame.where("conv_id > 90")))) == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_parts_through_spark(spark):
    rows = [(1, 0, "user", [("image", None, "a", 28, 28, None, None), ("text", "q", None, None, None, None, None)]), (1, 1, "assistant", None)]
    frame = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {C.PARTS}")
    out = rows_of(C.format_turns(frame))
    assert [r["expanded_tokens"] for r in out] == [4, 0] and out[0]["attachments"][0]["ref"] == "a"
    assert rows_of(C.read_back(frame))[0]["n_attachments"] == 1
