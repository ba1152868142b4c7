"""Operator 1, chat formatting with typed content parts.

A turn's content is a list of parts: text, image, audio or document.  A visitor
flattens it into one string: texts stand as they are (joined, then escaped) and
each attachment leaves a placeholder in its place, its reference and the number
of tokens that it expands to being recorded in the same order.  A turn reads

    <|turn|>ROLE<|says|>CONTENT<|end|>\\n

Control strings (these marks and those of other common templates) that occur in
roles or texts get a backslash behind their first sign, one more if they have
some already, so texts can't forge marks and reading back undoes it exactly.
The loss mask holds the code point spans of assistant texts, placeholders apart.

Turns are formatted row by row.  Reading whole conversations back needs their
turns in order: rows are dealt in ranges of (conversation, turn), a task digests
what lies whole within it, and only the conversations at a range's two ends are
handed on, as one piece a range, and joined in order as a stream.  A very long
conversation so never sits in one task's memory; its digest, sequential by
nature, is the only work done in one place.

Edge cases: null roles and texts are empty, null or unknown parts are skipped,
missing sizes count as 0; rows of equal turn come by role, then text, null turns
first; rows without conversation id form one conversation; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftforge.llm.common import documents, prepare

#: First sign, backslashes, rest of each control string.  Fixed values: own marks, then those of common templates.
CONTROL = re.compile(r"([<\[])(\\*)(\||/?s>|</?SYS>>|/?INST\])")
ESCAPED = re.compile(r"([<\[])\\(\\*)(\||/?s>|</?SYS>>|/?INST\])")
TURN = re.compile(r"<\|turn\|>(.*?)<\|says\|>(.*?)<\|end\|>\n", re.S)
PLACEHOLDER = re.compile(r"<\|(image|audio|document)\|>")

#: Characters of a text that a range's edge may hold.
HEAD = 256
PARTS = ("array<struct<kind string, text string, ref string, width int, height int, seconds double, pages int>>")
TURNS = ("conv_id long, turn long, formatted string, loss array<struct<start int, stop int>>, "
         "attachments array<struct<kind string, ref string, at int, tokens int>>, expanded_tokens long")


def escape(text: str) -> str:
    return CONTROL.sub(r"\1\2\\\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


@dataclass
class Flattener:
    """Visitor of a turn's parts.  Sizes: square image patches, audio tokens a second, tokens a page."""

    patch: int = 14
    per_second: float = 25.0
    per_page: int = 512
    out: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    _text: list[str] = field(default_factory=list)
    texts: list[tuple[int, int]] = field(default_factory=list)
    size: int = 0

    def visit(self, part: dict | None) -> None:
        how = getattr(self, f"visit_{(part or {}).get('kind')}", None)
        if how:
            how(part)

    def visit_text(self, part: dict) -> None:
        self._text.append(part.get("text") or "")

    def visit_image(self, part: dict) -> None:
        side = lambda n: ceil(max(n or 0, 0) / self.patch)
        self._attach(part, side(part.get("width")) * side(part.get("height")))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, ceil(max(part.get("seconds") or 0.0, 0.0) * self.per_second))

    def visit_document(self, part: dict) -> None:
        self._attach(part, max(part.get("pages") or 0, 0) * self.per_page)

    def _attach(self, part: dict, tokens: int) -> None:
        self._flush()
        self.attachments.append({"kind": part["kind"], "ref": part.get("ref"), "at": self.size, "tokens": tokens})
        self._put(f"<|{part['kind']}|>")

    def _flush(self) -> None:
        """Texts side by side are escaped as one, so that no control string forms where they meet."""
        text = escape("".join(self._text))
        self._text.clear()
        if text:
            self.texts.append((self.size, self.size + len(text)))
            self._put(text)

    def _put(self, text: str) -> None:
        self.out.append(text)
        self.size += len(text)

    def content(self) -> str:
        self._flush()
        return "".join(self.out)


def format_turn(role: str | None, parts: list[dict | None] | None, **sizes) -> dict:
    """formatted, loss, attachments (``at``: code point of the placeholder) and expanded_tokens of a turn."""
    flat = Flattener(**sizes)
    for part in parts or []:
        flat.visit(part)
    content = flat.content()
    head = f"<|turn|>{escape(role or '')}<|says|>"
    shift = len(head)
    return {
        "formatted": f"{head}{content}<|end|>\n",
        "loss": [{"start": s + shift, "stop": e + shift} for s, e in flat.texts] if role == "assistant" else [],
        "attachments": [a | {"at": a["at"] + shift} for a in flat.attachments],
        "expanded_tokens": sum(a["tokens"] for a in flat.attachments),
    }


def read_turn(formatted: str) -> tuple[str, str, list[str]]:
    """Role, text (attachments left out) and kinds of attachments of a formatted turn."""
    role, content = TURN.fullmatch(formatted).groups()
    pieces = PLACEHOLDER.split(content)
    return unescape(role), "".join(map(unescape, pieces[::2])), pieces[1::2]


def format_turns(rows: DataFrame, **sizes) -> DataFrame:
    """Each row of ``rows(conv_id, turn, role, parts)`` formatted, in the rows' order and partitions."""
    prepare(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [format_turn(r, p, **sizes) for r, p in zip(batch.column("role").to_pylist(), batch.column("parts").to_pylist())]
            extra = pa.Table.from_pylist(done, schema=_EXTRA).combine_chunks().to_batches() if done else []
            for more in extra:
                yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("turn"), *more.columns],
                                                 names=["conv_id", "turn", *more.schema.names])

    return rows.select("conv_id", "turn", "role", "parts").mapInArrow(run, TURNS)


_EXTRA = pa.schema([
    ("formatted", pa.string()),
    ("loss", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
    ("attachments", pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int32()), ("tokens", pa.int32())]))),
    ("expanded_tokens", pa.int64()),
])


class Digest:
    """What is read back of one conversation, turn by turn."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = self.n_attachments = self.expanded = 0

    def add(self, formatted: str, loss: list[dict], expanded: int) -> None:
        role, text, attached = read_turn(formatted)
        self.turns.update(f"{role}\n{text}\n".encode())
        for span in loss:
            said = unescape(formatted[span["start"]:span["stop"]])
            self.loss.update(said.encode())
            self.loss_chars += len(said)
        self.n_turns += 1
        self.formatted_chars += len(formatted)
        self.n_attachments += len(attached)
        self.expanded += expanded

    def row(self) -> tuple:
        return (self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(),
                self.formatted_chars, self.n_attachments, self.expanded)


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, n_attachments long, expanded_tokens long")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in DIGESTS.split(", ")]
    kinds = [pa.string() if "sha256" in n else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def read_back(turns: DataFrame) -> DataFrame:
    """Digests of whole conversations from rows (conv_id, turn, role, parts): format each turn, then read it again."""
    key = F.transform("parts", lambda p: F.coalesce(p["text"], F.lit("")))
    # The range sampler brings its keys to the driver: heads of the texts, in the order of the texts themselves.
    long_role = F.length("role") > HEAD
    head = F.when(~long_role, F.substring(F.get(key, F.lit(0)), 1, HEAD))
    ordered = (turns.repartitionByRange("conv_id", "turn", F.substring("role", 1, HEAD), long_role, head)
               .sortWithinPartitions("conv_id", "turn", "role", key))
    formatted = format_turns(ordered).withColumn("range", F.spark_partition_id())
    pieces = formatted.select("range", "conv_id", "formatted", "loss", "expanded_tokens")

    def columns(batch: pa.RecordBatch):
        return zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss", "expanded_tokens")))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole conversations as digests; turns of the range's first and last one handed on."""
        def handed(part, conv, turns_):
            return pa.RecordBatch.from_arrays(
                [pa.array([True]), pa.array([part], pa.int32()), pa.array([conv], pa.int64()),
                 pa.array([[{"formatted": f, "loss": x, "expanded": e} for f, x, e in turns_]], _TURN_LIST),
                 *[pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())]],
                names=_PIECE)

        def closed(rows):
            b = _digest_batch(rows)
            n = len(rows)
            return pa.RecordBatch.from_arrays([pa.array([False] * n), pa.nulls(n, pa.int32()), b.column(0), pa.nulls(n, _TURN_LIST), *b.columns[1:]],
                                              names=_PIECE)

        now, own, first, part, done = object(), [], True, None, []
        start = now
        for batch in batches:
            part = batch.column("range")[0].as_py() if batch.num_rows else part
            for conv, text, loss, expanded in columns(batch):
                if conv != now:
                    if now is not start:
                        if first:
                            yield handed(part, now, own)
                        else:
                            d = Digest()
                            for t in own:
                                d.add(*t)
                            done.append((now, *d.row()))
                        first = False
                    now, own = conv, []
                own.append((text, loss, expanded))
                if first and len(own) >= 1000:  # the range's first conversation needn't be held whole
                    yield handed(part, now, own)
                    own = []
            if done:
                yield closed(done)
                done = []
        if now is not start:
            yield handed(part, now, own)

    parts = pieces.mapInArrow(digest, f"open boolean, part int, conv_id long, turns array<struct<formatted string, "
                                      f"loss array<struct<start int, stop int>>, expanded long>>, {DIGESTS.split(', ', 1)[1]}")
    parts = parts.withColumn("piece", F.monotonically_increasing_id())

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = start = object()
        d = Digest()
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("open")[i].as_py():
                    conv = batch.column("conv_id")[i].as_py()
                    if conv != now:
                        if now is not start:
                            yield _digest_batch([(now, *d.row())])
                        now, d = conv, Digest()
                    for t in batch.column("turns")[i].as_py():
                        d.add(t["formatted"], t["loss"], t["expanded"])
                else:
                    yield batch.slice(i, 1).select([c.split()[0] for c in DIGESTS.split(", ")])
        if now is not start:
            yield _digest_batch([(now, *d.row())])

    # Closed conversations come along only to spare a second pass over the texts; pieces go in order of their ranges.
    deal = F.when(F.col("open"), F.hash("conv_id")).otherwise(F.hash("piece"))
    return (parts.withColumn("deal", deal).repartition("deal").sortWithinPartitions("open", "conv_id", "part", "piece")
            .mapInArrow(join, DIGESTS))


_TURN_LIST = pa.list_(pa.struct([("formatted", pa.string()),
                                 ("loss", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                                 ("expanded", pa.int64())]))
_PIECE = ["open", "part", "conv_id", "turns", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
          "n_attachments", "expanded_tokens"]


def text_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, parts) of plain text rows, each turn one text part."""
    part = F.struct(F.lit("text").alias("kind"), F.col("text").cast("string").alias("text"), F.lit(None).cast("string").alias("ref"),
                    F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
                    F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"))
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.array(part).alias("parts"))


def op1_typed_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = documents(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return read_back(text_turns(rows))


_ESCAPED = r"regexp_replace({}, '([<\[])(\\*)(\||/?s>|</?SYS>>|/?INST\])', '\1\2\\\3', 'g')"
SQL = rf"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')})) AS BIGINT) AS formatted_chars,
       CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS expanded_tokens
FROM r GROUP BY conv_id
"""
