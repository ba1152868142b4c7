"""Operator 11, repair of conversation structure by dynamic programming over a grammar.

A conversation's rows become symbols (role initial, fault).  Its cheapest edits
into the roles ``(s?(ua)+)?`` are a shortest path over four states: nothing said,
after system, after user, after assistant.  A symbol's transfer matrix holds, for
every two states, the least cost and the ASCII-least audit of the inserts before
the row and the row's own edit.  The product of two matrices is that of the
symbols in a row, so the distinct sequences of a slice of conversations are
compressed by Re-Pair (the commonest neighbours become a new symbol, again and
again), and each rule's matrix is computed once, bottom-up, from the two of its
body.  Conversations then only multiply a vector along their few symbols.

An audit is a rope: an entry points to the two audits it joins, and is written
out for the path taken only.  No audits are compared: from one state, audits of
the same rows that end in different states differ and neither begins with the
other (a row's edit always follows its inserts, and an edit leads to one state
only), so an entry's rank among its matrix row's follows from the ranks of its
two parts.

Rows are dealt by range of (conversation, turn, role, text) and streamed in
order; a conversation inside one range is repaired there.  One that goes over an
edge, or grows beyond ``PIECE`` rows, is cut into pieces: each piece's matrix is
computed where it lies, a second pass multiplies the pieces' matrices, and a
third streams the texts once more for the digest.  Duplicates are told by the
first turn of equal (role, text), aggregated before the shuffle.

Edge cases: nulls are one space (in the damage's key too, a null text is blank, a
null role has no initial that may stay); rows of equal turn go by role, then
text; roles whose first character isn't s, u or a can't be kept as they are; a
null conversation id is a conversation; a conversation without rows after the
damage gets zeros, an empty audit and the empty string's digest; an empty table
gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sftforge.llm.common import documents, materialize, prepare

KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
PIECE, SLICE_ROWS, SLICE_CHARS = 4096, 20_000, 8 << 20
PART_BYTES = 16 << 20
BLANKS = " \t\n\x0b\x0c\r"
INF = float("inf")

#: States: 0 nothing said, 1 after system, 2 after user, 3 after assistant; where a role leads.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The one role that may be given or inserted in a state.
NEXT = ("user", "user", "assistant", "user")
#: Inserts that lead from a state to another in the cheapest way.
INSERTS = {(p, p): 0 for p in range(4)} | {(0, 2): 1, (0, 3): 2, (1, 2): 1, (1, 3): 2, (2, 3): 1, (3, 2): 1}
#: Inserts that end a conversation from a state.
LAST = (0, 2, 1, 0)


# ---------------------------------------------------------------- matrices, grammar

class Matrix:
    """Cost, rank among its row's entries and audit rope of the best edits between any two states."""

    __slots__ = ("cost", "rank", "rope")

    def __init__(self, cost, rank, rope):
        self.cost, self.rank, self.rope = cost, rank, rope

    def __matmul__(self, other: "Matrix") -> "Matrix":
        cost, rank, rope = [], [], []
        for p in range(4):
            mine, ranks = self.cost[p], self.rank[p]
            c, via = [INF] * 4, [-1] * 4
            for m in range(4):
                if mine[m] == INF:
                    continue
                for q in range(4):
                    s = mine[m] + other.cost[m][q]
                    if s < c[q] or (s == c[q] < INF and ranks[m] < ranks[via[q]]):
                        c[q], via[q] = s, m
            order = sorted((q for q in range(4) if c[q] < INF), key=lambda q: (ranks[via[q]], other.rank[via[q]][q]))
            r = [4] * 4
            for place, q in enumerate(order):
                r[q] = place
            cost.append(c)
            rank.append(r)
            rope.append([(self.rope[p][via[q]], other.rope[via[q]][q]) if c[q] < INF else None for q in range(4)])
        return Matrix(cost, rank, rope)


def written(rope) -> str:
    out, stack = [], [rope]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            stack += (x[1], x[0])
    return "".join(out)


def symbol_matrix(initial: str, fault: str) -> Matrix:
    """Of one row: ``initial`` s, u, a or another; ``fault`` b(lank), d(uplicate), t(runcated) or empty."""
    best: dict = {}
    for (p, r), k in INSERTS.items():
        before, spent = "I" * k, INSERT * k
        edits = [(r, DELETE, "D")]
        if fault not in ("b", "d"):
            cut = CUT if fault == "t" else 0
            if (r, initial) in STEP:
                edits.append((STEP[r, initial], KEEP + cut, "K"))
            edits.append((STEP[r, NEXT[r][0]], REROLE + cut, "R"))
        for q, cost, letter in edits:
            found = (spent + cost, before + letter)
            best[p, q] = min(best.get((p, q), found), found)
    cost = [[best[p, q][0] if (p, q) in best else INF for q in range(4)] for p in range(4)]
    rope = [[best[p, q][1] if (p, q) in best else None for q in range(4)] for p in range(4)]
    rank = [[4] * 4 for _ in range(4)]
    for p in range(4):
        for place, q in enumerate(sorted((q for q in range(4) if rope[p][q] is not None), key=lambda q: rope[p][q])):
            rank[p][q] = place
    return Matrix(cost, rank, rope)


#: One character a symbol: deletion required, then the initials whole and truncated.
SYMBOLS = {("", "b"): "x"} | {(i, f): c for (i, f), c in zip([(i, f) for f in ("", "t") for i in ("s", "u", "a", "")], "suaoSUAO")}
_OF = {c: symbol_matrix(i, f) for (i, f), c in SYMBOLS.items()}
UNIT = Matrix([[0 if p == q else INF for q in range(4)] for p in range(4)], [[0 if p == q else 4 for q in range(4)] for p in range(4)],
              [["" if p == q else None for q in range(4)] for p in range(4)])


def symbol(initial: str, fault: str) -> str:
    return "x" if fault in ("b", "d") else SYMBOLS[initial if initial in ("s", "u", "a") else "", fault]


def repair_grammar(sequences: list[str]) -> tuple[list[np.ndarray], list[tuple[int, int]]]:
    """Re-Pair over all sequences at once: each as rule numbers, and the rules' bodies.

    Numbers below 128 are characters; rule i has number 128 + i.  A pair becomes
    a rule while it stands twice, and in over a thousandth of all places.
    """
    text = "\x00".join(sequences).encode("ascii")
    a = np.frombuffer(text, np.uint8).astype(np.int64)
    rules: list[tuple[int, int]] = []
    least = max(2, len(a) >> 10)
    while len(a) > 1:
        size = 128 + len(rules)
        pairs = np.where((a[:-1] > 0) & (a[1:] > 0), a[:-1] * size + a[1:], -1)
        kinds, counts = np.unique(pairs[pairs >= 0], return_counts=True)
        if not len(kinds) or counts.max() < least:
            break
        pair = int(kinds[counts.argmax()])
        at = np.flatnonzero(pairs == pair)
        if pair // size == pair % size:  # in a run of equal symbols every other place
            first = np.r_[True, np.diff(at) != 1]
            at = at[(np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))) % 2 == 0]
        if len(at) < 2:
            break
        rules.append((pair // size, pair % size))
        a[at] = size
        a = np.delete(a, at + 1)
    return np.split(a, np.flatnonzero(a == 0)), rules


class Solver:
    """Best edits of sequences; all that a call is given share one grammar's matrices."""

    def compressed(self, sequences: list[str]) -> dict[str, list[Matrix]]:
        distinct = sorted(set(sequences) - {""})
        out: dict[str, list[Matrix]] = {"": []}
        if distinct:
            coded, rules = repair_grammar(distinct)
            of = {ord(c): m for c, m in _OF.items()}
            for i, (left, right) in enumerate(rules):
                of[128 + i] = of[left] @ of[right]
            out |= {s: [of[x] for x in codes.tolist() if x] for s, codes in zip(distinct, coded)}
        return out

    def best(self, sequences: list[str]) -> dict[str, tuple[int, str]]:
        """Cost and audit of whole conversations."""
        return {s: ending(walk([START], ms)) for s, ms in self.compressed(sequences).items()}

    def matrix(self, sequence: str) -> Matrix:
        out = UNIT
        for m in self.compressed([sequence])[sequence]:
            out = out @ m
        return out


#: A vector: per state (cost, rank, rope), from the empty conversation.
START = [(0, 0, ""), None, None, None]


def walk(vectors: list, matrices) -> list:
    v = vectors[0]
    for m in matrices:
        new = [None] * 4
        for q in range(4):
            found = [(v[p][0] + m.cost[p][q], v[p][1], p) for p in range(4) if v[p] is not None and m.cost[p][q] < INF]
            if found:
                c, r, p = min(found)
                new[q] = (c, (r, m.rank[p][q]), (v[p][2], m.rope[p][q]))
        order = sorted(x[1] for x in new if x is not None)
        v = [None if x is None else (x[0], order.index(x[1]), x[2]) for x in new]
    return v


def ending(v: list) -> tuple[int, str]:
    c, _, p = min((v[p][0] + INSERT * LAST[p], v[p][1], p) for p in range(4) if v[p] is not None)
    return c, written(v[p][2]) + "I" * LAST[p]


class Replay:
    """The repaired conversation's digest, from rows and their audit in order."""

    def __init__(self):
        self.sha, self.state, self.any = hashlib.sha256(), 0, False

    def _say(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.any else "") + role + ":" + text).encode())
        self.any = True

    def insert(self) -> None:
        self._say(NEXT[self.state], "")
        self.state = STEP[self.state, NEXT[self.state][0]]

    def edit(self, letter: str, role: str, text: str) -> None:
        if letter == "D":
            return
        role = NEXT[self.state] if letter == "R" else role
        self._say(role, text)
        self.state = STEP[self.state, role[0]]


def digest(rows: list[tuple[str, str]], audit: str) -> str:
    out, at = Replay(), iter(rows)
    for letter in audit:
        if letter == "I":
            out.insert()
        else:
            out.edit(letter, *next(at))
    return out.sha.hexdigest()


# ---------------------------------------------------------------- rows

def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows after damage; a dropped one stays as a mark of its conversation."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                text("role").alias("role"), text("text").alias("text"),
                                (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20).alias("kind"))
    kind = F.col("kind")
    gone = kind == 0
    return rows.select(
        "conv_id", "turn",
        F.when(gone, None).when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone, None).when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        gone.alias("gone"), F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """Adds ``last`` (the last character that isn't blank, empty if none) and ``later`` (equal role and text in a smaller turn)."""
    key = F.when(~F.col("gone"), F.md5(F.concat(F.length("role"), F.lit(":"), F.col("role"), F.col("text")))).alias("key")
    keyed = rows.select("*", key, F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1).alias("last"))
    firsts = (keyed.where(~F.col("gone")).groupBy(F.col("conv_id").alias("of"), F.col("key").alias("equal"))
              .agg(F.count(F.lit(1)).alias("n"), F.max(F.col("turn").isNull()).alias("nowhere"), F.min("turn").alias("first"))
              .where(F.col("n") > 1))
    later = F.coalesce(F.when(F.col("nowhere"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first")), F.lit(False))
    return (keyed.join(firsts, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("equal")), "left")
            .select("conv_id", "turn", "role", "text", "gone", "last", later.alias("later")))


_STATS = ("blank", "duplicate", "truncated", "illegal")
RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
OUT = (f"kind string, {RESULT}, piece long, place long, role string, text string, first_initial string, last_initial string, "
       "first_turn long, last_turn long, turns long, costs array<double>, ranks array<int>, audits array<string>")
_TYPES = {"long": pa.int64(), "string": pa.string(), "array<double>": pa.list_(pa.float64()), "array<int>": pa.list_(pa.int32()),
          "array<string>": pa.list_(pa.string())}
_COLUMNS = [(n, _TYPES[t]) for n, t in (c.split() for c in OUT.split(", "))]


def _batch(rows: list[dict], columns=_COLUMNS) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in columns], names=[n for n, _ in columns])


class Part:
    """A conversation, or a piece of one: its counts, symbols and texts."""

    def __init__(self, conv):
        self.conv, self.open = conv, False
        self.clear()

    def clear(self):
        self.counts = dict.fromkeys(_STATS, 0)
        self.symbols, self.rows, self.chars = [], [], 0
        self.first = self.last = None  # initials
        self.low = self.high = None  # turns
        self.turns = 0

    def add(self, turn, role: str, text: str, last: str, duplicate: bool) -> None:
        initial = role[:1]
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        fault = "b" if not last else "d" if duplicate else "t" if last not in ".!?" else ""
        if fault:
            self.counts[{"b": "blank", "d": "duplicate", "t": "truncated"}[fault]] += 1
        if turn is not None:
            if turn != self.high:
                self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.first = initial if self.first is None else self.first
        self.last = initial
        self.symbols.append(symbol(initial, fault))
        self.rows.append((role, text))
        self.chars += len(text) + len(role)

    def record(self) -> dict:
        return {"conv_id": self.conv, **self.counts, "gaps": 0 if self.low is None else self.high - self.low + 1 - self.turns}


def repaired(faulty: DataFrame, parts: int, piece: int = PIECE) -> DataFrame:
    """The whole conversations of each range repaired; pieces of the others, with their matrices and texts."""
    ordered = (faulty.repartitionByRange(parts, "conv_id", "turn", "role", F.substring("text", 1, 8))
               .sortWithinPartitions("conv_id", "turn", "role", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver, number = Solver(), TaskContext.get().partitionId() << 32
        wait: list[Part] = []
        held = [0, 0]

        def close() -> Iterator[pa.RecordBatch]:
            best = solver.best(["".join(p.symbols) for p in wait])
            out = []
            for p in wait:
                cost, audit = best["".join(p.symbols)]
                out.append(p.record() | {"kind": "done", "cost": cost, "audit": audit, "repaired_sha256": digest(p.rows, audit)})
            wait.clear()
            held[:] = [0, 0]
            if out:
                yield _batch(out)

        def hand_on(p: Part) -> Iterator[pa.RecordBatch]:
            nonlocal number
            m = solver.matrix("".join(p.symbols))
            flat = [(p_, q) for p_ in range(4) for q in range(4)]
            yield _batch([p.record() | {
                "kind": "piece", "piece": number, "place": -1, "first_initial": p.first, "last_initial": p.last, "first_turn": p.low,
                "last_turn": p.high, "turns": p.turns, "costs": [m.cost[a][b] for a, b in flat], "ranks": [m.rank[a][b] for a, b in flat],
                "audits": [None if m.rope[a][b] is None else written(m.rope[a][b]) for a, b in flat]}])
            if p.rows:
                yield _batch([{"kind": "row", "conv_id": p.conv, "piece": number, "place": i, "role": r, "text": t}
                              for i, (r, t) in enumerate(p.rows)])
            number += 1

        now, first, before = None, True, None
        for batch in batches:
            for conv, turn, role, text, gone, last, later in zip(*(batch.column(c).to_pylist() for c in
                                                                    ("conv_id", "turn", "role", "text", "gone", "last", "later"))):
                if now is None or conv != now.conv:
                    if now is not None:
                        if first or now.open:
                            yield from hand_on(now)
                        else:
                            wait.append(now)
                            held[0] += len(now.rows)
                            held[1] += now.chars
                            if held[0] >= SLICE_ROWS or held[1] >= SLICE_CHARS:
                                yield from close()
                        first = False
                    now, before = Part(conv), None
                if gone:
                    continue
                if len(now.rows) >= piece or now.chars >= SLICE_CHARS:
                    now.open = True
                    yield from hand_on(now)
                    now.clear()
                # Equal rows stand side by side, as the range's bounds don't part them.
                now.add(turn, role, text, last, later or before == (turn, role, text))
                before = (turn, role, text)
        yield from close()
        if now is not None:
            yield from hand_on(now)

    return ordered.mapInArrow(run, OUT)


_CHOSEN = "conv_id long, piece long, place long, audit string, tail int, last boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def chosen(pieces: DataFrame, parts: int) -> DataFrame:
    """Each piece's audit on its conversation's best path; the conversation's figures on its last piece."""
    def finish(conv, own: list[dict]) -> pa.RecordBatch:
        v, back = [(0, 0), None, None, None], []
        total = dict.fromkeys(_STATS, 0)
        low = high = last = None
        turns = 0
        for r in own:
            cost, rank = np.reshape(r["costs"], (4, 4)), np.reshape(r["ranks"], (4, 4))
            new, via = [None] * 4, [0] * 4
            for q in range(4):
                found = [(v[p][0] + cost[p, q], v[p][1], p) for p in range(4) if v[p] is not None and cost[p, q] < INF]
                if found:
                    c, k, p = min(found)
                    new[q], via[q] = (c, (k, int(rank[p, q]))), p
            order = sorted(x[1] for x in new if x is not None)
            v = [None if x is None else (x[0], order.index(x[1])) for x in new]
            back.append(via)
            for s in _STATS:
                total[s] += r[s]
            if r["first_initial"] is not None:
                if last is not None and last + r["first_initial"] not in ("su", "ua", "au"):
                    total["illegal"] += 1
                last = r["last_initial"]
            if r["first_turn"] is not None:
                turns += r["turns"] - (r["first_turn"] == high)
                low = r["first_turn"] if low is None else low
                high = r["last_turn"]
        c, _, q = min((v[p][0] + INSERT * LAST[p], v[p][1], p) for p in range(4) if v[p] is not None)
        out, tail = [], LAST[q]
        for r, via in zip(reversed(own), reversed(back)):
            p = via[q]
            out.append({"conv_id": conv, "piece": r["piece"], "place": -1, "audit": r["audits"][4 * p + q], "tail": 0, "last": False})
            q = p
        out[0] |= total | {"tail": tail, "last": True, "cost": int(c), "gaps": 0 if low is None else high - low + 1 - turns}
        return _batch(out, [(n, {"int": pa.int32(), "boolean": pa.bool_()}.get(t) or _TYPES[t]) for n, t in (x.split() for x in _CHOSEN.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list[dict] = []
        for batch in batches:
            for r in batch.to_pylist():
                if own and r["conv_id"] != own[0]["conv_id"]:
                    yield finish(own[0]["conv_id"], own)
                    own = []
                own.append(r)
        if own:
            yield finish(own[0]["conv_id"], own)

    return pieces.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(run, _CHOSEN)


def joined(rows: DataFrame, audits: DataFrame, parts: int) -> DataFrame:
    """Results of conversations in pieces: their texts streamed once more along the audits."""
    both = audits.unionByName(rows.select("conv_id", "piece", "place", "role", "text"), allowMissingColumns=True)
    names = [c.split()[0] for c in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, audits_, edits, head = Replay(), [], iter(()), None

        def done() -> pa.RecordBatch:
            for _ in range(head["tail"]):
                replay.insert()
            return _batch([head | {"audit": "".join(audits_) + "I" * head["tail"], "repaired_sha256": replay.sha.hexdigest()}],
                          [c for c in _COLUMNS if c[0] in names])

        for batch in batches:
            for r in batch.to_pylist():
                if r["place"] == -1:
                    if head is not None and head["last"]:
                        yield done()
                        replay, audits_ = Replay(), []
                    head, edits = r, iter(r["audit"])
                    audits_.append(r["audit"])
                else:
                    letter = next(edits)
                    while letter == "I":
                        replay.insert()
                        letter = next(edits)
                    replay.edit(letter, r["role"], r["text"])
        if head is not None:
            yield done()

    return (both.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "piece", "place").mapInArrow(run, RESULT))


def repair(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row per original conversation: counts of faults, cost and audit of the cheapest repair, its digest."""
    spark = conversations.sparkSession
    prepare(spark)
    rows = damaged(conversations)
    size = rows.agg(F.sum(F.octet_length("text") + 64).alias("b")).first()["b"] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-size // PART_BYTES))
    out = materialize(repaired(with_faults(rows), parts, piece), "repair-pieces")
    names = [c.split()[0] for c in RESULT.split(", ")]
    pieces = out.where(F.col("kind") == "piece")
    return (out.where(F.col("kind") == "done").select(*names)
            .unionByName(joined(out.where(F.col("kind") == "row"), materialize(chosen(pieces.drop("role", "text"), parts), "repair-audits"), parts)))


def op11_repair_grammar_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(documents(spark, sf_dir, "conversations"))


def _recursion() -> str:
    """SQL: the states' best (cost, audit, repaired) advanced by one row; keys sort by cost, then audit."""
    def key(p: int, cost: str, letters: str, said: str) -> str:
        return (f"CASE WHEN v{p} IS NULL THEN NULL ELSE {{'c': v{p}.c + {cost}, 'a': v{p}.a || '{letters}', "
                f"'t': v{p}.t || {said}}} END")

    def inserted(p: int, r: int) -> str:
        out, at = [], p
        for _ in range(INSERTS[p, r]):
            out.append(f"chr(10) || '{NEXT[at]}:'")
            at = STEP[at, NEXT[at][0]]
        return " || ".join(out) or "''"

    cells = []
    for q in range(4):
        found = []
        for (p, r), k in INSERTS.items():
            before, ins = "I" * k, inserted(p, r)
            if r == q:
                found.append(key(p, str(INSERT * k + DELETE), before + "D", ins))
            if STEP[r, NEXT[r][0]] == q:
                found.append(f"CASE WHEN fault IN ('b', 'd') THEN NULL ELSE "
                             + key(p, f"{INSERT * k + REROLE} + cut", before + "R", f"{ins} || chr(10) || '{NEXT[r]}:' || text") + " END")
            for i in "sua":
                if STEP.get((r, i)) == q:
                    found.append(f"CASE WHEN fault IN ('b', 'd') OR initial <> '{i}' THEN NULL ELSE "
                                 + key(p, f"{INSERT * k} + cut", before + "K", f"{ins} || chr(10) || role || ':' || text") + " END")
        cells.append(f"list_sort(list_filter([{', '.join(found)}], lambda x: x IS NOT NULL))[1]" if found else "NULL")
    return ", ".join(cells)


def _crc32(text: str) -> str:
    """SQL: CRC-32 of an ASCII text, bit by bit."""
    bit = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: {bit})"
    codes = f"list_transform(str_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda crc, b: {byte}), 4294967295)"


def _sql() -> str:
    blanks = r"[^\x20\x09-\x0D]"
    ends = ", ".join(
        f"CASE WHEN v{p} IS NULL THEN NULL ELSE {{'c': v{p}.c + {INSERT * LAST[p]}, 'a': v{p}.a || '{'I' * LAST[p]}', 't': v{p}.t || "
        + {0: "''", 1: "chr(10) || 'assistant:'", 2: "chr(10) || 'user:' || chr(10) || 'assistant:'"}[LAST[p]] + "} END" for p in range(4))
    state = "STRUCT(c BIGINT, a VARCHAR, t VARCHAR)"
    return f"""
WITH RECURSIVE o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations
), d AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM o, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS c(copy)
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, role[1:1] AS initial FROM d
), k AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM n
), f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '{blanks}') THEN 'b' WHEN nth > 1 THEN 'd'
                 WHEN regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN '' ELSE 't' END AS fault FROM k
), g AS (SELECT *, CASE fault WHEN 't' THEN 1 ELSE 0 END AS cut FROM f
), w AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, CAST({{'c': 0, 'a': '', 't': ''}} AS {state}) AS v0,
         CAST(NULL AS {state}) AS v1, CAST(NULL AS {state}) AS v2, CAST(NULL AS {state}) AS v3 FROM o
  UNION ALL
  SELECT g.conv_id, g.i, {_recursion()} FROM w JOIN g ON g.conv_id IS NOT DISTINCT FROM w.conv_id AND g.i = w.i + 1
), e AS (
  SELECT conv_id, list_sort(list_filter([{ends}], lambda x: x IS NOT NULL))[1] AS b FROM w
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), s AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, b.c AS cost, b.a AS audit, sha256(b.t[2:]) AS repaired_sha256
FROM e LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM e.conv_id
"""


SQL = _sql()
