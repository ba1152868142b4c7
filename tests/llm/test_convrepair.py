import hashlib
import itertools
import random
import re
import zlib

import pytest

from sftforge.llm import convrepair as C

from .helpers import SF, rows_of, stored, table

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def cheapest(rows, faults):
    """Best (cost, audit, repaired) by plain strings over all states, row by row."""
    role_of = {0: ("user",), 1: ("user",), 2: ("assistant",), 3: ("user",)}
    step = lambda p, i: {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((p, i))

    def inserts(best):
        for _ in range(4):
            for p, (c, a, t) in list(best.items()):
                r = role_of[p][0]
                q, new = step(p, r[0]), (c + 2, a + "I", t + ((r, ""),))
                best[q] = min(best.get(q, new), new)
        return best

    best = {0: (0, "", ())}
    for (role, text), f in zip(rows, faults):
        new = {}
        for p, (c, a, t) in inserts(best).items():
            found = [(p, (c + 3, a + "D", t))]
            if f not in ("b", "d"):
                cut = f == "t"
                if step(p, role[:1]) is not None:
                    found.append((step(p, role[:1]), (c + cut, a + "K", t + ((role, text),))))
                r = role_of[p][0]
                found.append((step(p, r[0]), (c + 2 + cut, a + "R", t + ((r, text),))))
            for q, x in found:
                new[q] = min(new.get(q, x), x)
        best = new
    return min(v for p, v in inserts(best).items() if p in (0, 3))


def brute(rows):
    """rows: (conv, turn, role, text)."""
    one = lambda x: " " if x is None else str(x)
    convs = {}
    for conv, turn, role, text in rows:
        own = convs.setdefault(conv, [])
        k = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        role, text = one(role), one(text)
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        own += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    out = []
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in own:
            t = text.strip(" \t\n\x0b\x0c\r")
            faults.append("b" if not t else "d" if (role, text) in seen else "t" if t[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit, said = cheapest([r[1:] for r in own], faults)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, sha))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in rows_of(df)), key=str)


def test_query_matches_brute_force(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table("conversations")]
    assert got(C.op11_repair_grammar_conversations(spark, SF)) == brute(rows)


@pytest.mark.parametrize("piece", [4096, 5])
def test_edge_cases(spark, tmp_dir, piece):
    rng = random.Random(4)
    texts = ["Yes.", "No!", "so", "", "  \t", "Wait? ", "a.b", "É.", "x" * 3000 + ".", None]
    roles = ["user", "assistant", "system", "tool", "umbrella", "", None, "User"]
    rows = [(c, t if t % 5 else rng.choice([None, t, t + 3]), rng.choice(roles[:3] * 4 + roles), rng.choice(texts))
            for c in range(40) for t in range(rng.randint(1, 9))]
    rows += [(100, t, ("user", "assistant")[t % 2], rng.choice(texts)) for t in range(300)]  # one long conversation
    rows += [(101, 7, "user", "same turn.")] * 40 + [(None, 1, "user", "a?"), (None, None, None, None)]
    rows += [(c, t, "user", "x.") for c in range(200, 300) for t in (0,) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]  # nothing left
    want = brute(rows)
    frame = stored(spark, [(*r, 5, "z") for r in rows], "conv_id long, turn long, role string, text string, piece int, gone string", tmp_dir)
    assert got(C.repair(frame, piece)) == want
    assert any(r[0] == 200 + i and r[7] == "" for i in range(100) for r in want)
    assert got(C.repair(frame.where("conv_id > 9000"), piece)) == []


def test_grammar_and_audits_on_random_sequences():
    rng = random.Random(9)
    sequences = ["".join(rng.choice("xsuaoSUAO"[: rng.choice([4, 9])]) for _ in range(rng.choice([0, 1, 3, 8, 60]))) for _ in range(300)]
    sequences += ["ua" * 500, "u" * 333, "x" * 50]
    of = {c: (i, f) for (i, f), c in C.SYMBOLS.items()}
    solver = C.Solver()
    best = solver.best(sequences)
    for s in sequences:
        rows, faults = [(of[c][0] or "tool", "t") for c in s], [of[c][1] for c in s]
        want = cheapest(rows, faults)[:2]
        assert best[s] == want
        assert C.ending(C.walk([C.START], [solver.matrix(s)])) == want
    coded, rules = C.repair_grammar(["ua" * 500])
    assert len(rules) >= 8 and sum(len(c) for c in coded) < 20
