import random

import numpy as np
import pyarrow as pa
import pytest

from sftforge.llm import linededup as L

from .helpers import SF, rows_of, stored, table


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute(docs, edits=2, shortest=20):
    """(doc_id, n_lines, removed, kept_in) by comparing all distinct lines."""
    first = {}
    for r, (d, t) in enumerate(docs):
        for k, x in enumerate((t or "").split("\n")):
            if len(x) >= shortest:
                at = (d is None, d or 0, r, k, d)
                first[x] = min(first.get(x, at), at)
    lines = sorted(first)
    head = {x: x for x in lines}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for i, x in enumerate(lines):
        for y in lines[:i]:
            if abs(len(x) - len(y)) <= edits and L.edit_distance(x, y, edits) <= edits:
                head[find(x)] = find(y)
    keep = {}
    for x in lines:
        keep[find(x)] = min(keep.get(find(x), first[x]), first[x])
    out = []
    for r, (d, t) in enumerate(docs):
        gone = [(k, keep[find(x)][4]) for k, x in enumerate((t or "").split("\n"))
                if len(x) >= shortest and keep[find(x)][2:4] != (r, k)]
        out.append((d, len((t or "").split("\n")), [k for k, _ in gone], [c for _, c in gone]))
    return out


def as_rows(df):
    return sorted(((r["doc_id"], r["n_lines"], r["removed"], r["kept_in"]) for r in rows_of(df)), key=str)


def test_edit_distance_matches_the_table():
    rng = random.Random(1)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            p = rng.randint(0, len(b))
            b[p:p + rng.randint(0, 1)] = rng.choice(["", "a", "b", "c"])
        b = "".join(b)
        for t in (0, 1, 2, 3):
            assert L.edit_distance(a, b, t) == min(levenshtein(a, b), t + 1)


def test_segments_cover_the_line():
    for n in range(3, 40):
        at = [L.segment(np.array([n]), i, 3) for i in range(3)]
        assert [int(p[0]) for p, _ in at] == [0, *np.cumsum([int(s[0]) for _, s in at])[:-1]]
        assert sum(int(s[0]) for _, s in at) == n


def test_lines_as_split():
    texts = ["", "a\n\nb", None, "\n", "é\n日本\n", "x", ""]
    lines = L.Lines(pa.array(texts), 0)
    got = [[] for _ in texts]
    for i, r in enumerate(lines.row):
        got[r].append(lines.text(i))
    assert got == [(t or "").split("\n") for t in texts]
    assert lines.count.tolist() == [len(g) for g in got]


def mutations(rng, n):
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(15, 40))) for _ in range(8)]
    docs = []
    for i in range(n):
        lines = []
        for _ in range(rng.randint(0, 4)):
            x = list(rng.choice(base))
            for _ in range(rng.randint(0, 3)):
                p = rng.randint(0, len(x))
                x[p:p + rng.randint(0, 1)] = rng.choice(["", "a", "日", "bb"])
            lines.append("".join(x))
        docs.append((rng.choice([i, i, i, None, 3]), rng.choice(["\n".join(lines)] * 9 + [None, "", " \n"])))
    return docs


@pytest.mark.parametrize("sizes", [{}, {"crowded": 5, "block": 4}, {"block": 3}])
def test_brute_force(spark, tmp_dir, sizes):
    base = "abcdefghijklmnopqrstuvwxyz0123456789" * 2
    family = [(200 + i, f"{base[:i]}X{base[i + 1:]}") for i in range(60)]  # all within two edits of each other
    docs = mutations(random.Random(4), 90) + family + [(500, "long " * 9000), (501, "long " * 8999 + "lung ")]
    frame = stored(spark, [(*d, 7, "x") for d in docs], "doc_id long, text string, id int, line string", tmp_dir).coalesce(1)
    assert frame.count() == len(docs)
    stored_order = [(r["doc_id"], r["text"]) for r in frame.collect()]
    assert as_rows(L.line_report(frame, buckets=3, **sizes)) == sorted(brute(stored_order), key=str)


def test_query_matches_brute_force(spark):
    docs = [(d["doc_id"], d["text"]) for d in table("documents")]
    got = as_rows(L.op9_segment_line_dedup(spark, SF))
    assert got == sorted(brute(docs), key=str)


def test_drop_lines_and_empty(spark, tmp_dir):
    x = "The quick brown fox jumps."
    rows = [(1, f"{x}\nshort\nshort", 36, 1), (2, f"new line of some length\n{x}", 50, 1), (3, f"{x[:-1]}!\n\nend", 30, 1),
            (4, None, None, 1), (5, x, 26, 1)]
    docs = stored(spark, rows, "doc_id long, text string, n_chars long, removed int", tmp_dir)
    out = L.drop_lines(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in rows_of(out)}
    assert got == {1: (f"{x}\nshort\nshort", 36), 2: ("new line of some length", 23), 3: ("\nend", 4), 4: (None, None), 5: ("", 0)}
    assert rows_of(L.line_report(docs.where("doc_id > 9"))) == []


def test_ids_of_templated_lines_differ_in_all_bits():
    lines = L.Lines(pa.array([f"account number {7919 * i:010d} was closed today" for i in range(120_000)]), 20)
    for shift in (0, 32):  # 120,000 values of 32 bits hold about 1.7 clashes
        assert len(np.unique(lines.id.view(np.uint64) >> np.uint64(shift) & np.uint64(0xFFFFFFFF))) > 119_980
    assert len(np.unique(lines.id)) == 120_000


def test_lines_of_equal_sketch_and_half_an_id_stay(spark, tmp_dir):
    # Same letters in another order: the same sketch, so only the hash tells the lines apart.
    words = ["alpha", "bravo", "delta", "gamma", "kappa", "omega", "sigma", "theta"]
    rng = random.Random(5)
    texts = sorted({" ".join(rng.sample(words, 8)) for _ in range(2000)})
    lines = L.Lines(pa.array(texts), 20)
    assert len(np.unique(lines.sketch)) == 1 and len(np.unique(lines.id)) == len(texts)
    docs = stored(spark, list(enumerate(texts)), "doc_id long, text string", tmp_dir)
    assert all(r["n_removed"] == 0 for r in rows_of(L.line_report(docs, buckets=3)))


def test_unequal_lines_that_a_polynomial_confuses(spark, tmp_dir):
    """The Thue-Morse word and its complement agree under any polynomial modulo a power of two."""
    for n in (1024, 4096):
        word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
        other = word.translate(str.maketrans("ab", "ba"))
        docs = [(1, word), (2, other), (3, word)]
        frame = stored(spark, docs, "doc_id long, text string", tmp_dir)
        assert as_rows(L.line_report(frame)) == [(1, 1, [], []), (2, 1, [], []), (3, 1, [0], [1])]
