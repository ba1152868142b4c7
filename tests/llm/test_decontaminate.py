import random
import re

import pytest

from sftforge.llm import decontaminate as D

from .helpers import SF, rows_of, stored, table


def split(text):
    return [w.lower() if w.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), w)
            for w in re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+", text or "")]


def brute(docs, items):
    out = []
    pieces = [(i, split(t)) for i, t in items]
    for doc, text in docs:
        w = split(text)
        ids, covered = set(), set()
        for item, b in pieces:
            span = 13 if len(b) >= 13 else len(b)
            if span < 3:
                continue
            for p in range(len(w) - span + 1):
                for q in range(len(b) - span + 1):
                    same = sum(x == y for x, y in zip(w[p:p + span], b[q:q + span]))
                    if same >= (11 if span == 13 else span - 1 if span >= 7 else span):
                        ids.add(item)
                        covered |= set(range(p, p + span))
        out.append((doc, bool(covered), sorted(ids, key=lambda x: (x is None, x or 0)), len(covered), len(w)))
    return out


def as_rows(df):
    return [(r["doc_id"], r["contaminated"], r["item_ids"], r["leaked_words"], r["n_words"]) for r in rows_of(df)]


def test_masks_miss_no_two_substitutions():
    from itertools import combinations
    for pair in combinations(range(D.SPAN), 2):
        assert any(not set(pair) & set(m) for m in D.MASKS)


def test_query_against_containment(spark):
    """Every document that holds an item's words whole is found, and every finding has such a window."""
    items = [(b["item_id"], split(b["text"])) for b in table("benchmark")]
    texts = {d["doc_id"]: " " + " ".join(split(d["text"])) + " " for d in table("documents")}
    got = {r["doc_id"]: r for r in rows_of(D.op3_spaced_seed_decontamination(spark, SF))}
    assert set(got) == set(texts)
    for doc, text in texts.items():
        whole = {i for i, w in items if f" {' '.join(w)} " in text}
        assert whole <= set(got[doc]["item_ids"])
    assert any(r["contaminated"] for r in got.values()) and not all(r["contaminated"] for r in got.values())


@pytest.mark.parametrize("block", [D.BLOCK_BYTES, 300])
def test_brute_force_with_substitutions(spark, tmp_dir, block):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(60)] + ["Éa", "日本"]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, ", ".join(say(n))) for i, n in enumerate([4, 5, 7, 12, 13, 14, 30, 40, 22, 9])]
    items += [(None, items[6][1]), (6, items[6][1]), (90, None), (91, "")]
    docs = []
    for i in range(60):
        w = say(rng.randint(0, 40))
        if i % 2:
            b = split(items[rng.randrange(10)][1])
            for _ in range(rng.randint(0, 3)):
                b[rng.randrange(len(b))] = "zz"
            at = rng.randint(0, len(w))
            w[at:at] = b
        docs.append((i, " ".join(w), None, "x"))
    docs += [(None, items[7][1], 1, "x"), (70, None, 1, "x"), (71, "", 1, "x"), (3, docs[3][1], 1, "x"),
             (72, " ".join(say(30000)) + " " + items[7][1].upper(), 1, "x")]
    frame = stored(spark, docs, "doc_id long, text string, items int, spans string", tmp_dir)
    bench = stored(spark, items, "item_id long, text string", tmp_dir)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    want = sorted(brute([d[:2] for d in docs[:-1]], items), key=key)
    got = sorted(as_rows(D.find_leaks(frame, bench, block)), key=key)
    assert [g for g in got if g[0] != 72] == want
    assert next(g for g in got if g[0] == 72)[1]
    kept = D.keep_clean(frame, bench, block)
    assert kept.schema == frame.schema
    assert sorted(str(r["doc_id"]) for r in rows_of(kept)) == sorted(str(r[0]) for r in want if not r[1])


def test_copies_of_an_item_are_one_entry(spark, tmp_dir):
    """Repeated items, also with other ids or none, add ids to the finding and no entry to the index."""
    said = " ".join(f"w{i}" for i in range(20))
    items = [(i % 500, said) for i in range(1500)] + [(None, said), (None, said), (900, said + " more"), (901, None)]
    bench = stored(spark, items, "item_id long, text string", tmp_dir)
    built = D.indexes(bench)
    assert len(built) == 1 and len(built[0].value.ids) == 2
    docs = stored(spark, [(1, "so " + said), (2, "other words")], "doc_id long, text string", tmp_dir)
    got = {r["doc_id"]: r["item_ids"] for r in rows_of(D.find_leaks(docs, bench))}
    assert got == {1: [*range(500), 900, None], 2: []}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert as_rows(D.find_leaks(docs, none)) == [(1, False, [], 0, 6)]
    assert rows_of(D.find_leaks(docs.where("doc_id > 1"), none)) == []


def test_query_and_stage_find_short_items(spark, tmp_dir):
    import corpus_pipeline
    vocab = [f"v{i}" for i in range(40)]
    items, docs, want = [], [], {}
    for n in range(2, 13):
        item = vocab[n:2 * n]
        items.append((n, " ".join(item)))
        for changes in range(3):
            w = list(item)
            for p in random.Random(n).sample(range(n), min(changes, n)):
                w[p] = "zz"
            key = 10 * n + changes
            docs.append((key, " ".join(["before", "it", *w, "after"])))
            want[key] = n if changes == 0 and n >= 3 or changes == 1 and n >= 7 else None
        for p in range(n) if n >= 7 else ():  # whichever word is changed
            key = 1000 * n + p
            docs.append((key, " ".join(item[:p] + ["zz"] + item[p + 1:])))
            want[key] = n
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    got = {r["doc_id"]: r["item_ids"] for r in rows_of(D.op3_spaced_seed_decontamination(spark, tmp_dir))}
    for key, n in want.items():
        assert (n in got[key]) if n else key // 10 not in got[key], key
    kept = corpus_pipeline.unleaked(spark, spark.read.parquet(f"{tmp_dir}/documents.parquet"), tmp_dir)
    assert {r["doc_id"] for r in rows_of(kept)} == {k for k, found in got.items() if not found}
