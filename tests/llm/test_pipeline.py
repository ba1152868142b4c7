"""The pipeline's stages and its whole run against brute force, on a small table with the edge cases in it."""

import pytest

import corpus_pipeline as C

from . import test_decontaminate, test_linededup, test_packing, test_simhash
from .helpers import rows_of, table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __row string, spans int"


@pytest.fixture(scope="module")
def fixture(spark, tmp_path_factory):
    """A folder of tables: short documents, a leak, copies, near copies, a null and an empty text, a null id, clashing columns."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    items = [(b["item_id"], b["text"]) for b in table("benchmark")[:6]]
    docs = [(d["doc_id"], d["text"]) for d in table("documents") if len(d["text"]) < 1500][:50]
    words = docs[3][1].split()
    docs += [(900, "Before it. " + items[0][1] + " After it."), (901, docs[1][1]), (901, docs[1][1]), (902, " ".join([*words[:-1], "other"])),
             (903, None), (904, ""), (None, "a text without an id, all of its own words in it"), (905, docs[5][1] + "\nand one more line here at the end")]
    rows = [(i, t, "en", "web", len(t or ""), "x", 3) for i, t in docs]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(r["doc_id"], r["quality"], r["toxic"]) for r in table("labels")]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def stored_stage(spark, df, tmp_path, name):
    df.coalesce(1).write.parquet(f"{tmp_path}/{name}")
    return spark.read.parquet(f"{tmp_path}/{name}")


def test_stages_and_run_match_brute_force(spark, fixture, tmp_path):
    docs = spark.read.parquet(f"{fixture}/documents.parquet")
    stages = dict(C.STAGES)

    kept = stored_stage(spark, stages["toxicity"](spark, docs, fixture), tmp_path, "toxicity")
    assert kept.schema.simpleString() == docs.schema.simpleString() and 0 < kept.count() <= docs.count()

    before = pairs(kept)
    lined = stored_stage(spark, stages["line dedup"](spark, kept, fixture), tmp_path, "lines")
    want = []
    for (doc, text), (_, _, removed, _) in zip(before, test_linededup.brute(before)):
        want.append((doc, None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in removed)))
    assert sorted(pairs(lined), key=str) == sorted(want, key=str)
    assert all(r["n_chars"] == len(r["text"] or "") for r in rows_of(lined))
    assert lined.columns == docs.columns

    before = pairs(lined)
    one = stored_stage(spark, stages["SimHash near-dedup"](spark, lined, fixture), tmp_path, "one")
    prints = [(doc, test_simhash.brute_fp(text)) for doc, text in before]
    groups = test_simhash.brute_components([(i, fp) for i, (_, fp) in enumerate(prints)])
    assert set(one.columns) == set(docs.columns) and one.count() == len(set(groups))
    stays = sorted(pairs(one), key=str)
    place = {}
    for row, group in zip(before, groups):
        place.setdefault(str(row), set()).add(group)
    assert set().union(*[place[str(r)] for r in stays]) == set(groups)  # each group is there

    before = pairs(one)
    clean = stored_stage(spark, stages["benchmark decontamination"](spark, one, fixture), tmp_path, "clean")
    items = [(r["item_id"], r["text"]) for r in rows_of(spark.read.parquet(f"{fixture}/benchmark.parquet"))]
    leaked = [found for _, found, *_ in test_decontaminate.brute(before, items)]
    assert sorted(pairs(clean), key=str) == sorted((r for r, bad in zip(before, leaked) if not bad), key=str)
    assert 900 not in {d for d, _ in pairs(clean)}

    before = pairs(clean)
    ids = dict(zip([d for d, _ in before], test_packing.brute([t for _, t in before])))
    assert len(ids) == len(before)
    test_packing.check_pieces(rows_of(stages["packing"](spark, clean, fixture)), ids)
    test_packing.check_pieces(rows_of(C.run(spark, fixture)), ids)


def test_empty_tables(spark, fixture, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{fixture}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert rows_of(C.run(spark, str(tmp_path))) == []
