import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from sftforge.llm import packing as P

from .helpers import SF, rows_of, stored, table

PATH = P.default_tokenizer()


def brute(texts):
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    return [tok.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]


def check_pieces(rows, ids_of):
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert set(by) == set(ids_of)
    for doc, ps in by.items():
        ids = ids_of[doc]
        at = 0
        for p in sorted(ps, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["offset"] == 0
            assert p["length"] & (p["length"] - 1) == 0 and 1 << p["bucket"] == p["length"] <= P.WINDOW
            part = np.array(ids[at:at + p["length"]], "<u4").tobytes()
            assert p["ids_crc32"] == zlib.crc32(part)
            at += p["length"]
        assert at == len(ids)
    assert len({r["sequence_id"] for r in rows}) == len(rows)


def test_query_round_trip(spark):
    docs = table("documents")
    check_pieces(rows_of(P.op5_power_of_two_packing(spark, SF)),
                 dict(zip([d["doc_id"] for d in docs], brute([d["text"] for d in docs]))))


def test_edge_cases(spark, tmp_dir):
    texts = [None, "", " ", "日本 text 😀", "<|endoftext|>", "a" * 5000, "don't we'll  \n\n x", "word " * 3000]
    docs = stored(spark, [(i, t, 1, "s") for i, t in enumerate(texts)],
                  "doc_id long, text string, start int, bucket string", tmp_dir)
    check_pieces(rows_of(P.pack(docs, PATH)), dict(enumerate(brute(texts))))
    twice = rows_of(P.pack(docs.where("doc_id = 6").unionByName(docs.where("doc_id = 6")), PATH))
    assert len(twice) == 2 * len(rows_of(P.pack(docs.where("doc_id = 6"), PATH)))
    assert rows_of(P.pack(docs.where("doc_id < 0"), PATH)) == []
    lost = stored(spark, [(None, "x y")], "doc_id long, text string", tmp_dir)
    assert {r["doc_id"] for r in rows_of(P.pack(lost, PATH))} == {None}


def test_words_as_the_tokenizer_splits_them():
    import pyarrow as pa

    rng = random.Random(5)
    plain = "ab's 't''ll're  \n\t é1²٣½ñ'd'VE've.,-!Ж\x1c\x85\xa0\x0b\x00"
    texts = ["".join(rng.choice(plain + ("日　😀֑" if i % 3 == 0 else "")) for _ in range(rng.randint(0, 40)))
             for i in range(2000)]
    coder = P.WordCoder(PATH)
    for lot in (texts, texts[::-1]):  # the second time from the kept words
        ids, counts = coder.encode(pa.array(lot))
        got = [x.tolist() + [0] for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert got == brute(lot)


@pytest.mark.parametrize("n", [1, 2, 3, 1023, 1024, 1025, 5000])
def test_pieces(n):
    got = P.pieces(n)
    assert sum(got) == n and got == sorted(got, reverse=True)
    assert len(set(p for p in got if p < 1024)) == len([p for p in got if p < 1024])


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_unequal_words_that_a_polynomial_confuses(spark, tmp_dir, n):
    """The Thue-Morse word and its complement agree under any polynomial modulo a power of two."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    texts = [word, word.translate(str.maketrans("ab", "ba"))]
    frame = stored(spark, list(enumerate(texts)), "doc_id long, text string", tmp_dir).coalesce(1)
    check_pieces(rows_of(P.pack(frame, PATH)), dict(enumerate(brute(texts))))
