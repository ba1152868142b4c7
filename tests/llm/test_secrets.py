import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
import pytest

from sftforge.llm import secrets as S

from .helpers import SF, rows_of, stored, table


def brute(text):
    text = text or ""
    found = []
    for kind, pattern, least in (("assign", r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
                                 ("access", "(AKIA[A-Z0-9]+)", 20), ("hex", "([0-9a-f]+)", 24)):
        flags = re.I | re.A if kind == "assign" else 0
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text, flags) if len(m[1]) >= least]
    order = {"assign": 0, "access": 1, "hex": 2}
    found.sort(key=lambda f: (f[0], order[f[1]]))
    joined = ",".join(f"{k}:{s}:{e}" for s, k, e in found)
    return [sum(f[1] == k for f in found) for k in order], hashlib.sha256(joined.encode()).hexdigest(), joined


def check(row, text):
    counts, digest, joined = brute(text)
    assert [row["n_assign"], row["n_access"], row["n_hex"]] == counts and row["base_sha256"] == digest
    spans = row["spans"].split(",") if row["spans"] else []
    assert ",".join(s for s in spans if not s.startswith("crf:")) == joined
    assert sum(s.startswith("crf:") for s in spans) == row["n_crf"]
    for s in spans:
        _, a, z = s.split(":")
        assert 0 <= int(a) < int(z) <= len(text)


def test_query_matches_patterns(spark):
    docs = {d["doc_id"]: d["text"] for d in table("documents")}
    rows = rows_of(S.op6_crf_secrets(spark, SF))
    assert len(rows) == len(docs)
    for r in rows:
        check(r, docs[r["doc_id"]])


TEXTS = [None, "", " \n", 'Password = "abc123x', "API_KEY: short token=longenough", "AKIA" + "A" * 16, "AKIA" + "A" * 15,
         "é日 secret='zz/9+_.=-q' " + "0af" * 8, "paſſword=abcdefg toKen=abcdefg", "passwordpassword=abcdefg",
         "word " * 30000 + "token=abcdef1234", "x" + "deadbeef" * 3 + "g" + "0" * 23]


def test_edge_cases(spark, tmp_dir):
    rows = [(i, t, 1, "x") for i, t in enumerate(TEXTS)] + [(None, TEXTS[3], 1, "x"), (3, TEXTS[3], 1, "x")]
    docs = stored(spark, rows, "doc_id long, text string, spans int, kind string", tmp_dir)
    for field in (None, S.train(docs)):
        got = rows_of(S.scan(docs, field))
        assert len(got) == len(rows)
        for r in got:
            text = TEXTS[3 if r["doc_id"] is None else r["doc_id"]]
            base = [s for s in r["spans"] if s["kind"] != "crf"]
            assert ",".join(f"{s['kind']}:{s['start']}:{s['stop']}" for s in base) == brute(text)[2]
    assert rows_of(S.scan(docs.where("doc_id > 90"), S.train(docs.where("doc_id > 90")))) == []
    assert S.train(docs.where("doc_id in (0, 1, 2)")) is None


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    field = S.Field([np.zeros((n, 3)) for n in S.FAMILIES], rng.normal(size=(3, 3)))
    sizes = np.array([1, 4, 2, 5, 3])
    emission = rng.normal(size=(sizes.sum(), 3)) * 2
    first = np.cumsum(sizes) - sizes
    got = field.viterbi(emission, first, sizes)
    for f, n in zip(first, sizes):
        def value(path):
            v = sum(emission[f + i, y] for i, y in enumerate(path)) + (S._NEVER if path[0] == S.INSIDE else 0)
            return v + sum(field.steps[a, b] for a, b in zip(path, path[1:]))
        best = max(itertools.product(range(3), repeat=n), key=value)
        assert tuple(got[f:f + n]) == best


def test_field_learns_and_adds_what_patterns_miss(spark):
    rng = np.random.default_rng(1)
    key = lambda n=20: "".join(rng.choice(list("0123456789abcdef"), n))
    plain = ["the sun is warm", "we read 12 books", "a boat on the lake", "token of thanks", "in 1999 we met"]
    texts = [f"{plain[i % 5]} password={key()} {plain[(i + 1) % 5]}" if i % 3 else plain[i % 5] for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    field = S.train(docs)
    secret = key()
    text = f"the sun pwd={secret} is warm"
    assert (0, text.index(secret), text.index(secret) + 20) in S.tagged(field, pa.array([text]))
    assert S.tagged(field, pa.array(plain)) == []


@pytest.mark.parametrize("text", TEXTS)
def test_words_and_lines(text):
    w = S.Words(pa.array([text, "a b\nc", text]))
    assert w.features.shape == (5, len(w.start)) and (w.features >= 0).all()
    assert all((f < n).all() for f, n in zip(w.features, S.FAMILIES))
    raw = [x for t in (text, "a b\nc", text) for line in (t or "").split("\n")
           for x in [re.findall(rb"(?:[A-Za-z0-9+/_.-]|[\x80-\xff])+", line.encode())] if x]
    assert [len(x) for x in raw] == w.line_size.tolist()


@pytest.mark.parametrize("n", [1, 2, 1500, 24_000_000])
def test_bound_keeps_the_smallest_hashes(spark, n):
    rows = spark.range(n).selectExpr("xxhash64(id) AS hash")
    bound = S.hash_bound(rows, 1500)
    kept = rows.where(f"hash <= {bound}").count()
    assert min(n, 1500) <= kept <= 3000
    # Many equal hashes, and the ends of the range of a long.
    ends = spark.range(9000).selectExpr("IF(id < 5000, 7, IF(id < 7000, -9223372036854775807 - 1, 9223372036854775807)) AS hash")
    for k in (1, 2000, 2001, 7000, 7001, 9000, 9001):
        assert ends.where(f"hash <= {S.hash_bound(ends, k)}").count() == (2000 if k <= 2000 else 7000 if k <= 7000 else 9000)


def test_a_single_finding_trains(spark):
    for i in range(6):  # a bound in doubles lay below about half of single hashes
        docs = spark.createDataFrame([(i, "password=abcdefg1234")], "doc_id long, text string")
        assert S.train(docs) is not None


def test_planted_secrets_that_the_patterns_miss(spark):
    """Recall of whole secrets and false spans, secrets of four makes planted into whole documents of a table."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    field = S.train(docs)
    texts = [r["text"] or "" for r in docs.orderBy("doc_id").limit(300).select("text").collect()]
    rng = np.random.default_rng(5)
    hexa = "0123456789abcdef"
    mixed = hexa + "ghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    draw = lambda signs, n: "".join(rng.choice(list(signs), n))
    for lead, signs, n, least in (("pwd=", mixed, 14, 0.85), ("Authorization: Bearer ", mixed, 36, 0.95),
                                  ("AccountKey: ", mixed + "+/", 44, 0.95), ('credential "', hexa, 20, 0.95)):
        rows, want, wrong = [], [], 0
        for t in texts:
            w = t.split(" ")
            k = int(rng.integers(0, len(w)))
            head, secret = " ".join([*w[:k], lead]), draw(signs, n)
            rows.append(" ".join([head + secret, *w[k:]]))
            want.append((len(head), len(head) + n))
        found = S.tagged(field, pa.array(rows))
        for r, a, z in found:
            known = [want[r], *((s, e) for s, _, e, _ in S.base_spans(rows[r]))]
            wrong += all(z <= s or e <= a for s, e in known)
        hit = {r for r, a, z in found if a <= want[r][0] and want[r][1] <= z}
        assert len(hit) >= least * len(rows) and wrong <= 3, (lead, len(hit), wrong)


def test_varied_windows():
    rng = np.random.default_rng(2)
    label, real = np.zeros((4, 6), np.int64), np.ones((4, 6), bool)
    label[0, :2], label[1, 3] = (S.BEGIN, S.INSIDE), S.BEGIN
    real[2, 4:] = False
    features = np.stack([rng.integers(0, n, label.shape) for n in S.FAMILIES])
    f, y, r = S.varied(features, label, real, 10)
    assert f.shape[1:] == y.shape == r.shape == (4 + 5 * 4, 6)
    assert (f[:, :4] == features).all() and (y[:4] == label).all()
    assert all((x < n).all() and (x >= 0).all() for x, n in zip(f, S.FAMILIES))
    # Nothing is drawn where there is no finding, and the same is drawn each time.
    assert len(S.varied(features[:, 2:], label[2:], real[2:])[1]) == 2
    assert all((a == b).all() for a, b in zip(S.varied(features, label, real, 10), (f, y, r)))
