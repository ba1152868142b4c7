"""Operator 5, packing: power-of-two decomposition of token sequences.

Each document (its token ids and one end id) is cut into pieces whose lengths
are powers of two: as many full windows as fit, then the binary digits of the
rest, largest first.  Every piece is a sequence of its own, so no sequence ever
holds two documents, and sequences of equal length form the buckets from which
batches without padding are drawn.

Edge cases: a null or empty text gives the end id alone (one piece of length
1); null ids pass through; repeated rows are packed each for itself; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftforge.llm.common import WORD_BREAK, PrefixHash, documents, prepare, sliced, text_bytes

WINDOW = 1024
END_ID = 0
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, bucket int")
#: Texts whose code points all lie below take the vectorised word split; others the tokenizer's own.
PLAIN_BELOW = 0x590
_LETTER, _NUMBER, _SPACE, _OTHER = 0, 1, 2, 3


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return tok


@lru_cache(maxsize=2)
def _ranked(path: str):
    """The same vocabulary with its ids as merge ranks, which tiktoken merges faster.

    None if the ids don't rank the merges; the tokenizer itself then does all.
    """
    import tiktoken

    tok = _tokenizer(path)
    sign = _signs()
    vocab = {bytes(sign[c] for c in t): i for t, i in tok.get_vocab(with_added_tokens=False).items()
             if all(c in sign for c in t)}
    vocab = {t: i for t, i in vocab.items() if t != b"<|endoftext|>"}
    merges = [a + b for a, b in json.loads(tok.to_str())["model"]["merges"]]
    ids = [vocab.get(bytes(sign[c] for c in m)) for m in merges]
    if None in ids or ids != sorted(ids) or len(vocab) != 256 + len(ids):
        return None
    return tiktoken.Encoding("ranked", pat_str=r" ?\S+|\s+", mergeable_ranks=vocab, special_tokens={})


def _signs() -> dict[str, int]:
    """Byte of each sign of the byte-level alphabet: printable Latin-1 stands for itself, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Letter, number, space or other for each code point below PLAIN_BELOW."""
    import regex

    out = np.full(PLAIN_BELOW, _OTHER, np.int8)
    chars = "".join(map(chr, range(PLAIN_BELOW)))
    for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\p{White_Space}")):
        out[[ord(c) for c in regex.findall(pattern, chars)]] = kind
    return out


def split_words(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte starts of the byte-level tokenizer's words (``data``: texts back to back, plain).

    A word is a contraction, or a run of letters, of numbers or of other signs
    with at most one blank before it, or a run of white space that leaves its
    last character to the next word.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    at = np.flatnonzero((data & 0xC0) != 0x80)  # first byte of each code point
    code = data[at].astype(np.int32)
    two = code >= 0xC0  # below PLAIN_BELOW: at most two bytes
    code[two] = ((code[two] & 0x1F) << 6) | (data[at[two] + 1] & 0x3F)
    kind = _classes()[code]
    n = len(at)
    first = np.zeros(n + 1, bool)  # first code point of a text
    first[np.searchsorted(at, offsets)] = True
    last = first[1:]
    last[-1] = True
    first = first[:n]
    prev = np.empty(n, np.int8)
    prev[0], prev[1:] = -1, kind[:-1]
    start = first | (kind != prev)
    # A blank right before a run of another kind belongs to that run.
    space = kind == _SPACE
    nxt = np.empty(n, np.int8)
    nxt[-1], nxt[:-1] = -1, kind[1:]
    ends_run = space & ~last & (nxt != _SPACE)
    start |= ends_run  # the last white-space character of a run stands apart ...
    joined = np.flatnonzero(ends_run & (code == 0x20)) + 1
    start[joined] = False  # ... and a blank takes the run that follows
    # Contractions: an apostrophe that starts a word, with s, t, m, d, re, ve or ll behind it.
    mark = np.flatnonzero(start & (code == 0x27) & ~last)
    if len(mark):
        limit = np.append(np.searchsorted(at, offsets)[1:], n)
        stop = limit[np.searchsorted(np.searchsorted(at, offsets), mark, side="right") - 1]
        a = code[mark + 1]
        b = np.where(mark + 2 < stop, code[np.minimum(mark + 2, n - 1)], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        pair = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        for hit, size in ((one, 1), (pair, 2)):
            m = mark[hit]
            start[m + 1] = False
            after = m + 1 + size
            start[after[after < n]] = True
    return at[start]


class WordCoder:
    """Token ids by word, kept for the whole task: a word is tokenized the first time it is seen.

    Words are told apart by 64-bit hashes (two of a task's words clash with odds
    under 1e-7).  The store is emptied beyond ``MOST`` words, so memory is bounded.
    """

    MOST = 2_000_000

    def __init__(self, path: str):
        self.tok = _tokenizer(path)
        size = np.zeros(self.tok.get_vocab_size(), np.int64)
        for token, i in self.tok.get_vocab().items():
            size[i] = len(token)  # byte-level alphabet: one sign for each byte
        self.size = size
        self.ranked = _ranked(path)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.first = self.count = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _ids(self, texts: list[str]) -> np.ndarray:
        coded = [x.ids for x in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.array(x, np.uint32) for x in coded]) if coded else np.zeros(0, np.uint32)

    def learn(self, keys: np.ndarray, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> None:
        """Tokenize words ``raw[starts:ends]``.  Those of a blank and more are laid end to end, as each blank starts a word."""
        if len(self.keys) + len(keys) > self.MOST:
            self.clear()
        byte = np.frombuffer(raw, np.uint8)
        lone = (byte[starts] != 0x20) | (ends - starts < 2) | WORD_BREAK[byte[np.minimum(starts + 1, len(byte) - 1)]] \
            | (byte[np.minimum(starts + 1, len(byte) - 1)] == 0xC2)  # may open a wide blank
        order = np.argsort(lone, kind="stable")
        keys, starts, ends = keys[order], starts[order], ends[order]
        n = int((~lone).sum())
        pieces = [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist())]
        if self.ranked:
            rows = b"".join(pieces[:n]).decode()
            ids = np.array(self.ranked.encode_ordinary(rows), np.uint32)
            ids = np.concatenate([ids, self._ids([p.decode() for p in pieces[n:]])])
        else:
            rows = [b"".join(pieces[i:min(i + 256, n)]).decode() for i in range(0, n, 256)]
            ids = self._ids(rows + [p.decode() for p in pieces[n:]])
        ends_at = np.cumsum(self.size[ids])
        upto = np.searchsorted(ends_at, np.cumsum(ends - starts)) + 1
        count = np.diff(upto, prepend=0)
        all_keys = np.concatenate([self.keys, keys])
        by = np.argsort(all_keys)
        self.first = np.concatenate([self.first, upto - count + len(self.flat)])[by]
        self.count = np.concatenate([self.count, count])[by]
        self.keys, self.flat = all_keys[by], np.concatenate([self.flat, ids])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts back to back (no end ids), and the number of ids of each text."""
        data, offsets = text_bytes(texts)
        rows = len(offsets) - 1
        # 0xD6 0x90 is the first code point not below PLAIN_BELOW.
        high = np.concatenate([[0], np.cumsum(data >= 0xD6)])
        odd = high[offsets[1:]] > high[offsets[:-1]]
        if odd.any():
            whole = [np.array(x.ids, np.uint32) for x in self.tok.encode_batch_fast(
                texts.filter(pa.array(odd)).to_pylist(), add_special_tokens=False)]
            plain, sizes = self.encode(texts.filter(pa.array(~odd)))
            count = np.zeros(rows, np.int64)
            count[~odd], count[odd] = sizes, [len(x) for x in whole]
            parts: list = [None] * rows
            for r, x in zip(np.flatnonzero(~odd), np.split(plain, np.cumsum(sizes)[:-1]) if len(sizes) else []):
                parts[r] = x
            for r, x in zip(np.flatnonzero(odd), whole):
                parts[r] = x
            return np.concatenate(parts), count
        starts = split_words(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(rows, np.int64)
        ends = np.append(starts[1:], len(data))
        keys, where, inverse = np.unique(PrefixHash(data).of(starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        if len(self.keys):
            new = self.keys[np.minimum(at, len(self.keys) - 1)] != keys
        if len(self.keys) + new.sum() > self.MOST:
            self.clear()
            new[:] = True
        self.learn(keys[new], data.tobytes(), starts[where[new]], ends[where[new]])
        at = np.searchsorted(self.keys, keys)[inverse]
        each = self.count[at]
        upto = np.concatenate([[0], np.cumsum(each)])
        place = np.arange(upto[-1]) + np.repeat(self.first[at] - upto[:-1], each)
        bound = upto[np.searchsorted(starts, offsets)]
        return self.flat[place], np.diff(bound)


def pieces(n: int, window: int = WINDOW) -> list[int]:
    """Full windows, then the powers of two of the rest, largest first."""
    rest = n % window
    return [window] * (n // window) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece; ``window`` must be a power of two.  ``bucket``: log2 of the length."""
    if window < 1 or window & (window - 1):
        raise ValueError("window must be a power of two")
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordCoder(path)
        for batch in sliced(batches):
            ids, counts = coder.encode(batch.column("text"))
            rows = {k: [] for k in ("doc", "start", "length", "crc", "tokens")}
            begin = 0
            for d, n in enumerate(counts.tolist()):
                own = np.append(ids[begin:begin + n], np.uint32(end_id)).astype("<u4").tobytes()
                begin += n
                at = 0
                for size in pieces(n + 1, window):
                    rows["doc"].append(d)
                    rows["start"].append(at)
                    rows["length"].append(size)
                    rows["crc"].append(zlib.crc32(own[4 * at:4 * (at + size)]))
                    rows["tokens"].append(n + 1)
                    at += size
            length = np.array(rows["length"], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows["doc"], pa.int64())), pa.array(rows["start"], pa.int64()),
                 pa.array(length), pa.array(rows["crc"], pa.int64()), pa.array(rows["tokens"], pa.int64()),
                 pa.array(np.log2(length).round().astype(np.int32))],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "bucket"])

    cut = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
           .mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bucket int"))
    return cut.select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                      F.monotonically_increasing_id().alias("sequence_id"),
                      F.lit(0).cast("long").alias("offset"), "bucket")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), default_tokenizer())
