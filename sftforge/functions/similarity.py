"""Matching-blocks similarity of two texts (E2), in Arrow batches.

The ratio is 2M / T: T characters in both texts together, M of them in matching
blocks.  The first block is the longest common substring, of equally long ones
that which starts first in the answer, then first in the reference; the text on
its left and on its right is matched in the same way.  In a reference of 200
characters or more, characters that make up more than one place in a hundred
(rounded down, plus one) can't start a block, only extend one.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: From this length of the reference on, what share of places makes a character popular.
POPULAR_FROM, POPULAR_SHARE = 200, 100
#: The lengths of a long reference's substrings whose places are listed, when a search first needs them.
LISTED = (1, 2, 4, 8, 16)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _places(usual: np.ndarray) -> tuple[list[int], list[int]]:
    """The places of the characters that can start a block, and where the run of such that each is in ends."""
    places = np.flatnonzero(usual)
    stops = np.append(np.flatnonzero(~usual), len(usual))
    return places.tolist(), stops[np.searchsorted(stops, places)].tolist()


def _ahead(a: str, i: int, ahi: int, b: str, j: int, bhi: int) -> int:
    """How many characters of ``a`` from ``i`` and ``b`` from ``j`` on are equal, in steps that double."""
    k, step, most = 0, 8, min(ahi - i, bhi - j)
    while k < most:
        n = min(step, most - k)
        if a[i + k:i + k + n] == b[j + k:j + k + n]:
            k, step = k + n, step * 2
        elif n == 1:
            break
        else:
            most, step = k + n - 1, max(1, n // 2)
    return k


def _behind(a: str, alo: int, i: int, b: str, blo: int, j: int) -> int:
    """How many characters of ``a`` before ``i`` and ``b`` before ``j`` are equal."""
    k, step, most = 0, 8, min(i - alo, j - blo)
    while k < most:
        n = min(step, most - k)
        if a[i - k - n:i - k] == b[j - k - n:j - k]:
            k, step = k + n, step * 2
        elif n == 1:
            break
        else:
            most, step = k + n - 1, max(1, n // 2)
    return k


class Reference:
    """A text of ``POPULAR_FROM`` characters or more, to match answers with.

    ``usual``: by code point, whether it isn't popular; the last stands for all beyond.
    ``listed[n]``: the places of each of its substrings of ``n`` characters, none popular.
    """

    def __init__(self, b: str):
        self.b = b
        points = _points(b)
        self.usual = np.append(np.bincount(points) <= len(b) // POPULAR_SHARE + 1, True)
        self.places, self.ends = _places(self.usual[points])
        self.listed: dict[int, dict[str, list[int]]] = {}

    def at(self, n: int) -> dict[str, list[int]]:
        if n not in self.listed:
            found: dict[str, list[int]] = {}
            b = self.b
            for j, end in zip(self.places, self.ends):
                if j + n <= end:
                    found.setdefault(b[j:j + n], []).append(j)
            self.listed[n] = found
        return self.listed[n]

    def longest(self, a: str, alo: int, ahi: int, blo: int, bhi: int, places: list[int], ends: list[int], most: int) -> tuple[int, int, int]:
        """As :func:`_longest`, without popular characters.  ``places``: where a block can start in ``a``; ``ends``: where it ends at the latest.

        A place's candidates are the listed places of the characters there, so many
        of them as the best so far has or a few less; each is compared directly.
        """
        b, best_at, best_in, best = self.b, alo, blo, 0
        size, listed = 1, self.at(1)
        for p in range(bisect_left(places, alo), bisect_left(places, ahi)):
            i, end = places[p], min(ends[p], ahi)
            if i + best >= end:
                continue
            candidates = listed.get(a[i:i + size])
            if candidates is None:
                continue
            need = a[i:i + best + 1]
            for c in range(bisect_left(candidates, blo), len(candidates)):
                j = candidates[c]
                if j + best >= bhi or i + best >= end:
                    break
                if b.startswith(need, j):
                    best += 1
                    best += _ahead(a, i + best, end, b, j + best, bhi)
                    best_at, best_in = i, j
                    need = a[i:i + best + 1]
            if best >= most:  # a part's longest is no longer than the whole's
                break
            if best >= size:
                wanted = LISTED[bisect_right(LISTED, best + 1) - 1]
                if wanted != size:
                    size, listed = wanted, self.at(wanted)
        return best_at, best_in, best


def _longest(a: str, b: str, alo: int, ahi: int, blo: int, bhi: int, most: int) -> tuple[int, int, int]:
    """(start in a, start in b, length) of the longest common substring of two windows, none longer than ``most``; ``b`` is short.

    A window's longest is searched from left to right for one character more than
    the best so far, so each place of ``a`` costs one search, and each gain one more.
    """
    best_at, best = alo, 0
    find = b.find
    for i in range(alo, ahi):
        if i + best >= ahi:
            break
        while i + best < ahi and find(a[i:i + best + 1], blo, bhi) >= 0:
            best += 1
            best_at = i
        if best >= most:  # a part's longest is no longer than the whole's
            break
    return best_at, find(a[best_at:best_at + best], blo, bhi) if best else blo, best


def matching_characters(a: str, b: str, reference: Reference | None = None) -> int:
    """Characters of ``a`` in matching blocks with ``b``; ``reference``: that of ``b``, if it is there already."""
    if len(b) >= POPULAR_FROM:
        reference = reference or Reference(b)
        places, ends = _places(reference.usual[np.minimum(_points(a), len(reference.usual) - 1)])
    else:
        reference = None
    total, stack = 0, [(0, len(a), 0, len(b), len(a))]
    while stack:
        alo, ahi, blo, bhi, most = stack.pop()
        if reference:
            i, j, k = reference.longest(a, alo, ahi, blo, bhi, places, ends, most)
        else:
            i, j, k = _longest(a, b, alo, ahi, blo, bhi, most)
        found = k
        # Popular characters extend a block, or stand for one at the windows' start.
        back = _behind(a, alo, i, b, blo, j)
        i, j, k = i - back, j - back, k + back
        k += _ahead(a, i + k, ahi, b, j + k, bhi)
        if k:
            total += k
            if alo < i and blo < j:
                stack.append((alo, i, blo, j, found))
            if i + k < ahi and j + k < bhi:
                stack.append((i + k, ahi, j + k, bhi, found))
    return total


def ratio(a: str, b: str, reference: Reference | None = None) -> float:
    """2M / T; 1.0 if both texts are empty."""
    if a == b:
        return 1.0
    return 2.0 * matching_characters(a, b, reference) / (len(a) + len(b))


def _ratios(answers: pd.Series, references: pd.Series, wanted: pd.Series) -> pd.Series:
    out, known, last = [], {}, None
    for pair, want in zip(zip(answers, references), wanted):
        if want and pair not in known:
            a, b = pair
            if len(b) >= POPULAR_FROM and a != b and (last is None or last.b != b):
                last = Reference(b)  # the answers to one item mostly follow each other
            known[pair] = ratio(a, b, last if last is not None and last.b == b else None)
        out.append(known[pair] if want else None)
    return pd.Series(out, dtype="float64")


def reference_similarity(answer: Column, reference: Column, at_least: float | None = None) -> Column:
    """Matching-blocks ratio of answer and reference (E2); nulls are empty texts.

    Asymmetric, and quadratic in the texts' length at worst.  With ``at_least``
    pairs whose lengths alone keep them below it are null and never compared.
    """
    from sftforge.functions.scores import similarity_upper_bound
    from sftforge.session import ship_package

    ship_package()
    wanted = F.lit(True) if at_least is None else similarity_upper_bound(answer, reference) >= at_least
    # Texts that aren't wanted don't travel to Python.
    sent = [F.when(wanted, F.coalesce(c, F.lit(""))) for c in (answer, reference)]
    return F.pandas_udf(_ratios, "double")(*sent, wanted)
