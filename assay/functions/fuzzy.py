"""String similarity by longest common subsequence, which has no built-in form."""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


@lru_cache(100_000)
def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    if len(a) > len(b):
        a, b = b, a
    full = (1 << len(a)) - 1
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return bin(~row & full).count("1")


def similarity(a: str | None, b: str | None) -> float:
    """200 * common / (lengths); 100 for two empty strings."""
    if a is None or b is None:
        return 0.0
    total = len(a) + len(b)
    return 100.0 if not total else 200.0 * common_subsequence(a, b) / total


def partial_similarity(a: str | None, b: str | None) -> float:
    """The best similarity of the shorter string with a substring of its length in the longer one.

    No more characters are common in order than are in any; substrings that cannot be better by that bound are not compared.
    """
    if not a or not b:
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    if a in b:
        return 100.0
    n, free, shared, bounds = len(a), Counter(a), 0, []
    for i in range(1 - n, len(b)):
        if i + n <= len(b):
            c = b[i + n - 1]
            shared += free[c] > 0
            free[c] -= 1
        if i > 0:
            c = b[i - 1]
            free[c] += 1
            shared -= free[c] > 0
        bounds.append((200.0 * shared / (n + min(len(b), i + n) - max(0, i)), i))
    best = 0.0
    for bound, i in sorted(bounds, reverse=True):
        if bound <= best:
            break
        best = max(best, similarity(a, b[max(0, i) : i + n]))
    return best


def most_similar(names: list[str], others: list[str], labels: list[str], least: float) -> list[tuple[str, float] | None]:
    """For each name the label of the most similar other, the least label of equals, and the similarity, if it is `least` or more.

    One name is compared with all others at once, by the bit-parallel rows of common_subsequence on arrays.
    """
    by = sorted(range(len(others)), key=lambda k: (len(others[k]), labels[k]))
    others, labels = [others[k] for k in by], [labels[k] for k in by]
    place = np.empty(len(labels), np.int64)
    place[sorted(range(len(labels)), key=labels.__getitem__)] = np.arange(len(labels))
    sizes = np.array([len(x) for x in others], np.int64)
    code = {c: k + 1 for k, c in enumerate(sorted(set().union(*others)))}
    # column k has the codes of character k of all others, which are in order of length
    letters = [np.array([code[x[k]] for x in others[first:]], np.int64) for k in range(int(sizes.max(initial=0))) for first in [int(np.searchsorted(sizes, k, "right"))]]
    out: list[tuple[str, float] | None] = []
    for name in names:
        m = len(name)
        # 200 * min >= least * (sum of lengths) bounds the lengths
        fits = np.flatnonzero(200 * np.minimum(m, sizes) >= least * (m + sizes))
        if not len(fits):
            out.append(None)
            continue
        low, high = int(fits[0]), int(fits[-1]) + 1
        if m > 64:
            common = np.array([common_subsequence(name, x) for x in others[low:high]])
        else:
            masks = np.zeros(len(code) + 1, np.uint64)
            for k, c in enumerate(name):
                if c in code:
                    masks[code[c]] |= np.uint64(1 << k)
            full = np.uint64((1 << m) - 1)
            row = np.full(high - low, full, np.uint64)
            for k in range(int(sizes[high - 1])):
                first = len(others) - len(letters[k])
                at = max(low, first)
                part = row[at - low :]
                hit = part & masks[letters[k][at - first : high - first]]
                row[at - low :] = (part + hit) | (part - hit)
            common = np.bitwise_count(~row & full)
        total = m + sizes[low:high]
        score = np.where(total > 0, 200.0 * common / np.maximum(total, 1), 100.0)
        top = score.max()
        ties = np.flatnonzero(score == top)
        best = low + int(ties[place[low:high][ties].argmin()])
        out.append((labels[best], float(top)) if top >= least else None)
    return out


@F.pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def partial_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([partial_similarity(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")
