"""Pair similarities: string ratios in Arrow batches, set and length ratios as expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import batch


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit for each character of a."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    free = full
    for c in b:
        hit = free & places.get(c, 0)
        free = (free + hit | free - hit) & full
    return len(a) - free.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """Two common subsequences over both lengths; 1 for two empty strings."""
    if a == b:
        return 1.0
    return 2 * common_subsequence(a, b) / (len(a) + len(b))


def jaro_winkler(a: str, b: str, weight: float = 0.1) -> float:
    """Jaro similarity, raised by a common prefix of up to four where it exceeds 0.7; 1 for equal strings."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken = [False] * len(b)
    mine = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                mine.append(c)
                break
    if not mine:
        return 0.0
    theirs = [c for c, t in zip(b, taken, strict=True) if t]
    m, swaps = len(mine), sum(x != y for x, y in zip(mine, theirs, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * weight * (1 - jaro)


def token_sort_ratio(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """0 without words; 1 if one side's words hold the other's; else the best ratio among the common words and both completions."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = x & y
    if both and (both == x or both == y):
        return 1.0
    common = " ".join(sorted(both))
    left = " ".join(sorted(x - y))
    right = " ".join(sorted(y - x))
    one, two = f"{common} {left}".strip(), f"{common} {right}".strip()
    best = indel_ratio(one, two)
    if both:
        best = max(best, indel_ratio(common, one), indel_ratio(common, two))
    return best


def _udf(f):
    @F.pandas_udf(T.DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(f(a.fillna("").tolist(), b.fillna("").tolist()), dtype="float64")

    return run


indel, jaro, token_sort, token_set = map(_udf, (batch.indel_ratios, batch.jaro_winklers, batch.token_sort_ratios, batch.token_set_ratios))


@F.pandas_udf(T.DoubleType())
def sparse_dot(keys_a: pd.Series, values_a: pd.Series, keys_b: pd.Series, values_b: pd.Series) -> pd.Series:
    """Dot products of sparse rows (distinct keys and their values), all rows of a batch at once; a null row is zero."""
    out = np.zeros(len(keys_a))

    def flat(keys: pd.Series, values: pd.Series):
        sizes = [0 if k is None else len(k) for k in keys]
        row = np.repeat(np.arange(len(keys)), sizes)
        some = [i for i, n in enumerate(sizes) if n]
        empty = np.zeros(0)
        return row, np.concatenate([np.asarray(keys.iloc[i], np.int64) for i in some] or [empty.astype(np.int64)]), np.concatenate([np.asarray(values.iloc[i], float) for i in some] or [empty])

    ra, ka, va = flat(keys_a, values_a)
    rb, kb, vb = flat(keys_b, values_b)
    row, key, value = np.concatenate((ra, rb)), np.concatenate((ka, kb)), np.concatenate((va, vb))
    order = np.lexsort((key, row))
    row, key, value = row[order], key[order], value[order]
    same = np.flatnonzero((row[1:] == row[:-1]) & (key[1:] == key[:-1]))
    np.add.at(out, row[same], value[same] * value[same + 1])
    return pd.Series(out)


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def length_ratio(a: Column, b: Column) -> Column:
    """1 less the lengths' difference over the longer one; 1 if both are empty."""
    x, y = F.char_length(a), F.char_length(b)
    return F.when(F.greatest(x, y) == 0, 1.0).otherwise(1 - F.abs(x - y) / F.greatest(x, y))


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")
