"""TF-IDF over character n-grams inside word bounds."""

from __future__ import annotations

from collections import Counter
from itertools import pairwise

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def char_ngrams(text: Column, low: int = 2, high: int = 4) -> Column:
    """All n-grams of each word with a space at both ends; a word no longer than n is one n-gram, and longer n skip it."""

    def of_word(word: Column) -> Column:
        size = F.char_length(word)

        def of_size(n: Column) -> Column:
            cut = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), size - n + 1)), lambda i: F.substring(word, i, n))
            return F.when((n > low) & (size < n), F.array().cast("array<string>")).otherwise(cut)

        return F.flatten(F.transform(F.sequence(F.lit(low), F.lit(high)), of_size))

    padded = F.transform(F.filter(F.split(text, " "), lambda t: t != ""), lambda t: F.concat(F.lit(" "), t, F.lit(" ")))
    return F.flatten(F.transform(padded, of_word))


def fit(texts: DataFrame, column: str, low: int = 2, high: int = 4) -> DataFrame:
    """(gram, idf) with idf = ln((1 + n) / (1 + df)) + 1 over all rows; counts are pre-aggregated and n is a one-row join."""
    total = texts.agg(F.count("*").alias("n"))
    grams = texts.select(F.explode(F.array_distinct(char_ngrams(F.col(column), low, high))).alias("gram"))
    df = grams.groupBy("gram").agg(F.count("*").alias("df"))
    return df.crossJoin(F.broadcast(total)).select("gram", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def vectors(texts: DataFrame, key: str, column: str, idf: DataFrame, low: int = 2, high: int = 4) -> DataFrame:
    """(key, grams, weights): unit vectors as sorted n-gram hashes and weights; n-grams that idf lacks are left out."""
    grams = texts.select(key, F.explode(char_ngrams(F.col(column), low, high)).alias("gram")).groupBy(key, "gram").agg(F.count("*").alias("tf"))
    weighed = grams.join(idf, "gram").select(key, F.xxhash64("gram").alias("g"), (F.col("tf") * F.col("idf")).alias("w"))
    rows = weighed.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("g", "w"))).alias("v"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return rows.select(key, F.transform("v", lambda x: x["g"]).alias("grams"), F.transform("v", lambda x: x["w"] / F.col("norm")).alias("weights"))


def word_ngrams(text: str, low: int = 2, high: int = 4) -> list[str]:
    """What char_ngrams gives, in its order, for one text."""
    out = []
    for word in text.split(" "):
        if word:
            word = f" {word} "
            for n in range(low, high + 1):
                if n == low or len(word) >= n:
                    out += [word[i : i + n] for i in range(max(1, len(word) - n + 1))]
    return out


def aligned(texts: DataFrame, key: str, column: str, idf: DataFrame, name: str, low: int = 2, high: int = 4) -> DataFrame:
    """(key, name): the weights of each text's distinct n-grams in the order of their first places, 0 for those that idf lacks; texts without n-grams have no row."""
    grams = texts.select(key, F.posexplode(F.array_distinct(char_ngrams(F.col(column), low, high))).alias("at", "gram"))
    weighed = grams.join(idf, "gram", "left").select(key, F.struct("at", F.coalesce("idf", F.lit(0.0)).alias("w")).alias("x"))
    return weighed.groupBy(key).agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["w"]).alias(name))


class Rows:
    """Unit vectors of texts as sparse rows over the n-grams that occur in them, from the weights that aligned() gives."""

    def __init__(self, low: int = 2, high: int = 4):
        self.low, self.high = low, high
        self.numbers: dict[str, int] = {}

    def add(self, texts: list[str], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start of each row and the end, n-gram numbers, values)."""
        ids: list[np.ndarray] = []
        values: list[np.ndarray] = []
        for text, own in zip(texts, weights, strict=True):
            counts = Counter(word_ngrams(text, self.low, self.high))
            ids.append(np.fromiter((self.numbers.setdefault(g, len(self.numbers)) for g in counts), np.int64, len(counts)))
            v = np.fromiter(counts.values(), float, len(counts)) * own
            values.append(v / (np.sqrt(v @ v) or 1.0))
        start = np.cumsum([0, *map(len, ids)])
        return start, np.concatenate(ids or [np.zeros(0, np.int64)]), np.concatenate(values or [np.zeros(0)])

    def dots(self, left: tuple, right: tuple, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The products of rows a[i] of left and b[i] of right: each row of left is spread once and met by all of its partners."""
        out, dense = np.zeros(len(a)), np.zeros(len(self.numbers))
        order = np.argsort(a, kind="stable")
        edges = np.flatnonzero(np.append(np.append(True, np.diff(a[order]) != 0), True)) if len(a) else np.zeros(1, int)
        (start, ids, values), (at, others, weights) = left, right
        for i, j in pairwise(edges.tolist()):
            own = order[i:j]
            row, partners = a[own[0]], b[own]
            span = slice(start[row], start[row + 1])
            dense[ids[span]] = values[span]
            many = at[partners + 1] - at[partners]
            places = np.arange(many.sum()) + np.repeat(at[partners] - np.cumsum(many) + many, many)
            out[own] = np.bincount(np.repeat(np.arange(len(own)), many), dense[others[places]] * weights[places], len(own))
            dense[ids[span]] = 0
        return out
