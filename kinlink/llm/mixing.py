"""Mixing sources to target weights by entropy balancing.

A document's rate r is the number of times the mix takes it. Among all rates from 0 to `most` that meet each source's token target
(sum r * size = T), the ones closest in entropy to taking every document once are sought: the least sum of w * (r ln r - r + 1), with base
weights w = size + m for a source's mean size m. Weighing a document by its tokens and a mean one's keeps the tilt mild: the rates
are r = min(most, exp(a * z)) for the bounded feature z = size / (size + m), so that short documents stay near once and the
longest approach exp(a). The dual in a is convex, one number for each source; safeguarded Newton iterations solve it for all sources at
once: the tasks sum its gradient and curvature over the (source, size) classes they hold, nothing is shuffled, and the driver
adds up a few numbers for each source and task and steps.

Rates become copies by systematic rounding: within a source the classes follow each other by falling size, and each class takes the
whole number of copies that keeps the running error under half a document of that size; the rounding of the many small
documents absorbs that of the large ones, so a source ends within a few words of its target. Which documents of a class get the
extra copy follows a hash of the id, ranked within salted parts of the class, so no task holds a whole hot source.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import WORD, aside, back, cut

MOST = 3
#: Parts of a class of documents of one source and size.
SALT = 64


def words_of(text: str = "text") -> F.Column:
    return F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.regexp_count(F.col(text), F.lit(WORD))).cast("long")


def targets(sizes: dict[str | None, int], weights: Sequence[float] = (1, 2, 3), most: float = MOST) -> dict[str | None, float]:
    """The target of each source of these sizes: weights repeat over the sources by code point, null last.

    Targets share the total of all sizes by weight; none exceeds `most` times its source, the excess is shared anew by weight
    among the others until none is above.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    out, free, left = dict.fromkeys(order, 0.0), order, float(sum(sizes.values()))
    while free:
        each = left / sum(weight[s] for s in free)
        over = [s for s in free if each * weight[s] > most * sizes[s]]
        if not over:
            return out | {s: each * weight[s] for s in free}
        out |= {s: float(most * sizes[s]) for s in over}
        left -= sum(out[s] for s in over)
        free = [s for s in free if s not in over]
    return out


def tilted(size, a, mean, most: float = MOST):
    """The rate of documents of this size: numpy arrays or numbers."""
    return np.minimum(most, np.exp(np.minimum(a * (size / (size + mean)), 700.0)))


def balance(classes: DataFrame, goals: list[tuple[float, float]], most: float = MOST, rounds: int = 60, tolerance: float = 1e-9) -> np.ndarray:
    """The tilt a of each source; classes is (k, size, docs) with k the source's number in goals, (mean size, target) each.

    A target of 0 has the tilt -inf, one of `most` times the source or more +inf.
    """
    mean, target = np.array(goals, float).reshape(-1, 2).T
    low, high, a = np.full(len(goals), -np.inf), np.full(len(goals), np.inf), np.zeros(len(goals))

    def at(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens taken at these tilts, and their derivative."""

        def sums(batches):
            held = np.zeros((2, len(a)))
            for batch in batches:
                k, size, docs = (c.to_numpy() for c in batch.columns)
                rate, tokens = tilted(size, a[k], mean[k], most), size * docs
                held[0] += np.bincount(k, tokens * rate, len(a))
                held[1] += np.bincount(k, np.where(rate < most, tokens * rate * size / (size + mean[k]), 0.0), len(a))
            own = np.flatnonzero(held[0])
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(held[0][own]), pa.array(held[1][own])], ["k", "f", "d"])

        found = classes.select(F.col("k").cast("int"), F.col("size").cast("double"), F.col("docs").cast("double")).mapInArrow(sums, "k int, f double, d double").toArrow()
        k, f, d = (c.to_numpy() for c in found.columns)
        return np.bincount(k, f, len(a)), np.bincount(k, d, len(a))

    full = at(np.full(len(goals), np.inf))[0] if len(goals) else target
    done = (target <= 0) | (target >= full * (1 - 1e-12))
    for _ in range(rounds):
        if done.all():
            break
        f, d = at(a)
        off = f - target
        done |= np.abs(off) <= tolerance * target
        low, high = np.where(off < 0, np.maximum(low, a), low), np.where(off > 0, np.minimum(high, a), high)
        step = np.clip(a - off / np.maximum(d, 1e-300), a - 8, a + 8)
        # a step out of what is known to hold the solution goes to its middle
        inside = (step > low) & (step < high)
        middle = np.where(np.isfinite(low) & np.isfinite(high), np.maximum(low, -1e300) / 2 + np.minimum(high, 1e300) / 2, step)
        a = np.where(done, a, np.where(inside, step, middle))
    return np.where(target <= 0, -np.inf, np.where(target >= full * (1 - 1e-12), np.inf, a))


def _round(most: int):
    """Whole copies for each size of a source, the largest documents first; a source has as many rows here as sizes."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("size", ascending=False, kind="stable")
        error, copies = 0.0, []
        for size, n, rate in zip(frame["size"], frame["docs"], frame["rate"], strict=True):
            want = n * rate * size + error
            take = min(most * n, max(0, math.floor(want / size + 0.5)))
            error = want - take * size
            copies.append(int(take))
        return frame.assign(copies=copies)[["source", "size", "copies"]]

    return run


def mixed_copies(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """The mix itself: each row of docs (doc_id, source, text, other columns) as often as the mix takes it."""
    columns = docs.columns
    inner = aside(docs, doc_id="doc_id", source="source", text="text").withColumn("size", words_of()).drop("text")
    return mix(inner, weights, most).filter("copies > 0").withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(*back(columns))


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), most: int = MOST, salt: int = SALT) -> DataFrame:
    """docs (doc_id, source, size, other columns) with source_size, target, rate and copies; size from words_of().

    A document of size 0 (a null or wordless text) gets no copy and has no influence. Repeated rows count and are rounded as often
    as they occur. A null source is a source of its own, the last. Columns of docs named like the new ones are replaced. No rows give
    no rows. salt is the number of parts that a class is ranked in; another one gives the extra copies to other documents.
    """
    columns, made = docs.columns, ("source_size", "target", "rate", "copies")
    docs = aside(docs, doc_id="doc_id", source="source", size="size")
    spark = docs.sparkSession
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(salt)).cast("int")
    parts = cut(docs.groupBy(F.col("source").cast("string").alias("source"), "size", place.alias("part")).agg(F.count("*").alias("n")))
    classes = parts.groupBy("source", "size").agg(F.sum("n").alias("docs"))
    # a few numbers for each source
    found = classes.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("words"), F.sum(F.when(F.col("size") > 0, F.col("docs")).otherwise(0)).alias("docs")).collect()
    goal = targets({r.source: r.words for r in found}, weights, most)
    rows = [(k, r.source, r.words, goal[r.source], r.words / max(1, r.docs)) for k, r in enumerate(found)]
    numbered = spark.createDataFrame(rows, "k int, s string, source_size long, target double, mean double")
    known = cut(classes.join(F.broadcast(numbered), F.col("source").eqNullSafe(F.col("s"))).drop("s"))
    tilt = balance(known.filter("size > 0"), [(max(r[4], 1e-9), r[3]) for r in rows], most).tolist()
    tilts = spark.createDataFrame([(k, a) for k, a in enumerate(tilt)], "k int, a double")
    # the largest exponent keeps an infinite tilt from giving NaN
    power = F.greatest(F.least(F.col("a"), F.lit(1e300)), F.lit(-1e300)) * (F.col("size") / (F.col("size") + F.col("mean")))
    rate = F.least(F.lit(float(most)), F.exp(F.least(power, F.lit(700.0))))
    rated = known.join(F.broadcast(tilts), "k").withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(0.0))
    whole = rated.filter("size > 0").select("source", "size", "docs", "rate").groupBy("source").applyInPandas(_round(most), "source string, size long, copies long")
    r = rated.select("source", "size", "docs", "source_size", "target", "rate").alias("r")
    w = whole.select(F.col("source").alias("ws"), F.col("size").alias("wsize"), "copies")
    classed = r.join(w, F.col("source").eqNullSafe(F.col("ws")) & (F.col("size") == F.col("wsize")), "left").drop("ws", "wsize")
    # a class's copies over its parts, in proportion to their documents
    p = parts.select(F.col("source").alias("ps"), F.col("size").alias("psize"), "part", "n", F.sum("n").over(W.partitionBy("source", "size").orderBy("part")).alias("upto"))
    cells = classed.join(p, F.col("source").eqNullSafe(F.col("ps")) & (F.col("size") == F.col("psize")))
    k = F.coalesce(F.col("copies"), F.lit(0))
    share = F.floor(k * F.col("upto") / F.col("docs")) - F.floor(k * (F.col("upto") - F.col("n")) / F.col("docs"))
    cells = cells.select("ps", "psize", "part", "n", share.alias("k"), "source_size", "target", "rate")
    per = W.partitionBy("_source", "size", "_part").orderBy(F.xxhash64(F.col("doc_id").cast("string"), F.lit(1)), "doc_id")
    ranked = docs.withColumns({"_source": F.col("source").cast("string"), "_part": place}).withColumn("_rank", F.row_number().over(per))
    out = ranked.join(cells, F.col("_source").eqNullSafe(F.col("ps")) & (F.col("size") == F.col("psize")) & (F.col("_part") == F.col("part")))
    copies = (F.floor(F.col("k") / F.col("n")) + (F.col("_rank") <= F.col("k") % F.col("n")).cast("long")).alias("copies")
    return out.select(*back(columns, made), "source_size", "target", "rate", copies)
