"""Gradient-boosted trees grown by leaves, all folds' models in one growth.

Features are binned once by quantiles; a row is then a byte for each feature, its label and its fold, and rows are held in blocks of columns. A pass over
the blocks adds up histograms of gradients (tasks sum their own rows, the sums of many tasks meet in a shuffle by slot), and the driver gets sums only: at
most models x leaves x features x bins numbers, of FEW tasks at most. One pass serves the models of all folds and every leaf that may still
be split, so a tree takes as many passes as it is deep, not one for each leaf and model. The smaller child is counted, the other is the difference.
A pass has little work and there are many, so a block is one object on its way to Python, and only the paths to the nodes asked for are followed.

Gradients are whole numbers of 2**-20, so sums are exact; cuts come from counts of rounded values. So the trees do not depend on the partitioning. A null or NaN feature counts as the least value.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.blocks import gathered
from ..sources.lineage import once

UNIT = float(1 << 20)
#: Trees between two writings of the rows' scores, rows of a block, blocks of a task beyond one task a core, and tasks whose sums the driver adds.
KEEP, PART, BLOCKS, FEW = 10, 20_000, 10, 16
#: Least sum of second derivatives of a leaf.
LEAST_HESSIAN = 1e-3


@dataclass
class Tree:
    """Nodes as parallel lists; a node with left < 0 is a leaf. Rows with bin <= cut of the feature go left."""

    feature: list[int]
    cut: list[int]
    left: list[int]
    right: list[int]
    value: list[float]


def leaves(tree: Tree, bins: np.ndarray) -> np.ndarray:
    """The node of each row of bins (rows x features)."""
    feature, cut = np.array(tree.feature, np.int64), np.array(tree.cut, np.int64)
    sides = np.array([tree.right, tree.left], np.int64).T
    inner = sides[:, 1] >= 0
    sides[~inner] = np.flatnonzero(~inner)[:, None]  # a leaf leads to itself
    depth = np.zeros(len(inner), np.int64)
    for i in np.flatnonzero(inner):  # children come behind their parent
        depth[sides[i]] = depth[i] + 1
    at, flat, first, sides = np.zeros(len(bins), np.int64), np.ascontiguousarray(bins).ravel(), np.arange(len(bins)) * bins.shape[1], sides.ravel()
    for _ in range(int(depth.max(initial=0))):
        at = sides[2 * at + (flat[first + feature[at]] <= cut[at])]
    return at


@dataclass
class Model:
    """Trees over binned features; `constant` is the probability of a model that saw one label only."""

    features: tuple[str, ...]
    cuts: list[list[float]]
    trees: list[Tree] = field(default_factory=list)
    constant: float | None = None

    def probability(self) -> Column:
        """The probability of label 1 from the feature columns."""
        cuts, trees, constant = self.cuts, self.trees, self.constant
        if constant is not None:
            return F.lit(constant)

        @F.pandas_udf("double")
        def scored(values: pd.DataFrame) -> pd.Series:
            bins = binned(values.to_numpy(float), cuts)
            return pd.Series(_sigmoid(sum((np.array(t.value)[leaves(t, bins)] for t in trees), np.zeros(len(bins)))))

        return scored(F.struct(*(F.col(c).cast("double").alias(c) for c in self.features)))

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps({"features": self.features, "cuts": self.cuts, "constant": self.constant, "trees": [vars(t) for t in self.trees]})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load(spark: SparkSession, path: str) -> Model:
    made = json.loads(spark.read.text(path).first()[0])
    return Model(tuple(made["features"]), made["cuts"], [Tree(**t) for t in made["trees"]], made["constant"])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def binned(values: np.ndarray, cuts: list[list[float]]) -> np.ndarray:
    """Bytes: how many of a feature's cuts are below the value."""
    values = np.where(np.isnan(values), -np.inf, values)
    return np.stack([np.searchsorted(c, values[:, i], "left") for i, c in enumerate(cuts)], axis=1).astype(np.uint8)


def _cuts(values: DataFrame, features: tuple[str, ...], width: int) -> list[list[float]]:
    """At most width - 1 quantiles of each feature, of values at four significant digits: few distinct ones, so exact counts of them are small and their order is of no matter."""
    coarse = lambda c: F.when(F.col(c).isNotNull() & ~F.isnan(c), F.format_string("%.3e", c).cast("double"))
    found = values.agg(*(F.percentile(coarse(c), [i / width for i in range(1, width)]).alias(c) for c in features)).first()
    return [sorted(set(found[c] or [])) for c in features]


def derivatives(score: np.ndarray, label: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the weighted logistic loss, as whole numbers of 1 / UNIT."""
    p, w = _sigmoid(score), np.where(label == 1, weight, 1.0)
    return np.rint(UNIT * w * (p - label)).astype(np.int64), np.rint(UNIT * w * p * (1 - p)).astype(np.int64)


def best_split(sums: np.ndarray, least: int) -> tuple[float, int, int] | None:
    """(gain, feature, cut) of the best split of a node's histogram (features x bins x (g, h, n)), the first of equals; None without any."""
    low = sums.cumsum(axis=1)[:, :-1]
    high = sums.sum(axis=1, keepdims=True) - low
    g, h = sums[0, :, 0].sum() / UNIT, sums[0, :, 1].sum() / UNIT
    part = lambda x: (x[..., 0] / UNIT) ** 2 / np.maximum(x[..., 1] / UNIT, LEAST_HESSIAN)
    gain = part(low) + part(high) - g * g / max(h, LEAST_HESSIAN)
    fits = (np.minimum(low[..., 2], high[..., 2]) >= least) & (np.minimum(low[..., 1], high[..., 1]) >= LEAST_HESSIAN * UNIT)
    gain = np.where(fits, gain, -np.inf)
    at = int(gain.argmax()) if gain.size else 0
    if not gain.size or gain.flat[at] <= 1e-9:
        return None
    return float(gain.flat[at]), at // gain.shape[1], at % gain.shape[1]


class _Growth:
    """One tree of one model: what is known of its nodes, and which are asked for. Nodes are 2i+1 and 2i+2 below i."""

    def __init__(self, most: int, least: int):
        self.most, self.least = most, least
        self.sums, self.best, self.children, self.open, self.done = {}, {}, set(), {0}, []

    def wanted(self) -> list[int]:
        """Nodes to count next: the root, or the smaller child of each leaf that may still be split; none when the tree is whole."""
        if 0 not in self.sums:
            return [0]
        while len(self.done) < self.most - 1:
            ranked = sorted((i for i in self.open if self.best[i]), key=lambda i: (-self.best[i][0], i))
            if not ranked:
                return []
            if ranked[0] not in self.children:  # as many as splits are left may come, the others never
                new = [i for i in ranked[: self.most - 1 - len(self.done)] if i not in self.children]
                self.children.update(new)
                return [self._smaller(i) for i in new]
            self.open ^= {ranked[0], 2 * ranked[0] + 1, 2 * ranked[0] + 2}
            self.done.append(ranked[0])
        return []

    def _smaller(self, i: int) -> int:
        _, f, c = self.best[i]
        n = self.sums[i][f, :, 2]
        return 2 * i + 1 if 2 * n[: c + 1].sum() <= n.sum() else 2 * i + 2

    def add(self, node: int, sums: np.ndarray) -> None:
        both = [(node, sums)]
        if node:
            up = (node - 1) // 2
            both.append((node + 1 if node % 2 else node - 1, self.sums[up] - sums))
        for i, s in both:
            self.sums[i], self.best[i] = s, best_split(s, self.least)

    def tree(self, splits, step: float = 0.0) -> tuple[Tree, dict[int, int]]:
        """The tree of the given split nodes, with the places of its nodes; without a step its values are 0."""
        splits = set(splits)
        nodes = sorted({0} | {2 * i + k for i in splits for k in (1, 2)})
        at = {node: place for place, node in enumerate(nodes)}
        made = Tree([], [], [], [], [])
        for node in nodes:
            inner = node in splits
            made.feature.append(self.best[node][1] if inner else 0)
            made.cut.append(self.best[node][2] if inner else 0)
            made.left.append(at[2 * node + 1] if inner else -1)
            made.right.append(at[2 * node + 2] if inner else -1)
            g, h, _ = self.sums[node][0].sum(axis=0) if step and not inner else (0, 1, 0)
            made.value.append(-step * float(g) / max(float(h), LEAST_HESSIAN * UNIT))
        return made, at


#: Bins (features x rows), scores (models x rows), labels and folds of some rows.
Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _blocks(rows: DataFrame, wide: int, models: int) -> RDD:
    """The rows (label, fold, bins) as blocks of at most PART, with scores of 0."""
    most = PART

    def pack(batches):
        for own in gathered(batches, most):
            bins = np.frombuffer(b"".join(own.column("bins").to_pylist()), np.uint8).reshape(-1, wide).T
            whole = lambda c: own.column(c).to_numpy().astype(np.int32).tobytes()  # noqa: B023, E731
            yield pa.RecordBatch.from_pydict({"bins": pa.array([bins.tobytes()], pa.binary()), "label": pa.array([whole("label")], pa.binary()), "fold": pa.array([whole("fold")], pa.binary())})

    def unpacked(row) -> Block:
        label, fold = (np.frombuffer(x, np.int32) for x in (row.label, row.fold))
        return np.frombuffer(row.bins, np.uint8).reshape(wide, -1), np.zeros((models, len(label))), label, fold

    return once(rows.mapInArrow(pack, "bins binary, label binary, fold binary")).rdd.map(unpacked)


def _scored(blocks: RDD, recent: list[list[Tree]]) -> RDD:
    """blocks with the recent trees added to their scores."""

    def add(block: Block) -> Block:
        bins, scores, label, fold = block
        return bins, np.stack([_score(trees, scores[m], bins) for m, trees in enumerate(recent)]), label, fold

    return blocks.map(add)


def _score(trees: list[Tree], score: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """score with the values of the trees added."""
    for t in trees:
        value = np.zeros(len(score))
        ends = {i for i, left in enumerate(t.left) if left < 0}
        for node, rows in _members(t, ends, bins, np.ones(len(score), bool)).items():
            value[rows] = t.value[node]
        score = score + value
    return score


def _members(tree: Tree, wanted, bins: np.ndarray, use: np.ndarray) -> dict[int, np.ndarray]:
    """Which of the rows to use (a mask) are in each of the wanted leaves; only paths to these are followed."""
    needed = [i in wanted for i in range(len(tree.left))]
    for i in reversed(range(len(needed))):  # children come behind their parent
        if tree.left[i] >= 0:
            needed[i] = needed[tree.left[i]] or needed[tree.right[i]]
    masks = {0: use}
    for i in range(len(needed)):
        if tree.left[i] < 0 or not needed[i]:
            continue
        own, low = masks.pop(i), bins[tree.feature[i]] <= tree.cut[i]
        if needed[tree.left[i]]:
            masks[tree.left[i]] = own & low
        if needed[tree.right[i]]:
            masks[tree.right[i]] = own > low
    return {i: mask for i, mask in masks.items() if needed[i]}


def _histograms(bins: np.ndarray, score: np.ndarray, label: np.ndarray, weight: float, members: dict[int, np.ndarray], width: int) -> np.ndarray:
    """Histograms (slots x features x bins x 3) of a block's rows in each slot; members: its rows (a mask)."""
    rows = [np.flatnonzero(mask) for mask in members.values()]
    slot = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    rows, wide = np.concatenate(rows), len(bins)
    g, h = derivatives(score[rows], label[rows], weight)
    at = bins.take(rows, axis=1) + (slot * (wide * width) + np.arange(wide)[:, None] * width)
    many = len(members) * wide * width
    every = lambda x: np.broadcast_to(x.astype(float), at.shape).ravel()
    made = [np.bincount(at.ravel(), None if x is None else every(x), many) for x in (g, h, None)]  # sums of a block are below 2**53, so exact
    return np.stack(made, axis=1).astype(np.int64).reshape(len(members), wide, width, 3)


def _sums(blocks: RDD, shape: tuple[int, int], recent: list[list[Tree]], held: list[int | None], weights: list[float], asked: dict[int, tuple[Tree, dict[int, int]]], slots: int, tasks: int):
    """Histograms (slots x features x bins x 3) of the asked nodes, and each model's loss on its held-out fold where its tree is a mere root.

    recent: trees that the scores do not have yet. asked: a model's tree of all nodes known so far and the slot of each of its nodes that is counted.
    """
    wide, width = shape

    def count(own):
        made, loss = np.zeros((slots, wide, width, 3), np.int64), np.zeros(len(recent), np.int64)
        for bins, scores, label, fold in own:
            for m, (tree, places) in asked.items():
                score = _score(recent[m], scores[m], bins)
                out = np.zeros(len(label), bool) if held[m] is None else fold == held[m]
                if len(tree.left) == 1:
                    loss[m] += np.rint(UNIT * np.logaddexp(0, np.where(label[out] == 1, -score[out], score[out]))).astype(np.int64).sum()
                members = _members(tree, places, bins, ~out) if places else {}
                members = {places[i]: mask for i, mask in members.items() if mask.any()}
                if members:
                    made[[*members]] += _histograms(bins, score, label, weights[m], members, width)
        yield -1, loss
        yield from enumerate(made)

    parts = blocks.mapPartitions(count)
    got: dict[int, np.ndarray] = {}
    for slot, x in (parts if tasks <= FEW else parts.reduceByKey(np.add, FEW)).collect():
        got[slot] = got[slot] + x if slot in got else x
    return np.stack([got[s] for s in range(slots)]) if slots else None, got[-1] / UNIT


def grow(rows: DataFrame, features: tuple[str, ...], folds: list[int | None], rounds: int = 500, most: int = 31, least: int = 20, step: float = 0.05, patience: int = 30, width: int = 64) -> list[Model]:
    """A model for each of folds, learned from the rows (features, label 0 or 1, fold) of the other folds; None learns from all.

    Each round adds a tree of up to `most` leaves of at least `least` rows, the leaf of the highest gain split first. Positives weigh as much as
    negatives altogether. A fold's model stops when `patience` rounds in a row did not lower the mean loss on its fold, and keeps the trees up to the
    best round; None's runs through. A model whose rows have one label is that constant, one without rows is 0. Other columns are ignored.
    """
    features = tuple(features)
    counts = rows.groupBy("fold", "label").count().collect()
    number = lambda fold, label: sum(r["count"] for r in counts if (fold is None or r.fold != fold) and r.label == label)
    each = [(number(f, 0), number(f, 1)) for f in folds]
    live = [m for m, (no, yes) in enumerate(each) if no and yes and rounds > 0]
    weights = [no / max(yes, 1) for no, yes in each]
    values = rows.select("label", F.coalesce("fold", F.lit(-1)).cast("int").alias("fold"), *(F.col(c).cast("double").alias(c) for c in features))
    cuts = _cuts(values, features, width) if live else [[] for _ in features]
    models = [Model(features, cuts, constant=None if m in live else float(yes > 0)) for m, (no, yes) in enumerate(each)]
    if not live:
        return models

    def bytes_of(batches):
        for b in batches:
            made = binned(np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in features], axis=1), cuts)
            yield pa.RecordBatch.from_pydict({"label": b.column("label").cast(pa.int32()), "fold": b.column("fold"), "bins": pa.array([x.tobytes() for x in made], pa.binary())})

    n = sum(r["count"] for r in counts)
    tasks = max(min(-(-n // PART), max(8, rows.sparkSession.sparkContext.defaultParallelism)), -(-n // (PART * BLOCKS)))
    kept = _blocks(values.mapInArrow(bytes_of, "label int, fold int, bins binary").repartition(tasks), len(features), len(folds)).persist(StorageLevel.MEMORY_AND_DISK)
    recent, losses, shape, stale = [[] for _ in folds], [[] for _ in folds], (len(features), width), None
    for turn in range(rounds + 1):
        growths, fresh = {m: _Growth(most, least) for m in live}, True
        while growths:
            asked, order = {}, []
            for m, growth in growths.items():
                want = growth.wanted() if turn < rounds else []
                if want or fresh:
                    tree, at = growth.tree(growth.children)
                    asked[m] = (tree, {at[node]: len(order) + k for k, node in enumerate(want)})
                    order += [(m, node) for node in want]
            if not asked:
                break
            sums, loss = _sums(kept, shape, recent, folds, weights, asked, len(order), tasks)
            if stale is not None:
                stale.unpersist()
                stale = None
            if fresh:
                for m in live:
                    losses[m].append(float(loss[m]))
                live, fresh = [m for m in live if folds[m] is None or len(losses[m]) - 1 - int(np.argmin(losses[m])) < patience], False
                growths = {m: growths[m] for m in live}
            for (m, node), s in zip(order, sums if order else ()):
                if m in growths:
                    growths[m].add(node, s)
            if turn == rounds:
                break
        if turn == rounds:
            break
        for m, growth in growths.items():
            if growth.done:
                tree, _ = growth.tree(growth.done, step)
                models[m].trees.append(tree)
                recent[m].append(tree)
        live = [m for m in live if growths[m].done]
        if not live:
            break
        # a round's many passes read scores with all trees so far; they are held by the executors, and written now and then, as holding alone would lengthen the lineage
        kept, recent, stale = _scored(kept, recent).persist(StorageLevel.MEMORY_AND_DISK), [[] for _ in folds], kept
        if turn % KEEP == KEEP - 1:
            kept.checkpoint()
    for held in (kept, stale):
        if held is not None:
            held.unpersist()
    for m, fold in enumerate(folds):
        if fold is not None and losses[m]:
            del models[m].trees[int(np.argmin(losses[m])) :]
    return models
