"""Boosting by leaves against a plain version that grows one leaf at a time from lists of rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinlink.operators import boosting, matcher, split
from kinlink.operators.blocking import CAND, S1
from kinlink.operators.features import FEATURES

NAMES = ("a", "b", "c", "d")


def _rows(n, seed=5):
    r = np.random.default_rng(seed)
    x = r.random((n, 4)).round(2)
    x[r.random((n, 4)) < 0.03] = np.nan
    p = 1 / (1 + np.exp(-(6 * np.nan_to_num(x[:, 0]) * np.nan_to_num(x[:, 1]) - 3 + (np.nan_to_num(x[:, 2]) > 0.8))))
    return x, (r.random(n) < p).astype(int), np.arange(n) % 3


def _frame(spark, x, y, fold):
    rows = [(*(None if np.isnan(v) else float(v) for v in a), int(b), int(c)) for a, b, c in zip(x, y, fold)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in NAMES) + ", label int, fold int")


def _plain(bins, y, rounds, most, least, step):
    """Scores of a single model after each round."""
    weight, score, after = (y == 0).sum() / (y == 1).sum(), np.zeros(len(y)), []
    for _ in range(rounds):
        g, h = boosting.derivatives(score, y, weight)
        open_, count = {0: np.arange(len(y))}, 1
        while count < most:
            options = []
            for node, rows in open_.items():
                for f in range(bins.shape[1]):
                    for cut in range(bins[:, f].max()):
                        go = bins[rows, f] <= cut
                        low, high = rows[go], rows[~go]
                        if min(len(low), len(high)) < least:
                            continue
                        part = lambda i: (g[i].sum() / boosting.UNIT) ** 2 / (h[i].sum() / boosting.UNIT)
                        gain = part(low) + part(high) - part(rows)
                        if gain > 1e-9:
                            options.append((-gain, node, f, cut))
            if not options:
                break
            _, node, f, cut = min(options)
            rows = open_.pop(node)
            go = bins[rows, f] <= cut
            open_[2 * node + 1], open_[2 * node + 2], count = rows[go], rows[~go], count + 1
        for rows in open_.values():
            score[rows] -= step * g[rows].sum() / h[rows].sum()
        after.append(score.copy())
    return after


def test_equal_to_plain(spark, monkeypatch):
    monkeypatch.setattr(boosting, "PART", 300)
    monkeypatch.setattr(boosting, "KEEP", 2)
    x, y, fold = _rows(2000)
    df = _frame(spark, x, y, fold)
    got = boosting.grow(df, NAMES, [0, 1, 2, None], rounds=3, most=6, width=8)
    for model, held in zip(got, (0, 1, 2, None)):
        bins = boosting.binned(x, model.cuts)
        use = np.ones(len(y), bool) if held is None else fold != held
        want = _plain(bins[use], y[use], 3, 6, 20, 0.05)[-1]
        have = sum(np.array(t.value)[boosting.leaves(t, bins)] for t in model.trees)[use]
        assert len(model.trees) == 3 and np.allclose(want, have, atol=1e-12)
        assert all(sum(i < 0 for i in t.left) <= 6 for t in model.trees)
    alone = boosting.grow(df.repartition(3), NAMES, [1], rounds=3, most=6, width=8)[0]
    assert alone.trees == got[1].trees  # grown alone, other partitions: the same trees


def test_stops_early_and_keeps_the_best_round(spark):
    x, y, fold = _rows(600)
    noise = np.random.default_rng(1).integers(0, 2, 600)
    models = boosting.grow(_frame(spark, x, noise, fold), NAMES, [0, None], rounds=12, patience=2, step=0.5)
    assert len(models[0].trees) < 10 and len(models[1].trees) == 12


def test_probability_and_round_trip(spark, tmp_path):
    x, y, fold = _rows(400)
    df = _frame(spark, x, y, fold)
    model = boosting.grow(df, NAMES, [None], rounds=3)[0]
    model.save(spark, f"{tmp_path}/m")
    assert boosting.load(spark, f"{tmp_path}/m") == model
    got = df.withColumn("p", model.probability()).agg(F.avg(F.when(F.col("label") == 1, F.col("p"))).alias("yes"), F.avg(F.when(F.col("label") == 0, F.col("p"))).alias("no")).first()
    assert got.yes > got.no + 0.05


def test_one_label_empty_and_constant_features(spark):
    schema = ", ".join(f"{c} double" for c in NAMES) + ", label int, fold int"
    none = spark.createDataFrame([], schema)
    assert [m.constant for m in boosting.grow(none, NAMES, [0, None])] == [0.0, 0.0]
    ones = spark.createDataFrame([(0.5, 0.5, None, 0.5, 1, i % 2) for i in range(50)], schema)
    assert [m.constant for m in boosting.grow(ones, NAMES, [0, None])] == [1.0, 1.0]
    flat = spark.createDataFrame([(0.5, 0.5, None, 0.5, i % 2, 0) for i in range(80)], schema)
    model = boosting.grow(flat, NAMES, [None], rounds=5)[0]
    assert model.trees == [] and {r.p for r in flat.select(model.probability().alias("p")).collect()} == {0.5}


def test_stratified_folds_of_a_small_class(spark):
    rows = spark.createDataFrame([(f"S1-{i}", f"c{i}", int(i < 3)) for i in range(40)], f"{S1} string, {CAND} string, label int")
    assert split.stratified_folds(rows, [S1, CAND], folds=5).select("fold").distinct().count() == 3
    assert split.stratified_folds(rows.filter("label = 0"), [S1, CAND], folds=5).select("fold").distinct().count() == 2


def test_fit_equals_single_growths(spark):
    r = np.random.default_rng(3)
    x = r.random((300, len(FEATURES))).round(3)
    rows = [(f"S1-{i // 5}", f"S2-{i}", int(a[0] + a[1] > 1.2), *map(float, a)) for i, a in enumerate(x)]
    df = spark.createDataFrame(rows, f"{S1} string, {CAND} string, label int, " + ", ".join(f"{f} double" for f in FEATURES))
    model, scored = matcher.fit(df, folds=3, rounds=3)
    assert model == matcher.train(df, rounds=3)
    single = {(x[S1], x[CAND]): x.match_probability for x in matcher.out_of_fold(df, folds=3, rounds=3).collect()}
    together = {(x[S1], x[CAND]): x.match_probability for x in scored.collect()}
    assert together == pytest.approx(single) and len(single) == 300


def test_passes_score_no_tree_again(spark, monkeypatch):
    """A round has many passes; none of them walks the trees of earlier rounds, as the rows' scores have those already."""
    walked, sums = [], boosting._sums

    def counted(rows, shape, recent, *more):
        walked.append(max(map(len, recent)))
        return sums(rows, shape, recent, *more)

    monkeypatch.setattr(boosting, "_sums", counted)
    rows = spark.range(200).select((F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 17 > F.col("id") % 5 + 5).cast("int").alias("label"), F.lit(0).alias("fold"))
    assert len(boosting.grow(rows, ("x",), [None], 3)[0].trees) == 3
    assert set(walked) == {0}


def test_passes_read_blocks_of_rows(spark, monkeypatch):
    """A pass reads a few blocks, not a record for each row; the sums of many tasks are added in a shuffle, to the same trees."""
    monkeypatch.setattr(boosting, "PART", 100)
    x, y, fold = _rows(1000)
    df, seen, sums = _frame(spark, x, y, fold), [], boosting._sums

    def counted(rows, *more):
        seen.append(rows.count())
        return sums(rows, *more)

    few = boosting.grow(df, NAMES, [0, None], rounds=2, most=6, width=8)
    monkeypatch.setattr(boosting, "_sums", counted)
    monkeypatch.setattr(boosting, "FEW", 1)
    many = boosting.grow(df, NAMES, [0, None], rounds=2, most=6, width=8)
    assert seen and max(seen) <= 20
    assert [m.trees for m in few] == [m.trees for m in many]


def test_members_follow_the_paths_asked_for():
    tree = boosting.Tree([0, 1, 0, 0, 0], [3, 2, 0, 0, 0], [1, 3, -1, -1, -1], [2, 4, -1, -1, -1], [0.0] * 5)
    bins = np.random.default_rng(2).integers(0, 8, (2, 500)).astype(np.uint8)
    use = np.arange(500) % 3 > 0
    ends = boosting.leaves(tree, bins.T)
    for wanted in ({2}, {3}, {3, 4}, {2, 3, 4}, set()):
        got = boosting._members(tree, wanted, bins, use)
        assert set(got) == wanted and all((got[i] == (use & (ends == i))).all() for i in wanted)
