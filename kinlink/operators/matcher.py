"""Labels, the pair classifier and its use."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boosting
from .blocking import CAND, S1
from .classes import Classes
from .features import FEATURES
from .split import group_folds, stratified_folds


def labelled(pairs: DataFrame, truth: DataFrame | Classes) -> DataFrame:
    """pairs with label 1 for those in truth, else 0."""
    if isinstance(truth, Classes):
        return truth.hits(pairs)
    return pairs.join(truth.select(S1, CAND).distinct().withColumn("label", F.lit(1)), [S1, CAND], "left").withColumn("label", F.coalesce("label", F.lit(0)))


def missed_positives(pairs: DataFrame, truth: DataFrame | Classes, ids: DataFrame) -> DataFrame:
    """True pairs of the given entities that blocking lost."""
    if isinstance(truth, Classes):
        return truth.missed(pairs, ids)
    own = truth.select(S1, CAND).distinct().join(ids.select(F.col("entity_id").alias(S1)), S1, "left_semi")
    return own.join(pairs.select(S1, CAND), [S1, CAND], "left_anti")


def blocking_recall(pairs: DataFrame, truth: DataFrame | Classes, ids: DataFrame) -> DataFrame:
    """One row: total and missed true pairs and the share found (null without true pairs)."""
    given = ids.select(F.col("entity_id").alias(S1))
    if isinstance(truth, Classes):
        total = truth.totals().join(given, S1, "left_semi").agg(F.coalesce(F.sum("t"), F.lit(0)).alias("total"))
        found = truth.hits(pairs.select(S1, CAND).distinct().join(given, S1, "left_semi")).agg(F.coalesce(F.sum("label"), F.lit(0)).alias("found"))
        sums = total.crossJoin(found).select("total", (F.col("total") - F.col("found")).alias("missed"))
    else:
        own = truth.select(S1, CAND).distinct().join(given, S1, "left_semi")
        found = own.join(pairs.select(S1, CAND).distinct().withColumn("found", F.lit(1)), [S1, CAND], "left")
        sums = found.agg(F.count("*").alias("total"), (F.count("*") - F.count("found")).alias("missed"))
    return sums.select("total", "missed", (1 - F.try_divide("missed", "total")).alias("recall"))


def train(features: DataFrame, rounds: int = 50, seed: int = 42) -> boosting.Model:
    """A gradient-boosted classifier of rows with FEATURES and label; there must be rows of both labels. Nothing is drawn, so the seed changes nothing."""
    return fit(features, 0, rounds, seed)[0]


def fit(features: DataFrame, folds: int = 5, rounds: int = 50, seed: int = 42, groups: str | None = S1) -> tuple[boosting.Model, DataFrame]:
    """The classifier of all rows and the out-of-fold scores (see out_of_fold), grown together; without folds there are no scores."""
    classes = sorted(r.label for r in features.select("label").distinct().collect())
    if classes != [0, 1]:
        raise ValueError(f"training needs pairs of both labels; there are pairs of {classes or 'none'}")
    if not folds:
        return boosting.grow(features.withColumn("fold", F.lit(-1)), FEATURES, [None], rounds)[0], None
    dealt, numbers = _dealt(features, folds, seed, groups)
    models = boosting.grow(dealt, FEATURES, [None, *numbers], rounds)
    return models[0], _by_fold(dealt, numbers, models[1:])


def score(model: boosting.Model, features: DataFrame) -> DataFrame:
    """features with match_probability."""
    return features.withColumn("match_probability", model.probability())


def _dealt(features: DataFrame, folds: int, seed: int, groups: str | None) -> tuple[DataFrame, list[int]]:
    dealt = group_folds(features, folds, groups) if groups else stratified_folds(features, [S1, CAND], "label", folds, seed)
    return dealt, sorted(r.fold for r in dealt.select("fold").distinct().collect())


def _by_fold(dealt: DataFrame, numbers: list[int], models: list[boosting.Model]) -> DataFrame:
    out = dealt.withColumn("match_probability", F.lit(0.0)).limit(0)
    for fold, model in zip(numbers, models):
        out = out.unionByName(score(model, dealt.filter(F.col("fold") == fold)))
    return out


def out_of_fold(features: DataFrame, folds: int = 5, rounds: int = 50, seed: int = 42, groups: str | None = S1) -> DataFrame:
    """features with fold and the match_probability of a model that saw none of the fold's groups (entities), all models grown together.

    A model stops early by the loss on its own fold. Without groups the folds are stratified by label. Where all other folds have one label, that is the probability; no rows give none.
    """
    dealt, numbers = _dealt(features, folds, seed, groups)
    return _by_fold(dealt, numbers, boosting.grow(dealt, FEATURES, numbers, rounds))


def fold_metrics(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """accuracy, precision, recall, f1 and f0_5 of each fold; ratios without a denominator are 0."""
    hit = F.col("match_probability") >= threshold
    one = F.col("label") == 1
    sums = scored.groupBy("fold").agg(F.count("*").alias("n"), F.count_if(hit & one).alias("tp"), F.count_if(hit).alias("p"), F.count_if(one).alias("t"), F.count_if(hit == one).alias("right"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    sums = sums.withColumns({"precision": ratio(F.col("tp"), F.col("p")), "recall": ratio(F.col("tp"), F.col("t"))})
    p, r = F.col("precision"), F.col("recall")
    return sums.select("fold", (F.col("right") / F.col("n")).alias("accuracy"), "precision", "recall", ratio(2 * p * r, p + r).alias("f1"), ratio(1.25 * p * r, 0.25 * p + r).alias("f0_5"))


def decide(scored: DataFrame, threshold: float) -> DataFrame:
    """(S1, CAND) of pairs at or above the threshold."""
    return scored.filter(F.col("match_probability") >= threshold).select(S1, CAND)


def save(path: str, model: boosting.Model, idf: dict[str, DataFrame], config: dict) -> None:
    """The model, both vectorizers and the configuration, all through Spark's writers."""
    model.save(idf["name"].sparkSession, f"{path}/model")
    for field, table in idf.items():
        table.write.mode("overwrite").parquet(f"{path}/{field}_vectorizer")
    idf["name"].sparkSession.createDataFrame([(json.dumps(config),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/config")


def load(spark: SparkSession, path: str) -> tuple[boosting.Model, dict[str, DataFrame], dict]:
    idf = {field: spark.read.parquet(f"{path}/{field}_vectorizer") for field in ("name", "addr")}
    return boosting.load(spark, f"{path}/model"), idf, json.loads(spark.read.text(f"{path}/config").first()[0])
