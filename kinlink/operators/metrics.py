"""Entity-level F-beta, its micro companions, and the threshold sweep.

Predictions are a long table (S1, CAND); so is the truth, or it is given by Classes, and then no true pair is made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.lineage import once
from .blocking import CAND, S1
from .classes import Classes

THRESHOLDS = tuple(round(0.30 + 0.02 * i, 2) for i in range(33))


def f_beta(tp: Column, predicted: Column, truth: Column, beta: float = 0.5) -> Column:
    """Without truth 1 for an empty prediction, else 0; 0 without a hit."""
    precision, recall, b = tp / predicted, tp / truth, beta * beta
    score = (1 + b) * precision * recall / (b * precision + recall)
    return F.when(truth == 0, F.when(predicted == 0, 1.0).otherwise(0.0)).when(tp == 0, 0.0).otherwise(score)


def mean(x: Column) -> Column:
    """The mean of values from 0 to 1, null without any. Sums of decimals are exact, so it depends on no order of the rows."""
    return F.try_divide(F.sum(x.cast("decimal(28,20)")).cast("double"), F.count(x))


def entity_counts(predictions: DataFrame, truth: DataFrame | Classes, ids: DataFrame) -> DataFrame:
    """(S1, tp, predicted, truth) for every id of ids (entity_id); pairs of other ids are left out, repeated pairs count once."""
    if isinstance(truth, Classes):
        found = truth.hits(predictions.select(S1, CAND).distinct()).groupBy(S1).agg(F.sum("label").alias("tp"), F.count("*").alias("predicted"))
        counts = found.join(truth.totals().withColumnRenamed("t", "truth"), S1, "full")
        return ids.select(F.col("entity_id").alias(S1)).distinct().join(counts, S1, "left").na.fill(0, ["tp", "predicted", "truth"])
    marked = predictions.select(S1, CAND, F.lit(1).alias("p"), F.lit(0).alias("t")).unionByName(truth.select(S1, CAND, F.lit(0).alias("p"), F.lit(1).alias("t")))
    pairs = marked.groupBy(S1, CAND).agg(F.max("p").alias("p"), F.max("t").alias("t"))
    counts = pairs.groupBy(S1).agg(F.sum(F.col("p") * F.col("t")).alias("tp"), F.sum("p").alias("predicted"), F.sum("t").alias("truth"))
    return ids.select(F.col("entity_id").alias(S1)).distinct().join(counts, S1, "left").na.fill(0, ["tp", "predicted", "truth"])


def entity_scores(predictions: DataFrame, truth: DataFrame | Classes, ids: DataFrame, beta: float = 0.5) -> DataFrame:
    return entity_counts(predictions, truth, ids).withColumn("f_beta", f_beta(F.col("tp"), F.col("predicted"), F.col("truth"), beta))


def entity_report(predictions: DataFrame, truth: DataFrame | Classes, ids: DataFrame, beta: float = 0.5) -> DataFrame:
    """entity_scores with the sorted ids on both sides; of Classes the true ones are joined by commas, once for each class. Predictions are computed once, for scores and lists."""
    predictions = once(predictions.select(S1, CAND))
    lists = lambda pairs, name: pairs.groupBy(S1).agg(F.sort_array(F.collect_set(CAND)).alias(name))
    out = entity_scores(predictions, truth, ids, beta).select(S1, "f_beta")
    out, none = out.join(lists(predictions, "predicted"), S1, "left"), F.array().cast("array<string>")
    if isinstance(truth, Classes):
        return truth.with_lists(out, "truth").select(S1, F.coalesce("predicted", none).alias("predicted"), "truth", "f_beta")
    out = out.join(lists(truth, "truth"), S1, "left")
    return out.select(S1, F.coalesce("predicted", none).alias("predicted"), F.coalesce("truth", none).alias("truth"), "f_beta")


def macro_f_beta(predictions: DataFrame, truth: DataFrame | Classes, ids: DataFrame, beta: float = 0.5) -> DataFrame:
    """One row: the mean over all ids, 0 without ids."""
    return entity_scores(predictions, truth, ids, beta).agg(F.coalesce(mean(F.col("f_beta")), F.lit(0.0)).alias("macro_f_beta"))


def summary(predictions: DataFrame, truth: DataFrame | Classes, ids: DataFrame) -> DataFrame:
    """One row of pooled and per-entity measures; a ratio without a denominator is 0, the last two are null then."""
    own = entity_scores(predictions, truth, ids)
    right = (F.col("tp") == F.col("predicted")) & (F.col("tp") == F.col("truth"))
    sums = own.agg(
        F.sum("tp").alias("tp"), F.sum("predicted").alias("p"), F.sum("truth").alias("t"), mean(F.col("f_beta")).alias("macro"), F.count("*").alias("n"),
        F.count_if(F.col("truth") == 0).alias("single"), F.count_if((F.col("truth") == 0) & (F.col("predicted") == 0)).alias("single_right"), F.count_if(right).alias("exact"),
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    sums = sums.withColumns({"micro_precision": ratio(F.col("tp"), F.col("p")), "micro_recall": ratio(F.col("tp"), F.col("t"))})
    p, r = F.col("micro_precision"), F.col("micro_recall")
    return sums.select("micro_precision", "micro_recall", ratio(2 * p * r, p + r).alias("micro_f1"), ratio(1.25 * p * r, 0.25 * p + r).alias("micro_f0_5"), F.coalesce("macro", F.lit(0.0)).alias("macro_f0_5"), F.try_divide("single_right", "single").alias("singleton_accuracy"), F.try_divide("exact", "n").alias("exact_match_entity_rate"))


def threshold_sweep(scored: DataFrame, truth: DataFrame | Classes, ids: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS, score: str = "match_probability", beta: float = 0.5) -> DataFrame:
    """(threshold, macro_f0_5) for every threshold in one pass.

    Each pair is placed at the highest threshold it meets; an entity's counts at all thresholds are one row, and so are the means.
    """
    grid = F.array(*map(F.lit, thresholds))
    level = F.size(F.filter(grid, lambda t: F.col(score) >= t))
    entities = ids.select(F.col("entity_id").alias(S1)).distinct()
    best = scored.groupBy(S1, CAND).agg(F.max(score).alias(score)).withColumn("level", level).filter("level > 0")
    if isinstance(truth, Classes):
        placed, totals = truth.hits(best, "hit"), truth.totals()
    else:
        true = truth.select(S1, CAND).distinct()
        placed, totals = best.join(true.withColumn("hit", F.lit(1)), [S1, CAND], "left"), true.groupBy(S1).agg(F.count("*").alias("t"))
    steps = range(1, len(thresholds) + 1)
    at = lambda i: F.col("level") >= i
    counts = placed.groupBy(S1).agg(*(F.count_if(at(i)).alias(f"p{i}") for i in steps), *(F.count_if(at(i) & (F.col("hit") == 1)).alias(f"h{i}") for i in steps))
    rows = entities.join(totals, S1, "left").join(counts, S1, "left").na.fill(0)
    means = rows.agg(*(mean(f_beta(F.col(f"h{i}"), F.col(f"p{i}"), F.col("t"), beta)).alias(f"f{i}") for i in steps))
    each = F.explode(F.array(*(F.struct(F.lit(t).alias("threshold"), F.col(f"f{i}").alias("macro_f0_5")) for i, t in zip(steps, thresholds, strict=True))))
    return means.select(each.alias("x")).select("x.*").filter("macro_f0_5 is not null")


def best_threshold(sweep: DataFrame) -> DataFrame:
    """One row: the lowest threshold with the highest score."""
    best = F.max(F.struct("macro_f0_5", (-F.col("threshold")).alias("minus"))).alias("b")
    return sweep.agg(best).select((-F.col("b.minus")).alias("threshold"), F.col("b.macro_f0_5").alias("macro_f0_5"))
