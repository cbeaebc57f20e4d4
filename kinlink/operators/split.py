"""Deterministic splits by a hash of the entity's id that other engines share (md5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .blocking import S1


def rank_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.col(key), F.lit(str(seed))))


def entity_split(source1: DataFrame, truth: DataFrame, val_fraction: float = 0.2, seed: int = 42, buckets: int = 256) -> DataFrame:
    """(entity_id, has_match, is_val): ceil(fraction * n) of each class for validation, of all together if a class has under two.

    Ranks come from sorted buckets of the hash and the buckets' running counts, so no task sorts a whole class.
    """
    matched = truth.select(F.col(S1).alias("entity_id")).distinct().withColumn("m", F.lit(True))
    own = source1.select("entity_id").join(matched, "entity_id", "left").select("entity_id", F.coalesce("m", F.lit(False)).alias("has_match"), rank_hash("entity_id", seed).alias("h"))
    counts = own.groupBy("has_match").count()
    smallest = counts.agg(F.min("count").alias("low"), F.count("*").alias("classes"))
    own = own.crossJoin(F.broadcast(smallest)).withColumn("stratum", F.when((F.col("classes") > 1) & (F.col("low") >= 2), F.col("has_match").cast("int")).otherwise(-1))
    own = own.withColumn("bucket", (F.conv(F.substring("h", 1, 4), 16, 10).cast("int") * buckets / 65536).cast("int"))
    sizes = own.groupBy("stratum", "bucket").agg(F.count("*").alias("n"))
    running = W.partitionBy("stratum").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("stratum", "bucket", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before"), F.sum("n").over(W.partitionBy("stratum")).alias("all"))
    ranked = own.withColumn("rank", F.row_number().over(W.partitionBy("stratum", "bucket").orderBy("h", "entity_id"))).join(F.broadcast(sizes), ["stratum", "bucket"])
    return ranked.select("entity_id", "has_match", (F.col("rank") + F.col("before") <= F.ceil(F.col("all") * val_fraction)).alias("is_val"))


def group_folds(pairs: DataFrame, folds: int = 5, key: str = S1) -> DataFrame:
    """pairs with a fold for each group, so that no group is in two folds: at most `folds`, at least two, no more than groups."""
    many = pairs.agg(F.greatest(F.lit(2), F.least(F.lit(folds), F.count_distinct(key))).alias("_folds"))
    number = F.conv(F.substring(F.md5(F.col(key)), 1, 8), 16, 10).cast("long")
    return pairs.crossJoin(F.broadcast(many)).withColumn("fold", F.pmod(number, F.col("_folds")).cast("int")).drop("_folds")


def stratified_folds(rows: DataFrame, keys: list[str], label: str = "label", folds: int = 5, seed: int = 42, buckets: int = 256) -> DataFrame:
    """rows with a fold, each class dealt evenly over the folds by a hash of the keys: for rows without groups to keep together.

    There are no more folds than rows of the smaller class, but two at least, and two if there is one class only.
    Ranks come from sorted buckets of the hash and the buckets' running counts, as in entity_split.
    """
    own = rows.withColumn("_h", F.md5(F.concat_ws("|", *(F.col(k).cast("string") for k in keys), F.lit(str(seed)))))
    own = own.withColumn("_bucket", (F.conv(F.substring("_h", 1, 4), 16, 10).cast("int") * buckets / 65536).cast("int"))
    sizes = own.groupBy(label, "_bucket").agg(F.count("*").alias("_n"))
    per = sizes.groupBy(label).agg(F.sum("_n").alias("_n"))
    many = per.agg(F.when(F.count("*") > 1, F.greatest(F.lit(2), F.least(F.lit(folds), F.min("_n")))).otherwise(2).alias("_many"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(label).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(label, "_bucket", before.alias("_before"))
    ranked = own.withColumn("_rank", F.row_number().over(W.partitionBy(label, "_bucket").orderBy("_h", *keys))).join(F.broadcast(sizes), [label, "_bucket"]).crossJoin(F.broadcast(many))
    return ranked.withColumn("fold", F.pmod(F.col("_rank") + F.col("_before") - 1, F.col("_many")).cast("int")).select(*rows.columns, "fold")


def sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows, those of the smallest hash."""
    return df.orderBy(rank_hash(key, seed), key).limit(n)
