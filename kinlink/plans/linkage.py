"""Training and prediction from files to files."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.encoding import hashed_encoder
from ..functions.text import normalize
from ..operators import blocking, features, matcher, metrics, split, validate
from ..sources import tables

RECALL_GATE = 0.85
#: Encoders by name; each makes a function from a text column to a vector column. The first needs no model file.
ENCODERS = {"hashed-char-ngrams": hashed_encoder}


def load_sources(spark: SparkSession, folder: str, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three record tables; the pool's two with each row's place in its files."""
    return tuple(tables.read_records(spark, f"{folder}/{name}_source{i}.tsv", position=i > 1) for i in (1, 2, 3))


def normalized(source1: DataFrame, source2: DataFrame, source3: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Queries and pool, normalised once and kept; the pool is S2 before S3, each in order of its rows (column pos) or else of id."""
    place = lambda df: F.lpad(F.col("pos").cast("string"), 19, "0") if "pos" in df.columns else F.col("entity_id")
    placed = lambda df, first: df.withColumn("pos", F.concat(F.lit(first), place(df)))
    pool = placed(source2, "2").unionByName(placed(source3, "3"))
    return normalize(source1).persist(), normalize(pool).persist()


def _blocked(source1: DataFrame, pool: DataFrame, config: dict, encoder) -> DataFrame:
    knn = None
    if encoder is not None:
        encoded = lambda df: df.withColumn("embedding", encoder(F.concat_ws(" [SEP] ", "name_norm", "addr_norm")))
        knn = blocking.knn_candidates(encoded(source1), encoded(pool), config["embedding_top_k"])
    return blocking.candidates(source1, pool, knn, config["max_token_doc_freq"], config["max_postal_bucket_size"], config["max_candidates_per_token_query"], config["max_candidates_per_entity"])


def _config(**given) -> dict:
    base = {"max_candidates_per_entity": 30, "max_token_doc_freq": None, "max_postal_bucket_size": None, "max_candidates_per_token_query": 200, "embedding_top_k": 15, "val_fraction": 0.2, "seed": 42, "rounds": 50, "folds": 5, "embedding_model_name": next(iter(ENCODERS))}
    return base | given


def train(spark: SparkSession, source1: DataFrame, source2: DataFrame, source3: DataFrame, truth: DataFrame, encoder=None, **given):
    """(model, idf, config) from records and truth pairs; config holds the tuned threshold and the measures.

    encoder maps a text column to a vector column (array<float>); without one there is no neighbour search. cv_metrics are the means over
    folds of entities, each scored by a model of the others. Without candidates of both labels this raises.
    """
    config = _config(**given)
    queries, pool = normalized(source1, source2, source3)
    parts = split.entity_split(source1, truth, config["val_fraction"], config["seed"]).persist()
    side = lambda val: queries.join(parts.filter(F.col("is_val") == val).select("entity_id"), "entity_id", "left_semi")
    learn, val = side(False), side(True)
    pairs = _blocked(learn, pool, config, encoder).persist()
    recall = matcher.blocking_recall(pairs, truth, learn).first().recall
    if recall is not None and recall < RECALL_GATE:
        print(f"warning: blocking finds {recall:.3f} of the true pairs, under {RECALL_GATE}")
    idf = {k: v.persist() for k, v in features.fit_vectorizers(learn, pool).items()}
    rows = matcher.labelled(features.pair_features(learn, pool, pairs, idf), truth).persist()
    model, own_scores = matcher.fit(rows, config["folds"], config["rounds"], config["seed"])
    measures = matcher.fold_metrics(own_scores).drop("fold")
    scored = matcher.score(model, features.pair_features(val, pool, _blocked(val, pool, config, encoder), idf)).persist()
    best = metrics.best_threshold(metrics.threshold_sweep(scored, truth, val)).first()
    own = truth.join(val.select(F.col("entity_id").alias(blocking.S1)), blocking.S1, "left_semi")
    config |= {
        "threshold": best.threshold,
        "use_embeddings": encoder is not None,
        "cv_metrics": measures.agg(*(F.avg(c).alias(c) for c in measures.columns)).first().asDict(),
        "blocking_recall_train_split": recall,
        "validation_summary": metrics.summary(matcher.decide(scored, best.threshold), own, val).first().asDict(),
    }
    return model, idf, config


def predict(spark: SparkSession, source1: DataFrame, source2: DataFrame, source3: DataFrame, model, idf, config: dict, threshold: float | None = None, encoder=None):
    """(candidates, matches) as long tables."""
    config = _config(**config)
    queries, pool = normalized(source1, source2, source3)
    pairs = _blocked(queries, pool, config, encoder).persist()
    scored = matcher.score(model, features.pair_features(queries, pool, pairs, idf))
    return pairs, matcher.decide(scored, config["threshold"] if threshold is None else threshold)


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="python -m kinlink.plans.linkage")
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("train", "predict", "validate"):
        p = sub.add_parser(name)
        p.add_argument("--data-dir", required=True)
        if name != "validate":
            p.add_argument("--artifacts-dir", default="artifacts")
        if name != "validate":
            p.add_argument("--no-embeddings", action="store_true")
            p.add_argument("--embedding-model", choices=[*ENCODERS])
        if name == "train":
            p.add_argument("--val-fraction", type=float, default=0.2)
            p.add_argument("--rounds", type=int, default=50)
            p.add_argument("--folds", type=int, default=5)
        if name != "validate":
            for flag in ("--max-candidates", "--max-token-doc-freq", "--max-postal-bucket-size", "--max-candidates-per-token-query"):
                p.add_argument(flag, type=int)
        if name == "predict":
            p.add_argument("--output-dir", default="output")
            p.add_argument("--threshold", type=float)
        if name == "validate":
            p.add_argument("--matching", required=True)
            p.add_argument("--candidate", required=True)
    a = parser.parse_args(args)
    spark = SparkSession.builder.appName("linkage").getOrCreate()
    if a.command == "validate":
        own = [tables.read_ids(spark, f"{a.data_dir}/test_source{i}.tsv") for i in (1, 2, 3)]
        checks = validate.report(tables.read_output(spark, a.matching), tables.read_output(spark, a.candidate), *own)
        checks.show(50, False)
        return 0 if validate.valid(checks) else 1
    name = a.embedding_model or next(iter(ENCODERS))
    limits = {"max_candidates_per_entity": a.max_candidates, "max_token_doc_freq": a.max_token_doc_freq, "max_postal_bucket_size": a.max_postal_bucket_size, "max_candidates_per_token_query": a.max_candidates_per_token_query}
    limits = {k: v for k, v in limits.items() if v is not None}
    if a.command == "train":
        truth = tables.truth_pairs(tables.read_truth(spark, f"{a.data_dir}/train_ground_truth.tsv"))
        model, idf, config = train(spark, *load_sources(spark, a.data_dir, "train"), truth, None if a.no_embeddings else ENCODERS[name](), val_fraction=a.val_fraction, rounds=a.rounds, folds=a.folds, embedding_model_name=name, **limits)
        matcher.save(a.artifacts_dir, model, idf, config)
        return 0
    model, idf, config = matcher.load(spark, a.artifacts_dir)
    sources = load_sources(spark, a.data_dir, "test")
    encoder = ENCODERS[a.embedding_model or config["embedding_model_name"]]() if config["use_embeddings"] and not a.no_embeddings else None
    pairs, matches = predict(spark, *sources, model, idf, config | limits, a.threshold, encoder)
    tables.write_id_lists(sources[0], pairs, "candidate_entity_ids", f"{a.output_dir}/candidate_pairs.tsv")
    tables.write_id_lists(sources[0], matches, "matched_entity_ids", f"{a.output_dir}/matching_results.tsv")
    written = (tables.read_output(spark, f"{a.output_dir}/{x}.tsv") for x in ("matching_results", "candidate_pairs"))
    if outside := validate.subset_violations(*written).count():
        print(f"warning: {outside} entities have matches that are no candidates")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
