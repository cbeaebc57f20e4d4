"""The seventeen pair features."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import batch, tfidf
from .blocking import CAND, S1

# The order of the features.
FEATURES = (
    "name_levenshtein_ratio", "name_jaro_winkler", "name_token_sort_ratio", "name_token_set_ratio", "name_jaccard_tokens", "name_tfidf_cosine",
    "addr_levenshtein_ratio", "addr_jaro_winkler", "addr_token_sort_ratio", "addr_jaccard_tokens", "addr_tfidf_cosine",
    "postal_code_match", "postal_code_both_present", "country_match", "name_len_diff_ratio", "addr_len_diff_ratio", "embedding_cosine_sim",
)
#: Query records of a grid's row, and its columns.
BLOCK, COLUMNS = 4000, 4
_FIELDS = ("name_norm", "addr_norm", "name_core_tokens", "postal_code", "country")
_RATIOS = {"levenshtein_ratio": batch.indel_ratios, "jaro_winkler": batch.jaro_winklers, "token_sort_ratio": batch.token_sort_ratios, "token_set_ratio": batch.token_set_ratios}


def _both(*records: DataFrame) -> DataFrame:
    every = records[0].select("name_norm", "addr_norm")
    for r in records[1:]:
        every = every.unionByName(r.select("name_norm", "addr_norm"))
    return every


def fit_vectorizers(*records: DataFrame, low: int = 2, high: int = 4) -> dict[str, DataFrame]:
    """n-gram weights of names and addresses over all given normalised records."""
    every = _both(*records)
    return {"name": tfidf.fit(every, "name_norm", low, high), "addr": tfidf.fit(every, "addr_norm", low, high)}


def _fields(wanted: Sequence[str]) -> list[str]:
    """The fields of a record that the features need."""
    of = {"name_jaccard_tokens": "name_core_tokens", "postal_code_match": "postal_code", "postal_code_both_present": "postal_code", "country_match": "country", "embedding_cosine_sim": None}
    need = {of.get(f, f"{f.partition('_')[0]}_norm") for f in wanted}
    return [c for c in _FIELDS if c in need]


def _side(records: DataFrame, key: str, idf: dict[str, DataFrame], fields: Sequence[str]) -> DataFrame:
    own = records.select(F.col("entity_id").alias(key), *fields)
    for field in idf:
        own = own.join(tfidf.aligned(own, key, f"{field}_norm", idf[field], f"{field}_idf"), key, "left")
    return own


def _weights(column: pa.ChunkedArray) -> list[np.ndarray]:
    column = column.combine_chunks()
    flat, many = column.flatten().to_numpy(zero_copy_only=False), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.split(flat, np.cumsum(many)[:-1]) if len(many) else []


def _texts(table: pa.Table, column: str) -> list[str]:
    return table.column(column).fill_null("").to_pylist()


def _of_cell(wanted: Sequence[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(pairs: pa.Table, records: pa.Table) -> pa.Table:
        """The wanted features of a cell's pairs, from the records that came to it."""
        sides = [records.filter(pc.equal(records.column("side"), i)) for i in (0, 1)]
        places = [{x: i for i, x in enumerate(t.column("id").to_pylist())} for t in sides]
        at = [(places[0].get(x), places[1].get(y)) for x, y in zip(pairs.column(S1).to_pylist(), pairs.column(CAND).to_pylist(), strict=True)]
        known = np.array([x is not None and y is not None for x, y in at], bool)
        pairs = pairs.filter(pa.array(known))
        a, b = np.array([p for p, k in zip(at, known, strict=True) if k], np.int64).reshape(-1, 2).T
        made: dict[str, np.ndarray] = {}
        for field in ("name", "addr"):
            own = {f.removeprefix(f"{field}_") for f in wanted if f.startswith(f"{field}_")}
            if own - {"jaccard_tokens"}:
                left, right = (_texts(t, f"{field}_norm") for t in sides)
            if "tfidf_cosine" in own:
                vectors = tfidf.Rows()
                rows = [vectors.add(x, _weights(t.column(f"{field}_idf"))) for x, t in ((left, sides[0]), (right, sides[1]))]
                made[f"{field}_tfidf_cosine"] = vectors.dots(*rows, a, b)
            if own - {"jaccard_tokens", "tfidf_cosine"}:
                x, y = [left[i] for i in a.tolist()], [right[i] for i in b.tolist()]
            for name, f in _RATIOS.items():
                if name in own:
                    made[f"{field}_{name}"] = f(x, y)
            if "len_diff_ratio" in own:
                n, m = (np.fromiter(map(len, t), float, len(t)) for t in (x, y))
                longer = np.maximum(n, m)
                made[f"{field}_len_diff_ratio"] = np.where(longer == 0, 1.0, 1 - np.abs(n - m) / np.maximum(longer, 1))
            if "jaccard_tokens" in own:
                words = [[frozenset(z or ()) for z in t.column("name_core_tokens").to_pylist()] if field == "name" else [frozenset(z.split(" ")) - {""} for z in _texts(t, "addr_norm")] for t in sides]
                made[f"{field}_jaccard_tokens"] = np.array([len(p & q) / (len(p | q) or 1) for p, q in ((words[0][i], words[1][j]) for i, j in zip(a.tolist(), b.tolist(), strict=True))], float)
        if {"postal_code_match", "postal_code_both_present"} & {*wanted}:
            codes = [np.array(t.column("postal_code").to_pylist(), object)[i] for t, i in zip(sides, (a, b), strict=True)]
            there = [np.array([bool(c) for c in side], bool) for side in codes]
            made["postal_code_match"] = there[0] & (codes[0] == codes[1])
            made["postal_code_both_present"] = there[0] & there[1]
        if "country_match" in wanted:
            lands = [np.array(t.column("country").to_pylist(), object)[i] for t, i in zip(sides, (a, b), strict=True)]
            made["country_match"] = np.array([p is not None and p == q for p, q in zip(*lands, strict=True)], bool)
        made["embedding_cosine_sim"] = pairs.column("sim").to_numpy()
        return pa.table({S1: pairs.column(S1), CAND: pairs.column(CAND)} | {f: pa.array(np.asarray(made[f], float)) for f in wanted})

    return run


def pair_features(
    source1: DataFrame, pool: DataFrame, pairs: DataFrame, idf: dict[str, DataFrame] | None = None, block: int = BLOCK, columns: int = COLUMNS, wanted: Sequence[str] = FEATURES
) -> DataFrame:
    """(S1, CAND, wanted features) for pairs (S1, CAND, optional sim) of known ids; pairs with an unknown id are left out, ids occur once on each side.

    Pairs meet their records on a grid: query ids are hashed into rows of about `block` records, pool ids into `columns`. A query record goes out once for
    each column, a pool record once for each cell that has a pair of it, with the strings and the weights of n-grams that the wanted features need; a cell then computes all of its pairs at
    once. Pairs of a query record are bounded by the cap of its candidates, and those of a much wanted pool record spread over all rows.
    """
    idf = {field: idf[field] if idf else tfidf.fit(_both(source1, pool), f"{field}_norm") for field in ("name", "addr") if f"{field}_tfidf_cosine" in wanted}
    fields = [*_fields(wanted), *(f"{field}_idf" for field in idf)]
    rows = max(1, -(-source1.count() // block))
    row, column = F.pmod(F.xxhash64(S1), F.lit(rows)), F.pmod(F.xxhash64(CAND), F.lit(columns))
    score = F.coalesce("sim", F.lit(0.0)) if "sim" in pairs.columns else F.lit(0.0)
    dealt = pairs.select(S1, CAND, score.cast("double").alias("sim"), (row * columns + column).alias("cell"))
    needed = dealt.select(CAND, "cell").distinct()
    left = _side(source1, S1, idf, _fields(wanted)).withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(columns - 1)), lambda c: row * columns + c)))
    right = _side(pool, CAND, idf, _fields(wanted)).join(needed, CAND)
    own = lambda df, key, side: df.select("cell", F.lit(side).alias("side"), F.col(key).alias("id"), *fields)
    records = own(left, S1, 0).unionByName(own(right, CAND, 1))
    schema = f"{S1} string, {CAND} string, " + ", ".join(f"{f} double" for f in wanted)
    return dealt.groupBy("cell").cogroup(records.groupBy("cell")).applyInArrow(_of_cell(wanted), schema)
