"""Record linkage: hand-made rows, brute force, files, and a whole run."""

import math
import random
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinlink.functions import batch, similarity, text, tfidf
from kinlink.operators import blocking, features, matcher, metrics, split, validate
from kinlink.operators.blocking import CAND, S1
from kinlink.plans import linkage, queries
from kinlink.sources import fixtures, tables

RECORD = "entity_id string, business_name string, business_address string, country string"


def one(spark, column, *values):
    names = [f"c{i}" for i in range(len(values))]
    df = spark.createDataFrame([values], ", ".join(f"{n} string" for n in names))
    return df.select(column(*map(F.col, names)).alias("x")).first().x


# --- functions --------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("raw", "name"),
    [
        (None, ""), ("", ""), ("  Acme   Corp.  ", "acme corporation"), ("Smith & Sons Pvt. Ltd.", "smith and sons private limited"),
        ("Crème Brûlée Co", "creme brulee company"), ("ﬁne ½", "fine 1 2"), ("An Enterprises Ltd", "an ent limited"), ("A_B-C", "a_b c"),
        ("Corporate Incorporated", "corporate inc"), ("Industries Bros Mfg Intl Grp", "ind brothers manufacturing international group"), ("श्री लक्ष्मी", None), ("x y", "x y"),
    ],
)
def test_names(spark, raw, name):
    got = one(spark, text.normalize_name, raw)
    if name is None:  # marks of combining class 0 are no letters and become spaces
        folded = "".join(c for c in unicodedata.normalize("NFKD", raw) if not unicodedata.combining(c))
        name = " ".join("".join(c if c.isalnum() else " " for c in folded).split())
    assert got == name


@pytest.mark.parametrize(
    ("raw", "address"),
    [("12 Gandhi Rd., City, 641001", "12 gandhi road , city, 641001"), ("St Johns Ave,Apt 4", "street johns avenue,apartment 4"), (None, ""), ("Nagar Rd,rd rds", "nagar road,road rds"), ("Opp. Dr Ln", "opposite drive lane")],
)
def test_addresses(spark, raw, address):
    assert one(spark, text.normalize_address, raw) == address


@pytest.mark.parametrize(
    ("raw", "country", "code"),
    [
        ("x 641001", "India", "641001"), ("x 64100 1", "India", ""), ("12345 Main St, 73301", "US", "12345"), ("Austin 73301-1234", " us ", "73301"), ("Paris 75001", "France", "75001"),
        ("75001 then 641001", "", "641001"), ("1234567", "", ""), (None, None, ""), ("a64100b", "", ""), ("no code", "US", ""),
    ],
)
def test_postal_codes(spark, raw, country, code):
    assert one(spark, text.postal_code, raw, country) == code


def test_landmarks_and_core(spark):
    assert one(spark, text.landmark, "12 Rd, Near SBI ATM, City") == "SBI ATM"
    assert one(spark, text.landmark, "nearby 4") == "" and one(spark, text.landmark, None) == ""
    assert sorted(one(spark, text.core_tokens, "sri lakshmi ent private limited a")) == ["lakshmi", "sri"]
    assert sorted(one(spark, text.core_tokens, "the company limited company")) == ["company", "limited", "the"]
    assert one(spark, text.core_tokens, "") == []
    assert one(spark, text.id_list, " b, ,a ,,c,a") == ["b", "a", "c", "a"]


def naive_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abcé ", max_size=14), st.text("abcé ", max_size=14))
def test_string_ratios(a, b):
    common = naive_subsequence(a, b)
    assert similarity.common_subsequence(a, b) == common
    assert similarity.indel_ratio(a, b) == (2 * common / (len(a) + len(b)) if a or b else 1.0)
    assert similarity.token_sort_ratio(a, b) == similarity.indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))
    for f in (similarity.jaro_winkler, similarity.token_set_ratio, similarity.token_sort_ratio):
        assert 0 <= f(a, b) <= 1 and f(a, b) == pytest.approx(f(b, a))


def test_known_ratios():
    assert similarity.jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    assert similarity.jaro_winkler("dixon", "dicksonx") == pytest.approx(0.813333, abs=1e-6)
    assert similarity.jaro_winkler("abcd", "axyz") == 0.5 and similarity.jaro_winkler("", "") == 1.0 and similarity.jaro_winkler("", "a") == 0.0
    assert similarity.token_set_ratio("a b", "a b c") == 1.0 and similarity.token_set_ratio("", "") == 0.0 and similarity.token_sort_ratio("b a", "a b") == 1.0


def naive_ngrams(t, low=2, high=4):
    out = []
    for w in t.split():
        w = f" {w} "
        for n in range(low, high + 1):
            out += [w[i : i + n] for i in range(max(1, len(w) - n + 1))]
            if len(w) <= n:
                break
    return out


def test_ngrams(spark):
    r = random.Random(1)
    rows = ["".join(r.choice("ab c") for _ in range(r.randrange(12))) for _ in range(200)] + [""]
    got = spark.createDataFrame([(x,) for x in rows], "t string").select("t", tfidf.char_ngrams(F.col("t")).alias("g")).collect()
    assert all(sorted(x.g) == sorted(naive_ngrams(x.t)) for x in got)


def test_tfidf_against_dictionaries(spark):
    texts = ["acme tools", "acme", "tools of acme", "", "zebra"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    idf = tfidf.fit(df, "t")
    grams = [set(naive_ngrams(t)) for t in texts]
    weight = {g: math.log(6 / (1 + sum(g in x for x in grams))) + 1 for g in set().union(*grams)}
    assert {x.gram: round(x.idf, 9) for x in idf.collect()} == {g: round(w, 9) for g, w in weight.items()}
    vectors = {x.id: (x.grams, x.weights) for x in tfidf.vectors(df, "id", "t", idf).collect()}
    assert 3 not in vectors and all(sum(w * w for w in v[1]) == pytest.approx(1) for v in vectors.values())


# --- blocking ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def records(spark):
    s1 = [("S1-1", "Blue Heron Ent", "1 Rd, 641001", "India"), ("S1-2", "Quartz Corp", "x", "US"), ("S1-3", "The Company Ltd", "", ""), ("S1-4", "", "5 St 73301", "US")]
    pool = [
        ("S2-1", "Blue Heron Enterprises", "2 Rd 641001", "India"), ("S2-2", "Heron Lamps", "", "India"), ("S3-1", "QUARTZ", "9 Ave, 73301", "US"), ("S3-2", "Other", "641001", "France"),
        ("S3-3", "Company", "", ""), ("S3-4", "Zeta", "a 73301", "US"),
    ]
    return text.normalize(spark.createDataFrame(s1, RECORD)).cache(), text.normalize(spark.createDataFrame(pool, RECORD)).cache()


def pairs_of(df):
    return sorted((x[S1], x[CAND]) for x in df.collect())


def test_token_and_postal_candidates(records):
    s1, pool = records
    got = {(x[S1], x[CAND]): x.n_shared for x in blocking.token_candidates(s1, pool).collect()}
    assert got == {("S1-1", "S2-1"): 2, ("S1-1", "S2-2"): 1, ("S1-2", "S3-1"): 1, ("S1-3", "S3-3"): 1}
    assert pairs_of(blocking.token_candidates(s1, pool, limit=1)) == [("S1-1", "S2-1"), ("S1-2", "S3-1"), ("S1-3", "S3-3")]
    assert pairs_of(blocking.token_candidates(s1, pool, max_doc_freq=1)) == [("S1-1", "S2-1"), ("S1-2", "S3-1"), ("S1-3", "S3-3")]
    assert pairs_of(blocking.token_candidates(s1, pool, min_shared=2)) == [("S1-1", "S2-1")]
    assert pairs_of(blocking.postal_candidates(s1, pool)) == [("S1-1", "S2-1"), ("S1-1", "S3-2"), ("S1-4", "S3-1"), ("S1-4", "S3-4")]
    assert pairs_of(blocking.postal_candidates(s1, pool, 1)) == [("S1-1", "S2-1"), ("S1-4", "S3-1")]


def test_union_and_cap(spark, records):
    s1, pool = records
    knn = spark.createDataFrame([("S1-1", "S3-4", 0.9), ("S1-1", "S2-1", -0.2), ("S1-2", "S3-1", 0.1)], f"{S1} string, {CAND} string, sim double")
    union = blocking.union_candidates(blocking.token_candidates(s1, pool), blocking.postal_candidates(s1, pool), knn)
    top = {(x[S1], x[CAND]): x for x in blocking.cap_candidates(union, 2).collect()}
    # a negative similarity ranks below an unknown one
    assert [k for k in sorted(top) if k[0] == "S1-1"] == [("S1-1", "S2-2"), ("S1-1", "S3-4")]
    long = blocking.long_candidates(s1, blocking.cap_candidates(union, 30))
    assert {x[S1] for x in long.collect()} == {"S1-1", "S1-2", "S1-3", "S1-4"}
    sizes = blocking.candidate_sizes(s1, union).first()
    assert (sizes.entities, sizes.with_candidates, sizes.pairs, sizes.most) == (4, 4, union.count(), 4)


def test_most_shared_places_against_all_counts():
    """Bounds leave out no place: random sorted lists, ties, small limits, least counts."""
    r = random.Random(31)
    for _ in range(600):
        size, many = r.choice([3, 30, 200]), r.randrange(1, 6)
        lists = sorted((np.array(sorted(r.sample(range(size), r.randrange(1, size + 1)))) for _ in range(many)), key=len)
        limit, least = r.choice([1, 2, 5, 50]), r.choice([1, 1, 2, 3])
        count = Counter(x for own in lists for x in own.tolist())
        want = sorted((-n, x) for x, n in count.items() if n >= least)[:limit]
        places, counts = blocking._most_shared(lists, limit, least)
        assert [(-n, x) for x, n in zip(places.tolist(), counts.tolist(), strict=True)] == want


def test_token_overlap_by_cells_of_any_size(spark):
    """Small cells give what one cell gives, and what counting by hand gives: hot tokens, repeats, nulls, records without tokens."""
    r = random.Random(5)
    words = ["hot", *(f"w{i}" for i in range(12))]
    rows = lambda p, n: [(f"{p}-{i:04d}", sorted({"hot", *r.choices(words, k=r.randrange(4))} if i % 3 else set(r.choices(words, k=3)))) for i in range(n)]
    asked, held = rows("S1", 50), rows("S2", 300)
    kind = "entity_id string, name_core_tokens array<string>"
    s1 = spark.createDataFrame([*asked, asked[0], (None, ["hot"]), ("S1-x", []), ("S1-y", None), ("S1-z", ["nowhere"])], kind)
    pool = spark.createDataFrame([*held, held[1], (None, ["hot"]), ("S2-x", [])], kind)
    for limit, least in ((4, 1), (200, 2), (1000, 1)):
        want = set()
        for a, x in asked:
            count = {b: len(set(x) & set(y)) for b, y in held}
            best = sorted((-n, b) for b, n in count.items() if n >= least)[:limit]
            want |= {(a, b, -n) for n, b in best}
        for block in ((8000, 200_000), (5, 40)):
            got = blocking.token_candidates(s1, pool, 5000, least, limit, block=block)
            assert sorted(map(tuple, got.collect())) == sorted(want)
    assert blocking.token_candidates(s1.limit(0), pool).count() == blocking.token_candidates(s1, pool.limit(0)).count() == 0


def test_a_cell_gives_no_more_than_the_limit_of_a_query():
    """One word in all records of a cell: each query leaves with its `limit` best, not with the word's pairs."""
    asked = pa.table({S1: [f"S1-{i}" for i in range(300)] * 2, "token": ["harbour"] * 300 + [f"w{i % 7}" for i in range(300)], "code": pa.nulls(600, pa.string())})
    index = pa.table({CAND: [f"S2-{i:05}" for i in range(20_000)] * 2, "token": ["harbour"] * 20_000 + [f"w{i % 11}" for i in range(20_000)], "code": pa.nulls(40_000, pa.string())})
    out = blocking._sharing(200, 1)(asked, index)
    assert out.num_rows == 300 * 200 and set(out.column("n_shared").to_pylist()) == {2} and not any(out.column("postal_hit").to_pylist())


def test_a_cell_takes_lists_of_tokens_and_keeps_the_first_by_code():
    """Of the `limit` best by shared tokens and id the first by tokens, equal code and id: a hit beyond the limit does not come in."""
    r = random.Random(8)
    words, codes = [f"w{i}" for i in range(6)], ["", "1", "2", None]
    made = lambda p, n: [(f"{p}-{i:03}", r.sample(words, r.randrange(4)), r.choice(codes)) for i in range(n)]
    asked, held = made("S1", 30), made("S2", 90)
    table = lambda rows, key: pa.table({key: [x for x, _, _ in rows], "token": pa.array([t for _, t, _ in rows], pa.list_(pa.string())), "code": pa.array([c for *_, c in rows], pa.string())})
    want = set()
    for a, x, c in asked:
        best = sorted((-len({*x} & {*y}), b, not (c and c == d)) for b, y, d in held if {*x} & {*y})[:20]
        want |= {(a, b, -n, not other) for n, other, b in sorted((n, other, b) for n, b, other in best)[:4]}
    out = blocking._sharing(20, 1, 4)(table(asked, S1), table(held, CAND))
    assert {*zip(*(c.to_pylist() for c in out.columns), strict=True)} == want and out.num_rows == len(want)


def test_candidates_leave_a_cell_within_their_cap(spark, monkeypatch):
    """The cap of candidates holds in the cells, for one block of the pool and for many: no `per_token_query` rows of a query are shuffled."""
    row = lambda p, i: (f"{p}-{i:05}", ["hot", f"w{i % 5}"], f"{i % 3}")
    s1, pool = (spark.createDataFrame([row(p, i) for i in range(n)], "entity_id string, name_core_tokens array<string>, postal_code string") for p, n in (("S1", 20), ("S2", 400)))
    codes = pool.select(F.col("entity_id").alias(CAND), F.col("postal_code").alias("code"))
    whole = blocking.token_candidates(s1, pool, 5000, limit=200, codes=codes)
    want = blocking.cap_candidates(whole.withColumn("sim", F.lit(0.0)), 7).drop("sim")
    for block in ((8000, 200_000), (5, 60)):
        got = blocking.token_candidates(s1, pool, 5000, limit=200, codes=codes, block=block, first=7)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 140
    sizes = []
    made = blocking._sharing
    monkeypatch.setattr(blocking, "_sharing", lambda limit, least, first=None: sizes.append(first) or made(limit, least, first))
    blocking.candidates(s1, pool, max_doc_freq=5000)
    assert sizes == [30]


def test_a_cell_gets_no_more_of_a_key_than_the_limit(spark, monkeypatch):
    """One token in 3,000 pool records and a limit of 10: the cell reads ten of them, as many as of 300."""

    def counting(limit, least, first=None):
        def of_cell(asked, index):
            many = sum(map(len, index.column("held").to_pylist())) if "held" in index.column_names else index.num_rows
            return pa.table({S1: ["all"], CAND: ["all"], "n_shared": pa.array([many], pa.int32()), "postal_hit": [False]})

        return of_cell

    monkeypatch.setattr(blocking, "_sharing", counting)
    kind = "entity_id string, name_core_tokens array<string>"
    s1 = spark.createDataFrame([("S1-1", ["hot"])], kind)
    for n in (300, 3000):
        pool = spark.createDataFrame([(f"S2-{i:05}", ["hot", f"w{i}"]) for i in range(n)], kind)
        assert blocking.token_candidates(s1, pool, 5000, limit=10).agg(F.sum("n_shared")).first()[0] == 10


def test_records_of_many_tokens_are_counted_whole(spark, monkeypatch):
    """Narrow and wide records on either side against all counts."""
    monkeypatch.setattr(blocking, "WIDE", 3)
    r = random.Random(12)
    words = [f"w{i}" for i in range(14)]
    rows = {p: [(f"{p}-{i:03}", r.sample(words, r.choice([1, 2, 3, 3, 6, 9]))) for i in range(n)] for p, n in (("S1", 40), ("S2", 150))}
    s1, pool = (spark.createDataFrame(rows[p], "entity_id string, name_core_tokens array<string>") for p in ("S1", "S2"))
    want = []
    for a, x in rows["S1"]:
        best = sorted((-len({*x} & {*y}), b) for b, y in rows["S2"] if len({*x} & {*y}) >= 2)[:20]
        want += [(a, b, -n) for n, b in best]
    got = blocking.token_candidates(s1, pool, 5000, 2, 20, block=(15, 50))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_frequent_word_stays_bounded(spark):
    s1, pool = (text.normalize(fixtures.stress_records(spark, p, 2000)) for p in ("S1", "S2"))
    got = blocking.token_candidates(s1, pool)
    assert got.agg(F.max("n_shared")).first()[0] == 1 and got.count() == 2000
    assert "harbour" in {x.token for x in blocking.frequent_tokens(pool).collect()}
    capped = blocking.candidates(s1, pool)
    assert capped.groupBy(S1).count().agg(F.max("count")).first()[0] <= 30


def test_hot_tokens_and_codes_are_dealt_over_tasks(spark, monkeypatch):
    """A token and a code of all records: the same pairs from many parts, none of which holds more than its share of the pool."""
    row = lambda p, i: (f"{p}-{i:05}", ["hot", f"w{i % 50}"], "60001")
    kind = "entity_id string, name_core_tokens array<string>, postal_code string"
    s1, pool = spark.createDataFrame([row("S1", i) for i in range(30)], kind), spark.createDataFrame([row("S2", i) for i in range(2000)], kind)
    calls = {"token": lambda n: blocking.token_candidates(s1, pool, max_doc_freq=5000, limit=5000, block=(8000, n)), "code": lambda _: blocking.postal_candidates(s1, pool, 5000)}
    whole = {k: pairs_of(f(200_000)) for k, f in calls.items()}
    assert all(len(x) == 60_000 for x in whole.values())
    monkeypatch.setattr(blocking, "PART", 100)
    assert {k: pairs_of(f(100)) for k, f in calls.items()} == whole
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = blocking.postal_candidates(s1, pool, 5000).select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(x["count"] for x in plan) < 0.6 * 60_000  # over four tasks, twenty parts


def test_neighbours(spark):
    r = random.Random(2)
    vectors = lambda p, n: spark.createDataFrame([(f"{p}-{i:04d}", [r.gauss(0, 1) for _ in range(8)]) for i in range(n)], "entity_id string, embedding array<float>")
    s1, pool = vectors("S1", 60).cache(), vectors("S2", 900).cache()
    exact = blocking.knn_candidates(s1, pool, 5)
    cells = blocking.knn_candidates(s1, pool, 5, probes=64)
    assert exact.count() == cells.count() == 300
    assert len(set(pairs_of(exact)) & set(pairs_of(cells))) >= 0.9 * 300
    assert blocking.knn_candidates(s1, pool.limit(0), 5).count() == 0
    assert blocking.knn_candidates(s1, pool.limit(3), 5).count() == 180


def test_tiles_find_the_exact_neighbours(spark):
    """Tiles of 100 rows against all similarities: the same vector many times over many tiles, zeros, nulls."""
    r = random.Random(8)
    hot = [r.gauss(0, 1) for _ in range(12)]
    made = lambda p, n: [(f"{p}-{i:04d}", None if i % 41 == 7 else [0.0] * 12 if i % 53 == 9 else hot if i % 3 == 0 else [r.gauss(0, 1) for _ in range(12)]) for i in range(n)]
    asked, held = made("S1", 90), made("S2", 450)
    kind = "entity_id string, embedding array<double>"
    s1, pool = spark.createDataFrame(asked, kind), spark.createDataFrame(held, kind)
    unit = lambda rows: (np.array([k for k, v in rows if v]), (m := np.array([v for _, v in rows if v])) / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300))
    (own, q), (ids, p) = unit(asked), unit(held)
    want = {}
    for a, sims in zip(own, (q @ p.T).round(12), strict=True):
        want[a] = [(b, s) for s, b in sorted(zip((-sims).tolist(), ids, strict=True))[:15]]
    for tile in (100, 7, None):
        got = defaultdict(list)
        for x in blocking.knn_candidates(s1, pool, 15, tile=tile).orderBy(S1, F.desc("sim"), CAND).collect():
            got[x[S1]].append((x[CAND], -x.sim))
        assert {a: [b for b, _ in x] for a, x in got.items()} == {a: [b for b, _ in x] for a, x in want.items()}
        assert all(abs(s - t) < 1e-9 for a in want for (_, s), (_, t) in zip(want[a], got[a], strict=True))


# --- features, metrics, splits ----------------------------------------------------------------


def test_features(spark, records):
    s1, pool = records
    pairs = spark.createDataFrame([("S1-1", "S2-1", 0.5), ("S1-4", "S3-3", None), ("S1-9", "S2-1", 0.1)], f"{S1} string, {CAND} string, sim double")
    got = {x[S1]: x for x in features.pair_features(s1, pool, pairs).collect()}
    assert set(got) == {"S1-1", "S1-4"}
    a = got["S1-1"]
    assert a.name_levenshtein_ratio == a.name_jaccard_tokens == a.name_jaro_winkler == 1 and a.name_tfidf_cosine == pytest.approx(1)
    assert (a.postal_code_match, a.postal_code_both_present, a.country_match, a.embedding_cosine_sim) == (1, 1, 1, 0.5)
    b = got["S1-4"]
    assert (b.name_tfidf_cosine, b.name_jaccard_tokens, b.name_token_set_ratio, b.postal_code_both_present, b.embedding_cosine_sim) == (0, 0, 0, 0, 0)
    assert tuple(x for x in a.asDict() if x not in (S1, CAND)) == features.FEATURES


def test_metrics(spark):
    table = lambda rows: spark.createDataFrame(rows, f"{S1} string, {CAND} string")
    ids = spark.createDataFrame([(x,) for x in "abcd"], "entity_id string")
    truth = table([("a", "1"), ("a", "2"), ("b", "3"), ("z", "9")])
    predicted = table([("a", "1"), ("a", "1"), ("a", "7"), ("d", "5"), ("y", "1")])
    scores = {x[S1]: x.f_beta for x in metrics.entity_scores(predicted, truth, ids).collect()}
    assert scores == {"a": 0.5, "b": 0.0, "c": 1.0, "d": 0.0}
    assert metrics.macro_f_beta(predicted, truth, ids).first()[0] == pytest.approx(0.375)
    s = metrics.summary(predicted, truth, ids).first()
    assert (s.micro_precision, s.micro_recall) == (pytest.approx(1 / 3), pytest.approx(1 / 3)) and s.singleton_accuracy == 0.5 and s.exact_match_entity_rate == 0.25
    report = {x[S1]: x for x in metrics.entity_report(predicted, truth, ids).collect()}
    assert report["a"].predicted == ["1", "7"] and report["b"].predicted == [] and report["b"].truth == ["3"]
    assert metrics.macro_f_beta(predicted, truth, ids.limit(0)).first()[0] == 0


def test_sweep_equals_single_thresholds(spark):
    r = random.Random(3)
    ids = spark.createDataFrame([(f"s{i}",) for i in range(25)], "entity_id string")
    scored = spark.createDataFrame([(f"s{r.randrange(25)}", f"c{r.randrange(40)}", r.choice([0.3, 0.31, 0.5, 0.52, r.random(), 0.94, 1.0])) for _ in range(300)], f"{S1} string, {CAND} string, match_probability double").dropDuplicates([S1, CAND]).cache()
    truth = spark.createDataFrame([(f"s{r.randrange(25)}", f"c{r.randrange(40)}") for _ in range(60)], f"{S1} string, {CAND} string").distinct().cache()
    sweep = {x.threshold: x.macro_f0_5 for x in metrics.threshold_sweep(scored, truth, ids).collect()}
    assert len(sweep) == 33 and min(sweep) == 0.30 and max(sweep) == 0.94
    for t in (0.30, 0.52, 0.94):
        assert sweep[t] == pytest.approx(metrics.macro_f_beta(matcher.decide(scored, t), truth, ids).first()[0])
    best = metrics.best_threshold(metrics.threshold_sweep(scored, truth, ids)).first()
    assert best.threshold == min(t for t in sweep if sweep[t] == max(sweep.values()))


def test_splits(spark):
    s1 = spark.createDataFrame([(f"S1-{i}",) for i in range(101)], "entity_id string")
    truth = spark.createDataFrame([(f"S1-{i}", "x") for i in range(40)], f"{S1} string, {CAND} string")
    got = split.entity_split(s1, truth).collect()
    assert sum(x.is_val for x in got if x.has_match) == 8 and sum(x.is_val for x in got if not x.has_match) == 13
    alone = split.entity_split(s1, truth.limit(1)).collect()
    assert sum(x.is_val for x in alone) == 21
    folds = split.group_folds(truth).groupBy(S1).agg(F.count_distinct("fold").alias("n"), F.first("fold").alias("f")).collect()
    assert {x.n for x in folds} == {1} and {x.f for x in folds} <= set(range(5))
    assert split.sample(s1, "entity_id", 7).count() == 7


# --- files and validation ---------------------------------------------------------------------


def test_files_round_trip(spark, tmp_path):
    rows = [("S1-1", ' sp "q" ', "a\tb", "NA"), ("S1-2", "", "null", "")]
    df = spark.createDataFrame(rows, RECORD)
    tables.write_records(df, f"{tmp_path}/r")
    assert sorted(map(tuple, tables.read_records(spark, f"{tmp_path}/r").collect())) == rows
    pairs = spark.createDataFrame([("S1-1", "b"), ("S1-1", "a"), ("S1-1", "a")], f"{S1} string, {CAND} string")
    tables.write_id_lists(df, pairs, "matched_entity_ids", f"{tmp_path}/m")
    assert sorted(map(tuple, tables.read_output(spark, f"{tmp_path}/m").collect())) == [("S1-1", "a,b"), ("S1-2", "")]
    truth = tables.read_truth(spark, f"{tmp_path}/m")
    assert {x[S1]: sorted(x.matched_entity_ids) for x in truth.collect()} == {"S1-1": ["a", "b"], "S1-2": []}
    assert tables.read_output(spark, f"{tmp_path}/none") is None


def test_validation(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "entity_id string")
    s = ids("S1-1", "S1-2", "S1-3"), ids("S2-1"), ids("S3-1")
    m = lambda rows: spark.createDataFrame(rows, f"{S1} string, matched_entity_ids string")
    c = lambda rows: spark.createDataFrame(rows, f"{S1} string, candidate_entity_ids string")
    good = validate.report(m([("S1-1", "S2-1,S3-1"), ("S1-2", ""), ("S1-3", " ")]), c([("S1-1", "S3-1, S2-1")]), *s)
    assert validate.valid(good)
    bad = m([("S1-1", "S2-1,S2-1"), ("S1-1", "S1-2"), ("S1-9", "S2-9"), ("S1-2", None)])
    found = {x.check: x.violations for x in validate.report(bad, c([]), *s).collect() if x.violations}
    assert found == {"duplicate_entities": 1, "missing_entities": 1, "unknown_entities": 1, "null_cells": 1, "duplicates_in_cells": 1, "queries_as_matches": 1, "unknown_matches": 1, "matches_not_candidates": 2}
    assert not validate.valid(validate.report(None, c([]), *s)) and not validate.valid(validate.report(m([]).drop(S1), c([]), *s))


def test_whole_run(spark, tmp_path):
    r = random.Random(4)
    name = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(2))
    sources, truth = {1: [], 2: [], 3: []}, []
    for i in range(60):
        n, code = name(), str(600000 + i)
        sources[1].append((f"S1-{i}", f"{n} Pvt Ltd", f"{i} Main Rd, {code}", "India"))
        if i % 4:
            k = r.choice([2, 3])
            sources[k].append((f"S{k}-{i}", f"{n} Private Limited", f"{i} Main Road {code}", "India"))
            truth.append((f"S1-{i}", f"S{k}-{i}"))
        for k in (2, 3):
            sources[k].append((f"S{k}-n{i}", f"{n.split()[0]} {name()} Inc", "9 Other St 12345", "India"))
    s1, s2, s3 = (spark.createDataFrame(sources[i], RECORD) for i in (1, 2, 3))
    pairs = spark.createDataFrame(truth, f"{S1} string, {CAND} string")
    model, idf, config = linkage.train(spark, s1, s2, s3, pairs, rounds=3, folds=2)
    assert {"threshold", "use_embeddings", "embedding_model_name", "max_candidates_per_entity", "blocking_recall_train_split", "cv_metrics", "validation_summary"} <= set(config)
    assert set(config["cv_metrics"]) == {"accuracy", "precision", "recall", "f1", "f0_5"} and config["cv_metrics"]["f0_5"] > 0.8
    assert config["validation_summary"]["macro_f0_5"] > 0.9 and config["blocking_recall_train_split"] == 1.0
    matcher.save(f"{tmp_path}/art", model, idf, config)
    loaded = matcher.load(spark, f"{tmp_path}/art")
    assert loaded[2]["threshold"] == config["threshold"]
    found, matches = linkage.predict(spark, s1, s2, s3, *loaded)
    assert metrics.macro_f_beta(matches, pairs, s1).first()[0] > 0.9
    checks = validate.report(tables.id_lists(s1, matches, "matched_entity_ids"), tables.id_lists(s1, found, "candidate_entity_ids"), s1, s2, s3)
    assert validate.valid(checks)


def test_training_without_pairs_of_both_labels(spark):
    schema = f"{S1} string, {CAND} string, label int, " + ", ".join(f"{f} double" for f in features.FEATURES)
    none = spark.createDataFrame([], schema)
    ones = spark.createDataFrame([(f"S1-{i}", "S2-1", 1, *[0.5] * len(features.FEATURES)) for i in range(6)], schema)
    for rows in (none, ones):
        with pytest.raises(ValueError, match="both labels"):
            matcher.train(rows, rounds=1)
    assert matcher.out_of_fold(none).count() == 0 and matcher.out_of_fold(none, groups=None).count() == 0
    assert {x.match_probability for x in matcher.out_of_fold(ones).collect()} == {1.0}


def test_stratified_folds(spark):
    rows = spark.createDataFrame([(i, f"c{i}", int(i % 9 == 0)) for i in range(200)], f"{S1} long, {CAND} string, label int")
    got = split.stratified_folds(rows, [S1, CAND], folds=4).groupBy("label", "fold").count().collect()
    assert sorted((x.label, x["count"]) for x in got) == [(0, 44)] * 3 + [(0, 45)] + [(1, 5)] + [(1, 6)] * 3
    assert split.stratified_folds(rows, [S1, CAND], folds=4).count() == 200


def test_files_to_files(spark, tmp_path):
    s1, s2, s3, truth = fixtures.made_records(spark, 120)
    for name in ("train", "test"):
        for i, df in enumerate((s1, s2, s3), 1):
            tables.write_records(df, f"{tmp_path}/{name}_source{i}.tsv")
    tables.write_id_lists(s1, truth, "matched_entity_ids", f"{tmp_path}/train_ground_truth.tsv")
    art, out = f"{tmp_path}/art", f"{tmp_path}/out"
    assert linkage.main(["train", "--data-dir", str(tmp_path), "--artifacts-dir", art, "--rounds", "3", "--folds", "2", "--embedding-model", "hashed-char-ngrams"]) == 0
    assert linkage.main(["predict", "--data-dir", str(tmp_path), "--artifacts-dir", art, "--output-dir", out]) == 0
    checked = ["validate", "--data-dir", str(tmp_path), "--matching", f"{out}/matching_results.tsv", "--candidate", f"{out}/candidate_pairs.tsv"]
    assert linkage.main(checked) == 0
    found = tables.truth_pairs(tables.read_truth(spark, f"{out}/matching_results.tsv"))
    assert metrics.macro_f_beta(found, truth, s1).first()[0] > 0.9


def test_arriving_records(spark, records, tmp_path):
    from kinlink.streaming.arriving import candidates_of_stream

    s1, pool = records
    raw = s1.select("entity_id", "business_name", "business_address", "country")
    raw.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(raw.schema).parquet(f"{tmp_path}/in")
    candidates_of_stream(stream, pool, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert pairs_of(spark.read.parquet(f"{tmp_path}/out")) == pairs_of(blocking.candidates(s1, pool))


def test_sampled(spark):
    s1 = spark.createDataFrame([(f"S1-{i}",) for i in range(50)], "entity_id string")
    pool = spark.createDataFrame([(f"S2-{i}",) for i in range(200)], "entity_id string")
    truth = spark.createDataFrame([(f"S1-{i}", f"S2-{i}") for i in range(30)], f"{S1} string, {CAND} string")
    q, p, t = fixtures.sampled(s1, pool, truth, rows=20, matched=0.8)
    assert q.count() == 20 and t.count() == 16 and p.count() == 64


def test_catalogue_has_an_oracle_for_all_but_models():
    assert set(queries.queries()) - set(queries.oracle_sql()) == {"knn_by_cells", "pair_features", "matched_entities", "encoder_candidates", "out_of_fold_metrics", "jaro_winkler"}


@pytest.fixture(scope="module")
def crowded(spark, tmp_path_factory):
    """Documents whose names share words and postal codes far beyond the small caps; some names stay non-ASCII."""
    r = random.Random(6)
    folder = tmp_path_factory.mktemp("crowded")
    words = ["stra\u00dfe", "\u00f8rsted", "\u65e5\u672c", "north", "harbour", "timber", "copper", "meadow"]
    rows = [(i, " ".join([r.choice(words), f"w{r.randrange(6)}x", r.choice(words)]), r.choice(["en", "de", "fr"]), "s", 0) for i in range(150)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def crowded_features(spark, crowded):
    return queries.queries()["pair_features"](spark, crowded).collect()


def test_pair_features_has_the_whole_candidates(spark, crowded, crowded_features):
    s1, pool = (x.collect() for x in queries._sides(spark, crowded))
    df = {}
    for p in pool:
        for t in set(p.name_core_tokens):
            df[t] = df.get(t, 0) + 1
    want = set()
    for q in s1:
        found = []
        for p in pool:
            shared = sum(df[t] <= 50 for t in set(q.name_core_tokens) & set(p.name_core_tokens))
            hit = q.postal_code != "" and q.postal_code == p.postal_code
            if shared or hit:
                found.append((-shared, not hit, p.entity_id))
        want |= {(q.entity_id, c) for *_, c in sorted(found)[:30]}
    got = [(x[S1], x[CAND]) for x in crowded_features]
    assert len(got) == len(set(got)) and set(got) == want
    assert max(sum(a == q.entity_id for a, _ in got) for q in s1) == queries.K


def test_out_of_fold_queries_score_every_entity(spark, monkeypatch):
    """Whatever its fold, an entity is decided on, at the operator's own folds and rounds."""
    asked = []

    def out_of_fold(rows, **given):
        asked.append(given)
        return rows.withColumns({"fold": F.lit(0), "match_probability": F.lit(1.0)})

    s1 = spark.createDataFrame([(f"S1-{i}",) for i in range(20)], "entity_id string")
    rows = spark.createDataFrame([(f"S1-{i}", f"S2-{i}") for i in range(20)], f"{S1} string, {CAND} string")
    monkeypatch.setattr(matcher, "out_of_fold", out_of_fold)
    monkeypatch.setattr(queries, "_sides", lambda *_: (s1, None))
    monkeypatch.setattr(queries, "_truth", lambda *_: rows)
    monkeypatch.setattr(queries, "_featured", lambda *_: rows)
    got = {x[S1]: x.matched_entity_ids for x in queries.queries()["matched_entities"](spark, "").collect()}
    assert got == {f"S1-{i}": f"S2-{i}" for i in range(20)}
    assert queries.queries()["out_of_fold_metrics"](spark, "").count() == 1
    assert asked == [{}, {}]


def brute_indel(a, b):
    row = [0] * (len(a) + 1)
    for y in b:
        new = [0]
        for i, x in enumerate(a):
            new.append(row[i] + 1 if x == y else max(row[i + 1], new[-1]))
        row = new
    return 2 * row[-1] / (len(a) + len(b)) if a or b else 1.0


def brute_jaro_winkler(a, b):
    reach, used, mine = max(0, max(len(a), len(b)) // 2 - 1), set(), []
    for i, x in enumerate(a):
        j = next((j for j in range(max(0, i - reach), min(len(b), i + reach + 1)) if j not in used and b[j] == x), None)
        if j is not None:
            used.add(j)
            mine.append(x)
    m = len(mine)
    if not m:
        return 0.0
    swapped = sum(x != b[j] for x, j in zip(mine, sorted(used), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    same = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
    return jaro + 0.1 * same * (1 - jaro) if jaro > 0.7 else jaro


def test_string_ratios_of_all_pairs_against_brute_force(spark, crowded, crowded_features):
    """Every candidate beyond the third, and pairs with a non-ASCII name, have their ratios."""
    s1, pool = ({x.entity_id: x for x in side.collect()} for side in queries._sides(spark, crowded))
    tall, foreign = 0, 0
    by_query = {}
    for x in crowded_features:
        a, b = s1[x[S1]], pool[x[CAND]]
        by_query[x[S1]] = by_query.get(x[S1], 0) + 1
        tall += by_query[x[S1]] > 3
        foreign += not (a.name_norm + b.name_norm).isascii()
        order = lambda t: " ".join(sorted(t.split()))
        assert x.name_levenshtein_ratio == pytest.approx(brute_indel(a.name_norm, b.name_norm), abs=1e-6)
        assert x.addr_levenshtein_ratio == pytest.approx(brute_indel(a.addr_norm, b.addr_norm), abs=1e-6)
        assert x.name_token_sort_ratio == pytest.approx(brute_indel(order(a.name_norm), order(b.name_norm)), abs=1e-6)
        assert x.addr_token_sort_ratio == pytest.approx(brute_indel(order(a.addr_norm), order(b.addr_norm)), abs=1e-6)
        assert x.name_jaro_winkler == pytest.approx(brute_jaro_winkler(a.name_norm, b.name_norm), abs=1e-6)
    assert tall > 500 and foreign > 100


# --- ratios of many pairs at once, the grid ---------------------------------------------------


def test_batch_ratios_equal_single_ones():
    """Non-ASCII letters, lengths around a word of 64 bits and beyond, prefixes, equal and empty strings."""
    r = random.Random(8)
    made = lambda n: "".join(r.choice("abcde é日\U0001f600") for _ in range(n))
    a = [made(r.choice([0, 1, 3, 20, 63, 64, 65, 130, 200])) for _ in range(3000)]
    b = [x if r.random() < 0.05 else x[: r.randrange(len(x) + 1)] + made(5) if r.random() < 0.4 else made(r.choice([0, 2, 40, 64, 129])) for x in a]
    for many, one in ((batch.indel_ratios, similarity.indel_ratio), (batch.jaro_winklers, similarity.jaro_winkler), (batch.token_sort_ratios, similarity.token_sort_ratio), (batch.token_set_ratios, similarity.token_set_ratio)):
        assert many(a, b).tolist() == [one(x, y) for x, y in zip(a, b, strict=True)]
        assert many([], []).tolist() == []
        assert many(["", "a"], ["", ""]).tolist() == [one("", ""), one("a", "")]


def test_rows_give_the_cosines_of_vectors(spark):
    texts = ["acme tools", "acme acme", "tools of acme", "", "zebra", "a"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    idf = tfidf.fit(df.filter("id < 4"), "t")  # zebra's n-grams have no weight
    weights = {x.id: np.array(x.w) for x in tfidf.aligned(df, "id", "t", idf, "w").collect()}
    rows = tfidf.Rows()
    side = rows.add(texts, [weights.get(i, np.zeros(0)) for i in range(len(texts))])
    vectors = {x.id: dict(zip(x.grams, x.weights, strict=True)) for x in tfidf.vectors(df, "id", "t", idf).collect()}
    a, b = (np.array(x) for x in zip(*((i, j) for i in range(6) for j in range(6)), strict=True))
    want = [sum(w * vectors.get(j, {}).get(g, 0) for g, w in vectors.get(i, {}).items()) for i, j in zip(a, b, strict=True)]
    assert rows.dots(side, side, a, b) == pytest.approx(want)
    assert rows.dots(side, side, a[:0], b[:0]).tolist() == []


def test_grids_of_any_size_give_the_same_features(spark, crowded, crowded_features):
    s1, pool = queries._sides(spark, crowded)
    small = queries._six(features.pair_features(s1, pool, queries._capped(spark, crowded), block=7, columns=3), *features.FEATURES)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, crowded_features))
    none = features.pair_features(s1.limit(0), pool, queries._capped(spark, crowded).limit(0))
    assert none.count() == 0 and none.columns == [S1, CAND, *features.FEATURES]


def test_only_the_wanted_features_are_computed(spark, crowded, crowded_features, monkeypatch):
    """A query of flags fits no n-grams and sends no strings; a cosine fits one field's."""
    s1, pool = queries._sides(spark, crowded)
    pairs, fitted, fit = queries._capped(spark, crowded), [], tfidf.fit
    monkeypatch.setattr(tfidf, "fit", lambda texts, column, *more: fitted.append(column) or fit(texts, column, *more))
    for wanted, columns in ((["country_match", "postal_code_match"], []), (["addr_tfidf_cosine"], ["addr_norm"]), (["name_jaccard_tokens", "addr_len_diff_ratio"], [])):
        fitted.clear()
        got = queries._six(features.pair_features(s1, pool, pairs, wanted=wanted), *wanted)
        assert fitted == columns and got.columns == [S1, CAND, *wanted]
        assert sorted(map(tuple, got.collect())) == sorted((x[S1], x[CAND], *(x[f] for f in wanted)) for x in crowded_features)
    assert features._fields(["country_match", "postal_code_both_present"]) == ["postal_code", "country"]


def test_late_fill_keeps_the_capped_union(spark):
    """Against the union of all signals' pairs: hot codes, caps of buckets, neighbours of negative similarity among the smallest ids, repeats."""
    r = random.Random(12)
    made = lambda side, n: spark.createDataFrame([(f"{side}-{i:04d}", [r.choice(["red", "blue", "oak", f"w{r.randrange(9)}"]) for _ in range(2)], r.choice(["1", "1", "2", "", "3"])) for i in range(n)], "entity_id string, name_core_tokens array<string>, postal_code string").cache()
    s1, pool = made("S1", 40), made("S2", 120)
    near = [(f"S1-{i:04d}", f"S2-{j:04d}", r.choice([-0.5, -0.1, 0.0, 0.3])) for i in range(40) for j in r.sample(range(120), 7)] + [(f"S1-{i:04d}", f"S2-{j:04d}", -0.9) for i in range(5) for j in range(120, 122)]
    near = spark.createDataFrame(near, f"{S1} string, {CAND} string, sim double").dropDuplicates([S1, CAND]).cache()
    for knn in (None, near):
        for df, bucket, top, limit in ((40, 200, 200, 5), (60, 25, 6, 9), (5, 8, 3, 30), (1, 200, 200, 3)):
            full = blocking.union_candidates(blocking.token_candidates(s1, pool, df, limit=top), blocking.postal_candidates(s1, pool, bucket), knn)
            want = blocking.cap_candidates(full, limit).collect()
            got = blocking.candidates(s1, pool, knn, df, bucket, top, limit).collect()
            key = lambda x: tuple((c, str(x[c])) for c in (S1, CAND, "sim", "n_shared", "postal_hit"))
            assert sorted(map(key, got)) == sorted(map(key, want)) and got


def test_places_in_files(spark, tmp_path):
    """Several files, each in several splits: places follow the files' order, whatever the splits."""
    for part, low in (("b", 5000), ("a", 0)):
        rows = spark.range(low, low + 5000, 1, 1).selectExpr("id AS k", "repeat(md5(string(id)), 4) AS x")
        rows.write.option("parquet.block.size", 65536).parquet(f"{tmp_path}/{part}")
        rows.selectExpr("string(k) AS k", "x").write.csv(f"{tmp_path}/csv-{part}", sep="\t", header=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 70000)
    try:
        for scan in (spark.read.parquet(f"{tmp_path}/b", f"{tmp_path}/a"), spark.read.csv([f"{tmp_path}/csv-b", f"{tmp_path}/csv-a"], sep="\t", header=True)):
            assert scan.rdd.getNumPartitions() > 3
            got = tables.numbered(scan)
            assert got.columns == ["k", "x", "pos"] and got.filter("pos != bigint(k)").count() == 0 and got.count() == 10000
        assert tables.numbered(spark.read.parquet(f"{tmp_path}/a").filter("k < 0")).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_lines_are_those_of_files(spark, tmp_path):
    rows = [("S1-1", ' a\t"b" ', "one\ntwo\r\nthree", "NA"), ("S1-2", None, "", "null"), ("S1-3", '"', "x,y", " US "), ("S1-3", '"', "x,y", " US ")]
    df = spark.createDataFrame(rows, tables.RECORD)
    want = sorted(tuple(x or "" for x in r) for r in rows)
    lines = tables.record_lines(df)
    assert sorted(map(tuple, tables.records_from_lines(lines).collect())) == want
    tables.write_records(df, f"{tmp_path}/r", files=1)
    (file,) = (tmp_path / "r").glob("part-*")
    assert sorted(x.line for x in lines.collect()) == sorted([f'S1-1\t" a\t""b"" "\t"one\ntwo\r\nthree"\tNA', "S1-2\t\t\tnull", 'S1-3\t""""\tx,y\t US ', 'S1-3\t""""\tx,y\t US '])
    body = file.read_bytes().decode()
    assert all(x.line in body for x in lines.collect())


def test_pool_in_the_order_of_its_rows(spark):
    s2 = spark.createDataFrame([("S2-b", 0), ("S2-a", 1)], "entity_id string, pos long").withColumns({c: F.lit("x 600001") for c in tables.COLUMNS[1:]})
    s3 = s2.withColumn("entity_id", F.concat(F.lit("S3"), F.col("entity_id")))
    _, pool = linkage.normalized(s2.drop("pos"), s2, s3)
    assert [r.entity_id for r in pool.orderBy("pos").collect()] == ["S2-b", "S2-a", "S3S2-b", "S3S2-a"]


def test_the_last_row_of_the_last_file_counts(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "1.tsv").write_text("source1_entity_id\tmatched_entity_ids\tpos\nS1-1\tS2-9\t7\nS1-2\tS2-3, S2-3\t8\n")
    (tmp_path / "t" / "2.tsv").write_text("source1_entity_id\tmatched_entity_ids\tpos\nS1-1\tS2-1\t9\nS1-1\tS2-2\t1\n")
    got = {r[0]: r[1] for r in tables.read_truth(spark, f"{tmp_path}/t").collect()}
    assert got == {"S1-1": ["S2-2"], "S1-2": ["S2-3"]}


def test_a_tile_of_neighbours_needs_little_memory():
    """Similarities are held a few at a time and answers are arrays: far below the tile's own square."""
    import tracemalloc

    g = np.random.default_rng(1)
    side = lambda name, n: pa.table({name: [f"{name}{i:05}" for i in range(n)], "u": list(g.integers(-3, 4, (n, 4)).astype(float))})
    left, right = side(S1, 3000), side(CAND, 4000)
    a, b = (blocking._unit(t.column("u"), float) for t in (left, right))
    want = {(i, j) for i, row in enumerate((a[::100] @ b.T).round(12)) for j in np.argsort(-row, kind="stable")[:15].tolist()}
    tracemalloc.start()
    try:
        got = blocking._meeting(15, float, 12)(left, right)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    asked = {f"{S1}{i:05}": i // 100 for i in range(0, 3000, 100)}
    assert got.num_rows == 45_000 and peak < 96 << 20
    assert {(asked[x], int(y[-5:])) for x, y in zip(got.column(S1).to_pylist(), got.column(CAND).to_pylist(), strict=True) if x in asked} == want


def test_a_record_has_the_first_words_of_its_text_however_long(spark):
    texts = ["", "  a b", "\t\n", f"{'x' * 300} b c d e f", f" a b {'y' * 90} {'z' * 90} e", "a b c d e f g " * 50, f"a b c d{' ' * 200}e", f"a b c {'d' * 93}e f g", None]
    got = fixtures.records_of(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("lang", F.lit("en"))).collect()
    assert [x.business_name.rsplit(" ", 1)[0].replace(" Pvt", "") for x in sorted(got, key=lambda x: int(x.entity_id[-7:]))] == [" ".join((t or "").split()[:4]) for t in texts]


def test_encoder_candidates_encode_each_record_once(spark, monkeypatch):
    seen, encode = spark.sparkContext.accumulator(0), queries.hashed_encoder()

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    monkeypatch.setattr(queries, "hashed_encoder", lambda: lambda text: encode(counted(text)))
    found = queries.queries()["encoder_candidates"](spark, "/root/testdata/sf0.001").count()
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert found and seen.value == rows


def test_exact_neighbours_shuffle_no_copies_of_vectors(spark):
    """Each vector is dealt once, however many blocks meet; before, it went to every tile of its row or column."""
    g, store = np.random.default_rng(5), spark.sparkContext._jsc.sc().statusStore()
    written = lambda: sum(store.executorList(False).apply(i).totalShuffleWrite() for i in range(store.executorList(False).size()))
    made = lambda p, n: spark.createDataFrame([(f"{p}-{i:05}", x.tolist()) for i, x in enumerate(g.normal(size=(n, 64)))], "entity_id string, embedding array<double>").cache()
    s1, pool = made("S1", 300), made("S2", 1500)
    assert s1.count() + pool.count() == 1800
    began = written()
    assert blocking.knn_candidates(s1, pool, 2, tile=30).count() == 600
    assert 0 < written() - began < 3 * 1800 * 64 * 8

def test_single_precision_chooses_neighbours_without_losing_any():
    """Similarities differ by less than single precision tells, in more columns than a group has."""
    g = np.random.default_rng(3)
    base = g.normal(size=64)
    pool = np.concatenate([base + 1e-7 * g.normal(size=(500, 64)), g.normal(size=(3500, 64)), np.zeros((5, 64))])
    asked = np.concatenate([base[None] + 1e-3 * g.normal(size=(20, 64)), np.zeros((2, 64)), pool[600:640]])
    made = lambda name, m: pa.table({name: [f"{i:05}" for i in range(len(m))], "u": list(m)})
    a, b = (blocking._unit(pa.chunked_array([pa.array(list(m))]), float) for m in (asked, pool))
    want = {(i, j) for i, row in enumerate(np.einsum("id,jd->ij", a, b).round(12)) for j in np.argsort(-row, kind="stable")[:15].tolist()}
    got = blocking._meeting(15, float, 12)(made(S1, asked), made(CAND, pool))
    assert {(int(x), int(y)) for x, y in zip(got.column(S1).to_pylist(), got.column(CAND).to_pylist(), strict=True)} == want
