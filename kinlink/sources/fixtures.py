"""Record tables made from other tables or from nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.classes import Classes
from .lineage import once

# The legal suffixes that the fixture's names end in, by id.
SUFFIXES = ("Pvt Ltd", "Ltd", "Corp", "Inc", "LLC", "Co")
#: Characters of a text that mostly hold its first words.
HEAD = 100


def records_of(documents: DataFrame) -> DataFrame:
    """Business records derived from documents (doc_id, text, lang): entity_id, business_name, business_address, country, and the first 30 characters of the text as stem."""
    # Four words are read: a text's first HEAD characters have them if they have five, else the text is split, an empty word may come before the four and the rest of the text after.
    words = lambda text: F.filter(F.split(text, r"[ \t\n\r\f]+", 6), lambda t: t != "")
    text = F.coalesce("text", F.lit(""))
    head = words(F.substring(text, 1, HEAD))
    w = F.when(F.size(head) > 4, head).otherwise(words(text))
    size = lambda i: F.coalesce(F.char_length(F.get("w", F.lit(i))), F.lit(0))
    base = documents.select("doc_id", "lang", F.substring("text", 1, 30).alias("stem"), w.alias("w"))
    base = base.withColumn("k", (37 * size(0) + 101 * size(1) + 13 * size(2)) % 300)
    code = F.when(F.col("lang") == "de", (600000 + F.col("k")).cast("string")).when(F.col("lang") == "en", (60000 + F.col("k")).cast("string")).when(F.col("lang") == "fr", (75000 + F.col("k")).cast("string")).otherwise("no code")
    country = F.when(F.col("lang") == "en", "US").when(F.col("lang") == "de", "India").when(F.col("lang") == "fr", "France").otherwise("")
    suffix = F.element_at(F.array(*map(F.lit, SUFFIXES)), (F.col("doc_id") % 6 + 1).cast("int"))
    near = F.when(F.col("doc_id") % 5 == 0, ", Near SBI ATM").otherwise("")
    return base.select(
        F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"), F.lit("-"), F.lpad(F.col("doc_id").cast("string"), 7, "0")).alias("entity_id"),
        F.concat(F.array_join(F.slice("w", 1, 4), " "), F.lit(" "), suffix).alias("business_name"),
        F.concat((F.col("doc_id") % 99 + 1).cast("string"), F.lit(" Gandhi Rd, City"), (F.col("doc_id") % 50).cast("string"), F.lit(", "), code, near).alias("business_address"),
        country.alias("country"),
        "stem",
    )


def sides(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The queries (S1) and the pool (S2 before S3, in order of id)."""
    pool = records.filter(~F.col("entity_id").startswith("S1-"))
    return records.filter(F.col("entity_id").startswith("S1-")), pool.withColumn("pos", F.col("entity_id"))


def stress_records(spark: SparkSession, prefix: str, rows: int, common: float = 0.6) -> DataFrame:
    """Records of which a share has one very frequent word in its name."""
    i = F.col("id").cast("string")
    often = F.pmod(F.xxhash64("id"), F.lit(1000)) < int(common * 1000)
    return spark.range(rows).select(
        F.concat(F.lit(prefix + "-"), F.lpad(i, 7, "0")).alias("entity_id"),
        F.concat(F.lit("maker"), i, F.when(often, " harbour works").otherwise(" studio")).alias("business_name"),
        F.concat(F.lit("Quay "), i, F.lit(", Port "), (F.col("id") % 64).cast("string"), F.lit(" "), (700000 + F.col("id") % 1024).cast("string")).alias("business_address"),
        F.lit("India").alias("country"),
    )


def sampled(source1: DataFrame, pool: DataFrame, truth: DataFrame | Classes, rows: int = 5000, matched: float = 0.944, noise: int = 3, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A smaller set: rows S1 records with the given share of matched ones, all their true matches and noise times as many other pool records.

    Which ones follows a hash of the id and the seed. truth has (source1_entity_id, candidate_entity_id), or is given by Classes: then only the chosen records' pairs are made.
    """
    order = lambda c: F.md5(F.concat_ws("|", F.col(c), F.lit(str(seed))))
    with_match = source1.join((truth.totals() if isinstance(truth, Classes) else truth).select(F.col("source1_entity_id").alias("entity_id")).distinct(), "entity_id", "left_semi")
    without = source1.join(with_match.select("entity_id"), "entity_id", "left_anti")
    n = round(rows * matched)
    queries = with_match.orderBy(order("entity_id"), "entity_id").limit(n).unionByName(without.orderBy(order("entity_id"), "entity_id").limit(rows - n))
    if isinstance(truth, Classes):
        own = truth.source1.join(once(queries.select("entity_id")), "entity_id", "left_semi")
        kept = once(Classes(own, truth.pool, truth.key).pairs())
    else:
        kept = truth.join(queries.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi")
    ids = kept.select(F.col("candidate_entity_id").alias("entity_id")).distinct()
    true_rows = pool.join(ids, "entity_id", "left_semi")
    others = pool.join(ids, "entity_id", "left_anti").orderBy(order("entity_id"), "entity_id").limit(noise * ids.count())
    return queries, true_rows.unionByName(others), kept


def made_records(spark: SparkSession, rows: int, seed: int = 0, matched: float = 0.7, noise: int = 15) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(S1, S2, S3, truth pairs) from nothing: names of two words with a legal suffix, Indian or US addresses; a share of the S1 records has one or two lightly rewritten matches.

    Everything follows hashes of the row's number and the seed, so any number of rows is made in parallel and alike each time.
    """
    pick = lambda tag, n: F.pmod(F.xxhash64(F.col("id"), F.lit(tag), F.lit(seed)), F.lit(n)).cast("int")
    word = lambda tag, *values: F.element_at(F.array(*map(F.lit, values)), pick(tag, len(values)) + 1)
    first = word("first", "Amber", "Birch", "Cobalt", "Dune", "Ember", "Fjord", "Granite", "Heron")
    second = word("second", "Bakery", "Cartography", "Dyeworks", "Glassworks", "Joinery", "Nursery", "Pottery", "Tannery")
    india = pick("country", 2) == 0
    number = (pick("number", 99) + 1).cast("string")
    base = spark.range(rows).select(
        "id", F.concat_ws(" ", first, second, F.col("id").cast("string")).alias("name"), word("suffix", *SUFFIXES).alias("suffix"), india.alias("india"), number.alias("number"),
        F.when(india, (600000 + pick("code", 900)).cast("string")).otherwise((60000 + pick("code", 900)).cast("string")).alias("code"), pick("matches", 1000).alias("m"), pick("side", 2).alias("side"), pick("two", 3).alias("two"),
    )
    country = F.when(F.col("india"), "India").otherwise("US").alias("country")
    key = lambda prefix: F.concat(F.lit(prefix), F.lpad(F.col("id").cast("string"), 7, "0")).alias("entity_id")
    road = lambda long: F.concat_ws(" ", "number", F.when(F.col("india"), "Lantern Road," if long else "Lantern Rd").otherwise("Orchard St," if long else "Orchard Street"), "code").alias("business_address")
    s1 = base.select(key("S1-"), F.concat_ws(" ", "name", "suffix").alias("business_name"), road(True), country)
    has = F.col("m") < int(matched * 1000)
    other = F.regexp_replace(F.regexp_replace(F.concat_ws(" ", "name", "suffix"), "Pvt Ltd$", "Private Limited"), "Ltd$", "Limited").alias("business_name")
    in2, in3 = has & ((F.col("side") == 0) | (F.col("two") == 0)), has & ((F.col("side") == 1) | (F.col("two") == 0))
    extra = lambda prefix: spark.range(noise).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("entity_id"), F.concat(F.lit("Stray Workshop "), F.col("id").cast("string")).alias("business_name"), F.lit("77 Nowhere Lane").alias("business_address"), F.lit("US").alias("country"))
    side = lambda prefix, where: base.filter(where).select(key(prefix), other, road(False), country).unionByName(extra(f"{prefix}N"))
    pairs = lambda prefix, where: base.filter(where).select(key("S1-").alias("source1_entity_id"), key(prefix).alias("candidate_entity_id"))
    return s1, side("S2-", in2), side("S3-", in3), pairs("S2-", in2).unionByName(pairs("S3-", in3))
