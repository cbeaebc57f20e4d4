"""Phrase collocations: n-gram counts by language, scored by their weakest cut.

Words and pairs become rows that are counted by (language, phrase), with partial sums before the shuffle. A longer n-gram occurs no more often
than its two parts of one word less, so level by level only those become rows whose parts both occur often enough. A bit set of bounded size stands
for the frequent parts and lets through a few more, which their count then drops: no frequent phrase is lost. Phrases
that occur often enough meet the counts of their two parts at each cut by joins, scores are whole numbers of exact decimals, a
phrase that mostly occurs inside a longer one goes by an anti-join with the one-word extensions, and a window ranks the rest.

A null text has no words, a null language is `und`. Repeated rows count as often as they occur; an empty table, or one without frequent
phrases, gives no rows; other columns are ignored. N-grams leave their piece one by one, so no row holds those of a long one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The most bits of the set of frequent parts, which each task holds (32 MB), and its words of 64 bits in a row.
MOST_BITS, WORDS = 1 << 28, 16


def _words(docs: DataFrame) -> DataFrame:
    """(lang, w, i): the words of each piece of docs (lang, text), once for each place i in it."""
    lower = F.translate(F.coalesce("text", F.lit("")), _UPPER, _UPPER.lower())
    pieces = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.explode(F.split(lower, r"[.,;:!?\x0A-\x0D]+")).alias("piece"))
    bare = pieces.select("lang", F.btrim("piece", F.lit(" \t")).alias("piece")).filter("piece != ''")
    words = bare.select("lang", F.split("piece", r"[\x20\x09]+").alias("w"))
    return words.select("lang", "w", F.explode(F.sequence(F.lit(0), F.size("w") - 1)).alias("i"))


def _key(n: int, first: int = 0) -> Column:
    """The key of the n words from place i + first: space-joined, a tab (no word has one) and the language; null beyond the end."""
    word = lambda j: F.get("w", F.col("i") + j)
    return F.concat(word(first), *(x for j in range(first + 1, first + n) for x in (F.lit(" "), word(j))), F.lit("\t"), "lang")


def ngrams(docs: DataFrame, max_n: int) -> DataFrame:
    """(key): a row for each n-gram of 1 to max_n words of docs (lang, text)."""
    return _words(docs).select(F.explode(F.array(*(_key(n) for n in range(1, max_n + 1)))).alias("key")).filter("key is not null")


def longer_ngrams(docs: DataFrame, n: int, often: DataFrame) -> DataFrame:
    """(key): a row for each n-gram of docs of which both parts of n - 1 words are among the keys of often, and for few others."""
    bits = 1 << min(MOST_BITS.bit_length() - 1, max(16, (8 * often.count()).bit_length()))
    slot = lambda key: F.pmod(F.xxhash64(key), F.lit(bits))
    at = often.select(slot("key").alias("slot")).select(F.expr(f"slot div {64 * WORDS}").alias("row"), F.expr("slot div 64").alias("word"), F.expr("shiftleft(1L, cast(slot % 64 as int))").alias("bit"))
    held = at.groupBy("row", "word").agg(F.bit_or("bit").alias("bit")).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct((F.col("word") % WORDS).cast("int").alias("word"), "bit"))).alias("held"))
    table = cut(held.select("row", F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda j: F.coalesce(F.try_element_at("held", j), F.lit(0).cast("long"))).alias("bits")))
    rows = _words(docs).filter(F.col("i") + n <= F.size("w"))
    for first in (0, 1):
        rows = rows.withColumn("slot", slot(_key(n - 1, first))).withColumn("row", F.expr(f"slot div {64 * WORDS}"))
        rows = rows.join(F.broadcast(table), "row").filter(f"getbit(bits[cast(slot div 64 % {WORDS} as int)], cast(slot % 64 as int)) = 1").select("lang", "w", "i")
    return rows.select(_key(n).alias("key"))


def phrase_counts(docs: DataFrame, max_n: int, least: int) -> DataFrame:
    """(lang, phrase, f, words): phrases of up to max_n words with at least `least` occurrences, and the words among all occurrences; a null phrase of each language holds its rare words."""
    space, tab = F.instr("key", " "), F.instr("key", "\t")
    lang, phrase = F.expr("substring(key, instr(key, '\t') + 1)").alias("lang"), F.substring_index("key", "\t", 1).alias("phrase")
    counted = ngrams(docs, min(2, max_n)).groupBy("key").agg(F.count("*").alias("f"))
    seen = counted.filter((F.col("f") >= least) | (space == 0) | (space > tab))  # a rare word still counts for n
    split = seen.select(lang, phrase, "f")
    single = F.when(~F.col("phrase").contains(" "), F.col("f"))
    often = cut(split.groupBy("lang", F.when(F.col("f") >= least, F.col("phrase")).alias("phrase")).agg(F.sum("f").alias("f"), F.sum(single).alias("words")))
    parts = often.filter("phrase like '% %'").select(F.concat("phrase", F.lit("\t"), "lang").alias("key"))
    for n in range(3, max_n + 1):
        found = cut(longer_ngrams(docs, n, parts).groupBy("key").agg(F.count("*").alias("f")).filter(F.col("f") >= least))
        often, parts = often.unionByName(found.select(lang, phrase, "f", F.lit(None).cast("long").alias("words"))), found.select("key")
    return often


def _part(words: str, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, max_n: int = 3, least: int = 10, inside: int = 50, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases of 2 to max_n words of docs (text, lang).

    a counts the phrase, l and r the parts of the cut with the lowest score floor(10**6 * a * a / (l * r)), the earliest of equals. A phrase goes if some
    longer phrase that holds it has at least `inside` percent of its occurrences: then the one-word extension between them has, too, so
    those decide. Counts up to 10**12 keep the decimals exact.
    """
    counts = phrase_counts(docs, max_n, least)
    n = counts.groupBy("lang").agg(F.sum("words").alias("n"))
    known = counts.filter("phrase is not null").select("lang", "phrase", "f")
    of = known.withColumn("words", F.split("phrase", " ")).filter(F.size("words") > 1).withColumnRenamed("f", "a")
    cuts = of.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part("words", F.lit(1), F.col("k")).alias("head"), _part("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("tail"))
    part = lambda name, value: known.select("lang", F.col("phrase").alias(name), F.col("f").alias(value))
    score = F.expr("cast((cast(1000000 as decimal(7, 0)) * cast(a as decimal(19, 0)) * cast(a as decimal(19, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0))) as long)")
    scored = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"]).withColumn("score", score)
    weakest = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "cut.*")
    ends = F.array(_part("words", F.lit(1), F.size("words") - 1), _part("words", F.lit(2), F.size("words") - 1))
    longer = of.filter(F.size("words") > 2).select("lang", F.explode(ends).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    alone = weakest.join(longer, (weakest.lang == longer.lang) & (weakest.phrase == longer.phrase) & (100 * F.col("longest") >= inside * weakest.a), "left_anti")
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = alone.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
