"""Quality rules by distribution divergence, in DataFrame operations only.

Two histograms of each document are compared with those of all documents of its language by Jensen-Shannon distance (base 2,
from 0 to 1): character classes, and the language's most common words with one bin for all others. Short texts have noisy
histograms, so a distance counts only from MIN_WORDS words on and its threshold is wider for shorter texts. Base rules on length and
repetition come first.

All per-document work stays in one narrow stage: words, windows and histograms are arrays. Repeated windows are found by sorting
(hash, position) keys, and neighbours with equal hashes are confirmed by their words. Only the references are shuffled: counts of
distinct words for each language, pre-aggregated, which give the class counts and the common words alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import aside, back, cut

#: Common words for each language, and the slots of their lookup table (of words that share a slot, the rarer go to a list beside it).
COMMON, SLOTS = 64, 8192
#: Distances above which a text is rejected, for long texts; SLACK / sqrt(words) is added.
MIN_WORDS, MAX_CLASSES, MAX_WORDS, SLACK = 50, 0.2, 0.35, 1.0
#: Languages whose references are broadcast: their tables take at most SLOTS * MOST_LANGUAGES short strings.
MOST_LANGUAGES = 512
CLASSES = ("upper", "letter", "digit", "space", "point", "symbol")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


#: Bits for a window's place in a text; places beyond go another way.
PLACE_BITS = 26


def _classed(docs: DataFrame) -> DataFrame:
    """docs with the text (null: empty), its length and its class counts.

    Runs of lower-case letters go first and spaces next, so that the other classes are counted over the few characters left.
    """
    counted = lambda pattern: F.regexp_count("_r2", F.lit(pattern))
    step = docs.withColumn("_t", F.coalesce("text", F.lit("")))
    step = step.withColumn("_r1", F.regexp_replace("_t", r"\p{Ll}+", ""))
    step = step.withColumn("_r2", F.replace("_r1", F.lit(" "), F.lit("")))
    return step.withColumns(
        {
            "_n": F.length("_t"),
            "_upper": counted(r"\p{Lu}"),
            "_letter": F.length("_t") - F.length("_r1") + counted(r"[\p{L}\p{M}&&[^\p{Lu}]]"),
            "_digit": counted(r"\p{Nd}"),
            "_space": F.length("_r1") - F.length("_r2") + counted(r"[\x09-\x0D]"),
            "_point": counted(r"[.,;:!?'\"()\[\]-]"),
            "_symbol": counted("[#*$%&|<>]"),
        }
    ).drop("_r1", "_r2")


def _measured(docs: DataFrame, bits: int = PLACE_BITS) -> DataFrame:
    """docs with the base measures, words and class counts. Windows are sorted by a hash above `bits` bits of their place; a text with more places, or with hashes that collide, has the windows themselves sorted."""
    step = _classed(docs).withColumn("_w", F.expr(r"filter(split(_t, '[\\x20\\x09-\\x0D]+'), x -> x != '')"))
    step = step.withColumns(
        {
            "n_words": F.size("_w").cast("long"),
            "_lines": F.expr(r"filter(split(_t, '\n', -1), x -> rlike(x, '[^\\x20\\x09-\\x0D]'))"),
            "_keys": F.expr(f"sort_array(transform(if(size(_w) < 3, cast(array() as array<int>), sequence(0, size(_w) - 3)), i -> (shiftleft(xxhash64(_w[i], _w[i + 1], _w[i + 2]), {bits}) | cast(i as bigint))))"),
        }
    )
    step = step.withColumn("_near", F.expr(f"filter(if(size(_keys) < 2, cast(array() as array<int>), sequence(0, size(_keys) - 2)), j -> shiftrightunsigned(_keys[j] ^ _keys[j + 1], {bits}) = 0)"))
    step = step.withColumn("_pairs", F.expr(f"transform(_near, j -> array(cast(_keys[j] & {(1 << bits) - 1} as int), cast(_keys[j + 1] & {(1 << bits) - 1} as int)))"))
    same = " and ".join(f"_w[p[0] + {i}] = _w[p[1] + {i}]" for i in range(3))
    # neighbours that only share the hash's bits may lie between equal windows
    step = step.withColumn("_windows", F.expr(f"if(if(size(_keys) > {1 << bits}, true, exists(_pairs, p -> not ({same}))), sort_array(transform(sequence(0, size(_w) - 3), i -> struct(_w[i] as a, _w[i + 1] as b, _w[i + 2] as c, i as i))), null)"))
    equal = " and ".join(f"_windows[j].{x} = _windows[j + 1].{x}" for x in "abc")
    exact = f"transform(filter(sequence(0, size(_windows) - 2), j -> {equal}), j -> array(_windows[j].i, _windows[j + 1].i))"
    step = step.withColumn("_at", F.expr(f"array_sort(array_distinct(flatten(if(_windows is null, _pairs, {exact}))))"))
    return step.withColumns(
        {
            "word_chars": (F.col("_n") - F.col("_space")).cast("long"),
            "n_symbols": F.col("_symbol").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.expr("aggregate(transform(_at, (p, j) -> least(3, coalesce(get(_at, j + 1), p + 3) - p)), 0L, (s, x) -> s + x)"),
        }
    ).drop("_lines", "_keys", "_near", "_pairs", "_windows", "_at")


def _shares() -> F.Column:
    """The class histogram, as shares; the last class is all other characters."""
    known = [F.col(f"_{c}") for c in CLASSES]
    rest = F.greatest(F.lit(0), F.col("_n") - sum(known[1:], known[0]))
    return F.array(*(x.cast("double") for x in (*known, rest)))


def references(docs: DataFrame) -> DataFrame:
    """For each language (null is one): class counts, the lookup table of common words, and their shares.

    One pass over the texts counts the distinct words of each language; what a class has in words follows from those, and white space
    is what the words leave of the texts' lengths.
    """
    own = docs.select(F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("_t"))
    lengths = own.groupBy("lang").agg(F.sum(F.length("_t")).alias("n"))
    word = own.select("lang", F.explode(F.split("_t", r"[\x20\x09-\x0D]+")).alias("word")).filter("word != ''")
    counts = word.groupBy("lang", "word").agg(F.count("*").alias("k"))
    each = _classed(counts.withColumn("text", F.col("word")))
    classes = (F.sum(F.col("k") * F.col(f"_{c}")).alias(f"c{i}") for i, c in enumerate(CLASSES))
    in_words = each.groupBy("lang").agg(F.sum("k").alias("total"), F.sum(F.col("k") * F.col("_n")).alias("chars"), *classes)
    lower = counts.groupBy("lang", F.lower("word").alias("word")).agg(F.sum("k").alias("n"))
    sums = lengths.join(in_words.withColumnRenamed("lang", "_l"), F.col("lang").eqNullSafe(F.col("_l")), "left").drop("_l").na.fill(0, ["total", "chars", *(f"c{i}" for i in range(len(CLASSES)))])
    sums = sums.withColumn(f"c{CLASSES.index('space')}", F.col("n") - F.col("chars"))
    known = [F.col(f"c{i}") for i in range(len(CLASSES))]
    size = F.greatest(F.col("n"), F.lit(1))
    classes = sums.select("lang", "total", F.array(*((x / size).cast("double") for x in known), (F.greatest(F.lit(0), F.col("n") - sum(known[1:], known[0])) / size).cast("double")).alias("class_ref"))
    slot = F.pmod(F.xxhash64("word"), F.lit(SLOTS)).cast("int")
    top = lower.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "word"))).filter(F.col("rank") <= COMMON)
    listed = top.withColumn("slot", slot).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "slot", "word", "n"))).alias("top"))
    out = classes.join(listed.withColumnRenamed("lang", "_l"), F.col("lang").eqNullSafe(F.col("_l")), "left").select("lang", "class_ref", "top", "total")
    held = "transform(top, x -> x.slot)"
    table = f"transform(sequence(0, {SLOTS - 1}), s -> array_position({held}, s) - 1)"
    beside = f"transform(filter(top, (x, i) -> array_position({held}, x.slot) != i + 1), x -> x.rank - 1)"
    return out.select(F.col("lang").alias("_lang"), "class_ref", F.expr("transform(top, x -> x.word)").alias("common"), F.expr("array_max(transform(top, x -> length(x.word)))").alias("widest"), F.expr("transform(top, x -> x.n / total)").alias("common_ref"), F.expr(f"transform({table}, x -> cast(x as int))").alias("slots"), F.expr(beside).alias("beside"))


def _js(p: str, q: str) -> str:
    """One bin's share of the Jensen-Shannon divergence in bits; 0 where both are 0."""
    part = lambda x: f"if({x} > 0, {x} * log2(2 * {x} / ({p} + {q})), 0d)"
    return f"(0.5d * ({part(p)} + {part(q)}))"


def quality(docs: DataFrame) -> DataFrame:
    """docs with MEASURES, base_failed, class_distance, word_distance and kept.

    A null text is empty; texts under MIN_WORDS words fail the base rules. Documents without a language are compared with each other.
    Rows are judged one by one, so repeated rows get equal verdicts; columns of docs with one of the new names are replaced.
    """
    made = (*MEASURES, "base_failed", "class_distance", "word_distance", "kept")
    columns = docs.columns
    docs = aside(docs, text="text", lang="lang")
    ref = cut(references(docs.select("text", "lang")))
    measured = _measured(docs)
    languages = ref.count()
    if languages <= MOST_LANGUAGES:
        joined = measured.join(F.broadcast(ref), F.col("lang").cast("string").eqNullSafe(F.col("_lang")), "left")
    else:  # a salted join: no language's texts meet in one task
        salted = ref.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(255))))
        joined = measured.withColumn("_s", F.pmod(F.xxhash64("text"), F.lit(256))).join(salted, F.col("lang").cast("string").eqNullSafe(F.col("_lang")) & (F.col("_s") == F.col("_salt")), "left").drop("_s", "_salt")
    p, q = "(x / greatest(_n, 1))", "class_ref[i]"
    joined = joined.withColumn("_hist", _shares()).withColumn("class_distance", F.expr(f"sqrt(greatest(0d, aggregate(transform(_hist, (x, i) -> {_js(p, q)}), 0d, (s, x) -> s + x)))"))
    # numbers of the document's common words, sorted; the ends of their runs give the counts
    # no lower-case form is shorter than its word, so longer words than the widest common one are none
    joined = joined.withColumn("_lower", F.expr("transform(filter(_w, x -> length(x) <= widest), x -> lower(x))"))
    joined = joined.withColumn("_slot", F.expr(f"transform(_lower, x -> slots[cast(pmod(xxhash64(x), {SLOTS}) as int)])"))
    joined = joined.withColumn("_c", F.expr("sort_array(filter(transform(_slot, (k, j) -> if(k < 0, -1, if(common[k] = _lower[j], k, if(size(beside) = 0, -1, coalesce(get(filter(beside, b -> common[b] = _lower[j]), 0), -1))))), k -> k >= 0))"))
    joined = joined.withColumn("_ends", F.expr("filter(sequence(0, size(_c)), j -> j > 0 and (j = size(_c) or _c[j] != _c[j - 1]))"))
    joined = joined.withColumn("_runs", F.expr("transform(_ends, (e, j) -> struct(_c[e - 1] as k, (e - coalesce(get(_ends, j - 1), 0)) / greatest(n_words, 1) as p))"))
    seen = f"aggregate(transform(_runs, r -> {_js('r.p', 'common_ref[r.k]')}), 0d, (s, x) -> s + x)"
    absent = "(aggregate(common_ref, 0d, (s, x) -> s + x) - aggregate(transform(_runs, r -> common_ref[r.k]), 0d, (s, x) -> s + x))"
    joined = joined.withColumn("_po", F.expr("greatest(0d, 1 - size(_c) / greatest(n_words, 1))")).withColumn("_qo", F.expr("greatest(0d, 1 - aggregate(common_ref, 0d, (s, x) -> s + x))"))
    joined = joined.withColumn("word_distance", F.expr(f"coalesce(sqrt(greatest(0d, {seen} + 0.5d * {absent} + {_js('_po', '_qo')})), 0d)"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    slack = F.lit(SLACK) / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    fine = (F.col("class_distance") <= MAX_CLASSES + slack) & (F.col("word_distance") <= MAX_WORDS + slack)
    return joined.select(*back(columns, made), *MEASURES, failed.alias("base_failed"), "class_distance", "word_distance", (~failed & fine).alias("kept"))
