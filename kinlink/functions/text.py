"""Normalisation of names and addresses."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Canonical forms of words in names.
NAME_FORMS = {
    "corp": "corporation",
    "co": "company",
    "ltd": "limited",
    "pvt": "private",
    "incorporated": "inc",
    "industries": "ind",
    "enterprises": "ent",
    "associates": "assoc",
    "bros": "brothers",
    "mfg": "manufacturing",
    "intl": "international",
    "grp": "group",
}
# Words without weight in a name's core.
GENERIC = (
    "a", "an", "and", "assoc", "brothers", "co", "company", "corporation", "ent", "group", "inc", "ind", "international",
    "limited", "llc", "llp", "manufacturing", "of", "plc", "private", "the",
)
# Full forms of words in addresses.
ADDRESS_FORMS = {
    "apt": "apartment",
    "ave": "avenue",
    "bldg": "building",
    "blvd": "boulevard",
    "cir": "circle",
    "ct": "court",
    "dr": "drive",
    "fl": "floor",
    "hwy": "highway",
    "ln": "lane",
    "nr": "near",
    "opp": "opposite",
    "rd": "road",
    "sec": "sector",
    "st": "street",
    "ste": "suite",
}
#: What Unicode calls white space, as a character class.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_EDGE = (r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])")
# Fixed value: words that a landmark follows, and its length.
LANDMARK = _EDGE[0] + r"(?i:near|opposite|opp\.?|behind|next to|adjacent to)" + SPACE + r"+((?i)[a-z0-9 ]{3,40})"
PIN = _EDGE[0] + r"(\p{Nd}{6})" + _EDGE[1]
ZIP = _EDGE[0] + r"(\p{Nd}{5})(?:-\p{Nd}{4})?" + _EDGE[1]


@F.pandas_udf(T.StringType())
def strip_accents(text: pd.Series) -> pd.Series:
    """Compatibility decomposition without combining marks; ASCII passes as it is."""

    def plain(x: str | None) -> str | None:
        if x is None or x.isascii():
            return x
        return "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))

    return text.map(plain)


def _mapped(forms: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in forms.items() for x in pair))


def _folded(raw: Column) -> Column:
    trimmed = F.regexp_replace(F.coalesce(raw, F.lit("")), rf"^{SPACE}+|{SPACE}+$", "")
    return F.replace(strip_accents(F.lower(trimmed)), F.lit("&"), F.lit(" and "))


def words(text: Column) -> Column:
    """The words of a normalised text, '' has none."""
    return F.filter(F.split(text, " "), lambda t: t != "")


def normalize_name(raw: Column) -> Column:
    """Folded, letters, digits and underscores only, legal forms in one spelling."""
    clean = F.regexp_replace(_folded(raw), r"[^\p{L}\p{N}_]+", " ")
    forms = _mapped(NAME_FORMS)
    return F.array_join(F.transform(words(clean), lambda t: F.coalesce(F.try_element_at(forms, t), t)), " ")


def core_tokens(name: Column) -> Column:
    """Distinct words of a normalised name but the generic and one-letter ones; all of them if none is left."""
    every = F.array_distinct(words(name))
    core = F.filter(every, lambda t: ~t.isin(*GENERIC) & (F.char_length(t) > 1))
    return F.when(F.size(core) > 0, core).otherwise(every)


def normalize_address(raw: Column) -> Column:
    """Folded, commas stay; a word touches its comma, so it is cut at spaces and commas alike before its full form is looked up."""
    clean = F.trim(F.regexp_replace(_folded(raw), r"[^\p{L}\p{N}_,]+", " "))
    forms = _mapped(ADDRESS_FORMS)
    parts = F.split(clean, r"(?<=[ ,])|(?=[ ,])")
    return F.array_join(F.transform(parts, lambda t: F.coalesce(F.try_element_at(forms, t), t)), "")


def postal_code(raw: Column, country: Column) -> Column:
    """The first six- or five-digit code the country has; elsewhere the six-digit one before the other; '' if there is none."""
    raw, where = F.coalesce(raw, F.lit("")), F.lower(F.trim(F.regexp_replace(F.coalesce(country, F.lit("")), SPACE, " ")))
    pin, zip_ = F.regexp_extract(raw, PIN, 1), F.regexp_extract(raw, ZIP, 1)
    return F.when(where == "india", pin).when(where == "us", zip_).when(pin != "", pin).otherwise(zip_)


def landmark(raw: Column) -> Column:
    return F.trim(F.regexp_extract(F.coalesce(raw, F.lit("")), LANDMARK, 1))


def embedding_text(name: Column, address: Column) -> Column:
    return F.concat_ws(" [SEP] ", F.coalesce(name, F.lit("")), F.coalesce(address, F.lit("")))


def normalize(records: DataFrame, name: str = "business_name", address: str = "business_address", country: str = "country") -> DataFrame:
    """records with name_norm, name_core_tokens, addr_norm, postal_code and landmark."""
    made = records.withColumns(
        {
            "name_norm": normalize_name(F.col(name)),
            "addr_norm": normalize_address(F.col(address)),
            "postal_code": postal_code(F.col(address), F.col(country)),
            "landmark": landmark(F.col(address)),
        }
    )
    return made.withColumn("name_core_tokens", core_tokens(F.col("name_norm")))


def id_list(cell: Column) -> Column:
    """The trimmed, non-blank entries of a comma-separated cell."""
    cleaned = F.transform(F.split(F.coalesce(cell, F.lit("")), ","), lambda x: F.regexp_replace(x, rf"^{SPACE}+|{SPACE}+$", ""))
    return F.filter(cleaned, lambda x: x != "")


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)
