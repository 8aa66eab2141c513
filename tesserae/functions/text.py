"""Cleaning of names, addresses and countries as column expressions.

Everything is built in but for NFKD, which Spark lacks: one Arrow function, shared by all columns of a projection.
Missing values are empty strings; nulls are taken as empty.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Legal forms in the order in which they are removed (order matters: a shorter form may break a longer one).
LEGAL_FORMS = (
    "private limited", "pvt ltd", "pvt. ltd.", "pvt. ltd", "pvt ltd.", "p. ltd.", "p.ltd", "(p) ltd", "(p) limited",
    "public limited", "incorporated", "corporation", "unlimited", "limited", "private", "company", "llp", "llc",
    "l.l.c.", "l.l.c", "l.l.p.", "l.l.p", "corp.", "corp", "inc.", "inc", "ltd.", "ltd", "pvt.", "pvt", "co.", "co",
    "plc", "s.a.", "s.a", "s.a.r.l.", "s.a.r.l", "sarl", "sas", "gmbh", "ag", "bv", "nv", "oy", "ab", "as",
)
# Address abbreviations and what they stand for, in order.
ABBREVIATIONS = {
    "st": "street", "rd": "road", "ave": "avenue", "blvd": "boulevard", "dr": "drive", "ln": "lane", "ct": "court",
    "pl": "place", "pkwy": "parkway", "hwy": "highway", "fwy": "freeway", "ste": "suite", "fl": "floor", "flr": "floor",
    "bldg": "building", "apt": "apartment", "no": "number", "near": "near", "opp": "opposite", "opps": "opposite",
    "nth": "north", "sth": "south", "est": "east", "wst": "west",
}
# Characters that become a blank, and characters that go.
BLANKED = "/\\|-–—(){}[],;:!?"
DROPPED = "\"'`«»"

#: Python's white space: Java's Unicode class and the four separators that only Python counts.
SPACE = r"(?U)[\s\x1c-\x1f]+"
@F.arrow_udf(T.StringType())
def _nfkd(values):
    import pyarrow.compute as pc

    return pc.utf8_normalize(values, "NFKD")


def text(x: Column | str) -> Column:
    return F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit(""))


def strip_accents(x: Column) -> Column:
    return F.regexp_replace(_nfkd(x), r"\p{Mn}", "")


def squeeze(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, SPACE, " "))


def punctuation(x: Column) -> Column:
    """& spelled out, separators and brackets blanked, quotes dropped, full stops kept."""
    return F.translate(F.replace(x, F.lit("&"), F.lit(" and ")), BLANKED + DROPPED, " " * len(BLANKED))


def normal(x: Column) -> Column:
    return squeeze(punctuation(F.lower(strip_accents(x))))


def plain_name(normalised: Column) -> Column:
    """Of a normalised text, without full stops before a blank or the end."""
    return squeeze(F.regexp_replace(normalised, r"(?U)\.(?=\s|$)", " "))


_FORMS = [re.compile(rf"\b{re.escape(w)}\b") for w in LEGAL_FORMS]
_ANY_FORM = re.compile("|".join(f.pattern for f in _FORMS))
_SHORT = re.compile(r"\b(?:" + "|".join(ABBREVIATIONS) + r")\b")


def without_forms(name: str) -> str:
    """The name without legal forms, removed in order, again until nothing changes."""
    before = None
    while before != name and _ANY_FORM.search(name):
        before = name
        for form in _FORMS:
            name = form.sub(" ", name)
        name = " ".join(name.split())
    return name


def expanded(address: str) -> str:
    """Abbreviations spelled out: whole words that never overlap and whose expansions are no abbreviations."""
    return " ".join(_SHORT.sub(lambda m: ABBREVIATIONS[m[0]], address).split())


def _each(values, change):
    """change on each distinct value of an Arrow array."""
    import pyarrow as pa

    coded = values.dictionary_encode()
    words = pa.array([change(v) for v in coded.dictionary.to_pylist()], pa.string())
    return words.take(coded.indices)


# A chain of 46 replacements outgrows the size that generated code may have, so the two lists run in Arrow batches.
@F.arrow_udf(T.StringType())
def core_name(values):
    return _each(values, without_forms)


@F.arrow_udf(T.StringType())
def expand_address(values):
    return _each(values, expanded)


def tokens(x: Column) -> Column:
    return F.filter(F.split(x, SPACE), lambda t: t != "")


def numbers(x: Column) -> Column:
    return F.regexp_extract_all(x, F.lit(r"(?U)\d+"), F.lit(0))


def long_numbers(x: Column) -> Column:
    return F.filter(numbers(x), lambda t: F.length(t) >= 3)


def number_signature(x: Column) -> Column:
    return F.array_join(F.sort_array(long_numbers(x)), "-")


def blank(x: Column) -> Column:
    return (squeeze(x) == "").cast("int")


def clean(source: DataFrame) -> DataFrame:
    """The source with its raw columns, the normalised strings, missing flags, lengths and token counts."""
    name, address, country = text("business_name"), text("business_address"), text("country")
    df = source.withColumns({"_name": normal(name), "_address": normal(address), "_country": squeeze(F.lower(strip_accents(country)))})
    df = df.withColumn("business_name_norm", plain_name(F.col("_name")))
    return df.withColumns({
        "business_name_core": core_name(F.col("business_name_norm")), "business_address_norm": expand_address(F.col("_address")),
        "country_norm": F.col("_country"),
        "name_missing": blank(name), "address_missing": blank(address), "country_missing": blank(country),
        "name_char_length": F.length(name), "address_char_length": F.length(address),
        "name_token_count": F.size(tokens(name)), "address_token_count": F.size(tokens(address)),
    }).drop("_name", "_address", "_country")
