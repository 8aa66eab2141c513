"""The 44 features of a pair, from the cleaned strings of both sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.functions import similarity as S
from tesserae.functions.text import long_numbers, numbers, tokens

#: Columns that are no features; _many tells whether an id of the pair has several records.
ID_COLUMNS = ("source1_entity_id", "candidate_entity_id", "candidate_source", "is_match", "_many")


def _both(field: str) -> tuple[Column, Column]:
    return F.col(f"{field}_1"), F.col(f"{field}_2")


def _flag(condition: Column) -> Column:
    return condition.cast("int")


#: Lists without repeats that features compare: those of a record are made once, before it meets others.
WORDS = {
    "name_words": ("business_name_norm", tokens), "address_words": ("business_address_norm", tokens), "numbers": ("business_address_norm", numbers), "long_numbers": ("business_address_norm", long_numbers),
}


def with_words(rows: DataFrame, *sides: int) -> DataFrame:
    """The lists of the sides given (1, 2), unless rows has them."""
    made = {f"{k}_{n}": F.array_distinct(make(F.col(f"{column}_{n}"))) for n in sides for k, (column, make) in WORDS.items() if f"{k}_{n}" not in rows.columns}
    return rows.withColumns(made) if made else rows


def with_common(rows: DataFrame) -> DataFrame:
    """The lists of both sides, and how many elements they share."""
    return with_words(rows, 1, 2).withColumns({f"_{k}_common": S.shared(*_both(k)) for k in WORDS})


def _strings(kind: str, a: Column, b: Column) -> dict[str, Column]:
    words = (*_both(f"{kind}_words"), F.col(f"_{kind}_words_common"))
    return {
        f"{kind}_jaccard": S.jaccard(*words), f"{kind}_containment": S.containment(*words), f"{kind}_token_overlap_ratio": S.overlap(*words),
        f"{kind}_common_token_count": S.common(*words), f"{kind}_length_diff_norm": S.length_difference(a, b),
        f"{kind}_length_ratio": S.length_ratio(a, b), f"{kind}_missing": _flag((a == "") | (b == "")),
    }


SEQUENCES = {"levenshtein_sim": "ratio", "jaro_winkler": "wratio", "partial_ratio": "partial", "token_sort_ratio": "token_sort", "token_set_ratio": "token_set"}


def _sequences(kind: str) -> dict[str, Column]:
    return {f"{kind}_{name}": F.col(f"_{kind}.{field}") for name, field in SEQUENCES.items()}


def name_features() -> dict[str, Column]:
    a, b = _both("business_name_norm")
    c, d = _both("business_name_core")
    return {"name_exact": _flag((a == b) & (a != "")), "name_core_exact": _flag((c == d) & (c != "")), **_sequences("name"), **_strings("name", a, b)}


def address_features() -> dict[str, Column]:
    return {**_sequences("address"), **_strings("address", *_both("business_address_norm"))}


def numeric_features() -> dict[str, Column]:
    (x, y), (p, q) = _both("numbers"), _both("long_numbers")
    both, both_long = F.col("_numbers_common"), F.col("_long_numbers_common")
    return {
        "numeric_token_jaccard": S.jaccard(x, y, both), "numeric_token_overlap": S.overlap(x, y, both), "digit_seq_jaccard": S.jaccard(p, q, both_long),
        "has_exact_digit_match": _flag(both_long > 0), "numeric_count_diff": F.abs(F.size(x) - F.size(y)).cast("double"),
        "has_numeric_conflict": _flag((F.size(x) > 0) & (F.size(y) > 0) & (both == 0)),
    }


def country_features() -> dict[str, Column]:
    a, b = _both("country_norm")
    return {"country_match": _flag((a == b) & (a != "")), "country_missing": _flag((a == "") | (b == ""))}


def structural_features() -> dict[str, Column]:
    a, b = _both("business_name_norm")
    return {
        "source_is_s2": _flag(F.col("candidate_source") == "S2"), "source_is_s3": _flag(F.col("candidate_source") == "S3"),
        "same_first_char": _flag((a != "") & (b != "") & (F.substring(a, 1, 1) == F.substring(b, 1, 1))),
    }


def interaction_features() -> dict[str, Column]:
    n, a = F.col("_name.token_set"), F.col("_address.token_set")
    return {"name_x_address_sim": n * a, "min_name_address_sim": F.least(n, a), "max_name_address_sim": F.greatest(n, a)}


TFIDF = ("name_char_tfidf", "name_word_tfidf", "address_char_tfidf", "address_word_tfidf")


def with_scores(records: DataFrame, name: tuple[str, ...] = S.SCORES, address: tuple[str, ...] = S.SCORES) -> DataFrame:
    """The lists, and the sequence scores asked for of names and addresses, each pair of strings of a batch scored once."""
    records = with_common(records)
    made = {f"_{kind}": S.scores(*_both(column), fields) for kind, column, fields in (("name", "business_name_norm", name), ("address", "business_address_norm", address)) if fields}
    return records.withColumns(made) if made else records


def features(records: DataFrame, as_float: bool = True) -> DataFrame:
    """Id columns and the features in alphabetical order. TF-IDF features are 0 unless records already has them."""
    made = name_features() | address_features() | numeric_features() | country_features() | structural_features() | interaction_features()
    made |= {c: F.col(c) if c in records.columns else F.lit(0.0) for c in TFIDF}
    kind = "float" if as_float else "double"
    ids = [c for c in ID_COLUMNS if c in records.columns]
    return with_scores(records).select(*ids, *[made[c].cast(kind).alias(c) for c in sorted(made)])


def feature_names(df: DataFrame) -> list[str]:
    return sorted(c for c in df.columns if c not in ID_COLUMNS)
