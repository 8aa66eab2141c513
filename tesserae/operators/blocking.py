"""Candidate generation: exact keys, number signatures, rare tokens, bounded fuzzy top-k, and their union.

Frequency limits are part of the semantics (a key on too many target records says nothing), and they are applied before
the join, from a pre-aggregated count, so hot keys never meet. Records carry all their usable keys to the join, so that a pair
with several common keys is made once without a distinct over pairs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tesserae.functions.similarity import token_sort_score
from tesserae.functions.text import number_signature, tokens

PAIR = ["source1_entity_id", "candidate_entity_id", "candidate_source"]


def _paired(joined: DataFrame, source: str) -> DataFrame:
    return joined.select("source1_entity_id", "candidate_entity_id", F.lit(source).alias("candidate_source")).distinct()


def exact_key(s1: DataFrame, target: DataFrame, key: str, source: str, least: int, cap: int = 500, by_country: bool = False) -> DataFrame:
    """Equal keys of `least` characters or more that at most `cap` target records have."""
    on = ["_key", "country_norm"] if by_country else ["_key"]
    side = lambda df, name: df.select(F.col("entity_id").alias(name), F.col(key).alias("_key"), *on[1:]).where(F.length("_key") >= least)
    right = side(target, "candidate_entity_id")
    usable = right.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") <= cap).select(*on)
    return _paired(side(s1, "source1_entity_id").join(right.join(usable, on, "left_semi"), on), source)


def exact_name(s1: DataFrame, target: DataFrame, source: str, **options) -> DataFrame:
    return exact_key(s1, target, "business_name_norm", source, 2, **options)


def exact_core(s1: DataFrame, target: DataFrame, source: str, **options) -> DataFrame:
    return exact_key(s1, target, "business_name_core", source, 3, **options)


def exact_address(s1: DataFrame, target: DataFrame, source: str, **options) -> DataFrame:
    return exact_key(s1, target, "business_address_norm", source, 5, **options)


def numeric_address(s1: DataFrame, target: DataFrame, source: str, **options) -> DataFrame:
    signed = lambda df: df.withColumn("_signature", number_signature(F.col("business_address_norm")))
    return exact_key(signed(s1), signed(target), "_signature", source, 3, **options)


def token_frequency(df: DataFrame, column: str, least: int = 4) -> DataFrame:
    """token, n: occurrences, repeats within a record counted."""
    return df.select(F.explode(tokens(F.col(column))).alias("token")).where(F.length("token") >= least).groupBy("token").agg(F.count("*").alias("n"))


def rare_tokens(s1: DataFrame, target: DataFrame, column: str, source: str, cap: int = 1000, least_count: int = 2, least: int = 4) -> DataFrame:
    """Records that share a token that occurs `least_count` to `cap` times in the target."""
    rare = token_frequency(target, column, least).where(F.col("n").between(least_count, cap)).select("token")
    side = lambda df, name: df.select(F.col("entity_id").alias(name), F.explode(F.array_distinct(tokens(F.col(column)))).alias("token")).join(rare, "token", "left_semi")
    return _paired(side(s1, "source1_entity_id").join(side(target, "candidate_entity_id"), "token"), source)


#: Characters counted one by one for the fuzzy pass; all others count as one more.
COUNTED = "abcdefghijklmnopqrstuvwxyz0123456789 "


def character_counts(text: Column) -> Column:
    """How often each of COUNTED occurs, and how many characters are none of them."""
    own = [F.length(text) - F.length(F.replace(text, F.lit(c), F.lit(""))) for c in COUNTED]
    rest = F.length(text) - sum(own[1:], own[0])
    return F.array(*[c.cast("int") for c in (*own, rest)])


def fuzzy(s1: DataFrame, target: DataFrame, column: str, source: str, k: int = 10, cutoff: float = 0.8, first: int = 50_000) -> DataFrame:
    """The k best targets of the same country by token-sort ratio, at `cutoff` or more; ties to the smaller id.

    A ratio of c needs lengths within c / (2 - c) of each other, so pairs are joined on country and a band of lengths: three
    neighbouring bands of the target meet one of S1's and no pair is lost. The common subsequence has at most as many of a
    character as either side: pairs whose counts allow no ratio of c are never scored.
    """
    bound = cutoff / (2 - cutoff)
    order = Window.partitionBy("country_norm").orderBy("entity_id")
    # what a country may contribute is part of the operator; ids give it an order that does not depend on the layout
    left = s1.select("entity_id", "country_norm", F.col(column).alias("_a")).withColumn("_r", F.row_number().over(order)).where((F.col("_r") <= first) & (F.length("_a") >= 4))
    band = lambda c: F.floor(F.log(F.greatest(F.length(c), F.lit(1))) / F.log(F.lit(1 / bound)) + 1e-9)
    left = left.select(F.col("entity_id").alias("source1_entity_id"), "country_norm", "_a", band("_a").alias("_band"), character_counts(F.col("_a")).alias("_ca"))
    right = target.select(F.col("entity_id").alias("candidate_entity_id"), "country_norm", F.col(column).alias("_b")).where(F.length("_b") > 0).withColumn("_cb", character_counts(F.col("_b")))
    right = right.withColumn("_band", F.explode(F.array(*[band("_b") + i for i in (-1, 0, 1)])))
    near = F.least(F.length("_a"), F.length("_b")) >= F.lit(bound - 1e-9) * F.greatest(F.length("_a"), F.length("_b"))
    common = F.aggregate(F.zip_with("_ca", "_cb", lambda x, y: F.least(x, y)), F.lit(0), lambda total, x: total + x)
    enough = 2 * common >= F.lit(cutoff - 1e-9) * (F.length("_a") + F.length("_b"))
    scored = left.join(right, ["country_norm", "_band"]).where(near & enough).withColumn("_score", token_sort_score("_a", "_b")).where(F.col("_score") >= cutoff - 1e-12)
    best = Window.partitionBy("source1_entity_id").orderBy(F.col("_score").desc(), "candidate_entity_id")
    return _paired(scored.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= k), source)


#: Passes that join on keys, each with the mark of its keys: a pair is made by its first common key in the order of marks.
MARKS = {"rare_name": "0", "rare_address": "1", "numeric_address": "2", "exact_core": "3", "exact_name": "4", "exact_address": "5"}


def _keys(only: list[str]) -> Column:
    """All keys of a record for the passes named, marked; a token as often as it occurs."""
    none = F.array().cast("array<string>")
    rare = lambda column: F.coalesce(F.filter(tokens(F.col(column)), lambda w: F.length(w) >= 4), none)
    whole = lambda key, least: F.filter(F.array(key), lambda k: F.length(k) >= least)
    made = {
        "rare_name": rare("business_name_norm"), "rare_address": rare("business_address_norm"), "numeric_address": whole(number_signature(F.col("business_address_norm")), 3),
        "exact_core": whole(F.col("business_name_core"), 3), "exact_name": whole(F.col("business_name_norm"), 2), "exact_address": whole(F.col("business_address_norm"), 5),
    }
    # a second parameter of the function would get the place in the list
    marked = lambda n: F.transform(made[n], lambda k: F.concat(F.lit(MARKS[n]), k))
    return F.concat(*[marked(n) for n in MARKS if n in only])


def sides(s1: DataFrame, targets: dict[str, DataFrame], only: list[str] | None = None, rare_cap: int = 1000, cap: int = 500, parts: int | None = None) -> DataFrame:
    """What `meet` joins: ids of all records with candidate_source (null: the reference) and _keys, the sorted keys on which pairs are made.

    A key counts where the reference has it and a source's records have it often enough and not too often; one of the reference serves
    all sources that it counts for, as none of the others' records keeps it. `parts` gives the number of partitions.
    """
    only = list(MARKS) if only is None else only
    one = lambda df, source: df.select(F.col("entity_id").alias("_id"), F.lit(source).cast("string").alias("candidate_source"), _keys(only).alias("_all"))
    every = one(s1, None)
    for source, target in targets.items():
        every = every.unionByName(one(target, source))
    counted = [F.count_if(F.col("candidate_source") == s).alias(f"_n{i}") for i, s in enumerate(targets)]
    counts = every.select("candidate_source", F.explode("_all").alias("_key")).groupBy("_key").agg(*counted, F.count_if(F.col("candidate_source").isNull()).alias("_own"))
    fits = lambda n: F.when(F.col("_key") < "2", n.between(2, rare_cap)).otherwise(n.between(1, cap))
    within = F.array_compact(F.array(*[F.when(fits(F.col(f"_n{i}")), F.lit(s)) for i, s in enumerate(targets)]))
    usable = counts.where("_own > 0").select("_key", within.alias("_in")).where(F.size("_in") > 0)
    spread = every.select("_id", "candidate_source", F.explode(F.array_distinct("_all")).alias("_key")).join(usable, "_key")
    kept = spread.where(F.col("candidate_source").isNull() | F.array_contains("_in", F.col("candidate_source"))).select("_id", "candidate_source", "_key")
    kept = kept if parts is None else kept.repartition(parts, "_id")
    return kept.groupBy("_id", "candidate_source").agg(F.sort_array(F.collect_set("_key")).alias("_keys"))


def two(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of what `sides` gives. Other columns may be joined to either by its id before they meet: they come along with the pairs."""
    own = keyed.where(F.col("candidate_source").isNull()).select(F.col("_id").alias("source1_entity_id"), "_keys")
    return own, keyed.where(F.col("candidate_source").isNotNull()).select(F.col("_id").alias("candidate_entity_id"), "candidate_source", "_keys")


def meet(left: DataFrame, right: DataFrame, add: Callable[[DataFrame, int], DataFrame] | None = None) -> DataFrame:
    """Each pair with a common key once, made by its first common key, with the other columns of both sides: no pair is shuffled.

    `add` gives a side (1 or 2) further columns after its rows are dealt out by key, so that these are not shuffled either.
    """

    def spread(df: DataFrame, n: int) -> DataFrame:
        every = df.select("*", F.posexplode("_keys").alias("_at", "_key")).withColumn(f"_before_{n}", F.slice("_keys", F.lit(1), F.col("_at"))).drop("_keys", "_at")
        return every if add is None else add(every.repartition("_key"), n)

    both = spread(left, 1).join(spread(right, 2), "_key")
    first = (F.size("_before_1") == 0) | (F.size("_before_2") == 0) | ~F.arrays_overlap("_before_1", "_before_2")
    return both.where(first).drop("_key", "_before_1", "_before_2")


def all_passes(s1: DataFrame, targets: dict[str, DataFrame], only: list[str] | None = None, fuzzy_too: bool = False, rare_cap: int = 1000, ids: DataFrame | None = None) -> DataFrame:
    """The union of the enabled passes over all targets, each pair once; for the given reference ids (source1_entity_id) alone, where given."""
    if ids is not None:
        s1 = s1.join(ids.select(F.col("source1_entity_id").alias("entity_id")), "entity_id", "left_semi")
    keyed = [n for n in MARKS if only is None or n in only]
    found = [meet(*two(sides(s1, targets, keyed, rare_cap))).select(*PAIR)] if keyed else []
    if fuzzy_too:
        fields = {"fuzzy_name": "business_name_norm", "fuzzy_address": "business_address_norm"}
        found += [fuzzy(s1, target, column, source) for source, target in targets.items() for name, column in fields.items() if only is None or name in only]
    every = found[0]
    for one in found[1:]:
        every = every.unionByName(one)
    return every if len(found) == 1 else every.distinct()
