"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents, in a permuted order, form one stream of words that repeats (at most LIMIT times); the
mix takes its first `target` words. The taken part is cut into blocks of BLOCK words: the source's exact block quota.
A binary tree over the output shards splits the vector of quotas: at each node the left child's share of its blocks is
a draw from the multivariate hypergeometric law, so every leaf has exact counts that sum to the quotas and
each shard gets the global mix up to sampling noise. Shard m then owns the next count[m] blocks of each permuted
stream - disjoint by construction - and orders its own blocks by a hash: a local shuffle. What is taken of a document
is the sum of the word ranges that the shards so draw, in the registered query and the pipeline, too.

Defined cases: a null text or one without words has size 0 and is taken 0 times; a null source is a source of its
own, last in order; repeated rows count each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tesserae.llm.common import GAP, Scratch, Shield, n_words, running_total, unit_hash

WEIGHTS = (5, 2, 1)
LIMIT = 3
BLOCK = 256
SHARDS = 8
TREE_SEED = 7
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """source, source_size, target of each source, from one row (source, source_size) a source.

    Weights repeat over the sources by code point, null last. Targets share the whole; none exceeds limit times its
    source, and what exceeds is shared again by weight. The fixed point is a water level: with the sources in the order of
    limit * size / weight, the first k are full, and the rest get level * weight.
    """
    place = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("_i", F.row_number().over(place) - 1)
    rows = rows.withColumn("_w", F.element_at(cycle, (F.col("_i") % len(weights) + 1).cast("int"))).withColumn("_cap", F.col("source_size") * float(limit))
    full = Window.orderBy(F.col("_cap") / F.col("_w"), "_i").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(F.col("_cap") / F.col("_w"), "_i").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    rows = rows.withColumn("_level", (F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(full), F.lit(0.0))) / F.sum("_w").over(rest))
    # the level of the first source that is not full holds for all
    rows = rows.withColumn("_ok", F.col("_level") * F.col("_w") <= F.col("_cap"))
    first = F.min(F.when(F.col("_ok"), F.struct((F.col("_cap") / F.col("_w")).alias("r"), "_i", "_level"))).over(every)
    rows = rows.withColumn("_water", first["_level"])
    return rows.select("source", "source_size", F.least(F.col("_cap"), F.col("_water") * F.col("_w")).alias("target"))


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Exact counts (shards, sources) that sum to the quotas: the splitting tree."""
    counts = np.zeros((shards, len(quotas)), dtype=np.int64)

    def split(lo: int, hi: int, have: np.ndarray) -> None:
        if hi - lo == 1:
            counts[lo] = have
            return
        mid, total = (lo + hi) // 2, int(have.sum())
        take = total * (mid - lo) // (hi - lo)
        rng = np.random.Generator(np.random.PCG64([seed, lo, hi]))
        left, remaining, need = np.zeros_like(have), total, take
        for s, n in enumerate(have):  # the law factors into hypergeometric draws
            got = _hypergeometric(rng, int(n), remaining - int(n), need)
            left[s], remaining, need = got, remaining - int(n), need - got
        split(lo, mid, left)
        split(mid, hi, have - left)

    if shards > 0:
        split(0, shards, np.asarray(quotas, dtype=np.int64))
    return counts


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """The library's sampler up to its range, a rounded normal law within the support beyond."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, draws))
    total = good + bad
    mean = draws * good / total
    spread = (mean * (bad / total) * ((total - draws) / max(1, total - 1))) ** 0.5
    return int(min(high, max(low, round(rng.normal(mean, spread)))))


def block_owners(targets: DataFrame, shards: int, seed: int, block: int) -> DataFrame:
    """targets (source, source_size, target) with _ends: the block before which each shard's own blocks of the source end.

    Only quotas - a number a source - come to the driver, and only counts a shard and source go back.
    """
    quota = F.ceil(F.round("target").cast("long") / F.lit(block)).cast("long")
    rows = targets.withColumn("quota", quota).orderBy(F.col("source").isNull(), "source").collect()
    ends = np.cumsum(split_quotas(np.array([r["quota"] for r in rows], dtype=np.int64), shards, seed), axis=0)
    owned = [(r["source"], r["source_size"], r["target"], ends[:, i].tolist()) for i, r in enumerate(rows)]
    schema = T.StructType([*targets.schema.fields, T.StructField("_ends", T.ArrayType(T.LongType()))])
    return F.broadcast(targets.sparkSession.createDataFrame(owned, schema))


def streams(docs: DataFrame, keep: list[str] | None = None, shards: int = SHARDS, seed: int = TREE_SEED, block: int = BLOCK, **options) -> DataFrame:
    """Each document with size, its source's size, target and _ends, and its place in the source's permuted stream of words.

    Sizes are counted once, into a table in the shared folder; columns to keep come from docs by a join.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), *(keep or []))
    words = sized if keep else scratch.save(sized, "sizes")
    words = words.withColumn("_rank", unit_hash(F.col("doc_id"), seed=SEED))
    targets = source_targets(words.groupBy("source").agg(F.sum("size").alias("source_size")), **options)
    targets = scratch.save(targets.withColumn("target", F.round("target", 6)), "targets")
    return running_total(words, ["source"], "_rank", ["doc_id", "size"], "size", "start", block_owners(targets, shards, seed, block))


def taken_of(limit: int = LIMIT):
    """Words of the document among the first `target` words of the repeated stream."""
    quota = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(quota / F.greatest(F.col("source_size"), F.lit(1)))).otherwise(F.lit(0)).cast("long")
    rest = quota - whole * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start")))
    return whole, (whole * F.col("size") + part).cast("long"), part.cast("long")


def drawn_ranges(turn: Column, most: Column, block: int) -> Column:
    """The word ranges (shard, block, first_word, n_words) that shards draw of the document's first `most` words in a pass.

    A block that no shard owns gives no range.
    """
    at = turn * F.col("source_size") + F.col("start")

    def piece(b: Column) -> Column:
        begin, end = F.greatest(at, b * block), F.least(at + most, (b + 1) * block)
        shard = F.size(F.filter("_ends", lambda e: e <= b))
        return F.struct(shard.alias("shard"), b.alias("block"), (begin - at).alias("first_word"), (end - begin).alias("n_words"))

    blocks = F.sequence(F.floor(at / F.lit(block)).cast("long"), F.floor((at + most - 1) / F.lit(block)).cast("long"))
    own = F.filter(F.transform(blocks, piece), lambda r: r["shard"] < F.size("_ends"))
    return F.when(most > 0, own).otherwise(F.filter(F.transform(F.array(F.lit(0).cast("long")), piece), lambda r: F.lit(False)))


def words_in(ranges: Column) -> Column:
    return F.aggregate(ranges, F.lit(0).cast("long"), lambda n, r: n + r["n_words"])


def drawn_passes(block: int) -> Column:
    """For each pass of the stream over the document: pass, ranges."""
    whole, _, part = taken_of()
    most = lambda e: F.when(e < whole, F.col("size")).otherwise(part)
    return F.transform(F.sequence(F.lit(0).cast("long"), whole), lambda e: F.struct(e.alias("pass"), drawn_ranges(e, most(e), block).alias("ranges")))


def mix_documents(docs: DataFrame, block: int = BLOCK, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words in the ranges that the shards draw."""
    rows = streams(docs, block=block, **options).withColumn("_passes", drawn_passes(block))
    taken = F.aggregate("_passes", F.lit(0).cast("long"), lambda n, p: n + words_in(p["ranges"]))
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed_segments(docs: DataFrame, keep: list[str] | None = None, block: int = BLOCK, **options) -> DataFrame:
    """A row for each pass of the stream over a document, with the ranges that the shards draw of it and their words, n_taken."""
    rows = streams(docs, keep, block=block, **options).withColumn("_p", F.explode(drawn_passes(block)))
    rows = rows.select("*", "_p.pass", F.col("_p.ranges").alias("ranges"), words_in(F.col("_p.ranges")).alias("n_taken"))
    return rows.where("n_taken > 0").drop("_p", "_ends", "_rank")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents, with the columns of docs: a row for each pass over a document; where a source's quota ends
    within a document, its first words only, joined by blanks, with n_chars (if there) of what is left."""
    shield = Shield(docs, ["doc_id", "text", "source", "n_chars"])
    keep = [c for c in shield.df.columns if c not in ("doc_id", "source")]
    rows = mixed_segments(shield.df, keep)
    words = F.filter(F.split("text", GAP), lambda w: w != "")
    first = F.array_join(F.slice(words, F.lit(1), F.col("n_taken").cast("int")), " ")
    cut = F.col("n_taken") < F.col("size")
    rows = rows.withColumn("text", F.when(cut, first).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(cut, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return shield.back(rows)


def mix_to_shards(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, seed: int = TREE_SEED, block: int = BLOCK) -> DataFrame:
    """The mix as word ranges: shard, place (in the shard's own shuffle), doc_id, source, first_word, n_words."""
    found = mixed_segments(docs, block=block, shards=shards, seed=seed).withColumn("_r", F.explode("ranges"))
    place = unit_hash(F.col("source"), F.col("_r.block"), F.lit(seed), seed="place")
    return found.select("_r.shard", place.alias("place"), "doc_id", "source", "pass", "_r.block", "_r.first_word", "_r.n_words")
