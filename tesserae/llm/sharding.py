"""Sharding by jump consistent hashing, in DataFrame functions only.

A key walks the jumps 0 = b0 < b1 < b2 ... that its own linear congruential sequence gives; its shard among n
is the last jump below n. The walk does not depend on n, so the shard among n + 1 is either the same or the new
one: appending a shard moves only the rows that the new one takes, and no ring table is kept.

Defined cases: a null key counts as 0; repeated rows and rows with equal keys share a shard and get slots of their own;
a null text has no bytes (size 1, crc32 0); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import running_total, unit_hash

MULTIPLIER = 2862933555777941757  # fixed value of the published algorithm
WIDE, HALF = Decimal(2**64), Decimal(2**33)


def jump_shards(key: Column, counts: list[int]) -> Column:
    """An array with the key's shard for each of the ascending shard counts."""
    if not counts or min(counts) < 1 or counts != sorted(counts):
        raise ValueError("counts must be ascending and positive")
    start = F.struct(
        F.pmod(F.coalesce(key, F.lit(0)).cast("decimal(38,0)"), F.lit(WIDE)).cast("decimal(20,0)").alias("key"),
        F.lit(0).cast("long").alias("jump"),
        *[F.lit(0).cast("long").alias(f"s{n}") for n in counts],
    )

    def step(state: Column, _: Column) -> Column:
        moved = ((state["key"] * F.lit(Decimal(MULTIPLIER)) + F.lit(Decimal(1))) % F.lit(WIDE)).cast("decimal(20,0)")
        high = ((moved - moved % F.lit(HALF)) / F.lit(HALF)).cast("long")
        jump = F.floor((state["jump"] + 1) * (F.lit(float(2**31)) / (high + 1).cast("double"))).cast("long")
        # a walk that has left the largest count stays there, so numbers stay small
        left = state["jump"] >= counts[-1]
        to = F.when(left, state["jump"]).otherwise(F.least(jump, F.lit(counts[-1]).cast("long")))
        return F.struct(
            moved.alias("key"), to.alias("jump"),
            *[F.when(to < n, to).otherwise(state[f"s{n}"]).alias(f"s{n}") for n in counts],
        )

    # each step goes up by one at least, so this many steps leave the range
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(counts[-1])), start, step)
    return F.transform(F.array(walk), lambda w: F.array(*[w[f"s{n}"].cast("int") for n in counts]))[0]


def assign(df: DataFrame, key: str, shards: int, out: str = "shard", grown: str | None = None) -> DataFrame:
    """df with the shard of each row and, where `grown` names a column, its shard with one more."""
    both = df.withColumn("_shards", jump_shards(F.col(key), [shards, shards + 1]))
    both = both.withColumn(out, F.col("_shards")[0])
    return (both.withColumn(grown, F.col("_shards")[1]) if grown else both).drop("_shards")


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law `key`, shard, slot (place in the shard, gapless from 0), grown_shard."""
    utf8 = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(utf8) + 1).cast("long").alias("size"), F.crc32(utf8).alias("text_crc32"))
    rows = assign(rows, "doc_id", shards, "shard", "grown_shard").withColumn("_one", F.lit(1).cast("long"))
    rows = rows.withColumn("_rank", unit_hash(F.col("doc_id"), seed="slot"))
    placed = running_total(rows, ["shard"], "_rank", ["doc_id", "size", "text_crc32"], "_one", "slot")
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
