"""Cleaning and exact matching of records that arrive: additions, the batch operators unchanged.

Cleaning holds no state; matching joins the stream with a static, cleaned reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.functions.text import clean
from tesserae.sources.files import SOURCE


def read_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = ", ".join(f"{c} string" for c in SOURCE)
    return spark.readStream.schema(schema).option("sep", "\t").option("header", True).csv(folder).na.fill("")


def match_stream(stream: DataFrame, reference: DataFrame, key: str = "business_name_core", least: int = 3) -> DataFrame:
    """Pairs of arriving records and reference entities with equal keys."""
    arriving = clean(stream).where(F.length(key) >= least).select(F.col("entity_id").alias("candidate_entity_id"), key)
    return arriving.join(reference.select(F.col("entity_id").alias("source1_entity_id"), key), key).select("source1_entity_id", "candidate_entity_id")


def write_stream(df: DataFrame, out: str, checkpoint: str):
    """Exactly-once Parquet files of what has arrived so far."""
    return df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
