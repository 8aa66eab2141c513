"""Cosine of TF-IDF vectors as relations: grams, document frequencies, weights, norms, sums of products.

tf is 1 + ln(count), idf is ln((1 + n) / (1 + df)) + 1, vectors have unit length; a blank text is one blank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def char_grams(x: Column, least: int = 2, most: int = 4) -> Column:
    """Runs of characters, blanks included."""
    def of(n: int) -> Column:
        last = F.length(x) - (n - 1)
        return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(x, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    return F.concat(*[of(n) for n in range(least, most + 1)])


def word_grams(x: Column) -> Column:
    """Words of two characters or more, and their neighbours."""
    words = F.regexp_extract_all(x, F.lit(r"(?U)\b\w\w+\b"), F.lit(0))
    two = F.when(F.size(words) > 1, F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))), lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1))))
    return F.concat(words, F.coalesce(two, F.array().cast("array<string>")))


def vectors(texts: DataFrame, corpus: DataFrame, grams) -> DataFrame:
    """text, gram, weight of each distinct text; frequencies from every row of the corpus (column text)."""
    full = lambda df: df.select(F.lower(F.when(F.trim("text") == "", " ").otherwise(F.col("text"))).alias("_t"), "text")
    n = corpus.agg(F.count("*").alias("_n"))
    df = full(corpus).select(F.explode(F.array_distinct(grams(F.col("_t")))).alias("gram")).groupBy("gram").agg(F.count("*").alias("df"))
    tf = full(texts.select("text").distinct()).select("text", F.explode(grams(F.col("_t"))).alias("gram")).groupBy("text", "gram").agg(F.count("*").alias("tf"))
    # one row with the number of documents
    weighed = tf.join(df, "gram").join(F.broadcast(n)).select("text", "gram", ((1 + F.log("tf")) * (F.log((1 + F.col("_n")) / (1 + F.col("df"))) + 1)).alias("w"))
    norms = weighed.groupBy("text").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighed.join(norms, "text").select("text", "gram", (F.col("w") / F.col("norm")).alias("weight"))


def cosine(pairs: DataFrame, a: str, b: str, corpus: DataFrame, grams, out: str) -> DataFrame:
    """pairs with the cosine of the texts in columns a and b; 0 where they share no gram."""
    both = pairs.select(F.col(a).alias("text")).union(pairs.select(F.col(b).alias("text")))
    v = vectors(both, corpus, grams)
    x, y = v.select(F.col("text").alias("_a"), "gram", F.col("weight").alias("_x")), v.select(F.col("text").alias("_b"), "gram", F.col("weight").alias("_y"))
    wanted = pairs.select(F.col(a).alias("_a"), F.col(b).alias("_b")).distinct()
    dots = wanted.join(x, "_a").join(y, ["_b", "gram"]).groupBy("_a", "_b").agg(F.sum(F.col("_x") * F.col("_y")).alias(out))
    joined = pairs.join(dots, (pairs[a] == dots["_a"]) & (pairs[b] == dots["_b"]), "left").drop("_a", "_b")
    return joined.withColumn(out, F.coalesce(out, F.lit(0.0)))
