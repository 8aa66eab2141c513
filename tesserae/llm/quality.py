"""Quality by an interpolated modified Kneser-Ney model of n-grams of UTF-8 bytes, trained on trusted text.

Counts of the highest order come from every trusted document; lower orders count distinct left extensions. Each
order's probabilities are made by joins sharded on context and suffix: count with context sums, and with the next lower
order. Bytes make a closed alphabet, so a table holds what the corpus has of 256**order and grows slowly.

A document's perplexity is per byte. It is accepted where its logarithm lies between two bounds from quantiles of its language, in
trusted documents that the model has not seen (all of them, where a language has fewer than LEAST_TRUSTED). An
allowance for short texts counts on both sides of the comparison.

Tables of up to BROADCAST_ROWS rows go to the executors whole; beyond, documents are dealt into groups, each group
asks for its own distinct n-grams, a join answers, and the group is scored from its answers. Both ways give the same numbers.

Defined cases: a null or empty text has no perplexity and is rejected; a null language is a language of its own;
repeated rows score alike; without trusted text nothing can be told and every text with bytes is accepted; an empty table
gives no rows; long texts are read in slices; other columns are carried along under names of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import Scratch, Shield, small, tidied
from tesserae.llm.wordhash import utf8_slices

ORDER = 5
#: Of so many folds of the trusted documents one is held out: the model does not see it, and it sets the bounds.
FOLDS = 5
#: Quantiles, and how many times as far from the median as the quantile the bound lies. Clean texts of known lines are very likely.
LOW, HIGH = (0.01, 3.0), (0.95, 3.0)
#: A mean over n bytes strays by about 1 / sqrt(n): nats of allowance at one byte, so that short texts are judged alike.
SLACK = 2.0
#: Trusted documents from which on a language has bounds of its own.
LEAST_TRUSTED = 30
#: Rows of all tables of the model that are broadcast at most (12 bytes a row in each worker).
BROADCAST_ROWS = 3_000_000
#: Documents of a group where the model is not broadcast.
GROUP_DOCS = 20_000
#: Bytes of text whose n-grams a worker holds at once, some 100 bytes of memory each.
SLICE = 500_000
#: Stands before the first byte; it occurs in no UTF-8 text.
PAD = 0xFF


def gram_codes(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The code of the n-gram that ends at each byte of each text, and where each text begins (one more at the end)."""
    pad = bytes([PAD]) * (order - 1)
    joined = np.frombuffer(pad + pad.join(texts), dtype=np.uint8).astype(np.int64) if texts else np.zeros(0, dtype=np.int64)
    n = len(joined) - order + 1
    codes = np.zeros(max(n, 0), dtype=np.int64)
    for k in range(order):
        codes = (codes << 8) | joined[k : k + n]
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(lengths)
    own = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat((order - 1) * np.arange(len(texts)), lengths)
    return codes[own], np.concatenate(([0], ends)).astype(np.int64)


class Index:
    """Values by code in two sorted arrays of 12 bytes an entry, searched with whole arrays."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        place = np.argsort(codes)
        self.keys, self.values = codes[place], values[place].astype(np.float32)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each of the ascending codes is held, and its value (0 if not)."""
        if not len(self.keys):
            return np.zeros(len(codes), dtype=bool), np.zeros(len(codes), dtype=np.float32)
        at = np.minimum(np.searchsorted(self.keys, codes), len(self.keys) - 1)
        hit = self.keys[at] == codes
        return hit, np.where(hit, self.values[at], np.float32(0))


class Scorer:
    """Log-probabilities of n-grams from (kind, order, code, value) rows; kind 0: probability, 1: back-off weight."""

    def __init__(self, kind: np.ndarray, order: np.ndarray, code: np.ndarray, value: np.ndarray, top: int):
        pick = lambda k, o: (kind == k) & (order == o)
        self.top = top
        self.prob = {o: Index(code[pick(0, o)], value[pick(0, o)]) for o in range(1, top + 1)}
        self.back = {o: Index(code[pick(1, o)], value[pick(1, o)]) for o in range(1, top + 1)}

    def logs(self, codes: np.ndarray) -> np.ndarray:
        distinct, where = np.unique(codes, return_inverse=True)
        out, todo = np.zeros(len(distinct)), np.arange(len(distinct))
        for order in range(self.top, 0, -1):
            own, back = np.unique(distinct[todo] & ((1 << (8 * order)) - 1), return_inverse=True)
            hit, value = (x[back] for x in self.prob[order].find(own))
            out[todo[hit]] += value[hit]
            contexts, again = np.unique(own[back[~hit]] >> 8, return_inverse=True)
            todo = todo[~hit]
            if not len(todo):
                return out[where]
            out[todo] += self.back[order].find(contexts)[1][again]
        out[todo] -= np.log(256.0)
        return out[where]

    def text_logs(self, texts: pa.Array) -> list[float]:
        """Sum of the log-probabilities of each text's bytes."""
        sums: list[float] = []
        for _, _, raw in utf8_slices(texts, SLICE):
            codes, begins = gram_codes(raw, self.top)
            total = np.concatenate(([0.0], np.cumsum(self.logs(codes))))
            sums += (total[begins[1:]] - total[begins[:-1]]).tolist()
        return sums


def count_grams(texts: DataFrame, order: int) -> DataFrame:
    """code, n: counts of the highest order over all rows of `text`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, counts = [], []
            for _, _, raw in utf8_slices(batch.column(0), SLICE):
                c, n = np.unique(gram_codes(raw, order)[0], return_counts=True)
                codes.append(c)
                counts.append(n)
            if codes:
                c, where = np.unique(np.concatenate(codes), return_inverse=True)
                n = np.bincount(where, weights=np.concatenate(counts)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(n)], names=["code", "n"])

    return texts.select("text").mapInArrow(tidied(run), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the counts of counts 1 to 4."""
    have = {r["n"]: r["m"] for r in counts.where("n <= 4").groupBy("n").agg(F.count("*").alias("m")).collect()}
    n1, n2, n3, n4 = (have.get(k, 0) for k in (1, 2, 3, 4))
    if not n1 or not n2:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.5]
    return tuple(min(max(v, 0.05), k + 0.95) for k, v in enumerate(d))


def train(texts: DataFrame, order: int, scratch: Scratch) -> DataFrame:
    """The model's rows: kind, order, code, value (natural logarithms)."""
    tables = {order: scratch.save(count_grams(texts, order), f"counts{order}")}
    for k in range(order - 1, 0, -1):
        longer = tables[k + 1].select((F.col("code").bitwiseAND(F.lit((1 << (8 * k)) - 1))).alias("code"))
        tables[k] = scratch.save(longer.groupBy("code").agg(F.count("*").alias("n")), f"counts{k}")
    rows, lower = None, None
    for k in range(1, order + 1):
        d1, d2, d3 = discounts(tables[k])
        grams = tables[k].withColumn("context", F.shiftright("code", 8))
        cut = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        contexts = grams.groupBy("context").agg(F.sum("n").alias("total"), (F.sum(cut) / F.sum("n")).alias("back"))
        joined = grams.join(contexts, "context").withColumn("_suffix", F.col("code").bitwiseAND(F.lit((1 << (8 * (k - 1))) - 1)))
        if lower is None:
            joined = joined.withColumn("_lower", F.lit(1 / 256))
        else:
            joined = joined.join(lower.select(F.col("code").alias("_suffix"), F.col("p").alias("_lower")), "_suffix")
        probs = joined.select("code", "context", "back", ((F.col("n") - cut) / F.col("total") + F.col("back") * F.col("_lower")).alias("p"))
        lower = scratch.save(probs, f"probs{k}")
        prob = lower.select(F.lit(0).alias("kind"), F.lit(k).alias("order"), "code", F.log("p").cast("float").alias("value"))
        back = lower.groupBy("context").agg(F.max("back").alias("b")).select(F.lit(1).alias("kind"), F.lit(k).alias("order"), F.col("context").alias("code"), F.log("b").cast("float").alias("value"))
        rows = prob.unionByName(back) if rows is None else rows.unionByName(prob).unionByName(back)
    return rows


def _columns(table: pa.Table) -> tuple[np.ndarray, ...]:
    return tuple(table.column(c).to_numpy() for c in ("kind", "order", "code", "value"))


def add_logs(docs: DataFrame, model: DataFrame, order: int, scratch: Scratch, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """docs with _log, the sum of the log-probabilities of its text's bytes, and _bytes."""
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", _log double, _bytes long"
    place = names.index("text")

    def scored(table, scorer: Scorer):
        texts = table.column(place).combine_chunks() if isinstance(table, pa.Table) else table.column(place)
        more = [pa.array(scorer.text_logs(texts), pa.float64()), pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())]
        kind = pa.Table if isinstance(table, pa.Table) else pa.RecordBatch
        return kind.from_arrays([table.column(i) for i in range(len(names))] + more, names=[*names, "_log", "_bytes"])

    if model.count() <= broadcast_rows:
        shared = docs.sparkSession.sparkContext.broadcast(_columns(model.toArrow()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = Scorer(*shared.value, order)
            for batch in batches:
                yield scored(batch, scorer)

        return docs.mapInArrow(tidied(run), schema)

    groups = -(-docs.count() // GROUP_DOCS)
    dealt = docs.withColumn("_group", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)))

    def asked(table: pa.Table) -> pa.Table:
        found = [np.zeros(0, dtype=np.int64)]
        for _, _, raw in utf8_slices(table.column(place).combine_chunks(), SLICE):
            found.append(np.unique(gram_codes(raw, order)[0]))
        top, kinds, orders, codes = np.unique(np.concatenate(found)), [], [], []
        for k in range(order, 0, -1):
            own = np.unique(top & ((1 << (8 * k)) - 1))
            for kind, c in ((0, own), (1, np.unique(own >> 8))):
                kinds.append(np.full(len(c), kind, dtype=np.int32))
                orders.append(np.full(len(c), k, dtype=np.int32))
                codes.append(c)
        n = sum(map(len, codes))
        group = np.full(n, table.column("_group")[0].as_py() if n else 0, dtype=np.int64)
        return pa.table({"_group": group, "kind": np.concatenate(kinds), "order": np.concatenate(orders), "code": np.concatenate(codes)})

    requests = dealt.groupBy("_group").applyInArrow(asked, "_group long, kind int, order int, code long")
    answers = scratch.save(requests.join(model, ["kind", "order", "code"]), "answers")

    def score_group(own: pa.Table, answer: pa.Table) -> pa.Table:
        return scored(own, Scorer(*_columns(answer), order))

    return dealt.groupBy("_group").cogroup(answers.groupBy("_group")).applyInArrow(score_group, schema)


def add_perplexity(docs: DataFrame, labels: DataFrame, order: int = ORDER, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """docs with _perplexity (null without bytes; 256 without a model), _lower and _upper (its language's bounds) and _accepted."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    trusted = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    trusted = scratch.save(trusted.withColumn("_fold", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS))), "trusted")
    learned = small(trusted.where("_fold > 0").select("doc_id"))
    model = train(docs.join(learned, "doc_id", "left_semi").select("text"), order, scratch)
    scored = add_logs(docs, model, order, scratch, broadcast_rows).withColumn("_perplexity", F.when(F.col("_bytes") > 0, F.exp(-F.col("_log") / F.col("_bytes"))))
    scored = scratch.save(scored.drop("_log", "_bytes"), "scored")
    allowance = SLACK / F.sqrt(F.greatest(F.octet_length("text"), F.lit(1)))
    scored = scored.withColumns({"_high": F.log("_perplexity") - allowance, "_low": F.log("_perplexity") + allowance})
    known = scored.select("doc_id", "lang", "_high", "_low").where("_high is not null").join(small(trusted), "doc_id")
    quantile = lambda c, q: F.percentile_approx(c, q, 100_000)
    # what the model has seen is likelier to it: the upper bound starts from the median of what it has not seen, the spread is that of the many
    seen, unseen = (F.when(F.col("_fold") > 0, F.col("_high")), F.when(F.col("_fold") == 0, F.col("_high")))
    middle = [F.array(quantile("_low", 0.5), quantile("_low", LOW[0]), quantile(seen, 0.5), quantile(seen, HIGH[0]), F.coalesce(quantile(unseen, 0.5), quantile("_high", 0.5))).alias("q"), F.count("*").alias("n")]
    overall = known.agg(*middle).collect()[0]
    found = {r["lang"]: r["q"] for r in known.groupBy("lang").agg(*middle).collect() if r["n"] >= LEAST_TRUSTED}  # one row a language

    def limits(q) -> Column:
        low, high = (q[0] - LOW[1] * (q[0] - q[1]), q[4] + HIGH[1] * ((q[3] or 0.0) - (q[2] or 0.0))) if q else (float("-inf"), float("inf"))
        return F.struct(F.lit(low).alias("low"), F.lit(high).alias("high"))

    limit = limits(overall["q"] if overall["n"] else None)
    for lang, q in found.items():
        limit = F.when(F.col("lang").isNull() if lang is None else F.col("lang").eqNullSafe(F.lit(lang)), limits(q)).otherwise(limit)
    scored = scored.withColumn("_limit", limit)
    inside = (F.col("_low") >= F.col("_limit.low")) & (F.col("_high") <= F.col("_limit.high"))
    scored = scored.withColumns({"_lower": F.exp("_limit.low"), "_upper": F.exp("_limit.high"), "_accepted": F.coalesce(inside, F.lit(False))})
    scratch.keep("scored")
    return scored.drop("_limit", "_high", "_low")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, perplexity, lower, upper, kept of every document."""
    rows = add_perplexity(docs.select("doc_id", "text", "lang"), labels)
    return rows.select("doc_id", F.round("_perplexity", 6).alias("perplexity"), F.round("_lower", 6).alias("lower"), F.round("_upper", 6).alias("upper"), F.col("_accepted").alias("kept"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with their own columns."""
    shield = Shield(docs, ["doc_id", "text", "lang"])
    return shield.back(add_perplexity(shield.df, labels).where("_accepted"))
