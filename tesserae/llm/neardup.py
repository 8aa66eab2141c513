"""Near-duplicates by bottom-k sketches: inverted lists, union-sketch estimates, exact Jaccard.

1. A document's shingles are hashed once; its sketch is the K smallest values. Documents with equal sets (two
   independent 64-bit fingerprints and the size agree) are one node, stood for by its smallest doc_id.
2. Documents whose Jaccard similarity is t or more share at least `least_shared` sketch values (exactly so while sketches hold
   whole sets, but for less than one link in 10**10 beyond). So, with values ordered from rare to frequent, it suffices
   to index each node's first (size - least_shared + 1): the prefix. Passages that many documents share are frequent and fall out.
3. In each inverted list the node with the most shared values is the centre; the others are paired with it (a star, never
   all pairs). Estimates of the union's sketch filter (two sets that sketches hold whole are compared exactly);
   full sets, made again from the texts, verify.
4. Verified links give components; lists whose nodes lie in one component are done. Nodes of the others (a small rest) are
   compared by full sets: prefixes that are exact for each class of sizes give the pairs of different components that may
   still be similar. Each node tries its nearest partners first, components are made anew, and pairs that they hold need no
   look; what rounds leave is verified whole. So no link that joins components is lost.

Nothing of a size that grows with the corpus comes to the driver. Hot values, centres and copies are pre-aggregated
or meet in joins that adaptive execution splits.

Defined cases: texts that are null or have no word have an empty set, are linked with nothing and are kept; fewer words than a
shingle make one shingle; repeated rows are exact copies; a null doc_id counts as larger than any other; rows under one doc_id
are told apart by their texts; an empty table gives no rows; very long texts are hashed block by block; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import Scratch, Shield, small, tidied
from tesserae.llm.wordhash import BLOCK, set_prints, shingle_sets, utf8_slices

#: Values that a sketch retains.
RETAINED = 64
#: Ratio of neighbouring classes of size.
CLASS = 1.02
#: Rounds in which each node of the rest tries the nearest of PARTNERS parts of its partners, before all that are left are compared.
TRIES, PARTNERS = 1, 4
#: Numbers of 64 bits that tell how much two full sets differ at least.
BITS = 16
#: Values by which two prefixes tell whether they have met before.
HEAD = 64
#: Probability with which a link may share fewer sketch values than least_shared says.
MISS = 1e-10


def least_shared(threshold: Fraction, retained: int) -> int:
    """The largest c with P(Binomial(retained, threshold) < c) <= MISS (sampling without replacement spreads less)."""
    p, total = float(threshold), 0.0
    for c in range(retained + 1):
        total += math.comb(retained, c) * p**c * (1 - p) ** (retained - c)
        if total > MISS:
            return c
    return retained


SKETCHES = "doc_id long, text_key long, n_shingles long, node long, proof long, sketch array<long>"


def keyed(docs: DataFrame) -> DataFrame:
    """docs with text_key, a hash of the text: with doc_id (as long) it names a row, and rows that share both are equal in text."""
    return docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text_key": F.xxhash64(F.coalesce("text", F.lit("")))})


def sketches(docs: DataFrame, words: int, retained: int = RETAINED) -> DataFrame:
    """doc_id, text_key, n_shingles, node and proof (fingerprints of the set; null if empty), sketch (ascending)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
        for batch in batches:
            for lo, hi, texts in utf8_slices(batch.column(2)):
                sets = shingle_sets(texts, words)
                prints = [set_prints(s) if len(s) else (None, None) for s in sets]
                columns = (batch.column(0)[lo:hi], batch.column(1)[lo:hi], [len(s) for s in sets], [p[0] for p in prints], [p[1] for p in prints], [s[:retained] for s in sets])
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "text_key", "n_shingles", "node", "proof", "sketch"])

    rows = keyed(docs.select("doc_id", "text")).select("doc_id", "text_key", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(tidied(run), SKETCHES)


def verified(pairs: DataFrame, words: int, threshold: Fraction) -> DataFrame:
    """Of pairs (a, b, text_a, text_b), those with the similarity, on full sets: a, b."""
    num, den = threshold.numerator, threshold.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            bytes_of = [pc.binary_length(batch.column(i)).to_numpy(zero_copy_only=False) for i in (2, 3)]
            sizes, lo = np.cumsum(bytes_of[0] + bytes_of[1]), 0
            while lo < len(a):
                hi = max(lo + 1, int(np.searchsorted(sizes, (int(sizes[lo - 1]) if lo else 0) + BLOCK)))
                left, right = (batch.column(i).slice(lo, hi - lo).cast(pa.binary()).to_pylist() for i in (2, 3))
                distinct = list(dict.fromkeys(left + right))  # a centre occurs in many pairs
                sets, keep = dict(zip(distinct, shingle_sets(distinct, words))), []
                for x, y in zip(left, right):
                    x, y = sets[x], sets[y]
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(same > 0 and den * same >= num * (len(x) + len(y) - same))
                mask = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([c.slice(lo, hi - lo).filter(mask) for c in (a, b)], names=["a", "b"])
                lo = hi

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(tidied(run), "a long, b long")


def full_sets(texts: DataFrame, words: int) -> DataFrame:
    """node, n, values (every shingle of each text), bits: for each of 64 * BITS classes of values whether it holds an odd number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in utf8_slices(batch.column(1)):
                sets = shingle_sets(texts, words)
                odd = np.array([np.bincount(x & (64 * BITS - 1), minlength=64 * BITS) & 1 for x in sets], dtype=np.uint8).reshape(len(sets), 64 * BITS)
                bits = np.packbits(odd, axis=1).view(np.int64)
                columns = [batch.column(0).slice(lo, hi - lo), pa.array([len(x) for x in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64())), pa.array(list(bits), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "values", "bits"])

    return texts.mapInArrow(tidied(run), "node long, n long, values array<long>, bits array<long>")


def exact_candidates(sets: DataFrame, labels: DataFrame, threshold: Fraction, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of nodes of different components that may be similar, by prefixes of full sets and classes of size.

    For sizes x >= y, similar sets share o = ceil(t / (1 + t) * (x + y)) shingles or more, so the first x - o + 1 and y - o + 1
    in the common order (rare first) meet. The smaller one is indexed under its class of size, for which x = y is the
    worst case; the larger asks each class down to t * x, with a prefix for that class alone. Of the values in which two
    prefixes meet, the first gives the pair, as far as the HEAD first values of both tell; beyond, distinct() does. Two sets
    differ in at least as many values as their bits differ in, so a pair whose bits differ too much is no candidate.
    """
    num, den = threshold.numerator, threshold.denominator
    sets = scratch.save(sets, "sets")
    shingles = sets.select("node", "n", F.explode("values").alias("value"))
    often = shingles.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    met = shingles.join(often, "value").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("met"))
    met = scratch.save(met.join(labels, "node").join(sets.select("node", "bits"), "node"), "met")
    scratch.drop("sets")

    def need(x: Column, y: Column) -> Column:
        return F.floor((num * (x + y) + num + den - 1) / F.lit(num + den))

    n, log = F.col("n"), math.log(CLASS)
    size_class = lambda size: F.floor(F.log(size) / F.lit(log) + 1e-9)
    alone = n - F.size("met")

    def prefixes(rows: DataFrame, upto: Column) -> DataFrame:
        """A row for each value of rank 1 to upto, with the first values among them."""
        rows = rows.withColumn("_met", F.slice("met", F.lit(1), F.greatest(F.least(upto - alone, F.size("met")), F.lit(0)).cast("int")))
        rows = rows.withColumn("head", F.transform(F.slice("_met", 1, HEAD), lambda m: m["value"]))
        rows = rows.select("node", "n", "component", "bits", "_class", "head", alone.alias("_alone"), F.posexplode("_met").alias("_at", "m"))
        return rows.select("node", "n", "component", "bits", "_class", "head", F.col("m.value").alias("value"), (F.col("_alone") + F.col("_at") + 1).alias("rank"))

    index = prefixes(met.withColumn("_class", size_class(n)), n - need(n, n) + 1)
    index = index.select("value", "_class", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("rank").alias("rb"), F.col("component").alias("cb"), F.col("head").alias("hb"), F.col("bits").alias("bb"))
    least = F.ceil(n * num / F.lit(den))
    asked = met.withColumn("_class", F.explode(F.sequence(size_class(least), size_class(n))))
    asked = prefixes(asked, n - need(n, F.greatest(least, F.floor(F.pow(F.lit(CLASS), F.col("_class")) - 1e-6))) + 1)
    asked = asked.select("value", "_class", F.col("node").alias("a"), F.col("n").alias("na"), F.col("rank").alias("ra"), F.col("component").alias("ca"), F.col("head").alias("ha"), F.col("bits").alias("ba"))
    shared = need(F.col("na"), F.col("nb"))
    fits = (F.col("ca") != F.col("cb")) & (F.col("nb") * den >= F.col("na") * num) & ((F.col("nb") < F.col("na")) | ((F.col("nb") == F.col("na")) & (F.col("b") < F.col("a"))))
    fits = fits & (F.col("ra") <= F.col("na") - shared + 1) & (F.col("rb") <= F.col("nb") - shared + 1)
    # both heads are in the common order, so the first value of their meet is the first in which the prefixes meet
    fits = fits & (F.coalesce(F.get(F.array_intersect("ha", "hb"), F.lit(0)), F.col("value")) == F.col("value"))
    differ = sum((F.bit_count(F.get("ba", F.lit(i)).bitwiseXOR(F.get("bb", F.lit(i)))) for i in range(BITS)), F.lit(0))
    fits = fits & (differ <= F.col("na") + F.col("nb") - 2 * shared)
    return asked.join(index, ["value", "_class"]).where(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def shared_in_union(a: Column, b: Column, retained: int) -> Column:
    """How many of the union's `retained` smallest values both sketches hold."""
    return F.size(F.array_intersect(F.array_intersect(F.slice(F.array_sort(F.array_union(a, b)), 1, retained), a), b))


def components(edges: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """node, component (its smallest node) of every node of the undirected edges (a, b).

    Each round hooks nodes to their smallest neighbour, follows the pointers twice and contracts the graph; rounds go on
    until no edge joins two components.
    """
    current = scratch.save(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), f"{tag}-edges")
    maps: list[DataFrame] = []
    while not current.isEmpty():
        k = len(maps)
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min("b").alias("_least")).select(F.col("a").alias("node"), F.least("a", "_least").alias("parent"))
        for _ in range(2):
            up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("_up"))
            parent = parent.join(up, "parent").select("node", F.col("_up").alias("parent"))
        parent = scratch.save(parent, f"{tag}-parent{k}")
        pa_, pb_ = parent.select(F.col("node").alias("a"), F.col("parent").alias("_a")), parent.select(F.col("node").alias("b"), F.col("parent").alias("_b"))
        merged = current.join(pa_, "a").join(pb_, "b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
        current = scratch.save(merged.where("a < b").distinct(), f"{tag}-edges{k}")
        maps.append(parent)
    if not maps:
        return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = maps[0].select("node", F.col("parent").alias("component"))
    for later in maps[1:]:
        step = later.select(F.col("node").alias("component"), "parent")
        found = found.join(step, "component", "left").select("node", F.coalesce("parent", "component").alias("component"))
    return scratch.save(found, f"{tag}-components")


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["rep"]) & (a["text_key"] == b["rep_key"])


def named_nodes(all_docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """held (a row for each distinct set: node, rep, rep_key, n, sketch) and ids (doc_id, text_key, n_shingles, node).

    A set is known by both fingerprints and its size. Sets of one first fingerprint get names of their own, until none clash.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_key").alias("key")))
    sets = all_docs.where("node is not null").groupBy("node", "proof", F.col("n_shingles").alias("n")).agg(first.alias("_r"), F.first("sketch").alias("sketch"))
    held = scratch.save(sets.select("node", "proof", "n", F.col("_r.id").alias("rep"), F.col("_r.key").alias("rep_key"), "sketch"), "held")
    ids = scratch.save(all_docs.drop("sketch"), "ids")
    scratch.drop("sketches")  # the largest table; held has each set's sketch
    turn = 0
    while not (clashes := held.groupBy("node").agg(F.count("*").alias("_n")).where("_n > 1").select("node")).isEmpty():
        clashes, turn = scratch.save(clashes.withColumn("_clash", F.lit(True)), f"clashes{turn}"), turn + 1
        renamed = lambda rows, n: rows.join(clashes, "node", "left").withColumn("node", F.when(F.col("_clash"), F.xxhash64("node", "proof", n, F.lit(turn))).otherwise(F.col("node"))).drop("_clash")  # noqa: B023, E731
        held, ids = scratch.save(renamed(held, "n"), f"held{turn}"), scratch.save(renamed(ids, "n_shingles"), f"ids{turn}")
    return held.drop("proof"), ids.drop("proof")


def linked(docs: DataFrame, words: int = 5, threshold: Fraction = Fraction(8, 10), retained: int = RETAINED, node_bits: int = 64) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id (smallest doc_id reachable by links), kept.

    node_bits, of the first fingerprint of a set, is below 64 only in tests.
    """
    scratch = Scratch(docs.sparkSession, "neardup")
    t, shared = float(threshold), least_shared(threshold, retained)
    sketched = sketches(docs, words, retained)
    if node_bits < 64:
        sketched = sketched.withColumn("node", F.when(F.col("node").isNotNull(), F.floor(F.col("node") / F.lit(2.0 ** (64 - node_bits)))))
    held, ids = named_nodes(scratch.save(sketched, "sketches"), scratch)

    # values that two nodes hold; a node's other values are its rarest and need no list
    entries = held.select("node", "n", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    often = scratch.save(entries.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"), "often")
    met = entries.join(often, "value").groupBy("node", "n", "size").agg(F.collect_list(F.struct("df", "value")).alias("met"))
    whole = F.floor(F.lit(retained + 1) * t)  # below, any partner's sketch is its whole set, too
    num, den = threshold.numerator, threshold.denominator
    must = F.when(F.col("n") < whole, F.floor((F.col("n") * num + den - 1) / den)).otherwise(F.lit(shared))
    prefix = (F.col("size") - must + 1 - (F.col("size") - F.size("met"))).cast("int")
    kept = F.when(prefix > 0, F.slice(F.array_sort("met"), F.lit(1), F.greatest(prefix, F.lit(1))))
    lists = scratch.save(met.select("node", F.size("met").alias("common"), F.explode(kept).alias("m")).select("node", "common", F.col("m.value").alias("value")), "lists")
    scratch.drop("often")
    many = lists.groupBy("value").agg(F.count("*").alias("_n")).where("_n > 1").select("value")
    open_lists = scratch.save(lists.join(many, "value", "left_semi"), "open")
    scratch.drop("lists")
    # what can have a partner: the sets that the rounds below read again and again
    compared = scratch.save(held.join(open_lists.select("node").distinct(), "node", "left_semi"), "compared")

    def texts_of(some: DataFrame, tag: str) -> DataFrame:
        """node, text of its document with the smallest id."""
        reps = scratch.save(some.join(compared, "node").select("node", "rep", "rep_key"), f"{tag}-reps")
        rows = keyed(docs.select("doc_id", "text"))
        own = rows.join(small(reps), same_row(rows, reps))
        return scratch.save(own.dropDuplicates(["node"]).select("node", "text"), f"{tag}-texts")

    def hopeful(pairs: DataFrame, tag: str) -> DataFrame:
        """Candidate pairs (a, b) that sizes and the estimate leave, with near, the share of the sketches that both hold."""
        left = compared.select(F.col("node").alias("a"), F.col("sketch").alias("sa"), F.col("n").alias("na"))
        right = compared.select(F.col("node").alias("b"), F.col("sketch").alias("sb"), F.col("n").alias("nb"))
        rows = pairs.join(left, "a").join(right, "b")
        both = shared_in_union(F.col("sa"), F.col("sb"), retained)
        union = F.size(F.array_union("sa", "sb"))
        # sketches of two small sets are the sets: their similarity is exact
        whole_sets = (F.col("na") <= retained) & (F.col("nb") <= retained)
        sound = F.when(whole_sets, F.size(F.array_intersect("sa", "sb")) * den >= union * num).otherwise(both >= shared)
        rows = rows.where(F.least("na", "nb") * den >= F.greatest("na", "nb") * num).where(sound)
        return scratch.save(rows.select("a", "b", (both / F.least(union, F.lit(retained))).alias("near")), f"{tag}-pairs")

    def confirm(pairs: DataFrame, tag: str) -> DataFrame:
        """Of hopeful pairs the links, on full sets."""
        texts = texts_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), tag)
        a, b = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        links = scratch.save(verified(pairs.join(a, "a").join(b, "b"), words, threshold), f"{tag}-links")
        scratch.drop(f"{tag}-texts")
        return links

    def settled(pairs: DataFrame, links: DataFrame) -> DataFrame:
        """Components of the links and of those among the hopeful pairs.

        Each node first tries the nearest of its partners; pairs that come to lie in one component need no look any more.
        """
        for turn in range(TRIES):
            ends = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "near"))
            best = ends.groupBy("a", F.pmod(F.xxhash64("b", F.lit(turn)), F.lit(PARTNERS)).alias("_part")).agg(F.max(F.struct("near", "b")).alias("_m")).select("a", F.col("_m.b").alias("b"))
            best = scratch.save(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"try{turn}-best")
            links = links.unionByName(confirm(best, f"try{turn}"))
            found = components(links, scratch, f"try{turn}")
            ca, cb = found.select(F.col("node").alias("a"), F.col("component").alias("ca")), found.select(F.col("node").alias("b"), F.col("component").alias("cb"))
            apart = pairs.join(ca, "a", "left").join(cb, "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b"))
            pairs = scratch.save(apart.select("a", "b", "near").join(best, ["a", "b"], "left_anti"), f"try{turn}-left")
            if pairs.isEmpty():
                return found
        return components(links.unionByName(confirm(pairs, "rest")), scratch, "rest")

    # stars: each list's nodes with the one that shares most
    centre = open_lists.groupBy("value").agg(F.max(F.struct("common", "node")).alias("c")).select("value", F.col("c.node").alias("b"))
    pairs = open_lists.join(centre, "value").where("node <> b").select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
    links = confirm(hopeful(pairs, "star"), "star")
    found = components(links, scratch, "star")
    told = open_lists.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = told.groupBy("value").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi")).where("_lo < _hi").select("value")
    rest = scratch.save(told.join(mixed, "value", "left_semi").select("node", "component").distinct(), "rest")
    if not rest.isEmpty():
        sets = full_sets(texts_of(rest.select("node"), "rest-sets"), words)
        found = settled(hopeful(exact_candidates(sets, rest, threshold, scratch), "rest"), links)
    least = F.min(F.struct(F.col("rep").isNull().alias("none"), F.col("rep").alias("id"), F.col("rep_key").alias("key")))
    of = held.select("node", "rep", "rep_key").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = of.groupBy("component").agg(least.alias("_first")).select("component", F.col("_first.id").alias("component_id"), F.col("_first.key").alias("component_key"))
    named = scratch.save(of.join(first, "component").select("node", "component_id", "component_key"), "named")
    out = ids.join(named, "node", "left")
    alone = F.col("node").isNull()
    own_id = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    kept = alone | (F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_key") == F.col("component_key")))
    scratch.keep("ids", "named", *[f"ids{k}" for k in range(1, 9)])
    return out.select("doc_id", "text_key", "n_shingles", own_id.alias("component_id"), kept.alias("kept"))


def near_duplicates(docs: DataFrame, words: int = 5, threshold: Fraction = Fraction(8, 10), retained: int = RETAINED) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept."""
    return linked(docs, words, threshold, retained).drop("text_key")


def representatives(docs: DataFrame, **options) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id, with its own columns.

    Rows are told apart by doc_id and text, so that documents without an id or with another's are only dropped for their texts.
    """
    shield = Shield(docs, ["doc_id", "text"])
    kept = linked(shield.df, **options).where("kept").select(F.col("doc_id").alias("rep"), F.col("text_key").alias("rep_key")).distinct()
    rows = shield.df.withColumns({"_id": F.col("doc_id").cast("long"), "_key": F.xxhash64(F.coalesce("text", F.lit(""))), "_none": F.col("text").isNull()})
    own = rows.join(kept, F.col("_id").eqNullSafe(F.col("rep")) & (F.col("_key") == F.col("rep_key")), "left_semi")
    return shield.back(own.dropDuplicates(["_id", "_key", "_none"]))
