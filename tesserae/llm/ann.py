"""Nearest neighbours by multi-index hashing of learned, rotated binary codes.

A bounded sample gives principal directions and a rotation that brings them near their signs (iterative quantisation),
and the Hamming radius within which the sample's own neighbours lie. Every vector is coded and indexed: rows are dealt by a
hash of vec_id into blocks of bounded size, and a block keeps one table for each 16-bit substring of its codes. The query set goes
to every block. Of codes within radius r, one of the m substrings lies within r // m or, for the later ones, r // m - 1
(pigeonhole), so probing those values finds every code within r; full Hamming distances confirm, and the floats
rerank. A block in which fewer than k codes lie within r widens it until k or all are found. Blocks return their best k,
and a top-k of a few rows a block merges them.

Codes lose order, so neighbours may be missed; the radius is set for the recall RECALL on the sample, which a larger table
exceeds, as its neighbours are nearer.

Defined cases: vectors that are null, zero, of another length than most of the sample, or that hold a null or a non-finite
component take no part; rows with the query's vec_id are no candidates; repeated rows count once; equal distances
go to the smaller vec_id; fewer than k candidates are returned all; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SAMPLE, PROBES, RECALL, SEED = 20_000, 256, 0.975, 11
BITS, PART = 64, 16
#: Rows of a block at most, and the blocks that small tables are dealt into for the sake of parallel work.
BLOCK, LEAST_BLOCK, SPREAD = 262_144, 4096, 16

_MASKS = [np.flatnonzero(np.bitwise_count(np.arange(1 << PART, dtype=np.uint32)) == w).astype(np.int64) for w in range(PART + 1)]


@dataclass(frozen=True)
class Codebook:
    """Sign codes: mean, projection (already rotated) and the calibrated radius."""

    mean: np.ndarray
    projection: np.ndarray
    radius: int

    def codes(self, x: np.ndarray) -> np.ndarray:
        """One row of 16-bit parts for each vector."""
        signs = (x - self.mean) @ self.projection > 0
        weights = 1 << np.arange(PART, dtype=np.int64)
        return signs.reshape(len(x), -1, PART).astype(np.int64) @ weights


def learn_codebook(sample: np.ndarray, k: int, recall: float = RECALL, rounds: int = 30) -> Codebook:
    rng = np.random.Generator(np.random.PCG64(SEED))
    dim = sample.shape[1]
    bits = max(PART, min(BITS, -(-dim // PART) * PART))
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, vectors = np.linalg.eigh(centred.T @ centred / max(1, len(sample)))
    basis = vectors[:, ::-1][:, : min(bits, dim)]
    if basis.shape[1] < bits:  # fewer directions than bits: more, at random
        more = rng.normal(size=(dim, bits - basis.shape[1]))
        basis = np.concatenate((basis, more / np.linalg.norm(more, axis=0)), axis=1)
    projected = centred @ basis
    rotation = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
    for _ in range(rounds):
        signs = np.where(projected @ rotation > 0, 1.0, -1.0)
        u, _, w = np.linalg.svd(signs.T @ projected)
        rotation = (u @ w).T
    book = Codebook(mean, basis @ rotation, bits)
    codes, asked = book.codes(sample), rng.permutation(len(sample))[:PROBES]
    far = []
    for i in asked:
        d = ((sample - sample[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        near = np.argsort(d, kind="stable")[: min(k, len(sample) - 1)]
        far.append(np.bitwise_count(codes[near] ^ codes[i]).sum(axis=1))
    far = np.concatenate(far) if far else np.zeros(0)
    radius = int(np.quantile(far, recall, method="higher")) if len(far) else bits
    return Codebook(mean, book.projection, radius)


class Block:
    """Codes of one block with a table for each part."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.parts = codes, codes.shape[1]
        self.order = [np.argsort(codes[:, p], kind="stable") for p in range(self.parts)]
        self.starts = [np.searchsorted(codes[o, p], np.arange((1 << PART) + 1)) for p, o in enumerate(self.order)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows with a code within the radius."""
        share, rest = divmod(min(radius, self.parts * PART), self.parts)
        found = np.zeros(len(self.codes), dtype=bool)
        for p in range(self.parts):
            reach = share if p <= rest else share - 1
            if reach < 0:
                continue
            values = np.concatenate(_MASKS[: min(reach, PART) + 1]) ^ code[p]
            lows, highs = self.starts[p][values], self.starts[p][values + 1]
            full = highs > lows
            lows, sizes = lows[full], (highs - lows)[full]
            if len(lows):
                places = np.repeat(lows - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(int(sizes.sum()))
                found[self.order[p][places]] = True
        rows = np.flatnonzero(found)
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(axis=1) <= radius]


def search_block(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, book: Codebook, k: int):
    """For each query the block's best k found: (query_id, vec_id, distance) columns."""
    _, first = np.unique(np.concatenate((ids[:, None], vectors.view(np.int64)), axis=1), axis=0, return_index=True) if len(ids) else (None, [])
    first = np.sort(first).astype(np.int64)
    ids, vectors = ids[first], vectors[first]
    block, limit = Block(book.codes(vectors)), book.projection.shape[1]
    out: list[list] = [[], [], []]
    for qid, q, code in zip(query_ids.tolist(), queries, book.codes(queries)):
        own = int((ids == qid).sum())
        radius = book.radius
        while True:
            rows = block.within(code, radius)
            if len(rows) >= min(k + own, len(ids)) or radius >= limit:
                break
            radius = min(limit, radius + block.parts)
        rows = rows[ids[rows] != qid]
        d = np.sqrt(((vectors[rows] - q) ** 2).sum(axis=1))
        best = np.lexsort((ids[rows], d))[:k]
        out[0] += [qid] * len(best)
        out[1] += ids[rows[best]].tolist()
        out[2] += d[best].tolist()
    return out


def valid_vectors(table: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    v = F.transform(F.col(column), lambda x: x.cast("double"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector")).where("vec_id is not null and vector is not null")
    return rows.where(finite & F.exists("vector", lambda x: x != 0))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks()
    return np.asarray(flat.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dim)


def nearest(table: DataFrame, queries: DataFrame, k: int = 10, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's k nearest found among the rows of table."""
    rows = valid_vectors(table)
    # the smallest hashes; a bound on them keeps each partition from sending `sample` rows of its own
    drawn_hash, share = F.xxhash64("vec_id", F.lit(SEED)), 1.1 * sample / max(rows.count(), 1)
    low = rows if share >= 1 else rows.where(drawn_hash <= int(-(2.0**63) + 2.0**64 * share))
    drawn = low.select("vector").orderBy(drawn_hash, "vec_id").limit(sample).collect()  # bounded by `sample`
    lengths = Counter(len(r["vector"]) for r in drawn)
    out_type = "query_id long, vec_id long, score double"
    if not lengths:
        empty = rows.where("false").select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
        return empty
    dim = max(lengths, key=lambda n: (lengths[n], n))
    book = learn_codebook(np.array([r["vector"] for r in drawn if len(r["vector"]) == dim], dtype=np.float64), k)
    shared = table.sparkSession.sparkContext.broadcast(book)  # bounded by the dimension
    rows = rows.where(F.size("vector") == dim)
    n = rows.count()
    blocks = max(-(-n // BLOCK), min(SPREAD, -(-n // LEAST_BLOCK)), 1)
    index = rows.withColumn("_block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    asked = valid_vectors(queries).where(F.size("vector") == dim).dropDuplicates(["vec_id", "vector"])
    asked = asked.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(own: pa.Table, want: pa.Table) -> pa.Table:
        ids, qids = own.column("vec_id").to_numpy(), want.column("vec_id").to_numpy()
        if not len(ids) or not len(qids):
            found: list[list] = [[], [], []]
        else:
            found = search_block(ids, _matrix(own.column("vector"), dim), qids, _matrix(want.column("vector"), dim), shared.value, k)
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "vec_id", "score"), found, (pa.int64(), pa.int64(), pa.float64()))})

    found = index.groupBy("_block").cogroup(asked.groupBy("_block")).applyInArrow(search, out_type)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.dropDuplicates(["query_id", "vec_id", "score"]).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
