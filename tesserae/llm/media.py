"""Media payloads in content-defined chunks: gear-hash cuts, digests deduplicated by joins, verified reconstruction.

A rolling gear hash over 32 bytes cuts each payload where its low bits are zero, between LEAST and MOST bytes, so an
insertion moves only the cuts around it. Chunks are named by SHA-256. A count of digests over all documents tells
which occur twice; a bitmap of those - of fixed size, whatever the corpus - goes to the tasks that write:

* media table: a row a document, with its ordered chunk list, and the bytes of chunks whose bit is not set inside;
* chunk store: every other chunk once (a digest's copies are joined into one before and after the shuffle).

A bit may be set for a chunk that occurs once; then it is in the store, too, and nothing is lost. Reading back, documents
without stored chunks are rebuilt from their row; for the others chunk lists join the store by digest and meet their row again.
Each chunk's digest and the payload's length are verified. The stored form of a document that its digest and size speak
of is the list (magic, number of bytes, length and digest of each chunk) followed by the chunks in order.

Defined cases: a null or empty text is a payload of PAD bytes alone; repeated rows and null ids keep a row each;
equal texts give equal values; a text of any length is chunked whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import Scratch, tidied
from tesserae.llm.wordhash import slices

UNIT, PAD = 576, b"\xff"
LEAST, MASK, MOST = 256, (1 << 10) - 1, 4096
WINDOW = 32
#: Bits of the map of digests that occur more than once: 8 MB.
MAP_BITS = 1 << 26
MAGIC = b"CDC1"

_GEAR = np.random.Generator(np.random.PCG64(97)).integers(0, 1 << 32, 256, dtype=np.uint32)


def payload_of(text: str) -> bytes:
    raw = text.encode()
    return raw + PAD * (max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """sum(gear[byte j before] << j) over the window that ends at each byte, by doubling."""
    h = _GEAR[data]
    reach = 1
    while reach < WINDOW:
        h[reach:] += h[:-reach] << np.uint32(reach)
        reach *= 2
    return h


def cut_lengths(payloads: list[bytes]) -> list[list[int]]:
    """Chunk lengths of each payload. No cut lies within LEAST > WINDOW bytes of a start, so neighbours do not matter."""
    joined = np.frombuffer(b"".join(payloads), dtype=np.uint8)
    cuts = (np.flatnonzero((gear_hashes(joined) & np.uint32(MASK)) == 0) + 1).tolist()
    out, base = [], 0
    for p in payloads:
        at, end, lengths = base, base + len(p), []
        k = bisect_left(cuts, at + LEAST)
        while end - at > LEAST:
            k = bisect_left(cuts, at + LEAST, k)
            cut = min(cuts[k] if k < len(cuts) else end, at + MOST, end)
            lengths.append(cut - at)
            at = cut
        if end > at:
            lengths.append(end - at)
        out.append(lengths)
        base = end
    return out


def chunked(texts: list[str]) -> Iterator[tuple[int, bytes, list[bytes], list[bytes]]]:
    """For each text: bytes of the text, payload, chunks, digests."""
    payloads = [payload_of(t) for t in texts]
    for lo, hi in slices(payloads):
        for t, p, lengths in zip(texts[lo:hi], payloads[lo:hi], cut_lengths(payloads[lo:hi])):
            chunks, at = [], 0
            for n in lengths:
                chunks.append(p[at : at + n])
                at += n
            yield len(t.encode()), p, chunks, [hashlib.sha256(c).digest() for c in chunks]


def bit_of(digest: bytes) -> int:
    return int.from_bytes(digest[:4], "big") & (MAP_BITS - 1)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def digest_counts(docs: DataFrame) -> DataFrame:
    """digest, n: how often each chunk occurs in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, int] = {}
            for _, _, _, digests in chunked(batch.column(1).to_pylist()):
                for d in digests:
                    found[d] = found.get(d, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], names=["digest", "n"])

    return _texts(docs).mapInArrow(tidied(run), "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n"))


def shared_bits(docs: DataFrame) -> np.ndarray:
    """The bitmap of digests that occur more than once, 8 to a byte."""
    again = digest_counts(docs).where("n > 1")
    place = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long").bitwiseAND(F.lit(MAP_BITS - 1))
    # bitmaps of 32768 bits: at most MAP_BITS / 32768 rows of 4 kB
    # (the library's positions begin at 1)
    maps = again.select((place + 1).alias("at")).groupBy(F.bitmap_bucket_number("at").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    whole = np.zeros(MAP_BITS // 8, dtype=np.uint8)
    for row in maps.collect():
        at = np.flatnonzero(np.unpackbits(np.frombuffer(row["bits"], dtype=np.uint8), bitorder="little")) + (row["part"] - 1) * 32768
        np.bitwise_or.at(whole, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return whole


MEDIA = "doc_id long, n_bytes long, recipe binary, inline binary, stored array<struct<seq:int,digest:binary>>"


def recipe_of(payload_bytes: int, chunks: list[bytes], digests: list[bytes]) -> bytes:
    return MAGIC + struct.pack("<QI", payload_bytes, len(chunks)) + b"".join(struct.pack("<I", len(c)) + d for c, d in zip(chunks, digests))


def read_recipe(recipe: bytes) -> tuple[int, list[tuple[int, bytes]]]:
    size, n = struct.unpack_from("<QI", recipe, 4)
    return size, [(struct.unpack_from("<I", recipe, 16 + 36 * i)[0], recipe[20 + 36 * i : 52 + 36 * i]) for i in range(n)]


def write_media(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The media table (with a row number of its own) and the chunk store."""
    bits = docs.sparkSession.sparkContext.broadcast(shared_bits(docs))

    def is_shared(digest: bytes) -> bool:
        at = bit_of(digest)
        return bool(bits.value[at >> 3] >> (at & 7) & 1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.struct([("seq", pa.int32()), ("digest", pa.binary())]))]
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in slices(texts, 8_000_000):
                out: list[list] = [[], [], [], [], []]
                for doc, (n, p, chunks, digests) in zip(ids[lo:hi], chunked(texts[lo:hi])):
                    apart = [is_shared(d) for d in digests]
                    own = (n, recipe_of(len(p), chunks, digests), b"".join(c for c, a in zip(chunks, apart) if not a), [{"seq": i, "digest": d} for i, (d, a) in enumerate(zip(digests, apart)) if a])
                    for column, value in zip(out, (doc, *own)):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["doc_id", "n_bytes", "recipe", "inline", "stored"])

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, bytes] = {}
            for _, _, chunks, digests in chunked(batch.column(1).to_pylist()):
                for c, d in zip(chunks, digests):
                    if d not in found and is_shared(d):
                        found[d] = c
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.binary())], names=["digest", "bytes"])

    media = scratch.save(_texts(docs).mapInArrow(tidied(rows), MEDIA).withColumn("rid", F.monotonically_increasing_id()), "media")
    store = scratch.save(_texts(docs).mapInArrow(tidied(stored), "digest binary, bytes binary").dropDuplicates(["digest"]), "store")
    return media, store


def rebuilt(media: DataFrame) -> DataFrame:
    """doc_id, n_bytes, payload and recipe of each row (doc_id, n_bytes, recipe, inline, got: its stored chunks), verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = []
            for recipe, inline, got in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
                size, listed = read_recipe(recipe)
                stored, parts, at = {g["seq"]: g["bytes"] for g in got or ()}, [], 0
                for i, (n, digest) in enumerate(listed):
                    part = stored.get(i)
                    if part is None:
                        part, at = inline[at : at + n], at + n
                    if len(part) != n or hashlib.sha256(part).digest() != digest:
                        raise ValueError("a stored chunk differs from its digest")
                    parts.append(part)
                payloads.append(b"".join(parts))
                if len(payloads[-1]) != size:
                    raise ValueError("a payload differs from its length")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(payloads, pa.binary())], names=["doc_id", "n_bytes", "recipe", "payload"])

    return media.mapInArrow(tidied(run), "doc_id long, n_bytes long, recipe binary, payload binary")


def read_media(media: DataFrame, store: DataFrame) -> DataFrame:
    """Every document's payload and chunk list, read back from the two tables."""
    no_chunks = F.array().cast("array<struct<seq:int,bytes:binary>>")
    plain = media.where(F.size("stored") == 0).select("doc_id", "n_bytes", "recipe", "inline", no_chunks.alias("got"))
    lists = media.where(F.size("stored") > 0).select("rid", F.explode("stored").alias("s")).select("rid", "s.seq", "s.digest")
    found = lists.join(store, "digest").groupBy("rid").agg(F.collect_list(F.struct("seq", "bytes")).alias("got"))
    apart = media.where(F.size("stored") > 0).drop("stored").join(found, "rid", "left").select("doc_id", "n_bytes", "recipe", "inline", "got")
    return rebuilt(plain).unionByName(rebuilt(apart))


def sample_features(payload: np.ndarray) -> str:
    """Counts of samples by their three high bits, the least and the most sample, and the sum of all."""
    return f"{'-'.join(map(str, np.bincount(payload >> 5, minlength=8).tolist()))}:{payload.min()}:{payload.max()}:{int(payload.sum(dtype=np.int64))}"


DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_chunks long"


def media_digest(docs: DataFrame) -> DataFrame:
    """Stores every payload, reads it back and describes it."""
    payloads = read_media(*write_media(docs, Scratch(docs.sparkSession, "media")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        for batch in batches:
            out: list[list] = [[] for _ in kinds]
            for recipe, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                media = hashlib.sha256(recipe)
                media.update(p)
                own = (len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(recipe) + len(p), media.hexdigest(), sample_features(np.frombuffer(p, dtype=np.uint8)), (len(recipe) - 16) // 36)
                for column, value in zip(out, own):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, k) for c, k in zip(out, kinds)]], names=[c.split()[0] for c in DIGEST.split(", ")])

    return payloads.mapInArrow(tidied(run), DIGEST)
