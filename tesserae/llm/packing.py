"""Vector best-fit packing of tokenised documents into fixed sequences.

A piece is a vector (tokens, one document, attention cost = length squared), a sequence has a capacity in each.
Pieces go by descending length; each goes to the open sequence that fits under every constraint and is best by the
chosen rule: `norm` (smallest weighted norm of what would be left) or `dot` (largest weighted dot product of piece and
residual); if none fits, a new one opens. Pieces are dealt by a hash into groups of about GROUP, packed on their own:
at most one sequence a group stays badly filled (one in thousands), and no task holds more than a group.

Tokens: text is cut at blanks and line feeds, at which the tokenizer never joins, and each distinct run of a slice of texts is
encoded once. A text with a string that could be a special token is encoded whole.

Defined cases: a null or empty text is the end token alone; repeated rows are packed each; an empty table gives no rows;
a very long text is cut into pieces of `capacity` ids, the last may be shorter; other columns are not read.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import Scratch, tidied

GROUP = 8192
#: Bytes of text of which the distinct runs are encoded together (a longer text is taken whole).
SLICE = 8_000_000
#: A run of letters before ASCII marks, which the tokenizer never joins to them; no apostrophe, which may begin a word part.
TAIL = r"^(?P<stem>\p{L}+)(?P<tail>[!-&(-/:-@\[-`{-~]+)$"

#: The capital that becomes a letter and a mark when lowered.
DOTTED = "\u0130"


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds, and the weights of the three dimensions in the choice."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    rule: str = "norm"


@dataclass
class RunEncoder:
    """Little-endian 32-bit ids of texts by a tokenizer file; each distinct run between blanks of a slice is encoded once."""

    path: str
    tokenizer: object = None

    def __post_init__(self):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(self.path)
        special = sorted(((t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not t.normalized))
        self.mark, self.mark_id = special[0] if special else (None, None)
        #: whether ASCII letters may be lowered before runs are told apart
        self.lowers = np.array_equal(self.whole("AQ"), self.whole("aq"))
        #: whether a run of lower-case letters is one word of the model, spelled in the byte alphabet
        rules = json.loads(self.tokenizer.to_str())
        kinds = json.dumps([rules.get("normalizer"), rules.get("pre_tokenizer")])
        self.direct = self.lowers and '"ByteLevel"' in kinds and '"NFC"' in kinds and r"|[\\p{L}]+|" in kinds
        self.clues = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def whole(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _words(self, words: list[str], ascii_only: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters one after the other, and the number of each: they go straight to the model."""
        if not ascii_only:  # bytes in their alphabet, all words at once
            words = "\n".join(words).encode().decode("latin-1").translate(_BYTE_ALPHABET).split("\n") if words else []
        tokenize, ids, counts = self.tokenizer.model.tokenize, array("I"), array("I")
        for word in words:
            own = [x.id for x in tokenize(word)]
            ids.extend(own)
            counts.append(len(own))
        return np.frombuffer(ids, dtype=np.uint32), np.frombuffer(counts, dtype=np.uint32)

    def _others(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for any runs, by the whole tokenizer."""
        if self.mark is None:
            found = [np.asarray(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch(runs, add_special_tokens=False)]
            return np.concatenate([np.zeros(0, dtype=np.uint32), *found]), np.array([len(x) for x in found], dtype=np.uint32)
        ids, counts = [np.zeros(0, dtype=np.uint32)], [np.zeros(0, dtype=np.int64)]
        for i in range(0, len(runs), 2000):
            part = runs[i : i + 2000]
            own = np.asarray(self.tokenizer.encode(self.mark.join(part), add_special_tokens=False).ids, dtype=np.uint32)
            cuts = np.flatnonzero(own == self.mark_id)
            if len(cuts) != len(part) - 1:
                raise ValueError("a run holds the mark between runs")
            ids.append(np.delete(own, cuts))
            counts.append(np.diff(np.concatenate(([-1], cuts, [len(own)]))) - 1)
        return np.concatenate(ids), np.concatenate(counts)

    def _encode(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct runs in an order of their own, and where those of each begin and end (two columns)."""
        plain = pc.string_is_ascii(runs).to_numpy(zero_copy_only=False)
        words, settled = runs, np.full(len(runs), self.direct)
        if self.direct and not plain.all():  # as the tokenizer does: composed, then lowered
            others = runs.filter(pa.array(~plain))
            lowered = pc.utf8_lower(_composed(others))
            settled[~plain] = pc.and_(pc.equal(_composed(lowered), lowered), pc.invert(pc.match_substring(others, DOTTED))).to_numpy(zero_copy_only=False)
            words = pc.replace_with_mask(runs, pa.array(~plain), lowered)
        letters = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False) & settled
        plain = pc.string_is_ascii(words).to_numpy(zero_copy_only=False)
        kinds = (letters & plain, letters & ~plain, ~letters)
        ids, places, done = [], np.zeros((len(runs), 2), dtype=np.int64), 0
        for kind, mask in enumerate(kinds):
            own = (words if kind < 2 else runs).filter(pa.array(mask)).to_pylist()
            found, counts = self._words(own, kind == 0) if kind < 2 else self._others(own)
            ends = done + np.cumsum(counts.astype(np.int64))
            places[mask, 0], places[mask, 1] = ends - counts, ends
            ids.append(found)
            done += len(found)
        return np.concatenate(ids), places

    def _slice(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of texts without clues, by way of their distinct runs; a tail of punctuation marks is a run of its own."""
        flat = pc.replace_substring(pc.ascii_lower(texts) if self.lowers else texts, "\n", " ")
        split = pc.split_pattern(flat, " ")
        runs = split.values.dictionary_encode()
        indices, offsets = runs.indices.to_numpy(), split.offsets.to_numpy()
        parts = pc.extract_regex(runs.dictionary, TAIL)
        tailed = pc.and_(parts.is_valid(), pc.invert(pc.match_substring(runs.dictionary, DOTTED))).to_numpy(zero_copy_only=False) & self.direct
        stems = pc.if_else(pa.array(tailed), pc.struct_field(parts, "stem"), runs.dictionary)
        tails = pc.struct_field(parts, "tail").filter(pa.array(tailed))
        parts = pa.concat_arrays([stems, tails]).dictionary_encode()
        ids, places = self._encode(parts.dictionary)
        first = parts.indices.to_numpy()
        second = np.full(len(stems), -1, dtype=np.int64)
        second[tailed] = first[len(stems) :]
        # ids of each distinct run together, then of each text
        ids, ends = _gathered(ids, places, np.where(np.arange(2 * len(stems)) % 2, np.repeat(second, 2), np.repeat(first[: len(stems)], 2)))
        places = np.stack((np.concatenate(([0], ends[1::2][:-1])), ends[1::2]), axis=1) if len(stems) else places
        for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            yield _gathered(ids, places, indices[lo:hi])[0]

    def encode(self, texts: pa.Array | list[str]) -> Iterator[np.ndarray]:
        """Ids of each text."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < len(texts):
            done = int(sizes[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(sizes, done + SLICE)))
            own = texts.slice(lo, hi - lo)
            odd = np.zeros(len(own), dtype=bool)
            for clue in self.clues:
                odd |= pc.match_substring(own, clue).to_numpy(zero_copy_only=False)
            others = self._slice(own.filter(pa.array(~odd)))
            for i, whole in enumerate(odd.tolist()):
                yield self.whole(own[i].as_py()) if whole else next(others)
            lo = hi


def _composed(runs: pa.Array) -> pa.Array:
    """Runs, none with a line feed, in the composed form (Arrow's own function leaves them decomposed)."""
    return pa.array(unicodedata.normalize("NFC", "\n".join(runs.to_pylist())).split("\n"), pa.string())


def _gathered(ids: np.ndarray, places: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ids named by order, one after the other (-1: none), and where each ends."""
    begin = np.where(order < 0, 0, places[order, 0]) if len(places) else np.zeros(len(order), dtype=np.int64)
    counts = np.where(order < 0, 0, places[order, 1] - begin) if len(places) else begin
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return ids[np.arange(total) + np.repeat(begin - ends + counts, counts)], ends


_ENCODERS: dict[str, RunEncoder] = {}


def encoder(path: str) -> RunEncoder:
    """One for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = RunEncoder(path)
    return _ENCODERS[path]


#: The public byte alphabet: printable bytes stand for themselves, the others, in order, for characters from 256 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_ALPHABET = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _SHOWN) if b != 0x0A}  # line feeds part words here

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece of each tokenised document."""
    end, step = np.asarray([end_id], dtype="<u4").tobytes(), 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out: list[list] = [[], [], [], [], []]
            for doc, own_ids in zip(ids, enc.encode(batch.column(1))):
                raw = own_ids.astype("<u4", copy=False).tobytes() + end
                for k, at in enumerate(range(0, len(raw), step)):
                    own = raw[at : at + step]
                    for column, value in zip(out, (doc, k, at // 4, len(own) // 4, zlib.crc32(own))):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(tidied(cut), PIECES)


def best_fit(lengths: np.ndarray, cap: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """For lengths in descending order: the sequence and the offset of each."""
    n = len(lengths)
    seq, offset = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    scale = np.array([cap.tokens, cap.documents, cap.attention], dtype=np.float64)
    weights = np.asarray(cap.weights) / scale**2
    least = int(lengths[-1]) if n else 0
    residual, names, count, opened = np.empty((3, 1024)), np.empty(1024, dtype=np.int64), 0, 0
    for i, length in enumerate(lengths.tolist()):
        if length > cap.tokens or length**2 > cap.attention:
            raise ValueError("a piece exceeds the capacity of a sequence")
        item = np.array([length, 1.0, float(length) ** 2])
        fits = np.flatnonzero((residual[0, :count] >= item[0]) & (residual[1, :count] >= 1) & (residual[2, :count] >= item[2]))
        if len(fits):
            left = residual[:, fits]
            if cap.rule == "dot":
                b = fits[np.argmax((weights * item) @ left)]
            else:
                b = fits[np.argmin(weights @ (left - item[:, None]) ** 2)]
        else:
            if count == residual.shape[1]:
                residual, names = np.concatenate((residual, np.empty_like(residual)), axis=1), np.concatenate((names, np.empty_like(names)))
            b, count = count, count + 1
            residual[:, b], names[b], opened = scale, opened, opened + 1
        seq[i], offset[i] = names[b], cap.tokens - int(residual[0, b])
        residual[:, b] -= item
        if residual[0, b] < least or residual[1, b] < 1:  # nothing can follow: the last open one takes its place
            count -= 1
            residual[:, b], names[b] = residual[:, count], names[count]
    return seq, offset


PACKED = PIECES + ", sequence_id long, offset long"


def pack_pieces(pieces: DataFrame, cap: Capacity = Capacity()) -> DataFrame:
    """The pieces with sequence_id and offset."""
    groups = max(1, -(-pieces.count() // GROUP))

    def pack(table: pa.Table) -> pa.Table:
        group = table.column("_group")[0].as_py()
        table = table.sort_by([("length", "descending"), ("ids_crc32", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
        seq, offset = best_fit(table.column("length").to_numpy(), cap)
        return table.drop_columns(["_group"]).append_column("sequence_id", pa.array(seq + (group << 32))).append_column("offset", pa.array(offset))

    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    return dealt.groupBy("_group").applyInArrow(pack, PACKED)


def pack_documents(docs: DataFrame, tokenizer: str, cap: Capacity = Capacity()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of all documents."""
    pieces = Scratch(docs.sparkSession, "packing").save(cut_pieces(docs, tokenizer, cap.tokens), "pieces")
    return pack_pieces(pieces, cap)
