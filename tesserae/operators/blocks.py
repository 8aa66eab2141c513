"""Features of pairs, a block of pairs at once: all records of a key meet in whole arrays, and only what a query asks for leaves them.

Both sides are packed by key before they are joined, so that a record's strings are read once for all its pairs. The values are
those of the columns in `features` and `model`, rounded here where a query rounds them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.functions import kernel
from tesserae.operators.model import LINEAR

#: Pairs that are worked on at once.
CHUNK = 1 << 17
#: Parts into which a key's reference records are dealt: a row holds one part, and all records of the sources with that key.
DEALT = 8
FIELDS = {"name": "business_name_norm", "core": "business_name_core", "address": "business_address_norm", "country": "country_norm"}
#: Java's digits as of Unicode 13: two younger scripts' are none.
DIGITS = re.compile("(?:(?![\U00011f50-\U00011f59\U0001e4f0-\U0001e4f9])\\d)+")


def words(text: str) -> set[str]:
    return set(text.split())  # Python's white space is what `text.SPACE` names


def numbers(text: str) -> set[str]:
    return set(DIGITS.findall(text))


def long_numbers(text: str) -> set[str]:
    return {w for w in DIGITS.findall(text) if len(w) >= 3}


LISTS = {"words": words, "numbers": numbers, "long_numbers": long_numbers}


def rounded(x: np.ndarray, decimals: int = 6) -> np.ndarray:
    """Of values that are not negative, half up by their shortest decimal form: what the engine's round gives."""
    from decimal import ROUND_HALF_UP, Decimal

    if x.dtype.kind != "f":
        return x
    scaled = x * 10.0**decimals
    whole = np.floor(scaled)
    part = scaled - whole
    out = (whole + (part >= 0.5)) / 10.0**decimals
    near = np.flatnonzero(np.abs(part - 0.5) < 1e-4)
    if len(near):
        values, where = np.unique(x[near], return_inverse=True)
        out[near] = np.array([float(Decimal(repr(v)).quantize(Decimal(1).scaleb(-decimals), ROUND_HALF_UP)) for v in values.tolist()])[where]
    return out


class Lists:
    """Codes of the elements of rows' lists that the other side has, too: one row of a matrix for each place in a list."""

    def __init__(self, one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]):
        # (row of each element, its code), and the number of rows
        (rows1, codes1, n1), (rows2, codes2, n2) = one, two
        n = 1 + max([int(c.max()) for c in (codes1, codes2) if len(c)], default=0)
        held = [np.zeros(n, dtype=bool) for _ in (1, 2)]
        held[0][codes1], held[1][codes2] = True, True
        both = held[0] & held[1]
        self.n = n
        self.one, self.two = self._matrix(rows1, codes1, n1, both, -1), self._matrix(rows2, codes2, n2, both, -2)

    @staticmethod
    def _matrix(rows: np.ndarray, codes: np.ndarray, n: int, both: np.ndarray, none: int) -> np.ndarray:
        kept = both[codes]
        rows, codes = rows[kept], codes[kept]
        sizes = np.bincount(rows, minlength=n)
        at = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        made = np.full((int(sizes.max()) if n else 0, n), none, dtype=np.int32)
        made[at, rows] = codes
        return made

    @cached_property
    def _sorted(self) -> np.ndarray:
        at = np.broadcast_to(np.arange(self.two.shape[1], dtype=np.int64) * self.n, self.two.shape)
        return np.sort((at + self.two)[self.two >= 0])

    def shared(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many elements of each pair's second list the first has; equal ones count each."""
        out = np.zeros(len(i), dtype=np.int64)
        if not len(self.one) or not len(self.two):
            return out
        if len(self.one) * len(self.two) > 256:  # long lists: each element is looked up
            for a in self.one:
                mine = a.take(i)
                key = j * np.int64(self.n) + mine
                found = np.searchsorted(self._sorted, key, "right") - np.searchsorted(self._sorted, key, "left")
                out += np.where(mine >= 0, found, 0)
            return out
        count = np.zeros(len(i), dtype=np.int16)
        second = [b.take(j) for b in self.two]
        for a in self.one:
            mine = a.take(i)
            for b in second:
                count += mine == b
        return count.astype(np.int64)


class Texts:
    """A column of strings of both sides, each different one held once."""

    def __init__(self, left: pa.Array, right: pa.Array):
        both = pa.concat_arrays([left, right]).fill_null("").dictionary_encode()
        codes = both.indices.to_numpy()
        self.left, self.right = codes[: len(left)], codes[len(left) :]
        self.strings, self.lengths = both.dictionary.to_pylist(), pc.utf8_length(both.dictionary).to_numpy().astype(np.int64)
        self._lists: dict[str, tuple[Lists, np.ndarray]] = {}

    def lists(self, kind: str) -> tuple[Lists, np.ndarray]:
        """The lists of each string, and how many elements each has."""
        if kind not in self._lists:
            made = [LISTS[kind](s) for s in self.strings]
            sizes = np.array([len(x) for x in made], dtype=np.int64)
            names: dict[str, int] = {}
            codes = np.array([names.setdefault(w, len(names)) for x in made for w in x], dtype=np.int64)
            rows = np.repeat(np.arange(len(made)), sizes)
            own = []
            for side in (self.left, self.right):
                used = np.zeros(len(made), dtype=bool)
                used[side] = True
                kept = used[rows]
                own.append((rows[kept], codes[kept], len(made)))
            self._lists[kind] = Lists(*own), sizes
        return self._lists[kind]


class Strings:
    """The pairs of strings of a chunk (i and j are places in the list of strings), each different pair once where they are few."""

    def __init__(self, texts: Texts, left: np.ndarray, right: np.ndarray):
        self.texts, n = texts, len(texts.strings)
        i, j = texts.left.take(left), texts.right.take(right)
        ours, theirs = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
        ours[i], theirs[j] = True, True
        first, second = np.flatnonzero(ours), np.flatnonzero(theirs)
        if 2 * len(first) * len(second) < len(i):  # all that may meet are fewer than the pairs
            self.where = (np.cumsum(ours) - 1).take(i) * len(second) + (np.cumsum(theirs) - 1).take(j)
            self.i, self.j = np.repeat(first, len(second)), np.tile(second, len(first))
        else:
            self.where, self.i, self.j = None, i.astype(np.int64), j.astype(np.int64)
        self._counts: dict[str, tuple] = {}

    def spread(self, values: np.ndarray) -> np.ndarray:
        return values if self.where is None else values.take(self.where)

    @cached_property
    def lengths(self) -> tuple[np.ndarray, np.ndarray]:
        return self.texts.lengths.take(self.i), self.texts.lengths.take(self.j)

    def counts(self, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many elements either list has, and how many both share."""
        if kind not in self._counts:
            lists, sizes = self.texts.lists(kind)
            self._counts[kind] = sizes.take(self.i), sizes.take(self.j), lists.shared(self.i, self.j)
        return self._counts[kind]

    @cached_property
    def full(self) -> np.ndarray:
        return (self.lengths[0] > 0) & (self.lengths[1] > 0)

    @cached_property
    def used(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The strings of this chunk alone, and the places in them."""
        held = np.zeros(len(self.texts.strings), dtype=bool)
        held[self.i], held[self.j] = True, True
        place = np.cumsum(held) - 1
        return [self.texts.strings[k] for k in np.flatnonzero(held).tolist()], place.take(self.i), place.take(self.j)

    @cached_property
    def ratio(self) -> np.ndarray:
        value = np.where(self.full, kernel.ratios_at(*self.used), 0.0)
        return np.where((self.lengths[0] == 0) & (self.lengths[1] == 0), 1.0, value)

    @cached_property
    def token_sort(self) -> np.ndarray:
        strings, i, j = self.used
        return np.where(self.full, kernel.ratios_at(kernel.sorted_tokens(strings), i, j), 0.0)

    @cached_property
    def token_set(self) -> np.ndarray:
        return np.where(self.full, kernel.token_set_at(*self.used), 0.0)


def jaccard(a, b, both):
    return np.where((a == 0) & (b == 0), 1.0, np.where((a == 0) | (b == 0), 0.0, both / np.maximum(a + b - both, 1)))


def containment(a, b, both):
    return np.where(a == 0, 1.0, both / np.maximum(a, 1))


def overlap(a, b, both):
    least = np.minimum(a, b)
    return np.where(least == 0, 0.0, both / np.maximum(least, 1))


def common(a, b, both):
    return both


def length_difference(a, b):
    return np.abs(a - b) / np.maximum(np.maximum(a, b), 1)


def length_ratio(a, b):
    return np.minimum(a, b) / np.maximum(np.maximum(a, b), 1)


def _flag(x):
    return x.astype(np.int64)


def _equal(p: Strings):
    return _flag((p.i == p.j) & (p.lengths[0] > 0))


def _missing(p: Strings):
    return _flag(~p.full)


def _list_features(kind: str) -> dict:
    return {
        f"{kind}_jaccard": (kind, lambda p: jaccard(*p.counts("words"))), f"{kind}_containment": (kind, lambda p: containment(*p.counts("words"))),
        f"{kind}_token_overlap_ratio": (kind, lambda p: overlap(*p.counts("words"))), f"{kind}_common_token_count": (kind, lambda p: common(*p.counts("words"))),
        f"{kind}_length_diff_norm": (kind, lambda p: length_difference(*p.lengths)), f"{kind}_length_ratio": (kind, lambda p: length_ratio(*p.lengths)),
        f"{kind}_missing": (kind, _missing), f"{kind}_levenshtein_sim": (kind, lambda p: p.ratio), f"{kind}_token_sort_ratio": (kind, lambda p: p.token_sort),
        f"{kind}_token_set_ratio": (kind, lambda p: p.token_set),
    }


#: Features of the strings of one column: the column, and their values by its pairs of strings.
FEATURES: dict[str, tuple[str, Callable[[Strings], np.ndarray]]] = {
    "name_exact": ("name", _equal), "name_core_exact": ("core", _equal), **_list_features("name"), **_list_features("address"),
    "numeric_token_jaccard": ("address", lambda p: jaccard(*p.counts("numbers"))), "numeric_token_overlap": ("address", lambda p: overlap(*p.counts("numbers"))),
    "digit_seq_jaccard": ("address", lambda p: jaccard(*p.counts("long_numbers"))), "has_exact_digit_match": ("address", lambda p: _flag(p.counts("long_numbers")[2] > 0)),
    "numeric_count_diff": ("address", lambda p: np.abs(p.counts("numbers")[0] - p.counts("numbers")[1]).astype(float)),
    "has_numeric_conflict": ("address", lambda p: _flag((p.counts("numbers")[0] > 0) & (p.counts("numbers")[1] > 0) & (p.counts("numbers")[2] == 0))),
    "country_match": ("country", _equal), "country_missing": ("country", _missing),
}


def _linear(c: Chunk) -> np.ndarray:
    total = 0.0
    for name, weight in LINEAR.items():
        total = total + c.value(name).astype(float) * weight
    return total


def _of_both(make) -> Callable:
    return lambda c: make(c.value("name_token_set_ratio"), c.value("address_token_set_ratio"))


#: Values of whole pairs.
WHOLE: dict[str, Callable[[Chunk], np.ndarray]] = {
    "name_x_address_sim": _of_both(np.multiply), "min_name_address_sim": _of_both(np.minimum), "max_name_address_sim": _of_both(np.maximum),
    "probability": _linear, "is_match": lambda c: _flag(c.block.lists("matched").shared(c.left, c.right) > 0),
    "_many": lambda c: c.block.flags[0].take(c.left) | c.block.flags[1].take(c.right),
}


#: The features that they are made of.
PARTS = {"probability": tuple(LINEAR), **{f"{k}_name_address_sim": ("name_token_set_ratio", "address_token_set_ratio") for k in ("min", "max")}, "name_x_address_sim": ("name_token_set_ratio", "address_token_set_ratio")}


class Block:
    """Rows of both sides' packed records that met."""

    def __init__(self, batch: pa.RecordBatch):
        (self.left, self.at), (self.right, self.to) = [self._open(batch.column(n)) for n in ("_left", "_right")]
        self._texts: dict[str, Texts] = {}
        self._lists: dict[str, Lists] = {}

    @staticmethod
    def _open(packed: pa.ListArray) -> tuple[dict[str, pa.Array], np.ndarray]:
        offsets = packed.offsets.to_numpy().astype(np.int64)
        records = packed.flatten()
        fields = records.flatten()
        return {records.type.field(k).name: fields[k] for k in range(records.type.num_fields)}, offsets - offsets[0]

    def texts(self, kind: str) -> Texts:
        if kind not in self._texts:
            self._texts[kind] = Texts(self.left[kind], self.right[kind])
        return self._texts[kind]

    def lists(self, kind: str) -> Lists:
        """Of the keys before the one on which records met; of a reference's listed ids (matched, again) and the others' own id."""
        if kind not in self._lists:
            second = self.right[kind] if kind == "_before" else None
            values = [self.left[kind].flatten(), self.right["_id"] if second is None else second.flatten()]
            codes = pa.concat_arrays([v.cast(pa.string()) for v in values]).dictionary_encode().indices.to_numpy().astype(np.int64)
            rows = lambda x: np.repeat(np.arange(len(x)), np.diff(x.offsets.to_numpy()))
            n = len(values[0])
            one = rows(self.left[kind]), codes[:n], len(self.left["_id"])
            two = (np.arange(len(values[1])) if second is None else rows(second)), codes[n:], len(self.right["_id"])
            self._lists[kind] = Lists(one, two)
        return self._lists[kind]

    @cached_property
    def flags(self) -> list[np.ndarray]:
        return [side["_many"].fill_null(False).to_numpy(zero_copy_only=False) for side in (self.left, self.right)]

    def chunks(self) -> Iterator[Chunk]:
        """All pairs of records with a common key, made by the first such key, as often as the list of true pairs holds them."""
        key = np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))
        sizes = np.diff(self.to)[key]
        before = np.concatenate(([0], np.cumsum(sizes)))
        lo = 0
        while lo < len(sizes):
            hi = max(lo + 1, int(np.searchsorted(before, before[lo] + CHUNK, "right")) - 1)
            own = sizes[lo:hi]
            left = np.repeat(np.arange(lo, hi), own)
            right = np.arange(len(left)) - np.repeat(before[lo:hi] - before[lo], own) + np.repeat(self.to[key[lo:hi]], own)
            first = self.lists("_before")
            if len(first.one) and len(first.two):
                kept = first.shared(left, right) == 0
                left, right = left[kept], right[kept]
            if "again" in self.left:
                times = 1 + self.lists("again").shared(left, right)
                if (times > 1).any():
                    left, right = np.repeat(left, times), np.repeat(right, times)
            yield Chunk(self, left, right)
            lo = hi


class Chunk:
    """Some pairs of a block: places of their records on either side."""

    def __init__(self, block: Block, left: np.ndarray, right: np.ndarray):
        self.block, self.left, self.right = block, left, right
        self._strings: dict[str, Strings] = {}

    def strings(self, kind: str) -> Strings:
        if kind not in self._strings:
            self._strings[kind] = Strings(self.block.texts(kind), self.left, self.right)
        return self._strings[kind]

    def value(self, name: str, final: bool = False) -> np.ndarray:
        """A feature of each pair; rounded where it is final."""
        end = rounded if final else (lambda x: x)
        if name in WHOLE:
            return end(WHOLE[name](self))
        kind, make = FEATURES[name]
        p = self.strings(kind)
        return p.spread(end(make(p)))

    def where(self, kept: np.ndarray) -> Chunk:
        return Chunk(self.block, self.left[kept], self.right[kept])

    def ids(self) -> dict[str, pa.Array]:
        b = self.block
        return {"source1_entity_id": b.left["_id"].take(pa.array(self.left)), "candidate_entity_id": b.right["_id"].take(pa.array(self.right)), "candidate_source": b.right["candidate_source"].take(pa.array(self.right))}


TYPES = {"source1_entity_id": "string", "candidate_entity_id": "string", "candidate_source": "string", "_many": "boolean", "is_match": "bigint"}
WHOLE_NUMBERS = ("exact", "missing", "count", "match", "conflict")


def kind_of(name: str) -> str:
    return TYPES.get(name) or ("bigint" if name.endswith(WHOLE_NUMBERS) else "double")


def met(left: DataFrame, right: DataFrame, out: dict[str, str], least: float | None = None, differs: bool = False, parts: int | None = None, lists: bool = False) -> DataFrame:
    """Pairs of `left` and `right` (as `blocking.two` gives them, with their records' strings) with the columns `out` (name: id column, feature or score).

    `least` keeps pairs with such a probability or more, `differs` those that are no true pairs. The reference's columns `matched` and `again` hold
    listed ids. With `lists` there is one row a reference record and block, with all its candidates' ids, in the place of pairs.
    """
    schema = "source1_entity_id string, _found array<string>" if lists else ", ".join(f"{n} {kind_of(c)}" for n, c in out.items())

    asked = {c for c in out.values()} | ({"probability"} if least is not None else set()) | ({"is_match"} if differs else set())
    strings = {FEATURES[f][0] for c in asked for f in PARTS.get(c, (c,)) if f in FEATURES}

    def packed(df: DataFrame, n: int, key: list[str], name: str) -> DataFrame:
        ids = ["source1_entity_id"] if n == 1 else ["candidate_entity_id", "candidate_source"]
        more = [c for c in ("matched", "again") if c in df.columns and (c == "again" or "is_match" in asked)]
        texts = [F.col(f"{c}_{n}").alias(k) for k, c in FIELDS.items() if k in strings]
        flags = [F.col(f"_many_{n}").alias("_many")] if f"_many_{n}" in df.columns else []
        empty = F.array().cast("array<string>")
        every = df.select(*ids, *[F.coalesce(c, empty).alias(c) for c in more], *texts, *flags, "_keys", F.posexplode("_keys").alias("_at", "_key"))
        every = every.withColumn("_before", F.slice("_keys", F.lit(1), F.col("_at"))).drop("_keys", "_at").withColumnRenamed(ids[0], "_id")
        every = (every.repartition("_key") if parts is None else every.repartition(parts, "_key")).withColumn("_part", F.pmod(F.xxhash64("_id"), F.lit(DEALT)))
        return every.groupBy(*key).agg(F.collect_list(F.struct(*[c for c in every.columns if c not in ("_key", "_part")])).alias(name)).select("_key", name)

    def run(batches):
        for batch in batches:
            for rows in _slices(batch):
                for chunk in Block(rows).chunks():
                    if least is not None:
                        chunk = chunk.where(chunk.value("probability", True) >= least)
                    if differs:
                        chunk = chunk.where(chunk.value("is_match") == 0)
                    if not len(chunk.left):
                        continue
                    if lists:
                        yield _listed(chunk)
                        continue
                    ids = chunk.ids()
                    arrays = [ids[c] if c in ids else pa.array(chunk.value(c, True)) for c in out.values()]
                    yield pa.RecordBatch.from_arrays(arrays, names=list(out))

    both = packed(left, 1, ["_key", "_part"], "_left").join(packed(right, 2, ["_key"], "_right"), "_key").select("_left", "_right")
    return both.mapInArrow(run, schema)


#: Records of both sides from which a block is made, at least where there are so many.
RECORDS = 20_000


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows with RECORDS records together, or one row that has more."""
    sizes = sum(pc.list_value_length(batch.column(n)).to_numpy() for n in ("_left", "_right"))
    total, lo = np.cumsum(sizes), 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + RECORDS, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _listed(chunk: Chunk) -> pa.RecordBatch:
    begins = np.flatnonzero(np.concatenate(([True], chunk.left[1:] != chunk.left[:-1])))
    ids = chunk.block.left["_id"].take(pa.array(chunk.left[begins]))
    found = chunk.block.right["_id"].take(pa.array(chunk.right))
    offsets = pa.array(np.concatenate((begins, [len(chunk.left)])).astype(np.int32))
    return pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(offsets, found)], names=["source1_entity_id", "_found"])
