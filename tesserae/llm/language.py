"""Language spans: script ranges narrow the candidates, Viterbi over per-word scores with a switching penalty labels words.

Learned from labelled texts: counts of character 1- to 3-grams of lower-cased words (padded at both ends) by language, over
every labelled row, and how many words of each script a language has. A word's score under a language is its
interpolated trigram log-probability, relative to the best language and floored at CLIP; a language that does not write the
word's script gets the floor. A switch between languages costs SWITCH. The texts of a batch are decoded together, word by word
of all that are still open, so work is in proportion to words.

Every gram of every language counts. A model of up to CELLS numbers (grams times languages) is sent to the workers; beyond, the
counts stay a table, and each group of texts gets those of its own grams by a join: the same scores.

Defined cases: a null or empty text or one without letters is `und` with score 0 and no spans, as is any text where nothing
was learned; equal texts get equal results; ties go to the language first in order; rows without language are not learned
from; an empty table gives no rows; long texts are labelled whole; only named columns are read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesserae.llm.common import Scratch, Shield, tidied

SWITCH, CLIP = 12.0, -8.0
#: Numbers (grams times languages) up to which the model is sent whole.
CELLS = 4_000_000
#: A language writes a script that has this share of its words.
SCRIPT_SHARE = 0.02
#: Words whose scores a worker keeps, and texts that are decoded together.
CACHE, TOGETHER = 300_000, 2048
#: The pipeline accepts a text whose language holds this share of its letters.
LEAST_SHARE = 0.5
UNKNOWN = "und"

#: First code points of script blocks, in order.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Indic"), (0x0E00, "Thai"),
    (0x0E80, "Other"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x1380, "Other"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x3040, "Kana"), (0x3100, "Han"),
    (0xAC00, "Hangul"), (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"),
    (0xFB50, "Arabic"), (0xFE70, "Arabic"), (0xFF00, "Latin"), (0xFF66, "Kana"), (0x10000, "Other"), (0x20000, "Han"),
)
_STARTS, _NAMES = [s for s, _ in SCRIPTS], [n for _, n in SCRIPTS]
#: A word: a run of letters.
_LETTERS = re.compile(r"[^\W\d_]+")
_END = "\x02"


def script_of(word: str) -> str:
    return _NAMES[bisect_right(_STARTS, ord(word[0])) - 1]


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def _grams(word: str) -> list[str]:
    padded = f"{_END}{word}{_END}"
    return [padded[i - 2 if i > 1 else 0 : i + 1] for i in range(1, len(padded))]


def count_grams(labelled: DataFrame) -> DataFrame:
    """lang, gram, n over all rows (text, lang); a gram that begins with a form feed counts words of a script."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: dict[str, Counter] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words.setdefault(lang, Counter()).update(words_of(text))
            for lang, counted in words.items():
                grams: Counter = Counter()
                for word, n in counted.items():
                    grams["\f" + script_of(word)] += n
                    for g in _grams(word):
                        grams[g] += n
                if grams:
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams.keys()), pa.array(grams.values(), pa.int64())], names=["lang", "gram", "n"])

    counted = labelled.select("text", "lang").mapInArrow(tidied(run), "lang string, gram string, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Shared(NamedTuple):
    """What every group's model needs, a few numbers a language."""

    langs: list[str]
    scripts: list[tuple[str, str, int]]
    every: list[int]
    letters: int


def gram_stats(counts: DataFrame) -> DataFrame:
    """kind, gram, lang, n: counts of 1- to 3-grams (kinds 0 to 2), and of what 1- and 2-grams go before (3 and 4)."""
    tri, found = counts.where(~F.col("gram").startswith("\f")), None
    for k in range(3):
        of = tri.where(F.length("gram") > k).select("lang", F.expr(f"right(gram, {k + 1})").alias("gram"), "n")
        for kind, key in [(k, F.col("gram"))] + ([(k + 2, F.expr(f"left(gram, {k})"))] if k else []):
            one = of.select(F.lit(kind).alias("kind"), key.alias("gram"), "lang", "n")
            found = one if found is None else found.unionByName(one)
    return found.groupBy("kind", "gram", "lang").agg(F.sum("n").alias("n"))


class Joined:
    """Counts too many to send: a table of gram_stats, and what all models share."""

    def __init__(self, counts: DataFrame, scratch: Scratch):
        self.stats = scratch.save(gram_stats(counts), "stats")
        letters = self.stats.where("kind = 0")
        every = {r["lang"]: r["n"] for r in letters.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
        scripts = sorted(tuple(r) for r in counts.where(F.col("gram").startswith("\f")).select("lang", "gram", "n").collect())
        langs = sorted(every)
        self.shared = Shared(langs, scripts, [every[x] for x in langs], letters.select("gram").distinct().count())


class Model:
    """Scores of words under each learned language."""

    def __init__(self, counts: list[tuple[str, str, int]]):
        self.langs = sorted({c[0] for c in counts})
        at, size = {lang: i for i, lang in enumerate(self.langs)}, len(self.langs)
        scripts: dict[str, np.ndarray] = {}
        tri: dict[str, np.ndarray] = {}
        for lang, gram, n in counts:
            table = scripts if gram[0] == "\f" else tri
            table.setdefault(gram[1:] if gram[0] == "\f" else gram, np.zeros(size))[at[lang]] += n
        total = np.maximum(sum(scripts.values(), np.zeros(size)), 1)
        self.scripts = {s: n / total >= SCRIPT_SHARE for s, n in scripts.items()}
        tables: list[dict[str, np.ndarray]] = [{}, {}, {}]
        for gram, n in tri.items():  # a gram's last character given up to two before it
            for k in range(3):
                key = gram[-1 - k :] if k < len(gram) else gram
                if k < len(gram):
                    tables[k][key] = tables[k].get(key, 0) + n
        heads: list[dict[str, np.ndarray]] = [{}, {}, {}]
        for k in (1, 2):
            for gram, n in tables[k].items():
                heads[k][gram[:-1]] = heads[k].get(gram[:-1], 0) + n
        self._fit(tables, heads, sum(tables[0].values(), np.zeros(size)), len(tables[0]))

    @classmethod
    def of(cls, shared: Shared, stats: Iterator[tuple[int, str, str, int]]) -> Model:
        """The model for texts whose grams' own rows (kind, gram, lang, n) of gram_stats are given."""
        model = cls(shared.scripts)
        model.langs, size = shared.langs, len(shared.langs)
        at = {lang: i for i, lang in enumerate(shared.langs)}
        found: list[dict[str, np.ndarray]] = [{} for _ in range(5)]
        for kind, gram, lang, n in stats:
            found[kind].setdefault(gram, np.zeros(size))[at[lang]] += n
        model._fit(found[:3], [{}, *found[3:]], np.array(shared.every, dtype=np.float64), shared.letters)
        return model

    def _fit(self, tables: list[dict[str, np.ndarray]], heads: list[dict[str, np.ndarray]], every: np.ndarray, letters: int) -> None:
        size = len(self.langs)
        self.rows: dict[str, int] = {}
        logs, probs = [], {}
        lower = {c: (n + 0.5) / (every + 0.5 * (letters + 1)) for c, n in tables[0].items()}
        probs.update(lower)
        for k, strength in ((1, 20.0), (2, 10.0)):
            for gram, n in tables[k].items():
                probs[gram] = (n + strength * probs[gram[1:]]) / (heads[k][gram[:-1]] + strength)
        for gram, p in probs.items():
            self.rows[gram] = len(logs)
            logs.append(np.log(p))
        logs.append(np.zeros(size))  # an unknown character tells nothing
        self.logs = np.array(logs).reshape(len(logs), size)
        self.cache: dict[str, int] = {}
        self.known = np.zeros((0, size))

    def _row(self, gram: str) -> int:
        rows = self.rows
        while gram:
            if gram in rows:
                return rows[gram]
            gram = gram[1:]
        return len(self.logs) - 1

    def _score(self, words: list[str]) -> np.ndarray:
        index, begins, rows, last = [], [], self.rows, len(self.logs) - 1
        for word in words:
            begins.append(len(index))
            for g in _grams(word):
                r = rows.get(g, -1)
                index.append(r if r >= 0 else self._row(g))
        scores = np.add.reduceat(self.logs[np.array(index, dtype=np.int64)], begins, axis=0)
        scores = np.maximum(scores - scores.max(axis=1, keepdims=True), CLIP)
        for i, word in enumerate(words):
            may = self.scripts.get(script_of(word))
            if may is None or not may.any():
                scores[i] = 0.0  # a script that no language writes tells nothing
            elif not may.all():
                scores[i, ~may] = CLIP
                scores[i, may] -= scores[i, may].max()
        return scores

    def learn(self, words: set[str]) -> None:
        """Puts the words' scores into the cache, which starts anew when it is full."""
        if len(self.cache) + len(words) > CACHE:
            self.cache, self.known = {}, self.known[:0]
        missing = list(words - self.cache.keys())
        if missing:
            self.cache.update(zip(missing, range(len(self.known), len(self.known) + len(missing))))
            self.known = np.concatenate((self.known, self._score(missing)))

    def label(self, docs: list[list[str]]) -> list[np.ndarray]:
        """The language (its number) of each word of each document."""
        order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
        get = self.cache.__getitem__
        lengths = np.array([len(docs[i]) for i in order], dtype=np.int64)
        ids = np.array([get(w) for i in order for w in docs[i]], dtype=np.int64)
        begins = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        steps = int(lengths[0]) if len(lengths) else 0
        active = np.searchsorted(-lengths, -np.arange(steps), side="left")  # documents longer than t
        size, stays, bests = len(self.langs), [], []
        state = np.zeros((len(docs), size))
        for t in range(steps):
            n = active[t]
            score = self.known[ids[begins[:n] + t]]
            if t:
                own = state[:n]
                best = own.argmax(axis=1)
                switched = own[np.arange(n), best] - SWITCH
                stay = own >= switched[:, None]
                state[:n] = np.where(stay, own, switched[:, None]) + score
                stays.append(stay)
                bests.append(best)
            else:
                state[:n] = score
        flat = np.zeros(len(ids), dtype=np.int32)
        now = state.argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            n = active[t]
            flat[begins[:n] + t] = now[:n]
            if t:
                stay = stays[t - 1][np.arange(n), now[:n]]
                now[:n] = np.where(stay, now[:n], bests[t - 1])
        out: list[np.ndarray] = [np.zeros(0, dtype=np.int32)] * len(docs)
        for k, i in enumerate(order):
            out[i] = flat[begins[k] : begins[k] + lengths[k]]
        return out


def learn(labelled: DataFrame) -> list[tuple[str, str, int]] | Joined:
    """The counts of a Model from rows (text, lang): all of them, or a table where they are too many to send."""
    scratch = Scratch(labelled.sparkSession, "language")
    counts = scratch.save(count_grams(labelled.where("text is not null and lang is not null")), "counts")
    size = counts.agg(F.countDistinct("gram").alias("grams"), F.countDistinct("lang").alias("langs")).first()
    if size["grams"] * size["langs"] > CELLS:
        return Joined(counts, scratch)
    return sorted((r["lang"], r["gram"], r["n"]) for r in counts.select("lang", "gram", "n").collect())


def label_spans(docs: DataFrame, counts: list[tuple[str, str, int]] | Joined, spans: bool = True) -> DataFrame:
    """docs with _lang, _share (of its letters) and, if asked, _spans (lang, first_word, n_words)."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    schema += ", _lang string, _share double" + (", _spans array<struct<lang:string,first_word:long,n_words:long>>" if spans else "")
    place = docs.columns.index("text")
    kinds = [pa.string(), pa.float64(), pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())]))]

    def labelled(model: Model, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(lo, TOGETHER)
                found = [words_of(t or "") for t in batch.column(place).to_pylist()]
                if model.langs:
                    model.learn(set().union(*found))
                    labels = model.label(found)
                out: list[list] = [[], [], []]
                for k, words in enumerate(found):
                    if not model.langs or not any(map(str.isalpha, "".join(words[:50]))) and not any(map(str.isalpha, "".join(words))):
                        out[0].append(UNKNOWN), out[1].append(0.0), out[2].append([])
                        continue
                    weight = np.fromiter(map(len, words), dtype=np.float64, count=len(words))
                    share = np.bincount(labels[k], weights=weight, minlength=len(model.langs))
                    out[0].append(model.langs[int(share.argmax())])
                    out[1].append(float(share.max() / weight.sum()))
                    if spans:
                        cuts = np.flatnonzero(np.diff(labels[k])) + 1
                        begins, ends = [0, *cuts.tolist()], [*cuts.tolist(), len(words)]
                        out[2].append([{"lang": model.langs[labels[k][a]], "first_word": a, "n_words": b - a} for a, b in zip(begins, ends)])
                n = 3 if spans else 2
                yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, t) for c, t in zip(out[:n], kinds)]], names=[*batch.schema.names, *["_lang", "_share", "_spans"][:n]])

    if isinstance(counts, Joined):
        return _by_groups(docs, counts, labelled, schema)
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    return docs.mapInArrow(tidied(lambda batches: labelled(Model(shared.value), batches)), schema)


def _by_groups(docs: DataFrame, counts: Joined, labelled, schema: str) -> DataFrame:
    """Texts in groups of about TOGETHER, each labelled with the counts of its own grams, which a join finds."""
    groups, shared = -(-docs.count() // TOGETHER) or 1, counts.shared
    keys = [f.name for f in docs.schema.fields if isinstance(f.dataType, T.AtomicType)]
    dealt = docs.withColumn("_group", F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(groups)))
    n = len(docs.columns)

    def needs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own: dict[int, set[str]] = {}
            for group, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own.setdefault(group, set()).update(words_of(text or ""))
            for group, words in own.items():
                asked = set()
                for g in {g for w in words for g in _grams(w)}:
                    for k in range(len(g)):
                        key = g[-1 - k :]
                        asked.add((k, key))
                        if k:
                            asked.add((k + 2, key[:-1]))
                if asked:
                    kinds, grams = zip(*asked)
                    yield pa.RecordBatch.from_arrays([pa.array([group] * len(kinds), pa.int64()), pa.array(kinds, pa.int32()), pa.array(grams)], names=["_group", "kind", "gram"])

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        model = Model.of(shared, zip(*[right.column(c).to_pylist() for c in ("kind", "gram", "lang", "n")]))
        return pa.Table.from_batches(labelled(model, left.select(range(n)).to_batches()))

    asked = dealt.select("_group", "text").mapInArrow(tidied(needs), "_group long, kind int, gram string").distinct()
    rows = asked.join(counts.stats, ["kind", "gram"]).select("_group", "kind", "gram", "lang", "n")
    return dealt.groupBy("_group").cogroup(rows.groupBy("_group")).applyInArrow(both, schema)


def held_out(doc_id):
    """Whether crc32 of doc_id as text leaves 2 when divided by 4 (a null doc_id is not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_spans; learned from the documents that are not held out."""
    counts = learn(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    found = label_spans(docs.select("doc_id", "text"), counts)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_share").alias("score"), F.size("_spans").alias("n_spans"))


def accepted(docs: DataFrame) -> DataFrame:
    """The documents with one known language for most of their letters, with their own columns."""
    counts = learn(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    shield = Shield(docs, ["text"])
    found = label_spans(shield.df, counts, spans=False)
    return shield.back(found.where((F.col("_lang") != UNKNOWN) & (F.col("_share") >= LEAST_SHARE)))
