"""Fuzzy search of short licence notices in whole texts.

Texts are lower-cased (A-Z) and reduced to words, joined by a blank. A notice of L characters may differ by k edits:
split into k + 1 parts, one part at least occurs unchanged (pigeonhole). One automaton over all parts of all notices finds
these seeds; each gives the place where its notice would begin; places within k of each other form one window. A
window that holds the notice, or enough of its 3-grams (an edit spoils three), goes on; there
the regex library's bounded-error matching confirms the notice, counts the edits and gives the span. No notice within
its bound is missed, and a window is never longer than the notice and a few times k.

Base labels are exact phrases of whole words, found apart from that.

Defined cases: a null or empty text has no words, no labels, null places and score 0; repeated rows give equal rows; texts
of any length are searched whole, with work in proportion to length and hits; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import tidied

#: Exact phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Short notices as words, and the method's labels.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("released under the mit license", "mit-notice"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit-notice"),
    ("licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl-notice"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd-notice"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc-notice"),
    ("this software is provided as is without any express or implied warranty in no event will the authors be held liable", "zlib-notice"),
    ("distributed under the boost software license version 1 0", "bsl-1.0"),
    ("under the terms of the gnu lesser general public license as published by the free software foundation", "lgpl-notice"),
    ("under the terms of the gnu affero general public license as published by the free software foundation", "agpl-notice"),
    ("licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa-4.0"),
    ("spdx license identifier", "spdx"),
)
#: One edit is allowed for so many characters of a notice.
CHARS_PER_EDIT = 12
#: Length of the grams that a window must mostly hold before the costly match.
GRAM = 3

_DELIMITERS = bytes(range(0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80))
#: A-Z to a-z, what is in no word to a blank; bytes of other characters stay.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else 32 if b in _DELIMITERS else b for b in range(256))


def normal_words(text: str) -> list[bytes]:
    return text.encode().translate(_NORMAL).split()


@lru_cache(maxsize=8)
def _machine(notices: tuple[tuple[str, str], ...], per_edit: int):
    import ahocorasick
    import regex

    machine, rules, seeds = ahocorasick.Automaton(), [], {}
    for i, (notice, label) in enumerate(notices):
        edits = max(1, len(notice) // per_edit)
        rule = regex.compile(f"(?b)(?:{regex.escape(notice, special_only=True)}){{e<={edits}}}")
        grams = [notice[j : j + GRAM] for j in range(len(notice) - GRAM + 1)]
        # an edit spoils GRAM of them at most
        rules.append((label, notice, edits, rule, grams, len(grams) - GRAM * edits))
        for p in range(edits + 1):
            lo, hi = p * len(notice) // (edits + 1), (p + 1) * len(notice) // (edits + 1)
            seeds.setdefault(notice[lo:hi], []).append((i, hi))
    for seed, owners in seeds.items():
        machine.add_word(seed, owners)
    machine.make_automaton()
    return machine, rules


def find_notices(text: str, notices=NOTICES, per_edit: int = CHARS_PER_EDIT) -> list[tuple[str, int, int, int]]:
    """(label, begin, end, edits) of the notices in a normalised text."""
    machine, rules = _machine(tuple(notices), per_edit)
    begins: dict[int, list[int]] = {}
    for last, owners in machine.iter(text):
        for i, hi in owners:
            begins.setdefault(i, []).append(last + 1 - hi)
    found: set[tuple[str, int, int, int]] = set()
    for i, at in begins.items():
        label, notice, edits, rule, grams, least = rules[i]
        at.sort()
        k = 0
        while k < len(at):
            low = high = at[k]
            while k < len(at) and at[k] - low <= 2 * edits:
                high = at[k]
                k += 1
            lo = max(0, low - edits)
            window = text[lo : high + len(notice) + edits + 1]
            if (at_once := window.find(notice)) >= 0:
                found.add((label, lo + at_once, lo + at_once + len(notice), 0))
            elif sum(g in window for g in grams) >= least and (m := rule.search(window)):
                found.add((label, lo + m.start(), lo + m.end(), sum(m.fuzzy_counts)))
    kept: dict[str, tuple[str, int, int, int]] = {}
    out = []
    for span in sorted(found, key=lambda f: (f[0], f[1], f[3])):  # of two that overlap, the one with fewer edits
        last = kept.get(span[0])
        if last is None or span[1] >= last[2]:
            out.append(span)
            kept[span[0]] = span
        elif span[3] < last[3]:
            out[-1] = kept[span[0]] = span
    return sorted(out, key=lambda f: (f[1], f[2], f[0]))


def find_phrases(words: list[bytes], phrases=BASE) -> list[tuple[int, str]]:
    """(start word, label) of every place of each phrase."""
    places = []
    for phrase, label in phrases.items():
        parts = phrase.encode().split()
        rare, at = len(parts) - 1, -1
        while True:
            try:
                at = words.index(parts[rare], at + 1)
            except ValueError:
                break
            if at >= rare and words[at - rare : at + 1] == parts:
                places.append((at - rare, label))
    return places


SCANNED = "doc_id long, n_words long, places array<struct<start_word:long,label:string>>, notices array<struct<label:string,begin:long,end:long,edits:int,similarity:double>>"


def scan(docs: DataFrame, notices=NOTICES, phrases=BASE, per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """doc_id, n_words, places of the exact phrases and spans of the notices in the normalised text."""
    notices, phrases = tuple(notices), dict(phrases)
    last_words = sorted({p.split()[-1].encode() for p in phrases})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start_word", pa.int64()), ("label", pa.string())])), pa.list_(pa.struct([("label", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()), ("similarity", pa.float64())]))]
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for doc, text in zip(batch.column(0), batch.column(1)):
                words = normal_words(text.as_py())
                plain = b" ".join(words)
                places = find_phrases(words, phrases) if any(w in plain for w in last_words) else []
                spans = find_notices(plain.decode("latin-1"), notices, per_edit)
                out[0].append(doc.as_py())
                out[1].append(len(words))
                out[2].append([{"start_word": p, "label": x} for p, x in sorted(places)])
                out[3].append([{"label": x, "begin": a, "end": b, "edits": e, "similarity": 1 - e / (b - a)} for x, a, b, e in spans])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["doc_id", "n_words", "places", "notices"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(tidied(run), SCANNED)


def license_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_notices, best_edits."""
    found = scan(docs)
    starts = F.transform("places", lambda p: p["start_word"])
    base, own = F.transform("places", lambda p: p["label"]), F.transform("notices", lambda n: n["label"])
    text = lambda labels: F.array_join(F.sort_array(F.array_distinct(labels)), ",")
    best = F.coalesce(F.array_max(F.transform("notices", lambda n: n["similarity"])), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        text(base).alias("base_labels"), text(F.concat(base, own)).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), best)).alias("score"),
        F.size("notices").cast("long").alias("n_notices"), F.array_min(F.transform("notices", lambda n: n["edits"])).alias("best_edits"),
    )
