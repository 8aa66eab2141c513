"""Each operator against brute force on small fixtures with nulls, empty and long texts, ties, repeated rows, clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.llm import ann, common, extraction, language, licenses, media, mixing, neardup, packing, quality, sharding
from tesserae.llm.queries import word_tokenizer
from tests.conftest import DATA

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, node string, _group string"


def fixture_rows():
    r = random.Random(4)
    word = lambda: "".join(r.choice(("an", "the", "er", "on", "ti")) for _ in range(r.randint(1, 4)))
    base = [word() for _ in range(120)]
    texts = [None, "", " \t\n", "one", "one two", "One TWO", "é à ü", "12 34", " ".join(base), " ".join(base), "x" * 5000]
    for k in range(25):
        copy = base.copy()
        for _ in range(k % 9):
            copy[r.randrange(len(copy))] = word()
        texts.append(" ".join(copy))
    texts += [" ".join(word() for _ in range(n)) + r.choice((".", " 2024!", "")) for n in (1, 2, 3, 5, 40, 300, 6000)]
    texts.append("Licensed under the Apache License, Version 2.0.\n" * 30)
    return [(i, t, r.choice(("en", "fr", None)), r.choice(("b", "a", "é", None)), None, "s", "n", "g") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = fixture_rows()
    return spark.createDataFrame(rows + [rows[8], rows[0]], SCHEMA)  # two rows again


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# 1


def test_generated_pages_are_read_right():
    trees, rng, right = extraction.trained(400, 3), random.Random(8), 0
    for _ in range(80):
        page = extraction.parse(extraction.training_page(rng))
        keep = extraction.decode(page, trees.logits(extraction.features(page)))
        right += all(keep[node] == ("§+" in text) for node, text in page.runs)
        for i, node in enumerate(page.nodes):
            assert not keep[i] or node.parent < 0 or keep[node.parent]
    assert right >= 60


PARAGRAPH = "The river rose quickly that spring, and the town council met to discuss the old bridge."
ARTICLE = "<h1>Flood report</h1>" + f"<p>{PARAGRAPH}</p>" * 5
WRITTEN = " ".join(["Flood report", *[PARAGRAPH] * 5])


@pytest.mark.parametrize(
    "page",
    [
        f"<body><div class='content'>{ARTICLE}</div><div id='footer'>Copyright 2024 The Herald</div></body>",
        f"<body><nav><a href=/>Home</a> <a href=/n>News</a></nav><article>{ARTICLE}<section><h3>Related stories</h3><ul><li><a href=/a>Other flood</a><li><a href=/b>Rain</a></ul></section></article></body>",
        f"<body><div class=x0><a href=/>Home</a> <a href=/n>News</a></div><div class=x1>{ARTICLE}</div><div class=x2><div><b>Ann</b><p>Nice one</p></div><div><b>Bob</b><p>I disagree</p></div></div></body>",
        f"<body><header><p>The Herald</p></header><main>{ARTICLE}</main><div class=x2><h3>3 Comments</h3><div><b>Ann</b><p>Nice one</p></div><div><b>Bob</b><p>No</p></div></div></body>",
        f"<body><div role=dialog class='cookie-banner'><p>We use cookies.</p></div><main><article>{ARTICLE}</article><aside><h2>Popular</h2><ul><li><a href=/q>A</a></ul></aside></main><footer><p>Imprint</p></footer></body>",
    ],
)
def test_pages_written_by_hand(page):
    assert extraction.extract_texts([page], extraction.trained()) == [WRITTEN]


@pytest.mark.parametrize("n", [5, 30, 49, 50, 200, 1000])
def test_adverts_go_from_flat_pages_of_any_length(n):
    flat = f'<body><div class="content"><h1>Flood</h1>{f"<p>{PARAGRAPH}</p>" * n}<p class="advert">Buy now cheap</p>{f"<p>{PARAGRAPH}</p>" * n}</div></body>'
    assert extraction.extract_texts([flat], extraction.trained()) == [" ".join(["Flood", *[PARAGRAPH] * (2 * n)])]


def test_decoder_equals_exhaustive_search():
    r = np.random.default_rng(3)
    for _ in range(200):
        n = int(r.integers(1, 10))
        nodes = [extraction.parse("").nodes[0]] + [type(extraction.parse("").nodes[0])("p", int(r.integers(0, i)), 0, frozenset()) for i in range(1, n)]
        logits = r.normal(0, 2, n)
        found = extraction.decode(extraction.Page(nodes, []), logits)
        gain = logits.copy()
        gain[0] = max(gain[0], 0.0)
        closed = [s for s in range(2**n) if all(not s >> i & 1 or s >> nodes[i].parent & 1 for i in range(1, n))]
        total = lambda s: sum(gain[i] for i in range(n) if s >> i & 1)
        assert abs(max(map(total, closed)) - gain[found].sum()) < 1e-9
        assert all(not found[i] or found[nodes[i].parent] for i in range(1, n))


def test_places_are_exact_among_many_siblings():
    page = extraction.parse("<body><h1>" + "long " * 300 + "</h1><div>" + "".join(f"<p>{'word ' * (1 + 7 * k % 40)}</p>" for k in range(120)) + "</div></body>")
    found = extraction.features(page)
    for i, node in enumerate(page.nodes):
        if node.parent >= 0:
            assert found[i, -23] == page.nodes[node.parent].children.index(i)
    assert max(len(node.children) for node in page.nodes) >= 120


def test_pages_table_and_odd_pages(spark):
    trees = extraction.trained(400, 3)
    pages = common.table(spark, DATA, "pages")
    for row in pages.join(extraction.main_texts(pages, trees).withColumnRenamed("text", "got"), "page_id").collect():
        inside = re.search(r"<article>(.*?)(</article>|$)", row["html"], re.S)[1]
        plain = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", inside))
        import html

        assert row["got"] == " ".join(html.unescape(plain).split()) and row["n_chars"] == len(row["got"])
    odd = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "u", "<p"), (4, "u", "<div " * 3000), (4, "u", "<article><p>a &lt; b&nbsp; c")], "page_id long, url string, html string")
    got = extraction.main_texts(odd, trees).collect()
    assert len(got) == 5 and sum(r["n_chars"] for r in got if r["page_id"] != 4) == 0
    assert extraction.main_texts(odd.limit(0), trees).count() == 0


# 2


def brute_components(rows, size, num, den):
    sets = {}
    for i, (doc, text) in enumerate(rows):
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sets:
        for j in range(i):
            same = len(sets[i] & sets[j])
            if same and den * same >= num * (len(sets[i]) + len(sets[j]) - same):
                up[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(sets[i]), least[find(i)] if sets[i] else doc) for i, (doc, _) in enumerate(rows)]


@pytest.mark.parametrize("size,threshold", [(3, Fraction(85, 100)), (5, Fraction(8, 10))])
def test_near_duplicates_equal_all_pairs(docs, size, threshold):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs, size, threshold).collect()]
    assert sorted(got) == sorted(brute_components(rows, size, threshold.numerator, threshold.denominator))


def test_near_duplicates_without_a_centre(spark):
    """Copies of a base that is missing, sketches far smaller than sets: the exact prefixes find what stars miss."""
    r = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(40):
        copy = base.copy()
        for _ in range(r.randint(1, 5)):
            copy[r.randrange(200)] = f"z{r.random()}"
        rows.append((i, " ".join(copy)))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, Fraction(85, 100)).collect()
    assert sorted((g["doc_id"], g["n_shingles"], g["component_id"]) for g in got) == sorted(brute_components(rows, 3, 85, 100))


def test_small_sets_at_the_threshold_are_linked(spark):
    """63 five-word shingles each, 56 of them shared: a similarity of exactly 0.8."""
    rows = []
    for k in range(40):
        text = [f"w{k}x{i}" for i in range(67)]
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(text[:60] + [f"v{k}x{i}" for i in range(7)]))]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=5, threshold=Fraction(8, 10)).collect()
    assert all(g["n_shingles"] == 63 and g["component_id"] == g["doc_id"] // 2 * 2 for g in got) and len(got) == 80


def test_rows_without_an_id_of_their_own_stay_by_their_texts(spark):
    r = random.Random(5)
    text = lambda k: [f"t{k}x{i}" for i in range(80)]
    near = lambda k: " ".join(text(k)[:-1] + ["other"])
    rows = [(None, " ".join(text(k))) for k in range(6)] + [(7, " ".join(text(k))) for k in range(6, 9)]
    rows += [(None, near(0)), (None, near(6)), (9, near(1)), (7, near(8)), (None, " ".join(text(2))), (None, None), (7, "")]
    r.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    left = [(d, t) for d, t in map(tuple, neardup.representatives(frame).collect()) if t]
    group = lambda t: t.split("x")[0]
    assert sorted(group(t) for _, t in left) == [f"t{k}" for k in range(9)]  # one of each, none else
    assert (9, near(1)) in left and (7, " ".join(text(6))) in left
    flags = neardup.near_duplicates(frame).collect()
    assert len(flags) == len(rows) and sum(g["kept"] for g in flags if g["n_shingles"]) == len(left) + 1  # the equal rows are both flagged
    assert neardup.representatives(frame).where("text is null or text = ''").count() == 2


def test_repeated_and_missing_ids_are_linked_by_their_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(100)), " ".join(f"b{i}" for i in range(100))
    rows = [(1, a), (1, b), (2, a + " tail"), (3, b + " tail")]
    got = {(g["doc_id"], g["component_id"]) for g in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1), (2, 1), (3, 1)}
    got = {(g["doc_id"], g["component_id"]) for g in neardup.near_duplicates(spark.createDataFrame([(None, a), (5, a + " tail")], "doc_id long, text string")).collect()}
    assert got == {(None, 5), (5, 5)}


@pytest.mark.parametrize("bits", [0, 3])
def test_sets_of_one_fingerprint_stay_apart(docs, bits):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in neardup.linked(docs, 3, Fraction(85, 100), node_bits=bits).collect()]
    assert sorted(got) == sorted(brute_components(rows, 3, 85, 100))


def test_near_duplicates_of_nothing(empty):
    assert neardup.near_duplicates(empty).count() == 0


# 3


def test_language_of_held_out_documents(spark):
    docs = common.table(spark, DATA, "documents")
    got = language.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 20 and sum(g["lang"] == g["lang_pred"] for g in got) >= 0.95 * len(got)


def test_language_edges_and_spans(docs, spark, empty):
    got = {r["doc_id"]: r for r in language.predict(docs).collect()}
    assert got[0]["lang_pred"] == got[7]["lang_pred"] == "und" and got[0]["score"] == 0 and 0 <= got[20]["score"] <= 1
    assert language.predict(empty).count() == 0
    train = [("the cat and the dog went over the hill " * 20, "en"), ("der hund und die katze gehen über den berg " * 20, "de"), ("кошка и собака идут через гору " * 20, "ru")]
    counts = language.learn(spark.createDataFrame(train, "text string, lang string"))
    mixed = "the dog went over the hill and the cat " * 3 + "der hund und die katze gehen über den berg " * 3 + "кошка и собака"
    spans = language.label_spans(spark.createDataFrame([(mixed,)], "text string"), counts).first()["_spans"]
    assert [s["lang"] for s in spans] == ["en", "de", "ru"] and [s["first_word"] for s in spans] == [0, 27, 54]


def test_every_language_counts_and_both_ways_agree(spark, docs, monkeypatch):
    r = random.Random(3)
    rows = []
    for k in range(270):
        own = "".join(chr(0x4E00 + 40 * k + i) for i in range(40))
        rows += [(4 * k + i, " ".join("".join(r.choices(own, k=4)) for _ in range(12)), f"l{k:03}") for i in range(4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).cache()
    lang = {d: x for d, _, x in rows}
    sent = {g["doc_id"]: tuple(g) for g in language.predict(frame).collect()}
    trained = {lang[d] for d, g in sent.items() if not g[1]}
    assert len(trained) > 256 and all(sent[d][2] == x for d, x in lang.items() if x in trained)
    both = [(frame, sent)] + [(docs, None)]
    for table, whole in both:
        whole = sorted(map(tuple, language.predict(table).collect()), key=str) if whole is None else sorted(whole.values(), key=str)
        with monkeypatch.context() as m:
            m.setattr(language, "CELLS", 0)
            m.setattr(language, "TOGETHER", 100)
            assert isinstance(language.learn(table.select("text", "lang")), language.Joined)
            assert sorted(map(tuple, language.predict(table).collect()), key=str) == whole


def test_decoding_equals_exhaustive_search():
    import itertools

    r = random.Random(5)
    model = language.Model([("a", "x", 1), ("b", "y", 1), ("c", "z", 1)])
    vocabulary = [f"w{i}" for i in range(12)]
    model.cache = {w: i for i, w in enumerate(vocabulary)}
    model.known = np.array([[r.choice((0.0, -2.5, -5.0, language.CLIP, -7.25)) for _ in range(3)] for _ in vocabulary])
    texts = [[r.choice(vocabulary) for _ in range(r.randint(1, 7))] for _ in range(60)] + [[]]
    worth = lambda words, path: sum(model.known[model.cache[w], x] for w, x in zip(words, path)) - language.SWITCH * sum(x != y for x, y in zip(path, path[1:]))
    for words_, got in zip(texts, model.label(texts)):
        best = max(worth(words_, path) for path in itertools.product(range(3), repeat=len(words_)))
        assert len(got) == len(words_) and abs(worth(words_, got.tolist()) - best) < 1e-9
    long = ["w0"] * 9 + ["w1"] * 9  # spans long enough to be worth a switch
    model.known[:2] = [[0, -8, -8], [-8, 0, -8]]
    assert model.label([long])[0].tolist() == [0] * 9 + [1] * 9


# 4


def test_base_phrases_equal_a_plain_loop(spark):
    r = random.Random(6)
    pool = "MIT mit License license, apache Apache-license general public General gnu é license2 the".split()
    texts = [" ".join(r.choice(pool) + r.choice(("", "", ".", "\n")) for _ in range(r.randint(0, 60))) for _ in range(150)] + [None, "", "mit", "MIT\tLICENSE", "mitlicense", "mit license license mit license"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {g["doc_id"]: g for g in licenses.license_digest(rows).collect()}
    for i, text in enumerate(texts):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        at = [(k, label) for k in range(len(own)) for phrase, label in licenses.BASE.items() if own[k : k + len(phrase.split())] == phrase.split()]
        places = [k for k, _ in at]
        want = (len(own), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at})))
        assert tuple(got[i][c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == want


def test_lesser_and_affero_notices_are_told_apart():
    begin, end = "under the terms of the gnu ", " general public license as published by the free software foundation"
    for kind, label in (("lesser", "lgpl-notice"), ("affero", "agpl-notice"), ("leser", "lgpl-notice")):
        assert label in {f[0] for f in licenses.find_notices(begin + kind + end)}
    assert [f[0] for f in licenses.find_notices("spdx licence identifier mit")] == ["spdx"]


def test_licenses(docs, empty):
    found = {r["doc_id"]: r for r in licenses.license_digest(docs).collect()}
    last = max(found)
    assert found[last]["n_base"] == 30 and found[last]["labels"] == "apache,apache-2.0" and found[last]["first_word"] == 3 and found[0]["labels"] == ""
    assert licenses.license_digest(empty).count() == 0


def test_every_notice_within_its_bound_is_found():
    import regex

    r = random.Random(2)
    for notice, label in licenses.NOTICES:
        edits = max(1, len(notice) // licenses.CHARS_PER_EDIT)
        for _ in range(6):
            s = list(notice)
            for _ in range(r.randint(0, edits)):
                k = r.randrange(len(s))
                s[k : k + 1] = r.choice(("", "q", s[k] + "q"))
            text = "some words before " + "".join(s) + " and after"
            wanted = regex.search(f"(?b)(?:{notice}){{e<={edits}}}", text)
            got = [g for g in licenses.find_notices(text) if g[0] == label]
            assert got and got[0][3] <= sum(wanted.fuzzy_counts)


# 5


def test_media_round_trip(docs, empty):
    rows, got = docs.collect(), media.media_digest(docs).collect()
    want = Counter()
    for r in rows:
        raw = (r["text"] or "").encode()
        p = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        want[(r["doc_id"], len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))] += 1
    assert Counter((g["doc_id"], g["n_bytes"], g["payload_bytes"], g["payload_sha256"], g["tail_crc32"]) for g in got) == want
    assert media.media_digest(empty).count() == 0


def test_chunks_resist_insertions_and_rolling_hash_is_a_window():
    r = random.Random(1)
    data = bytes(r.randrange(256) for _ in range(60_000))
    cut = lambda p: {p[sum(c[:i]) : sum(c[: i + 1])] for c in media.cut_lengths([p]) for i in range(len(c))}
    a, b = cut(data), cut(data[:30_000] + b"new" + data[30_000:])
    assert len(a & b) >= len(a) - 4 and all(len(x) <= media.MOST for x in a)
    h = media.gear_hashes(np.frombuffer(data[:200], dtype=np.uint8))
    plain = sum(int(media._GEAR[data[150 - j]]) << j for j in range(media.WINDOW)) % 2**32
    assert int(h[150]) == plain


def test_media_refuses_a_wrong_chunk(docs, spark):
    table, store = media.write_media(docs, common.Scratch(spark, "t"))
    assert store.count() > 0
    with pytest.raises(Exception, match="differs from its digest"):
        media.read_media(table, store.withColumn("bytes", F.lit(b"x"))).count()


# 6


def test_hashing_recall_and_order(spark):
    table = common.table(spark, "/root/testdata/sf0.01", "embeddings")
    odd = [(10_000_000, None), (10_000_100, [0.0] * 64), (10_000_200, [float("nan")] * 64), (10_000_300, [1.0, None] * 32)]
    odd = spark.createDataFrame(odd, "vec_id long, embedding array<float>")
    rows = table.select("vec_id", "embedding")
    got = ann.nearest(rows.unionByName(odd).unionByName(rows.limit(3)), rows.unionByName(odd).where("vec_id % 100 = 0")).collect()
    data = {r["vec_id"]: np.array(r["embedding"], dtype=np.float64) for r in rows.collect()}
    by = {}
    for g in got:
        by.setdefault(g["query_id"], []).append((g["rank"], g["vec_id"], g["score"]))
    hit = 0
    for q in (i for i in data if i % 100 == 0):
        every = sorted((float(np.sqrt(((v - data[q]) ** 2).sum())), i) for i, v in data.items() if i != q)[:10]
        mine = sorted(by[q])
        assert [m[0] for m in mine] == list(range(1, 11)) and [(m[2], m[1]) for m in mine] == sorted((m[2], m[1]) for m in mine)
        assert all(abs(m[2] - np.sqrt(((data[m[1]] - data[q]) ** 2).sum())) < 1e-12 for m in mine)
        hit += len({i for _, i in every} & {m[1] for m in mine})
    assert len(by) == 5 and hit >= 45


def test_probing_finds_every_code_within_the_radius():
    codes = np.random.default_rng(0).integers(0, 1 << 16, (500, 3))
    block = ann.Block(codes)
    for radius in (0, 3, 11, 17, 48):
        want = np.flatnonzero(np.bitwise_count(codes ^ codes[7]).sum(axis=1) <= radius)
        assert block.within(codes[7], radius).tolist() == want.tolist()


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (100, [1.0, 0.0]), (7, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = ann.nearest(few, few.where("vec_id % 100 = 0")).collect()
    assert sorted((g["query_id"], g["rank"], g["vec_id"]) for g in got) == [(0, 1, 100), (0, 2, 7), (100, 1, 0), (100, 2, 7)]
    assert ann.nearest(few.limit(0), few.limit(0)).count() == 0


# 7


def test_sharding_equals_the_loop(docs, empty):
    def jump(key, n):
        b, j = -1, 0
        while j < n:
            b, key = j, (key * sharding.MULTIPLIER + 1) % 2**64
            j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
        return b

    got = sharding.shard_documents(docs).collect()
    assert all(g["shard"] == jump(g["doc_id"], 8) and g["grown_shard"] == jump(g["doc_id"], 9) for g in got)
    text = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    assert all(g["size"] == len(text[g["doc_id"]]) + 1 and g["text_crc32"] == zlib.crc32(text[g["doc_id"]]) for g in got)
    slots = {}
    for g in got:
        slots.setdefault(g["shard"], []).append(g["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(got) == docs.count()
    assert sharding.shard_documents(empty).count() == 0


def test_keys_of_any_sign(spark):
    keys = spark.createDataFrame([(None,), (-5,), (2**62,)], "k long")
    assert sharding.assign(keys, "k", 5).where("shard between 0 and 4").count() == 3


# 8


def test_mixing_meets_targets(docs, empty):
    sizes = {}
    for r in docs.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(words(r["text"]))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, full = {s: 0.0 for s in order}, set()
    while True:  # the rule as stated: share, stop, share the excess again
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        target = {s: 3.0 * sizes[s] if s in full else rest * weight[s] / sum(weight[o] for o in open_) for s in order}
        over = {s for s in open_ if target[s] > 3 * sizes[s]}
        if not over:
            break
        full |= over
    got = mixing.streams(docs, ["text"]).collect()
    assert all(abs(g["target"] - target[g["source"]]) < 1e-5 and g["size"] == len(words(g["text"])) for g in got)
    taken = mixing.mix_documents(docs).collect()
    assert all(0 <= g["taken"] <= 3 * g["size"] for g in taken)
    assert abs(sum(g["taken"] for g in taken) - sum(target.values())) <= len(target)
    assert sorted(map(tuple, taken)) == sorted(map(tuple, mixing.mix_documents(docs.repartition(3)).collect()))
    assert mixing.mix_documents(empty).count() == 0


def test_splitting_tree_is_exact_and_shards_are_disjoint(spark, docs):
    counts = mixing.split_quotas(np.array([1000, 10, 0, 333]), 7, 1)
    assert counts.sum(axis=0).tolist() == [1000, 10, 0, 333] and max(counts.sum(axis=1)) - min(counts.sum(axis=1)) <= 1
    rows = mixing.mix_to_shards(spark, docs, 3, block=16).collect()
    assert sum(r["n_words"] for r in rows) == sum(r["taken"] for r in mixing.mix_documents(docs).collect())
    owners = {}
    for r in rows:
        owners.setdefault((r["source"], r["block"]), set()).add(r["shard"])
    assert all(len(o) == 1 for o in owners.values())


def test_taken_is_what_the_shards_draw(spark, docs, monkeypatch):
    whole = {}
    for r in mixing.mix_to_shards(spark, docs).collect():
        whole[r["doc_id"]] = whole.get(r["doc_id"], 0) + r["n_words"]
    taken = {}
    for r in mixing.mix_documents(docs).collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["taken"]
    assert {d: n for d, n in taken.items() if n} == whole
    rows = mixing.streams(docs)
    exact = rows.select("doc_id", "size", "source_size", "target", mixing.taken_of()[1].alias("taken")).collect()
    assert sorted(map(tuple, exact), key=str) == sorted(map(tuple, mixing.mix_documents(docs).collect()), key=str)
    # quotas that the tree does not hand to a shard are not taken
    tree = mixing.split_quotas
    monkeypatch.setattr(mixing, "split_quotas", lambda *args: tree(*args) // 2)
    fewer = sum(r["taken"] for r in mixing.mix_documents(docs).collect())
    assert fewer == sum(r["n_words"] for r in mixing.mix_to_shards(spark, docs).collect()) < sum(taken.values())
    kept = sum(len(words(r["text"])) for r in mixing.mixed_documents(docs).collect())
    assert kept == fewer


# 9


def test_kneser_ney_sums_to_one_and_equals_brute_force(spark):
    texts = ["abab abc", "the cat the hat", "abba"]
    order = 3
    rows = quality.train(spark.createDataFrame([(t,) for t in texts], "text string"), order, common.Scratch(spark, "t")).toArrow()
    scorer = quality.Scorer(*quality._columns(rows), order)
    for context in (b"ab", b"th", b"zz"):
        logs = [scorer.logs(np.array([(context[0] << 16) | (context[1] << 8) | w], dtype=np.int64))[0] for w in range(256)]
        assert abs(np.exp(logs).sum() - 1) < 1e-4
    grams = Counter()
    for t in texts:
        p = b"\xff" * (order - 1) + t.encode()
        grams.update(p[i : i + order] for i in range(len(p) - order + 1))
    tables = {3: grams}
    for k in (2, 1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])

    def cuts(c):
        n = Counter(c.values())
        if not n[1] or not n[2]:
            return 0.5, 0.5, 0.5
        y = n[1] / (n[1] + 2 * n[2])
        d = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 0.5]
        return [min(max(v, 0.05), k + 0.95) for k, v in enumerate(d)]

    def p(gram):
        if not gram:
            return 1 / 256
        table, d = tables[len(gram)], cuts(tables[len(gram)])
        same = {g: n for g, n in table.items() if g[:-1] == gram[:-1]}
        if not same:
            return p(gram[1:])
        total = sum(same.values())
        n = same.get(gram, 0)
        return max(n - d[min(n, 3) - 1], 0) / total * (n > 0) + sum(d[min(v, 3) - 1] for v in same.values()) / total * p(gram[1:])

    for gram in (b"aba", b"the", b"qhe", b"zzz", b"xab"):
        code = int.from_bytes(gram, "big")
        assert abs(scorer.logs(np.array([code]))[0] - np.log(p(gram))) < 1e-4


def test_both_ways_of_scoring_agree_and_junk_goes(spark):
    docs, labels = common.table(spark, DATA, "documents"), common.table(spark, DATA, "labels")
    scratch = common.Scratch(spark, "t")
    model = scratch.save(quality.train(docs.select("text"), 4, scratch), "model")
    some = docs.select("doc_id", "text").limit(60)
    one = {r["doc_id"]: r["_log"] for r in quality.add_logs(some, model, 4, scratch).collect()}
    two = {r["doc_id"]: r["_log"] for r in quality.add_logs(some, model, 4, scratch, broadcast_rows=0).collect()}
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-6 for k in one)
    kept = {r["doc_id"]: r["kept"] for r in quality.classify(docs, labels).collect()}
    good = [kept[r["doc_id"]] for r in labels.where("quality = 1").collect()]
    bad = [kept[r["doc_id"]] for r in labels.where("quality = 0").collect()]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_quality_edges(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.classify(docs, none).collect()}
    assert got[0]["perplexity"] is None and not got[0]["kept"] and got[8]["kept"]
    assert quality.classify(empty, none).count() == 0


# 10


def test_packing_round_trip(docs, empty):
    from tokenizers import Tokenizer

    reader = Tokenizer.from_file(word_tokenizer())
    want = Counter()
    for r in docs.collect():
        raw = np.array(reader.encode(r["text"] or "", add_special_tokens=False).ids + [0], dtype="<u4").tobytes()
        for k in range(0, len(raw), 8192):
            want[(r["doc_id"], k // 8192, k // 4, len(raw[k : k + 8192]) // 4, zlib.crc32(raw[k : k + 8192]))] += 1
    got = packing.pack_documents(docs, word_tokenizer()).collect()
    assert Counter(tuple(g[:5]) for g in got) == want
    bins = {}
    for g in got:
        bins.setdefault(g["sequence_id"], []).append((g["offset"], g["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= 1.1 * -(-sum(k[3] for k in want.elements()) // 2048) + 1
    assert packing.pack_documents(empty, word_tokenizer()).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_constraint_holds(rule):
    lengths = np.sort(np.random.default_rng(1).integers(1, 400, 3000))[::-1]
    cap = packing.Capacity(1000, 4, 300_000, rule=rule)
    seq, offset = packing.best_fit(lengths, cap)
    for s in np.unique(seq):
        own = lengths[seq == s]
        assert own.sum() <= 1000 and len(own) <= 4 and (own.astype(float) ** 2).sum() <= 300_000


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("limits", [(2048, 2048, 2048**2), (1000, 4, 300_000), (900, 90, 250_000)])
def test_choice_equals_a_plain_loop(rule, limits):
    lengths = np.sort(np.random.default_rng(7).integers(1, 500, 400))[::-1]
    cap = packing.Capacity(*limits, rule=rule, weights=(1.0, 0.3, 0.7))
    seq, offset = packing.best_fit(lengths, cap)
    bins = {}  # name: what is left of each capacity
    for i, length in enumerate(lengths.tolist()):
        item, best = (length, 1, length * length), None
        for left in bins.values():
            if all(r >= x for r, x in zip(left, item)):
                if rule == "dot":
                    score = -sum(w / c**2 * x * r for w, c, x, r in zip(cap.weights, limits, item, left))
                else:
                    score = sum(w / c**2 * (r - x) ** 2 for w, c, x, r in zip(cap.weights, limits, item, left))
                best = score if best is None else min(best, score)
        name = int(seq[i])
        if best is None:
            assert name not in bins
            bins[name] = list(limits)
        else:
            chosen = bins[name]
            own = -sum(w / c**2 * x * r for w, c, x, r in zip(cap.weights, limits, item, chosen)) if rule == "dot" else sum(w / c**2 * (r - x) ** 2 for w, c, x, r in zip(cap.weights, limits, item, chosen))
            assert abs(own - best) < 1e-12  # ties may go either way
        assert offset[i] == limits[0] - bins[name][0]
        bins[name] = [r - x for r, x in zip(bins[name], item)]
        assert min(bins[name]) >= 0


def test_each_capacity_binds_alone():
    lengths = np.full(64, 10)
    count = lambda **given: len(np.unique(packing.best_fit(lengths, packing.Capacity(**given))[0]))
    assert count() == 1  # as registered, the tokens alone limit
    assert count(tokens=80) == 8 and count(documents=4) == 16 and count(attention=1000) == 7


def test_encoder_equals_the_tokenizer_on_odd_texts():
    enc, r = packing.RunEncoder(word_tokenizer()), random.Random(1)
    texts = ["it's, don't we'll X's İstanbul ΣΑΣ. ﬁn é", "<|endoftext|> <|ENDOFTEXT|>", "", "日本語 ß ſ K", "x.,;y. a., b.\x1cc \x85 d", "각 각. ñ̃, x̀! a̸. ‼", "don.'t 's 't. x'll! İ. È, (é) {a}~"]
    texts += ["".join(r.choice(" \n.,'abzABZéÉß́­<|x12日") for _ in range(80)) for _ in range(60)]
    for text, ids in zip(texts, enc.encode(texts)):
        assert ids.tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids
