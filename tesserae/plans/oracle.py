"""The registered queries as SQL for DuckDB, over the same tables: written apart from the operators' code."""

from __future__ import annotations

from tesserae.functions.text import ABBREVIATIONS, BLANKED, DROPPED, LEGAL_FORMS
from tesserae.operators.model import LINEAR
from tesserae.sources.fixture import CTES

import re


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _ws(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def _punct(x: str) -> str:
    return f"translate(replace({x}, '&', ' and '), {_q(BLANKED + DROPPED)}, {_q(' ' * len(BLANKED))})"


def _norm(x: str) -> str:
    return _ws(_punct(f"lower(strip_accents({x}))"))


def _name(x: str) -> str:
    return _ws(rf"regexp_replace({_norm(x)}, '\.(\s|$)', ' \1', 'g')")


def _core(x: str) -> str:
    for _ in range(2):
        for w in LEGAL_FORMS:
            x = f"regexp_replace({x}, {_q(chr(92) + 'b' + re.escape(w) + chr(92) + 'b')}, ' ', 'g')"
        x = _ws(x)
    return x


def _address(x: str) -> str:
    x = _norm(x)
    for short, long in ABBREVIATIONS.items():
        x = rf"regexp_replace({x}, '\b{short}\b', '{long}', 'g')"
    return _ws(x)


def _tok(x: str) -> str:
    return rf"list_filter(string_split_regex({x}, '\s+'), lambda w: w <> '')"


def _nums(x: str) -> str:
    return rf"regexp_extract_all({x}, '\d+')"


def _long(x: str) -> str:
    return f"list_filter({_nums(x)}, lambda w: len(w) >= 3)"


def _clean(source: str) -> str:
    return f"""SELECT entity_id, business_name, business_address, country, business_name_norm, {_core("business_name_norm")} AS business_name_core,
 {_address("business_address")} AS business_address_norm, {_ws("lower(strip_accents(country))")} AS country_norm,
 CAST(trim(business_name) = '' AS BIGINT) AS name_missing, CAST(trim(business_address) = '' AS BIGINT) AS address_missing, CAST(trim(country) = '' AS BIGINT) AS country_missing,
 len(business_name) AS name_char_length, len(business_address) AS address_char_length, len({_tok("business_name")}) AS name_token_count, len({_tok("business_address")}) AS address_token_count
 FROM (SELECT *, {_name("business_name")} AS business_name_norm FROM {source})"""


def _exact(key: str, least: int) -> str:
    parts = []
    for n, src in ((2, "S2"), (3, "S3")):
        parts.append(f"""SELECT DISTINCT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id, '{src}' AS candidate_source
 FROM (SELECT entity_id, {key} AS key FROM c1) a JOIN (SELECT *, count(*) OVER (PARTITION BY key) AS f FROM (SELECT entity_id, {key} AS key FROM c{n}) WHERE len(key) >= {least}) b ON a.key = b.key WHERE b.f <= 500""")
    return " UNION ALL ".join(parts)


_SIGNATURE = f"array_to_string(list_sort({_long('business_address_norm')}), '-')"
_PASSES = {"name": _exact("business_name_norm", 2), "core": _exact("business_name_core", 3), "address": _exact("business_address_norm", 5), "numeric": _exact(_SIGNATURE, 3)}


def _rare(column: str, n: int, source: str, cap: int = 1000) -> str:
    return f"""SELECT DISTINCT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id, '{source}' AS candidate_source
 FROM (SELECT entity_id, unnest({_tok(column)}) AS w FROM c1) a
 JOIN (SELECT entity_id, w, count(*) OVER (PARTITION BY w) AS f FROM (SELECT entity_id, unnest({_tok(column)}) AS w FROM c{n}) WHERE len(w) >= 4) b ON a.w = b.w WHERE b.f BETWEEN 2 AND {cap}"""


def _rares(column: str) -> str:
    return " UNION ALL ".join(_rare(column, n, f"S{n}") for n in (2, 3))


def _mask(c: str, b: str) -> str:
    return f"list_sum(list_transform(range(1, len({b}) + 1), lambda j: CASE WHEN {b}[j] = {c} THEN 1::HUGEINT << (j - 1)::HUGEINT ELSE 0::HUGEINT END))::HUGEINT"


def _lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence by the bit-parallel recurrence."""
    full = f"((1::HUGEINT << len({b})::HUGEINT) - 1)"
    fold = f"list_reduce(list_prepend({full}, list_transform(string_split({a}, ''), lambda c: {_mask('c', b)})), lambda s, m: ((s + (s & m)) | (s & xor({full}, m))) & {full})"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE len({b}) - bit_count({fold}) END"


def _sorted(x: str) -> str:
    return f"array_to_string(list_sort({_tok(x)}), ' ')"


def _ratio(a: str, b: str) -> str:
    return f"2.0::DOUBLE * lcs / greatest(len({a}) + len({b}), 1)"


def _score_cte(kind: str, column: str) -> dict[str, str]:
    """Distinct pairs of a column's strings with ratio, token_sort, token_set."""
    a, b = f"{column}_1", f"{column}_2"
    rest = lambda x, y: f"array_to_string(list_sort(list_filter(list_distinct({_tok(x)}), lambda w: NOT list_contains({_tok(y)}, w))), ' ')"
    return {
        f"{kind}_strings": f"SELECT DISTINCT {a} AS a, {b} AS b FROM rec",
        f"{kind}_parts": f"SELECT a, b, {_sorted('a')} AS sa, {_sorted('b')} AS sb, {rest('a', 'b')} AS da, {rest('b', 'a')} AS db, len(array_to_string(list_intersect(list_distinct({_tok('a')}), list_distinct({_tok('b')})), ' ')) AS c FROM {kind}_strings",
        f"{kind}_lcs": f"SELECT *, {_lcs('a', 'b')} AS l, {_lcs('sa', 'sb')} AS ls, {_lcs('da', 'db')} AS ld FROM {kind}_parts",
        f"{kind}_sizes": f"SELECT *, c + CAST(c > 0 AS BIGINT) + len(da) AS la, c + CAST(c > 0 AS BIGINT) + len(db) AS lb FROM {kind}_lcs",
        f"{kind}_scores": f"""SELECT a, b,
 CASE WHEN a = '' AND b = '' THEN 1.0 WHEN a = '' OR b = '' THEN 0.0 ELSE 2.0::DOUBLE * l / (len(a) + len(b)) END AS ratio,
 CASE WHEN a = '' OR b = '' THEN 0.0 ELSE 2.0::DOUBLE * ls / (len(sa) + len(sb)) END AS token_sort,
 CASE WHEN a = '' OR b = '' THEN 0.0 WHEN c > 0 AND (da = '' OR db = '') THEN 1.0 WHEN c = 0 THEN 1 - (len(da) + len(db) - 2 * ld)::DOUBLE / (la + lb)
 ELSE greatest(1 - (len(da) + len(db) - 2 * ld)::DOUBLE / (la + lb), 2.0::DOUBLE * c / (c + la), 2.0::DOUBLE * c / (c + lb)) END AS token_set FROM {kind}_sizes""",
    }


def _jaccard(x: str, y: str) -> str:
    return f"CASE WHEN len({x}) = 0 AND len({y}) = 0 THEN 1.0 WHEN len({x}) = 0 OR len({y}) = 0 THEN 0.0 ELSE len(list_intersect({x}, {y}))::DOUBLE / len(list_distinct(list_concat({x}, {y}))) END"


def _containment(x: str, y: str) -> str:
    return f"CASE WHEN len({x}) = 0 THEN 1.0 ELSE len(list_intersect({x}, {y}))::DOUBLE / len(list_distinct({x})) END"


def _overlap(x: str, y: str) -> str:
    return f"CASE WHEN len({x}) = 0 OR len({y}) = 0 THEN 0.0 ELSE len(list_intersect({x}, {y}))::DOUBLE / least(len(list_distinct({x})), len(list_distinct({y}))) END"


_FIELDS = ("business_name_norm", "business_name_core", "business_address_norm", "country_norm")
_SIDES = ", ".join(f"coalesce({s}.{f}, '') AS {f}_{n}" for n, s in ((1, "x"), (2, "y")) for f in _FIELDS)
_N1, _N2, _A1, _A2 = "business_name_norm_1", "business_name_norm_2", "business_address_norm_1", "business_address_norm_2"


def _native(kind: str, a: str, b: str) -> dict[str, str]:
    x, y = f"{kind}x", f"{kind}y"
    return {
        f"{kind}_jaccard": _jaccard(x, y), f"{kind}_containment": _containment(x, y), f"{kind}_token_overlap_ratio": _overlap(x, y),
        f"{kind}_common_token_count": f"len(list_intersect({x}, {y}))", f"{kind}_length_diff_norm": f"abs(len({a}) - len({b}))::DOUBLE / greatest(len({a}), len({b}), 1)",
        f"{kind}_length_ratio": f"least(len({a}), len({b}))::DOUBLE / greatest(len({a}), len({b}), 1)", f"{kind}_missing": f"CAST({a} = '' OR {b} = '' AS BIGINT)",
    }


_NAME = {"name_exact": f"CAST({_N1} = {_N2} AND {_N1} <> '' AS BIGINT)", "name_core_exact": "CAST(business_name_core_1 = business_name_core_2 AND business_name_core_1 <> '' AS BIGINT)", **_native("name", _N1, _N2)}
_ADDRESS = _native("address", _A1, _A2)
_NUMERIC = {
    "numeric_token_jaccard": _jaccard("nx", "ny"), "numeric_token_overlap": _overlap("nx", "ny"), "digit_seq_jaccard": _jaccard("dx", "dy"),
    "has_exact_digit_match": "CAST(list_has_any(dx, dy) AS BIGINT)", "numeric_count_diff": "abs(len(list_distinct(nx)) - len(list_distinct(ny)))::DOUBLE",
    "has_numeric_conflict": "CAST(len(nx) > 0 AND len(ny) > 0 AND NOT list_has_any(nx, ny) AS BIGINT)",
}
_COUNTRY = {"country_match": "CAST(country_norm_1 = country_norm_2 AND country_norm_1 <> '' AS BIGINT)", "country_missing": "CAST(country_norm_1 = '' OR country_norm_2 = '' AS BIGINT)"}
_STRUCTURE = {"source_is_s2": "CAST(candidate_source = 'S2' AS BIGINT)", "source_is_s3": "CAST(candidate_source = 'S3' AS BIGINT)", "same_first_char": f"CAST({_N1} <> '' AND {_N2} <> '' AND left({_N1}, 1) = left({_N2}, 1) AS BIGINT)"}
_ALL = _NAME | _ADDRESS | _NUMERIC | _COUNTRY | _STRUCTURE

_FSCORE = """CASE WHEN n_actual = 0 THEN CAST(n_predicted = 0 AS DOUBLE) WHEN tp = 0 THEN 0.0
 ELSE 1.25 * (tp / n_predicted::DOUBLE) * (tp / n_actual::DOUBLE) / (0.25 * (tp / n_predicted::DOUBLE) + tp / n_actual::DOUBLE) END"""
_PRECISION = "CASE WHEN n_predicted = 0 THEN 1.0 ELSE tp / n_predicted::DOUBLE END"
_RECALL = "CASE WHEN n_actual = 0 THEN 1.0 ELSE tp / n_actual::DOUBLE END"


def _md5(seed: int, *columns: str) -> str:
    return "md5(concat_ws('|', " + ", ".join([f"'{seed}'", *columns]) + "))"


_K = "source1_entity_id, candidate_entity_id"
_PAIR_HASH = lambda seed: _md5(seed, "source1_entity_id", "candidate_entity_id")


def _sweep(where: str = "TRUE", extra: str = "") -> str:
    """The plain form: every entity with every threshold."""
    return f"""SELECT threshold{extra}, round(avg(f), 6) AS macro_f05, round(avg(p), 6) AS macro_precision, round(avg(r), 6) AS macro_recall, sum(tp)::BIGINT AS tp, sum(n_predicted - tp)::BIGINT AS fp, sum(n_actual - tp)::BIGINT AS fn,
 sum(n_predicted)::BIGINT AS predicted, round(CASE WHEN count(*) FILTER (n_actual = 0) > 0 THEN count(*) FILTER (n_actual = 0 AND n_predicted = 0) / (count(*) FILTER (n_actual = 0))::DOUBLE ELSE 1.0 END, 6) AS singleton_accuracy, count(*) AS entities
 FROM (SELECT *, {_FSCORE} AS f, {_PRECISION} AS p, {_RECALL} AS r FROM (
  SELECT g.source1_entity_id, t.threshold, any_value(len(g.matched)) AS n_actual, count(s.candidate_entity_id) AS n_predicted, count(s.candidate_entity_id) FILTER (list_contains(g.matched, s.candidate_entity_id)) AS tp
  FROM gt g CROSS JOIN (SELECT unnest(range(10, 100)) / 100.0::DOUBLE AS threshold) t LEFT JOIN (SELECT * FROM scored WHERE {where}) s ON g.source1_entity_id = s.source1_entity_id AND s.probability >= t.threshold GROUP BY 1, 2)) GROUP BY threshold"""


_LINEAR = " + ".join(f"({_ALL[c]}) * {w}::DOUBLE" for c, w in LINEAR.items())
_IDS = "SELECT source1_entity_id FROM split WHERE part = "
_TARGET_IDS = "SELECT entity_id FROM er_source2 UNION ALL SELECT entity_id FROM er_source3"


def _lists(pairs: str, out: str) -> str:
    return f"""SELECT i.entity_id AS source1_entity_id, coalesce(l.x, '') AS {out} FROM er_source1 i LEFT JOIN (SELECT source1_entity_id, string_agg(DISTINCT candidate_entity_id, ',' ORDER BY candidate_entity_id) AS x FROM {pairs} GROUP BY 1) l ON i.entity_id = l.source1_entity_id"""


VIEWS: dict[str, str] = {
    **CTES,
    "gt_text": "SELECT s.entity_id AS source1_entity_id, coalesce(string_agg(p.candidate_entity_id, ',' ORDER BY p.candidate_entity_id), '') AS matched_entity_ids FROM er_source1 s LEFT JOIN er_pairs p ON s.entity_id = p.source1_entity_id GROUP BY 1",
    "gt": "SELECT source1_entity_id, list_sort(list_distinct(list_filter(list_transform(string_split(matched_entity_ids, ','), lambda x: trim(x)), lambda x: x <> ''))) AS matched FROM gt_text",
    "c1": _clean("er_source1"), "c2": _clean("er_source2"), "c3": _clean("er_source3"),
    "uncleaned": "SELECT * FROM er_source1 UNION ALL SELECT * FROM er_source2 UNION ALL SELECT * FROM er_source3",
    "every": "SELECT * FROM c1 UNION ALL SELECT * FROM c2 UNION ALL SELECT * FROM c3",
    "cand": "SELECT DISTINCT * FROM (" + " UNION ALL ".join([*_PASSES.values(), _rares("business_name_norm"), _rares("business_address_norm")]) + ")",
    "lab": "SELECT c.*, CAST(p.source1_entity_id IS NOT NULL AS BIGINT) AS is_match FROM cand c LEFT JOIN er_pairs p ON c.source1_entity_id = p.source1_entity_id AND c.candidate_entity_id = p.candidate_entity_id",
    "rec": f"SELECT l.*, {_SIDES} FROM lab l LEFT JOIN every x ON l.source1_entity_id = x.entity_id LEFT JOIN every y ON l.candidate_entity_id = y.entity_id",
    "sets": f"SELECT *, {_tok(_N1)} AS namex, {_tok(_N2)} AS namey, {_tok(_A1)} AS addressx, {_tok(_A2)} AS addressy, {_nums(_A1)} AS nx, {_nums(_A2)} AS ny, {_long(_A1)} AS dx, {_long(_A2)} AS dy FROM rec",
    "scored": f"SELECT {_K}, candidate_source, is_match, round({_LINEAR}, 6) AS probability FROM sets",
    "split": f"SELECT source1_entity_id, CASE WHEN row_number() OVER (ORDER BY {_md5(42, 'source1_entity_id')}, source1_entity_id) <= greatest(1, floor((SELECT count(*) FROM er_source1) * 0.2::DOUBLE)) THEN 'validation' ELSE 'train' END AS part FROM gt_text",
    "decided": "SELECT * FROM scored WHERE probability >= 0.25",
    "ent": f"""SELECT *, n_predicted - tp AS fp, n_actual - tp AS fn, round({_PRECISION}, 6) AS precision, round({_RECALL}, 6) AS recall, round({_FSCORE}, 6) AS f05, {_PRECISION} AS p_, {_RECALL} AS r_, {_FSCORE} AS f_, CAST(n_actual = 0 AS BIGINT) AS is_singleton, CAST(n_actual = 0 AND n_predicted = 0 AS BIGINT) AS singleton_correct
 FROM (SELECT g.source1_entity_id, any_value(len(g.matched)) AS n_actual, count(DISTINCT d.candidate_entity_id) AS n_predicted, count(DISTINCT d.candidate_entity_id) FILTER (list_contains(g.matched, d.candidate_entity_id)) AS tp FROM gt g LEFT JOIN decided d ON g.source1_entity_id = d.source1_entity_id GROUP BY 1)""",
    "percand": "SELECT source1_entity_id, count(*) AS c FROM cand GROUP BY 1",
    "hits": "SELECT p.*, c.source1_entity_id IS NOT NULL AS hit, starts_with(p.candidate_entity_id, 'S2-') AS two FROM er_pairs p LEFT JOIN cand c ON p.source1_entity_id = c.source1_entity_id AND p.candidate_entity_id = c.candidate_entity_id",
    "rates": "SELECT count(*) FILTER (hit) / count(*)::DOUBLE AS overall, count(*) FILTER (hit AND two) / (count(*) FILTER (two))::DOUBLE AS s2, count(*) FILTER (hit AND NOT two) / (count(*) FILTER (NOT two))::DOUBLE AS s3, count(*) FILTER (hit) AS found, count(*) AS total FROM hits",
    "space": "SELECT (SELECT count(*) FROM er_source1) * ((SELECT count(*) FROM er_source2) + (SELECT count(*) FROM er_source3)) AS n, (SELECT count(*) FROM cand) AS c",
    **_score_cte("ns", "business_name_norm"), **_score_cte("ads", "business_address_norm"),
    "told": "SELECT s.source1_entity_id, s.candidate_entity_id, s.candidate_source, s.probability, CAST(s.probability >= 0.25 AS BIGINT) AS predicted_match, CAST(list_contains(g.matched, s.candidate_entity_id) AS BIGINT) AS is_true_match, len(g.matched) AS n FROM scored s JOIN gt g ON s.source1_entity_id = g.source1_entity_id",
    "swept": _sweep(),
    "easy": f"SELECT * FROM lab WHERE is_match = 0 ORDER BY {_PAIR_HASH(42)}, {_K} LIMIT 200",
    "vlines": """SELECT source1_entity_id AS s1, matched_entity_ids AS rest FROM gt_text WHERE right(source1_entity_id, 1) <> '3' UNION ALL VALUES ('S1-000000001', 'S2-000000002,S2-000000002'), ('S1-999999999', 'S1-000000001,X-1,S2-999999999')""",
    "vids": "SELECT s1, unnest(string_split(rest, ',')) AS x FROM vlines WHERE trim(rest) <> ''",
    "vfound": f"""SELECT 'malformed_row' AS rule, 'no tab here' AS x UNION SELECT 'duplicate_row', s1 FROM vlines GROUP BY s1 HAVING count(*) > 1
 UNION SELECT 'duplicate_id_in_list', s1 FROM vlines WHERE trim(rest) <> '' AND len(string_split(rest, ',')) <> len(list_distinct(string_split(rest, ',')))
 UNION SELECT 'self_match', x FROM vids WHERE starts_with(x, 'S1-') UNION SELECT 'wrong_prefix', x FROM vids WHERE NOT regexp_matches(x, '^S[123]-')
 UNION SELECT 'unknown_id', x FROM vids WHERE regexp_matches(x, '^S[23]-') AND x NOT IN ({_TARGET_IDS})
 UNION SELECT 'missing_s1', entity_id FROM er_source1 WHERE entity_id NOT IN (SELECT s1 FROM vlines) UNION SELECT 'unexpected_s1', s1 FROM vlines WHERE s1 NOT IN (SELECT entity_id FROM er_source1)""",
}


def _select(columns: dict[str, str], table: str = "sets", rounded: bool = True) -> str:
    made = ", ".join(f"round({v}, 6) AS {k}" if any(w in k for w in ("jaccard", "containment", "ratio", "norm", "overlap", "diff")) else f"{v} AS {k}" for k, v in columns.items())
    return f"SELECT {_K}, {made} FROM {table}"


def _both_scores(field: str) -> str:
    return f"SELECT {_K}, round(n.{field}, 6) AS name, round(d.{field}, 6) AS address FROM rec JOIN ns_scores n ON n.a = {_N1} AND n.b = {_N2} JOIN ads_scores d ON d.a = {_A1} AND d.b = {_A2}"


def _tokens(make) -> str:
    return f"SELECT {_K}, round({make('namex', 'namey')}, 6) AS name, round({make('addressx', 'addressy')}, 6) AS address FROM sets"


def _with_sequences(columns: dict[str, str], kind: str, prefix: str, a: str, b: str) -> str:
    base = _select(columns).replace(" FROM sets", "")
    scores = f", round(q.ratio, 6) AS {prefix}_levenshtein_sim, round(q.token_sort, 6) AS {prefix}_token_sort_ratio, round(q.token_set, 6) AS {prefix}_token_set_ratio"
    return f"{base}{scores} FROM sets JOIN {kind}_scores q ON q.a = {a} AND q.b = {b}"


def _tfidf(grams: str, column: str) -> tuple[str, str]:
    t = "CASE WHEN trim(x) = '' THEN ' ' ELSE lower(x) END"
    return f"""SELECT r.source1_entity_id, r.candidate_entity_id, round(coalesce(sum(u.w * v.w), 0.0), 6) AS cosine FROM rec r
 LEFT JOIN weights u ON u.x = r.{column}_1 LEFT JOIN weights v ON v.x = r.{column}_2 AND v.g = u.g GROUP BY r.source1_entity_id, r.candidate_entity_id, r.{column}_1, r.{column}_2""", f"""
 docs AS (SELECT {column} AS x, {t.replace('x', column)} AS t FROM every),
 grams AS (SELECT x, {grams} AS gs FROM docs),
 dfs AS (SELECT g, count(*) AS df FROM (SELECT unnest(list_distinct(gs)) AS g FROM grams) GROUP BY g),
 tfs AS (SELECT x, g, count(*) AS tf FROM (SELECT x, unnest(gs) AS g FROM (SELECT DISTINCT x, gs FROM grams)) GROUP BY x, g),
 raw AS (SELECT x, g, (1 + ln(tf)) * (ln((1 + (SELECT count(*) FROM docs))::DOUBLE / (1 + df)) + 1) AS w FROM tfs JOIN dfs USING (g)),
 weights AS (SELECT x, g, w / sqrt(sum(w * w) OVER (PARTITION BY x)) AS w FROM raw)"""


_CHARS = "flatten(list_transform([2, 3, 4], lambda n: list_transform(range(1, greatest(len(t) - n + 2, 1)), lambda i: substr(t, i, n))))"
_WORDS = r"list_concat(regexp_extract_all(t, '\b\w\w+\b'), list_transform(range(1, greatest(len(regexp_extract_all(t, '\b\w\w+\b')), 1)), lambda i: concat(regexp_extract_all(t, '\b\w\w+\b')[i], ' ', regexp_extract_all(t, '\b\w\w+\b')[i + 1])))"


def _fuzzy(column: str) -> tuple[str, str]:
    near = " UNION ALL ".join(f"""SELECT x.entity_id AS source1_entity_id, y.entity_id AS candidate_entity_id, 'S{n}' AS candidate_source, {_sorted('x.' + column)} AS a, {_sorted('y.' + column)} AS b FROM c1 x JOIN c{n} y ON x.country_norm = y.country_norm
  WHERE len(x.{column}) >= 4 AND y.{column} <> '' AND 3 * least(len(x.{column}), len(y.{column})) >= 2 * greatest(len(x.{column}), len(y.{column}))""" for n in (2, 3))
    return "SELECT source1_entity_id, candidate_entity_id, candidate_source FROM (SELECT *, row_number() OVER (PARTITION BY source1_entity_id, candidate_source ORDER BY s DESC, candidate_entity_id) AS r FROM fz3 WHERE s >= 0.8 - 1e-12) WHERE r <= 10", f"""
 fz1 AS ({near}),
 fz2 AS (SELECT a, b, {_lcs('a', 'b')} AS l FROM (SELECT DISTINCT a, b FROM fz1)),
 fz3 AS (SELECT fz1.*, 2.0::DOUBLE * l / (len(fz1.a) + len(fz1.b)) AS s FROM fz1 JOIN fz2 ON fz1.a = fz2.a AND fz1.b = fz2.b)"""


def sql(final: str, more: str = "") -> str:
    """The query with the views that it needs, in their order."""
    wanted, text = set(), final + more
    names = list(VIEWS)
    for name in reversed(names):
        if re.search(rf"\b{name}\b", text):
            wanted.add(name)
            text += " " + VIEWS[name]
    views = ", ".join(f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in names if n in wanted)
    extra = more.strip()
    return f"WITH {views}{', ' + extra if extra else ''} {final}" if views or extra else final


_ERR = "source1_entity_id, candidate_entity_id, candidate_source, probability, predicted_match, is_true_match"
_TOP = f"ORDER BY probability DESC, {_K} LIMIT 50"

_FINAL: dict = {
    "strip_accents": "SELECT entity_id, strip_accents(business_name) AS plain FROM uncleaned",
    "norm_ws": rf"SELECT entity_id, {_ws('business_name')} AS plain FROM uncleaned",
    "norm_punct": f"SELECT entity_id, {_punct('business_address')} AS plain FROM uncleaned",
    "norm_text": f"SELECT entity_id, {_norm('business_name')} AS plain FROM uncleaned",
    "clean_name_norm": "SELECT entity_id, business_name_norm FROM every",
    "clean_name_core": "SELECT entity_id, business_name_core FROM every",
    "clean_address": "SELECT entity_id, business_address_norm FROM every",
    "clean_country": "SELECT entity_id, country_norm FROM every",
    "tokenize": f"SELECT entity_id, array_to_string({_tok('business_name_norm')}, ' ') AS tokens, len({_tok('business_name_norm')}) AS n FROM every",
    "numeric_tokens": f"SELECT entity_id, array_to_string({_nums('business_address_norm')}, ' ') AS numbers FROM every",
    "digit_sequences": f"SELECT entity_id, array_to_string({_long('business_address_norm')}, ' ') AS numbers FROM every",
    "numeric_signature": f"SELECT entity_id, {_SIGNATURE} AS signature FROM every",
    "missing_flags": "SELECT entity_id, name_missing, address_missing, country_missing FROM every",
    "length_features": "SELECT entity_id, name_char_length, address_char_length, name_token_count, address_token_count FROM every",
    "clean_source": "SELECT * FROM every",
    "block_exact_name": f"SELECT DISTINCT * FROM ({_PASSES['name']})",
    "block_exact_core": f"SELECT DISTINCT * FROM ({_PASSES['core']})",
    "block_exact_address": f"SELECT DISTINCT * FROM ({_PASSES['address']})",
    "block_numeric_address": f"SELECT DISTINCT * FROM ({_PASSES['numeric']})",
    "block_rare_name_token": f"SELECT DISTINCT * FROM ({_rares('business_name_norm')})",
    "block_rare_address_token": f"SELECT DISTINCT * FROM ({_rares('business_address_norm')})",
    "block_fuzzy_name": _fuzzy("business_name_norm"),
    "block_fuzzy_address": _fuzzy("business_address_norm"),
    "block_all": "SELECT * FROM cand",
    "token_frequency": f"SELECT w AS token, count(*) AS n FROM (SELECT unnest({_tok('business_name_norm')}) AS w FROM every) WHERE len(w) >= 4 GROUP BY w",
    "label_candidates": "SELECT * FROM lab",
    "positive_pairs": f"SELECT {_K}, left(candidate_entity_id, 2) AS candidate_source, 1::BIGINT AS is_match FROM er_pairs",
    "easy_negatives": "SELECT * FROM easy",
    "hard_negative_pool": "SELECT * FROM lab WHERE is_match = 0 AND source1_entity_id IN (SELECT source1_entity_id FROM lab WHERE is_match = 1)",
    "hard_pool_sql": "SELECT n.* FROM lab n JOIN lab p ON n.source1_entity_id = p.source1_entity_id WHERE n.is_match = 0 AND p.is_match = 1",
    "hard_negatives": f"SELECT * FROM lab WHERE is_match = 0 AND ((SELECT count(*) FROM lab WHERE is_match = 0 AND source1_entity_id IN (SELECT source1_entity_id FROM lab WHERE is_match = 1)) < 100 OR source1_entity_id IN (SELECT source1_entity_id FROM lab WHERE is_match = 1)) ORDER BY {_PAIR_HASH(43)}, {_K} LIMIT 100",
    "training_pairs": (
        f"SELECT {_K}, max(candidate_source) AS candidate_source, max(is_match) AS is_match FROM (SELECT {_K}, left(candidate_entity_id, 2) AS candidate_source, 1::BIGINT AS is_match FROM er_pairs UNION ALL SELECT {_K}, candidate_source, is_match FROM tp1 UNION ALL SELECT {_K}, candidate_source, is_match FROM tp2) GROUP BY {_K}",
        f"""np AS (SELECT count(*) AS n FROM er_pairs), hp AS (SELECT * FROM lab WHERE is_match = 0 AND source1_entity_id IN (SELECT source1_entity_id FROM lab WHERE is_match = 1)),
 tp1 AS (SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (ORDER BY {_PAIR_HASH(43)}, {_K}) AS r FROM lab WHERE is_match = 0 AND ((SELECT count(*) FROM hp) < (SELECT 2 * n FROM np) OR source1_entity_id IN (SELECT source1_entity_id FROM hp))) WHERE r <= (SELECT 2 * n FROM np)),
 tp2 AS (SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (ORDER BY {_PAIR_HASH(42)}, {_K}) AS r FROM lab WHERE is_match = 0) WHERE r <= (SELECT 2 * n FROM np))""",
    ),
    "validation_pairs": f"SELECT * FROM lab WHERE source1_entity_id IN ({_IDS}'validation')",
    "capture_rate": "SELECT count(*) FILTER (hit) AS captured, count(*) AS positives, round(count(*) FILTER (hit) / count(*)::DOUBLE, 6) AS rate FROM hits",
    "filter_by_ids": f"SELECT * FROM cand WHERE source1_entity_id IN ({_IDS}'train')",
    "pair_records": "SELECT * FROM rec",
    "entity_lookup": "SELECT entity_id, business_name, business_address, country FROM er_source1 UNION ALL SELECT entity_id, business_name, business_address, country FROM er_source2 UNION ALL SELECT entity_id, business_name, business_address, country FROM er_source3",
    "parse_gt": "SELECT source1_entity_id, array_to_string(matched, ',') AS matched, len(matched) AS n FROM gt",
    "expand_gt": f"SELECT {_K} FROM er_pairs",
    "gt_invalid_ids": "SELECT source1_entity_id, source1_entity_id AS matched_id, 'self' AS reason FROM gt UNION ALL SELECT source1_entity_id, 'S9-1', 'unknown' FROM gt",
    "gt_by_source": "SELECT source1_entity_id, array_to_string(list_filter(matched, lambda x: starts_with(x, 'S2-')), ',') AS matched FROM gt WHERE len(list_filter(matched, lambda x: starts_with(x, 'S2-'))) > 0",
    "gt_summary": "SELECT count(*) AS entities, count(*) FILTER (len(matched) > 0) AS with_matches, count(*) FILTER (len(matched) = 0) AS singletons, sum(len(matched))::BIGINT AS matched_ids FROM gt",
    "gt_for_ids": "SELECT source1_entity_id, array_to_string(matched, ',') AS matched FROM gt UNION ALL SELECT 'S1-none', ''",
    "split_entities": "SELECT * FROM split",
    "split_pack": f"SELECT c.entity_id, c.business_name_norm, len(g.matched) AS n FROM c1 c JOIN gt g ON c.entity_id = g.source1_entity_id WHERE c.entity_id IN ({_IDS}'validation')",
    "sim_ratio": _both_scores("ratio"), "sim_token_sort": _both_scores("token_sort"), "sim_token_set": _both_scores("token_set"),
    "sim_jaccard": _tokens(_jaccard), "sim_containment": _tokens(_containment), "sim_overlap": _tokens(_overlap),
    "sim_common": f"SELECT {_K}, len(list_intersect(namex, namey)) AS name, len(list_intersect(addressx, addressy)) AS address FROM sets",
    "sim_length": f"SELECT {_K}, round({_NAME['name_length_diff_norm']}, 6) AS difference, round({_NAME['name_length_ratio']}, 6) AS ratio FROM sets",
    "sim_tfidf_char": _tfidf(_CHARS, "business_name_norm"), "sim_tfidf_word": _tfidf(_WORDS, "business_name_norm"),
    "sim_tfidf_char_address": _tfidf(_CHARS, "business_address_norm"), "sim_tfidf_word_address": _tfidf(_WORDS, "business_address_norm"),
    "features_name": _with_sequences(_NAME, "ns", "name", _N1, _N2), "features_address": _with_sequences(_ADDRESS, "ads", "address", _A1, _A2),
    "features_numeric": _select(_NUMERIC), "features_country": _select(_COUNTRY), "features_structural": _select(_STRUCTURE),
    "features_interaction": f"SELECT {_K}, round(n.token_set * d.token_set, 6) AS name_x_address_sim, round(least(n.token_set, d.token_set), 6) AS min_name_address_sim, round(greatest(n.token_set, d.token_set), 6) AS max_name_address_sim FROM rec JOIN ns_scores n ON n.a = {_N1} AND n.b = {_N2} JOIN ads_scores d ON d.a = {_A1} AND d.b = {_A2}",
    "linear_score": "SELECT * FROM scored",
    "entity_eval": "SELECT source1_entity_id, n_actual, n_predicted, tp, fp, fn, precision, recall, f05, is_singleton, singleton_correct FROM ent",
    "macro_f05": "SELECT count(*) AS entities, round(avg(f_), 6) AS macro_f05, round(avg(p_), 6) AS macro_precision, round(avg(r_), 6) AS macro_recall FROM ent",
    "singleton_metrics": "SELECT count(*) FILTER (n_actual = 0) AS n_singletons, count(*) FILTER (n_actual = 0 AND n_predicted = 0) AS n_correct, round(CASE WHEN count(*) FILTER (n_actual = 0) > 0 THEN count(*) FILTER (n_actual = 0 AND n_predicted = 0) / (count(*) FILTER (n_actual = 0))::DOUBLE ELSE 1.0 END, 6) AS accuracy FROM ent",
    "candidate_recall": "SELECT round(overall, 6) AS overall, round(s2, 6) AS s2, round(s3, 6) AS s3, found, total FROM rates",
    "candidate_stats": "SELECT round(avg(c), 6) AS mean, round(median(c), 6) AS median, round(quantile_cont(c, 0.95), 6) AS p95, max(c) AS max, min(c) AS min, sum(c)::BIGINT AS total_pairs, count(*) AS unique_s1 FROM percand",
    "reduction_ratio": "SELECT c AS candidates, n AS full_space, round(1 - c / n::DOUBLE, 6) AS reduction_ratio FROM space",
    "blocking_report": "SELECT round(overall, 6) AS recall_overall, round(s2, 6) AS recall_s2, round(s3, 6) AS recall_s3, (SELECT round(avg(c), 6) FROM percand) AS mean_candidates, (SELECT round(quantile_cont(c, 0.95), 6) FROM percand) AS p95_candidates, (SELECT round(1 - c / n::DOUBLE, 6) FROM space) AS reduction_ratio FROM rates",
    "recall_by_country": "SELECT c.country_norm, CASE WHEN len(g.matched) = 1 THEN '1' ELSE '2+' END AS bucket, count(*) AS total, count(*) FILTER (h.hit) AS found, round(count(*) FILTER (h.hit) / count(*)::DOUBLE, 6) AS recall FROM hits h JOIN gt g ON h.source1_entity_id = g.source1_entity_id JOIN c1 c ON c.entity_id = h.source1_entity_id GROUP BY 1, 2",
    "predictions_at": _lists("decided", "predicted"),
    "threshold_sweep": "SELECT * FROM swept",
    "best_threshold": "SELECT threshold, macro_f05 FROM swept ORDER BY macro_f05 DESC, threshold LIMIT 1",
    "sweep_report": "SELECT threshold, macro_f05 FROM swept ORDER BY macro_f05 DESC, threshold LIMIT 10",
    "sweep_by_source": _sweep("candidate_source = 'S2'", ", 'S2' AS source") + " UNION ALL " + _sweep("candidate_source = 'S3'", ", 'S3' AS source"),
    "errors_fp": f"SELECT {_ERR} FROM told WHERE predicted_match = 1 AND is_true_match = 0 {_TOP}",
    "errors_fn": f"SELECT {_ERR} FROM told WHERE predicted_match = 0 AND is_true_match = 1 {_TOP}",
    "errors_singleton": f"SELECT {_ERR} FROM told WHERE predicted_match = 1 AND n = 0 {_TOP}",
    "cleaning_quality": " UNION ALL ".join(f"SELECT 'S{n}' AS source, raw_rows, raw_names, clean_rows, clean_names, 0::BIGINT AS ids_lost, 0::BIGINT AS ids_added, round((e1 - e0)::DOUBLE / clean_rows * 100, 6) AS empty_diff_pct, round((raw_names - clean_names)::DOUBLE / raw_names, 6) AS collision_ratio, CAST(raw_rows = clean_rows AND (e1 - e0) * 100.0 / clean_rows <= 2.0 AS BIGINT) AS passed, CAST((raw_names - clean_names)::DOUBLE / raw_names > 0.5 AS BIGINT) AS collision_warning FROM (SELECT count(*) AS raw_rows, count(DISTINCT business_name) AS raw_names, count(*) FILTER (trim(business_name) = '') AS e0 FROM er_source{n}), (SELECT count(*) AS clean_rows, count(DISTINCT business_name_norm) AS clean_names, count(*) FILTER (trim(business_name_norm) = '') AS e1 FROM c{n})" for n in (1, 2, 3)),
    "top_collisions": " UNION ALL ".join(f"SELECT * FROM (SELECT 'S{n}' AS source, business_name_norm, count(*) AS n FROM c{n} GROUP BY 2 ORDER BY n DESC, business_name_norm LIMIT 5)" for n in (1, 2, 3)),
    "matching_results": _lists("decided", "matched_entity_ids"),
    "candidate_pairs_out": _lists("cand", "candidate_entity_ids"),
    "subset_violations": f"SELECT {_K} FROM decided EXCEPT SELECT {_K} FROM cand WHERE candidate_source = 'S2'",
    "validate_report": "SELECT rule, count(*) AS offenders, array_to_string(list_sort(list(x))[1:5], ', ') AS examples FROM vfound GROUP BY rule",
}

ORACLE_SQL = {k: sql(*v) if isinstance(v, tuple) else sql(v) for k, v in _FINAL.items()}
