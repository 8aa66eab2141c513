"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from fractions import Fraction

from tesserae.llm import ann, extraction, language, licenses, media, mixing, neardup, packing, quality, sharding
from tesserae.llm.common import table


def word_tokenizer() -> str:
    """The tokenizer file of op10 and the pipeline."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_dom_trees(spark, sf_dir):
    return extraction.main_texts(table(spark, sf_dir, "pages"))


def op2_bottomk_neardup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=3, threshold=Fraction(85, 100))


def op3_language_spans(spark, sf_dir):
    return language.predict(table(spark, sf_dir, "documents"))


def op4_license_notices(spark, sf_dir):
    return licenses.license_digest(table(spark, sf_dir, "documents"))


def op5_chunked_media(spark, sf_dir):
    return media.media_digest(table(spark, sf_dir, "documents"))


def op6_multi_index_hashing(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op7_jump_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op8_source_mixing(spark, sf_dir):
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op9_kneser_ney_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_vector_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), word_tokenizer())


QUERIES = {f.__name__: f for f in (op1_dom_trees, op2_bottomk_neardup, op3_language_spans, op4_license_notices, op5_chunked_media, op6_multi_index_hashing, op7_jump_sharding, op8_source_mixing, op9_kneser_ney_quality, op10_vector_packing)}

#: Targets by the level at which the sources are full; the permuted stream by md5, as in the operator.
OP8_SQL = r"""
WITH w AS (
  SELECT doc_id, source, CAST(CASE WHEN t = '' THEN 0 ELSE len(regexp_extract_all(t, '[\x20\x09-\x0D]+')) + 1 END AS BIGINT) AS size,
         substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS k
  FROM (SELECT doc_id, source, regexp_replace(regexp_replace(coalesce(text, ''), '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS t FROM documents) d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM w GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS i FROM s),
c AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][CAST(i % 3 AS INTEGER) + 1] AS wt, source_size * 3.0::DOUBLE AS cap FROM n),
l AS (SELECT *, ((SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER (ORDER BY cap / wt, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(wt) OVER (ORDER BY cap / wt, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
t AS (SELECT source, source_size, round(least(cap, wt * (SELECT arg_min(level, cap / wt) FROM l WHERE level * wt <= cap)), 6) AS target FROM l),
p AS (SELECT doc_id, size, source_size, target,
        CAST(coalesce(sum(size) OVER (PARTITION BY w.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
        CAST(round(target) AS BIGINT) AS q
      FROM w JOIN t ON w.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST((q // greatest(source_size, 1)) * size + greatest(0, least(size, q - (q // greatest(source_size, 1)) * source_size - start)) AS BIGINT) AS taken
FROM p
"""

#: All pairs that share a shingle, counted in full; then everything reachable, by recursion.
OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
n AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS sh
  FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM n),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS i FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2, 3, 4),
l AS (SELECT a, b FROM p WHERE 100 * i >= 85 * (na + nb - i)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT n.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id, n.doc_id = component_id AS kept FROM n JOIN m ON n.doc_id = m.doc_id
"""


def _crc_table() -> list[int]:
    """The checksum of each byte, by eight steps of its polynomial."""
    table = list(range(256))
    for _ in range(8):
        table = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in table]
    return table


#: The published walk of jumps on huge integers; the checksum byte by byte.
OP7_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size,
    xor(4294967295::BIGINT, list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)),
      lambda c, x: xor(c >> 8, list_extract(CAST({_crc_table()} AS BIGINT[]), CAST((xor(c, x) & 255) + 1 AS INTEGER))), 4294967295::BIGINT)) AS text_crc32
  FROM documents),
j(doc_id, k, jump, s8, s9, step) AS (
  SELECT DISTINCT doc_id, CAST(coalesce(doc_id, 0) AS HUGEINT) + CASE WHEN doc_id < 0 THEN 18446744073709551616::HUGEINT ELSE 0 END, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0 FROM documents
  UNION ALL
  SELECT doc_id, m, b, CASE WHEN b < 8 THEN b ELSE s8 END, CASE WHEN b < 9 THEN b ELSE s9 END, step + 1
  FROM (SELECT doc_id, m, s8, s9, step, CASE WHEN jump >= 9 THEN 9 ELSE CAST(least(9, floor((jump + 1) * (2147483648.0::DOUBLE / CAST(m // 8589934592 + 1 AS DOUBLE)))) AS BIGINT) END AS b
        FROM (SELECT *, (k * 2862933555777941757 + 1) % 18446744073709551616::HUGEINT AS m FROM j WHERE step < 9) a) c),
f AS (SELECT doc_id, s8, s9 FROM j WHERE step = 9)
SELECT d.doc_id, size, text_crc32, 'key' AS law, CAST(s8 AS INTEGER) AS shard,
  CAST(row_number() OVER (PARTITION BY s8 ORDER BY substr(md5('slot|' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13), d.doc_id NULLS FIRST, size, text_crc32) - 1 AS BIGINT) AS slot,
  CAST(s9 AS INTEGER) AS grown_shard
FROM d JOIN f ON d.doc_id IS NOT DISTINCT FROM f.doc_id
"""

ORACLE_SQL = {"op2_bottomk_neardup": OP2_SQL, "op7_jump_sharding": OP7_SQL, "op8_source_mixing": OP8_SQL}
