"""The dealt operators as registered queries over whole tables, with SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from scholarmart.llm import byte_bpe
from scholarmart.llm.common import table
from scholarmart.llm.decontamination import contained_items
from scholarmart.llm.fim import fill_in_middle, restore
from scholarmart.llm.fingerprints import fingerprints
from scholarmart.llm.language import identify
from scholarmart.llm.lexical import search
from scholarmart.llm.licenses import scan
from scholarmart.llm.line_dedup import dedup_lines
from scholarmart.llm.mixing import mix
from scholarmart.llm.near_dedup import near_groups
from scholarmart.llm.ppm import scores
from scholarmart.llm.surrogates import replace_entities
from scholarmart.llm.toxicity import toxicity


def op1_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_line_dedup(spark, sf_dir):
    return dedup_lines(table(spark, sf_dir, "documents"))


def op3_surrogates(spark, sf_dir):
    return replace_entities(table(spark, sf_dir, "documents"))


def op4_near_dedup(spark, sf_dir):
    return near_groups(table(spark, sf_dir, "documents"), size=4)


def op5_ppm(spark, sf_dir):
    return scores(table(spark, sf_dir, "documents"))


def op6_source_mix(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"))


def op7_fingerprints(spark, sf_dir):
    return fingerprints(table(spark, sf_dir, "documents"))


def op8_language(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))


def op9_decontamination(spark, sf_dir):
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_licenses(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"))


def _sha256(column):
    return F.sha2(F.col(column).cast("binary"), 256)


def op11_fim(spark, sf_dir):
    whole = restore(fill_in_middle(table(spark, sf_dir, "documents")))
    return whole.select("doc_id", "n", "form", "prefix_chars", "middle_chars", _sha256("output").alias("output_sha256"), _sha256("restored").alias("restored_sha256"))


def op12_lexical(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_byte_bpe(spark, sf_dir, vocabulary=None):
    ranks = (vocabulary or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    whole = byte_bpe.encode(table(spark, sf_dir, "documents"), *ranks, decoded=True)
    return whole.select("doc_id", "n_tokens", _sha256("ids").alias("ids_sha256"), _sha256("decoded").alias("decoded_sha256"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_line_dedup": op2_line_dedup,
    "op3_surrogates": op3_surrogates,
    "op4_near_dedup": op4_near_dedup,
    "op5_ppm": op5_ppm,
    "op6_source_mix": op6_source_mix,
    "op7_fingerprints": op7_fingerprints,
    "op8_language": op8_language,
    "op9_decontamination": op9_decontamination,
    "op10_licenses": op10_licenses,
    "op11_fim": op11_fim,
    "op12_lexical": op12_lexical,
    "op13_byte_bpe": op13_byte_bpe,
}

#: exact components of all links, by counting the shared shingles of every pair
OP4_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM words
), posted AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS both_
  FROM posted x JOIN posted y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (SELECT a, b FROM shared WHERE 100 * both_ >= 80 * (na + nb - both_)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_ AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM sets s JOIN least_ ON a = s.doc_id
"""

#: draws repeated from the same hashes; the distribution comes from the closed form
OP6_SQL = """
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (SELECT source, sum(n) OVER () * sqrt(n) / sum(sqrt(n)) OVER () / n AS rate FROM counts),
pieces AS (SELECT source, rate, greatest(1, ceil(rate / 16)) AS draws FROM rates),
terms AS (SELECT source, draws, rate / draws AS mean, k FROM pieces, range(0, 120) t(k)),
cdf AS (SELECT source, draws, sum(exp(-mean + k * ln(mean) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
draws AS (
  SELECT d.doc_id, p.source, CAST('0x' || substr(md5('mix-1|' || d.doc_id || '|' || j.j), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
  FROM documents d JOIN pieces p ON d.source IS NOT DISTINCT FROM p.source JOIN range(0, 100) j(j) ON j.j < p.draws
),
copies AS (SELECT x.doc_id, count(*) AS copies FROM draws x JOIN cdf ON x.source IS NOT DISTINCT FROM cdf.source AND cdf.c <= x.u GROUP BY x.doc_id)
SELECT d.*, CAST(g.k AS INTEGER) AS copy_no FROM documents d JOIN copies c USING (doc_id) JOIN range(0, 1000) g(k) ON g.k < c.copies
"""

#: exact containment of every item in every document, by shared shingles
OP9_SQL = r"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark
), words AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), sets AS (
  SELECT kind, id, list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM words WHERE len(w) >= 5
), posted AS (SELECT kind, id, len(s) AS n, unnest(s) AS g FROM sets),
counts AS (
  SELECT d.id AS doc_id, i.id AS item_id, CAST(any_value(i.n) AS BIGINT) AS n_shingles, count(*) AS n_found
  FROM posted d JOIN posted i ON d.g = i.g AND d.kind = 'd' AND i.kind = 'i' GROUP BY ALL
)
SELECT *, n_found / n_shingles AS containment FROM counts WHERE 10 * n_found >= 8 * n_shingles
"""

#: units as lists of lines; the text itself is what the output restores
OP11_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), units AS (
  SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u,
    list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS d FROM texts
), cuts AS (
  SELECT *, least(d[1] % (len(u) + 1), d[2] % (len(u) + 1)) AS a, greatest(d[1] % (len(u) + 1), d[2] % (len(u) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain' WHEN d[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM units
), parts AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM cuts
)
SELECT doc_id, CAST(len(u) AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""

#: scores of every document that shares a term with an item
OP12_SQL = r"""
WITH tokens AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), lengths AS (SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
sizes AS (SELECT doc_id, 100 - 50 + ((50 * n * docs) // total) AS m FROM lengths, whole),
counts AS (SELECT doc_id, term, count(*) AS tf FROM tokens WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, whole GROUP BY term, docs),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM wanted JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id) GROUP BY item_id, doc_id
), ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
"""

SQL = {
    "op11_fim": OP11_SQL,
    "op12_lexical": OP12_SQL,
    "op6_source_mix": OP6_SQL,
    "op9_decontamination": OP9_SQL,
    "op4_near_dedup": OP4_SQL,
}
