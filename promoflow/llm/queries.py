"""Registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from promoflow.llm.chat import CONTROL, END, SAYS, TURN, conversation_report
from promoflow.llm.common import table
from promoflow.llm.decontam import contamination
from promoflow.llm.embed_pq import cosine_components
from promoflow.llm.licenses import license_report
from promoflow.llm.merkle import document_manifest, proofs
from promoflow.llm.negatives import hard_negatives
from promoflow.llm.packing import pack
from promoflow.llm.pii import pseudonym_report
from promoflow.llm.quality import quality_report
from promoflow.llm.secrets import new_ledger, secret_report, update_ledger
from promoflow.llm.simhash import simhash_components
from promoflow.llm.toxicity import toxicity_verdicts
from promoflow.llm.urls import judge_urls

#: Vocabulary file of the byte-level BPE; a parameter of the operators that encode.
VOCABULARY = "byte_bpe_50k.json"


#: The conversation whose texts are control strings.
CONTROL_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op1_chat_formatting(spark, sf_dir):
    """Every conversation formatted, with the mask of its assistant texts, and read back."""
    more = spark.createDataFrame(CONTROL_TURNS, "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    return conversation_report(rows, public_tokenizers.path(VOCABULARY))


def op2_decontamination(spark, sf_dir):
    """Benchmark windows of ten words in every document."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_license_scan(spark, sf_dir):
    """Licence notices, tags and their expressions in every document."""
    return license_report(table(spark, sf_dir, "documents"))


def op4_quality(spark, sf_dir):
    """Quality of every document from its text and the posteriors of its source and language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return quality_report(docs, table(spark, sf_dir, "labels"))


def op5_secret_scan(spark, sf_dir):
    """Secrets of every document, found once per distinct text through a blob ledger that is fed
    in two deliveries, half of the ids and then all: ``scan`` says which one read the text."""
    docs = table(spark, sf_dir, "documents")
    ledger = new_ledger(spark)
    update_ledger(docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0).select("text"), ledger)
    return secret_report(docs, ledger)


def op6_simhash(spark, sf_dir):
    """SimHash components of every document at three bits."""
    return simhash_components(table(spark, sf_dir, "documents"))


def op7_toxicity(spark, sf_dir):
    """Calibrated toxicity of every document."""
    return toxicity_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_embedding_pq(spark, sf_dir):
    """Links and components of every vector at cosine 0.98 within its label."""
    return cosine_components(table(spark, sf_dir, "embeddings"))


def op9_pii(spark, sf_dir):
    """Every document's text with its personal numbers, dates and addresses replaced."""
    return pseudonym_report(table(spark, sf_dir, "documents"))


def op10_packing(spark, sf_dir):
    """Every document's token pieces, packed into sequences of 2048."""
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), with_ids=False)


#: Verdict, host and path of the rules for pages.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op11_url_filter(spark, sf_dir):
    """Every page's address judged by the rules, or else by its aliases."""
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op12_hard_negatives(spark, sf_dir):
    """Hard negatives of every hundredth vector, after the labels of every seventh moved on."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)


def op13_merkle_manifest(spark, sf_dir):
    """Proof of every document, and the root its original or tampered leaf folds to."""
    return proofs(document_manifest(table(spark, sf_dir, "documents")))


REGISTRY = {f.__name__: f for f in (
    op1_chat_formatting, op2_decontamination, op3_license_scan, op4_quality, op5_secret_scan, op6_simhash,
    op7_toxicity, op8_embedding_pq, op9_pii, op10_packing, op11_url_filter, op12_hard_negatives, op13_merkle_manifest)}

_OP1_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, {len(TURN + SAYS + END)} + length(regexp_replace(role, '{CONTROL}', '\1\\\2\3', 'g'))
              + length(regexp_replace(text, '{CONTROL}', '\1\\\2\3', 'g')) AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

# The links of the SQL are absolute canonical hrefs in double quotes; the given pages have none.
_OP11_SQL = r"""
WITH RECURSIVE rules(v, h, p) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), links AS (
  SELECT url AS source, regexp_extract(tag, 'href="([^"]*://[^"]*)"', 1) AS target
  FROM (SELECT url, unnest(regexp_extract_all(html, '<link [^>]*rel="canonical"[^>]*>')) AS tag FROM pages)
), urls AS (
  SELECT url FROM pages UNION SELECT source FROM links UNION SELECT target FROM links
), parts AS (
  SELECT url, contains(url, '://') AS whole,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         list_filter(string_split(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'),
                     lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[^=]*|gclid|fbclid|msclkid|ref|ref_src)(=|$)')) AS asked,
         lower(regexp_extract(url, '^\s*([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme
  FROM urls
), judged AS (
  SELECT *, CASE WHEN whole THEN (CASE WHEN scheme IN ('http', 'https', '') THEN '' ELSE scheme || '://' END)
              || regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^(?:www|m)\.([^.]+\.[^.])', '\1')
              || rtrim(path, '/') || CASE WHEN len(asked) > 0 THEN '?' || array_to_string(asked, '&') ELSE '' END END AS address,
         (SELECT max_by(h || p || ' ' || v, length(h || p)) FROM rules
          WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS said
  FROM parts
), edges AS (
  SELECT a.address AS a, b.address AS b FROM links JOIN judged a ON a.url = source JOIN judged b ON b.url = target
), own AS (
  SELECT DISTINCT address FROM judged WHERE said LIKE '% block' AND address IS NOT NULL
), spread AS (
  SELECT address FROM own
  UNION SELECT e.b FROM spread s JOIN (SELECT a, b FROM edges UNION SELECT b, a FROM edges) e ON e.a = s.address
)
SELECT p.page_id, j.host, j.path, string_split(j.said, ' ')[1] AS rule,
       coalesce(string_split(j.said, ' ')[2], CASE WHEN s.address IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       j.address, j.said IS NULL AND s.address IS NOT NULL AS by_alias
FROM pages p JOIN judged j ON j.url IS NOT DISTINCT FROM p.url LEFT JOIN spread s ON s.address = j.address
"""

_OP12_SQL = """
WITH vectors AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.rid AS anchor, a.vec_id AS anchor_id, a.label AS anchor_label, b.rid, b.vec_id, b.label,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON len(a.q) = len(b.q) AND a.rid <> b.rid WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM pairs WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, rid) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.rid ORDER BY n.score DESC, n.vec_id, n.rid) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor = p.anchor AND n.label <> p.anchor_label
     AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.rid ORDER BY n.score DESC, n.vec_id, n.rid) <= 5
"""

_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"

_OP13_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_LEAF.format(n="n_chars")} AS leaf, {_LEAF.format(n="(n_chars + 1)")} AS changed,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
             lambda a, b: list_reduce(list_prepend(xor(a, b), CAST(range(8) AS BIGINT[])),
                                   lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) % 7 = 0 AS tampered
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM leaves
), nodes AS (
  SELECT lang, 0 AS level, pos, n, leaf AS digest FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2, n
), subroots AS (
  SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, pos, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, pos // 2, n
), folded AS (
  SELECT p.lang, p.pos AS leaf_pos, s.pos AS scope_pos, false AS upper, 0 AS level, p.pos, p.n, '' AS proof,
         CASE WHEN coalesce(p.tampered, false) THEN p.changed ELSE p.leaf END AS digest
  FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
  UNION ALL
  SELECT f.lang, f.leaf_pos, f.scope_pos, f.upper OR f.n = 1, CASE WHEN f.n = 1 THEN 0 ELSE f.level + 1 END,
         CASE WHEN f.n = 1 THEN f.scope_pos ELSE f.pos // 2 END,
         CASE WHEN f.n = 1 THEN (SELECT max(n) FROM subroots) ELSE (f.n + 1) // 2 END,
         CASE WHEN f.n = 1 THEN f.proof ELSE f.proof || coalesce(s.digest, u.digest, '') END,
         CASE WHEN f.n = 1 THEN f.digest
              WHEN f.pos % 2 = 1 THEN sha256(coalesce(s.digest, u.digest, '') || f.digest)
              ELSE sha256(f.digest || coalesce(s.digest, u.digest, '')) END
  FROM folded f
  LEFT JOIN nodes s ON NOT f.upper AND s.lang IS NOT DISTINCT FROM f.lang AND s.level = f.level AND s.pos = xor(f.pos, 1) AND f.n > 1
  LEFT JOIN tops u ON f.upper AND u.level = f.level AND u.pos = xor(f.pos, 1) AND f.n > 1
  WHERE NOT (f.upper AND f.n = 1)
), root AS (SELECT digest FROM tops WHERE n = 1)
SELECT p.doc_id, p.leaf, s.digest AS subroot, r.digest AS root, sha256(f.proof) AS proof_sha256, f.digest AS folded_root,
       f.digest = r.digest AS verified
FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
JOIN folded f ON f.lang IS NOT DISTINCT FROM p.lang AND f.leaf_pos = p.pos AND f.upper AND f.n = 1, root r
"""

ORACLE: dict[str, str] = {"op1_chat_formatting": _OP1_SQL, "op11_url_filter": _OP11_SQL, "op12_hard_negatives": _OP12_SQL,
                          "op13_merkle_manifest": _OP13_SQL}
