"""One query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outreach.llm import decontamination, divergence, html_text, language_id, lm_scoring, merkle, mixing, near_dedup
from outreach.llm import simhash, token_rollup, toxicity, vector_search, warc
from outreach.llm.common import fold, table
from outreach.sources.staging import stage, stage_path

# Vocabulary of the counted tokenizer; installed beside the interpreter by default.
VOCABULARY = os.environ.get("TOKENIZER_FILES", "/opt/tokenizers") + "/byte_bpe_50k.tiktoken"
# How that vocabulary cuts a text before merging: a fixed value of the format.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    part = fold(F.col("doc_id"), 10)  # 0 is not learned from, 1 fits the mixture's weights
    role = F.when(part == 0, lm_scoring.TEST).when(part == 1, lm_scoring.HELD).otherwise(lm_scoring.MAIN)
    out = lm_scoring.score_texts(docs, role).withColumn("held_out", F.col("role") == lm_scoring.TEST)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op3_near_dedup(spark, sf_dir):
    out = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    part = fold(F.col("doc_id"), 3)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), part != 1)
    out = toxicity.toxicity(docs, model).withColumn("held_out", part == 1)
    return out.select("doc_id", "held_out", "score", "predicted", "whole", "first", "second")


@query
def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    part = fold(F.col("doc_id"), 5)
    out = language_id.identify(docs, language_id.learn(docs, part != 0))
    return out.withColumn("held_out", part == 0).select("doc_id", "held_out", "lang_pred", "score")


@query
def op4_decontamination(spark, sf_dir):
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_mixing(spark, sf_dir):
    return mixing.mixing_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op7_token_rollup(spark, sf_dir):
    """Load all documents, count their words anew by another rule, delete exact copies,
    and load again, which changes nothing.

    Of equal texts the row with the smallest id stays, a row without an id only where no other
    has the text; rows that share an id but not the text all stay. The batch of deletes takes
    all rows away and puts back those that stay, so copies are never listed one by one.
    """
    docs = table(spark, sf_dir, "documents")
    words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "[\\s]+", -1), lambda w: w != "")).cast("long")
    narrow = docs.withColumns({
        "words": words, "letters": F.length(F.coalesce("text", F.lit(""))).cast("long"), "copy_of": F.md5(F.coalesce("text", F.lit(""))),
    })
    keep = ["doc_id", "source", "lang", "words", "letters", "copy_of"]
    counted = stage(token_rollup.token_counts(narrow, VOCABULARY, PATTERN, "bpe", keep))

    def version(name: str, count: str, rows=counted):
        return rows.select("source", "lang", F.lit(name).alias("tokenizer_version"), F.col(count).alias("n_tokens"))

    kept = token_rollup.one_of_each(counted, "copy_of", ["doc_id"])
    gone = token_rollup.deletes(version("byte_bpe_50k", "bpe").unionAll(version("units", "letters")))
    back = token_rollup.inserts(version("byte_bpe_50k", "bpe", kept).unionAll(version("units", "letters", kept)))
    rollup = token_rollup.Rollup(spark, stage_path(spark))
    load = token_rollup.inserts(version("byte_bpe_50k", "bpe").unionAll(version("units", "words")))
    rollup.commit("load", load)
    revised = counted.select("source", "lang", F.lit("units").alias("tokenizer_version"), F.col("letters").alias("n_tokens"), F.col("words").alias("old_tokens"))
    rollup.commit("count letters", token_rollup.revisions(revised))
    rollup.compact()
    rollup.commit("delete copies", gone.unionAll(back))
    rollup.commit("load", load)
    return rollup.totals()


@query
def op8_warc(spark, sf_dir):
    path = stage_path(spark)
    index = warc.write_archive(table(spark, sf_dir, "pages"), path)
    records = warc.read_records(index, path)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op10_vector_search(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return vector_search.nearest(vectors, F.col("vec_id") % 20 == 0)


@query
def op11_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op12_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    out = merkle.manifest(docs, tampered)
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query
def op13_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op8_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), k AS (
  SELECT *, max(page_id) OVER (PARTITION BY h) AS keeper FROM p
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = keeper THEN NULL ELSE keeper END AS refers_to
FROM k
"""

ORACLES["op3_near_dedup"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), c AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (
  SELECT x, y FROM c JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)
), r AS (
  SELECT doc_id, doc_id AS o FROM documents UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.o = l.x
), m AS (SELECT doc_id, min(o) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)
"""

ORACLES["op12_merkle_manifest"] = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, text,
    list_transform([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text],
      lambda v: coalesce(CAST(octet_length(encode(v)) AS VARCHAR) || ':' || v, '-')) AS f
  FROM documents
), e AS (
  SELECT doc_id, source, f, sha256(array_to_string(f, '')) AS leaf,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda h, b: xor(h >> 8, list_reduce(list_concat([xor(h & 255, b)], list_transform(range(8), lambda k: CAST(0 AS BIGINT))),
        lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END))) AS h
  FROM d
), l AS (
  SELECT doc_id, source, leaf,
    CASE WHEN xor(h, CAST(4294967295 AS BIGINT)) % 5 = 0
      THEN sha256(f[1] || f[2] || f[3] || f[4] || coalesce(CAST(octet_length(encode(low)) AS VARCHAR) || ':' || low, '-')) ELSE leaf END AS claimed,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM e
), t AS (
  SELECT source, 0 AS lvl, pos, leaf AS h, n FROM l
  UNION ALL
  SELECT source, lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 15) // 16) FROM t WHERE n > 1 GROUP BY source, lvl, pos // 16
), sub AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1
), u AS (
  SELECT 0 AS lvl, pos, subroot AS h, n FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 15) // 16) FROM u WHERE n > 1 GROUP BY lvl, pos // 16
), low AS (
  SELECT a.source, a.lvl, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS lt,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS rt
  FROM t a JOIN t b ON a.source IS NOT DISTINCT FROM b.source AND a.lvl = b.lvl AND a.pos // 16 = b.pos // 16 WHERE a.n > 1 GROUP BY ALL
), high AS (
  SELECT a.lvl, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS lt,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS rt
  FROM u a JOIN u b ON a.lvl = b.lvl AND a.pos // 16 = b.pos // 16 WHERE a.n > 1 GROUP BY ALL
), steps AS (
  SELECT l.source, l.pos AS doc, low.lvl AS step, lt, rt FROM l JOIN low ON l.source IS NOT DISTINCT FROM low.source AND l.pos // CAST(pow(16, low.lvl) AS BIGINT) = low.pos
  UNION ALL
  SELECT l.source, l.pos, 100 + high.lvl, lt, rt FROM l JOIN sub ON l.source IS NOT DISTINCT FROM sub.source JOIN high ON sub.pos // CAST(pow(16, high.lvl) AS BIGINT) = high.pos
), path AS (
  SELECT source, doc, list({'lt': lt, 'rt': rt} ORDER BY step) AS p FROM steps GROUP BY ALL
), fold AS (
  SELECT l.source, l.pos, l.claimed AS h, coalesce(p, []) AS p, 1 AS k FROM l LEFT JOIN path ON l.source IS NOT DISTINCT FROM path.source AND l.pos = path.doc
  UNION ALL
  SELECT source, pos, sha256(p[k].lt || h || p[k].rt), p, k + 1 FROM fold WHERE k <= len(p)
)
SELECT l.doc_id, l.leaf, sub.subroot, r.h AS root, sha256(array_to_string(list_transform(fold.p, lambda s: s.lt || s.rt), '')) AS proof_sha256,
  fold.h AS folded_root, fold.h = r.h AS verified
FROM l JOIN sub ON l.source IS NOT DISTINCT FROM sub.source JOIN fold ON l.source IS NOT DISTINCT FROM fold.source AND l.pos = fold.pos AND fold.k = len(fold.p) + 1
CROSS JOIN (SELECT h FROM u WHERE n = 1) r
"""

ORACLES["op13_divergence"] = """
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), w AS (
  SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\\x{00}-\\x{40}\\x{5B}-\\x{60}\\x{7B}-\\x{7F}]+')) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS c FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 3
), lt AS (SELECT lang, count(*) AS v, CAST(sum(c) AS BIGINT) AS total FROM kept GROUP BY lang
), n AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL
), g AS (
  SELECT d.lang, d.source, coalesce(any_value(s.total), 0) AS total FROM d LEFT JOIN (SELECT lang, source, CAST(sum(c) AS BIGINT) AS total FROM n GROUP BY ALL) s
    ON d.lang = s.lang AND d.source = s.source GROUP BY d.lang, d.source
), p AS (
  SELECT g.lang, g.source, kept.term, coalesce(n.c, 0) AS c,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(n.c, 0) + 1)) // (g.total + lt.v) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (kept.c + 1)) // (lt.total + lt.v) AS q
  FROM g JOIN kept ON g.lang = kept.lang JOIN lt ON lt.lang = g.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = kept.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(0 AS HUGEINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  UNION ALL
  SELECT a.lang, a.source, b.source, ((a.p - b.p) * (a.p - b.p)) // b.p FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
), s AS (SELECT lang, source, item, CAST(sum(value) AS BIGINT) AS value FROM pairs GROUP BY ALL
), t AS (SELECT lang, source, term AS item, CAST(((p - q) * (p - q)) // q AS BIGINT) AS value FROM p WHERE c > 0 AND p > q
), r AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM s
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) FROM t
)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 200
"""
