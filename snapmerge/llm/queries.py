"""One registered query per corpus operator: production parameters, whole tables, digest columns of the contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from snapmerge.llm import (cover_tree, decontam, hard_negatives, html_text, line_rules, packing, quality_pu, repeats, sharding, simhash,
                           toxicity, vector_codes, vectors, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The vocabulary file of the packing query."""
    return public_tokenizers.path("word_bpe_49k.json")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a benchmark window, and the verdict."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.decontaminate(docs, _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint of every document and the component of its near-duplicates."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from three quarters of the labelled rows."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", toxicity.held_out(F.col("doc_id"), 4, 2).alias("held_out"))
    labels = _table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id"), 4, 2))
    return toxicity.classify(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat elsewhere in strings of 400, and the digest of what is left."""
    return repeats.digest(repeats.mark_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"), tidy=False))


def op5_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the positives of two thirds of the labelled rows."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", toxicity.held_out(F.col("doc_id"), 3, 1).alias("held_out"))
    labels = _table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id"), 3, 1))
    return quality_pu.classify(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word rules of every document, and whether it is kept after lines common to its source are removed."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_rules.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                         "base_failed", "kept", "removed_words")


def op7_packing(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Every document's token pieces and their places in sequences of at most 2048 tokens."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = packing.pieces(docs, path or tokenizer_path())
    cut = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(cut)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the archives it was written to."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in 16 shards of nearly equal bytes."""
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    return sharding.shard_documents(docs, keep_text=False).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op11_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of every embedding within its label: number of links and component."""
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    return cover_tree.near_duplicates(rows).select("vec_id", "n_links", "component_id", "kept")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive; labels of every seventh id are moved on, components are whole 256ths."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = (_table(spark, sf_dir, "embeddings").where(vectors.usable(F.col("embedding")))
            .select("vec_id", label.alias("label"), vectors.scaled_down(F.col("embedding"), 256).alias("vector")))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every embedding, the errors of its label, and the digest of the codebooks."""
    coded, books = vector_codes.compress(_table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    digits = F.transform("code", lambda c: F.lower(F.lpad(F.hex(c.cast("long")), 2, "0")))
    return (vector_codes.error_by(coded.withColumn("code", F.array_join(digits, "")), "label")
            .select("vec_id", "code", "error", "label_error", F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256")))


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_simhash, op3_toxicity, op4_suffix_dedup, op5_quality_pu, op6_line_rules,
                                   op7_packing, op8_warc, op9_sharding, op10_html_text, op11_cover_tree, op12_hard_negatives,
                                   op13_vector_codes)}

OP1_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
wins AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS s
  FROM items, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS g(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM wins),
hits AS (
  SELECT d.doc_id, i, d.n, wins.item_id FROM (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
    FROM words, sizes, unnest(generate_series(1, len(w) - n + 1)) AS g(i) WHERE len(w) >= n) d
  JOIN wins ON wins.n = d.n AND wins.s = d.s),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, i, n FROM hits), unnest(generate_series(i, i + n - 1)) AS g(p) GROUP BY doc_id),
owners AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS list
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hits) GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(o.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(o.list, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(w.w) AS contaminated
FROM words w LEFT JOIN covered c USING (doc_id) LEFT JOIN owners o USING (doc_id)
"""

OP6_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce('=' || source, '') AS host,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM docs, unnest(generate_series(1, len(w) - 4)) AS x(i) WHERE len(w) >= 5),
twice AS (SELECT doc_id, g FROM grams GROUP BY ALL HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM grams JOIN twice USING (doc_id, g), unnest(generate_series(0, 4)) AS x(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, host, t, line, regexp_replace(trim(regexp_replace(lower(line), '\s+', ' ', 'g')), '[1-9]', '0', 'g') AS k,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, host, t, unnest(string_split(t, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
doubled AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id),
hosts AS (SELECT host, count(DISTINCT t) AS host_docs FROM docs GROUP BY host),
boiler AS (
  SELECT host, k FROM (SELECT host, k, count(DISTINCT t) AS n FROM lines GROUP BY host, k) JOIN hosts USING (host)
  WHERE n > 10 AND n > 0.05 * host_docs),
lost AS (SELECT doc_id, sum(n) AS n FROM lines JOIN boiler USING (host, k) GROUP BY doc_id),
counts AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(u.n, 0)::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(l.n, 0)::BIGINT AS removed_words
  FROM docs d LEFT JOIN doubled u USING (doc_id) LEFT JOIN covered c USING (doc_id) LEFT JOIN lost l USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND removed_words <= 0.5 * n_words AS kept
FROM counts
"""

_USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

OP11_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND {_USABLE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS v, vec_id AS r FROM embeddings UNION SELECT reach.v, pairs.b FROM reach JOIN pairs ON reach.r = pairs.a),
low AS (SELECT v, min(r) AS component_id FROM reach GROUP BY v),
n AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN low ON v = vec_id LEFT JOIN n ON a = vec_id
"""

OP12_SQL = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND {_USABLE}),
scored AS (
  SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS s
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor, other, s FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY s DESC, other) <= 5)
SELECT p.anchor AS anchor_id, p.other AS positive_id,
       row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.s DESC, n.other)::INTEGER AS rank,
       n.other AS negative_id, p.s AS positive_score, n.s AS negative_score
FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same AND 80 * p.s <= 100 * n.s AND n.s <= p.s
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.s DESC, n.other) <= 5
"""


def _codes_sql(rounds: int = vector_codes.ROUNDS) -> str:
    """One pair of CTEs per round: nearest entries, and the codebook that follows from them."""
    near = """
near{k} AS MATERIALIZED (
  SELECT vec_id, p, e, err FROM (
    SELECT x.vec_id, x.p, b.e, sum((x.x - b.x) * (x.x - b.x)) AS err FROM parts x JOIN book{k} b ON x.p = b.p AND x.d = b.d GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY err, e) = 1)"""
    step = """
book{n} AS MATERIALIZED (
  SELECT b.p, b.e, b.d, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN (
    SELECT n.p, n.e, x.d, floor(sum(x.x)::DOUBLE / count(*))::BIGINT AS x FROM near{k} n JOIN parts x USING (vec_id, p) GROUP BY ALL) m
  ON b.p = m.p AND b.e = m.e AND b.d = m.d)"""
    chain = [t for k in range(rounds) for t in (near.format(k=k), step.format(k=k, n=k + 1))] + [near.format(k=rounds)]
    return f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS e FROM embeddings WHERE {_USABLE}),
parts AS MATERIALIZED (
  SELECT vec_id, p, d, e[p * (len(e) // 8) + d + 1] AS x
  FROM v, unnest(generate_series(0, 7)) AS a(p), unnest(generate_series(0, len(e) // 8 - 1)) AS c(d)),
book0 AS MATERIALIZED (
  SELECT p, e, d, x FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM v ORDER BY vec_id LIMIT 16) USING (vec_id)),
{','.join(chain)},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(err)::BIGINT AS error FROM near{rounds} GROUP BY vec_id),
digest AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, d)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN v USING (vec_id), digest
"""


ORACLE = {"op1_decontamination": OP1_SQL, "op6_line_rules": OP6_SQL, "op11_cover_tree": OP11_SQL, "op12_hard_negatives": OP12_SQL,
          "op13_vector_codes": _codes_sql()}
