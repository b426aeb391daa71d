"""Registered queries of the corpus operators: one ``opN_<name>`` each, over
the whole intended table with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratesmith.llm import (bpe, collocations, decontamination, embedding_dedup, filter_audit, licenses,
                           mixing, pii, secrets, simhash, sketches, toxicity, urls)

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> None:
    """Python workers import this package from where it is installed."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, _ROOT]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op2_embedding_near_dedup", """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), u AS (
  SELECT vec_id, e FROM v
  WHERE e IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_sum(list_transform(e, lambda x: x * x)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS x, vec_id AS y FROM v
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
)
SELECT v.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, c.component_id,
       v.vec_id = c.component_id AS kept
FROM v LEFT JOIN (SELECT x, count(*) AS n_links FROM links GROUP BY x) n ON n.x = v.vec_id
JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = v.vec_id""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, components and kept vectors of all embeddings at cosine 0.95."""
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "n_links", "component_id", "kept")


@register("op6_simhash_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


@register("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the rows not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = toxicity.fit(docs.filter(~held_out), labels.filter(~held_out))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def token_digests(decoded: DataFrame) -> DataFrame:
    """Number of tokens, and hashes of the ids and of the decoded bytes."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op4_byte_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and the bytes they decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return token_digests(bpe.encode(table(spark, sf_dir, "documents"), ranks,
                                    public_tokenizers.PATTERN, decoded=True))


@register("op7_source_mix")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a 1:2:3 mix of all sources takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(1, 2, 3)).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "first_slot", "last_slot")


#: Host and path rules of the url query.
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"),
             ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
             ("net", "/fr/", "block"))


@register("op10_url_filter")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url by rules, else by its path template."""
    return urls.filter_urls(table(spark, sf_dir, "pages"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "template", "purity")


@register("op5_personal_data")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document."""
    return pii.digest_columns(pii.find_personal_data(table(spark, sf_dir, "documents")))


@register("op8_paragraph_sketch")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketch fingerprint of every document, its edited text and the next."""
    found = sketches.fingerprint_documents(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.size(c).cast("long") for c in ("removed", "added")})


@register("op9_secret_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    return secrets.digest_columns(secrets.find_secrets(table(spark, sf_dir, "documents")))


@register("op3_licence_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families and notices of every document."""
    found = licenses.scan_licences(table(spark, sf_dir, "documents"))
    shown = F.transform("notices", lambda s: F.concat(
        s["family"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))
    return found.select(
        "doc_id", F.size("notices").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct("notices.family")), ",").alias("families"),
        F.array_join(shown, ",").alias("spans"),
        F.array_max("notices.probability").alias("probability"))


@register("op11_benchmark_decontamination", r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), bw AS (
  SELECT DISTINCT item, least(len(ws), 10) AS k,
         ws[i:i + least(len(ws), 10) - 1] AS w
  FROM (SELECT item, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0)
), dw AS (
  SELECT row, i, k, ws[i:i + k - 1] AS w
  FROM (SELECT row, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM bw) WHERE len(ws) >= k)
), hit AS (SELECT row, i, k, item FROM dw JOIN bw USING (k, w)
), pos AS (
  SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + k)) AS p FROM hit) GROUP BY row
), its AS (
  SELECT row, count(DISTINCT item) AS n_items,
         sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items_sha256 FROM hit GROUP BY row
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (row) LEFT JOIN its USING (row)""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in benchmark passages, and the items."""
    found = decontamination.contamination(table(spark, sf_dir, "documents"),
                                          table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


@register("op12_phrase_collocations", r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p
), g AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM w, (SELECT unnest(range(1, 5)) AS k) WHERE len(ws) >= k)
), f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL
), t AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 30
), cut AS (
  SELECT c.lang, c.phrase, c.k, c.a, j, array_to_string(ws[1:j], ' ') AS lp,
         array_to_string(ws[j + 1:], ' ') AS rp
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
), s AS (
  SELECT cut.lang, cut.phrase, cut.k, cut.a, j, l.f AS l, r.f AS r,
         (2000000::HUGEINT * cut.a) // (l.f + r.f) AS score
  FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = lp AND l.k = j
  JOIN f r ON r.lang = cut.lang AND r.phrase = rp AND r.k = cut.k - j
), low AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inner_of AS (
  SELECT DISTINCT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i
        FROM (SELECT *, unnest(range(2, k)) AS m FROM c WHERE k > 2))
), kept AS (
  SELECT * FROM low WHERE NOT EXISTS (
    SELECT 1 FROM inner_of i WHERE i.lang = low.lang AND i.phrase = low.phrase
      AND 100::HUGEINT * i.a >= 80::HUGEINT * low.a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
       n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN t USING (lang) WHERE rank <= 2000""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 strongest phrases of 2 to 4 words."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


@register("op13_filter_interaction_audit", r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM d LEFT JOIN l USING (doc_id)
), cell AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL
), f AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(f, bit)
), o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), s AS (
  SELECT filter_order, step, bits[step] AS bit,
         coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS before
  FROM o, (SELECT unnest(range(1, 6)) AS step)
), r AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & before = 0 AND mask & bit = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cell, s GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM r""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of five filters per source, order and step."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
