"""The queries of this folder, one per operator, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowwarden.llm import ann, bpe, chat, extract, jaccard, mixing, negatives, repair, sharding, topk, toxicity, url_filter, warc
from flowwarden.llm.common import ready, table
from flowwarden.session import apply_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "byte_bpe_50k.json"


def query(sql: str | None = None):
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ready(apply_settings(spark)), sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return run

    return register


@query()
def op1_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filter.train(url_filter.rule_labels(pages))
    return url_filter.judge(pages, model).select("page_id", "host", "path", "rule", "verdict", "block_score")


_OP2 = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighted AS (
  SELECT source, source_size, ([5.0, 2.0, 1.0])[(place % 3) + 1]::DOUBLE AS w, 3.0::DOUBLE * source_size AS cap FROM sources),
-- In the order of cap / weight a source is capped as long as its share of the rest reaches its cap.
ordered AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS k,
         coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
         sum(source_size) OVER () AS total
  FROM weighted),
first_open AS (SELECT min(k) AS k FROM ordered WHERE (total - before) / open * w < cap),
rate AS (SELECT (total - before) / open AS r FROM ordered WHERE k = (SELECT k FROM first_open)),
targets AS (
  SELECT o.source, o.source_size,
         CASE WHEN f.k IS NULL OR o.k < f.k THEN o.cap ELSE least(o.cap, o.w * r.r) END AS target
  FROM ordered o CROSS JOIN first_open f LEFT JOIN rate r ON true),
budget AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS rounds FROM targets),
hashes AS (SELECT source, h, sum(size) AS words FROM sized GROUP BY source, h),
running AS (
  SELECT source, h, words, sum(words) OVER (PARTITION BY source ORDER BY h) AS upto FROM hashes),
chosen AS (
  SELECT r.source, r.h,
         CASE WHEN upto <= target - rounds * b.source_size THEN 1
              WHEN upto - words <= target - rounds * b.source_size
               AND words - (target - rounds * b.source_size - (upto - words)) <= target - rounds * b.source_size - (upto - words)
               AND words > 0 THEN 1 ELSE 0 END AS more
  FROM running r JOIN budget b ON r.source IS NOT DISTINCT FROM b.source)
SELECT s.doc_id, s.size, b.source_size, b.target, CAST(s.size * least(b.rounds + c.more, 3) AS BIGINT) AS taken
FROM sized s
JOIN budget b ON s.source IS NOT DISTINCT FROM b.source
JOIN chosen c ON s.source IS NOT DISTINCT FROM c.source AND s.h = c.h
"""


@query(_OP2)
def op2_source_mixing(spark, sf_dir):
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return toxicity.score(docs.select("doc_id", "text", held_out().alias("held_out")), model, ("doc_id", "held_out"))


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


@query()
def op4_sharding(spark, sf_dir):
    placed = sharding.shards(table(spark, sf_dir, "documents"), 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


_OP5 = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum([x[1] * x[2] for x in list_zip(a.q, b.q)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""


@query(_OP5)
def op5_exact_topk(spark, sf_dir):
    return topk.top_products(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0, k=10)


@query()
def op6_ngram_jaccard(spark, sf_dir):
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@query()
def op7_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    archives = warc.arc_files(pages, "page_id", "url", "html")
    back = warc.read_warc(spark, warc.convert_archives(archives))
    return back.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op8_nearest(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0, k=5)


@query()
def op9_bpe(spark, sf_dir):
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query()
def op10_chat(spark, sf_dir):
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.prefix_examples(rows))


_OP11 = """
WITH v AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label,
         CAST(list_sum([x[1] * x[2] for x in list_zip(a.q, b.q)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
 AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""


@query(_OP11)
def op11_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return negatives.hard_negatives(rows, lambda i: i % 100 == 0)


# Holds for the pages of the given tables: each marks its article by <article>, and these are the references they use.
_OP12 = r"""
WITH blocks AS (
  SELECT page_id, url, list_filter(list_transform(
           string_split_regex(replace(regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'), '<br>', ' '), '</?(p|h1)>'),
           lambda b: trim(regexp_replace(regexp_replace(regexp_replace(replace(replace(regexp_replace(b, '<[a-z/][^>]*>', '', 'g'),
             '&lt;', '<'), '&gt;', '>'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))),
         lambda b: b <> '') AS found FROM pages)
SELECT page_id, url, coalesce(array_to_string(found, chr(10)), '') AS text, CAST(length(coalesce(array_to_string(found, chr(10)), '')) AS BIGINT) AS n_chars
FROM blocks
"""


@query(_OP12)
def op12_html_extraction(spark, sf_dir):
    return extract.extract_pages(table(spark, sf_dir, "pages"))


@query()
def op13_conversation_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.repair_report(repair.damage(rows), rows)
