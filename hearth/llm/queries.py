"""The numbered operators as registered queries, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op3_jump_sharding(spark, sf_dir):
    from hearth.llm.sharding import shard_documents
    return shard_documents(read(spark, sf_dir, "documents"), 24)


@query
def op8_site_lines(spark, sf_dir):
    from hearth.llm.line_dedup import drop_site_boilerplate
    return drop_site_boilerplate(read(spark, sf_dir, "pages"))


@query
def op10_source_mix(spark, sf_dir):
    from hearth.llm.mixing import mix_sources
    out = mix_sources(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
                      F.col("__target").alias("target"), (F.col("__times") * F.col("__size")).cast("long").alias("taken"))


ORACLES["op8_site_lines"] = r"""
WITH lines AS (
  SELECT row_number() OVER () AS rid, page_id,
         lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
           '(?is)<!--.*?(?:-->|\z)|<script[^<>]*>.*?(?:</script>|\z)|<style[^<>]*>.*?(?:</style>|\z)', chr(10), 'g'),
           '(?i)</?(?:address|article|aside|blockquote|body|br|div|dd|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)(?:[\x20\x09-\x0D/][^<>]*)?>', chr(10), 'g'),
           '<[^<>]*>', '', 'g'), chr(10)), lambda x: trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'))), lambda x: x <> '') AS ls
  FROM pages),
one AS (SELECT rid, page_id, host, ls, unnest(range(1, len(ls) + 1)) AS k FROM lines),
line AS (SELECT rid, page_id, host, k, ls[k] AS line FROM one),
total AS (SELECT host, count(*) AS p FROM lines GROUP BY host),
common AS (SELECT host, line FROM (SELECT host, line, count(DISTINCT rid) AS n FROM line GROUP BY host, line)
           JOIN total USING (host) WHERE n >= 3 AND n > 0.2 * p),
kept AS (SELECT rid, count(*) AS n, string_agg(line, chr(10) ORDER BY k) AS text FROM line
         WHERE NOT EXISTS (SELECT 1 FROM common c WHERE c.host = line.host AND c.line = line.line) GROUP BY rid)
SELECT page_id, host, len(ls)::INTEGER AS n_lines, (len(ls) - coalesce(n, 0))::INTEGER AS n_dropped,
       coalesce(text, '') AS text
FROM lines LEFT JOIN kept USING (rid)
"""

ORACLES["op10_source_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || chr(31) || coalesce(text, '')), 1, 15))::BIGINT AS h,
         row_number() OVER () AS r
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
r AS (SELECT *, source_size * 3.0::DOUBLE AS cap, source_size * 3.0::DOUBLE / weight AS ratio FROM w),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM r),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT min_by(lv, ratio) FROM l WHERE ratio > lv), 0) * weight) AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
g AS (SELECT source, h, sum(size) AS n, count(*) AS copies FROM d GROUP BY source, h),
c AS (SELECT source, h, n, copies, coalesce(sum(n) OVER (PARTITION BY source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM g),
k AS (SELECT *, row_number() OVER (PARTITION BY source, h ORDER BY r) - 1 AS number FROM d)
SELECT k.doc_id, k.size, p.source_size, p.target::DOUBLE AS target,
       (k.size * (whole + CASE WHEN target - whole * source_size > 0
                               AND earlier + (number::DOUBLE + 0.5::DOUBLE) * (n::DOUBLE / copies) <= target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM k JOIN p ON k.source IS NOT DISTINCT FROM p.source
JOIN c ON k.source IS NOT DISTINCT FROM c.source AND k.h = c.h
"""


@query
def op1_ngram_jaccard(spark, sf_dir):
    from hearth.llm.ngram_jaccard import near_duplicates
    return near_duplicates(read(spark, sf_dir, "documents"))


@query
def op9_toxicity_gru(spark, sf_dir):
    from hearth.llm.toxicity import score_toxicity
    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op5_suffix_tree_lm(spark, sf_dir):
    from hearth.llm.suffix_tree_lm import score_documents
    return score_documents(read(spark, sf_dir, "documents"))


@query
def op7_fm_index_dedup(spark, sf_dir):
    from hearth.llm.fm_dedup import remove_repeated
    out = remove_repeated(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


@query
def op2_pstable_dedup(spark, sf_dir):
    from hearth.llm.embedding_dedup import near_duplicates
    return near_duplicates(read(spark, sf_dir, "embeddings"))


@query
def op4_seeded_alignment(spark, sf_dir):
    from hearth.llm.decontamination import find_leaks
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op6_license_rules(spark, sf_dir):
    from hearth.llm.license_scan import scan_licenses
    return scan_licenses(read(spark, sf_dir, "documents"))


@query
def op11_language_profiles(spark, sf_dir):
    from hearth.llm.language_id import identify_languages
    return identify_languages(read(spark, sf_dir, "documents"))


@query
def op12_periodic_runs(spark, sf_dir):
    from hearth.llm.periodic_runs import digest, periodic_runs
    return digest(periodic_runs(read(spark, sf_dir, "documents"), repeat_tails=True))


@query
def op13_embedding_whitening(spark, sf_dir):
    from hearth.llm.whitening import whitened
    return whitened(read(spark, sf_dir, "embeddings"))
