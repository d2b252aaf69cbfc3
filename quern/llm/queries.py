"""The operators with production parameters over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from . import fingerprint, html_extract, langid, licenses, mixing, near_dedup, packing, quality, sharding, toxicity

SHARDS = 24
TOXIC_FROM = 0.7
#: Shares of expected tokens by labelled domain.
DOMAIN_TARGETS = {"clean": 0.90, "low": 0.06, "toxic": 0.04}


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of a file that one task reads well.
SPLIT = 128 << 20


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of long texts, dealt over all cores if it has fewer files than there are cores, and they are so small that
    Spark would not split them: texts take far longer to work on than to move."""
    df = table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores:
        return df
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    size = where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()
    return df.repartition(cores) if size <= cores * SPLIT else df


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(texts(spark, sf_dir, "pages"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(texts(spark, sf_dir, "documents"), shingle=4, percent=80)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(texts(spark, sf_dir, "documents"), tokenizer=tokenizer_path(), capacity=1024, end_id=2)


def held_out(id_col: str, parts: int, part: int) -> F.Column:
    return F.crc32(F.col(id_col).cast("string")) % parts == part


def language_model(docs: DataFrame) -> langid.Model:
    train = docs.where(~held_out("doc_id", 5, 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    return langid.fit(langid.sampled(train, "lang", "doc_id", LANGUAGE_SAMPLE))


#: Documents of each language that the model is fitted on, about.
LANGUAGE_SAMPLE = 2000


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir, "documents")
    out = langid.predict(docs, language_model(docs))
    return out.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score", "languages")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_filter(texts(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(texts(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    carry = {"size": (F.octet_length(text) + 8).cast("bigint"), "text_crc32": F.crc32(text)}
    out = sharding.assign_shards(texts(spark, sf_dir, "documents"), weights=[1.0] * SHARDS, carry=carry)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 3, 1))
    out = toxicity.score_texts(texts(spark, sf_dir, "documents"), labels)
    return out.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "evidence")


def domains_of(labels: DataFrame) -> DataFrame:
    """doc_id and domain: toxic, else low or clean by the quality label."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean")
    return labels.select("doc_id", domain.alias("domain"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = texts(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return mixing.mix(docs, domains_of(labels), DOMAIN_TARGETS, anchor="clean", carry=["doc_id", "source"])


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(texts(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_html_extraction, op2_minhash_near_dedup, op3_best_fit_packing, op4_language_id, op5_quality_rules, op6_license_scans, op7_sharding, op8_toxicity, op9_source_mixing, op10_document_fingerprints]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op5_quality_rules": QUALITY_SQL}


QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, lang, source, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
t AS (SELECT doc_id, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT doc_id, i FROM t QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY 1),
base AS (SELECT w.doc_id AS doc_id, lang, source, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars, n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed FROM w LEFT JOIN c ON w.doc_id = c.doc_id),
m AS (SELECT doc_id, lang, source, 'symbol' AS measure, n_symbols AS hits, n_words AS size FROM base WHERE NOT base_failed
    UNION ALL SELECT doc_id, lang, source, 'dup_line', n_dup_lines, n_lines FROM base WHERE NOT base_failed
    UNION ALL SELECT doc_id, lang, source, 'repeat', n_repeat_words, n_words FROM base WHERE NOT base_failed
    UNION ALL SELECT doc_id, lang, source, 'mean_word', word_chars, n_words FROM base WHERE NOT base_failed),
s AS (SELECT lang, source, measure, CASE WHEN hits > 0 THEN CAST(floor(ln(greatest(hits / size, 0.000001)) / ln(1.05) + 1000) AS INTEGER) ELSE -1 END AS bucket, count(*) AS n FROM m GROUP BY ALL),
l AS (SELECT 1 AS level, lang, source, measure, bucket, n FROM s UNION ALL SELECT 2, lang, NULL, measure, bucket, sum(n) FROM s GROUP BY ALL UNION ALL SELECT 3, NULL, NULL, measure, bucket, sum(n) FROM s GROUP BY ALL),
u AS (SELECT *, sum(n) OVER g AS total, sum(n) OVER (g ORDER BY bucket) AS upto, coalesce(sum(n) FILTER (bucket >= 0) OVER g, 0) AS nz, coalesce(sum(n) FILTER (bucket >= 0) OVER (g ORDER BY bucket), 0) AS nz_upto,
    CASE WHEN bucket < 0 THEN 0 ELSE pow(1.05::DOUBLE, bucket - 1000 + 0.5) END AS value FROM l WINDOW g AS (PARTITION BY level, lang, source, measure)),
q AS (SELECT level, lang, source, measure, max(total) AS docs, max(nz) AS nz, sum(n * value) / sum(n) AS mean, min(value) FILTER (upto >= ceil(total * 0.75)) AS q3, min(value) FILTER (upto >= ceil(total * 0.25)) AS q1,
    min(bucket) FILTER (bucket >= 0 AND nz_upto >= ceil(nz * 0.75)) AS p3, min(bucket) FILTER (bucket >= 0 AND nz_upto >= ceil(nz * 0.25)) AS p1 FROM u GROUP BY ALL),
f AS (SELECT level, lang, source, measure, docs, nz, CASE WHEN measure = 'symbol' THEN greatest(q3 + 3.0 * (q3 - q1), mean) ELSE q3 + 3.0 * (q3 - q1) END AS fence,
    CASE WHEN measure IN ('dup_line', 'repeat') THEN pow(1.05::DOUBLE, p3 + 1.5 * (p3 - p1) - 1000 + 0.5) END AS burst FROM q),
v AS (SELECT m.doc_id AS doc_id, bool_and((m.hits - 3.0 * sqrt(m.hits)) / m.size <= greatest(CASE WHEN a.docs >= 100 THEN a.fence WHEN b.docs >= 100 THEN b.fence ELSE e.fence END, CASE WHEN a.nz >= 100 THEN a.burst WHEN b.nz >= 100 THEN b.burst ELSE e.burst END)) AS fits FROM m
    JOIN f a ON a.level = 1 AND a.measure = m.measure AND a.lang IS NOT DISTINCT FROM m.lang AND a.source IS NOT DISTINCT FROM m.source
    JOIN f b ON b.level = 2 AND b.measure = m.measure AND b.lang IS NOT DISTINCT FROM m.lang JOIN f e ON e.level = 3 AND e.measure = m.measure GROUP BY 1)
SELECT base.doc_id AS doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(fits, false) AS kept FROM base LEFT JOIN v ON base.doc_id = v.doc_id
"""
