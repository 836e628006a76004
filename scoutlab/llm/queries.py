"""Registered queries of the training-data operators, with their oracle SQL.

Each query applies one operator, with production parameters, to a whole table.
Where SQL cannot express one (hashing, filters, tokenizers, trained models),
``tests/llm`` holds it against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from scoutlab.llm import (decontamination, exact_dedup, html_extract, license_scan, mixing, near_dedup, packing, periodic_runs, quality,
                          sharding, substring_dedup, url_filter, whitening)
from scoutlab.llm.common import settle, table
from scoutlab.llm.registry import ORACLE as LLM_ORACLE, QUERIES as LLM_QUERIES, query

__all__ = ["LLM_ORACLE", "LLM_QUERIES"]


@query("op1_sharding")
def op1_sharding(spark, sf_dir):
    out = sharding.shard_documents(table(spark, sf_dir, "documents"), 8)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "region", "rack")


@query("op2_packing")
def op2_packing(spark, sf_dir):
    import public_tokenizers

    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (
  SELECT source, source_size, 3 * source_size AS cap,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)),
o AS (
  SELECT *, sum(source_size) OVER () AS total,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
         sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM s),
l AS (
  SELECT (total - spent)::DOUBLE / open AS level FROM o
  WHERE cap > weight * ((total - spent)::DOUBLE / open) ORDER BY cap / weight, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * level) AS target,
         floor(least(cap::DOUBLE, weight * level) + 0.5)::BIGINT AS quota FROM s, l),
p AS (
  SELECT doc_id, source, size, coalesce(sum(size) OVER (
           PARTITION BY source ORDER BY md5(concat_ws(':', '42', doc_id::VARCHAR)), doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d)
SELECT p.doc_id, p.size, t.source_size, t.target,
       CASE WHEN t.source_size = 0 THEN 0 ELSE
         (t.quota // t.source_size) * p.size
         + greatest(0, least(p.start + p.size, t.quota % t.source_size) - p.start) END::BIGINT AS taken
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
"""


@query("op5_mixing", MIX_SQL)
def op5_mixing(spark, sf_dir):
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def _quality_sql() -> str:
    def sql(expression: str) -> str:
        return expression.replace(" div ", " // ")

    measures = {r.name: r.value for r in quality.RULES} | quality.SIZES
    values = " UNION ALL ".join(
        f"SELECT lang, source, '{name}' AS rule, ({sql(value)})::BIGINT AS value FROM m WHERE NOT base_failed"
        for name, value in measures.items())
    inside = [f"coalesce({sql(r.value)} {'<=' if r.clean < 50 else '>='} f.{r.name} OR {r.spared}, true)" for r in quality.RULES]
    sizes = [f"max(mid) FILTER (rule = '{name}') AS {name}" for name in quality.SIZES]
    marks = [f"max({c}) FILTER (rule = '{r.name}') AS {r.name}_{c}" for r in quality.RULES for c in ("mid", "low", "upper", "high")]
    fences = [f"{sql(quality.fence_sql(r))} AS {r.name}" for r in quality.RULES]

    def level(keys: str) -> str:
        by = f"{keys}, " if keys else ""
        part = f"PARTITION BY {by}rule"
        return f"""
  SELECT {by}total, {', '.join(fences)} FROM (
    SELECT {by}max(total) AS total, {', '.join(sizes + marks)} FROM (
      SELECT {by}rule, max(total) AS total, min(bucket) FILTER (upto * 100 >= total * 50) AS mid,
             min(bucket) FILTER (upto * 100 >= total * 10) AS low, min(bucket) FILTER (upto * 100 >= total * 75) AS upper,
             min(bucket) FILTER (upto * 100 >= total * 90) AS high
      FROM (SELECT {by}rule, bucket, sum(n) OVER ({part} ORDER BY bucket) AS upto, sum(n) OVER ({part}) AS total
            FROM (SELECT {by}rule, bucket, sum(n) AS n FROM k GROUP BY {by}rule, bucket))
      GROUP BY {by}rule) {'GROUP BY ' + keys if keys else ''})"""

    pick = ", ".join(
        f"CASE WHEN o.total >= {quality.MIN_GROUP} THEN o.{r.name} WHEN l.total >= {quality.MIN_GROUP} THEN l.{r.name} ELSE e.{r.name} END AS {r.name}"
        for r in quality.RULES)
    space = r"[\x20\x09-\x0D]"
    return rf"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (SELECT doc_id, unnest(generate_series(1, len(words) - 2)) AS pos, words FROM w),
h AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, words[pos], words[pos + 1], words[pos + 2]) AS times FROM g),
c AS (SELECT doc_id, count(DISTINCT pos + step) AS n FROM h, (SELECT unnest([0, 1, 2]) AS step) WHERE times > 1 GROUP BY doc_id),
b AS (
  SELECT w.doc_id, lang, source, len(words) AS n_words, length(regexp_replace(text, '{space}', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM w LEFT JOIN c USING (doc_id)),
m AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM b),
v AS ({values}),
k AS (
  SELECT lang, source, rule, (value >> s) << s AS bucket, count(*) AS n
  FROM (SELECT *, greatest(length(bin(value)) - {quality.PRECISION_BITS}, 0)::BIGINT AS s FROM v) GROUP BY ALL),
o AS ({level('lang, source')}),
l AS ({level('lang')}),
e AS ({level('')}),
f AS (SELECT o.lang, o.source, {pick} FROM o LEFT JOIN l ON o.lang IS NOT DISTINCT FROM l.lang, e)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       CASE WHEN base_failed THEN false ELSE {' AND '.join(inside)} END AS kept
FROM m LEFT JOIN f ON m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source
"""


@query("op7_quality", _quality_sql())
def op7_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    rows = settle(quality.measured(docs).drop("text"), "quality-measures")
    return quality.judged(rows).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                       "n_repeat_words", "base_failed", "kept")


@query("op10_exact_dedup", r"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM t JOIN g USING (norm)
""")
def op10_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query("op8_near_dedup")
def op8_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_url_filter")
def op9_url_filter(spark, sf_dir):
    """Pages end in the number of the document they show, which ``labels`` may judge."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    _, path = url_filter.host_and_path(F.col("url"))
    number = F.regexp_extract(path, r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", 1)
    shown = pages.select("page_id", number.try_cast("long").alias("shown"))
    marks = table(spark, sf_dir, "labels").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    labelled = shown.join(marks, F.col("shown") == F.col("doc_id")).select("page_id", "bad")
    return url_filter.filter_urls(pages, labelled)


@query("op3_html_extract")
def op3_html_extract(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.train(pages))


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark, sf_dir):
    out = substring_dedup.substring_duplicates(table(spark, sf_dir, "documents"))
    return out.withColumn("repeated", F.col("n_removed") > 0)


@query("op6_license_scan")
def op6_license_scan(spark, sf_dir):
    return license_scan.licenses(table(spark, sf_dir, "documents"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.periodic_runs(docs, periodic_runs.periodic_tail(F.col("doc_id"), F.col("text")))
    run = "struct<start: long, length: long, period: long>"
    none = F.lit(None).cast(run)
    # runs come by start, then period, so the first of those that tie stays
    best = F.aggregate("runs", none, lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return found.select("_row.doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words").select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256", "n_words")


@query("op12_whitening")
def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query("op13_decontamination")
def op13_decontamination(spark, sf_dir):
    found = decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))
