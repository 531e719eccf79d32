"""Registered queries of the operators and their DuckDB SQL where one exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrar.llm import (bpe, conversations, decontam, exact_dedup, html_extract, langid, licenses, minhash, runs, sharding, token_io,
                           toxicity, url_filter)
from registrar.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: The tokenizer of the encoding queries.
TOKENIZER = "word_bpe_49k.json"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), 85).drop("text_key")


@query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op3_exact_dedup"] = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM n
"""


@query
def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


RULES = (
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
)


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


ORACLE["op5_url_filter"] = r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(rule_host, rule_path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
best AS (
  SELECT p.page_id, p.host, p.path,
         arg_max(r.rule_host || r.rule_path, length(r.rule_host) * 1000 + length(r.rule_path)) AS rule,
         arg_max(r.verdict, length(r.rule_host) * 1000 + length(r.rule_path)) AS verdict
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
  GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best
"""


@query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 24)


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_io.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), 1)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = langid.held_out(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return langid.identify(docs, langid.train(docs.where("not held_out")))


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op9_decontamination"] = r"""
WITH texts AS (
  SELECT 'doc' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'item', item_id, text FROM benchmark),
words AS (
  SELECT side, id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM texts WHERE text IS NOT NULL),
lengths AS (SELECT DISTINCT least(5, len(w)) AS k FROM words WHERE side = 'item' AND len(w) > 0),
places AS (
  SELECT side, id, k, w, unnest(range(1, len(w) - k + 2)) AS pos
  FROM words JOIN lengths ON len(w) >= k AND (side = 'doc' OR k = least(5, len(w)))),
shingles AS (SELECT DISTINCT side, id, k, array_to_string(w[pos:pos + k - 1], ' ') AS s FROM places),
sizes AS (SELECT id, count(*) AS n FROM shingles WHERE side = 'item' GROUP BY id),
found AS (
  SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_found
  FROM shingles d JOIN shingles i ON d.side = 'doc' AND i.side = 'item' AND d.k = i.k AND d.s = i.s GROUP BY ALL)
SELECT doc_id, item_id, n AS n_shingles, n_found, n_found / n AS containment
FROM found JOIN sizes ON id = item_id WHERE 100 * n_found >= 80 * n
"""


@query
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (toxicity.held_out(table(spark, sf_dir, t)) for t in ("documents", "labels"))
    model = toxicity.train(docs.where("not held_out"), labels.where("not held_out"))
    return toxicity.score(docs, model)


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.detect(runs.damaged(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    best = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), longest.alias("best"), "collapsed",
                        F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n")))).alias("listed"))
    return best.select("doc_id", "n_runs", F.col("best.start").alias("start"), (-F.col("best.less")).alias("length"),
                       F.col("best.period").alias("period"), F.expr("(-1000 * best.less) div best.period").alias("exponent_milli"),
                       F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations")
    return conversations.repair(told, conversations.damaged(told))
