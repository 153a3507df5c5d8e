"""The registered queries of this package, and SQL for those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.files import table
from ..session import run_dir
from . import (audit, centroids, decontaminate, exact_dedup, lang_id, lm_score, ngram_join, packing, quality_rules,
               secret_scan, sharding, token_ids, url_filters)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(build):
        QUERIES[build.__name__] = build
        if sql:
            SQL[build.__name__] = sql
        return build
    return add


# Fixed values of the contract.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
SHARDS = 16


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@_query()
def op1_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = run_dir(spark, "token-ids")
    token_ids.write_ids(table(spark, folder, "documents"), path, tokenizer_file())
    return token_ids.read_digests(spark, path)


@_query()
def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_tokens(table(spark, folder, "documents"), tokenizer_file(), with_ids=False)


@_query("""WITH cut AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages), parts AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
rules(verdict, host, path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
  ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/'))
SELECT p.page_id, p.host, p.path, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
       coalesce(max_by(r.verdict, length(r.host || r.path)), 'allow') AS verdict
FROM parts p LEFT JOIN rules r
  ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
GROUP BY p.page_id, p.host, p.path""")
def op3_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = url_filters.judge(pages, url_filters.rules_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@_query()
def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.place(table(spark, folder, "documents"), SHARDS)


@_query(r"""WITH squeezed AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents),
groups AS (
  SELECT t, count(*) AS group_size, arg_min(doc_id, struct_pack(a := -chars, b := doc_id)) AS keep_id
  FROM squeezed GROUP BY t)
SELECT s.doc_id, g.keep_id, g.group_size, s.doc_id = g.keep_id AS kept, sha256(s.t) AS text_sha256
FROM squeezed s JOIN groups g USING (t)""")
def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


@_query()
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return lang_id.identify(table(spark, folder, "documents"))


@_query()
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@_query()
def op8_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.classes(table(spark, folder, "documents")).select(
        "doc_id", "class_id", "n_links", "kept")


@_query()
def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score(table(spark, folder, "documents"))


@_query()
def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The findings without their text: its length and checksum tell them apart."""
    return secret_scan.scan(table(spark, folder, "documents")).select(
        "doc_id", "no", "start", F.length("secret").alias("length"),
        F.crc32(F.col("secret").cast("binary")).alias("secret_crc32"), "kind", "held_out",
        "probability", "is_secret")


_STOP_WORDS = ", ".join(f"'{word}'" for word in sorted({w for of in quality_rules.STOP_WORDS.values() for w in of}))


@_query(rf"""WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT row_id, i, words[i:i + 2] AS w FROM (
    SELECT row_number() OVER () AS row_id, words, unnest(generate_series(1, len(words) - 2)) AS i FROM texts)),
again AS (SELECT row_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY row_id, w) > 1),
repeats AS (
  SELECT row_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT row_id, i + unnest([0, 1, 2]) AS place FROM again) GROUP BY row_id),
measured AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         len(lines) AS n_lines, len(list_filter(words, lambda x: regexp_matches(x, '\pL'))) AS n_letter_words,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[•*-]'))) AS n_bullet_lines,
         len(list_distinct(list_filter(list_transform(words, lambda x: lower(x)), lambda x: x IN ({_STOP_WORDS})))) AS n_stop_kinds,
         len(regexp_extract_all(text, '\p{{Lu}}')) AS n_capitals
  FROM (SELECT row_number() OVER () AS row_id, * FROM texts) LEFT JOIN repeats USING (row_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_words > 100000 OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
           OR 5 * n_letter_words < 4 * n_words AS hard_failed,
         [word_chars < 3 * n_words, word_chars > 10 * n_words, 10 * n_ellipsis_lines > 3 * n_lines,
          10 * n_bullet_lines > 9 * n_lines, n_stop_kinds < 2, 100 * n_capitals > 30 * word_chars] AS soft
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT hard_failed AND len(list_filter(soft, lambda x: x)) <= 1 AS kept,
       CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (n_words > 100000)::INT
            + 8 * soft[1]::INT + 16 * soft[2]::INT + 32 * (10 * n_symbols > n_words)::INT
            + 64 * (10 * n_dup_lines > 3 * n_lines)::INT + 128 * (5 * n_letter_words < 4 * n_words)::INT
            + 256 * soft[3]::INT + 512 * soft[4]::INT + 1024 * soft[5]::INT + 2048 * soft[6]::INT AS BIGINT) AS failed
FROM judged""")
def op11_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(quality_rules.ledger(table(spark, folder, "documents")))
    base = quality_rules.bits(*quality_rules.BASE)
    base_failed = F.col("failed").bitwiseAND(F.lit(base)) != 0
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         base_failed.alias("base_failed"), (~base_failed & F.col("kept")).alias("kept"), "failed")


def _centroid_sql(rounds: int = centroids.ROUNDS) -> str:
    """Rounds of plain assignment to the nearest of all centroids, one after the other."""
    steps = ["""whole AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)""",
             """parts AS (SELECT r, unnest(generate_series(1, 64)) AS i, unnest(v) AS x FROM whole)""",
             """c0 AS (
  SELECT c, unnest(generate_series(1, 64)) AS i, unnest(v) AS x FROM (
    SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v FROM whole) WHERE c < 40)"""]
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
  SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT r, c, CAST(sum((p.x - q.x) * (p.x - q.x)) AS BIGINT) AS d
    FROM parts p JOIN c{k} q USING (i) GROUP BY r, c) GROUP BY r)""")
        if k < rounds:
            steps.append(f"""c{k + 1} AS MATERIALIZED (
  SELECT c, i, coalesce(moved, x) AS x FROM c{k} LEFT JOIN (
    SELECT c, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS moved FROM parts JOIN a{k} USING (r) GROUP BY c, i)
    USING (c, i))""")
    return f"""WITH {', '.join(steps)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, name AS centroid_sha256
FROM a{rounds} JOIN whole USING (r)
  JOIN (SELECT c, sha256(string_agg(x, ',' ORDER BY i)) AS name FROM c{rounds} GROUP BY c) USING (c)"""


@_query(_centroid_sql())
def op12_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(table(spark, folder, "embeddings"))


@_query(r"""WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents),
flags AS (
  SELECT d.part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic, map {
    'A': len(w) < 100, 'B': 100 * len(list_distinct(w)) < 80 * len(w),
    'C': 100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text),
    'D': regexp_matches(text, '[#$%&*|]'),
    'E': doc_id > min(doc_id) OVER (PARTITION BY text)} AS fails
  FROM words d LEFT JOIN labels l USING (doc_id)),
orders(filter_order) AS (
  SELECT '' UNION ALL
  SELECT filter_order || f FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f)
  WHERE NOT contains(filter_order, f)),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS f,
         string_split(filter_order[1:step - 1], '') AS before
  FROM orders, (SELECT unnest(generate_series(1, 5)) AS step) WHERE length(filter_order) = 5),
folded AS (SELECT part, good, toxic, fails, count(*) AS n FROM flags GROUP BY ALL),
tried AS (
  SELECT part, filter_order, step, f, n, good, toxic, fails[f] AS failing,
         len(list_filter(before, lambda x: x <> '' AND fails[x])) > 0 AS gone,
         len(list_filter(map_values(fails), lambda x: x)) AS failures
  FROM folded, steps),
found AS (
  SELECT part, filter_order, step, f,
         CAST(coalesce(sum(n) FILTER (NOT gone AND NOT failing), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (NOT gone AND failing), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (gone AND failing), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (failing AND failures = 1), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(n) FILTER (NOT gone AND failing AND good), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(n) FILTER (NOT gone AND failing AND toxic), 0) AS BIGINT) AS toxic_lost
  FROM tried GROUP BY ALL)
SELECT * EXCLUDE (f), CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM found""")
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.interactions(table(spark, folder, "documents"), table(spark, folder, "labels"))
