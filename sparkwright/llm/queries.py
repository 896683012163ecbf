"""The thin queries of this package over the driver tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkwright.session import table

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn
    return deco


@query("op1_sum_of_squares_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack
    return pack(table(spark, sf_dir, "documents"))


#: (host, path, verdict) of the rules that pages are judged by.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


@query("op7_url_range_join", """
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (
  SELECT page_id, row_number() OVER () AS id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
rules(rh, rp, rv) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fit AS (
  SELECT id, max_by(rh || rp, length(rh || rp)) AS rule, max_by(rv, length(rh || rp)) AS verdict
  FROM h JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  GROUP BY id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM h LEFT JOIN fit USING (id)
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import judge_urls
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


@query("op10_heap_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count_tokens
    return count_tokens(table(spark, sf_dir, "documents"))


@query("op4_suffix_array_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repetition import quality
    return quality(table(spark, sf_dir, "documents"))


@query("op6_prefix_join_decontamination", r"""
WITH dw AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, p, p + least(10, len(w)) - 1), ' ') AS k
  FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS p FROM iw WHERE len(w) > 0)),
hits AS (
  SELECT DISTINCT rid, p, n, item_id
  FROM (SELECT rid, n, p, array_to_string(list_slice(w, p, p + n - 1), ' ') AS k
        FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM dw, (SELECT DISTINCT n FROM win))) d
  JOIN win USING (n, k)),
words AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM hits) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS l
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_bloom_lm_scores")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_scoring import score
    return score(table(spark, sf_dir, "documents"))


@query("op8_lempel_ziv_dedup", r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
win AS (
  SELECT rid, p, array_to_string(list_slice(w, p, p + 34), ' ') AS k
  FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
dup AS (SELECT rid, p FROM win WHERE k IN (SELECT k FROM win GROUP BY k HAVING count(*) > 1)),
rem AS (SELECT DISTINCT rid, unnest(range(p, p + 35)) AS q FROM dup),
words AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS q FROM d),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY q) AS t, count(*) AS n
  FROM words ANTI JOIN rem USING (rid, q) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import remove_repeats
    return (remove_repeats(table(spark, sf_dir, "documents"))
            .selectExpr("doc_id", "n_words", "n_removed", "sha2(kept, 256) kept_sha256"))


@query("op9_grouped_prefix_jaccard", r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT rid, array_to_string(list_slice(w, p, p + 3), ' ') AS k
  FROM (SELECT rid, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
o AS (SELECT a.rid AS x, b.rid AS y, count(*) AS o FROM s a JOIN s b USING (k) GROUP BY 1, 2),
l AS (
  SELECT x, y FROM o JOIN n a ON a.rid = x JOIN n b ON b.rid = y WHERE 100 * o >= 85 * (a.n + b.n - o)),
r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT r.x AS rid, min(doc_id) AS component_id FROM r JOIN d ON d.rid = r.y GROUP BY r.x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, CASE WHEN n > 0 THEN component_id ELSE doc_id END AS component_id
FROM d LEFT JOIN n USING (rid) LEFT JOIN c USING (rid)
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op3_recurrent_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score_toxicity
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_simhash_line_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines
    return (dedup_lines(table(spark, sf_dir, "documents"))
            .selectExpr("doc_id", "n_lines", "n_removed", "sha2(text, 256) kept_sha256"))

@query("op13_dual_tree_search", r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT row_number() OVER () AS iid, item_id, list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark),
g AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
q AS (SELECT iid, unnest(w) AS term FROM i),
t AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY rid, term),
v AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS weight
  FROM t, g GROUP BY term),
m AS (SELECT rid, 50 + (50 * len(w) * n_docs) // n_terms AS m FROM d, g WHERE len(w) > 0),
s AS (
  SELECT iid, rid, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN t USING (term) JOIN v USING (term) JOIN m USING (rid) GROUP BY iid, rid)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT iid, doc_id, score, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST, rid) AS rank
      FROM s JOIN d USING (rid) WHERE score > 0) JOIN i USING (iid)
WHERE rank <= 50
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ranked_search import search
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_importance_resampling")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .resampling import resample
    return (resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
            .select("doc_id", "n_features", "weight", "score", "rank"))


@query("op12_disclosure_sanitisation")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sanitise import digest, find_spans
    return digest(find_spans(table(spark, sf_dir, "documents")))
