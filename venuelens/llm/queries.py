"""Registered queries of the operators, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelens.llm import collocations, decontaminate, divergence, licences, lines, mixing, neardup, perplexity, pii, simhash, spots, toxicity, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)  # where the package is not installed, as in tests
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@_query
def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"), size=2, percent=80)


@_query
def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), size=10).drop("spans")


ORACLES["op10_benchmark_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS gram
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
hits AS (
  SELECT g.doc_id, g.i, g.n, x.item_id
  FROM (
    SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS gram
    FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)) g
  JOIN windows x ON x.n = g.n AND x.gram = g.gram),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(words.n_hit, 0) AS n_hit, coalesce(items.n_items, 0) AS n_items,
  sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(words.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""


@_query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = lambda id: F.crc32(id.cast("string")) % 3 == 1
    model = toxicity.fit(docs, labels.where(~held_out(F.col("doc_id"))))
    scored = toxicity.score(docs, model, threshold=0.7)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "sentences")


#: Shares of tokens after mixing.
TARGETS = {"en": 0.46, "de": 0.17, "fr": 0.16, "es": 0.11, "low": 0.10}


@_query
def op2_mixing_to_target_weights(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return mixing.mix(docs, mixing.label_domains(docs, labels), TARGETS)


@_query
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return licences.scan_documents(docs, licences.fit(docs))


@_query
def op4_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge_urls(table(spark, folder, "pages"))


#: Sources whose texts train the language model.
TRUSTED = ("src1", "src2", "src3", "src4", "src5")


@_query
def op6_quality_perplexity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = perplexity.fit(docs.where(F.col("source").isin(*TRUSTED)))
    return perplexity.judge(perplexity.perplexity(docs, model), docs, labels.where("quality = 1"))


@_query
def op7_spotsigs_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return spots.fingerprint_edits(table(spark, folder, "documents"))


@_query
def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.drop_repeated_units(table(spark, folder, "documents"), least=1)


@_query
def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return pii.find_pii(docs, pii.fit(docs))


def _word(column: str, term: str) -> str:
    return f"regexp_matches({column}, '(^|[^a-z0-9]){term}($|[^a-z0-9])')"


ORACLES["op4_url_filters"] = f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id, low, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parts),
rules(rule, name, start, verdict) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
fit AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM split, rules WHERE ends_with('.' || host, '.' || name) AND starts_with(path, start) GROUP BY page_id),
counted AS (
  SELECT page_id, host, path, {" + ".join(f"CAST({_word('low', t)} AS INT)" for t in urls.STRICT)} AS strict,
    {" + ".join(f"CAST({_word('low', t)} AS INT)" for t in urls.SOFT)} AS soft
  FROM split)
SELECT c.page_id, c.host, c.path, fit.rule, coalesce(fit.verdict, CASE WHEN strict > 0 OR soft >= 2 THEN 'block' ELSE 'allow' END) AS verdict, strict, soft
FROM counted c LEFT JOIN fit ON fit.page_id = c.page_id
"""


@_query
def op12_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), size=3, seed=42, most=2)


@_query
def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"), least=3, most=200)


_P = "1 + (1000000000 * (CAST({n} AS HUGEINT) + 1)) // ({total} + v)"

ORACLES["op11_source_divergence"] = rf"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
kept AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d) GROUP BY lang, term HAVING count(*) >= 3),
sources AS (SELECT DISTINCT lang, source FROM d),
found AS (
  SELECT o.lang, o.source, o.term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM d) o JOIN kept k ON k.lang = o.lang AND k.term = o.term
  GROUP BY o.lang, o.source, o.term),
dense AS (
  SELECT s.lang, s.source, k.term, coalesce(f.n, 0) AS n, sum(coalesce(f.n, 0)) OVER (PARTITION BY s.lang, s.source) AS total,
    count(*) OVER (PARTITION BY s.lang, s.source) AS v
  FROM sources s JOIN kept k ON k.lang = s.lang LEFT JOIN found f ON f.lang = s.lang AND f.source = s.source AND f.term = k.term),
own AS (SELECT lang, source, term, n, v, {_P.format(n="n", total="total")} AS p FROM dense),
whole AS (
  SELECT lang, term, {_P.format(n="n", total="total")} AS q
  FROM (SELECT lang, term, any_value(v) AS v, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total FROM dense GROUP BY lang, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
  FROM own a JOIN own b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY a.lang, a.source, b.source),
listed AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM sources a JOIN sources b ON b.lang = a.lang AND b.source <> a.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT o.lang, o.source, 'term', o.term, CAST((o.p - q) * (o.p - q) // q AS BIGINT)
  FROM own o JOIN whole w ON w.lang = o.lang AND w.term = o.term WHERE o.n > 0 AND o.p > q)
SELECT lang, source, part, item, value, CAST(rank AS INT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM listed)
WHERE part = 'pair' OR rank <= 200
"""


@_query
def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(table(spark, folder, "documents"), most_words=5, least=100, top=2000)


ORACLES["op13_phrase_collocations"] = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
total AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
counts AS (
  SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM pieces, (SELECT unnest(generate_series(1, 5)) AS m) WHERE len(w) >= m)
  GROUP BY lang, m, phrase),
candidates AS (SELECT * FROM counts WHERE m >= 2 AND f >= 100),
cuts AS (
  SELECT lang, m, phrase, f, k, array_to_string(list_slice(string_split(phrase, ' '), 1, k), ' ') AS head, array_to_string(list_slice(string_split(phrase, ' '), k + 1, m), ' ') AS rest
  FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM candidates)),
scored AS (
  SELECT c.lang, c.m, c.phrase, c.f AS a, c.k, h.f AS l, r.f AS r, t.n, (1000 * CAST(c.f AS HUGEINT) * t.n) // (CAST(h.f AS HUGEINT) * r.f) AS score
  FROM cuts c JOIN counts h ON h.lang = c.lang AND h.phrase = c.head AND h.m = c.k JOIN counts r ON r.lang = c.lang AND r.phrase = c.rest AND r.m = c.m - c.k
  JOIN total t ON t.lang = c.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT DISTINCT c.lang, c.phrase FROM candidates c JOIN candidates d ON d.lang = c.lang AND d.f = c.f AND d.m > c.m
  WHERE contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' ')),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest WHERE (lang, phrase) NOT IN (SELECT lang, phrase FROM inside))
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""
