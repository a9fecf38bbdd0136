"""Registered queries over reviews: profiles, text features, ranks, metrics and models."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from venuelens.functions import numbers as nm, text as tx
from venuelens.operators import categories as ct, distribution as ds, evaluate as ev, features as ft, filters as fl, models as ml
from venuelens.operators import heavy as hv, profile as pf, ranking as rk
from venuelens.plans.bridge import measured_reviews, narrow_reviews, review_lengths, review_texts, reviews, table
from venuelens.plans.registry import query
from venuelens.plans.review_pipeline import NUMERIC, prepare_reviews, run_models
from venuelens.plans.venue_queries import binned_sql, r6, rounded_bins

FILLED = ["clothing_id", "division_name", "department_name", "class_name"]
# The prose of the supplied texts has no clothing words; these stand in as keyword lists.
COMMON, MORE, FRENCH = ["the", "and", "with"], ["of", "that", "was"], ["les", "une", "que"]


@query("SELECT * FROM reviews")
def reviews_scan(spark, folder):
    return reviews(spark, folder)


@query("SELECT row_id, " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'Unknown') AS {c}" for c in FILLED) + " FROM reviews")
def fill_unknown(spark, folder):
    return fl.clean_categories(reviews(spark, folder).select("row_id", *FILLED), FILLED)


@query("SELECT row_id, rating FROM reviews WHERE rating IS NOT NULL")
def valid_target(spark, folder):
    return fl.valid_target(reviews(spark, folder).select("row_id", "rating"), "rating")


@query("""WITH rare AS (SELECT clothing_id FROM reviews WHERE clothing_id IS NOT NULL GROUP BY 1
 HAVING count(positive_feedback_count) < 10)
 SELECT row_id, clothing_id FROM reviews WHERE clothing_id IS NULL OR clothing_id NOT IN (SELECT clothing_id FROM rare)""")
def rare_excluded(spark, folder):
    rows = reviews(spark, folder).select("row_id", "clothing_id", "positive_feedback_count")
    return fl.drop_rare(rows, "clothing_id", "positive_feedback_count").select("row_id", "clothing_id")


@query("""SELECT clothing_id, count(positive_feedback_count) AS value_count FROM reviews WHERE clothing_id IS NOT NULL
 GROUP BY 1 HAVING count(positive_feedback_count) < 10""")
def rare_categories(spark, folder):
    return fl.rare_values(reviews(spark, folder), "clothing_id", "positive_feedback_count")


LEAK = ["age", "clothing_id", "rating", "recommended_ind", "doubled"]


@query("""WITH wide AS (SELECT *, positive_feedback_count * 2 AS doubled FROM reviews) """ + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr(positive_feedback_count, {c}), 6) AS corr,"
    f" coalesce(abs(corr(positive_feedback_count, {c})) >= 0.999, FALSE) AS leaks FROM wide" for c in LEAK))
def leakage_check(spark, folder):
    wide = reviews(spark, folder).withColumn("doubled", F.col("positive_feedback_count") * 2)
    return fl.leakage_check(wide, "positive_feedback_count", LEAK).select("feature", r6("corr"), "leaks")


CARDS = ["division_name", "department_name", "class_name", "clothing_id", "title"]


@query("WITH counted AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) + CAST(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT)"
    f" AS distinct_values FROM reviews" for c in CARDS) + ") SELECT *, distinct_values <= 100 AS low_cardinality FROM counted")
def cardinality_guard(spark, folder):
    return fl.cardinality(reviews(spark, folder), CARDS)


COLUMNS = ["row_id", "clothing_id", "age", "title", "review_text", "rating", "recommended_ind",
           "positive_feedback_count", "division_name", "department_name", "class_name"]
TEXTUAL = ["title", "review_text", "division_name", "department_name", "class_name"]


def _missing_sql(threshold: float) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count,"
        f" round((count(*) - count({c})) / CAST(count(*) AS DOUBLE), 6) AS missing_share,"
        f" (count(*) - count({c})) / CAST(count(*) AS DOUBLE) > {threshold} AS mostly_missing FROM reviews"
        for c in COLUMNS
    )


@query(_missing_sql(0.3))
def missing_profile(spark, folder):
    rows = pf.missing_profile(measured_reviews(spark, folder).select(*COLUMNS), 0.3)
    return rows.select("column_name", "missing_count", r6("missing_share"), "mostly_missing")


_OVERVIEW = " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{'string' if c in TEXTUAL else 'bigint'}' AS data_type,"
    f" count(*) AS row_count FROM reviews" for i, c in enumerate(COLUMNS, 1))


@query(_OVERVIEW)
def overview(spark, folder):
    return pf.overview(reviews(spark, folder))


SPREAD = ["count", "missing_count", "min", "max", "mean", "median", "std"]


def _spread_sql(c: str) -> str:
    return f"""'{c}' AS column_name, count({c}) AS count, count(*) - count({c}) AS missing_count,
 CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(avg({c}), 6) AS mean,
 round(quantile_cont({c}, 0.5), 6) AS median, round(stddev_samp({c}), 6) AS std"""


def _target_sql(c: str, base: str) -> str:
    return f"""SELECT {_spread_sql(c)}, count(*) FILTER (WHERE {c} = 0) AS zero_count,
 round(count(*) FILTER (WHERE {c} = 0) / CAST({base} AS DOUBLE), 6) AS zero_share, round(skewness({c}), 6) AS skewness
 FROM reviews"""


def _rounded_target(df: DataFrame) -> DataFrame:
    return df.select("column_name", "count", "missing_count", "min", "max", r6("mean"), r6("median"), r6("std"),
                     "zero_count", r6("zero_share"), r6("skewness"))


@query(_target_sql("positive_feedback_count", "count(*)"))
def target_profile(spark, folder):
    return _rounded_target(pf.target_profile(reviews(spark, folder), "positive_feedback_count"))


@query(_target_sql("recommended_ind", "count(recommended_ind)"))
def target_profile_valid(spark, folder):
    return _rounded_target(pf.target_profile(reviews(spark, folder), "recommended_ind", "valid"))


def _text_sql(cols: list[str], source: str, empty: bool) -> str:
    parts = []
    for c in cols:
        t = f"coalesce({c}, '')" if empty else c
        parts.append(
            f"SELECT '{c}' AS column_name, {c} IS NULL AS gone, length({t}) AS chars,"
            f" len(regexp_extract_all({t}, '\\S+')) AS words, coalesce(NOT regexp_matches({t}, '\\S'), FALSE) AS blank FROM {source}"
        )
    lengths = ", ".join(
        f"round(avg({m}), 6) AS {m}_mean, round(quantile_cont({m}, 0.5), 6) AS {m}_median,"
        f" CAST(min({m}) AS BIGINT) AS {m}_min, CAST(max({m}) AS BIGINT) AS {m}_max" for m in ("chars", "words"))
    return (
        f"SELECT column_name, count(*) FILTER (WHERE gone) AS missing_count, count(*) FILTER (WHERE blank) AS blank_count,"
        f" {lengths} FROM ({' UNION ALL '.join(parts)}) GROUP BY column_name"
    )


def _rounded_text(df: DataFrame) -> DataFrame:
    lengths = [r6(f"{m}_{s}") if s in ("mean", "median") else f"{m}_{s}"
               for m in ("chars", "words") for s in ("mean", "median", "min", "max")]
    return df.select("column_name", "missing_count", "blank_count", *lengths)


@query(_text_sql(["title", "review_text"], "review_texts", False))
def text_profile(spark, folder):
    return _rounded_text(pf.text_profile(review_texts(spark, folder), ["title", "review_text"], "drop"))


@query(_text_sql(["title", "review_text"], "review_texts", True))
def text_profile_empty(spark, folder):
    return _rounded_text(pf.text_profile(review_texts(spark, folder), ["title", "review_text"], "empty"))


def _category_sql(cols: list[str], k: int, where: str = "TRUE") -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM reviews" for c in cols)
    return f"""counts AS (SELECT column_name, value, count(*) AS value_count FROM ({long}) GROUP BY 1, 2),
totals AS (SELECT column_name, count(value) AS distinct_count,
 CAST(coalesce(sum(value_count) FILTER (WHERE value IS NULL), 0) AS BIGINT) AS missing_count FROM counts GROUP BY 1),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY column_name ORDER BY value_count DESC, value NULLS LAST) AS INTEGER)
 AS value_rank FROM counts WHERE {where}),
top_values AS (SELECT column_name, distinct_count, missing_count, value_rank, value, value_count
 FROM ranked JOIN totals USING (column_name) WHERE value_rank <= {k})"""


@query(f"WITH {_category_sql(FILLED, 10)} SELECT * FROM top_values")
def category_profile(spark, folder):
    return pf.category_profile(reviews(spark, folder), FILLED)


@query(f"WITH {_category_sql(FILLED, 10, 'value IS NOT NULL')} SELECT * FROM top_values")
def category_profile_present(spark, folder):
    return pf.category_profile(reviews(spark, folder), FILLED, keep_null=False)


REPORT_NUMERIC = ["age", "rating", "recommended_ind"]
RELATED = [("age", "age"), ("title_chars", "length(coalesce(title, ''))"), ("review_text_chars", "length(coalesce(review_text, ''))")]


def _report_sql() -> str:
    """The long report, put together from the SQL of its parts."""
    target = "positive_feedback_count"

    def long(section: str, source: str, metrics: list[str], label: str = "NULL") -> str:
        return " UNION ALL ".join(
            f"SELECT '{section}' AS section, column_name, '{m}' AS metric, round(CAST({m} AS DOUBLE), 6) AS value,"
            f" CAST({label} AS VARCHAR) AS label FROM {source}" for m in metrics)

    def relation(name: str, x: str) -> str:
        binned = binned_sql(f"(SELECT {x} AS x, {target} AS y FROM reviews)", "x", "y", 20)
        return f"""SELECT 'target_relation', '{name}', m, round(v, 6), CAST(bin AS VARCHAR) FROM (SELECT bin, unnest(['mean_target', 'row_count']) AS m,
 unnest([mean, row_count]) AS v FROM (WITH {binned}))"""

    pairs = [*REPORT_NUMERIC, target]
    corr = " UNION ALL ".join(
        f"SELECT '{a}' AS column_name, '{b}' AS col_b, corr({a}, {b}) AS corr FROM reviews"
        for i, a in enumerate(pairs) for b in pairs[i + 1:])
    numeric = " UNION ALL ".join(f"SELECT {_spread_sql(c)} FROM reviews" for c in REPORT_NUMERIC)
    lengths = [f"{m}_{s}" for m in ("chars", "words") for s in ("mean", "median", "min", "max")]
    texts = r"""texts AS (SELECT title, review_text, regexp_replace(regexp_replace(coalesce(title, ''), '^\s+|\s+$', '', 'g') || ' ' ||
 regexp_replace(coalesce(review_text, ''), '^\s+|\s+$', '', 'g'), '^\s+|\s+$', '', 'g') AS combined_text FROM reviews)"""
    return f"""WITH overview_rows AS ({_OVERVIEW}), lost AS ({_missing_sql(0.3)}),
dups AS (SELECT '*' AS column_name, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM reviews)) AS duplicate_rows FROM reviews),
goal AS ({_target_sql(target, 'count(*)')}), spread AS ({numeric}), {texts},
lengths AS ({_text_sql(['title', 'review_text', 'combined_text'], 'texts', True)}), pairs AS ({corr}),
{_category_sql(FILLED, 10)}
{long('overview', 'overview_rows', ['row_count'], 'data_type')} UNION ALL {long('overview', 'dups', ['duplicate_rows'])}
UNION ALL {long('missing', 'lost', ['missing_count', 'missing_share'])}
UNION ALL {long('target', 'goal', [*SPREAD, 'zero_count', 'zero_share', 'skewness'])}
UNION ALL {long('numeric', 'spread', SPREAD)} UNION ALL {long('text', 'lengths', ['missing_count', 'blank_count', *lengths])}
UNION ALL {long('correlation', 'pairs', ['corr'], 'col_b')}
UNION ALL SELECT 'warning', column_name, 'mostly_missing_share', missing_share, NULL FROM lost WHERE mostly_missing
UNION ALL SELECT 'warning', column_name, 'target_missing', missing_count, NULL FROM goal WHERE missing_count > 0
UNION ALL {long('category', '(SELECT * FROM top_values WHERE value_rank = 1)', ['distinct_count', 'missing_count'])}
UNION ALL {long('category', 'top_values', ['value_count'], "coalesce(value, '<missing>')")}
UNION ALL SELECT 'target_relation', 'rating', m, round(v, 6), CAST(rating AS VARCHAR) FROM (SELECT rating, unnest(['mean_target', 'row_count']) AS m,
 unnest([avg({target}), count(*)]) AS v FROM reviews WHERE rating IS NOT NULL GROUP BY rating)
UNION ALL {" UNION ALL ".join(relation(c, x) for c, x in RELATED)}"""


@query(_report_sql())
def profile_report(spark, folder):
    report = pf.profile_report(
        measured_reviews(spark, folder), "positive_feedback_count", REPORT_NUMERIC, categorical=FILLED, measured=True, rating="rating", age="age"
    )
    return report.select("section", "column_name", "metric", r6("value"), "label")


@query("""SELECT rating, round(avg(positive_feedback_count), 6) AS mean_target FROM reviews WHERE rating IS NOT NULL
 GROUP BY rating""")
def target_by_rating(spark, folder):
    means = ct.mean_by(reviews(spark, folder), ["rating"], "positive_feedback_count", "mean_target")
    return means.select("rating", r6("mean_target"))


@query("WITH " + binned_sql("reviews", "age", "positive_feedback_count", 20))
def target_by_age(spark, folder):
    return rounded_bins(ds.binned_mean(reviews(spark, folder), "age", "positive_feedback_count", 20))


@query("WITH measured AS (SELECT length(coalesce(review_text, '')) AS chars, positive_feedback_count AS target FROM reviews), "
       + binned_sql("measured", "chars", "target", 20))
def target_by_review_length(spark, folder):
    targets = narrow_reviews(spark, folder).select("row_id", F.col("positive_feedback_count").alias("target"))
    measured = review_lengths(spark, folder).join(targets, "row_id").select("chars", "target")
    return rounded_bins(ds.binned_mean(ml.materialize(measured), "chars", "target", 20))


PAIRED = ["age", "rating", "recommended_ind", "positive_feedback_count"]


@query(" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM reviews"
    for i, a in enumerate(PAIRED) for b in PAIRED[i + 1:]))
def review_correlations(spark, folder):
    return pf.corr_matrix(reviews(spark, folder), PAIRED).select("col_a", "col_b", r6("corr"))


def _words_sql(text: str, words: list[str]) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return (
        f"len(list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{M}}\\p{{N}}_]+'), lambda x: x IN ({listed})))"
    )


@query(f"""SELECT doc_id, CAST({_words_sql('text', COMMON)} AS BIGINT) AS hits,
 CAST({_words_sql('text', FRENCH)} > 0 AS INTEGER) AS french_flag FROM documents""")
def keyword_counts(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id",
        tx.keyword_count(F.col("text"), COMMON).alias("hits"),
        tx.keyword_flag(F.col("text"), FRENCH).alias("french_flag"),
    )


@query(rf"""WITH filled AS (SELECT row_id, coalesce(title, '') AS t, coalesce(review_text, '') AS b FROM review_texts),
joined AS (SELECT *, regexp_replace(regexp_replace(t, '^\s+|\s+$', '', 'g') || ' ' || regexp_replace(b, '^\s+|\s+$', '', 'g'),
 '^\s+|\s+$', '', 'g') AS combined_text FROM filled)
SELECT row_id, combined_text, length(b) AS review_text_len_chars, len(regexp_extract_all(b, '\S+')) AS review_text_word_count,
 length(t) AS title_len_chars, len(regexp_extract_all(t, '\S+')) AS title_word_count,
 CAST(regexp_matches(t, '\S') AS INTEGER) AS has_title, CAST(regexp_matches(b, '\S') AS INTEGER) AS has_review_text,
 CAST({_words_sql('combined_text', COMMON)} AS BIGINT) AS fit_keyword_count,
 CAST({_words_sql('combined_text', MORE)} AS BIGINT) AS quality_keyword_count,
 CAST({_words_sql('combined_text', FRENCH)} > 0 AS INTEGER) AS size_keyword_flag FROM joined""")
def text_features(spark, folder):
    rows = ft.add_text_features(review_texts(spark, folder), COMMON, MORE, FRENCH)
    return rows.drop("title", "review_text")


@query("""SELECT row_id, CAST(coalesce(rating <= 2, FALSE) AS INTEGER) AS rating_is_low,
 CAST(coalesce(rating >= 4, FALSE) AS INTEGER) AS rating_is_high FROM reviews""")
def rating_flags(spark, folder):
    return ft.add_rating_flags(reviews(spark, folder)).select("row_id", "rating_is_low", "rating_is_high")


@query("""SELECT row_id, round(ln(1 + CAST(positive_feedback_count AS DOUBLE)), 6) AS target_log,
 round(CAST(positive_feedback_count AS DOUBLE), 6) AS target_back, greatest(round(exp(-0.1 * age) - 1, 6), 0) AS clipped
 FROM reviews""")
def target_transform(spark, folder):
    rows = reviews(spark, folder).select(
        "row_id",
        nm.log_target(F.col("positive_feedback_count")).alias("target_log"),
        nm.unlog_target(-0.1 * F.col("age")).alias("clipped"),
    )
    return rows.withColumn("target_back", nm.unlog_target(F.col("target_log"))).select(
        "row_id", r6("target_log"), r6("target_back"), r6("clipped")
    )


TEST = "CAST('0x' || substr(md5(row_id || ':42'), 1, 8) AS BIGINT) / 4294967296.0 < 0.2"


@query(f"SELECT {TEST} AS is_test, count(*) AS row_count FROM reviews GROUP BY 1")
def split_sizes(spark, folder):
    train, test = ft.split(reviews(spark, folder).select("row_id"), "row_id")
    marked = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    return marked.groupBy("is_test").agg(F.count("*").alias("row_count"))


FIT = ["age", "rating", "recommended_ind"]


@query("WITH fitted AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in FIT)
       + f" FROM reviews WHERE NOT ({TEST})) SELECT row_id, "
       + ", ".join(f"round(coalesce(CAST({c} AS DOUBLE), m_{c}), 6) AS {c}" for c in FIT) + " FROM reviews, fitted")
def impute_median(spark, folder):
    rows = reviews(spark, folder).select("row_id", *FIT)
    train, _ = ft.split(rows, "row_id")
    return ft.impute(rows, ft.fit_medians(train, FIT)).select("row_id", *[r6(c) for c in FIT])


@query("WITH m AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in FIT)
       + f" FROM reviews WHERE NOT ({TEST})), filled AS (SELECT row_id, {TEST} AS test, "
       + ", ".join(f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in FIT)
       + " FROM reviews, m), s AS (SELECT "
       + ", ".join(f"avg({c}) AS a_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS d_{c}" for c in FIT)
       + " FROM filled WHERE NOT test) SELECT row_id, "
       + ", ".join(f"round(({c} - a_{c}) / d_{c}, 6) + 0.0 AS {c}" for c in FIT) + " FROM filled, s")
def standard_scale(spark, folder):
    rows = reviews(spark, folder).select("row_id", *FIT)
    medians = ft.fit_medians(ft.split(rows, "row_id")[0], FIT)
    filled = ft.impute(rows, medians)
    scaled = ft.scale(filled, ft.fit_scaling(ft.split(filled, "row_id")[0], FIT))
    return scaled.select("row_id", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in FIT])


@query(r"""WITH tokens AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}_]+'),
 lambda x: length(x) >= 2)) AS term FROM documents), n AS (SELECT count(*) AS texts FROM documents),
terms AS (SELECT term, count(*) AS term_count, count(DISTINCT doc_id) AS doc_count FROM tokens GROUP BY term)
SELECT term, term_count, doc_count, round(ln((1.0 + texts) / (1.0 + doc_count)) + 1, 6) AS idf FROM terms, n
WHERE doc_count >= 2 ORDER BY term_count DESC, term LIMIT 500""")
def tfidf_vocab(spark, folder):
    terms = ft.tfidf_vocabulary(table(spark, folder, "documents"), "text", 500, 2)
    return terms.select("term", "term_count", "doc_count", r6("idf"))


@query("""SELECT value, count(*) AS row_count FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS value FROM documents) GROUP BY value
ORDER BY row_count DESC, value LIMIT 100""")
def frequent_words(spark, folder):
    """The hundred most frequent words of all texts, out of very many: candidates from a summary, counted exactly."""
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)))
    return hv.top_counts(table(spark, folder, "documents").select(words.alias("word")), "word", 100)


@query("""SELECT event_id, value, rank() OVER (ORDER BY value DESC) AS predicted_rank FROM events""")
def predicted_rank(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "value")
    ranked = rk.add_predicted_ranks(rows, "value", "event_id")
    return ranked.select("event_id", "value", F.col("predicted_rank").cast("bigint").alias("predicted_rank"))


@query("""SELECT event_id, round((rank() OVER (ORDER BY floor(value / 30)) + (count(*) OVER (PARTITION BY floor(value / 30)) - 1)
 / 2.0) / CAST(count(*) OVER () AS DOUBLE), 9) AS predicted_percentile FROM events""")
def predicted_percentile(spark, folder):
    rows = table(spark, folder, "events").select("event_id", F.floor(F.col("value") / 30).alias("helpful"))
    ranked = rk.add_predicted_ranks(rows, "helpful", "event_id")
    return ranked.select("event_id", F.round("predicted_percentile", 9).alias("predicted_percentile"))


@query("""WITH named AS (SELECT substr(md5(CAST(event_id AS VARCHAR)), 1, 22) AS id, floor(value / 30) AS score FROM events)
SELECT id, CAST(score AS DOUBLE) AS score FROM (SELECT *, row_number() OVER (ORDER BY score DESC, id DESC) AS nth, count(*) OVER () AS n FROM named)
WHERE nth <= greatest(1, n // 10)""")
def top_decile_by_text(spark, folder):
    """The tenth of the events with the highest score; ties go by an id that is a text."""
    named = table(spark, folder, "events").select(
        F.substring(F.md5(F.col("event_id").cast("string")), 1, 22).alias("id"), F.floor(F.col("value") / 30).cast("double").alias("score")
    )
    return rk.top_decile(named, "score", "id")


# A stand-in prediction for the metrics: a fixed function of the event's user.
GUESS = "18 + (user_id * 7) % 82"
PAIRS = f"pairs AS (SELECT event_id, floor(value / 30) AS y, CAST({GUESS} AS DOUBLE) / 17 AS p FROM events)"


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id",
        F.floor(F.col("value") / 30).cast("double").alias("y"),
        (F.expr(GUESS).cast("double") / 17).alias("p"),
    )


@query(f"""WITH {PAIRS}, ranked AS (SELECT row_number() OVER (ORDER BY y, event_id) AS a,
 row_number() OVER (ORDER BY p, event_id) AS b FROM pairs)
SELECT round(1 - 6 * sum(CAST(a - b AS DOUBLE) * (a - b)) / (CAST(count(*) AS DOUBLE) * (CAST(count(*) AS DOUBLE) * count(*) - 1)), 6)
 AS rank_correlation FROM ranked""")
def rank_correlation(spark, folder):
    return ev.rank_correlation(_pairs(spark, folder), "y", "p", "event_id").select(r6("rank_correlation"))


@query(f"""WITH {PAIRS}, ranked AS (SELECT y, row_number() OVER (ORDER BY p DESC, event_id DESC) AS nth,
 greatest(1, count(*) OVER () // 10) AS k FROM pairs)
SELECT round(avg(CASE WHEN y > 0 THEN 1.0 ELSE 0.0 END), 6) AS top_decile_rate FROM ranked WHERE nth <= k""")
def top_decile_rate(spark, folder):
    return ev.top_decile_rate(_pairs(spark, folder), "y", "p", "event_id").select(r6("top_decile_rate"))


@query(f"""WITH {PAIRS} SELECT count(*) AS rows, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(avg(abs(y - p)), 6) AS mae,
 round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2 FROM pairs""")
def regression_metrics(spark, folder):
    metrics = ev.regression_metrics(_pairs(spark, folder), "y", "p")
    return metrics.select("rows", r6("rmse"), r6("mae"), r6("r2"))


MODELS = {"constant_3": "CAST(3 AS DOUBLE)", "user_guess": "p", "half_guess": "p / 2"}


@query(f"""WITH {PAIRS}, long AS ({" UNION ALL ".join(f"SELECT '{m}' AS model_name, event_id, y, {e} AS p FROM pairs" for m, e in MODELS.items())}),
basic AS (SELECT model_name, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae, min(p) < max(p) AS varied FROM long GROUP BY 1),
ranked AS (SELECT model_name, y, row_number() OVER (PARTITION BY model_name ORDER BY y, event_id) AS a,
 row_number() OVER (PARTITION BY model_name ORDER BY p, event_id) AS b, count(*) OVER (PARTITION BY model_name) AS n FROM long),
extra AS (SELECT model_name, 1 - 6 * sum(CAST(a - b AS DOUBLE) * (a - b)) / (CAST(max(n) AS DOUBLE) * (CAST(max(n) AS DOUBLE) * max(n) - 1)) AS rc,
 avg(CASE WHEN y > 0 THEN 1.0 ELSE 0.0 END) FILTER (WHERE b > n - greatest(1, n // 10)) AS td FROM ranked GROUP BY 1)
SELECT model_name, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(CASE WHEN varied THEN rc END, 6) AS rank_correlation,
 round(td, 6) AS top_decile_rate FROM basic JOIN extra USING (model_name)
ORDER BY rmse, mae, rank_correlation DESC NULLS LAST, td DESC NULLS LAST, model_name LIMIT 1""")
def best_model(spark, folder):
    pairs = _pairs(spark, folder)
    models = F.array(*[
        F.struct(F.lit(m).alias("model_name"), F.expr(e).alias("p")) for m, e in MODELS.items()
    ])
    long = pairs.select("event_id", "y", F.inline(models))
    metrics = ev.evaluate_predictions(long, "event_id", "y", "p", "y", "p", ["model_name"])
    return ev.best_model(metrics).select("model_name", r6("rmse"), r6("mae"), r6("rank_correlation"), r6("top_decile_rate"))


@query(f"""WITH fitted AS (SELECT avg(ln(1 + CAST(positive_feedback_count AS DOUBLE))) AS m FROM reviews WHERE NOT ({TEST}))
SELECT row_id, round(m, 6) AS predicted_target_log, round(exp(m) - 1, 6) AS predicted_target FROM reviews, fitted WHERE {TEST}""")
def mean_baseline(spark, folder):
    rows = ml.with_label(reviews(spark, folder).select("row_id", "positive_feedback_count"), "positive_feedback_count")
    train, test = ft.split(rows, "row_id")
    model = ml.fit_mean(train, ml.FeatureSpec(("row_id",)))
    return ml.score(model, test, ["row_id"]).select("row_id", r6("predicted_target_log"), r6("predicted_target"))


# Ridge on two standardised features in closed form: (X'X + I) w = X'y with X'X = n [[1, c], [c, 1]].
RIDGE = """base AS (SELECT row_id, positive_feedback_count AS t, clothing_id, rating, CAST(age AS DOUBLE) AS u,
 CAST(coalesce(length(review_text), 0) AS DOUBLE) AS v, ln(1 + CAST(positive_feedback_count AS DOUBLE)) AS y FROM reviews),
z AS (SELECT avg(u) AS mu, stddev_pop(u) AS su, avg(v) AS mv, stddev_pop(v) AS sv, avg(y) AS my, count(*) AS n FROM base),
s AS (SELECT *, (u - mu) / su AS a, (v - mv) / sv AS b FROM base, z),
g AS (SELECT sum(a * a) + 1 AS aa, sum(a * b) AS ab, sum(b * b) + 1 AS bb, sum(a * (y - my)) AS ay, sum(b * (y - my)) AS by_ FROM s),
w AS (SELECT (bb * ay - ab * by_) / (aa * bb - ab * ab) AS wa, (aa * by_ - ab * ay) / (aa * bb - ab * ab) AS wb FROM g)"""
RIDGE_SPEC = ml.FeatureSpec(("age", "review_text_len_chars"))


def _ridge_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Features for the two-feature ridge; texts are measured before anything is joined or sorted."""
    lengths = review_lengths(spark, folder).withColumnRenamed("chars", "review_text_len_chars")
    rows = narrow_reviews(spark, folder).join(lengths, "row_id")
    kept = rows.select("row_id", "age", "review_text_len_chars", "positive_feedback_count")
    return ml.materialize(ml.with_label(kept, "positive_feedback_count"))


@query(f"""WITH {RIDGE} SELECT 'age' AS feature, round(wa, 6) AS weight FROM w
UNION ALL SELECT 'review_text_len_chars', round(wb, 6) FROM w UNION ALL SELECT 'intercept', round(my, 6) FROM z""")
def ridge_weights(spark, folder):
    rows = _ridge_rows(spark, folder)
    fitted = ml.fit_ridge(rows, RIDGE_SPEC).stages[-1]
    weights = [*zip(RIDGE_SPEC.numeric, fitted.coefficients.tolist()), ("intercept", fitted.intercept)]
    return spark.createDataFrame(weights, "feature string, weight double").select("feature", r6("weight"))


@query(f"""WITH {RIDGE}, scored AS (SELECT s.*, my + wa * a + wb * b AS p_log,
 greatest(exp(my + wa * a + wb * b) - 1, 0) AS p FROM s, w)
SELECT row_id AS row_index, CAST(t AS DOUBLE) AS actual_target, round(p, 6) AS predicted_target, round(p_log, 6) AS predicted_target_log,
 round(t - p, 6) AS residual, round(abs(t - p), 6) AS abs_error, rank() OVER (ORDER BY round(p, 9) DESC) AS predicted_rank,
 round((rank() OVER (ORDER BY round(p, 9)) + (count(*) OVER (PARTITION BY round(p, 9)) - 1) / 2.0) / CAST(n AS DOUBLE), 9) AS predicted_percentile,
 'ridge' AS model_name, 'all_valid_rows' AS prediction_scope, scored.clothing_id, title, review_text, scored.rating, recommended_ind,
 division_name, department_name, class_name FROM scored JOIN reviews USING (row_id)""")
def prediction_table(spark, folder):
    rows = _ridge_rows(spark, folder)
    model = ml.fit_ridge(rows, RIDGE_SPEC)
    table_ = ml.prediction_table(model, rows, "row_id", "positive_feedback_count", "ridge", source=reviews(spark, folder))
    rounded = {c: F.round(c, 6) for c in ("predicted_target", "predicted_target_log", "residual", "abs_error")}
    rounded["predicted_percentile"] = F.round("predicted_percentile", 9)
    return table_.withColumns(rounded)


TFIDF_TERMS = 500


@query(rf"""WITH tokens AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{M}}\p{{N}}_]+'),
 lambda x: length(x) >= 2)) AS term FROM documents), n AS (SELECT count(*) AS texts FROM documents),
vocabulary AS (SELECT term, ln((1.0 + texts) / (1.0 + doc_count)) + 1 AS idf FROM (SELECT term, count(*) AS term_count,
 count(DISTINCT doc_id) AS doc_count FROM tokens GROUP BY term), n WHERE doc_count >= 2 ORDER BY term_count DESC, term LIMIT {TFIDF_TERMS}),
weighted AS (SELECT doc_id, term, count(*) * any_value(idf) AS w FROM tokens JOIN vocabulary USING (term) GROUP BY doc_id, term)
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM weighted""")
def tfidf_weights(spark, folder):
    texts = table(spark, folder, "documents").select("doc_id", "text")
    stages, vector = ml._text_stages(texts, "text", TFIDF_TERMS)
    for stage in stages:
        texts = stage.transform(texts)
    terms = F.array(*[F.lit(t) for t in stages[2].vocabulary])
    weights = texts.select("doc_id", F.posexplode(vector_to_array(F.col(vector))).alias("place", "weight")).filter("weight > 0")
    return weights.select("doc_id", F.get(terms, F.col("place")).alias("term"), r6("weight"))


@query("SELECT row_id, column_name, value FROM (" + " UNION ALL ".join(
    f"SELECT row_id, '{c}' AS column_name, coalesce({c}, 'Unknown') AS value FROM reviews" for c in FILLED[1:]) + ")")
def one_hot_block(spark, folder):
    """Every row has exactly the values of its categories in the one-hot block of the models."""
    rows = fl.clean_categories(reviews(spark, folder).select("row_id", *FILLED[1:]), FILLED[1:])
    stages, blocks = ml._category_stages(rows, FILLED[1:])
    coded = ml._apply(stages, rows)
    long = []
    for c, block, labels in zip(FILLED[1:], blocks, stages[0].labelsArray):
        hot = F.array_position(vector_to_array(F.col(block)), F.lit(1.0)).cast("int")
        names = F.array(*[F.lit(x) for x in labels])
        long.append(F.struct(F.lit(c).alias("column_name"), F.get(names, hot - 1).alias("value")))
    return coded.select("row_id", F.inline(F.array(*long)))


def _prepared_sql() -> str:
    words = {"fit_keyword_count": tx.FIT_WORDS, "quality_keyword_count": tx.QUALITY_WORDS}
    counts = ", ".join(f"CAST({_words_sql('combined_text', list(w))} AS BIGINT) AS {c}" for c, w in words.items())
    filled = ", ".join(f"coalesce({c}, 'Unknown') AS {c}" for c in FILLED[1:])
    return rf"""WITH joined AS (SELECT *, coalesce(title, '') AS t, coalesce(review_text, '') AS b,
 regexp_replace(regexp_replace(coalesce(title, ''), '^\s+|\s+$', '', 'g') || ' ' || regexp_replace(coalesce(review_text, ''), '^\s+|\s+$', '', 'g'),
 '^\s+|\s+$', '', 'g') AS combined_text FROM reviews)
SELECT row_id, clothing_id, age, title, review_text, rating, recommended_ind, positive_feedback_count, {filled}, combined_text,
 length(b) AS review_text_len_chars, len(regexp_extract_all(b, '\S+')) AS review_text_word_count,
 length(t) AS title_len_chars, len(regexp_extract_all(t, '\S+')) AS title_word_count,
 CAST(regexp_matches(t, '\S') AS INTEGER) AS has_title, CAST(regexp_matches(b, '\S') AS INTEGER) AS has_review_text, {counts},
 CAST({_words_sql('combined_text', list(tx.SIZE_WORDS))} > 0 AS INTEGER) AS size_keyword_flag,
 CAST(coalesce(rating <= 2, FALSE) AS INTEGER) AS rating_is_low, CAST(coalesce(rating >= 4, FALSE) AS INTEGER) AS rating_is_high FROM joined"""


@query(_prepared_sql())
def prepared_reviews(spark, folder):
    return prepare_reviews(reviews(spark, folder))


@query()
def model_comparison(spark, folder):
    metrics, _, _ = run_models(prepare_reviews(reviews(spark, folder)), NUMERIC)
    return metrics.select(
        "model_name", "rows", *[r6(c) for c in (
            "rmse_log", "mae_log", "r2_log", "rmse", "mae", "r2", "rank_correlation", "top_decile_rate")], "error",
    )
