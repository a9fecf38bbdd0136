"""Registered queries over venues, pages and the other plain tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from venuelens.functions import arrays as ar, numbers as nm
from venuelens.operators import categories as ct, dedup as dd, distribution as ds, encoding as en, filters as fl
from venuelens.operators import profile as pf
from venuelens.operators import matching as mt
from venuelens.operators.materialize import shared_folder
from venuelens.plans.bridge import restaurants, table
from venuelens.plans.registry import query
from venuelens.sources.cards import LINKS, extract_cards, extract_listing_cards
from venuelens.sources.readers import RESTAURANT_SCHEMA, parse_csv, parse_responses, read_csv
from venuelens.streaming.ingest import ingest_pages

SCRAPED = ["rating", "reviews_count", "cuisine_type", "price", "is_sponsored"]
# Dictionary of the matching query: names as they should be written.
VENUE_WORDS = ["small", "large", "Old", "New", "Red", "Blue", "Hot", "Cold", "Gismo", "Wijet", "Rings", "bolt", "Anvill"]
MARKED_WORDS = ["small", "large", "old", "new", "red", "blue", "hot", "cold", "ring", "bolt", "gear", "rod",
                "anvil", "gizmo", "plate", "widget"]

EXPLODED = """exploded AS (
 SELECT restaurant_id, rating, unnest(string_split(cuisine_type, ', ')) AS cuisine_type FROM restaurants)"""


def r6(name: str):
    return F.round(F.col(name), 6).alias(name)


def exploded(spark: SparkSession, folder: str) -> DataFrame:
    venues = restaurants(spark, folder).select("restaurant_id", "rating", "cuisine_type")
    return ct.explode_values(venues.withColumn("cuisine_type", ar.split_list(F.col("cuisine_type"))), "cuisine_type")


@query("SELECT * FROM restaurants")
def restaurants_scan(spark, folder):
    return restaurants(spark, folder)


@query("""SELECT event_id, user_id, CAST(regexp_extract(props, '"k": (-?[0-9]+)', 1) AS BIGINT) AS k FROM events""")
def json_props(spark, folder):
    return parse_responses(table(spark, folder, "events").select("event_id", "user_id", "props"), "props", "k BIGINT")


# Lines of a venue file: quoted lists, missing-value tokens, whole numbers written as decimals, and numbers that cannot be read.
CSV_LINES = """SELECT p_partkey, concat(
 CASE WHEN p_partkey % 11 = 0 THEN 'N/A' ELSE concat(p_size % 5, ',', p_partkey % 10) END, '|',
 CASE WHEN p_partkey % 7 = 0 THEN 'x7' WHEN p_partkey % 5 = 0 THEN concat(p_partkey % 50, '.0') ELSE concat(p_partkey % 50, '') END, '|"',
 replace(p_name, ' ', ', '), CASE WHEN p_partkey % 3 = 0 THEN ' ""big""' ELSE '' END, '"|',
 CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN '$' ELSE '$$ - $$$' END, '|', CASE WHEN p_type = 'PROMO' THEN 'True' ELSE 'False' END) AS line
FROM {part}"""


@query("""SELECT p_partkey, CASE WHEN p_partkey % 11 <> 0 THEN concat(p_size % 5, ',', p_partkey % 10) END AS rating,
 CASE WHEN p_partkey % 7 <> 0 THEN p_partkey % 50 END AS reviews_count,
 replace(p_name, ' ', ', ') || CASE WHEN p_partkey % 3 = 0 THEN ' "big"' ELSE '' END AS cuisine_type,
 CASE p_partkey % 3 WHEN 1 THEN '$' WHEN 2 THEN '$$ - $$$' END AS price, p_type = 'PROMO' AS is_sponsored FROM part""")
def csv_lines(spark, folder):
    lines = spark.sql(CSV_LINES, part=table(spark, folder, "part"))
    return parse_csv(lines, "line", RESTAURANT_SCHEMA, "|")


# Missing-value tokens are NULL, as in every reader; the texts hold line breaks and quotes.
@query("""SELECT doc_id, nullif(lang, '') AS lang, source, length(text) AS chars, length(text) - length(replace(text, chr(10), '')) AS line_breaks, md5(text) AS text_md5
FROM documents WHERE text <> ''""")
def csv_records(spark, folder):
    """All documents written as CSV files and read back in blocks; a text over several lines is one record."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "text")
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    docs.write.csv(path, header=True, quote='"', escape='"')
    read = read_csv(spark, path, docs.schema)
    text = F.col("text")
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return read.where("text <> ''").select("doc_id", "lang", "source", F.length(text).cast("bigint").alias("chars"), breaks.cast("bigint").alias("line_breaks"), F.md5("text").alias("text_md5"))


@query("""
WITH found AS (SELECT page_id, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS cards FROM pages),
placed AS (SELECT page_id, cards, unnest(range(1, len(cards) + 1)) AS i FROM found)
SELECT page_id, CAST(i - 1 AS INTEGER) AS card_no, regexp_extract(cards[i], 'href="([^"]*)"', 1) AS target,
 regexp_extract(cards[i], '>([^<]*)<', 1) AS label FROM placed""")
def page_cards(spark, folder):
    return extract_cards(table(spark, folder, "pages"), LINKS)


@query("""
WITH found AS (SELECT page_id, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS cards FROM pages),
placed AS (SELECT page_id, cards, unnest(range(1, len(cards) + 1)) AS i FROM found)
SELECT page_id, CAST(i - 1 AS INTEGER) AS card_no, regexp_extract(cards[i], 'href="([^"]*)"', 1) AS target,
 regexp_extract(cards[i], '>([^<]*)<', 1) AS label FROM placed""")
def ingested_cards(spark, folder):
    """All pages landed twice in two runs of the stream, in part for the second time: every page's cards once."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    path = f"{shared_folder(spark)}/landed-{uuid.uuid4().hex}"
    for part in (pages.where("page_id % 3 <> 0"), pages):
        part.write.mode("append").parquet(f"{path}/in")
        ingest_pages(spark, f"{path}/in", f"{path}/cards", f"{path}/state", LINKS).awaitTermination()
    return spark.read.parquet(f"{path}/cards").select("page_id", "card_no", "target", "label")


# Every link of a page as a card: boxes with more or fewer elements than wanted, unclosed paragraphs, classes among others.
CARD = """<div class="x" data-automation="restaurantCard"{sponsored}><img src="a.png"><div data-automation="bubbleRatingValue"><b>no</b><span class="r"> {label} </span></div>
<div data-automation="bubbleReviewCount"><p>about<span>({target} <i>reviews</i>)</span><p>more</div><span>other</span>
<span class="a f"><span>{label}, <b>{target}</b><!-- hidden --></span><span>later</span></span>
<div class="biqBm"><p><span class="biGQs">below</span></p></div><div class='z biqBm'><em>from</em><span class="biGQs q">$$ - $$$</span></div></div><span class="f"><span>outside</span></span>"""
_SPONSORED = ' data-sponsored="1"'


@query("""WITH found AS (SELECT page_id, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS cards FROM pages),
placed AS (SELECT page_id, cards, unnest(range(1, len(cards) + 1)) AS i FROM found),
fields AS (SELECT page_id, i, regexp_extract(cards[i], 'href="([^"]*)"', 1) AS target, trim(regexp_extract(cards[i], '>([^<]*)<', 1)) AS label FROM placed)
SELECT page_id, CAST(i - 1 AS INTEGER) AS card_no, label AS rating, TRY_CAST(regexp_replace(target, '[^0-9]', '', 'g') AS BIGINT) AS reviews_count,
 label || ',' || target AS cuisine_type, '$$ - $$$' AS price, page_id % 2 = 0 AS is_sponsored FROM fields""")
def listing_cards(spark, folder):
    """Cards of listing pages, of which every link of the supplied pages makes one; the rest of a page stays as it is."""
    pages = table(spark, folder, "pages").select("page_id", "html")
    link = F.lit('<a href="([^"]*)">([^<]*)</a>')
    card = lambda mark: F.regexp_replace("html", link, F.lit(CARD.replace("$", "\\$").format(sponsored=mark, label="$2", target="$1")))
    return extract_listing_cards(pages.select("page_id", F.when(F.col("page_id") % 2 == 0, card(_SPONSORED)).otherwise(card("")).alias("html")))


@query("""SELECT p_partkey, TRY_CAST(regexp_replace(p_brand, '[^0-9]', '', 'g') AS BIGINT) AS brand_number,
 TRY_CAST(regexp_replace(p_name, '[^0-9]', '', 'g') AS BIGINT) AS name_number FROM part""")
def digits_to_int(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey",
        nm.digits_to_int(F.col("p_brand")).alias("brand_number"),
        nm.digits_to_int(F.col("p_name")).alias("name_number"),
    )


@query("SELECT count(*) FILTER (WHERE reviews_count = 0) AS matching_rows FROM restaurants")
def zero_review_count(spark, folder):
    return fl.count_where(restaurants(spark, folder), F.col("reviews_count") == 0)


@query("SELECT * FROM restaurants WHERE reviews_count <> 0 AND rating IS NULL")
def reviewed_unrated(spark, folder):
    return fl.reviewed_unrated(restaurants(spark, folder), "reviews_count", "rating")


@query("SELECT * FROM restaurants WHERE rating IS NOT NULL AND price IS NOT NULL AND cuisine_type IS NOT NULL")
def drop_missing(spark, folder):
    return fl.drop_missing(restaurants(spark, folder), ["rating", "price", "cuisine_type"])


@query("SELECT * FROM restaurants WHERE NOT regexp_matches(coalesce(price, ''), '- [$]{3}')")
def junk_filter(spark, folder):
    return fl.drop_junk(restaurants(spark, folder), "price", "- [$]{3}")


@query("""
WITH levels AS (SELECT * FROM (VALUES ('$', 1), ('$$', 2), ('$$$', 3), ('$$$$', 4), ('$$$$$', 5)) AS v(sign, tier)),
parts AS (SELECT restaurant_id, string_split(replace(price, ' ', ''), '-') AS p FROM restaurants)
SELECT restaurant_id, a.tier AS min_price, b.tier AS max_price FROM parts
LEFT JOIN levels a ON a.sign = p[1] LEFT JOIN levels b ON b.sign = p[-1]""")
def price_tiers(spark, folder):
    low, high = ar.price_bounds(F.col("price"))
    return restaurants(spark, folder).select("restaurant_id", low.alias("min_price"), high.alias("max_price"))


@query("""SELECT restaurant_id, """ + ", ".join(
    f"CAST(len(list_filter(string_split(cuisine_type, ', '), lambda x: x = '{w}')) AS INTEGER) AS cuisine_{w}"
    for w in MARKED_WORDS) + " FROM restaurants")
def one_hot_categories(spark, folder):
    venues = restaurants(spark, folder).select("restaurant_id", ar.split_list(F.col("cuisine_type")).alias("cuisines"))
    return en.one_hot_array(venues, "cuisines", MARKED_WORDS, "cuisine").drop("cuisines")


@query("""SELECT restaurant_id, CAST(coalesce(price = '$', FALSE) AS INTEGER) AS price_1,
 CAST(coalesce(price = '$$$$', FALSE) AS INTEGER) AS price_4,
 CAST(coalesce(price = '$$ - $$$', FALSE) AS INTEGER) AS price_range,
 CAST(coalesce(price = '$$-$$$', FALSE) AS INTEGER) AS price_tight FROM restaurants""")
def one_hot_price(spark, folder):
    listed = ["$", "$$$$", "$$ - $$$", "$$-$$$"]
    wide = en.one_hot_scalar(restaurants(spark, folder).select("restaurant_id", "price"), "price", listed)
    return wide.select(
        "restaurant_id",
        F.col("`$`").alias("price_1"),
        F.col("`$$$$`").alias("price_4"),
        F.col("`$$ - $$$`").alias("price_range"),
        F.col("`$$-$$$`").alias("price_tight"),
    )


@query(f"WITH {EXPLODED} SELECT restaurant_id, cuisine_type, count(*) AS hits FROM exploded GROUP BY ALL")
def sparse_categories(spark, folder):
    venues = restaurants(spark, folder).select("restaurant_id", ar.split_list(F.col("cuisine_type")).alias("cuisines"))
    return en.sparse_counts(venues, "cuisines").select(
        "restaurant_id", F.explode("value_counts").alias("cuisine_type", "hits")
    ).withColumn("hits", F.col("hits").cast("bigint"))


@query("""SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT rating, reviews_count, cuisine_type, price, is_sponsored
 FROM restaurants)) AS duplicate_rows FROM restaurants""")
def duplicate_count(spark, folder):
    return dd.duplicate_count(restaurants(spark, folder).select(*SCRAPED))


@query("SELECT DISTINCT rating, reviews_count, cuisine_type, price, is_sponsored FROM restaurants")
def dedup_rows(spark, folder):
    return dd.drop_duplicate_rows(restaurants(spark, folder).select(*SCRAPED))


@query("""SELECT user_id, event_id, event_type, value FROM (
 SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS nth FROM events) WHERE nth = 1""")
def dedup_by_key(spark, folder):
    rows = table(spark, folder, "events").select("user_id", "event_id", "event_type", "value")
    return dd.dedup_by_key(rows, "user_id", [F.col("event_id")])


@query("""SELECT count(DISTINCT price) + CAST(max(CASE WHEN price IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_ids
 FROM restaurants""")
def distinct_ids(spark, folder):
    return dd.distinct_ids(restaurants(spark, folder), "price")


@query("""SELECT c_custkey, TRY_CAST(string_split(c_name, '#')[2] AS DOUBLE) AS name_number,
 TRY_CAST(c_mktsegment AS DOUBLE) AS segment_number FROM customer""")
def to_number(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey",
        nm.to_number(F.element_at(F.split("c_name", "#"), 2)).alias("name_number"),
        nm.to_number(F.col("c_mktsegment")).alias("segment_number"),
    )


@query("SELECT restaurant_id, rating FROM restaurants")
def decimal_comma(spark, folder):
    written = restaurants(spark, folder).select(
        "restaurant_id", F.replace(F.col("rating").cast("string"), F.lit("."), F.lit(",")).alias("rating")
    )
    return written.withColumn("rating", nm.decimal_comma(F.col("rating")))


@query(f"""WITH {EXPLODED} SELECT cuisine_type, round(avg(rating), 6) AS mean, count(rating) AS count,
 round(stddev_samp(rating), 6) AS std FROM exploded WHERE cuisine_type IS NOT NULL GROUP BY cuisine_type""")
def category_stats(spark, folder):
    stats = ct.category_stats(exploded(spark, folder), "cuisine_type", "rating")
    return stats.select("cuisine_type", r6("mean"), "count", r6("std"))


@query(f"""WITH {EXPLODED} SELECT cuisine_type, round(avg(rating), 6) AS mean, count(rating) AS count,
 round(stddev_samp(rating), 6) AS std FROM exploded WHERE cuisine_type IS NOT NULL GROUP BY cuisine_type
 HAVING count(rating) >= 10 ORDER BY round(avg(rating), 9) DESC NULLS LAST, cuisine_type LIMIT 10""")
def top_rated_categories(spark, folder):
    stats = ct.category_stats(exploded(spark, folder), "cuisine_type", "rating").filter("count >= 10")
    best = ct.top_k(stats, F.round("mean", 9), ["cuisine_type"], 10)
    return best.select("cuisine_type", r6("mean"), "count", r6("std"))


@query(f"""WITH {EXPLODED}, stats AS (SELECT cuisine_type, avg(rating) AS mean, count(rating) AS n FROM exploded
 WHERE cuisine_type IS NOT NULL GROUP BY cuisine_type HAVING count(rating) > 20)
 SELECT cuisine_type, round(mean, 6) AS mean, n AS count FROM stats""")
def frequent_categories(spark, folder):
    stats = ct.category_stats(exploded(spark, folder), "cuisine_type", "rating").filter("count > 20")
    return stats.select("cuisine_type", r6("mean"), "count")


@query("SELECT * FROM restaurants ORDER BY reviews_count DESC, restaurant_id LIMIT 10")
def top_reviewed(spark, folder):
    return ct.top_k(restaurants(spark, folder), F.col("reviews_count"), ["restaurant_id"], 10)


@query(f"""WITH {EXPLODED} SELECT cuisine_type, count(*) AS value_count FROM exploded GROUP BY cuisine_type
 ORDER BY 2 DESC, 1 LIMIT 50""")
def popular_categories(spark, folder):
    return ct.top_values(exploded(spark, folder), "cuisine_type", 50)


@query(f"""WITH {EXPLODED} SELECT cuisine_type, count(*) AS value_count FROM exploded GROUP BY cuisine_type
 ORDER BY 2, 1 LIMIT 10""")
def tail_categories(spark, folder):
    return ct.rarest_values(exploded(spark, folder), "cuisine_type", 10)


@query(f"WITH {EXPLODED} SELECT restaurant_id, rating, cuisine_type FROM exploded")
def explode_categories(spark, folder):
    return exploded(spark, folder)


@query("SELECT restaurant_id, replace(cuisine_type, ', ', '|') AS cuisines FROM restaurants")
def parse_list_text(spark, folder):
    text = F.concat(F.lit("['"), F.replace("cuisine_type", F.lit(", "), F.lit("', '")), F.lit("']"))
    venues = restaurants(spark, folder).select("restaurant_id", text.alias("listed"))
    return venues.select("restaurant_id", F.array_join(ar.parse_list_text(F.col("listed")), "|").alias("cuisines"))


@query("SELECT restaurant_id, replace(cuisine_type, ', ', '|') AS titles FROM restaurants")
def category_titles(spark, folder):
    records = F.transform(ar.split_list(F.col("cuisine_type")), lambda t: F.struct(F.upper(t).alias("alias"), t.alias("title")))
    venues = restaurants(spark, folder).select("restaurant_id", records.alias("categories"))
    return venues.select("restaurant_id", F.array_join(ar.struct_field(F.col("categories"), "title"), "|").alias("titles"))


PRICED = """levels AS (SELECT * FROM (VALUES ('$', 1), ('$$', 2), ('$$$', 3), ('$$$$', 4), ('$$$$$', 5)) AS v(sign, tier)),
priced AS (SELECT r.*, a.tier AS min_price, b.tier AS max_price FROM
 (SELECT *, string_split(replace(price, ' ', ''), '-') AS p FROM restaurants) r
 LEFT JOIN levels a ON a.sign = p[1] LEFT JOIN levels b ON b.sign = p[-1])"""


def priced(spark: SparkSession, folder: str) -> DataFrame:
    low, high = ar.price_bounds(F.col("price"))
    return restaurants(spark, folder).withColumns({"min_price": low, "max_price": high})


@query(f"""WITH {PRICED} SELECT min_price, max_price, round(avg(rating), 6) AS rating FROM priced
 WHERE min_price IS NOT NULL AND max_price IS NOT NULL GROUP BY min_price, max_price""")
def mean_by_price(spark, folder):
    means = ct.mean_by(priced(spark, folder), ["min_price", "max_price"], "rating", "rating")
    return means.select("min_price", "max_price", r6("rating"))


@query(f"""WITH {PRICED}, m AS (SELECT min_price, max_price, avg(rating) AS rating FROM priced
 WHERE min_price IS NOT NULL AND max_price IS NOT NULL GROUP BY min_price, max_price)
SELECT 'min_price' AS col_a, 'max_price' AS col_b, round(corr(min_price, max_price), 6) AS corr FROM m UNION ALL
SELECT 'min_price', 'rating', round(corr(min_price, rating), 6) FROM m UNION ALL
SELECT 'max_price', 'rating', round(corr(max_price, rating), 6) FROM m""")
def price_correlation(spark, folder):
    means = ct.mean_by(priced(spark, folder), ["min_price", "max_price"], "rating", "rating")
    return pf.corr_matrix(means, ["min_price", "max_price", "rating"]).select("col_a", "col_b", r6("corr"))


@query("""SELECT CAST(length(price) AS INTEGER) AS price_category, round(avg(rating), 6) AS rating FROM restaurants
 WHERE length(coalesce(price, '')) <> 0 GROUP BY 1""")
def mean_by_price_len(spark, folder):
    venues = restaurants(spark, folder).withColumn("price_category", ar.price_length(F.col("price")))
    means = ct.mean_by(venues, ["price_category"], "rating", "rating").filter("price_category <> 0")
    return means.select("price_category", r6("rating"))


def box_sql(source: str, group: str, value: str) -> str:
    return f"""q AS (SELECT {group} AS g, count({value}) AS n, quantile_cont({value}, 0.25) AS q1,
 quantile_cont({value}, 0.5) AS median, quantile_cont({value}, 0.75) AS q3 FROM {source}
 WHERE {group} IS NOT NULL AND {value} IS NOT NULL GROUP BY 1),
j AS (SELECT q.*, {value} AS v, {value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok
 FROM {source} JOIN q ON q.g = {group} WHERE {value} IS NOT NULL)
SELECT g AS {group}, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
 round(least(min(v) FILTER (WHERE ok), q1), 6) AS whisker_low,
 round(greatest(max(v) FILTER (WHERE ok), q3), 6) AS whisker_high, count(*) FILTER (WHERE NOT ok) AS outliers
FROM j GROUP BY g, n, q1, median, q3"""


def rounded_box(df: DataFrame, group: str) -> DataFrame:
    parts = [r6(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")]
    return df.select(group, "n", *parts, "outliers")


@query(f"WITH {PRICED}, {box_sql('priced', 'min_price', 'rating')}")
def box_stats(spark, folder):
    return rounded_box(ds.box_stats(priced(spark, folder), "min_price", "rating"), "min_price")


@query("WITH " + box_sql("restaurants", "is_sponsored", "rating"))
def box_by_sponsored(spark, folder):
    return rounded_box(ds.box_stats(restaurants(spark, folder), "is_sponsored", "rating"), "is_sponsored")


@query("WITH " + box_sql("events", "event_type", "value"))
def box_by_event_type(spark, folder):
    return rounded_box(ds.box_stats(table(spark, folder, "events"), "event_type", "value"), "event_type")


@query("""SELECT p_partkey AS venue_id, p_name AS name, p_size / CAST(10 AS DOUBLE) AS rating, NULL::DOUBLE AS balance FROM part
 UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
 UNION ALL SELECT c_custkey, c_name, NULL, c_acctbal FROM customer""")
def union_batches(spark, folder):
    first = table(spark, folder, "part").select(
        F.col("p_partkey").alias("venue_id"), F.col("p_name").alias("name"), (F.col("p_size") / F.lit(10.0)).alias("rating")
    )
    second = table(spark, folder, "supplier").selectExpr("s_suppkey AS venue_id", "s_name AS name", "s_acctbal AS balance")
    third = table(spark, folder, "customer").selectExpr("c_custkey AS venue_id", "c_name AS name", "c_acctbal AS balance")
    return dd.union_batches([first, second, third])


_SCORE = "(greatest(length(a), length(b)) - levenshtein(a, b)) / CAST(greatest(length(a), length(b)) AS DOUBLE)"


@query(f"""
WITH names(name, place) AS (VALUES {", ".join(f"('{w}', {i})" for i, w in enumerate(VENUE_WORDS))}),
words AS (SELECT p_partkey, unnest([1, 2]) AS place_no, unnest([string_split(p_name, ' ')[1], string_split(p_name, ' ')[2]]) AS word FROM part),
kinds AS (SELECT DISTINCT word FROM words),
pairs AS (SELECT word, name, place, lower(name) AS a, lower(word) AS b FROM kinds CROSS JOIN names),
scored AS (SELECT word, name, place, word = name AS equal, a = b AS same, {_SCORE} AS score FROM pairs),
best AS (SELECT word, name, equal, same, score,
 row_number() OVER (PARTITION BY word ORDER BY equal DESC, same DESC, score DESC, place) AS nth FROM scored)
SELECT p_partkey, CAST(place_no AS INTEGER) AS place_no, words.word, CASE WHEN same OR score >= 0.6 THEN name END AS matched_value,
 CASE WHEN equal THEN 'exact' WHEN same THEN 'normalised' WHEN score >= 0.6 THEN 'closest' ELSE 'none' END AS match_type,
 CASE WHEN same THEN 1.0::DOUBLE WHEN score >= 0.6 THEN round(score, 6) END AS match_score
FROM words JOIN best ON best.word = words.word AND nth = 1""")
def match_values(spark, folder):
    words = table(spark, folder, "part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("place_no", "word"))
    matched = mt.match_values(words.withColumn("place_no", F.col("place_no") + 1), "word", VENUE_WORDS, 0.6)
    return matched.select("p_partkey", "place_no", "word", "matched_value", "match_type", r6("match_score"))


def _nearest_sql(words: str, entries: str) -> str:
    """The closest entry for each distinct word, by comparing all pairs."""
    return f"""words AS ({words}), entries AS ({entries}), kinds AS (SELECT DISTINCT word FROM words),
pairs AS (SELECT word, name, lower(name) AS a, lower(word) AS b FROM kinds CROSS JOIN entries),
scored AS (SELECT word, name, word = name AS equal, a = b AS same, {_SCORE} AS score FROM pairs),
best AS (SELECT word, name, equal, same, score, row_number() OVER (PARTITION BY word ORDER BY equal DESC, same DESC, score DESC, name) AS nth FROM scored)"""


_FOUND = """CASE WHEN same OR score >= 0.6 THEN name END AS matched_value,
 CASE WHEN equal THEN 'exact' WHEN same THEN 'normalised' WHEN score >= 0.6 THEN 'closest' ELSE 'none' END AS match_type,
 CASE WHEN same THEN 1.0::DOUBLE WHEN score >= 0.6 THEN round(score, 6) END AS match_score"""
PART_WORDS = "SELECT p_partkey, unnest([1, 2]) AS place_no, unnest([string_split(p_name, ' ')[1], string_split(p_name, ' ')[2]]) AS word FROM part"
TEXT_WORDS = "SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS {name} FROM documents"


def _text_words(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias(name)).distinct()


@query(f"""WITH {_nearest_sql(PART_WORDS, TEXT_WORDS.format(name="name"))}
SELECT p_partkey, CAST(place_no AS INTEGER) AS place_no, words.word, {_FOUND} FROM words JOIN best ON best.word = words.word AND nth = 1""")
def match_values_table(spark, folder):
    """The words of all part names against a dictionary of all words of the documents."""
    words = table(spark, folder, "part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("place_no", "word"))
    words = words.withColumn("place_no", F.col("place_no") + 1)
    matched = mt.match_values_table(words, "word", _text_words(spark, folder, "name"), "name", cutoff=0.6)
    return matched.select("p_partkey", "place_no", "word", "matched_value", "match_type", r6("match_score"))


@query(f"""WITH {_nearest_sql(TEXT_WORDS.format(name="word"), "SELECT DISTINCT word AS name FROM (" + PART_WORDS + ")")}
SELECT best.word, {_FOUND} FROM best WHERE nth = 1""")
def match_text_words(spark, folder):
    """The other way round: every word of the documents against the words of part names."""
    names = table(spark, folder, "part").select(F.explode(F.split("p_name", " ")).alias("name")).distinct()
    matched = mt.match_values_table(_text_words(spark, folder, "word"), "word", names, "name", cutoff=0.6)
    return matched.select("word", "matched_value", "match_type", r6("match_score"))


LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _profile_sql(source: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS count, count(*) - count({c}) AS missing_count,"
        f" CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(avg({c}), 6) AS mean,"
        f" round(quantile_cont({c}, 0.5), 6) AS median, round(stddev_samp({c}), 6) AS std FROM {source}"
        for c in cols
    )


@query(_profile_sql("lineitem", LINE))
def numeric_profile(spark, folder):
    rows = pf.numeric_profile(table(spark, folder, "lineitem"), LINE)
    return rows.select("column_name", "count", "missing_count", "min", "max", r6("mean"), r6("median"), r6("std"))


@query(" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for i, a in enumerate(LINE) for b in LINE[i + 1:])
    + " UNION ALL " + " UNION ALL ".join(f"SELECT '{a}', 'constant', NULL FROM region WHERE r_regionkey = (SELECT min(r_regionkey) FROM region)" for a in LINE))
def corr_matrix(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("constant", F.lit(1.0))
    return pf.corr_matrix(lines, [*LINE, "constant"]).select("col_a", "col_b", r6("corr"))


# Forty columns with gaps of their own, made of the numbers of a line.
WIDE = [f"CASE WHEN l_orderkey % {i + 3} <> 0 THEN CAST(l_quantity * {i % 7} + l_extendedprice * {i % 5} + l_linenumber * {i} AS DOUBLE) END AS c{i}" for i in range(40)]


@query(f"WITH wide AS (SELECT {', '.join(WIDE)} FROM lineitem) SELECT col_a, col_b, CASE WHEN isfinite(c) THEN round(c, 6) END AS corr FROM (" + " UNION ALL ".join(
    f"SELECT 'c{i}' AS col_a, 'c{j}' AS col_b, corr(c{i}, c{j}) AS c FROM wide" for i in range(40) for j in range(i + 1, 40)) + ")")
def corr_wide(spark, folder):
    lines = table(spark, folder, "lineitem").selectExpr(*WIDE)
    return pf.corr_matrix(lines, lines.columns).select("col_a", "col_b", r6("corr"))


def _axis(source: str, x: str, bins: int, where: str = "TRUE") -> str:
    return f"""SELECT lo, hi, (hi - lo) / {bins} AS w FROM (
 SELECT CAST(min({x}) AS DOUBLE) AS lo, CAST(max({x}) AS DOUBLE) AS hi FROM {source} WHERE {where})"""


def left_bin(x: str, axis: str, bins: int) -> str:
    return f"CAST(least(floor(({x} - {axis}.lo) / ({axis}.hi - {axis}.lo) * {bins}), {bins - 1}) AS BIGINT)"


def left_fixed(x: str, guess: str, axis: str, bins: int) -> str:
    return (
        f"{guess} - CAST({x} < {axis}.lo + {guess} * {axis}.w AS INT)"
        f" + CAST({x} >= {axis}.lo + ({guess} + 1) * {axis}.w AND {guess} < {bins - 1} AS INT)"
    )


@query(f"""WITH axis AS ({_axis('lineitem', 'l_extendedprice', 30)}),
guessed AS (SELECT l_extendedprice AS x, {left_bin('l_extendedprice', 'axis', 30)} AS g FROM lineitem, axis),
counted AS (SELECT {left_fixed('x', 'g', 'axis', 30)} AS bin, count(*) AS c FROM guessed, axis GROUP BY 1)
SELECT b.bin, round(lo + b.bin * w, 6) AS lower, round(lo + (b.bin + 1) * w, 6) AS upper, coalesce(c, 0) AS row_count
FROM (SELECT unnest(range(30)) AS bin) b CROSS JOIN axis LEFT JOIN counted ON counted.bin = b.bin""")
def histogram(spark, folder):
    bars = ds.histogram(table(spark, folder, "lineitem"), "l_extendedprice", 30)
    return bars.select("bin", r6("lower"), r6("upper"), "row_count")


def _auto_sql(source: str, x: str, name: str, whole: bool) -> str:
    width = f"{'greatest(1, ' if whole else '('}least(greatest(2 * (q3 - q1) / pow(n, 1.0 / 3.0), (hi - lo) / sqrt(n) / 2), (hi - lo) / (log2(n) + 1)))"
    return f"""SELECT '{name}' AS column_name, b.bin, round(lo + b.bin * w, 6) AS lower, round(lo + (b.bin + 1) * w, 6) AS upper, coalesce(c, 0) AS row_count FROM (
 WITH seen AS (SELECT count({x}) AS n, CAST(min({x}) AS DOUBLE) AS lo, CAST(max({x}) AS DOUBLE) AS hi, quantile_cont(CAST({x} AS DOUBLE), 0.25) AS q1,
  quantile_cont(CAST({x} AS DOUBLE), 0.75) AS q3 FROM {source}),
 sized AS (SELECT *, CAST(ceil((hi - lo) / {width}) AS BIGINT) AS bins FROM seen),
 axis AS (SELECT *, (hi - lo) / bins AS w FROM sized),
 guessed AS (SELECT CAST({x} AS DOUBLE) AS x, CAST(least(floor((CAST({x} AS DOUBLE) - lo) / (hi - lo) * bins), bins - 1) AS BIGINT) AS g FROM {source}, axis WHERE {x} IS NOT NULL),
 counted AS (SELECT g - CAST(x < lo + g * w AS INT) + CAST(x >= lo + (g + 1) * w AND g < bins - 1 AS INT) AS bin, count(*) AS c FROM guessed, axis GROUP BY 1)
 SELECT b.bin, lo, w, c FROM (SELECT unnest(range((SELECT bins FROM axis))) AS bin) b CROSS JOIN axis LEFT JOIN counted ON counted.bin = b.bin) b"""


AUTO_COLUMNS = {"l_extendedprice": ("lineitem", False), "value": ("events", False), "rating": ("restaurants", False), "reviews_count": ("restaurants", True)}


@query(" UNION ALL ".join(_auto_sql(t, c, c, whole) for c, (t, whole) in AUTO_COLUMNS.items()))
def histogram_auto(spark, folder):
    """Bins that the data themselves set, of a price, an event value, a rating with gaps and a whole number."""
    parts = []
    for c, (name, _) in AUTO_COLUMNS.items():
        rows = restaurants(spark, folder) if name == "restaurants" else table(spark, folder, name)
        parts.append(ds.histogram(rows.select(c), c, "auto").select(F.lit(c).alias("column_name"), "bin", r6("lower"), r6("upper"), "row_count"))
    return reduce(DataFrame.union, parts)


def binned_sql(source: str, x: str, y: str, bins: int) -> str:
    both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
    return f"""axis AS ({_axis(source, x, bins, both)}),
guessed AS (SELECT CAST({x} AS DOUBLE) AS x, {y} AS y,
 CAST(greatest(ceil(({x} - lo) / (hi - lo) * {bins}) - 1, 0) AS BIGINT) AS g FROM {source}, axis WHERE {both}),
counted AS (SELECT g - CAST(x <= lo + g * w AND g > 0 AS INT) + CAST(x > lo + (g + 1) * w AND g < {bins - 1} AS INT) AS bin,
 count(*) AS c, avg(y) AS m FROM guessed, axis GROUP BY 1)
SELECT b.bin, round(lo + b.bin * w, 6) AS lower, round(lo + (b.bin + 1) * w, 6) AS upper, coalesce(c, 0) AS row_count,
 round(m, 6) AS mean
FROM (SELECT unnest(range({bins})) AS bin) b CROSS JOIN axis LEFT JOIN counted ON counted.bin = b.bin"""


def rounded_bins(df: DataFrame) -> DataFrame:
    return df.select("bin", r6("lower"), r6("upper"), "row_count", r6("mean"))


@query("WITH " + binned_sql("lineitem", "l_quantity", "l_extendedprice", 20))
def binned_mean(spark, folder):
    return rounded_bins(ds.binned_mean(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice", 20))


@query(f"""WITH ax AS ({_axis('lineitem', 'l_quantity', 25)}), ay AS ({_axis('lineitem', 'l_extendedprice', 40)}),
guessed AS (SELECT l_quantity AS x, l_extendedprice AS y, {left_bin('l_quantity', 'ax', 25)} AS gx,
 {left_bin('l_extendedprice', 'ay', 40)} AS gy FROM lineitem, ax, ay)
SELECT {left_fixed('x', 'gx', 'ax', 25)} AS x_bin, {left_fixed('y', 'gy', 'ay', 40)} AS y_bin, count(*) AS row_count
FROM guessed, ax, ay GROUP BY 1, 2""")
def scatter_grid(spark, folder):
    return ds.scatter_grid(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice", 25, 40)
