from __future__ import annotations

import json
import shutil
import time

from pyspark.sql import functions as F

from venuelens.sources import cards, readers, writers
from venuelens.streaming.ingest import ingest_pages, take_batch

HEADER = ",Clothing ID,Age,Title,Review Text,Rating,Recommended IND,Positive Feedback Count,Division Name,Department Name,Class Name\n"


def test_reviews_csv(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(
        HEADER
        + '0,767,33,,"Absolutely\nwonderful ""silky""",4,1,0,Initmates,Intimate,Intimates\n'
        + "1,1080.0,34,N/A,nan,5,x,4,General,Dresses,\n",
        encoding="utf-8",
    )
    first, second = readers.read_reviews(spark, str(path)).orderBy("row_id").collect()
    assert first["review_text"] == 'Absolutely\nwonderful "silky"' and first["title"] is None
    assert second["clothing_id"] == 1080 and second["recommended_ind"] is None
    assert second["title"] is None and second["review_text"] is None and second["class_name"] is None
    assert second.asDict()["positive_feedback_count"] == 4


def test_restaurants_csv(spark, tmp_path):
    path = tmp_path / "venues.csv"
    path.write_text('rating,reviews_count,cuisine_type,price,is_sponsored\n"4,5",12,"Pizza, Bar",$$ - $$$,True\nN/A,0,,,False\n')
    rows = readers.read_restaurants(spark, str(path)).orderBy(F.desc("reviews_count")).collect()
    assert tuple(rows[0]) == ("4,5", 12, "Pizza, Bar", "$$ - $$$", True)
    assert tuple(rows[1]) == (None, 0, None, None, False)


BUSINESS = {
    "id": "a", "name": "A", "is_closed": False, "review_count": 3, "rating": 4.5, "price": "$$",
    "categories": [{"alias": "x", "title": "X"}], "transactions": ["pickup"], "phone": "1",
}


def test_businesses_json(spark, tmp_path):
    for i, found in enumerate([[BUSINESS, {**BUSINESS, "id": "b", "price": None}], []]):
        (tmp_path / f"r{i}.json").write_text(json.dumps({"businesses": found, "total": 2}, indent=1))
    rows = readers.read_businesses(spark, str(tmp_path)).orderBy("id").collect()
    assert [r["id"] for r in rows] == ["a", "b"]
    assert rows[0]["categories"][0]["title"] == "X" and rows[1]["price"] is None


LISTING = """<html><body><span class="f"><span>outside</span></span>
<div data-automation="restaurantCard" data-sponsored="1">
 <div data-automation="bubbleRatingValue"><span> 4,5 </span></div>
 <div data-automation="bubbleReviewCount"><a><span>(1 234 reviews)</span></a></div>
 <span class="f q"><span>Pizza, <b>Bar</b></span></span><span class="f"><span>later</span></span>
 <div class="biqBm"><span class="biGQs x">$$ - $$$</span></div></div>
<div data-automation="restaurantCard"><img src="x"><div class="biqBm"><p><span class="biGQs">not a child</span></p></div>
 <div data-automation="bubbleReviewCount"><span>new</span></div></div>
<div data-automation="restaurantCard"><div data-automation="bubbleRatingValue">no span</div>
 <div data-automation="bubbleRatingValue"><span>3,0</span></div></div>
<div class="biqBm"><span class="biGQs">after</span></div></body></html>"""


def listing_rows(spark):
    return spark.createDataFrame([(1, LISTING), (2, ""), (3, None)], "page_id long, html string")


def test_listing_cards(spark):
    rows = [tuple(r) for r in cards.extract_listing_cards(listing_rows(spark)).orderBy("page_id", "card_no").collect()]
    assert rows == [
        (1, 0, "4,5", 1234, "Pizza,Bar", "$$ - $$$", True),
        (1, 1, "N/A", None, "", "", False),
        (1, 2, "N/A", 0, "", "", False),
    ]


def test_odd_markup(spark):
    card = '<DIV data-automation=restaurantCard>{}</DIV>'
    texts = {
        1: "<div data-automation='bubbleRatingValue'><div><div><SPAN title='a > b'>4,<br>0 &amp; up</SPAN></div></div></div>",
        2: "<p><p><span class='x f'><em>none</em></span><span class=f><b><span> A &lt; B </span></b></span>",
        3: '<!-- <div data-automation="bubbleRatingValue"><span>9</span></div> --><script>"<span>"</script><div class="biqBm">\n<span class="biGQs">$</span>',
        4: "<div data-automation='bubbleReviewCount'><span/></div><div class='no biqBmx'><span class='biGQs'>no</span></div>1 < 2",
    }
    page = lambda body: f'<!DOCTYPE html><p>"<div class="f"><span class="f">{body}</span>'
    df = spark.createDataFrame([(k, page(card.format(t) + card.format(""))) for k, t in texts.items()], "page_id long, html string")
    found = cards.extract_listing_cards(df)
    rows = {r["page_id"]: tuple(r)[2:] for r in found.where("card_no = 0").collect()}
    assert rows == {
        1: ("4,0 & up", 0, "", "", False), 2: ("N/A", 0, "A < B", "", False), 3: ("N/A", 0, "", "$", False), 4: ("N/A", 0, "", "", False),
    }
    assert found.where("card_no = 1").count() == 4
    plan = found._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("PythonUDF", "InPandas", "InArrow", "Exchange"))


def test_elements_are_looked_through_once(spark):
    """A card of many tokens: the name of its tag was taken from a copy of the rest of the page for each of them."""
    card = lambda n: "<div data-automation='restaurantCard'>" + "<b>x</b><div>" * n + "</div>" * n + "</div><p>"

    def seconds(n):
        df = spark.createDataFrame([(1, card(n))], "page_id long, html string")
        began = time.perf_counter()
        assert [tuple(r) for r in cards.extract_listing_cards(df).collect()] == [(1, 0, "N/A", 0, "", "", False)]
        return time.perf_counter() - began

    seconds(100)
    assert seconds(8000) < 20


def test_cards_by_rules(spark):
    rules = cards.CardRules(r"(?s)<li>.*?</li>", {"name": r"<b>(.*?)</b>", "price": r"<i>(.*?)</i>"})
    pages = spark.createDataFrame([(1, "<ul><li><b>A</b><i>$</i></li>\n<li><b>B</b></li></ul>"), (2, None)], "page_id long, html string")
    rows = [tuple(r) for r in cards.extract_cards(pages, rules).orderBy("card_no").collect()]
    assert rows == [(1, 0, "A", "$"), (1, 1, "B", None)]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q"\nb'), (2, None)], "id long, t string")
    writers.write_prepared(df, f"{tmp_path}/p")
    writers.write_prepared(df, f"{tmp_path}/c", "csv")
    writers.write_predictions(df, f"{tmp_path}/one", f"{tmp_path}/two")
    writers.write_report(df, f"{tmp_path}/report")
    for name in ("p", "one", "two", "report"):
        assert sorted(spark.read.parquet(f"{tmp_path}/{name}").collect()) == sorted(df.collect())
    back = readers.read_csv(spark, f"{tmp_path}/c", df.schema)
    assert sorted(map(tuple, back.collect())) == [(1, 'a "q"\nb'), (2, None)]


def test_ingest_takes_each_page_once(spark, tmp_path):
    landing, out, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))

    def land(*keys):
        rows = [(k, f"u{k}", LISTING) for k in keys]
        spark.createDataFrame(rows, "page_id long, url string, html string").write.mode("append").parquet(landing)

    def run():
        ingest_pages(spark, landing, out, state).awaitTermination()
        return spark.read.parquet(out).count()

    land(1, 1, 2)
    assert run() == 6
    assert run() == 6
    land(2, 3)
    assert run() == 9


def test_a_batch_that_is_run_again_adds_nothing(spark, tmp_path):
    out, keys = f"{tmp_path}/out", f"{tmp_path}/keys"
    pages = lambda *ids: spark.createDataFrame([(k, f"u{k}", LISTING) for k in ids], "page_id long, url string, html string")
    cards_of = lambda: sorted((r["page_id"], r["card_no"]) for r in spark.read.parquet(out).collect())
    take_batch(pages(1, 2, 2), 0, out, keys)
    take_batch(pages(2, 3), 1, out, keys)
    want = [(k, n) for k in (1, 2, 3) for n in range(3)]
    assert cards_of() == want
    for lost in ((), ("keys",), ("out", "keys")):  # what a crash had not written yet, or had written in full
        for name in lost:
            shutil.rmtree(f"{tmp_path}/{name}/batch=1")
        take_batch(pages(2, 3), 1, out, keys)
        assert cards_of() == want
    take_batch(pages(1, 2, 3), 2, out, keys)
    assert cards_of() == want
