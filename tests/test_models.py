from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import functions as F

from venuelens.functions.numbers import unlog_target
from venuelens.operators import champion, evaluate as ev, features as ft, models as ml
from venuelens.plans import review_pipeline as rp, venue_pipeline as vp


def reviews_frame(spark, n=240):
    words = ["soft fabric", "fits large", "runs small", "lovely color", "cheap material"]
    rows = []
    for i in range(n):
        helpful = (i * 7) % 5 if i % 3 else 0
        title = None if i % 6 == 0 else f"title {words[i % 5]}"
        text = None if i % 28 == 0 else f"{words[i % 5]} and {words[(i + helpful) % 5]} number{i % 11} " * (1 + helpful)
        rows.append((i, i % 9, 20 + i % 50, title, text, 1 + i % 5 if i % 4 else None, i % 2, helpful,
                     f"div{i % 2}", f"dep{i % 3}" if i % 10 else None, f"class{i % 7}"))
    return spark.createDataFrame(
        rows,
        "row_id long, clothing_id long, age long, title string, review_text string, rating long, recommended_ind long,"
        " positive_feedback_count long, division_name string, department_name string, class_name string",
    )


def test_split_depends_on_key_and_seed_only(spark):
    df = spark.range(2000).withColumnRenamed("id", "row_id")
    tests = {tuple(sorted(r[0] for r in ft.split(df.repartition(p), "row_id")[1].collect())) for p in (1, 4, 17)}
    assert len(tests) == 1
    chosen = tests.pop()
    assert 330 < len(chosen) < 470
    other = {r[0] for r in ft.split(df, "row_id", seed=7)[1].collect()}
    assert set(chosen) != other
    assert ft.split(df, "row_id")[0].count() == 2000 - len(chosen)


def test_median_imputation_and_scaling(spark):
    df = spark.createDataFrame([(1.0, 5, None), (2.0, 5, None), (3.0, 5, None), (10.0, None, None)], "a double, b int, c double")
    medians = ft.fit_medians(df, ["a", "b", "c"])
    assert medians == {"a": 2.5, "b": 5.0, "c": 0.0}
    filled = ft.impute(df, medians)
    scaling = ft.fit_scaling(filled, ["a", "b"])
    assert scaling["a"] == pytest.approx((4.0, np.std([1, 2, 3, 10]))) and scaling["b"] == (5.0, 1.0)
    assert {r["b"] for r in ft.scale(filled, scaling).collect()} == {0.0}


TEXTS = ["Big red dog", "red red cat", "dog cat cat a", None, "bird"]


def test_tfidf(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, t string")
    terms = {r["term"]: r for r in ft.tfidf_vocabulary(df, "t", 10, 2).collect()}
    assert {t: (r["term_count"], r["doc_count"]) for t, r in terms.items()} == {"red": (3, 2), "cat": (3, 2), "dog": (2, 2)}
    assert terms["red"]["idf"] == pytest.approx(math.log(6 / 3) + 1)
    assert [r["term"] for r in ft.tfidf_vocabulary(df, "t", 2, 1).collect()] == ["cat", "red"]
    stages, name = ml._text_stages(df, "t")
    vectors = {r["id"]: r[name].toArray() for r in ml._apply(stages, df).collect()}
    idf = {"red": math.log(6 / 3) + 1, "bird": math.log(6 / 2) + 1}
    order = stages[2].vocabulary
    row = np.array([{"red": 2 * idf["red"], "cat": idf["red"]}.get(t, 0.0) for t in order])
    assert np.allclose(vectors[1], row / np.linalg.norm(row))
    assert not vectors[3].any()


@pytest.mark.parametrize("alpha", [1.0, 25.0])
def test_ridge_equals_closed_form(spark, alpha):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(80, 3)) * [1, 10, 0.1] + [0, 5, 1]
    y = x @ [1.0, -0.2, 4.0] + rng.normal(size=80)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, label double")
    model = ml.fit_ridge(df, ml.FeatureSpec(("a", "b", "c")), alpha=alpha)
    z = (x - x.mean(0)) / x.std(0)
    weights = np.linalg.solve(z.T @ z + alpha * np.eye(3), z.T @ (y - y.mean()))
    assert np.allclose(model.stages[-1].coefficients.toArray(), weights, atol=1e-7)
    assert model.stages[-1].intercept == pytest.approx(y.mean())


def test_unseen_category_gives_zeros(spark):
    train = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    stages, (block,) = ml._category_stages(train, ["c"])
    assert isinstance(stages[0], StringIndexerModel)
    seen = spark.createDataFrame([("b",), ("zzz",), (None,)], "c string")
    rows = [r[block].toArray().tolist() for r in ml._apply(stages, seen).collect()]
    assert rows == [[0.0, 1.0], [0.0, 0.0], [0.0, 0.0]]


def test_best_model_puts_missing_last(spark):
    schema = "model_name string, rmse double, mae double, rank_correlation double, top_decile_rate double"
    rows = [("a", None, 1.0, 0.9, 0.9), ("b", 2.0, 1.0, None, 0.9), ("c", 2.0, 1.0, 0.1, 0.2), ("d", 2.0, 1.5, 0.9, 0.9)]
    assert ev.best_model(spark.createDataFrame(rows, schema)).first()["model_name"] == "c"


def broken(df, spec, numeric=None):
    raise ValueError("no luck")


def test_a_failing_candidate_does_not_stop_the_others(spark):
    rows = ml.with_label(reviews_frame(spark), rp.TARGET)
    train, test = ft.split(rows, "row_id")
    spec = ml.FeatureSpec(("age",))
    metrics, errors = ml.compare_models(train, test, {"ok": (ml.fit_mean, spec), "bad": (broken, spec)}, "row_id", rp.TARGET)
    rows = {r["model_name"]: r for r in metrics.collect()}
    assert set(rows) == {"ok", "bad"} and rows["ok"]["error"] is None
    assert rows["bad"]["error"] == "ValueError: no luck" and rows["bad"]["rmse"] is None
    assert errors == {"bad": "ValueError: no luck"}
    with pytest.raises(RuntimeError):
        ml.compare_models(train, test, {"bad": (broken, spec)}, "row_id", rp.TARGET)


def test_champion_is_replaced_only_by_a_lower_error(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0)], "a double, label double")
    model = ml.fit_mean(df, ml.FeatureSpec(("a",)))
    metric = lambda e: spark.createDataFrame([("m", e)], "model_name string, rmse double")
    path = str(tmp_path)
    assert champion.champion_metrics(spark, path) is None
    assert [champion.save_if_better(model, metric(e), path) for e in (None, 2.0, 2.0, 2.5, float("nan"), 1.0, None)] == [
        False, True, False, False, False, True, False]
    assert champion.champion_metrics(spark, path)["rmse"] == 1.0 and champion.champion_metrics(spark, path)["version"] == 2
    assert len(list((tmp_path / "models").iterdir())) == len([p for p in (tmp_path / "versions").iterdir() if p.suffix == ".json"]) == 1
    assert champion.load_champion(spark, path).transform(df).first()["prediction"] == 2.0


@pytest.mark.parametrize("own, kept, left", [(0.7, 0.5, 0.5), (0.3, 0.5, 0.3)])
def test_two_writers_at_once(spark, tmp_path, monkeypatch, own, kept, left):
    """The other run commits after this one has looked and saved its model; the loser of the race looks again."""
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0)], "a double, label double")
    model, path, create = ml.fit_mean(df, ml.FeatureSpec(("a",))), str(tmp_path), champion._create
    metric = lambda e: spark.createDataFrame([("m", e)], "model_name string, rmse double")
    assert champion.save_if_better(model, metric(2.0), path)

    def meanwhile(*args):
        monkeypatch.setattr(champion, "_create", create)
        assert champion.save_if_better(model, metric(kept), path)
        return create(*args)

    monkeypatch.setattr(champion, "_create", meanwhile)
    assert champion.save_if_better(model, metric(own), path) == (own < kept)
    now = champion.champion_metrics(spark, path)
    assert now["rmse"] == left and now["version"] == 2 + (own < kept)
    assert [p.name for p in (tmp_path / "models").iterdir()] == [now["model_path"].rsplit("/", 1)[1]]
    assert champion.load_champion(spark, path).transform(df).first()["prediction"] == 2.0


def test_unfinished_versions_and_orphans(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(champion, "PATIENCE", 1)
    df = spark.createDataFrame([(1.0, 1.0)], "a double, label double")
    model, path = ml.fit_mean(df, ml.FeatureSpec(("a",))), str(tmp_path)
    metric = lambda e: spark.createDataFrame([("m", e)], "model_name string, rmse double")
    assert champion.save_if_better(model, metric(2.0), path)
    (tmp_path / "versions" / "0000000002.json").write_text('{"rmse": 1.')
    model.write().save(f"{path}/models/lost")
    assert champion.champion_metrics(spark, path)["rmse"] == 2.0
    assert champion.save_if_better(model, metric(1.5), path) and champion.champion_metrics(spark, path)["version"] == 3
    assert champion.remove_orphans(spark, path) == 0 and champion.remove_orphans(spark, path, 0) == 1
    assert champion.load_champion(spark, path) is not None


def test_review_pipeline(spark, tmp_path):
    reviews = reviews_frame(spark)
    prepared = rp.prepare_reviews(reviews)
    assert len(prepared.columns) == 23
    metrics, errors, run = rp.run_models(prepared)
    rows = {r["model_name"]: r for r in metrics.collect()}
    assert errors == {} and set(rows) == set(run["models"])
    assert rows["mean_numeric"]["rank_correlation"] is None
    assert rows["ridge_numeric_text_category"]["rmse"] < rows["mean_numeric"]["rmse"]
    assert rp.run_pipeline(reviews, str(tmp_path))
    assert not rp.run_pipeline(reviews, str(tmp_path))
    table = spark.read.parquet(f"{tmp_path}/memory/predictions")
    assert table.count() == 240 == table.select("row_index").distinct().count()
    assert table.filter("predicted_target < 0 OR predicted_rank IS NULL OR title = ''").count() == 0
    best = champion.load_champion(spark, f"{tmp_path}/memory/best_model")
    again = best.transform(prepared).select(F.col("row_id").alias("row_index"), unlog_target(F.col("prediction")).alias("again"))
    assert table.join(again, "row_index").filter("abs(again - predicted_target) > 1e-9").count() == 0


def test_listing_study(spark):
    cuisines = ["Pizza, Bar", "Bar", "Sushi", "Меню", "Pizza"]
    rows = [(f"{i % 5},{i % 9}" if i % 12 else "N/A", i % 40, cuisines[i % 5], ["$", "$$ - $$$", "$$$$", None][i % 4], i % 3 == 0)
            for i in range(120)]
    rows += rows[:30]
    scraped = spark.createDataFrame(rows, "rating string, reviews_count long, cuisine_type string, price string, is_sponsored boolean")
    study = vp.listing_study(scraped, 10)
    results = {name: df.collect() for name, df in study.items()}
    assert all(results.values())
    assert {r["cuisine_type"] for r in results["cuisine_stats"]} == {"Pizza", "Bar", "Sushi"}
    venues = vp.clean_listings(scraped)
    assert venues.count() == len({r for r in rows if r[0] != "N/A" and r[2] != "Меню" and r[3]})
    assert sum(r["row_count"] for r in results["rating_histogram"]) == venues.count()


def test_business_studies(spark):
    schema = ("id string, name string, is_closed boolean, review_count long, categories array<struct<alias:string,title:string>>,"
              " rating double, transactions array<string>, price string")
    batch = [(f"b{i}", f"n{i}", False, i, [("x", "Thai"), ("y", "Bar")] if i % 2 else [("y", "Bar")], 3.0 + i % 3,
              ["pickup", "delivery"][: i % 3], ["$", "$$", None][i % 3]) for i in range(30)]
    first, second = spark.createDataFrame(batch, schema), spark.createDataFrame(batch[:10], schema)
    sparse = vp.encode_businesses([first, second]).filter("id = 'b5'").first()
    assert sparse["categories_counts"] == {"Thai": 1, "Bar": 1} and sparse["transactions_counts"] == {"pickup": 1, "delivery": 1}
    wide = vp.encode_businesses([first, second], ["pickup", "delivery"], ["Thai", "Bar"])
    assert wide.count() == 30
    row = wide.filter("id = 'b5'").first()
    assert (row["categories_Thai"], row["categories_Bar"], row["transactions_pickup"], row["$"], row["$$$$"]) == (1, 1, 1, 0, 0)
    listed = first.select("id", "name", "review_count", "rating", "transactions", "price",
                          F.concat(F.lit("['"), F.array_join(F.col("categories.title"), "', '"), F.lit("']")).alias("categories"))
    results = {name: df.collect() for name, df in vp.business_study(listed, 10, 20).items()}
    assert {r["categories"]: r["count"] for r in results["category_stats"]} == {"Bar": 30, "Thai": 15}
    assert [r["categories"] for r in results["best_rated"]] == ["Bar"]
    assert {r["price_category"] for r in results["rating_by_price"]} == {1, 2}
