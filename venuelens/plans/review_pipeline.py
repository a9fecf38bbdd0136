"""The review-helpfulness pipeline: clean, features, models, ranked predictions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from venuelens.operators import champion, features as ft, filters as fl, models as ml
from venuelens.operators.evaluate import best_model
from venuelens.operators.materialize import materialize
from venuelens.sources.writers import write_predictions

KEY, TARGET = "row_id", "positive_feedback_count"
CATEGORIES = ("division_name", "department_name", "class_name")
# Numeric features of the review models; clothing_id is one of them although it is a label.
NUMERIC = (
    "clothing_id",
    "age",
    "rating",
    "recommended_ind",
    "review_text_len_chars",
    "review_text_word_count",
    "title_len_chars",
    "title_word_count",
    "has_title",
    "has_review_text",
    "rating_is_low",
    "rating_is_high",
    "fit_keyword_count",
    "quality_keyword_count",
    "size_keyword_flag",
)


def prepare_reviews(reviews: DataFrame) -> DataFrame:
    """Cleaned reviews with the twelve derived columns."""
    return ft.add_rating_flags(ft.add_text_features(fl.clean_categories(reviews, CATEGORIES)))


@dataclass(frozen=True)
class Choice:
    """The winning model, refitted on all rows with a target."""

    name: str
    model: PipelineModel
    metrics: DataFrame
    rows: DataFrame


def run_models(
    prepared: DataFrame, numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORIES
) -> tuple[DataFrame, dict[str, str], dict]:
    """Fit all candidates on the train rows and measure them on the test rows.

    The prepared rows are written once: every candidate then reads only the columns it needs.
    """
    prepared = materialize(prepared)
    valid = fl.valid_target(prepared, TARGET)
    valid, numbers = fl.with_constant_feature(valid, numeric)
    types = fl.feature_types(valid, TARGET, [KEY], categorical)
    spec = ml.FeatureSpec(tuple(numbers), tuple(types["categorical"]), next(iter(types["text"]), None))
    rows = ml.with_label(valid, TARGET)
    train, test = ft.split(rows, KEY)
    models = ml.candidates(spec)
    metrics, errors = ml.compare_models(train, test, models, KEY, TARGET)
    return metrics, errors, {"models": models, "rows": rows}


def choose_model(prepared: DataFrame, numeric: Sequence[str] = NUMERIC) -> Choice:
    """The best candidate, refitted on all valid rows with its own columns."""
    metrics, _, run = run_models(prepared, numeric)
    best = materialize(best_model(metrics.filter("error IS NULL").drop("error")))
    name = best.first()["model_name"]
    fit, spec = run["models"][name]
    return Choice(name, fit(run["rows"], spec), best, run["rows"])


def run_pipeline(reviews: DataFrame, output: str, numeric: Sequence[str] = NUMERIC) -> bool:
    """Score all reviews into ``output`` and keep the model if it beats the stored one."""
    choice = choose_model(prepare_reviews(reviews), numeric)
    predictions = ml.prediction_table(choice.model, choice.rows, KEY, TARGET, choice.name)
    write_predictions(predictions, f"{output}/predictions", f"{output}/memory/predictions")
    return champion.save_if_better(choice.model, choice.metrics, f"{output}/memory/best_model")
