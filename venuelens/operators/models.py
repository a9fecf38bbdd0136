"""Candidate regression models, choice, refit and prediction table (MD-8 to MD-10, MD-14 to MD-18)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    Normalizer,
    OneHotEncoder,
    RegexTokenizer,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from venuelens.functions.numbers import log_target, unlog_target
from venuelens.operators.evaluate import evaluate_predictions
from venuelens.operators.features import fit_medians, fit_scaling, impute, tfidf_vocabulary
from venuelens.operators.materialize import materialize
from venuelens.operators.ranking import add_predicted_ranks


@dataclass(frozen=True)
class FeatureSpec:
    """Feature columns of one model."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    text: str | None = None


def _number(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


@dataclass(frozen=True)
class NumericFit:
    """Median per numeric column, and mean and deviation after imputation."""

    medians: dict[str, float]
    scaling: dict[str, tuple[float, float]]


def fit_numeric(df: DataFrame, cols: Sequence[str]) -> NumericFit:
    medians = fit_medians(df, cols)
    return NumericFit(medians, fit_scaling(impute(df.select(*cols), medians), cols))


def _numeric_stage(fitted: NumericFit, cols: Sequence[str], scaled: bool) -> tuple[SQLTransformer, list[str]]:
    """Median imputation, and scaling if wanted, as one SQL projection that can be saved with the model."""
    parts = []
    for c in cols:
        filled = f"coalesce(CAST(`{c}` AS DOUBLE), {_number(fitted.medians[c])})"
        mean, std = fitted.scaling[c]
        parts.append(f"({filled} - {_number(mean)}) / {_number(std)} AS `{c}__x`" if scaled else f"{filled} AS `{c}__x`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__"), [f"{c}__x" for c in cols]


def _text_stages(df: DataFrame, col: str, size: int = 500, min_df: int = 2) -> tuple[list, str]:
    """TF-IDF with smooth idf and unit length; only the vocabulary (``size`` terms) reaches the driver."""
    terms = tfidf_vocabulary(df, col, size, min_df).collect()
    if not terms:
        raise ValueError(f"no terms in {col}")
    idf = Vectors.dense([row["idf"] for row in terms])
    counter = CountVectorizerModel.from_vocabulary(
        [row["term"] for row in terms], inputCol="text__words", outputCol="text__counts"
    )
    return [
        SQLTransformer(statement=f"SELECT *, coalesce(`{col}`, '') AS text__filled FROM __THIS__"),
        RegexTokenizer(inputCol="text__filled", outputCol="text__words", pattern=r"(?U)\b\w\w+\b", gaps=False),
        counter,
        ElementwiseProduct(inputCol="text__counts", outputCol="text__weighted", scalingVec=idf),
        Normalizer(inputCol="text__weighted", outputCol="text__x", p=2.0),
    ], "text__x"


def _category_stages(df: DataFrame, cols: Sequence[str]) -> tuple[list, list[str]]:
    """One-hot blocks; a category unseen in training gives zeros."""
    index, block = [f"{c}__index" for c in cols], [f"{c}__x" for c in cols]
    indexer = StringIndexer(inputCols=list(cols), outputCols=index, handleInvalid="keep").fit(df)
    encoder = OneHotEncoder(inputCols=index, outputCols=block, dropLast=True).fit(indexer.transform(df))
    return [indexer, encoder], block


def _apply(stages: Sequence, df: DataFrame) -> DataFrame:
    for stage in stages:
        df = stage.transform(df)
    return df


def feature_stages(
    df: DataFrame, spec: FeatureSpec, scaled: bool, numeric: NumericFit | None = None, min_df: int = 2
) -> list:
    """Fitted stages that end in the vector column ``features``; ``numeric`` may come from an earlier fit.

    ``min_df``: documents that a term of the text must occur in.
    """
    stages, inputs = [], []
    if spec.text:
        more, name = _text_stages(df, spec.text, min_df=min_df)
        stages += more
        inputs.append(name)
    if spec.numeric:
        stage, names = _numeric_stage(numeric or fit_numeric(df, spec.numeric), spec.numeric, scaled)
        stages.append(stage)
        inputs += names
    if spec.categorical:
        more, names = _category_stages(df, spec.categorical)
        stages += more
        inputs += names
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error")]


def fit_mean(
    df: DataFrame, spec: FeatureSpec, label: str = "label", numeric: NumericFit | None = None
) -> PipelineModel:
    """The mean of the label for every row."""
    mean = df.agg(F.avg(label)).first()[0]
    return PipelineModel([SQLTransformer(statement=f"SELECT *, {_number(mean)} AS prediction FROM __THIS__")])


def fit_ridge(
    df: DataFrame,
    spec: FeatureSpec,
    label: str = "label",
    alpha: float = 1.0,
    numeric: NumericFit | None = None,
    min_df: int = 2,
) -> PipelineModel:
    """Ridge regression: squared error plus ``alpha`` times the squared weights, intercept free.

    Spark divides the error by n and measures the penalty on a label of unit deviation, hence the factor.
    """
    stages = feature_stages(df, spec, True, numeric, min_df)
    size = df.agg(F.count(label).alias("n"), F.stddev_pop(F.col(label).cast("double")).alias("std")).first()
    ridge = LinearRegression(
        labelCol=label,
        solver="normal",
        standardization=False,
        elasticNetParam=0.0,
        regParam=alpha / size["n"] * size["std"],
    )
    return PipelineModel([*stages, ridge.fit(_apply(stages, df).select("features", label))])


def fit_forest(
    df: DataFrame,
    spec: FeatureSpec,
    label: str = "label",
    trees: int = 30,
    numeric: NumericFit | None = None,
) -> PipelineModel:
    """Random forest of depth 12 with at least five rows per leaf and all features at every split."""
    stages = feature_stages(df, spec, False, numeric)
    forest = RandomForestRegressor(
        labelCol=label,
        numTrees=trees,
        maxDepth=12,
        minInstancesPerNode=5,
        featureSubsetStrategy="all",
        seed=42,
        maxBins=256,
    )
    return PipelineModel([*stages, forest.fit(_apply(stages, df).select("features", label))])


Fit = Callable[..., PipelineModel]


def candidates(spec: FeatureSpec) -> dict[str, tuple[Fit, FeatureSpec]]:
    """Mean baseline, ridge and forest on numbers, and ridge on everything when there is a text column."""
    numbers = FeatureSpec(spec.numeric)
    models: dict[str, tuple[Fit, FeatureSpec]] = {
        "mean_numeric": (fit_mean, numbers),
        "ridge_numeric": (fit_ridge, numbers),
        "forest_numeric": (fit_forest, numbers),
    }
    if spec.text:
        models["ridge_numeric_text_category"] = (fit_ridge, spec)
    return models


def with_label(df: DataFrame, target: str) -> DataFrame:
    return df.withColumn("label", log_target(F.col(target)))


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The kept columns with the prediction on the log scale and on the scale of the target."""
    return model.transform(df).select(
        *keep,
        F.col("prediction").cast("double").alias("predicted_target_log"),
        unlog_target(F.col("prediction")).alias("predicted_target"),
    )


def compare_models(
    train: DataFrame, test: DataFrame, models: Mapping[str, tuple[Fit, FeatureSpec]], key: str, target: str
) -> tuple[DataFrame, dict[str, str]]:
    """Metrics per model on the test rows, and the error text of each model that failed.

    The loop is over a handful of candidates. Every candidate is fitted and scored in its own attempt,
    so one failure does not stop the others: it gives a row with its reason in ``error`` and no figures.
    Candidates with the same numeric columns share their medians and scaling.
    """
    scored, errors, numeric = [], {}, {}
    for name, (fit, spec) in models.items():
        try:
            if spec.numeric not in numeric:
                numeric[spec.numeric] = fit_numeric(train, spec.numeric)
            model = fit(train, spec, numeric=numeric[spec.numeric])
            rows = score(model, test, [key, target, "label"]).withColumn("model_name", F.lit(name))
            scored.append(materialize(rows))
        except Exception as error:  # any candidate may fail for its own reason
            errors[name] = f"{type(error).__name__}: {error}"
    if not scored:
        raise RuntimeError(f"no model could be trained: {errors}")
    predictions = scored[0]
    for rows in scored[1:]:
        predictions = predictions.unionByName(rows)
    metrics = evaluate_predictions(
        predictions, key, target, "predicted_target", "label", "predicted_target_log", ["model_name"]
    ).withColumn("error", F.lit(None).cast("string"))
    if errors:
        failed = metrics.sparkSession.createDataFrame(sorted(errors.items()), "model_name string, error string")
        metrics = metrics.unionByName(failed, allowMissingColumns=True)
    return metrics, errors


# Columns of the input that prediction tables carry along.
CARRIED = (
    "clothing_id",
    "title",
    "review_text",
    "rating",
    "recommended_ind",
    "division_name",
    "department_name",
    "class_name",
)


def prediction_table(
    model: PipelineModel,
    df: DataFrame,
    key: str,
    target: str,
    model_name: str,
    carried: Sequence[str] = CARRIED,
    source: DataFrame | None = None,
) -> DataFrame:
    """Scores, errors and ranks of all rows next to the carried columns of the input.

    Ranks are formed on keys and scores alone; the carried columns, which may hold whole texts, join in by key. They come
    from ``source`` where the scored rows do not have them.
    """
    source = df if source is None else source
    extra = [c for c in carried if c in source.columns]
    scores = materialize(score(model, df, [key, target]))
    actual = F.col(target).cast("double")
    ranked = add_predicted_ranks(scores, "predicted_target", key).select(
        F.col(key).alias("row_index"),
        actual.alias("actual_target"),
        "predicted_target",
        "predicted_target_log",
        (actual - F.col("predicted_target")).alias("residual"),
        F.abs(actual - F.col("predicted_target")).alias("abs_error"),
        "predicted_rank",
        "predicted_percentile",
        F.lit(model_name).alias("model_name"),
        F.lit("all_valid_rows").alias("prediction_scope"),
    )
    if not extra:
        return ranked
    return ranked.join(source.select(F.col(key).alias("row_index"), *extra), "row_index")
