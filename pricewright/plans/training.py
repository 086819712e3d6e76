"""The linear price model from search to saved pipeline."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..operators.ledger import Ledger, Run
from ..operators.metrics import METRICS, evaluate
from ..operators.split import fold_of
from ..operators.tuning import (
    Moments,
    best_of,
    cross_validate,
    cross_validate_linear,
    fold_moments,
    param_grid,
)
from .pipelines import (
    ELASTIC_NET_PARAMS,
    FOLDS,
    LABEL,
    LINEAR_DEFAULTS,
    LINEAR_FEATURES,
    LOG_COLUMNS,
    REG_PARAMS,
    linear_features,
    linear_pipeline,
    linear_regression,
)


@dataclass
class Trained:
    model: PipelineModel
    params: dict
    scores: list[dict]
    metrics: DataFrame


def linear_grid() -> list[dict]:
    return param_grid(regParam=REG_PARAMS, elasticNetParam=ELASTIC_NET_PARAMS)


def linear_moments(prepared: PipelineModel, df: DataFrame, folds: int = FOLDS) -> Moments:
    """Moments per fold of the feature vector of the linear model."""
    vectors = prepared.transform(df.withColumn("fold", fold_of(folds))).select(
        "fold", LABEL, vector_to_array("features").alias("v")
    )
    columns = [F.col("v")[i].alias(c) for i, c in enumerate(LINEAR_FEATURES)]
    return fold_moments(vectors.select("fold", LABEL, *columns), LINEAR_FEATURES, LABEL, "fold")


def model_columns(train: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The columns the linear model reads: what is worth caching for its fits."""
    columns = [*keep, "Date", LABEL, "type", *LOG_COLUMNS]
    return train.select(*[F.col(f"`{c}`") for c in columns])


def fit_features(train: DataFrame, keep: Sequence[str] = ()) -> PipelineModel:
    """Fit the feature stages; the source is read, and its dates parsed, once for all of them."""
    project, *learned = linear_features(keep).getStages()
    rows = project.transform(model_columns(train, keep)).persist()
    try:
        return PipelineModel(stages=[project, *Pipeline(stages=learned).fit(rows).stages])
    finally:
        rows.unpersist()


def fit_linear(train: DataFrame, keep: Sequence[str] = (), **params) -> PipelineModel:
    """Fit features and regressor; the source is read, and its dates parsed, once for all stages."""
    features, regressor = linear_pipeline(keep, **params).getStages()
    project, *learned = features.getStages()
    rows = project.transform(model_columns(train, keep)).persist()
    try:
        fitted = Pipeline(stages=[*learned, regressor]).fit(rows).stages
    finally:
        rows.unpersist()
    return PipelineModel(stages=[PipelineModel(stages=[project, *fitted[:-1]]), fitted[-1]])


def search(train: DataFrame, folds: int = FOLDS) -> tuple[PipelineModel, list[dict]]:
    """Fit the features, then score the whole grid.

    With at most two types the index is affine whatever order a fold gives it,
    so one pass of moments is enough. More types can change places between
    folds; then the whole pipeline is refitted in every fold.
    """
    rows = train.withColumn("fold", fold_of(folds))
    prepared = linear_features(keep=["fold"]).fit(rows)
    if len(prepared.stages[1].labels) > 2:
        return prepared, cross_validate(
            linear_features(keep=["fold"]), linear_regression, linear_grid(), rows, LABEL, folds=folds)
    return prepared, cross_validate_linear(linear_moments(prepared, train, folds), linear_grid())


def train_linear(
    train: DataFrame,
    test: DataFrame,
    ledger: Ledger | None = None,
    experiment: str = "linear price model",
    folds: int = FOLDS,
) -> Trained:
    """Search the grid by cross-validation, refit the best, score it on ``test``.

    What the ledger gets are the parameters and metrics of the model that is
    returned and saved.
    """
    rows = model_columns(train, ["bucket"]).persist()
    try:
        _, scores = search(rows, folds)
        best = best_of(scores)
        params = {
            **LINEAR_DEFAULTS,
            "regParam": best["regParam"], "elasticNetParam": best["elasticNetParam"],
        }
        prepared = linear_features().fit(rows)
        regressor = linear_regression(**params).fit(prepared.transform(rows))
    finally:
        rows.unpersist()
    model = PipelineModel(stages=[prepared, regressor])
    metrics = evaluate(model.transform(test), LABEL, "prediction")
    if ledger is not None:
        row = metrics.first()
        run = Run(experiment, "cross-validated search", params={**params, "numFolds": folds})
        run.finish(avg_rmse=best["avg_rmse"], **{m: row[m] for m in METRICS})
        ledger.log_model(run, model)
        ledger.append(run)
    return Trained(model, params, scores, metrics)

