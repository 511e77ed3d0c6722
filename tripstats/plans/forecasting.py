"""Tree models of next-hour demand."""

import functools
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.fixed_values import PREDICTION_KEY, TRAINING_FRACTION
from tripstats.operators.split import split_by_key
from tripstats.plans.demand import WEATHER_KEYS
from tripstats.workspace import checkpointed

LABEL = "number_of_trips"
FEATURES = ("start_station_id", "weekday", "weekend", "start_hour", "start_month", "past_trips")
METRICS = ("r2", "rmse")
_REGRESSORS = {
    "decision_tree": DecisionTreeRegressor,
    "gradient_boosted_trees": GBTRegressor,
    "random_forest": RandomForestRegressor,
}


class Forecast(NamedTuple):
    models: dict[str, PipelineModel]
    predictions: dict[str, DataFrame]
    metrics: DataFrame


def assembler(columns: list[str]) -> VectorAssembler:
    """Feature vectors of complete rows; a row with a null feature stops the job."""
    return VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="error")


def pipelines(with_weather: bool = False, seed: int = 0) -> dict[str, Pipeline]:
    """An unfitted pipeline per model, all with default settings."""
    columns = [*FEATURES, *WEATHER_KEYS] if with_weather else [*FEATURES]
    return {
        name: Pipeline(
            stages=[
                assembler(columns),
                regressor(featuresCol="features", labelCol=LABEL, seed=seed),
            ]
        )
        for name, regressor in _REGRESSORS.items()
    }


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``rows`` with the prediction, without the feature vector and the weather."""
    return model.transform(rows).drop("features", *WEATHER_KEYS)


def evaluate(predictions: dict[str, DataFrame]) -> DataFrame:
    """One row per model and metric, from one pass over each model's rows.

    r2 is 1 - squared errors / squared distances from the mean label, rmse the root of the
    mean squared error.
    """
    error, label = F.col("prediction") - F.col(LABEL), F.col(LABEL).cast("double")
    measured = [
        scored.agg(
            (1 - F.avg(error * error) / F.var_pop(label)).alias("r2"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
        ).select(
            F.lit(name).alias("model"),
            F.inline(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS))),
        )
        for name, scored in predictions.items()
    ]
    return functools.reduce(DataFrame.unionByName, measured)


def forecast_demand(
    rows: DataFrame,
    with_weather: bool = False,
    fraction: float = TRAINING_FRACTION,
    seed: int = 0,
) -> Forecast:
    """Fit the three models on one part of the rows and score the other.

    Fitting reads the rows many times, so they are first stored in the shared
    folder: a lost executor costs a read of its share, not another pass over the
    trips.  So are the predictions, which are measured and stored.
    """
    train, validation = split_by_key(checkpointed(rows), list(PREDICTION_KEY), fraction)
    models = {name: p.fit(train) for name, p in pipelines(with_weather, seed).items()}
    predictions = {
        name: checkpointed(predict(model, validation)) for name, model in models.items()
    }
    return Forecast(models, predictions, evaluate(predictions))
