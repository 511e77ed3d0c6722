import random

import pytest
from pyspark.sql import functions as F

from tripstats.fixed_values import PREDICTION_KEY
from tripstats.plans import forecasting


@pytest.fixture(scope="module")
def demand_rows(spark):
    """Demand that follows the hour, so that trees can learn it."""
    rng = random.Random(3)
    data = []
    for station in range(6):
        for day in range(1, 15):
            for hour in range(23):
                level = 20 if 7 <= hour < 10 else 3
                data.append(
                    (station, f"2019-06-{day:02d}", hour, 6, day % 7 // 5, 1 - day % 7 // 5,
                     20.0, 50, 3.0, level + rng.randrange(3), level + station + rng.randrange(3))
                )
    return spark.createDataFrame(
        data,
        "start_station_id int, start_date string, start_hour int, start_month int, weekday int, "
        "weekend int, temperature double, humidity int, windspeed double, past_trips long, "
        "number_of_trips long",
    )


def test_forecast_learns_scores_and_repeats(demand_rows, rows):
    plain = demand_rows.drop("temperature", "humidity", "windspeed")
    first = forecasting.forecast_demand(plain)
    again = forecasting.forecast_demand(plain.repartition(5))
    found = rows(first.metrics)
    assert [(model, metric) for model, metric, _ in found] == [
        ("decision_tree", "r2"),
        ("decision_tree", "rmse"),
        ("gradient_boosted_trees", "r2"),
        ("gradient_boosted_trees", "rmse"),
        ("random_forest", "r2"),
        ("random_forest", "rmse"),
    ]
    assert all(value > 0.8 for _, metric, value in found if metric == "r2")
    for (_, _, a), (_, _, b) in zip(found, rows(again.metrics)):
        assert a == pytest.approx(b, rel=0.1)

    total = plain.count()
    for scored in first.predictions.values():
        assert set(scored.columns) == {*plain.columns, "prediction"}
        assert 0.15 * total < scored.count() < 0.35 * total
        assert scored.select(*PREDICTION_KEY).distinct().count() == scored.count()


def test_weather_features_are_used_and_dropped(demand_rows):
    result = forecasting.forecast_demand(demand_rows, with_weather=True)
    assembler = result.models["decision_tree"].stages[0]
    assert assembler.getInputCols()[-3:] == ["temperature", "humidity", "windspeed"]
    assert "temperature" not in result.predictions["decision_tree"].columns


def test_rows_are_stored_in_the_shared_folder(spark, demand_rows):
    from tripstats.workspace import checkpointed, scratch_path, shared_folder

    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(folder)
    stored = checkpointed(demand_rows)
    assert "Scan ExistingRDD" in stored._jdf.queryExecution().executedPlan().toString()
    assert folder in spark.sparkContext.getCheckpointDir()
    assert stored.count() == demand_rows.count()


def test_trees_without_a_split(spark):
    from pyspark.ml.regression import GBTRegressor

    from tripstats.plans import tree_nodes

    rows = spark.range(20).select("id", F.lit(1.0).alias("x"), F.lit(4.0).alias(forecasting.LABEL))
    model = GBTRegressor(labelCol=forecasting.LABEL, maxIter=3).fit(forecasting.assembler(["x"]).transform(rows))
    nodes = tree_nodes.node_table(spark, model)
    found = tree_nodes.predict_by_nodes(rows, nodes, ["x"], ["id"], *tree_nodes.size(model))
    assert {r.prediction for r in found.collect()} == {4.0} and found.count() == 20
