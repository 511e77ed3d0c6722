"""All reports from one reading of the trips.

The trips are grouped by several sets of columns at once (grouping sets): Spark expands a trip into one
row a set and combines them inside each task, so the shuffle carries groups, not trips.  The groups
of a set are its cells.  A cell holds sums, from which coarser groups follow: months and the total come
from the hours, user types from the routes.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstats.fixed_values import GENDER_FEMALE, GENDER_MALE, GENDER_UNKNOWN, TOP_K, USER_TYPES
from tripstats.plans import usage

# Column sets of the cells; each has a column that no other set has, which names it.
_PLACE = ("station_name", "station_latitude", "station_longitude")
SETS: dict[str, tuple[str, list[str]]] = {
    "bike": ("bike_id", ["bike_id"]),
    "start": ("start_station_latitude", [f"start_{c}" for c in _PLACE]),
    "end": ("end_station_latitude", [f"end_{c}" for c in _PLACE]),
    "route": ("user_type", ["user_type", "start_station_name", "end_station_name"]),
    "age": ("age", ["age"]),
    "hour": ("start_hour", ["start_year", "start_month", "start_hour"]),
    "temperature": ("temperature", ["temperature"]),
    "precipitation": ("precipitation", ["precipitation", "humidity"]),
    "windspeed": ("windspeed", ["windspeed"]),
}
_MEASURES = ("temperature", "precipitation", "humidity", "windspeed")


def trip_cells(trips: DataFrame) -> DataFrame:
    """One row for each group of each set: ``cell`` (the set), the columns of all sets, ``n`` trips, ``timed`` trips
    with a duration, the sum of ``duration``, and trips by gender.

    Missing weather counts as 0, as in the weather reports.
    """
    columns = list(dict.fromkeys(c for _, names in SETS.values() for c in names))
    trips = trips.select(*columns, "trip_duration", "gender").fillna(0, subset=list(_MEASURES))

    def of_gender(code) -> Column:
        return F.count_if(F.col("gender") == code)

    cell = F.coalesce(
        *(F.when(F.grouping(own) == 0, F.lit(name)) for name, (own, _) in SETS.items())
    )
    sets = [[F.col(c) for c in names] for _, names in SETS.values()]
    return trips.groupingSets(sets, *columns).agg(
        cell.alias("cell"),
        F.count(F.lit(1)).alias("n"),
        F.count("trip_duration").alias("timed"),
        F.sum("trip_duration").alias("duration"),
        of_gender(GENDER_MALE).alias("males"),
        of_gender(GENDER_FEMALE).alias("females"),
        of_gender(GENDER_UNKNOWN).alias("unknown"),
    )


def reports(
    cells: DataFrame, k: int = TOP_K, user_types: tuple[str, ...] = USER_TYPES
) -> dict[str, DataFrame]:
    """The report tables by name, equal to those of ``usage`` and ``weather_profiles``; of stations that share
    a name, and routes that share a text, the busiest stays."""

    def of(name: str) -> DataFrame:
        return cells.where(F.col("cell") == name)

    trips = F.col("n").alias("number_of_trips")
    mean = _mean("timed").alias("average_duration")
    months = of("hour").groupBy("start_year", "start_month").agg(F.sum("n").alias("count"))
    total = F.coalesce(F.sum("n"), F.lit(0)).alias("total_bikes")
    types = of("route").where(F.col("user_type").isin(*user_types)).groupBy("user_type").agg(
        F.sum("n").alias("number_of_trips"), F.sum("timed").alias("timed"), F.sum("duration").alias("duration")
    )
    routes = of("route").select("user_type", "start_station_name", "end_station_name", trips, mean)
    ages = of("age")
    # Trips with unknown duration count, as if it were 0.
    profile = (trips, F.coalesce(_mean("n"), F.lit(0.0)).alias("average_duration"))
    return {
        "total_trips": of("hour").agg(total),
        "distinct_bikes": of("bike").agg(F.count("bike_id").alias("number_of_bikes")),
        "start_trip_top_20": usage.busiest_stations(of("start").select(*SETS["start"][1], trips), "start", k, True),
        "end_trip_top_20": usage.busiest_stations(of("end").select(*SETS["end"][1], trips), "end", k, True),
        "average_trip_user_type": types.select("user_type", "number_of_trips", mean),
        "start_to_end_top_20": usage.busiest_routes(routes, k, True),
        "trips_age": ages.select("age", F.col("n").alias("total_count"), "males", "females", "unknown"),
        "trip_duration_age": ages.select("age", _mean("timed").alias("avg_trip_duration")),
        "grouped_count": months,
        "grouped_count_season": usage.with_season(of("hour").withColumn("count", F.col("n"))),
        "avg_temp": of("temperature").select("temperature", *profile),
        "phmd": of("precipitation").select("precipitation", "humidity", *profile),
        "windspeed": of("windspeed").select("windspeed", *profile),
    }


def _mean(count: str) -> Column:
    return F.try_divide(F.col("duration").cast("double"), F.col(count).cast("double"))
