"""Public events: locating them, and finding those near busy stations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.fixed_values import BUSY_TRIPS_PER_HOUR, EVENT_NAMES, EVENT_RADIUS_KM
from tripstats.functions.parsing import split_coordinates
from tripstats.operators.lookup import BROADCAST_BYTES, SALTS, lookup_join
from tripstats.operators.radius import within_radius
from tripstats.workspace import checkpointed


def event_locations(events: DataFrame) -> DataFrame:
    """The distinct location texts, to be looked up by a geocoder."""
    return events.select("event_location").distinct()


def parse_geocodes(geocoded: DataFrame) -> DataFrame:
    """``event_location`` and ``geocode`` text to locations with coordinates; those
    the geocoder did not find are left out."""
    latitude, longitude = split_coordinates(F.col("geocode"))
    placed = geocoded.select(
        "event_location", latitude.alias("latitude"), longitude.alias("longitude")
    )
    return placed.dropna(subset=["latitude", "longitude"])


def locate_events(
    events: DataFrame,
    locations: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Events without repeated rows, with the coordinates of their location.

    ``locations`` has ``event_location``, ``latitude`` and ``longitude``; of several rows
    of one text the least place counts.  Events at unknown places are left out.
    """
    known = locations.select("event_location", "latitude", "longitude").dropna()
    place = F.min(F.struct("latitude", "longitude")).alias("place")
    known = known.groupBy("event_location").agg(place).select("event_location", "place.*")
    unique = events.dropDuplicates()
    return lookup_join(unique, known, ["event_location"], events.columns, broadcast_bytes, salts)


def event_table(located_events: DataFrame) -> DataFrame:
    """The stored form of located events: fixed columns, the id a whole number and the
    coordinates numbers.  What is none becomes null."""
    texts = [name for name in EVENT_NAMES.values() if name != "event_id"]
    return located_events.select(
        F.col("event_id").try_cast("int").alias("event_id"),
        *texts,
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"),
    )


def busy_station_hours(trips: DataFrame, min_trips: int = BUSY_TRIPS_PER_HOUR) -> DataFrame:
    """Arrivals per end station, date and hour, where there are at least ``min_trips``.

    Date and hour are those of the start of the trip.
    """
    start = F.col("start_time")
    arrivals = trips.groupBy(
        "end_station_id",
        "end_station_latitude",
        "end_station_longitude",
        F.to_date(start).alias("date"),
        F.hour(start).alias("hour"),
    ).count()
    return arrivals.filter(F.col("count") >= min_trips)


def events_near_busy_stations(
    trips: DataFrame,
    events: DataFrame,
    min_trips: int = BUSY_TRIPS_PER_HOUR,
    km: float = EVENT_RADIUS_KM,
    **tuning,
) -> DataFrame:
    """Busy station-hours with each event less than ``km`` away, on any date.

    Distances are those of distinct places, so a station with many busy hours is measured
    once.  Repeated events are removed before the join; station-hours are unique as it
    is, so the far larger result needs no second look for repeated rows.
    """
    # Read twice below, and far fewer than the trips.
    busy = checkpointed(busy_station_hours(trips, min_trips))
    places = events.select(
        "event_id",
        "event_name",
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"),
    ).distinct()
    ends = ["end_station_latitude", "end_station_longitude"]
    near = within_radius(
        busy.select(*ends).distinct(),
        places.select("latitude", "longitude").distinct(),
        km,
        left_point=tuple(ends),
        salt_by=ends,
        **tuning,
    )
    found = near.join(places, ["latitude", "longitude"])
    return busy.join(found, ends)
