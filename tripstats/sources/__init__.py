"""Readers with fixed schemas; every column gets its canonical name."""

from tripstats.sources.events import read_events
from tripstats.sources.stations import read_snapshot_stream, read_station_snapshot
from tripstats.sources.tables import read_table
from tripstats.sources.trips import read_trips
from tripstats.sources.weather import read_nearby_sites, read_weather_hours, read_weather_sites

__all__ = [
    "read_events",
    "read_nearby_sites",
    "read_snapshot_stream",
    "read_station_snapshot",
    "read_table",
    "read_trips",
    "read_weather_hours",
    "read_weather_sites",
]
