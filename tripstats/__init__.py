"""Trip, station, weather and city-event analytics on Spark DataFrames."""
