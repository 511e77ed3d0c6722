"""Names, formats and constants that results depend on.

Everything here is part of the public input formats (file headers, JSON field
names) or of the definition of a report (thresholds, labels).  Every constant is
the default of a parameter of the operator that uses it.
"""

# --- Fixed values: trip file, header order -------------------------------------
TRIP_FILE_SCHEMA = """
    tripduration INT,
    starttime TIMESTAMP,
    stoptime TIMESTAMP,
    `start station id` INT,
    `start station name` STRING,
    `start station latitude` FLOAT,
    `start station longitude` FLOAT,
    `end station id` INT,
    `end station name` STRING,
    `end station latitude` FLOAT,
    `end station longitude` FLOAT,
    bikeid INT,
    usertype STRING,
    `birth year` INT,
    gender INT
"""

TRIP_NAMES = {
    "tripduration": "trip_duration",
    "starttime": "start_time",
    "stoptime": "stop_time",
    "start station id": "start_station_id",
    "start station name": "start_station_name",
    "start station latitude": "start_station_latitude",
    "start station longitude": "start_station_longitude",
    "end station id": "end_station_id",
    "end station name": "end_station_name",
    "end station latitude": "end_station_latitude",
    "end station longitude": "end_station_longitude",
    "bikeid": "bike_id",
    "usertype": "user_type",
    "birth year": "birth_year",
    "gender": "gender",
}

# --- Fixed values: station snapshot document -----------------------------------
STATION_SNAPSHOT_SCHEMA = """
    executionTime STRING,
    stationBeanList ARRAY<STRUCT<
        altitude: STRING,
        availableBikes: BIGINT,
        availableDocks: BIGINT,
        city: STRING,
        id: BIGINT,
        landMark: STRING,
        lastCommunicationTime: STRING,
        latitude: FLOAT,
        location: STRING,
        longitude: FLOAT,
        postalCode: STRING,
        stAddress1: STRING,
        stAddress2: STRING,
        stationName: STRING,
        statusKey: BIGINT,
        statusValue: STRING,
        testStation: BOOLEAN,
        totalDocks: BIGINT>>
"""

STATION_NAMES = {
    "stationName": "station_name",
    "availableBikes": "available_bikes",
    "availableDocks": "available_docks",
    "totalDocks": "total_docks",
    "landMark": "landmark",
    "postalCode": "postal_code",
    "stAddress1": "st_address1",
    "stAddress2": "st_address2",
    "lastCommunicationTime": "last_communication_time",
    "statusValue": "status_value",
    "statusKey": "status_key",
    "testStation": "test_station",
}

# The stream keeps six fields of each record; executionTime stamps the document.
STATION_STATUS_SCHEMA = """
    executionTime STRING,
    stationBeanList ARRAY<STRUCT<
        id: INT,
        stationName: STRING,
        availableBikes: INT,
        latitude: FLOAT,
        longitude: FLOAT,
        availableDocks: INT>>
"""

# --- Fixed values: weather documents -------------------------------------------
NEARBY_SITES_SCHEMA = "output STRUCT<data: ARRAY<STRUCT<id: STRING, name: STRING, distance: STRING>>>"

WEATHER_SITE_SCHEMA = """
    data STRUCT<
        id: STRING,
        name: STRING,
        country: STRUCT<code: STRING, name: STRING>,
        region: STRING,
        wmo: STRING,
        icao: STRING,
        iata: STRING,
        latitude: STRING,
        longitude: STRING,
        elevation: STRING,
        time_zone: STRING>
"""

WEATHER_HOURS_SCHEMA = """
    id STRING,
    name STRING,
    latitude FLOAT,
    longitude FLOAT,
    data ARRAY<STRUCT<
        time: STRING,
        time_local: STRING,
        temperature: FLOAT,
        dewpoint: FLOAT,
        humidity: INT,
        precipitation: FLOAT,
        precipitation_3: FLOAT,
        precipitation_6: FLOAT,
        snowdepth: FLOAT,
        windspeed: FLOAT,
        peakgust: FLOAT,
        winddirection: INT,
        pressure: INT,
        condition: INT>>
"""

SNAPSHOT_TIME_FORMATS = ("yyyy-MM-dd hh:mm:ss a", "yyyy-MM-dd HH:mm:ss")
WEATHER_TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm")
WEATHER_MEASURES = ("temperature", "precipitation", "humidity", "dewpoint", "windspeed")

# --- Fixed values: public event file -------------------------------------------
EVENT_NAMES = {
    "Event ID": "event_id",
    "Event Name": "event_name",
    "Start Date/Time": "start_date_time",
    "End Date/Time": "end_date_time",
    "Event Agency": "event_agency",
    "Event Type": "event_type",
    "Event Borough": "event_borough",
    "Event Location": "event_location",
}

# --- Fixed values: report definitions ------------------------------------------
EARTH_RADIUS_KM = 6371
REFERENCE_YEAR = 2019
FIRST_TRAINING_YEAR = 2017
USER_TYPES = ("Subscriber", "Customer")
GENDER_UNKNOWN, GENDER_MALE, GENDER_FEMALE = 0, 1, 2
TOP_K = 20
BUSY_TRIPS_PER_HOUR = 150
EVENT_RADIUS_KM = 4
TRAINING_FRACTION = 0.75
SEASONS = {"Spring": (3, 5), "Summer": (6, 8), "Fall": (9, 11)}
OTHER_SEASON = "Winter"

# --- Fixed values: row keys of the stored tables -------------------------------
TRIP_KEY = ("start_station_id", "bike_id", "start_time")
STATION_KEY = ("id",)
WEATHER_SITE_KEY = ("id",)
WEATHER_HOUR_KEY = ("id", "time")
EVENT_KEY = ("event_id", "start_date_time")
PREDICTION_KEY = ("start_station_id", "start_date", "start_hour")
STATION_STATUS_KEY = ("station_name",)

# --- Fixed values: report tables and their row keys ----------------------------
REPORT_KEYS = {
    "total_trips": ("total_bikes",),
    "distinct_bikes": ("number_of_bikes",),
    "start_trip_top_20": ("start_station_name",),
    "end_trip_top_20": ("end_station_name",),
    "average_trip_user_type": ("user_type",),
    "start_to_end_top_20": ("user_type", "route"),
    "trips_age": ("age",),
    "trip_duration_age": ("age",),
    "grouped_count": ("start_year", "start_month"),
    "percentage_change": ("year", "month"),
    "grouped_count_season": ("start_year", "start_month", "start_hour"),
    "avg_temp": ("temperature",),
    "phmd": ("precipitation", "humidity"),
    "windspeed": ("windspeed",),
}
