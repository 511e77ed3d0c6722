"""SQL twins of ``queries``, for an engine with the test tables as views."""


def _ends(end: str, number: str) -> str:
    return f"""
        {number} AS {end}_station_id,
        concat('Station ', {number}) AS {end}_station_name,
        40.5e0 + ({number} * 37 % 100) / 250e0 AS {end}_station_latitude,
        -74.2e0 + ({number} * 53 % 100) / 250e0 AS {end}_station_longitude"""


def _distance(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    h = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * pow(sin(radians({lng2} - {lng1}) / 2), 2))"
    )
    return f"2 * 6371 * atan2(sqrt({h}), sqrt(1 - {h}))"


def _year(time: str) -> str:
    return f"cast(year({time}) AS int)"


def _month(time: str) -> str:
    return f"cast(month({time}) AS int)"


def _hour(time: str) -> str:
    return f"cast(hour({time}) AS int)"


def _weekday(time: str) -> str:
    return f"CASE WHEN dayofweek({time}) BETWEEN 1 AND 5 THEN 1 ELSE 0 END"


def _weekend(time: str) -> str:
    return f"CASE WHEN dayofweek({time}) IN (0, 6) THEN 1 ELSE 0 END"


def _season(month: str) -> str:
    return (
        f"CASE WHEN {month} BETWEEN 3 AND 5 THEN 'Spring' WHEN {month} BETWEEN 6 AND 8 "
        f"THEN 'Summer' WHEN {month} BETWEEN 9 AND 11 THEN 'Fall' ELSE 'Winter' END"
    )


_TABLES = {
    "trips": f"""
        SELECT cast(floor(l_extendedprice) AS int) AS trip_duration, o_orderdate AS start_time,
               l_shipdate AS stop_time, {_ends("start", "l_suppkey")},
               {_ends("end", "(o_custkey % 50)")}, l_partkey AS bike_id,
               o_orderpriority AS user_type, 2019 - (1930 + o_custkey % 50) AS age,
               l_linenumber % 3 AS gender
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "line_trips": f"""
        SELECT cast(floor(l_extendedprice) AS int) AS trip_duration, l_shipdate AS start_time,
               {_ends("start", "l_suppkey")}, {_ends("end", "l_suppkey")},
               l_partkey AS bike_id, nullif(l_quantity, 1e0) AS temperature,
               nullif(l_discount, 0.03e0) AS precipitation,
               nullif(l_linenumber, 2) AS humidity, nullif(l_tax, 0.05e0) AS windspeed
        FROM lineitem""",
    "clock_trips": f"""
        SELECT cast(floor(value) AS int) AS trip_duration, ts AS start_time, {_ends("start", "user_id")},
               {_ends("end", "(user_id % 7)")}, event_id AS bike_id,
               cast(2019 - (1950 + user_id % 50) AS int) AS age
        FROM events""",
    "stations": """
        SELECT s_suppkey AS id, 40.5e0 + (s_suppkey * 37 % 100) / 250e0 AS latitude,
               -74.2e0 + (s_suppkey * 53 % 100) / 250e0 AS longitude
        FROM supplier""",
    "rider_stations": """
        SELECT c_custkey AS id, 40.5e0 + (c_custkey * 7919 % 10007) / 25000e0 AS latitude,
               -74.2e0 + (c_custkey * 6151 % 10009) / 25000e0 AS longitude, c_mktsegment
        FROM customer""",
    "sites": """
        SELECT cast(n_nationkey AS varchar) AS id,
               40.5e0 + (n_nationkey * 11 % 25) / 60e0 AS latitude,
               -74.2e0 + (n_nationkey * 7 % 25) / 60e0 AS longitude
        FROM nation""",
    "weather": """
        SELECT cast(user_id % 25 AS varchar) AS id, date_trunc('hour', ts) AS observed,
               max(value) AS temperature, min(value) AS precipitation,
               cast(count(*) AS int) AS humidity, cast(max(event_id) AS double) AS dewpoint,
               cast(min(event_id) AS double) AS windspeed
        FROM events GROUP BY ALL""",
    "city_events": """
        SELECT cast(event_id % 500 AS varchar) AS event_id, event_type AS event_name,
               strftime(ts, '%Y-%m-%d') AS start_date_time,
               strftime(ts, '%Y-%m-%d') AS end_date_time, 'Parks' AS event_agency,
               event_type, 'Bronx' AS event_borough,
               concat('Place ', user_id) AS event_location
        FROM events""",
}


def _with(*names: str, **extra: str) -> str:
    parts = {name: _TABLES[name] for name in names} | extra
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items())


def _change(denominator: str) -> str:
    return f"""
        {_with("trips", counts=f'''
            SELECT {_year("start_time")} AS y, {_month("start_time")} AS m, count(*) AS n
            FROM trips GROUP BY ALL''')}
        SELECT c.m AS month, c.y AS year,
               (c.n - p.n) / cast({denominator}.n AS double) * 100 AS percentage_change
        FROM counts c JOIN counts p ON c.m = p.m + 1 AND c.y = p.y"""


def _profile(*measures: str) -> str:
    filled = ", ".join(f"coalesce({m}, 0) AS {m}" for m in measures)
    return f"""
        {_with("line_trips")}
        SELECT {filled}, count(*) AS number_of_trips,
               avg(trip_duration) AS average_duration
        FROM line_trips GROUP BY {", ".join(f"coalesce({m}, 0)" for m in measures)}"""


def _nearest(stations: str, sites: str, rank: str, order: str) -> str:
    far = _distance("a.latitude", "a.longitude", "b.latitude", "b.longitude")
    names = dict.fromkeys((stations, sites))
    return f"""
        {_with(*names, pairs=f'''
            SELECT a.id, b.id AS weather_station_id, {far} AS d
            FROM {stations} a CROSS JOIN {sites} b''', ranked=f'''
            SELECT *, {rank}() OVER (PARTITION BY id ORDER BY {order}) AS n FROM pairs''')}
        SELECT id, weather_station_id, round(d, 6) AS distance_km FROM ranked WHERE n = 1"""


_STATION_JOIN = f"""
    {_with("line_trips")}
    SELECT start_station_id, cast(s_nationkey AS varchar) AS weather_station_id,
           count(*) AS trips
    FROM line_trips JOIN supplier ON s_suppkey = start_station_id GROUP BY ALL"""

_HOURLY = f"""
    SELECT start_station_id, start_station_name, cast(start_time AS date) AS start_date,
           {_hour("start_time")} AS start_hour, {_month("start_time")} AS start_month,
           {_weekday("start_time")} AS weekday, {_weekend("start_time")} AS weekend,
           count(*) AS number_of_trips
    FROM clock_trips GROUP BY ALL"""

_PAIRS = """
    SELECT p.start_station_id, p.start_date, p.start_hour, p.start_month, p.weekday,
           p.weekend, p.number_of_trips AS past_trips, c.number_of_trips
    FROM hourly p JOIN hourly c
      ON p.start_station_id = c.start_station_id AND p.start_date = c.start_date
     AND p.start_hour = c.start_hour - 1"""

_WEATHER_TRIPS = f"""
    SELECT t.*, w.* EXCLUDE (id, observed), w.id AS weather_station_id
    FROM clock_trips t JOIN weather w
      ON cast(start_station_id % 25 AS varchar) = w.id AND date_trunc('hour', start_time) = w.observed"""

_DOCUMENTS = """
    SELECT event_id // 100 AS document, event_id, user_id, ts,
           row_number() OVER (PARTITION BY event_id // 100 ORDER BY event_id) - 1 AS position,
           max(ts) OVER (PARTITION BY event_id // 100) AS snapshot_time
    FROM events"""

_WEATHER_HOURLY = f"""
    SELECT start_station_id, start_station_name, cast(start_time AS date) AS start_date,
           {_hour("start_time")} AS start_hour, {_month("start_time")} AS start_month,
           {_weekday("start_time")} AS weekday, {_weekend("start_time")} AS weekend,
           temperature, humidity, windspeed, count(*) AS number_of_trips
    FROM joined GROUP BY ALL"""

_WEATHER_PAIRS = """
    SELECT p.start_station_id, p.start_date, p.start_hour, p.start_month, p.weekday,
           p.weekend, p.temperature, p.humidity, p.windspeed,
           p.number_of_trips AS past_trips, c.number_of_trips
    FROM hourly p JOIN hourly c
      ON p.start_station_id = c.start_station_id AND p.start_date = c.start_date
     AND p.start_hour = c.start_hour - 1"""

_MODELS = "(VALUES ('decision_tree'), ('gradient_boosted_trees'), ('random_forest')) AS models (model)"


def _text(*numbers: str) -> str:
    """Numbers as the JVM writes doubles of moderate size."""
    return "concat_ws('|', " + ", ".join(f"cast(round(cast({n} AS double), 6) AS varchar)" for n in numbers) + ")"


_PLAIN_FEATURES = ("start_station_id", "weekday", "weekend", "start_hour", "start_month", "past_trips")

ORACLES: dict[str, str] = {
    "total_trips": "SELECT count(*) AS total_bikes FROM lineitem",
    "total_trips_of_year": """
        SELECT count(*) AS total_bikes FROM lineitem WHERE year(l_shipdate) = 1999""",
    "distinct_bikes": "SELECT count(DISTINCT l_partkey) AS number_of_bikes FROM lineitem",
    "start_top20": f"""
        {_with("line_trips")}
        SELECT start_station_name, round(start_station_latitude, 6) AS start_station_latitude,
               round(start_station_longitude, 6) AS start_station_longitude,
               count(*) AS number_of_trips
        FROM line_trips GROUP BY ALL
        ORDER BY number_of_trips DESC, start_station_name LIMIT 20""",
    "end_top20": f"""
        {_with("trips")}
        SELECT end_station_name, round(end_station_latitude, 6) AS end_station_latitude,
               round(end_station_longitude, 6) AS end_station_longitude,
               count(*) AS number_of_trips
        FROM trips GROUP BY ALL ORDER BY number_of_trips DESC, end_station_name LIMIT 20""",
    "usertype_summary": f"""
        {_with("trips")}
        SELECT user_type, count(*) AS number_of_trips,
               avg(trip_duration) AS average_duration
        FROM trips WHERE user_type IN ('1-URGENT', '5-LOW') GROUP BY user_type""",
    "route_top20": f"""
        {_with("trips")}
        SELECT user_type, concat(start_station_name, ' to ', end_station_name) AS route,
               count(*) AS number_of_trips, avg(trip_duration) AS average_duration
        FROM trips GROUP BY user_type, start_station_name, end_station_name
        ORDER BY number_of_trips DESC, start_station_name, end_station_name, user_type
        LIMIT 20""",
    "trips_age": f"""
        {_with("trips")}
        SELECT cast(age AS int) AS age, count(*) AS total_count,
               count(CASE WHEN gender = 1 THEN 1 END) AS males,
               count(CASE WHEN gender = 2 THEN 1 END) AS females,
               count(CASE WHEN gender = 0 THEN 1 END) AS unknown
        FROM trips GROUP BY 1""",
    "duration_by_age": f"""
        {_with("trips")}
        SELECT cast(age AS int) AS age, avg(trip_duration) AS avg_trip_duration
        FROM trips GROUP BY 1""",
    "monthly_trips": f"""
        {_with("trips")}
        SELECT {_year("start_time")} AS start_year, {_month("start_time")} AS start_month,
               count(*) AS "count"
        FROM trips GROUP BY 1, 2""",
    "pct_change": _change("c"),
    "pct_change_of_previous": _change("p"),
    "season_hour": f"""
        {_with("clock_trips", counts=f'''
            SELECT {_year("start_time")} AS y, {_month("start_time")} AS m,
                   {_hour("start_time")} AS h, count(*) AS n
            FROM clock_trips GROUP BY ALL''')}
        SELECT y AS start_year, m AS start_month, n AS "count", {_season("m")} AS season,
               CASE WHEN h = 0 THEN '12AM' WHEN h < 12 THEN concat(h, 'AM')
                    WHEN h = 12 THEN '12PM' ELSE concat(h - 12, 'PM') END AS start_hour
        FROM counts""",
    "season_of_month": f"""
        SELECT {_year("l_shipdate")} AS year, {_season("month(l_shipdate)")} AS season,
               count(*) AS trips
        FROM lineitem GROUP BY 1, 2""",
    "fill0_by_measure": _profile("temperature"),
    "two_measures": _profile("precipitation", "humidity"),
    "by_windspeed": _profile("windspeed"),
    "by_windspeed_known": f"""
        {_with("line_trips")}
        SELECT windspeed, count(*) AS number_of_trips,
               avg(trip_duration) AS average_duration
        FROM line_trips WHERE windspeed IS NOT NULL GROUP BY windspeed""",
    "trip_features": f"""
        {_with("clock_trips")}
        SELECT bike_id, {_year("start_time")} AS start_year, {_month("start_time")} AS start_month,
               cast(dayofyear(start_time) AS int) AS day_of_year,
               {_hour("start_time")} AS start_hour, {_month("start_time")} AS stop_month,
               {_hour("start_time")} AS stop_hour, {_weekday("start_time")} AS weekday,
               {_weekend("start_time")} AS weekend, age
        FROM clock_trips""",
    "weekday_flags": f"""
        SELECT {_weekday("o_orderdate")} AS weekday, {_weekend("o_orderdate")} AS weekend,
               count(*) AS trips
        FROM orders GROUP BY 1, 2""",
    "dropna": """
        SELECT count(*) AS complete FROM events
        WHERE nullif(event_type, 'error') IS NOT NULL AND nullif(user_id, 3) IS NOT NULL""",
    "fill0": """
        SELECT event_id, nullif(event_type, 'error') AS event_type,
               coalesce(nullif(user_id, 3), 0) AS user_id
        FROM events""",
    "weather_times": f"""
        SELECT event_id, CASE WHEN event_id % 3 < 2 THEN {_hour("ts")} END AS hour,
               CASE WHEN event_id % 3 < 2 THEN cast(minute(ts) AS int) END AS minute,
               CASE event_id % 3 WHEN 0 THEN cast(second(ts) AS int) WHEN 1 THEN 0 END AS second
        FROM events""",
    "geocode_parts": f"""
        {_with("rider_stations")}
        SELECT concat('Place ', id) AS event_location, round(latitude, 6) AS latitude,
               round(longitude, 6) AS longitude
        FROM rider_stations WHERE id % 10 <> 0""",
    "station_join": _STATION_JOIN,
    "station_join_salted": _STATION_JOIN,
    "weather_join": f"""
        {_with("clock_trips", "weather", joined=_WEATHER_TRIPS)}
        SELECT bike_id, weather_station_id, temperature, precipitation, humidity, dewpoint,
               windspeed
        FROM joined""",
    "trip_enrichment": f"""
        {_with("clock_trips", "rider_stations", "sites", "weather", pairs=f'''
            SELECT a.id, b.id AS site,
                   {_distance("a.latitude", "a.longitude", "b.latitude", "b.longitude")} AS d
            FROM rider_stations a CROSS JOIN sites b''', nearest='''
            SELECT * FROM (SELECT *, rank() OVER (PARTITION BY id ORDER BY d) AS n FROM pairs)
            WHERE n = 1''')}
        SELECT bike_id, start_station_id, {_year("start_time")} AS start_year,
               {_month("start_time")} AS start_month,
               cast(dayofyear(start_time) AS int) AS day_of_year,
               {_hour("start_time")} AS start_hour, {_weekday("start_time")} AS weekday,
               {_weekend("start_time")} AS weekend, age, temperature, precipitation,
               humidity, dewpoint, windspeed
        FROM clock_trips JOIN nearest ON nearest.id = start_station_id
        JOIN weather ON weather.id = site AND observed = date_trunc('hour', start_time)""",
    "nearest_site": _nearest("stations", "sites", "rank", "d"),
    "nearest_site_first": _nearest("rider_stations", "sites", "row_number", "d, weather_station_id"),
    "nearest_of_many_sites": _nearest("stations", "rider_stations", "rank", "d"),
    "within_radius": f"""
        {_with("stations", "sites", pairs=f'''
            SELECT a.id, b.id AS site_id,
                   {_distance("a.latitude", "a.longitude", "b.latitude", "b.longitude")} AS d
            FROM stations a CROSS JOIN sites b''')}
        SELECT id, site_id, round(d, 6) AS distance_km FROM pairs WHERE d < 4""",
    "within_radius_fine": f"""
        {_with("rider_stations", pairs=f'''
            SELECT a.id, b.id AS place_event_id,
                   {_distance("a.latitude", "a.longitude", "b.latitude", "b.longitude")} AS d
            FROM rider_stations a CROSS JOIN rider_stations b''')}
        SELECT id, place_event_id, round(d, 6) AS distance_km FROM pairs WHERE d < 0.75""",
    "station_inflow": f"""
        {_with("clock_trips")}
        SELECT end_station_id, cast(start_time AS date) AS date, {_hour("start_time")} AS hour,
               count(*) AS "count"
        FROM clock_trips GROUP BY 1, 2, 3 HAVING count(*) >= 5""",
    "events_near_busy": f"""
        {_with("line_trips", "sites", busy='''
            SELECT end_station_id, end_station_latitude AS lat, end_station_longitude AS lng,
                   cast(start_time AS date) AS date, cast(hour(start_time) AS int) AS hour,
                   count(*) AS n
            FROM line_trips GROUP BY ALL HAVING count(*) >= 3''', pairs=f'''
            SELECT busy.*, id, {_distance("lat", "lng", "latitude", "longitude")} AS d
            FROM busy CROSS JOIN sites''')}
        SELECT DISTINCT end_station_id, date, hour, n AS "count", id AS event_id,
               concat('Event ', id) AS event_name, round(d, 6) AS distance_km
        FROM pairs WHERE d < 4""",
    "event_lookup": f"""
        {_with("city_events", "rider_stations")}
        SELECT DISTINCT e.* REPLACE (cast(event_id AS int) AS event_id),
               round(latitude, 6) AS latitude, round(longitude, 6) AS longitude
        FROM city_events e JOIN rider_stations ON event_location = concat('Place ', id)
        WHERE id % 10 <> 0""",
    "event_places": "SELECT DISTINCT concat('Place ', user_id) AS event_location FROM events",
    "hourly_demand": f"{_with('clock_trips')} {_HOURLY}",
    "lag_demand": f"""
        {_with("clock_trips", hourly=_HOURLY, pairs=_PAIRS)}
        SELECT * FROM pairs""",
    "scored_rows": f"""
        {_with("clock_trips", hourly=_HOURLY, pairs=_PAIRS, hashed='''
            SELECT *, md5(concat(start_station_id, '|', start_date, '|', start_hour)) AS digest
            FROM pairs''')}
        SELECT hashed.* EXCLUDE (digest), model
        FROM hashed CROSS JOIN (VALUES ('decision_tree'), ('gradient_boosted_trees'),
                                       ('random_forest')) AS models (model)
        WHERE cast(concat('0x', substr(digest, 1, 4)) AS int) >= 49152""",
    "lag_demand_weather": f"""
        {_with("clock_trips", "weather", joined=_WEATHER_TRIPS, hourly=f'''
            SELECT start_station_id, start_station_name, cast(start_time AS date) AS start_date,
                   {_hour("start_time")} AS start_hour, {_month("start_time")} AS start_month,
                   {_weekday("start_time")} AS weekday, {_weekend("start_time")} AS weekend,
                   temperature, humidity, windspeed, count(*) AS number_of_trips
            FROM joined GROUP BY ALL''')}
        SELECT p.start_station_id, p.start_date, p.start_hour, p.start_month, p.weekday,
               p.weekend, p.temperature, p.humidity, p.windspeed,
               p.number_of_trips AS past_trips, c.number_of_trips
        FROM hourly p JOIN hourly c
          ON p.start_station_id = c.start_station_id AND p.start_date = c.start_date
         AND p.start_hour = c.start_hour - 1""",
    "key_split": f"""
        {_with("clock_trips", hourly=_HOURLY, hashed='''
            SELECT md5(concat(start_station_id, '|', start_date, '|', start_hour)) AS digest
            FROM hourly''')}
        SELECT cast(concat('0x', substr(digest, 1, 4)) AS int) < 49152 AS train,
               count(*) AS rows
        FROM hashed GROUP BY 1""",
    "upsert_latest": """
        SELECT user_id, event_id, event_type FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n
            FROM events)
        WHERE n = 1""",
    "keyed_table": """
        SELECT user_id, event_id, value FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n
            FROM events)
        WHERE n = 1""",
    "partitioned_table": f"""
        SELECT l_suppkey, {_year("l_shipdate")} AS ship_year, {_month("l_shipdate")} AS ship_month,
               max(l_orderkey) AS l_orderkey,
               arg_max(l_linenumber, (l_orderkey, l_linenumber)) AS l_linenumber
        FROM lineitem GROUP BY 1, 2, 3""",
    "trips_csv": f"""
        SELECT cast(l_suppkey AS int) AS start_station_id, {_year("l_shipdate")} AS start_year,
               cast(2019 - (1940 + p_size) AS int) AS age, count(*) AS trips,
               cast(sum(cast(floor(l_extendedprice) AS bigint)) AS bigint) AS seconds
        FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE p_size NOT IN (7, 10) GROUP BY 1, 2, 3""",
    "events_csv": f"""
        {_with("city_events", listed="SELECT DISTINCT * FROM city_events")}
        SELECT event_id, event_location, count(*) AS listed FROM listed GROUP BY 1, 2""",
    "events_csv_inferred": f"""
        {_with("city_events", listed="SELECT DISTINCT * FROM city_events")}
        SELECT cast(event_id AS int) AS event_id,
               cast(year(cast(start_date_time AS date)) AS int) AS year, count(*) AS listed
        FROM listed GROUP BY 1, 2""",
    "station_snapshot": """
        SELECT user_id AS id, concat('Station ', user_id) AS station_name, count(*) AS records,
               cast(sum(event_id % 40) AS bigint) AS bikes
        FROM events GROUP BY user_id""",
    "weather_sites_json": f"""
        {_with("rider_stations")}
        SELECT cast(id AS varchar) AS id, concat('Site ', id) AS name, 'NY' AS region,
               round(cast(cast(latitude AS float) AS double), 3) AS latitude,
               CASE WHEN id % 9 <> 0
                    THEN round(cast(cast(longitude AS float) AS double), 3) END AS longitude
        FROM rider_stations WHERE id % 10 <> 0""",
    "weather_hours_json": f"""
        {_with("weather")}
        SELECT id, strftime(observed, '%Y-%m-%d %H:%M:%S') AS time,
               round(cast(cast(temperature AS float) AS double), 2) AS temperature, humidity
        FROM weather""",
    "json_field": """
        SELECT event_id, cast(json_extract_string(props, '$.k') AS int) AS k FROM events""",
    "json_explode": f"""
        {_with(documents=_DOCUMENTS)}
        SELECT cast(document AS int) AS document, cast(position AS int) AS position,
               cast(user_id AS int) AS id, concat('Station ', user_id) AS station_name,
               cast(event_id % 40 AS int) AS available_bikes,
               cast(event_id % 30 AS int) AS available_docks,
               round(cast(cast(40.5e0 + (user_id * 37 % 100) / 250e0 AS float) AS double), 3)
                   AS latitude,
               round(cast(cast(-74.2e0 + (user_id * 53 % 100) / 250e0 AS float) AS double), 3)
                   AS longitude
        FROM documents""",
    "station_stream": f"""
        {_with(documents=_DOCUMENTS)}
        SELECT cast(user_id AS int) AS id, concat('Station ', user_id) AS station_name,
               cast(event_id % 40 AS int) AS available_bikes,
               cast(event_id % 30 AS int) AS available_docks
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY user_id ORDER BY snapshot_time DESC, position DESC) AS n
              FROM documents)
        WHERE n = 1""",
    "nearest_site_repeated": f"""
        {_with("rider_stations", "sites", pairs=f'''
            SELECT a.id, b.id AS site,
                   {_distance("a.latitude", "a.longitude", "b.latitude", "b.longitude")} AS d
            FROM rider_stations a CROSS JOIN sites b''', ranked='''
            SELECT *, rank() OVER (PARTITION BY id ORDER BY d) AS n FROM pairs''')}
        SELECT CASE WHEN id % 5 <> 0 THEN id % 7 END AS id, way, site AS weather_station_id,
               round(d, 6) AS distance_km
        FROM ranked CROSS JOIN (VALUES ('few'), ('many')) AS ways (way) WHERE n = 1""",
    "text_partitions": """
        SELECT o_orderkey, lpad(cast(o_orderkey % 12 AS varchar), 2, '0') AS part,
               CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE -1e0 END AS o_totalprice
        FROM orders""",
    "enriched_table": f"""
        {_with("clock_trips", "weather", joined=_WEATHER_TRIPS)}
        SELECT bike_id, start_station_id, temperature, humidity, windspeed
        FROM joined JOIN customer ON c_custkey = start_station_id""",
    "report_tables": f"""
        {_with("clock_trips", "weather", joined=_WEATHER_TRIPS, kept='''
            SELECT joined.* FROM joined JOIN customer ON c_custkey = start_station_id''', top='''
            SELECT start_station_name AS key, count(*) AS trips FROM kept
            GROUP BY start_station_name, start_station_latitude, start_station_longitude
            ORDER BY count(*) DESC, start_station_name LIMIT 20''')}
        SELECT 'total_trips' AS "table", 'all' AS key, count(*) AS trips FROM kept
        UNION ALL SELECT 'start_trip_top_20', key, trips FROM top
        UNION ALL SELECT 'grouped_count',
            concat(year(start_time), '-', month(start_time)), count(*) FROM kept GROUP BY ALL
        UNION ALL SELECT 'phmd', cast(humidity AS varchar), count(*) FROM kept GROUP BY ALL""",
    "event_table_loaded": f"""
        {_with("city_events", "rider_stations", ranked='''
            SELECT *, row_number() OVER (PARTITION BY event_id, start_date_time
                                         ORDER BY event_location DESC) AS n
            FROM city_events JOIN rider_stations ON event_location = concat('Place ', id)''')}
        SELECT cast(event_id AS int) AS event_id, start_date_time, event_location,
               round(latitude, 6) AS latitude, round(longitude, 6) AS longitude
        FROM ranked WHERE n = 1""",
    "stations_table": f"""
        {_with(documents=_DOCUMENTS)}
        SELECT user_id AS id, concat('Station ', user_id) AS station_name,
               event_id % 40 AS available_bikes
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY user_id ORDER BY snapshot_time DESC, event_id % 40 DESC) AS n
              FROM documents)
        WHERE n = 1""",
    "first_training_year": f"""
        WITH hourly AS (
            SELECT l_suppkey AS start_station_id, cast(l_shipdate AS date) AS start_date,
                   cast(l_partkey % 24 AS int) AS start_hour, {_month("l_shipdate")} AS start_month,
                   {_weekday("l_shipdate")} AS weekday, {_weekend("l_shipdate")} AS weekend,
                   count(*) AS number_of_trips
            FROM lineitem WHERE year(l_shipdate) >= 1998 GROUP BY ALL)
        {_PAIRS}""",
    "metric_values": f"""
        {_with("clock_trips", hourly=_HOURLY, pairs=_PAIRS, found='''
            SELECT avg(pow(past_trips - number_of_trips, 2)) AS mse,
                   var_pop(number_of_trips) AS spread
            FROM pairs''')}
        SELECT 'as_before' AS model, 'r2' AS metric, round(1 - mse / spread, 6) AS value FROM found
        UNION ALL SELECT 'as_before', 'rmse', round(sqrt(mse), 6) FROM found""",
    "feature_vector": f"""
        {_with("clock_trips", "weather", hourly_plain=_HOURLY, pairs_plain=_PAIRS.replace("hourly", "hourly_plain"),
               joined=_WEATHER_TRIPS, hourly=_WEATHER_HOURLY, pairs=_WEATHER_PAIRS)}
        SELECT 'plain' AS variant, start_station_id, start_date, start_hour,
               {_text(*_PLAIN_FEATURES)} AS features FROM pairs_plain
        UNION ALL SELECT 'weather', start_station_id, start_date, start_hour,
               {_text(*_PLAIN_FEATURES, "temperature", "humidity", "windspeed")} FROM pairs""",
    "weekday_tree": f"""
        {_with("clock_trips", hourly=_HOURLY, pairs=_PAIRS)}
        SELECT weekday, round(avg(number_of_trips), 6) AS prediction FROM pairs GROUP BY 1""",
    "weather_scored_rows": f"""
        {_with("clock_trips", "weather", joined=_WEATHER_TRIPS, hourly=_WEATHER_HOURLY,
               pairs=_WEATHER_PAIRS, hashed='''
            SELECT *, md5(concat(start_station_id, '|', start_date, '|', start_hour)) AS digest
            FROM pairs''')}
        SELECT hashed.* EXCLUDE (digest, temperature, humidity, windspeed), model
        FROM hashed CROSS JOIN {_MODELS}
        WHERE cast(concat('0x', substr(digest, 1, 4)) AS int) >= 49152""",
}

ORACLES["station_stream_batches"] = ORACLES["station_stream_bounded"] = ORACLES["station_stream"]

# (table, its rows, key, measures)
_REPORTS = [
    ("total_trips", "SELECT count(*) AS total_bikes FROM kept", [], ["total_bikes"]),
    ("distinct_bikes", "SELECT count(DISTINCT bike_id) AS number_of_bikes FROM kept", [], ["number_of_bikes"]),
    *(
        (f"{end}_trip_top_20", f"""
            SELECT {end}_station_name AS place, max(n) AS number_of_trips FROM (
                SELECT {end}_station_name, count(*) AS n FROM kept
                GROUP BY {end}_station_name, {end}_station_latitude, {end}_station_longitude)
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""", ["place"], ["number_of_trips"])
        for end in ("start", "end")
    ),
    ("average_trip_user_type", """
        SELECT user_type, count(*) AS number_of_trips, avg(trip_duration) AS average_duration
        FROM kept WHERE user_type IN ('Subscriber', 'Customer') GROUP BY 1""",
     ["user_type"], ["number_of_trips", "average_duration"]),
    ("start_to_end_top_20", """
        SELECT user_type, concat(start_station_name, ' to ', end_station_name) AS route,
               count(*) AS number_of_trips, avg(trip_duration) AS average_duration
        FROM kept GROUP BY user_type, start_station_name, end_station_name
        ORDER BY number_of_trips DESC, start_station_name, end_station_name, user_type LIMIT 20""",
     ["user_type", "route"], ["number_of_trips", "average_duration"]),
    ("trips_age", """
        SELECT age, count(*) AS total_count, count(*) FILTER (gender = 1) AS males,
               count(*) FILTER (gender = 2) AS females, count(*) FILTER (gender = 0) AS unknown
        FROM kept GROUP BY age""", ["age"], ["total_count", "males", "females", "unknown"]),
    ("trip_duration_age", "SELECT age, avg(trip_duration) AS avg_trip_duration FROM kept GROUP BY age",
     ["age"], ["avg_trip_duration"]),
    ("grouped_count", 'SELECT y, m, count(*) AS "count" FROM kept GROUP BY y, m', ["y", "m"], ["count"]),
    ("percentage_change", """
        SELECT c.y, c.m, (c.n - p.n) / cast(c.n AS double) * 100 AS percentage_change
        FROM months c JOIN months p ON c.y = p.y AND c.m = p.m + 1""", ["y", "m"], ["percentage_change"]),
    ("grouped_count_season", f"""
        SELECT y, m, CASE WHEN h = 0 THEN '12AM' WHEN h < 12 THEN concat(h, 'AM') WHEN h = 12 THEN '12PM'
                     ELSE concat(h - 12, 'PM') END AS hour, {_season("m")} AS season, count(*) AS "count"
        FROM kept GROUP BY y, m, h""", ["y", "m", "hour", "season"], ["count"]),
    *(
        (table, f"""
            SELECT {columns}, count(*) AS number_of_trips, avg(trip_duration) AS average_duration
            FROM kept GROUP BY {columns}""", [], [*shown, "number_of_trips", "average_duration"])
        for table, columns, shown in (
            ("avg_temp", "temperature", ["temperature"]),
            ("phmd", "precipitation, humidity", ["precipitation"]),
            ("windspeed", "windspeed", ["windspeed"]),
        )
    ),
]


def _measures(table: str, rows: str, key: list[str], measures: list[str]) -> str:
    text = f"concat_ws('|', {', '.join(key)})" if key else "''"
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS "table", {text} AS key, '{m}' AS measure,
                   round(cast("{m}" AS double), 6) AS value FROM ({rows})"""
        for m in measures
    )


ORACLES["report_tables_in_full"] = f"""
    {_with("clock_trips", "weather", joined=_WEATHER_TRIPS, kept='''
        SELECT joined.*, event_type AS user_type, event_id % 3 AS gender, year(start_time) AS y,
               month(start_time) AS m, hour(start_time) AS h
        FROM joined JOIN customer ON c_custkey = start_station_id JOIN events ON event_id = bike_id''',
        months="SELECT y, m, count(*) AS n FROM kept GROUP BY y, m")}
    {" UNION ALL ".join(_measures(*report) for report in _REPORTS)}"""

ORACLES["bikes_after_upsert"] = f"""
    {_with("line_trips", known='''
        SELECT bike_id, cast(year(start_time) AS int) AS start_year, cast(month(start_time) AS int) AS start_month
        FROM line_trips''')}
    SELECT start_year, start_month, count(DISTINCT bike_id) AS number_of_bikes FROM known GROUP BY ALL
    UNION ALL SELECT NULL, NULL, count(DISTINCT bike_id) FROM known"""

ORACLES["bad_records"] = """
    SELECT 'trip lines' AS what, count(*) AS read, count(*) FILTER (p_size = 7) AS bad
    FROM lineitem JOIN part ON p_partkey = l_partkey
    UNION ALL SELECT 'station documents', count(DISTINCT event_id // 100),
        count(DISTINCT event_id // 100) FILTER ((event_id // 100) % 5 = 0) FROM events"""

for _ours, _rows in (("trees_by_nodes", "scored_rows"), ("weather_trees_by_nodes", "weather_scored_rows")):
    ORACLES[_ours] = f"""
        SELECT model, count(*) AS rows, cast(0 AS BIGINT) AS different FROM ({ORACLES[_rows]}) GROUP BY model"""
