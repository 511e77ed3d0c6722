import math
import random

import pytest
from conftest import executed_plan
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripstats.functions.geo import haversine_km
from tripstats.operators.columns import drop_incomplete, prefix_columns, zero_fill
from tripstats.operators.keyed import has_duplicate_keys, latest_per_key
from tripstats.operators.lookup import lookup_join, measure, salted_join
from tripstats.operators.nearest import nearest_site
from tripstats.operators.periods import lag_demand, month_over_month
from tripstats.operators.radius import within_radius
from tripstats.operators.split import split_by_key
from tripstats.operators.topk import top_k


def haversine(a, b):
    (lat1, lng1), (lat2, lng2) = a, b
    p, q = math.radians(lat1), math.radians(lat2)
    h = math.sin((q - p) / 2) ** 2
    h += math.cos(p) * math.cos(q) * math.sin(math.radians(lng2 - lng1) / 2) ** 2
    return 2 * 6371 * math.atan2(math.sqrt(h), math.sqrt(max(0.0, 1 - h)))


def scattered(seed, n, spread):
    """Points in clusters all over the globe, at the poles and at the date line."""
    rng = random.Random(seed)
    centres = [(40.7, -73.9), (0.0, 179.999), (0.0, -179.999), (89.999, 5.0), (-89.99, 90.0)]
    points = []
    for i in range(n):
        lat, lng = rng.choice(centres)
        lat = max(-90.0, min(90.0, lat + rng.gauss(0, spread)))
        lng = (lng + rng.gauss(0, spread) + 180) % 360 - 180
        points.append((i, lat, lng))
    return points


def places(spark, points, names="id int, latitude double, longitude double"):
    return spark.createDataFrame(points, names)


# --- lookup joins ------------------------------------------------------------------


def test_lookup_join_keeps_results_on_every_path(spark, rows):
    # One key holds most of the facts.
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v")
    )
    lookup = spark.range(45).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    expected = rows(facts.join(lookup, "k"))
    assert rows(lookup_join(facts, lookup, ["k"])) == expected
    assert rows(lookup_join(facts, lookup, ["k"], broadcast_bytes=0)) == expected
    assert rows(lookup_join(facts, lookup, ["k"], ["v"], broadcast_bytes=0, salts=3)) == expected


def test_salt_spreads_a_hot_key(spark):
    facts = spark.range(8000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    lookup = spark.range(5).select(F.col("id").cast("int").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(facts, lookup, ["k"], ["v"], salts=32)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 8000
    assert max(sizes) < 5000


def dealt(df, columns):
    """Rows of the frame that stands in the plan's exchange by these columns, as a side of the join."""
    return sorted(tuple(r) for r in df.groupBy(*columns).count().collect())


def test_only_hot_keys_are_copied(spark, rows, monkeypatch):
    from tripstats.operators import lookup as module

    # A third of the rows have one key; the rest are spread over 500 keys.
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 500)
    facts = spark.range(30_000).select(key.alias("k"), F.col("id").alias("v"))
    facts = facts.unionByName(spark.createDataFrame([(None, 1)], "k long, v long"))
    table = spark.range(-1, 600).select(F.col("id").alias("k"), F.lit("x").alias("w"))
    hot = module.hot_keys(facts, ["k"], tasks=12).collect()
    (minus_one,) = spark.range(1).select(F.xxhash64(F.lit(-1).cast("long"))).first()
    assert [(r["_key"], r["_salts"]) for r in hot] == [(minus_one, 4)]

    sides = []
    original = type(facts).join

    def spy(self, other, on=None, how=None):
        if isinstance(on, list) and "_salt" in on:
            sides.extend([self, other])
        return original(self, other, on, how)

    monkeypatch.setattr(type(facts), "join", spy)
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        joined = lookup_join(facts, table, ["k"], ["v"], broadcast_bytes=-1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    monkeypatch.undo()
    assert rows(joined) == rows(facts.join(table, "k"))
    left, right = sides
    # One lookup row in 601 has copies, one for each salt of its key; the key's rows are dealt evenly.
    assert right.count() == 601 + 3 and right.where("k = -1").count() == 4
    assert left.where("k <> -1").select("_salt").distinct().collect() == [(0,)]
    assert all(2300 < n < 2700 for _, n in dealt(left.where("k = -1"), ["_salt"]))


def test_no_hot_keys(spark):
    from tripstats.operators.lookup import hot_keys

    assert hot_keys(spark.range(0), ["id"], 8).count() == 0
    assert hot_keys(spark.range(1000), ["id"], 8).count() == 0
    assert hot_keys(spark.createDataFrame([(None,)] * 9, "id long"), ["id"], 8).count() <= 1


def test_small_lookup_leaves_facts_where_they_are(spark):
    facts = spark.range(100).withColumnRenamed("id", "k")
    joined = lookup_join(facts, spark.range(10).withColumnRenamed("id", "k"), ["k"])
    plan = executed_plan(joined)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_measure_counts_text(spark):
    short = spark.createDataFrame([("a",)] * 10, "t string")
    long = spark.createDataFrame([("a" * 1000,), (None,)], "t string")
    assert measure(short) == (10, 10 * (16 + 8 + 1))
    assert measure(long) == (2, 2 * (16 + 8) + 1000)
    assert measure(short.limit(0)) == (0, 0)
    nested = spark.createDataFrame([([1, 2, 3],)], "a array<int>")
    assert measure(nested).bytes > 24


# --- keys, order, nulls ------------------------------------------------------------


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (2, None, "d"), (2, 0, "e"), (None, 1, "f")],
        "k int, t int, v string",
    )
    assert rows(latest_per_key(df, ["k"], ["t"])) == [(1, 3, "b"), (2, 0, "e"), (None, 1, "f")]


def test_latest_per_key_settles_ties_alike_in_any_partitioning(spark, rows):
    df = spark.range(200).select((F.col("id") % 3).alias("k"), F.lit(1).alias("t"), F.col("id").alias("v"))
    found = {tuple(rows(latest_per_key(df.repartition(n), ["k"], ["t"]))) for n in (1, 2, 7)}
    assert found == {((0, 1, 198), (1, 1, 199), (2, 1, 197))}


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = executed_plan(latest_per_key(df, ["k"], ["t"]))
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < plan.index("row_number(), 1, Partial")


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "a int, b int")
    assert has_duplicate_keys(df, ["a"])
    assert not has_duplicate_keys(df, ["a", "b"])


def test_top_k_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("c", 2), ("a", 2), ("b", 2), ("d", 5), (None, 2)], "s string, n int")
    top = top_k(df, "n", ["s"], 3)
    assert [tuple(r) for r in top.collect()] == [("d", 5), ("a", 2), ("b", 2)]
    assert "TakeOrderedAndProject" in executed_plan(top)


def test_null_handling(spark, rows):
    df = spark.createDataFrame([(1, None, "x"), (None, 2.0, None), (3, 4.0, "y")], "a int, b double, c string")
    assert rows(drop_incomplete(df)) == [(3, 4.0, "y")]
    assert rows(drop_incomplete(df, ["a"])) == [(1, None, "x"), (3, 4.0, "y")]
    assert rows(zero_fill(df)) == [(0, 2.0, None), (1, 0.0, "x"), (3, 4.0, "y")]
    assert prefix_columns(df, "p_").columns == ["p_a", "p_b", "p_c"]


# --- periods -----------------------------------------------------------------------


def test_month_over_month(spark, rows):
    counts = spark.createDataFrame(
        [(2018, 12, 50), (2019, 1, 100), (2019, 2, 80), (2019, 4, 10), (2019, 5, 0), (2019, 6, 4)],
        "start_year int, start_month int, count long",
    )
    assert rows(month_over_month(counts)) == [
        (2, 2019, -25.0),
        (5, 2019, None),
        (6, 2019, 100.0),
    ]
    assert rows(month_over_month(counts, denominator="previous")) == [
        (2, 2019, -20.0),
        (5, 2019, -100.0),
        (6, 2019, None),
    ]
    with pytest.raises(ValueError):
        month_over_month(counts, denominator="next")


def hourly(spark, data):
    return spark.createDataFrame(
        data,
        "start_station_id int, start_date string, start_hour int, mark string, number_of_trips long",
    )


def test_lag_demand_crosses_neither_gap_nor_midnight(spark, rows):
    demand = hourly(
        spark,
        [
            (1, "d1", 9, "a", 5),
            (1, "d1", 11, "b", 6),
            (1, "d1", 12, "c", 7),
            (1, "d1", 23, "d", 8),
            (1, "d2", 0, "e", 9),
            (2, "d1", 12, "f", 1),
            (None, "d1", 9, "g", 1),
            (None, "d1", 10, "h", 1),
        ],
    )
    assert rows(lag_demand(demand)) == [(1, "d1", 11, "b", 6, 7)]
    assert rows(lag_demand(demand, step=3)) == [(1, "d1", 9, "a", 5, 7)]


def test_lag_demand_equals_shifted_self_join(spark, rows):
    rng = random.Random(5)
    data = [
        (rng.randrange(4), f"d{rng.randrange(3)}", rng.randrange(24), rng.choice("xyz"), i)
        for i in range(300)
    ]
    demand = hourly(spark, data)
    expected = sorted(
        ((s, d, h, m, n, later) for s, d, h, m, n in data
         for s2, d2, h2, _, later in data if (s, d, h + 1) == (s2, d2, h2)),
        key=repr,
    )
    assert rows(lag_demand(demand)) == expected


# --- geometry ----------------------------------------------------------------------


def brute_force_pairs(left, right, km):
    return {(a[0], b[0]) for a in left for b in right if haversine(a[1:], b[1:]) < km}


@pytest.mark.parametrize("km, spread", [(4, 0.05), (0.005, 0.00005), (900, 5.0), (15000, 20.0)])
@pytest.mark.parametrize("broadcast_bytes", [10**8, -1])
def test_within_radius_equals_brute_force(spark, km, spread, broadcast_bytes):
    left, right = scattered(1, 120, spread), scattered(2, 90, spread)
    pairs = within_radius(
        places(spark, left),
        places(spark, right, "e int, lat double, lng double"),
        km,
        right_point=("lat", "lng"),
        broadcast_bytes=broadcast_bytes,
    )
    found = [(r.id, r.e) for r in pairs.collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute_force_pairs(left, right, km)
    assert len(found) > 0


def test_within_radius_without_broadcast_is_never_broadcast(spark):
    left, right = scattered(1, 120, 0.05), scattered(2, 90, 0.05)
    pairs = within_radius(
        places(spark, left),
        places(spark, right, "e int, lat double, lng double"),
        4,
        right_point=("lat", "lng"),
        broadcast_bytes=-1,
    )
    assert {(r.id, r.e) for r in pairs.collect()} == brute_force_pairs(left, right, 4)
    plan = executed_plan(pairs)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_within_radius_is_strict_and_skips_missing_coordinates(spark):
    left = places(spark, [(1, 0.0, 0.0), (2, None, 0.0)])
    right = places(
        spark,
        [(1, 0.0, 3.99 / 111.194927), (2, 0.0, 4.01 / 111.194927), (3, 0.0, None)],
        "e int, latitude double, longitude double",
    )
    assert [(r.id, r.e) for r in within_radius(left, right, 4).collect()] == [(1, 1)]


def test_within_radius_keeps_repeated_rows(spark):
    left = places(spark, [(1, 1.0, 1.0), (1, 1.0, 1.0)])
    right = places(spark, [(9, 1.0, 1.0)] * 3, "e int, latitude double, longitude double")
    assert within_radius(left, right, 1).count() == 6


def brute_force_nearest(points, sites):
    """All pairs, with the same distance expression, so that the same ones tie."""
    apart = haversine_km(F.col("latitude"), F.col("longitude"), F.col("lat"), F.col("lng"))
    pairs = points.crossJoin(sites.toDF("site", "lat", "lng")).withColumn("d", apart)
    best = F.min("d").over(Window.partitionBy("id"))
    return {(r.id, r.site) for r in pairs.withColumn("best", best).filter("d = best").collect()}


@pytest.mark.parametrize("seed, spread", [(1, 0.05), (2, 3.0), (3, 60.0), (4, 0.00002)])
@pytest.mark.parametrize("tuning", [{}, {"few_sites": 0}, {"few_sites": 0, "broadcast_bytes": -1}])
def test_nearest_site_equals_brute_force(spark, seed, spread, tuning):
    points, sites = scattered(seed, 60, spread), scattered(seed + 50, 200, spread)
    # Two sites at one spot, and a point right there.
    sites += [(900, *sites[0][1:]), (901, *sites[1][1:])]
    points += [(800, *sites[0][1:])]
    points, sites = places(spark, points), places(spark, sites)
    found = nearest_site(points, sites, **tuning).collect()
    assert {(r.id, r.weather_station_id) for r in found} == brute_force_nearest(points, sites)
    assert len(found) == len({(r.id, r.weather_station_id) for r in found})


@pytest.mark.parametrize("tuning", [{}, {"few_sites": 0}])
def test_nearest_site_ties(spark, rows, tuning):
    points = places(spark, [(1, 0.0, 0.0), (2, 0.0, 0.9), (3, None, 0.0)])
    sites = places(spark, [(7, 0.0, 1.0), (5, 0.0, -1.0), (6, 0.0, 1.0), (4, None, 0.0)])
    every = nearest_site(points, sites, **tuning)
    assert rows(every, "id", "weather_station_id") == [(1, 5), (1, 6), (1, 7), (2, 6), (2, 7)]
    first = nearest_site(points, sites, ties="first", **tuning)
    assert rows(first, "id", "weather_station_id") == [(1, 5), (2, 6)]
    with pytest.raises(ValueError):
        nearest_site(points, sites, ties="some")


def test_nearest_site_among_a_crowd(spark):
    """Most sites crowd in one place; a lone one is still found, and not all pairs met."""
    rng = random.Random(9)
    crowd = [(i, 10 + rng.random() / 100, 10 + rng.random() / 100) for i in range(1500)]
    sites = crowd + [(9999, 10.5, 10.5)]
    points = [(1, 10.6, 10.6), (2, 10.2, 10.2), (3, 10.005, 10.005), (4, -50.0, 100.0)]
    points, sites = places(spark, points), places(spark, sites)
    found = nearest_site(points, sites).collect()
    assert {(r.id, r.weather_station_id) for r in found} == brute_force_nearest(points, sites)


def test_nearest_of_no_sites(spark):
    assert nearest_site(places(spark, [(1, 0.0, 0.0)]), places(spark, [])).count() == 0


# --- split -------------------------------------------------------------------------


def test_split_is_whole_repeatable_and_about_right(spark, rows):
    df = spark.range(4000).select((F.col("id") % 2000).alias("k"), F.col("id").alias("v"))
    first, second = split_by_key(df, ["k"])
    assert first.count() + second.count() == 4000
    assert abs(first.count() / 4000 - 0.75) < 0.05
    again, _ = split_by_key(df.repartition(13), ["k"])
    assert rows(again) == rows(first)
    assert first.select("k").intersect(second.select("k")).count() == 0


def test_split_takes_null_keys(spark):
    first, second = split_by_key(spark.createDataFrame([(None,), (1,)], "k int"), ["k"])
    assert first.count() + second.count() == 2


def joined_sides(monkeypatch, spark):
    """Both sides of each join made from now on."""
    sides = []
    kind = type(spark.range(1))
    original = kind.join

    def spy(self, other, on=None, how=None):
        sides.append((self, other))
        return original(self, other, on, how)

    monkeypatch.setattr(kind, "join", spy)
    return sides


def test_radius_join_copies_right_rows_only_where_they_are_needed(spark, monkeypatch):
    # A grid of points 2.2 km apart or less: no cell has a task's share of them.
    left = [(i, 10.0 + i % 30 * 0.02, 20.0 + i // 30 * 0.02) for i in range(900)]
    right = [(i, lat + 0.005, lng - 0.003) for i, lat, lng in left]
    sides = joined_sides(monkeypatch, spark)
    pairs = within_radius(
        places(spark, left),
        places(spark, right, "e int, lat double, lng double"),
        1,
        right_point=("lat", "lng"),
        broadcast_bytes=-1,
    )
    assert {(r.id, r.e) for r in pairs.collect()} == brute_force_pairs(left, right, 1)
    ((facts, lookup),) = sides
    assert facts.count() == 900
    # Eight cells of sixteen salts before.
    assert lookup.count() < 6 * 900


def test_radius_join_still_spreads_a_crowded_cell(spark, monkeypatch):
    left = scattered(1, 300, 0.0001) + [(300 + i, -30.0 + i * 0.05, 60.0) for i in range(60)]
    right = [(i, lat, lng) for i, lat, lng in left[::6]]
    sides = joined_sides(monkeypatch, spark)
    pairs = within_radius(
        places(spark, left),
        places(spark, right, "e int, lat double, lng double"),
        1,
        right_point=("lat", "lng"),
        broadcast_bytes=-1,
    )
    found = [(r.id, r.e) for r in pairs.collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute_force_pairs(left, right, 1)
    ((facts, _),) = sides
    crowded = facts.groupBy("_cell").agg(F.countDistinct("_salt").alias("salts")).orderBy(F.desc("salts"))
    salts = [r["salts"] for r in crowded.collect()]
    assert salts[0] > 1 and salts[-1] == 1
