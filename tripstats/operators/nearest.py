"""Nearest site of each point."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstats.functions.geo import cell_key, cell_numbers, haversine_km, unit_vector
from tripstats.operators.lookup import BROADCAST_BYTES, SALTS, measure, salted_join
from tripstats.workspace import checkpointed

FEW_SITES = 64

# Depths of the search, in halvings of the box around the unit sphere.  The first
# has at most 512 cells; those of the last are about 12 m wide.
_DEPTHS = (3, 6, 9, 12, 15, 18, 20)
_FEW_CELLS = 64
_FEW_SPOTS = 32
# What is searched for: places, not points.
_KEY = ("latitude", "longitude")


def nearest_site(
    points: DataFrame,
    sites: DataFrame,
    site_id: str = "id",
    ties: str = "all",
    out_id: str = "weather_station_id",
    out_distance: str = "distance_km",
    few_sites: int = FEW_SITES,
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Add to each point the id and distance of the nearest site.

    Both sides carry ``latitude`` and ``longitude`` in degrees; points or sites
    without coordinates are left out.  With ``ties="all"`` a point gets a row for every
    site at the least distance, with ``ties="first"`` only the smallest id of them.
    Repeated points, and points with the same or no id, all keep their rows.

    The search is for the distinct coordinates of the points, and its result is joined
    back to them.  Coordinates are compared with all of up to ``few_sites`` sites.  More
    are searched through ever smaller cells (see ``_search``); the result is the same.
    """
    if ties not in ("all", "first"):
        raise ValueError(f"ties must be 'all' or 'first', not {ties!r}")
    located = points.filter("latitude is not null and longitude is not null")
    places = sites.select(
        F.col(site_id).alias("_id"),
        F.col("latitude").cast("double").alias("_lat"),
        F.col("longitude").cast("double").alias("_lng"),
    ).filter("_lat is not null and _lng is not null")
    # Sites are read several times below, so they are stored once.
    places = checkpointed(places)
    size = measure(places)
    distinct = located.select(*_KEY).distinct()
    if size.rows <= few_sites:
        nearest = _compare_all(distinct, places, ties)
    else:
        # No table joined in the search has more rows than there are sites, nor rows
        # more than twice as wide.
        small = 2 * size.bytes <= broadcast_bytes
        nearest = _search(distinct, places, ties, small, salts)
    found = located.join(nearest.select(*_KEY, "_id", "_distance"), list(_KEY))
    return found.select(
        *points.columns, F.col("_id").alias(out_id), F.col("_distance").alias(out_distance)
    )


def _distance_to(lat: Column, lng: Column) -> Column:
    return haversine_km(F.col("latitude"), F.col("longitude"), lat, lng)


def _compare_all(points: DataFrame, places: DataFrame, ties: str) -> DataFrame:
    """Compare each point with every one of a few sites.  The points are dealt by
    their coordinates already, so ranking needs no further shuffle."""
    listed = places.agg(F.collect_list(F.struct("_id", "_lat", "_lng"))).scalar()
    pairs = points.withColumn("_sites", listed).select(*_KEY, F.inline("_sites"))
    measured = pairs.withColumn("_distance", _distance_to(F.col("_lat"), F.col("_lng")))
    return _nearest_only(measured, ties)


def _search(
    points: DataFrame,
    places: DataFrame,
    ties: str,
    small: bool,
    salts: int,
) -> DataFrame:
    """Branch and bound over nested cubic cells.

    A point starts with the occupied cells of a coarse grid and trades, depth by
    depth, each of its cells for the occupied cells inside.  The far corner of an
    occupied cell bounds the nearest site from above; cells that begin beyond the
    best bound are given up.  So a point only ever meets the few cells that can
    still hold its nearest site, however many sites crowd elsewhere.
    """
    # Sites at one spot compete as one and are told apart at the end.
    spots = places.groupBy("_lat", "_lng").agg(F.min("_id").alias("_id"))
    spots = spots.select("*", *_named("_s", F.col("_lat"), F.col("_lng")))
    cells = {f"_cell_{depth}": _cell_at(depth) for depth in _DEPTHS}
    spots = checkpointed(spots.withColumns(cells))

    def join(many: DataFrame, few: DataFrame, on: list[str]) -> DataFrame:
        if small:
            return many.join(F.broadcast(few), on)
        return salted_join(many, few, on, list(_KEY), salts)

    depths = _useful_depths(spots)
    vectors = points.select("*", *_named("_p", F.col("latitude"), F.col("longitude")))
    # At most a few hundred cells, whatever the number of sites.
    coarse = [row[0] for row in spots.select(f"_cell_{depths[0]}").distinct().collect()]
    state = vectors.withColumn("_cell", F.explode(F.lit(coarse).cast("array<long>")))
    state = _still_possible(state, depths[0])
    for depth, deeper in zip(depths, depths[1:]):
        inner = spots.select(
            F.col(f"_cell_{depth}").alias("_cell"), F.col(f"_cell_{deeper}").alias("_inner")
        ).distinct()
        opened = join(state, inner, ["_cell"]).drop("_cell").withColumnRenamed("_inner", "_cell")
        state = _still_possible(opened, deeper)

    inside = spots.select("_id", "_lat", "_lng", F.col(f"_cell_{depths[-1]}").alias("_cell"))
    measured = join(state, inside, ["_cell"]).withColumn(
        "_distance", _distance_to(F.col("_lat"), F.col("_lng"))
    )
    nearest = _nearest_only(measured, ties)
    if ties == "first":
        return nearest
    return join(nearest.drop("_id"), places, ["_lat", "_lng"])


def _nearest_only(measured: DataFrame, ties: str) -> DataFrame:
    same_point = Window.partitionBy(*_KEY)
    if ties == "first":
        place = F.row_number().over(same_point.orderBy("_distance", "_id"))
    else:
        place = F.rank().over(same_point.orderBy("_distance"))
    return measured.withColumn("_n", place).filter("_n = 1")


def _still_possible(state: DataFrame, depth: int) -> DataFrame:
    """Drop the cells that cannot hold the nearest site of their point."""
    near, far = _chord_sq_range(depth)
    best = F.min("_far").over(Window.partitionBy(*_KEY))
    bounded = state.withColumns({"_near": near, "_far": far}).withColumn("_best", best)
    # The slack keeps sites whose rounded distances tie.
    possible = bounded.filter(F.col("_near") <= F.col("_best") * (1 + 1e-6) + 1e-18)
    return possible.drop("_near", "_far", "_best")


def _useful_depths(spots: DataFrame) -> tuple[int, ...]:
    """The depths from the last with few occupied cells to the first where no cell
    holds many spots.  A choice of speed only: any depths give the same result."""
    levels = F.array(
        *(F.struct(F.lit(d).alias("depth"), F.col(f"_cell_{d}").alias("cell")) for d in _DEPTHS)
    )
    held = spots.select(F.inline(levels)).groupBy("depth", "cell").count()
    measured = held.groupBy("depth").agg(F.count("*").alias("cells"), F.max("count").alias("most"))
    rows = {row["depth"]: row for row in measured.collect()}
    first = max((d for d in _DEPTHS if rows[d]["cells"] <= _FEW_CELLS), default=_DEPTHS[0])
    last = min((d for d in _DEPTHS if rows[d]["most"] <= _FEW_SPOTS), default=_DEPTHS[-1])
    return tuple(d for d in _DEPTHS if first <= d <= max(first, last))


def _named(prefix: str, lat: Column, lng: Column) -> list[Column]:
    return [axis.alias(prefix + name) for name, axis in zip("xyz", unit_vector(lat, lng))]


def _cell_at(depth: int) -> Column:
    """Key of the cell a spot lies in after ``depth`` halvings of the box."""
    top = F.lit(2**depth - 1)
    numbers = (F.floor((F.col(f"_s{a}") + 1) * 2.0 ** (depth - 1)) for a in "xyz")
    return cell_key(*(F.least(n, top) for n in numbers))


def _chord_sq_range(depth: int) -> tuple[Column, Column]:
    """Squared chord from a point to the near and far end of its cell."""
    width = 2.0 ** (1 - depth)
    near = far = F.lit(0.0)
    for axis, number in zip("xyz", cell_numbers(F.col("_cell"))):
        low = number * width - 1
        below, above = low - F.col(f"_p{axis}"), F.col(f"_p{axis}") - (low + width)
        gap = F.greatest(below, above, F.lit(0.0))
        span = F.greatest(-below, -above)
        near, far = near + gap * gap, far + span * span
    return near, far
