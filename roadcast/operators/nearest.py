"""Nearest station by geodesic distance; the station listed first wins a tie.

Straight-line (chord) distances bound geodesic ones on both sides, so the costly
distance is computed only for stations that can still be nearest.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadcast.functions.geodesic import earth_xyz, geodesic_km
from roadcast.functions.numeric import let
from roadcast.session import checkpointed

# Up to this many stations travel with the plan as one array; beyond it they stay
# distributed and are found through cells.
MAX_INLINE_STATIONS = 2_000
# No curve on the ellipsoid bends tighter than this radius (metres), so a chord c
# spans at most the arc 2 r asin(c / 2 r) (Schur's comparison theorem).
TIGHTEST_RADIUS = 6.33e6
FAR = 4.0e7  # longer than any geodesic
# Earth-centred cubes of 2**(24 - level) metres: 4194 km down to 25 cm, each 8 of the next level's.
LEVELS = range(2, 27)
# A cube of points whose stations that can be nearest are this few gets them as one array.
FEW_STATIONS = 128
_OFFSET, _SPAN = float(1 << 23), 24


def _longest_geodesic(chord: Column) -> Column:
    reach = 2 * TIGHTEST_RADIUS
    return F.when(chord < 1.2e7, reach * F.asin(chord / reach) + 0.001).otherwise(F.lit(FAR))


def _chord(p: Column, q: Column) -> Column:
    square = lambda axis: (p[axis] - q[axis]) * (p[axis] - q[axis])
    return F.sqrt(square("x") + square("y") + square("z"))


def _xyz(lat: Column, lon: Column) -> Column:
    x, y, z = earth_xyz(lat, lon)
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))


def station_violations(stations: DataFrame) -> DataFrame:
    """Broken rules of a station list: empty list, missing id, repeated id."""
    empty = stations.agg(F.count("*").alias("n")).filter("n = 0").select(
        F.lit("no_stations").alias("rule"), F.lit(None).cast("string").alias("station_id")
    )
    blank = stations.filter(F.coalesce(F.col("station_id"), F.lit("")) == "").select(
        F.lit("invalid_station_id").alias("rule"), "station_id"
    )
    repeated = (
        stations.filter(F.col("station_id") != "")
        .groupBy("station_id")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .select(F.lit("duplicate_station_id").alias("rule"), "station_id")
    )
    return empty.unionByName(blank).unionByName(repeated)


def nearest_station(
    points: DataFrame,
    stations: DataFrame,
    keys: Sequence[str],
    lat: str = "lat",
    lon: str = "lon",
    inline_limit: int = MAX_INLINE_STATIONS,
) -> DataFrame:
    """``points`` plus ``station_id, station_name, station_location, distance_km``.

    ``stations`` holds ``ordinal, station_id, name, lat, lon, location``. Its size is
    read first (at most ``inline_limit`` + 1 rows). ``keys``, which may repeat, identify a
    point together with its position. A point none of whose distances settles keeps a null distance.
    """
    if stations.limit(inline_limit + 1).count() <= inline_limit:
        found = _from_array(points, stations, lat, lon)
    else:
        found = _from_cells(points, stations, list(dict.fromkeys([*keys, lat, lon])), lat, lon)
    distance = F.col("nearest.km")
    return found.select(
        *points.columns,
        F.col("nearest.s.station_id").alias("station_id"),
        F.col("nearest.s.name").alias("station_name"),
        F.col("nearest.s.location").alias("station_location"),
        F.when(distance < FAR, distance).alias("distance_km"),
    )


def _entry() -> Column:
    return F.struct(
        "ordinal", "station_id", "name", "location", "lat", "lon", _xyz(F.col("lat"), F.col("lon")).alias("at")
    )


def _best(candidates: Column, lat: str, lon: str) -> Column:
    """The nearest of an array of stations to the point of the row, whose place is ``_at``."""

    def measured(station: Column) -> Column:
        km = geodesic_km(F.col(lat), F.col(lon), station["lat"], station["lon"])
        return F.struct(F.coalesce(km, F.lit(FAR)).alias("km"), station["ordinal"].alias("ordinal"), station.alias("s"))

    chords = let(
        F.col("_at"),
        lambda at: F.transform(candidates, lambda s: F.struct(_chord(at, s["at"]).alias("chord"), s.alias("s"))),
    )
    return let(
        chords,
        lambda cs: let(
            _longest_geodesic(F.array_min(F.transform(cs, lambda c: c["chord"]))),
            lambda reach: F.array_min(
                F.transform(F.filter(cs, lambda c: c["chord"] <= reach), lambda c: measured(c["s"]))
            ),
        ),
    )


def _from_array(points: DataFrame, stations: DataFrame, lat: str, lon: str) -> DataFrame:
    """All stations as one array in the plan (a scalar subquery): no join, no shuffle of points."""
    table = stations.agg(F.array_sort(F.collect_list(_entry()))).scalar()
    located = points.withColumns({"_at": _xyz(F.col(lat), F.col(lon)), "_stations": table})
    return located.withColumn("nearest", _best(F.col("_stations"), lat, lon))


def _axes(point: Column, level: int) -> list[Column]:
    side = 2.0 ** (_SPAN - level)
    return [F.floor((point[axis] + _OFFSET) / side).alias(axis) for axis in "xyz"]


def _cell(point: Column, level: int) -> Column:
    return F.struct(*_axes(point, level))


def _on_earth(lat: str, lon: str) -> Column:
    return F.abs(F.col(lat)) + F.abs(F.col(lon)) < float("inf")


def _from_cells(points: DataFrame, stations: DataFrame, keys: list[str], lat: str, lon: str) -> DataFrame:
    """Descend two trees of cubes together, one of points and one of stations, by equi-joins.

    A cube of points keeps the station cubes of its level that can hold the nearest station
    of any of its points: those no farther than the longest geodesic from any of them to a
    station already known. It is opened further until these hold few stations, which then go to
    its points as one array. So the pairs of cubes grow with the occupied cubes, not with points
    times cubes, and the answer is exact for any station list.
    """
    sites = checkpointed(
        # of stations at one position only the first listed can win
        stations.filter(_on_earth("lat", "lon")).groupBy("lat", "lon")
        .agg(F.min(F.struct("ordinal", "station_id", "name", "location")).alias("s"))
        .select("s.*", "lat", "lon")
        .select(_entry().alias("s"))
    )
    located = points.filter(_on_earth(lat, lon)).select(*keys).dropna().dropDuplicates(keys)
    located = checkpointed(located.withColumn("_at", _xyz(F.col(lat), F.col(lon))))
    settled, rest = _descend(located, sites)
    found = _from_pairs(located, rest, sites, keys, lat, lon)
    if settled:
        found = found.unionByName(_from_lists(located, settled, sites, keys, lat, lon))
    return points.join(found, keys, "left")


def _descend(located: DataFrame, sites: DataFrame) -> tuple[dict[int, DataFrame], DataFrame]:
    """By level the pairs ``block, cell`` of the blocks (cubes of points) with few stations in their cells,
    and ``block, cell, reach`` of those that still have many on the last level."""
    pairs, settled = None, {}
    for level in LEVELS:
        # the first level has at most 4**3 blocks and cells, all in one cube
        up = (lambda at: _cell(at, level - 1)) if pairs is not None else (lambda at: F.lit(0))  # noqa: B023
        blocks = located.groupBy(up(F.col("_at")).alias("block"), _cell(F.col("_at"), level).alias("inner_block"))
        blocks = blocks.agg(*_box("_at", "p_low", "p_high"))
        cells = sites.groupBy(up(F.col("s.at")).alias("cell"), _cell(F.col("s.at"), level).alias("inner_cell"))
        cells = cells.agg(*_box("s.at", "low", "high"), F.min("s.at").alias("some"), F.count("*").alias("n"))
        if pairs is None:
            opened = blocks.crossJoin(cells).withColumn("reach", F.lit(FAR))
        else:
            opened = pairs.select("block", "cell", "reach").join(blocks, "block").join(cells, "cell")
        pairs = checkpointed(_pruned(opened.drop("block", "cell")))
        few = F.col("stations") <= FEW_STATIONS
        settled[level] = pairs.filter(few).select("block", "cell")
        pairs = pairs.filter(~few)
        if pairs.isEmpty():
            break
    return {level: kept for level, kept in settled.items() if not kept.isEmpty()}, pairs.select("block", "cell", "reach")


def _pruned(opened: DataFrame) -> DataFrame:
    """``block, cell, reach, stations``: the pairs that can matter, and how many stations the block's cells hold."""
    block = Window.partitionBy("inner_block")
    known = F.least("reach", _longest_geodesic(_farthest(F.col("some"), F.col("p_low"), F.col("p_high"))))
    reached = opened.withColumn("reach", F.min(known).over(block))
    near = reached.filter(_gap(F.col("p_low"), F.col("p_high"), F.col("low"), F.col("high")) <= F.col("reach"))
    return near.select(
        F.col("inner_block").alias("block"), F.col("inner_cell").alias("cell"), "reach", F.sum("n").over(block).alias("stations")
    )


def _from_lists(
    located: DataFrame, settled: dict[int, DataFrame], sites: DataFrame, keys: list[str], lat: str, lon: str
) -> DataFrame:
    """The nearest stations of points in settled blocks: a block's stations are one array of ``FEW_STATIONS`` at most."""
    lists = reduce(
        DataFrame.unionByName,
        [
            pairs.join(sites.select(_cell(F.col("s.at"), level).alias("cell"), "s"), "cell")
            .groupBy(F.struct(F.lit(level).alias("level"), *[f"block.{a}" for a in "xyz"]).alias("block"))
            .agg(F.collect_list("s").alias("_stations"))
            for level, pairs in settled.items()
        ],
    )
    # the levels share no block of a point: one is opened only where it is not settled
    own = F.array(*[F.struct(F.lit(level).alias("level"), *_axes(F.col("_at"), level)) for level in settled])
    placed = located.withColumn("block", F.explode(own)).join(lists, "block")
    return placed.select(*keys, _best(F.col("_stations"), lat, lon).alias("nearest"))


def _from_pairs(
    located: DataFrame, pairs: DataFrame, sites: DataFrame, keys: list[str], lat: str, lon: str
) -> DataFrame:
    """The same for blocks of the last level with more stations: a row for each, so nothing is held together."""
    last = LEVELS[-1]
    station = lambda name: F.col("s")[name]
    km = geodesic_km(F.col(lat), F.col(lon), station("lat"), station("lon"))
    return (
        located.withColumn("block", _cell(F.col("_at"), last))
        .join(pairs, "block")
        .join(sites.withColumn("cell", _cell(F.col("s.at"), last)), "cell")
        .filter(_chord(F.col("_at"), station("at")) <= F.col("reach"))
        .groupBy(*keys)
        .agg(F.min(F.struct(F.coalesce(km, F.lit(FAR)).alias("km"), station("ordinal").alias("ordinal"), "s")).alias("nearest"))
    )


def _box(at: str, low: str, high: str) -> list[Column]:
    corner = lambda agg: F.struct(*[agg(F.col(at)[axis]).alias(axis) for axis in "xyz"])
    return [corner(F.min).alias(low), corner(F.max).alias(high)]


def _length(sides: list[Column]) -> Column:
    return F.sqrt(reduce(lambda total, side: total + side * side, sides, F.lit(0.0)))


def _gap(low: Column, high: Column, other_low: Column, other_high: Column) -> Column:
    """Straight-line distance between two boxes, 0 where they meet."""
    return _length([F.greatest(other_low[a] - high[a], low[a] - other_high[a], F.lit(0.0)) for a in "xyz"])


def _farthest(at: Column, low: Column, high: Column) -> Column:
    """The greatest straight-line distance from a place to a point of a box."""
    return _length([F.greatest(F.abs(at[a] - low[a]), F.abs(at[a] - high[a])) for a in "xyz"])
