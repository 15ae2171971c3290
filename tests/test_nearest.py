import random

import pytest
from pyspark.sql import functions as F

from roadcast.functions.geodesic import geodesic_km
from roadcast.operators import nearest
from roadcast.operators.nearest import nearest_station
from roadcast.specs import STATION_SCHEMA

POINTS = "beat long, lat double, lon double"


def all_pairs(points, stations):
    pairs = points.crossJoin(stations.select("ordinal", "station_id", F.col("lat").alias("a"), F.col("lon").alias("b")))
    km = F.coalesce(geodesic_km(F.col("lat"), F.col("lon"), F.col("a"), F.col("b")), F.lit(1e9))
    best = pairs.groupBy("beat").agg(F.min(F.struct(km.alias("km"), "ordinal", "station_id")).alias("m"))
    return {r.beat: (r.m.station_id, r.m.km) for r in best.collect()}


def scattered(rng, n, crowd):
    """Half of the places all over the globe, half in one town."""
    wide = [(rng.uniform(-89, 89), rng.uniform(-180, 180)) for _ in range(n - crowd)]
    return wide + [(rng.uniform(32.70, 32.72), rng.uniform(-117.12, -117.10)) for _ in range(crowd)]


# few stations: blocks are settled on many levels; a short tree: blocks of its last level go by rows
@pytest.mark.parametrize("few, levels", [(128, range(2, 27)), (4, range(2, 27)), (1, range(2, 9)), (3, range(2, 4))])
def test_cubes_agree_with_all_pairs(spark, monkeypatch, few, levels):
    monkeypatch.setattr(nearest, "FEW_STATIONS", few)
    monkeypatch.setattr(nearest, "LEVELS", levels)
    rng = random.Random(few)
    stations = spark.createDataFrame(
        [(i, f"S{i}", f"n{i}", *at, "l") for i, at in enumerate(scattered(rng, 200, 100))], STATION_SCHEMA
    )
    points = spark.createDataFrame([(i, *at) for i, at in enumerate(scattered(rng, 60, 30))], POINTS)
    got = nearest_station(points, stations, ["beat"], inline_limit=0).collect()
    assert {r.beat: (r.station_id, r.distance_km) for r in got} == all_pairs(points, stations)


def test_places_that_are_not_given_get_no_station(spark):
    nan = float("nan")
    stations = spark.createDataFrame(
        [(0, "N", "n", None, 1.0, "l"), (1, "M", "m", nan, 1.0, "l"), (2, "A", "a", 1.0, 1.0, "l")], STATION_SCHEMA
    )
    points = spark.createDataFrame([(1, 1.5, 1.0), (2, None, 1.0), (3, nan, 1.0), (4, 80.0, nan)], POINTS)
    got = nearest_station(points, stations, ["beat"], inline_limit=0).collect()
    assert {r.beat: r.station_id for r in got} == {1: "A", 2: None, 3: None, 4: None}
    nowhere = nearest_station(points, stations.filter("ordinal < 2"), ["beat"], inline_limit=0).collect()
    assert [r.station_id for r in nowhere] == [None] * 4


def test_what_a_point_is_joined_with_does_not_grow_with_the_stations(spark):
    """Lists of a block stay short and pairs of cubes go by occupied cubes, so points times cubes are never made."""

    def globe(n, rng):
        return [(rng.uniform(-60, 60), rng.uniform(-180, 180)) for _ in range(n)]

    rng = random.Random(1)
    points = spark.createDataFrame([(i, *at) for i, at in enumerate(globe(4000, rng))], POINTS)
    located = points.withColumn("_at", nearest._xyz(F.col("lat"), F.col("lon")))
    for n in (250, 2000):
        stations = spark.createDataFrame([(i, f"S{i}", "n", *at, "l") for i, at in enumerate(globe(n, rng))], STATION_SCHEMA)
        sites = stations.select(nearest._entry().alias("s"))
        settled, rest = nearest._descend(located, sites)
        assert rest.isEmpty()
        made = sum(pairs.count() for pairs in settled.values())
        sizes = [
            r["n"]
            for level, pairs in settled.items()
            for r in pairs.join(sites.select(nearest._cell(F.col("s.at"), level).alias("cell")), "cell")
            .groupBy("block").agg(F.count("*").alias("n")).collect()
        ]
        assert max(sizes) <= nearest.FEW_STATIONS
        assert made < 20 * n
