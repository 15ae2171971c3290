import json
import random

import pytest
from pyspark.sql import functions as F
from shapes import box

from roadcast.operators import areas
from roadcast.operators.mapping import beats_per_station, mapping_rules, mapping_summary
from roadcast.operators.nearest import nearest_station, station_violations
from roadcast.plans.mapping_job import RuleError, map_areas
from roadcast.sources.documents import default_stations, read_collections, read_feature_lines, read_mapping
from roadcast.specs import MAPPING_COLUMNS, STATION_SCHEMA


def feature(objectid, beat, div=1, serv=2, ring=None, kind="Polygon", **more):
    ring = ring or box(-117.2, 32.7, 0.1, 0.1)
    coordinates = [ring] if kind == "Polygon" else [[ring]]
    return {
        "type": "Feature",
        "properties": {"objectid": objectid, "beat": beat, "div": div, "serv": serv, **more},
        "geometry": {"type": kind, "coordinates": coordinates},
    }


def write(tmp_path, features, kind="FeatureCollection"):
    path = tmp_path / "areas.geojson"
    path.write_text(json.dumps({"type": kind, "features": features}), encoding="utf-8")
    return str(path)


def read_features(spark, tmp_path, features):
    return areas.explode_features(read_collections(spark, write(tmp_path, features)))


@pytest.mark.parametrize(
    "document, rule",
    [
        ({"type": "Feature", "features": []}, "not_a_feature_collection"),
        ({"features": []}, "not_a_feature_collection"),
        ({"type": "FeatureCollection", "features": {"a": 1}}, "features_not_a_list"),
        ({"type": "FeatureCollection"}, "features_not_a_list"),
        ({"type": "FeatureCollection", "features": []}, None),
    ],
)
def test_container_rules(spark, tmp_path, document, rule):
    path = tmp_path / "c.geojson"
    path.write_text(json.dumps(document))
    got = [r.rule for r in areas.collection_violations(read_collections(spark, str(path))).collect()]
    assert got == ([rule] if rule else [])


def test_feature_rules_with_index(spark, tmp_path):
    no_div = feature(1, 1)
    del no_div["properties"]["div"]
    no_coordinates = feature(1, 1)
    del no_coordinates["geometry"]["coordinates"]
    point = {"properties": feature(1, 1)["properties"], "geometry": {"type": "Point", "coordinates": [1, 2]}}
    cases = [
        (feature(1, 1), None),
        (feature(1, 1, div=None, serv=None, name=None), None),
        (no_div, "missing_required_properties"),
        (point, "unsupported_geometry_type"),
        (no_coordinates, "missing_coordinates"),
        ({"properties": None, "geometry": {}}, "missing_properties_or_geometry"),
        ({"properties": [1], "geometry": {}}, "missing_properties_or_geometry"),
        (feature("x", 1), "not_an_integer"),
        (feature(None, 1), "not_an_integer"),
        (feature("12", 3.9, kind="MultiPolygon"), None),
        ({**feature(1, 1), "geometry": {"type": "Polygon", "coordinates": "no"}}, "malformed_coordinates"),
    ]
    frame = read_features(spark, tmp_path, [c for c, _ in cases])
    got = {r.feature_index: r for r in areas.feature_violations(frame).collect()}
    assert {i: r.rule for i, r in got.items()} == {i: rule for i, (_, rule) in enumerate(cases) if rule}
    assert got[2].missing_keys == "div"
    typed = {r.feature_index: r for r in areas.typed_features(frame).collect()}
    assert sorted(typed) == [i for i, (_, rule) in enumerate(cases) if not rule]
    assert typed[1].div is None and typed[1].name is None
    assert (typed[9].objectid, typed[9].beat) == (12, 3) and len(typed[9].parts) == 1


def test_feature_lines(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text("\n".join(json.dumps(feature(i, i % 2)) for i in range(5)))
    typed = areas.typed_features(read_feature_lines(spark, str(path)))
    assert typed.count() == 5 and typed.select("feature_index").distinct().count() == 5
    mapping = map_areas(spark, str(path), str(tmp_path / "out"), lines=True)
    assert {r.beat: r.source_objectids for r in mapping.collect()} == {0: [0, 2, 4], 1: [1, 3]}


def test_consolidation_and_conflicts(spark, tmp_path):
    frame = read_features(
        spark,
        tmp_path,
        [
            feature(5, 1, name="A"), feature(3, 1), feature(4, 1, name="A"),
            feature(7, 2, serv=9), feature(8, 2, serv=10), feature(9, 2, serv=None),
            feature(10, 3, div=None), feature(11, 3, div=None),
            feature(12, 4, name="B"), feature(13, 4, name="A"),
        ],
    )
    typed = areas.typed_features(frame)
    one = {r.beat: r for r in areas.consolidate(typed).collect()}
    assert (one[1].objectid, one[1].name, one[1].source_feature_count, one[1].source_null_name_count) == (3, "A", 3, 1)
    assert not one[1].name_conflict and not one[3].div_conflict and one[3].div is None
    assert one[2].serv == 10 and one[2].serv_conflict
    found = {(r.beat, r.field): r.chosen for r in areas.conflicts(areas.consolidate(typed)).collect()}
    assert found == {(2, "serv"): "10", (4, "name"): "A"}
    values = areas.conflict_values(typed, areas.consolidate(typed)).collect()
    assert {(r.beat, r.field, r.value) for r in values} == {
        (2, "serv", "9"), (2, "serv", "10"), (2, "serv", None), (4, "name", "A"), (4, "name", "B"),
    }


def test_id_lists_are_complete_whatever_their_length(spark):
    n = 10_001
    typed = spark.range(n).selectExpr("1L AS beat", f"{n} - id AS objectid").union(spark.sql("SELECT 2L, 9L"))
    whole = {r.beat: r.source_objectids for r in areas.inline_source_ids(typed).collect()}
    assert whole == {1: list(range(1, n + 1)), 2: [9]}
    assert areas.source_ids(typed).count() == n + 1


def test_station_rules(spark):
    make = lambda ids: spark.createDataFrame([(i, s, "n", 1.0, 1.0, "l") for i, s in enumerate(ids)], STATION_SCHEMA)
    rules = lambda ids: sorted(r.rule for r in station_violations(make(ids)).collect())
    assert rules([]) == ["no_stations"]
    assert rules(["A", "B"]) == []
    assert rules(["A", "A", "", None]) == ["duplicate_station_id", "invalid_station_id", "invalid_station_id"]
    assert station_violations(default_stations(spark)).count() == 0


def test_tie_goes_to_the_station_listed_first(spark):
    stations = spark.createDataFrame(
        [(2, "Z", "z", 0.0, 1.0, "l"), (1, "Y", "y", 0.0, -1.0, "l"), (3, "A", "a", 0.0, 1.0, "l")], STATION_SCHEMA
    )
    points = spark.createDataFrame([(1, 0.0, 0.0)], "beat long, lat double, lon double")
    for limit in (100, 0):
        assert nearest_station(points, stations, ["beat"], inline_limit=limit).first().station_id == "Y"


@pytest.mark.parametrize("spread", [180.0, 0.05])
def test_both_ways_agree_with_all_pairs(spark, spread):
    from roadcast.functions.geodesic import geodesic_km

    rng = random.Random(int(spread))
    near = lambda middle, half: middle + rng.uniform(-half, half)
    site = lambda: (near(0 if spread > 90 else 32.8, min(spread / 2, 89)), near(0 if spread > 90 else -117.1, spread))
    stations = spark.createDataFrame([(i, f"S{i}", f"n{i}", *site(), "l") for i in range(150)], STATION_SCHEMA)
    points = spark.createDataFrame([(i, *site()) for i in range(60)], "beat long, lat double, lon double")
    pairs = points.crossJoin(stations.select("ordinal", "station_id", F.col("lat").alias("a"), F.col("lon").alias("b")))
    km = F.coalesce(geodesic_km(F.col("lat"), F.col("lon"), F.col("a"), F.col("b")), F.lit(1e9))
    want = pairs.groupBy("beat").agg(F.min(F.struct(km.alias("km"), "ordinal", "station_id")).alias("m"))
    expected = {r.beat: (r.m.station_id, r.m.km) for r in want.collect()}
    for limit in (1000, 10):
        got = nearest_station(points, stations, ["beat"], inline_limit=limit).collect()
        assert {r.beat: (r.station_id, r.distance_km) for r in got} == expected


def test_map_areas_end_to_end(spark, tmp_path):
    left, right = box(-117.20, 32.70, 0.05, 0.05), box(-117.15, 32.70, 0.05, 0.05)
    # drop the float noise of adding, so that the neighbours share an edge exactly
    tidy = lambda ring: [[round(x, 6), round(y, 6)] for x, y in ring]
    features = [
        feature(21, 11, ring=tidy(left), name="North"), feature(20, 11, ring=tidy(right)),
        feature(30, 5, ring=tidy(box(-117.0, 32.55, 0.02, 0.02)), kind="MultiPolygon"),
        feature(31, 5, ring=tidy(box(-116.9, 32.55, 0.04, 0.04))),
    ]
    out = str(tmp_path / "mapping")
    mapping = map_areas(spark, write(tmp_path, features), out)
    assert mapping.columns == list(MAPPING_COLUMNS)
    rows = {r.beat: r for r in mapping.collect()}
    assert rows[11].source_objectids == [20, 21] and rows[11].geometry_type == "Polygon" and rows[11].name == "North"
    assert (rows[11].representative_lat, rows[11].representative_lon) == (32.725, -117.15)
    assert rows[11].station_id == "KSAN" and rows[11].distance_to_station_km == 4.17
    assert rows[5].geometry_type == "MultiPolygon" and rows[5].representative_lon == -116.88
    text = "\n".join(r.value for r in spark.read.text(out).collect())
    document = json.loads(text)
    assert [d["beat"] for d in document] == [5, 11] and list(document[0]) == list(MAPPING_COLUMNS)
    assert document[0]["name"] is None
    assert sorted(r.station_id for r in read_mapping(spark, out).collect()) == sorted(r.station_id for r in rows.values())
    total = mapping_summary(mapping).first()
    assert (total.total_beats, total.collapsed_features, total.null_name_features, total.multipolygon_beats) == (2, 2, 3, 1)
    assert sum(r.n_beats for r in beats_per_station(mapping).collect()) == 2
    assert mapping_rules(mapping).first().rule is None
    assert mapping_rules(mapping.union(mapping)).first().rule == "duplicate_beats"
    assert mapping_rules(mapping.limit(0)).first().rule == "empty_mapping"


def test_strict_rejects_conflicts_and_writes_nothing(spark, tmp_path):
    path = write(tmp_path, [feature(1, 1, serv=9), feature(2, 1, serv=10)])
    out = tmp_path / "out"
    with pytest.raises(RuleError, match="serv"):
        map_areas(spark, path, str(out))
    assert not out.exists()
    assert map_areas(spark, path, str(out), strict=False).first().serv == 10


def test_area_without_surface_is_rejected(spark, tmp_path):
    flat = [[-117.2, 32.7], [-117.1, 32.8], [-117.0, 32.9], [-117.2, 32.7]]
    path = write(tmp_path, [feature(1, 1), feature(2, 2, ring=flat)])
    with pytest.raises(RuleError, match="'beat': 2"):
        map_areas(spark, path, str(tmp_path / "out"))


def test_features_of_several_files_do_not_mix(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for name, x in (("a", -117.2), ("b", -116.9)):
        ring = [[round(px, 6), round(py, 6)] for px, py in box(x, 32.7, 0.05, 0.05)]
        (folder / f"{name}.geojson").write_text(
            json.dumps({"type": "FeatureCollection", "features": [feature(1, 1, ring=ring)]})
        )
    out, document = str(tmp_path / "out"), str(tmp_path / "document")
    row = map_areas(spark, str(folder), out, document=False).first()
    map_areas(spark, str(folder), document)
    assert read_mapping(spark, document).collect() == read_mapping(spark, out).collect()
    assert (row.geometry_type, row.source_feature_count, row.source_objectids) == ("MultiPolygon", 2, [1, 1])
    assert [r.beat for r in read_mapping(spark, out).collect()] == [1]


def test_repeated_point_keys_get_their_own_station_either_way(spark):
    from roadcast.operators.nearest import nearest_station

    points = spark.createDataFrame([(1, 32.1, -117.0), (1, 33.9, -117.0), (1, 32.1, -117.0)], "k int, lat double, lon double")
    rows = [(0, "A", "a", 32.0, -117.0, "x"), (1, "C", "c", 34.0, -117.0, "x")]
    stations = spark.createDataFrame(rows, "ordinal int, station_id string, name string, lat double, lon double, location string")
    for limit in (0, 10):
        found = nearest_station(points, stations, ["k"], inline_limit=limit).collect()
        assert sorted((r.lat, r.station_id) for r in found) == [(32.1, "A"), (32.1, "A"), (33.9, "C")]
