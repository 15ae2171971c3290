import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from roadcast.operators import observations as obs
from roadcast.plans.capture_job import capture, capture_split
from roadcast.sources.documents import read_batches, read_observation_log, read_responses
from roadcast.streaming.batches import drain, stream_observations
from roadcast.specs import MAPPING_READ_SCHEMA, RESPONSE_SCHEMA

AT = datetime(2026, 2, 19, 10, 53, 7, tzinfo=timezone.utc)


def body(station, **properties):
    return json.dumps(
        {
            "id": f"obs/{station}",
            "type": "Feature",
            "unknown": 1,
            "geometry": {"type": "Point", "coordinates": [-117.1, 32.7]},
            "properties": {
                "stationId": station,
                "stationName": f"Station {station}",
                "timestamp": "2026-02-19T10:51:00+00:00",
                "temperature": {"unitCode": "wmoUnit:degC", "value": 17.5, "qualityControl": "V"},
                **properties,
            },
        }
    )


def mapping(spark, ids):
    return spark.createDataFrame([(i, i, None, 1.0, 1.0, s) for i, s in enumerate(ids)], MAPPING_READ_SCHEMA)


def responses(spark):
    rows = [("A", 200, body("A"), None), ("B", 503, body("B"), None), ("C", 200, "<html>", None), ("Z", 200, body("Z"), None)]
    return spark.createDataFrame(rows, RESPONSE_SCHEMA)


def test_requested_stations_and_rules(spark):
    frame = mapping(spark, ["B", "A", "", "A", None])
    assert sorted(r.station_id for r in obs.requested_stations(frame).collect()) == ["A", "B"]
    assert [(r.beat, r.missing_field) for r in obs.mapping_violations(frame).collect()] == [(4, "station_id")]


def test_split_and_metrics(spark):
    split = capture_split(mapping(spark, ["A", "B", "C", "D", "A"]), responses(spark), AT)
    assert {r.station_id: r.is_failed for r in split.collect()} == {"A": False, "B": True, "C": True, "D": True}
    m = obs.capture_metrics(split).first()
    assert (m.total_stations, m.succeeded, m.failed) == (4, 1, 3)


def test_failure_rule(spark):
    cases = [(200, "[1]", False), (200, "3", False), (None, "{}", True), (404, "{}", True), (200, "{", True), (200, None, True), (200, '{"a":1,"a":2}', False)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, s int, b string, want boolean")
    bad = df.filter(obs.response_failed(F.col("s"), F.col("b")) != F.col("want")).collect()
    assert bad == []


def test_last_attempt_decides(spark):
    rows = [("A", 1, 200, "{}"), ("A", 2, 503, None), ("B", 1, 503, None), ("B", 3, 200, "{}")]
    tries = spark.createDataFrame(rows, "station_id string, attempt int, http_status int, body string")
    got = {r.station_id: r.http_status for r in obs.last_attempt(tries, ["station_id"], ["attempt"]).collect()}
    assert got == {"A": 503, "B": 200}


def test_capture_document_round_trip_and_stream(spark, tmp_path):
    mapping_path = str(tmp_path / "mapping.json")
    rows = [dict(objectid=i, beat=i, name=None, representative_lat=1.0, representative_lon=1.0, station_id=s, extra=1)
            for i, s in enumerate(["C", "A", "B", ""])]
    with open(mapping_path, "w") as out:
        json.dump(rows, out)
    landed = str(tmp_path / "landed")
    responses(spark).write.parquet(landed)
    root = str(tmp_path / "captures")
    for _ in range(2):  # a rerun of a capture replaces it
        metrics = capture(spark, mapping_path, read_responses(spark, landed), root, AT).first()
    assert (metrics.total_stations, metrics.succeeded, metrics.failed) == (3, 1, 2)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).filter("length > 0")
    found = files.select("path", F.col("content").cast("string").alias("text")).collect()
    assert len(found) == 1 and "/capture_date=2026-02-19/capture=2026-02-19T10-53-07Z/" in found[0].path
    document = json.loads(found[0].text)
    assert list(document) == list(obs.BATCH_FIELDS)
    assert document["captured_at_utc"] == "2026-02-19T10:53:07+00:00"
    assert document["stations_requested"] == ["A", "B", "C"] and document["stations_failed"] == ["B", "C"]
    assert document["observations"] == [json.loads(body("A"))]
    prefix = root + "/nws_observations"
    assert obs.observation_rows(read_batches(spark, prefix)).count() == 1
    target, checkpoint = str(tmp_path / "rows"), str(tmp_path / "cp")
    for _ in range(2):  # the second run finds nothing new
        drain(stream_observations(spark, prefix), target, checkpoint)
    assert [r.station_id for r in spark.read.parquet(target).collect()] == ["A"]
    capture(spark, mapping_path, read_responses(spark, landed), root, AT.replace(hour=11))
    drain(stream_observations(spark, prefix), target, checkpoint)
    assert spark.read.parquet(target).count() == 2


def test_captures_as_rows_hold_the_same_and_are_replaced(spark, tmp_path):
    mapping_path, root = str(tmp_path / "mapping"), str(tmp_path / "captures")
    mapping(spark, ["A", "B"]).write.json(mapping_path)
    for _ in range(2):
        capture(spark, mapping_path, responses(spark), root, AT, document=False)
    capture(spark, mapping_path, responses(spark), root, AT.replace(hour=11), document=False)
    capture(spark, mapping_path, responses(spark), root, AT)
    log = read_observation_log(spark, f"{root}/nws_observations_log")
    assert sorted((r.station_id, r.is_failed, r.body is None) for r in log.collect()) == [("A", False, False)] * 2 + [("B", True, True)] * 2
    as_rows = obs.log_rows(log.filter("captured_at_utc LIKE '%T10%'")).collect()
    batches = obs.observation_rows(read_batches(spark, f"{root}/nws_observations"))
    assert [json.loads(r.body) for r in as_rows] == [json.loads(r.body) for r in batches.collect()]


def test_last_of_repeated_replies_decides_in_the_job(spark, tmp_path):
    early, late = datetime(2026, 2, 19, 10, 1), datetime(2026, 2, 19, 10, 2)
    rows = [("A", 503, None, early), ("A", 200, body("A"), late), ("B", 200, body("B"), early), ("B", 500, None, late), ("C", 200, body("C"), None)]
    mapping_path, root = str(tmp_path / "mapping"), str(tmp_path / "captures")
    mapping(spark, ["A", "B", "C"]).write.json(mapping_path)
    m = capture(spark, mapping_path, spark.createDataFrame(rows, RESPONSE_SCHEMA), root, AT).first()
    assert (m.total_stations, m.succeeded, m.failed) == (3, 2, 1)
    batch = read_batches(spark, f"{root}/nws_observations").first()
    assert batch.stations_failed == ["B"] and len(batch.observations) == 2


def test_typed_observation(spark):
    layers = [{"base": {"unitCode": "wmoUnit:m", "value": 300}, "amount": "BKN"}, {"base": None, "amount": "CLR"}]
    bodies = [body("A", cloudLayers=layers, windGust=None, presentWeather=[{"x": 1}]), body("B"), '{"id":"x"}']
    parsed = obs.parse_observations(spark.createDataFrame([(b,) for b in bodies], "body string"))
    rows = {r.observation_id: r for r in parsed.collect()}
    a = rows["obs/A"]
    assert (a.temperature, a.temperature_unit, a.temperature_qc, a.wind_gust) == (17.5, "wmoUnit:degC", "V", None)
    assert (a.lon, a.lat, a.is_valid, len(a.present_weather)) == (-117.1, 32.7, True, 1)
    assert rows["obs/B"].present_weather == [] and rows["obs/B"].is_valid and not rows["x"].is_valid
    got = sorted((r.observation_id, r.layer, r.amount, r.base) for r in obs.cloud_layers(parsed).collect() if r.layer is not None)
    assert got == [("obs/A", 0, "BKN", 300.0), ("obs/A", 1, "CLR", None)]
    assert obs.cloud_layers(parsed).count() == 4


def test_naive_capture_time_is_refused(spark):
    with pytest.raises(ValueError):
        capture_split(mapping(spark, ["A"]), responses(spark), AT.replace(tzinfo=None))
