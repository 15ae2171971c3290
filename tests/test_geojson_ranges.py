import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadcast.operators import areas
from roadcast.plans.mapping_job import RuleError, map_areas
from roadcast.sources import geojson_ranges as geo
from roadcast.sources import splits
from roadcast.sources.sinks import join_parts

STRINGS = ["", "a", "}{][", 'quote " here', "back\\slash", '\\"', "\\", "é, 日", "],[", '{"features":[{}]}', ":,"]


def value(rng, depth):
    kind = rng.randrange(6 if depth else 4)
    if kind == 4:
        return [value(rng, depth - 1) for _ in range(rng.randrange(4))]
    if kind == 5:
        return {rng.choice(STRINGS): value(rng, depth - 1) for _ in range(rng.randrange(4))}
    return [rng.choice(STRINGS), rng.randrange(-9, 99), None, True][kind]


def document(rng):
    features = [
        {"type": "Feature", "properties": value(rng, 2), "geometry": value(rng, 3)} if rng.random() < 0.8 else value(rng, 1)
        for _ in range(rng.randrange(6))
    ]
    pairs = [("type", rng.choice(["FeatureCollection", "FeatureCollection", 5, None])), ("features", features)]
    pairs += [(rng.choice(["crs", "bbox", "name", "x"]), value(rng, 3)) for _ in range(rng.randrange(3))]
    rng.shuffle(pairs)
    if rng.random() < 0.1:
        pairs = [p for p in pairs if p[0] != "features"] + [("features", rng.choice([{}, {"a": [{}]}, None, 3]))]
    layout = {"indent": rng.choice([None, None, 1]), "ensure_ascii": rng.random() < 0.5}
    inner = ", ".join(f"{json.dumps(k)}: {json.dumps(v, **layout)}" for k, v in pairs)
    return "{" + inner + "}" + rng.choice(["", "\n", " \n"])


def small_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))


@pytest.fixture()
def restored(spark, monkeypatch):
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    yield
    spark.conf.set(key, old)


@pytest.mark.parametrize("size, sent", [(30, 1_000_000), (90, 0), (1 << 20, 1_000_000)])
def test_ranges_give_what_one_reader_gives(spark, tmp_path, restored, monkeypatch, size, sent):
    monkeypatch.setattr(splits, "MOST_SENT", sent)
    rng = random.Random(size + sent)
    texts = {f"d{i:03d}.json": document(rng) for i in range(40)}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    small_splits(spark, size)
    containers, features = geo.read_documents(spark, str(tmp_path))
    got = {name: {} for name in texts}
    for r in features.selectExpr("source", "feature_index", "to_json(properties) AS p", "to_json(geometry) AS g").collect():
        got[r.source.rpartition("/")[2]][r.feature_index] = (r.p and json.loads(r.p), r.g and json.loads(r.g))
    broken = {r.source.rpartition("/")[2]: r.rule for r in areas.collection_violations(containers).collect()}
    for name, text in texts.items():
        whole = json.loads(text)
        listed = whole["features"] if isinstance(whole["features"], list) else []
        member = lambda f, key: f.get(key) if isinstance(f, dict) else None
        assert got[name] == {i: (member(f, "properties"), member(f, "geometry")) for i, f in enumerate(listed)}, (name, text)
        rule = "not_a_feature_collection" if whole["type"] != "FeatureCollection" else None
        rule = rule or (None if isinstance(whole["features"], list) else "features_not_a_list")
        assert broken.get(name) == rule, (name, text)


BROKEN = (
    [
        ("", "not_a_feature_collection"),
        ("[]", "not_a_feature_collection"),
        ('{"type": "FeatureCollection", "features": [{}]', "not_a_feature_collection"),
        ('{"type": "FeatureCollection", "features": [{}]}}', "not_a_feature_collection"),
        ('{"type": "FeatureCollection", "features": []} trailing', "not_a_feature_collection"),
        ('{"type": "FeatureCollection", "features": [[]], "features": {}}', "features_not_a_list"),
        ('{"type": "FeatureCollection", "features": {}, "features": [{}]}', None),
    ]
)


def test_containers_that_are_no_documents(spark, tmp_path):
    for i, (text, _) in enumerate(BROKEN):
        (tmp_path / f"{i}.json").write_text(text)
    containers, _ = geo.read_documents(spark, str(tmp_path))
    found = {int(r.source.rpartition("/")[2][:-5]): r.rule for r in areas.collection_violations(containers).collect()}
    assert found == {i: rule for i, (text, rule) in enumerate(BROKEN) if rule and text}


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from('"\\a{}[],'), max_size=40), st.booleans())
def test_open_strings(text, inside):
    expected, state, escaped = [inside], inside, False
    for char in text:
        if escaped:
            escaped = False
        elif char == "\\":
            escaped = True
        elif char == '"':
            state = not state
        expected.append(state)
    assert geo.open_strings(np.frombuffer(text.encode(), np.uint8), inside).tolist() == expected


def square(i):
    x = i * 3
    ring = [[x, 0], [x + 1, 0], [x + 1, 1], [x, 1], [x, 0]]
    return {"properties": {"objectid": i, "beat": i, "div": 1, "serv": 1, "name": "a }, { b"}, "geometry": {"type": "Polygon", "coordinates": [ring]}}


def test_the_job_reads_a_document_by_ranges(spark, tmp_path, restored):
    features = [square(i) for i in range(12)]
    path = tmp_path / "areas.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    small_splits(spark, 300)
    mapping = map_areas(spark, str(path), str(tmp_path / "out"))
    assert sorted(r.beat for r in mapping.collect()) == list(range(12))
    assert [m["beat"] for m in json.loads((tmp_path / "out").read_text())] == list(range(12))
    del features[7]["properties"]["div"]
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    with pytest.raises(RuleError, match="'feature_index': 7"):
        map_areas(spark, str(path), str(tmp_path / "out"))


def test_parts_become_one_file(spark, tmp_path):
    rows = spark.range(5000).repartition(6).orderBy("id").selectExpr("CAST(id AS STRING) AS value")
    rows.write.text(str(tmp_path / "parts"))
    (tmp_path / "one").mkdir()
    for _ in range(2):
        if not (tmp_path / "parts").exists():
            rows.write.text(str(tmp_path / "parts"))
        join_parts(spark, str(tmp_path / "parts"), str(tmp_path / "one"))
    assert (tmp_path / "one").read_text() == "".join(f"{i}\n" for i in range(5000))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["one"]
    assert [r.value for r in spark.read.text(str(tmp_path / "one")).limit(3).collect()] == ["0", "1", "2"]
