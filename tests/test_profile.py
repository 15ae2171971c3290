import random
import statistics
from collections import Counter
from datetime import datetime, timedelta

import pytest

from roadcast.operators import profile as p
from roadcast.plans.profile_job import profile_children, profile_parents
from roadcast.specs import BASIC, DETAIL_NULL_COLUMNS, DETAILS

TOP = datetime(2026, 2, 19, 10, 30)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(5)
    roads = ["A ST", "B ST", "C AV", None]
    basic = []
    for i in range(400):
        row = dict.fromkeys(BASIC.columns)
        row.update(
            report_id=f"R{i}", date_time=TOP - timedelta(hours=rng.randint(0, 4000)), police_beat=rng.randint(1, 30),
            address_no_primary="1", address_road_primary=rng.choice(roads), injured=rng.choice([0, 1, None]),
        )
        basic.append(row)
    basic[0]["date_time"], basic[1]["date_time"] = TOP, TOP - timedelta(days=90)
    basic[2]["date_time"] = TOP - timedelta(days=90, seconds=1)
    details = []
    for i in range(400):
        for _ in range(rng.randint(0, 5)):
            row = dict.fromkeys(DETAILS.columns)
            row.update(report_id=f"R{i}", date_time=TOP, police_beat=1, person_role=rng.choice(["DRIVER", None]), killed=rng.choice([0, None, None]))
            details.append(row)
    return basic, details


@pytest.fixture(scope="module")
def frames(spark, data):
    def frame(rows, spec):
        schema = ", ".join(f"{c} {spec.column_type(c).simpleString()}" for c in spec.columns)
        return spark.createDataFrame([tuple(r[c] for c in spec.columns) for r in rows], schema)

    return frame(data[0], BASIC), frame(data[1], DETAILS)


def window_of(basic):
    since = max(r["date_time"] for r in basic) - timedelta(days=90)
    return [r for r in basic if r["date_time"] >= since]


def percent_null(rows, column):
    return round(100 * sum(r[column] is None for r in rows) / len(rows), 2)


def quantile(ordered, share):
    """Linear between the two neighbours."""
    place = share * (len(ordered) - 1)
    low = int(place)
    return ordered[low] + (place - low) * (ordered[min(low + 1, len(ordered) - 1)] - ordered[low])


def test_parents(data, frames):
    rows, got = window_of(data[0]), profile_parents(frames[0])
    ids = {r["report_id"] for r in rows}
    assert {r.report_id for r in got["recent"].select("report_id").collect()} == ids
    assert "R1" in ids and "R2" not in ids  # the edge of the window belongs to it
    assert tuple(got["grain"].first()) == (True, len(ids), len(rows))
    found = [(r.column_name, r.null_pct) for r in got["null_percentages"].collect()]
    assert dict(found) == {c: percent_null(rows, c) for c in BASIC.columns}
    assert [pct for _, pct in found] == sorted((pct for _, pct in found), reverse=True)
    roads = Counter(r["address_road_primary"] for r in rows if r["address_road_primary"])
    assert {r.value: r.n_rows for r in got["top_roads"].collect()} == roads
    beats = Counter(r["police_beat"] for r in rows)
    assert [r.n_rows for r in got["top_beats"].collect()] == [n for _, n in beats.most_common(15)]
    assert {r.hour: r.n_rows for r in got["by_hour"].collect()} == Counter(r["date_time"].hour for r in rows)


def test_children(data, frames):
    parents = window_of(data[0])
    ids = {r["report_id"] for r in parents}
    rows, got = [r for r in data[1] if r["report_id"] in ids], profile_children(*frames)
    assert tuple(got["parents_shape"].first()) == (len(parents), len(BASIC.columns))
    assert tuple(got["children_shape"].first()) == (len(rows), len(DETAILS.columns))
    sizes = Counter(r["report_id"] for r in rows)
    assert {r.report_id: r.n_rows for r in got["rows_per_report"].collect()} == sizes
    n = sorted(sizes.values())
    s = got["rows_per_report_summary"].first()
    expected = [len(n), statistics.mean(n), statistics.stdev(n), n[0], *(quantile(n, q) for q in (0.25, 0.5, 0.75)), n[-1]]
    assert [s.n, s.mean, s.std, s.min, s.p25, s.p50, s.p75, s.max] == pytest.approx(expected)
    assert {r.rows_per_key: r.n_keys for r in got["rows_per_report_frequency"].collect()} == dict(Counter(n).most_common(10))
    nulls = {r.column_name: r.null_pct for r in got["null_percentages"].collect()}
    assert nulls == {c: percent_null(rows, c) for c in DETAIL_NULL_COLUMNS}


def test_grain_and_nulls(spark):
    unique = lambda values: p.grain_check(spark.createDataFrame([(v,) for v in values], "k string"), "k").first()
    assert tuple(unique(["a", "b", None])) == (True, 2, 3)
    assert tuple(unique(["a", None, None])) == (False, 1, 3)
    assert tuple(unique(["a", "a"])) == (False, 1, 2)


def test_null_keys_match_nothing(spark):
    left = spark.createDataFrame([(None,), ("a",)], "report_id string")
    assert p.belonging_to(left, left).count() == 1
    assert p.rows_per_key(left).count() == 1
