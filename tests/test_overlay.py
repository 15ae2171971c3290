import math
import random

import pytest
from pyspark.sql import functions as F
from shapes import PARTS, box, count_components, in_triangle, union_area, unit_cells

from roadcast.operators.components import component_labels
from roadcast.operators.interior import representative_points
from roadcast.operators.overlay import open_vertices, union_outline

SCHEMA = f"beat bigint, feature_index bigint, {PARTS}"


def solve(spark, rows):
    outline = union_outline(spark.createDataFrame(rows, SCHEMA)).cache()
    assert open_vertices(outline).count() == 0
    return {r.beat: r for r in representative_points(outline).collect()}


def test_named_shapes(spark):
    big, hole = box(0, 0, 4, 4), box(1, 1, 2, 2)
    shapes = {
        1: ([[[box(0, 0)]], [[box(1, 0)]]], "Polygon", 1, 2.0, (1.0, 0.5)),  # shared edge
        2: ([[[box(0, 0)]], [[box(5, 0)]]], "MultiPolygon", 2, 2.0, (0.5, 0.5)),  # apart, first on a tie
        3: ([[[box(0, 0, 2, 2)]], [[box(1, 1, 2, 2)[::-1]]]], "Polygon", 1, 7.0, (1.5, 1.5)),  # overlap
        4: ([[[big, hole]]], "Polygon", 1, 12.0, (0.5, 2.0)),  # hole
        5: ([[[big, hole]], [[box(1.25, 1.25, 0.5, 0.5)]]], "MultiPolygon", 2, 12.25, (0.5, 2.0)),  # island
        6: ([[[big]], [[hole]]], "Polygon", 1, 16.0, (2.0, 2.0)),  # nested
        7: ([[[box(0, 0)]], [[box(1, 1)]]], "MultiPolygon", 2, 2.0, (0.5, 0.5)),  # touch in a point
        8: ([[[box(0, 0)]]] * 3, "Polygon", 1, 1.0, (0.5, 0.5)),  # copies
        9: ([[[box(0, 0, 2, 2)]], [[box(2, 0.5)]]], "Polygon", 1, 5.0, (1.5, 1.0)),  # corner on an edge
        10: ([[[box(0, 0, 3, 1)]], [[box(1, -1, 1, 3)]]], "Polygon", 1, 5.0, (1.5, 0.5)),  # cross
        11: ([[[box(0, 0)], [box(3, 0, 2, 2)]]], "MultiPolygon", 2, 5.0, (4.0, 1.0)),  # larger part
        12: ([[[box(0, 0, 3, 3), box(1, 1)]], [[box(1, 1)]]], "Polygon", 1, 9.0, (1.5, 1.5)),  # hole filled
    }
    rows, index = [], 0
    for beat, (features, *_rest) in shapes.items():
        for parts in features:
            rows.append((beat, index, parts))
            index += 1
    got = solve(spark, rows)
    for beat, (_features, kind, n_parts, area, point) in shapes.items():
        r = got[beat]
        assert (r.geometry_type, r.n_parts, r.area) == (kind, n_parts, area), beat
        if beat not in (12,):
            assert (r.lon, r.lat) == point, beat


@pytest.mark.parametrize("seed", [0, 1])
def test_random_boxes_against_unit_cells(spark, seed):
    rng, rows, cells = random.Random(seed), [], {}
    for beat in range(30):
        cells[beat] = set()
        for _ in range(rng.randint(1, 14)):
            b = (rng.randint(0, 14), rng.randint(0, 14), rng.randint(1, 4), rng.randint(1, 4))
            rows.append((beat, len(rows), [[box(*b)]]))
            cells[beat] |= unit_cells(*b)
    got = solve(spark, rows)
    for beat, own in cells.items():
        r = got[beat]
        assert (r.area, r.n_parts) == (len(own), count_components(own))
        assert (int(r.lon // 1), int(r.lat // 1)) in own


def test_random_triangles_against_slabs(spark):
    rng, rows, triangles = random.Random(3), [], {}
    for beat in range(15):
        triangles[beat] = [
            [(rng.uniform(-117.3, -117.0), rng.uniform(32.5, 32.8)) for _ in range(3)] for _ in range(rng.randint(1, 12))
        ]
        for t in triangles[beat]:
            rows.append((beat, len(rows), [[[list(p) for p in t]]]))
    got = solve(spark, rows)
    for beat, ts in triangles.items():
        assert got[beat].area == pytest.approx(union_area(ts), abs=1e-10)
        assert any(in_triangle(t, got[beat].lon, got[beat].lat) for t in ts)


def test_components_of_chains_hubs_and_pairs(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)] + [(9, 8), (8, 9), (7, 7)]
    got = component_labels(spark.createDataFrame(links, "a long, b long")).collect()
    want = {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 700)}, 8: 8, 9: 8}
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert component_labels(spark.createDataFrame([], "a long, b long")).count() == 0


def turned(ring, angle, dx, dy):
    c, s = math.cos(angle), math.sin(angle)
    return [[c * x - s * y + dx, s * x + c * y + dy] for x, y in ring]


def test_turned_brick_walls_close(spark):
    """Rectangles that only touch, their common borders equal up to rounding."""
    rng, rows, expected = random.Random(8), [], {}
    for beat in range(40):
        angle, dx, dy = rng.uniform(0, 7), rng.uniform(-118, -116), rng.uniform(32, 33)
        w, h, n = rng.uniform(0.01, 0.5), rng.uniform(0.01, 0.5), 0
        for row in range(3):
            for column in range(3):
                brick = box((column + row % 2 * rng.choice([0.5, 1 / 3])) * w, row * h, w, h)
                rows.append((beat, len(rows), [[turned(brick, angle, dx, dy)]]))
                n += 1
        expected[beat] = (w, h)
    outline = union_outline(spark.createDataFrame(rows, SCHEMA)).cache()
    assert open_vertices(outline).count() == 0
    found = {r.beat: r for r in representative_points(outline).collect()}
    for beat, (w, h) in expected.items():
        assert found[beat].area <= 9 * w * h + 1e-9


def test_turned_overlapping_grids_close_with_their_area(spark):
    rng, rows, cells = random.Random(9), [], {}
    for beat in range(40):
        angle, dx, dy, size = rng.uniform(0, 7), rng.uniform(-118, -116), rng.uniform(32, 33), rng.uniform(0.01, 0.1)
        own = set()
        for _ in range(12):
            b = (rng.randint(0, 8), rng.randint(0, 8), rng.randint(1, 4), rng.randint(1, 4))
            ring = [[size * x, size * y] for x, y in box(*b)]
            rows.append((beat, len(rows), [[turned(ring, angle, dx, dy)]]))
            own |= unit_cells(*b)
        cells[beat] = (own, size)
    outline = union_outline(spark.createDataFrame(rows, SCHEMA)).cache()
    assert open_vertices(outline).count() == 0
    for r in representative_points(outline).collect():
        own, size = cells[r.beat]
        assert r.area == pytest.approx(len(own) * size * size, abs=1e-9) and r.n_parts == count_components(own), r.beat
