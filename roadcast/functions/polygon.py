"""Rings as array expressions: closed segments, signed area, orientation.

A ring is ``array<array<double>>`` of points (x, y); a part is a shell followed by
its holes. One part is one row, so these run inside the row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadcast.functions.numeric import let


def _segment(start: Column, end: Column) -> Column:
    return F.struct(
        start[0].alias("x0"), start[1].alias("y0"), end[0].alias("x1"), end[1].alias("y1")
    )


def ring_segments(ring: Column) -> Column:
    """Consecutive segments of a ring, closed if it is not, without zero-length ones."""
    ends = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return F.filter(
        F.zip_with(ring, ends, _segment), lambda s: (s.x0 != s.x1) | (s.y0 != s.y1)
    )


def twice_signed_area(segments: Column) -> Column:
    """Shoelace sum, positive for counter-clockwise rings."""
    return F.aggregate(
        segments, F.lit(0.0), lambda acc, s: acc + (s.x0 - s.x1) * (s.y0 + s.y1)
    )


def ring_area(ring: Column) -> Column:
    return F.abs(twice_signed_area(ring_segments(ring))) / 2


def part_area(part: Column) -> Column:
    """Shell minus holes, in squared units of the coordinates."""
    holes = F.aggregate(
        F.slice(part, 2, F.size(part)), F.lit(0.0), lambda acc, ring: acc + ring_area(ring)
    )
    return ring_area(part[0]) - holes


def oriented_segments(part: Column) -> Column:
    """All segments of a part with the interior on their left (shell counter-clockwise, holes clockwise)."""

    def one(ring: Column, position: Column) -> Column:
        return let(
            ring_segments(ring),
            lambda segments: F.when(
                (twice_signed_area(segments) > 0) == (position == 0), segments
            ).otherwise(
                F.transform(
                    segments,
                    lambda s: F.struct(s.x1.alias("x0"), s.y1.alias("y0"), s.x0.alias("x1"), s.y0.alias("y1")),
                )
            ),
        )

    return F.flatten(F.transform(part, one))
