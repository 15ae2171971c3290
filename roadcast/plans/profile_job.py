"""The profile of recent parent and child records as named result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from roadcast.operators import profile as p
from roadcast.specs import DETAIL_NULL_COLUMNS, PROFILE_DAYS


def profile_parents(basic: DataFrame, days: int = PROFILE_DAYS) -> dict[str, DataFrame]:
    """Results over recent parents; persist ``recent`` when asking for several of them."""
    recent = p.recent(basic, days=days)
    return {
        "recent": recent,
        "grain": p.grain_check(recent, "report_id"),
        "null_percentages": p.null_percentages(recent),
        "top_roads": p.top_values(recent, "address_road_primary", 15),
        "top_beats": p.top_values(recent, "police_beat", 15),
        "by_hour": p.hour_histogram(recent),
    }


def profile_children(basic: DataFrame, details: DataFrame, days: int = PROFILE_DAYS) -> dict[str, DataFrame]:
    """Results over the children of recent parents."""
    recent = p.recent(basic, days=days)
    children = p.belonging_to(details, recent)
    counts = p.rows_per_key(children)
    return {
        "parents_shape": p.shape(recent),
        "children_shape": p.shape(children),
        "rows_per_report": counts,
        "rows_per_report_summary": p.describe_counts(counts),
        "rows_per_report_frequency": p.count_frequencies(counts, 10),
        "null_percentages": p.null_percentages(children, DETAIL_NULL_COLUMNS),
    }
