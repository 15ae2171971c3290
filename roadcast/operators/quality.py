"""Cell normalisation, row rules and header rules.

Rules do not abort rows in flight. ``find_violations`` turns every broken rule into
a row of its own (a narrow pass, no shuffle), and the jobs decide on those rows
before anything is written.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadcast.functions import text
from roadcast.specs import DatasetSpec


def _parsed(raw: DataFrame, spec: DatasetSpec, keep: Sequence[str]) -> DataFrame:
    """Each column as trimmed text, and under ``_typed_`` as its cast value where it has a type.

    Projections of their own, so that every cell is trimmed once and cast once however many
    rules look at it. Cells are trimmed as one array: an expression a column makes one long
    generated method that runs several times slower.
    """
    trimmed = F.transform(F.transform(F.array(*[F.col(c) for c in spec.columns]), text.trimmed), text.filled)
    trimmed = raw.select(*keep, trimmed.alias("_trimmed"))
    cells = trimmed.select(*keep, *[F.get("_trimmed", F.lit(i)).alias(c) for i, c in enumerate(spec.columns)])
    return cells.select(
        "*",
        *[text.parse_int(F.col(c)).alias(f"_typed_{c}") for c in spec.columns if c in spec.integers],
        *[text.parse_timestamp(F.col(c)).alias(f"_typed_{c}") for c in spec.columns if c in spec.timestamps],
    )


def _stored(spec: DatasetSpec) -> list[Column]:
    typed = spec.integers | spec.timestamps
    return [F.col(f"_typed_{c}").alias(c) if c in typed else F.col(c) for c in spec.columns]


def normalize(raw: DataFrame, spec: DatasetSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Columns in table order: trimmed, blank to null, cast (a failed cast is null).

    ``keep`` carries extra input columns along.
    """
    return _parsed(raw, spec, keep).select(*keep, *_stored(spec))


def normalize_and_flag(raw: DataFrame, spec: DatasetSpec, keep: Sequence[str] = ()) -> DataFrame:
    """``normalize`` plus ``_broken``: whether any cell of the row breaks a rule."""
    broken = reduce(or_, [failed for c in spec.columns for _, failed in _rules(spec, c)])
    return _parsed(raw, spec, keep).select(*keep, *_stored(spec), broken.alias("_broken"))


def with_lineage(df: DataFrame, run_date: date, source: str | Column, load_ts: datetime) -> DataFrame:
    """Add run date, file base name and one shared load time.

    ``load_ts`` must be zone-aware: it is one value for the whole run, so every
    table of a run carries the same instant.
    """
    if load_ts.tzinfo is None:
        raise ValueError("load_ts needs a time zone")
    path = F.lit(source) if isinstance(source, str) else source
    return df.select(
        "*",
        F.lit(run_date).cast("date").alias("snapshot_dt"),
        text.base_name(path).alias("source_file"),
        F.lit(load_ts.isoformat()).cast("timestamp").alias("load_ts"),
    )


def _rules(spec: DatasetSpec, column: str) -> list[tuple[str, Column]]:
    """Rule name and failure test of one column of a parsed frame, in the order they are checked."""
    value = F.col(column)
    rules = [("invalid_utf8", ~F.coalesce(F.is_valid_utf8(value), F.lit(True)))]
    if column in spec.required:
        rules.append(("required", value.isNull()))
    for rule, columns in (("integer", spec.integers), ("timestamp", spec.timestamps)):
        if column in columns:
            rules.append((rule, value.isNotNull() & F.col(f"_typed_{column}").isNull()))
    return rules


def _findings(spec: DatasetSpec) -> list[Column]:
    """For each column of a parsed frame ``col_ord, column_name, rule, value`` of its first broken rule, or null."""
    broken = []
    for ordinal, column in enumerate(spec.columns):
        chain = None
        for rule, failed in _rules(spec, column):
            found = F.struct(
                F.lit(ordinal).alias("col_ord"),
                F.lit(column).alias("column_name"),
                F.lit(rule).alias("rule"),
                F.col(column).alias("value"),
            )
            chain = F.when(failed, found) if chain is None else chain.when(failed, found)
        broken.append(chain)
    return broken


def normalize_and_find(raw: DataFrame, spec: DatasetSpec, keep: Sequence[str] = ()) -> DataFrame:
    """``normalize`` plus ``_found``: the first broken rule of the row as a struct, or null."""
    # an array for the reason given in `_parsed`
    found = F.get(F.array_compact(F.array(*_findings(spec))), F.lit(0))
    return _parsed(raw, spec, keep).select(*keep, *_stored(spec), found.alias("_found"))


def find_violations(raw: DataFrame, spec: DatasetSpec, keep: Sequence[str] = ("row_num",)) -> DataFrame:
    """One row per broken rule: ``keep`` columns, ``col_ord, column_name, rule, value``.

    ``invalid_utf8`` finds cells with bytes that are not UTF-8, which the CSV reader keeps.
    """
    found = F.explode(F.array_compact(F.array(*_findings(spec)))).alias("v")
    return _parsed(raw, spec, keep).select(*keep, found).select(*keep, "v.*")


def first_violation(violations: DataFrame, row_order: Sequence[str] = ("row_num",)) -> DataFrame:
    """The earliest broken rule, by row and then by table column order (a top-1, no full sort)."""
    return violations.orderBy(*row_order, "col_ord").limit(1)


def violation_message(spec: DatasetSpec, row_num: int, v: T.Row) -> str:
    where = f"dataset {spec.name}, row {row_num}, column {v.column_name}"
    if v.rule == "required":
        return f"{where}: value is missing or empty"
    if v.rule == "invalid_utf8":
        return f"{where}: text is not valid UTF-8"
    return f"{where}: not a valid {v.rule}: {v.value!r}"


def header_report(headers: DataFrame, expected: Sequence[str], names: str = "names") -> DataFrame:
    """Check header rows given as an array column ``names``.

    Adds the sorted arrays ``duplicates, missing, unexpected`` and ``problem``: the
    first rule broken in the order empty, duplicates, missing, unexpected, or null.
    """
    want = F.array(*[F.lit(c) for c in expected])
    have = F.transform(F.col(names), text.strip)
    report = headers.withColumn("_have", have).select(
        *headers.columns,
        F.array_sort(
            F.array_distinct(F.filter("_have", lambda h: F.size(F.filter("_have", lambda o: o == h)) > 1))
        ).alias("duplicates"),
        F.array_sort(F.array_except(want, F.col("_have"))).alias("missing"),
        F.array_sort(F.array_except(F.col("_have"), want)).alias("unexpected"),
    )
    return report.withColumn(
        "problem",
        F.when(F.coalesce(F.size(names), F.lit(0)) <= 0, "empty")
        .when(F.size("duplicates") > 0, "duplicates")
        .when(F.size("missing") > 0, "missing")
        .when(F.size("unexpected") > 0, "unexpected"),
    )
