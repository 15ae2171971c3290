"""Load the daily snapshots: every dataset passes all checks, or no table changes."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from roadcast.functions.times import resolve_run_date
from roadcast.operators.quality import normalize_and_find, violation_message, with_lineage
from roadcast.sources.csv_records import POSITION
from roadcast.sources.csv_snapshots import check_header, counted_splits, read_raw, read_states
from roadcast.sources.files import delete_folder, resolve_sources
from roadcast.sources.releases import forget_run, install, latest, register_run, release
from roadcast.sources.sinks import write_run
from roadcast.specs import DATASETS, DatasetSpec


class RowError(RuntimeError):
    """A row breaks a rule; the message names the first one by row and column."""


@dataclass(frozen=True)
class LoadMetrics:
    dataset: str
    rows_replaced: int
    rows_inserted: int


def prepare(raw: DataFrame, spec: DatasetSpec, run_date: date, load_ts: datetime, source: str) -> DataFrame:
    """Rows as they are stored, plus the position columns and ``_found``: the row's first broken rule, or null."""
    checked = normalize_and_find(raw, spec, keep=POSITION)
    return with_lineage(checked, run_date, source, load_ts)


def load_snapshots(
    spark: SparkSession,
    source_root: str,
    warehouse: str,
    run_date: str | date | None = None,
    specs: Iterable[DatasetSpec] = DATASETS,
    multi_line: bool = True,
    load_ts: datetime | None = None,
) -> list[LoadMetrics]:
    """Full refresh of every table from the files of one day; a dataset lands as a file or as a folder of files.

    Order: all files exist, all headers fit, every dataset is written to a fresh folder while
    its earliest broken rule is found in the same pass, and only when no dataset has
    any is the release written that makes the new folders the content of all tables at once.
    Otherwise the folders of this run are deleted. A load that is killed leaves the tables as
    they were before it.
    """
    specs = tuple(specs)
    day = resolve_run_date(run_date)
    stamp = load_ts or datetime.now(timezone.utc)
    paths = resolve_sources(spark, source_root, day, specs)
    headers = {s.name: check_header(spark, paths[s.name], s) for s in specs}
    base = latest(spark, warehouse)
    install(spark, specs, warehouse)
    written, runs, inserted = {}, {}, {}
    try:
        for spec in specs:
            path = paths[spec.name]
            states = read_states(spark, path) if multi_line else None
            raw = read_raw(spark, path, spec, headers[spec.name], multi_line, states)
            seen = Observation(f"load {spec.name}")
            rows = prepare(raw, spec, day, stamp, path).observe(seen, F.count(F.lit(1)).alias("rows"), earliest().alias("broken"))
            written[spec.name] = write_run(rows.drop(*POSITION, "_found"), warehouse, spec.table)
            if seen.get["broken"]:
                raise RowError(first_error(seen.get["broken"], raw, spec, states))
            inserted[spec.table] = seen.get["rows"]
        for spec in specs:
            runs[spec.table] = register_run(spark, spec, written[spec.name])
        release(spark, warehouse, base, runs, inserted)
    except Exception:
        for spec in specs:
            if spec.name in written:
                forget_run(spark, spec, written[spec.name])
                delete_folder(spark, written[spec.name])
        raise
    return [LoadMetrics(s.name, base["row_counts"].get(s.table, 0), inserted[s.table]) for s in specs]


def earliest() -> Column:
    """The first broken rule by file, split and record, as an aggregate that any order of rows may merge."""
    return F.min(F.when(F.col("_found").isNotNull(), F.struct(*POSITION, "_found")))


def first_error(broken: Row, raw: DataFrame, spec: DatasetSpec, states: DataFrame | None) -> str:
    """Message of the earliest broken rule. The number of its row needs the records before its split only."""
    place = (F.col("_file") == broken["_file"]) & (F.col("_block") == broken["_block"])
    before = (states if states is not None else counted_splits(raw)).filter(place).first()["before"]
    return violation_message(spec, before + broken["_order"] + 1, broken["_found"])
