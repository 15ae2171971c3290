"""Registered queries: name to ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadcast.functions import text
from roadcast.functions.geodesic import geodesic_km
from roadcast.functions.polygon import part_area
from roadcast.functions.times import batch_key, utc_clock
from roadcast.operators import areas, observations as obs, profile as prof, quality
from roadcast.operators.interior import outline_parts, outline_summary, representative_points
from roadcast.operators.mapping import beats_per_station, mapping_rules, mapping_summary
from roadcast.operators.nearest import nearest_station, station_violations
from roadcast.operators.overlay import open_vertices, union_outline
from roadcast.operators.joins import beat_weather, details_with_report
from roadcast.plans.capture_job import capture
from roadcast.plans.mapping_job import RuleError, build_mapping, map_areas
from roadcast.plans.staging_job import RowError, load_snapshots
from roadcast.session import checkpointed, scratch_root
from roadcast.sources.csv_snapshots import HeaderError, read_raw, read_states, with_row_numbers
from roadcast.sources.documents import default_stations, read_batches, read_feature_lines, read_mapping, read_responses
from roadcast.sources.files import SourceMissing, dated_source
from roadcast.sources.geojson_ranges import read_documents
from roadcast.sources.sinks import join_parts, mapping_document, write_batches, write_mapping_document
from roadcast.specs import BASIC, BATCH_PREFIX, DETAIL_NULL_COLUMNS, DETAILS, DatasetSpec
from roadcast.streaming.batches import drain, stream_batches
from workload import bindings as b

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_DATE = date(2024, 2, 1)
CAPTURED_AT = datetime(2024, 2, 1, 6, 30, tzinfo=timezone.utc)
LOAD_TS = datetime(2024, 2, 1, 6, 0, tzinfo=timezone.utc)


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


# --- profile -------------------------------------------------------------------------


def recent_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.belonging_to(b.details(spark, sf_dir), prof.recent(b.basic(spark, sf_dir)))


@register
def rows_per_report_90d(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = prof.rows_per_key(recent_details(spark, sf_dir))
    return prof.count_frequencies(counts, 10)


@register
def recent_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.recent(b.basic(spark, sf_dir)).select("report_id", "date_time", "police_beat", "address_road_primary")


@register
def recent_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_details(spark, sf_dir).select("report_id", "line", "police_beat")


@register
def latest_and_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = F.max("date_time")
    return b.basic(spark, sf_dir).agg(
        latest.alias("latest"), (latest - F.make_dt_interval(F.lit(90))).alias("cutoff")
    )


@register
def parent_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.shape(prof.recent(b.basic(spark, sf_dir)))


@register
def child_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.shape(recent_details(spark, sf_dir))


@register
def grain_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.grain_check(prof.recent(b.basic(spark, sf_dir)), "report_id")


@register
def grain_check_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.grain_check(b.details(spark, sf_dir), "report_id")


@register
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.null_percentages(prof.recent(b.basic(spark, sf_dir)))


@register
def null_profile_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.null_percentages(recent_details(spark, sf_dir), DETAIL_NULL_COLUMNS)


@register
def top_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.top_values(prof.recent(b.basic(spark, sf_dir)), "address_road_primary", 15, "road")


@register
def top_beats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.top_values(prof.recent(b.basic(spark, sf_dir)), "police_beat", 15, "beat")


@register
def hour_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = prof.recent(b.table(spark, sf_dir, "events"), "ts")
    return prof.hour_histogram(recent, "ts")


@register
def rows_per_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.rows_per_key(recent_details(spark, sf_dir))


@register
def rows_per_report_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = prof.describe_counts(prof.rows_per_key(recent_details(spark, sf_dir)))
    return summary.select("n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", "p25", "p50", "p75", "max")


# --- staging -------------------------------------------------------------------------


@register
def normalize_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.normalize(b.raw_events(spark, sf_dir), b.EVENT_ROWS, keep=("row_num",))


def _violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.find_violations(b.raw_events(spark, sf_dir), b.EVENT_ROWS)


@register
def required_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _violations(spark, sf_dir).filter("rule = 'required'").select("row_num", "column_name", "value")


@register
def integer_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _violations(spark, sf_dir).filter("rule = 'integer'").select("row_num", "column_name", "value")


@register
def timestamp_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _violations(spark, sf_dir).filter("rule = 'timestamp'").select("row_num", "column_name", "value")


@register
def first_violation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.first_violation(_violations(spark, sf_dir)).select("row_num", "column_name", "rule", "value")


@register
def staging_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.normalize_and_flag(b.raw_events(spark, sf_dir), b.EVENT_ROWS).agg(
        F.count("*").alias("rows_read"),
        F.count_if(~F.col("_broken")).alias("rows_accepted"),
        F.count_if("_broken").alias("rows_broken"),
    )


@register
def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.raw_events(spark, sf_dir).select("row_num")
    staged = quality.with_lineage(rows, RUN_DATE, "landing/2024-02-01/event_rows.csv", LOAD_TS)
    return staged.withColumn("load_ts", utc_clock(F.col("load_ts")))


@register
def staged_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted rows written as one run's folder and read back, as the load job does."""
    target = _fresh(spark, "staged")
    flagged = quality.normalize_and_flag(b.raw_events(spark, sf_dir), b.EVENT_ROWS)
    flagged.filter(~F.col("_broken")).drop("_broken").write.parquet(target)
    return spark.read.parquet(target)


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _own_tables(*specs) -> list:
    """The datasets with tables of this call, so that queries do not meet."""
    return [replace(spec, table=f"{spec.table.rpartition('.')[2]}_{uuid.uuid4().hex}") for spec in specs]


def _land(rows: DataFrame, target: str) -> None:
    """Land ``rows`` as a folder of CSV files, written by as many tasks as there are."""
    rows.write.option("header", True).csv(target, escape='"')


@register
def load_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load job over orders and line items landed as one day's CSV files: the rows of both tables."""
    root = _fresh(spark, "load-job")
    specs = _own_tables(BASIC, DETAILS)
    for spec, name in zip(specs, ("basic", "details"), strict=True):
        _land(b.landed(spark, sf_dir, name), dated_source(f"{root}/landing", RUN_DATE, spec))
    loaded = load_snapshots(spark, f"{root}/landing", f"{root}/warehouse", RUN_DATE, specs, load_ts=LOAD_TS)
    columns = ("report_id", "date_time", "police_beat", "injured", "snapshot_dt", "source_file", "load_ts")
    tables = [
        spark.table(spec.table).select(F.lit(m.rows_inserted).cast("bigint").alias("rows_inserted"), *columns)
        for spec, m in zip(specs, loaded, strict=True)
    ]
    return tables[0].unionByName(tables[1])


@register
def load_job_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why loads of later days are refused, and the rows that the table still has after each."""
    root = _fresh(spark, "load-refusals")
    (spec,) = _own_tables(BASIC)
    rows = b.landed(spark, sf_dir, "basic")
    key = F.col("report_id").cast("bigint")
    broken = rows.withColumn("police_beat", F.when(key % 50 == 33, "x").otherwise(F.col("police_beat"))).orderBy(key)
    days = [RUN_DATE + timedelta(days=n) for n in range(4)]
    landed = (rows, rows.withColumnRenamed("killed", "dead"), broken)
    for day, made in zip(days, landed, strict=False):
        _land(made, dated_source(f"{root}/landing", day, spec))
    found = []
    for case, day in zip(("good", "header", "row", "file"), days, strict=True):
        try:
            load_snapshots(spark, f"{root}/landing", f"{root}/warehouse", day, [spec], load_ts=LOAD_TS)
            message = ""
        except (HeaderError, RowError, SourceMissing) as refusal:
            message = str(refusal).replace(root, "")
        found.append((case, message, spark.table(spec.table).count()))
    return spark.createDataFrame(found, "load string, message string, rows_in_table long")


@register
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows written as CSV files in another column order, then read and typed by header name."""
    target = _fresh(spark, "csv")
    order = list(reversed(b.EVENT_ROWS.columns))
    b.raw_events(spark, sf_dir).select(*order).write.option("header", True).csv(
        target, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return quality.normalize(read_raw(spark, target, b.EVENT_ROWS), b.EVENT_ROWS)


ROWS_A_FILE = 2000


@register
def row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of records in CSV files whose cells hold quotes, commas and line breaks."""
    target = _fresh(spark, "numbered")
    note = F.concat(F.lit('"'), "event_type", F.lit('", '), F.when(F.col("event_id") % 3 == 0, "\n\n,").otherwise(""), "props")
    rows = b.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"), note.alias("note"), F.floor(F.col("event_id") / ROWS_A_FILE).alias("file")
    )
    dealt = rows.repartition("file").sortWithinPartitions("file", F.col("event_id").cast("bigint"))
    dealt.write.partitionBy("file").option("header", True).csv(target, escape='"')
    spec = DatasetSpec("numbered", "numbered", "numbered.csv", ("event_id", "note"), frozenset())
    states = read_states(spark, target)
    numbered = with_row_numbers(read_raw(spark, target, spec, list(spec.columns), states=states), states)
    return numbered.select(F.col("event_id").cast("bigint").alias("event_id"), F.length("note").cast("bigint").alias("note_length"), "row_num")


@register
def header_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.header_report(b.header_rows(spark, sf_dir), b.EVENT_ROWS.columns)
    joined = [F.array_join(c, ",").alias(c) for c in ("duplicates", "missing", "unexpected")]
    return report.select("event_id", "problem", *joined)


@register
def dated_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = b.table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"))
    path = text.dated_path(F.lit("landing/raw//"), F.col("day"), F.concat(F.lit("rows_"), F.dayofmonth("day"), F.lit(".csv")))
    return (
        days.groupBy("day")
        .agg(F.count("*").alias("n_rows"))
        .select(path.alias("path"), "n_rows")
        .select("path", text.base_name(F.col("path")).alias("source_file"), "n_rows")
    )


@register
def run_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    raw = F.when(e % 3 == 0, F.date_format("ts", "yyyyMMdd")).when(e % 3 == 1, F.date_format("ts", "yyyy-MM-dd")).otherwise(
        F.concat(F.date_format("ts", "yyyy-MM"), F.lit("-32"))
    )
    return (
        b.table(spark, sf_dir, "events")
        .select("event_id", raw.alias("raw"))
        .select("event_id", text.parse_iso_date(F.col("raw")).alias("run_date"))
    )


# --- observations --------------------------------------------------------------------


@register
def mapping_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs.mapping_violations(b.customer_mapping(spark, sf_dir)).select("objectid", "missing_field")


@register
def requested_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs.requested_stations(b.customer_mapping(spark, sf_dir))


CAPTURE = ["captured_at", "station_id"]


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = obs.last_attempt(b.attempts(spark, sf_dir), CAPTURE, ["event_id"])
    return obs.split_responses(b.requests(spark, sf_dir), last, CAPTURE)


@register
def response_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir)


@register
def capture_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs.capture_metrics(_split(spark, sf_dir), ["captured_at"])


@register
def batch_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs.batch_json(obs.batch_documents(_split(spark, sf_dir)))


@register
def batch_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "events").select("event_id", batch_key(F.col("ts")).alias("batch_key"))


@register
def observation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs.observation_log(_split(spark, sf_dir))


@register
def observation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = obs.observation_rows(obs.batch_documents(_split(spark, sf_dir)))
    return rows.select("captured_at_utc", "source", "schema_version", "body")


@register
def stream_observation_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch files of all captures, then read once as a stream."""
    root = _fresh(spark, "captures")
    write_batches(obs.batch_documents(_split(spark, sf_dir)), f"{root}/batches", by_capture=False)
    stream = obs.observation_rows(stream_batches(spark, f"{root}/batches"))
    drain(stream.select("captured_at_utc", "source", "schema_version", "body"), f"{root}/rows", f"{root}/progress")
    return spark.read.parquet(f"{root}/rows")


@register
def observation_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = obs.parse_observations(b.observation_bodies(spark, sf_dir))
    return parsed.select(
        "observation_id",
        "feature_type",
        "station_id",
        "station_name",
        utc_clock(F.col("observed_at")).alias("observed_at"),
        "lon",
        "lat",
        "text_description",
        "temperature",
        "temperature_unit",
        "temperature_qc",
        "wind_gust",
        F.size("present_weather").cast("bigint").alias("n_present_weather"),
        "is_valid",
    )


@register
def observation_cloud_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = obs.cloud_layers(obs.parse_observations(b.observation_bodies(spark, sf_dir)))
    return layers.withColumn("layer", F.col("layer").cast("bigint"))


@register
def response_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies landed as files and read back."""
    target = _fresh(spark, "replies")
    b.replies(spark, sf_dir).write.parquet(target)
    return read_responses(spark, target).drop("received_at")


@register
def capture_job_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The capture job over all replies as one capture's, several a station; its document and metrics."""
    folder = _fresh(spark, "capture-job")
    b.customer_mapping(spark, sf_dir).filter("station_id IS NOT NULL AND representative_lat IS NOT NULL").write.json(f"{folder}/mapping")
    replies = b.attempts(spark, sf_dir).withColumn("received_at", F.timestamp_seconds("event_id"))
    metrics = capture(spark, f"{folder}/mapping", replies, folder, CAPTURED_AT)
    batch = read_batches(spark, f"{folder}/{BATCH_PREFIX}")
    return batch.select(
        "captured_at_utc",
        F.array_join("stations_requested", ",").alias("stations_requested"),
        F.array_join("stations_failed", ",").alias("stations_failed"),
        F.size("observations").cast("bigint").alias("n_observations"),
    ).join(metrics)


@register
def report_detail_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = details_with_report(b.details(spark, sf_dir), b.basic(spark, sf_dir), ["date_time", "police_beat"])
    return joined.select("report_id", "line", "person_role", "report_date_time", "report_police_beat")


@register
def beat_weather_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = _split(spark, sf_dir).filter("NOT is_failed").select("station_id", "captured_at", "http_status")
    return beat_weather(b.customer_mapping(spark, sf_dir), good).select("beat", "station_id", "captured_at", "http_status")


# --- areas ---------------------------------------------------------------------------


@register
def container_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return areas.collection_violations(b.containers(spark, sf_dir)).select("s_suppkey", "rule")


@register
def feature_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return areas.feature_violations(b.dirty_features(spark, sf_dir)).select("feature_index", "rule", "missing_keys")


def _nation_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return areas.typed_features(b.nation_features(spark, sf_dir))


@register
def typed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nation_typed(spark, sf_dir).select(
        "feature_index", "objectid", "beat", "div", "serv", "name", "geometry_type",
        F.size("parts").cast("bigint").alias("n_parts"),
    )


@register
def feature_lines_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features written one per line, then read and typed."""
    target = _fresh(spark, "features")
    b.nation_features(spark, sf_dir).select("properties", "geometry").write.json(target)
    typed = areas.typed_features(read_feature_lines(spark, target))
    return typed.select("objectid", "beat", "div", "serv", "name", "geometry_type")


@register
def beat_consolidation(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = _nation_typed(spark, sf_dir)
    one = areas.consolidate(typed)
    ids = areas.inline_source_ids(typed)
    return one.join(ids, "beat", "left").withColumn("source_objectids", F.array_join("source_objectids", ","))


@register
def beat_source_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return areas.source_ids(_nation_typed(spark, sf_dir))


@register
def beat_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return areas.conflicts(areas.consolidate(_nation_typed(spark, sf_dir)))


@register
def beat_conflict_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = _nation_typed(spark, sf_dir)
    return areas.conflict_values(typed, areas.consolidate(typed))


@register
def station_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return station_violations(b.customer_station_list(spark, sf_dir))


@register
def polygon_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _nation_typed(spark, sf_dir).select("feature_index", F.posexplode("parts").alias("part_no", "part"))
    return parts.select(
        "feature_index", F.col("part_no").cast("bigint").alias("part_no"), F.round(part_area(F.col("part")), 9).alias("area")
    )


@register
def representative_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point inside each feature, every feature being an area of its own."""
    own = _nation_typed(spark, sf_dir).withColumn("beat", F.col("feature_index"))
    points = representative_points(checkpointed(union_outline(own)))
    return points.select("beat", "geometry_type", F.round("lon", 9).alias("lon"), F.round("lat", 9).alias("lat"))


@register
def beat_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = outline_summary(outline_parts(union_outline(_nation_typed(spark, sf_dir))))
    return summary.select("beat", "geometry_type", "n_parts", F.round("area", 9).alias("area"))


@register
def beat_union_slanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walls of slanted bricks: one part each, of the bricks' total area, without an open vertex."""
    outline = checkpointed(union_outline(areas.typed_features(b.slanted_features(spark, sf_dir))))
    opened = open_vertices(outline).groupBy("beat").agg(F.count("*").alias("n_open"))
    return (
        outline_summary(outline_parts(outline))
        .join(opened, "beat", "left")
        .select(
            "beat",
            "geometry_type",
            "n_parts",
            F.round("area", 6).alias("area"),
            F.coalesce("n_open", F.lit(0)).cast("bigint").alias("n_open"),
        )
    )


@register
def beat_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = representative_points(checkpointed(union_outline(_nation_typed(spark, sf_dir))))
    return points.select("beat", F.round("lon", 9).alias("lon"), F.round("lat", 9).alias("lat"))


@register
def union_closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices where a union's outline does not close: none."""
    return open_vertices(union_outline(_nation_typed(spark, sf_dir))).select("beat", "imbalance")


@register
def geodesic_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = b.customer_points(spark, sf_dir, wide=False)
    km = geodesic_km(F.col("lat"), F.col("lon"), F.lit(32.7338), F.lit(-117.1933))
    return points.select("beat", F.round(km, 5).alias("km"))


@register
def nearest_of_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest_station(b.customer_points(spark, sf_dir, wide=False), b.nation_stations(spark, sf_dir), ["beat"])
    return found.select("beat", "station_id", "station_name", F.round("distance_km", 5).alias("distance_km"))


@register
def nearest_of_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken for station lists too long to travel with the plan."""
    found = nearest_station(
        b.customer_points(spark, sf_dir, wide=True), b.supplier_stations(spark, sf_dir), ["beat"], inline_limit=0
    )
    return found.select("beat", "station_id", F.round("distance_km", 5).alias("distance_km"))


def _pair_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = areas.typed_features(b.pair_features(spark, sf_dir))
    return build_mapping(typed, default_stations(spark), strict=True)


@register
def area_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pair_mapping(spark, sf_dir).withColumn("source_objectids", F.array_join("source_objectids", ","))


@register
def mapping_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping written as one JSON array and read back by the capture."""
    target = _fresh(spark, "mapping")
    write_mapping_document(_pair_mapping(spark, sf_dir), target)
    return read_mapping(spark, target)


def _one_document(parts: DataFrame, target: str) -> None:
    """Write text parts in parallel and put their files together as one: ``value`` in order of ``section, s_suppkey``."""
    folder = f"{target}-parts"
    parts.orderBy("section", "s_suppkey").select("value").write.text(folder)
    join_parts(parts.sparkSession, folder, target)


@register
def mapping_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping job over a GeoJSON file; the fields that the capture reads, from the document it wrote."""
    folder = _fresh(spark, "mapping-job")
    _one_document(b.pair_document(spark, sf_dir), f"{folder}/areas.geojson")
    map_areas(spark, f"{folder}/areas.geojson", f"{folder}/mapping")
    return read_mapping(spark, f"{folder}/mapping")


@register
def document_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of one GeoJSON document with their position in its list, read by ranges."""
    folder = _fresh(spark, "document")
    _one_document(b.pair_document(spark, sf_dir), f"{folder}/areas.geojson")
    containers, features = read_documents(spark, f"{folder}/areas.geojson")
    typed = areas.typed_features(features).select("source", "feature_index", "objectid", "beat", "geometry_type")
    return typed.join(containers.select("source", F.col("type").alias("container_type")), "source").drop("source")


@register
def mapping_job_refusal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A strict mapping is refused for the first area whose features disagree; otherwise it takes the value whose text sorts first."""
    typed = _nation_typed(spark, sf_dir)
    try:
        build_mapping(typed, default_stations(spark), strict=True)
        message = ""
    except RuleError as refusal:
        message = str(refusal)
    return spark.createDataFrame([(message,)], "message string")


@register
def area_mapping_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping_rules(_pair_mapping(spark, sf_dir))


@register
def area_mapping_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping_summary(_pair_mapping(spark, sf_dir)).withColumn("avg_distance_km", F.round("avg_distance_km", 6))


@register
def area_beats_per_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return beats_per_station(_pair_mapping(spark, sf_dir))


@register
def area_mapping_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the mapping's JSON array."""
    return mapping_document(_pair_mapping(spark, sf_dir)).select("section", "beat", "value")
