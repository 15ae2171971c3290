"""Declared shapes of every input and output: datasets, features, mapping, observations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class DatasetSpec:
    """One daily CSV and the table it fills.

    ``columns`` is the table order; the file may hold them in any order.
    """

    name: str
    table: str
    file_name: str
    columns: tuple[str, ...]
    required: frozenset[str]
    integers: frozenset[str] = frozenset()
    timestamps: frozenset[str] = frozenset()

    def column_type(self, column: str) -> T.DataType:
        if column in self.integers:
            return T.IntegerType()
        if column in self.timestamps:
            return T.TimestampNTZType()
        return T.StringType()

    def table_schema(self) -> T.StructType:
        """Typed source columns followed by the three lineage columns."""
        fields = [T.StructField(c, self.column_type(c), c not in self.required) for c in self.columns]
        return T.StructType(fields + LINEAGE_FIELDS)

    def create_table_sql(self, table: str | None = None, using: str = "parquet") -> str:
        body = ", ".join(
            f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
            for f in self.table_schema().fields
        )
        return f"CREATE TABLE IF NOT EXISTS {table or self.table} ({body}) USING {using}"


LINEAGE_FIELDS = [
    T.StructField("snapshot_dt", T.DateType(), False),
    T.StructField("source_file", T.StringType(), False),
    T.StructField("load_ts", T.TimestampType(), False),
]

# Table names, file names and column lists of the two datasets.
BASIC = DatasetSpec(
    name="staging_collisions_basic",
    table="raw.collisions_basic",
    file_name="pd_collisions_datasd.csv",
    columns=(
        "report_id", "date_time", "police_beat", "address_no_primary", "address_pd_primary", "address_road_primary",
        "address_sfx_primary", "address_pd_intersecting", "address_name_intersecting", "address_sfx_intersecting",
        "violation_section", "violation_type", "charge_desc", "injured", "killed", "hit_run_lvl",
    ),
    required=frozenset({"report_id", "date_time", "police_beat", "address_no_primary"}),
    integers=frozenset({"police_beat", "injured", "killed"}),
    timestamps=frozenset({"date_time"}),
)
DETAILS = DatasetSpec(
    name="staging_collisions_details",
    table="raw.collisions_details",
    file_name="pd_collisions_details_datasd.csv",
    columns=(
        "report_id", "date_time", "person_role", "person_injury_lvl", "person_veh_type", "veh_type", "veh_make",
        "veh_model", "police_beat", "address_no_primary", "address_pd_primary", "address_road_primary",
        "address_sfx_primary", "address_pd_intersecting", "address_name_intersecting", "address_sfx_intersecting",
        "violation_section", "violation_type", "charge_desc", "injured", "killed", "hit_run_lvl",
    ),
    required=frozenset({"report_id", "date_time", "police_beat"}),
    integers=frozenset({"police_beat", "injured", "killed"}),
    timestamps=frozenset({"date_time"}),
)
DATASETS = (BASIC, DETAILS)

# Columns whose null rates the detail profile reports.
DETAIL_NULL_COLUMNS = (
    "person_role",
    "person_injury_lvl",
    "injured",
    "killed",
    "veh_type",
    "police_beat",
    "hit_run_lvl",
)

STATION_SCHEMA = "ordinal int, station_id string, name string, lat double, lon double, location string"

# The station list, in the order that decides ties.
STATIONS = (
    ("KSAN", "San Diego International Airport", 32.7338, -117.1933, "Coastal/Downtown"),
    ("KNZY", "North Island Naval Air Station", 32.6992, -117.2153, "Harbor/Coronado"),
    ("KSDM", "Brown Field Municipal", 32.5723, -116.9801, "South San Diego"),
    ("KMYF", "Montgomery-Gibbs Executive", 32.8158, -117.1394, "Kearny Mesa/Inland"),
    ("KRNM", "Ramona Airport", 33.04111, -116.91556, "North Inland/East County"),
    ("KSEE", "Gillespie Field", 32.82472, -116.97222, "East County/El Cajon"),
    ("KNKX", "MCAS Miramar", 32.86833, -117.14167, "North Inland/Miramar"),
)

# Feature properties that must be present (a null value is present), shape kinds,
# and the columns of a mapping row.
FEATURE_KEYS = ("objectid", "beat", "div", "serv")
AREA_GEOMETRIES = ("Polygon", "MultiPolygon")

MAPPING_COLUMNS = (
    "objectid",
    "source_objectids",
    "source_feature_count",
    "source_null_name_count",
    "beat",
    "div",
    "serv",
    "name",
    "geometry_type",
    "representative_lat",
    "representative_lon",
    "station_id",
    "station_name",
    "station_location",
    "distance_to_station_km",
)

# The part of a mapping row the capture reads; other keys are ignored. ``name``
# may be null because the mapping legitimately emits unnamed areas.
MAPPING_READ_SCHEMA = (
    "objectid bigint, beat bigint, name string, representative_lat double, "
    "representative_lon double, station_id string"
)
MAPPING_REQUIRED = ("objectid", "beat", "representative_lat", "representative_lon", "station_id")

# Field names of replies, observations and batch documents.
OBSERVATION_LOG_SCHEMA = (
    "captured_at_utc string, capture_date date, capture string, station_id string, is_failed boolean, "
    "source string, schema_version int, body string"
)
# ``received_at`` orders the replies of one station; it may be null or missing in the files.
RESPONSE_SCHEMA = "station_id string, http_status int, body string, received_at timestamp"

_QV = "struct<unitCode:string,value:double,qualityControl:string>"
_ELEVATION = "struct<unitCode:string,value:double>"
MEASUREMENTS = (
    "temperature",
    "windDirection",
    "windSpeed",
    "windGust",
    "visibility",
    "precipitationLastHour",
    "precipitationLast3Hours",
    "precipitationLast6Hours",
)
OBSERVATION_SCHEMA = (
    "id string, type string, geometry struct<type:string,coordinates:array<double>>, "
    "properties struct<stationId:string,stationName:string,timestamp:timestamp,"
    f"elevation:{_ELEVATION},textDescription:string,icon:string,presentWeather:array<variant>,"
    + ",".join(f"{m}:{_QV}" for m in MEASUREMENTS)
    + f",cloudLayers:array<struct<base:{_ELEVATION},amount:string>>>"
)

BATCH_SCHEMA = (
    "captured_at_utc string, stations_requested array<string>, stations_failed array<string>, "
    "source string, schema_version int, observations array<variant>"
)

# Fixed values written into every observation batch.
BATCH_SOURCE = "https://api.weather.gov"
BATCH_SCHEMA_VERSION = 1
BATCH_PREFIX = "nws_observations"

PROFILE_DAYS = 90
