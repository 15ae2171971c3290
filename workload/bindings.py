"""The given tables in the roles the operators expect.

Every frame covers its whole table. Dirt is derived by rule from the row's key, so
that SQL can state the same input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadcast.functions.times import iso_utc
from roadcast.operators.areas import explode_features
from roadcast.specs import BASIC, DETAILS, DatasetSpec


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as parent records."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("report_id"),
        F.col("o_orderdate").alias("date_time"),
        (F.col("o_custkey") % 100).cast("int").alias("police_beat"),
        F.col("o_orderpriority").alias("address_road_primary"),
        F.nullif((F.col("o_custkey") % 7).cast("int"), F.lit(0)).alias("injured"),
        F.nullif((F.col("o_orderkey") % 3).cast("int"), F.lit(1)).alias("killed"),
        F.nullif(F.col("o_orderstatus"), F.lit("O")).alias("hit_run_lvl"),
    )


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as child records."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("report_id"),
        F.col("l_linenumber").alias("line"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("person_role"),
        F.nullif(F.col("l_linestatus"), F.lit("F")).alias("person_injury_lvl"),
        F.nullif((F.col("l_quantity").cast("int") % 5), F.lit(0)).alias("injured"),
        F.nullif((F.col("l_partkey") % 9).cast("int"), F.lit(4)).alias("killed"),
        F.when(F.col("l_tax") > 0, F.col("l_returnflag")).alias("veh_type"),
        (F.col("l_suppkey") % 100).cast("int").alias("police_beat"),
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("hit_run_lvl"),
    )


EVENT_ROWS = DatasetSpec(
    name="event_rows",
    table="raw.event_rows",
    file_name="event_rows.csv",
    columns=("report_id", "date_time", "police_beat", "injured", "note"),
    required=frozenset({"report_id", "date_time", "police_beat"}),
    integers=frozenset({"police_beat", "injured"}),
    timestamps=frozenset({"date_time"}),
)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as CSV text rows with padding, blanks and bad values."""
    e = F.col("event_id")
    text = lambda c: c.cast("string")
    return table(spark, sf_dir, "events").select(
        (e + 2).alias("row_num"),
        F.when(e % 29 == 0, "  ")
        .when(e % 3 == 0, F.concat(F.lit("\t"), text(e), F.lit(" ")))
        .otherwise(text(e))
        .alias("report_id"),
        F.when(e % 23 == 0, "01/05/2024").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("date_time"),
        F.when(e % 5 == 0, F.concat(F.lit(" "), text(F.col("user_id")))).otherwise(text(F.col("user_id"))).alias("police_beat"),
        F.when(e % 11 == 0, "x")
        .when(e % 7 == 0, "   ")
        .when(e % 13 == 0, "1.0")
        .otherwise(text(e % 4))
        .alias("injured"),
        F.when(e % 9 == 0, "")
        .when(e % 10 == 0, F.concat(F.lit(" "), F.col("event_type"), F.lit("　")))
        .otherwise(F.col("event_type"))
        .alias("note"),
    )


def header_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One header per event, in six variants."""
    names = lambda *values: F.array(*[F.lit(v) if isinstance(v, str) else v for v in values])
    kind = F.col("event_id") % 6
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == 0, names("note", " report_id", "date_time ", "police_beat", "injured"))
        .when(kind == 1, names("report_id", "date_time", "police_beat", "injured"))
        .when(kind == 2, names("report_id", "report_id", "date_time", "police_beat", "injured", "note"))
        .when(kind == 3, names("report_id", "date_time", "police_beat", "injured", "note", F.col("event_type")))
        .when(kind == 4, F.array().cast("array<string>"))
        .otherwise(names("Report_ID", "date_time", "police_beat", "injured", "note"))
        .alias("names"),
    )


def _captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("captured_at"),
        F.concat(F.lit("K"), (F.col("user_id") % 60).cast("string")).alias("station_id"),
        (F.col("user_id") % 60).alias("station_no"),
        F.when(F.col("event_type") == "error", 503).otherwise(200).alias("http_status"),
        F.when(F.col("event_id") % 13 == 0, F.regexp_replace("props", r"\}$", "")).otherwise(F.col("props")).alias("body"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations asked for in each hourly capture."""
    return _captures(spark, sf_dir).select("captured_at", "station_id").distinct()


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All replies as they land."""
    return _captures(spark, sf_dir).select("station_id", "http_status", "body")


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed replies; ten of the stations never answer, others may answer several times."""
    return _captures(spark, sf_dir).filter("station_no < 50").drop("station_no")


def customer_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as mapping rows, some without station or coordinates."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("objectid"),
        (k % 500).alias("beat"),
        F.lit(None).cast("string").alias("name"),
        F.when(k % 41 != 0, 32.0 + (k % 64) / 64).alias("representative_lat"),
        (-117.0 - (k % 64) / 64).alias("representative_lon"),
        F.when(k % 11 == 0, "")
        .when(k % 37 != 0, F.concat(F.lit("K"), (k % 60).cast("string")))
        .alias("station_id"),
    )


def observation_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observation documents in JSON text."""
    e, station = F.col("event_id"), F.col("user_id") % 50
    measured = lambda unit, value: F.struct(
        F.lit(unit).alias("unitCode"), value.alias("value"), F.lit("V").alias("qualityControl")
    )
    layers = F.transform(
        F.slice(F.array(F.lit(0), F.lit(1)), F.lit(1), (e % 3).cast("int")),
        lambda i: F.struct(
            F.struct(F.lit("wmoUnit:m").alias("unitCode"), (i * 100 + station).cast("double").alias("value")).alias("base"),
            F.when(i == 0, "FEW").otherwise("BKN").alias("amount"),
        ),
    )
    properties = F.struct(
        F.concat(F.lit("K"), station.cast("string")).alias("stationId"),
        F.concat(F.lit("Station "), station.cast("string")).alias("stationName"),
        iso_utc(F.col("ts")).alias("timestamp"),
        F.col("event_type").alias("textDescription"),
        measured("wmoUnit:degC", F.col("value")).alias("temperature"),
        F.when(e % 4 != 0, measured("wmoUnit:km_h-1", F.col("value") * 2)).alias("windGust"),
        layers.alias("cloudLayers"),
    )
    return table(spark, sf_dir, "events").select(
        F.to_json(
            F.struct(
                F.when(e % 31 != 0, F.concat(F.lit("obs/"), e.cast("string"))).alias("id"),
                F.lit("Feature").alias("type"),
                F.struct(
                    F.lit("Point").alias("type"),
                    F.array(-117.0 - station / 64, 32.0 + station / 64).alias("coordinates"),
                ).alias("geometry"),
                properties.alias("properties"),
            )
        ).alias("body")
    )


def _ring(x: Column, y: Column, w: Column, h: Column) -> Column:
    """Rectangle on a grid of eighths of a degree."""
    lon = lambda v: (F.lit(-118.0) + v / 8)
    lat = lambda v: (F.lit(32.0) + v / 8)
    corners = [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
    return F.array(*[F.array(lon(a), lat(b)) for a, b in corners])


def _geojson(kind: Column, coordinates: Column) -> Column:
    return F.concat(F.lit('{"type":"'), kind, F.lit('","coordinates":'), coordinates, F.lit("}"))


def _as_features(df: DataFrame, properties: Column, geometry: Column) -> DataFrame:
    """Every row as a container of one feature in JSON text, parsed and exploded as files are."""
    document = F.concat(F.lit('[{"properties":'), properties, F.lit(',"geometry":'), geometry, F.lit("}]"))
    collections = df.select(
        "s_suppkey", F.lit("FeatureCollection").alias("type"), F.try_parse_json(document).alias("features")
    )
    return explode_features(collections).drop("feature_index").withColumnRenamed("s_suppkey", "feature_index")


def _nation_properties() -> Column:
    k, nation = F.col("s_suppkey"), F.col("s_nationkey").cast("bigint")
    return F.to_json(
        F.struct(
            (k * 10 + 7).alias("objectid"),
            nation.alias("beat"),
            F.when(k % 19 != 0, nation % 5 + F.when(k % 17 == 0, 1).otherwise(0)).alias("div"),
            (nation % 3 + F.when(k % 23 == 0, 8).otherwise(0)).alias("serv"),
            F.when(k % 3 != 0, F.concat(F.lit("area "), nation.cast("string"), F.when(k % 29 == 0, "b").otherwise(""))).alias("name"),
        ),
        {"ignoreNullFields": "false"},
    )


def _nation_geometry() -> Column:
    k = F.col("s_suppkey")
    x, y, w, h = (k * 7) % 13, (k * 5) % 11, k % 3 + 1, k % 4 + 1
    one = F.lit(1)
    shell = _ring(x, y, w, h)
    part = F.when((k % 3 == 2) & (k % 4 >= 2), F.array(shell, _ring(x + 1, y + 1, one, one))).otherwise(F.array(shell))
    several = F.array(part, F.array(_ring(x + 20, y + 3, one, one)))
    return F.when(k % 4 == 0, _geojson(F.lit("MultiPolygon"), F.to_json(several))).otherwise(
        _geojson(F.lit("Polygon"), F.to_json(part))
    )


def nation_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as map features whose area is their nation; shapes overlap, touch and repeat."""
    return _as_features(table(spark, sf_dir, "supplier"), _nation_properties(), _nation_geometry())


def slanted_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as bricks of ten walls that stand at an angle: rectangles that only touch.

    A brick is half a degree by a quarter; rows of four, every second one set off by half a brick.
    """
    k = F.col("s_suppkey")
    beat, nth = k % 10, F.floor(k / 10)
    row, column = F.floor(nth / 4), nth % 4
    x, y = (column + row % 2 * 0.5) * 0.5, row * 0.25
    angle = beat * 0.37 + 0.1

    def corner(u: Column, v: Column) -> Column:
        return F.array(
            -118.3 + F.cos(angle) * u - F.sin(angle) * v, 32.7 + F.sin(angle) * u + F.cos(angle) * v
        )

    ring = F.array(*[corner(x + a, y + b) for a, b in ((0.0, 0.0), (0.5, 0.0), (0.5, 0.25), (0.0, 0.25), (0.0, 0.0))])
    properties = F.to_json(F.struct((k * 10 + 7).alias("objectid"), beat.alias("beat"), F.lit(1).alias("div"), F.lit(1).alias("serv"), F.col("s_name").alias("name")))
    return _as_features(table(spark, sf_dir, "supplier"), properties, _geojson(F.lit("Polygon"), F.to_json(F.array(ring))))


def dirty_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same features with one defect in half of them."""
    kind = F.col("s_suppkey") % 10
    good_p, good_g = _nation_properties(), _nation_geometry()
    properties = (
        F.when(kind == 1, F.regexp_replace(good_p, '"div":[^,]*,', ""))
        .when(kind == 4, "[1]")
        .when(kind == 5, F.regexp_replace(good_p, '"objectid":[0-9]+', '"objectid":"x"'))
        .otherwise(good_p)
    )
    geometry = (
        F.when(kind == 2, '{"type":"Point","coordinates":[1,2]}').when(kind == 3, '{"type":"Polygon"}').otherwise(good_g)
    )
    return _as_features(table(spark, sf_dir, "supplier"), properties, geometry)


def containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One container per supplier, two thirds of them unsound."""
    kind = F.col("s_suppkey") % 3
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.when(kind == 1, "Feature").otherwise("FeatureCollection").alias("type"),
        F.try_parse_json(F.when(kind == 2, '{"a":1}').otherwise("[]")).alias("features"),
    )


def _pair_texts() -> tuple[Column, Column]:
    """Properties and geometry, as JSON text."""
    k = F.col("s_suppkey")
    p = F.floor(k / 2)
    x, y, h, first = (p * 7) % 29, (p * 5) % 23, p % 3 + 1, p % 2 + 1
    gap = F.when(p % 5 == 0, 2).otherwise(0)
    rectangle = F.when(k % 2 == 0, _ring(x, y, first, h)).otherwise(_ring(x + first + gap, y, p % 4 + 1, h))
    properties = F.to_json(
        F.struct(
            (k * 10 + 7).alias("objectid"),
            p.alias("beat"),
            (p % 5).alias("div"),
            (p % 3).alias("serv"),
            F.when(k % 2 == 0, F.col("s_name")).alias("name"),
        ),
        {"ignoreNullFields": "false"},
    )
    return properties, _geojson(F.lit("Polygon"), F.to_json(F.array(rectangle)))


def pair_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in pairs: two rectangles of an area that share an edge or, every fifth pair, lie apart."""
    return _as_features(table(spark, sf_dir, "supplier"), *_pair_texts())


def pair_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same features as the sorted lines of one GeoJSON document: ``section, s_suppkey, value``."""
    properties, geometry = _pair_texts()
    feature = F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), geometry, F.lit("}"))
    suppliers = table(spark, sf_dir, "supplier")
    first = suppliers.select(F.min("s_suppkey")).scalar()
    lead = F.when(F.col("s_suppkey") == first, "").otherwise(",")
    lines = suppliers.select(F.lit(1).alias("section"), "s_suppkey", F.concat(lead, feature).alias("value"))
    edge = lambda section, text: spark.range(1).select(F.lit(section).alias("section"), F.lit(0).alias("s_suppkey"), F.lit(text).alias("value"))
    return lines.union(edge(0, '{"type":"FeatureCollection","features":[')).union(edge(2, "]}"))


def landed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Orders or line items with all columns of their snapshot, as text."""
    spec, rows = (BASIC, basic(spark, sf_dir)) if name == "basic" else (DETAILS, details(spark, sf_dir))
    if name != "basic":
        rows = rows.join(basic(spark, sf_dir).select("report_id", "date_time"), "report_id")
    rows = rows.withColumn("date_time", F.date_format(F.col("date_time").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss"))
    rows = rows.withColumn("address_no_primary", F.lit("1"))
    return rows.select(*[(F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string")).alias(c) for c in spec.columns])


def nation_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as stations."""
    n = F.col("n_nationkey").cast("bigint")
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("ordinal"),
        F.concat(F.lit("N"), n.cast("string")).alias("station_id"),
        F.col("n_name").alias("name"),
        (31.5 + (n * 7 % 25) / 10).alias("lat"),
        (-118.5 + (n * 11 % 25) / 10).alias("lon"),
        F.lit("inland").alias("location"),
    )


def supplier_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a station list that grows with the data."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        k.cast("int").alias("ordinal"),
        F.concat(F.lit("S"), k.cast("string")).alias("station_id"),
        F.col("s_name").alias("name"),
        (-60.0 + (k * 37 % 1201) / 10).alias("lat"),
        (-180.0 + (k * 101 % 3601) / 10).alias("lon"),
        F.lit("anywhere").alias("location"),
    )


def customer_points(spark: SparkSession, sf_dir: str, wide: bool) -> DataFrame:
    """Customers as points, in the region of the nation stations or all over the globe."""
    k = F.col("c_custkey")
    lat = -60.0 + (k * 53 % 1199) / 10 + 0.037 if wide else 31.5 + (k * 53 % 251) / 100
    lon = -180.0 + (k * 89 % 3593) / 10 + 0.041 if wide else -118.5 + (k * 89 % 241) / 100
    return table(spark, sf_dir, "customer").select(k.alias("beat"), lat.alias("lat"), lon.alias("lon"))


def customer_station_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a station list with blank and repeated ids."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.cast("int").alias("ordinal"),
        F.when(k % 13 == 0, "").when(k % 17 == 0, F.concat(F.lit("D"), (k % 100).cast("string")))
        .otherwise(F.concat(F.lit("C"), k.cast("string"))).alias("station_id"),
    )
