"""Daily CSV snapshots: header check, raw text scan, typed scan, file row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadcast.functions.text import WHITESPACE, strip
from roadcast.operators.quality import header_report, normalize
from roadcast.session import checkpointed
from roadcast.sources.csv_records import POSITION, cells, first_record, read_lines, records, split_states
from roadcast.sources.files import data_files, first_bytes
from roadcast.specs import DatasetSpec

MARK = b"\xef\xbb\xbf"  # a byte order mark


class HeaderError(RuntimeError):
    pass


def _decoded(cell: Column) -> Column:
    """The bytes of a cell as text. Bytes that are not UTF-8 stay in it, for ``is_valid_utf8`` to find."""
    return F.encode(cell, "ISO-8859-1").cast("string")


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Names in the first record, stripped; empty when the file has no header line. Of a folder, its first file counts.

    The first bytes are looked at as well, because the line reader drops a byte order
    mark: a mark stays part of the first name, and a blank first line means there is no header.
    """
    files = data_files(spark, path)
    start = first_bytes(spark, files[0]) if files else b""
    if not start or start[:1] in (b"\n", b"\r"):
        return []
    record = first_record(spark, files[0]).removeprefix(MARK)
    row = spark.createDataFrame([(record,)], "record binary").select(F.transform(cells(F.col("record")), _decoded)).first()
    names = [text.strip(WHITESPACE) for text in row[0]]
    if start == MARK:
        names[0] = MARK.decode() + names[0]
    return names


def check_header(spark: SparkSession, path: str, spec: DatasetSpec) -> list[str]:
    """Header names in file order, or an error naming the offending columns, sorted."""
    names = read_header(spark, path)
    frame = spark.createDataFrame([(names,)], "names array<string>")
    report = header_report(frame, spec.columns).first()
    if report.problem == "empty":
        raise HeaderError(f"dataset {spec.name}: the file has no CSV header")
    if report.problem:
        raise HeaderError(f"dataset {spec.name}: {report.problem} columns {report[report.problem]}")
    return names


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """Where the splits of the files stand (``csv_records.split_states``), kept: a row per split."""
    return checkpointed(split_states(read_lines(spark, path)))


def read_raw(
    spark: SparkSession,
    path: str,
    spec: DatasetSpec,
    names: list[str] | None = None,
    multi_line: bool = True,
    states: DataFrame | None = None,
) -> DataFrame:
    """All cells as text plus the position columns, of a file or of all files in a folder.

    Files are read by many tasks. Cells may hold line breaks, which takes a first scan for
    the states of the splits unless ``states`` are given; ``multi_line=False`` says that none does.
    Columns are bound by position to the checked header, so case and padding of names
    do not matter to Spark. Short records are filled with nulls, long ones cut. Each file has
    a header, and one that differs from ``names`` fails the read.
    """
    names = names if names is not None else check_header(spark, path, spec)
    if multi_line and states is None:
        states = read_states(spark, path)
    split = records(spark, path, states if multi_line else None).select(*POSITION, cells(F.col("record")).alias("_cells"))
    header = F.transform("_cells", lambda c: strip(_decoded(c)))
    expected = F.array(*[F.lit(n.removeprefix(MARK.decode())) for n in names])
    other = F.raise_error(F.concat(F.lit(f"dataset {spec.name}: another header in "), F.col("_file"))).cast("boolean")
    is_data = F.when((F.col("_block") == 0) & (F.col("_order") == 0), F.when(header == expected, False).otherwise(other)).otherwise(True)
    columns = [_decoded(F.get("_cells", F.lit(i))).alias(n) for i, n in enumerate(names)]
    return split.filter(is_data).select(*columns, *POSITION)


def read_typed(spark: SparkSession, path: str, spec: DatasetSpec, multi_line: bool = True) -> DataFrame:
    """Typed columns for profiling: same scan, unparsable cells become null."""
    return normalize(read_raw(spark, path, spec, multi_line=multi_line), spec)


def counted_splits(raw: DataFrame) -> DataFrame:
    """``_file, _block, before`` where no states were read: counts of the rows themselves."""
    splits = raw.groupBy("_file", "_block").agg((F.max("_order") + 1).alias("n"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select("_file", "_block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def with_row_numbers(positioned: DataFrame, splits: DataFrame) -> DataFrame:
    """Add ``row_num``, the record's number within its file; the header is 1.

    ``positioned`` holds some or all rows of a read with the position columns, ``splits`` the
    records before each split. Records of a split are numbered by their order in it, so no
    file is sorted or read by one task.
    """
    starts = splits.select("_file", "_block", F.col("before").alias("_before"))
    return positioned.join(starts, ["_file", "_block"]).withColumn("row_num", F.col("_before") + F.col("_order") + 1).drop("_before")
