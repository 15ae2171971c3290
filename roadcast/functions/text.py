"""Cell-level text rules as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character the Unicode-aware strip removes: tab to carriage return, the
# four separators 1C-1F, space, NEL, NBSP and the Unicode space and line classes.
WHITESPACE = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680]
        + [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)


def strip(text: Column) -> Column:
    """Trim Unicode whitespace on both sides; a set trim, so no regex per cell."""
    return F.btrim(text, F.lit(WHITESPACE))


def trimmed(text: Column) -> Column:
    """A CSV cell: line breaks inside it become ``\\n``, ends trimmed."""
    return strip(F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")))


def filled(text: Column) -> Column:
    """Blank is null."""
    return F.nullif(text, F.lit(""))


def cell(text: Column) -> Column:
    """A CSV cell: line breaks inside it become ``\\n``, ends trimmed, blank is null."""
    return filled(trimmed(text))


def parse_int(text: Column, sql_type: str = "int") -> Column:
    """Whole number or null. Digits may be grouped by single underscores."""
    grouped = F.when(
        F.contains(text, F.lit("_")) & text.rlike(r"^[+-]?[0-9]+(_[0-9]+)+$"),
        F.replace(text, F.lit("_"), F.lit("")),
    ).otherwise(text)
    return grouped.try_cast(sql_type)


ISO_DATE = "[0-9]{4}-[0-9]{2}-[0-9]{2}"


def parse_timestamp(text: Column) -> Column:
    """ISO timestamp with a full date and without zone, or null; never shifted by the session zone."""
    return F.when(text.rlike(rf"\A{ISO_DATE}([T ][^\n]*)?\z"), text.try_cast("timestamp_ntz"))


def parse_iso_date(text: Column) -> Column:
    """Strict ``YYYY-MM-DD`` or null."""
    return F.when(text.rlike(rf"\A{ISO_DATE}\z"), text.try_cast("date"))


def strip_trailing_slashes(path: Column) -> Column:
    return F.rtrim(path, F.lit("/"))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def dated_path(root: Column, day: Column, file_name: Column) -> Column:
    return F.concat_ws("/", strip_trailing_slashes(root), F.date_format(day, "yyyy-MM-dd"), file_name)
