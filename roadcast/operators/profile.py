"""Profile of a recent window of parent records and of the child records that belong to them.

Ordered results carry a value tie-break, so they do not depend on file order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadcast.functions.numeric import round_scaled
from roadcast.specs import PROFILE_DAYS


def recent(df: DataFrame, ts: str = "date_time", days: int = PROFILE_DAYS) -> DataFrame:
    """Rows no older than ``days`` before the latest one, boundary and time of day included.

    The cutoff is a scalar subquery: it reads one column, is partially aggregated,
    and reaches the file scan as a pushed filter.
    """
    cutoff = df.select(F.max(ts) - F.make_dt_interval(F.lit(days))).scalar()
    return df.filter(F.col(ts) >= cutoff)


def belonging_to(children: DataFrame, parents: DataFrame, key: str = "report_id") -> DataFrame:
    """Child rows whose key is among the parents' keys (semi-join; a null key matches nothing)."""
    return children.join(parents.select(key), key, "left_semi")


def shape(df: DataFrame) -> DataFrame:
    """One row: how many rows and how many columns."""
    return df.agg(F.count("*").alias("n_rows")).select("n_rows", F.lit(len(df.columns)).alias("n_columns"))


def grain_check(df: DataFrame, key: str) -> DataFrame:
    """One row: is the key unique, its distinct count (nulls left out), the row count.

    Two nulls are a duplicate; one null is not.
    """
    return df.agg(
        F.count_distinct(key).alias("n_distinct"),
        F.count(key).alias("n_present"),
        F.count("*").alias("n_rows"),
    ).select(
        ((F.col("n_distinct") == F.col("n_present")) & (F.col("n_rows") - F.col("n_present") <= 1)).alias("is_unique"),
        "n_distinct",
        "n_rows",
    )


def null_percentages(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Percentage of nulls per column to two decimals, highest first.

    All columns come from one aggregate over one scan; only its single row is unpivoted,
    so the result is one partition and needs no exchange to be in order.
    """
    columns = list(columns or df.columns)
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    return (
        shares.unpivot([], columns, "column_name", "share")
        .sortWithinPartitions(F.desc("share"), "column_name")
        .select("column_name", round_scaled(F.col("share") * 100, 2).alias("null_pct"))
    )


def frequencies(df: DataFrame, value: str | Column, name: str = "value") -> DataFrame:
    """Count per non-null value, unordered."""
    column = F.col(value) if isinstance(value, str) else value
    return (
        df.select(column.alias(name)).filter(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n_rows"))
    )


def top_values(df: DataFrame, value: str, k: int, name: str = "value") -> DataFrame:
    """The ``k`` most frequent values, ties by value."""
    return frequencies(df, value, name).orderBy(F.desc("n_rows"), name).limit(k)


def hour_histogram(df: DataFrame, ts: str = "date_time") -> DataFrame:
    return frequencies(df, F.hour(ts), "hour").orderBy("hour")


def rows_per_key(df: DataFrame, key: str = "report_id") -> DataFrame:
    """Group sizes; rows without a key belong to no group."""
    return frequencies(df, key, key)


def describe_counts(counts: DataFrame, value: str = "n_rows") -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles (interpolated) and maximum in one row.

    ``percentile`` keeps one entry per distinct value. For group sizes over N rows
    that is below sqrt(2 N), since k distinct sizes need k (k + 1) / 2 rows.
    """
    return counts.agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"),
        F.max(value).alias("max"),
    ).select(
        "n",
        "mean",
        "std",
        "min",
        F.col("q")[0].alias("p25"),
        F.col("q")[1].alias("p50"),
        F.col("q")[2].alias("p75"),
        "max",
    )


def count_frequencies(counts: DataFrame, k: int = 10, value: str = "n_rows") -> DataFrame:
    """How many groups have each size; the ``k`` most frequent sizes."""
    return (
        counts.groupBy(F.col(value).alias("rows_per_key"))
        .agg(F.count("*").alias("n_keys"))
        .orderBy(F.desc("n_keys"), "rows_per_key")
        .limit(k)
    )
