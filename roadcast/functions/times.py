"""Time text and keys. Nothing here depends on the session time zone."""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadcast.functions.text import ISO_DATE
from roadcast.specs import BATCH_PREFIX


def utc_clock(ts: Column) -> Column:
    """Wall clock in UTC (``timestamp_ntz``) of an instant, whatever the session zone."""
    micros = F.unix_micros(ts)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), micros.cast("decimal(38,6)") / F.lit(1000000).cast("decimal(7,0)")
    )


def iso_utc(clock: Column) -> Column:
    """ISO text with offset; a fraction only if there is one, in six digits."""
    whole = F.date_format(clock, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(clock, "SSSSSS")
    return F.concat(whole, F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)), F.lit("+00:00"))


def batch_key(clock: Column, prefix: str = BATCH_PREFIX) -> Column:
    """``prefix/yyyy-MM-dd/yyyy-MM-ddTHH-mm-ssZ.json`` for a UTC clock."""
    return F.concat_ws(
        "/",
        F.lit(prefix),
        F.date_format(clock, "yyyy-MM-dd"),
        F.concat(F.date_format(clock, "yyyy-MM-dd'T'HH-mm-ss'Z'"), F.lit(".json")),
    )


def resolve_run_date(run_date: str | date | None = None) -> date:
    """The run date: today when unset, else a date or strict ``YYYY-MM-DD`` text."""
    if not run_date:
        return date.today()
    if isinstance(run_date, datetime):
        return run_date.date()
    if isinstance(run_date, date):
        return run_date
    try:
        if not re.fullmatch(ISO_DATE, run_date):
            raise ValueError("not a full date")
        return date.fromisoformat(run_date)
    except ValueError as exc:
        raise ValueError(f"run date must be YYYY-MM-DD, got {run_date!r}") from exc
