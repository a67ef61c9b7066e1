"""Ingestion metadata and partition columns (M1)."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.names import quoted

# The columns added and the zone ingestion times are shown in.
INGESTED_AT = "momento_ingestion"
PROCESS_DATE = "job_process_date"
PARTITION_COLUMNS = ("year", "month", "day")
LOCAL_ZONE = "America/Bogota"
DEFAULT_PARTITION_DATE = "created_at"


def instant(moment: datetime | None) -> Column:
    """The instant as TIMESTAMP: now, or ``moment`` (UTC unless it has a zone)."""
    if moment is None:
        return F.current_timestamp()
    aware = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    since = aware - datetime(1970, 1, 1, tzinfo=timezone.utc)
    micros = (since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds
    return F.timestamp_micros(F.lit(micros))


def utc_to_local(moment: Column, zone: str = LOCAL_ZONE) -> Column:
    """The wall-clock time in ``zone`` of a UTC time."""
    return F.from_utc_timestamp(moment, zone)


def _moment(df: DataFrame, name: str) -> Column:
    column = F.col(quoted(name))
    # a date column nobody converted: what is no date is NULL, and does not end the job
    return column.try_cast("date") if isinstance(df.schema[name].dataType, T.StringType) else column


def add_metadata(
    df: DataFrame,
    process_date: date,
    partition_date: str | None = None,
    *,
    ingested_at: datetime | None = None,
    zone: str = LOCAL_ZONE,
) -> DataFrame:
    """Add ingestion time, run date, and ``year`` (int), ``month``, ``day`` (two digits).

    The partition columns come from ``partition_date`` (``created_at`` by default); if
    there is no such column, from the run date. A NULL date gives a NULL year and the
    texts ``null``.
    """
    run_date = F.lit(process_date.strftime("%Y-%m-%d 00:00:00")).cast("timestamp")
    name = partition_date or DEFAULT_PARTITION_DATE
    moment = _moment(df, name) if name in df.columns else run_date
    year, month, day = PARTITION_COLUMNS
    return df.withColumns(
        {
            INGESTED_AT: utc_to_local(instant(ingested_at), zone),
            PROCESS_DATE: run_date,
            year: F.year(moment),
            month: F.format_string("%02d", F.month(moment)),
            day: F.format_string("%02d", F.dayofmonth(moment)),
        }
    )
