"""Event times: epoch numbers and ISO texts, windows over instants."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tellurion.functions import jsonx

# Above this an epoch number counts milliseconds; keys looked up for a time.
MILLISECONDS_FROM = 10_000_000_000
TIMESTAMP_KEYS = ("timestamp", "utcTimestamp", "utc_timestamp", "time")
# First and last microsecond of the years 1 to 9999.
FIRST_MICRO = -62_135_596_800_000_000
LAST_MICRO = 253_402_300_799_999_999


def iso_text(micros: Column) -> Column:
    """Microseconds since the epoch as ISO text in UTC, fraction only when needed."""
    instant = F.timestamp_micros(micros)
    return F.when(
        micros % 1_000_000 == 0, F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ssxxx")
    ).otherwise(F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))


def iso_timestamp(instant: Column) -> Column:
    return iso_text(F.unix_micros(instant.cast("timestamp")))


def epoch_micros(value: str, kind: str) -> Column:
    """Microseconds of a JSON number that counts epoch seconds or milliseconds.

    Arguments are SQL text: the value and its type name. NULL outside the calendar.
    """
    whole = f"try_variant_get({value}, '$', 'bigint')"
    exact = f"try_variant_get({value}, '$', 'decimal(38,9)')"
    first, last = FIRST_MICRO // 1_000_000, LAST_MICRO // 1000
    # Whole numbers, the usual case, stay in integer arithmetic.
    return F.expr(
        f"""CASE WHEN {kind} = 'BIGINT' THEN
            CASE WHEN {whole} BETWEEN {first} AND {MILLISECONDS_FROM} THEN {whole} * 1000000
              WHEN {whole} BETWEEN {first} AND {last} THEN {whole} * 1000 END
          WHEN {kind} RLIKE '{jsonx.NUMBER_KINDS}' THEN
            CASE WHEN {exact} BETWEEN {first} AND {MILLISECONDS_FROM} THEN CAST(bround({exact} * 1000000) AS BIGINT)
              WHEN {exact} BETWEEN {first} AND {last} THEN CAST(bround({exact} * 1000) AS BIGINT) END END"""
    )


def normalised(value: str, kind: str, micros: str, fallback: str) -> Column:
    """A JSON value as timestamp text; arguments are SQL text.

    Numbers show the instant they count; null, an empty string and a number
    outside the calendar take the fallback; anything else is kept as text.
    """
    return F.expr(
        f"""CASE WHEN {kind} IS NULL OR {kind} = 'VOID' THEN {fallback}
          WHEN {kind} = 'STRING' THEN coalesce(nullif(try_variant_get({value}, '$', 'string'), ''), {fallback})
          WHEN {micros} % 1000000 = 0 THEN date_format(timestamp_micros({micros}), "yyyy-MM-dd'T'HH:mm:ssxxx")
          WHEN {micros} IS NOT NULL THEN date_format(timestamp_micros({micros}), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
          WHEN {kind} RLIKE '{jsonx.NUMBER_KINDS}' THEN {fallback}
          ELSE to_json({value}) END"""
    )


def first_present(members: str) -> Column:
    """The value of the first time key among the members of an object."""
    return F.expr("coalesce(" + ", ".join(f"{members}.{k}" for k in TIMESTAMP_KEYS) + ")")


def event_time(stamp: str, stamp_kind: str, ingested: str, ingested_kind: str) -> Column:
    """Timestamp of a record, else its ingestion time, else an empty string."""
    return (
        F.when(jsonx.truthy(stamp, stamp_kind), jsonx.text(stamp, stamp_kind))
        .when(jsonx.truthy(ingested, ingested_kind), jsonx.text(ingested, ingested_kind))
        .otherwise(F.lit(""))
    )


def parse_iso(text: str) -> datetime:
    """ISO text as an instant; a text without a zone is UTC."""
    parsed = datetime.fromisoformat(text)
    return parsed.replace(tzinfo=UTC) if parsed.tzinfo is None else parsed.astimezone(UTC)


def window_bounds(
    start: str | None = None,
    end: str | None = None,
    since_minutes: int | None = None,
    now: datetime | None = None,
) -> tuple[datetime, datetime]:
    """Bounds of a half-open window, given as a pair or as the last N minutes."""
    if start or end:
        if not (start and end):
            raise ValueError("give both bounds of the window")
        bounds = parse_iso(start), parse_iso(end)
        if bounds[0] >= bounds[1]:
            raise ValueError("the window must start before it ends")
        return bounds
    if since_minutes is None:
        raise ValueError("give a pair of bounds or a number of minutes")
    if since_minutes <= 0:
        raise ValueError("the number of minutes must be positive")
    last = now or datetime.now(UTC)
    return last - timedelta(minutes=since_minutes), last


def in_window(instant: Column, start: datetime, end: datetime) -> Column:
    return (instant >= F.lit(start)) & (instant < F.lit(end))
