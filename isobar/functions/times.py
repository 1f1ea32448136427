"""Timestamp parsing, bucketing, zones, labels and the near-slot test."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text forms of reading times.
OFFSET_FORM = "yyyy-MM-dd HH:mm:ssXXX"
T_FORM = "yyyy-MM-dd'T'HH:mm"
PLAIN_FORM = "yyyy-MM-dd HH:mm"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
LABEL_FORM = "MM-dd HH:mm"
CREATED_FORM = "yyyy-MM-dd HH:mm:ss.SSSSSS"
JAKARTA = "Asia/Jakarta"

# Minutes of the slots.
SLOT_MINUTES = {"hourly": (0,), "quarter": (0, 15, 30, 45)}


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_reading_time(text: Column | str, zone: str | None = None) -> Column:
    """Instant of a reading time in any provider's text form; null where it does not parse.

    Texts with an offset carry their own zone. The others are wall-clock times of `zone`, or of the
    session zone when none is given.
    """
    text = as_column(text)
    local = F.when(text.contains("T"), F.try_to_timestamp(text, F.lit(T_FORM))).otherwise(
        F.try_to_timestamp(text, F.lit(PLAIN_FORM))
    )
    return F.when(text.contains("+"), F.try_to_timestamp(text, F.lit(OFFSET_FORM))).otherwise(
        wall_clock_to_instant(local, zone)
    )


def parse_mixed_time(text: Column | str, zone: str | None = None) -> Column:
    """`parse_reading_time`, then every form Spark itself reads (seconds, microseconds, dates)."""
    text = as_column(text)
    general = F.try_to_timestamp(text)
    return F.coalesce(
        parse_reading_time(text, zone),
        F.when(text.contains("+"), general).otherwise(wall_clock_to_instant(general, zone)),
    )


def wall_clock_to_instant(ts: Column, zone: str | None) -> Column:
    """Reads the session wall clock of `ts` as a wall clock of `zone`."""
    if zone is None:
        return ts
    return F.convert_timezone(
        F.lit(zone), F.current_timezone(), ts.cast("timestamp_ntz")
    ).cast("timestamp")


def iso_text(ts: Column | str) -> Column:
    return F.date_format(as_column(ts), ISO_SECONDS)


def hour_of(ts: Column | str) -> Column:
    return F.date_trunc("hour", as_column(ts))


def quarter_hour_of(ts: Column | str) -> Column:
    """Start of the 15-minute slot. Works on wall clocks too, as every slot lies inside an hour."""
    ts = as_column(ts)
    slot = F.floor(F.minute(ts) / 15) * 15
    return F.date_trunc("hour", ts) + F.make_dt_interval(mins=slot.cast("int"))


def nearest_hour(ts: Column | str) -> Column:
    """Minute 30 and later goes up."""
    return F.date_trunc("hour", as_column(ts) + F.expr("INTERVAL 30 MINUTES"))


def label(ts: Column | str) -> Column:
    return F.date_format(as_column(ts), LABEL_FORM)


def zoned_text(epoch_seconds: Column | str, zone: str = JAKARTA, offset: str = "+07:00") -> Column:
    """Epoch seconds as wall-clock text of `zone` with its (fixed) offset."""
    wall = wall_clock(F.timestamp_seconds(as_column(epoch_seconds)), zone)
    return F.concat(F.date_format(wall, "yyyy-MM-dd HH:mm:ss"), F.lit(offset))


def shift_zone(wall: Column | str, source: str = "+03:00", target: str = "-07:00") -> Column:
    """Wall clock of the source offset as wall clock of the target offset; no daylight saving."""
    return F.convert_timezone(F.lit(source), F.lit(target), as_column(wall).cast("timestamp_ntz"))


def t_text(ts: Column | str) -> Column:
    return F.date_format(as_column(ts), T_FORM)


def wall_clock(ts: Column | str, zone: str = JAKARTA) -> Column:
    """Wall clock of an instant in a zone."""
    return F.convert_timezone(
        F.current_timezone(), F.lit(zone), as_column(ts).cast("timestamp_ntz")
    )


def append_seconds(text: Column | str, suffix: str = ":00") -> Column:
    """`yyyy-MM-ddTHH:mm` text as `yyyy-MM-dd HH:mm` plus a suffix such as `:00` or `:00-07`."""
    return F.concat(F.replace(as_column(text), F.lit("T"), F.lit(" ")), F.lit(suffix))


def near_slot(
    ts: Column | str, slots: str = "hourly", tolerance: int = 2, wrap: bool = False
) -> Column:
    """Whether the minute is within `tolerance` of a slot minute.

    Without `wrap` minutes 58 and 59 are not near 0; with it the distance is taken on the clock.
    """
    if slots not in SLOT_MINUTES:
        raise ValueError(f"no slots named {slots!r}; use one of {sorted(SLOT_MINUTES)}")
    minute = F.minute(as_column(ts))
    near = F.lit(False)
    for base in SLOT_MINUTES[slots]:
        gap = F.abs(minute - base)
        if wrap:
            gap = F.least(gap, 60 - gap)
        near = near | (gap <= tolerance)
    return near
