"""Event time: RFC 3339 with an offset, else the clock in the stream id, else the epoch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewheel.functions.ids import parse_id

_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})$"
#: Largest milliseconds that are an instant (fixed value: the end of year 262142).
MAX_MS = 8210266876799999


def rfc3339(text: Column) -> Column:
    """TIMESTAMP of a strict RFC 3339 string; null without an offset or for any other shape. Beyond microseconds digits are cut."""
    plain = F.regexp_replace(F.translate(F.upper(text), " ", "T"), r"(\.[0-9]{6})[0-9]+", "$1")
    return F.when(text.rlike(_SHAPE), F.try_to_timestamp(plain))


def resolve(stream_id: Column, ts: Column) -> Column:
    """The instant of an event."""
    ms = parse_id(stream_id)["ms"]
    clock = F.when(ms <= MAX_MS, F.timestamp_millis(F.when(ms <= MAX_MS, ms).cast("long")))
    return F.coalesce(rfc3339(ts), clock, F.timestamp_seconds(F.lit(0)))


def date_of(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd")


def dt_for(stream_id: Column, ts: Column) -> Column:
    """UTC date of an event, the partition it lies in."""
    return date_of(resolve(stream_id, ts))


def to_rfc3339(instant: Column) -> Column:
    """RFC 3339 in UTC with as many digits of the fraction as are needed, by threes."""
    micros = F.pmod(F.unix_micros(instant), F.lit(1_000_000))
    fraction = F.when(micros == 0, "").when(micros % 1000 == 0, F.date_format(instant, ".SSS")).otherwise(F.date_format(instant, ".SSSSSS"))
    return F.concat(F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("Z"))


def epoch_to_rfc3339(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def millis_between(start: Column, finish: Column) -> Column:
    """Milliseconds from start to finish, cut toward zero and never below it."""
    return F.greatest(F.lit(0), (F.unix_micros(finish) - F.unix_micros(start)) / 1000).cast("long")
