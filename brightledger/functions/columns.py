"""Column helpers with fixed semantics.

Every helper takes and returns Spark columns and stays inside the JVM. Date-times
are ``timestamp_ntz``: none of the results depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = {
    "SECOND": 1_000_000,
    "MINUTE": 60_000_000,
    "HOUR": 3_600_000_000,
    "DAY": 86_400_000_000,
}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a date-time without zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            col(ts).cast("timestamp_ntz"))


def unit_no(unit: str, ts: Column | str) -> Column:
    """Running number of the second, minute, hour or day a date-time falls in."""
    micros = epoch_micros(ts)
    return ((micros - F.pmod(micros, F.lit(MICROS[unit]))) / MICROS[unit]).cast("long")


def diff_boundary(unit: str, later: Column | str, earlier: Column | str) -> Column:
    """Number of unit boundaries between two date-times (10:00:59 to 10:01:00 is one minute)."""
    if unit == "DAY":
        return F.datediff(col(later), col(earlier))
    return unit_no(unit, later) - unit_no(unit, earlier)


def from_seconds(seconds: Column | str) -> Column:
    """Seconds since 1970 to a UTC date-time."""
    return from_micros(col(seconds).cast("long") * 1_000_000)


def from_micros(micros: Column | str) -> Column:
    micros = col(micros)
    seconds = (micros / 1_000_000).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def to_zone(ts_utc: Column | str, zone: str) -> Column:
    """UTC date-time to local date-time of a named zone (daylight saving included)."""
    if zone == "UTC":
        return col(ts_utc).cast("timestamp_ntz")
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), col(ts_utc).cast("timestamp_ntz"))


def local_day(seconds: Column | str, zone: str) -> Column:
    """Local date of a session start given in epoch seconds."""
    return F.to_date(to_zone(from_seconds(seconds), zone))


def trunc_hour(ts: Column | str) -> Column:
    return F.date_trunc("HOUR", col(ts)).cast("timestamp_ntz")


def month_start(d: Column | str) -> Column:
    return F.trunc(col(d).cast("date"), "MM")


def path_only(path: Column | str) -> Column:
    """Page path without its query string; null stays null and a leading ``?`` gives ''."""
    return F.regexp_extract(col(path), r"^([^?]*)", 1)


def has(c: Column | str, text: str) -> Column:
    """Case-insensitive containment, null when the text is null."""
    return F.lower(col(c)).contains(text)


def pseudonym(email: Column | str) -> Column:
    """Hex digest of the lower-cased address; addresses leave the jobs only in this form."""
    return F.md5(F.lower(col(email)))


def item_strict(array: Column, n: int) -> Column:
    """Element ``n`` (from 0); an error where the array is too short. A null array gives null."""
    message = F.concat(F.lit(f"no element {n} in an array of "), F.size(array).cast("string"))
    return F.when(array.isNotNull() & (F.size(array) <= n), F.raise_error(message)).otherwise(F.get(array, F.lit(n)))


def item(arr: Column, index: int) -> Column:
    """Zero-based array item, null when out of range."""
    return F.get(arr, F.lit(index))


def split_literal(text: Column | str, sep: str) -> Column:
    """Split at a literal separator (Spark's ``split`` takes a pattern)."""
    return F.split(col(text), r"\Q" + sep + r"\E")


def bucket_ladder(n: Column | str) -> Column:
    """0, 1, 2 or more than two."""
    n = col(n)
    return F.when(n == 1, "1").when(n == 2, "2").when(n > 2, ">2").otherwise("0")


def iso_with_offset(ts_utc: Column | str, zone: str) -> Column:
    """ISO-8601 text of a UTC date-time followed by the zone's offset, e.g. ``-08:00`` or ``+05:30``."""
    minutes = F.timestamp_diff("MINUTE", col(ts_utc), to_zone(ts_utc, zone))
    part = [F.lpad(x.cast("string"), 2, "0") for x in (F.floor(F.abs(minutes) / 60), F.abs(minutes) % 60)]
    return F.concat(F.date_format(col(ts_utc), "yyyy-MM-dd'T'HH:mm:ss"), F.when(minutes < 0, "-").otherwise("+"), part[0], F.lit(":"), part[1])


def money_text(c: Column | str) -> Column:
    """``$1,234.50`` to a double; text that is not a number gives null."""
    return F.trim(F.regexp_replace(col(c), r"[$,]", "")).try_cast("double")
