"""Publish-date parsing (P-3, P-11, P-12, V-3) as native expressions.

The session time zone must be UTC (``inkwell.session``): naive inputs are
read as UTC and every result is a UTC instant.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.functions.text import bind, py_strip

# Only with extended=True: long month names ("January 05, 2025").
LONG_MONTH_PATTERN = "MMMM d, yyyy"
# Zone names that the reader below does not know are left to this pattern.
RFC822_PATTERN = "d MMM yyyy HH:mm:ss [Z][z]"

_WEEKDAY_PREFIX = "^[A-Za-z]{3},[ ]*"

# ISO 8601, extended or basic, calendar or week date; time, seconds, fraction and offset may be left out.
# Groups: 1 year, 3 month, 4 day, 5 week, 6 day of the week, 7 hour, 9 minute, 10 second, 11 fraction, 12 zone.
_ISO = ("^([0-9]{4})(?:(-?)([0-9]{2})\\2([0-9]{2})|-?W([0-9]{2})(?:-?([1-7]))?)"
        "(?:[Tt ]([0-9]{2})(?:(:?)([0-9]{2})(?:\\8([0-9]{2})(?:[.,]([0-9]+))?)?)?"
        " *([Zz]|[+-][0-9]{2}(?::?[0-9]{2}(?::?[0-9]{2})?)?)?)?$")
# Mail and feed dates: 1 day, 2 month, 3 year, 4 hour, 5 minute, 6 second, 7 fraction, 8 zone.
_ZONE = "[+-][0-9]{2}:?[0-9]{2}|[A-Za-z]{1,5}"
_RFC = ("^(?:[A-Za-z]{3,9}[.]?(?:,\\s*|\\s+))?([0-9]{1,2})[\\s-]+([A-Za-z]{3,9})[.]?[\\s-]+([0-9]{4}|[0-9]{2})"
        "(?:[\\sT]+([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]+))?)?)?"
        f"\\s*({_ZONE})?\\s*(?:[(][^()]*[)])?$")
# C library order: 1 month, 2 day, 3 hour, 4 minute, 5 second, 6 zone, 7 year.
_ASC = ("^(?:[A-Za-z]{3,9}[.]?,?\\s+)?([A-Za-z]{3,9})[.]?\\s+([0-9]{1,2}),?\\s+([0-9]{1,2}):([0-9]{2})(?::([0-9]{2}))?"
        f"\\s+(?:({_ZONE})\\s+)?([0-9]{{4}})$")
_MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
# Hours from UTC of zone names in feeds.
_ZONE_HOURS = {
    "z": 0, "ut": 0, "utc": 0, "gmt": 0, "wet": 0, "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7, "mdt": -6, "pst": -8, "pdt": -7,
    "bst": 1, "cet": 1, "cest": 2, "eet": 2, "eest": 3, "msk": 3, "gst": 4, "pkt": 5, "ist": 5.5, "jst": 9, "aest": 10, "aedt": 11,
}
_US = 1_000_000


def _try_ts(s: Column, pattern: str) -> Column:
    return F.try_to_timestamp(s, F.lit(pattern))


def _written(year: Column, month: Column, day: Column, hour, minute, second, fraction, zone) -> Column:
    """Struct of the written day, the time of day in microseconds and the offset in seconds; a part out of range is NULL."""

    def number(c):
        return F.coalesce(c.cast("int"), F.lit(0))

    h, m, sec = number(hour), number(minute), number(second)
    micros = F.rpad(F.substring(F.coalesce(fraction, F.lit("0")), 1, 6), 6, "0").cast("long")
    time = F.when((h < 24) & (m < 60) & (sec < 60), ((h * 60 + m) * 60 + sec).cast("long") * _US + micros)
    digits = F.regexp_replace(zone, ":", "")
    span = number(F.nullif(F.substring(digits, 2, 2), F.lit(""))) * 3600 + number(F.nullif(F.substring(digits, 4, 2), F.lit(""))) * 60 \
        + number(F.nullif(F.substring(digits, 6, 2), F.lit("")))
    named = F.create_map(*[F.lit(x) for name, hours in _ZONE_HOURS.items() for x in (name, int(hours * 3600))])
    offset = (F.when(zone.isNull(), 0).when(zone.rlike("^[+-]"), F.when(span < 86400, F.when(zone.startswith("-"), -span).otherwise(span)))
              .otherwise(F.try_element_at(named, F.lower(zone))))
    date = F.try_to_date(F.format_string("%04d-%02d-%02d", year.cast("int"), month.cast("int"), day.cast("int")), "yyyy-MM-dd")
    return F.struct(F.when(year.cast("int") > 0, date).alias("day"), time.alias("time"), offset.cast("long").alias("offset"))


def _month(name: Column) -> Column:
    """1..12 for a month name or its first three letters, else 0 (no such date)."""
    i = F.array_position(F.array(*[F.lit(m[:3]) for m in _MONTHS]), F.lower(F.substring(name, 1, 3))).cast("int")
    full = F.get(F.array(*[F.lit(m) for m in _MONTHS]), i - 1)
    return F.when((F.length(name) == 3) | (F.lower(name) == full) | (F.lower(name) == "sept"), i).otherwise(0)


def date_parts(raw: Column) -> Column:
    """What a date string says: struct(day, time, offset), or NULL if it is none of the three forms.

    The parts are found by pattern and put together by arithmetic, so a spelling needs no format of its
    own: weekday, seconds, fraction, zone and century may be left out.  Two-digit years below 90 are in
    this century.
    """
    return bind(py_strip(raw), _stripped_parts)


def _stripped_parts(s: Column) -> Column:
    def part(pattern, i):
        return F.nullif(F.regexp_extract(s, pattern, i), F.lit(""))

    iso = [part(_ISO, i) for i in range(13)]
    # The Monday of the week that holds 4 January begins week 1.
    fourth = F.try_to_date(F.concat(iso[1], F.lit("-01-04")), "yyyy-MM-dd")
    week = F.date_add(F.date_sub(fourth, F.weekday(fourth)), (iso[5].cast("int") - 1) * 7 + F.coalesce(iso[6].cast("int"), F.lit(1)) - 1)
    in_year = (iso[5].cast("int") >= 1) & (F.weekofyear(week) == iso[5].cast("int"))
    by_week = F.when(in_year, week)
    iso_year, iso_month, iso_day = (F.when(iso[5].isNull(), c).otherwise(w) for c, w in (
        (iso[1], F.year(by_week).cast("string")), (iso[3], F.month(by_week).cast("string")), (iso[4], F.dayofmonth(by_week).cast("string"))))
    rfc, asc = [part(_RFC, i) for i in range(9)], [part(_ASC, i) for i in range(8)]
    short = rfc[3].cast("int")
    year = F.when(F.length(rfc[3]) > 2, short).otherwise(short + F.when(short < 90, 2000).otherwise(1900))
    none = F.lit(None).cast("string")
    return (F.when(s.rlike(_ISO), _written(iso_year, iso_month, iso_day, iso[7], iso[9], iso[10], iso[11], iso[12]))
            .when(s.rlike(_RFC), _written(year, _month(rfc[2]), rfc[1], *rfc[4:]))
            .when(s.rlike(_ASC), _written(asc[7], _month(asc[1]), asc[2], asc[3], asc[4], asc[5], none, asc[6])))


def read_date(raw: Column) -> Column:
    """The instant a date string names (UTC without a zone), or NULL."""
    return bind(date_parts(raw), lambda p: F.timestamp_micros(
        F.unix_date(p["day"]).cast("long") * 86400 * _US + p["time"] - p["offset"] * _US))


def publish_ts(raw: Column, parsed: Column | None = None, extended: bool = False) -> Column:
    """P-11 parse ladder -> TIMESTAMP (UTC) or NULL when nothing matches.

    ``parsed`` is the feed parser's own UTC timestamp when it exists (ladder
    step 1).  Every step yields NULL on bad input, never an error (V-2/V-3).
    """
    def ladder(s):
        steps = [read_date(s), _try_ts(F.regexp_replace(s, _WEEKDAY_PREFIX, ""), RFC822_PATTERN)]
        return F.coalesce(*steps, *([_try_ts(s, LONG_MONTH_PATTERN)] if extended else []))

    read = bind(py_strip(raw), ladder)
    return read if parsed is None else F.coalesce(parsed.cast("timestamp"), read)


def date_unparsed(raw: Column, ts: Column) -> Column:
    """V-3: a non-empty date string that did not parse (row is kept)."""
    return F.coalesce(raw, F.lit("")).__ne__("") & ts.isNull()


def literal_day(raw: Column) -> Column:
    """P-12: the calendar day written in the string itself, as a DATE.

    A relational DATE column keeps the day of the literal and ignores time and
    zone, so "2025-06-03T02:00:00+05:00" is 2025-06-03 although the instant is
    on 2025-06-02 UTC.  Long month names are accepted here as a DATE reader
    would.  Unreadable -> NULL (the row is quarantined by the loader instead of
    failing the batch).
    """
    s = py_strip(raw)
    rfc = F.regexp_replace(s, _WEEKDAY_PREFIX, "")
    iso_day = F.regexp_extract(s, "^([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    rfc_day = F.regexp_extract(rfc, "^([0-9]{1,2} [A-Za-z]{3} [0-9]{4})", 1)
    long_day = F.regexp_extract(s, "^([A-Za-z]+ [0-9]{1,2}, [0-9]{4})", 1)
    return F.coalesce(
        F.try_to_date(F.nullif(iso_day, F.lit("")), "yyyy-MM-dd"),
        F.try_to_date(F.nullif(rfc_day, F.lit("")), "d MMM yyyy"),
        F.try_to_date(F.nullif(long_day, F.lit("")), LONG_MONTH_PATTERN),
        date_parts(raw)["day"],
    )


def iso_string(ts: Column) -> Column:
    """``datetime.isoformat()`` of a naive timestamp: fraction only when non-zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, "SSSSSS")
    return F.when(frac == "000000", whole).otherwise(F.concat(whole, F.lit("."), frac))


def ts_string(ts: Column) -> Column:
    """Portable rendering used in query outputs: ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
