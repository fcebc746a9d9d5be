"""Timestamps as BIGINT nanoseconds since the epoch.

Spark timestamps stop at microseconds and offsets of 18 hours, so they only read ISO
texts, whose fraction is added as an integer. Other layouts are read by one pattern into
their parts, which become days, seconds and nanoseconds by integer arithmetic.
Values outside the BIGINT nanosecond range (years 1678-2262) give NULL.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, functions as F

from ..errors import InvalidPipelineError
from .numbers import parse_float, parse_int

# Nanoseconds per unit of each epoch format.
EPOCH_UNITS = {"unix": 1_000_000_000, "unix_ms": 1_000_000, "unix_us": 1_000, "unix_ns": 1}

# Named layouts.
NAMED_LAYOUTS = {
    "rfc3339": "2006-01-02T15:04:05Z07:00",
    "rfc3339nano": "2006-01-02T15:04:05.999999999Z07:00",
}

# Reference-time layout elements, longest spelling first where one
# is a prefix of another, with the pattern each one reads and the part it fills.
LAYOUT_ELEMENTS = {
    "January": ("[A-Za-z]+", "month_name"),
    "Jan": ("[A-Za-z]{3}", "month_name"),
    "Monday": ("[A-Za-z]+", None),
    "Mon": ("[A-Za-z]{3}", None),
    "MST": ("[A-Z]{3,4}", None),
    "2006": ("[0-9]{4}", "year"),
    "Z07:00:00": ("Z|[+-][0-9]{2}:[0-9]{2}:[0-9]{2}", "zone"),
    "Z070000": ("Z|[+-][0-9]{6}", "zone"),
    "Z07:00": ("Z|[+-][0-9]{2}:[0-9]{2}", "zone"),
    "Z0700": ("Z|[+-][0-9]{4}", "zone"),
    "Z07": ("Z|[+-][0-9]{2}", "zone"),
    "-07:00:00": ("[+-][0-9]{2}:[0-9]{2}:[0-9]{2}", "zone"),
    "-070000": ("[+-][0-9]{6}", "zone"),
    "-07:00": ("[+-][0-9]{2}:[0-9]{2}", "zone"),
    "-0700": ("[+-][0-9]{4}", "zone"),
    "-07": ("[+-][0-9]{2}", "zone"),
    "002": ("[0-9]{3}", "year_day"),
    "__2": ("[ ]{0,2}[0-9]{1,3}", "year_day"),
    "01": ("[0-9]{2}", "month"),
    "02": ("[0-9]{2}", "day"),
    "03": ("[0-9]{2}", "hour12"),
    "04": ("[0-9]{2}", "minute"),
    "05": ("[0-9]{2}", "second"),
    "06": ("[0-9]{2}", "short_year"),
    "15": ("[0-9]{1,2}", "hour"),
    "_2": ("[ ]?[0-9]{1,2}", "day"),
    "PM": ("AM|PM", "half"),
    "pm": ("am|pm", "half"),
    "1": ("[0-9]{1,2}", "month"),
    "2": ("[0-9]{1,2}", "day"),
    "3": ("[0-9]{1,2}", "hour12"),
    "4": ("[0-9]{1,2}", "minute"),
    "5": ("[0-9]{1,2}", "second"),
}
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

_ELEMENT = re.compile("|".join(re.escape(e) for e in LAYOUT_ELEMENTS))
_FRACTION = re.compile(r"[.,](0+|9+)(?![0-9])")

# Nanoseconds per duration unit.
DURATION_UNITS = {
    "ns": 1,
    "us": 1_000,
    "µs": 1_000,
    "μs": 1_000,
    "ms": 1_000_000,
    "s": 1_000_000_000,
    "m": 60_000_000_000,
    "h": 3_600_000_000_000,
}
_DURATION = re.compile(r"([0-9]+(?:\.[0-9]*)?|\.[0-9]+)(ns|us|µs|μs|ms|s|m|h)")


@dataclass(frozen=True)
class Layout:
    """A layout as one regular expression plus the group number of every part."""

    pattern: str
    groups: dict[str, int]


def compile_layout(layout: str) -> Layout:
    """Turn a reference-time layout into a pattern that reads it."""
    layout = NAMED_LAYOUTS.get(layout, layout)
    pieces: list[str] = []
    groups: dict[str, int] = {}
    at = 0
    while at < len(layout):
        element = _ELEMENT.match(layout, at)
        if element is None:
            pieces.append(re.escape(layout[at]))
            at += 1
            continue
        reads, part = LAYOUT_ELEMENTS[element.group()]
        at = element.end()
        if part is None:
            pieces.append(f"(?:{reads})")
            continue
        if part in groups:
            raise InvalidPipelineError(f"timestamp layout {layout!r} repeats an element")
        groups[part] = len(groups) + 1
        pieces.append(f"({reads})")
        if part == "second":
            # Input may carry a fraction here even when the layout has none; a run
            # of zeros in the layout asks for exactly that many digits.
            fraction = _FRACTION.match(layout, at)
            groups["fraction"] = len(groups) + 1
            if fraction and fraction.group(1)[0] == "0":
                pieces.append(f"(?:[.,]([0-9]{{{len(fraction.group(1))}}}))")
            else:
                pieces.append("(?:[.,]([0-9]+))?")
            at = fraction.end() if fraction else at
    if not groups:
        raise InvalidPipelineError(f"timestamp format {layout!r} has no date or time element")
    return Layout("^" + "".join(pieces) + "$", groups)


# Separates the parts of a text; a text that holds it is none of any layout.
_BREAK = "\x01"


def _whole(number: Column, unit: int) -> Column:
    """Integer quotient of a number that is not negative."""
    return F.call_function("div", number, F.lit(unit))


def _days(year: Column, month: Column, day: Column) -> Column:
    """Days since 1970-01-01 of a date after year 0; years are taken to start in March."""
    early = (month <= 2).cast("int")
    since, place = year - early, month + early * 12 - 3
    leaps = _whole(since, 4) - _whole(since, 100) + _whole(since, 400)
    return since * 365 + leaps + _whole(place * 153 + 2, 5) + day - 719469


def _is_leap(year: Column) -> Column:
    return (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))


def _calendar_ns(text: Column, layout: Layout) -> Column:
    """Nanoseconds of a text in any layout; NULL if it does not match or a part is out of range."""
    order = sorted(layout.groups, key=layout.groups.__getitem__)
    marked = F.regexp_replace(text, layout.pattern, "".join(f"{_BREAK}${layout.groups[name]}" for name in order))
    parts = F.split(marked, _BREAK)
    # Each stage is bound to a name, so that the pattern runs once and each part is read once.
    numbers = _bound(F.split(marked, _BREAK), lambda p: _numbers({name: p[n] for n, name in enumerate(order, 1)}))
    value = _bound(numbers, _moment)
    return F.when(marked.startswith(_BREAK) & ~text.contains(_BREAK), value)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def _numbers(parts: dict[str, Column]) -> Column:
    """The parts as numbers: year, month, day, day of year, seconds of the day less the
    offset, nanoseconds. A part out of range is NULL, one that the layout lacks its default."""

    def number(name: str, low: int, high: int, default: int) -> Column:
        if name not in parts:
            return F.lit(default)
        return _bound(F.trim(parts[name]).try_cast("int"), lambda n: F.when(n.between(low, high), n))

    if "short_year" in parts:
        year = _bound(number("short_year", 0, 99, 0), lambda n: n + F.when(n >= 69, 1900).otherwise(2000))
    else:
        year = number("year", 1677, 2262, 0)
    if "month_name" in parts:
        # Places 1, 4, 7 and so on of the joined names.
        name = F.lower(F.substring(parts["month_name"], 1, 3))
        month = _bound(F.instr(F.lit("".join(MONTHS)), name), lambda at: F.when(at % 3 == 1, _whole(at + 2, 3).cast("int")))
    else:
        month = number("month", 1, 12, 1)
    if "hour12" in parts:
        half = F.lower(parts.get("half", F.lit("")))
        hour = _bound(
            number("hour12", 0, 12, 0),
            lambda n: F.when((half == "pm") & (n < 12), n + 12).when((half == "am") & (n == 12), 0).otherwise(n),
        )
    else:
        hour = number("hour", 0, 23, 0)
    clock = hour * 3600 + number("minute", 0, 59, 0) * 60 + number("second", 0, 59, 0)
    if "zone" in parts:
        offset, inside = _offset_seconds(F.replace(parts["zone"], F.lit(":"), F.lit("")))
        clock -= F.when(parts["zone"] == "Z", 0).otherwise(F.when(inside, offset))
    nanos = F.rpad(F.substring(parts["fraction"], 1, 9), 9, "0").cast("bigint") if "fraction" in parts else F.lit(0).cast("bigint")
    # What the layout lacks is told apart from what a text has: a day beside a day of year must agree.
    year_day = number("year_day", 1, 366, 0)
    with_month = F.lit("month_name" in parts or "month" in parts)
    return F.struct(
        year.alias("year"), month.alias("month"), number("day", 1, 31, 1).alias("day"), year_day.alias("year_day"),
        with_month.alias("with_month"), F.lit("day" in parts).alias("with_day"), clock.cast("bigint").alias("clock"), nanos.alias("nanos"),
    )


def _moment(n: Column) -> Column:
    """Nanoseconds of the parts; NULL if there is no such day."""
    year, month, day, year_day = n["year"], n["month"], n["day"], n["year_day"]
    leap = _is_leap(year).cast("int")
    longest = F.when(month == 2, leap + 28).otherwise(30 + (month + (month >= 8).cast("int")) % 2)
    plain = F.when(month.between(1, 12) & (day <= longest), _days(year, month, day))

    def agreeing(days: Column) -> Column:
        date = F.date_from_unix_date(days)
        agrees = (~n["with_month"] | (F.month(date) == month)) & (~n["with_day"] | (F.day(date) == day))
        return F.when(agrees & (year_day <= leap + 365), days)

    days = F.when(year_day == 0, plain).otherwise(_bound(_days(year, F.lit(1), year_day), agreeing))
    billion = F.lit(1_000_000_000).cast("bigint")

    def joined(seconds: Column) -> Column:
        # Before 1970 the second is left towards zero first, so that the first value still fits.
        early = (seconds < 0).cast("bigint")
        return F.try_add(F.try_multiply(seconds + early, billion), n["nanos"] - early * billion)

    return F.when(year > 0, _bound(days.cast("bigint") * 86400 + n["clock"], joined))


def _offset_seconds(zone: Column) -> tuple[Column, Column]:
    """Seconds of an offset ``+hh``, ``+hhmm`` or ``+hhmmss`` and whether it is in range."""
    # Filled up first, as a cast that fails is slow.
    filled = F.rpad(zone, 7, "0")
    hours, minutes, seconds = (F.substring(filled, at, 2).try_cast("int") for at in (2, 4, 6))
    size = hours * 3600 + minutes * 60 + seconds
    return F.when(zone.startswith("-"), -size).otherwise(size), (hours <= 24) & (minutes <= 60) & (seconds <= 60)


def _exact_ns(moment: Column, text: Column, digits: str) -> Column:
    """Microseconds of the cast plus the digits below them that the text has."""
    below = F.rpad(F.regexp_extract(text, digits, 1), 3, "0").try_cast("bigint")
    micros = F.try_multiply(F.unix_micros(moment), F.lit(1000))
    return F.try_add(micros, below)


def _iso_ns(text: Column, suffix: str) -> Column:
    """Layouts already written the way Spark casts need no rebuilding."""

    def cast(part: Column, end: str) -> Column:
        moment = F.concat(F.replace(part, F.lit(","), F.lit(".")), F.lit(end)).try_cast("timestamp")
        return _exact_ns(moment, part, "[.,][0-9]{6}([0-9]{1,3})")

    if suffix:
        return cast(text, suffix)
    # Offsets that Spark does not read are taken off as seconds.
    far = text.rlike("[+-](1[89]|2[0-4]):[0-9]{2}$|[+-][0-9]{2}:60$")
    offset, inside = _offset_seconds(F.replace(F.right(text, F.lit(6)), F.lit(":"), F.lit("")))
    shift = F.lit(-1_000_000_000).cast("bigint") * offset
    moved = F.try_add(cast(F.left(text, F.length(text) - 6), "Z"), shift)
    return F.when(far, F.when(inside, moved)).otherwise(cast(text, ""))


_ISO = re.compile(r"2006-01-02[T ]15:04:05(?:[.,](?:0+|9+))?(Z07:00|-07:00|Z)?$")


def ts_from_text(text: Column, fmt: str) -> Column:
    """A timestamp string (or numeric epoch string) to nanoseconds."""
    if fmt in EPOCH_UNITS:
        whole = parse_int(text)
        return F.when(whole.isNotNull(), ts_from_int(whole, fmt)).otherwise(
            ts_from_float(parse_float(text), fmt)
        )
    layout = compile_layout(fmt)
    iso = _ISO.match(NAMED_LAYOUTS.get(fmt, fmt))
    if iso:
        return F.when(text.rlike(layout.pattern), _iso_ns(text, "" if iso.group(1) else "Z"))
    return _calendar_ns(text, layout)


def ts_from_int(number: Column, fmt: str) -> Column:
    """An integer epoch to nanoseconds; NULL for a date format."""
    if fmt not in EPOCH_UNITS:
        return F.lit(None).cast("bigint")
    return F.try_multiply(number, F.lit(EPOCH_UNITS[fmt]))


def ts_from_float(number: Column, fmt: str) -> Column:
    """A fractional epoch to nanoseconds; whole units stay exact, the rest is rounded."""
    if fmt not in EPOCH_UNITS:
        return F.lit(None).cast("bigint")
    unit = EPOCH_UNITS[fmt]
    whole = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))
    rest = F.round((number - whole) * float(unit)).try_cast("bigint")
    inside = F.abs(number) < 9.2e18
    return F.when(inside, F.try_add(F.try_multiply(whole, F.lit(unit)), rest))


def to_ts_ns(value: Column, fmt: str = "rfc3339", kind: str = "text") -> Column:
    """Shared conversion: ``kind`` says whether the column is text, int or float."""
    convert = {"text": ts_from_text, "int": ts_from_int, "float": ts_from_float}[kind]
    return convert(value, fmt)


def _whole_units(ts_ns: Column, unit: int) -> Column:
    """Floor division that stays in BIGINT."""
    return F.call_function("div", ts_ns, F.lit(unit)) - F.when(
        F.pmod(ts_ns, F.lit(unit)) != ts_ns % F.lit(unit), 1
    ).otherwise(0)


def ns_to_timestamp(ts_ns: Column) -> Column:
    """Spark TIMESTAMP of a nanosecond value, rounded down to microseconds."""
    return F.timestamp_micros(_whole_units(ts_ns, 1000))


def timestamp_to_ns(moment: Column) -> Column:
    """Nanoseconds of a Spark TIMESTAMP."""
    return F.unix_micros(moment) * F.lit(1000)


def ts_text(ts_ns: Column) -> Column:
    """UTC text of a nanosecond value, fraction without trailing zeros."""
    nanos = F.pmod(ts_ns, F.lit(1_000_000_000))
    seconds = _whole_units(ts_ns, 1_000_000_000)
    day = F.date_from_unix_date(F.floor(seconds / 86400).cast("int")).cast("string")
    rest = F.pmod(seconds, F.lit(86400))
    clock = F.format_string(
        "%02d:%02d:%02d", F.floor(rest / 3600), F.floor(rest / 60) % 60, rest % 60
    )
    fraction = F.when(
        nanos > 0, F.concat(F.lit("."), F.rtrim(F.lpad(nanos.cast("string"), 9, "0"), F.lit("0")))
    ).otherwise("")
    return F.concat(day, F.lit(" "), clock, fraction, F.lit(" +0000 UTC"))


def duration_ns(text: object) -> int:
    """A positive duration literal such as ``200us`` or ``1m30s`` in nanoseconds."""
    if not isinstance(text, str):
        raise InvalidPipelineError(f"duration must be a string, got {text!r}")
    body = text[1:] if text[:1] == "+" else text
    total = Fraction(0)
    at = 0
    while at < len(body):
        piece = _DURATION.match(body, at)
        if piece is None:
            raise InvalidPipelineError(f"invalid duration {text!r}")
        total += int(Fraction(piece.group(1).rstrip(".")) * DURATION_UNITS[piece.group(2)])
        at = piece.end()
    if not 0 < total < 1 << 63:
        raise InvalidPipelineError(f"duration {text!r} must be positive")
    return int(total)
