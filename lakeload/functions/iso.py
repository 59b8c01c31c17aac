"""ISO-8601 dates and times as Spark SQL expression text.

Text, because one parsed string per column costs the driver far less than the
hundreds of single column objects it stands for, which counts for wide tables.

Spark's own string casts are looser than ISO-8601 in some places (``2022001``
becomes the year 2022001, ``2022-1-1`` is a date) and narrower in others
(compact, ordinal and week forms are unknown). Each form is therefore guarded
by a pattern before anything is computed from it. The two layouts that make up
almost all real data are tried first and go straight to Spark's cast.
"""

from __future__ import annotations

# ---- grammar (Java regular expressions) -------------------------------------
YEAR = r"(?!0000)\d{4}"
HOUR, SIXTY = r"(?:[01]\d|2[0-3])", r"[0-5]\d"
FRACTION, ZERO_FRACTION = r"(?:[.,]\d+)?", r"(?:[.,](?:0{1,5}|0{6}\d*))?"
SHIFT = rf"[+-]{HOUR}(?::?{SIXTY})?"
ZONE = rf"(?:[Zz]|{SHIFT})?"
CLOCK = rf"{HOUR}(?::{SIXTY}(?::{SIXTY}{FRACTION})?|{SIXTY}(?:{SIXTY}{FRACTION})?)?"
MIDNIGHT_24 = rf"24(?::00(?::00{ZERO_FRACTION})?|00(?:00{ZERO_FRACTION})?)?"
TIME = rf"(?:(?:{CLOCK}|{MIDNIGHT_24}){ZONE}|{SHIFT})"
ANY_SEPARATOR = r"[\x00-\x7F]"
# After seven digits, a digit would make it a calendar date.
ORDINAL_SEPARATOR = r"[\x00-\x7F&&[^\d]]"

CALENDAR_FORM = rf"^{YEAR}(-?)\d\d\1\d\d(?:{ANY_SEPARATOR}{TIME})?\z"
ORDINAL_FORM = rf"^{YEAR}(?:-\d{{3}}(?:{ANY_SEPARATOR}{TIME})?|\d{{3}}(?:{ORDINAL_SEPARATOR}{TIME})?)\z"
WEEK_FORM = rf"^{YEAR}(-?)W\d\d(?:\1[1-7](?:{ANY_SEPARATOR}{TIME})?)?\z"
SHORT_FORM = rf"^{YEAR}(?:-(?:0[1-9]|1[0-2]))?\z"

# The layouts of almost all real data. Spark accepts zone offsets up to 18 hours.
NEAR_ZONE = rf"(?:Z|[+-](?:0\d|1[0-7]):{SIXTY})?"
PLAIN_DATE = rf"^{YEAR}-\d\d-\d\d\z"
PLAIN_TIMESTAMP = rf"^{YEAR}-\d\d-\d\d[ T]{HOUR}:{SIXTY}:{SIXTY}(?:\.\d{{1,6}})?{NEAR_ZONE}\z"
COMPACT_TIMESTAMP = rf"^{YEAR}\d{{4}}[ T]{HOUR}(:?){SIXTY}\1{SIXTY}(?:\.\d{{1,6}})?{NEAR_ZONE}\z"


def matches(s: str, pattern: str) -> str:
    return f"({s} rlike r'{pattern}')"


def _part(s: str, start: int, length: int) -> str:
    return f"substring({s}, {start}, {length})"


def _rest(s: str, start: str | int) -> str:
    return f"substring({s}, {start}, length({s}))"


def _number(s: str) -> str:
    return f"try_cast({s} as int)"


def _date(s: str) -> str:
    return f"try_cast({s} as date)"


def _dashed(s: str) -> str:
    return f"{_part(s, 5, 1)} = '-'"


def _compact_day(s: str) -> str:
    return f"concat_ws('-', {_part(s, 1, 4)}, {_part(s, 5, 2)}, {_part(s, 7, 2)})"


def _calendar_day(s: str) -> str:
    return _date(f"if({_dashed(s)}, {_part(s, 1, 10)}, {_compact_day(s)})")


def _ordinal_day(s: str) -> str:
    nth = _number(f"if({_dashed(s)}, {_part(s, 6, 3)}, {_part(s, 5, 3)})")
    first, last = (_date(f"concat({_part(s, 1, 4)}, '{day}')") for day in ("-01-01", "-12-31"))
    return f"case when {nth} between 1 and dayofyear({last}) then date_add({first}, {nth} - 1) end"


def _week_day(s: str) -> str:
    week = _number(f"if({_dashed(s)}, {_part(s, 7, 2)}, {_part(s, 6, 2)})")
    # A week without a day means its Monday.
    day = f"coalesce({_number(f'if({_dashed(s)}, {_part(s, 10, 1)}, {_part(s, 8, 1)})')}, 1)"
    fourth = _date(f"concat({_part(s, 1, 4)}, '-01-04')")
    return f"case when {week} between 1 and 53 then date_add({fourth}, ({week} - 1) * 7 + {day} - 1 - weekday({fourth})) end"


def _day(s: str) -> str:
    return f"""case when {matches(s, CALENDAR_FORM)} then {_calendar_day(s)}
        when {matches(s, ORDINAL_FORM)} then {_ordinal_day(s)}
        when {matches(s, WEEK_FORM)} then {_week_day(s)}
        when {matches(s, SHORT_FORM)} then {_date(s)} end"""


def _after_separator(s: str) -> str:
    """The time and zone of a text that has one of the forms; empty for a date alone.

    The length of the day part follows from the form: 10 or 8 characters, for an
    ordinal date 8 or 7. In an ordinal date the character where a calendar date
    has its second dash (or its eighth digit) is none.
    """
    dashed_start = f"if({_part(s, 8, 1)} <> '-' and {_part(s, 6, 1)} <> 'W', 10, 12)"
    compact_start = f"if({_part(s, 5, 1)} <> 'W' and {_part(s, 8, 1)} not between '0' and '9', 9, 10)"
    return _rest(s, f"if({_dashed(s)}, {dashed_start}, {compact_start})")


def _clock_micros(after: str) -> str:
    """Microseconds since midnight UTC of the text behind the date separator."""
    digits = f"rpad(translate(regexp_extract({after}, r'^[0-9:]*', 0), ':', ''), 6, '0')"
    fraction = f"rpad(regexp_extract({after}, r'[.,]([0-9]+)', 1), 6, '0')"
    hour, minute, second = (_number(_part(digits, at, 2)) for at in (1, 3, 5))
    return f"(({hour} * 3600 + {minute} * 60 + {second} - {_shift_seconds(after)}) * 1000000L + {_number(fraction)})"


def _shift_seconds(after: str) -> str:
    """Zone offset, positive to the east."""
    shift = rf"translate(regexp_extract({after}, r'[+-][0-9:]+\z', 0), ':', '')"
    digits = f"rpad({_part(shift, 2, 4)}, 4, '0')"
    size = f"({_number(_part(digits, 1, 2))} * 3600 + {_number(_part(digits, 3, 2))} * 60)"
    return f"case {_part(shift, 1, 1)} when '-' then -{size} when '+' then {size} else 0 end"


def _with_zone(s: str) -> str:
    """Add ``Z`` to a plain or compact timestamp that has no zone."""
    return f"if(endswith({s}, 'Z') or substring({s}, -6, 1) in ('+', '-'), {s}, concat({s}, 'Z'))"


def _spread_out(s: str) -> str:
    """A compact timestamp in the plain layout."""
    clock = f"if({_part(s, 12, 1)} = ':', {_rest(s, 10)}, concat_ws(':', {_part(s, 10, 2)}, {_part(s, 12, 2)}, {_rest(s, 14)}))"
    return f"concat({_compact_day(s)}, 'T', {clock})"


def iso_date(s: str) -> str:
    """Calendar date as written (any zone offset is ignored), NULL when not ISO-8601."""
    midnight_24 = f"length({s}) > 9 and {_part(_after_separator(s), 1, 2)} = '24'"
    return f"""case when {matches(s, PLAIN_DATE)} then {_date(s)}
        else date_add({_day(s)}, if({midnight_24}, 1, 0)) end"""


def iso_timestamp(s: str) -> str:
    """Instant; text without a zone is taken as UTC whatever the session zone is."""
    after = _after_separator(s)
    clock = f"if({after} = '', 0L, {_clock_micros(after)})"
    return f"""case when {matches(s, PLAIN_TIMESTAMP)} then try_cast({_with_zone(s)} as timestamp)
        when {matches(s, PLAIN_DATE)} then try_cast(concat({s}, 'T00:00:00Z') as timestamp)
        when {matches(s, COMPACT_TIMESTAMP)} then try_cast({_with_zone(_spread_out(s))} as timestamp)
        else timestamp_micros(unix_date({_day(s)}) * 86400000000L + {clock}) end"""
