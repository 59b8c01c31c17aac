"""Strict text-to-type parsers.

Every parser maps NULL and blank text to NULL. Text that is not a value of the
target type fails the job in ``strict`` mode (the message starts with the quoted
text) and becomes NULL otherwise; ``operators.casting.cast_rejects`` lists such
values.

Parsers take a column name or the text of a SQL expression.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeload.functions.iso import iso_date, iso_timestamp, matches

# The characters Unicode calls white space.
SPACES = (
    r"\t\n\x0B\f\r\x1C\x1D\x1E\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
BLANK = rf"^[{SPACES}]*\z"
EDGE_SPACES = rf"^[{SPACES}]+|[{SPACES}]+\z"

PLAIN_LONG = r"^-?\d{1,18}\z"
GROUPED_DIGITS = r"\d+(?:_\d+)*"
LONG_FORM = rf"^[+-]?{GROUPED_DIGITS}\z"
PLAIN_DOUBLE = r"^-?\d+(?:\.\d+)?\z"
DOUBLE_FORM = (
    rf"^[+-]?(?:{GROUPED_DIGITS}(?:\.(?:{GROUPED_DIGITS})?)?|\.{GROUPED_DIGITS})(?:[eE][+-]?{GROUPED_DIGITS})?\z"
)
NAN_FORM, INFINITY_FORM = r"(?i)^[+-]?nan\z", r"(?i)^[+-]?inf(?:inity)?\z"


def _digit_table() -> tuple[str, str]:
    """Every decimal digit beyond ASCII, and the ASCII digit it stands for."""
    table = [
        (chr(code), str(unicodedata.decimal(chr(code))))
        for code in range(128, sys.maxunicode + 1)
        if unicodedata.category(chr(code)) == "Nd"
    ]
    return "".join(c for c, _ in table), "".join(d for _, d in table)


OTHER_DIGITS, ASCII_DIGITS = _digit_table()


def _tidy(s: str) -> str:
    """Surrounding white space gone, digits of other scripts as ASCII."""
    return f"translate(regexp_replace({s}, r'{EDGE_SPACES}', ''), '{OTHER_DIGITS}', '{ASCII_DIGITS}')"


def _blank(s: str) -> str:
    return matches(s, BLANK)


def _ungrouped(tidy: str, type_name: str) -> str:
    return f"try_cast(replace({tidy}, '_', '') as {type_name})"


def _long(s: str) -> str:
    tidy = _tidy(s)
    return f"""case when {matches(s, PLAIN_LONG)} then try_cast({s} as bigint)
        when {matches(tidy, LONG_FORM)} then {_ungrouped(tidy, 'bigint')} end"""


def _double(s: str) -> str:
    tidy = _tidy(s)
    return f"""case when {matches(s, PLAIN_DOUBLE)} then try_cast({s} as double)
        when {matches(tidy, DOUBLE_FORM)} then {_ungrouped(tidy, 'double')}
        when {matches(tidy, NAN_FORM)} then double('NaN')
        when {matches(tidy, INFINITY_FORM)} then if(startswith({tidy}, '-'), double('-Infinity'), double('Infinity')) end"""


_READERS = {"long": (_long, "bigint"), "double": (_double, "double"), "date": (iso_date, "date"), "timestamp": (iso_timestamp, "timestamp")}


def is_blank(s: str) -> Column:
    return F.expr(_blank(s))


def blank_to_null(s: str) -> Column:
    return F.expr(f"case when not {_blank(s)} then {s} end")


def parse_as(s: str, type_name: str, strict: bool = True) -> Column:
    """Parse text as ``long``, ``double``, ``date`` or ``timestamp``; other types stay text."""
    if type_name not in _READERS:
        return F.expr(s)
    read, sql_type = _READERS[type_name]
    if not strict:
        return F.expr(read(s))
    complaint = f"concat(char(39), {s}, char(39), ', is not a valid {type_name}')"
    # coalesce is lazy: the blank test runs only for text that gave no value.
    return F.expr(f"coalesce({read(s)}, case when not {_blank(s)} then cast(raise_error({complaint}) as {sql_type}) end)")


def is_bad(s: str, type_name: str) -> Column:
    """True for text that a strict parse would fail on."""
    if type_name not in _READERS:
        return F.lit(False)
    return F.expr(f"({s} is not null and ({_READERS[type_name][0](s)}) is null and not {_blank(s)})")


def parse_long(s: str, strict: bool = True) -> Column:
    return parse_as(s, "long", strict)


def parse_double(s: str, strict: bool = True) -> Column:
    return parse_as(s, "double", strict)


def parse_date(s: str, strict: bool = True) -> Column:
    return parse_as(s, "date", strict)


def parse_timestamp(s: str, strict: bool = True) -> Column:
    return parse_as(s, "timestamp", strict)
