"""Yes/no expressions over landed metadata. NULL input gives false."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeload.functions.paths import DATA_SUFFIX

ISO_DATE = r"^[+-]?\d{4}-\d\d-\d\d\z"
ISO_EXTENDED = (
    r"^(\d{4}-\d\d-\d\d)[T ]((?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d(?:\.\d+)?)(?:[Zz]|[+-](?:[01]\d|2[0-3])(?::?[0-5]\d)?)?\z"
)
# scheme, authority and path of RFC 3986, appendix B
URL_PARTS = r"(?s)^([^:/?#]+):(?://[^/?#]*)?([^?#]*)"


def _definite(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def valid_iso_date(s: Column) -> Column:
    """``YYYY-MM-DD`` and a day of the calendar."""
    return _definite(F.when(s.rlike(ISO_DATE), s.try_cast("date").isNotNull()))


def parse_iso_extended(s: Column) -> Column:
    """Extended ISO date-time as wall-clock time (microseconds kept, offset dropped), else NULL."""
    wall = F.concat_ws(" ", F.regexp_extract(s, ISO_EXTENDED, 1), F.regexp_extract(s, ISO_EXTENDED, 2))
    return F.when(s.rlike(ISO_EXTENDED), wall.try_cast("timestamp_ntz"))


def valid_iso_datetime(s: Column) -> Column:
    return parse_iso_extended(s).isNotNull()


def valid_url(s: Column) -> Column:
    """An https address whose path is more than the root."""
    scheme, path = F.regexp_extract(s, URL_PARTS, 1), F.regexp_extract(s, URL_PARTS, 2)
    return _definite((F.lower(scheme) == "https") & ~path.isin("", "/"))


def has_keys(entries: Column, keys: Sequence[str]) -> Column:
    """All keys are present in the map; their values may be NULL."""
    present = F.lit(True)
    for key in keys:
        present = present & F.map_contains_key(entries, key)
    return _definite(present)


def is_data_object(key: Column, size: Column) -> Column:
    """A data file: named ``*.csv.gz`` with a known size (zero is known)."""
    return _definite(key.endswith(DATA_SUFFIX) & size.isNotNull())
