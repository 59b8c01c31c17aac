"""Column expressions. Everything here is native: no Python runs per row."""

from lakeload.functions.checks import (
    has_keys,
    is_data_object,
    parse_iso_extended,
    valid_iso_date,
    valid_iso_datetime,
    valid_url,
)
from lakeload.functions.parsers import (
    blank_to_null,
    is_blank,
    parse_as,
    parse_date,
    parse_double,
    parse_long,
    parse_timestamp,
)
from lakeload.functions.paths import (
    base_name,
    dir_name,
    drop_prefix,
    drop_suffix,
    root_name,
    starts_below,
    swap_suffix,
)
from lakeload.functions.times import format_snapshot, next_microsecond, truncate_second

__all__ = [
    "base_name",
    "blank_to_null",
    "dir_name",
    "drop_prefix",
    "drop_suffix",
    "format_snapshot",
    "has_keys",
    "is_blank",
    "is_data_object",
    "next_microsecond",
    "parse_as",
    "parse_date",
    "parse_double",
    "parse_iso_extended",
    "parse_long",
    "parse_timestamp",
    "root_name",
    "starts_below",
    "swap_suffix",
    "truncate_second",
    "valid_iso_date",
    "valid_iso_datetime",
    "valid_url",
]
