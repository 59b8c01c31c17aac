"""Casting all-text columns to the destination schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.functions.parsers import is_bad, parse_as

Field = Mapping[str, str]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _named(name: str) -> Column:
    return F.col(_quoted(name))


def cast_to_schema(df: DataFrame, fields: Sequence[Field], mode: str = "strict", keep: Sequence[str] = ()) -> DataFrame:
    """Select ``fields`` by name, in order, each parsed to its type.

    Columns not named are dropped, a missing one fails the analysis. Text
    columns pass through untouched, blanks included. In ``strict`` mode the
    first bad value fails the job, in ``lenient`` mode it becomes NULL.
    ``keep`` names columns that are carried along behind the fields.
    """
    if mode not in ("strict", "lenient"):
        raise ValueError(f"mode must be strict or lenient, not {mode!r}")
    parsed = [parse_as(_quoted(f["name"]), f["type"], mode == "strict").alias(f["name"]) for f in fields]
    return df.select(*parsed, *[_named(k) for k in keep])


def cast_rejects(df: DataFrame, fields: Sequence[Field], keep: Sequence[str] = ()) -> DataFrame:
    """One row per value that does not parse: ``column, type, value`` and the ``keep`` columns."""
    typed = [f for f in fields if f["type"] != "string"]
    carried = [_named(k) for k in keep]
    if not typed:
        return df.select(*carried, *[F.lit("").alias(c) for c in ("column", "type", "value")]).where(F.lit(False))
    # No filter on the bad values: pushed below a projection it would repeat the
    # expressions that make the texts once for every use in the parsers.
    findings = [
        F.when(
            is_bad(_quoted(f["name"]), f["type"]),
            F.struct(F.lit(f["name"]).alias("column"), F.lit(f["type"]).alias("type"), _named(f["name"]).alias("value")),
        )
        for f in typed
    ]
    return df.select(*carried, F.inline(F.array_compact(F.array(*findings))))
