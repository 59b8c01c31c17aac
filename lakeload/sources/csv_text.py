"""Gzipped CSV objects as all-text columns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The dialect the sidecars describe.
DEFAULT_DIALECT = {"sep": ",", "quote": '"', "escape": '"', "nullValue": "", "multiLine": "true"}

SIDECAR_TO_READER = {"fieldDelimiter": "sep", "quoteChar": "quote", "escapeChar": "escape", "nullValue": "nullValue"}


def dialect_of(format_options: Mapping[str, str]) -> dict[str, str]:
    """Reader options for a sidecar's ``formatInfo.options``; empty settings keep the default."""
    found = {SIDECAR_TO_READER[k]: v for k, v in format_options.items() if k in SIDECAR_TO_READER and v}
    record = format_options.get("recordDelimiter")
    if record and record not in ("\n", "\r\n"):
        found.update(lineSep=record)
    return {**DEFAULT_DIALECT, **found}


def exact_path(path: str) -> str:
    """A path that Spark takes literally, not as a pattern."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def scan_csv_strings(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    header: bool = False,
    dialect: Mapping[str, str] | None = None,
    file_column: str | None = None,
    mode: str = "PERMISSIVE",
    corrupt_column: str | None = None,
) -> DataFrame:
    """Read any number of objects of one table in a single scan, every column as text.

    A single string may be a pattern or a folder; the paths of a list are literal.

    One read serves all loads of a table: the files are spread over the
    executors, and ``file_column`` (the object's full path) tells which load a
    row came from. Missing trailing columns are NULL and surplus ones are dropped
    unless ``mode`` is ``FAILFAST``; ``corrupt_column`` then holds the raw text of
    such a row, and is NULL for rows with as many fields as ``columns``.
    """
    marks = [corrupt_column] if corrupt_column else []
    schema = StructType([StructField(name, StringType()) for name in [*columns, *marks]])
    df = (
        spark.read.schema(schema)
        .options(**(dialect or DEFAULT_DIALECT))
        .options(**({"columnNameOfCorruptRecord": corrupt_column} if corrupt_column else {}))
        .option("header", header)
        .option("mode", mode)
        .csv(paths if isinstance(paths, str) else [exact_path(p) for p in paths])
    )
    if file_column:
        df = df.select("*", F.col("_metadata.file_path").alias(file_column))
    return df
