"""Destination schemas kept in a registry table ``table_name, ordinal, column_name, column_type``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.functions.paths import CHANGES_SUFFIX, dir_name
from lakeload.runtime import lookup_join
from lakeload.schemas import CATALOG_TYPES


def parsed_type(catalog_type: Column) -> Column:
    """The type a catalog type is parsed to; unknown, nested and decimal types stay text."""
    known = F.create_map(*[F.lit(x) for pair in CATALOG_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, catalog_type), F.lit("string"))


def with_parsed_types(registry: DataFrame) -> DataFrame:
    return registry.withColumn("parsed_type", parsed_type(F.col("column_type")))


def fields_of_tables(registry: DataFrame, table_names: Sequence[str]) -> dict[str, list[dict[str, str]]]:
    """Fields for ``cast_to_schema`` by table name; a table has a few hundred columns at most."""
    if not table_names:
        return {}
    rows = with_parsed_types(registry.where(F.col("table_name").isin(*table_names))).orderBy("table_name", "ordinal")
    found: dict[str, list[dict[str, str]]] = {}
    for row in rows.select("table_name", "column_name", "parsed_type").collect():
        found.setdefault(row["table_name"], []).append({"name": row["column_name"], "type": row["parsed_type"]})
    return found


def fields_of(registry: DataFrame, table_name: str) -> list[dict[str, str]]:
    return fields_of_tables(registry, [table_name]).get(table_name, [])


def columns_by_table(registry: DataFrame) -> DataFrame:
    """``table_name, columns``: the column names in catalog order."""
    listed = F.array_sort(F.collect_list(F.struct("ordinal", "column_name")))
    return registry.groupBy("table_name").agg(listed.getField("column_name").alias("columns"))


def source_table_name(table_name: Column, key: Column) -> Column:
    """The catalog table of a load: change files have a table of their own."""
    return F.when(dir_name(key).endswith(CHANGES_SUFFIX), F.concat(table_name, F.lit(CHANGES_SUFFIX))).otherwise(table_name)


def load_catalog_columns(loads_with_table: DataFrame, registry: DataFrame) -> DataFrame:
    """Each load with the column names of its catalog table (NULL when the table is unknown).

    ``loads_with_table`` carries ``table_name`` and ``s3_key``.
    """
    keyed = loads_with_table.withColumn("catalog_table", source_table_name(F.col("table_name"), F.col("s3_key")))
    columns = columns_by_table(registry).select(F.col("table_name").alias("catalog_table"), F.col("columns").alias("catalog_columns"))
    return lookup_join(keyed, columns, "catalog_table", "left", bounded_by=registry)
