"""Ledger, listing, sidecar and payload schemas, as DDL text."""

from __future__ import annotations

LISTING = "key string, last_modified timestamp, size bigint"

TABLES = (
    "id bigint, name string, s3_prefix string, is_raw boolean, is_active boolean, "
    "deleted_at timestamp, inserted_at timestamp, updated_at timestamp"
)
LOADS = (
    "id bigint, table_id bigint, status string, s3_key string, s3_modified timestamp, s3_size bigint, "
    "is_raw boolean, deleted_at timestamp, inserted_at timestamp, updated_at timestamp"
)
TABLE_SNAPSHOTS = (
    "id bigint, table_id bigint, snapshot timestamp, snapshot_s3_key string, "
    "deleted_at timestamp, inserted_at timestamp, updated_at timestamp"
)
LOAD_SNAPSHOTS = (
    "id bigint, load_id bigint, snapshot timestamp, deleted_at timestamp, inserted_at timestamp, updated_at timestamp"
)
FEEDS = (
    "id bigint, relative_url string, last_updated_at timestamp, "
    "deleted_at timestamp, inserted_at timestamp, updated_at timestamp"
)
DATASETS = (
    "id bigint, feed_id bigint, type string, identifier string, start_date date, end_date date, "
    "last_updated_at timestamp, deleted_at timestamp, inserted_at timestamp, updated_at timestamp"
)

FEED_BODY = "success boolean, results array<map<string,string>>"

JOB_PAYLOAD = (
    "loads array<struct<id: bigint, s3_key: string, source_table_name: string, destination_table_name: string, "
    "source_s3_key: string, destination_path: string, partition_columns: array<struct<name: string, value: string>>>>"
)

SIDECAR = (
    "dfmVersion string, "
    "fileInfo struct<name: string, extension: string, location: string, recordCount: bigint, errorCount: bigint>, "
    "formatInfo struct<format: string, options: struct<fieldDelimiter: string, recordDelimiter: string, "
    "nullValue: string, quoteChar: string, escapeChar: string>>, "
    "dataInfo struct<sourceSchema: string, sourceTable: string, targetSchema: string, targetTable: string, "
    "tableVersion: bigint, columns: array<struct<ordinal: int, name: string, type: string, length: int, "
    "`precision`: int, scale: int, primaryKeyPos: int>>>"
)

# Catalog type -> type parsed to; every other catalog type stays text.
CATALOG_TYPES = {
    "string": "string",
    "bigint": "long",
    "double": "double",
    "date": "date",
    "timestamp": "timestamp",
}
