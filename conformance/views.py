"""Inputs in the shape the operators take, as SQL that both engines run unchanged.

``{name}`` stands for a table or another view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS = {
    "v_tables": """
        select cast(n_nationkey as bigint) as id,
               concat('ods__t', cast(n_nationkey as varchar(10))) as name,
               concat('ods/T', cast(n_nationkey as varchar(10)), '/') as s3_prefix,
               n_nationkey % 2 = 0 as is_raw,
               case n_nationkey % 5 when 0 then false when 1 then null else true end as is_active,
               case when n_nationkey = 24 then date '2000-01-01' end as deleted_at
        from {nation}""",
    "v_table_snapshots": """
        select cast(n_nationkey as bigint) as table_id,
               concat('ods/T', cast(n_nationkey as varchar(10)), '/LOAD00000001.csv.gz') as snapshot_s3_key,
               case when n_nationkey % 3 = 1 then cast('1995-01-01 00:00:00' as timestamp) end as snapshot
        from {nation} where n_nationkey % 3 <> 0""",
    # the same two, one table per customer
    "v_many_tables": """
        select cast(c_custkey as bigint) as id, concat('ods__t', cast(c_custkey as varchar(20))) as name,
               concat('ods/T', cast(c_custkey as varchar(20)), '/') as s3_prefix, c_custkey % 2 = 0 as is_raw,
               case c_custkey % 5 when 0 then false when 1 then null else true end as is_active,
               case when c_custkey % 24 = 0 then date '2000-01-01' end as deleted_at
        from {customer}""",
    "v_many_snapshots": """
        select cast(c_custkey as bigint) as table_id,
               concat('ods/T', cast(c_custkey as varchar(20)), '/LOAD00000001.csv.gz') as snapshot_s3_key,
               case when c_nationkey % 3 = 1 then cast('1995-01-01 00:00:00' as timestamp) end as snapshot
        from {customer} where c_nationkey % 3 <> 0""",
    "v_loads": """
        select o_orderkey as id, o_custkey % 25 as table_id,
               case o_orderstatus when 'O' then 'ready' when 'F' then 'archiving' else 'ready_for_erroring' end as status,
               case when o_orderkey % 40 = 0 then concat('ods/T', cast(o_custkey % 25 as varchar(10)), '/LOAD00000001.csv.gz')
                    when o_orderkey % 2 = 0 then concat('ods/T', cast(o_custkey % 25 as varchar(10)), '/LOAD', lpad(cast(o_orderkey as varchar(20)), 8, '0'), '.csv.gz')
                    else concat('ods/T', cast(o_custkey % 25 as varchar(10)), '__ct/', lpad(cast(o_orderkey as varchar(20)), 8, '0'), '.csv.gz') end as s3_key,
               o_orderdate as s3_modified,
               case when o_orderkey % 97 = 0 then 0 else cast(floor(o_totalprice) as bigint) end as s3_size,
               o_orderkey % 3 = 0 as is_raw,
               case when o_orderkey % 53 = 0 then date '2000-01-01' end as deleted_at
        from {orders}""",
    # a fifth of the loads belongs to the dataset feed
    "v_mixed_loads": """
        select id, table_id, status, s3_modified, s3_size, is_raw, deleted_at,
               case when id % 5 = 0 then concat('datasets/', substr(s3_key, 5)) else s3_key end as s3_key
        from {v_loads}""",
    # every status occurs
    "v_status_loads": """
        select o_orderkey as id, o_custkey % 25 as table_id,
               case o_orderkey % 11 when 0 then 'archived' when 1 then 'archived_unknown' when 2 then 'archiving'
                    when 3 then 'errored' when 4 then 'errored_unknown' when 5 then 'erroring' when 6 then 'ingesting'
                    when 7 then 'ready' when 8 then 'ready_for_archiving' when 9 then 'ready_for_erroring'
                    else 'ready_for_ingesting' end as status,
               case when o_orderkey % 53 = 0 then date '2000-01-01' end as deleted_at
        from {orders}""",
    "v_load_snapshots": """
        select o_orderkey * 2 as id, o_orderkey as load_id, o_orderdate as snapshot,
               cast('2020-01-01 00:00:00' as timestamp) as inserted_at
        from {orders}
        union all
        select o_orderkey * 2 + 1 as id, o_orderkey as load_id, o_orderdate + interval '1' day as snapshot,
               cast('2020-01-02 00:00:00' as timestamp) as inserted_at
        from {orders} where o_orderstatus <> 'P'""",
    "v_strings": """
        select l_orderkey, l_linenumber,
               case when l_orderkey % 11 = 0 then '  ' else cast(l_partkey as varchar(20)) end as long_s,
               case when l_orderkey % 13 = 0 then '' else cast(l_extendedprice as varchar(40)) end as double_s,
               case when l_orderkey % 7 = 0 then replace(cast(cast(l_shipdate as date) as varchar(10)), '-', '')
                    when l_orderkey % 7 = 1 then concat(cast(cast(l_shipdate as date) as varchar(10)), ' 23:34:56-04:00')
                    else cast(cast(l_shipdate as date) as varchar(10)) end as iso_s,
               case when l_orderkey % 101 = 0 then '12x' else cast(l_suppkey as varchar(20)) end as dirty_s
        from {lineitem}""",
    "v_objects": """
        select user_id as table_id, event_id,
               concat('ods/U', cast(user_id as varchar(10)), '/', lpad(cast(event_id as varchar(20)), 8, '0'),
                      case when event_id % 9 = 0 then '.dfm' else '.csv.gz' end) as object_key,
               ts as last_modified,
               case when event_id % 31 = 0 then 0 when event_id % 37 = 0 then null else cast(floor(value*100) as bigint) end as object_size,
               ts < cast('2024-01-15 00:00:00' as timestamp) as already_loaded
        from {events}""",
    "v_feed": """
        select page_id,
               concat('{{"success":true,"results":[{{"id":"sample","dataset_id":"sample_', cast(page_id as varchar(10)),
                      '","url":"', url, '","start_date":"', case when page_id % 7 = 0 then '2022-05-45' else '2022-05-17' end,
                      '","end_date":"2022-05-17","last_updated":"2022-05-18T12:12:24.', lpad(cast(page_id as varchar(10)), 6, '0'), '"}}]}}') as body
        from {pages}""",
    "v_registry": """
        select concat('ods__t', cast(cast(floor(p_partkey / 20) as bigint) as varchar(10)), case when p_partkey % 20 >= 10 then '__ct' else '' end) as table_name,
               p_partkey % 10 as ordinal, concat('c', cast(p_partkey as varchar(10))) as column_name,
               case p_size % 7 when 0 then 'string' when 1 then 'bigint' when 2 then 'double' when 3 then 'date'
                    when 4 then 'timestamp' when 5 then 'array<string>' else 'decimal(10,2)' end as column_type
        from {part}""",
    # no sidecar for a third of the loads; snapshot files have one key for many loads and none here
    "v_sidecars": """
        select concat(replace(s3_key, '.csv.gz', ''), '.dfm') as sidecar_key,
               concat('{{"dfmVersion":"1.1","dataInfo":{{"sourceTable":"T","columns":[{{"ordinal":1,"name":"ID_', cast(id as varchar(20)),
                      '","type":"INT4"}},{{"ordinal":2,"name":"C', cast(table_id * 20 as varchar(20)), '","type":"STRING"}}]}}}}') as body
        from {v_loads} where id % 3 <> 0 and id % 40 <> 0""",
    "v_payloads": """
        select o_orderkey,
               concat('{{"loads":[{{"id":', cast(o_orderkey * 2 as varchar(20)), ',"s3_key":"ods/A/', cast(o_orderkey as varchar(20)),
                      '.csv.gz","source_table_name":"a","partition_columns":[{{"name":"snapshot","value":"',
                      o_orderstatus, '"}},{{"name":"identifier","value":"', cast(o_orderkey as varchar(20)),
                      '.csv.gz"}}]}},{{"id":', cast(o_orderkey * 2 + 1 as varchar(20)), ',"s3_key":"datasets/b/', cast(o_orderkey as varchar(20)),
                      '.csv.gz","source_table_name":"b","partition_columns":[{{"name":"identifier","value":"', cast(o_orderkey as varchar(20)),
                      '.csv.gz"}}]}}]}}') as payload
        from {orders}""",
    "v_feeds": """
        select c_custkey as id,
               concat(case when c_custkey % 2 = 0 then '/datasetcontrolleduserapi/' else '/datasetpublicusersapi/' end,
                      'transactional/d', cast(c_custkey as varchar(20))) as relative_url,
               case when c_custkey % 3 = 0 then null
                    else cast(concat('2022-05-22 20:49:50.', lpad(cast(c_custkey % 1000000 as varchar(10)), 6, '0')) as timestamp) end as last_updated_at
        from {customer}""",
    "v_status_events": """
        select o_orderkey as load_id,
               case o_custkey % 6 when 0 then 'select' when 1 then 'batch' when 2 then 'finish' when 3 then 'fail'
                    when 4 then 'dispatch' else 'moved' end as event
        from {orders}""",
    # up to seven events a load, and one load with those of every fiftieth order
    "v_load_events": """
        select case when l_orderkey % 50 = 0 then 1 else l_orderkey end as load_id, l_shipdate as at, l_orderkey * 8 + l_linenumber as seq,
               case (l_partkey + l_linenumber) % 7 when 0 then 'select' when 1 then 'batch' when 2 then 'finish' when 3 then 'fail'
                    when 4 then 'dispatch' when 5 then 'moved' else 'lost' end as event
        from {lineitem}""",
    # three announcements a body, the first and the last of one dataset
    "v_twin_bodies": """
        select c_custkey as arrival,
               concat('{{"success":true,"results":[', one, ',', two, ',', three, ']}}') as body
        from (select c_custkey,
                     concat('{{"id":"first","dataset_id":"d', cast(c_custkey % 600 as varchar(20)), '","url":"https://h.example.com/a","start_date":"2022-05-17","end_date":"2022-05-17","last_updated":"2022-05-18T12:12:24.000001"}}') as one,
                     concat('{{"id":"second","dataset_id":"e', cast(c_custkey % 400 as varchar(20)), '","url":"https://h.example.com/b","start_date":"2022-05-18","end_date":"2022-05-18","last_updated":"2022-05-19T12:12:24.', lpad(cast(c_custkey % 1000000 as varchar(20)), 6, '0'), '"}}') as two,
                     concat('{{"id":"third","dataset_id":"d', cast(c_custkey % 600 as varchar(20)), '","url":"https://h.example.com/c","start_date":"2022-05-19","end_date":"2022-05-20","last_updated":"2022-05-20T12:12:24.', lpad(cast(c_custkey % 1000000 as varchar(20)), 6, '0'), '"}}') as three
              from {customer}) t""",
    # an object for every five customers, of five replicated tables and five of the dataset feed, and each snapshot file twice
    "v_deliveries": """
        select owner, cast(1 + owner % 2 as int) as delivery,
               case owner % 3 when 0 then concat('datasets/set', cast(owner % 5 as varchar(10)), '/', cast(owner as varchar(20)), '.csv.gz')
                    when 1 then concat('ods/T', cast(owner % 5 as varchar(10)), '/LOAD', lpad(cast(owner + 2 as varchar(20)), 8, '0'), '.csv.gz')
                    else concat('ods/T', cast(owner % 5 as varchar(10)), '__ct/', lpad(cast(owner as varchar(20)), 8, '0'), '.csv.gz') end as s3_key,
               case owner % 2 when 0 then cast('2024-01-02 00:00:00' as timestamp) else cast('2024-02-02 00:00:00' as timestamp) end as s3_modified
        from (select distinct cast(floor(c_custkey / 5) as bigint) as owner from {customer}) o
        union all
        select cast(-1 - r_regionkey as bigint) as owner, d.delivery, concat('ods/T', cast(r_regionkey as varchar(10)), '/LOAD00000001.csv.gz') as s3_key,
               case d.delivery when 1 then cast('2024-01-01 00:00:00' as timestamp) else cast('2024-02-01 00:00:00' as timestamp) end as s3_modified
        from {region} cross join (select 1 as delivery union all select 2 as delivery) d""",
    "v_delivered_lines": """
        select cast(floor(o_custkey / 5) as bigint) as owner, o_orderkey as n, cast(o_orderdate as date) as day, o_orderpriority as text from {orders}
        union all
        select cast(-1 - r_regionkey as bigint) as owner, cast(r_regionkey as bigint) as n, date '2023-12-31' as day, r_name as text from {region}""",
    # tables as asked for: twins, a name with two prefixes, a prefix with two names, and names that are registered
    "v_registrations": """
        select concat('ods__t', cast(c_custkey as varchar(20))) as name, concat('ods/T', cast(c_custkey as varchar(20)), '/') as s3_prefix, true as is_raw from {customer}
        union all
        select concat('ods__t', cast(c_custkey as varchar(20))) as name, concat('ods/T', cast(c_custkey as varchar(20)), '/') as s3_prefix, true as is_raw
        from {customer} where c_custkey % 4 = 0
        union all
        select concat('ods__t', cast(c_custkey as varchar(20))) as name, concat('ods/OTHER', cast(c_custkey as varchar(20)), '/') as s3_prefix, true as is_raw
        from {customer} where c_custkey % 10 = 3
        union all
        select concat('ods__other', cast(c_custkey as varchar(20))) as name, concat('ods/T', cast(c_custkey as varchar(20)), '/') as s3_prefix, true as is_raw
        from {customer} where c_custkey % 10 = 7
        union all
        select concat('set', cast(c_custkey as varchar(20))) as name, concat('datasets/set', cast(c_custkey as varchar(20)), '/') as s3_prefix, false as is_raw
        from {customer} where c_custkey % 6 = 0""",
    "v_status_log": """
        select user_id as load_id, event_type as status, ts as at, event_id as seq from {events}""",
}

PLACEHOLDER = re.compile(r"(?<!\{)\{(\w+)\}(?!\})")


def uses(sql: str) -> list[str]:
    return list(dict.fromkeys(PLACEHOLDER.findall(sql)))


class Inputs:
    """The tables of one scale folder and the views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name in VIEWS:
            return self.sql(VIEWS[name])
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        needed = {name: getattr(self, name) for name in uses(text)}
        return self.spark.sql(text, **needed)


def with_views(select: str) -> str:
    """A DuckDB statement: the views a query needs as common table expressions, then the query."""
    order: list[str] = []

    def add(sql: str) -> None:
        for name in uses(sql):
            if name in VIEWS and name not in order:
                add(VIEWS[name])
                order.append(name)

    add(select)
    plain = lambda sql: PLACEHOLDER.sub(r"\1", sql).replace("{{", "{").replace("}}", "}")
    recursive = "recursive " if "recursive" in select else ""
    body = select.replace("with recursive", ",", 1) if recursive and order else re.sub(r"^with ", ", ", select) if order else select
    ctes = ",\n".join(f"{name} as ({plain(VIEWS[name])})" for name in order)
    if not order:
        return plain(select)
    return f"with {recursive}{ctes}\n{plain(body)}"
