"""For each query, the SQL it must agree with, written without a look at its Spark form."""

from __future__ import annotations

from conformance.views import with_views

SECOND = "date_trunc('second', {})"
STAMP = "'%Y%m%dT%H%M%SZ'"
DIR = "regexp_replace(s3_key, '/[^/]*$', '')"
BASE = "regexp_extract(s3_key, '[^/]*$')"
STEM = f"regexp_replace({BASE}, '\\.csv\\.gz$', '')"
DATASET = "json_extract_string(body, '$.results[0].{}')"
LATEST_SNAPSHOT = "select load_id, arg_max(snapshot, (inserted_at, id)) as snapshot from {v_load_snapshots} group by load_id"
ARRIVALS = "select id, table_id, s3_key, s3_modified as modified, s3_size, is_raw from {v_loads}"
FOLD = f"""
    select a.id, a.table_id, a.s3_key, a.modified, a.s3_size,
           s.snapshot_s3_key is not null as is_snapshot_table,
           case when s.snapshot_s3_key is not null then coalesce(
               last_value(case when a.s3_key = s.snapshot_s3_key then a.modified end ignore nulls) over (
                   partition by a.table_id order by a.s3_key, a.modified, a.id
                   rows between unbounded preceding and current row), s.snapshot) end as snapshot
    from ({ARRIVALS}) a left join {{v_table_snapshots}} s on a.table_id = s.table_id"""
NEW_LOADS = f"""
    select f.id, f.table_id,
           case when f.s3_size > 0 and (not f.is_snapshot_table or f.snapshot is not null) then 'ready' else 'ready_for_erroring' end as status,
           f.s3_key, f.modified as s3_modified, f.s3_size, t.is_raw, f.snapshot, f.is_snapshot_table
    from ({FOLD}) f join {{v_tables}} t on t.id = f.table_id"""
LAST_SNAPSHOT_LOAD = """
    select s3_key, max(s3_modified) as last_snapshot_at from {v_loads}
    where deleted_at is null and s3_key in (select snapshot_s3_key from {v_table_snapshots}) group by s3_key"""
READY = f"""
    select l.id, l.table_id, t.name as table_name, l.s3_key, l.s3_modified
    from {{v_loads}} l join {{v_tables}} t on t.id = l.table_id and t.deleted_at is null
    left join {{v_table_snapshots}} s on s.table_id = t.id
    left join ({LAST_SNAPSHOT_LOAD}) k on k.s3_key = s.snapshot_s3_key
    where l.deleted_at is null and l.status = 'ready' and (s.table_id is null or l.s3_modified >= k.last_snapshot_at)"""
LOADED = f"""
    select table_id, object_key, {SECOND.format('last_modified')} as s3_modified from {{v_objects}} where already_loaded"""
BATCHES = """
    with recursive ready as (
        select id, table_id, s3_size, row_number() over (partition by table_id order by id) as n
        from {v_loads} where deleted_at is null and status = 'ready'),
    walk as (
        select id, table_id, s3_size, n, cast(0 as bigint) as batch_no, cast(1 as bigint) as held, s3_size as bytes from ready where n = 1
        union all
        select r.id, r.table_id, r.s3_size, r.n,
               w.batch_no + case when w.held = 10 or w.bytes + r.s3_size > 1500000 then 1 else 0 end,
               case when w.held = 10 or w.bytes + r.s3_size > 1500000 then 1 else w.held + 1 end,
               case when w.held = 10 or w.bytes + r.s3_size > 1500000 then r.s3_size else w.bytes + r.s3_size end
        from walk w join ready r on r.table_id = w.table_id and r.n = w.n + 1)
    """
RETURNED = "(select l_orderkey from {lineitem} where l_returnflag = 'R')"
MIXED_ODS = "starts_with(s3_key, 'ods/')"
ERROR_ROOT = f"""case when {MIXED_ODS} then concat({DIR}, '/timestamp=', strftime(s3_modified, {STAMP}), '/', {STEM}) else concat({DIR}, '/', {STEM}) end"""
ARCHIVE_ROOT = f"""case when {MIXED_ODS} then concat({DIR}, '/snapshot=', strftime(snapshot, {STAMP}), '/', {STEM}) else concat({DIR}, '/', {STEM}) end"""
ROUTED = f"""
    select l.id, l.s3_key,
           concat(t.name, case when {DIR} like '%\\_\\_ct' escape '\\' then '__ct' else '' end) as source_table_name,
           concat(case when l.is_raw then 'raw_' else '' end, t.name, case when {DIR} like '%\\_\\_ct' escape '\\' then '__ct' else '' end) as destination_table_name,
           concat('incoming/', s3_key) as source_path,
           concat('lake/', case when l.is_raw then 'raw/' else '' end, {DIR}) as destination_path,
           {BASE} as identifier
    from {{v_mixed_loads}} l join {{v_tables}} t on t.id = l.table_id where l.deleted_at is null"""
PAIRS = """
    select id, concat(source, suffix) as source_key, concat(destination, suffix) as destination_key
    from (select *, unnest(case when starts_with(source, 'ods/') then ['.csv.gz', '.dfm'] else ['.csv.gz'] end) as suffix from ({}))"""
SOURCE_ROOT = "regexp_replace(s3_key, '\\.csv\\.gz$', '')"
ERROR_PAIRS = PAIRS.format(f"select id, {SOURCE_ROOT} as source, {ERROR_ROOT} as destination from {{v_mixed_loads}}")
VALID_PAGE = f"""(try_cast({DATASET.format('start_date')} as date) is not null and regexp_full_match(url, 'https://[^/?#]*/[^?#]+.*'))"""
MANIFEST = """
    select l.id, case when s.sidecar_key is null then '' else concat('id_', l.id, ',c', l.table_id * 20) end as columns
    from {v_loads} l left join {v_sidecars} s on s.sidecar_key = concat(replace(l.s3_key, '.csv.gz', ''), '.dfm')"""
NAMED_LOADS = "select l.id, l.s3_key, concat(t.name, case when l.s3_key like '%\\_\\_ct/%' escape '\\' then '__ct' else '' end) as catalog_table from {v_loads} l join {v_tables} t on t.id = l.table_id where l.deleted_at is null"
CATALOG = "select table_name, string_agg(column_name, ',' order by ordinal) as columns from {v_registry} group by table_name"
# Written out, not taken from the code under test.
RULES = """('ready', 'select', 'ready_for_ingesting'), ('ready_for_ingesting', 'batch', 'ingesting'),
    ('ingesting', 'finish', 'ready_for_archiving'), ('ingesting', 'fail', 'ready_for_erroring'),
    ('ready_for_archiving', 'dispatch', 'archiving'), ('ready_for_erroring', 'dispatch', 'erroring'),
    ('archiving', 'moved', 'archived'), ('archiving', 'fail', 'archived_unknown'),
    ('archived_unknown', 'moved', 'archived'), ('archived_unknown', 'fail', 'archived_unknown'),
    ('erroring', 'moved', 'errored'), ('erroring', 'fail', 'errored_unknown'),
    ('errored_unknown', 'moved', 'errored'), ('errored_unknown', 'fail', 'errored_unknown')"""
EVENT_WALK = f"""
    with recursive rules as (select * from (values {RULES}) r(status, event, next_status)),
    ranked as (select load_id, seq, event, row_number() over (partition by load_id order by "at", seq, event) as n from {{v_load_events}}),
    walk as (
        select r.load_id, r.seq, r.event, r.n, l.status, u.next_status
        from ranked r left join {{v_status_loads}} l on l.id = r.load_id left join rules u on u.status = l.status and u.event = r.event where r.n = 1
        union all
        select r.load_id, r.seq, r.event, r.n, coalesce(w.next_status, w.status), u.next_status
        from walk w join ranked r on r.load_id = w.load_id and r.n = w.n + 1
        left join rules u on u.status = coalesce(w.next_status, w.status) and u.event = r.event)
    """
ALL_BATCHES = """
    with recursive ready as (
        select id, s3_size, row_number() over (order by id) as n from {v_loads} where deleted_at is null and status = 'ready'),
    walk as (
        select id, s3_size, n, cast(0 as bigint) as batch_no, cast(1 as bigint) as held, s3_size as bytes from ready where n = 1
        union all
        select r.id, r.s3_size, r.n,
               w.batch_no + case when w.held = 10 or w.bytes + r.s3_size > 1500000 then 1 else 0 end,
               case when w.held = 10 or w.bytes + r.s3_size > 1500000 then 1 else w.held + 1 end,
               case when w.held = 10 or w.bytes + r.s3_size > 1500000 then r.s3_size else w.bytes + r.s3_size end
        from walk w join ready r on r.n = w.n + 1)
    """

SQL = {
    "blank_to_null": "select l_orderkey, l_linenumber, nullif(trim(long_s), '') as long_s, nullif(trim(double_s), '') as double_s from {v_strings}",
    "cast_long": """select l_orderkey, l_linenumber, case when regexp_full_match(long_s, '[0-9]+') then cast(long_s as bigint) end as value,
        case when regexp_full_match(dirty_s, '[0-9]+') then cast(dirty_s as bigint) end as lenient from {v_strings}""",
    "cast_double": "select l_orderkey, l_linenumber, cast(nullif(double_s, '') as double) as value from {v_strings}",
    "cast_date": """select l_orderkey, l_linenumber,
        case when length(iso_s) = 8 then cast(strptime(iso_s, '%Y%m%d') as date) else cast(substr(iso_s, 1, 10) as date) end as value from {v_strings}""",
    "cast_timestamp": """select l_orderkey, l_linenumber,
        case when length(iso_s) = 8 then strptime(iso_s, '%Y%m%d')
             when length(iso_s) = 25 then cast(substr(iso_s, 1, 19) as timestamp) + interval 4 hour
             else cast(iso_s as timestamp) end as value from {v_strings}""",
    "cast_to_schema": """select l_orderkey, l_linenumber,
        case when regexp_full_match(long_s, '[0-9]+') then cast(long_s as bigint) end as long_s,
        cast(nullif(double_s, '') as double) as double_s,
        case when length(iso_s) = 8 then cast(strptime(iso_s, '%Y%m%d') as date) else cast(substr(iso_s, 1, 10) as date) end as iso_s,
        dirty_s from {v_strings}""",
    "load_pass": """select l_orderkey, l_linenumber,
        case when regexp_full_match(long_s, '[0-9]+') then cast(long_s as bigint) end as long_s,
        cast(nullif(double_s, '') as double) as double_s,
        case when length(iso_s) = 8 then cast(strptime(iso_s, '%Y%m%d') as date) else cast(substr(iso_s, 1, 10) as date) end as iso_s,
        dirty_s from {v_strings}""",
    "load_pass_replicated": """select
        concat(case when d.s3_key like 'ods/%' and d.table_no % 2 = 0 then 'raw/' else '' end, regexp_replace(d.s3_key, '/[^/]*$', '')) as destination,
        case when d.s3_key not like 'ods/%' then '' when d.delivery = 1 then '20240101T000000Z' else '20240201T000000Z' end as snapshot,
        regexp_extract(d.s3_key, '[^/]*$') as identifier, l.n, l.day, l.text
        from (select *, case when owner < 0 then -1 - owner else owner % 5 end as table_no from {v_deliveries}) d
        join {v_delivered_lines} l on l.owner = d.owner where d.owner < 0 or d.owner % 13 <> 0""",
    "load_pass_schema_gate": """select s3_key, s3_modified, case
        when s3_key like 'ods/%' and owner >= 0 and (owner % 7 = 0 or owner % 5 = 0 or owner % 11 = 0) then 'ready_for_erroring'
        when owner % 13 = 0 and owner in (select owner from {v_delivered_lines}) then 'ready_for_erroring'
        else 'ready_for_archiving' end as status from {v_deliveries} where delivery = 1""",
    "relocation_pass": r"""with named as (
          select *, owner % 8 as fate, regexp_replace(s3_key, '\.csv\.gz$', '') as root, regexp_replace(s3_key, '/[^/]*$', '') as dir,
                 regexp_replace(regexp_extract(s3_key, '[^/]*$'), '\.csv\.gz$', '') as stem, s3_key like 'ods/%' as ods
          from {v_deliveries} where owner >= 0),
        files as (select *, '.csv.gz' as suffix from named union all select *, '.dfm' as suffix from named where ods),
        placed as (
          select case when fate = 2 then 'errors' when fate = 3 then 'incoming' else 'archive' end as area,
                 case when fate = 3 or not ods then root
                      when fate = 2 then concat(dir, '/timestamp=', strftime(s3_modified, '%Y%m%dT%H%M%SZ'), '/', stem)
                      else concat(dir, '/snapshot=', case delivery when 1 then '20240101T000000Z/' else '20240201T000000Z/' end, stem) end || suffix as key
          from files where fate <> 4)
        select area, key from placed
        union all
        select 'ledger' as area, concat(s3_key, ' ', case fate when 2 then 'errored' when 3 then 'ready' when 4 then 'archived_unknown' else 'archived' end) as key from named""",
    "stream_advance": r"""with named as (
          select *, owner >= 0 and owner % 13 = 0 and owner in (select owner from {v_delivered_lines}) as bad,
                 regexp_replace(s3_key, '\.csv\.gz$', '') as root, regexp_replace(s3_key, '/[^/]*$', '') as dir,
                 regexp_replace(regexp_extract(s3_key, '[^/]*$'), '\.csv\.gz$', '') as stem, s3_key like 'ods/%' as ods
          from {v_deliveries} where owner >= 0 or delivery = 1),
        files as (select *, '.csv.gz' as suffix from named union all select *, '.dfm' as suffix from named where ods)
        select case when bad then 'errors' else 'archive' end as area, concat(case when ods then concat(dir, '/at/', stem) else root end, suffix) as key from files
        union all
        select 'ledger' as area, concat(s3_key, ' ', case when bad then 'errored' else 'archived' end) as key from named""",
    "feed_sync": """with announced as (
          select arrival, p.position, arrival % 7 as feed_id, json_extract(body, '$.results[' || p.position || ']') as r
          from {v_twin_bodies} cross join (select unnest([0, 1, 2]) as position) p),
        rows as (
          select arrival % 2 as round, arrival, position, feed_id, r->>'$.id' as type, r->>'$.dataset_id' as identifier, r->>'$.start_date' as start_date,
                 r->>'$.end_date' as end_date, r->>'$.url' as url, cast(r->>'$.last_updated' as timestamp) as last_updated_at from announced)
        select 'dataset' as kind, arg_min(feed_id, (round, arrival, position)) as feed_id,
               concat(identifier, ' ', arg_min(concat(type, ' ', start_date, ' ', end_date), (round, arrival, position))) as what,
               arg_max(last_updated_at, (round, arrival, position)) as last_updated_at from rows group by identifier
        union all
        select 'feed', id, relative_url, greatest(last_updated_at, (select max(r.last_updated_at) from rows r where r.feed_id = f.id)) from {v_feeds} f
        union all
        select 'fetch', feed_id, concat(url, ' datasets/', type, '/', identifier, '.csv.gz'), null from rows""",
    "register_all": """with batch as (select distinct name, s3_prefix, is_raw from {v_registrations}),
        judged as (
          select b.*, case when b.name in (select name from {v_tables}) then 'known' when b.s3_prefix in (select s3_prefix from {v_tables}) then 'taken'
               when (select count(*) from batch o where o.name = b.name) > 1 or (select count(*) from batch o where o.s3_prefix = b.s3_prefix) > 1 then 'ambiguous' end as reason
          from batch b),
        fresh as (select *, (select max(id) from {v_tables}) + row_number() over (order by name) as id from judged where reason is null),
        feeds_new as (select relative_url, (select max(id) from {v_feeds} where id % 2 = 0) + row_number() over (order by relative_url) as id
                      from (select distinct relative_url from {v_feeds} where id % 2 = 1) f)
        select 'table' as kind, id, concat(name, ' ', s3_prefix, ' ', cast(is_raw as varchar)) as what from {v_tables}
        union all select 'table', id, concat(name, ' ', s3_prefix, ' ', cast(is_raw as varchar)) from fresh
        union all select 'snapshot', table_id, concat(cast(table_id as varchar), ' ', snapshot_s3_key) from {v_table_snapshots}
        union all select 'snapshot', (select max(table_id) from {v_table_snapshots}) + row_number() over (order by concat(s3_prefix, 'LOAD00000001.csv.gz')),
                         concat(cast(id as varchar), ' ', s3_prefix, 'LOAD00000001.csv.gz') from fresh where s3_prefix like 'ods/%'
        union all select 'feed', id, relative_url from {v_feeds} where id % 2 = 0
        union all select 'feed', id, relative_url from feeds_new
        union all select 'refused 0', null, concat(name, ' ', s3_prefix, ' ', reason) from judged where reason is not null
        union all select 'refused 1', null, concat(name, ' ', s3_prefix, ' ', case when reason = 'ambiguous' then reason when name in (select name from {v_tables}) or reason is null then 'known' else reason end) from judged""",
    "cast_rejects": """select l_orderkey, l_linenumber, 'dirty_s' as "column", 'long' as "type", dirty_s as "value"
        from {v_strings} where not regexp_full_match(dirty_s, '[0-9]+')""",
    "truncate_second": "select event_id, date_trunc('second', ts) as second from {events}",
    "format_snapshot": f"select event_id, strftime(ts, {STAMP}) as snapshot from {{events}}",
    "parse_iso_extended": f"select page_id, cast({DATASET.format('last_updated')} as timestamp) as last_updated_at from {{v_feed}}",
    "valid_iso_date": f"""select page_id, try_cast({DATASET.format('start_date')} as date) is not null as start_ok,
        try_cast({DATASET.format('end_date')} as date) is not null as end_ok, false as updated_ok from {{v_feed}}""",
    "valid_iso_datetime": f"""select page_id, try_cast({DATASET.format('last_updated')} as timestamp) is not null as updated_ok, false as end_ok from {{v_feed}}""",
    "valid_url": "select page_id, regexp_full_match(url, 'https://[^/?#]*/[^?#]+.*') as ok from {pages}",
    "has_keys": """select event_id, json_exists(props, '$.k') as has_k, json_exists(props, '$.k') and json_exists(props, '$.z') as has_k_and_z from {events}""",
    "is_ods": "select id, s3_key like 'ods/%' as is_ods from {v_mixed_loads}",
    "path_parts": f"""select id, {DIR} as dir, {BASE} as base, {STEM} as stem, {SOURCE_ROOT} as root, substr(s3_key, 5) as below,
        concat(regexp_replace({DIR}, '__ct$', ''), '/') as table_prefix from {{v_loads}}""",
    "scan_csv_strings": """select cast(l_orderkey as varchar) as l_orderkey, cast(l_linenumber as varchar) as l_linenumber, long_s,
        nullif(double_s, '') as double_s, iso_s, dirty_s from {v_strings}""",
    "list_objects": """select concat('T', table_id) as folder, count(distinct cast(floor(id / 50000) as bigint)) as objects, true as all_filled
        from {v_loads} group by table_id""",
    "stream_discover": """select l.table_id, case when s.table_id is null or s.snapshot is not null then 'ready' else 'ready_for_erroring' end as status,
        count(distinct cast(floor(l.id / 50000) as bigint)) as loads
        from {v_loads} l join {v_tables} t on t.id = l.table_id and t.is_active and t.deleted_at is null
        left join {v_table_snapshots} s on s.table_id = l.table_id group by all""",
    "stateful_watermark": f"""select o.table_id, o.event_id, o.object_key as key from {{v_objects}} o
        left join (select table_id, max(s3_modified) as watermark from ({LOADED}) group by table_id) w on w.table_id = o.table_id
        where o.already_loaded or w.watermark is null or {SECOND.format('o.last_modified')} > w.watermark""",
    "list_prefixes": """select distinct regexp_extract(s3_key, '^ods/[^/]*/') as prefix from {v_loads}
        union all select distinct concat('datasets/D', table_id, '/') from {v_objects}""",
    "manifest_columns": MANIFEST,
    "catalog_columns": f"select n.id, n.catalog_table, c.columns from ({NAMED_LOADS}) n left join ({CATALOG}) c on c.table_name = n.catalog_table",
    "catalog_type_map": """select *, case column_type when 'bigint' then 'long' when 'double' then 'double' when 'date' then 'date'
        when 'timestamp' then 'timestamp' else 'string' end as parsed_type from {v_registry}""",
    "schema_check": f"""select n.id, m.columns = coalesce(c.columns, '') as columns_match,
        len(list_filter(string_split(m.columns, ','), lambda x: x <> '' and not list_contains(coalesce(string_split(c.columns, ','), []), x))) as not_in_catalog,
        len(list_filter(coalesce(string_split(c.columns, ','), []), lambda x: not list_contains(string_split(m.columns, ','), x))) as not_in_manifest
        from ({NAMED_LOADS}) n join ({MANIFEST}) m on m.id = n.id left join ({CATALOG}) c on c.table_name = n.catalog_table""",
    "feed_results": f"""select page_id, {DATASET.format('id')} as type, {DATASET.format('dataset_id')} as identifier,
        cast({DATASET.format('end_date')} as date) as end_date, cast({DATASET.format('last_updated')} as timestamp) as last_updated_at,
        {DATASET.format('url')} as url from {{v_feed}}""",
    "payload_parse": """select o_orderkey, o_orderkey * 2 as id, concat('ods/A/', o_orderkey, '.csv.gz') as s3_key, 'a' as source_table_name,
        concat('snapshot=', o_orderstatus, '/identifier=', o_orderkey, '.csv.gz') as partitions from {orders}
        union all select o_orderkey, o_orderkey * 2 + 1, concat('datasets/b/', o_orderkey, '.csv.gz'), 'b', concat('identifier=', o_orderkey, '.csv.gz') from {orders}""",
    "ledger_live": "select * from {v_loads} where deleted_at is null",
    "active_tables": "select * from {v_many_tables} where is_active and deleted_at is null",
    "loads_by_status": "select id, status, s3_key from {v_loads} where deleted_at is null and status in ('ready', 'archiving') order by id limit 1000",
    "loads_by_status_all": "select id, status, s3_key from {v_loads} where deleted_at is null and status in ('ready', 'archiving')",
    "loads_with_table": f"""select l.id, l.table_id, t.name as table_name, l.s3_key from {{v_loads}} l join {{v_tables}} t on t.id = l.table_id
        where l.deleted_at is null and l.id in {RETURNED}""",
    "tables_with_snapshot": """select t.id, t.name, s.snapshot_s3_key, s.snapshot from {v_many_tables} t
        left join {v_many_snapshots} s on s.table_id = t.id where t.deleted_at is null order by t.id""",
    "latest_load_snapshot": LATEST_SNAPSHOT,
    "latest_snapshot_load": LAST_SNAPSHOT_LOAD,
    "ready_loads": f"""select * from ({READY}) qualify row_number() over (partition by table_id order by s3_modified, s3_key, id) <= 100""",
    "ready_loads_all": f"select id, table_id, table_name from ({READY})",
    "ledger_json": "select id, table_id, status, s3_key, s3_size, is_raw, deleted_at from {v_loads}",
    "dispatch_actions": """select id, status, case status when 'ready_for_ingesting' then 'ingest' when 'ready_for_archiving' then 'archive' else 'error' end as action
        from {v_status_loads} where deleted_at is null and status like 'ready\\_for\\_%' escape '\\'""",
    "stuck_loads": """select id, status, case when status like 'archiv%' then 'archive' else 'error' end as action
        from {v_status_loads} where deleted_at is null and status in ('archiving', 'archived_unknown', 'erroring', 'errored_unknown')""",
    "update_status_many": f"""select id, case when deleted_at is null and id in {RETURNED} then 'archived' else status end as status from {{v_loads}}""",
    "changed_rows": f"select id, 'archived' as status, s3_key from {{v_loads}} where deleted_at is null and id in {RETURNED}",
    "status_transition": f"""select l.id as load_id, l.status, e.event, r.next_status from {{v_status_loads}} l join {{v_status_events}} e on e.load_id = l.id
        left join (values {RULES}) r(status, event, next_status) on r.status = l.status and r.event = e.event""",
    "status_fold": EVENT_WALK + "select load_id, seq, event, status, next_status from walk",
    "folded_status": EVENT_WALK + """select l.id as load_id, coalesce(f.last_status, l.status) as status, coalesce(f.applied, 0) as applied, coalesce(f.rejected, 0) as rejected
        from {v_status_loads} l left join (select load_id, arg_max(coalesce(next_status, status), n) as last_status, count(next_status) as applied,
            count(*) - count(next_status) as rejected from walk group by load_id) f on f.load_id = l.id""",
    "find_by_clause": "select t.id, t.name, l.id as load_id from {v_tables} t join {v_loads} l on l.table_id = t.id where t.s3_prefix = 'ods/T7/' and not t.is_raw and t.deleted_at is null",
    "current_status": 'select load_id, arg_max(status, ("at", seq)) as status from {v_status_log} group by load_id',
    "register_tables": """select concat('ods__t', c_custkey) as name, concat('ods/T', c_custkey, '/') as s3_prefix,
        concat('ods/T', c_custkey, '/LOAD00000001.csv.gz') as snapshot_s3_key from {customer}
        where concat('ods__t', c_custkey) not in (select name from {v_tables})""",
    "match_prefixes": """select p.prefix, t.id as table_id, t.name as table_name
        from (select distinct regexp_extract(s3_key, '^ods/[^/]*/') as prefix from {v_loads}) p
        join {v_tables} t on t.s3_prefix = regexp_replace(p.prefix, '__ct/$', '/') and t.is_active and t.deleted_at is null""",
    "valid_objects": "select event_id, object_key, object_size from {v_objects} where object_key like '%.csv.gz' and object_size is not null",
    "table_watermark": f"select table_id, max(s3_modified) as watermark from ({LOADED}) group by table_id",
    "new_objects": f"""select o.table_id, o.event_id, o.object_key as key from {{v_objects}} o
        left join (select table_id, max(s3_modified) as watermark from ({LOADED}) group by table_id) w on w.table_id = o.table_id
        where o.object_key like '%.csv.gz' and o.object_size is not null
          and (w.watermark is null or {SECOND.format('o.last_modified')} > w.watermark)
        qualify row_number() over (partition by regexp_extract(o.object_key, '^.*/') order by o.object_key) <= 500""",
    "new_objects_all": f"""select o.table_id, o.event_id, o.object_key as key from {{v_objects}} o
        left join (select table_id, max(s3_modified) as watermark from ({LOADED}) group by table_id) w on w.table_id = o.table_id
        where o.object_key like '%.csv.gz' and o.object_size is not null
          and (w.watermark is null or {SECOND.format('o.last_modified')} > w.watermark)""",
    "unseen_objects": f"""select o.table_id, o.event_id, o.object_key as key from {{v_objects}} o
        where o.object_key like '%.csv.gz' and o.object_size is not null
          and not exists (select 1 from ({LOADED}) d where d.object_key = o.object_key and d.s3_modified = {SECOND.format('o.last_modified')})""",
    "snapshot_fold": f"select id, table_id, snapshot, is_snapshot_table from ({FOLD})",
    "table_snapshot_update": """select s.table_id, s.snapshot_s3_key, coalesce(max(l.s3_modified), s.snapshot) as snapshot
        from {v_table_snapshots} s left join {v_loads} l on l.table_id = s.table_id and l.s3_key = s.snapshot_s3_key
        group by s.table_id, s.snapshot_s3_key, s.snapshot""",
    "new_load_rows": f"select id, table_id, status, s3_key, s3_modified, s3_size, is_raw from ({NEW_LOADS})",
    "load_snapshot_rows": f"select id as load_id, snapshot from ({NEW_LOADS}) where is_snapshot_table",
    "dense_load_ids": """select (select max(id) from {v_loads}) + row_number() over (order by table_id, s3_key, s3_modified) as id, table_id, s3_key, s3_modified
        from {v_loads}""",
    "chunk_loads_global": ALL_BATCHES + "select id, s3_size, batch_no from walk",
    "chunk_loads": BATCHES + "select id, table_id, s3_size, batch_no from walk",
    "batch_stats": BATCHES + "select table_id, batch_no, count(*) as load_count, cast(sum(s3_size) as bigint) as total_bytes from walk group by table_id, batch_no",
    "route_loads": f"select id, source_table_name, destination_table_name, source_path, destination_path, identifier from ({ROUTED})",
    "routed_partitions": f"""select r.id, concat(case when {MIXED_ODS} then concat('snapshot=', strftime(s.snapshot, {STAMP}), '/') else '' end, 'identifier=', r.identifier) as partitions
        from ({ROUTED}) r join ({LATEST_SNAPSHOT}) s on s.load_id = r.id""",
    "archive_keys": f"select l.id, {ARCHIVE_ROOT} as destination from {{v_mixed_loads}} l join ({LATEST_SNAPSHOT}) s on s.load_id = l.id",
    "error_keys": f"select id, {ERROR_ROOT} as destination from {{v_mixed_loads}}",
    "move_pairs": PAIRS.format(
        f"select l.id, {SOURCE_ROOT} as source, {ARCHIVE_ROOT} as destination from {{v_mixed_loads}} l join ({LATEST_SNAPSHOT}) s on s.load_id = l.id"
    ),
    "move_plan": f"""select p.id, p.source_key, p.destination_key,
        case when s.source_key is null and d.destination_key is not null then 'already_copied' when s.source_key is null then 'error'
             when d.destination_key is not null then 'delete_source' else 'copy_then_delete' end as action
        from ({ERROR_PAIRS}) p
        left join (select distinct source_key from ({ERROR_PAIRS}) where id % 4 in (0, 1)) s on s.source_key = p.source_key
        left join (select distinct destination_key from ({ERROR_PAIRS}) where id % 4 in (1, 2)) d on d.destination_key = p.destination_key""",
    "partition_literals": "select o_orderkey, o_totalprice, '20220101T204950Z' as snapshot, 'LOAD1.csv.gz' as identifier from {orders}",
    "land_partitioned": """select o_orderkey, o_custkey, case when o_orderstatus = 'F' then o_totalprice + 1 else o_totalprice end as o_totalprice,
        o_orderstatus from {orders}""",
    "land_empty_partition": """select o_orderkey, case when o_orderstatus in ('F', 'O') then o_totalprice + 1 else o_totalprice end as o_totalprice,
        o_orderstatus, o_orderpriority from {orders} where not (o_orderstatus = 'O' and o_orderpriority >= '3')""",
    "upsert_datasets_ordered": """
        with seen as (
            select c_custkey % 7 as feed_id, c_custkey as arrival, x.* from {customer},
                lateral (values (0, 'first', 'd' || c_custkey % 600, date '2022-05-17', date '2022-05-17', timestamp '2022-05-18 12:12:24.000001'),
                    (1, 'second', 'e' || c_custkey % 400, date '2022-05-18', date '2022-05-18', timestamp '2022-05-19 12:12:24' + to_microseconds(c_custkey % 1000000)),
                    (2, 'third', 'd' || c_custkey % 600, date '2022-05-19', date '2022-05-20', timestamp '2022-05-20 12:12:24' + to_microseconds(c_custkey % 1000000)))
                    x(place, type, identifier, start_date, end_date, last_updated_at)),
        batch as (
            select identifier, arg_min(feed_id, (arrival, place)) as feed_id, arg_min(type, (arrival, place)) as type, arg_min(start_date, (arrival, place)) as start_date,
                   arg_min(end_date, (arrival, place)) as end_date, arg_max(last_updated_at, (arrival, place)) as last_updated_at
            from seen group by identifier),
        stored as (select cast(c_nationkey as bigint) as feed_id, 'stored' as type, 'd' || c_custkey as identifier, date '2020-01-01' as start_date,
                          date '2020-01-02' as end_date, timestamp '2020-01-03 00:00:00' as last_updated_at from {customer} where c_custkey % 2 = 0)
        select coalesce(s.feed_id, b.feed_id) as feed_id, coalesce(s.type, b.type) as type, coalesce(s.identifier, b.identifier) as identifier,
               coalesce(s.start_date, b.start_date) as start_date, coalesce(s.end_date, b.end_date) as end_date, coalesce(b.last_updated_at, s.last_updated_at) as last_updated_at
        from stored s full join batch b on b.identifier = s.identifier""",
    "valid_datasets": f"""select page_id, {DATASET.format('id')} as type, {DATASET.format('dataset_id')} as identifier,
        cast({DATASET.format('start_date')} as date) as start_date, cast({DATASET.format('end_date')} as date) as end_date,
        cast({DATASET.format('last_updated')} as timestamp) as last_updated_at, url
        from (select f.page_id, f.body, p.url from {{v_feed}} f join {{pages}} p on p.page_id = f.page_id) where {VALID_PAGE}""",
    "upsert_datasets": f"""select coalesce(st.feed_id, i.feed_id) as feed_id, coalesce(st.type, i.type) as type, coalesce(st.identifier, i.identifier) as identifier,
        coalesce(st.start_date, i.start_date) as start_date, coalesce(st.end_date, i.end_date) as end_date, coalesce(i.last_updated_at, st.last_updated_at) as last_updated_at
        from (select cast(c_nationkey as bigint) as feed_id, 'stored' as type, concat('sample_', c_custkey) as identifier, date '2020-01-01' as start_date,
                     date '2020-01-02' as end_date, timestamp '2020-01-03 00:00:00' as last_updated_at from {{customer}}) st
        full join (select identifier, arg_min(feed_id, page_id) as feed_id, 'sample' as type, date '2022-05-17' as start_date, date '2022-05-17' as end_date,
                          arg_max(last_updated_at, page_id) as last_updated_at
                   from (select page_id, page_id % 10 as feed_id, concat('sample_', cast(floor(page_id / 2 * 9) as bigint)) as identifier,
                                cast({DATASET.format('last_updated')} as timestamp) as last_updated_at
                         from (select f.page_id, f.body, p.url from {{v_feed}} f join {{pages}} p on p.page_id = f.page_id) where {VALID_PAGE})
                   group by identifier) i on i.identifier = st.identifier""",
    "feed_watermark": """select f.id, f.relative_url, case when d.newest is null then f.last_updated_at when f.last_updated_at is null then d.newest
        when d.newest > f.last_updated_at then d.newest else f.last_updated_at end as last_updated_at
        from {v_feeds} f left join (select user_id, max(ts) as newest from {events} group by user_id) d on d.user_id = f.id""",
    "feed_requests": """select id, relative_url, case when relative_url like '%controlled%' then 'controlled' else 'public' end as access_class,
        concat('https://feeds.example.com', relative_url) as request_url,
        case when id % 7 = 0 then '2022-05-01T10:49:50.123456' else strftime(last_updated_at + interval 1 microsecond, '%Y-%m-%dT%H:%M:%S.%f') end as last_updated
        from {v_feeds}""",
    "feed_access_class": "select id, case when relative_url like '%controlled%' then 'controlled' else 'public' end as access_class from {v_feeds}",
    "dataset_landing_key": "select page_id, concat('datasets/sample/sample_', page_id, '.csv.gz') as landing_key from {v_feed}",
    "remap_feed_urls": """select id, case when id % 2 = 1 and id in (select s_suppkey from {supplier}) then concat('/datasetpublicusersapi/renamed/d', id) else relative_url end as relative_url
        from {v_feeds}""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in SQL.items()}
