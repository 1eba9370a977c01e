"""The registered queries as standard SQL over the same tables, for checking results."""

from __future__ import annotations

from spanloom.plans.constants import (
    AS_OF, BACKLOG_MS, FIRST_MS, LATE_MS, LOOKUP_FIRST, LOOKUP_LAST, REPLAY_HOLD_MS, SLICE_MS,
)

TAGGED = """
e as (select *, epoch_us(ts) // 1000 as begin_ms,
        cast(json_extract_string(props, '$.k') as int) as k,
        cast(date_trunc('day', ts) as date) as d from events),
n as (select *, user_id * 1000 + dayofyear(d) as tno,
        row_number() over (partition by user_id, d order by ts, event_id) as idx from e),
m as (select *, format('{:016x}', tno) as tid,
        case when idx = 1 then format('{:016x}', tno)
             else format('{:016x}', 1000000000 + event_id) end as sid from n),
tagged as (
  select c.tno, c.idx, c.event_id, c.tid as traceid, c.sid as spanid, p.sid as parent,
    case when c.k = 99 then 'http:/' when c.idx = 1 then concat('http:/', c.event_type)
         else c.event_type end as name,
    c.begin_ms as begin, c.begin_ms + cast(floor(c.value) as bigint) as "end",
    (c.begin_ms // 86400000 + 1) * 86400000 as receive,
    case when c.idx = 1 or c.k % 10 = 0 then 'sr' else 'cs' end as event,
    concat('svc', c.user_id % 7) as service, concat('10.1.0.', c.user_id % 50) as ip,
    case when c.k % 5 = 0 then 'redis' when c.k % 5 = 1 then 'mysql' end as tag_lc,
    case when c.k % 5 = 2 then 'http://h/x' end as tag_http_url,
    case when c.k % 4 = 0 then concat('10.0.0.', c.k) end as tag_http_host,
    case when c.event_type = 'error' then 'boom' end as tag_error,
    case when c.user_id % 2 = 0 then 'r1' end as tag_region,
    case when c.k % 3 = 0 then concat('iFP', c.user_id % 10)
         when c.k % 3 = 1 then concat('aFP', c.user_id % 10) end as tag_from_page
  from m c left join m p
    on c.user_id = p.user_id and c.d = p.d and c.idx > 1 and p.idx = c.idx // 2)
"""

SPANS = TAGGED + """,
spans as (
  select name, traceid, spanid, parent, begin, "end", "end" - begin as duration, receive, event,
    service, ip, tag_http_host as http_host,
    cast(case when trim(tag_error) <> '' then 1 else 0 end as bigint) as error_count,
    case when tag_lc = 'redis' then 'REDIS' when tag_lc = 'mysql' then 'MYSQL'
         when trim(tag_http_url) <> '' then 'RESTTEMPLATE'
         when traceid = spanid then 'HTTP' else 'OTHER' end as span_type,
    case when trim(tag_region) <> '' then tag_region end as region,
    tag_from_page as page_id
  from tagged)
"""

TREE = SPANS + """,
ranked as (
  select *, row_number() over (partition by traceid
            order by begin, lower(name), spanid, event, parent, name, "end", receive) as rn
  from spans),
roots as (
  select traceid, coalesce(min(case when spanid = traceid then rn end), max(rn)) as rn
  from ranked group by traceid),
-- An id's children belong to the root, if it has the id, or else to the first span with it.
owned as (
  select r.*, r.rn = o.rn as is_root,
    row_number() over (partition by r.traceid, r.spanid order by r.rn <> o.rn, r.rn) = 1 as owns
  from ranked r join roots o on r.traceid = o.traceid),
edges as (select * from owned where not is_root and event = 'cs' and spanid <> parent),
tree as (
  select traceid, spanid, rn, owns, 0 as level, [rn] as path from owned where is_root
  union all
  select c.traceid, c.spanid, c.rn, c.owns, t.level + 1, list_append(t.path, c.rn)
  from tree t join edges c on c.traceid = t.traceid and c.parent = t.spanid
  where t.owns),
steps as (
  select t.traceid, cast(row_number() over (partition by t.traceid order by t.path) - 1 as bigint) as pos,
    cast(t.level as bigint) as level, r.spanid, r.name, r.event, r.begin, r."end", r.receive,
    case when t.level = 0 then t.traceid else r.parent end as parent,
    r.error_count, r.span_type, r.region, r.ip, r.http_host
  from tree t join ranked r on t.traceid = r.traceid and t.rn = r.rn),
summary as (
  select traceid, max(case when pos = 0 then name end) as api,
    md5(string_agg(name, '|' order by pos) || '|') as trace_md5,
    max(case when pos = 0 then "end" - begin end) as duration,
    max(case when pos = 0 then begin end) as start_ms,
    max(case when pos = 0 then begin end) // 86400000 * 86400 as start_day,
    max(case when pos = 0 then receive end) // 60000 * 60 as minute_start,
    max(case when pos = 0 then receive end) // 86400000 * 86400 as day_start,
    bool_or(error_count > 0) as error_status,
    count(*) filter (where span_type = 'RESTTEMPLATE') as rest_times,
    count(*) filter (where span_type = 'MYSQL') as mysql_times,
    count(*) filter (where span_type = 'REDIS') as redis_times,
    max(case when pos = 0 then region end) as region,
    count(*) as steps_total
  from steps group by traceid)
"""

MEASURED = TREE + """,
chain as (
  select s.*, m.minute_start, m.start_day, m.trace_md5 from steps s join summary m on s.traceid = m.traceid)
"""

STEP_JSON = """
  '{"spanName":"' || name || '","spanId":"' || spanid || '","duration":' || ("end" - begin)
  || ',"level":' || level || ',"parent":"' || parent || '","errorCount":' || error_count
  || ',"spanType":"' || span_type || '"}'
"""

JSON = TREE + f""",
texts as (
  select traceid, cast(pos // 1000 as bigint) as segment,
    '[' || string_agg({STEP_JSON}, ',' order by pos) || ']' as spans
  from steps group by traceid, pos // 1000),
full_rows as (select m.*, x.segment, x.spans from summary m join texts x on m.traceid = x.traceid)
"""


def _with(ctes: str, body: str) -> str:
    return f"with recursive {ctes}\n{body}"


def chains(source: str, bucket: str, extra: str = "") -> str:
    """Call-chain statistics of a summary-like relation."""
    return f"""
select {extra} {bucket}, trace_md5, api, count(*) as times,
  cast(sum(duration) // count(*) as bigint) as duration,
  max(duration) as max_latency,
  max({{'d': duration, 't': traceid}})['t'] as max_latency_trace,
  min(duration) as min_latency,
  min({{'d': duration, 't': traceid}})['t'] as min_latency_trace,
  cast(sum(rest_times) as bigint) as rest_times,
  cast(sum(mysql_times) as bigint) as mysql_times,
  cast(sum(redis_times) as bigint) as redis_times,
  case when count(*) = 1 then max(region) end as region
from {source} group by {extra} {bucket}, trace_md5, api"""


def chain_steps(bucket: str) -> str:
    return f"""
select {bucket}, trace_md5, pos,
  min({{'t': traceid, 'v': name}})['v'] as span_name,
  min({{'t': traceid, 'v': spanid}})['v'] as span_id,
  cast(sum("end" - begin) // count(*) as bigint) as duration,
  min({{'t': traceid, 'v': level}})['v'] as level,
  min({{'t': traceid, 'v': parent}})['v'] as parent,
  cast(sum(error_count) as bigint) as error_count,
  min({{'t': traceid, 'v': span_type}})['v'] as span_type
from chain group by {bucket}, trace_md5, pos"""


def chain_table(bucket: str) -> str:
    """Chain statistics joined with their steps as JSON, 1,000 steps a row."""
    return MEASURED + f""",
chain_rows as ({chains("summary", bucket)}),
chain_steps as ({chain_steps(bucket)}),
chain_texts as (
  select {bucket}, trace_md5, cast(pos // 1000 as bigint) as segment,
    '[' || string_agg(
      '{{"spanName":"' || span_name || '","spanId":"' || span_id || '","duration":' || duration
      || ',"level":' || level || ',"parent":"' || parent || '","errorCount":' || error_count
      || ',"spanType":"' || span_type || '"}}', ',' order by pos) || ']' as spans
  from chain_steps group by {bucket}, trace_md5, pos // 1000)"""


EMITTED = TREE + f""",
slices as (
  select traceid, min(receive) // {SLICE_MS} as slice,
    bool_or(receive - "end" < {REPLAY_HOLD_MS}) as held
  from spans group by traceid),
emitted as (
  select traceid, cast(dense_rank() over (order by slice) - 1
                       + case when held then 1 else 0 end as bigint) as batch_id
  from slices)
"""

PAGES = SPANS + """,
paged as (
  select case when page_id like 'iFP%' or page_id like 'aFP%' then substr(page_id, 2)
              else page_id end as page,
    replace(name, 'http:/', '') as api, "end" - begin as duration, receive
  from spans
  where page_id <> '' and name <> '' and name <> 'http:/'),
totals as (
  select page, api, count(*) as times, cast(sum(duration) as bigint) as total_duration,
    cast(sum(duration) // count(*) as bigint) as duration
  from paged group by page, api)
"""

STORE = TAGGED + """,
sent as (
  select *, receive as version, name as sent_name from tagged
  union all
  select *, receive + 60000, upper(name) from tagged where tag_error is not null),
store as (
  select traceid || ':' || (begin // 1000) || ':' || spanid || ':' || event as rowkey,
    traceid, begin // 1000 as begin_sec, spanid, event, service, ip, sent_name as name, begin,
    "end", parent,
    '[{"timestamp":' || begin || ',"event":"' || event || '"}]' as logs,
    version as receive
  from sent
  qualify row_number() over (partition by traceid, begin // 1000, spanid, event
                             order by version desc) = 1)
"""

NESTED = TAGGED + """,
z as (
  select traceid as trace_id, spanid as id, event as event_key, tagged.*,
    cast((10 * 16777216 + 1 * 65536) + cast(split_part(ip, '.', 4) as bigint) as bigint) as ipv4
  from tagged)
"""



# Spans with errors sent a second time, a minute later, under a name in upper case.
RESENT = """,
spans as (
  select * from first_spans
  union all
  select * replace (upper(name) as name, receive + 60000 as receive) from first_spans
  where error_count > 0)
"""
RESOLVED = """,
spans as (
  select * from sent_spans
  qualify row_number() over (partition by traceid, begin // 1000, spanid, event
                             order by receive desc) = 1)
"""


def _resent(ctes: str, resolved: bool = False) -> str:
    """The relations of ``ctes`` over spans of which some were sent again."""
    flat = SPANS.replace("\nspans as (", "\nfirst_spans as (")
    again = RESENT + RESOLVED if resolved else RESENT
    if resolved:
        again = again.replace("\nspans as (", "\nsent_spans as (", 1)
    return ctes.replace(SPANS, flat + again)


def _traces_by(ctes: str, trace_no: str) -> str:
    """The same relations over events cut into traces by another number."""
    return (
        ctes.replace("user_id * 1000 + dayofyear(d) as tno", f"cast({trace_no} as bigint) as tno")
        .replace("partition by user_id, d order by", f"partition by {trace_no} order by")
        .replace("c.user_id = p.user_id and c.d = p.d", "c.tno = p.tno")
    )


TYPE_NO = "ascii(event_type) * 100 + length(event_type)"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    q["span_flatten"] = _with(SPANS, "select * from spans")
    q["span_flatten_messages"] = q["span_flatten"]
    q["span_type_counts"] = _with(SPANS, """
select span_type, count(*) as spans, cast(sum(error_count) as bigint) as errors
from spans group by span_type""")
    q["late_trace_filter"] = _with(SPANS, f"""
select traceid, spanid, "end" from spans where traceid in (
  select traceid from spans group by traceid having {AS_OF} - max("end") < 1000000000)""")
    held = f"""
select traceid from spans group by traceid
having bool_or(receive - "end" < {REPLAY_HOLD_MS})"""
    q["held_traces"] = _with(SPANS, held)
    released = f"""
select traceid from spans where traceid in ({held}) group by traceid
having min({AS_OF} - receive) >= 60000 and max({AS_OF} - receive) < 1296000000"""
    q["released_traces"] = _with(SPANS, released)
    q["ready_traces"] = _with(SPANS, f"""
select traceid, count(*) as spans from spans
where traceid not in ({held}) or traceid in ({released}) group by traceid""")

    q["span_order"] = _with(TREE, "select traceid, spanid, rn as position from ranked")
    q["trace_tree"] = _with(
        TREE, "select traceid, pos, level, spanid, parent, name, event from steps"
    )
    q["trace_summary"] = _with(TREE, "select * from summary")
    q["api_minutes"] = _with(TREE, chains("summary", "minute_start"))
    q["api_minutes_steps"] = _with(MEASURED, chain_steps("minute_start"))
    q["api_minutes_table"] = _with(
        chain_table("minute_start"),
        "select * from chain_rows join chain_texts using (minute_start, trace_md5)",
    )
    q["api_daily"] = _with(
        TREE + """,
days as (select * exclude (day_start), start_day as day_start from summary)""",
        chains("days", "day_start"),
    )
    q["api_daily_table"] = _with(chain_table("start_day"), """
select * exclude (start_day), start_day as day_start,
  api || ':' || start_day || '.' || trace_md5 as rowkey
from chain_rows join chain_texts using (start_day, trace_md5)""")
    q["step_profile_by_name"] = _with(MEASURED + """,
calls as (select trace_md5, count(*) as times from summary group by trace_md5)""", """
select s.trace_md5, s.name as span_name, c.times, count(*) as steps,
  cast(sum(s."end" - s.begin) // c.times as bigint) as duration
from chain s join calls c on s.trace_md5 = c.trace_md5
group by s.trace_md5, s.name, c.times""")
    q["chain_profile"] = _with(TREE, """
select api, trace_md5, count(*) as times,
  cast(sum(duration) // count(*) as bigint) as duration,
  coalesce(max(duration) filter (where duration > 1), 1) as max_latency,
  coalesce((max({'d': duration, 't': traceid}) filter (where duration > 1))['t'], '')
    as max_latency_trace,
  coalesce(min(duration) filter (where duration < 9999999), 9999999) as min_latency,
  coalesce((min({'d': duration, 't': traceid}) filter (where duration < 9999999))['t'], '')
    as min_latency_trace
from summary group by api, trace_md5""")
    q["span_ip"] = _with(MEASURED, """
select trace_md5, name as span_name, minute_start,
  case when traceid = spanid then ip else http_host end as ip,
  cast(sum("end" - begin) // count(*) as bigint) as avg_duration, count(*) as times
from chain
where trim(case when traceid = spanid then ip else http_host end) <> ''
group by 1, 2, 3, 4""")

    failed = "where error_status and trim(api) <> '' and api <> 'http:/'"
    q["exception_trace_by_time"] = _with(TREE, f"""
select (start_ms // 1000) || ':' || traceid as rowkey, start_ms // 1000 as starttime, traceid,
  api, region from summary {failed}""")
    q["exception_trace_by_api"] = _with(JSON, f"""
select api || ':' || (start_ms // 1000) || ':' || traceid as rowkey, segment, spans, traceid,
  start_ms // 1000 as starttime, api, region from full_rows {failed}""")
    indexed = """segment, spans, traceid, start_ms // 1000 as starttime,
  minute_start || '.' || trace_md5 as bucket_md5, duration, region"""
    q["all_trace_by_md5"] = _with(JSON, f"""
select trace_md5 || ':' || (start_ms // 1000) || ':' || traceid as rowkey, {indexed}
from full_rows""")
    q["all_trace_by_api"] = _with(JSON, f"""
select api || ':' || (start_ms // 1000) || ':' || traceid as rowkey, {indexed}
from full_rows""")

    parity = "cast(('0x' || right(traceid, 1)) as bigint) % 2"
    parts = TREE + f""",
parts as (select *, {parity} as batch_id from summary)"""
    q["stored_chain_minutes"] = _with(
        parts + f""",
chain_parts as ({chains("parts", "minute_start", "batch_id,")})""", f"""
select batch_id, minute_start, trace_md5, times, duration, max_latency_trace,
  concat_ws(':', api, {AS_OF // 1000} + batch_id, trace_md5,
    case when minute_start < max(minute_start) over (partition by batch_id, api, trace_md5)
         then 'm' || minute_start end) as rowkey
from chain_parts""")
    q["stored_address_totals"] = q["span_ip"].replace(
        "select trace_md5, name as span_name, minute_start,",
        """select trace_md5 || ':' || name || ':' || minute_start || ':'
    || case when traceid = spanid then ip else http_host end as rowkey,
  trace_md5, name as span_name, minute_start,""",
    ).replace("group by 1, 2, 3, 4", "group by 1, 2, 3, 4, 5")
    started = "start_ms // 1000"
    q["stored_trace_keys"] = _with(parts, "\nunion all\n".join(
        f"select '{label}' as index, {key} as rowkey, traceid, {started} as starttime, batch_id "
        f"from parts {condition}"
        for label, key, condition in (
            ("failed by time", f"({started}) || ':' || traceid", failed),
            ("failed by api", f"api || ':' || ({started}) || ':' || traceid", failed),
            ("md5", f"trace_md5 || ':' || ({started}) || ':' || traceid", ""),
            ("api", f"api || ':' || ({started}) || ':' || traceid", ""),
        )))
    q["merged_address_totals"] = q["stored_address_totals"]
    q["trace_lookup"] = _with(JSON, f"""
select api || ':' || ({started}) || ':' || traceid as rowkey, segment, traceid,
  {started} as starttime, minute_start || '.' || trace_md5 as bucket_md5, duration, region
from full_rows
where api = (select max(api) from full_rows) and {started} between {LOOKUP_FIRST} and {LOOKUP_LAST}""")
    q["trace_results"] = _with(JSON, """
select api, cast(1 as bigint) as times, duration, segment, spans,
  minute_start || '.' || trace_md5 as bucket_md5, traceid as max_latency_trace,
  traceid as min_latency_trace, duration as max_latency, duration as min_latency, traceid,
  error_status, start_ms, rest_times, mysql_times, redis_times, region
from full_rows""")
    q["span_identities"] = _with(TAGGED, """
select cast(0 as bigint) as trace_high, tno as trace_no,
  case when idx = 1 then tno else 1000000000 + event_id end as span_no, count(*) as records
from tagged group by 1, 2, 3""")

    q["page_api"] = _with(PAGES, "select page, api, times, total_duration, duration from totals")
    q["api_page"] = _with(PAGES, "select api, page, times from totals")
    q["page_hot_api"] = _with(PAGES, "select page, max(times) as times from totals group by page")

    q["raw_span_store"] = _with(STORE, "select * from store")
    q["merged_span_store"] = q["raw_span_store"]
    low = AS_OF // 86_400_000 * 86_400_000 - 8 * 3_600_000
    q["stored_day_scan"] = _with(STORE, f"""
select name, traceid, spanid, parent, begin, "end", event, service, ip from store
where begin between {low} and {AS_OF}""")
    q["stored_span_parse"] = _with(
        STORE, 'select name, traceid, spanid, parent, begin, "end", event, service, ip from store'
    )
    q["id_normalize"] = """
with ids as (
  select event_id, (event_id - 500) * 1000003 as id, case when event_id % 2 = 0 then user_id else 0 end as high
  from events)
select event_id, id, case when id < 0 then format('{:016x}', 18446744073709551616::hugeint + id)
                          else format('{:016x}', id) end as hex,
  case when high <> 0 then format('{:016x}', high) else '' end
    || case when id < 0 then format('{:016x}', 18446744073709551616::hugeint + id)
            else format('{:016x}', id) end as trace_string,
  id as parsed, cast(null as bigint) as malformed
from ids"""

    q["zipkin_spans"] = _with(NESTED, """
select trace_id, id, event_key, parent as parent_id, lower(name) as name,
  begin * 1000 as timestamp, ("end" - begin) * 1000 as duration from z""")
    q["zipkin_annotations"] = _with(NESTED, """
select trace_id, id, event_key, begin * 1000 as timestamp, event as value,
  service as endpoint_service, ipv4 as endpoint_ipv4, cast(8080 as bigint) as endpoint_port
from z""")
    varied = NESTED.replace("tagged.*,", """tagged.*,
    case when idx = 1 then tno else 1000000000 + event_id end % 6 as kind,""")
    kept = "from z where kind <> 0"
    q["zipkin_varied_spans"] = _with(varied, f"""
select trace_id, id, case when kind = 3 then 'cs' else event_key end as event_key,
  case when kind = 5 then coalesce(parent, traceid) else parent end as parent_id,
  lower(name) as name, case when kind <> 1 then begin * 1000 end as timestamp,
  cast(case when kind = 3 then 7000 when kind not in (1, 2) then ("end" - begin) * 1000 end as bigint)
    as duration {kept}""")
    q["zipkin_varied_tags"] = _with(varied + """,
w as (select trace_id, id, case when kind = 3 then 'cs' else event_key end as event_key, service, ipv4,
        kind, event, tag_lc, tag_http_url, tag_http_host, tag_error, tag_region, tag_from_page,
        case when kind = 4 then 'Peer' || service end as tag_peer from z where kind <> 0)
""", "\nunion all\n".join(
        f"select trace_id, id, event_key, '{type_}' as type, '{key}' as key, {value} as value, "
        f"{endpoint} as endpoint_service, ipv4 as endpoint_ipv4, cast(8080 as bigint) as endpoint_port "
        f"from w where {condition}"
        for type_, key, value, endpoint, condition in (
            *(("STRING", key, column, "service", f"{column} is not null") for key, column in (
                ("lc", "tag_lc"), ("http.url", "tag_http_url"), ("http.host", "tag_http_host"),
                ("error", "tag_error"), ("region", "tag_region"), ("fromPage", "tag_from_page"),
                ("peer.service", "tag_peer"))),
            ("STRING", "lc", "lower('Proc-' || service)", "service",
             "kind <> 3 and event <> 'sr' and tag_lc is null"),
            ("BOOL", "sa", "'true'", "lower(tag_peer)", "event = 'cs' and tag_peer is not null"),
        )))
    tag_rows = "\nunion all\n".join(
        f"select trace_id, id, event_key, 'STRING' as type, '{key}' as key, {column} as value, "
        f"service as endpoint_service, ipv4 as endpoint_ipv4, cast(8080 as bigint) as endpoint_port "
        f"from z where {column} is not null"
        for key, column in (
            ("lc", "tag_lc"), ("http.url", "tag_http_url"), ("http.host", "tag_http_host"),
            ("error", "tag_error"), ("region", "tag_region"), ("fromPage", "tag_from_page"),
        )
    )
    q["zipkin_binary_annotations"] = _with(NESTED, f"""{tag_rows}
union all
select trace_id, id, event_key, 'STRING', 'lc', lower('Proc-' || service), service, ipv4,
  cast(8080 as bigint) from z where event = 'cs' and tag_lc is null""")

    q["decode_messages"] = _with(TAGGED, """
select service, ip, cast(8080 as bigint) as port, receive, traceid, spanid, parent, name, begin, "end",
  false as remote, 'Proc-' || service as process_id, ("end" - begin) * 1000 as duration_micros,
  concat_ws(',', 'error=' || tag_error, 'fromPage=' || tag_from_page, 'http.host=' || tag_http_host,
            'http.url=' || tag_http_url, 'lc=' || tag_lc, 'region=' || tag_region) as tags,
  begin as log_ms, event as log_event, cast(1 as bigint) as n_logs
from tagged""")
    q["dead_letters"] = """
select page_id,
  case when page_id % 4 = 0 then 'truncated' when page_id % 4 = 1 then 'empty'
       when page_id % 4 = 2 then 'malformed' else 'no spans' end as reason,
  md5(case when page_id % 4 = 0 then '\\x00'::blob when page_id % 4 = 1 then '\\x00\\x00'::blob
       when page_id % 4 = 2 then '\\x00\\x00'::blob || encode(html)
       else '\\x00\\x00'::blob || encode('{"url":"' || url || '"}') end) as payload_md5
from pages"""

    split = """
words as (
  select unnest(case when text is null then ['null'] when text = '' then ['']
                     when rtrim(text, ' ') = '' then [] else string_split(rtrim(text, ' '), ' ') end) as word,
         dense_rank() over (order by coalesce(lang, '')) - 1 as slice from documents)"""
    q["word_count"] = f"with {split} select word, count(*) as n from words group by word"
    q["word_count_running"] = f"""
with {split}, per as (select word, slice, count(*) as c from words group by word, slice)
select cast(slice as bigint) as batch_id, word,
  cast(sum(c) over (partition by word order by slice) as bigint) as n from per"""

    q["stream_trace_assembly"] = _with(EMITTED, """
select e.batch_id, s.traceid, s.api, s.trace_md5, s.duration, s.steps_total
from summary s join emitted e on s.traceid = e.traceid""")
    q["stream_api_minutes"] = _with(
        EMITTED + """,
batched as (select s.*, e.batch_id from summary s join emitted e on s.traceid = e.traceid)""",
        chains("batched", "minute_start", "batch_id,"),
    )
    q["stream_page_api"] = _with(PAGES, f"""
select cast(dense_rank() over (order by slice) - 1 as bigint) as batch_id, page, api, times,
  total_duration, duration
from (select receive // {SLICE_MS} as slice, page, api, count(*) as times,
        cast(sum(duration) as bigint) as total_duration,
        cast(sum(duration) // count(*) as bigint) as duration
      from paged group by 1, 2, 3)""")
    steps = "select traceid, pos, level, spanid, parent, name, event from steps"
    q["resent_trace_tree"] = _with(_resent(TREE), steps)
    q["resent_trace_summary"] = _with(_resent(TREE, resolved=True), "select * from summary")
    q["wide_trace_tree"] = _with(_traces_by(TREE, TYPE_NO), steps)
    q["wide_trace_summary"] = _with(_traces_by(TREE, TYPE_NO), "select * from summary")
    # In a chain the number of a span in its trace is its place and its depth.
    chain = _traces_by(TAGGED, TYPE_NO).replace("p.idx = c.idx // 2", "p.idx = c.idx - 1")
    q["deep_trace_tree"] = _with(chain, """
select traceid, idx - 1 as pos, idx - 1 as level, spanid, coalesce(parent, traceid) as parent, name,
  case when idx = 1 then event else 'cs' end as event
from tagged""")
    q["daily_job_table"] = q["api_daily_table"]
    q["daily_job_long_traces"] = _traces_by(
        q["api_daily_table"], "user_id * 1000 + dayofyear(d) // 10"
    ).replace(
        "epoch_us(ts) // 1000 as begin_ms",
        f"{FIRST_MS} + (epoch_us(ts) // 1000 - {FIRST_MS}) // 8 as begin_ms",
    )
    q["stream_late_spans"] = _with(SPANS, f"""
select batch_id, as_of, traceid, spanid from (
  select *, cast(dense_rank() over (order by receive // {SLICE_MS}) - 1 as bigint) as batch_id,
    max(receive) over (partition by receive // {SLICE_MS}) as as_of,
    max("end") over (partition by traceid) as last_end from spans)
where as_of - last_end >= {LATE_MS}""")
    q["stream_crossing_traces"] = _with(_traces_by(SPANS, "user_id") + f""",
per as (
  select traceid, cast(dense_rank() over (order by slice) - 1 as bigint) as b, recent, n from (
    select traceid, receive // {SLICE_MS} as slice, count(*) as n,
      bool_or(receive - "end" < {REPLAY_HOLD_MS}) as recent
    from spans group by 1, 2)),
-- A trace goes out in the first batch, from its own on, that brings it no recent span.
free as (
  select t.traceid, a.b from (select distinct traceid from per) t, (select distinct b from per) a
  where not exists (select 1 from per r where r.traceid = t.traceid and r.b = a.b and r.recent)),
ends as (
  select p.traceid, p.b, p.n, min(x.b) as out_b
  from per p left join free x on x.traceid = p.traceid and x.b >= p.b group by p.traceid, p.b, p.n)
""", """
select coalesce(out_b, (select max(b) + 1 from per)) as batch_id, traceid,
  cast(sum(n) as bigint) as spans
from ends group by 1, 2""")
    q["stream_keyed_assembly"] = q["stream_crossing_traces"]
    q["stream_merged_minutes"] = q["api_minutes"]
    q["stream_backlog_batches"] = _with(SPANS, f"""
select cast(dense_rank() over (order by slice) - 1 as bigint) as batch_id, spans, traces from (
  select (receive - {FIRST_MS} - 1) // {BACKLOG_MS} as slice, count(*) as spans,
    count(distinct traceid) as traces
  from spans group by 1)""")
    # Hours of a word without a gap of one belong together.
    q["word_count_expiring"] = f"""
with {split}, per as (select word, slice, count(*) as c from words group by word, slice),
runs as (select *, slice - row_number() over (partition by word order by slice) as run from per)
select word, cast(min(slice) as bigint) as first_hour, cast(max(slice) as bigint) as last_hour,
  cast(sum(c) as bigint) as n
from runs group by word, run"""
    q["stream_sessions"] = _with(TREE, """
select traceid, api, trace_md5, duration, steps_total from summary""")
    return q
