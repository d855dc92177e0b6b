"""DuckDB oracles for the named queries: independent SQL over the same
Parquet tables (views named after the tables), one statement per query.

The generator oracles recompute the seeded draws with DuckDB's md5, so the
generated rows are checked value by value.
"""

from __future__ import annotations

from livetables.plans.catalog import TICK_DAY, TICK_DAYS, TICK_ID_STEP
from livetables.sources import generators

_S = "(select distinct user_id as value from events where user_id % 4 = 0) s"

ORACLE_SQL: dict[str, str] = {
    "bucketed_last_quote": (
        "select e.user_id as sym, arg_max(e.value, e.event_id) as last_bid "
        f"from events e join {_S} on e.user_id = s.value "
        f"where cast(e.ts as date) = date '{TICK_DAY}' group by e.user_id"),
    "last_quote_by_symbol": (
        "select e.user_id as sym, arg_max(e.value, e.event_id) as last_bid "
        f"from events e join {_S} on e.user_id = s.value "
        f"where cast(e.ts as date) = date '{TICK_DAY}' group by e.user_id"),
    "last_price_by_symbol_exchange": (
        "select e.user_id as sym, e.event_type as ex, arg_max(e.value, e.event_id) as last_price "
        f"from events e join {_S} on e.user_id = s.value "
        f"where cast(e.ts as date) = date '{TICK_DAY}' group by e.user_id, e.event_type"),
    "hourly_avg_size": (
        "select e.user_id as sym, cast(hour(e.ts) as bigint) as hr, "
        "cast(sum(cast(e.value as decimal(18,2))) as double) / count(e.value) as avg_size "
        f"from events e join {_S} on e.user_id = s.value "
        f"where cast(e.ts as date) = date '{TICK_DAY}' group by e.user_id, hour(e.ts)"),
    "hour_of_text_time": "select hour(ts) as hr, count(*) as n from events group by 1",
    "max_bid_by_symbol": (
        "select t.user_id as sym, max(q.value) as max_bid "
        "from (select user_id from events where event_type = 'click') t "
        "join (select user_id, value from events where event_type = 'view') q "
        "on t.user_id = q.user_id group by t.user_id"),
    "delay_by_carrier": (
        "select cast(sum(cast(l.l_tax as decimal(18,2))) as double) as total_delay, "
        "p.p_name as description from lineitem l, part p "
        "where l.l_partkey = p.p_partkey and l.l_returnflag like '%A%' and l.l_tax > 0 "
        "group by p.p_name"),
    "top_delays": (
        "select cast(sum(cast(l.l_tax as decimal(18,2))) as double) as total_delay, "
        "p.p_name as description from lineitem l, part p "
        "where l.l_partkey = p.p_partkey and l.l_returnflag like '%A%' and l.l_tax > 0 "
        "group by p.p_name order by total_delay desc, description limit 20"),
}


# Generator oracles: the same seeded draws written in DuckDB SQL.

def _duck_draw(tag: str, window: int, id_col: str = "event_id") -> str:
    return (f"cast('0x' || substr(md5(concat('{tag}', cast({id_col} as varchar))), "
            f"{1 + 8 * window}, 8) as bigint)")


def _duck_symbol(idx: str) -> str:
    return (f"case when {idx} < 100 then 'SY' || lpad(cast({idx} as varchar), 2, '0') "
            f"else 'S' || cast({idx} as varchar) end")


def _duck_time(tag_a: str, tag_b: str) -> str:
    parts = [(_duck_draw(tag_a, 3), 8, 2), (_duck_draw(tag_b, 0), 60, 2),
             (_duck_draw(tag_b, 1), 60, 2), (_duck_draw(tag_b, 2), 1000, 3)]
    p = [f"lpad(cast({d} % {m} as varchar), {w}, '0')" for d, m, w in parts]
    return f"{p[0]} || ':' || {p[1]} || ':' || {p[2]} || '.' || {p[3]}"


def _duck_decimal_text(unscaled: str, scale: int = 4) -> str:
    return (f"cast(({unscaled}) // {10 ** scale} as varchar) || '.' || "
            f"lpad(cast(({unscaled}) % {10 ** scale} as varchar), {scale}, '0')")


def _duck_exchange(idx: str) -> str:
    names = ", ".join(f"'{x}'" for x in generators.EXCHANGES)
    return f"[{names}][{idx} + 1]"


def _gen_quotes_sql() -> str:
    a, b = "qa:", "qb:"
    inner = (f"select event_id as seq, {_duck_symbol(_duck_draw(a, 0) + ' % 400')} as sym, "
             f"{_duck_exchange(_duck_draw(a, 1) + ' % 9')} as ex, "
             f"{_duck_draw(a, 2)} / 4294967296.0::double * 100000.0::double as bid, "
             f"{_duck_time(a, b)} as time, '{generators.BASE_DAY}' as date from events")
    stamp = f"concat_ws('{generators.COMMENT_FIELD_SEPARATOR}', sym, ex, date || ' ' || time, date)"
    comments = ", ".join(f"'{generators.QUOTE_COMMENT_PREFIX.format(k=k)}' || {stamp} as comment{k}"
                         for k in range(1, generators.QUOTE_COMMENTS + 1))
    return f"select seq, sym, ex, bid, time, date, {comments} from ({inner}) q"


def _gen_trades_sql() -> str:
    a, b = "ta:", "tb:"
    price_u = f"{_duck_draw(a, 2)} % 100000000"
    size_u = f"{_duck_draw(b, 3)} % 10000000"
    inner = (f"select event_id as seq, {_duck_symbol(_duck_draw(a, 0) + ' % 400')} as sym, "
             f"{_duck_exchange(_duck_draw(a, 1) + ' % 9')} as ex, "
             f"{_duck_decimal_text(price_u)} as price, {_duck_time(a, b)} as time, "
             f"'{generators.BASE_DAY}' as date, ({size_u}) / 10000.0::double as size, "
             f"{_duck_decimal_text(size_u)} as size_text from events")
    stamp = f"concat_ws('{generators.COMMENT_FIELD_SEPARATOR}', sym, ex, price, date || ' ' || time, date, size_text)"
    comments = ", ".join(f"'{generators.TRADE_COMMENT_PREFIX.format(k=k)}' || {stamp} as comment{k}"
                         for k in range(1, generators.TRADE_COMMENTS + 1))
    return f"select seq, sym, ex, price, time, date, size, {comments} from ({inner}) t"


_JSON_REASON = (
    "case event_id % 10 when 1 then 'field of the wrong type: k' when 2 then 'not a JSON object' "
    "when 3 then 'unknown field: z' when 4 then 'not a JSON object' when 7 then 'repeated field' "
    "when 8 then 'field of the wrong type: ok' when 9 then 'field of the wrong type: at' end")
_JSON_MESSAGE = (
    "'{\"event_id\":' || event_id || ',' || ['\"k\":12', '\"k\":\"foo\"', '\"k\":7} trailing', '\"k\":1,\"z\":1', '\"k\":', "
    "'\"k\":12.0', '\"ok\":true', '\"k\":1,\"k\":2', '\"ok\":\"yes\"', '\"at\":{\"x\":\"foo\"}'][event_id % 10 + 1] || '}'")

def _load_ticks_sql() -> str:
    tick = f"(event_id * {TICK_ID_STEP})"
    day = f"{tick} // {generators.ROWS_PER_DAY_STEP} % {TICK_DAYS} = 1"
    quotes = (f"select event_id, {_duck_symbol(_duck_draw('qa:', 0, tick) + ' % 400')} as sym, "
              f"{_duck_draw('qa:', 2, tick)} / 4294967296.0::double * 100000.0::double as bid from events where {day}")
    listed = f"select {_duck_symbol('event_id')} as value from events where event_id < {generators.LISTED_SYMBOLS}"
    return f"select sym, round(arg_max(bid, event_id), 6) as last_bid from ({quotes}) q join ({listed}) s on sym = value group by sym"


# The last cell of every column, worked out by hand from the log's rules.
_COMPACT_CELLS = """
    select o_orderkey,
           case when o_orderkey % 27 = 0 then 5.5 when o_orderkey % 3 = 0 then 2.5 else o_totalprice end as o_totalprice,
           case when o_orderkey % 27 = 0 then null when o_orderkey % 3 = 0 then 'new' else o_orderstatus end as o_orderstatus,
           case when o_orderkey % 27 = 0 or o_orderkey % 15 = 0 then null else o_orderpriority end as o_orderpriority,
           case when o_orderkey % 27 = 0 then null else o_custkey end as o_custkey
    from orders where o_orderkey % 9 <> 0 or o_orderkey % 27 = 0
    union all
    select -o_orderkey, null, null, 'added', null from orders where o_orderkey % 6 = 0 and o_orderkey > 0
"""

_EVENTS_STAR = "select * from events"

ORACLE_SQL.update({
    "external_table": "select * from nation",
    "rename_reserved": "select n_nationkey as n_nationkey_, n_name, n_regionkey from nation",
    "varchar_violations": (
        "select count(*) filter (where length(c_name) > 17) as c_name_too_long, "
        "count(*) filter (where c_name is null) as c_name_null, "
        "count(*) filter (where length(c_mktsegment) > 30) as c_mktsegment_too_long, "
        "count(*) filter (where c_mktsegment is null) as c_mktsegment_null from customer"),
    "ctas": _EVENTS_STAR,
    "append": _EVENTS_STAR,
    "create_table": _EVENTS_STAR,
    "csv_import": _EVENTS_STAR,
    "bulk_copy": _EVENTS_STAR,
    "save_dir": _EVENTS_STAR,
    "sql_external_table": "select * from part",
    "cdc_flatten": "select ts, value, event_type, user_id, event_id from events",
    "gen_symbols": (f"select user_id, {_duck_symbol('user_id')} as value "
                    "from (select distinct user_id from events) u"),
    "gen_quotes": _gen_quotes_sql(),
    "gen_trades": _gen_trades_sql(),
    "json_ingest": ("select event_id, cast(props->>'$.k' as int) as k from events where json_type(props) = 'OBJECT' "
                    "and len(list_filter(json_keys(props), lambda x: x != 'k')) = 0 "
                    "and (props->>'$.k' is null or try_cast(props->>'$.k' as int) is not null)"),
    "json_rejects": (f"select event_id, {_JSON_MESSAGE} as value, {_JSON_REASON} as reject_reason "
                     f"from events where ({_JSON_REASON}) is not null"),
    "json_checked": ("select event_id, case when event_id % 10 in (0, 5) then 12 end as k, "
                     f"case when event_id % 10 = 6 then true end as ok from events where ({_JSON_REASON}) is null"),
    "stream_json_feed": (f"select coalesce({_JSON_REASON}, 'good') as reason, count(*) as n, "
                         "cast(sum(event_id) as bigint) as ids from events group by 1"),
    "external_table_partitioned": _EVENTS_STAR,
    "varchar_schema": "select * from customer",
    "allow_existing": "select * from nation",
    "csv_text": "select * from conversations",
    "csv_split": "select * from conversations",
    "delay_limit": ("select least(20, count(distinct p.p_name)) as n from lineitem l, part p "
                    "where l.l_partkey = p.p_partkey and l.l_returnflag like '%A%' and l.l_tax > 0"),
    "gen_days": (f"select cast(date '{generators.BASE_DAY}' + cast(event_id * {TICK_ID_STEP} // {generators.ROWS_PER_DAY_STEP} % {TICK_DAYS} as int) "
                 "as varchar) as date, count(*) as n from events group by 1"),
    "load_ticks": _load_ticks_sql(),
    "changelog_scan": ("select user_id % 4 as segment, event_id as position, event_type as table_name, ts, value, event_type, "
                       "user_id, event_id from events"),
    "cdc_compact_cells": _COMPACT_CELLS,
    "stream_cdc_sync": (
        "select 'copy' as kind, event_id, user_id, ts, value from events where event_type = 'click' union all "
        "select 'unknown ' || event_type, count(*), null, null, null from events "
        "where event_type not in ('click', 'view') group by event_type"),
    "cdc_sync": "select event_id, user_id, ts, value from events where event_type = 'click'",
    "cdc_positions": ("select user_id % 4 as segment, max(event_id) as position "
                      "from events group by user_id % 4"),
    "cdc_unknown_tables": ("select event_type as table_name, count(*) as n from events "
                           "where lower(event_type) not in ('click', 'view') "
                           "or event_type is null group by event_type"),
    "cdc_compact": ("select user_id, event_type, event_id, value from (select user_id, event_type, "
                    "event_id, value, row_number() over (partition by user_id, event_type "
                    "order by event_id desc) as rn from events) t where rn = 1"),
    "cdc_gaps": """
        with positions as (select distinct user_id % 4 as segment, event_id as position from events),
        started as (select segment, position from positions where position >= 0 union select distinct segment, -1 from positions),
        following as (select segment, position, lead(position) over (partition by segment order by position) as after from started),
        gaps as (select segment, position + 1 as gap_from, after - 1 as gap_to from following where after - position > 1),
        ends as (select segment, max(position) as last from started group by segment),
        sound as (select segment, min(gap_from) - 1 as upto from gaps group by segment)
        select e.segment, coalesce(s.upto, e.last) as gap_free_to, g.gap_from, g.gap_to
        from ends e left join sound s using (segment) left join gaps g using (segment)""",
    "live_rollups": """
        select 'quote' as kind, ts::date as day, user_id, null::varchar as part, max_by(value, event_id) as x, null::bigint as n, max(value) as top
        from events group by ts::date, user_id
        union all select 'price', ts::date, user_id, event_type, max_by(value, event_id), null, max(value) from events group by ts::date, user_id, event_type
        union all select 'size', ts::date, user_id, hour(ts)::varchar, sum(value::decimal(18,2))::double, count(value), null
        from events group by ts::date, user_id, hour(ts)""",
    "bulk_then_feed": _COMPACT_CELLS,
    "cdc_compact_files": _COMPACT_CELLS,
    "stream_fold": "select event_id, user_id, ts, value from events where event_type = 'click'",
})
