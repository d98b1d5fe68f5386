"""The registered queries in SQL, computed straight from the given tables."""

# `epoch_us(ts) // 1000` and not `epoch_ms(ts)`, which rounds
_EVENT_TRADES = """
    select 'trade' as message_type, props as condition, value as price, event_type as symbol,
           epoch_us(ts) // 1000 as timestamp,
           cast(cast(json_extract_string(props, '$.k') as bigint) as double) as volume,
           event_id, ts
    from events"""

_COLUMNS = "message_type, condition, price, symbol, timestamp, volume"

# one row per key, the one of the greatest event
_LATEST = f"""
    select * from ({_EVENT_TRADES})
    qualify row_number() over (partition by symbol, timestamp order by event_id desc) = 1"""

_MINUTE_TRADES = f"""
    select message_type, condition, price, symbol,
           timestamp - timestamp % 60000 as timestamp, volume, event_id, ts
    from ({_EVENT_TRADES})"""

_MINUTE_LATEST = f"""
    select * from ({_MINUTE_TRADES})
    qualify row_number() over (partition by symbol, timestamp order by {{order}}) = 1"""

_HOUR_TRADES = f"""
    select message_type, condition, price, symbol,
           timestamp - timestamp % 3600000 as timestamp, volume, event_id, ts
    from ({_EVENT_TRADES})"""

_HOUR_LATEST = f"""
    select * from ({_HOUR_TRADES})
    qualify row_number() over (partition by symbol, timestamp order by {{order}}) = 1"""

_WORD_TRADES = """
    select 'trade' as message_type, lang as condition, cast(length(word) as double) as price,
           word as symbol, doc_id as timestamp, cast(pos as double) as volume, pos
    from (select doc_id, lang, unnest(words) as word,
                 cast(unnest(generate_series(0, len(words) - 1)) as integer) as pos
          from (select doc_id, lang, string_split(text, ' ') as words from documents))"""

_NOT_EXPIRED = "ts + interval 2592000 second > timestamp '2024-02-10 12:00:00'"
_RANGE = "symbol = 'click' and timestamp between 1704844800000 and 1705708799999"

# the batch of the two-batch table, then the place in the batch: even events, then odd ones,
# whose offsets are negative
_TWO_BATCHES = "event_id % 2 desc, if(event_id % 2 = 1, -event_id, event_id) desc"
_STORED = f"""
    select {_COLUMNS} from ({_HOUR_LATEST.format(order=_TWO_BATCHES)}) where {_NOT_EXPIRED}"""

_PUBLISHED = f"""
    select 'd' as key, event_id, symbol, price, timestamp
    from ({_EVENT_TRADES}) where symbol = 'purchase'"""

ORACLES = {
    "utf8_strict": """
        select doc_id, cast(length(text) as integer) as n_chars, md5(text) as digest
        from documents where lang <> 'de'""",
    "publish_trades": _PUBLISHED,
    "stream_publish": _PUBLISHED,
    "subscribe_symbols": f"""
        select {_COLUMNS} from ({_EVENT_TRADES}) where symbol in ('click', 'view')""",
    "subscribe_symbol_table": f"""
        select {_COLUMNS} from ({_WORD_TRADES})
        where symbol in (select unnest(string_split(text, ' ')) from benchmark)""",
    "decode_trades": f"select {_COLUMNS} from ({_EVENT_TRADES})",
    "decode_nested": f"select {_COLUMNS}, pos from ({_WORD_TRADES})",
    "parse_props": """
        select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events""",
    "preview": f"select {_COLUMNS} from ({_EVENT_TRADES}) order by event_id limit 5",
    "dead_letters": """
        select event_id, case event_type when 'error' then 'not_decodable' else 'no_trades' end as reason
        from events where event_type in ('error', 'signup')""",
    "quarantine_keys": f"""
        select event_id, case symbol when 'view' then symbol when 'signup' then '' else 'none' end as symbol,
               case symbol when 'view' then 'none' else cast(timestamp as varchar) end as timestamp, price,
               case symbol when 'error' then 'missing_symbol' when 'signup' then 'empty_symbol'
                    else 'missing_timestamp' end as reason
        from ({_EVENT_TRADES}) where symbol in ('error', 'signup', 'view')""",
    "upsert_latest": f"""
        select {_COLUMNS} from ({_MINUTE_LATEST.format(order="event_id desc")})""",
    "upsert_nested": f"""
        select {_COLUMNS} from ({_WORD_TRADES})
        qualify row_number() over (partition by symbol, timestamp order by pos desc) = 1""",
    "ttl_live": f"select {_COLUMNS} from ({_EVENT_TRADES}) where {_NOT_EXPIRED}",
    "trades_by_symbol": f"select {_COLUMNS} from ({_LATEST}) where symbol = 'click'",
    "latest_for_symbol": f"""
        select {_COLUMNS},
               cast(row_number() over (order by timestamp desc) as integer) as rank
        from ({_LATEST}) where symbol = 'click' order by timestamp desc limit 10""",
    "symbol_time_range": f"select {_COLUMNS} from ({_LATEST}) where {_RANGE}",
    "timestamp_lookup": f"""
        select {_COLUMNS} from ({_LATEST})
        where timestamp = (select max(epoch_us(ts) // 1000) from events)""",
    "compact_expire": _STORED,
    "merge_on_read": _STORED,
    "dashboard_view": f"select * from ({_STORED}) where {_RANGE}",
    "dashboard_range": f"""
        select * from ({_STORED})
        where symbol in ('click', 'view') and timestamp between 1704844800000 and 1705708799999""",
    "table_reads": f"""
        with stored as ({_STORED})
        select 'symbol' as read, * from stored where symbol = 'click'
        union all
        (select 'newest', * from stored where symbol = 'error' order by timestamp desc limit 10)
        union all
        select 'range', * from stored
        where symbol = 'view' and timestamp between 1704844800000 and 1705708799999
        union all
        select 'timestamp', * from stored where timestamp = (select max(timestamp) from stored)""",
    "table_symbols": f"""
        select * from ({_STORED})
        where symbol in (
          select event_type from events group by event_type
          having count(*) > (select count(*) / count(distinct event_type) from events))""",
    "key_lookup": f"""
        select * from ({_STORED})
        where symbol = 'view' and timestamp = (
          select max(epoch_us(ts) // 3600000000 * 3600000) from events where event_type = 'view')""",
    "bucketed_upsert": f"""
        select {_COLUMNS} from ({_HOUR_LATEST.format(order="event_id % 2, event_id")}) where {_NOT_EXPIRED}""",
    "bucketed_newest": f"""
        select {_COLUMNS}, cast(row_number() over (partition by symbol order by timestamp desc) as integer) as rank
        from ({_HOUR_LATEST.format(order="event_id desc")}) where {_NOT_EXPIRED}
        qualify rank <= 3""",
    "stream_changes": f"""
        select event_id % 3 as load, {_COLUMNS} from ({_HOUR_TRADES})
        qualify row_number() over (partition by event_id % 3, symbol, timestamp order by event_id desc) = 1""",
    "offset_gaps": """
        select * from (
          select 0 as src_partition, lag(event_id) over (order by event_id) + 1 as first_missing,
                 event_id - 1 as last_missing, event_id - lag(event_id) over (order by event_id) - 1 as missing
          from events where event_type <> 'error')
        where missing > 0""",
    "backfill_slices": f"""
        select {_COLUMNS}, 2 as resumed, (select count(*) from events) as written
        from ({_HOUR_LATEST.format(order="event_id desc")})""",
    "table_rejects": """
        select event_id, case event_type when 'error' then 'missing_symbol' else 'empty_value' end as reason
        from events where event_type in ('error', 'signup')""",
    "stream_decode": f"select {_COLUMNS}, true as capped from ({_EVENT_TRADES})",
    "stream_upsert": f"""
        select {_COLUMNS}, (select count(*) from events) as delivered
        from ({_HOUR_LATEST.format(order="event_id % 3 desc, event_id desc")})""",
    "publish_rejects": """
        select event_id, if(event_type = 'error', 'not_utf8', 'not_an_object') as reason
        from events where event_type in ('error', 'signup', 'view')""",
    "publish_deliveries": """
        select 'topic' as target, 'delivered' as outcome, count(*) as records, 1 as batches
        from events where event_type = 'purchase'
        union all
        select 'topic', 'failed', 0, 1""",
    "delivery_metrics": """
        select 0 as src_partition,
               case event_type when 'error' then 'bad_key' when 'signup' then 'dead_letter'
                    else 'trade' end as kind,
               count(*) as rows, min(event_id) as first_offset, max(event_id) as last_offset
        from events group by all""",
}
