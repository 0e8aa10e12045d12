"""SQL twin of each registered query, over the same tables, for cross-checking.

The alert twins never touch JSON: they work on the amounts the documents were
made from, so they check the parsing path independently.
"""

from __future__ import annotations

_AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
_CUT = "TIMESTAMP '2024-01-15 00:00:00'"


def _address(key: str) -> str:
    return f"'0:' || lpad(cast({key} as varchar), greatest(6, cast(length(cast({key} as varchar)) as int)), '0')"


def _cents(amount: str) -> str:
    return f"cast(round({amount} * 100) as bigint)"


def _units(nano: str) -> str:
    """A non-negative amount as text with nine decimals."""
    return f"(cast(({nano}) // 1000000000 as varchar) || '.' || lpad(cast(({nano}) % 1000000000 as varchar), 9, '0'))"


_ASSET_CHAIN = "case when o_orderpriority = '5-LOW' then 'ever' else 'ton' end"
_ASSET_PROVIDER = "case when o_orderpriority = '5-LOW' then 'everapi' else 'tonapi' end"
_HERE = "chain = 'ton' and provider = 'tonapi'"


def _short(text: str) -> str:
    return f"case when length({text}) > 10 then left({text}, 10) || '...' else {text} end"


def _id(tx_hash: str) -> str:
    return f"substr(sha256(chain || ':' || address || ':' || lt || ':' || {tx_hash}), 1, 16)"


def _plus(ts: str, seconds: str) -> str:
    return f"({ts} + to_microseconds(cast(({seconds}) * 1000000 as bigint)))"


# name -> (views it needs, body)
_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "chain_tx": ((), f"""
        select event_id as lt, case when event_id % 5 = 0 then 'ever' else 'ton' end as chain,
               case when event_id % 5 = 0 then 'everapi' else 'tonapi' end as provider,
               {_address('user_id')} as address,
               substr(sha256(cast(event_id as varchar)), 1, 16) as tx_hash,
               cast(ts as timestamp) as block_time, event_type,
               {_cents('value')} * 10000000 as value_nano, value
        from events"""),
    "chain_events": (("chain_tx",), f"""
        select *, substr(sha256(event_id), 1, 32) as correlation_id
        from (select {_id('tx_hash')} as event_id, * from chain_tx)"""),
    "raw_docs": (("chain_events",), """
        select *, case event_type
            when 'purchase' then '{"in_msg":{"source":"0:SRC' || lpad(cast(lt % 97 as varchar), 8, '0')
                || '","destination":"' || address || '","value":"' || value_nano || '"}}'
            when 'click' then '{"out_msgs":[{"destination":{"workchain_id":0,"address":"EQ'
                || lpad(cast(lt % 97 as varchar), 10, '0') || '"},"value":' || value_nano
                || '},{"value":"' || (value_nano // 2) || '"}]}'
            when 'view' then '{"transactions":[{"in_msg":{"value":"' || value_nano
                || '"}},{"out_msgs":[{"value":"' || value_nano || '"}]}]}'
            when 'signup' then '{"test": true}' else '{ invalid json }' end as raw_json
        from chain_events"""),
    "arrivals": (("chain_tx",), f"""
        select {_id('tx_hash')} as event_id, *, block_time as arrived_at from (
            select chain, provider, address, lt, tx_hash, block_time, event_type, value_nano,
                   4 * lt as arrival_seq from chain_tx
            union all
            select chain, provider, address, lt, 'x' || tx_hash, block_time, event_type, value_nano,
                   4 * lt + 1 from chain_tx where lt % 97 = 0
            union all
            select chain, provider, address, lt, tx_hash, block_time, event_type, value_nano,
                   4 * lt + 10000002 from chain_tx where lt % 10 = 0)"""),
    "first_arrivals": (("arrivals",), """
        select * from arrivals
        qualify row_number() over (partition by event_id order by arrival_seq) = 1"""),
    "monitored": ((), f"""
        select {_ASSET_CHAIN} as chain, {_address('o_custkey')} as address, {_ASSET_PROVIDER} as provider,
               o_orderpriority as asset_id,
               cast(sum({_cents('o_totalprice')}) as varchar) || '0000000' as balance,
               o_custkey % 10 <> 0 as is_active,
               cast(min(o_orderdate) as timestamp) as discovered_at,
               cast(max(o_orderdate) as timestamp) as updated_at
        from orders group by o_custkey, o_orderpriority"""),
    "checkpoints": (("chain_tx",), """
        select chain, address, provider, max(lt) as last_lt, arg_max(tx_hash, lt) as last_hash,
               max(block_time) as updated_at
        from chain_tx group by chain, address, provider"""),
    "old_checkpoints": (("chain_tx",), f"""
        select chain, address, provider, max(lt) as last_lt, arg_max(tx_hash, lt) as last_hash,
               max(block_time) as updated_at
        from chain_tx where block_time < {_CUT} group by chain, address, provider"""),
    "leases": ((), f"""
        select 'ton:tonapi:' || {_address('s_suppkey')} as lease_key, 'ingestor' as owner_id,
               {_plus(_AS_OF, _cents('s_acctbal') + ' * 0.01')} as expires_at
        from supplier"""),
    "transfers": (("chain_events",), """
        select event_id, lt, 0 as message_no, 'IN' as direction, value_nano as nano,
               case event_type when 'purchase' then '0:SRC' || lpad(cast(lt % 97 as varchar), 8, '0')
                    else 'unknown' end as other
        from chain_events where event_type in ('purchase', 'view')
        union all
        select event_id, lt, 1, 'OUT', value_nano,
               case event_type when 'click' then '0:EQ' || lpad(cast(lt % 97 as varchar), 10, '0')
                    else 'unknown' end
        from chain_events where event_type in ('click', 'view')
        union all
        select event_id, lt, 2, 'OUT', value_nano // 2, 'unknown'
        from chain_events where event_type = 'click'"""),
    "alerts": (("chain_events", "transfers"), f"""
        select e.event_id, e.chain, e.address, e.provider, e.correlation_id, e.block_time,
               row_number() over (partition by e.event_id order by t.message_no) - 1 as position,
               'TON' as asset_id, e.address as wallet, {_units('t.nano')} as amount,
               t.direction,
               case t.direction when 'IN' then 'Received from ' else 'Sent to ' end
                   || {_short('t.other')} as message
        from chain_events e join transfers t on e.event_id = t.event_id
        where t.nano >= 100000000000"""),
    "decisions": (("chain_events", "alerts"), f"""
        select {_AS_OF} as decided_at, 'whale_decision' as category,
               case when a.event_id is not null then 'sent' when e.event_type = 'error' then 'failed'
                    else 'suppressed' end as outcome,
               case when a.event_id is not null then null when e.event_type = 'error'
                    then 'raw_json_parse_error' else 'no_qualifying_transfer' end as reason_code,
               case when a.event_id is not null then 'console' else 'none' end as channel,
               e.event_id, e.correlation_id, e.chain, e.address, e.provider,
               coalesce(a.position, 0) as position, a.asset_id, a.direction, a.amount, a.message
        from chain_events e left join alerts a on e.event_id = a.event_id"""),
    "numbered": (("chain_tx",), """
        select *, (row_number() over (partition by chain, address, provider order by lt) - 1) // 20 as page_no,
               cast(floor(epoch_us(block_time) / 1000000) as bigint) as utime
        from chain_tx"""),
    "page_bodies": (("numbered",), """
        select chain, address, provider, page_no,
               '{"transactions":[' || string_agg('{"lt":' || lt || ',"hash":"' || tx_hash || '","utime":'
                   || utime || ',"in_msg":{"value":"' || value_nano || '"}}', ',' order by lt) || ']}' as body
        from numbered group by chain, address, provider, page_no"""),
    "native": ((), f"""
        select 'TON' as asset_id, 'native' as asset_type, {_address('c_custkey')} as address,
               case c_mktsegment when 'BUILDING' then '0'
                    when 'FURNITURE' then cast(abs({_cents('c_acctbal')}) * 10000000 as varchar)
                    else cast({_cents('c_acctbal')} * 10000000 as varchar) end as balance
        from customer"""),
    "jetton": ((), f"""
        select case c_mktsegment when 'AUTOMOBILE' then 'AUTO' when 'BUILDING' then 'BLDG'
                    else 'FURN' end as asset_id, 'jetton' as asset_type, {_address('c_custkey')} as address,
               cast(abs({_cents('c_acctbal')}) as varchar) || repeat('0', 27) as balance,
               abs({_cents('c_acctbal')}) as size
        from customer
        where c_mktsegment in ('AUTOMOBILE', 'BUILDING', 'FURNITURE') and c_nationkey <> 0
              and {_cents('c_acctbal')} <> 0"""),
    "top_jetton": (("jetton",), """
        select asset_id, asset_type, address, balance from jetton
        qualify row_number() over (partition by asset_id order by size desc, address) <= 100"""),
    "top_holders": (("native", "top_jetton"), """
        select *, row_number() over (partition by asset_id order by cast(balance as hugeint) desc, address) as rank
        from (select * from native union all select * from top_jetton) qualify rank <= 100"""),
    "damaged": (("raw_docs",), """
        select *, case when event_type = 'signup' then 'null' when event_type = 'error' then 'cut'
                       when event_type = 'purchase' and lt % 11 = 0 then 'missing'
                       when event_type = 'click' and lt % 13 = 0 then 'tail'
                       when event_type = 'view' and lt % 17 = 0 then 'listed' end as damage
        from raw_docs"""),
    "attempts": (("damaged",), """
        select 'events.' || event_type as queue, event_id as message_id, event_type = 'signup' as undecodable,
               case event_type when 'signup' then 1 else lt % 4 + 1 end as n
        from damaged where damage is not null"""),
    "letters": (("attempts",), """
        select queue, message_id, n as attempts,
               case when undecodable or n >= 3 then 'dead' else 'retry' end as disposition,
               case when undecodable then 'undecodable' when n >= 3 then 'max_retries' end as reason,
               cast(case when undecodable or n >= 3 then null when n = 1 then 1 when n = 2 then 5
                    else 30 end as bigint) as delay_seconds
        from attempts"""),
    "cycle": (("monitored", "chain_tx"), f"""
        select m.address, case when f.address is null then coalesce(e.n, 0) else 0 end as events_published,
               case when f.address is not null then 'provider unavailable' end as error
        from (select distinct address from monitored where is_active and {_HERE}) m
        left join (select address, count(*) as n from chain_tx where {_HERE} group by address) e on m.address = e.address
        left join (select {_address('c_custkey')} as address from customer where c_acctbal < 0 and c_custkey % 3 <> 0) f
             on m.address = f.address"""),
    "lags": (("checkpoints",), f"""
        select chain, address, max(updated_at) as updated_at,
               (epoch_us({_AS_OF}) - epoch_us(max(updated_at))) / 1e6 as lag_seconds
        from checkpoints group by chain, address"""),
    "samples": (("chain_tx",), """
        select case event_type when 'error' then 'dlq_messages' when 'click' then 'circuit_breaker_state'
                    when 'signup' then 'discovery_last_success_timestamp_seconds'
                    when 'view' then 'event_lag_seconds' else 'event_lag_stale_wallets' end as metric,
               case event_type when 'error' then 'queue=events.dead'
                    when 'view' then 'address=' || address || ',chain=' || chain
                    when 'purchase' then 'chain=' || chain else '' end as series,
               block_time as ts,
               cast(case event_type when 'error' then cast(floor(value) as bigint) % 4
                    when 'click' then cast(floor(value) as bigint) % 3
                    when 'signup' then cast(floor(epoch_us(block_time) / 1000000) as bigint)
                                       - cast(floor(value * 100) as bigint)
                    when 'view' then cast(floor(value * 30) as bigint)
                    else cast(floor(value) as bigint) % 7 end as double) as value,
               lt as sample_id
        from chain_tx"""),
    "last_samples": (("samples",), """
        select metric, series, arg_max(value, sample_id) as value from samples group by metric, series"""),
    "fold": (("first_arrivals",), """
        select *, case when before is null or lt > before.lt then 'advance'
                       when lt = before.lt and tx_hash <> before.hash then 'conflict' else 'ignore' end as outcome
        from (select *, max({'lt': lt, 'seq': -arrival_seq, 'hash': tx_hash}) over (
                  partition by chain, address, provider order by arrival_seq
                  rows between unbounded preceding and 1 preceding) as before
              from first_arrivals)"""),
    "handled": (("first_arrivals", "old_checkpoints"), f"""
        select *, case when before is null or lt > before.lt then 'advance'
                       when lt = before.lt and tx_hash <> before.hash then 'conflict' else 'ignore' end as outcome
        from (select *, max({{'lt': lt, 'seq': -arrival_seq, 'hash': tx_hash}}) over (
                  partition by chain, address, provider order by arrival_seq
                  rows between unbounded preceding and 1 preceding) as before
              from (select event_id, chain, address, provider, lt, tx_hash, arrival_seq, event_type, value_nano
                    from first_arrivals
                    where event_id not in (select {_id('tx_hash')} from chain_tx where block_time < {_CUT})
                    union all
                    select null, chain, address, provider, last_lt, last_hash, -1, null, null
                    from old_checkpoints))
        where event_id is not null"""),
    "minutes": (("chain_tx",), """
        select chain as series, date_trunc('minute', block_time) as minute, count(*) as n
        from chain_tx group by all"""),
    "stalls": (("chain_tx",), f"""
        select 'ingestion_stalled' as alert, 'warning' as severity, 'chain=' || chain as series,
               {_plus('block_time', '660')} as starts_at, next_at as ends_at
        from (select chain, block_time, coalesce(lead(block_time) over (
                  partition by chain order by block_time), {_AS_OF}) as next_at from chain_tx)
        where next_at > {_plus('block_time', '660')}"""),
    "lag_high": (("fold",), f"""
        select 'event_lag_high' as alert, 'warning' as severity,
               'address=' || address || ',chain=' || chain as series,
               {_plus('arrived_at', '1860')} as starts_at, next_at as ends_at
        from (select chain, address, arrived_at, coalesce(lead(arrived_at) over (
                  partition by chain, address order by arrived_at), {_AS_OF}) as next_at
              from fold where outcome = 'advance')
        where next_at > {_plus('arrived_at', '1860')}"""),
}


def _held(metric: str, condition: str, hold: int) -> str:
    """Stretches of consecutive samples that meet a condition for the hold time."""
    return f"""
        select series, min(ts) as active_at, {_plus('min(ts)', str(hold))} as starts_at,
               max(ts) as ends_at, count(*) as samples
        from (select *, sum(case when met then 0 else 1 end) over (
                  partition by series order by ts, sample_id) as island
              from (select *, {condition} as met from samples where metric = '{metric}'))
        where met group by series, island
        having epoch_us(max(ts)) - epoch_us(min(ts)) >= {hold} * 1000000"""


def _rule(alert: str, severity: str, metric: str, condition: str, hold: int) -> str:
    return f"""
        select '{alert}' as alert, '{severity}' as severity, series, starts_at, ends_at
        from ({_held(metric, condition, hold)})"""


_VIEWS["dlq_rule"] = (("samples",), _rule("dlq_message", "critical", "dlq_messages", "value > 0", 0))
_VIEWS["breaker_rule"] = (("samples",), _rule(
    "circuit_breaker_open", "critical", "circuit_breaker_state", "value = 2", 0))
_VIEWS["discovery_rule"] = (("samples",), _rule(
    "discovery_failed", "warning", "discovery_last_success_timestamp_seconds",
    "epoch_us(ts) / 1e6 - value > 7200", 300))
_VIEWS["firing"] = (("dlq_rule", "breaker_rule", "discovery_rule", "stalls", "lag_high"), """
        select * from dlq_rule union all select * from breaker_rule union all select * from discovery_rule
        union all select * from stalls union all select * from lag_high""")
_VIEWS["islands"] = (("firing",), """
        select alert, severity, min(starts_at) as starts_at, max(ends_at) as ends_at
        from (select *, sum(case when covered is null or starts_at > covered then 1 else 0 end) over (
                  partition by alert, severity order by starts_at, ends_at, series
                  rows unbounded preceding) as island
              from (select *, max(ends_at) over (
                        partition by alert, severity order by starts_at, ends_at, series
                        rows between unbounded preceding and 1 preceding) as covered
                    from firing))
        group by alert, severity, island""")


def _rate(minutes: str) -> str:
    return f"""
        select m.series, m.minute + to_minutes(cast(o.offset_no as int)) as window_end, {{total}} as increase,
               sum(m.n) / 300.0::double as rate
        from (with counted as (select k.series, c.minute, c.n from {minutes} c
                  cross join lateral (select unnest([c.series, '*']) as series) k)
              select * from counted
              union all
              select series, unnest(generate_series(min(minute), max(minute), interval 1 minute)), 0
              from counted group by series) m
        cross join (select unnest([1, 2, 3, 4, 5]) as offset_no) o
        group by m.series, window_end"""


def _twin(body: str, *needed: str) -> str:
    """``body`` behind the WITH list of the views it needs, dependencies first."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in _VIEWS[name][0]:
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in needed:
        add(name)
    ctes = ",\n".join(f"{name} as ({_VIEWS[name][1]})" for name in ordered)
    return f"with {ctes}\n{body}" if ctes else body


_TX = "chain, provider, address, lt, tx_hash"
_WALLETS = "select distinct address"
_SUMS = "select metric, sum(value) as value from last_samples group by metric"

TWINS: dict[str, str] = {
    # sources
    "src_tx_pages": _twin(f"select {_TX}, utime from numbered", "numbered"),
    "src_native_holders": _twin("select * from native", "native"),
    "src_jetton_holders": _twin("select * from top_jetton", "top_jetton"),
    "src_event_messages": _twin(
        f"""select correlation_id, event_id, {_TX}, block_time as occurred_at, raw_json
            from damaged where damage is null""", "damaged"),
    "bad_pages": _twin(
        """select chain, address, provider, count(distinct page_no) * 6 as bad, count(distinct page_no) * 5 as with_text
           from numbered group by chain, address, provider""", "numbered"),
    "src_tables": _twin(
        """select event_id as key, chain, address, 'events' as table_name from chain_events
           union all select chain || ':' || address || ':' || provider, chain, address, 'checkpoints'
           from checkpoints
           union all select chain || ':' || address || ':' || provider || ':' || asset_id, chain, address,
                            'monitored_addresses' from monitored
           union all select lease_key, 'ton', substr(lease_key, 12), 'address_leases' from leases""",
        "chain_events", "checkpoints", "monitored", "leases"),
    "src_metric_samples": _twin("select metric, series, ts, value from samples", "samples"),
    # sinks
    "snk_events": _twin(
        """select f.event_id, f.chain, f.address, f.lt, f.tx_hash, f.block_time, d.raw_json,
                  f.block_time as created_at
           from first_arrivals f join raw_docs d on f.lt = d.lt""", "first_arrivals", "raw_docs"),
    "snk_state_tables": _twin("select * from checkpoints", "checkpoints"),
    "snk_alert_lines": _twin(
        f"""select event_id, position, '🐋 WHALE ALERT: ' || asset_id || ' - ' || {_short('wallet')} || ' '
                || direction || ' ' || rtrim(rtrim(amount, '0'), '.') || ' | ' || message
                || '. CorrelationId: ' || correlation_id as line from alerts""", "alerts"),
    "snk_decision_log": _twin(
        """select event_id, position, '{"timestamp":"2024-01-31T00:00:00.0000000+00:00","category":"'
               || category || '","outcome":"' || outcome || '"'
               || coalesce(',"reasonCode":"' || reason_code || '"', '') || ',"channel":"' || channel
               || '","eventId":"' || event_id || '","correlationId":"' || correlation_id
               || '","chain":"' || chain || '","address":"' || address || '","provider":"' || provider || '"'
               || coalesce(',"assetId":"' || asset_id || '","direction":"' || direction || '","amount":'
                   || rtrim(rtrim(amount, '0'), '.') || ',"message":"' || message || '"', '')
               || '}' as line
           from decisions""", "decisions"),
    "snk_metric_samples": _twin(
        f"""select metric, series, {_AS_OF} as ts, cast(value as double) as value from (
            select 'events_ingested_total' as metric, 'chain=ton' as series, sum(events_published) as value
            from cycle having sum(events_published) > 0
            union all select 'alerts_fired_total', 'asset=' || asset_id || ',direction=' || direction, count(*)
            from alerts group by asset_id, direction
            union all select 'event_lag_seconds', 'address=' || address || ',chain=' || chain, lag_seconds
            from lags
            union all select 'event_lag_stale_wallets', 'chain=' || chain,
                             count(*) filter (where lag_seconds > 900) from lags group by chain
            union all select 'dlq_messages', 'queue=' || queue, count(*) filter (where disposition = 'dead')
            from letters group by queue
            union all select 'monitored_addresses', '', count(distinct address) from monitored where is_active
            and {_HERE}
            union all select 'circuit_breaker_state', '', arg_max(value, {{'ts': ts, 'id': sample_id}}) from samples
            where metric = 'circuit_breaker_state'
            union all select 'discovery_last_success_timestamp_seconds', '', floor(epoch_us(max(updated_at)) / 1000000)
            from monitored)""",
        "cycle", "alerts", "lags", "letters", "samples", "monitored"),
    "snk_event_messages": _twin(
        f"""select {_id('tx_hash')} as event_id, n.chain, n.provider, n.address, lt,
                   make_timestamp(utime * 1000000) as occurred_at, body as raw_json,
                   cast(32 as bigint) as correlation_width
            from numbered n join page_bodies b on n.chain = b.chain and n.address = b.address and n.page_no = b.page_no""".replace(
                "chain || ':' || address", "n.chain || ':' || n.address"), "page_bodies"),
    # projections and filters
    "normalize_events": _twin(
        f"""select event_id, n.chain, n.provider, n.address, lt, tx_hash, make_timestamp(utime * 1000000)
                   as occurred_at, body as raw_json
            from (select {_id('tx_hash')} as event_id, * from numbered) n
            join page_bodies b on n.chain = b.chain and n.address = b.address and n.page_no = b.page_no""", "page_bodies"),
    "events_to_rows": _twin(
        f"""select {_id('tx_hash')} as event_id, chain, address, lt, tx_hash,
                   make_timestamp(utime * 1000000) as block_time from numbered""", "numbered"),
    "decisions": _twin("select * from decisions", "decisions"),
    "active_addresses": _twin(
        f"{_WALLETS} from monitored where chain = 'ton' and provider = 'tonapi' and is_active", "monitored"),
    "large_transfers": _twin(
        "select lt, chain, address, " + _units('value_nano') + """ as amount from chain_tx
           where value_nano >= 100000000000""", "chain_tx"),
    "after_cursor": _twin(
        """select t.chain, t.address, t.provider, t.lt, t.tx_hash, t.block_time from chain_tx t
           left join old_checkpoints c on t.chain = c.chain and t.address = c.address and t.provider = c.provider
           where c.last_lt is null or t.lt > c.last_lt""", "old_checkpoints"),
    "active_leases": _twin(
        f"""select lease_key, owner_id, expires_at from leases where expires_at > {_AS_OF}
            order by expires_at desc, lease_key limit 5""", "leases"),
    "failed_addresses": _twin("select address, error from cycle where error is not null", "cycle"),
    "failed_address_lines": _twin(
        """select line_no, count(*) as failed, string_agg(address, ', ' order by address) as addresses
           from (select address, cast('0x' || substr(sha256(address), 1, 8) as bigint)
                     % cast(greatest(1, ceil(count(*) over () / 100)) as bigint) as line_no
                 from cycle where error is not null)
           group by line_no""", "cycle"),
    "stale_checkpoints": _twin("select * from lags where lag_seconds > 900", "lags"),
    "checkpoint_lookup": _twin(
        "select * from checkpoints where chain = 'ton' and address = '0:000007' and provider = 'tonapi'",
        "checkpoints"),
    # joins
    "unprocessed_addresses": _twin(
        """select distinct m.address, m.asset_id, left(m.balance, 20) as balance
           from monitored m anti join chain_tx t on m.address = t.address where m.is_active
           order by 1, 2, 3 limit 10""", "monitored", "chain_tx"),
    "unprocessed_wallets": _twin(
        """select distinct address, asset_id, balance from monitored
           where is_active and address not in (select address from chain_tx)""", "monitored", "chain_tx"),
    "new_events": _twin(
        f"""select event_id, chain, address, provider, lt, tx_hash, arrival_seq, block_time from first_arrivals
            where event_id not in (select event_id from chain_events where block_time < {_CUT})""",
        "first_arrivals", "chain_events"),
    "fetch_after_checkpoint": _twin(
        """select t.chain, t.address, t.provider, t.lt, t.tx_hash, t.block_time from chain_tx t
           left join old_checkpoints c on t.chain = c.chain and t.address = c.address and t.provider = c.provider
           where c.last_lt is null or t.lt > c.last_lt
           qualify row_number() over (partition by t.chain, t.address, t.provider order by t.lt) <= 100""",
        "old_checkpoints"),
    "upsert_monitored": _twin(
        f"""select chain, address, provider, asset_id,
                   case when b.balance is not null then b.balance else m.balance end as balance,
                   b.balance is not null or m.is_active as is_active,
                   coalesce(m.discovered_at, {_AS_OF}) as discovered_at,
                   case when b.balance is not null then {_AS_OF} else m.updated_at end as updated_at
            from monitored m full join (
                select chain, address, provider, asset_id, arg_max(balance, seq) as balance from (
                    select 'ton' as chain, address, 'tonapi' as provider, asset_id, balance, 0 as seq
                    from top_holders
                    union all
                    select {_ASSET_CHAIN}, {_address('o_custkey')}, {_ASSET_PROVIDER}, o_orderpriority,
                           cast({_cents('o_totalprice')} as varchar) || '0000000', o_orderkey
                    from orders)
                group by chain, address, provider, asset_id) b
            using (chain, address, provider, asset_id)""", "monitored", "top_holders"),
    "deactivate_addresses": _twin(
        f"""select m.chain, m.address, m.provider, m.asset_id, m.balance,
                   m.is_active and k.address is null as is_active, m.discovered_at,
                   case when k.address is null then m.updated_at else {_AS_OF} end as updated_at
            from monitored m left join (
                select {_address('c_custkey')} as address from customer where c_acctbal < 0) k
            on m.address = k.address and m.asset_id = '5-LOW'""", "monitored"),
    "ingest_active_only": _twin(
        """select chain, address, provider, lt, tx_hash, block_time from chain_tx
           where (chain, address, provider) in (select (chain, address, provider) from monitored where is_active)""",
        "chain_tx", "monitored"),
    "ingest_cycle": _twin(
        """select t.chain, t.address, t.provider, t.lt, t.tx_hash, t.block_time from chain_tx t
           left join old_checkpoints c on t.chain = c.chain and t.address = c.address and t.provider = c.provider
           where (c.last_lt is null or t.lt > c.last_lt)
                 and (t.chain, t.address, t.provider) in (
                     select (chain, address, provider) from monitored where is_active)
           qualify row_number() over (partition by t.chain, t.address, t.provider order by t.lt) <= 100""",
        "old_checkpoints", "monitored"),
    # aggregations
    "addresses_per_asset": _twin(
        """select asset_id, count(*) as total_addresses, count(distinct address) as unique_addresses
           from monitored where is_active group by asset_id""", "monitored"),
    "multi_asset_wallets": _twin(
        """select address, cast(len(list_distinct(held)) as bigint) as asset_count,
                  array_to_string(held, ', ') as assets
           from (select address, list(asset_id order by asset_id) as held
                 from monitored where is_active group by address)
           where len(list_distinct(held)) > 1 order by asset_count desc, address limit 10""", "monitored"),
    "events_summary": _twin(
        """select count(*) as total_events, count(distinct address) as addresses_with_events,
                  count(distinct event_id) as unique_event_ids, min(block_time) as first_event,
                  max(block_time) as last_event from chain_events""", "chain_events"),
    "events_per_address_top10": _twin(
        """select address, count(*) as event_count from chain_tx group by address
           order by event_count desc, address limit 10""", "chain_tx"),
    "checkpoint_progress": _twin(
        """select count(*) as total_checkpoints, count(distinct (chain, address, provider)) as unique_addresses
           from checkpoints""", "checkpoints"),
    "checkpoint_coverage": _twin(
        """select h.n as total_addresses, c.n as checkpointed_addresses, h.n - c.n as not_checkpointed
           from (select count(distinct address) as n from monitored where is_active) h,
                (select count(*) as n from checkpoints) c""", "monitored", "checkpoints"),
    "duplicate_event_ids": _twin(
        """select event_id, count(*) as duplicates from arrivals group by event_id having count(*) > 1
           order by event_id limit 10""", "arrivals"),
    "system_summary": _twin(
        """select unnest(['Monitored Addresses', 'Unique Wallets', 'Assets Tracked', 'Total Events',
                          'Addresses Checkpointed']) as metric,
                  cast(unnest([h.n, h.wallets, h.assets, e.n, c.n]) as varchar) as value
           from (select count(*) as n, count(distinct address) as wallets, count(distinct asset_id) as assets
                 from monitored where is_active) h,
                (select count(*) as n from chain_tx) e, (select count(*) as n from checkpoints) c""",
        "monitored", "checkpoints"),
    "discovery_freshness": _twin(
        """select asset_id, min(discovered_at) as oldest_discovery, max(discovered_at) as newest_discovery
           from monitored where is_active group by asset_id""", "monitored"),
    "discovery_limit_check": _twin(
        """select chain, asset_id, n as count, if(n > 100, '⚠️ Over limit (query shows top 100 anyway)',
                  '✓ OK') as status
           from (select chain, asset_id, count(*) as n from monitored where is_active group by all)""",
        "monitored"),
    "checkpoint_timestamps": _twin("select chain, address, updated_at from lags", "lags"),
    "active_wallet_count": _twin(
        f"select count(distinct address) as active_wallets from monitored where is_active and {_HERE}", "monitored"),
    "ingest_result": _twin(
        """select count(*) as addresses_processed,
                  cast(sum(events_published) as bigint) as total_events_published,
                  count(error) as addresses_failed from cycle""", "cycle"),
    "address_results": _twin("select * from cycle", "cycle"),
    "events_ingested_total": _twin(
        """select 'ton' as chain, cast(sum(events_published) as bigint) as events from cycle
           having sum(events_published) > 0""", "cycle"),
    "alerts_fired_total": _twin(
        "select asset_id, direction, count(*) as alerts from alerts group by asset_id, direction", "alerts"),
    "stale_wallets_by_chain": _twin(
        "select chain, count(*) filter (where lag_seconds > 900) as stale_wallets from lags group by chain",
        "lags"),
    "dlq_depth": _twin(
        """select queue, count(*) filter (where disposition = 'dead') as dead_messages
           from letters group by queue""", "letters"),
    "discovery_stats": _twin(
        """select asset_id, max(asset_type) as asset_type, true as ok, count(*) as holders
           from top_holders group by asset_id
           union all select 'HOUS', 'jetton', false, 0""", "top_holders"),
    "discovery_summary": _twin(
        """select count(distinct asset_id) as succeeded, cast(1 as bigint) as failed, count(*) as total_holders
           from top_holders""", "top_holders"),
    # windows, sorts, sets
    "first_arrival": _twin(
        "select event_id, chain, address, provider, lt, tx_hash, arrival_seq from first_arrivals",
        "first_arrivals"),
    "top_balances_per_asset": _twin(
        """select chain, asset_id, left(address, 42) as wallet, left(balance, 22) as balance,
                  row_number() over (partition by chain, asset_id
                      order by cast(balance as hugeint) desc, address) as rank
           from monitored where is_active qualify rank <= 5""", "monitored"),
    "checkpoint_fold": _twin(
        """select chain, address, provider, event_id, lt, tx_hash, arrival_seq, outcome from fold""", "fold"),
    "checkpoint_conflicts": _twin(
        """select chain, address, provider, event_id, lt, tx_hash, arrival_seq, outcome from fold
           where outcome = 'conflict'""", "fold"),
    "final_checkpoints": _twin("select * from checkpoints", "checkpoints"),
    "limit_per_group": _twin(
        """select chain, address, provider, lt, tx_hash from chain_tx
           qualify row_number() over (partition by chain, address, provider order by lt) <= 100""", "chain_tx"),
    "hold_for": _twin(_held("event_lag_seconds", "value > 1800", 60), "samples"),
    "top_balances": _twin(
        """select address, balance from monitored
           order by cast(balance as hugeint) desc, address, asset_id limit 10""", "monitored"),
    "top_balances_text": _twin(
        "select address, balance from monitored order by balance desc, address, asset_id limit 10",
        "monitored"),
    "event_count": _twin("select count(*) as event_count from chain_tx", "chain_tx"),
    "latest_checkpoints": _twin(
        """select chain, left(address, 20) as address, last_lt, last_hash, updated_at from checkpoints
           order by updated_at desc, chain, address limit 10""", "checkpoints"),
    "all_asset_holders": _twin("select * from top_holders", "top_holders"),
    "distinct_addresses": _twin(f"{_WALLETS} from chain_tx", "chain_tx"),
    # column jobs
    "event_ids": _twin("select lt, event_id from chain_events", "chain_events"),
    "event_ids_short": _twin(
        "select lt, substr(sha256(chain || '::' || lt || ':' || tx_hash), 1, 16) as event_id from chain_tx",
        "chain_tx"),
    "cursor_text": _twin("select lt, lt || ':' || tx_hash as cursor from chain_tx", "chain_tx"),
    "cursor_audit": _twin(
        """select lt, case event_type when 'purchase' then lt || ':' || tx_hash
                          when 'click' then cast(lt as varchar) when 'view' then lt || ':'
                          when 'signup' then tx_hash || 'h:' || tx_hash
                          else lt || ':' || tx_hash || ':more' end as cursor,
                  event_type = 'purchase' as accepted,
                  case when event_type = 'purchase' then lt end as primary_part,
                  case when event_type = 'purchase' then tx_hash end as secondary_part
           from chain_tx""", "chain_tx"),
    "sanitize_json": _twin("select event_id, raw_json || '\\u0002' as clean from raw_docs", "raw_docs"),
    "block_times": _twin("select lt, date_trunc('second', block_time) as block_time from chain_tx", "chain_tx"),
    "parse_balances": f"""
        select c_custkey, case c_mktsegment when 'BUILDING' then '0' when 'MACHINERY' then '0'
                   when 'FURNITURE' then cast(abs({_cents('c_acctbal')}) as varchar)
                   when 'HOUSEHOLD' then case when {_cents('c_acctbal')} = 0 then '0'
                        else cast(abs({_cents('c_acctbal')}) as varchar) || repeat('0', 33) end
                   else cast({_cents('c_acctbal')} as varchar) end as balance
        from customer""",
    "correlation_ids": _twin(
        """select event_id, event_type = 'signup' as fresh,
                  case event_type when 'click' then 'header' when 'signup' then null
                       else correlation_id end as given_id,
                  cast(case event_type when 'click' then 6 else 32 end as bigint) as width
           from chain_events""", "chain_events"),
    "to_units": _twin(f"select lt, {_units('value_nano')} as amount from chain_tx", "chain_tx"),
    "message_addresses": _twin(
        """select event_id, cast(0 as bigint) as position, '0:SRC' || lpad(cast(lt % 97 as varchar), 8, '0') as source,
                  address as destination from chain_events where event_type = 'purchase'
           union all select event_id, 0, 'unknown', '0:EQ' || lpad(cast(lt % 97 as varchar), 10, '0')
           from chain_events where event_type = 'click'
           union all select event_id, 1, 'unknown', 'unknown' from chain_events where event_type = 'click'
           union all select event_id, unnest([0, 1]), 'unknown', 'unknown' from chain_events
           where event_type = 'view'""", "chain_events"),
    "short_address": f"""select c_custkey, {_short('c_name')} as name, {_short('c_mktsegment')} as segment
                         from customer""",
    "alert_text": _twin("select event_id, position, direction, message from alerts", "alerts"),
    "lease_keys": _twin(
        """select lease_key, 'ton' as chain, 'tonapi' as provider, substr(lease_key, 12) as address,
                  lease_key as rebuilt from leases""", "leases"),
    "json_shape": _twin(
        """select e.event_id, cast(v.variant_no as bigint) as variant_no,
                  case when v.variant_no = 3 then 'evaluation_error'
                       when e.event_type = 'error' or v.variant_no = 1 then 'raw_json_parse_error'
                       when v.variant_no = 2 then 'evaluation_error' else 'ok' end as status,
                  case when v.variant_no = 0 then coalesce(a.n, 0) else 0 end as alerts
           from chain_events e cross join (select unnest([0, 1, 2, 3]) as variant_no) v
           left join (select event_id, count(*) as n from alerts group by event_id) a
                on e.event_id = a.event_id""", "chain_events", "alerts"),
    # alerts, handling, streams
    "whale_alerts": _twin("select * exclude (block_time) from alerts", "alerts"),
    "page_alerts": _twin(
        f"""select {_id('tx_hash')} as event_id, n.chain, n.address, n.provider, n.lt, h.position, h.amount,
                   'IN' as direction, 'Received from unknown' as message
            from numbered n join (
                select chain as c, address as a, page_no, {_units('value_nano')} as amount,
                       row_number() over (partition by chain, address, page_no order by lt) - 1 as position
                from numbered where value_nano >= 100000000000) h
            on n.chain = h.c and n.address = h.a and n.page_no = h.page_no""", "numbered"),
    "page_alerts_own_tx": _twin(
        f"""select {_id('tx_hash')} as event_id, chain, address, provider, lt, cast(0 as bigint) as position,
                   {_units('value_nano')} as amount, 'IN' as direction,
                   'Received from unknown' as message
            from numbered where value_nano >= 100000000000""", "numbered"),
    "dead_letters": _twin("select * from letters", "letters"),
    # monitoring
    "event_lag": _twin("select * from lags", "lags"),
    "ingest_rate_5m": _twin(_rate("minutes").format(total="cast(sum(m.n) as bigint)"), "minutes"),
    "alert_rate_5m": _twin(
        _rate("""(select direction as series, date_trunc('minute', block_time) as minute, count(*) as n
                  from alerts group by all)""").format(total="cast(sum(m.n) as bigint)"), "alerts"),
    "max_lag": _twin("select max(lag_seconds) as max_lag_seconds from lags", "lags"),
    "max_lag_series": _twin(
        """select minute, max(value) as value from (
               select series, seen + to_minutes(cast(o as int)) as minute, arg_max(value, seen) as value
               from (select series, date_trunc('minute', ts) as seen, arg_max(value, {'ts': ts, 'id': sample_id}) as value
                     from samples where metric = 'event_lag_seconds' group by all)
               cross join (select unnest([0, 1, 2, 3, 4]) as o) group by 1, 2)
           group by minute""", "samples"),
    "gauge_sums": _twin(_SUMS, "last_samples"),
    "discovery_age": _twin(
        f"""select value as last_success, epoch_us({_AS_OF}) / 1e6 - value as age_seconds from last_samples
            where metric = 'discovery_last_success_timestamp_seconds'""", "last_samples"),
    "health_bands": _twin(
        f"""select v.metric, v.value, case when v.value >= b.red then 'red' when v.value >= b.yellow
                   then 'yellow' else 'green' end as band
            from (select * from ({_SUMS})
                  where metric in ('dlq_messages', 'circuit_breaker_state', 'event_lag_stale_wallets')
                  union all select 'event_lag_seconds', max(lag_seconds) from lags
                  union all select 'discovery_age_seconds', epoch_us({_AS_OF}) / 1e6 - value from last_samples
                  where metric = 'discovery_last_success_timestamp_seconds') v
            join (values ('dlq_messages', null, 1), ('circuit_breaker_state', 1, 2),
                         ('event_lag_seconds', 1800, 3600), ('discovery_age_seconds', 3600, 7200),
                         ('event_lag_stale_wallets', 1, 5)) b(metric, yellow, red) on v.metric = b.metric""",
        "last_samples", "lags"),
    "rule_dlq": _twin("select * from dlq_rule", "dlq_rule"),
    "rule_breaker_open": _twin("select * from breaker_rule", "breaker_rule"),
    "rule_ingestion_stalled": _twin("select * from stalls", "stalls"),
    "rule_lag_high": _twin("select * from lag_high", "lag_high"),
    "rule_discovery_failed": _twin("select * from discovery_rule", "discovery_rule"),
    "notification_schedule": _twin(
        """select alert, severity, severity as receiver, starts_at, unnest(generate_series(
               starts_at + to_seconds(10), ends_at,
               case severity when 'critical' then interval 1 hour else interval 4 hour end)) as sent_at
           from islands""", "islands"),
}

_HANDLED = """
    select h.event_id, h.chain, h.address, h.lt, h.outcome,
           case when h.outcome = 'conflict' then 'conflict' when h.event_type = 'error'
                then 'raw_json_parse_error' else 'ok' end as status,
           case when h.outcome = 'conflict' then 0 else coalesce(a.n, 0) end as alerts,
           case when h.outcome = 'conflict' then '0.000000000' else coalesce(a.total, '0.000000000') end
               as alerted_amount
    from {source} h left join (
        select lt, count(*) as n, {total} as total from transfers
        where nano >= 100000000000 group by lt) a on h.lt = a.lt"""
TWINS["handle_batch"] = _twin(_HANDLED.format(source="handled", total=_units("cast(sum(nano) as bigint)")), "handled", "transfers")
TWINS["handle_stream"] = _twin(_HANDLED.format(source="fold", total=_units("cast(sum(nano) as bigint)")), "fold", "transfers")
TWINS["handle_stream_compacted"] = TWINS["handle_stream"]
TWINS["handler_metrics"] = f"""
    with h as ({TWINS["handle_stream"]})
    select unnest(['events_stored', 'events_unidentified', 'checkpoints_advanced', 'checkpoint_conflicts', 'checkpoints_ignored',
                   'events_evaluated', 'events_failed', 'alerts_fired', 'decisions_logged']) as metric,
           cast(unnest([count(*), 0, count(*) filter (outcome = 'advance'), count(*) filter (outcome = 'conflict'),
                   count(*) filter (outcome = 'ignore'), count(*) filter (status <> 'conflict'),
                   count(*) filter (status = 'evaluation_error'), sum(alerts),
                   sum(case when status in ('conflict', 'evaluation_error') then 0 else greatest(alerts, 1) end)]) as bigint) as value
    from h"""
TWINS["dedupe_stream"] = TWINS["dedupe_stream_watermark"] = TWINS["first_arrival"]
TWINS["dedupe_stream_bounded"] = _twin(
    "select event_id, chain, address, provider, lt, tx_hash from first_arrivals", "first_arrivals")
TWINS["checkpoint_stream_keyed"] = TWINS["checkpoint_stream"] = TWINS["snk_state_tables"]
TWINS["checkpoint_stream_keyed_conflicts"] = TWINS["checkpoint_stream_conflicts"] = TWINS["checkpoint_conflicts"]
TWINS["event_sources"] = TWINS["src_landed_pages"] = TWINS["src_landed_pages_stream"] = TWINS["src_tx_pages"]
TWINS["src_landed_pages_after"] = _twin(
    f"""select {_TX}, utime from numbered where chain = 'ton' and address = '0:000007' and provider = 'tonapi' and lt > 300
        order by lt, tx_hash limit 100""", "numbered")
TWINS["holder_sources"] = TWINS["all_asset_holders"]
TWINS["events_ingested_stream"] = _twin("select chain, count(*) as total from chain_events group by chain", "chain_events")
TWINS["alerts_fired_stream"] = TWINS["alerts_fired_total"]
# Closed minutes end at or before the latest block time less ten minutes.
TWINS["ingest_rate_stream"] = _twin(
    """select * from (""" + _rate("(select * from minutes where minute + interval 1 minute <= (select date_trunc('minute', max(block_time) - interval 10 minute) from chain_events))").format(total="cast(sum(m.n) as bigint)")
    + """) where window_end <= (select date_trunc('minute', max(block_time) - interval 10 minute) from chain_events)""", "minutes", "chain_events")
TWINS["rule_ingestion_stalled_stream"] = TWINS["rule_ingestion_stalled"]
TWINS["fetch_colocated"] = TWINS["fetch_after_checkpoint"]
TWINS["events_summary_sketch"] = _twin(
    """select count(*) as total_events, min(block_time) as first_event, max(block_time) as last_event,
              true as addresses_within_bound, true as event_ids_within_bound from chain_events""", "chain_events")
TWINS["active_addresses_sketch"] = _twin(
    """select chain, count(distinct address) as addresses, count(*) as rows, true as within_bound
       from chain_events where block_time >= timestamp '2024-01-15 00:00:00' group by chain""", "chain_events")
TWINS["snk_monitored"] = TWINS["upsert_monitored"]
TWINS["failed_events"] = _twin(
    """select event_id, chain, address, provider, 'evaluation_error' as status from chain_events
       where lt % 3 = 0""", "chain_events")
# Counter samples: the first minute of the series has no predecessor and adds nothing.
TWINS["ingest_rate_counter_5m"] = _twin(
    _rate("""(select 'chain=' || series as series, minute, cast(case when minute = min(minute) over (partition by series)
                     then 0 else n end as double) as n from minutes)""").format(total="sum(m.n)"), "minutes")
TWINS["stored_alerts"], TWINS["stored_decisions"] = TWINS["whale_alerts"], TWINS["decisions"]
