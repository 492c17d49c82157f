"""The queries of the registry in SQL, for a second engine to check them."""

from __future__ import annotations

from tapespark.adapters import SYMBOLS

MESSAGES = """
select case event_type when 'purchase' then 'trade_report'
            when 'click' then 'quote_update' when 'view' then 'quote_update'
            else 'trading_status' end as type,
       ts as "timestamp",
       case when event_id % 19 <> 0 then 'SYM' || cast(user_id % 20 as varchar) end as symbol,
       case when event_id % 23 <> 0 then cast(floor(value * 100) as bigint) end as size,
       case when event_id % 17 <> 0 then value + 10 end as price,
       cast(event_id as varchar) as trade_id,
       cast(event_id % 500 + 1 as bigint) as bid_size, value + 10 as bid_price,
       cast(event_id % 300 + 1 as bigint) as ask_size,
       value + 10 + (event_id % 7) * 0.25::double as ask_price
from events"""

TRADES = f"""
select type, "timestamp", symbol, size as sale_size, price as sale_price, trade_id
from ({MESSAGES}) where type = 'trade_report'"""

BULK = """
select 'trade_report' as type, l_shipdate as "timestamp",
       'S' || cast(l_suppkey as varchar) as symbol,
       cast(l_quantity as bigint) as sale_size, l_extendedprice as sale_price,
       cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as trade_id
from lineitem"""

TOPS = f"""
select type, "timestamp", symbol,
       case when type = 'quote_update' then coalesce(bid_size, 0) else 0 end as bid_size,
       case when type = 'quote_update' then coalesce(bid_price, 0) else 0 end as bid_price,
       case when type = 'quote_update' then coalesce(ask_size, 0) else 0 end as ask_size,
       case when type = 'quote_update' then coalesce(ask_price, 0) else 0 end as ask_price,
       case when type = 'trade_report' then coalesce(size, 0) else 0 end as last_sale_size,
       case when type = 'trade_report' then coalesce(price, 0) else 0 end as last_sale_price
from ({MESSAGES}) where symbol is not null and "timestamp" is not null"""

STG_TOPS = f"""
select symbol, cast("timestamp" as timestamp) as ts, cast("timestamp" as date) as trade_date,
       cast(bid_price as double) as bid_price, cast(ask_price as double) as ask_price,
       cast(last_sale_price as double) as last_sale_price,
       cast(bid_size as bigint) as bid_size, cast(ask_size as bigint) as ask_size,
       cast(last_sale_size as bigint) as last_sale_size,
       case when last_sale_size > 0 then 1 else 0 end as is_trade
from ({TOPS})"""

STG_TRADES = """
select type, "timestamp", symbol, sale_size as last_sale_size,
       sale_price as last_sale_price, trade_id
from ({trades})"""


def metrics(trades: str, keys: str, weight: str = "sale_size") -> str:
    named = " and ".join(f"{key.strip()} is not null" for key in keys.split(","))
    return f"""
select {keys}, cast(coalesce(sum(sale_size), 0) as bigint) as total_volume,
       round(avg(sale_price), 6) as avg_price, count(trade_id) as trade_count,
       round(sum(sale_price * sale_size) / nullif(sum({weight}), 0), 6) as vwap
from (select *, cast("timestamp" as date) as "date" from ({trades}))
where {named} group by {keys}"""


DAILY = metrics(TRADES, '"date", symbol')


def pivot(value: str) -> str:
    cells = ", ".join(f"""min({value}) filter (where symbol = '{s}') as "{s}" """ for s in SYMBOLS)
    return f'select "date", {cells} from ({DAILY}) group by "date"'


PAYLOADS = """
select strftime(ts, '%Y%m%d') as date_str, case when event_id % 43 = 0
            then ' ' || chr(9) || body || ' ' else body end as value
from (select *, case when event_id % 29 = 0 then concat_ws(',', head, size, price)
            when event_id % 31 = 0 then concat_ws(',', head, size, price, cast(event_id as varchar), 'extra')
            else concat_ws(',', head, size, price, cast(event_id as varchar)) end as body
      from (select event_id, ts,
                   concat_ws(',', case when event_type = 'purchase' then 'trade_report' else 'quote_update' end,
                       case when event_id % 41 = 0 then 'noon' else strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') end,
                       'SYM' || cast(user_id % 20 as varchar)) as head,
                   case when event_id % 23 = 0 then '' when event_id % 37 = 0 then 'many'
                        else cast(cast(floor(value * 100) as bigint) as varchar) end as size,
                   case when event_id % 17 = 0 then '' when event_id % 47 = 0 then 'n/a'
                        else cast(value as varchar) end as price
            from events))"""

PARSED = f"""
select date_str, payload,
       parts[1] as type, try_cast(parts[2] as timestamp) as "timestamp",
       nullif(parts[3], '') as symbol, try_cast(parts[4] as bigint) as sale_size,
       try_cast(parts[5] as double) as sale_price, nullif(parts[6], '') as trade_id,
       case when len(parts) <> 6 then 'field count'
            when parts[2] <> '' and try_cast(parts[2] as timestamp) is null then 'bad timestamp'
            when parts[4] <> '' and try_cast(parts[4] as bigint) is null then 'bad sale_size'
            when parts[5] <> '' and try_cast(parts[5] as double) is null then 'bad sale_price'
       end as reason
from (select date_str, trim(value, ' ' || chr(9)) as payload,
             string_split(trim(value, ' ' || chr(9)), ',') as parts from ({PAYLOADS}))
where starts_with(payload, 'trade_report')"""

TRADE_COLUMNS = 'type, "timestamp", symbol, sale_size, sale_price, trade_id'

FEED_DAY = "cast(strptime(date_str, '%Y%m%d') as date)"

PRESENT_TRADES = f"""
select {TRADE_COLUMNS}, {FEED_DAY} as "date" from ({PARSED})
where reason is null and day({FEED_DAY}) % 7 <> 2"""


PRESENT_REJECTS = f"""
select payload, reason, {FEED_DAY} as "date" from ({PARSED})
where reason is not null and day({FEED_DAY}) % 7 <> 2"""


def weekdays(first: str, last: str, source: str) -> str:
    return f"""
select cast(d as date) as trade_date, strftime(d, '%Y%m%d') as date_str
from (select unnest(generate_series(lo, hi, interval 1 day)) as d
      from (select cast({first} as timestamp) as lo, cast({last} as timestamp) as hi from {source}))
where isodow(d) < 6"""


def calendar(first: str, last: str, source: str) -> str:
    return f"""
select trade_date, date_str, version, file_name, '/feeds/' || file_name as input_path,
       '/trades/date=' || cast(trade_date as varchar) as output_path
from (select *, 'data_feeds_' || date_str || '_' || date_str || '_IEXTP1_TOPS' || version
             || '.pcap.gz' as file_name
      from (select *, case when date_str < '20171101' then '1.5' else '1.6' end as version
            from ({weekdays(first, last, source)})))"""


EVENT_CALENDAR = calendar("min(ts)::date", "max(ts)::date", "events")

COMPLETED = "select distinct strftime(ts, '%Y%m%d') as date_str from events where day(ts) % 5 = 0"

FILES = "select distinct strftime(ts, '%Y%m%d') as date_str from events where day(ts) % 7 <> 2"

OUTCOMES = f"""
select date_str,
       case when date_str in ({COMPLETED}) then 'SKIPPED'
            when date_str not in ({FILES}) then 'FAILED'
            when n is null then 'FAILED' else 'SUCCESS' end as status,
       case when date_str not in ({COMPLETED}) and date_str in ({FILES}) then n end as rows,
       case when date_str in ({COMPLETED}) then 'already exists'
            when date_str not in ({FILES}) then 'missing file'
            when n is null then 'no trade_report rows' end as reason
from ({EVENT_CALENDAR}) left join (
    select strftime(ts, '%Y%m%d') as date_str, count(*) as n from events
    where event_type = 'purchase' and day(ts) % 11 <> 0 group by 1) using (date_str)"""

TWO_RUNS = f"""
with bounds as (select min(ts)::date as lo, max(ts)::date as hi from events where event_type = 'purchase'),
days as ({weekdays("lo", "hi", "bounds")}),
found as (select distinct {FEED_DAY} as d from ({PAYLOADS}) where day({FEED_DAY}) % 7 <> 2),
counted as (select "date" as d, count(*) as n from ({PRESENT_TRADES}) group by 1),
refused as (select "date" as d, count(*) as r from ({PRESENT_REJECTS}) group by 1),
fresh as (
    select trade_date, date_str, case when n is null then 'FAILED' else 'SUCCESS' end as status, n as rows,
           case when trade_date not in (select d from found) then 'missing file'
                when n is null then 'no trade_report rows' end as reason,
           case when trade_date in (select d from found) then coalesce(r, 0) end as rejected
    from days left join counted on trade_date = counted.d left join refused on trade_date = refused.d),
first_run as (select fresh.* from fresh, bounds where trade_date <= lo + cast(floor((hi - lo) / 2) as integer))
select date_str, status, rows, reason, rejected from first_run
union all
select date_str, case when done then 'SKIPPED' else status end, case when not done then rows end,
       case when done then 'already exists' else reason end, case when not done then rejected end
from (select *, date_str in (select date_str from first_run where status = 'SUCCESS') as done from fresh)"""

UNITS, GIVEN = range(32), range(64)
#: First slots of b1, w2, b2 and the loss.
B1, W2, B2, LOSS = 2048, 2080, 2112, 2113


def _layer(unit: int, inputs: int) -> tuple[str, float, float]:
    row = [((31 * unit + 17 * j) % 13 - 6) / 10 for j in range(inputs)]
    return f"{row}::double[]", (unit % 5 - 2) / 10, (7 * unit % 11 - 5) / 10


def network(x: str, inputs: int = 10) -> str:
    terms = []
    for unit in UNITS:
        row, bias, out = _layer(unit, inputs)
        terms.append(f"({out}::double) * greatest(0::double, list_dot_product({row}, {x}) + ({bias}::double))")
    return f"1 / (1 + exp(-({' + '.join(terms)} + 0.1::double)))"


CURATED = f"""
select * from ({TRADES}) where type is not null and "timestamp" is not null and symbol is not null
and sale_size is not null and sale_price is not null and trade_id is not null"""

SCORED = f"""
select {TRADE_COLUMNS}, round({network("x")}, 6) as score
from (select *, [sale_size / 10000.0::double, sale_price / 1000.0::double,
                 sale_price * sale_size / 1.0e7::double, hour("timestamp") / 24.0::double,
                 minute("timestamp") / 60.0::double, second("timestamp") / 60.0::double,
                 (isodow("timestamp") - 1) / 7.0::double, day("timestamp") / 31.0::double,
                 sale_size % 100 / 100.0::double, length(symbol) / 10.0::double]::double[] as x
      from ({CURATED}))"""


TRAINING = """
select row_number() over () as id, embedding::double[] as x, toxic::double as y
from embeddings join labels on vec_id = doc_id"""


def _start() -> str:
    """Slots and values of the starting weights: w1 row by row, b1, w2, b2."""
    layers = [_layer(unit, len(GIVEN)) for unit in UNITS]
    rows = [((31 * unit + 17 * j) % 13 - 6) / 10 for unit in UNITS for j in GIVEN]
    values = [*rows, *(bias for _, bias, _ in layers), *(out for _, _, out in layers), 0.1]
    return ", ".join(f"({slot}, {value}::double)" for slot, value in enumerate(values))


def _means(weights: str, prefix: str) -> str:
    """Tables ending in ``{prefix}means``: mean gradient per slot under given weights.

    The last slot is the mean loss.
    """
    return f"""
{prefix}units as materialized (
    select u, list(w order by slot) filter (where slot < {B1}) as w,
           any_value(w) filter (where slot >= {B1} and slot < {W2}) as b,
           any_value(w) filter (where slot >= {W2}) as v
    from (select *, case when slot < {B1} then slot // 64 else (slot - {B1}) % 32 end as u from {weights} where slot < {B2})
    group by u),
{prefix}hidden as materialized (
    select id, u, x, y, v, greatest(0::double, list_dot_product(w, x) + b) as h from data, {prefix}units),
{prefix}scores as materialized (
    select id, any_value(y) as y,
           1 / (1 + exp(-(sum(v * h) + (select w from {weights} where slot = {B2})))) as p
    from {prefix}hidden group by id),
{prefix}back as materialized (
    select u, x, h, p - s.y as s, case when h > 0 then (p - s.y) * v else 0 end as g
    from {prefix}hidden join {prefix}scores s using (id)),
{prefix}means as materialized (
    select cast(slot as integer) as slot, total / (select count(*) from data) as mean from (
        select u * 64 + j as slot, sum(g * x[j + 1]) as total from {prefix}back, range(64) t(j) group by 1
        union all select {B1} + u, sum(g) from {prefix}back group by 1
        union all select {W2} + u, sum(s * h) from {prefix}back group by 1
        union all select {B2}, sum(p - y) from {prefix}scores
        union all select {LOSS}, sum(-(y * ln(p) + (1 - y) * ln(1 - p))) from {prefix}scores))"""


def _gradient() -> str:
    return f"""
with data as materialized ({TRAINING}), start(slot, w) as (values {_start()}), {_means("start", "")}
select slot, round(mean, 9) as mean from means"""


def _fitted(epochs: int) -> list[str]:
    """Optimiser steps, each a handful of tables over the ones before."""
    steps = [
        f"data as materialized ({TRAINING})",
        f"state0(slot, w, m, s) as (select slot, w, 0::double, 0::double from (values {_start()}) t(slot, w))",
    ]
    for epoch in range(1, epochs + 1):
        steps.append(_means(f"state{epoch - 1}", f"e{epoch}_"))
        steps.append(f"""
state{epoch} as materialized (
    select slot, w - 0.001::double * (m / (1 - pow(0.9::double, {epoch})))
               / (sqrt(s / (1 - pow(0.999::double, {epoch}))) + 1e-8::double) as w, m, s
    from (select slot, w, 0.9::double * m + 0.1::double * mean as m,
                 0.999::double * s + 0.001::double * mean * mean as s
          from state{epoch - 1} join e{epoch}_means using (slot)))""")
    return steps


def _fit_losses(epochs: int = 10) -> str:
    steps = _fitted(epochs)
    losses = " union all ".join(
        f"select cast({epoch} as integer) as epoch, round(mean, 9) as loss from e{epoch}_means where slot = {LOSS}"
        for epoch in range(1, epochs + 1)
    )
    return f"with {', '.join(steps)} {losses}"


def _stored_weights() -> str:
    """Scores under the weights after one step."""
    return f"""
with {', '.join(_fitted(1))},
units as materialized (
    select u, list(w order by slot) filter (where slot < {B1}) as w,
           any_value(w) filter (where slot >= {B1} and slot < {W2}) as b,
           any_value(w) filter (where slot >= {W2}) as v
    from (select *, case when slot < {B1} then slot // 64 else (slot - {B1}) % 32 end as u
          from state1 where slot < {B2}) group by u)
select vec_id, round(1 / (1 + exp(-(sum(v * greatest(0::double, list_dot_product(w, embedding::double[]) + b))
       + (select w from state1 where slot = {B2})))), 6) as score
from embeddings, units group by vec_id"""


ORACLES: dict[str, str] = {
    "daily_metrics": DAILY,
    "daily_metrics_bulk": metrics(BULK, '"date", symbol'),
    "daily_metrics_paired": metrics(
        TRADES, '"date", symbol', "case when sale_price is not null then sale_size end"
    ),
    "exposure": metrics(TRADES, "symbol"),
    "exposure_bulk": metrics(BULK, "symbol"),
    "trades_per_day": f"""
        select cast("timestamp" as date) as "date", count(trade_id) as trade_count
        from ({TRADES}) where "timestamp" is not null group by 1""",
    "date_range": f"""
        select cast(min("timestamp") as date) as min_date, cast(max("timestamp") as date) as max_date
        from ({TRADES})""",
    "symbols": f"select distinct symbol from ({TRADES}) where symbol is not null",
    "default_symbols": f"""
        select symbol from ({TRADES}) where symbol is not null
        group by symbol order by min("timestamp"), symbol limit 1""",
    "preview": f'select * from ({TRADES}) order by "timestamp", trade_id limit 10',
    "preview_head": f"""
        select *, cast("timestamp" as date) as "date" from ({TRADES}) order by "timestamp", trade_id limit 5""",
    "pivot_avg_price": pivot("avg_price"),
    "pivot_volume": pivot("total_volume"),
    "pivot_vwap": pivot("vwap"),
    "large_trades": f"""
        select *, cast("timestamp" as date) as "date" from ({TRADES})
        where sale_size > 5 * (select avg(sale_size) from ({TRADES}))""",
    "alert_status": f"""
        select case when exists (select 1 from ({TRADES})
                                 where sale_size > 5 * (select avg(sale_size) from ({TRADES})))
                    then 'ALERT' else 'CLEAR' end as status,
               max(sale_size) as largest, round(5 * avg(sale_size), 6) as threshold
        from ({TRADES})""",
    "alert_status_clear": f"""
        select case when exists (select 1 from ({BULK})
                                 where sale_size > 5 * (select avg(sale_size) from ({BULK})))
                    then 'ALERT' else 'CLEAR' end as status,
               max(sale_size) as largest, round(5 * avg(sale_size), 6) as threshold
        from ({BULK})""",
    "daily_metrics_ordered": f'select * from ({DAILY}) order by "date", symbol',
    "encoded_messages": f"""
        select type, case when cast(trade_id as bigint) % 3 = 1 then date_trunc('second', "timestamp") + interval 5 hour
                          else date_trunc('second', "timestamp") end as "timestamp",
               case when cast(trade_id as bigint) % 13 <> 0 then symbol end as symbol,
               sale_size, round(sale_price, 4) as sale_price, trade_id
        from ({TRADES})""",
    "union_days": f"""
        select {TRADE_COLUMNS} from ({TRADES})
        union all select type, "timestamp", symbol, sale_size, sale_price, null from ({BULK})""",
    "trade_reports": TRADES,
    "tops_normalized": TOPS,
    "stg_tops": STG_TOPS,
    "stg_trades": STG_TRADES.format(trades=TRADES),
    "fct_tops": f"""
        select trade_date, symbol, round(avg(last_sale_price), 6) as avg_price,
               round(avg(ask_price - bid_price), 6) as avg_spread,
               cast(sum(last_sale_size) as bigint) as total_volume
        from ({STG_TOPS}) group by 1, 2""",
    "fct_tops_by_type": f"""
        select cast("timestamp" as date) as trade_date, symbol,
               round(avg(price) filter (where type = 'trade_report' and price > 0), 6) as avg_price,
               round(avg(ask_price - bid_price) filter (where type = 'quote_update' and bid_size > 0
                     and ask_size > 0 and bid_price > 0 and ask_price > 0), 6) as avg_spread,
               cast(coalesce(sum(size) filter (where type = 'trade_report'), 0) as bigint) as total_volume
        from ({MESSAGES}) where symbol is not null and "timestamp" is not null group by 1, 2""",
    "fct_trades": f"""
        select symbol, round(sum(last_sale_size * last_sale_price), 2) as notional, count(*) as trade_count
        from ({STG_TRADES.format(trades=TRADES)}) group by symbol""",
    "fct_trades_bulk": f"""
        select symbol, round(sum(last_sale_size * last_sale_price), 2) as notional, count(*) as trade_count
        from ({STG_TRADES.format(trades=BULK)}) group by symbol""",
    "csv_roundtrip": TRADES,
    "csv_inferred": TRADES,
    "csv_many": f"""
        select {TRADE_COLUMNS} from ({TRADES})
        union all select null, "timestamp", symbol, sale_size, sale_price, null from ({BULK})""",
    "parquet_roundtrip": TRADES,
    "daily_partitions": f'select *, cast("timestamp" as date) as "date" from ({TRADES})',
    "counted_write": f"select count(*) as stored, count(*) as reported from ({TRADES})",
    "curated_trades": CURATED,
    "feed_payload_parse": f"select {TRADE_COLUMNS} from ({PARSED}) where reason is null",
    "malformed_rows": f"select payload, reason from ({PARSED}) where reason is not null",
    "file_date": f"""
        select {FEED_DAY} as "date", count(*) as lines, cast(sum(length(value)) as bigint) as characters
        from ({PAYLOADS}) group by 1""",
    "feed_calendar": calendar(
        "min(l_shipdate)::date + interval 20 year", "max(l_shipdate)::date + interval 20 year", "lineitem"
    ),
    "pending_dates": f"select * from ({EVENT_CALENDAR}) where date_str not in ({COMPLETED})",
    "skipped_dates": f"select * from ({EVENT_CALENDAR}) where date_str in ({COMPLETED})",
    "missing_inputs": f"select * from ({EVENT_CALENDAR}) where date_str not in ({FILES})",
    "ingest_outcomes": OUTCOMES,
    "run_summary": f"""
        select status, count(*) as dates, cast(sum(rows) as bigint) as total_rows,
               string_agg(date_str, ',' order by date_str) as listed
        from ({OUTCOMES}) group by status""",
    "summary_file": f"""
        select case status when 'SUCCESS' then 'success' when 'FAILED' then 'failed' else 'skipped' end as bucket,
               date_str as "date", case when status = 'SUCCESS' then rows end as rows,
               case when status <> 'SUCCESS' then reason end as reason
        from ({OUTCOMES})""",
    "range_ingest": TWO_RUNS,
    "range_ingest_trades": f"""
        select * from ({PRESENT_TRADES}) where isodow("date") < 6""",
    "range_ingest_rejects": f"""
        select * from ({PRESENT_REJECTS}) where isodow("date") < 6""",
    "csv_rejects": f"""
        select trade_id, 'sale_size' as columns from ({TRADES}) where cast(trade_id as bigint) % 11 = 0""",
    "day_ingest": f"""
        select {TRADE_COLUMNS}, (select max(ts)::date from events) as "date" from ({PARSED}) where reason is null""",
    "fraud_score": f"select vec_id, round({network('embedding::double[]', 64)}, 6) as score from embeddings",
    "scored_trades": SCORED,
    "stored_weights": _stored_weights(),
    "fraud_gradient": _gradient(),
    "fraud_fit_losses": _fit_losses(),
}
