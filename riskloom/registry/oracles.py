"""SQL over the plain test tables that must give what the queries give.

Written for DuckDB and independent of the Spark code: every statement starts
from the given tables. Common table expressions are put together by name.
"""

from __future__ import annotations

import re


def _pad(prefix: str, number: str, width: int) -> str:
    return (f"'{prefix}' || case when length(({number})::varchar) >= {width} then ({number})::varchar "
            f"else lpad(({number})::varchar, {width}, '0') end")


def _half_up(value: str, digits: int) -> str:
    return f"floor(({value}) * {10.0 ** digits} + 0.5) / {10.0 ** digits}"


def _money(value: str) -> str:
    return f"cast(sum(cast({value} as decimal(18,2))) as double)"


def _exact(value: str) -> str:
    """A double as four whole numbers, without loss."""
    top = f"floor({value} / {2.0**52})"
    rest = f"({value} - {top} * {2.0**52})"
    low = f"(({rest} - floor({rest})) * {2.0**52})"
    parts = [top, f"floor({rest})", f"floor({low})", f"floor(({low} - floor({low})) * {2.0**52})"]
    return " || ',' || ".join(f"({p})::bigint::varchar" for p in parts)


def _part(text: str) -> str:
    """A value with its length in front, so that neighbours cannot run together."""
    return f"coalesce(length({text})::varchar || ':' || ({text}), 'n')"


_CHANNELS = "['mobile_app', 'web', 'in_store', 'api']"
_DEVICES = "['ios', 'android', 'macos', 'windows', 'linux']"
_TENURE = """case when account_age_days > 365 or account_age_days is null then 'Veteran (>1yr)'
    when account_age_days > 180 then 'Mature (6-12m)' when account_age_days >= 30 then 'Established (1-6m)'
    else 'New (<30d)' end"""
_TX_COLUMNS = ("transaction_id, user_id, merchant_id, amount, currency, timestamp, channel, card_type, "
               "device_type, ip_address, country, distance_from_home_km, is_fraud, fraud_type")
_TEMPORAL = """cast(extract(hour from timestamp) as integer) as hour_of_day,
    cast(extract(isodow from timestamp) - 1 as integer) as day_of_week,
    case when extract(isodow from timestamp) in (6, 7) then 1 else 0 end as is_weekend,
    case when extract(hour from timestamp) < 6 or extract(hour from timestamp) > 22 then 1 else 0 end as is_night"""

_ROW_TEXT = " || ".join(
    _part(_exact(c) if c in ("amount", "distance_from_home_km") else
          "epoch_us(timestamp)::varchar" if c == "timestamp" else f"({c})::varchar")
    for c in _TX_COLUMNS.split(", "))

# name -> body
_CTES: dict[str, tuple[str, str]] = {}


def _cte(name: str, body: str) -> None:
    _CTES[name] = body


_cte("ev", "select *, cast(regexp_extract(props, '\"k\": ([0-9]+)', 1) as integer) as k from events")
_cte("tx", f"""
    select e.event_id as no,
      {_pad('TX_', 'e.event_id', 12)} as transaction_id,
      {_pad('USR_', 'e.user_id', 5)} as user_id,
      {_pad('MER_', 'e.k % (select count(*) from supplier)', 4)} as merchant_id,
      cast(cast(e.value * 10 as decimal(18,2)) as double) as amount,
      'USD' as currency,
      e.ts as timestamp,
      {_CHANNELS}[(e.event_id % 4) + 1] as channel,
      ['credit', 'debit', 'virtual_card'][(e.event_id % 3) + 1] as card_type,
      {_DEVICES}[(e.event_id % 5) + 1] as device_type,
      '10.0.' || e.k || '.1' as ip_address,
      n.n_name as country,
      (e.event_id * 37 % 4000) / 100.0::double
        + case when e.event_type = 'error' and e.k < 19 then 250.0::double * (e.k + 1) else 0.0::double end
        as distance_from_home_km,
      case when e.event_type = 'error' and e.k < 19 then 1 else 0 end as is_fraud,
      case when e.event_type = 'error' and e.k < 19
        then ['VELOCITY_BURST', 'IMPOSSIBLE_TRAVEL', 'CARD_PROBING', 'HIGH_RISK_SURGE'][(e.event_id % 4) + 1]
        else 'NONE' end as fraud_type
    from ev e
    left join customer c on c.c_custkey = e.user_id
    left join nation n on n.n_nationkey =
      case when e.event_id % 11 = 0 then (c.c_nationkey + 1) % 25 else c.c_nationkey end""")
_cte("txc", "select * replace (case when amount > 0 then amount else 1.0::double end as amount) from tx")
_cte("usr", f"""
    select {_pad('USR_', 'c_custkey', 5)} as user_id, c_name as user_name,
      lower(replace(c_name, '#', '.')) || '@example.com' as email, n_name as country,
      cast(5 + c_custkey * 37 % 1500 as integer) as account_age_days,
      case when c_custkey % 7 <> 0 then 1 else 0 end as kyc_verified,
      50.0::double + abs(c_acctbal) / 20.0::double as baseline_spend,
      cast(date '2024-01-31' - cast(5 + c_custkey * 37 % 1500 as integer) as timestamp) as created_at
    from customer join nation on c_nationkey = n_nationkey""")
_cte("mer", f"""
    select {_pad('MER_', 's_suppkey', 4)} as merchant_id, s_name as merchant_name,
      ['grocery', 'subscription', 'restaurant', 'electronics', 'travel', 'luxury_goods',
       'crypto_exchange', 'gaming_gambling'][(s_suppkey % 8) + 1] as category,
      ['Low', 'Low', 'Low', 'Medium', 'Medium', 'High', 'High', 'High'][(s_suppkey % 8) + 1] as risk_tier,
      n_name as country, (10 + s_suppkey * 7 % 390) / 10000.0::double as chargeback_history_rate
    from supplier join nation on s_nationkey = n_nationkey""")
_cte("act", f"select *, {_TEMPORAL}, cast(timestamp as date) as transaction_date from tx")
_cte("fact", """
    select a.*, case when u.user_id is not null and a.country is distinct from u.country then 1 else 0 end
      as is_cross_border
    from act a left join usr u on u.user_id = a.user_id""")
_cte("dup", f"""
    select 'TX_' || l_orderkey || '_' || l_linenumber as transaction_id,
      {_pad('USR_', 'o_custkey', 5)} as user_id, {_pad('MER_', 'l_suppkey', 4)} as merchant_id,
      l_extendedprice as amount, 'USD' as currency, l_shipdate as timestamp,
      {_CHANNELS}[(l_linenumber % 4) + 1] as channel,
      case when l_linestatus = 'O' then 'credit' else 'debit' end as card_type,
      {_DEVICES}[(l_partkey % 5) + 1] as device_type, '10.0.0.1' as ip_address, n_name as country,
      l_quantity as distance_from_home_km, case when l_returnflag = 'R' then 1 else 0 end as is_fraud,
      case when l_returnflag = 'R' then 'CARD_PROBING' else 'NONE' end as fraud_type
    from lineitem join orders on l_orderkey = o_orderkey
    join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey""")
_cte("dedup", f"""
    select {_TX_COLUMNS} from (
      select *, row_number() over (partition by transaction_id order by
        timestamp nulls first, user_id nulls first, merchant_id nulls first, amount nulls first, currency nulls first,
        channel nulls first, card_type nulls first, device_type nulls first, ip_address nulls first,
        country nulls first, distance_from_home_km nulls first, is_fraud nulls first, fraud_type nulls first) as rn
      from dup) where rn = 1""")
_cte("bad", """
    select case when no % 101 = 0 then null else transaction_id end as transaction_id,
      case when no % 89 = 0 then 'NON_EXISTENT_USR' else user_id end as user_id,
      case when no % 83 = 0 then null else merchant_id end as merchant_id,
      case when no % 103 = 0 then 'NaN'::double when no % 97 = 0 then -amount else amount end as amount,
      currency, timestamp, channel, card_type, device_type, ip_address, country,
      case when no % 79 = 0 then -distance_from_home_km else distance_from_home_km end as distance_from_home_km,
      case when no % 73 = 0 then 2 when no % 71 = 0 then null else is_fraud end as is_fraud, fraud_type
    from tx, (values (0), (1)) copies(copy) where copy = 0 or no % 67 = 0""")
_cte("inc", """
    select a.transaction_id, a.user_id, u.user_name, a.merchant_id, m.merchant_name,
      m.category as merchant_category, a.amount as fraud_amount, a.timestamp, a.fraud_type, a.channel,
      a.device_type, a.distance_from_home_km,
      case when a.amount >= 2000 then 'CRITICAL' when a.amount >= 500 then 'HIGH' else 'MEDIUM' end as severity_level,
      'FLAGGED_FOR_REVIEW' as ops_status
    from act a join usr u on u.user_id = a.user_id join mer m on m.merchant_id = a.merchant_id
    where a.is_fraud = 1""")
_cte("du", f"""
    select u.*, coalesce(m.n, 0) as total_transactions, coalesce(m.spend, 0.0) as total_lifetime_spend,
      coalesce({_half_up('m.spend / m.n', 2)}, 0.0) as avg_transaction_spend,
      coalesce(m.frauds, 0) as total_fraud_incidents, m.last_at as last_active_timestamp,
      {_TENURE} as user_cohort_tenure
    from usr u left join (
      select user_id, count(transaction_id) as n, {_money('amount')} as spend,
        cast(sum(is_fraud) as bigint) as frauds, max(timestamp) as last_at
      from tx group by user_id) m on m.user_id = u.user_id""")
_cte("dm", f"""
    select m.*, coalesce(x.n, 0) as total_processed_tx, coalesce(x.volume, 0.0) as total_processed_volume,
      coalesce(x.frauds, 0) as fraud_tx_count, coalesce(x.fraud_volume, 0.0) as total_fraud_volume,
      case when x.n > 0 then {_half_up('x.frauds::double / x.n', 4)} else 0.0 end as empirical_fraud_rate
    from mer m left join (
      select merchant_id, count(transaction_id) as n, {_money('amount')} as volume,
        cast(sum(is_fraud) as bigint) as frauds,
        {_money('case when is_fraud = 1 then amount else 0 end')} as fraud_volume
      from tx group by merchant_id) x on x.merchant_id = m.merchant_id""")
_cte("fil", """
    select * from act where transaction_date between date '2024-01-05' and date '2024-01-25'
      and channel in ('web', 'api', 'mobile_app') and amount >= 50.0 and amount <= 1500.0""")
_cte("stg", """
    select transaction_id, user_id, merchant_id, amount, currency, timestamp as transaction_timestamp, channel,
      card_type, device_type, country as transaction_country, distance_from_home_km, is_fraud, fraud_type,
      date_trunc('day', timestamp)::timestamp as transaction_date,
      cast(extract(hour from timestamp) as integer) as hour_of_day,
      extract(dow from timestamp) in (0, 6) as is_weekend
    from tx where transaction_id is not null and amount > 0""")
_cte("vel", """
    select transaction_id, user_id, timestamp, amount,
      count(transaction_id) over (partition by user_id order by timestamp
        range between interval 1 hour preceding and current row) as tx_count_last_1h,
      cast(sum(cast(amount as decimal(18,2))) over (partition by user_id order by timestamp
        range between interval 24 hour preceding and current row) as double) as total_spend_last_24h,
      lag(timestamp) over (partition by user_id order by timestamp, transaction_id) as prev_tx_timestamp,
      (epoch_us(timestamp) - epoch_us(lag(timestamp) over (partition by user_id order by timestamp, transaction_id)))
        / 1000000.0::double as seconds_since_prev_tx
    from tx""")
_cte("rs", f"""
    select *, {_half_up('''least(0.05::double + case when amount > 3000 then 0.3::double else 0.0::double end
      + case when is_cross_border = 1 then 0.25::double else 0.0::double end
      + case when hour_of_day in (0, 1, 2, 3) then 0.2::double else 0.0::double end, 0.99::double)''', 4)} as score
    from fact""")
# requests as they are sent: value, and whether the key was left out
_cte("req", """
    select no, transaction_id, case when no % 31 = 0 then 'USR_UNKNOWN' else user_id end as user_id,
      case when no % 37 = 0 then 'MER_UNKNOWN' else merchant_id end as merchant_id,
      case when no % 97 = 0 then -amount else amount end as amount,
      case when no % 5 = 0 then 'web' else channel end as channel,
      case when no % 7 = 0 then 'credit' else card_type end as card_type,
      case when no % 9 = 0 then 'windows' else device_type end as device_type,
      case when no % 13 = 0 then 'US' else country end as country,
      case when no % 17 = 0 then 15.0::double when no % 79 = 0 then -1.0::double else distance_from_home_km end
        as distance_from_home_km,
      case when no % 19 = 0 then 14 when no % 23 = 0 then null when no % 29 = 0 then 25
        else cast(extract(hour from timestamp) as integer) end as hour_of_day
    from tx""")
_cte("reqv", """
    select *, concat_ws('; ', case when not amount > 0 then 'amount must be above 0' end,
      case when not distance_from_home_km >= 0 then 'distance_from_home_km must not be negative' end,
      case when hour_of_day not between 0 and 23 then 'hour_of_day must be within 0..23' end) as violations
    from req""")
_cte("enr", """
    select r.transaction_id, r.user_id, r.merchant_id, r.amount, r.channel, r.card_type, r.device_type, r.country,
      r.distance_from_home_km, coalesce(r.hour_of_day, 12) as hour_of_day, 0 as is_weekend,
      case when coalesce(r.hour_of_day, 12) < 6 or coalesce(r.hour_of_day, 12) > 22 then 1 else 0 end as is_night,
      case when u.user_id is not null and r.country is distinct from u.country then 1 else 0 end as is_cross_border,
      case when u.user_id is null then 180 else u.account_age_days end as account_age_days,
      case when u.user_id is null then 1 else u.kyc_verified end as kyc_verified,
      case when u.user_id is null then 50.0::double else u.baseline_spend end as baseline_spend,
      case when u.user_id is null then r.country else u.country end as home_country,
      case when m.merchant_id is null then 'Medium' else m.risk_tier end as risk_tier,
      case when m.merchant_id is null then 0.015::double else m.chargeback_history_rate end as chargeback_history_rate,
      r.amount / greatest(1.0::double, case when u.user_id is null then 50.0::double else u.baseline_spend end)
        as amount_to_baseline_ratio,
      case coalesce(m.risk_tier, 'Medium') when 'Low' then 0.1::double when 'Medium' then 0.5::double
        when 'High' then 0.9::double else 0.5::double end as merchant_risk_score,
      m.category
    from reqv r left join usr u on u.user_id = r.user_id left join mer m on m.merchant_id = r.merchant_id
    where r.violations = ''""")
_cte("enrs", f"""
    select *, {_half_up('''least(0.05::double + case when amount > 3000 then 0.3::double else 0.0::double end
      + case when is_cross_border = 1 then 0.25::double else 0.0::double end
      + case when hour_of_day in (0, 1, 2, 3) then 0.2::double else 0.0::double end, 0.99::double)''', 4)} as score
    from enr""")
_DECISION = """case when score >= 0.80 then 'DECLINE_FRAUD' when score >= 0.50 then 'MANUAL_REVIEW'
    when score >= 0.25 then 'APPROVE_WITH_CHALLENGE' else 'APPROVE' end"""
_TIER = """case when score >= 0.80 then 'CRITICAL' when score >= 0.50 then 'HIGH'
    when score >= 0.25 then 'ELEVATED' else 'LOW' end"""


def _fixed(value: str, digits: int) -> str:
    return f"cast(cast({_half_up(value, digits)} as decimal(30,{digits})) as varchar)"


_REASONS = f"""coalesce(nullif(concat_ws('; ',
    case when amount_to_baseline_ratio > 5.0 then
      'Amount ' || {_fixed('amount_to_baseline_ratio', 1)} || 'x higher than user average spend' end,
    case when distance_from_home_km > 2000.0 then 'Abnormal distance: ' || distance_from_home_km || ' km' end,
    case when is_night = 1 then 'Late-night transaction window' end,
    case when is_cross_border = 1 then 'Cross-border country mismatch' end,
    case when risk_tier = 'High' then 'High-risk merchant category (crypto/luxury)' end), ''),
    'Normal transactional pattern')"""
_cte("feat", """
    select f.transaction_id, f.amount, f.distance_from_home_km, f.hour_of_day, f.is_weekend, f.is_night,
      f.is_cross_border, u.account_age_days, u.kyc_verified, u.baseline_spend,
      f.amount / case when u.baseline_spend < 1.0 then 1.0::double else u.baseline_spend end as amount_to_baseline_ratio,
      coalesce(m.chargeback_history_rate, 0.01::double) as chargeback_history_rate,
      case m.risk_tier when 'Low' then 0.1::double when 'Medium' then 0.5::double when 'High' then 0.9::double
        else 0.2::double end as merchant_risk_score,
      f.channel, f.card_type, f.device_type, f.is_fraud
    from fact f left join usr u on u.user_id = f.user_id left join mer m on m.merchant_id = f.merchant_id""")
_cte("gate", """
    select count(*) as total,
      count(*) - count(distinct transaction_id) - coalesce(bool_or(transaction_id is null), false)::int as dup_n,
      count(*) filter (where transaction_id is null) as null_ids,
      count(*) filter (where merchant_id is null) as null_merchants,
      count(*) filter (where amount is null or isnan(amount)) as null_amounts,
      count(*) filter (where transaction_id is null) + count(*) filter (where user_id is null)
        + count(*) filter (where merchant_id is null) + count(*) filter (where amount is null or isnan(amount))
        + count(*) filter (where timestamp is null) as null_n,
      count(*) filter (where not isnan(amount) and amount <= 0) as amount_n, count(*) filter (where distance_from_home_km < 0) as distance_n,
      count(*) filter (where user_id is null or user_id not in (select user_id from usr)) as user_n,
      count(*) filter (where merchant_id is null or merchant_id not in (select merchant_id from mer)) as merchant_n,
      count(*) filter (where is_fraud is null or is_fraud not in (0, 1)) as label_n
    from bad""")
_MELT = "unnest(['amount', 'distance_from_home_km', 'hour_of_day']) as feature, " \
        "unnest([amount, distance_from_home_km, hour_of_day::double]) as value"
_cte("duph", "select *, cast(extract(hour from timestamp) as integer) as hour_of_day from dup")
_cte("side_big", f"""
    select feature, value, 1 as r, 0 as c from (select {_MELT} from act)
    union all select feature, value, 0, 1 from (select {_MELT} from duph)""")
_cte("sample", "select * from act order by md5('42:' || transaction_id), transaction_id limit 1500")
_cte("sampx", "select * replace (amount * 1.8::double as amount) from sample")
_cte("side_halves", f"""
    select feature, value, (timestamp < timestamp '2024-01-16')::int as r, (timestamp >= timestamp '2024-01-16')::int as c
    from (select timestamp, {_MELT} from act)""")
_MELT_ALL = "unnest(['amount', 'distance_from_home_km', 'hour_of_day', 'account_age_days', 'baseline_spend']) as feature, " \
            "unnest([amount, distance_from_home_km, hour_of_day::double, account_age_days::double, baseline_spend]) as value"
_cte("featx", "select * replace (amount * 1.8::double as amount) from feat")
_cte("side_all", f"""
    select feature, value, 1 as r, 0 as c from (select {_MELT_ALL} from feat)
    union all select feature, value, 0, 1 from (select {_MELT_ALL} from featx)""")
_cte("side_scaled", f"""
    select feature, value, 1 as r, 0 as c from (select {_MELT} from act)
    union all select feature, value, 0, 1 from (select {_MELT} from sampx)""")


def _drift_ctes(tag: str, side: str) -> None:
    _cte(f"dist_{tag}", f"""
        select *, cast(sum(n_ref) over w as bigint) as cum_ref, cast(sum(n_cur) over w as bigint) as cum_cur,
          cast(sum(n_ref) over (partition by feature) as bigint) as size_ref,
          cast(sum(n_cur) over (partition by feature) as bigint) as size_cur,
          lead(value) over (partition by feature order by value) as next_value
        from (select feature, value, sum(r) as n_ref, sum(c) as n_cur from {side} group by feature, value)
        window w as (partition by feature order by value rows unbounded preceding)""")
    _cte(f"edge_{tag}", f"""
        select feature, i, lo + (hi - lo) * (pos - floor(pos)) as edge from (
          select s.feature, i, any_value(pos) as pos,
            min(d.value) filter (where d.cum_ref > floor(pos)) as lo,
            min(d.value) filter (where d.cum_ref > least(floor(pos) + 1, d.size_ref - 1)) as hi
          from (select feature, i, (max(size_ref) - 1) * (i / 10.0::double) as pos
                from dist_{tag}, range(1, 10) t(i) group by feature, i) s
          join dist_{tag} d on d.feature = s.feature and d.n_ref > 0 group by s.feature, i)""")
    _cte(f"buck_{tag}", f"""
        select f.feature, b.bucket, coalesce(sum(x.n_ref), 0)::bigint as n_ref, coalesce(sum(x.n_cur), 0)::bigint as n_cur,
          any_value(f.size_ref) as size_ref, any_value(f.size_cur) as size_cur
        from (select feature, max(size_ref) as size_ref, max(size_cur) as size_cur from dist_{tag} group by feature) f
        cross join range(0, 10) b(bucket)
        left join (select d.feature, d.n_ref, d.n_cur,
            (select count(*) from edge_{tag} e where e.feature = d.feature and e.edge <= d.value) as bucket
          from dist_{tag} d) x on x.feature = f.feature and x.bucket = b.bucket
        group by f.feature, b.bucket""")
    _cte(f"psi_{tag}", f"""
        select feature, sum((a - e) * ln(a / e)) as psi from (
          select feature, greatest(1e-4::double, least(1.0::double, n_ref / size_ref::double)) as e,
            greatest(1e-4::double, least(1.0::double, n_cur / size_cur::double)) as a from buck_{tag})
        group by feature""")
    _cte(f"far_{tag}", f"""
        select feature, any_value(size_ref) as size_ref, any_value(size_cur) as size_cur,
          max(abs(cum_ref / size_ref::double - cum_cur / size_cur::double)) as ks,
          sum(abs(cum_ref / size_ref::double - cum_cur / size_cur::double)
            * (coalesce(next_value, value) - value)) as w1
        from dist_{tag} group by feature""")
    _cte(f"pv_{tag}", f"""
        select feature, ks, w1, case when lam < 0.2 then 1.0::double else greatest(0.0::double, least(1.0::double,
            2 * (select sum(case when k % 2 = 1 then 1.0 else -1.0 end * exp(-2.0::double * k * k * lam * lam))
                 from range(1, 101) t(k)))) end as p
        from (select *, ks * sqrt(size_ref::double * size_cur / (size_ref + size_cur)) as lam from far_{tag})""")
    _cte(f"met_{tag}", f"""
        select p.feature, p.ks, p.w1, p.p, s.psi, (s.psi > 0.20 or p.p < 0.05) as drifting,
          case when s.psi > 0.25 then 'HIGH' when s.psi > 0.10 then 'MODERATE' else 'NEGLIGIBLE' end as severity
        from pv_{tag} p join psi_{tag} s on s.feature = p.feature""")


_drift_ctes("big", "side_big")
_drift_ctes("halves", "side_halves")
_drift_ctes("all", "side_all")
_drift_ctes("scaled", "side_scaled")


def _curve_ctes(tag: str, source: str, score: str) -> None:
    _cte(f"step_{tag}", f"""
        select s as score, pos, neg, sum(pos) over w as above_pos, sum(neg) over w as above_neg,
          sum(pos) over () as all_pos, sum(neg) over () as all_neg
        from (select {score} as s, sum(is_fraud) as pos, sum(1 - is_fraud) as neg from {source} group by 1)
        window w as (order by s desc rows unbounded preceding)""")


_curve_ctes("rule", "rs", "score")
_curve_ctes("dist", "act", "distance_from_home_km")

_cte("split", """
    select transaction_id, is_fraud,
      row_number() over (partition by is_fraud order by md5('42:' || transaction_id), transaction_id)
        <= floor(count(*) over (partition by is_fraud) * 0.2::double + 0.5) as is_test
    from act""")
_cte("expo", f"""
    select coalesce({_money('case when is_fraud = 1 then amount else 0 end')}, 0.0) as dollars,
      count(*) filter (where is_fraud = 0) as legit from fil""")
_cte("tau", "select t.*, greatest(0.40::double, least(0.99::double, 1.0::double - (threshold - 0.10::double) * 0.5::double)) as rec, "
     "greatest(0.001::double, least(0.08::double, (1.0::double - threshold) * 0.04::double)) as fpr, dollars, legit "
     "from (select 'Conservative' as policy, 0.30::double as threshold union all select 'Balanced', 0.50 "
     "union all select 'Growth', 0.70) t, expo")
_cte("tauf", "select point, threshold, greatest(0.40::double, least(0.99::double, 1.0::double - (threshold - 0.10::double) * 0.5::double)) as rec, "
     "greatest(0.001::double, least(0.08::double, (1.0::double - threshold) * 0.04::double)) as fpr, dollars, legit "
     "from (select cast(i as integer) as point, 0.1::double + i * (0.8::double / 24) as threshold from range(0, 25) r(i)), expo")


def _sql(body: str) -> str:
    """Prefix the statement with the common table expressions it names, directly or not."""
    wanted: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:from|join)\s+([a-z_]+)|,\s*(expo)\b", text):
            name = name[0] or name[1]
            if name in _CTES and name not in wanted:
                visit(_CTES[name])
                wanted.append(name)

    visit(body)
    head = ",\n".join(f"{name} as ({_CTES[name]})" for name in wanted)
    return f"with {head}\n{body}" if wanted else body


_DAILY = f"""
    select transaction_date, count(transaction_id) as total_transactions, {_money('amount')} as total_gmv,
      {_half_up(_money('amount') + ' / count(amount)', 2)} as avg_ticket_size,
      cast(sum(is_fraud) as bigint) as fraud_incident_count,
      {_money('case when is_fraud = 1 then amount else 0 end')} as total_fraud_amount,
      {_half_up('sum(is_fraud)::double / count(transaction_id) * 100', 2)} as fraud_rate_pct,
      count(distinct user_id) as active_transacting_users, count(distinct merchant_id) as active_merchants
    from act group by transaction_date"""
_CATEGORY = f"""
    select m.category, count(a.transaction_id) as total_tx_count, {_money('a.amount')} as total_volume,
      cast(sum(a.is_fraud) as bigint) as total_fraud_count,
      {_money('case when a.is_fraud = 1 then a.amount else 0 end')} as total_fraud_volume,
      {_half_up('sum(a.is_fraud)::double / count(a.transaction_id) * 100', 2)} as fraud_rate_pct
    from act a join mer m on m.merchant_id = a.merchant_id group by m.category"""
_CHANNEL = f"""
    select channel, count(transaction_id) as total_tx_count, {_money('amount')} as total_volume,
      {_half_up(_money('amount') + ' / count(amount)', 2)} as avg_transaction_value,
      cast(sum(is_fraud) as bigint) as fraud_count,
      {_half_up('sum(is_fraud)::double / count(transaction_id) * 100', 2)} as fraud_rate_pct
    from act group by channel"""


def _user_metrics(source: str) -> str:
    return f"""
    select user_id, count(transaction_id) as total_transactions, {_money('amount')} as total_lifetime_spend,
      {_half_up(_money('amount') + ' / count(amount)', 2)} as avg_transaction_spend,
      cast(sum(is_fraud) as bigint) as total_fraud_incidents, max(timestamp) as last_active_timestamp
    from {source} group by user_id"""


def _histogram(source: str, value: str, bins: int, by: str, by_name: str) -> str:
    return f"""
    select bin, any_value(lo + bin * w) as lower, any_value(lo + (bin + 1) * w) as upper, side as {by_name}, count(*) as n
    from (select lo, (hi - lo) / {bins} as w, {by} as side,
        cast(case when hi = lo then 0 else least(floor(({value} - lo) / ((hi - lo) / {bins})), {bins - 1}) end as integer) as bin
      from {source} s cross join (select min({value}) as lo, max({value}) as hi from {source}) r)
    group by bin, side"""


_FACT_COLUMNS = """transaction_id, user_id, merchant_id, amount, currency, timestamp, channel, card_type, device_type,
    country as transaction_country, distance_from_home_km, hour_of_day, day_of_week, is_weekend, is_night,
    is_cross_border, is_fraud, fraud_type"""
_QUEUE = """transaction_id, user_name, merchant_name, merchant_category, fraud_amount, fraud_type, severity_level,
    distance_from_home_km, ops_status"""
_CONFUSION = """
    select count(*) filter (where score >= 0.3 and is_fraud = 1) as true_positives,
      count(*) filter (where score >= 0.3 and is_fraud = 0) as false_positives,
      count(*) filter (where score < 0.3 and is_fraud = 0) as true_negatives,
      count(*) filter (where score < 0.3 and is_fraud = 1) as false_negatives from rs"""


def _pr(tag: str) -> str:
    return f"""
    select score as threshold, (above_pos / (above_pos + above_neg))::double as precision,
      (above_pos / all_pos)::double as recall from step_{tag}
    union all select null, 1.0::double, 0.0::double"""


_OUTCOME = """threshold, rec as recall, fpr as false_positive_rate, dollars * rec as fraud_prevented,
    dollars * (1.0::double - rec) as fraud_leakage, trunc(legit * fpr)::bigint as fp_count,
    trunc(legit * fpr) * 25.0::double as friction_total, dollars * rec - trunc(legit * fpr) * 25.0::double as net_benefit"""

_MESSAGES = [
    ("dup_n", "'Primary key violation: ' || dup_n || ' duplicate transaction_ids found.'"),
    ("null_n", "'Null constraint violation in critical columns: {' || concat_ws(', ', "
     "case when null_ids > 0 then 'transaction_id: ' || null_ids end, "
     "case when null_merchants > 0 then 'merchant_id: ' || null_merchants end, "
     "case when null_amounts > 0 then 'amount: ' || null_amounts end) || '}'"),
    ("amount_n", "'Amount domain violation: ' || amount_n || ' transactions with amount <= 0.'"),
    ("distance_n", "'Distance invariant violation: ' || distance_n || ' rows with negative distance.'"),
    ("user_n", "'Referential integrity failure: ' || user_n || ' transactions reference non-existent user_ids.'"),
    ("merchant_n", "'Referential integrity failure: ' || merchant_n || ' transactions reference non-existent merchant_ids.'"),
    ("label_n", "'Fraud label invalid: ' || label_n || ' rows with non-binary values.'"),
]

_SCALED = ["amount", "distance_from_home_km", "hour_of_day", "is_weekend", "is_night", "is_cross_border",
           "account_age_days", "kyc_verified", "baseline_spend", "amount_to_baseline_ratio",
           "chargeback_history_rate", "merchant_risk_score"]
_SLOTS = {"channel": ["api", "in_store", "mobile_app", "web"], "card_type": ["credit", "debit", "virtual_card"],
          "device_type": ["android", "ios", "linux", "macos", "windows"]}


def _scaled(column: str) -> str:
    z = f"({column} - avg({column}) over ()) / coalesce(nullif(stddev_pop({column}) over (), 0), 1)"
    return f"{_half_up(z, 6)} as scaled_{column}"


def _scaled_by_training(column: str) -> str:
    train = "filter (where not is_test) over ()"
    z = f"({column} - avg({column}) {train}) / coalesce(nullif(stddev_pop({column}) {train}, 0), 1)"
    return f"{_half_up(z, 6)} as scaled_{column}"


_SLOT_NAMES = _SCALED + [f"{c}_{v}" for c, values in _SLOTS.items() for v in values]
_ANSWERS = f"""select transaction_id, {_REASONS} as factors, 8 as version_length, true as in_range, true as decision_fits
    from enr"""
_BODIES: dict[str, str] = {
    "a1_landed_batch": f"select {_TX_COLUMNS}, 'batch_check' as batch_id from tx",
    "a2_snapshot_replaced": "select * from usr",
    "a3_scan_transactions": f"select {_TX_COLUMNS} from tx",
    "a3_scan_users": "select * from usr",
    "a3_scan_merchants": "select * from mer",
    "a4_silver_written_by_date": """select transaction_date, count(*) as n, sum(is_cross_border)::bigint as cross_border,
        sum(is_night)::bigint as night from fact group by transaction_date""",
    "a5_published_marts": """select 'dim_users' as mart, count(*) as row_count from usr
        union all select 'dim_merchants', count(*) from mer union all select 'fct_transactions', count(*) from tx
        union all select 'fct_fraud_incidents', count(*) from inc""",
    "a6_gold_export": "select * from inc",
    "a6_exported_users": "select * from du",
    "a6_exported_merchants": "select * from dm",
    "a6_exported_transactions": f"select {_FACT_COLUMNS} from fact",
    "a6_exported_incidents": "select * from inc",
    "a7_view_daily": _DAILY,
    "a7_view_categories": _CATEGORY,
    "a7_view_channels": _CHANNEL,
    "a7_view_sql": f"""select transaction_date, total_transactions, fraud_rate_pct, active_merchants
        from ({_DAILY}) where fraud_incident_count > 0""",
    "a8_registered_relations": """select u.country, count(*) as n, count(distinct t.user_id) as users
        from tx t join usr u on u.user_id = t.user_id group by u.country""",
    "a9_audit_ledger": """select (select count(*) from tx) as transaction_count, (select count(*) from customer) as users_count,
        (select count(*) from supplier) as merchants_count, (select sum(is_fraud)::bigint from tx) as fraud_count,
        'INGESTION_SUCCESS' as status""",
    "a10_content_checksum": f"""
        select row_count, digest_sum::varchar as digest_sum, sha256(row_count || '|' || digest_sum) as content_checksum
        from (select count(*) as row_count, sum(('0x' || substring(sha256({_ROW_TEXT}), 50, 15))::bigint)
            as digest_sum from tx)""",
    "a12_activity_scan": "select transaction_id, user_id, amount, timestamp, transaction_date from act",
    "a13_parsed_requests": """select transaction_id, user_id, merchant_id, amount, channel, card_type, device_type, country,
        distance_from_home_km, hour_of_day, violations, violations = '' as is_accepted from reqv""",
    "a13_rejected_requests": """select violation, count(*) as n from (
        select unnest(string_split(violations, '; ')) as violation from reqv where violations <> '') group by violation""",
    "b1_staging": "select * from stg",
    "b2_staging_filter": "select channel, count(*) as n from bad where transaction_id is not null and amount > 0 group by channel",
    "b3_temporal": "select transaction_id, hour_of_day, day_of_week, is_weekend from act",
    "b4_night_flag": "select hour_of_day, is_night, count(*) as n from act group by hour_of_day, is_night",
    "b5_silver_users": "select * from usr",
    "b5_silver_merchants": "select * from mer",
    "b5_silver_transactions": f"""select {_TX_COLUMNS}, hour_of_day, day_of_week, is_weekend, is_night, is_cross_border
        from fact""",
    "b6_fct_transactions": f"select {_FACT_COLUMNS} from fact",
    "b7_tenure_cohort": f"select user_id, {_TENURE} as user_cohort_tenure from usr",
    "b8_severity": "select severity_level, ops_status, count(*) as n from inc group by severity_level, ops_status",
    "b9_filtered_activity": "select transaction_id, transaction_date, channel, card_type, amount, is_fraud from fil",
    "b10_incident_queue": f"""select {_QUEUE} from inc where severity_level in ('CRITICAL', 'HIGH')
        and fraud_type in ('CARD_PROBING', 'VELOCITY_BURST') and fraud_amount >= 100""",
    "b10_empty_choice_selects_none": """select count(*) as incidents, 0 as none_chosen,
        count(*) filter (where severity_level = 'CRITICAL' and fraud_amount >= 100) as chosen from inc""",
    "b11_fraud_subset": "select transaction_id, amount from tx where is_fraud = 1",
    "b11_legit_subset": "select transaction_id, amount from tx where is_fraud = 0",
    "b12_merchant_portfolio": """select merchant_name, category, total_processed_volume, empirical_fraud_rate, fraud_tx_count
        from dm""",
    "b13_kyc_labels": """select user_id, case kyc_verified when 0 then 'Unverified (No KYC)' when 1 then 'KYC Verified' end
        as status_label from usr""",
    "c1_dim_users": "select * from du",
    "c2_dim_merchants": "select * from dm",
    "c3_fraud_incidents": "select * from inc",
    "c4_category_join": f"select category, total_tx_count, total_volume from ({_CATEGORY})",
    "c5_cross_border": """select b.transaction_id, b.user_id, b.country,
        case when u.user_id is not null and b.country is distinct from u.country then 1 else 0 end as is_cross_border
        from bad b left join usr u on u.user_id = b.user_id""",
    "c6_feature_join": """select b.transaction_id, b.user_id, b.merchant_id, u.account_age_days, u.kyc_verified, u.baseline_spend,
        u.country as country_user, m.risk_tier, coalesce(m.chargeback_history_rate, 0.01::double) as chargeback_history_rate
        from bad b left join usr u on u.user_id = b.user_id left join mer m on m.merchant_id = b.merchant_id""",
    "c7_fact_with_velocity": """
        select t.transaction_id, t.user_id, t.merchant_id, t.amount, t.currency, t.timestamp as transaction_timestamp,
          date_trunc('day', t.timestamp)::timestamp as transaction_date, t.channel, t.card_type, t.device_type,
          t.country as transaction_country, t.distance_from_home_km,
          cast(extract(hour from t.timestamp) as integer) as hour_of_day,
          extract(dow from t.timestamp) in (0, 6) as is_weekend,
          v.tx_count_last_1h, v.total_spend_last_24h, v.seconds_since_prev_tx, t.is_fraud, t.fraud_type
        from dedup t left join (
          select transaction_id,
            count(transaction_id) over (partition by user_id order by timestamp
              range between interval 1 hour preceding and current row) as tx_count_last_1h,
            cast(sum(cast(amount as decimal(18,2))) over (partition by user_id order by timestamp
              range between interval 24 hour preceding and current row) as double) as total_spend_last_24h,
            (epoch_us(timestamp) - epoch_us(lag(timestamp) over (partition by user_id order by timestamp, transaction_id)))
              / 1000000.0::double as seconds_since_prev_tx
          from dedup) v on v.transaction_id = t.transaction_id
        where t.transaction_id is not null and t.amount > 0""",
    "c8_incidents_of_activity": "select * from inc where transaction_id in (select transaction_id from fil)",
    "c9_orphan_users": "select count(*) as orphans from bad b where not exists (select 1 from usr u where u.user_id = b.user_id)",
    "c10_orphan_merchants": """select count(*) as orphans from bad b
        where not exists (select 1 from mer m where m.merchant_id = b.merchant_id)""",
    "c11_profile_lookup": """select transaction_id, account_age_days, kyc_verified, baseline_spend, home_country, risk_tier,
        chargeback_history_rate from enr""",
    "d1_user_metrics": _user_metrics("tx"),
    "d1_user_metrics_lines": _user_metrics("dup"),
    "d2_merchant_metrics": f"""select merchant_id, count(transaction_id) as total_processed_tx,
        {_money('amount')} as total_processed_volume, cast(sum(is_fraud) as bigint) as fraud_tx_count,
        {_money('case when is_fraud = 1 then amount else 0 end')} as total_fraud_volume from tx group by merchant_id""",
    "d3_fraud_rate": "select merchant_id, empirical_fraud_rate from dm",
    "d4_daily_kpis": _DAILY,
    "c1_bucketed_users": "select * from du",
    "c6_bucketed_profiles": """select f.transaction_id, f.user_id, f.amount / greatest(1.0::double, u.baseline_spend)
        as amount_to_baseline_ratio, case when f.country is distinct from u.country then 1 else 0 end as is_cross_border
        from tx f join usr u on u.user_id = f.user_id""",
    "d1_incremental_users": "select * from du",
    "d2_incremental_merchants": "select * from dm",
    "d4_incremental_days": _DAILY,
    "d9_weekly_actives": """select cast(date_trunc('week', timestamp) as date) as period_start, count(distinct user_id) as exact_users,
        count(distinct merchant_id) as exact_merchants, true as users_close, true as merchants_close from act group by 1""",
    "h6_batch_stamps": """select transaction_id, 'batch_' || strftime(timestamp, '%Y%m%d_%H%M%S') || '_' || channel as batch_id,
        strftime(timestamp, '%Y-%m-%dT%H:%M:%S') || case when extract(microsecond from timestamp) % 1000000 <> 0
        then '.' || strftime(timestamp, '%f') else '' end as landed_at from act""",
    "d5_category_risk": _CATEGORY,
    "d6_channel_metrics": _CHANNEL,
    "d7_dim_users_staged": f"""
        select u.*, coalesce(a.n, 0) as total_transactions, coalesce(a.spend, 0.0) as total_lifetime_spend,
          coalesce({_half_up('a.spend / a.n', 2)}, 0.0) as avg_transaction_spend,
          coalesce(a.frauds, 0) as fraud_incident_count, a.last_at as last_active_at, {_TENURE} as user_cohort_tenure
        from usr u left join (
          select user_id, count(*) as n, {_money('amount')} as spend, cast(sum(is_fraud) as bigint) as frauds,
            max(transaction_timestamp) as last_at from stg group by user_id) a on a.user_id = u.user_id""",
    "d8_kpi_card": f"""select count(*) as total_tx_count, {_money('amount')} as total_gmv,
        cast(sum(is_fraud) as bigint) as fraud_count,
        {_money('case when is_fraud = 1 then amount else 0 end')} as fraud_dollars,
        sum(is_fraud)::double / greatest(1, count(*)) * 100 as fraud_rate,
        {_money('amount')} / greatest(1, count(*)) as avg_ticket,
        count(distinct user_id) as active_users, count(distinct merchant_id) as active_merchants from fil""",
    "d9_daily_trend": f"""select transaction_date, {_money('amount')} as total_gmv,
        {_money('case when is_fraud = 1 then amount else 0 end')} as fraud_gmv, count(transaction_id) as tx_count
        from fil group by transaction_date""",
    "d10_channel_share": f"""select channel, {_money('amount')} as volume,
        {_money('amount')} / (select {_money('amount')} from fil) as volume_share from fil group by channel""",
    "d11_card_type_risk": f"""select *, fraud_gmv / case when total_gmv = 0 then 1 else total_gmv end * 100 as fraud_rate_pct
        from (select card_type, {_money('amount')} as total_gmv,
          {_money('case when is_fraud = 1 then amount else 0 end')} as fraud_gmv from fil group by card_type)""",
    "d12_device_activity": """select device_type, count(*) as tx_count, cast(sum(is_fraud) as bigint) as fraud_count
        from fil group by device_type""",
    "d13_cohort_value": f"""select user_cohort_tenure, count(user_id) as user_count,
        {_money('total_lifetime_spend')} / count(*) as avg_lifetime_spend,
        cast(sum(total_transactions) as double) / count(*) as avg_tx_count,
        count(*) filter (where total_fraud_incidents > 0) as fraud_user_count,
        count(*) filter (where total_fraud_incidents > 0)::double / count(*) * 100 as compromise_rate_pct
        from du group by user_cohort_tenure""",
    "d14_kyc_split": f"""select kyc_verified, count(*) as user_count, {_money('total_lifetime_spend')} / count(*) as avg_spend,
        cast(sum(total_fraud_incidents) as bigint) as total_fraud,
        case kyc_verified when 0 then 'Unverified (No KYC)' when 1 then 'KYC Verified' end as status_label
        from du group by kyc_verified""",
    "d15_mart_counts": """select 'dim_users' as mart, count(*) as row_count from usr
        union all select 'dim_merchants', count(*) from mer union all select 'fct_transactions', count(*) from tx
        union all select 'fct_fraud_incidents', count(*) from inc""",
    "d16_fraud_type_counts": "select fraud_type, count(*) as n from tx group by fraud_type",
    "d17_distance_histogram": _histogram("act", "distance_from_home_km", 35, "is_fraud", "is_fraud"),
    "d18_score_histogram": _histogram("rs", "score", 30, "score >= 0.5", "flagged"),
    "d19_flagging_kpis": f"""select count(*) as total_transactions, count(*) filter (where score >= 0.5) as flagged_count,
        count(*) filter (where score >= 0.5)::double / count(*) * 100 as flagged_pct,
        coalesce({_money('case when score >= 0.5 then amount end')}, 0.0) as flagged_amount,
        sum(floor(score * 10000 + 0.5)::bigint)::double / count(*) / 10000.0::double as avg_score from rs""",
    "d20_batch_counts": """select count(*) as transaction_count, cast(sum(is_fraud) as bigint) as fraud_count,
        (select count(*) from customer) as users_count, (select count(*) from supplier) as merchants_count from tx""",
    "d21_filter_domains": """select distinct 'channel' as domain, channel as value from tx
        union all select distinct 'card_type', card_type from tx union all select distinct 'fraud_type', fraud_type from tx
        union all select 'min_date', min(timestamp)::date::varchar from tx
        union all select 'max_date', max(timestamp)::date::varchar from tx
        union all select 'max_amount', ceil(max(amount))::bigint::varchar from tx""",
    "e1_tx_count_1h": "select transaction_id, tx_count_last_1h from vel",
    "e2_spend_24h": "select transaction_id, total_spend_last_24h from vel",
    "e3_previous_time": "select transaction_id, prev_tx_timestamp from vel",
    "e4_seconds_since": "select transaction_id, seconds_since_prev_tx from vel",
    "e_velocity": "select * from vel",
    "e_velocity_split_users": "select * from vel",
    "f1_ordered_daily": f"select row_number() over (order by transaction_date)::int as position, transaction_date, total_gmv from ({_DAILY})",
    "f1_ordered_categories": f"""select row_number() over (order by total_fraud_volume desc, category)::int as position,
        category, total_fraud_volume from ({_CATEGORY})""",
    "f1_ordered_channels": f"""select row_number() over (order by total_volume desc, channel)::int as position,
        channel, total_volume from ({_CHANNEL})""",
    "f2_largest_incidents": f"""select {_QUEUE} from inc where fraud_amount >= 100
        order by fraud_amount desc, transaction_id limit 100""",
    "f3_highest_scores": "select transaction_id, amount, score from rs order by score desc, transaction_id limit 50",
    "f5_fixed_sample": "select transaction_id, amount from sample",
    "f6_first_users": "select user_id from usr order by user_id limit 25",
    "f6_first_merchants": "select merchant_id from mer order by merchant_id limit 25",
    "g1_keep_first": "select * from dedup",
    "g2_surplus_rows": "select count(*) - count(distinct transaction_id) as surplus from dup",
    "g3_batches_as_one_table": """select 'batch_one' as batch_id, count(*) as n, sum(is_fraud)::bigint as fraud_count from tx
        union all select 'batch_two', count(*), sum(is_fraud)::bigint from dup""",
    **{
        f"i{no}_{name}": f"select {column} as violations, {column} = 0 as passed from gate"
        for no, (name, column) in enumerate([
            ("unique_transaction_id", "dup_n"), ("not_null_critical", "null_n"), ("positive_amount", "amount_n"),
            ("non_negative_distance", "distance_n"), ("known_user", "user_n"), ("known_merchant", "merchant_n"),
            ("binary_label", "label_n")], 1)
    },
    "i2_null_counts": """select count(*) filter (where transaction_id is null) as transaction_id,
        count(*) filter (where user_id is null) as user_id, count(*) filter (where merchant_id is null) as merchant_id,
        count(*) filter (where amount is null or isnan(amount)) as amount, count(*) filter (where timestamp is null) as timestamp from bad""",
    "i8_gate_summary": f"""select 7 as checks_run, failures = '' as passed, total as total_records_tested, failures,
        case when failures = '' then 'PASSED' else 'FAILED' end as status from (select total, concat_ws(' / ',
        {', '.join(f"case when {c} > 0 then {m} end" for c, m in _MESSAGES)}) as failures from gate)""",
    "i9_halted_run": f"""select 'FAILED' as run_status, 'bronze_ingestion, quality_gates' as stages, 'FAILED' as gate_status,
        {' + '.join(f'({c} > 0)::int' for c, _ in _MESSAGES)} as failures from gate""",
    "i8_gate_summary_clean": """select 7 as checks_run, true as passed, count(*) as total_records_tested, '' as failures,
        'PASSED' as status from txc""",
    "i10_unique": """select count(*) as violations from (
        select transaction_id from bad where transaction_id is not null group by transaction_id having count(*) > 1)""",
    "i11_not_null": "select count(*) as violations from bad where merchant_id is null",
    "i12_accepted_values": "select count(distinct is_fraud) as violations from bad where is_fraud not in (0, 1)",
    "i_fact_contract": """select *, violations = 0 as passed from (
        select 'unique' as rule, 'transaction_id' as subject, (select count(*) from (select transaction_id from bad
          where transaction_id is not null group by transaction_id having count(*) > 1)) as violations
        union all select 'not_null', 'transaction_id', count(*) filter (where transaction_id is null) from bad
        union all select 'not_null', 'user_id', count(*) filter (where user_id is null) from bad
        union all select 'not_null', 'amount', count(*) filter (where amount is null) from bad
        union all select 'accepted_values', 'channel', count(distinct channel) filter
          (where channel not in ('mobile_app', 'web', 'in_store', 'api')) from bad
        union all select 'accepted_values', 'is_fraud', count(distinct is_fraud) filter (where is_fraud not in (0, 1)) from bad)""",
    "i_user_contract": """select *, violations = 0 as passed from (
        select 'unique' as rule, 'user_id' as subject, count(*) - count(distinct user_id) as violations from usr
        union all select 'not_null', 'user_id', count(*) filter (where user_id is null) from usr
        union all select 'not_null', 'email', count(*) filter (where email is null) from usr)""",
    "j1_features": "select * exclude (is_fraud) from feat",
    "j2_baseline_ratio": "select transaction_id, amount_to_baseline_ratio from feat",
    "j3_merchant_risk": """select m.risk_tier, case m.risk_tier when 'Low' then 0.1::double when 'Medium' then 0.5::double
        when 'High' then 0.9::double else 0.2::double end as merchant_risk_score, count(*) as n
        from bad b left join mer m on m.merchant_id = b.merchant_id group by m.risk_tier""",
    "j5_derived_flags": f"""select b.transaction_id, b.user_id, cast(extract(hour from b.timestamp) as integer) as hour_of_day,
        case when extract(isodow from b.timestamp) in (6, 7) then 1 else 0 end as is_weekend,
        case when extract(hour from b.timestamp) < 6 or extract(hour from b.timestamp) > 22 then 1 else 0 end as is_night,
        case when b.country is distinct from u.country then 1 else 0 end as is_cross_border
        from bad b left join usr u on u.user_id = b.user_id""",
    "j6_imputed": """select b.transaction_id, b.merchant_id,
        case when b.distance_from_home_km >= 0 then b.distance_from_home_km else 10.0::double end as distance_from_home_km,
        coalesce(m.chargeback_history_rate, 0.01::double) as chargeback_history_rate
        from bad b left join mer m on m.merchant_id = b.merchant_id""",
    "j7_scaled": f"select transaction_id, {', '.join(map(_scaled, _SCALED))} from feat",
    "j8_one_hot": "select transaction_id, " + ", ".join(
        f"({c} = '{v}')::int as {c}_{v}" for c, values in _SLOTS.items() for v in values) + " from feat",
    "j9_feature_slots": f"""select transaction_id, unnest([{', '.join(f"'{n}'" for n in _SLOT_NAMES)}]) as slot,
        unnest([{', '.join([f'scaled_{c}' for c in _SCALED] + [f"({c} = '{v}')::int::double" for c, vs in _SLOTS.items() for v in vs])}])
        as value from (select transaction_id, {', '.join(_SLOTS)}, {', '.join(map(_scaled, _SCALED))} from feat)""",
    "j10_transformed_test_rows": f"""select transaction_id, {', '.join(f'scaled_{c}' for c in _SCALED)} from (
        select f.transaction_id, s.is_test, {', '.join(_scaled_by_training(c) for c in _SCALED)}
        from feat f join split s on s.transaction_id = f.transaction_id) where is_test""",
    "a9_audit_checksum": f"""select sha256(row_count || '|' || digest_sum) as content_checksum, true as path_fits
        from (select count(*) as row_count, sum(('0x' || substring(sha256({_ROW_TEXT}), 50, 15))::bigint) as digest_sum from tx)""",
    "a14_bundle_slots": f"select unnest([{', '.join(f"'{n}'" for n in _SLOT_NAMES)}]) as feature, true as valid",
    "j20_importance_order": "select i::int as position, true as falls from range(1, 13) t(i)",
    "j13_score_checks": "select transaction_id, true as in_range, true as label_fits from feat",
    "j21_run_counts": f"""select count(*) filter (where not is_test) as train_samples, count(*) filter (where is_test) as test_samples,
        {_half_up('avg(is_fraud) filter (where not is_test)', 4)} as fraud_ratio_train,
        {_half_up('(count(*) filter (where not is_test) - sum(is_fraud) filter (where not is_test))::double '
                  '/ greatest(sum(is_fraud) filter (where not is_test), 1) * 0.75::double', 2)} as pos_weight,
        5 as top_features from split""",
    "p2_metrics_recomputed": """select unnest(['roc_auc', 'average_precision', 'precision', 'recall', 'f1_score',
        'true_positives', 'false_positives', 'true_negatives', 'false_negatives']) as metric, true as agrees""",
    "p2_quality_bounds": """select unnest(['roc_auc', 'average_precision', 'f1_score', 'recall', 'precision']) as metric,
        unnest([0.9, 0.8, 0.7, 0.7, 0.6])::double as bound, true as reached""",
    "p2_tested_rows": "select transaction_id, is_fraud from split where is_test",
    "k4_answer_checks": _ANSWERS,
    "p4_stored_answer_checks": _ANSWERS,
    "j11_stratified_split": "select * from split",
    "j12_class_weight": f"""select count(*) as train_samples, cast(sum(is_fraud) as bigint) as fraud_samples,
        {_half_up('sum(is_fraud)::double / count(*)', 4)} as fraud_ratio,
        {_half_up('(count(*) - sum(is_fraud))::double / greatest(sum(is_fraud), 1) * 0.75::double', 2)} as pos_weight from tx""",
    "j15_roc_auc": f"""select {_half_up('sum(neg * (2 * (above_pos - pos) + pos))::double / (max(all_pos)::double * max(all_neg) * 2)', 6)}
        as roc_auc from step_rule""",
    "j16_average_precision": f"""select {_half_up('sum((pos / all_pos)::double * (above_pos / (above_pos + above_neg))::double)', 6)}
        as average_precision from step_rule""",
    "j17_precision_recall_f1": f"""select true_positives::double / (true_positives + false_positives) as precision,
        true_positives::double / (true_positives + false_negatives) as recall,
        (2 * true_positives)::double / (2 * true_positives + false_positives + false_negatives) as f1_score
        from ({_CONFUSION})""",
    "j18_confusion": _CONFUSION,
    "j19_pr_curve": _pr("rule"),
    "j19_pr_curve_sliced": _pr("dist"),
    "k1_enriched_requests": f"select transaction_id, {', '.join(_SCALED)}, risk_tier, home_country from enr",
    "k2_reason_codes": f"select transaction_id, {_REASONS} as factors from enr",
    "k3_decisions": f"select transaction_id, score, {_DECISION} as decision, {_TIER} as risk_tier from enrs",
    "k5_batch_summary": f"""select count(*) as total_processed,
        count(*) filter (where {_DECISION} in ('DECLINE_FRAUD', 'MANUAL_REVIEW')) as flagged_count from enrs""",
    "k6_analyst_reasons": f"""select transaction_id, concat_ws('; ',
        case when amount_to_baseline_ratio > 4.0 then 'Amount is ' || {_fixed('amount_to_baseline_ratio', 1)}
          || 'x higher than customer typical spend ($' || {_fixed('baseline_spend', 2)} || ')' end,
        case when distance_from_home_km > 2000.0 then 'Abnormal distance: ' || {_fixed('distance_from_home_km', 1)}
          || ' km away from cardholder registered home' end,
        case when is_night = 1 then 'Late-night activity window (' || hour_of_day || ':00)' end,
        case when is_cross_border = 1 then 'Cross-border transaction (' || country
          || ') does not match home country (' || home_country || ')' end,
        case when risk_tier = 'High' then 'Merchant is high-risk category: ' || category end) as factors from enr""",
    "k7_rule_score": "select transaction_id, score from rs",
    "k8_flagged": "select transaction_id, score >= 0.35 as predicted_fraud from rs",
    "l1_psi": f"select feature, {_half_up('psi', 4)} as psi_score from psi_big",
    "l2_quantile_buckets": "select feature, bucket::integer as bucket, n_ref, n_cur from buck_big",
    "l2_quantile_edges": "select feature, (i - 1)::integer as edge_no, edge from edge_big",
    "l3_ks_statistic": f"select feature, {_half_up('ks', 6)} as ks_statistic from far_big",
    "l_profile_drift": """select feature, sum(n_ref)::bigint as n_ref, sum(n_cur)::bigint as n_cur, true as ks_close,
        true as same_verdict from buck_big group by feature""",
    "l4_ks_p_value": f"select feature, {_half_up('p', 5)} as p_value from pv_halves",
    "l5_wasserstein": f"select feature, {_half_up('w1', 4)} as wasserstein_distance from far_big",
    "l5_wasserstein_sliced": f"""select feature, {_half_up('w1', 4)} as wasserstein_distance,
        {_half_up('ks', 6)} as ks_statistic from far_big""",
    "l6_verdicts": "select feature, drifting as drift_detected from met_all",
    "l7_severity": "select feature, severity from met_all",
    "l8_drift_report": """select case when bool_or(drifting) then 'DRIFT_ALERT' else 'STABLE' end as overall_status,
        (select count(*) from act) as reference_sample_size, (select count(*) from feat) as current_sample_size,
        count(*) filter (where drifting) as drifting_features_count,
        coalesce(string_agg(feature, ', ' order by feature) filter (where drifting), '') as drifting_features from met_all""",
    "l9_shared_features": "select feature from met_all",
    "l10_flat_report": f"""select feature as feature_name, {_half_up('ks', 4)} as ks_statistic, {_half_up('p', 5)} as p_value,
        {_half_up('psi', 4)} as psi_score, case when drifting then 'Alert' else 'Stable' end as drift_status,
        severity as severity_tier from met_all""",
    "l11_perturbed_sample": "select transaction_id, amount from sampx",
    "m1_policy_response": "select point, rec as recall, fpr as false_positive_rate from tauf",
    "m2_policy_point": f"select {_OUTCOME} from tau where policy = 'Balanced'",
    "m3_frontier": "select point, threshold, dollars * rec - legit * fpr * 25.0::double as net_savings from tauf",
    "m4_named_policies": f"select policy, {_OUTCOME} from tau",
    "n1_stream_landing": """select count(*) as transaction_count, sum(is_fraud)::bigint as fraud_count,
        (select count(*) from customer) as users_count, (select count(*) from supplier) as merchants_count from tx""",
    "n2_stream_deduplicated": "select transaction_id, user_id, amount, timestamp from tx",
    "n3_stream_daily_kpis": f"""select * exclude (active_transacting_users, active_merchants), true as users_close,
        true as merchants_close from ({_DAILY})""",
    "n4_stream_scoring": f"""select transaction_id, score as fraud_probability, {_DECISION} as decision, {_TIER} as risk_tier,
        {_REASONS} as factors, 'rules' as model_version
        from (select r.*, r.amount / greatest(1.0::double, u.baseline_spend) as amount_to_baseline_ratio, m.risk_tier
          from rs r join usr u on u.user_id = r.user_id join mer m on m.merchant_id = r.merchant_id where r.amount > 0)""",
    "n4_current_versions": """select transaction_id, u.baseline_spend * case when extract(day from t.timestamp) <= 15 then 1 else 2 end
        as baseline_spend from tx t join usr u on u.user_id = t.user_id""",
    "n5_stream_velocity": """select transaction_id, tx_count_last_1h, total_spend_last_24h, prev_tx_timestamp,
        seconds_since_prev_tx from vel""",
    "p1_medallion_job": """select 'SUCCESS' as run_status, * from (
        select 'bronze_ingestion' as stage, 'COMPLETED' as stage_status, 'records_ingested' as item, count(*) as n from txc
        union all select 'bronze_ingestion', 'COMPLETED', 'fraud_records', sum(is_fraud)::bigint from txc
        union all select 'quality_gates', 'PASSED', 'checks_run', 7
        union all select 'silver_transformation', 'COMPLETED', 'transactions', count(*) from txc
        union all select 'silver_transformation', 'COMPLETED', 'users', count(*) from usr
        union all select 'silver_transformation', 'COMPLETED', 'merchants', count(*) from mer
        union all select 'gold_warehouse', 'COMPLETED', 'dim_users', count(*) from usr
        union all select 'gold_warehouse', 'COMPLETED', 'dim_merchants', count(*) from mer
        union all select 'gold_warehouse', 'COMPLETED', 'fct_transactions', count(*) from txc
        union all select 'gold_warehouse', 'COMPLETED', 'fct_fraud_incidents', count(*) from inc)""",
    "p3_drift_job": f"""select feature as feature_name, {_half_up('ks', 4)} as ks_statistic, {_half_up('p', 5)} as p_value,
        {_half_up('psi', 4)} as psi_score, case when drifting then 'Alert' else 'Stable' end as drift_status,
        severity as severity_tier from met_scaled""",
}

ORACLES: dict[str, str] = {name: _sql(body) for name, body in _BODIES.items()}
