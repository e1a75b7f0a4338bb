"""The same results in DuckDB SQL, from the same view texts."""

from __future__ import annotations

from txflow.registry import views

_TX = f"with tx as ({views.TX})"
_SIGHTINGS = f"with s as ({views.SIGHTINGS})"
_FULL = ("coalesce(try_strptime(upper(trim({0})), ['%m/%d/%Y %H:%M:%S', '%m/%d/%Y %H:%M', '%m/%d/%Y %I:%M:%S %p',"
         " '%m/%d/%Y %I:%M %p', '%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S', '%Y-%m-%d %H:%M', '%Y-%m-%dT%H:%M',"
         " '%d-%m-%Y %H:%M:%S', '%d-%m-%Y %H:%M', '%Y/%m/%d %H:%M:%S', '%Y/%m/%d %H:%M', '%m/%d/%Y', '%Y-%m-%d',"
         " '%Y/%m/%d', '%d-%m-%Y']))")
_PARSED = _FULL.format("trans_date_trans_time")
_FLAG = ("case when lower(is_fraud) in ('true','yes','y','t','1') then 1"
         " when lower(is_fraud) in ('false','no','n','f','0') then 0 else try_cast(is_fraud as int) end")
_ISO = r"regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\.?0+$', '') || 'Z'"


def _bad(column: str, cast: str) -> str:
    return f"(coalesce(trim({column}), '') <> '' and {cast} is null)"


_CHECKS = [("amt", "try_cast(amt as double)"), ("lat", "try_cast(lat as double)"), ("long", "try_cast(long as double)"),
           ("latitude", "try_cast(latitude as double)"), ("longitude", "try_cast(longitude as double)"),
           ("city_pop", "try_cast(city_pop as int)"), ("is_fraud", f"({_FLAG})")]
_FAILED = "concat_ws(',', " + ", ".join(f"case when {_bad(c, x)} then '{c}' end" for c, x in _CHECKS) + ")"

# Records judged: failed casts first, else every missing key.
_JUDGED = f"""
with raw as ({views.RAW}),
cast_done as (select *, {_FAILED} as failed, {_PARSED} as parsed, try_cast(amt as double) as amount from raw),
judged as (
  select *, case when failed <> '' then failed else concat_ws(',',
           case when parsed is null then 'trans_date_trans_time' end, case when trans_num is null then 'trans_num' end,
           case when amount is null then 'amt' end) end as failed_fields,
         case when failed <> '' then 'CastMismatch'
              when parsed is null or trans_num is null or amount is null then 'MissingKey' end as error_type
  from cast_done)"""

# What each sighting leaves behind, per record number.
_FOLD = f"""
with s as ({views.SIGHTINGS}),
f as (
  select trans_num, count(*) as n,
         arg_min(struct_pack(source := source, ts := ts, is_fraud := is_fraud, city := city, state := state,
                 city_pop := city_pop, lat := lat, cardholder_lat := cardholder_lat,
                 cardholder_long := cardholder_long, job := job, at := ingested_at), seq) as a,
         arg_max(struct_pack(amount := amount, at := ingested_at), seq) as z,
         arg_max(struct_pack(ts := ts, is_fraud := is_fraud, file := file), seq) filter (where source = 'batch') as b,
         arg_max(struct_pack(category := category, channel := channel, state := state), seq)
           filter (where source = 'kafka') as k
  from s group by trans_num),
t as (
  select trans_num, a.source as source, case when b is not null then b.ts else a.ts end as ts, z.amount as amount,
         case when b is not null then b.is_fraud else a.is_fraud end as is_fraud, k.category as category,
         k.channel as channel, a.city as city, case when k is not null then k.state else a.state end as state,
         case when a.source = 'batch' then a.city_pop end as city_pop, case when a.source = 'batch' then a.lat end as lat,
         case when a.source = 'kafka' then a.cardholder_lat end as cardholder_lat,
         case when a.source = 'kafka' then a.cardholder_long end as cardholder_long,
         case when a.source = 'kafka' then a.job end as job, b.file as file, a.at as ingested_at,
         case when n > 1 then z.at end as updated_at
  from f)"""
_FOLDED = _FOLD + """
select trans_num, source, epoch_us(ts) as ts, round(amount, 6) as amount, is_fraud, category, channel, city, state,
       city_pop, round(lat, 6) as lat, round(cardholder_lat, 6) as cardholder_lat, job, file,
       epoch_us(ingested_at) as ingested_at, epoch_us(updated_at) as updated_at from t"""

_BY_LOAD = _SIGHTINGS + """, l as (select trans_num, seq, case when source = 'batch' then 'files'
        when channel = 'APP' then 'late' else 'stream' end as load from s),
      p as (select load, trans_num, min(seq) as first from l group by 1, 2),
      o as (select *, min(first) filter (where load = 'late') over k as a, min(first) filter (where load = 'files') over k as b
            from p window k as (partition by trans_num)),
      c as (select load, case load when 'late' then true when 'files' then a is null or first < a
            else (a is null or first < a) and (b is null or first < b) end as made from o)
      select load, count(*) as total, count(*) filter (where made) as created,
             count(*) filter (where not made) as updated from c group by load"""

_CARDHOLDERS = """
  select cardholder_id, arg_min(struct_pack(v := dob), seq).v as dob,
         arg_min(job, seq) filter (where job is not null) as job,
         case when count(*) > 1 then arg_max(ingested_at, seq) end as updated_at
  from s where cardholder_id is not null and merchant_id is not null group by cardholder_id"""
_MERCHANTS = """
  select merchant_id, cast(null as string) as name, arg_min(struct_pack(v := merchant_lat), seq).v as latitude,
         arg_min(struct_pack(v := merchant_long), seq).v as longitude,
         arg_min(struct_pack(v := city), seq).v as city, arg_min(struct_pack(v := state), seq).v as state,
         case when count(*) > 1 then arg_max(ingested_at, seq) end as updated_at
  from s where cardholder_id is not null and merchant_id is not null group by merchant_id"""
_FLAT = _FOLD + f""",
c as ({_CARDHOLDERS}), m as ({_MERCHANTS}),
p as (select distinct cardholder_id, trans_num from s where cardholder_id is not null and merchant_id is not null),
q as (select distinct merchant_id, trans_num from s where cardholder_id is not null and merchant_id is not null),
flat as (
  select t.trans_num as Transaction_key, {_ISO.replace('ts,', 't.ts,')} as transdatetrans_time,
         coalesce(m.name, m.merchant_id) as merchant, t.category, t.amount as amt, coalesce(t.city, m.city) as city,
         coalesce(t.state, m.state) as state, t.cardholder_lat as lat, t.cardholder_long as long, t.city_pop,
         c.job, c.dob, t.trans_num, m.latitude as merch_lat, m.longitude as merch_long, t.is_fraud, t.ts as _ts
  from p join t using (trans_num) join q using (trans_num) join m using (merchant_id) join c using (cardholder_id))
select * exclude (_ts) from flat order by _ts asc nulls last, trans_num asc nulls last, merchant, dob"""


_SHARED = _TX + """, e as (select distinct cardholder_id, merchant_id, cast(event_id // 25 as varchar) as trans_num from tx
        where cardholder_id is not null and merchant_id is not null)
  select p.cardholder_id, trans_num, q.merchant_id from (select distinct cardholder_id, trans_num from e) p
  join (select distinct merchant_id, trans_num from e) q using (trans_num)"""

# Payments as they are dealt: the second half brings a fiftieth of the first, too late but for its last hour.
_DEALT = _TX + """, mid as (select (epoch_us(min(ts)) + epoch_us(max(ts))) // 2 as at from tx),
b as (select tx.*, epoch_us(ts) < mid.at and event_id % 50 <> 0 as first from tx, mid),
dealt as (select *, not first and epoch_us(ts) < (select max(epoch_us(ts)) from b where first) - 3600000000 as late from b),
last as (select (max(epoch_us(ts)) - 3600000000) // 1000 * 1000 as done from dealt where not late)"""


def _lag(rest: str) -> str:
    return _SIGHTINGS + """, l as (select trans_num as "transNum",
      cast(floor((epoch_us(ingested_at) - epoch_us(ts)) / 1000000) as bigint) as "ingestLagSeconds"
      from s where source = 'kafka') """ + rest


_LAG_DIST = _lag("""select count(*) as n, min("ingestLagSeconds") as min, max("ingestLagSeconds") as max,
  round(avg("ingestLagSeconds"), 6) as avg, """ + ", ".join(
    f'round(quantile_cont(cast("ingestLagSeconds" as double), {p / 100}), 6) as p{p}' for p in (50, 90, 95, 99))
    + " from l")


def _only(here: str, there: str) -> str:
    return f"""{_SIGHTINGS}, mine as (
      select trans_num as "transNum", round(arg_max(amount, seq), 6) as amount, epoch_us(arg_max(ts, seq)) as ts
      from s where source = '{here}' group by trans_num)
    select * from mine where not exists (
      select 1 from s where s.source = '{there}' and s.trans_num = mine."transNum")"""


def _velocity(seconds: int) -> str:
    # The frame's lower bound is exclusive, hence one microsecond less.
    return f"""{_TX} select trans_num, count(*) over (partition by cardholder_id order by ts
      range between interval {seconds * 1_000_000 - 1} microseconds preceding and current row) as tx_last_10m from tx"""


def _mad(key: str | None) -> str:
    pick, on = (f"{key}, ", f"using ({key})") if key else ("", "on true")
    group = f"group by {key}" if key else ""
    return f"""with tx as ({views.CARD_TX}), med as (select {pick}count(*) as n, median(amount) as med from tx {group}),
      mad as (select {pick}median(abs(amount - med)) as mad from tx join med {on} {group})
      select {pick}n, round(med, 6) as med, round(mad, 6) as mad from med join mad {on}"""


# Only finite amounts count; payments without a cardholder have no history.
_ODD_MAD = f"""with tx as (select category, amount from ({views.ODD_TX}) o where category is not null and isfinite(amount)),
  med as (select category, count(*) as n, median(amount) as med from tx group by category),
  mad as (select category, median(abs(amount - med)) as mad from tx join med using (category) group by category)
  select category, n, round(med, 6) as med, round(mad, 6) as mad from med join mad using (category)"""
_ODD_VELOCITY = f"""with tx as ({views.ODD_TX}) select trans_num, case when cardholder_id is null then 0
  else count(*) over (partition by cardholder_id order by ts
    range between interval 599999999 microseconds preceding and current row) end as tx_last_10m from tx"""


def _baseline(name: str, key: str | None, least: int) -> str:
    pick, on = (f"{key}, ", f"using ({key})") if key else ("", "on true")
    group = f"group by {key}" if key else ""
    return f"""{name}_c as (select {pick}count(*) as {name}_n, median(amount) as {name}_med from tx {group}
        having count(*) >= {least}),
      {name} as (select {pick}any_value({name}_n) as {name}_n, any_value({name}_med) as {name}_med,
        median(abs(amount - {name}_med)) as {name}_mad from tx join {name}_c {on} {group})"""


def _scored(mode: str = "left join", where: str = "") -> str:
    return f"""with tx as ({views.CARD_TX}),
      {_baseline('ch', 'cardholder_id', 5)}, {_baseline('cat', 'category', 30)}, {_baseline('g', None, 1)},
      v as (select *, count(*) over (partition by cardholder_id order by ts
        range between interval 599999999 microseconds preceding and current row) as tx_last_10m from tx),
      j as (select * from v {mode} ch using (cardholder_id) {mode} cat using (category) cross join g {where}),
      b as (select *,
        case when ch_n >= 5 then ch_med when cat_n >= 30 then cat_med else g_med end as base_med,
        case when ch_n >= 5 then ch_mad when cat_n >= 30 then cat_mad else g_mad end as raw_mad,
        case when ch_n >= 5 then 'cardholder' when cat_n >= 30 then 'category' else 'global' end as baseline_used
        from j),
      r as (select *, abs(amount - base_med) / (case when raw_mad is null or raw_mad = 0 then 1e-9
        when raw_mad < 0.25 then 0.25 else raw_mad end) as score from b),
      z as (select *, case when score > 25 then 25 else score end as raw_score from r)"""


_UC1_OUT = f""" select trans_num, {_ISO} as ts, cardholder_id as cardholder, merchant_id as merchant, category,
  round(amount, 6) as amount, baseline_used, round(raw_score, 6) as raw_score, tx_last_10m from z"""
_UC1_TOP = f""" select trans_num, {_ISO} as ts, cardholder_id as cardholder, merchant_id as merchant, category, amount,
  baseline_used, round(raw_score, 2) as amount_anomaly_score, tx_last_10m,
  round(0.7::double * raw_score + 0.3::double * tx_last_10m, 2) as combined_score, raw_score from z
  order by combined_score desc nulls first, amount_anomaly_score desc nulls first, trans_num, merchant limit 100"""


def _pairs(condition: str, most: float = 5) -> str:
    return f"""{_TX}, m as (select distinct a.cardholder_id, a.trans_num, a.ts from tx a where a.amount <= {most}
      and exists (select 1 from tx b where b.cardholder_id = a.cardholder_id and b.trans_num <> a.trans_num
        and b.amount <= {most} and b.merchant_id <> a.merchant_id {condition}))"""


def _near(seconds: int) -> str:
    return f"and abs(epoch_us(a.ts) - epoch_us(b.ts)) < {(seconds + 1) * 1_000_000}"


_LISTED = """ select cardholder_id as cardholder, string_agg(trans_num, ',' order by trans_num) as
  "suspiciousTransactions", count(*) as "burstCount" from m group by cardholder_id having count(*) >= 3"""
_PER_BURST = """, g as (select *, lag(epoch_us(ts)) over (partition by cardholder_id order by ts) as prev from m),
  r as (select *, sum(case when prev is null or epoch_us(ts) - prev >= 14401000000 then 1 else 0 end)
        over (partition by cardholder_id order by ts) as run from g)
  select cardholder_id as cardholder, epoch_us(min(ts)) as "burstStart",
         string_agg(trans_num, ',' order by trans_num) as "suspiciousTransactions", count(*) as "burstCount"
  from r group by cardholder_id, run having count(*) >= 3"""

_SCANNED = _TX + """ select trans_num, strftime(ts, '%Y-%m-%d %H:%M:%S') as trans_date_trans_time, amount as amt,
  category, 'Say "hi", ' || merchant_id as client from tx"""

_REJECTS = _JUDGED + """ select 'batch' as source, '2024-06-01' as ingest_date, error_type, failed_fields, trans_num,
  nullif(amt, '') as amt, nullif(trans_date_trans_time, '') as trans_date_trans_time from judged
  where error_type is not null"""

_HASH = "sha256(concat_ws('|', {}))"
_NORM = "lower(trim(coalesce({}, ''), ' \t'))"


def _hash(*parts: str) -> str:
    return _HASH.format(", ".join(_NORM.format(p) for p in parts))


_STREAMED = f"""with m as ({views.MESSAGES}) select trans_num, 'kafka' as source,
  epoch_us(date_trunc('second', ts)) as ts, k + 0.75 as amount, case when kind = 8 then 1 else 0 end as is_fraud,
  category, 'POS' as channel, concat('city', cast(k as string)) as city, 'CO' as state,
  case when kind = 8 then 5000 else cast(user_id as int) end as city_pop,
  k % 48 + 0.5 as cardholder_lat, cast(-71.5 as double) as cardholder_long, k % 48 + 0.25 as merchant_lat,
  cast(concat('-', cast(k as string), '.125') as double) as merchant_long, 'Nurse' as job,
  concat('1980-01-', cast(user_id as string)) as dob,
  {_hash("concat('1980-01-', cast(user_id as string))", "concat('city', cast(k as string))", "'CO'")} as cardholder_id,
  {_hash("concat(cast(k % 48 as string), '.25')", "concat('-', cast(k as string), '.125')",
         "concat('city', cast(k as string))", "'CO'")} as merchant_id,
  cast(event_id % 4 as int) as kafka_partition, event_id as kafka_offset,
  epoch_us(timestamp '2024-06-01 00:00:00') as ingested_at from m where kind >= 8 and kind <> 9"""
_REFUSED = f"""with m as ({views.MESSAGES}) select cast(event_id % 4 as int) as kafka_partition,
  event_id as kafka_offset, trans_num as kafka_key, epoch_us(ts) // 1000 as kafka_timestamp, body as raw_value,
  case kind when 4 then 'InvalidTimestamp' when 5 then 'JSONDecodeError' when 9 then 'SinkError'
    else 'ValidationError' end as error_type,
  case kind when 0 then 'amt' when 1 then 'trans_num' when 2 then 'long' when 3 then 'is_fraud'
    when 4 then 'trans_date_trans_time' when 5 then '' when 9 then '' else 'amt,is_fraud' end as failed_fields,
  'kafka-stream' as source, epoch_us(timestamp '2024-06-01 00:00:00') as "ingestedAt" from m where kind < 8 or kind = 9"""

_REPORT = f"""{_JUDGED}, s as (select * from ({views.THREE_DAYS}) d where cast(ingested_at as date) = date '2024-06-01'),
l as (select floor((epoch_us(ingested_at) - epoch_us(ts)) / 1000000) as lag from s where source = 'kafka'),
d as (select source, trans_num, count(*) as times from s group by source, trans_num having count(*) > 1),
x as (select unnest(string_split(failed_fields, ',')) as field, error_type from judged where error_type is not null),
nums as (select trans_num, bool_or(source = 'batch') as b, bool_or(source = 'kafka') as k from s group by trans_num),
metrics as (
  select 'records' as metric, source as dimension, cast(count(*) as double) as value from s group by source
  union all select 'rejected', 'batch', count(*) from judged where error_type is not null having count(*) > 0
  union all select 'duplicates', source, sum(times - 1) from d group by source
  union all select 'field_mismatch', concat('batch/', error_type, '/', field), count(*) from x group by error_type, field
  union all select 'batch_only', 'all', count(*) from nums where b and not k
  union all select 'stream_only', 'all', count(*) from nums where k and not b
  union all select 'lag_min', 'kafka', min(lag) from l union all select 'lag_max', 'kafka', max(lag) from l
  union all select 'lag_avg', 'kafka', avg(lag) from l
  union all select 'lag_p50', 'kafka', quantile_cont(lag, 0.5) from l
  union all select 'lag_p90', 'kafka', quantile_cont(lag, 0.9) from l
  union all select 'lag_p95', 'kafka', quantile_cont(lag, 0.95) from l
  union all select 'lag_p99', 'kafka', quantile_cont(lag, 0.99) from l),
rated as (select *, case when metric in ('duplicates', 'field_mismatch', 'batch_only', 'stream_only') then 0
  when metric = 'lag_p99' then 300 end as most from metrics),
judged2 as (select metric, dimension, value,
  case when value <= most then 'PASS' when value > most then 'FAIL' end as status from rated),
together as (select * from judged2 union all
  select 'summary', 'all', count(*) filter (where status = 'FAIL'),
         case when count(*) filter (where status = 'FAIL') = 0 then 'PASS' else 'FAIL' end from judged2)
select '2024-06-01' as dt, metric, dimension, round(value, 6) as value, status from together"""

_PAYLOAD = _JUDGED + f""" select trans_num as "transNum", cast(epoch(parsed) as bigint) as "tsEpoch",
      amount, {_FLAG} as "isFraud", city, state, try_cast(city_pop as int) as "cityPop", try_cast(lat as double) as lat,
      try_cast(long as double) as long, try_cast(latitude as double) as latitude,
      try_cast(longitude as double) as longitude, 'batch' as source,
      epoch_us(timestamp '2024-06-01 00:00:00') as "ingestedAt" from judged where error_type is null"""

ORACLES: dict[str, str] = {
    "count_by_source": _SIGHTINGS + " select source, count(*) as cnt from s group by source",
    "source_pivot": _SIGHTINGS + """ select count(*) filter (where source = 'batch') as "batchCount",
      count(*) filter (where source = 'kafka') as "streamCount" from s""",
    "batch_only": _only("batch", "kafka"),
    "stream_only": _only("kafka", "batch"),
    "batch_only_first500": f'select "transNum" from ({_only("batch", "kafka")}) order by "transNum" limit 500',
    "stream_only_first50": f'select "transNum" from ({_only("kafka", "batch")}) order by "transNum" limit 50',
    "ingest_lag_all": _lag("select * from l"),
    "ingest_lag_top": _lag('select * from l order by "ingestLagSeconds" desc nulls first, "transNum" limit 50'),
    "ingest_lag_dist": _LAG_DIST,
    "ingest_lag_dist_narrowed": _LAG_DIST,
    "dup_counts": _SIGHTINGS + """, d as (select source, trans_num, count(*) as times from s
      group by source, trans_num having count(*) > 1)
      select source, count(*) as numbers, cast(sum(times - 1) as bigint) as extra from d group by source""",
    "daily_counts": _SIGHTINGS + """ select cast(cast(ingested_at as date) as string) as dt, source, count(*) as cnt
      from s group by 1, 2""",
    "verify_load": _SIGHTINGS + """ select count(*) filter (where source = 'batch') as "batchCount" from s""",
    "accepted_lookup": _SIGHTINGS + """ select trans_num as "transNum", source, epoch_us(ingested_at) as "ingestedAt"
      from s where trans_num in ('1', '2', '3', '40', '500')""",
    "recon_summary": _REPORT,
    "report_roundtrip": _REPORT,
    "recon_summary_rollup": _REPORT,
    "lag_sketch_by_day": f"""with s as ({views.THREE_DAYS}) select cast(cast(ingested_at as date) as string) as dt, count(*) as n,
      true as p50, true as p90, true as p95, true as p99 from s where source = 'kafka' group by 1""",
    "fanout_sketch": _TX + """ select cardholder_id as cardholder, count(distinct merchant_id) as "merchantCount" from tx group by 1""",
    "only_sketch": _SIGHTINGS + """, n as (select trans_num, bool_or(source = 'batch') as b, bool_or(source = 'kafka') as k
        from s group by 1)
      select count(*) filter (where not k) as batch_only, count(*) filter (where not b) as stream_only, true as batch_near,
        true as stream_near from n""",
    "upsert_fold": _FOLDED,
    "upsert_incremental": _FOLDED,
    "upsert_stats": _FOLD + """ select count(*) as total, count(*) filter (where updated_at is null) as created,
      count(*) filter (where updated_at is not null) as updated from t""",
    "upsert_bucketed": _FOLDED,
    "paths_bucketed": _FOLD + """, p as (select distinct cardholder_id, merchant_id, trans_num from s
        where cardholder_id is not null and merchant_id is not null)
      select p.cardholder_id, q.merchant_id, trans_num, epoch_us(ts) as ts, round(amount, 6) as amount
      from (select distinct cardholder_id, trans_num from p) p join (select distinct merchant_id, trans_num from p) q
      using (trans_num) join t using (trans_num)""",
    "upsert_stats_by_load": _BY_LOAD,
    "upsert_stats_numbered_loads": f"""select * replace (case load when 'late' then '01' when 'files' then '1.0'
      else '2024-06-01' end as load) from ({_BY_LOAD})""",
    "cardholders": f"{_SIGHTINGS}, c as ({_CARDHOLDERS}) select * replace (epoch_us(updated_at) as updated_at) from c",
    "merchants": f"{_SIGHTINGS}, m as ({_MERCHANTS}) select * replace (epoch_us(updated_at) as updated_at) from m",
    "edges_performed": _SIGHTINGS + """ select distinct cardholder_id, trans_num from s
      where cardholder_id is not null and merchant_id is not null""",
    "edges_at_merchant": _SIGHTINGS + """ select distinct trans_num, merchant_id from s
      where cardholder_id is not null and merchant_id is not null""",
    "flatten_graph": _FLAT + " limit 1000",
    "flatten_graph_all": _FLAT,
    "flatten_graph_skewed": _FLAT,
    "paths_skewed": _SHARED,
    "paths_skewed_many": _SHARED,
    "graph_roundtrip": _FLAT,
    "merchant_fanout": _TX + """ select cardholder_id as cardholder, count(distinct merchant_id) as "merchantCount"
      from tx group by 1 order by 2 desc, 1 limit 20""",
    "merchant_fanout_all": _TX + """ select cardholder_id as cardholder,
      count(distinct merchant_id) as "merchantCount" from tx group by 1""",
    "velocity_10m": _velocity(600),
    "velocity_3d": _velocity(3 * 86400),
    "velocity_3d_by_clock": _velocity(3 * 86400),
    "mad_cardholder": _mad("cardholder_id"),
    "mad_category": _mad("category"),
    "mad_category_narrowed": _mad("category"),
    "mad_category_many": _mad("category"),
    "mad_global": _mad(None),
    "mad_global_narrowed": _mad(None),
    "uc1_anomaly": _scored() + _UC1_OUT,
    "uc1_as_written": _scored("join") + _UC1_OUT,
    "uc1_skewed": _scored() + _UC1_OUT,
    "uc1_skewed_many": _scored() + _UC1_OUT,
    "uc1_recent": _scored(where="where ts >= timestamp '1998-01-01 00:00:00'") + _UC1_OUT,
    "uc1_incremental": _scored() + _UC1_OUT,
    "uc1_incremental_skewed": _scored() + _UC1_OUT,
    "uc1_incremental_recent": _scored(where="where ts >= timestamp '1998-01-01 00:00:00'") + _UC1_OUT,
    "uc1_top100": _scored() + _UC1_TOP,
    "uc2_burst": _pairs(_near(14400)) + _LISTED,
    "uc2_as_written": _pairs("") + _LISTED,
    "uc2_by_clock": _pairs(_near(14400)) + _LISTED,
    "uc2_ten_minutes_members": _pairs(_near(600), 50) + " select cardholder_id, trans_num from m",
    "uc2_per_burst": _pairs(_near(14400)) + _PER_BURST,
    "uc2_per_burst_by_clock": _pairs(_near(14400)) + _PER_BURST,
    "uc2_burst_rows": _pairs(_near(14400)) + """, n as (select *, count(*) over (partition by cardholder_id) as c from m)
      select cardholder_id as cardholder, trans_num, c as "burstCount" from n where c >= 3""",
    "mad_odd_values": _ODD_MAD,
    "mad_odd_values_narrowed": _ODD_MAD,
    "velocity_unknown_cardholders": _ODD_VELOCITY,
    "velocity_unknown_cardholders_by_clock": _ODD_VELOCITY,
    "cast_mismatch": f"""with raw as ({views.RAW}) select trans_num, amt, lat, longitude, city_pop, is_fraud,
      {_FAILED} as failed, try_cast(amt as double) as amount, try_cast(city_pop as int) as population from raw""",
    "fraud_flag": f"""with raw as ({views.RAW}) select is_fraud, {_FLAG} as flag, count(*) as cnt from raw
      group by 1, 2""",
    "parse_timestamps": f"""with raw as ({views.RAW}), p as (select *, {_PARSED} as ts from raw)
      select trans_num, trans_date_trans_time, cast(epoch(ts) as bigint) as epoch,
      strftime(ts, '%Y-%m-%dT%H:%M:%S') as iso from p""",
    "validate_records": _JUDGED + """ select trans_num, trans_date_trans_time, amt, error_type, failed_fields
      from judged""",
    "mismatch_stats": _JUDGED + """, x as (select unnest(string_split(failed_fields, ',')) as field, error_type
      from judged where error_type is not null)
      select 'batch' as source, error_type, field, count(*) as cnt from x group by 2, 3""",
    "entity_ids": f"""select c_custkey, {_hash("c_name", "c_mktsegment", "cast(c_nationkey as string)")}
      as cardholder_id, {_hash("cast(round(c_acctbal, 5) as string)", "cast(cast(c_custkey as double) as string)",
      "case when c_nationkey > 5 then c_mktsegment end", "cast(c_nationkey as string)")} as merchant_id from customer""",
    "scan_csv": _SCANNED,
    "scan_csv_unreadable": _SCANNED + " union all select 'files not read', null, 1, null, null",
    "input_manifest": """select distinct 'n_regionkey=' || n_regionkey as folder, true as filled, null::varchar as error
      from nation""",
    "manifest_by_keys": """select distinct 'keys=' || coalesce(cast(l_orderkey // 1000 as varchar), '__HIVE_DEFAULT_PARTITION__')
      as folder, true as filled, null::varchar as error from lineitem""",
    "stream_two_topics": _STREAMED,
    "scan_jsonl": _SCANNED,
    "scan_json": _SCANNED,
    "scan_mixed": f"{_SCANNED} union all ({_SCANNED}) union all ({_SCANNED})",
    "load_batch_payload": _PAYLOAD,
    "payload_sample": _PAYLOAD + """ order by "transNum", "tsEpoch" limit 1""",
    "load_batch_rejects": _REJECTS,
    "quarantine_roundtrip": _REJECTS,
    "landing_sightings": _JUDGED + f""" select trans_num, 'batch' as source, epoch_us(parsed) as ts, amount,
      {_FLAG} as is_fraud, category, try_cast(city_pop as int) as city_pop, dob from judged where error_type is null""",
    "stream_ingest": _STREAMED,
    "stream_quarantine": _REFUSED,
    "stream_redelivered": _STREAMED,
    "stream_recent_unique": _SIGHTINGS + """ select distinct trans_num, epoch_us(ts) as ts from s where source = 'kafka'""",
    "load_counts": _JUDGED + """ select count(*) as records, count(error_type) as rejected from judged""",
    "writers_per_partition": _JUDGED + """ select error_type is not null as rejected, count(*) as records, true as two_files
      from judged group by 1""",
    "file_lineage": _TX + """ select 'csv' as reader, category as kind, count(*) as records, count(*) as numbers from tx group by 2
      union all select r, category, count(*), count(*) from tx, unnest(['lines', 'pretty']) as s(r)
      where category in ('view', 'click') group by 1, 2""",
    "stream_fold_state": _FOLDED,
    "stream_late_rows": _DEALT + """ select trans_num, cardholder_id, epoch_us(ts) as ts, amount from dealt where late""",
    # A payment lies in two windows of ten minutes that begin every five; those behind the last watermark are finished.
    "stream_velocity_windows": _DEALT + """, w as (
        select cardholder_id, amount, (epoch_us(ts) // 300000000 - back) * 300000000 as begins
        from dealt, unnest([0, 1]) as s(back) where not late)
      select cardholder_id, begins, begins + 600000000 as ends, count(*) as n, round(sum(amount), 6) as amount from w
      where begins + 600000000 <= (select done from last) group by 1, 2""",
    "stream_burst_sessions": _DEALT + """, small as (
        select cardholder_id, epoch_us(ts) as moment, epoch_us(ts) - lag(epoch_us(ts)) over (partition by cardholder_id order by ts) as gap
        from dealt where not late and amount <= 20),
      r as (select *, count(*) filter (where gap is null or gap >= 14400000000)
                      over (partition by cardholder_id order by moment rows unbounded preceding) as run from small),
      g as (select cardholder_id, run, min(moment) as begins, max(moment) + 14400000000 as ends, count(*) as n from r group by 1, 2)
      select cardholder_id, begins, ends, n from g
      where n >= 2 and ends <= (select (max(moment) - 3600000000) // 1000 * 1000 from small)""",
    "publish_payload": _TX + """ select trans_num as key, 'amount,cardholder_id,category,trans_num,ts' as fields,
      trans_num, amount, category, cardholder_id from tx""",
}
