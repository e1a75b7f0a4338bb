"""Payment-shaped views over the driver's tables.

Each view is one SQL text that Spark and DuckDB both read the same way, so a
query and its oracle start from identical rows. Irregularities (spellings,
missing values, repeated records) are computed from the rows' own numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txflow.session import filled, tune

_K = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"

TX = f"""
select cast(event_id as string) as trans_num, cast(ts as timestamp) as ts,
       cast(user_id as string) as cardholder_id, regexp_extract(props, '([0-9]+)', 1) as merchant_id,
       event_type as category, value as amount, event_id, user_id, {_K} as k
from events
"""

CARD_TX = """
select cast(o_orderkey as string) as trans_num, cast(o_orderdate as timestamp) as ts,
       cast(o_custkey as string) as cardholder_id, o_orderstatus as merchant_id,
       case when o_custkey % 2 = 0 then o_orderpriority else concat('rare-', cast(o_custkey as string)) end as category,
       o_totalprice as amount
from orders
"""

# Payments with values that are no numbers, and without some of their keys.
ODD_TX = f"""
with tx as ({TX})
select trans_num, ts, case when k % 7 <> 0 then cardholder_id end as cardholder_id, merchant_id,
       case when k % 11 <> 0 then category end as category,
       case when k % 13 = 0 then cast('NaN' as double) when k % 13 = 1 then cast('Infinity' as double)
            when k % 13 = 2 then -cast('Infinity' as double) when k % 13 = 3 then -cast(0 as double)
            when k % 13 = 4 then null when k % 13 = 5 then -amount else amount end as amount
from tx
"""

# Views come by stream only, errors by file only, everything else both ways; purchases
# are sent twice, and files may arrive before the stream.
SIGHTINGS = f"""
with tx as ({TX})
select trans_num, 'kafka' as source, 4 * event_id as seq, ts, amount, 0 as is_fraud, category,
       case when k % 2 = 0 then 'POS' else 'NET' end as channel, concat('city', cast(k % 40 as string)) as city,
       concat('s', cast(k % 7 as string)) as state, cast(null as int) as city_pop,
       cast(null as double) as lat, cast(null as double) as long,
       cast(null as double) as latitude, cast(null as double) as longitude,
       cast(k + 0.25 as double) as cardholder_lat, cast(k - 0.25 as double) as cardholder_long,
       cast(k + 0.5 as double) as merchant_lat, cast(k - 0.5 as double) as merchant_long,
       case when user_id % 4 = 0 then null else concat('job', cast(user_id % 5 as string)) end as job,
       concat('dob', cast(user_id as string)) as dob, cardholder_id, merchant_id, cast(null as string) as file,
       ts + interval '1' second * (event_id % 97) as ingested_at
from tx where category <> 'error'
union all
select trans_num, 'kafka', 4 * event_id + 2, ts, amount + 0.5, 1, upper(category), 'APP', 'elsewhere',
       concat('t', cast(k % 7 as string)), null, null, null, null, null,
       cast(k + 0.25 as double), cast(k - 0.25 as double), cast(k + 0.5 as double), cast(k - 0.5 as double), concat('late', cast(user_id % 5 as string)),
       concat('dob', cast(user_id as string)), cardholder_id, merchant_id, null,
       ts + interval '1' second * (event_id % 97 + 60)
from tx where category = 'purchase'
union all
select trans_num, 'batch', case when amount < 20 then 4 * event_id - 1 else 4 * event_id + 1 end,
       ts + interval '1' second * 1, amount + 1, case when k % 3 = 0 then null else k % 2 end,
       concat('file ', category), null, concat('town', cast(k % 30 as string)), concat('u', cast(k % 7 as string)),
       cast(user_id as int), cast(k + 0.1 as double), cast(k + 0.2 as double), cast(k + 0.3 as double),
       cast(k + 0.4 as double), null, null, null, null, null, null, null, null,
       concat('load-', cast(k % 5 as string)), ts + interval '1' second * 3600
from tx where category <> 'view'
"""

# The same records taken in on three days.
THREE_DAYS = f"""
with s as ({SIGHTINGS})
select trans_num, source, seq, amount,
       timestamp '2024-05-31 00:00:00' + interval '1' second * (86400 * (seq % 3) + seq % 80000) as ts,
       timestamp '2024-05-31 00:00:00' + interval '1' second * (86400 * (seq % 3) + seq % 80000 + seq % 97) as ingested_at
from s
"""

# Raw text records in every timestamp shape, with unusable values among them.
_CLOCK = "concat(cast(h as string), ':', cast(mi as string))"
_CLOCK_S = f"concat({_CLOCK}, ':', cast(s as string))"
_HALF = "concat(cast(h % 12 + 1 as string), ':', cast(mi as string))"
_MDY = "concat(cast(mo as string), '/', cast(d as string), '/', cast(y as string))"
_YMD = "concat(cast(y as string), '-', cast(mo as string), '-', cast(d as string))"
_DMY = "concat(cast(d as string), '-', cast(mo as string), '-', cast(y as string))"
_YSMD = "concat(cast(y as string), '/', cast(mo as string), '/', cast(d as string))"
RAW = f"""
with p as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag,
         year(l_shipdate) as y, month(l_shipdate) as mo, day(l_shipdate) as d,
         l_partkey % 24 as h, l_suppkey % 60 as mi, l_orderkey % 60 as s
  from lineitem)
select case when l_partkey % 19 = 0 then null
            else concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) end as trans_num,
       case l_orderkey % 21
         when 0 then concat({_MDY}, ' ', {_CLOCK_S}) when 1 then concat({_MDY}, ' ', {_CLOCK})
         when 2 then concat({_MDY}, ' ', {_HALF}, ':', cast(s as string), ' PM')
         when 3 then concat({_MDY}, ' ', {_HALF}, ' am')
         when 4 then concat({_YMD}, ' ', {_CLOCK_S}) when 5 then concat({_YMD}, 'T', {_CLOCK_S})
         when 6 then concat({_YMD}, ' ', {_CLOCK}) when 7 then concat({_YMD}, 'T', {_CLOCK})
         when 8 then concat({_DMY}, ' ', {_CLOCK_S}) when 9 then concat({_DMY}, ' ', {_CLOCK})
         when 10 then concat({_YSMD}, ' ', {_CLOCK_S}) when 11 then concat({_YSMD}, ' ', {_CLOCK})
         when 12 then {_MDY} when 13 then {_YMD} when 14 then {_YSMD} when 15 then concat('  ', {_DMY}, ' ')
         when 16 then '32/01/2020' when 17 then '15/01/2020' when 18 then '02/30/2020' when 19 then ' '
         else concat({_YMD}, 'T', {_CLOCK_S}, 'Z') end as trans_date_trans_time,
       concat('Client, ', cast(l_suppkey as string)) as client_name, l_returnflag as category,
       case when l_partkey % 11 = 0 then 'N/A' when l_partkey % 13 = 0 then ''
            else concat(cast(cast(l_quantity as int) as string), '.5') end as amt,
       concat('city', cast(l_suppkey % 50 as string)) as city, 'XX' as state,
       case when l_partkey % 17 = 0 then 'north' else cast(l_suppkey % 90 as string) end as lat,
       concat('-', cast(l_suppkey % 180 as string), '.25') as long,
       case when l_partkey % 23 = 0 then ' ' when l_partkey % 29 = 0 then '12abc' else cast(l_partkey as string) end
         as city_pop,
       'clerk' as job, '01/02/1970' as dob, '10.5' as latitude,
       case when l_partkey % 37 = 0 then 'west' else '-20.5' end as longitude,
       case l_suppkey % 9 when 0 then 'Yes' when 1 then 'TRUE' when 2 then 'n' when 3 then 'F' when 4 then '1'
         when 5 then '0' when 6 then '2' when 7 then 'maybe' else ' yes ' end as is_fraud
from p
"""

# Message bodies by event type; some of them are damaged, each kind in its own way.
MESSAGES = f"""
with tx as ({TX}), f as (
  select *, event_id % 12 as kind, concat('{{"trans_num":"', trans_num, '","trans_date_trans_time":"',
         substr(cast(ts as string), 1, 10), 'T', substr(cast(ts as string), 12, 8), 'Z"') as head,
         concat(',"category":"', category, '","channel":"POS","city":"city', cast(k as string),
                '","state":"CO","dob":"1980-01-', cast(user_id as string), '","job":"Nurse"') as words,
         concat(',"lat":', cast(k % 48 as string), '.5,"merch_lat":', cast(k % 48 as string),
                '.25,"merch_long":-', cast(k as string), '.125') as places
  from tx)
select event_id, ts, trans_num, user_id, k, category, kind,
  case kind
    when 0 then concat(head, ',"amt":"not_a_number","is_fraud":0,"long":-71.5', words, places, '}}')
    when 1 then concat('{{"amt":1.5,"trans_date_trans_time":"2024-01-01T00:00:00Z","is_fraud":0,"long":-71.5',
                       words, places, '}}')
    when 2 then concat(head, ',"amt":2.5,"is_fraud":0,"long":"bad_long"', words, places, '}}')
    when 3 then concat(head, ',"amt":2.5,"is_fraud":"maybe","long":-71.5', words, places, '}}')
    when 4 then concat('{{"trans_num":"', trans_num, '","trans_date_trans_time":"not-a-date","amt":2.5,"is_fraud":0',
                       ',"long":-71.5', words, places, '}}')
    when 5 then 'this is not json at all'
    when 6 then concat(head, ',"amt":"NaN","is_fraud":"yes-maybe","long":-71.5', words, places, '}}')
    when 7 then concat(head, ',"amt":null,"is_fraud":1.5,"long":-71.5', words, places, '}}')
    when 8 then concat(head, ',"amt":', cast(k as string), '.75,"is_fraud":true,"city_pop":"5000","long":"-71.5"',
                       words, places, ',"extra":[1,2]}}')
    when 9 then concat(head, ',"amt":2.5,"is_fraud":0,"long":-71.5', words, ',"lat":1.5,"merch_lat":1e18,"merch_long":-1.5}}')
    else concat(head, ',"amt":', cast(k as string), '.75,"is_fraud":0,"city_pop":', cast(user_id as string),
                ',"long":-71.5', words, places, '}}') end as body
from f
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, text: str, spread: bool = False) -> DataFrame:
    """Rows of one of the texts above; with ``spread`` made by all tasks, however few row groups a table has.

    A table with row groups for several tasks per core is read as it is.
    """
    tune(spark)
    for name in ("events", "orders", "lineitem", "customer"):
        if f"from {name}" in text:
            rows = table(spark, sf_dir, name)
            few = spread and filled(rows) < 4 * spark.sparkContext.defaultParallelism
            (rows.hint("rebalance") if few else rows).createOrReplaceTempView(name)
    return spark.sql(text)
