"""A stand-in impression log over the star-schema test tables.

Every event becomes one impression: its item and shop come from ``part`` and ``supplier``, its user from the event,
a conversion is a purchase. The last day carries no label. Every hundredth row is logged twice.
The same SQL gives the log to Spark and to the engine results are checked against; only the three
expressions in ``SPARK`` and ``CHECKER`` differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallywind.functions.time import with_clock
from tallywind.operators.clean import dedupe_rows
from tallywind.schema import DayPlan

PLAN = DayPlan(first=1, train=(26, 27, 28), valid=29, test=30)

# The columns of the test tables that are read.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
    "part": "p_partkey bigint, p_brand string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_nationkey int",
}

SPARK = {
    "k": "get_json_object(props, '$.k')",
    "epoch": "unix_date(cast(ts as date)) * bigint(86400) + hour(ts) * 3600 + minute(ts) * 60 + floor(second(ts))",
    "copies": "explode(sequence(1, case when instance_id % 100 = 0 then 2 else 1 end))",
}
CHECKER = {
    "k": "json_extract_string(props, '$.k')",
    "epoch": "floor(epoch(ts))",
    "copies": "unnest(range(0, case when instance_id % 100 = 0 then 2 else 1 end))",
}

_BASE = """
select event_id as id, user_id, event_type, cast({k} as int) as k, cast({epoch} as bigint) as ep,
       cast(day(ts) as int) as d,
       (user_id * 7 + cast({k} as int)) % (select count(*) from {part}) as item
from {events}
"""

_KEYED = "select *, item % (select count(*) from {supplier}) as shop from base"

_ONCE = """
select id as instance_id, cast(item as bigint) as item_id,
  concat('79;', brand, case when p_size > 25 then concat(';', size) else '' end) as item_category_list,
  concat(size, ';', cast(k as {text}), ';', brand, case when k % 2 = 0 then ';7' else '' end) as item_property_list,
  cast(brand as bigint) as item_brand_id, cast(s_nationkey as bigint) as item_city_id,
  cast(floor(p_retailprice / 10) - 90 as int) as item_price_level, cast(p_size % 19 - 1 as int) as item_sales_level,
  cast(p_size % 10 as int) as item_collected_level, cast(p_size % 13 as int) as item_pv_level,
  user_id, cast(user_id % 4 - 1 as int) as user_gender_id,
  cast(case when user_id % 29 = 0 then -1 else 1000 + user_id % 8 end as int) as user_age_level,
  cast(case when user_id % 29 = 0 then -1 else 2002 + user_id % 4 end as int) as user_occupation_id,
  cast(case when user_id % 29 = 0 then -1 else 3000 + user_id % 11 end as int) as user_star_level,
  id * 7 as context_id, ep as context_timestamp, cast(4001 + id % 20 as int) as context_page_id,
  case when id % 50 = 0 then '-1' else concat(brand, ':', size, ',', cast(k as {text}),
    case when k % 2 = 0 then ';79:1' else '' end, case when k % 4 = 0 then ';5:-1' else '' end)
  end as predict_category_property,
  cast(shop as bigint) as shop_id, cast(shop % 10 + 3 as int) as shop_review_num_level,
  case when id % 41 = 0 then -1e0 else round(1e0 - (id % 200) / 1e3, 6) end as shop_review_positive_rate,
  cast(4999 + shop % 10 as int) as shop_star_level,
  case when id % 43 = 0 then -1e0 else round(9e-1 + (id % 97) / 1e3, 6) end as shop_score_service,
  case when id % 43 = 0 then -1e0 else round(9e-1 + (id % 89) / 1e3, 6) end as shop_score_delivery,
  case when id % 43 = 0 then -1e0 else round(9e-1 + (id % 83) / 1e3, 6) end as shop_score_description,
  cast(case when d < 30 then case when event_type = 'purchase' then 1 else 0 end end as int) as is_trade
from keyed
left join (select *, split_part(p_brand, '#', 2) as brand, cast(p_size as {text}) as size from {part}) p on p_partkey = item
left join {supplier} on s_suppkey = shop
"""

_COPIED = "select *, {copies} as copy from once"


def _sql(dialect: dict[str, str], names: dict[str, str]) -> str:
    words = {**dialect, **names}
    base, keyed, once, copied = (part.strip().format(**words) for part in (_BASE, _KEYED, _ONCE, _COPIED))
    return f"base as ({base}),\nkeyed as ({keyed}),\nonce as ({once}),\ncopied as ({copied})"


_NAMES = {t: t for t in TABLES}
RAW_SQL = _sql({**CHECKER, "text": "varchar"}, _NAMES) + ",\nraw as (select * exclude (copy) from copied)"
LOG_SQL = RAW_SQL + """,
log as (
  select distinct *, cast(day(to_timestamp(context_timestamp) at time zone 'UTC') as int) as day,
         cast(hour(to_timestamp(context_timestamp) at time zone 'UTC') as int) as hour
  from raw)"""
_SPARK_SQL = "with " + _sql({**SPARK, "text": "string"}, {t: "{" + t + "}" for t in TABLES}) + "\nselect * except (copy) from copied"


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as it would be read from file, duplicates included."""
    tables = {name: spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet") for name, schema in TABLES.items()}
    return spark.sql(_SPARK_SQL, **tables)


def clean_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log without duplicates, with day and hour."""
    return with_clock(dedupe_rows(raw_log(spark, sf_dir)))
