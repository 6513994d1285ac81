"""Query registry: key -> Spark plan builder, key -> oracle SQL (DuckDB)."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def register(key: str, oracle: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


# ---------------------------------------------------------------- oracle views
# DuckDB text of the domain views (same definitions as sources.tables).

ATTEMPTS = """attempts as (
  select event_id, cast(user_id as varchar) lti_user_id, event_type attempt_type,
         ts created_at, case when value < 5 then null else value >= 30 end is_correct,
         cast(value as decimal(10,2)) score,
         json_extract_string(props, '$.k') lesson_id,
         'lesson ' || json_extract_string(props, '$.k') lesson_name
  from events)"""

CAFE = """cafe as (
  select cast(l_shipdate as date) report_date, n_name branch, p_type dish, p_brand category,
         cast(l_quantity as bigint) qty, cast(p_retailprice as decimal(10,2)) price,
         cast(l_extendedprice as decimal(12,2)) amount, s_name manager_name
  from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
       join nation on s_nationkey = n_nationkey)"""

PURCHASES = """purchases as (
  select o_orderkey purchase_id, o_custkey client_id, cast(o_orderdate as date) purchase_date,
         case o_orderpriority when '1-URGENT' then 'year' when '2-HIGH' then 'trial'
              else 'month' end subscription_plan,
         cast(o_totalprice as decimal(12,2)) price, o_orderpriority payment_method,
         case o_orderstatus when 'F' then 'success' when 'O' then 'failed'
              else 'refund' end status
  from orders)"""

SERIES = """series as (
  select o_orderkey + 1 id, 'Category_' || cast((o_orderkey + 1) % 5 as varchar) category,
         cast(round(cast(o_orderkey + 1 as decimal(20,1)) * 10.5, 0) as bigint) amount
  from orders)"""

# Expected values of the API records rendered from events (sources.records).
RECORDS = """records as (
  select event_id, user_id, event_type, value, ts,
         cast(user_id as varchar) lti_user_id,
         case when value < 5 then null when value < 30 then 0
              when user_id % 10 = 7 then 2 else 1 end raw_correct,
         'key-' || cast(user_id as varchar) oauth_consumer_key,
         case when value < 5 then null else 'src:' || cast(event_id as varchar) end
           lis_result_sourcedid,
         case event_type
           when 'view' then 'https://lms.example/view?it''s=' || cast(event_id as varchar)
           when 'error' then 'https://lms.example/error?msg=it''s "bad"'
           when 'signup' then 'note: None, ok'
           else 'https://lms.example/' || event_type end lis_outcome_service_url,
         json_extract_string(props, '$.k') lesson_id,
         case when user_id % 10 <> 4 then 'Lesson no. ' || json_extract_string(props, '$.k')
              || ' by ' || event_type end lesson_name,
         case when event_type = 'click' then null when value < 10 then null
              when value < 20 then cast(0 as decimal(10,2)) when user_id % 10 = 3 then null
              else cast(value as decimal(10,2)) end inner_score,
         case user_id % 10 when 1 then null when 0 then cast(0 as decimal(10,2))
              else cast(user_id as decimal(10,2)) end outer_score,
         value >= 30 graded
  from events)"""


def with_(*views: str) -> str:
    return "with " + ",\n".join(views) + "\n"
