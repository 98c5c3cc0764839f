"""DuckDB SQL for the domain views (``b_*``) used by the oracle queries.

Same definitions as ``tijara.sources.testdata`` but written as SQL over the raw
test tables; ``with_views`` prepends the CTEs a query mentions.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "b_orders": """
select o_orderkey as id, cast(floor(o_orderkey / 3) as bigint) as master_order_id, o_custkey as user_id,
  cast(o_orderkey % 11 as int) as status, cast(1 + o_custkey % 3 as int) as type,
  case when o_orderkey % 17 = 0 then null else cast(1 + o_orderkey % 4 as int) end as fulfilment_mode_id,
  cast(1 + o_orderkey % 5 as int) as vertical_id, (o_orderkey % 13 = 0) as is_fake,
  case when o_orderkey % 7 = 0 then null else o_orderkey end as stop_id, cast(o_custkey % 25 as int) as city_id,
  o_orderdate + interval 20 hours as created_at,
  case when o_orderkey % 11 in (4, 5, 6, 7) then o_orderdate + interval 3 days + interval 21 hours end as delivered_at,
  case when o_orderkey % 11 in (4, 5, 6, 7) then o_orderdate + interval 3 days + interval 23 hours end as delivery_date_time,
  case when o_custkey % 2 = 0 then o_custkey end as created_by,
  case when o_orderkey % 11 = 6 then cast(1 + o_orderkey % 3 as int) end as cancel_reason_id
from orders""",
    "b_order_items": """
select l_orderkey * 10 + l_linenumber as id, l_orderkey as order_id, l_partkey as product_id, l_partkey as variant_id,
  l_partkey as sku_id, cast(l_extendedprice as decimal(18,2)) as price, cast(l_quantity as bigint) as qty,
  case when l_linenumber = 7 then null else greatest(cast(l_quantity as bigint) - l_linenumber % 3, 0) end as picked_qty,
  case when l_returnflag = 'R' then cast(1 as bigint) when l_returnflag = 'A' then cast(0 as bigint) end as return_qty,
  cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(4,2)) as discount,
  cast(l_tax as decimal(4,2)) * 100 as commission_value, l_linestatus as seller_status, l_shipdate as updated_at
from lineitem""",
    "b_order_payments": """
select l_orderkey as order_id, cast(1 + l_linenumber % 5 as int) as payment_types_id,
  case when l_returnflag = 'A' then null else cast(l_extendedprice as decimal(18,2)) end as amount,
  cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(4,2)) as total_discount,
  case when l_returnflag = 'R' then cast(l_extendedprice as decimal(18,2)) end as return_amount
from lineitem""",
    "b_stops": """
select o_orderkey as id, cast(1 + o_orderkey % 6 as int) as stop_status, o_orderkey % 97 as route_id
from orders where o_orderkey % 7 <> 0""",
    "b_routes": """
select s_suppkey as id, concat('Route ', s_name) as name, cast(s_nationkey % 3 as int) as status, s_suppkey as user_id,
  timestamp '1995-01-01 20:00:00' as created_at, timestamp '1995-01-02 04:00:00' as started_at from supplier""",
    "b_transaction_logs": """
select l_orderkey * 10 + l_linenumber as id, l_orderkey as stop_id, min(l_shipdate) as created_at from lineitem group by 1, 2""",
    "b_cash_collection": """
select s_suppkey as route_id, timestamp '1995-01-02 21:00:00' as created_at from supplier""",
    "b_orders_agents": """
select cast(o_orderkey as varchar) as order_id, cast(o_custkey % 50 as varchar) as agent_id from orders where o_orderkey % 3 = 0""",
    "b_seller_invoice_orders": """
select o_orderkey as order_id, o_orderkey + 900000 as invoice_id from orders where o_orderkey % 5 <> 0""",
    "b_users": """
select c_custkey as id, c_name as name, concat('+', cast(c_custkey as varchar)) as mobile,
  case when c_custkey % 5 = 0 then null else c_custkey % 100 end as refer_by,
  timestamp '1995-01-01 20:00:00' as created_at, (c_acctbal > 0) as is_active from customer""",
    "b_retailers": """
select c_custkey as user_id, cast(d as int) as copy_no,
  case when c_custkey % 3 = 0 then null else concat('+', cast(c_custkey as varchar)) end as phone,
  case when d = 1 and c_custkey % 2 = 0 then null else concat('Store ', c_name) end as store_name,
  case when c_custkey % 7 = 0 then null else cast(c_nationkey * 1.5 as double) end as lat,
  case when c_custkey % 7 = 0 then null else cast(c_nationkey * 2.5 as double) end as lng,
  cast(c_nationkey as int) as city_id, case when d = 1 then null else cast(c_custkey % 25 as int) end as area_id,
  case when c_custkey % 4 = 0 then null else cast(c_custkey % 5 as int) end as sub_area_id,
  case when d = 0 and c_custkey % 2 = 1 then null else cast(c_custkey * 7 as varchar) end as cnic_number,
  case when c_custkey % 9 = 0 then null else c_mktsegment end as address, cast(c_custkey % 5 as int) as store_type
from customer cross join (select r_regionkey as d from region where r_regionkey < 2) x
where d = 0 or c_custkey % 2 = 0""",
    "b_suppliers": """
select s_suppkey as user_id, s_name as store_name, cast(s_nationkey as int) as city_id,
  case when s_suppkey % 3 = 0 then true when s_suppkey % 3 = 1 then false end as is_internal from supplier""",
    "b_drivers": """
select s_suppkey as user_id, cast(s_nationkey as int) as city_id from supplier where s_suppkey % 4 <> 0""",
    "b_cities": """
select cast(n_nationkey as int) as id, n_name as name, (n_regionkey = 0) as is_exclusive from nation""",
    "b_areas": """
select cast(n_nationkey as int) as id, concat('Area ', n_name) as name from nation""",
    "b_named_codes": """
select cast(r_regionkey as int) as id, r_name as name from region""",
    "b_reasons": """
select cast(1 + r_regionkey as int) as id, case r_regionkey when 0 then 'Wastage' when 1 then 'Lost/Stolen'
  when 2 then 'Wrong data entry' else 'Other' end as reason from region""",
    "b_categories": """
select cast(r_regionkey as int) as id, r_name as name, cast(null as int) as parent_id from region
union all select cast(100 + n_nationkey as int), n_name, cast(n_regionkey as int) from nation
union all select cast(1000 + s_suppkey as int), s_name, cast(100 + s_nationkey as int) from supplier""",
    "b_product_categories": """
select p_partkey as product_id, cast(100 + p_partkey % 25 as int) as category_id from part where p_partkey % 12 <> 11
union all select p_partkey, cast(100 + (p_partkey + 1) % 25 as int) from part where p_partkey % 10 = 0""",
    "b_products": """
select p_partkey as id, p_name as name, cast(p_partkey % 5 as int) as vertical_id from part""",
    "b_product_variants": """
select p_partkey as id, concat(p_name, ' ', cast(p_size as varchar)) as name, p_partkey as product_sku_id from part""",
    "b_product_sku": """
select p_partkey as id, concat('SKU ', p_name) as sku_name, cast(p_retailprice as decimal(18,2)) as price,
  p_partkey as product_id, case when p_partkey % 6 = 0 then null else p_partkey end as product_variant_id from part""",
    "b_product_sku_details": """
select p_partkey as sku_id, p_partkey % 100 as user_id from part""",
    "b_brands": """
select distinct cast(substr(p_brand, 7) as int) as id, p_brand as name from part""",
    "b_product_brands": """
select p_partkey as product_id, cast(substr(p_brand, 7) as int) as brand_id from part where p_partkey % 8 <> 0""",
    "b_product_manufacturing": """
select p_partkey as product_id, cast(p_partkey % 7 as int) as manufacturing_id from part""",
    "b_return_discrepancy": """
select l_orderkey * 10 + l_linenumber as id, l_orderkey % 97 as route_id, l_partkey as sku_id,
  cast(l_quantity as bigint) as qty,
  case when l_linenumber = 7 then null else cast(l_linenumber as bigint) end as discrepancy,
  case when l_linenumber = 6 then null else cast(1 + l_linenumber % 4 as int) end as reason_id,
  l_shipdate + interval 20 hours as created_at
from lineitem where l_returnflag = 'R'""",
    "b_categories_commission": """
select s_suppkey as id, cast(100 + s_suppkey % 25 as int) as category_id, cast(s_nationkey as int) as city_id,
  cast(1 + s_suppkey % 4 as int) as fulfilment_mode_id, cast(s_suppkey % 12 as int) as commission_value,
  (s_acctbal > 0) as is_active, s_suppkey as created_by, case when s_suppkey % 2 = 0 then s_suppkey + 1 end as updated_by,
  timestamp '1995-01-01 20:00:00' as created_at,
  case when s_suppkey % 2 = 0 then timestamp '1996-06-30 21:30:00' end as updated_at,
  case when s_suppkey % 9 = 0 then timestamp '1997-01-31 19:00:00' end as deleted_at from supplier""",
    "b_activity_logs": """
select event_id, case event_type when 'click' then 'SKU updated successfully' when 'view' then 'Item added successfully'
    when 'purchase' then 'Product updated successfully' when 'signup' then 'Out of stock marked manually'
    else 'Login failed' end as payload,
  concat('{"current":{"id":"', case when event_id % 10 = 0 then 'n/a' when event_id % 10 = 1 then '5.'
    when event_id % 10 = 2 then '1e5' else cast(event_id as varchar) end,
    '","price":', cast(user_id as varchar), ',"code":"', event_type, '","is_hot":',
    case when event_id % 2 = 0 then 'true' else 'false' end,
    ',"deleted_at":null,"updated_at":"2023-', case when event_id % 2 = 0 then '06' else '07' end, '-',
    cast(10 + event_id % 19 as varchar),
    'T19:12:41.593000Z","delivery_date":"', cast(cast(ts as date) as varchar), '"},"sku":{"id":',
    cast(user_id as varchar), ',"sku_id":"S', cast(user_id as varchar),
    '","approved":', case when event_id % 3 = 0 then 'true' else 'false' end,
    ',"seller_change_requests":{"expiry_date":"', cast(cast(ts as date) as varchar), '"}}}') as changes
from events""",
    "b_nps_results": """
select user_id, event_id as result_id, 1700000000 + event_id * 60 as created_at, cast(1 + event_id % 2 as int) as survey_id,
  cast(1 + event_id % 3 as int) as question_id, cast(1 + event_id % 5 as int) as option_id,
  cast(event_id % 11 as int) as selected_option
from events""",
    "b_nps_surveys": """
select cast(1 + a.r_regionkey as int) as survey_id, cast(1 + b.r_regionkey as int) as question_id,
  cast(1 + c.r_regionkey as int) as option_id, concat('Survey ', a.r_name) as survey_name,
  'scale' as question_type, case b.r_regionkey when 0 then 'how likely are you to recommend us'
    when 1 then 'would you suggest us to other shops' else 'other question' end as question_text,
  c.r_name as option_text
from region a cross join region b cross join region c where a.r_regionkey < 2 and b.r_regionkey < 3""",
}

# order matters only for readability; views never reference each other
_NAME = re.compile(r"\bb_[a-z_]+\b")


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the b_* CTEs it references (merging with its own WITH)."""
    used = [n for n in VIEWS if re.search(rf"\b{n}\b", sql)]
    unknown = {m for m in _NAME.findall(sql)} - set(VIEWS)
    if unknown:
        raise KeyError(f"unknown views {sorted(unknown)}")
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in used)
    body = sql.strip()
    if not ctes:
        return body
    if body[:4].lower() == "with":
        own = body[4:].lstrip()
        if own.upper().startswith("RECURSIVE "):
            return f"WITH RECURSIVE {ctes},\n{own[10:].lstrip()}"
        return f"WITH {ctes},\n{own}"
    return f"WITH {ctes}\n{body}"
