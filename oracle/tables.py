"""Source, staging and gold tables as common table expressions over the driver's tables."""

from __future__ import annotations

NULL_MARKER = "_dbt_utils_surrogate_key_null_"
MISSING = "md5('-1')"

SPINE_START = "1995-01-01"
SPINE_END = "2034-12-31"


def sk(*columns: str) -> str:
    texts = [f"coalesce(cast({c} as varchar), '{NULL_MARKER}')" for c in columns]
    return f"md5({' || \'-\' || '.join(texts)})"


def keyed(column: str) -> str:
    return f"case when {column} is null then {MISSING} else {sk(column)} end"


def calendar(first: str, last: str) -> str:
    return f"""
with spine as (
  select cast(unnest(generate_series({first}, {last}, interval 1 day)) as date) date_day
)
select {MISSING} dim_date_sk, cast(null as date) date_day, cast(null as int) year_number,
       cast(null as int) quarter_number, cast(null as varchar) quarter_label,
       cast(null as int) month_number, cast(null as varchar) month_name,
       cast(null as int) week_of_year, cast(null as int) day_of_month,
       cast(null as int) day_of_week, cast(null as varchar) day_name,
       cast(null as boolean) is_weekend
union all
select {sk('date_day')}, date_day, cast(extract(year from date_day) as int),
       cast(extract(quarter from date_day) as int),
       'Q'||cast(extract(quarter from date_day) as varchar),
       cast(extract(month from date_day) as int), strftime(date_day,'%B'),
       cast(extract(week from date_day) as int), cast(extract(day from date_day) as int),
       cast(extract(dayofweek from date_day) as int), strftime(date_day,'%A'),
       extract(dayofweek from date_day) in (0,6)
from spine"""


SOURCES = {
    "src_brands": """
select distinct cast(split_part(p_brand,'#',2) as int) brand_id, '  '||p_brand||' ' brand_name
from part""",
    "src_categories": """
select cast(dense_rank() over(order by p_type) as int) category_id, ' '||p_type||' ' category_name
from (select distinct p_type from part) t""",
    "src_products": """
select p.p_partkey product_id, ' '||p.p_name||' ' product_name,
       cast(split_part(p.p_brand,'#',2) as int) brand_id, c.category_id,
       cast(2014+p.p_size%6 as smallint) model_year,
       cast(p.p_retailprice as decimal(10,2)) list_price
from part p join src_categories c on trim(c.category_name)=p.p_type""",
    "src_stores": """
select r_regionkey store_id, ' '||r_name||' Store ' store_name,
       case when r_regionkey%2=0 then ' ' else '555-010'||cast(r_regionkey as string) end phone,
       ' store'||cast(r_regionkey as string)||'@example.com ' email, '' street, r_name city,
       lower(substr(r_name,1,2)) state, '0000'||cast(r_regionkey as string) zip_code
from region""",
    "src_staffs": """
select s.s_suppkey staff_id, ' First'||cast(s.s_suppkey as string)||' ' first_name,
       'Last'||cast(s.s_suppkey as string) last_name,
       ' STAFF'||cast(s.s_suppkey as string)||'@Example.com' email, '' phone,
       cast(case when s.s_suppkey%10=9 then 0 else 1 end as smallint) active,
       n.n_regionkey store_id,
       case when s.s_suppkey<3 then null else s.s_suppkey%3 end manager_id
from supplier s join nation n on s.s_nationkey=n.n_nationkey""",
    "src_customers": """
select c.c_custkey customer_id, ' Cust ' first_name, split_part(c.c_name,'#',2) last_name,
       ' C'||cast(c.c_custkey as string)||'@Example.com ' email,
       case when c.c_custkey%3=0 then ' ' else '555-'||cast(c.c_custkey as string) end phone,
       '' street, n.n_name city, lower(substr(r.r_name,1,2)) state,
       cast(10000+c.c_nationkey as string) zip_code
from customer c join nation n on c.c_nationkey=n.n_nationkey
join region r on n.n_regionkey=r.r_regionkey""",
    "src_orders": """
select o.o_orderkey order_id,
       case when o.o_orderkey%20=0 then null else o.o_custkey end customer_id,
       cast(case when o.o_orderkey%15=7 then 3 when o.o_orderstatus='O' then 1
                 when o.o_orderstatus='P' then 2 else 4 end as smallint) order_status,
       cast(o.o_orderdate as date) order_date, cast(o.o_orderdate as date)+7 required_date,
       case when o.o_orderstatus='F'
            then cast(o.o_orderdate as date)+cast(o.o_orderkey%10 as int) end shipped_date,
       st.store_id, st.staff_id
from orders o cross join (select count(*) n from supplier) sc
join src_staffs st on st.staff_id=o.o_orderkey%sc.n""",
    "src_order_items": """
select l.l_orderkey order_id,
       cast(row_number() over(partition by l.l_orderkey
            order by l.l_linenumber,l.l_partkey,l.l_suppkey,l.l_shipdate,l.l_extendedprice)
            as int) item_id,
       l.l_partkey product_id, cast(l.l_quantity as int) quantity,
       cast(cast(p.p_retailprice as decimal(10,2))+l.l_linenumber as decimal(10,2)) list_price,
       cast(l.l_discount as decimal(4,2)) discount
from lineitem l join part p on l.l_partkey=p.p_partkey""",
    "src_stocks": """
select r.r_regionkey store_id, p.p_partkey product_id,
       case when (p.p_partkey+r.r_regionkey)%50=0 then null
            else cast((p.p_partkey*7+r.r_regionkey*13+d.k*5)%40 as int) end quantity,
       date '2001-07-01'+d.k ingestion_date
from region r cross join part p
cross join (select 0 k union all select 1 union all select 2) d""",
}

STAGING = {
    "stg_customers": """
select customer_id, trim(first_name) first_name, trim(last_name) last_name,
       trim(first_name)||' '||trim(last_name) full_name, lower(trim(email)) email,
       nullif(trim(phone),'') phone, nullif(trim(street),'') street, nullif(trim(city),'') city,
       upper(trim(state)) state, nullif(trim(zip_code),'') zip_code
from src_customers""",
    "stg_orders": """
select order_id, customer_id, order_status,
       case order_status when 1 then 'Pending' when 2 then 'Processing'
                         when 3 then 'Rejected' when 4 then 'Completed' end order_status_label,
       order_date, required_date, shipped_date, shipped_date is not null is_shipped,
       store_id, staff_id
from src_orders""",
    "stg_order_items": """
select order_id, item_id, product_id, quantity, list_price, discount,
       cast(round(quantity*list_price*(1-discount),2) as decimal(18,2)) line_total
from src_order_items""",
    "stg_staffs": """
select staff_id, trim(first_name) first_name, trim(last_name) last_name,
       trim(first_name)||' '||trim(last_name) full_name, lower(trim(email)) email,
       nullif(trim(phone),'') phone, active=1 is_active, store_id, manager_id
from src_staffs""",
    "stg_stores": """
select store_id, trim(store_name) store_name, nullif(trim(phone),'') phone,
       nullif(trim(email),'') email, nullif(trim(street),'') street, nullif(trim(city),'') city,
       upper(trim(state)) state, nullif(trim(zip_code),'') zip_code
from src_stores""",
    "stg_brands": "select brand_id, trim(brand_name) brand_name from src_brands",
    "stg_categories": "select category_id, trim(category_name) category_name from src_categories",
    "stg_products": """
select product_id, trim(product_name) product_name, brand_id, category_id, model_year, list_price
from src_products""",
    "stg_stocks_history": """
select store_id, product_id, coalesce(quantity,0) quantity, ingestion_date snapshot_date
from src_stocks""",
    "stg_stocks": """
select * from stg_stocks_history
where snapshot_date = (select max(ingestion_date) from src_stocks)""",
}

GOLD = {
    "dim_customer": f"""
select {MISSING} dim_customer_sk, cast(-1 as bigint) customer_id, 'Unknown' first_name,
       'Unknown' last_name, 'Unknown Customer' full_name, cast(null as varchar) email,
       cast(null as varchar) phone, cast(null as varchar) street, cast(null as varchar) city,
       cast(null as varchar) state, cast(null as varchar) zip_code
union all
select {sk('customer_id')}, customer_id, first_name, last_name, full_name, email, phone, street,
       city, state, zip_code
from stg_customers""",
    "dim_product": f"""
select {MISSING} dim_product_sk, cast(-1 as bigint) product_id, 'Unknown Product' product_name,
       cast(null as smallint) model_year, cast(null as decimal(10,2)) list_price,
       cast(-1 as int) brand_id, 'Unknown Brand' brand_name, cast(-1 as int) category_id,
       'Unknown Category' category_name
union all
select {sk('p.product_id')}, p.product_id, p.product_name, p.model_year, p.list_price,
       b.brand_id, b.brand_name, c.category_id, c.category_name
from stg_products p left join stg_brands b on p.brand_id=b.brand_id
left join stg_categories c on p.category_id=c.category_id""",
    "dim_store": f"""
select {MISSING} dim_store_sk, cast(-1 as int) store_id, 'Unknown Store' store_name,
       cast(null as varchar) phone, cast(null as varchar) email, cast(null as varchar) street,
       cast(null as varchar) city, cast(null as varchar) state, cast(null as varchar) zip_code
union all
select {sk('store_id')}, store_id, store_name, phone, email, street, city, state, zip_code
from stg_stores""",
    "dim_staff": f"""
select {MISSING} dim_staff_sk, cast(-1 as bigint) staff_id, 'Unknown' first_name,
       'Unknown' last_name, 'Unknown Staff' full_name, cast(null as varchar) email,
       cast(null as varchar) phone, false is_active, cast(-1 as int) store_id,
       cast(null as bigint) manager_id, {MISSING} manager_dim_staff_sk,
       cast(null as varchar) manager_full_name
union all
select {sk('s.staff_id')}, s.staff_id, s.first_name, s.last_name, s.full_name, s.email, s.phone,
       s.is_active, s.store_id, s.manager_id, {keyed('s.manager_id')}, m.full_name
from stg_staffs s left join stg_staffs m on s.manager_id=m.staff_id""",
    "dim_date": calendar(f"date '{SPINE_START}'", f"date '{SPINE_END}'"),
    "fct_sales": f"""
select {sk('oi.order_id', 'oi.item_id')} sales_pk, {sk('o.order_date')} dim_date_sk,
       {keyed('o.customer_id')} dim_customer_sk, {sk('oi.product_id')} dim_product_sk,
       {sk('o.store_id')} dim_store_sk, {sk('o.staff_id')} dim_staff_sk, oi.order_id, oi.item_id,
       o.order_status, o.order_status_label, o.is_shipped, o.order_date, o.required_date,
       o.shipped_date, oi.quantity, oi.list_price, oi.discount, oi.line_total
from stg_order_items oi join stg_orders o on oi.order_id=o.order_id""",
    "fct_inventory": f"""
select {sk('s.store_id', 's.product_id')} inventory_pk, {sk('s.snapshot_date')} dim_date_sk,
       {sk('s.store_id')} dim_store_sk, {sk('s.product_id')} dim_product_sk, s.store_id,
       s.product_id, s.snapshot_date, s.quantity,
       cast(round(s.quantity*p.list_price,2) as decimal(18,2)) inventory_value
from stg_stocks s left join stg_products p on s.product_id=p.product_id""",
    "fct_inventory_history": f"""
select {sk('s.store_id', 's.product_id', 's.snapshot_date')} inventory_pk,
       {sk('s.snapshot_date')} dim_date_sk, {sk('s.store_id')} dim_store_sk,
       {sk('s.product_id')} dim_product_sk, s.store_id, s.product_id, s.snapshot_date, s.quantity,
       cast(round(s.quantity*p.list_price,2) as decimal(18,2)) inventory_value
from stg_stocks_history s left join stg_products p on s.product_id=p.product_id""",
}

TABLES = {**SOURCES, **STAGING, **GOLD}


def with_tables(query: str) -> str:
    """The query behind all table definitions; an engine drops those it does not use."""
    ctes = ",\n".join(f"{name} as ({body.strip()})" for name, body in TABLES.items())
    return f"with {ctes}\nselect * from (\n{query.strip()}\n) result"
