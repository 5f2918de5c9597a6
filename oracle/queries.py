"""One SQL statement per registered query."""

from __future__ import annotations

from oracle import contract
from oracle.tables import GOLD, MISSING, STAGING, calendar, sk, with_tables

REVENUE = "cast(sum(s.line_total) as decimal(28,2))"
UNITS = "cast(sum(s.quantity) as bigint)"
DATE = "join dim_date d on s.dim_date_sk = d.dim_date_sk"
STORE = "join dim_store st on s.dim_store_sk = st.dim_store_sk"
PRODUCT = "join dim_product p on s.dim_product_sk = p.dim_product_sk"
STAFF = "join dim_staff sf on s.dim_staff_sk = sf.dim_staff_sk"
CUSTOMER = "join dim_customer c on s.dim_customer_sk = c.dim_customer_sk"


def ratio(a: str, b: str) -> str:
    return f"(cast({a} as double) / nullif(cast({b} as double), 0))"


def divide0(a: str, b: str) -> str:
    return f"coalesce({ratio(a, b)}, 0.0)"


def percent(part: str, total: str) -> str:
    return f"(cast({part} as double) * 100.0 / nullif(cast({total} as double), 0))"


def mean(column: str) -> str:
    return ratio(f"sum({column})", f"count({column})")


def kpi_columns(alias: str = "s") -> str:
    orders = f"count(distinct {alias}.order_id)"
    shipped = f"count(distinct case when {alias}.is_shipped then {alias}.order_id end)"
    return f"""cast(sum({alias}.line_total) as decimal(28,2)) total_revenue,
       {orders} total_orders,
       {divide0(f'cast(sum({alias}.line_total) as decimal(28,2))', orders)} avg_order_value,
       cast(sum({alias}.quantity) as bigint) units_sold,
       {divide0(shipped, orders)} * 100 fulfillment_rate_pct"""


def sales_kpis(where: str = "", joins: str = "") -> str:
    return f"select {kpi_columns()} from fct_sales s {joins} {where}"


KPIS = ["total_revenue", "total_orders", "avg_order_value", "units_sold", "fulfillment_rate_pct"]


def kpis_yoy() -> str:
    columns = []
    for k in KPIS:
        change = divide0(
            f"coalesce(cast(a.{k} as double), 0) - cast(b.{k} as double)", f"b.{k}"
        )
        columns.append(f"a.{k}, b.{k} py_{k}, {change} * 100 {k}_change_pct")
    return f"""
select coalesce(a.year_number, b.year_number + 1) year_number, {', '.join(columns)}
from (select d.year_number, {kpi_columns()} from fct_sales s {DATE} group by 1) a
full join (select d.year_number, {kpi_columns()} from fct_sales s {DATE} group by 1) b
  on b.year_number = a.year_number - 1"""


MONTHLY = f"""select d.year_number, d.month_number, {REVENUE} revenue
from fct_sales s {DATE} group by 1, 2"""


def revenue_yoy(where: str = "") -> str:
    return f"""
with m as ({MONTHLY}),
t as (
  select coalesce(a.year_number, b.year_number + 1) year_number,
         coalesce(a.month_number, b.month_number) month_number, a.revenue, b.revenue py_revenue
  from m a full join m b
    on b.year_number = a.year_number - 1 and b.month_number = a.month_number
)
select *, {divide0('coalesce(revenue, 0) - py_revenue', 'py_revenue')} * 100 yoy_growth_pct
from t {where}"""


def years_ago(n: int) -> str:
    return f"""
select coalesce(a.year_number, b.year_number + {n}) year_number,
       coalesce(a.month_number, b.month_number) month_number, a.revenue,
       cast({n} as int) years_back, b.revenue earlier_revenue
from ({MONTHLY}) a full join ({MONTHLY}) b
  on b.year_number = a.year_number - {n} and b.month_number = a.month_number"""


def trend(where: str) -> str:
    return f"""
select d.year_number, d.month_number, d.month_name, {REVENUE} monthly_revenue
from fct_sales s {DATE} where {where} group by 1, 2, 3"""


def share(by: str, join: str, name: str) -> str:
    total = "(select cast(sum(line_total) as decimal(28,2)) from fct_sales)"
    return f"""select '{by}' "by", {name} as name, {REVENUE} revenue,
       {divide0(REVENUE, total)} * 100 share_pct
from fct_sales s {join} group by {name}"""


def band_case() -> str:
    arms = " ".join(f"when s.line_total >= {floor} then '{b}'" for floor, b in contract.REVENUE_BANDS)
    return f"case {arms} else '{contract.LOWEST_REVENUE_BAND}' end"


SALES = {
    "sales_kpis": sales_kpis(),
    "revenue_trend_monthly": f"""
select d.year_number, d.month_number, d.month_name, {REVENUE} monthly_revenue
from fct_sales s {DATE} group by 1, 2, 3""",
    "order_status_distribution": f"""
select order_status, order_status_label, count(distinct order_id) order_count,
       {percent('count(distinct order_id)', 'sum(count(distinct order_id)) over ()')} pct
from fct_sales group by 1, 2""",
    "orders_by_status_measures": """
select count(distinct case when order_status = 4 then order_id end) completed_orders,
       count(distinct case when order_status = 1 then order_id end) pending_orders,
       count(distinct case when order_status = 3 then order_id end) rejected_orders,
       count(distinct case when order_status = 2 then order_id end) processing_orders
from fct_sales""",
    "revenue_by_store": f"""
select st.store_name, {REVENUE} store_revenue from fct_sales s {STORE} group by 1""",
    "revenue_by_category": f"""
select p.category_name, {REVENUE} category_revenue from fct_sales s {PRODUCT} group by 1""",
    "top_products": f"""
select p.product_name, p.brand_name, p.category_name, {UNITS} units_sold, {REVENUE} revenue,
       {ratio(REVENUE, UNITS)} avg_selling_price
from fct_sales s {PRODUCT} group by 1, 2, 3
order by revenue desc, product_name, brand_name, category_name limit 10""",
    "monthly_summary": f"""
select d.year_number, d.month_number, d.month_name, {REVENUE} revenue,
       count(distinct s.order_id) orders, {mean('s.discount')} avg_discount,
       {mean('s.discount')} * 100 avg_discount_pct
from fct_sales s {DATE} group by 1, 2, 3""",
    "revenue_yoy": revenue_yoy(),
    "revenue_n_years_ago": "\nunion all\n".join(f"({years_ago(n)})" for n in (1, 2, 3)),
    "kpis_yoy": kpis_yoy(),
    "revenue_share": "\nunion all\n".join(
        [
            share("store", STORE, "st.store_name"),
            share("product", PRODUCT, "p.product_name"),
            share("category", PRODUCT, "p.category_name"),
            share("brand", PRODUCT, "p.brand_name"),
        ]
    ),
    "revenue_rank_products": f"""
select product_name, revenue, dense_rank() over (order by revenue desc) revenue_rank
from (select p.product_name, {REVENUE} revenue from fct_sales s {PRODUCT} group by 1) t""",
    "revenue_bands": f"""
select {band_case()} band, count(*) "lines", {REVENUE} revenue from fct_sales s group by 1""",
    "revenue_by_quarter": f"""
select 'Q' || d.quarter_number || ' ' || d.year_number quarter_year_label, {REVENUE} revenue
from fct_sales s {DATE} group by 1""",
    "revenue_by_month_label": f"""
select strftime(d.date_day, '%b %Y') month_year_label, {REVENUE} revenue
from fct_sales s {DATE} group by 1""",
    "discount_percent": """
select order_id, item_id, discount, cast(discount * 100 as decimal(6,2)) discount_pct
from fct_sales""",
}

ALERT = "case when s.quantity <= 2 then 'Critical' when s.quantity <= 5 then 'Warning' else 'OK' end"
VALUE = "cast(sum(s.inventory_value) as decimal(28,2))"


def inventory_kpis(table: str = "fct_inventory", where: str = "", threshold: int = 5) -> str:
    return f"""
select {UNITS} total_units, {VALUE} total_value,
       count(case when s.quantity <= {threshold} then 1 end) low_stock_count,
       count(distinct s.store_id) stores_covered,
       {divide0(UNITS, 'count(distinct s.product_id)')} avg_units_per_product
from {table} s {where}"""


def low_stock_alerts(threshold: int = 5) -> str:
    return f"""
select st.store_name, s.product_id, p.product_name, p.brand_name, p.category_name, s.quantity,
       p.list_price unit_price, s.inventory_value, s.snapshot_date, {ALERT} alert_level
from fct_inventory s {STORE} {PRODUCT} where s.quantity <= {threshold}"""


SNAPSHOTS = f"""
select d.date_day snapshot_date, {UNITS} units, {VALUE} "value"
from fct_inventory_history s {DATE} group by 1"""


def change(measure: str, kind: str) -> str:
    prior = f'lag("{measure}") over (order by snapshot_date)'
    delta = f'("{measure}" - {prior})'
    return f"""{prior} prior_{measure}, cast({delta} as {kind}) {measure}_change,
       {divide0(delta, prior)} * 100 {measure}_change_pct"""


INVENTORY = {
    "inventory_kpis": inventory_kpis(),
    "inventory_value_by_store": f"""
select st.store_name, {VALUE} store_inventory_value from fct_inventory s {STORE} group by 1""",
    "units_by_store": f"""
select st.store_name, {UNITS} units from fct_inventory s {STORE} group by 1""",
    "inventory_trend": f"select snapshot_date, units total_units from ({SNAPSHOTS}) t",
    "units_by_category": f"""
select p.category_name, {UNITS} units_on_hand from fct_inventory s {PRODUCT} group by 1""",
    "inventory_value_by_brand": f"""
select p.brand_name, {VALUE} brand_inventory_value,
       {percent(VALUE, f'sum({VALUE}) over ()')} pct
from fct_inventory s {PRODUCT} group by 1""",
    "low_stock_alerts": low_stock_alerts(),
    "alert_level_counts": f"""
select {ALERT} alert_level, count(*) "rows" from fct_inventory s group by 1""",
    "low_stock_by_threshold": """
select cast(t.threshold as int) threshold, count(i.quantity) low_stock_count
from (select unnest(generate_series(1, 20)) threshold) t
left join fct_inventory i on i.quantity <= t.threshold group by 1""",
    "snapshot_dates": "select distinct snapshot_date from fct_inventory_history",
    "snapshot_change": f"""
select snapshot_date, units, {change('units', 'bigint')}, "value",
       {change('value', 'decimal(28,2)')}
from ({SNAPSHOTS}) t""",
    "snapshot_as_of": inventory_kpis(
        "fct_inventory_history", "where s.snapshot_date = date '2001-07-02'"
    ),
    "store_inventory_share": f"""
select st.store_name, {VALUE} "value",
       {divide0(VALUE, f'sum({VALUE}) over ()')} * 100 share_pct
from fct_inventory s {STORE} group by 1""",
    "is_low_stock": """
select store_id, product_id, quantity, quantity <= 5 is_low_stock from fct_inventory""",
    "low_stock_products": """
select product_id, min(quantity) lowest_quantity from fct_inventory group by 1
having min(quantity) <= 5""",
    "days_of_supply": f"""
with snap as (select max(snapshot_date) d from fct_inventory),
sold as (
  select f.dim_store_sk, f.dim_product_sk, cast(sum(f.quantity) as bigint) units_sold
  from fct_sales f cross join snap
  where f.order_date >= snap.d - 90 and f.order_date < snap.d group by 1, 2
),
rated as (
  select i.store_id, i.product_id, i.snapshot_date, i.quantity,
         coalesce(sold.units_sold, 0) units_sold,
         cast(coalesce(sold.units_sold, 0) as double) / 90 avg_daily_units
  from fct_inventory i left join sold
    on sold.dim_store_sk = i.dim_store_sk and sold.dim_product_sk = i.dim_product_sk
)
select *, {ratio('quantity', 'avg_daily_units')} days_of_supply from rated""",
}


def top_label(names: str, out: str) -> str:
    return f"""
with t as ({names})
select case when count(*) > 1 then 'Multiple' else max(name) end {out},
       cast(sum(revenue) as decimal(28,2)) revenue
from t where revenue = (select max(revenue) from t)"""


ORDERS = "count(distinct s.order_id)"

PERFORMANCE = {
    "performance_kpis": f"""
select count(distinct s.dim_product_sk) products_sold,
       (select count(*) from dim_staff where is_active and staff_id <> -1) active_staff,
       {mean('s.discount')} * 100 avg_discount_pct
from fct_sales s""",
    "performance_kpis_yoy": f"""
with y as (
  select d.year_number, count(distinct s.dim_product_sk) products,
         {mean('s.discount')} * 100 pct
  from fct_sales s {DATE} group by 1
)
select coalesce(a.year_number, b.year_number + 1) year_number, a.products products_sold,
       b.products py_products_sold, a.pct avg_discount_pct, b.pct py_avg_discount_pct
from y a full join y b on b.year_number = a.year_number - 1""",
    "top_brand": top_label(
        f"select p.brand_name as name, {REVENUE} revenue from fct_sales s {PRODUCT} group by 1",
        "brand_name",
    ),
    "top_staff": top_label(
        f"select sf.full_name as name, {REVENUE} revenue from fct_sales s {STAFF} group by 1",
        "staff_name",
    ),
    "revenue_by_brand": f"""
select brand_name, brand_revenue, units_sold, order_count,
       dense_rank() over (order by brand_revenue desc) revenue_rank,
       {divide0('brand_revenue', 'sum(brand_revenue) over ()')} * 100 share_pct
from (select p.brand_name, {REVENUE} brand_revenue, {UNITS} units_sold, {ORDERS} order_count
      from fct_sales s {PRODUCT} group by 1) t""",
    "revenue_by_model_year": f"""
select p.model_year, {REVENUE} revenue, {UNITS} units_sold, {ORDERS} orders
from fct_sales s {PRODUCT} where p.model_year is not null group by 1""",
    "revenue_by_model_year_group": f"""
select case when p.model_year >= 2018 then '2018 (Current)' when p.model_year = 2017 then '2017'
            when p.model_year = 2016 then '2016' when p.model_year <= 2015 then '2015 & Earlier'
            else 'Unknown' end model_year_group, {REVENUE} revenue, {UNITS} units_sold
from fct_sales s {PRODUCT} group by 1""",
    "category_revenue_share": f"""
select p.category_name, {REVENUE} category_revenue,
       {percent(REVENUE, f'sum({REVENUE}) over ()')} revenue_pct
from fct_sales s {PRODUCT} group by 1""",
    "avg_discount_by_category": f"""
select p.category_name, {mean('s.discount')} avg_discount_rate,
       {mean('s.discount')} * 100 avg_discount_pct, {ORDERS} orders
from fct_sales s {PRODUCT} group by 1""",
    "staff_leaderboard": f"""
select *, dense_rank() over (order by revenue desc) revenue_rank from (
  select sf.staff_id, sf.full_name staff_name, sf.manager_full_name, st.store_name, sf.is_active,
         {ORDERS} orders_handled, {REVENUE} revenue, {divide0(REVENUE, ORDERS)} avg_order_value
  from fct_sales s {STAFF} join dim_store st on sf.store_id = st.store_id
  where sf.staff_id <> -1 and sf.is_active group by 1, 2, 3, 4, 5) t""",
    "top_customers": f"""
select c.full_name customer_name, c.city, c.state, {ORDERS} orders, {REVENUE} revenue
from fct_sales s {CUSTOMER} group by 1, 2, 3
order by revenue desc, customer_name nulls last, city nulls last, state nulls last limit 10""",
    "repeat_customers": f"""
select c.customer_id, c.full_name customer_name, {ORDERS} orders, {REVENUE} revenue
from fct_sales s {CUSTOMER} where c.customer_id <> -1 group by 1, 2 having {ORDERS} > 1""",
    "guest_revenue": f"""
select case when s.dim_customer_sk = {MISSING} then 'Guest' else 'Registered' end customer_type,
       {ORDERS} orders, {REVENUE} revenue
from fct_sales s group by 1""",
    "discount_yoy": f"""
with m as (
  select d.year_number, d.month_number, {mean('s.discount')} * 100 pct
  from fct_sales s {DATE} group by 1, 2
)
select coalesce(a.year_number, b.year_number + 1) year_number,
       coalesce(a.month_number, b.month_number) month_number, a.pct avg_discount_pct,
       b.pct py_avg_discount_pct, a.pct - b.pct change_pp
from m a full join m b on b.year_number = a.year_number - 1 and b.month_number = a.month_number""",
    "staff_level": """
select staff_id, full_name, case when manager_id is null then 'Manager' else 'Staff' end staff_level
from dim_staff""",
    "manager_rollup": f"""
select m.staff_id manager_id, m.full_name manager_name, count(distinct sf.staff_id) selling_staff,
       {ORDERS} orders, {REVENUE} revenue
from fct_sales s {STAFF} join dim_staff m on sf.manager_dim_staff_sk = m.dim_staff_sk
group by 1, 2""",
}

FILTERS = {
    "filter_period": f"""
select d.year_number, d.month_number, d.month_name, {REVENUE} monthly_revenue
from fct_sales s {DATE} where d.year_number = 1997 and d.quarter_number in (1, 4)
group by 1, 2, 3""",
    "filter_store": sales_kpis("where st.store_name in ('ASIA Store', 'EUROPE Store')", STORE),
    "filter_store_pushed": sales_kpis("where st.store_name in ('ASIA Store', 'EUROPE Store')", STORE),
    "filter_category": sales_kpis("where p.category_name in ('STANDARD', 'PROMO')", PRODUCT),
    "filter_brand": sales_kpis("where p.brand_name in ('Brand#11', 'Brand#23')", PRODUCT),
    "filter_brand_pushed": sales_kpis("where p.brand_name in ('Brand#11', 'Brand#23')", PRODUCT),
    "filter_status": sales_kpis("where s.order_status_label = 'Completed'"),
    "filter_staff": sales_kpis(
        "where sf.full_name in ('First1 Last1', 'First2 Last2') and st.store_name = 'ASIA Store'",
        f"{STAFF} join dim_store st on sf.store_id = st.store_id",
    ),
    "filter_snapshot": f"""
select st.store_name, {UNITS} units from fct_inventory_history s {STORE}
where s.snapshot_date = date '2001-07-01' group by 1""",
    "filter_threshold": low_stock_alerts(12),
    "filter_date_range": trend(
        "d.date_day between date '1996-03-15' and date '1997-02-10'"
    ),
    "filter_since": trend("d.date_day >= date '1998-02-01'"),
    "filter_until": trend("d.date_day <= date '1995-06-30'"),
    "filter_quarter": trend("d.quarter_number = 2"),
    "filter_first_load": sales_kpis("where d.year_number = 1997", DATE),
    "filter_year_yoy": revenue_yoy("where year_number in (1995, 1997)"),
    "filter_brand_share": f"""
with all_brands as (
  select p.brand_name, {REVENUE} brand_revenue, {UNITS} units_sold, {ORDERS} order_count
  from fct_sales s {PRODUCT} group by 1
)
select *, dense_rank() over (order by brand_revenue desc) revenue_rank,
       {divide0('brand_revenue', '(select sum(brand_revenue) from all_brands)')} * 100 share_pct
from all_brands where brand_name in ('Brand#11', 'Brand#23')""",
    "filter_category_share": f"""
with all_categories as (
  select p.category_name, {REVENUE} category_revenue from fct_sales s {PRODUCT} group by 1
)
select *, {percent('category_revenue', '(select sum(category_revenue) from all_categories)')}
       revenue_pct
from all_categories where category_name in ('STANDARD', 'PROMO')""",
    "filter_brand_inventory": f"""
with all_brands as (
  select p.brand_name, {VALUE} brand_inventory_value from fct_inventory s {PRODUCT} group by 1
)
select *, {percent('brand_inventory_value', '(select sum(brand_inventory_value) from all_brands)')}
       pct
from all_brands where brand_name = 'Brand#11'""",
}


def cast_columns(schema: str, table: str) -> str:
    columns = contract.SOURCES[schema][table]
    return f"select {', '.join(f'cast({n} as {k}) {n}' for n, k in columns)} from src_{table}"


def landed(table: str) -> str:
    """What one load lands: stocks as they are on the newest date."""
    where = " where ingestion_date = date '2001-07-03'" if table == "stocks" else ""
    return f"src_{table}{where}"


def manifest(*schemas: str) -> str:
    return "\nunion all\n".join(
        f"""select 'supabase' source, '{schema}' "schema", '{table}' "table",
       date '2001-07-03' ingestion_date, 'full_load' ingestion_strategy, count(*) row_count
from {landed(table)}"""
        for schema in schemas
        for table in contract.SOURCES[schema]
    )


def reconciled() -> str:
    """Every table landed once, stocks once a date and again on the newest; all as recorded."""
    loads = [
        f"""select 'supabase' source, '{schema}' "schema", '{table}' "table", date '2001-07-03' ingestion_date,
       'first' run_id, count(*) recorded, count(*) found, 'same' status from src_{table}"""
        for schema in contract.SOURCES
        for table in contract.SOURCES[schema]
        if table != "stocks"
    ]
    loads.append("""select 'supabase', 'production', 'stocks', ingestion_date, 'run' || (k - 1 + again), count(*), count(*), 'same'
from (select *, dense_rank() over (order by ingestion_date) k, max(ingestion_date) over () last from src_stocks)
join (values (0), (1)) v(again) on again = 0 or ingestion_date = last
group by ingestion_date, k, again""")
    return "\nunion all\n".join(loads)


def model_counts() -> str:
    names = [name for name in [*STAGING, *GOLD] if name != "stg_stocks_history"]
    return "\nunion all\n".join(
        f"select '{name}' model, count(*) row_count from {name}" for name in names
    )


INGEST = {
    "jdbc_full_load": cast_columns("sales", "orders"),
    "source_catalog": "\nunion all\n".join(
        f"select '{s}' table_schema, '{t}' table_name, count(*) row_count from {landed(t)}"
        for s in contract.SOURCES
        for t in contract.SOURCES[s]
    ),
    "ingest_sales": manifest("sales"),
    "ingest_production": manifest("production"),
    "ingest_manifest": manifest("sales", "production"),
    "manifest_reconciliation": reconciled(),
    "raw_snapshot_write": cast_columns("sales", "customers"),
    "raw_scan": "select store_id, product_id, quantity, ingestion_date from src_stocks",
    "model_write": "select * from fct_sales",
    "build_warehouse": model_counts(),
}

KEYS = {
    "latest_full_load": """
select * from src_stocks where ingestion_date = (select max(ingestion_date) from src_stocks)""",
    "surrogate_key": f"""
select order_id, item_id, {sk('order_id', 'item_id')} sales_pk, {sk('product_id')} dim_product_sk
from src_order_items""",
    "keyed_nulls": f"""
select order_id, customer_id,
       case when customer_id is null then {MISSING} else {sk('customer_id')} end dim_customer_sk,
       {sk('customer_id')} unkeyed_sk
from src_orders""",
    "missing_member": f"""
select 'dim_customer' dimension, count(*) members, count(case when dim_customer_sk = {MISSING}
       then 1 end) missing_members from dim_customer
union all
select 'dim_product', count(*), count(case when dim_product_sk = {MISSING} then 1 end)
from dim_product
union all
select 'dim_store', count(*), count(case when dim_store_sk = {MISSING} then 1 end) from dim_store
union all
select 'dim_staff', count(*), count(case when dim_staff_sk = {MISSING} then 1 end) from dim_staff
union all
select 'dim_date', count(*), count(case when dim_date_sk = {MISSING} then 1 end) from dim_date""",
}


def check_sql(model: str, column: str, test: str, failing: str) -> str:
    return f"""select '{model}' model, '{column}' column_name, '{test}' test,
       ({failing}) failing_rows"""


def unique(columns: dict[str, tuple[str, ...]]) -> list[str]:
    return [
        check_sql(m, c, "unique", f"""select count(*) from (select {c} from {m}
       where {c} is not null group by {c} having count(*) > 1) t""")
        for m, names in columns.items()
        for c in names
    ]


NOT_NULL = [
    check_sql(m, c, "not_null", f"select count(*) from {m} where {c} is null")
    for m, names in contract.FILLED.items()
    for c in names
]
ACCEPTED = [
    check_sql(m, "order_status", "accepted_values", f"""select count(distinct order_status)
       from {m} where order_status not in ({', '.join(map(str, contract.STATUS_VALUES))})""")
    for m in contract.STATUS_MODELS
]
RELATIONSHIPS = [
    check_sql(fact, f"{dim}_sk", "relationships", f"""select count(*) from {fact}
       where {dim}_sk is not null
       and not exists (select 1 from {dim} p where p.{dim}_sk = {fact}.{dim}_sk)""")
    for fact, dims in contract.PARENTS.items()
    for dim in dims
]


def checks_sql(checks: list[str]) -> str:
    rows = "\nunion all\n".join(checks)
    return f"""
select *, case when failing_rows = 0 then 'pass' else 'fail' end status from ({rows}) t"""


QUALITY = {
    "dq_unique": checks_sql(unique(contract.UNIQUE)),
    "dq_not_null": checks_sql(NOT_NULL),
    "dq_accepted_values": checks_sql(ACCEPTED),
    "dq_relationships": checks_sql(RELATIONSHIPS),
    "dq_suite": checks_sql([*unique(contract.UNIQUE), *NOT_NULL, *ACCEPTED, *RELATIONSHIPS]),
    "dq_composite_unique": checks_sql(unique(contract.COMPOSITE_UNIQUE)),
}

MODELS = {name: f"select * from {name}" for name in [*STAGING, *GOLD]}
MODELS["dim_date"] = calendar(
    "(select date_trunc('year', min(order_date)) from src_orders)",
    "(select date_trunc('year', max(order_date)) + interval 1 year - interval 1 day "
    "from src_orders)",
)
del MODELS["stg_stocks_history"]

STREAM = {"snapshot_stream": "select * from fct_inventory_history"}


STATEMENTS = {
    **INGEST,
    **KEYS,
    **MODELS,
    **QUALITY,
    **SALES,
    **INVENTORY,
    **PERFORMANCE,
    **FILTERS,
    **STREAM,
}


def oracle_sql() -> dict[str, str]:
    """Each statement behind the definitions of all tables, over the driver's tables."""
    return {name: with_tables(sql) for name, sql in STATEMENTS.items()}
