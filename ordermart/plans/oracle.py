"""Independent DuckDB SQL for every registered query.

The SQL restates the binding, the ETL and each question directly in SQL,
in the most literal form (two-scan self-join for the order pivot, a global
``row_number()`` for surrogate ids, ``QUALIFY`` for dedupe, ``strftime('%U')``
for Sunday weeks), so that it shares no code path with the Spark plans.
"""

from __future__ import annotations

from ..sources import binding as b
from . import history as h
from .warehouse import CUT, RUN_DATE

OPEN_END = "DATE '9999-12-31'"
DEFAULT_MARK = "TIMESTAMP '1900-01-01 00:00:00'"


def _secs(expr: str) -> str:
    return f"to_seconds(CAST({expr} AS BIGINT))"


SOURCES = f"""
geo AS (
  SELECT n.n_nationkey, n.n_name, r.r_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
customer_master AS (
  SELECT c.c_custkey AS customerid, c.c_name AS name, c.c_name || ' street' AS address,
         g.n_name AS city, g.r_name AS state,
         CAST({b.PINCODE_BASE} + c.c_custkey % {b.PINCODE_SPREAD} AS BIGINT) AS pincode,
         TIMESTAMP '{b.CUSTOMER_EPOCH}' + {_secs(f"(c.c_custkey % {b.CUSTOMER_DAY_SPREAD}) * 86400")} AS update_timestamp
  FROM customer c LEFT JOIN geo g ON c.c_nationkey = g.n_nationkey),
product_master AS (
  SELECT p_partkey AS productid, p_brand AS productcode, p_name AS productname,
         CAST(p_size AS VARCHAR) || 'KG' AS sku, CAST(floor(p_retailprice) AS BIGINT) AS rate,
         p_partkey % 5 <> 0 AS isactive
  FROM part),
ev AS (
  SELECT o_orderkey AS orderid, o_custkey AS customerid, o_orderstatus AS st,
         o_orderdate + {_secs(f"o_orderkey * {b.RECEIVED_MULT} % 86400")} AS t_r
  FROM orders),
ev2 AS (
  SELECT *, t_r + {_secs(f"1 + orderid * {b.INPROGRESS_MULT} % 86400")} AS t_i FROM ev),
ev3 AS (
  SELECT *, t_i + {_secs(f"1 + orderid * {b.DELIVERED_MULT} % 86400")} AS t_d FROM ev2),
order_details AS (
  SELECT orderid, customerid, t_r AS order_status_update_timestamp, 'Received' AS order_status FROM ev3
  UNION ALL
  SELECT orderid, customerid, t_i, 'InProgress' FROM ev3 WHERE st IN ('P', 'F')
  UNION ALL
  SELECT orderid, customerid, t_d, 'Delivered' FROM ev3 WHERE st = 'F'),
order_items AS (
  SELECT l_orderkey AS orderid, l_partkey AS productid, CAST(l_quantity AS BIGINT) AS quantity
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber, l_quantity) = 1)"""


def etl_ctes(cust_mark: str = DEFAULT_MARK, order_mark: str = DEFAULT_MARK,
             history: bool = False, run_date: str = RUN_DATE, dedupe: str = "row") -> str:
    """CTEs for one batch: deltas, stage rows, dims and facts.

    ``history=False``: first batch into an empty warehouse.
    ``history=True``: the existing dimensions of ``plans/history.py``.
    """
    if history:
        existing = f"""
old_dim_customer AS (
  SELECT customerid, name, CAST(NULL AS BIGINT) AS address_id,
         CAST(update_timestamp AS DATE) AS start_date, {OPEN_END} AS end_date
  FROM customer_master WHERE customerid % {h.CUSTOMER_MOD} <> 0),
old_dim_address AS (
  SELECT row_number() OVER (ORDER BY customerid) AS address_id, address, city, state, pincode
  FROM customer_master WHERE customerid % {h.CUSTOMER_MOD} <> 0),
old_dim_product AS (
  SELECT productid, productcode, productname, sku,
         CASE WHEN productid % {h.PRODUCT_MOD} = 1 THEN rate - 1 ELSE rate END AS rate,
         isactive, DATE '{h.PRODUCT_HISTORY_START}' AS start_date, {OPEN_END} AS end_date
  FROM product_master WHERE productid % {h.PRODUCT_MOD} <> 0),"""
    else:
        existing = """
old_dim_customer AS (SELECT * FROM (SELECT CAST(NULL AS BIGINT) AS customerid) WHERE false),
old_dim_address AS (
  SELECT * FROM (SELECT CAST(NULL AS BIGINT) AS address_id, CAST(NULL AS VARCHAR) AS address,
    CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state, CAST(NULL AS BIGINT) AS pincode) WHERE false),
old_dim_product AS (
  SELECT * FROM (SELECT CAST(NULL AS BIGINT) AS productid, CAST(NULL AS VARCHAR) AS productcode,
    CAST(NULL AS VARCHAR) AS productname, CAST(NULL AS VARCHAR) AS sku, CAST(NULL AS BIGINT) AS rate,
    CAST(NULL AS BOOLEAN) AS isactive, CAST(NULL AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date) WHERE false),"""
    return f"""{SOURCES},{existing}
delta_customer AS (SELECT * FROM customer_master WHERE update_timestamp >= {cust_mark}),
delta_orders AS (SELECT * FROM order_details WHERE order_status_update_timestamp >= {order_mark}),
delta_products AS (SELECT * FROM product_master),
delta_items AS (
  SELECT * FROM order_items WHERE orderid IN (
    SELECT DISTINCT orderid FROM order_details
    WHERE order_status_update_timestamp >= {order_mark} AND order_status = 'InProgress')),
stg_address_all AS (
  SELECT (SELECT coalesce(max(address_id), 0) FROM old_dim_address)
         + row_number() OVER (ORDER BY customerid) AS address_id,
         address, city, state, pincode
  FROM delta_customer),
stg_address_nk AS (
  SELECT (SELECT coalesce(max(address_id), 0) FROM old_dim_address)
         + row_number() OVER (ORDER BY min_customerid) AS address_id,
         address, city, state, pincode
  FROM (SELECT address, city, state, pincode, min(customerid) AS min_customerid
        FROM delta_customer d WHERE NOT EXISTS (
          SELECT 1 FROM old_dim_address o
          WHERE o.address IS NOT DISTINCT FROM d.address AND o.city IS NOT DISTINCT FROM d.city
            AND o.state IS NOT DISTINCT FROM d.state AND o.pincode IS NOT DISTINCT FROM d.pincode)
        GROUP BY address, city, state, pincode)),
stg_address_row AS (
  SELECT * FROM stg_address_all s WHERE NOT EXISTS (
    SELECT 1 FROM old_dim_address o
    WHERE o.address_id IS NOT DISTINCT FROM s.address_id AND o.address IS NOT DISTINCT FROM s.address
      AND o.city IS NOT DISTINCT FROM s.city AND o.state IS NOT DISTINCT FROM s.state
      AND o.pincode IS NOT DISTINCT FROM s.pincode)),
stg_dim_address AS (SELECT * FROM stg_address_{dedupe}),
address_lookup AS (SELECT * FROM old_dim_address UNION ALL SELECT * FROM stg_dim_address),
cust_rows AS (
  SELECT d.customerid, d.name, a.address_id, CAST(d.update_timestamp AS DATE) AS start_date,
         {OPEN_END} AS end_date
  FROM delta_customer d LEFT JOIN address_lookup a
    ON d.address IS NOT DISTINCT FROM a.address AND d.city IS NOT DISTINCT FROM a.city
   AND d.state IS NOT DISTINCT FROM a.state AND d.pincode IS NOT DISTINCT FROM a.pincode),
stg_dim_customer AS (
  SELECT * FROM cust_rows WHERE customerid NOT IN (SELECT customerid FROM old_dim_customer)),
stg_dim_customer_updates AS (
  SELECT * FROM cust_rows WHERE customerid IN (SELECT customerid FROM old_dim_customer)),
product_changes AS (
  SELECT * FROM delta_products d WHERE NOT EXISTS (
    SELECT 1 FROM old_dim_product o
    WHERE o.productid IS NOT DISTINCT FROM d.productid AND o.productcode IS NOT DISTINCT FROM d.productcode
      AND o.productname IS NOT DISTINCT FROM d.productname AND o.sku IS NOT DISTINCT FROM d.sku
      AND o.rate IS NOT DISTINCT FROM d.rate AND o.isactive IS NOT DISTINCT FROM d.isactive)),
stg_dim_product AS (
  SELECT productid, productcode, productname, sku, rate, isactive,
         DATE '{run_date}' AS start_date, {OPEN_END} AS end_date
  FROM product_changes WHERE productid NOT IN (SELECT productid FROM old_dim_product)),
stg_dim_product_updates AS (
  SELECT productid, productcode, productname, sku, rate, isactive, DATE '{run_date}' AS end_date
  FROM product_changes WHERE productid IN (SELECT productid FROM old_dim_product)),
stg_dim_order AS (
  SELECT orderid, order_status_update_timestamp, order_status FROM delta_orders),
received AS (
  SELECT customerid, orderid, order_status_update_timestamp AS ts FROM delta_orders
  WHERE order_status = 'Received' AND orderid IS NOT NULL AND customerid IS NOT NULL
    AND order_status_update_timestamp IS NOT NULL),
delivered AS (
  SELECT customerid, orderid, order_status_update_timestamp AS ts FROM delta_orders
  WHERE order_status = 'Delivered' AND orderid IS NOT NULL AND customerid IS NOT NULL
    AND order_status_update_timestamp IS NOT NULL),
stg_f_order_details AS (
  SELECT i.orderid, d.ts AS order_delivery_timestamp, i.productid, i.quantity
  FROM delta_items i LEFT JOIN delivered d ON i.orderid = d.orderid),
amounts AS (
  SELECT l.orderid, sum(l.quantity * p.rate) AS order_amount, sum(l.quantity) AS item_count
  FROM stg_f_order_details l LEFT JOIN delta_products p ON l.productid = p.productid
  GROUP BY l.orderid),
stg_fact_daily_orders AS (
  SELECT r.customerid, r.orderid, r.ts AS order_received_timestamp,
         d.ts AS order_delivery_timestamp,
         CAST(coalesce(c.pincode, 0) AS BIGINT) AS pincode,
         CAST(coalesce(a.order_amount, 0) AS BIGINT) AS order_amount,
         CAST(coalesce(a.item_count, 0) AS BIGINT) AS item_count,
         CAST(coalesce(date_diff('second', r.ts, d.ts), 0) AS BIGINT) AS order_delivery_time_seconds
  FROM received r
  LEFT JOIN delivered d ON r.customerid = d.customerid AND r.orderid = d.orderid
  LEFT JOIN amounts a ON r.orderid = a.orderid
  LEFT JOIN delta_customer c ON r.customerid = c.customerid),
fact_daily_orders AS (SELECT * FROM stg_fact_daily_orders),
f_order_details AS (SELECT * FROM stg_f_order_details),
dim_customer AS (SELECT * FROM stg_dim_customer),
dim_address AS (SELECT * FROM stg_dim_address),
dim_product AS (SELECT * FROM stg_dim_product)"""


def _with(body: str, extra: str = "", **kw) -> str:
    return f"WITH {etl_ctes(**kw)}{',' if extra else ''}{extra}\n{body}"


_FACT_GEO = """FROM fact_daily_orders f
LEFT JOIN dim_customer c ON f.customerid = c.customerid
LEFT JOIN dim_address a ON c.address_id = a.address_id"""
_FACT_GEO_INNER = """FROM fact_daily_orders f
JOIN dim_customer c ON f.customerid = c.customerid
JOIN dim_address a ON c.address_id = a.address_id"""

_GRAIN_SQL = {
    "day": ("Daily", "CAST(extract(day FROM f.order_received_timestamp) AS BIGINT)"),
    "month": ("Monthly", "CAST(extract(month FROM f.order_received_timestamp) AS BIGINT)"),
    "week": ("Weekly", "CAST(strftime(f.order_received_timestamp, '%U') AS BIGINT)"),
    "state": ("State", "a.state"),
    "city": ("City", "a.city"),
    "pincode": ("Pincode", "f.pincode"),
}


def _q_avg(measure: str, alias: str, grain: str) -> str:
    name, expr = _GRAIN_SQL[grain]
    return _with(f'SELECT {expr} AS "{name}", avg({measure}) AS {alias}\n{_FACT_GEO}\nGROUP BY 1')


def _delivery(agg: str, grain: str) -> str:
    ts = "f.order_delivery_timestamp"
    keys = [f'CAST({ts} AS DATE) AS "DATES"',
            f"CAST(strftime({ts}, '%U') AS BIGINT) AS \"WEEKS\"",
            f'CAST(dayofweek({ts}) + 1 AS BIGINT) AS "WEEKDAYS"',
            f'CAST(extract(month FROM {ts}) AS BIGINT) AS "MONTHS"',
            'a.city AS "City"']
    if grain == "hour":
        keys.insert(4, f'CAST(extract(hour FROM {ts}) AS BIGINT) AS "HOURS"')
    elif grain == "weekend":
        keys = [f'dayofweek({ts}) IN (0, 6) AS "WEEKEND"', 'a.city AS "City"']
    elif grain != "base":
        keys = {"daily": keys[:1], "weekday": keys[2:3], "monthly": keys[3:4], "state": ['a.state'],
                "pincode": ['a.pincode AS address_pincode']}[grain]
    n = len(keys)
    return _with(f"SELECT {', '.join(keys)}, {agg}\n{_FACT_GEO_INNER}\n"
                 f"GROUP BY {', '.join(str(i) for i in range(1, n + 1))}")


def analytics_sql() -> dict[str, str]:
    q = {}
    for g in _GRAIN_SQL:
        q[f"q01_avg_items_by_{g}"] = _q_avg("item_count", "avg_items", g)
        q[f"q02_avg_sales_by_{g}"] = _q_avg("order_amount", "avg_sales", g)
    q3_keys = 'p.productname, p.sku, CAST(extract(day FROM f.order_delivery_timestamp) AS BIGINT) AS "DAY"'
    q3_from = "FROM dim_product p JOIN f_order_details f ON p.productid = f.productid"
    q["q03_units_by_sku_day"] = _with(
        f"SELECT {q3_keys}, CAST(sum(quantity) AS BIGINT) AS units_sold\n{q3_from}\nGROUP BY 1, 2, 3")
    q["q03_units_by_sku_month"] = _with(
        f"SELECT {q3_keys}, CAST(extract(month FROM f.order_delivery_timestamp) AS BIGINT) AS \"MONTH\", "
        f"CAST(sum(quantity) AS BIGINT) AS units_sold\n{q3_from}\nGROUP BY 1, 2, 3, 4")
    q["q04_sales_by_date_product_city"] = _with(
        """SELECT CAST(f.order_received_timestamp AS DATE) AS "Daily", o.productid, a.city,
       CAST(sum(order_amount) AS BIGINT) AS total_sales
FROM fact_daily_orders f
JOIN f_order_details o ON f.orderid = o.orderid
JOIN dim_customer c ON f.customerid = c.customerid
JOIN dim_address a ON c.address_id = a.address_id
GROUP BY 1, 2, 3 ORDER BY "Daily\"""")
    for g, keys in {"city": "a.state, a.city", "state": "a.state",
                    "pincode": "a.state, a.city, a.pincode"}.items():
        suffix = "" if g == "city" else f"_{g}"
        q[f"q05_orders_by_area{suffix}"] = _with(
            f'SELECT {keys}, count(DISTINCT f.orderid) AS "NumberOfOrders"\n{_FACT_GEO_INNER}\n'
            f"GROUP BY {keys}")
    q["q06_avg_amount_customer_date"] = _with(
        """SELECT customerid, CAST(order_received_timestamp AS DATE) AS "Date",
       round(avg(order_amount), 2) AS "OrderAmount"
FROM fact_daily_orders GROUP BY 1, 2""")
    q["q07_new_customers_by_date"] = _with(
        """SELECT start_date AS "START_DATE", count(customerid) AS "NewCustomers"
FROM dim_customer
WHERE customerid IN (SELECT customerid FROM dim_customer GROUP BY customerid HAVING count(*) = 1)
GROUP BY start_date""")
    q["q08_counts_by_date"] = _with(
        """SELECT DISTINCT CAST(order_received_timestamp AS DATE) AS "Dates",
       count(*) OVER (PARTITION BY CAST(order_received_timestamp AS DATE)) AS "CustomerCounts"
FROM fact_daily_orders GROUP BY order_received_timestamp ORDER BY "Dates\"""")
    q["q08b_customers_by_date"] = _with(
        """SELECT CAST(order_received_timestamp AS DATE) AS "Dates", count(DISTINCT customerid) AS "Customers"
FROM fact_daily_orders GROUP BY 1""")
    day = 'CAST(f.order_received_timestamp AS DATE) AS "Daily"'
    q["q04_daily"] = _with(f"SELECT {day}, CAST(sum(order_amount) AS BIGINT) AS total_sales FROM fact_daily_orders f GROUP BY 1")
    q["q04_by_product"] = _with(f"""SELECT {day}, l.productid, CAST(sum(l.quantity * p.rate) AS BIGINT) AS total_sales
FROM fact_daily_orders f JOIN f_order_details l ON f.orderid = l.orderid JOIN dim_product p ON l.productid = p.productid
GROUP BY 1, 2""")
    for g, keys in {"state": "a.state", "city": "a.state, a.city", "pincode": "a.state, a.city, a.pincode"}.items():
        q[f"q04_by_{g}"] = _with(f"SELECT {day}, {keys}, CAST(sum(order_amount) AS BIGINT) AS total_sales\n{_FACT_GEO_INNER}\n"
                                 f"GROUP BY 1, {keys}")
    ts = "f.order_delivery_timestamp"
    cells = {"date": f"CAST(CAST({ts} AS DATE) AS VARCHAR)", "weekday": f"CAST(dayofweek({ts}) + 1 AS VARCHAR)",
             "month": f"CAST(extract(month FROM {ts}) AS VARCHAR)", "state": "a.state", "city": "a.city"}
    q["q10_orders_grouping_sets"] = _with("\nUNION ALL\n".join(
        f"SELECT '{n}' AS slice, {c} AS value, count(f.orderid) AS \"NumberOfOrders\"\n{_FACT_GEO_INNER}\nGROUP BY 2"
        for n, c in cells.items()))
    def each(cells: dict[str, str], aggs: str, rows: str) -> str:
        """A question per column, with a null for each other column, one after another."""
        n = len(cells)
        return _with("\nUNION ALL\n".join(
            "SELECT " + ", ".join(f'{e if x == name else f"CAST(NULL AS {kind})"} AS "{x}"' for x, (e, kind) in cells.items())
            + f", CAST({2 ** n - 1 - 2 ** (n - 1 - i)} AS BIGINT) AS grouping_id, {aggs}\n{rows}\nGROUP BY {i + 1}"
            for i, name in enumerate(cells)))

    kinds = {n: ("VARCHAR" if g in ("state", "city") else "BIGINT") for g, (n, _) in _GRAIN_SQL.items()}
    grains = {_GRAIN_SQL[g][0]: (_GRAIN_SQL[g][1], kinds[_GRAIN_SQL[g][0]]) for g in ("day", "month", "week", "state", "city", "pincode")}
    q["q01_q02_grouping_sets"] = each(grains, "avg(item_count) AS avg_items, avg(order_amount) AS avg_sales", _FACT_GEO)
    q["q09_grouping_sets"] = each(
        {"DATES": (f"CAST({ts} AS DATE)", "DATE"), "WEEKDAYS": (f"CAST(dayofweek({ts}) + 1 AS BIGINT)", "BIGINT"),
         "MONTHS": (f"CAST(extract(month FROM {ts}) AS BIGINT)", "BIGINT"), "State": ("a.state", "VARCHAR"),
         "City": ("a.city", "VARCHAR"), "Pincode": ("a.pincode", "BIGINT")},
        'min(order_delivery_time_seconds) AS "MinDeliveryTime", max(order_delivery_time_seconds) AS "MaxDeliveryTime", '
        'avg(order_delivery_time_seconds) AS "AvgDeliveryTime", count(f.orderid) AS "NumberOfOrders"', _FACT_GEO_INNER)
    agg9 = ('min(order_delivery_time_seconds) AS "MinDeliveryTime", '
            'max(order_delivery_time_seconds) AS "MaxDeliveryTime", '
            'avg(order_delivery_time_seconds) AS "AvgDeliveryTime"')
    agg10 = 'count(f.orderid) AS "NumberOfOrders"'
    for g in ("base", "hour", "weekend", "daily", "weekday", "monthly", "state", "pincode"):
        suffix = "" if g == "base" else f"_{g}"
        q[f"q09_delivery_time{suffix}"] = _delivery(agg9, g)
        q[f"q10_orders_sliced{suffix}"] = _delivery(agg10, g)
    return q


#: An old row is valid until the new version of its key starts; one row per version.
_SCD2_PRODUCT = f"""
SELECT o.productid, o.productcode, o.productname, o.sku, o.rate, o.isactive, o.start_date,
       CASE WHEN u.productid IS NOT NULL AND o.end_date = {OPEN_END}
            THEN greatest(o.start_date, DATE '{RUN_DATE}') ELSE o.end_date END AS end_date
FROM old_dim_product o LEFT JOIN stg_dim_product_updates u ON o.productid = u.productid
UNION ALL
SELECT productid, productcode, productname, sku, rate, isactive, DATE '{RUN_DATE}', {OPEN_END}
FROM stg_dim_product_updates
UNION ALL
SELECT productid, productcode, productname, sku, rate, isactive, start_date, end_date
FROM stg_dim_product"""
_CHANGED_CUSTOMERS = """(
  SELECT u.* FROM stg_dim_customer_updates u JOIN old_dim_customer o ON u.customerid = o.customerid
  WHERE u.name IS DISTINCT FROM o.name OR u.address_id IS DISTINCT FROM o.address_id)"""
_SCD2_CUSTOMER = f"""
SELECT o.customerid, o.name, o.address_id, o.start_date,
       CASE WHEN u.customerid IS NOT NULL AND o.end_date = {OPEN_END}
            THEN greatest(o.start_date, u.start_date) ELSE o.end_date END AS end_date
FROM old_dim_customer o LEFT JOIN {_CHANGED_CUSTOMERS} u ON o.customerid = u.customerid
UNION ALL
SELECT customerid, name, address_id, start_date, {OPEN_END} FROM {_CHANGED_CUSTOMERS} c
UNION ALL
SELECT customerid, name, address_id, start_date, end_date FROM stg_dim_customer"""


def _scd2_checks(rows: str, key: str, **kw) -> str:
    """Every pair of versions of a key is compared."""
    return _with(f"""
SELECT 'one_open_row' AS check_name, count(*) AS violations FROM (
  SELECT {key} FROM ({rows}) v WHERE end_date = {OPEN_END} GROUP BY {key} HAVING count(*) > 1)
UNION ALL
SELECT 'no_overlap', count(*) FROM (
  SELECT a.end_date, (SELECT min(b.start_date) FROM numbered b WHERE b.k = a.k AND b.n > a.n) AS following FROM numbered a)
WHERE following < end_date
UNION ALL
SELECT 'ends_after_start', count(*) FROM ({rows}) v WHERE end_date < start_date""", extra=f"""
numbered AS (SELECT {key} AS k, start_date, end_date,
                    row_number() OVER (PARTITION BY {key} ORDER BY start_date, end_date) AS n FROM ({rows}) v)""", **kw)


def etl_sql() -> dict[str, str]:
    inc = dict(cust_mark=f"TIMESTAMP '{h.CUSTOMER_MARK}'", order_mark=f"TIMESTAMP '{h.ORDER_MARK}'",
               history=True)
    q = {
        "etl_dim_address": _with("SELECT * FROM stg_dim_address", **inc),
        "etl_dim_customer_inserts": _with("SELECT * FROM stg_dim_customer", **inc),
        "etl_dim_customer_updates": _with("SELECT * FROM stg_dim_customer_updates", **inc),
        "etl_dim_product_inserts": _with("SELECT * FROM stg_dim_product", **inc),
        "etl_dim_product_updates": _with("SELECT * FROM stg_dim_product_updates", **inc),
        "etl_dim_address_natural_key": _with("SELECT * FROM stg_dim_address", dedupe="nk", **inc),
        "etl_dim_customer_inserts_natural_key": _with("SELECT * FROM stg_dim_customer", dedupe="nk", **inc),
        "etl_dim_customer_updates_natural_key": _with("SELECT * FROM stg_dim_customer_updates",
                                                      dedupe="nk", **inc),
        "etl_dim_order": _with("SELECT * FROM stg_dim_order", **inc),
        "etl_f_order_details": _with("SELECT * FROM stg_f_order_details", **inc),
        "etl_fact_daily_orders": _with("SELECT * FROM stg_fact_daily_orders", **inc),
        "etl_scd2_apply_product": _with(_SCD2_PRODUCT, **inc),
        "etl_scd2_apply_customer": _with(_SCD2_CUSTOMER, dedupe="nk", **inc),
        "scd2_checks_product": _scd2_checks(_SCD2_PRODUCT, "productid", **inc),
        "scd2_checks_customer": _scd2_checks(_SCD2_CUSTOMER, "customerid", dedupe="nk", **inc),
        "scd2_checks_not_closed": _scd2_checks(f"""
SELECT productid, start_date, end_date FROM old_dim_product
UNION ALL SELECT productid, DATE '{RUN_DATE}', {OPEN_END} FROM stg_dim_product_updates""", "productid", **inc),
        "dim_address_buckets": _with("""
SELECT CASE WHEN address_id BETWEEN 0 AND 999 THEN address_id // 100 ELSE -1 END AS bucket,
       count(*) AS addresses, CAST(max(address_id) AS BIGINT) AS max_id
FROM dim_address GROUP BY 1"""),
        "quality_raw_line_checks": """
SELECT 'lines.pk' AS check_name, (SELECT count(*) FROM lineitem)
       - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)) AS violations
UNION ALL
SELECT 'lines.open_order.fk', count(*) FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'F')""",
        "etl_high_water_mark": f"""
SELECT 'stg_dim_order' AS tablename, CAST(max(date_trunc('month', o_orderdate)) AS TIMESTAMP) AS mark FROM orders
UNION ALL SELECT 'stg_dim_product', {DEFAULT_MARK}
UNION ALL SELECT 'stg_dim_customer', {DEFAULT_MARK}""",
        "extract_customers_since": f"WITH {SOURCES}\nSELECT * FROM customer_master "
                                   f"WHERE update_timestamp >= TIMESTAMP '{h.CUSTOMER_MARK}'",
        "extract_orders_since": f"WITH {SOURCES}\nSELECT * FROM order_details "
                                f"WHERE order_status_update_timestamp >= TIMESTAMP '{h.ORDER_MARK}'",
        "extract_items_since": _with("SELECT * FROM delta_items", **inc),
        "dedupe_order_items": f"WITH {SOURCES}\nSELECT * FROM order_items",
        "quality_row_counts": f"""WITH {SOURCES}
SELECT 'customer_master' AS table_name, count(*) AS row_count FROM customer_master
UNION ALL SELECT 'product_master', count(*) FROM product_master
UNION ALL SELECT 'order_details', count(*) FROM order_details
UNION ALL SELECT 'order_items', count(*) FROM order_items""",
        "quality_max_keys": f"""WITH {SOURCES}
SELECT 'customer_master' AS table_name, CAST(coalesce(max(customerid), 0) AS BIGINT) AS max_key
FROM customer_master
UNION ALL SELECT 'product_master', CAST(coalesce(max(productid), 0) AS BIGINT) FROM product_master""",
        "quality_key_checks": f"""WITH {SOURCES}
SELECT 'customer_master.pk' AS check_name,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT customerid FROM customer_master)) AS BIGINT) AS violations
FROM customer_master
UNION ALL SELECT 'product_master.pk',
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT productid FROM product_master)) FROM product_master
UNION ALL SELECT 'order_details.pk',
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT orderid, order_status FROM order_details)) FROM order_details
UNION ALL SELECT 'order_items.pk',
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT orderid, productid FROM order_items)) FROM order_items
UNION ALL SELECT 'order_details.customerid.fk',
       count(*) FROM order_details d WHERE customerid IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer_master c WHERE c.customerid = d.customerid)
UNION ALL SELECT 'order_items.productid.fk',
       count(*) FROM order_items i WHERE productid IS NOT NULL AND NOT EXISTS (SELECT 1 FROM product_master p WHERE p.productid = i.productid)
UNION ALL SELECT 'customer_master.not_null', count(*) FROM customer_master
       WHERE customerid IS NULL OR name IS NULL OR update_timestamp IS NULL
UNION ALL SELECT 'product_master.not_null', count(*) FROM product_master
       WHERE productid IS NULL OR productcode IS NULL
UNION ALL SELECT 'order_details.not_null', count(*) FROM order_details
       WHERE orderid IS NULL OR customerid IS NULL OR order_status IS NULL
UNION ALL SELECT 'order_items.not_null', count(*) FROM order_items
       WHERE orderid IS NULL OR productid IS NULL OR quantity IS NULL""",
    }
    return q


def two_batches_facts(accumulate: bool) -> str:
    """The order fact after two batches; accumulate: deliveries count whatever their batch."""
    same = "" if accumulate else "AND d.batch = r.batch"
    return f"""{SOURCES},
events AS (
  SELECT *, CASE WHEN order_status_update_timestamp < TIMESTAMP '{CUT}' THEN 1 ELSE 2 END AS batch FROM order_details),
r AS (SELECT * FROM events WHERE order_status = 'Received'),
i AS (SELECT * FROM events WHERE order_status = 'InProgress'),
d AS (SELECT * FROM events WHERE order_status = 'Delivered'),
amounts AS (
  SELECT i.batch, orderid, sum(quantity * rate) AS amount, sum(quantity) AS units
  FROM i JOIN order_items USING (orderid) LEFT JOIN product_master USING (productid) GROUP BY i.batch, orderid),
facts AS (
  SELECT r.customerid, r.orderid, r.order_status_update_timestamp AS order_received_timestamp,
         d.order_status_update_timestamp AS order_delivery_timestamp, coalesce(c.pincode, 0) AS pincode,
         CAST(coalesce(amount, 0) AS BIGINT) AS order_amount, CAST(coalesce(units, 0) AS BIGINT) AS item_count,
         CAST(coalesce(date_diff('second', r.order_status_update_timestamp, d.order_status_update_timestamp), 0) AS BIGINT)
           AS order_delivery_time_seconds
  FROM r LEFT JOIN d ON d.orderid = r.orderid AND d.customerid = r.customerid {same}
  LEFT JOIN amounts x ON x.orderid = r.orderid AND x.batch = r.batch
  LEFT JOIN customer_master c ON c.customerid = r.customerid AND (r.batch = 1 OR c.update_timestamp >= TIMESTAMP '{CUT}'))"""


def two_batches_sql() -> dict[str, str]:
    counts = [("stg_dim_order", "events"), ("stg_fact_daily_orders", "r"), ("stg_f_order_details", "i JOIN order_items USING (orderid)")]
    first = [("stg_dim_customer", "customerid", "customer_master"), ("stg_dim_product", "productid", "product_master"),
             ("stg_dim_address", "(address, city, state, pincode)", "customer_master")]
    log = [f"SELECT b AS processlogid, '{t}' AS tablename, (SELECT count(*) FROM {rows} WHERE batch = b) AS extractrowcount, 'Completed' AS status "
           "FROM (VALUES (1), (2)) v(b)" for t, rows in counts]
    log += [f"SELECT b, '{t}', CASE b WHEN 1 THEN (SELECT count(DISTINCT {key}) FROM {rows}) ELSE 0 END, 'Completed' FROM (VALUES (1), (2)) v(b)"
            for t, key, rows in first]
    log = "\nUNION ALL ".join(log)
    steps = [("order_details", "source to delta", "events WHERE batch = 2"), ("product_master", "source to delta", "product_master"),
             ("customer_master", "source to delta", f"customer_master WHERE update_timestamp >= TIMESTAMP '{CUT}'"),
             ("dim_order", "delta to stage", "events WHERE batch = 2"),
             ("dim_address", "stage to target", "events WHERE false"), ("dim_customer", "stage to target", "events WHERE false"),
             ("dim_product", "stage to target", "events WHERE false"),
             *((t.removeprefix("stg_"), "stage to target", f"{rows} WHERE batch = 2") for t, rows in counts)]
    reconciled = "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, '{step}' AS step, (SELECT count(*) FROM {rows}) AS n" for t, step, rows in steps)
    return {
        "two_batches_fact_daily_orders": f"WITH {two_batches_facts(False)} SELECT * FROM facts",
        "two_batches_accumulated_orders": f"WITH {two_batches_facts(True)} SELECT * FROM facts",
        "two_batches_reconciled": f"""WITH {two_batches_facts(False)},
counts AS ({reconciled})
SELECT table_name, step, CAST(n AS BIGINT) AS rows_from, CAST(n AS BIGINT) AS rows_to, CAST(0 AS BIGINT) AS differences FROM counts""",
        "q05_two_batches_orders_by_city": f"""WITH {two_batches_facts(False)}
SELECT c.state, c.city, count(DISTINCT orderid) AS "NumberOfOrders"
FROM facts f JOIN customer_master c ON f.customerid = c.customerid GROUP BY 1, 2""",
        "two_batches_delivery_time_month": f"""WITH {two_batches_facts(True)}
SELECT CAST(date_trunc('month', order_delivery_timestamp) AS DATE) AS delivery_month, count(*) AS orders,
       min(order_delivery_time_seconds) AS fastest, max(order_delivery_time_seconds) AS slowest,
       CAST(sum(order_delivery_time_seconds) AS BIGINT) AS seconds
FROM facts WHERE order_delivery_timestamp IS NOT NULL GROUP BY 1""",
        "two_batches_extract_log": f"WITH {two_batches_facts(False)} SELECT CAST(processlogid AS BIGINT) AS processlogid, tablename, extractrowcount, status FROM ({log})",
        "late_events_dim_order": f"WITH {SOURCES} SELECT orderid, order_status_update_timestamp, order_status FROM order_details",
        "late_events_accumulated_orders": f"WITH {two_batches_facts(True)} SELECT * FROM facts",
        "oltp_insert_purge": f"""WITH {SOURCES}, n AS (SELECT count(*) AS n FROM order_items)
SELECT 'insert' AS step, n AS row_count FROM n UNION ALL SELECT 'insert again', 2 * n FROM n
UNION ALL SELECT 'purge', 0 UNION ALL SELECT 'insert after purge', n FROM n""",
    }


def scd2_batches_sql() -> dict[str, str]:
    """Both versions of what changed between the two batches, from the sources alone."""
    first, mark = f"DATE '{h.CUSTOMER_MARK[:10]}'", f"TIMESTAMP '{h.CUSTOMER_MARK}'"
    product = "productid, productcode, productname, sku"
    return {
        "scd2_batches_product": f"""WITH {SOURCES}
SELECT {product}, rate - 1 AS rate, isactive, {first} AS start_date, DATE '{RUN_DATE}' AS end_date
FROM product_master WHERE productid % {h.PRODUCT_MOD} = 1
UNION ALL
SELECT {product}, rate, isactive, CASE WHEN productid % {h.PRODUCT_MOD} IN (0, 1) THEN DATE '{RUN_DATE}' ELSE {first} END, {OPEN_END}
FROM product_master""",
        "scd2_batches_customer": f"""WITH {SOURCES},
old AS (SELECT *, row_number() OVER (ORDER BY customerid) AS address_id FROM customer_master WHERE customerid % {h.CUSTOMER_MOD} <> 0),
fresh AS (
  SELECT *, (SELECT count(*) FROM old) + row_number() OVER (ORDER BY customerid) AS address_id FROM customer_master
  WHERE customerid % {h.CUSTOMER_MOD} = 0 AND update_timestamp >= {mark}),
renamed AS (SELECT * FROM old WHERE customerid % {h.CUSTOMER_MOD} = 1 AND update_timestamp >= {mark})
SELECT customerid, CASE WHEN customerid % {h.CUSTOMER_MOD} = 1 THEN name || '{h.OLD_NAME}' ELSE name END AS name, address_id,
       CAST(update_timestamp AS DATE) - 365 AS start_date,
       CASE WHEN customerid IN (SELECT customerid FROM renamed) THEN CAST(update_timestamp AS DATE) ELSE {OPEN_END} END AS end_date
FROM old
UNION ALL
SELECT customerid, name, address_id, CAST(update_timestamp AS DATE), {OPEN_END} FROM renamed
UNION ALL
SELECT customerid, name, address_id, CAST(update_timestamp AS DATE), {OPEN_END} FROM fresh""",
    }


def all_sql() -> dict[str, str]:
    return {**analytics_sql(), **etl_sql(), **two_batches_sql(), **scd2_batches_sql()}
