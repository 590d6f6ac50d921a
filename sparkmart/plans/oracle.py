"""What every registered query must return, as DuckDB SQL over the test tables.

All checks read one wide relation, ``sold``: a row per loaded sale with its
buyer, offer and calendar attributes spelled out, straight from the TPC-H-style
tables.  A report is an aggregate of it, written here as the grouping that the
report's question asks for; nothing follows the star joins of the Spark plans,
so an error in either side shows.  Q19 compares exact integers.
"""

from __future__ import annotations

SOLD = """
span AS (SELECT make_date(year(min(o_orderdate)), 1, 1) AS first_day, make_date(year(max(o_orderdate)), 12, 31) AS last_day
         FROM orders),
buyer AS (
  SELECT c_custkey AS buyer_key, CASE c_custkey % 2 WHEN 0 THEN 'F' ELSE 'M' END AS sex,
         CASE c_custkey % 7 WHEN 0 THEN '0-17' WHEN 1 THEN '18-25' WHEN 2 THEN '26-35' WHEN 3 THEN '36-45'
                            WHEN 4 THEN '46-50' WHEN 5 THEN '51-55' ELSE '55+' END AS band,
         c_mktsegment AS job, chr(CAST(65 + n_regionkey AS INTEGER)) AS town,
         CAST(c_nationkey % 5 AS VARCHAR) || CASE c_nationkey % 5 WHEN 4 THEN '+' ELSE '' END AS years_there,
         c_custkey % 3 = 0 AS married
  FROM customer, nation WHERE n_nationkey = c_nationkey),
offer AS (
  SELECT p_partkey AS part_key, 'P' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS code, p_type AS kind,
         CAST(p_retailprice AS DOUBLE) AS list_price, s_nationkey AS shop_key, n_name AS shop, s_suppkey AS maker_key, s_name AS maker
  FROM part, supplier, nation
  WHERE s_suppkey = p_partkey % (SELECT count(*) FROM supplier) AND n_nationkey = s_nationkey),
line AS (
  SELECT l_orderkey, l_partkey, o_custkey, CAST(l_quantity AS INTEGER) AS pieces, CAST(o_orderdate AS DATE) AS day,
         row_number() OVER (PARTITION BY l_orderkey, l_partkey
                            ORDER BY l_linenumber, l_suppkey, l_quantity, l_shipdate, l_extendedprice) AS turn
  FROM lineitem, orders WHERE o_orderkey = l_orderkey),
sold AS (
  SELECT l_orderkey AS sale_key, code, kind, shop_key, shop, maker_key, maker, pieces, day, year(day) AS y, quarter(day) AS q,
         month(day) AS m, CASE WHEN isodow(day) > 5 THEN 'Weekend' ELSE 'Weekday' END AS part_of_week,
         CAST(list_price * pieces AS DECIMAL(12,2)) AS paid, buyer.*
  FROM line JOIN offer ON part_key = l_partkey JOIN buyer ON buyer_key = o_custkey
  WHERE turn = 1)"""

PAID = "CAST(sum(paid) AS DECIMAL(22,2))"

#: Output column: expression over ``sold``.
COLUMNS = {
    "year": "CAST(y AS INTEGER)", "quarter": "CAST(q AS INTEGER)", "month": "CAST(m AS INTEGER)", "day_type": "part_of_week",
    "city_category": "town", "gender": "sex", "age": "band", "occupation": "job", "marital_status": "married",
    "stay_in_current_city_years": "years_there", "product_category": "kind", "product_id": "code", "store_name": "shop",
    "supplier_name": "maker", "full_date": "day",
    "season": "['Winter', 'Spring', 'Summer', 'Fall'][CAST(m % 12 // 3 AS INTEGER) + 1]",
}


def by(names: str, measure: str, where: str = "true", total: str = PAID) -> str:
    """One measure per group of the named columns."""
    keys = ", ".join(f"{COLUMNS[n]} AS {n}" for n in names.split())
    return f"SELECT {keys}, {total} AS {measure} FROM sold WHERE {where} GROUP BY ALL"


def best(names: str, within: str, measure: str, place: str, where: str = "true") -> str:
    """The five best groups of each ``within``, ties included."""
    inner = ", ".join(within.split())
    return (f"SELECT *, CAST(rank() OVER (PARTITION BY {inner} ORDER BY {measure} DESC) AS INTEGER) AS {place} "
            f"FROM ({by(names, measure, where)}) QUALIFY {place} <= 5")


def change(names: str, series: str, along: str, measure: str, before: str, rate: str, where: str = "true") -> str:
    """Each group beside the one before it in its series, and the change in percent."""
    part, order = ", ".join(series.split()), ", ".join(along.split())
    return f"""SELECT *, (CAST({measure} AS DOUBLE) - CAST({before} AS DOUBLE)) / CAST(nullif({before}, 0) AS DOUBLE) * 100 AS {rate}
FROM (SELECT *, CAST(coalesce(lag({measure}) OVER (PARTITION BY {part} ORDER BY {order}), 0) AS DECIMAL(22,2)) AS {before}
      FROM ({by(names, measure, where)}))"""


HALF_YEAR = "day BETWEEN CAST(DATE '1998-04-12' - INTERVAL 6 MONTH AS DATE) AND DATE '1998-04-12'"
TABLES = {
    "dim_customer": """SELECT CAST(buyer_key AS BIGINT) AS customer_id, sex AS gender, band AS age, job AS occupation,
       town AS city_category, years_there AS stay_in_current_city_years, married AS marital_status FROM buyer""",
    "dim_product": "SELECT code AS product_id, kind AS product_category, CAST(list_price AS DECIMAL(10,2)) AS price FROM offer",
    "dim_store": "SELECT DISTINCT CAST(shop_key AS BIGINT) AS store_id, shop AS store_name FROM offer",
    "dim_supplier": "SELECT DISTINCT CAST(maker_key AS BIGINT) AS supplier_id, maker AS supplier_name FROM offer",
    "dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(d AS DATE) AS full_date, CAST(day(d) AS INTEGER) AS day,
       CAST(month(d) AS INTEGER) AS month, CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
       dayname(d) AS weekday
FROM (SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS d FROM span)""",
    "fact_sales": """SELECT CAST(sale_key AS BIGINT) AS order_id, CAST(buyer_key AS BIGINT) AS customer_id, code AS product_id,
       CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_id, CAST(shop_key AS BIGINT) AS store_id,
       CAST(maker_key AS BIGINT) AS supplier_id, pieces AS quantity, paid AS revenue FROM sold""",
}
KEYS = {"dim_customer": "customer_id", "dim_store": "store_id", "dim_supplier": "supplier_id", "dim_product": "product_id",
        "dim_date": "date_id", "fact_sales": "order_id, product_id"}
#: Declared text lengths (fixed values).
LENGTHS = [("dim_customer", "gender", 10), ("dim_customer", "age", 10), ("dim_customer", "occupation", 50),
           ("dim_customer", "city_category", 1), ("dim_customer", "stay_in_current_city_years", 5), ("dim_store", "store_name", 100),
           ("dim_supplier", "supplier_name", 100), ("dim_product", "product_id", 20), ("dim_product", "product_category", 50),
           ("dim_date", "weekday", 10), ("fact_sales", "product_id", 20)]
TRANSACTIONS = """SELECT CAST(l_orderkey AS BIGINT) AS order_id, CAST(o_custkey AS BIGINT) AS customer_id,
       'P' || lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS product_id, pieces AS quantity, day AS sale_date FROM line"""


def _each(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def _repeated(name: str, label: str, relation: str, keys: str) -> str:
    return (f"SELECT '{name}' AS {label}, count(*) FILTER (n > 1) AS duplicate_keys, "
            f"CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS rows_with_duplicate_keys "
            f"FROM (SELECT count(*) AS n FROM ({relation}) GROUP BY {keys})")


TOP_BY_DAY_TYPE = best("year month product_id day_type", "year month day_type", "total_revenue", "revenue_rank", "y = 1997")
STORE_QUARTERS = by("store_name year quarter", "total_quarterly_sales")

# The replayed feed: each line with its arrival, its customer's (none in one
# class of ten), and the price that held then (a seventh of the parts is new and
# a fifth costs twice as much from 1998 on).
REPLAYED = """SELECT *, arrival >= TIMESTAMP '1998-01-01' AS changed, buyer_key % 10 <> 9 AND
       first_day + INTERVAL (CAST(buyer_key % 10 * 200 AS INTEGER)) DAY <= arrival + INTERVAL 30 DAY AS in_time
FROM (SELECT *, day + INTERVAL (CAST(l_orderkey % 24 AS INTEGER)) HOUR AS arrival FROM line), buyer, offer, span
WHERE buyer_key = o_custkey AND part_key = l_partkey"""
DROPPED = """SELECT CAST(l_orderkey AS BIGINT) AS order_id, CAST(buyer_key AS BIGINT) AS customer_id, code AS product_id,
       pieces AS quantity, day AS sale_date, arrival AS arrival_ts"""
REPLAYED_FACTS = f"""SELECT CAST(l_orderkey AS BIGINT) AS order_id, CAST(buyer_key AS BIGINT) AS customer_id, code AS product_id,
       CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_id, CAST(shop_key AS BIGINT) AS store_id,
       CAST(maker_key AS BIGINT) AS supplier_id, pieces AS quantity,
       CAST(CASE WHEN changed AND part_key % 5 = 0 THEN 2 ELSE 1 END * list_price * pieces AS DECIMAL(12,2)) AS revenue
FROM ({REPLAYED}) WHERE turn = 1 AND in_time AND (changed OR part_key % 7 <> 0)"""

QUERIES: dict[str, str] = {
    "q01_top_products_daytype_month": TOP_BY_DAY_TYPE,
    "q02_demographics_by_city": by("city_category gender age", "total_purchase_amount"),
    "q03_category_by_occupation": by("product_category occupation", "total_sales"),
    "q04_gender_age_quarterly": by("year quarter gender age", "total_purchases", "y = 1996"),
    "q05_top_occupations_by_category": best("product_category occupation", "product_category", "total_sales", "sales_rank"),
    "q06_city_marital_monthly": by("year month city_category marital_status", "total_purchase_amount", HALF_YEAR),
    "q07_avg_by_stay_gender": by("stay_in_current_city_years gender", "average_purchase_amount",
                                 total="CAST(sum(paid) AS DOUBLE) / count(*)"),
    "q08_top_cities_by_category": best("product_category city_category", "product_category", "total_revenue", "revenue_rank"),
    "q09_monthly_growth_by_category": change("year month product_category", "product_category", "year month", "total_sales",
                                             "previous_month_sales", "sales_growth_percentage", "y = 1998"),
    "q10_daytype_by_age": by("age day_type", "total_sales", "y = 2000"),
    "q11_top_products_drilldown": TOP_BY_DAY_TYPE,
    "q12_store_quarterly_growth": change("store_name quarter", "store_name", "quarter", "total_sales", "previous_quarter_sales",
                                         "growth_rate_percentage", "y = 1998"),
    "q13_supplier_contribution": by("store_name supplier_name product_id", "total_sales"),
    "q14_seasonal_product_sales": by("product_id season", "total_sales"),
    "q15_store_supplier_volatility": change("store_name supplier_name year month", "store_name supplier_name", "year month",
                                            "total_sales", "previous_month_sales", "revenue_volatility_percentage"),
    # Every unordered pair of a buyer's products of one day, counted by sale rows.
    "q16_product_affinity": """SELECT least(s.code, t.code) AS product_a, greatest(s.code, t.code) AS product_b,
       CAST(count(*) / 2 AS BIGINT) AS together_count
FROM sold s, sold t WHERE s.buyer_key = t.buyer_key AND s.day = t.day AND s.code <> t.code
GROUP BY ALL ORDER BY together_count DESC, product_a, product_b LIMIT 5""",
    "q17_yearly_rollup": f"""SELECT CAST(y AS INTEGER) AS year, shop AS store_name, maker AS supplier_name, code AS product_id,
       {PAID} AS total_revenue
FROM sold GROUP BY GROUPING SETS ((y, shop, maker, code), (y, shop, maker), (y, shop), (y), ())""",
    "q18_half_year_pivot": """SELECT code AS product_id, CAST(y AS INTEGER) AS year,
       CAST(coalesce(sum(paid) FILTER (m < 7), 0) AS DECIMAL(22,2)) AS H1_Revenue,
       CAST(coalesce(sum(paid) FILTER (m > 6), 0) AS DECIMAL(22,2)) AS H2_Revenue,
       CAST(sum(paid) AS DECIMAL(22,2)) AS Yearly_Revenue,
       CAST(coalesce(sum(pieces) FILTER (m < 7), 0) AS BIGINT) AS H1_Quantity,
       CAST(coalesce(sum(pieces) FILTER (m > 6), 0) AS BIGINT) AS H2_Quantity,
       CAST(sum(pieces) AS BIGINT) AS Yearly_Quantity
FROM sold GROUP BY code, y""",
    # n * x - s > sigma * n and 2 * n * x > 3 * s, all in whole cents.
    "q19_revenue_spikes": f"""SELECT full_date, product_id, daily_sales, mean AS avg_daily_sales,
       CASE WHEN mean > 0 THEN CAST(daily_sales AS DOUBLE) / mean END AS spike_factor
FROM (SELECT *, CAST(sum(daily_sales) OVER p AS DOUBLE) / CAST(count(*) OVER p AS DOUBLE) AS mean,
             count(*) OVER p * c - sum(c) OVER p AS above,
             count(*) OVER p * sum(c * c) OVER p - (sum(c) OVER p) * (sum(c) OVER p) AS spread,
             2 * count(*) OVER p * c - 3 * sum(c) OVER p AS over_half
      FROM (SELECT *, CAST(daily_sales * 100 AS HUGEINT) AS c FROM ({by('product_id full_date', 'daily_sales')}))
      WINDOW p AS (PARTITION BY product_id))
WHERE above > 0 AND above * above > spread OR over_half > 0""",
    "q20_store_quarterly_view": f"SELECT * FROM ({STORE_QUARTERS}) WHERE store_name = 'NATION_8'",
    "q17_rollup_grouping_id": f"""SELECT CAST(y AS INTEGER) AS year, shop AS store_name, maker AS supplier_name,
       code AS product_id, CAST(grouping(y, shop, maker, code) AS BIGINT) AS subtotal, {PAID} AS total_revenue
FROM sold GROUP BY ROLLUP (y, shop, maker, code)""",
    "catalog_view_by_name": f"SELECT * FROM ({STORE_QUARTERS}) WHERE store_name = 'NATION_8'",
    "x1_row_count_audit": _each(f"SELECT '{t}' AS table_name, count(*) AS no_rows FROM ({sql})" for t, sql in TABLES.items()),
    "x2_product_coverage": """SELECT count(part_key) AS matched, count(*) AS total, count(*) - count(part_key) AS unmatched
FROM line LEFT JOIN offer ON part_key = l_partkey""",
    **{f"etl_{t}": sql for t, sql in TABLES.items()},
    "etl_fact_sales_from_csv": TABLES["fact_sales"],
    "etl_product_lookup": """SELECT code AS product_id, list_price AS price, CAST(shop_key AS BIGINT) AS store_id,
       CAST(maker_key AS BIGINT) AS supplier_id FROM offer""",
    "etl_hybrid_join_batch": f"{TRANSACTIONS} SEMI JOIN buyer ON buyer_key = o_custkey",
    "etl_trailing_months": f"SELECT *, strptime(CAST(date_id AS VARCHAR), '%Y%m%d')::DATE AS full_date FROM ({TABLES['fact_sales']} WHERE {HALF_YEAR})",
    "etl_rejects": """SELECT CAST(l_orderkey AS BIGINT) AS order_id,
       CAST(CASE l_orderkey % 50 WHEN 3 THEN -1 - o_custkey ELSE o_custkey END AS BIGINT) AS customer_id,
       CASE l_orderkey % 50 WHEN 1 THEN 'XP' ELSE 'P' END || lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS product_id,
       pieces AS quantity, CAST(CASE l_orderkey % 50 WHEN 2 THEN day + INTERVAL 1200 MONTH ELSE day END AS DATE) AS sale_date,
       ['unknown_product', 'date_outside_calendar', 'unknown_customer'][CAST(l_orderkey % 50 AS INTEGER)] AS reason
FROM line WHERE l_orderkey % 50 IN (1, 2, 3)""",
    # What a second load finds missing: the rows of each table less those there already.
    "etl_reload_new_rows": _each(f"SELECT '{t}' AS table_name, count(*) AS new_rows FROM (({sql}) EXCEPT ALL ({sql}))"
                                 for t, sql in TABLES.items()),
    "check_pk_violations": _each(_repeated(t, "table_name", sql, KEYS[t]) for t, sql in TABLES.items()),
    "check_fk_violations": _each(
        f"SELECT '{KEYS[t]}' AS fk_column, '{t}' AS ref_table, count(*) AS orphan_rows "
        f"FROM ({TABLES['fact_sales']}) ANTI JOIN ({TABLES[t]}) USING ({KEYS[t]})" for t in TABLES if t != "fact_sales"),
    "check_master_duplicates": _each([
        _repeated("customer_master", "source", TABLES["dim_customer"], "customer_id"),
        _repeated("product_master", "source", TABLES["dim_product"], "product_id"),
        _repeated("transactions", "source", TRANSACTIONS, "order_id, product_id")]),
    "check_length_violations": _each(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, {n} AS max_length, count(*) FILTER (length({c}) > {n}) AS too_long "
        f"FROM ({TABLES[t]})" for t, c, n in LENGTHS),
    "stream_hybrid_join": TABLES["fact_sales"],
    "stream_store_quarterly": STORE_QUARTERS,
    "stream_replay_facts": REPLAYED_FACTS,
    "stream_replay_dim_customer": f"{TABLES['dim_customer']} SEMI JOIN ({REPLAYED_FACTS}) f ON f.customer_id = buyer_key",
    "stream_replay_dim_product": """SELECT code AS product_id, kind AS product_category,
       CAST(CASE WHEN part_key % 35 = 0 THEN 2 ELSE 1 END * list_price AS DECIMAL(10,2)) AS price FROM offer""",
    "stream_expired": f"{DROPPED}, 'customer_not_seen_within_ttl' AS reason FROM ({REPLAYED}) WHERE NOT in_time",
    "stream_rejects": f"{DROPPED}, 'unknown_product' AS reason FROM ({REPLAYED}) WHERE in_time AND NOT changed AND part_key % 7 = 0",
    "stream_replay_balance": f"""SELECT CASE WHEN NOT in_time THEN 'expired' WHEN changed OR part_key % 7 <> 0 THEN 'fact'
       ELSE 'rejected' END AS outcome, count(*) AS transactions FROM ({REPLAYED}) WHERE turn = 1 GROUP BY ALL""",
    "stream_dedupe_facts": TABLES["fact_sales"],
}


def oracle_sql() -> dict[str, str]:
    return {name: f"WITH {SOLD}\n{body}" for name, body in QUERIES.items()}
