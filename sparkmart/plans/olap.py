"""The twenty OLAP reports over the star schema (DataFrame API).

Conventions used throughout:

* Every report aggregates the fact table *before* it joins a large dimension
  (customer, product, supplier): a partial aggregate on the join key
  collapses a hot key inside each map task, and the join then sees one row
  per key instead of every sale.  Sums of partial sums are exact (decimal).
* The calendar is joined by broadcast (its size is bounded by its day
  range); year filters become partition filters on the fact table.
* ``dim_product`` is joined only where a product attribute is read.  Where a
  report joins it only to read ``product_id``, which the fact already holds,
  the join is key-preserving: the loader admits a fact only for a known
  product and ``quality.fk_violations`` verifies it.
* Money stays ``decimal`` up to the output; ratios are ``double``.

Parameter defaults are the reference's literals; ``TEST_PARAMS`` are the
values that fit the test data's years (1995-2001).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmart.functions.calendar import day_type, is_first_half, season
from sparkmart.functions.measures import cents, safe_ratio
from sparkmart.operators.affinity import top_pairs
from sparkmart.operators.grouping import rollup
from sparkmart.operators.windows import period_over_period, top_n_per_group
from sparkmart.plans.etl import Star

MONEY_SUM = "decimal(22,2)"

TEST_PARAMS = {
    "q01": {"year": 1997}, "q04": {"year": 1996}, "q06": {"anchor": "1998-04-12"},
    "q09": {"year": 1998}, "q10": {"year": 2000}, "q11": {"year": 1997},
    "q12": {"year": 1998}, "q20": {"store_name": "NATION_8"},
}


# ---- helpers ----------------------------------------------------------------

def _money_sum(col: str, alias: str) -> F.Column:
    return F.sum(col).cast(MONEY_SUM).alias(alias)


def _dates(star: Star, *cols: str) -> DataFrame:
    # Bounded broadcast: date_id is the primary key, one row per calendar day.
    return F.broadcast(star.dim_date.select("date_id", *cols))


def _with_dates(fact: DataFrame, star: Star, *cols: str) -> DataFrame:
    return fact.join(_dates(star, *cols), "date_id", "inner")


def add_months(day: dt.date, months: int) -> dt.date:
    """Calendar month arithmetic, clamped to the month's last day."""
    m = day.month - 1 + months
    y, m = day.year + m // 12, m % 12 + 1
    last = (dt.date(y + (m == 12), m % 12 + 1, 1) - dt.timedelta(days=1)).day
    return dt.date(y, m, min(day.day, last))


def parse_day(text: str) -> dt.date:
    """``yyyy-m-d`` with or without zero padding (the reference writes
    ``'2016-4-12'``)."""
    y, m, d = (int(x) for x in text.strip().split("-"))
    return dt.date(y, m, d)


def _by_customer(fact: DataFrame, star: Star, keys: list[str], attrs: list[str],
                 measures: dict[str, F.Column]) -> DataFrame:
    """Pre-aggregate the fact by customer (+ keys), then attach customer
    attributes: one row per customer and key reaches the join."""
    pre = fact.groupBy("customer_id", *keys).agg(*[m.alias(n) for n, m in measures.items()])
    return pre.join(star.dim_customer.select("customer_id", *attrs), "customer_id", "inner")


def _by_product(fact: DataFrame, star: Star, keys: list[str], attrs: list[str],
                measures: dict[str, F.Column]) -> DataFrame:
    pre = fact.groupBy("product_id", *keys).agg(*[m.alias(n) for n, m in measures.items()])
    return pre.join(star.dim_product.select("product_id", *attrs), "product_id", "inner")


def _store_supplier_names(pre: DataFrame, star: Star, store: bool = True,
                          supplier: bool = True) -> DataFrame:
    out = pre
    if store:
        out = out.join(star.dim_store.select("store_id", "store_name"), "store_id", "inner")
    if supplier:
        out = out.join(star.dim_supplier.select("supplier_id", "supplier_name"),
                       "supplier_id", "inner")
    return out


def _top_products_by_daytype(star: Star, year: int, k: int) -> DataFrame:
    f = _with_dates(star.facts(year).select("date_id", "product_id", "revenue"),
                    star, "year", "month", "weekday").where(F.col("year") == year)
    agg = (f.groupBy("year", "month", "product_id", day_type("weekday").alias("day_type"))
           .agg(_money_sum("revenue", "total_revenue")))
    ranked = top_n_per_group(agg, ["year", "month", "day_type"], "total_revenue", k,
                             "revenue_rank")
    return ranked.orderBy("year", "month", "day_type", "revenue_rank", "product_id")


# ---- Q1 - Q20 -----------------------------------------------------------------

def q01_top_products_daytype_month(star: Star, year: int = 2016, k: int = 5) -> DataFrame:
    """Top-k products by revenue per month and weekday/weekend of a year."""
    return _top_products_by_daytype(star, year, k)


def q02_demographics_by_city(star: Star) -> DataFrame:
    """Revenue by city category, gender and age band."""
    j = _by_customer(star.facts(), star, [], ["city_category", "gender", "age"],
                     {"rev": F.sum("revenue")})
    return (j.groupBy("city_category", "gender", "age")
            .agg(_money_sum("rev", "total_purchase_amount"))
            .orderBy("city_category", "gender", "age"))


def q03_category_by_occupation(star: Star) -> DataFrame:
    """Revenue by product category and occupation."""
    return (_category_occupation(star, "occupation", "total_sales")
            .orderBy("product_category", F.desc("total_sales"), "occupation"))


def _category_occupation(star: Star, attr: str, alias: str) -> DataFrame:
    # Category first (few sales share product and customer, so a pre-aggregate
    # on both removes nothing); then one partial aggregate on (customer,
    # category), and the customer join sees a row for each of those.
    f = star.facts().select("product_id", "customer_id", "revenue").join(
        star.dim_product.select("product_id", "product_category"), "product_id")
    j = _by_customer(f, star, ["product_category"], [attr], {"rev": F.sum("revenue")})
    return j.groupBy("product_category", attr).agg(_money_sum("rev", alias))


def q04_gender_age_quarterly(star: Star, year: int = 2015) -> DataFrame:
    """Revenue by quarter, gender and age band for one year."""
    f = _with_dates(star.facts(year), star, "year", "quarter").where(F.col("year") == year)
    j = _by_customer(f, star, ["year", "quarter"], ["gender", "age"], {"rev": F.sum("revenue")})
    return (j.groupBy("year", "quarter", "gender", "age")
            .agg(_money_sum("rev", "total_purchases"))
            .orderBy("year", "quarter", "gender", "age"))


def q05_top_occupations_by_category(star: Star, k: int = 5) -> DataFrame:
    agg = _category_occupation(star, "occupation", "total_sales")
    return (top_n_per_group(agg, ["product_category"], "total_sales", k, "sales_rank")
            .orderBy("product_category", "sales_rank", "occupation"))


def trailing_months(star: Star, anchor: str, months: int = 6, *date_cols: str) -> DataFrame:
    """Fact rows dated from ``anchor`` minus ``months`` months up to
    ``anchor``, both ends inclusive, with the requested calendar columns.

    The window becomes a partition filter (years) and a ``date_id`` range
    pushed to the Parquet scan, then the calendar join checks ``full_date``.
    """
    end = parse_day(anchor)
    start = add_months(end, -months)
    lo, hi = int(start.strftime("%Y%m%d")), int(end.strftime("%Y%m%d"))
    f = star.fact_sales
    if "sale_year" in f.columns:
        f = f.where(F.col("sale_year").between(start.year, end.year))
    f = f.where(F.col("date_id").between(lo, hi))
    cols = list(dict.fromkeys(["full_date", *date_cols]))
    return _with_dates(f, star, *cols).where(F.col("full_date").between(F.lit(start), F.lit(end)))


def q06_city_marital_monthly(star: Star, anchor: str = "2016-04-12", months: int = 6) -> DataFrame:
    """Revenue by month, city category and marital status over the trailing
    ``months`` months up to ``anchor`` (both ends inclusive)."""
    f = trailing_months(star, anchor, months, "year", "month")
    j = _by_customer(f, star, ["year", "month"], ["city_category", "marital_status"],
                     {"rev": F.sum("revenue")})
    return (j.groupBy("year", "month", "city_category", "marital_status")
            .agg(_money_sum("rev", "total_purchase_amount"))
            .orderBy("year", "month", "city_category", "marital_status"))


def q07_avg_by_stay_gender(star: Star) -> DataFrame:
    """Average revenue per fact row by stay duration and gender."""
    j = _by_customer(star.facts(), star, [], ["stay_in_current_city_years", "gender"],
                     {"rev": F.sum("revenue"), "n": F.count(F.lit(1))})
    return (j.groupBy("stay_in_current_city_years", "gender")
            .agg((F.sum("rev").cast("double") / F.sum("n")).alias("average_purchase_amount"))
            .orderBy("stay_in_current_city_years", "gender"))


def q08_top_cities_by_category(star: Star, k: int = 5) -> DataFrame:
    agg = _category_occupation(star, "city_category", "total_revenue")
    return (top_n_per_group(agg, ["product_category"], "total_revenue", k, "revenue_rank")
            .orderBy("product_category", "revenue_rank", "city_category"))


def q09_monthly_growth_by_category(star: Star, year: int = 2017) -> DataFrame:
    """Monthly sales per category in one year, previous month's sales and the
    growth in percent (the year filter precedes the lag)."""
    f = _with_dates(star.facts(year), star, "year", "month").where(F.col("year") == year)
    j = _by_product(f, star, ["year", "month"], ["product_category"], {"rev": F.sum("revenue")})
    monthly = j.groupBy("year", "month", "product_category").agg(_money_sum("rev", "total_sales"))
    out = period_over_period(monthly, ["product_category"], ["year", "month"], "total_sales",
                             "previous_month_sales", "sales_growth_percentage")
    return out.orderBy("product_category", "year", "month")


def q10_daytype_by_age(star: Star, year: int = 2020) -> DataFrame:
    f = _with_dates(star.facts(year), star, "year", "weekday").where(F.col("year") == year)
    f = f.withColumn("day_type", day_type("weekday"))
    j = _by_customer(f, star, ["day_type"], ["age"], {"rev": F.sum("revenue")})
    return (j.groupBy("age", "day_type").agg(_money_sum("rev", "total_sales"))
            .orderBy("age", "day_type"))


def q11_top_products_drilldown(star: Star, year: int = 2016, k: int = 5) -> DataFrame:
    """Same statement as Q1 (monthly drill-down of weekday/weekend top-k)."""
    return _top_products_by_daytype(star, year, k)


def q12_store_quarterly_growth(star: Star, year: int = 2017) -> DataFrame:
    f = _with_dates(star.facts(year), star, "year", "quarter").where(F.col("year") == year)
    pre = f.groupBy("store_id", "quarter").agg(F.sum("revenue").alias("rev"))
    q = (_store_supplier_names(pre, star, supplier=False)
         .groupBy("store_name", "quarter").agg(_money_sum("rev", "total_sales")))
    out = period_over_period(q, ["store_name"], ["quarter"], "total_sales",
                             "previous_quarter_sales", "growth_rate_percentage")
    return out.orderBy("store_name", "quarter")


def q13_supplier_contribution(star: Star) -> DataFrame:
    pre = star.facts().groupBy("store_id", "supplier_id", "product_id").agg(
        F.sum("revenue").alias("rev"))
    return (_store_supplier_names(pre, star)
            .groupBy("store_name", "supplier_name", "product_id")
            .agg(_money_sum("rev", "total_sales"))
            .orderBy("store_name", "supplier_name", F.desc("total_sales"), "product_id"))


def q14_seasonal_product_sales(star: Star) -> DataFrame:
    f = _with_dates(star.facts().select("date_id", "product_id", "revenue"), star, "month")
    return (f.groupBy("product_id", season("month").alias("season"))
            .agg(_money_sum("revenue", "total_sales"))
            .orderBy("product_id", F.desc("total_sales"), "season"))


def q15_store_supplier_volatility(star: Star) -> DataFrame:
    f = _with_dates(star.facts(), star, "year", "month")
    pre = f.groupBy("store_id", "supplier_id", "year", "month").agg(F.sum("revenue").alias("rev"))
    monthly = (_store_supplier_names(pre, star)
               .groupBy("store_name", "supplier_name", "year", "month")
               .agg(_money_sum("rev", "total_sales")))
    out = period_over_period(monthly, ["store_name", "supplier_name"], ["year", "month"],
                             "total_sales", "previous_month_sales",
                             "revenue_volatility_percentage")
    return out.orderBy("store_name", "supplier_name", "year", "month")


def q16_product_affinity(star: Star, k: int = 5) -> DataFrame:
    """Top-k product pairs bought by one customer on one day (pair rows)."""
    return top_pairs(star.facts().select("customer_id", "date_id", "product_id"), k)


def q17_yearly_rollup(star: Star, grouping_id: str | None = None) -> DataFrame:
    """Revenue by year > store > supplier > product with subtotals (ROLLUP).
    ``grouping_id`` names a column that tells a subtotal from a missing name."""
    f = _with_dates(star.facts(), star, "year")
    pre = f.groupBy("year", "store_id", "supplier_id", "product_id").agg(
        F.sum("revenue").alias("rev"))
    named = _store_supplier_names(pre, star)
    return (rollup(named, ["year", "store_name", "supplier_name", "product_id"], _money_sum("rev", "total_revenue"),
                   grouping_id=grouping_id)
            .orderBy(F.asc_nulls_first("year"), F.asc_nulls_first("store_name"),
                     F.asc_nulls_first("supplier_name"), F.asc_nulls_first("product_id")))


def q18_half_year_pivot(star: Star) -> DataFrame:
    f = _with_dates(star.facts(), star, "year", "month")
    h1 = is_first_half("month")
    zero_money = F.lit(0).cast("decimal(12,2)")
    return (f.groupBy("product_id", "year").agg(
        F.sum(F.when(h1, F.col("revenue")).otherwise(zero_money)).cast(MONEY_SUM).alias("H1_Revenue"),
        F.sum(F.when(~h1, F.col("revenue")).otherwise(zero_money)).cast(MONEY_SUM).alias("H2_Revenue"),
        _money_sum("revenue", "Yearly_Revenue"),
        F.sum(F.when(h1, F.col("quantity")).otherwise(0)).cast("bigint").alias("H1_Quantity"),
        F.sum(F.when(~h1, F.col("quantity")).otherwise(0)).cast("bigint").alias("H2_Quantity"),
        F.sum("quantity").cast("bigint").alias("Yearly_Quantity"),
    ).orderBy("product_id", "year"))


def q19_revenue_spikes(star: Star, sigmas: int = 1, factor: float = 1.5) -> DataFrame:
    """Product-days whose sales exceed mean + sigmas * stddev_pop, or
    factor * mean, of the product's days with sales.

    The thresholds are tested exactly in integer cents: with n days, total S
    and sum of squares Q, ``x > S/n + sigmas*sqrt(nQ - S^2)/n`` is
    ``n*x - S > 0 and (n*x - S)^2 > sigmas^2 * (nQ - S^2)``, and
    ``x > factor * S/n`` is ``den*n*x > num*S`` for factor = num/den.  (In
    floating point the first test flips on rounding whenever a product has
    exactly two sales days, where mean + sigma equals the larger day.)
    The per-product statistics are a window over the daily rows, which a
    product's days (at most the calendar's length) fit into.
    """
    f = _with_dates(star.facts().select("date_id", "product_id", "revenue"), star, "full_date")
    daily = f.groupBy("product_id", "full_date").agg(_money_sum("revenue", "daily_sales"))
    w = Window.partitionBy("product_id")
    x = cents("daily_sales")
    st = daily.select(
        "*",
        F.count(F.lit(1)).over(w).cast(EXACT).alias("n"),
        F.sum("daily_sales").over(w).alias("total"),
        F.sum(x).over(w).cast(EXACT).alias("s"),
        F.sum((x * x).cast(EXACT)).over(w).cast(EXACT).alias("q"),
    )
    n, s_, q = F.col("n"), F.col("s"), F.col("q")
    dev = (n * x - s_).cast(EXACT)
    var = (n * q - s_ * s_).cast(EXACT)
    num, den = exact_ratio(factor)
    s_num, s_den = exact_ratio(sigmas)
    over_sigma = (dev > 0) & ((dev * dev * s_den ** 2).cast(EXACT) > (var * s_num ** 2).cast(EXACT))
    over_factor = (n * x * den).cast(EXACT) > (s_ * num).cast(EXACT)
    avg = (F.col("total").cast("double") / n.cast("double")).alias("avg_daily_sales")
    out = st.where(over_sigma | over_factor).select("full_date", "product_id", "daily_sales", avg)
    out = out.withColumn("spike_factor", safe_ratio("daily_sales", "avg_daily_sales"))
    return out.orderBy(F.desc("spike_factor"), "product_id", "full_date")


EXACT = "decimal(38,0)"


def exact_ratio(x: float) -> tuple[int, int]:
    """A decimal factor as an exact integer ratio (1.5 -> (3, 2))."""
    from fractions import Fraction
    fr = Fraction(str(x))
    return fr.numerator, fr.denominator


def store_quarterly_sales(star: Star) -> DataFrame:
    """The STORE_QUARTERLY_SALES view: revenue by store, year and quarter."""
    f = _with_dates(star.facts(), star, "year", "quarter")
    pre = f.groupBy("store_id", "year", "quarter").agg(F.sum("revenue").alias("rev"))
    return (_store_supplier_names(pre, star, supplier=False)
            .groupBy("store_name", "year", "quarter")
            .agg(_money_sum("rev", "total_quarterly_sales")))


def register_views(spark: SparkSession, star: Star) -> None:
    """Temp views for SQL users: the six tables and STORE_QUARTERLY_SALES
    (views of these names that the caller has are replaced)."""
    for name, df in star.tables().items():
        df.createOrReplaceTempView(name)
    store_quarterly_sales(star).createOrReplaceTempView("STORE_QUARTERLY_SALES")


def q20_store_quarterly_view(star: Star, store_name: str = "Game Zone") -> DataFrame:
    spark = star.fact_sales.sparkSession
    store_quarterly_sales(star).createOrReplaceTempView("STORE_QUARTERLY_SALES")
    return (spark.table("STORE_QUARTERLY_SALES").where(F.col("store_name") == store_name)
            .orderBy("store_name", "year", "quarter"))


REPORTS = {
    "q01_top_products_daytype_month": (q01_top_products_daytype_month, "q01"),
    "q02_demographics_by_city": (q02_demographics_by_city, None),
    "q03_category_by_occupation": (q03_category_by_occupation, None),
    "q04_gender_age_quarterly": (q04_gender_age_quarterly, "q04"),
    "q05_top_occupations_by_category": (q05_top_occupations_by_category, None),
    "q06_city_marital_monthly": (q06_city_marital_monthly, "q06"),
    "q07_avg_by_stay_gender": (q07_avg_by_stay_gender, None),
    "q08_top_cities_by_category": (q08_top_cities_by_category, None),
    "q09_monthly_growth_by_category": (q09_monthly_growth_by_category, "q09"),
    "q10_daytype_by_age": (q10_daytype_by_age, "q10"),
    "q11_top_products_drilldown": (q11_top_products_drilldown, "q11"),
    "q12_store_quarterly_growth": (q12_store_quarterly_growth, "q12"),
    "q13_supplier_contribution": (q13_supplier_contribution, None),
    "q14_seasonal_product_sales": (q14_seasonal_product_sales, None),
    "q15_store_supplier_volatility": (q15_store_supplier_volatility, None),
    "q16_product_affinity": (q16_product_affinity, None),
    "q17_yearly_rollup": (q17_yearly_rollup, None),
    "q18_half_year_pivot": (q18_half_year_pivot, None),
    "q19_revenue_spikes": (q19_revenue_spikes, None),
    "q20_store_quarterly_view": (q20_store_quarterly_view, "q20"),
}


def run_report(name: str, star: Star, params: dict | None = None) -> DataFrame:
    fn, key = REPORTS[name]
    kwargs = dict(TEST_PARAMS.get(key, {})) if params is None and key else dict(params or {})
    return fn(star, **kwargs)


__all__ = ["REPORTS", "TEST_PARAMS", "run_report", "register_views", "store_quarterly_sales",
           "add_months", "parse_day", "trailing_months"]
