"""Every query by name, bound to the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.operators.affinity import (
    best_sellers,
    buyers_per_product,
    category_leaders,
    count_categories,
    purchases,
)
from tidebook.operators.attributes import usual_spelling, value_problems
from tidebook.operators.calendar import calendar, observed_bounds
from tidebook.operators.demand import forecast_error, monthly_units
from tidebook.operators.schema import (
    infer_types,
    profile_tables,
    schemas_of,
    to_ddl,
    value_ranges,
)
from tidebook.plans import customers as cust
from tidebook.plans import attributes, demand, marts, overview, recommend, weekdays
from tidebook.plans.ingest import Ingested, ingest
from tidebook.session import scratch_path
from tidebook.sources import csv_tables, star, warehouse
from tidebook.sources.mart_files import Mart, MartRejected, mart_paths, publish_marts, read_mart

PHYSICAL = "1-URGENT"
TEST_FROM, TEST_TO = date(2001, 5, 1), date(2001, 7, 1)
EARLY_FROM, EARLY_TO = date(1995, 1, 1), date(1995, 4, 1)
LATE_TO = date(2001, 12, 1)
CALENDAR_FROM, CALENDAR_TO = date(1996, 1, 1), date(2000, 12, 31)
TOP_CUSTOMERS = 10
MIN_CATEGORIES = 15
NEIGHBOURS = 5
# Identifier columns that stay text although their values look like numbers.
TEXT_COLUMNS = ["c_custkey"]

Query = Callable[[SparkSession, str], DataFrame]


def _sales(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders, items and products."""
    return star.sales(spark, root)[:3]


def _pairs(spark: SparkSession, root: str) -> DataFrame:
    orders, items, _ = _sales(spark, root)
    return purchases(orders, items)


def _text_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {
        name: csv_tables.as_exported(star.table(spark, root, name)) for name in star.STAR_TABLES
    }


# Overview


def order_eda(spark: SparkSession, root: str) -> DataFrame:
    return overview.table_eda(star.table(spark, root, "orders"), "o_totalprice")


def sales_kpis(spark: SparkSession, root: str) -> DataFrame:
    return overview.sales_kpis(star.orders(spark, root))


def monthly_sales(spark: SparkSession, root: str) -> DataFrame:
    return overview.monthly_sales(star.orders(spark, root))


def sales_by_channel(spark: SparkSession, root: str) -> DataFrame:
    return overview.sales_by_channel(star.orders(spark, root))


def status_distribution(spark: SparkSession, root: str) -> DataFrame:
    return overview.status_distribution(star.orders(spark, root))


# Calendar and weekdays


def calendar_dim(spark: SparkSession, root: str) -> DataFrame:
    return calendar(spark, *observed_bounds(star.orders(spark, root), "order_date"))


def daily_sales_filled(spark: SparkSession, root: str) -> DataFrame:
    return weekdays.daily_totals(weekdays.daily_sales(star.orders(spark, root), PHYSICAL))


def weekday_avg_sales(spark: SparkSession, root: str) -> DataFrame:
    return weekdays.weekday_average(star.orders(spark, root), PHYSICAL)


def weekday_avg_sales_bounded(spark: SparkSession, root: str) -> DataFrame:
    orders = star.orders(spark, root)
    return weekdays.weekday_average(orders, PHYSICAL, CALENDAR_FROM, CALENDAR_TO)


def worst_weekday(spark: SparkSession, root: str) -> DataFrame:
    return weekdays.worst_weekday(weekday_avg_sales(spark, root))


# Customers


def customer_profile(spark: SparkSession, root: str) -> DataFrame:
    return cust.customer_profile(*_sales(spark, root))


def _loyal_customers(spark: SparkSession, root: str, min_categories: int) -> DataFrame:
    sales = star.sales(spark, root)
    ranking = cust.rank_customers(*sales[:3], min_categories, TOP_CUSTOMERS)
    return cust.loyal_customers(*sales, ranking)


def _loyal_categories(spark: SparkSession, root: str, min_categories: int) -> DataFrame:
    sales = _sales(spark, root)
    ranking = cust.rank_customers(*sales, min_categories, TOP_CUSTOMERS)
    return cust.loyal_categories(*sales, ranking)


def loyal_customers_top10(spark: SparkSession, root: str) -> DataFrame:
    return _loyal_customers(spark, root, 0)


def loyal_customers_diverse(spark: SparkSession, root: str) -> DataFrame:
    return _loyal_customers(spark, root, MIN_CATEGORIES)


def loyal_categories(spark: SparkSession, root: str) -> DataFrame:
    return _loyal_categories(spark, root, 0)


def loyal_categories_diverse(spark: SparkSession, root: str) -> DataFrame:
    return _loyal_categories(spark, root, MIN_CATEGORIES)


# Demand


def monthly_demand(spark: SparkSession, root: str) -> DataFrame:
    orders, items, _ = _sales(spark, root)
    return monthly_units(orders, items)


def monthly_demand_dense(spark: SparkSession, root: str) -> DataFrame:
    return demand.monthly_demand(*_sales(spark, root))


def demand_forecast(spark: SparkSession, root: str) -> DataFrame:
    return demand.demand_forecast(*_sales(spark, root), TEST_FROM, TEST_TO)


def demand_forecast_early(spark: SparkSession, root: str) -> DataFrame:
    """The first months of the series, whose history is not complete."""
    return demand.demand_forecast(*_sales(spark, root), EARLY_FROM, EARLY_TO)


def demand_forecast_late(spark: SparkSession, root: str) -> DataFrame:
    """Test months that reach beyond the last order: those are not scored."""
    return demand.demand_forecast(*_sales(spark, root), TEST_TO, LATE_TO)


def weekday_avg_sales_tied(spark: SparkSession, root: str) -> DataFrame:
    """A channel without sales: all weekdays tie, one is the worst."""
    return weekdays.weekday_average(star.orders(spark, root), "no such channel")


def forecast_mae(spark: SparkSession, root: str) -> DataFrame:
    return forecast_error(demand_forecast(spark, root))


def forecast_mae_by_product(spark: SparkSession, root: str) -> DataFrame:
    return forecast_error(demand_forecast(spark, root), by=["product_id"])


# Recommendations


def customer_product_pairs(spark: SparkSession, root: str) -> DataFrame:
    return _pairs(spark, root)


def product_buyers(spark: SparkSession, root: str) -> DataFrame:
    return buyers_per_product(_pairs(spark, root))


def similar_to_reference(spark: SparkSession, root: str) -> DataFrame:
    orders, items, products = _sales(spark, root)
    pairs = purchases(orders, items)
    return recommend.recommendations(pairs, best_sellers(pairs), products, NEIGHBOURS, 1)


def similar_to_category_leaders(spark: SparkSession, root: str) -> DataFrame:
    orders, items, products = _sales(spark, root)
    pairs = purchases(orders, items)
    leaders, n = category_leaders(pairs, products), count_categories(products)
    return recommend.recommendations(pairs, leaders, products, NEIGHBOURS, n)


# Schema and load


def column_profile(spark: SparkSession, root: str) -> DataFrame:
    return profile_tables(_text_tables(spark, root))


def column_ranges(spark: SparkSession, root: str) -> DataFrame:
    return profile_tables(_text_tables(spark, root), value_ranges)


def inferred_schema(spark: SparkSession, root: str) -> DataFrame:
    return infer_types(profile_tables(_text_tables(spark, root)), TEXT_COLUMNS)


def _ingest(spark: SparkSession, root: str, names: tuple[str, ...]) -> Ingested:
    """Export tables as CSV and ingest the files."""
    folder = scratch_path(spark, "load")
    for name in names:
        exported = csv_tables.as_exported(star.table(spark, root, name))
        csv_tables.write_text_table(exported, f"{folder}/raw/{name}")
    return ingest(spark, f"{folder}/raw", f"{folder}/warehouse")


def load_reconcile(spark: SparkSession, root: str) -> DataFrame:
    return _ingest(spark, root, star.STAR_TABLES).row_counts


def loaded_orders_sql(spark: SparkSession, root: str) -> DataFrame:
    loaded = _ingest(spark, root, ("orders",)).tables
    warehouse.register({"loaded_orders": loaded["orders"]})
    return spark.sql(
        "SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders,"
        " CAST(sum(o_totalprice) AS DOUBLE) AS total_value,"
        " CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day"
        " FROM loaded_orders GROUP BY o_orderstatus, o_orderpriority"
    )


def loaded_weekday_avg_sales(spark: SparkSession, root: str) -> DataFrame:
    """The weekday averages from typed tables that went through CSV."""
    loaded = _ingest(spark, root, ("orders", "lineitem", "part", "customer")).tables
    return weekdays.weekday_average(star.bind(loaded).orders, PHYSICAL)


def schema_ddl(spark: SparkSession, root: str) -> DataFrame:
    """One CREATE TABLE text per table, from the types inferred over all rows."""
    tables = _text_tables(spark, root)
    types = infer_types(profile_tables(tables), TEXT_COLUMNS)
    schemas = schemas_of(types, {name: df.columns for name, df in tables.items()})
    rows = [(name, to_ddl(name, schema)) for name, schema in schemas.items()]
    return spark.createDataFrame(rows, "table_name string, ddl string")


# Marts: computed, checked, written as CSV and read back


def _published(spark: SparkSession, mart: Mart) -> DataFrame:
    folder = scratch_path(spark, "marts")
    publish_marts({"mart": mart}, folder)
    return read_mart(spark, mart_paths(spark, folder)["mart"], mart.rows.schema)


def mart_loyal_customers(spark: SparkSession, root: str) -> DataFrame:
    checks = [*marts.ranking_checks("ticket_medio", TOP_CUSTOMERS), marts.ticket_check()]
    return _published(
        spark, marts.LOYAL_CUSTOMERS.mart(loyal_customers_top10(spark, root), checks)
    )


def mart_loyal_categories(spark: SparkSession, root: str) -> DataFrame:
    checks = marts.ranking_checks("quantidade_itens")
    return _published(spark, marts.LOYAL_CATEGORIES.mart(loyal_categories(spark, root), checks))


def mart_weekdays(spark: SparkSession, root: str) -> DataFrame:
    checks = marts.weekday_checks(star.orders(spark, root), PHYSICAL)
    return _published(spark, marts.WEEKDAYS.mart(weekday_avg_sales(spark, root), checks))


def mart_forecast(spark: SparkSession, root: str) -> DataFrame:
    sales = _sales(spark, root)
    best = demand.most_sold(sales[1])
    return _published(spark, marts.forecast_mart(*sales, best, TEST_FROM, TEST_TO))


def mart_recommendations(spark: SparkSession, root: str) -> DataFrame:
    rows = similar_to_reference(spark, root)
    checks = marts.similarity_checks(NEIGHBOURS)
    return _published(spark, marts.RECOMMENDATIONS.mart(rows, checks))


def mart_overview(spark: SparkSession, root: str) -> DataFrame:
    return _published(spark, marts.overview_mart(star.orders(spark, root)))


def mart_kpis(spark: SparkSession, root: str) -> DataFrame:
    rows = overview.sales_kpis(star.orders(spark, root))
    return _published(spark, marts.KPIS.mart(rows, marts.kpi_checks()))


def approved_mart(spark: SparkSession, root: str) -> DataFrame:
    """The weekday mart, published again by a refresh that must give the approved rows."""
    orders = star.orders(spark, root)
    checks = marts.weekday_checks(orders, PHYSICAL)
    mart = marts.WEEKDAYS.mart(weekday_avg_sales(spark, root), checks)
    folder = scratch_path(spark, "marts")
    publish_marts({"mart": mart}, folder)
    approved = read_mart(spark, mart_paths(spark, folder)["mart"], mart.rows.schema)
    publish_marts({"mart": replace(mart, approved=approved)}, folder, refresh=True)
    return read_mart(spark, mart_paths(spark, folder)["mart"], mart.rows.schema)


def rejected_mart(spark: SparkSession, root: str) -> DataFrame:
    """What happens to a weekday mart that differs from the approved rows in one day's total."""
    mart = marts.WEEKDAYS.mart(weekday_avg_sales(spark, root), [])
    total = F.when(F.col("ordem_dia") == 1, F.col("valor_total") + 1).otherwise(F.col("valor_total"))
    folder = scratch_path(spark, "marts")
    try:
        publish_marts({"mart": replace(mart, approved=mart.rows.withColumn("valor_total", total))}, folder)
        message = "published"
    except MartRejected as rejected:
        message = str(rejected)
    orders = star.orders(spark, root).agg(F.count("*").alias("n_orders"))
    return orders.select(F.lit(message).alias("message"), F.lit(len(mart_paths(spark, folder))).alias("n_marts"), "n_orders")


def published_marts(spark: SparkSession, root: str) -> DataFrame:
    """All seven marts, built, checked and written together: rows per written file set."""
    sales = star.sales(spark, root)
    best = demand.most_sold(sales.items)
    built = marts.build_marts(
        sales, PHYSICAL, best, TEST_FROM, TEST_TO, TOP_CUSTOMERS, NEIGHBOURS
    )
    folder = scratch_path(spark, "marts")
    publish_marts(built, folder)
    paths = mart_paths(spark, folder)
    written = {name: read_mart(spark, paths[name], mart.rows.schema) for name, mart in built.items()}
    return warehouse.count_rows(written, "n_rows")


def typed_event_values(spark: SparkSession, root: str) -> DataFrame:
    """Properties of events typed by a dictionary; rows that do not fit say why."""
    return attributes.typed_event_values(spark, root).drop("value")


def event_value_problems(spark: SparkSession, root: str) -> DataFrame:
    return value_problems(attributes.typed_event_values(spark, root))


def event_value_spellings(spark: SparkSession, root: str) -> DataFrame:
    return usual_spelling(attributes.typed_event_values(spark, root))


def users_wide(spark: SparkSession, root: str) -> DataFrame:
    """A row for each user: the values of the first event that has a good one."""
    return attributes.users_wide(spark, root)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        order_eda,
        sales_kpis,
        monthly_sales,
        sales_by_channel,
        status_distribution,
        calendar_dim,
        daily_sales_filled,
        weekday_avg_sales,
        weekday_avg_sales_bounded,
        weekday_avg_sales_tied,
        worst_weekday,
        customer_profile,
        loyal_customers_top10,
        loyal_customers_diverse,
        loyal_categories,
        loyal_categories_diverse,
        monthly_demand,
        monthly_demand_dense,
        demand_forecast,
        demand_forecast_early,
        demand_forecast_late,
        forecast_mae,
        forecast_mae_by_product,
        customer_product_pairs,
        product_buyers,
        similar_to_reference,
        similar_to_category_leaders,
        column_profile,
        column_ranges,
        inferred_schema,
        schema_ddl,
        load_reconcile,
        loaded_orders_sql,
        loaded_weekday_avg_sales,
        mart_loyal_customers,
        mart_loyal_categories,
        mart_weekdays,
        mart_forecast,
        mart_recommendations,
        mart_overview,
        mart_kpis,
        approved_mart,
        rejected_mart,
        published_marts,
        typed_event_values,
        event_value_problems,
        event_value_spellings,
        users_wide,
    )
}
