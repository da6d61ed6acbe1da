"""Multi-tenant summaries, k-anonymous aggregates, inventory and demo data."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import measures as M


def customer_cells(rev: DataFrame, unit: str) -> DataFrame:
    """Per period (``unit``: day or month), tenant, region, product line and customer: the distinct count becomes a plain
    count, and a tenant with a third of the rows spreads over its customers."""
    return rev.groupBy(
        D.trunc_date(F.col("revenue_date"), unit).alias("period"), "tenant_id", "product_line", "region", "customer_id"
    ).agg(F.sum("amount_usd").alias("amount"), F.count("amount_usd").alias("paid"), F.count(F.lit(1)).alias("n"))


def customer_cells_of_lines(lines: DataFrame, buyers: DataFrame, products: DataFrame, unit: str) -> DataFrame:
    """The same cells from lines that know only their ``order_key`` and ``product_key``.

    Raw lines are shuffled once, to meet their buyers (one row per order: tenant, region, customer). They are reduced to
    (period, customer, product) before they leave the task, so only sums travel to the products (one row per product). A
    line without an order or a product stays, under null.
    """
    who = ["tenant_id", "region", "customer_id"]
    reduced = (
        lines.join(buyers, "order_key", "left")
        .groupBy(D.trunc_date(F.col("revenue_date"), unit).alias("period"), *who, "product_key")
        .agg(F.sum("amount_usd").alias("amount"), F.count("amount_usd").alias("paid"), F.count(F.lit(1)).alias("n"))
    )
    sums = [F.sum(c).alias(c) for c in ("amount", "paid", "n")]
    return reduced.join(products, "product_key", "left").groupBy("period", "product_line", *who).agg(*sums)


def bi_revenue_summary(rev: DataFrame, as_of: datetime) -> DataFrame:
    """Daily revenue by tenant, product line and region, with its provenance."""
    return bi_summary_of_cells(customer_cells(rev, "day"), as_of)


def bi_summary_of_cells(cells: DataFrame, as_of: datetime) -> DataFrame:
    """The daily summary from cells by day and customer."""
    return (
        cells.groupBy(F.col("period").alias("date"), "tenant_id", "product_line", "region")
        .agg(
            F.sum("amount").alias("total_revenue"),
            F.count("customer_id").alias("customer_count"),
            F.sum("n").alias("transaction_count"),
        )
        .withColumns(
            {
                "source_semantic_view": F.lit("finance_revenue"),
                "certification_status": F.lit("CERTIFIED"),
                "query_timestamp": D.lit_ts(as_of),
            }
        )
    )


def bi_tenant_totals(summary: DataFrame) -> DataFrame:
    return (
        summary.groupBy("tenant_id")
        .agg(F.count(F.lit(1)).alias("days_of_data"), F.sum("total_revenue").alias("total"))
        .orderBy(F.desc("total"), "tenant_id")
    )


def gdpr_safe_aggregates(rev: DataFrame, k: int = 5) -> DataFrame:
    """Monthly aggregates that may leave their region: groups of fewer than k customers are withheld."""
    return safe_aggregates_of_cells(customer_cells(rev, "month"), k)


def safe_aggregates_of_cells(cells: DataFrame, k: int = 5) -> DataFrame:
    """The aggregates that may leave from cells by month and customer."""
    return (
        cells.groupBy("period", "tenant_id", "region", "product_line")
        .agg(
            F.sum("amount").alias("total_revenue"),
            F.count("customer_id").alias("customer_count"),
            M.mean(F.sum("amount"), F.sum("paid")).alias("avg_transaction_value"),
        )
        .filter(F.col("customer_count") >= k)
        .withColumns(
            {
                "data_classification": F.lit("AGGREGATE"),
                "source_table": F.lit("multi_tenant.semantic.fct_revenue"),
            }
        )
    )


def k_anonymity_check(aggregates: DataFrame) -> DataFrame:
    return aggregates.agg(
        F.count(F.lit(1)).alias("aggregate_rows"), F.min("customer_count").alias("min_k_anonymity")
    )


# --- Fixed values: inventory lines that describe configuration rather than tables
CONFIGURED = {"Row Access Policies": "2 (fct_revenue + fct_usage)", "BI Service Roles": "2 (Tableau + PowerBI)"}


def platform_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table as text, and the configured policies and roles."""
    counted = [
        df.agg(F.count(F.lit(1)).cast("string").alias("value")).select(F.lit(label).alias("category"), "value")
        for label, df in tables.items()
    ]
    fixed = F.explode(F.create_map(*[F.lit(x) for pair in CONFIGURED.items() for x in pair])).alias("category", "value")
    spark = counted[0].sparkSession
    return reduce(DataFrame.unionByName, [*counted, spark.range(1).select(fixed)])


# --- Fixed values: demo tenants (tenant, rows, product lines, regions, customers, amount range)
DEMO_TENANTS = [
    ("TNT-001", 200, ["Platform", "Analytics", "Support"], ["AMER", "EMEA", "APAC", "LATAM"], 50, (5000, 50000)),
    ("TNT-002", 100, ["Platform", "Analytics"], ["AMER", "EMEA"], 20, (1000, 15000)),
    ("TNT-003", 30, ["Platform"], ["EMEA"], 5, (500, 3000)),
]
DEMO_PAGES = ["/dashboard", "/reports", "/settings", "/api-docs", "/home"]


def _cycle(values: list[str], key: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(key, F.lit(len(values))).cast("int"))


def _uniform(low: int, high: int, *seed: Column) -> Column:
    return F.pmod(F.xxhash64(*seed), F.lit(high - low + 1)) + low


def generate_tenant_revenue(spark: SparkSession, as_of: date, factor: int = 1) -> DataFrame:
    """Demo revenue of three tenants, ``factor`` times the standard 330 rows. Values come from a hash
    of the row number, so every run and every partitioning yields the same rows."""
    n = F.col("id")
    parts = [
        spark.range(rows * factor).select(
            F.lit(tenant).alias("tenant_id"),
            F.date_sub(D.lit_date(as_of), F.pmod(n, F.lit(rows)).cast("int")).alias("revenue_date"),
            _cycle(products, n).alias("product_line"),
            _cycle(regions, n).alias("region"),
            _uniform(*amounts, n, F.lit(tenant)).cast("decimal(12,2)").alias("amount_usd"),
            F.concat(F.lit("CUST-"), F.lpad(F.pmod(n, F.lit(customers)).cast("string"), 4, "0")).alias("customer_id"),
        )
        for tenant, rows, products, regions, customers, amounts in DEMO_TENANTS
    ]
    return reduce(DataFrame.unionByName, parts)


def generate_page_events(spark: SparkSession, as_of: datetime, rows: int = 1000) -> DataFrame:
    """Demo page loads of the last hour."""
    n = F.col("id")
    second = _uniform(0, 3600, n, F.lit("second"))
    return spark.range(rows).select(
        n.alias("event_id"),
        _cycle([t[0] for t in DEMO_TENANTS], n).alias("tenant_id"),
        F.concat(F.lit("USER-"), F.lpad(F.pmod(n, F.lit(100)).cast("string"), 4, "0")).alias("user_id"),
        _cycle(DEMO_PAGES, n).alias("page_name"),
        _uniform(100, 5000, n, F.lit("load")).cast("int").alias("load_time_ms"),
        F.timestamp_add("SECOND", -second, D.lit_ts(as_of)).alias("event_timestamp"),
    )
