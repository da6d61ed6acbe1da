"""Row policies and the entitlement check as SQL functions, for users who write SQL.

``install`` gives the governed tables names and defines functions over them. They are ordinary
queries to Spark: a call is planned as the semi join or aggregate that the DataFrame form is.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def install_tenant_rows(spark: SparkSession, name: str, table: DataFrame, tenant_users: DataFrame) -> None:
    """``name(viewer)``: the rows of the table that belong to the viewer's tenants."""
    table.createOrReplaceTempView(f"{name}_governed")
    tenant_users.createOrReplaceTempView("governed_tenant_users")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    listed = ", ".join(f"r.`{c}`" for c in table.columns)
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(viewer STRING) RETURNS TABLE ({columns}) RETURN
        SELECT {listed} FROM {name}_governed AS r LEFT SEMI JOIN governed_tenant_users AS u
        ON r.tenant_id = u.tenant_id AND u.user_email = {name}.viewer"""
    )


def install_access_check(spark: SparkSession, tables: Mapping[str, DataFrame], name: str = "can_access_metric") -> None:
    """``name(viewer, metric)``: whether an active tenant of the viewer enables the metric, or all. From the tables ``tenants`` and ``tenant_users``."""
    for table in ("tenants", "tenant_users"):
        tables[table].createOrReplaceTempView(f"governed_{table}")
    spark.sql(
        """CREATE OR REPLACE TEMPORARY VIEW governed_entitlements AS
        SELECT DISTINCT u.user_email, m.metric_name FROM governed_tenant_users AS u
        JOIN (SELECT tenant_id, explode(metrics_enabled) AS metric_name FROM governed_tenants WHERE is_active) AS m ON u.tenant_id = m.tenant_id"""
    )
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(viewer STRING, metric STRING) RETURNS BOOLEAN RETURN
        (SELECT count(*) FROM governed_entitlements AS g WHERE g.user_email = {name}.viewer AND g.metric_name = {name}.metric)
        + (SELECT count(*) FROM governed_entitlements AS g WHERE g.user_email = {name}.viewer AND g.metric_name = '*') > 0"""
    )
