"""Rows that find no partner stay."""

import os

from tallyward.operators import quality
from tallyward.sources import testdata as t


def test_assets_without_a_rule_stay(spark):
    assets = spark.createDataFrame([("view", "a_b"), ("view", "AB"), ("table", "x")], "asset_type string, asset_name string")
    rules = spark.createDataFrame([("view", "[a-z_]+", "WARN", True), ("table", "x", "BLOCK", False)], "asset_type string, pattern_regex string, enforcement_level string, is_active boolean")
    got = sorted((r.asset_name, r.enforcement_level, r.result) for r in quality.naming_conventions_check(assets, rules).collect())
    assert got == [("AB", "WARN", "WARN"), ("a_b", "WARN", "PASS"), ("x", None, None)]


def test_lines_without_order_or_part_stay(spark, sf, folder):
    for name in ("nation", "region", "customer"):
        os.symlink(f"{sf}/{name}.parquet", f"{folder}/{name}.parquet")
    t.table(spark, sf, "orders").filter("o_orderkey % 2 = 0").write.parquet(f"{folder}/orders.parquet")
    t.table(spark, sf, "part").filter("p_partkey % 3 = 0").write.parquet(f"{folder}/part.parquet")
    t.table(spark, sf, "lineitem").write.parquet(f"{folder}/lineitem.parquet")
    got = t.tenant_revenue(spark, folder)
    assert got.count() == t.table(spark, sf, "lineitem").count()
    assert got.filter("tenant_id IS NULL").count() > 0 and got.filter("product_line IS NULL").count() > 0
