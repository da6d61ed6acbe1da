"""Steps whose work or memory must not grow faster than their input."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from frames import rows
from plan_audit import physical_plan
from tallyward.operators import distinct_cells
from tallyward.sources import testdata as t
from tallyward.streaming import revenue_ledger


def star(spark, folder):
    """Lines of every kind, some twice, without a number, a date, a price, a flag or an order."""
    lines = [(i % 7, i, date(2000, 1 + i % 5, 1 + i % 28), 100.25 + i, 0.05 * (i % 3), None if i % 29 == 0 else i % 8, "F", [None, "A", "R", "N"][i % 4], 0.02) for i in range(200)]
    lines += [(1, 500, None, 7.0, 0.0, 1, "F", "A", 0.0), (2, 501, date(2000, 3, 3), None, 0.0, 1, "F", "R", 0.0), (99, 502, date(2000, 3, 4), 8.0, 0.0, 4, "O", "R", 0.0), *lines[:20]]
    ddl = "l_orderkey bigint, l_partkey bigint, l_shipdate date, l_extendedprice double, l_discount double, l_linenumber int, l_linestatus string, l_returnflag string, l_tax double"
    spark.createDataFrame(lines, ddl).write.parquet(f"{folder}/lineitem.parquet")
    orders = [*[(k, k % 3) for k in range(7)], (3, 2), (4, None)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint").write.parquet(f"{folder}/orders.parquet")
    return folder


def test_a_delivery_reads_the_facts_once(spark, folder):
    d = star(spark, folder)
    rev = t.fct_revenue(spark, d)
    late, adjusted = "revenue_type = 'one_time'", "credit_type = 'adjustment'"
    twice, more = "credit_type = 'refund' AND revenue_type = 'subscription'", F.col("amount_usd") + 1
    expected = [
        [(f"NOT ({late}) AND NOT ({adjusted})", 0, 1), (twice, 0, 1), (f"{adjusted} AND NOT ({late})", 1, 1)],
        [(f"{late} AND is_recurring IS NOT NULL", 0, 1), (f"{adjusted} AND NOT ({late})", 1, -1), (f"{adjusted} AND NOT ({late})", 0, 1)],
        [(twice, 0, -1)],
    ]
    for (delta, batch), parts in zip(t.revenue_deliveries(spark, d), expected, strict=True):
        assert physical_plan(delta).count("lineitem.parquet") == physical_plan(delta).count("orders.parquet") == 1
        known = [rev.filter(where).withColumns({"amount_usd": (more if add else F.col("amount_usd")).cast("decimal(30,4)"), "sign": F.lit(sign)}) for where, add, sign in parts]
        for other in known[1:]:
            known[0] = known[0].unionByName(other)
        got = delta.withColumn("amount_usd", F.col("amount_usd").cast("decimal(30,4)"))
        assert got.columns == known[0].columns and rows(got) == rows(known[0]) and rows(got)


def test_a_ledger_of_many_tasks(spark, folder, monkeypatch):
    """Small pieces: lines of a month lie in several, and sums and joins still see each customer whole."""
    monkeypatch.setattr(revenue_ledger, "TASK_LINES", 5)
    cust = spark.createDataFrame([(f"C{i}", "SMB" if i % 2 else "Enterprise", "EU") for i in range(9)], "customer_id string, segment string, region string")
    values = [(date(2000, 1 + i % 4, 1 + i % 5), None if i % 11 == 0 else f"C{i % 9}", Decimal(i), i % 3 == 0) for i in range(180)]
    lines = spark.createDataFrame(values, "recognized_date date, customer_id string, amount_usd decimal(12,4), is_recurring boolean")
    ledger = revenue_ledger.RevenueLedger(spark, folder)
    ledger.apply(revenue_ledger.signed(lines.filter("amount_usd < 150"), 1), cust, 1)
    ledger.apply(revenue_ledger.signed(lines.filter("amount_usd >= 150"), 1).unionByName(revenue_ledger.signed(lines.filter("amount_usd < 9"), -1)), cust, 2)
    whole = lines.filter("amount_usd >= 9").join(cust, "customer_id").groupBy(F.trunc("recognized_date", "month").alias("metric_month"), "segment", "region").agg(
        F.sum("amount_usd").cast("decimal(38,4)").alias("total_revenue"), F.sum(F.when(F.col("is_recurring"), F.col("amount_usd")).otherwise(0)).cast("decimal(38,4)").alias("recurring_revenue"), F.count_distinct("customer_id").alias("customer_count")
    )
    cells = ledger.read(cust, date(2001, 1, 1))
    assert rows(cells.select(whole.columns)) == rows(whole) and len(ledger.lines.read().inputFiles()) > 4
    lying = revenue_ledger.cells_of(ledger.lines.read(), cust, 180)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in lying and "37" in lying  # tasks follow the lines, not the session's number of partitions


def test_bitmaps_are_made_where_their_numbers_meet(spark, folder, monkeypatch):
    """No bitmap of a task's share is shuffled, and tasks follow the ids, not the session's number of partitions."""
    monkeypatch.setattr(distinct_cells, "TASK_IDS", 10)
    ids = spark.range(95).select(F.concat(F.lit("u"), "id").alias("id"))
    numbering = distinct_cells.extend_numbering(ids, folder, 1)
    assert distinct_cells.tasks_for(numbering) == 10 and distinct_cells.tasks_for(numbering.limit(0)) == 1
    facts = spark.range(900).select(F.concat(F.lit("u"), F.col("id") % 100).alias("user"), F.when(F.col("id") % 7 > 0, F.col("id") % 4).alias("month"))
    facts = facts.unionByName(facts.limit(50)).unionByName(spark.createDataFrame([(None, 1)], facts.schema))
    cells = distinct_cells.distinct_cells(facts, numbering, {"month": F.col("month")}, "user")
    tree = physical_plan(cells).splitlines()
    made = [i for i, line in enumerate(tree) if "SortAggregate" in line and "construct_agg" in line]
    assert len(made) == 2 and not any("Exchange" in line for line in tree[made[0] : made[1]])
    assert "RepartitionByExpression [month" in cells._jdf.queryExecution().optimizedPlan().toString()
    known = facts.join(ids, facts["user"] == ids["id"]).groupBy("month").agg(F.count_distinct("user").alias("distinct_count"))
    assert rows(distinct_cells.distinct_count(cells, {"month": F.col("month")})) == rows(known)
