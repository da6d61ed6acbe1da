"""Schemas, appended logs, published states and the clustered layout."""

import pytest
from pyspark.sql import functions as F

from frames import NOW, catalog, change_log, rows
from tallyward.operators import quality
from tallyward.sources import schemas, tables
from tallyward.sources import testdata as t

LOG = "governance.devops.change_log"


def test_written_tables_have_a_schema(spark):
    for name in schemas.TABLES:
        assert set(schemas.required(name)) <= set(schemas.schema(name).names)
    assert schemas.schema(LOG)["approved_by"].dataType.simpleString() == "array<string>"
    assert "asset_fqn" in schemas.required(LOG)


def test_log_rows_get_ids_and_times(spark, folder):
    rows_ = change_log(spark).drop("change_id", "deployed_at")
    tables.append_rows(rows_, folder, LOG, NOW)
    tables.append_rows(rows_, folder, LOG, NOW)
    log = tables.read_table(spark, folder, LOG)
    assert log.count() == 4 and log.select("change_id").distinct().count() == 4
    assert rows(log.select("deployed_at").distinct()) == [(NOW,)]
    assert log.schema == schemas.schema(LOG)
    with pytest.raises(ValueError, match="no columns"):
        tables.append_rows(rows_.withColumn("surprise", F.lit(1)), folder, LOG, NOW)


def test_states_are_versions(spark, folder):
    name = "governance.operating_model.metric_catalog"
    first = catalog(spark)
    tables.publish_state(first, folder, name, 1)
    second = tables.read_state(spark, folder, name).filter("certification_status = 'CERTIFIED'")
    tables.publish_state(second, folder, name, 2)
    assert tables.read_state(spark, folder, name).count() == 3
    found = quality.constraint_violations(tables.read_state(spark, folder, name), ["metric_fqn"], ["metric_name"])
    assert {r.violations for r in found.collect()} == {0}


def test_clustered_facts_skip_files(spark, sf, folder):
    facts = t.fct_revenue(spark, sf)
    tables.write_clustered(facts, f"{folder}/facts", files=8)
    stored = spark.read.parquet(f"{folder}/facts")
    assert stored.count() == facts.count()
    spans = stored.groupBy(F.input_file_name()).agg(F.min("recognized_date").alias("a"), F.max("recognized_date").alias("b"))
    ordered = sorted((r.a, r.b) for r in spans.collect())
    assert len(ordered) > 4 and all(x[1] <= y[0] for x, y in zip(ordered, ordered[1:]))
