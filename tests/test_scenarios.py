"""The governance, automation and tenancy scenarios with their stated outcomes."""

from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from frames import DAY, NOW, ago, catalog, catalog_row, change_log, domains, frame, incidents, one, requests, rows
from tallyward.context import Principal
from tallyward.operators import access, control, federation, governance, lifecycle, quality, tenancy
from tallyward.sources import seeds
from tallyward.streaming import page_loads

# ------------------------------------------------------------------ governance scenario


def test_scorecard_shows_the_five_metrics(spark):
    row = one(governance.governance_health_scorecard(catalog(spark), domains(spark), DAY))
    assert row.certification_coverage_pct == Decimal("60.0") and row.certification_health == "CRITICAL"
    assert row.ownership_coverage_pct == Decimal("100.0") and row.ownership_health == "HEALTHY"
    assert (row.active_metrics, row.zombie_metrics, row.total_domains, row.mature_domains) == (4, 0, 2, 1)
    assert row.avg_domain_certification_rate == Decimal("87.5") and row.total_metric_count == 5


def test_domain_maturity_keeps_the_stored_level_and_recommends_another(spark):
    got = rows(governance.domain_maturity_assessment(domains(spark), DAY), "domain_name", "current_maturity", "recommended_maturity")
    assert got == [("Finance", "ENTERPRISE", "GROWTH"), ("Marketing", "GROWTH", "GROWTH")]


def test_sox_evidence_is_compliant(spark):
    got = rows(governance.sox_evidence(change_log(spark), NOW), "control_area", "finding", "status")
    assert got == [
        ("Change Management", "Total promotions: 2, Approved: 2", "COMPLIANT"),
        ("Segregation of Duties", "Changes where requester != approver: 2", "COMPLIANT"),
    ]


def test_sox_evidence_finds_unapproved_and_self_approved_changes(spark):
    bad = [
        ("C3", "agent", "a", "BOB", [], ago(hours=9), ago(hours=2), False, "DEPLOYED"),
        ("C4", "agent", "b", "BOB", ["BOB"], ago(hours=9), ago(hours=2), False, "DEPLOYED"),
    ]
    got = rows(governance.sox_evidence(change_log(spark, bad), NOW), "status")
    assert got == [("FINDING",), ("NON-COMPLIANT",)]


def test_sox_evidence_of_an_empty_log(spark):
    got = rows(governance.sox_evidence(change_log(spark).limit(0), NOW), "control_area", "finding", "status")
    assert got[0] == ("Change Management", None, "NON-COMPLIANT")
    assert got[1][2] == "COMPLIANT"


def test_incident_within_its_sla(spark):
    row = one(governance.incident_sla_compliance(incidents(spark), NOW))
    assert (row.severity, row.total_incidents, row.within_sla) == (2, 1, 1)
    assert row.sla_compliance_pct == Decimal("100.0") and row.avg_mitigate_minutes == 120.0


def test_two_deployments_and_their_hours(spark):
    velocity = governance.change_velocity(change_log(spark), NOW)
    assert velocity.agg(F.sum("changes_deployed")).first()[0] == 2
    assert rows(velocity, "asset_type", "avg_hours_approval_to_deploy") == [("agent", 24.0), ("semantic_view", 48.0)]


def test_discovery_offers_certified_and_pending_metrics(spark):
    found = governance.metric_discovery_projection(
        governance.metric_discovery(catalog(spark), domains(spark), seeds.glossary_seed(spark))
    )
    got = rows(found, "metric_name", "certification_status", "domain_contact")
    assert [g[0] for g in got] == ["campaign_roi", "conversion_rate", "customer_acquisition_cost", "pipeline_sourced"]
    assert {g[2] for g in got} == {"SARAH_CHEN"}


def test_one_pending_request(spark):
    row = one(governance.request_pipeline_health(requests(spark), NOW))
    assert (row.status, row.request_count, row.sla_breached) == ("SUBMITTED", 1, 1)


def test_promotion_readiness_lists_the_path_s_gates(spark):
    ask = frame(spark, "asset_fqn string, target_environment string", [("analytics.semantic.marketing_campaigns", "STAGING")])
    got = governance.check_promotion_readiness(governance.with_source_environment(ask), seeds.promotion_gates(spark))
    assert rows(got, "gate_name") == [
        ("Metric Existence Check",), ("No PII in Metric Definitions",), ("Schema Validation",), ("Test Coverage Minimum",)
    ]
    assert {r.status for r in got.collect()} == {"PENDING"}


def test_nothing_to_decertify_and_no_zombies(spark):
    cat = catalog(spark)
    assert lifecycle.changed(cat, lifecycle.auto_decertify_expired(cat, DAY)).isEmpty()
    assert lifecycle.changed(cat, lifecycle.flag_zombies(cat, DAY)).isEmpty()


def test_glossary_lookup(spark):
    row = one(governance.glossary_lookup(seeds.glossary_seed(spark), "revenue"))
    assert row.commonly_confused_with == ["bookings", "billings", "ARR", "MRR"]


def test_inventory_of_the_seeded_tables(spark):
    got = dict(
        rows(
            governance.governance_inventory(
                {
                    "RACI Operations": seeds.raci_seed(spark),
                    "Promotion Gates": seeds.promotion_gates(spark),
                    "Regulatory Controls": seeds.regulatory_mapping(spark),
                    "Operating Cadences": seeds.operating_cadences(spark),
                    "Glossary Terms": seeds.glossary_seed(spark),
                    "Naming Conventions": seeds.naming_rules(spark),
                    "Onboarding Steps": seeds.onboarding_checklist(spark),
                }
            )
        )
    )
    assert got == {
        "RACI Operations": 13, "Promotion Gates": 10, "Regulatory Controls": 13, "Operating Cadences": 9,
        "Glossary Terms": 5, "Naming Conventions": 6, "Onboarding Steps": 11,
    }


def test_raci_and_gate_coverage_of_the_seeds(spark):
    raci = {r.operation_category: r for r in governance.raci_coverage(seeds.raci_seed(spark)).collect()}
    assert raci["creation"].operations_defined == 3 and raci["creation"].avg_sla_hours == 80.0
    assert raci["incident"].requiring_approval == 0
    gates = {r.promotion_path: r for r in governance.gate_coverage(seeds.promotion_gates(spark)).collect()}
    assert gates["DEV -> STAGING"].gate_count == 4
    assert (gates["STAGING -> PRODUCTION"].manual_gates, gates["STAGING -> PRODUCTION"].blocking_gates) == (3, 5)


def test_naming_examples_match_their_rules(spark):
    names = [(r[0], r[3], True) for r in seeds.NAMING_RULES] + [(r[0], r[4], False) for r in seeds.NAMING_RULES]
    assets = frame(spark, "asset_type string, asset_name string, valid boolean", names)
    checked = quality.naming_conventions_check(assets.select("asset_type", "asset_name"), seeds.naming_rules(spark))
    result = {(r.asset_type, r.asset_name): r.result for r in checked.collect()}
    for kind, name, valid in names:
        # a role may carry one qualifier after its type; "domain_steward_finance" does
        assert (result[kind, name] == "PASS") == valid, (kind, name)


def test_seeded_roles_inherit_down_to_the_restricted_consumer(spark):
    closure = access.effective_roles(seeds.role_grants_seed(spark))
    reach = {(r.role, r.granted_role): r.distance for r in closure.collect()}
    assert reach["governance_council_admin", "metric_consumer_restricted"] == 4
    assert reach["agent_service_sales", "metric_consumer_restricted"] == 2
    assert ("agent_service_sales", "metric_consumer_full") not in reach
    assert sum(role == "governance_council_admin" for role, _ in reach) == 12


def test_role_cycles_end(spark):
    loop = frame(spark, "role string, granted_role string", [("a", "b"), ("b", "c"), ("c", "a"), ("c", "c")])
    assert len(access.effective_roles(loop).collect()) == 6


def test_controls_never_validated(spark):
    states = governance.control_validation_status(seeds.regulatory_mapping(spark), DAY).select("validation_status").distinct()
    assert rows(states) == [("NOT_YET_VALIDATED",)]


# ------------------------------------------------------------------ automation scenario

REQUEST_DDL = "request_id bigint, submitted_at timestamp_ntz, requested_by string"


def _onboarding(spark, *names):
    ddl = REQUEST_DDL + ", domain_name string, description string, steward_user string, backup_steward string"
    return frame(spark, ddl, [(i, ago(minutes=60 - i), "ADMIN", n, "d", "DS_LEAD_CHEN", "ML_ENG_PATEL") for i, n in enumerate(names)])


def _certification(spark, *asks):
    ddl = REQUEST_DDL + ", metric_fqn string, data_quality_score decimal(5,2), approver string"
    return frame(spark, ddl, [(i, ago(minutes=60 - i), "ADMIN", *ask) for i, ask in enumerate(asks)])


@pytest.fixture()
def data_science(spark):
    """Domain onboarded and its first metric registered."""
    onboarded = control.onboard_domains(_onboarding(spark, "Data Science"), domains(spark), NOW)
    ddl = (
        REQUEST_DDL + ", domain string, metric_name string, business_definition string, semantic_view_fqn string,"
        " aggregation_method string, time_grain string, owner_role string, freshness_sla_hours bigint"
    )
    ask = frame(
        spark, ddl, [(1, NOW, "ADMIN", "Data Science", "model_accuracy_p95", "P95", "analytics.semantic.ds_models", "AVG", "daily", "R", 4)]
    )
    return onboarded, control.register_metrics(ask, onboarded.domains, catalog(spark), NOW)


def test_onboarding_succeeds_and_is_logged(spark, data_science):
    onboarded, _ = data_science
    row = one(onboarded.results)
    assert (row.status, row.steward_role) == ("SUCCESS", "DOMAIN_STEWARD_DATA_SCIENCE")
    added = one(onboarded.domains.filter("domain_name = 'Data Science'"))
    assert (added.governance_maturity, added.next_review_due.isoformat()) == ("FOUNDATION", "2025-12-17")
    entry = one(onboarded.log)
    assert entry.requested_by == "ADMIN" and entry.approved_by == ["ADMIN"] and entry.status == "DEPLOYED"


def test_onboarding_rejects_bad_and_taken_names(spark):
    got = control.onboard_domains(_onboarding(spark, "9lives", "FINANCE", "Legal", "legal", "x"), domains(spark), NOW)
    assert [r.status for r in got.results.orderBy("request_id").collect()] == ["FAILED", "FAILED", "SUCCESS", "FAILED", "FAILED"]
    assert got.log.count() == 1 and got.domains.count() == 3


def test_registration_makes_a_draft_and_counts_it(spark, data_science):
    _, registered = data_science
    row = one(registered.results)
    assert (row.status, row.metric_fqn) == ("SUCCESS", "data_science.semantic.model_accuracy_p95")
    draft = one(registered.catalog.filter("domain = 'Data Science'"))
    assert (draft.certification_status, draft.steward_role) == ("DRAFT", "DOMAIN_STEWARD_DATA_SCIENCE")
    assert one(registered.domains.filter("domain_name = 'Data Science'")).metric_count == 1


def test_certification_fails_below_the_threshold_and_passes_above(spark, data_science):
    _, registered = data_science
    name = "data_science.semantic.model_accuracy_p95"
    done = control.certify_metrics(
        _certification(spark, (name, 90.0, "STEWARD"), (name, 99.2, "STEWARD"), (name, 99.9, "ADMIN"), ("no.such", 99.0, "S")),
        registered.catalog,
        registered.domains,
        NOW,
    )
    got = done.results.orderBy("request_id").collect()
    assert [r.status for r in got] == ["FAILED", "SUCCESS", "FAILED", "FAILED"]
    assert got[0].error.startswith("Data quality score must be >= 95.0")
    assert got[2].error.startswith("Segregation of duties") and got[3].error == "Metric not found: no.such"
    metric = one(done.catalog.filter(F.col("metric_fqn") == name))
    assert (metric.certification_status, metric.data_quality_score) == ("CERTIFIED", Decimal("99.20"))
    assert metric.recertification_due == DAY + timedelta(90)
    assert one(done.domains.filter("domain_name = 'Data Science'")).certification_rate == Decimal("100.00")
    assert one(done.domains.filter("domain_name = 'Finance'")).certification_rate == Decimal("95.00")


def test_unknown_quality_is_not_below_the_threshold(spark):
    done = control.certify_metrics(
        _certification(spark, ("marketing.semantic.campaign_roi", None, "STEWARD")), catalog(spark), domains(spark), NOW
    )
    assert one(done.results).status == "SUCCESS"


def test_validation_suite_and_promotion(spark):
    ddl = "request_id bigint, asset_fqn string, asset_type string, target_environment string, git_commit_sha string, change_description string, requested_by string"
    asks = frame(
        spark,
        ddl,
        [
            (1, "analytics.semantic.marketing_demand", "semantic_view", "PRODUCTION", "a1", "d", "U"),
            (2, "analytics.semantic.marketing_campaigns", "semantic_view", "PRODUCTION", "a2", "d", "U"),
            (3, "analytics.semantic.marketing_campaigns", "semantic_view", "STAGING", "a3", "d", "U"),
            (4, "analytics.semantic.finance_revenue", "semantic_view", "PRODUCTION", "a4", "d", "U"),
            (5, "analytics.agents.marketing_agent", "agent", "PRODUCTION", "a5", "d", "U"),
            (6, "analytics.dash.board_one", "dashboard", "STAGING", "a6", "d", "U"),
        ],
    )
    suite = {(r.asset_fqn, r.target_environment): r for r in control.run_validation_suite(asks, catalog(spark)).collect()}
    blocked = suite["analytics.semantic.marketing_campaigns", "PRODUCTION"]
    assert blocked.gates_evaluated == 4 and blocked.results[3]["detail"] == "1 metrics not yet certified"
    empty = suite["analytics.semantic.finance_revenue", "PRODUCTION"]
    assert [g["status"] for g in empty.results] == ["PASS", "PASS", "FAIL", "PASS"]
    promoted = control.promote_assets(asks, catalog(spark), NOW)
    assert [r.status for r in promoted.results.orderBy("request_id").collect()] == [
        "SUCCESS", "BLOCKED", "SUCCESS", "BLOCKED", "SUCCESS", "BLOCKED"
    ]
    assert rows(promoted.log, "git_commit_sha", "source_environment") == [("a1", "STAGING"), ("a3", "DEV"), ("a5", "STAGING")]


def test_recertification_rules(spark):
    due = DAY + timedelta(3)
    rows_ = [
        catalog_row(10, "good", "v", "CERTIFIED", due, NOW, 100, 1, 1, 98.0),
        catalog_row(11, "low_quality", "v", "CERTIFIED", due, NOW, 100, 1, 1, 97.9),
        catalog_row(12, "rarely_used", "v", "CERTIFIED", due, NOW, 99, 1, 1, 99.0),
        catalog_row(13, "in_trouble", "v", "CERTIFIED", due, NOW, 500, 1, 1, 99.0),
        catalog_row(14, "too_early", "v", "CERTIFIED", DAY + timedelta(8), NOW, 500, 1, 1, 99.0),
        catalog_row(15, "healed", "v", "CERTIFIED", DAY + timedelta(7), NOW, 500, 1, 1, 99.0),
    ]
    troubles = [
        ("I2", 1, ["other", "in_trouble"], ago(days=89), "OPEN", 1, 1, 1),
        ("I3", 1, ["healed"], ago(days=92), "OPEN", 1, 1, 1),
    ]
    cat = catalog(spark, rows_)
    after = lifecycle.auto_recertify(cat, incidents(spark, troubles), NOW)
    assert rows(lifecycle.changed(cat, after), "metric_name") == [("good",), ("healed",)]


def test_expiry_has_a_week_of_grace(spark):
    cat = catalog(
        spark,
        [
            catalog_row(10, "late", "v", "CERTIFIED", DAY - timedelta(8), NOW, 1, 1, 1, 99.0),
            catalog_row(11, "in_grace", "v", "CERTIFIED", DAY - timedelta(7), NOW, 1, 1, 1, 99.0),
        ],
    )
    assert rows(lifecycle.changed(cat, lifecycle.auto_decertify_expired(cat, DAY)), "metric_name") == [("late",)]


def test_zombies_and_deprecation_are_tagged_once(spark):
    cat = catalog(
        spark,
        [
            catalog_row(10, "zombie", "v", "CERTIFIED", DAY, ago(days=61), 0, 0, 0, 99.0, tags=["x"]),
            catalog_row(11, "never_asked", "v", "CERTIFIED", DAY, None, 0, 0, 0, 99.0),
            catalog_row(12, "idle_draft", "v", "DRAFT", DAY, ago(days=181), 0, 0, 0, 99.0),
        ],
    )
    flagged = lifecycle.flag_zombies(cat, DAY)
    assert rows(lifecycle.changed(cat, flagged), "metric_name", "tags") == [("zombie", ["x", "ZOMBIE_CANDIDATE"])]
    assert lifecycle.changed(flagged, lifecycle.flag_zombies(flagged, DAY)).isEmpty()
    retired = lifecycle.auto_deprecate_unused(flagged, DAY)
    assert rows(lifecycle.changed(flagged, retired), "metric_name") == [("email_engagement",), ("idle_draft",)]
    assert lifecycle.changed(retired, lifecycle.auto_deprecate_unused(retired, DAY)).isEmpty()


def test_maturity_follows_the_catalog(spark):
    after = {r.domain_name: r for r in lifecycle.recalculate_domain_maturity(domains(spark), catalog(spark)).collect()}
    assert after["Marketing"].certification_rate == Decimal("60.00") and after["Marketing"].governance_maturity == "GROWTH"
    assert after["Marketing"].avg_data_quality == Decimal("97.40")
    assert (after["Finance"].metric_count, after["Finance"].governance_maturity) == (0, "FOUNDATION")
    assert after["Finance"].avg_data_quality is None


def test_alerts_respect_condition_and_cooldown(spark):
    conditions = control.alert_conditions(catalog(spark), domains(spark), incidents(spark), change_log(spark), NOW)
    met = dict(rows(conditions))
    assert met["Certification Below 80%"] and sum(met.values()) == 1
    rules = seeds.alert_rules(spark).withColumn("last_fired", F.col("last_fired").cast("timestamp_ntz"))
    first = control.evaluate_alerts(rules, conditions, NOW)
    assert rows(first.filter("fired"), "rule_name") == [("Certification Below 80%",)]
    rules = first.drop("fired")
    assert control.evaluate_alerts(rules, conditions, NOW + timedelta(hours=23)).filter("fired").isEmpty()
    assert control.evaluate_alerts(rules, conditions, NOW + timedelta(hours=24)).filter("fired").count() == 1


def test_usage_is_counted_by_substring_and_case_blind(spark):
    history = frame(
        spark,
        "query_id bigint, user_name string, query_text string, start_time timestamp_ntz, execution_status string",
        [
            (1, "ann", "SELECT * FROM Analytics.Semantic.Marketing_Demand", ago(days=1), "SUCCESS"),
            (2, "bob", "select x\nfrom (analytics.semantic.marketing_demand_v2)", ago(days=2), "SUCCESS"),
            (2, "bob", "select x\nfrom analytics.semantic.marketing_demand;", ago(days=2), "SUCCESS"),
            (3, "cat", "select analytics.semantic.marketing_demand", ago(days=31), "SUCCESS"),
            (4, "dan", "select analytics.semantic.marketing_demand", ago(days=3), "FAILED"),
            (5, "eve", "select 1 from \"odd  view\" t", ago(days=4), "SUCCESS"),
        ],
    )
    cat = catalog(spark, [catalog_row(20, "odd", "Odd  View", "DRAFT", None, None, 0, 0, 0, 99.0)])
    usage = {r.name: r for r in lifecycle.view_usage(cat, history, NOW).collect()}
    assert set(usage) == {"analytics.semantic.marketing_demand", "odd  view"}
    demand = usage["analytics.semantic.marketing_demand"]
    assert (demand.query_count, demand.consumer_count, demand.last_queried) == (2, 2, ago(days=1))
    after = lifecycle.refresh_usage_stats(cat, history, NOW)
    same = rows(after.filter("semantic_view_fqn like '%campaigns'"))
    assert same == rows(cat.filter("semantic_view_fqn like '%campaigns'"))


# ------------------------------------------------------------------ tenancy scenario


@pytest.fixture(scope="module")
def demo_revenue(spark):
    return tenancy.generate_tenant_revenue(spark, DAY).cache()


def test_demo_rows_are_complete_and_repeatable(spark, demo_revenue):
    assert demo_revenue.count() == 330
    again = tenancy.generate_tenant_revenue(spark, DAY).repartition(7)
    assert again.exceptAll(demo_revenue).isEmpty()
    amounts = demo_revenue.groupBy("tenant_id").agg(F.min("amount_usd").alias("lo"), F.max("amount_usd").alias("hi"))
    for tenant, low, high in rows(amounts):
        bounds = {t[0]: t[5] for t in tenancy.DEMO_TENANTS}[tenant]
        assert bounds[0] <= low and high <= bounds[1]


def test_isolation(spark, demo_revenue):
    users = seeds.tenant_users_seed(spark)
    everyone = access.tenant_row_counts(demo_revenue, users, Principal("root", "ACCOUNTADMIN"))
    assert dict(rows(everyone)) == {"TNT-001": 200, "TNT-002": 100, "TNT-003": 30}
    mine = access.tenant_row_counts(demo_revenue, users, Principal("analyst@acme.com", "TEST_TENANT_USER"))
    assert dict(rows(mine)) == {"TNT-001": 200}
    nobody = access.tenant_row_counts(demo_revenue, users, Principal("x@y.z", "TEST_TENANT_USER"))
    assert nobody.isEmpty()


def test_tier_access(spark):
    asks = frame(
        spark,
        "user_email string, metric_name string",
        [
            ("analyst@acme.com", "anything"),
            ("user@initech.com", "active_users"),
            ("user@initech.com", "churn_risk_score"),
            ("stranger@x.y", "active_users"),
        ],
    )
    got = access.can_access_metric(asks, seeds.tenants_seed(spark), seeds.tenant_users_seed(spark))
    assert sorted(r.can_access for r in got.collect()) == [False, False, True, True]
    assert {r.user_email: r.can_access for r in got.filter("metric_name = 'active_users'").collect()} == {
        "user@initech.com": True, "stranger@x.y": False
    }


def test_seeded_tenants_have_exactly_their_tier_s_metrics(spark):
    got = access.tier_entitlements(seeds.tenants_seed(spark), seeds.tier_metrics(spark))
    assert rows(got.select("entitlement").distinct()) == [("GRANTED",)]


def test_interface_answers_200_403_404(spark):
    asks = frame(
        spark,
        "request_id bigint, metric_name string, tenant_id string",
        [
            (1, "customer_acquisition_cost", "TNT-001"),
            (2, "customer_acquisition_cost", "TNT-003"),
            (3, "nonexistent_metric", "TNT-001"),
            (4, "campaign_roi", "TNT-001"),
            (5, "customer_acquisition_cost", "TNT-999"),
        ],
    )
    got = access.query_metric_batch(asks, catalog(spark), seeds.tenants_seed(spark), seeds.rate_limits(spark))
    answers = {r.request_id: r for r in got.collect()}
    assert [answers[i].status for i in range(1, 6)] == [200, 403, 404, 404, 403]
    assert (answers[1].tier, answers[1].rate_limit_rpm) == ("enterprise", 500)
    log = access.request_log_rows(got)
    assert dict(rows(access.api_status_summary(log))) == {200: 1, 403: 2, 404: 2}
    assert {r.served_from for r in log.filter("response_status <> 200").collect()} == {"rejected"}


def test_spoke_resolution_and_glossary_sync(spark):
    asks = frame(spark, "metric_name string", [("customer_acquisition_cost",), ("campaign_roi",), ("nope",)])
    got = {r.metric_name: r.status for r in federation.spoke_resolve_metrics(asks, catalog(spark)).collect()}
    assert got == {"customer_acquisition_cost": "RESOLVED", "campaign_roi": "NOT_FOUND", "nope": "NOT_FOUND"}
    spokes = frame(spark, "spoke string, local_version int", [("US", 1), ("EU", 3)])
    sync = federation.glossary_sync(spokes, seeds.glossary_versions_seed(spark))
    assert rows(sync, "spoke", "status", "versions_behind") == [("EU", "IN_SYNC", 0), ("US", "OUT_OF_SYNC", 2)]


def test_a_name_certified_twice_resolves_once(spark):
    twin = catalog_row(30, "conversion_rate", "v", "CERTIFIED", None, None, 1, 1, 1, 99.0, domain="Alpha")
    asks = frame(spark, "metric_name string", [("conversion_rate",)])
    assert one(federation.spoke_resolve_metrics(asks, catalog(spark, [twin]))).domain == "Alpha"


def test_federation_health(spark):
    row = one(
        federation.federation_health(
            catalog(spark), domains(spark), seeds.glossary_seed(spark), seeds.glossary_versions_seed(spark)
        )
    )
    assert (row.certified_metrics, row.active_domains, row.glossary_terms, row.glossary_version) == (3, 2, 5, 3)


def test_small_groups_are_withheld(spark, demo_revenue):
    safe = tenancy.gdpr_safe_aggregates(demo_revenue)
    check = one(tenancy.k_anonymity_check(safe))
    assert check.aggregate_rows > 0 and check.min_k_anonymity >= 5
    whole = demo_revenue.groupBy(F.trunc("revenue_date", "month"), "tenant_id", "region", "product_line").agg(
        F.count_distinct("customer_id").alias("k")
    )
    assert check.aggregate_rows == whole.filter("k >= 5").count()


def test_bi_totals_keep_every_dollar(spark, demo_revenue):
    totals = tenancy.bi_tenant_totals(tenancy.bi_revenue_summary(demo_revenue, NOW))
    assert totals.agg(F.sum("total")).first()[0] == demo_revenue.agg(F.sum("amount_usd")).first()[0]


def test_freshness_bands(spark):
    ages = [0, 60, 61, 300, 301, 900, 901]
    minutes = frame(spark, "metric_minute timestamp_ntz, age int", [(NOW - timedelta(seconds=a), a) for a in ages])
    aged = page_loads.page_load_with_freshness(minutes, NOW)
    got = {r.age: (r.data_age_seconds, r.freshness_status) for r in aged.collect()}
    assert all(got[a][0] == a for a in ages)
    assert [got[a][1] for a in ages] == ["LIVE", "LIVE", "RECENT", "RECENT", "DELAYED", "DELAYED", "STALE"]


def test_demo_page_events_fill_the_last_hour(spark):
    events = tenancy.generate_page_events(spark, NOW)
    metrics = page_loads.page_load_metrics(events, NOW)
    assert metrics.agg(F.sum("page_views")).first()[0] == 1000
    inventory = tenancy.platform_inventory({"Streaming Events": events, "Tenants": seeds.tenants_seed(spark)})
    assert dict(rows(inventory))["Streaming Events"] == "1000" and inventory.count() == 4
