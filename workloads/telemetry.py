"""Answer telemetry, question binding and row policies with their SQL twins."""

from tallyward.context import Principal
from tallyward.operators import access, binding, telemetry
from tallyward.plans import models
from tallyward.sources import testdata as t

from .common import oracle, query, rounded, share

NOW = t.EVENT_TIME
ANALYST = Principal("U3", "ANALYST")
AUDITOR = Principal("U3", "ANALYST", frozenset({"AGENT_AUDITOR"}))
MANAGER = Principal("manager_3", "AGENT_USER")

QUERIES = {
    "agent_health_dashboard": query(lambda s, d: telemetry.agent_health_dashboard(t.answer_log(s, d), NOW)),
    "test_pass_rate": query(lambda s, d: telemetry.test_pass_rate(t.answer_tests(s, d))),
    "grounding_rate": query(lambda s, d: telemetry.grounding_rate(t.governance_log(s, d), NOW)),
    "consistency_score": query(lambda s, d: telemetry.consistency_score(t.governance_log(s, d), NOW)),
    "escalation_rate": query(lambda s, d: telemetry.escalation_rate(t.governance_log(s, d), NOW)),
    "confidence_by_agent": query(lambda s, d: telemetry.confidence_by_agent(t.governance_log(s, d), NOW)),
    "confidence_drift": query(lambda s, d: telemetry.confidence_drift(t.answer_log(s, d), NOW)),
    "answer_inconsistencies": query(lambda s, d: telemetry.answer_inconsistencies(t.governance_log(s, d), NOW)),
    "answer_variants": query(lambda s, d: telemetry.answer_variants(t.governance_log(s, d), NOW)),
    "escalation_questions": query(lambda s, d: telemetry.escalation_questions(t.escalations(s, d), NOW)),
    "signal_questions": query(
        lambda s, d: telemetry.escalation_questions(t.escalations(s, d), NOW, days=7, keys=("escalation_reason",))
    ),
    "weekly_signals": query(lambda s, d: telemetry.weekly_signals(t.governance_log(s, d), t.escalations(s, d), NOW)),
    "escalation_improvements": query(lambda s, d: telemetry.escalation_improvements(t.escalations(s, d), NOW)),
    "security_compliance": query(lambda s, d: telemetry.security_compliance(t.governance_log(s, d), NOW)),
    "grounding_verification": query(lambda s, d: telemetry.grounding_verification(t.answer_log(s, d), NOW)),
    "resolution_patterns": query(lambda s, d: telemetry.resolution_patterns(t.governance_log(s, d), NOW)),
    "escalation_analysis": query(lambda s, d: telemetry.escalation_analysis(t.escalations(s, d), NOW)),
    "test_inventory": query(lambda s, d: telemetry.test_inventory(t.answer_tests(s, d))),
    "test_inventory_governance": query(lambda s, d: telemetry.test_inventory_governance(t.answer_tests(s, d))),
    "test_run_status": query(lambda s, d: telemetry.test_run_status(t.answer_tests(s, d))),
    "bind_questions": query(lambda s, d: binding.bind_questions(t.questions(s, d))),
    "bound_targets": query(lambda s, d: binding.bound_targets(binding.bind_questions(t.questions(s, d)), models.declared_metrics(s))),
    "audit_access_own_role": query(lambda s, d: access.audit_access(t.answer_log(s, d), ANALYST)),
    "audit_access_auditor": query(lambda s, d: access.audit_access(t.answer_log(s, d), AUDITOR)),
    "region_access": query(
        lambda s, d: access.region_access(
            t.dim_customer(s, d).select("customer_id", "region", "segment"), t.user_region_mapping(s, d), MANAGER
        )
    ),
}

_WEEK = "TIMESTAMP '2024-01-24 00:00:00'"
_MONTH = "TIMESTAMP '2024-01-01 00:00:00'"
_GROUNDED = "count(*) FILTER (WHERE len(metrics_used) > 0)"
_ESCALATED = "count(*) FILTER (WHERE escalated)"
_CENT = "CAST({} * 100 AS HUGEINT)"


def _values(rows):
    return ", ".join("(" + ", ".join("'" + str(v) + "'" for v in row) + ")" for row in rows)


_RULES = _values([(b.agent, b.phrase, b.metric, b.view) for b in binding.BINDINGS])
_LIMITS = _values([(b.agent, b.phrase, b.behavior, b.boundary_type) for b in binding.BOUNDARIES])
_LOG_COLUMNS = """interaction_id, "timestamp", agent_name, user_id, user_role, resolved_semantic_view, resolved_metric,
       CAST(confidence_score AS DOUBLE) AS confidence_score, response_time_ms, grounded, escalated"""

ORACLE = {
    "agent_health_dashboard": f"""
SELECT agent_name, count(*) AS total_interactions,
       {share("count(*) FILTER (WHERE grounded)", "count(*)")} AS grounding_rate_pct,
       {rounded(_CENT.format("sum(confidence_score)"), "count(confidence_score)")} AS avg_confidence_pct,
       {share(_ESCALATED, "count(*)")} AS escalation_rate_pct,
       {rounded("sum(response_time_ms)", "count(*)", 0)} AS avg_response_ms,
       count(DISTINCT user_id) AS unique_users
FROM answer_log WHERE "timestamp" >= {_WEEK} GROUP BY 1""",
    "test_pass_rate": f"""
SELECT test_category, count(*) AS total_tests, count(*) FILTER (WHERE last_result = 'PASS') AS passed,
       count(*) FILTER (WHERE last_result = 'FAIL') AS failed,
       {share("count(*) FILTER (WHERE last_result = 'PASS')", "count(*)")} AS pass_rate
FROM answer_tests WHERE is_active GROUP BY 1""",
    "grounding_rate": f"""
SELECT 'Grounding Rate' AS kpi, grounded, total, pct,
       CASE WHEN pct >= 95 THEN 'HEALTHY' WHEN pct >= 85 THEN 'WARNING' ELSE 'CRITICAL' END AS status
FROM (SELECT {_GROUNDED} AS grounded, count(*) AS total, {share(_GROUNDED, "count(*)")} AS pct
      FROM governance_log WHERE created_at >= {_WEEK})""",
    "consistency_score": f"""
WITH q AS (SELECT normalized_question, count(DISTINCT answer_summary) AS a FROM governance_log
           WHERE created_at >= {_MONTH} AND normalized_question IS NOT NULL GROUP BY 1 HAVING count(*) >= 3),
     k AS (SELECT count(*) FILTER (WHERE a = 1) AS consistent, count(*) AS total_questions FROM q),
     p AS (SELECT *, {share("consistent", "total_questions")} AS consistency_pct FROM k)
SELECT 'Consistency Score' AS kpi, consistent, total_questions, consistency_pct,
       CASE WHEN consistency_pct >= 99 THEN 'HEALTHY' WHEN consistency_pct >= 95 THEN 'WARNING' ELSE 'CRITICAL' END AS status
FROM p""",
    "escalation_rate": f"""
SELECT 'Escalation Rate' AS kpi, escalated, total, escalation_pct,
       CASE WHEN escalation_pct BETWEEN 2 AND 10 THEN 'HEALTHY' WHEN escalation_pct < 2 THEN 'WARNING: Too permissive?'
            ELSE 'CRITICAL: Too many escalations' END AS status
FROM (SELECT {_ESCALATED} AS escalated, count(*) AS total, {share(_ESCALATED, "count(*)")} AS escalation_pct
      FROM governance_log WHERE created_at >= {_WEEK})""",
    "confidence_by_agent": f"""
SELECT agent_name, {rounded(_CENT.format("sum(resolution_confidence)"), "count(resolution_confidence)")} AS avg_confidence_pct,
       round(quantile_cont(CAST(resolution_confidence AS DOUBLE), 0.1) * 100, 1) AS p10_confidence,
       count(*) AS query_count, count(*) FILTER (WHERE resolution_confidence < 0.6) AS very_low_confidence_count
FROM governance_log WHERE created_at >= {_WEEK} GROUP BY 1""",
    "confidence_drift": f"""
WITH d AS (SELECT CAST("timestamp" AS DATE) AS day, agent_name, resolved_metric,
                  CAST(sum(confidence_score) AS DOUBLE) / count(confidence_score) AS c
           FROM answer_log WHERE "timestamp" >= {_MONTH} AND grounded GROUP BY 1, 2, 3),
     s AS (SELECT agent_name, resolved_metric, avg(c) AS m, stddev_samp(c) AS v, count(DISTINCT day) AS days_active
           FROM d GROUP BY 1, 2 HAVING count(DISTINCT day) >= 5)
SELECT agent_name, resolved_metric, round(m, 3) AS avg_confidence, round(v, 3) AS confidence_volatility, days_active,
       CASE WHEN v > 0.1 THEN 'HIGH DRIFT - INVESTIGATE' WHEN v > 0.05 THEN 'MODERATE DRIFT - MONITOR' ELSE 'STABLE' END AS drift_status
FROM s""",
    "answer_inconsistencies": f"""
SELECT normalized_question, min(created_at) AS first_asked, max(created_at) AS last_asked,
       count(DISTINCT answer_summary) AS distinct_answers,
       array_to_string(list_sort(list(DISTINCT answer_summary)), '|') AS all_answers,
       array_to_string(list_sort(list(DISTINCT array_to_string(metrics_used, ','))), '|') AS metrics_used_variations
FROM governance_log WHERE created_at >= {_MONTH} AND normalized_question IS NOT NULL
GROUP BY 1 HAVING count(DISTINCT answer_summary) > 1 ORDER BY distinct_answers DESC, normalized_question LIMIT 20""",
    "answer_variants": f"""
SELECT normalized_question, answer_summary, array_to_string(metrics_used, '|') AS metrics_used, count(*) AS times_given,
       min(created_at) AS first_given, max(created_at) AS last_given
FROM governance_log g WHERE created_at >= {_MONTH}
  AND normalized_question IN (SELECT normalized_question FROM governance_log WHERE created_at >= {_MONTH}
                              GROUP BY 1 HAVING count(DISTINCT answer_summary) > 1)
GROUP BY normalized_question, answer_summary, g.metrics_used""",
    "escalation_questions": f"""
SELECT agent_name, escalation_reason, user_question, count(*) AS times_asked, max(created_at) AS last_asked
FROM escalations WHERE created_at >= {_MONTH} GROUP BY 1, 2, 3""",
    "signal_questions": f"""
SELECT escalation_reason, user_question, count(*) AS times_asked, max(created_at) AS last_asked
FROM escalations WHERE created_at >= {_WEEK} GROUP BY 1, 2""",
    "weekly_signals": f"""
WITH u AS (SELECT 'Low Confidence Questions' AS improvement_type, original_question AS topic, original_question AS detail,
                  count(*) AS frequency,
                  CAST({rounded(_CENT.format("sum(resolution_confidence)"), "count(*)", 0)} AS BIGINT) || '% confidence' AS severity
           FROM governance_log WHERE resolution_confidence < 0.7 AND created_at >= {_WEEK}
           GROUP BY original_question HAVING count(*) >= 2
           UNION ALL
           SELECT 'Escalation Patterns', escalation_reason,
                  escalation_reason || ': ' || string_agg(DISTINCT substr(user_question, 1, 60), ' | ' ORDER BY substr(user_question, 1, 60)),
                  count(*), 'Escalated ' || count(*) || ' times'
           FROM escalations WHERE created_at >= {_WEEK} GROUP BY escalation_reason HAVING count(*) >= 2)
SELECT improvement_type, detail, frequency, severity FROM u ORDER BY frequency DESC, improvement_type, topic LIMIT 20""",
    "escalation_improvements": """
SELECT agent_name, escalation_reason, escalation_gate, count(*) AS occurrences,
       count(*) FILTER (WHERE led_to_new_metric) AS led_to_improvements
FROM escalations WHERE created_at >= TIMESTAMP '2023-12-31 00:00:00' GROUP BY 1, 2, 3
ORDER BY occurrences DESC, agent_name, escalation_reason, escalation_gate LIMIT 20""",
    "security_compliance": f"""
SELECT agent_name, user_role, count(*) AS total_queries, count(DISTINCT user_id) AS unique_users,
       count(*) FILTER (WHERE len(rls_policies_applied) > 0) AS rls_enforced_count,
       count(*) FILTER (WHERE len(masking_policies_applied) > 0) AS masking_enforced_count,
       count(*) FILTER (WHERE NOT provenance_disclosed) AS provenance_gaps
FROM governance_log WHERE created_at >= {_WEEK} GROUP BY 1, 2
HAVING count(*) FILTER (WHERE NOT provenance_disclosed) > 0 OR count(*) FILTER (WHERE len(rls_policies_applied) > 0) = 0""",
    "grounding_verification": f"""
SELECT agent_name, resolved_semantic_view, resolved_metric, count(*) AS usage_count,
       {rounded(_CENT.format("sum(confidence_score)"), "count(confidence_score) * 100", 3)} AS avg_confidence
FROM answer_log WHERE "timestamp" >= {_WEEK} AND grounded GROUP BY 1, 2, 3
ORDER BY usage_count DESC, agent_name, resolved_semantic_view, resolved_metric LIMIT 20""",
    "resolution_patterns": f"""
SELECT agent_name, array_to_string(metrics_used, '|') AS metrics_used, count(*) AS query_count,
       CAST(sum(resolution_confidence) AS DOUBLE) / count(*) AS avg_confidence,
       CAST(sum(execution_time_ms) AS DOUBLE) / count(*) AS avg_execution_ms,
       count(*) FILTER (WHERE disambiguation_applied) AS disambiguation_count, {_ESCALATED} AS escalation_count
FROM governance_log WHERE created_at >= {_WEEK} GROUP BY 1, 2 ORDER BY query_count DESC, agent_name, metrics_used LIMIT 30""",
    "escalation_analysis": f"""
SELECT agent_name, escalation_reason, count(*) AS escalation_count,
       {rounded(_CENT.format("sum(confidence_score)"), "count(confidence_score) * 100", 3)} AS avg_confidence,
       string_agg(DISTINCT left(user_question, 80), ' | ' ORDER BY left(user_question, 80)) AS sample_questions
FROM escalations WHERE created_at >= {_MONTH} GROUP BY 1, 2 ORDER BY escalation_count DESC, agent_name, escalation_reason LIMIT 20""",
    "test_inventory": """
SELECT agent_name, test_category, expected_behavior, count(*) AS test_count FROM answer_tests WHERE is_active GROUP BY 1, 2, 3""",
    "test_inventory_governance": """
SELECT agent_name, test_category, expected_behavior, count(*) AS total_tests FROM answer_tests GROUP BY 1, 2, 3""",
    "test_run_status": """
SELECT agent_name, test_category, count(*) AS test_count, count(*) FILTER (WHERE last_result = 'PASS') AS passed,
       count(*) FILTER (WHERE last_result = 'FAIL') AS failed, count(*) FILTER (WHERE last_result IS NULL) AS not_yet_run
FROM answer_tests WHERE is_active GROUP BY 1, 2""",
    "bind_questions": f"""
WITH rules(agent, phrase, metric, v) AS (VALUES {_RULES}),
     limits(agent, phrase, behavior, kind) AS (VALUES {_LIMITS}),
     w AS (SELECT *, ' ' || regexp_replace(lower(question), '[^a-z0-9]+', ' ', 'g') || ' ' AS words FROM questions),
     hits AS (SELECT w.question_id, r.phrase, r.metric, r.v,
                     row_number() OVER (PARTITION BY w.question_id ORDER BY length(r.phrase) DESC, r.phrase DESC) AS k
              FROM w JOIN rules r ON r.agent = w.agent_name AND contains(w.words, ' ' || r.phrase || ' ')),
     best AS (SELECT question_id, any_value(phrase) FILTER (k = 1) AS phrase, any_value(metric) FILTER (k = 1) AS metric,
                     any_value(v) FILTER (k = 1) AS v, count(DISTINCT v) AS views FROM hits GROUP BY 1),
     stops AS (SELECT w.question_id, l.phrase, l.behavior, l.kind,
                      row_number() OVER (PARTITION BY w.question_id ORDER BY length(l.phrase) DESC, l.phrase DESC) AS k
               FROM w JOIN limits l ON l.agent = w.agent_name AND contains(w.words, ' ' || l.phrase || ' '))
SELECT w.question_id, w.agent_name, w.question, CAST(w.confidence AS DOUBLE) AS confidence,
       CASE WHEN s.phrase IS NULL THEN b.metric END AS resolved_metric, CASE WHEN s.phrase IS NULL THEN b.v END AS resolved_view,
       coalesce(s.phrase, b.phrase) AS matched_phrase, s.kind AS boundary_type,
       CASE WHEN s.phrase IS NOT NULL THEN s.behavior WHEN b.phrase IS NULL THEN 'ESCALATE'
            WHEN w.confidence < 0.8 THEN 'CLARIFY' WHEN b.views > 1 THEN 'MULTI_VIEW_ANSWER' ELSE 'ANSWER' END AS behavior
FROM w LEFT JOIN best b ON w.question_id = b.question_id LEFT JOIN stops s ON w.question_id = s.question_id AND s.k = 1""",
    "audit_access_own_role": f"SELECT {_LOG_COLUMNS} FROM answer_log WHERE user_role = 'ANALYST'",
    "audit_access_auditor": f"SELECT {_LOG_COLUMNS} FROM answer_log",
    "region_access": """
SELECT customer_id, region, segment FROM dim_customer
WHERE region IN (SELECT allowed_region FROM user_region_mapping WHERE user_name = 'manager_3') OR region = 'ALL'""",
}
_DECLARED = _values([(m.name, x.name) for m in models.MODELS.values() for x in m.metrics])
ORACLE["bound_targets"] = f"""
SELECT resolved_view, resolved_metric, count(*) AS questions,
       (resolved_view, resolved_metric) IN (SELECT (m, x) FROM (VALUES {_DECLARED}) k(m, x)) AS declared
FROM ({ORACLE["bind_questions"]}) WHERE resolved_metric IS NOT NULL GROUP BY 1, 2"""
ORACLE = {name: oracle(sql) for name, sql in ORACLE.items()}
