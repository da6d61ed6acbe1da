"""The daily governance cycle: the lifecycle rules in their fixed order, over immutable tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..context import cut_lineage
from ..functions import dates as D
from ..operators import control, lifecycle
from ..sources import changes

CATALOG = "governance.operating_model.metric_catalog"


@dataclass(frozen=True)
class DailyState:
    catalog: DataFrame
    domains: DataFrame
    alerts: DataFrame


def governance_daily(
    cat: DataFrame,
    dom: DataFrame,
    history: DataFrame,
    incidents: DataFrame,
    log: DataFrame,
    rules: DataFrame,
    as_of: datetime,
    catalog_changed: bool = True,
) -> DailyState:
    """Usage, recertification, expiry; then zombie tags and, on Mondays, deprecation on one branch, and
    domain maturity and alerts on the other.

    The decertified catalog feeds both branches, so it is checkpointed once: the query history is
    scanned once, and a lost executor does not repeat it. Zombies are tagged if the catalog has
    changed since the last run or it is Monday.
    """
    refreshed = lifecycle.refresh_usage_stats(cat, history, as_of)
    recertified = lifecycle.auto_recertify(refreshed, incidents, as_of)
    decertified = cut_lineage(lifecycle.auto_decertify_expired(recertified, as_of))
    monday = D.is_monday(as_of)
    catalog = decertified
    if catalog_changed or monday:
        catalog = lifecycle.flag_zombies(catalog, as_of)
    if monday:
        catalog = lifecycle.auto_deprecate_unused(catalog, as_of)
    domains = lifecycle.recalculate_domain_maturity(dom, decertified)
    conditions = control.alert_conditions(decertified, domains, incidents, log, as_of)
    return DailyState(catalog, domains, control.evaluate_alerts(rules, conditions, as_of))


def governance_daily_published(
    spark: SparkSession, root: str, dom: DataFrame, history: DataFrame, incidents: DataFrame, log: DataFrame, rules: DataFrame, as_of: datetime
) -> DailyState:
    """The cycle over the published catalog: it finds out by itself whether the catalog has changed since the version that its
    last run left, publishes the catalog after the rules, and remembers that version as its own."""
    consumer = changes.Consumer(spark, root, CATALOG, "governance_daily")
    version = changes.newest_version(spark, root, CATALOG)
    catalog = changes.read_version(spark, root, CATALOG, version)
    state = governance_daily(catalog, dom, history, incidents, log, rules, as_of, catalog_changed=consumer.has_data())
    changes.publish_version(state.catalog, root, CATALOG, version + 1, ["metric_fqn"])
    consumer.advance(version + 1)
    return state
