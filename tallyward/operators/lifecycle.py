"""Metric lifecycle as set-based transforms: a catalog goes in, the catalog after the rule comes out."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates as D
from ..functions import measures as M


def update_where(df: DataFrame, condition: Column, values: dict[str, Column], only_changed: bool = False) -> DataFrame:
    """Rows that meet the condition take the new values; a NULL condition leaves the row alone.

    ``only_changed`` gives the delta instead: the rows that took a value other than the one they had, repeated rows as often as
    they occur. It needs no comparison of the whole tables, so nothing is shuffled.
    """
    flagged = df.withColumn("_hit", F.coalesce(condition, F.lit(False)))

    def typed(name: str, value: Column) -> Column:
        kind = df.schema[name].dataType
        value = value if isinstance(kind, T.ArrayType) else value.cast(kind)
        return F.when(F.col("_hit"), value).otherwise(F.col(name))

    new = {name: typed(name, value) for name, value in values.items()}
    if only_changed:
        differs = reduce(or_, [~F.col(name).eqNullSafe(value) for name, value in new.items()])
        flagged = flagged.filter(F.col("_hit") & differs)
    return flagged.withColumns(new).drop("_hit")


def changed(before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows of ``after`` that ``before`` does not hold, repeated rows as often as they are new. For tables of any origin: it compares
    whole rows, which shuffles both. An update knows its own delta (``only_changed``)."""
    return after.select(*before.columns).exceptAll(before)


def _windows(texts: DataFrame, names: DataFrame) -> DataFrame:
    """Pairs (text, name) of one kind (``whole``) where the name occurs anywhere inside the text.

    A substring test has no join key, and pairing every text with every name would be a cross
    join. Every name is as long as one of the distinct name lengths, so each text lists its
    substrings of just those lengths and an equality join finds the names among them.
    """
    lengths = names.agg(F.collect_set(F.struct("whole", F.length("name").alias("size")))).scalar()
    return (
        texts.select("text", F.col("whole").alias("_whole"), F.inline(lengths))
        .filter((F.col("_whole") == F.col("whole")) & (F.col("size") <= F.length("text")))
        .select("text", "whole", "size", F.explode(F.sequence(F.lit(1), F.length("text") - F.col("size") + 1)).alias("_at"))
        .select("text", "whole", F.substring("text", F.col("_at"), F.col("size")).alias("name"))
        .join(names, ["name", "whole"])
        .select("text", "whole", "name")
        .distinct()
    )


def view_usage(views: DataFrame, history: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    """Successful queries, users and last use of each view over the last days.

    A query uses a view if its text contains the view's name, also inside a longer word. A name
    without blanks lies within one word of the text, so the few distinct words are matched, not the
    texts; the rare name with blanks is matched against the whole text, which takes part only where
    there is such a name. Which of them there are is a subquery: building the query runs no job.
    """
    recent = history.filter(
        (F.col("start_time") >= D.lit_ts(D.shift_days(as_of, -days))) & (F.col("execution_status") == "SUCCESS")
    ).select("query_id", "user_name", "start_time", F.lower("query_text").alias("_query"))
    names = views.select(F.lower("semantic_view_fqn").alias("name")).filter(F.length("name") > 0).distinct()
    names = names.withColumn("whole", F.col("name").rlike("\\s"))
    kinds = names.agg(
        F.struct(
            F.min(F.when(~F.col("whole"), F.length("name"))).alias("shortest"),
            F.coalesce(F.bool_or("whole"), F.lit(False)).alias("blanks"),
        )
    ).scalar()

    # Words shorter than every name cannot contain one: keywords, which every query repeats, never
    # reach a shuffle.
    words = F.filter(F.array_distinct(F.split("_query", "\\s+")), lambda w: F.length(w) >= F.col("_kinds.shortest"))
    pieces = F.concat(
        F.transform(words, lambda w: F.struct(w.alias("text"), F.lit(False).alias("whole"))),
        F.filter(F.array(F.struct(F.col("_query").alias("text"), F.lit(True).alias("whole"))), lambda _: F.col("_kinds.blanks")),
    )
    texts = recent.withColumn("_kinds", kinds).select("query_id", "user_name", "start_time", F.inline(pieces))
    hits = texts.join(_windows(texts.select("text", "whole").distinct(), names), ["text", "whole"])
    return hits.groupBy("name").agg(
        F.count_distinct("query_id").alias("query_count"),
        F.count_distinct("user_name").alias("consumer_count"),
        F.max("start_time").alias("last_queried"),
    )


def refresh_usage_stats(cat: DataFrame, history: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    """Catalog with usage from the query history; metrics of unused views keep their figures."""
    usage = view_usage(cat.select("semantic_view_fqn"), history, as_of, days)
    joined = cat.join(usage, F.lower("semantic_view_fqn") == F.col("name"), "left")
    return update_where(
        joined,
        F.col("name").isNotNull(),
        {
            "query_count_30d": F.col("query_count"),
            "consumer_count_30d": F.col("consumer_count"),
            "last_queried_at": F.col("last_queried"),
            "updated_at": D.lit_ts(as_of),
        },
    ).select(*cat.columns)


def auto_recertify(cat: DataFrame, inc: DataFrame, as_of: date, quality: float = 98.0, queries: int = 100) -> DataFrame:
    """Certified metrics due within a week, of high quality, in use and free of incidents for 90 days
    are certified for another 90 days."""
    day = D.as_date(as_of)
    troubled = (
        inc.filter(F.col("detected_at") >= D.lit_ts(D.shift_days(day, -90)))
        .select(F.explode("affected_metrics").alias("metric_name"))
        .distinct()
        .withColumn("_incident", F.lit(True))
    )
    condition = (
        (F.col("certification_status") == "CERTIFIED")
        & F.col("recertification_due").between(D.lit_date(day), D.lit_date(D.shift_days(day, 7)))
        & (F.col("data_quality_score") >= quality)
        & (F.col("query_count_30d") >= queries)
        & F.col("_incident").isNull()
    )
    return update_where(
        cat.join(troubled, "metric_name", "left"),
        condition,
        {
            "certification_date": D.lit_date(day),
            "recertification_due": D.lit_date(D.shift_days(day, 90)),
            "updated_at": D.lit_ts(as_of),
        },
    ).select(*cat.columns)


def auto_decertify_expired(cat: DataFrame, as_of: date, grace_days: int = 7) -> DataFrame:
    late = F.col("recertification_due") < D.lit_date(D.shift_days(D.as_date(as_of), -grace_days))
    return update_where(
        cat,
        (F.col("certification_status") == "CERTIFIED") & late,
        {"certification_status": F.lit("EXPIRED"), "updated_at": D.lit_ts(as_of)},
    )


def flag_zombies(cat: DataFrame, as_of: date, days: int = 60, only_changed: bool = False) -> DataFrame:
    """Tags certified metrics nobody queries. A metric never queried at all is not flagged."""
    condition = (
        (F.col("certification_status") == "CERTIFIED")
        & (F.col("query_count_30d") == 0)
        & (F.col("last_queried_at") < D.lit_ts(D.shift_days(as_of, -days)))
        & ~M.has_tag(F.col("tags"), "ZOMBIE_CANDIDATE")
    )
    return update_where(
        cat, condition, {"tags": M.tag(F.col("tags"), "ZOMBIE_CANDIDATE"), "updated_at": D.lit_ts(as_of)}, only_changed
    )


def auto_deprecate_unused(cat: DataFrame, as_of: date, days: int = 180) -> DataFrame:
    """Expired and draft metrics idle for 180 days, or never queried, are deprecated and tagged."""
    idle = F.col("last_queried_at").isNull() | (F.col("last_queried_at") < D.lit_ts(D.shift_days(as_of, -days)))
    condition = (
        F.col("certification_status").isin("EXPIRED", "DRAFT")
        & idle
        & (F.col("query_count_30d") == 0)
        & ~M.has_tag(F.col("tags"), "AUTO_DEPRECATED")
    )
    return update_where(
        cat,
        condition,
        {
            "certification_status": F.lit("DEPRECATED"),
            "tags": M.tag(F.col("tags"), "AUTO_DEPRECATED"),
            "updated_at": D.lit_ts(as_of),
        },
    )


def recalculate_domain_maturity(dom: DataFrame, cat: DataFrame) -> DataFrame:
    """Active domains with rate, quality, metric count and maturity from the catalog: one aggregate of
    the catalog and one join. Quality is stored with two decimals, but judged exactly."""
    by_domain = cat.groupBy(F.col("domain").alias("domain_name")).agg(
        F.count(F.lit(1)).alias("_n"),
        M.count_when(F.col("certification_status") == "CERTIFIED").alias("_certified"),
        F.sum("data_quality_score").alias("_quality"),
        F.count("data_quality_score").alias("_rated"),
    )
    joined = dom.join(by_domain, "domain_name", "left").withColumn(
        "_rate", F.coalesce(M.pct(F.col("_certified"), F.col("_n")), F.lit(0))
    )
    rate = F.col("_rate")
    enough = lambda bound: F.coalesce(F.col("_quality") >= F.col("_rated") * bound, F.lit(False))
    maturity = (
        F.when((rate >= 90) & enough(95) & (F.col("agent_count") >= 2), "ENTERPRISE")
        .when((rate >= 80) & enough(90), "SCALE")
        .when(rate >= 60, "GROWTH")
        .otherwise("FOUNDATION")
    )
    return update_where(
        joined,
        F.col("is_active"),
        {
            "certification_rate": rate,
            "avg_data_quality": M.mean(F.col("_quality"), F.col("_rated"), 2),
            "metric_count": F.coalesce(F.col("_n"), F.lit(0)),
            "governance_maturity": maturity,
        },
    ).select(*dom.columns)
