"""Alert conditions that are stored as text: checked against what they may name, then run together."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from datetime import datetime
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates as D
from ..sources.seeds import literal_frame

# --- Fixed values: what a condition may name besides the columns of its relation and as_of
KEYWORDS = "and or not in is null true false between like case when then else end interval day days hour hours minute minutes distinct filter where".split()
FUNCTIONS = "count count_if sum avg min max any every bool_or bool_and abs round coalesce nullif lower upper length trim date_trunc to_date".split()

MAX_RULES = 1000
_ANSWER = [("rule_name", pa.string()), ("condition_met", pa.bool_()), ("refused", pa.string())]

_QUOTED = r"'(?:[^'\\]|\\.|'')*'"
_MARK = "\u00a7"
_WORD = r"[A-Za-z_][A-Za-z0-9_]*"
_CALL = rf"({_WORD})\s*\("


def refusals(rules: DataFrame, relations: Mapping[str, DataFrame]) -> DataFrame:
    """Each rule with ``refused``: why its text may not run, null if it may.

    A rule names its ``relation``, a ``row_filter`` (null: all rows) and a ``condition`` over the aggregates of those rows.
    Outside quoted strings a text may hold only names of the relation's columns, ``as_of``, the listed keywords and the
    listed functions, which alone may be called (``in``, ``and``, ``or``, ``not``, ``when`` and ``where`` may precede a
    bracket). So there is no subquery, no other table, no other function, no comment and
    no quoted identifier; a letter right before a quote (a raw or binary literal) is refused too.
    """
    columns = F.create_map(
        *[x for name, df in relations.items() for x in (F.lit(name), F.array(*[F.lit(c.lower()) for c in [*df.columns, "as_of"]]))]
    )
    own = F.try_element_at(columns, F.col("relation"))
    bare = F.regexp_replace(F.lower(F.concat_ws(" ; ", F.coalesce("row_filter", F.lit("true")), "condition")), _QUOTED, _MARK)
    allowed = F.concat(F.array(*[F.lit(w) for w in KEYWORDS + FUNCTIONS]), own)
    callable_ = F.array(*[F.lit(w) for w in [*FUNCTIONS, "in", "and", "or", "not", "when", "where", "filter"]])
    words = F.regexp_extract_all("_bare", F.lit(rf"({_WORD})"), 1)
    calls = F.regexp_extract_all("_bare", F.lit(_CALL), 1)
    unknown, uncalled = F.array_sort(F.array_except(words, allowed)), F.array_sort(F.array_except(calls, callable_))
    both = F.array_sort(F.array_union(unknown, uncalled))
    reason = (
        F.when(F.col("condition").isNull(), "no condition")
        .when(own.isNull(), F.concat(F.lit("relation "), F.coalesce("relation", F.lit("null")), F.lit(" is not offered")))
        .when(F.col("_bare").rlike(rf"['\"`$\\{{}}\[\]:]|[a-z0-9_]{_MARK}|--|/\*|;.*;"), "quotes, comments, parameters or statements")
        .when(F.size(both) > 0, F.concat(F.lit("may not name "), F.array_join(both, ", ")))
    )
    return rules.withColumn("_bare", bare).withColumn("refused", reason).drop("_bare")


def _condition(df: DataFrame, text: str) -> Column | str:
    """The aggregate as a column, or why Spark's analysis of it fails."""
    try:
        kind = df.agg(F.expr(text).alias("v")).schema["v"].dataType
    except (AnalysisException, ParseException) as error:
        return f"not valid: {error.getCondition()}"
    return F.expr(text) if isinstance(kind, T.BooleanType) else f"not a truth value: {kind.simpleString()}"


def stored_conditions(rules: DataFrame, relations: Mapping[str, DataFrame], as_of: datetime, max_rules: int = MAX_RULES) -> DataFrame:
    """Whether the stored condition of each rule holds: ``rule_name``, ``condition_met``, ``refused``.

    Texts that pass the check become part of one plan: rules with the same relation and row filter share one aggregate, whose
    filter reaches the scan; each answers in a row of its own. ``as_of`` stands for the time of evaluation. A condition that is
    null, and every refused one, is not met; the refused say why. Rules are configuration, not data: their texts come to the
    driver, since they become the plan, and more than ``max_rules`` are an error. Of rules with one name, each has its row.
    """
    checked = refusals(rules, relations).select("rule_name", "relation", "row_filter", "condition", "refused").limit(max_rules + 1).collect()
    if len(checked) > max_rules:
        raise ValueError(f"more than max_rules = {max_rules} rules")
    answers, groups = [], defaultdict(list)
    for rule in checked:
        if rule.refused is None:
            groups[rule.relation, rule.row_filter].append(rule)
        else:
            answers.append((rule.rule_name, False, rule.refused))
    frames = []
    for (relation, row_filter), members in groups.items():
        source = relations[relation].withColumn("as_of", D.lit_ts(as_of))
        try:
            source = source.filter(F.expr(row_filter)) if row_filter is not None else source
        except (AnalysisException, ParseException) as error:
            answers += [(m.rule_name, False, f"not valid: {error.getCondition()}") for m in members]
            continue
        entries, sums = [], []
        for m in members:
            column = _condition(source, m.condition)
            if isinstance(column, str):
                answers.append((m.rule_name, False, column))
                continue
            sums.append(column.alias(f"c{len(sums)}"))
            met = F.coalesce(F.col(f"c{len(sums) - 1}"), F.lit(False))
            entries.append(F.struct(F.lit(m.rule_name).alias("rule_name"), met.alias("condition_met"), F.lit(None).cast("string").alias("refused")))
        if entries:
            frames.append(source.agg(*sums).select(F.inline(F.array(*entries))))
    frames.append(literal_frame(rules.sparkSession, _ANSWER, answers))
    return reduce(DataFrame.unionByName, frames)
