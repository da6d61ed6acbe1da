"""Semantic models: tables, relationships, dimensions and metrics declared once, queried by name.

``SemanticModel.query`` composes plain DataFrame operations. The fact table is aggregated to
the requested dimensions and the join keys before it meets any dimension table, so the joins
see one row per key combination, whatever the skew of the facts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D


@dataclass(frozen=True)
class Relationship:
    """Many fact rows refer to one dimension row."""

    table: str
    fact_column: str
    column: str


@dataclass(frozen=True)
class Dimension:
    name: str
    column: str
    table: str | None = None  # None: a column of the fact table


@dataclass(frozen=True)
class Metric:
    """``sum``, ``count``, ``count_distinct`` or ``avg`` of an expression over the fact table, or the
    ``ratio`` of two other metrics. ``where`` limits the rows that count."""

    name: str
    agg: str
    expr: str = "1"
    where: str | None = None
    numerator: str | None = None
    denominator: str | None = None
    description: str = ""


@dataclass(frozen=True)
class TimeDimension:
    column: str
    grains: tuple[str, ...] = ("day", "week", "month", "quarter", "year")


@dataclass(frozen=True)
class SemanticModel:
    name: str
    fact: str
    metrics: tuple[Metric, ...]
    dimensions: tuple[Dimension, ...] = ()
    relationships: tuple[Relationship, ...] = ()
    time: TimeDimension | None = None

    def metric(self, name: str) -> Metric:
        for m in self.metrics:
            if m.name == name:
                return m
        raise ValueError(f"{self.name} has no metric {name!r}: undefined metrics are never computed")

    def dimension(self, name: str) -> Dimension:
        for d in self.dimensions:
            if d.name == name:
                return d
        raise ValueError(f"{self.name} has no dimension {name!r}")

    def _relationship(self, table: str) -> Relationship:
        for r in self.relationships:
            if r.table == table:
                return r
        raise ValueError(f"{self.name} declares no relationship to {table!r}")

    def query(
        self,
        frames: Mapping[str, DataFrame],
        metrics: Sequence[str],
        dimensions: Sequence[str] = (),
        grain: str | None = None,
        fiscal: bool = False,
        fact_filter: Column | None = None,
        dimension_filter: Column | None = None,
    ) -> DataFrame:
        """Requested metrics by the requested dimensions and, with a grain, by period.

        ``fact_filter`` runs on the fact table, ``dimension_filter`` on the joined dimensions.
        """
        wanted = [self.metric(m) for m in metrics]
        parts = {p.name: p for m in wanted for p in self._parts(m)}
        dims = [self.dimension(d) for d in dimensions]

        facts = frames[self.fact]
        if fact_filter is not None:
            facts = facts.filter(fact_filter)
        keys: dict[str, Column] = {f"_d_{d.name}": F.col(d.column) for d in dims if d.table is None}
        if grain is not None:
            if self.time is None or grain not in self.time.grains:
                raise ValueError(f"{self.name} cannot be grouped by {grain}")
            keys["_period"] = D.trunc_date(F.col(self.time.column), grain, fiscal)
        joined = {d.table: self._relationship(d.table) for d in dims if d.table is not None}
        for rel in joined.values():
            keys[f"_k_{rel.fact_column}"] = F.col(rel.fact_column)
        counted = {p.name: p for p in parts.values() if p.agg == "count_distinct"}
        # A distinct count of the only join key: after the first aggregation each key is one row of
        # its group, so a plain count suffices and saves a shuffle.
        plain = {
            name
            for name, p in counted.items()
            if p.where is None and len(counted) == 1 and [rel.fact_column for rel in joined.values()] == [p.expr]
        }
        distinct = {f"_x_{name}": _value(p) for name, p in counted.items() if name not in plain}
        partials = [a for p in parts.values() if p.agg != "count_distinct" for a in _partial(p)]

        if partials:
            cells = facts.groupBy(*[c.alias(n) for n, c in {**keys, **distinct}.items()]).agg(*partials)
        else:
            cells = facts.select(*[c.alias(n) for n, c in {**keys, **distinct}.items()]).distinct()
        for table, rel in joined.items():
            columns = [F.col(d.column).alias(f"_d_{d.name}") for d in dims if d.table == table]
            side = frames[table].select(F.col(rel.column).alias(f"_k_{rel.fact_column}"), *columns)
            # A fact without its dimension row keeps counting, under a null label.
            cells = cells.join(side, f"_k_{rel.fact_column}", "left")
        if dimension_filter is not None:
            cells = cells.select("*", *[F.col(f"_d_{d.name}").alias(d.name) for d in dims]).filter(dimension_filter)

        group = [F.col(f"_d_{d.name}").alias(d.name) for d in dims]
        if grain is not None:
            group.append(F.col("_period").alias(f"period_{grain}"))
        finals = [
            (F.count(f"_k_{p.expr}") if name in plain else _final(p)).alias(f"_m_{name}") for name, p in parts.items()
        ]
        out = cells.groupBy(*group).agg(*finals)
        labels = [d.name for d in dims] + ([f"period_{grain}"] if grain else [])
        return out.select(*labels, *[_result(m).alias(m.name) for m in wanted])

    def _parts(self, metric: Metric) -> list[Metric]:
        if metric.agg == "ratio":
            return [p for name in (metric.numerator, metric.denominator) for p in self._parts(self.metric(name))]
        return [metric]


def _value(m: Metric) -> Column:
    value = F.expr(m.expr)
    return value if m.where is None else F.when(F.expr(m.where), value)


def _partial(m: Metric) -> list[Column]:
    value = _value(m)
    if m.agg == "sum":
        if m.where is not None:
            value = F.when(F.expr(m.where), F.expr(m.expr)).otherwise(F.lit(0))
        return [F.sum(value).alias(f"_p_{m.name}")]
    if m.agg == "count":
        return [F.count(value).alias(f"_p_{m.name}")]
    if m.agg == "avg":
        return [F.sum(value).alias(f"_p_{m.name}"), F.count(value).alias(f"_n_{m.name}")]
    raise ValueError(f"unknown aggregate {m.agg!r}")


def _final(m: Metric) -> Column:
    if m.agg == "count_distinct":
        return F.count_distinct(f"_x_{m.name}")
    if m.agg == "avg":
        return F.sum(f"_p_{m.name}").cast("double") / F.nullif(F.sum(f"_n_{m.name}").cast("double"), F.lit(0.0))
    return F.sum(f"_p_{m.name}")


def _result(m: Metric) -> Column:
    if m.agg == "ratio":
        bottom = F.col(f"_m_{m.denominator}").cast("double")
        return F.col(f"_m_{m.numerator}").cast("double") / F.nullif(bottom, F.lit(0.0))
    return F.col(f"_m_{m.name}")


def multi_domain_query(
    parts: Sequence[tuple[SemanticModel, Mapping[str, DataFrame], Sequence[str]]], dimensions: Sequence[str]
) -> DataFrame:
    """Metrics of several models side by side on shared dimensions.

    Each model is aggregated to the shared dimensions first; the join is one row to one row, so no
    model's rows multiply another's.
    """
    frames = [model.query(tables, metrics, dimensions) for model, tables, metrics in parts]
    return reduce(lambda a, b: a.join(b, list(dimensions), "full_outer"), frames)


def pass_through(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A governed view over a base table: same rows, declared columns."""
    return df.select(*(columns or ["*"]))
