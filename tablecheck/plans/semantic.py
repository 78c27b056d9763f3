"""Measures over marts and the metrics that combine them.

A query aggregates every mart it needs once, at the requested grain, with all
measures of that mart in the same group-by. Ratios, derived values, offsets,
running totals and cross-mart combinations work on those small results.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_column
from ..functions.predicates import expr_true
from ..operators.aggregates import count_distinct, exact_median
from ..operators.joins import combine_metrics, offset_join, on_own_days, on_spine
from ..operators.windows import cumulative, growth_pct
from ..sources.tables import TABLE, materialize

METRIC_TIME = "metric_time"


@dataclass(frozen=True)
class Measure:
    """An aggregate of a SQL expression: sum, average, count_distinct or median.

    ``approx`` allows a sketch for count_distinct and median.
    """

    name: str
    agg: str = "sum"
    expr: str | None = None
    approx: bool = False

    @property
    def source(self) -> str:
        return self.expr or self.name


@dataclass(frozen=True, eq=False)
class SemanticModel:
    """A mart with its time dimension, named keys and measures.

    The mart may be given as a function, which is called when it is queried.
    """

    name: str
    frame: DataFrame | Callable[[], DataFrame]
    measures: tuple[Measure, ...]
    time: str | None = None
    keys: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True, eq=False)
class Shared:
    """A frame that can stand in for several models at once.

    ``measures`` gives the SQL expression whose sum is a measure's sum there;
    ``time`` and ``keys`` are groups that mean the same in all those models.
    """

    frame: DataFrame | Callable[[], DataFrame]
    measures: dict[str, str]
    time: str | None = None
    keys: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Simple:
    """A measure, over the rows that meet ``where``."""

    name: str
    measure: str
    where: str | None = None


@dataclass(frozen=True)
class Ratio:
    name: str
    numerator: str
    denominator: str


@dataclass(frozen=True)
class Input:
    """A metric used by a derived one, optionally taken ``offset_months`` earlier."""

    metric: str
    offset_months: int = 0


@dataclass(frozen=True)
class Derived:
    """A SQL expression over other metrics, named by the keys of ``inputs``."""

    name: str
    expr: str
    inputs: dict[str, Input]


@dataclass(frozen=True)
class Growth:
    """Percentage change of a metric against ``offset_months`` earlier."""

    name: str
    metric: str
    offset_months: int = 1


@dataclass(frozen=True)
class Cumulative:
    """All-time running total of a simple metric."""

    name: str
    metric: str


@dataclass(frozen=True)
class TimeDimension:
    """Group by the mart's time at a grain: day, week, month, quarter or year."""

    grain: str = "day"


@dataclass(frozen=True)
class Key:
    """Group by an entity or another named column of the mart."""

    name: str


def _aggregate(measure: Measure, where: str | None) -> Column:
    value = F.expr(measure.source)
    if where is not None:
        value = F.when(expr_true(where), value)
    if measure.agg == "sum":
        return F.sum(value)
    if measure.agg == "average":
        return F.avg(value)
    if measure.agg == "count_distinct":
        return count_distinct(value, measure.approx)
    if measure.agg == "median":
        return F.percentile_approx(value, 0.5)
    raise ValueError(f"unknown aggregate: {measure.agg}")


class MetricCatalog:
    """Semantic models and metric definitions that can be queried by name."""

    def __init__(self, models: list[SemanticModel], metrics: list, shared: list[Shared] | None = None):
        self.models, self.shared = models, shared or []
        self.metrics = {m.name: m for m in metrics}
        self.home = {measure.name: (model, measure) for model in models for measure in model.measures}

    def extended(self, metrics: list) -> MetricCatalog:
        """The same models with further metrics."""
        return MetricCatalog(self.models, [*self.metrics.values(), *metrics], self.shared)

    def _parts(self, name: str) -> list[str]:
        """Metrics a metric is directly made of; none for a simple one."""
        metric = self.metrics[name]
        if isinstance(metric, Simple):
            return []
        if isinstance(metric, Ratio):
            return [metric.numerator, metric.denominator]
        if isinstance(metric, Derived):
            return [i.metric for i in metric.inputs.values()]
        return [metric.metric]

    def _leaves(self, name: str) -> set[str]:
        """Simple metrics a metric is made of."""
        parts = self._parts(name)
        return set().union(*[self._leaves(p) for p in parts]) if parts else {name}

    def _totals(self, name: str) -> set[str]:
        """Running totals of simple metrics that a metric is or is made of."""
        parts = self._parts(name)
        own = {name} if isinstance(self.metrics[name], Cumulative) and not self._parts(parts[0]) else set()
        return own.union(*[self._totals(p) for p in parts])

    @staticmethod
    def _group(model: SemanticModel, group_by: list) -> list[Column]:
        cols = []
        for g in group_by:
            if isinstance(g, TimeDimension):
                cols.append(F.to_date(F.date_trunc(g.grain, as_column(model.time))).alias(METRIC_TIME))
            else:
                cols.append(F.expr(model.keys[g.name]).alias(g.name))
        return cols

    def _model_frame(self, model: SemanticModel, leaves: list[Simple], group_by: list, names: list[str]) -> DataFrame:
        mart = model.frame() if callable(model.frame) else model.frame
        group = self._group(model, group_by)
        exact, aggs = [], []
        for leaf in leaves:
            measure = self.home[leaf.measure][1]
            if measure.agg == "median" and not measure.approx:
                exact.append((leaf, measure))
            else:
                aggs.append(_aggregate(measure, leaf.where).alias(leaf.name))
        frame = mart.groupBy(*group).agg(*aggs) if aggs else None
        for leaf, measure in exact:
            rows = mart if leaf.where is None else mart.filter(leaf.where)
            values = rows.select(*group, F.expr(measure.source).alias("__value"))
            part = exact_median(values, names, "__value", leaf.name)
            frame = part if frame is None else combine_metrics(frame, part, names)
        return frame

    def _shared_frame(self, by_model: dict, group_by: list) -> DataFrame | None:
        """All measures from one frame, where the query spans models and some shared frame has everything it asks for."""
        leaves = [leaf for _, own in by_model.values() for leaf in own]
        for one in self.shared if len(by_model) > 1 else []:
            summed = all(leaf.where is None and self.home[leaf.measure][1].agg == "sum" for leaf in leaves)
            if not summed or not {leaf.measure for leaf in leaves} <= set(one.measures):
                continue
            if all(one.time is not None if isinstance(g, TimeDimension) else g.name in one.keys for g in group_by):
                facts = one.frame() if callable(one.frame) else one.frame
                sums = [F.sum(F.expr(one.measures[leaf.measure])).alias(leaf.name) for leaf in leaves]
                return facts.groupBy(*self._group(one, group_by)).agg(*sums)
        return None

    def query_metrics(
        self, metrics: list[str], group_by: list | None = None, spine: DataFrame | None = None, fill: bool = False
    ) -> DataFrame:
        """The metrics at the requested grain: group columns, then one column each.

        ``spine`` (see :func:`~tablecheck.operators.spine.date_spine`) gives one
        row for each of its days, with or without measurements, before running
        totals and offsets are taken. It needs the day as the only group; days
        outside the spine have no row then. ``fill`` does the same without a
        spine: every combination of the other groups gets all days from its first
        to its last. Running totals of simple metrics are taken on the measured
        days and carried to the days between.
        """
        group_by = group_by or []
        names = [METRIC_TIME if isinstance(g, TimeDimension) else g.name for g in group_by]
        if spine is not None and group_by != [TimeDimension("day")]:
            raise ValueError("a spine needs the day as the only group")
        if fill and TimeDimension("day") not in group_by:
            raise ValueError("filling needs the day as a group")
        by_model: dict[str, tuple[SemanticModel, list[Simple]]] = {}
        for leaf in sorted(set().union(*[self._leaves(n) for n in metrics])):
            simple = self.metrics[leaf]
            model = self.home[simple.measure][0]
            by_model.setdefault(model.name, (model, []))[1].append(simple)
        frame = self._shared_frame(by_model, group_by)
        for model, leaves in by_model.values() if frame is None else []:
            part = self._model_frame(model, leaves, group_by, names)
            frame = part if frame is None else combine_metrics(frame, part, names)
        if spine is not None:
            frame = on_spine(frame, spine, METRIC_TIME)
        if fill:
            frame = frame.filter(F.col(METRIC_TIME).isNotNull())
            totals = sorted(set().union(*[self._totals(n) for n in metrics]))
            for n in totals:
                frame = self._add(frame, n, names)
            frame = on_own_days(frame, METRIC_TIME, [n for n in names if n != METRIC_TIME], totals)
        for n in metrics:
            frame = self._add(frame, n, names)
        return frame.select(*[as_column(c) for c in [*names, *metrics]])

    def _add(self, frame: DataFrame, name: str, names: list[str]) -> DataFrame:
        if name in frame.columns:
            return frame
        metric = self.metrics[name]
        others = [n for n in names if n != METRIC_TIME]
        if isinstance(metric, Ratio):
            for part in (metric.numerator, metric.denominator):
                frame = self._add(frame, part, names)
            # In double, because a quotient of wide decimals keeps only six decimals.
            top, bottom = as_column(metric.numerator).cast("double"), as_column(metric.denominator).cast("double")
            return frame.withColumn(name, F.try_divide(top, bottom))
        if isinstance(metric, Cumulative):
            frame = self._add(frame, metric.metric, names)
            if METRIC_TIME not in names:
                # Without a time axis the all-time total is the metric itself.
                return frame.withColumn(name, as_column(metric.metric))
            return cumulative(frame, METRIC_TIME, metric.metric, name, others)
        if isinstance(metric, Growth):
            frame = self._add(frame, metric.metric, names)
            prev = f"__prev_{name}"
            frame = self._offset(frame, metric.metric, prev, metric.offset_months, names)
            return frame.withColumn(name, growth_pct(metric.metric, prev)).drop(prev)
        sources = {}
        for i, (alias, source) in enumerate(metric.inputs.items()):
            frame = self._add(frame, source.metric, names)
            sources[alias] = source.metric
            if source.offset_months:
                sources[alias] = f"__{name}_{i}"
                frame = self._offset(frame, source.metric, sources[alias], source.offset_months, names)
        # The expression sees only its inputs, so an alias may equal another metric's name.
        kept = {f"__k{i}": c for i, c in enumerate(frame.columns)}
        inputs = [as_column(c).alias(alias) for alias, c in sources.items()]
        scope = frame.select(*[as_column(c).alias(k) for k, c in kept.items()], *inputs)
        return scope.select(*[F.col(k).alias(c) for k, c in kept.items()], F.expr(metric.expr).alias(name))

    @staticmethod
    def _offset(frame: DataFrame, metric: str, out: str, months: int, names: list[str]) -> DataFrame:
        if METRIC_TIME not in names:
            raise ValueError(f"{metric} with an offset needs a time dimension")
        return offset_join(frame, METRIC_TIME, metric, out, months, [n for n in names if n != METRIC_TIME])

    def saved_query(
        self, name: str, metrics: list[str], group_by: list, path: str | None = None, table: str | None = None
    ) -> DataFrame:
        """Run a query and export it as a table, named like the query unless ``table`` is given."""
        return materialize(self.query_metrics(metrics, group_by), table or name, TABLE, path)


# From here on, metric, measure, key and saved query names, and the conditions of filtered metrics.

Mart = DataFrame | Callable[[], DataFrame]


def shop_metrics(order_items: Mart, orders: Mart, customers: Mart, locations: Mart, facts: Mart | None = None) -> MetricCatalog:
    """The semantic layer of the shop marts.

    With ``facts`` (see :func:`~tablecheck.plans.marts.order_facts`) sums of items
    and of orders that are asked for together come from one grouping of the items.
    """
    models = [
        SemanticModel(
            "order_item",
            order_items,
            (
                Measure("revenue", expr="product_price"),
                Measure("food_revenue", expr="if(is_food_item, product_price, 0)"),
                Measure("drink_revenue", expr="if(is_drink_item, product_price, 0)"),
                Measure("median_revenue", "median", "product_price"),
            ),
            "ordered_at",
            {"order_item": "order_item_id", "order_id": "order_id", "product": "product_id",
             "is_food_item": "is_food_item", "is_drink_item": "is_drink_item"},
        ),
        SemanticModel(
            "orders",
            orders,
            (Measure("order_total"), Measure("order_count", expr="1"), Measure("tax_paid"), Measure("order_cost")),
            "ordered_at",
            {"order_id": "order_id", "location": "location_id", "customer": "customer_id",
             "order_total_dim": "order_total", "is_food_order": "is_food_order", "is_drink_order": "is_drink_order",
             "customer_order_number": "customer_order_number"},
        ),
        SemanticModel(
            "customers",
            customers,
            (
                Measure("customers", "count_distinct", "customer_id"),
                Measure("count_lifetime_orders"),
                Measure("lifetime_spend_pretax"),
                Measure("lifetime_spend"),
            ),
            "first_ordered_at",
            {"customer": "customer_id", "customer_name": "customer_name", "customer_type": "customer_type"},
        ),
        SemanticModel(
            "locations",
            locations,
            (Measure("average_tax_rate", "average", "tax_rate"),),
            "opened_date",
            {"location": "location_id", "location_name": "location_name"},
        ),
    ]
    same_name = [
        "revenue", "food_revenue", "drink_revenue", "median_revenue", "order_cost", "order_total", "tax_paid",
        "customers", "count_lifetime_orders", "lifetime_spend_pretax", "lifetime_spend", "average_tax_rate",
    ]
    metrics = [
        *[Simple(n, n) for n in same_name],
        Simple("orders", "order_count"),
        Simple("new_customer_orders", "order_count", "customer_order_number = 1"),
        Simple("large_orders", "order_count", "order_total >= 20"),
        Simple("food_orders", "order_count", "is_food_order"),
        Simple("drink_orders", "order_count", "is_drink_order"),
        Ratio("food_revenue_pct", "food_revenue", "revenue"),
        Ratio("drink_revenue_pct", "drink_revenue", "revenue"),
        Derived(
            "average_order_value",
            "try_divide(double(spend), orders)",
            {"spend": Input("lifetime_spend_pretax"), "orders": Input("count_lifetime_orders")},
        ),
        Derived("order_gross_profit", "revenue - cost", {"revenue": Input("revenue"), "cost": Input("order_cost")}),
        Growth("revenue_growth_mom", "revenue"),
        Cumulative("cumulative_revenue", "revenue"),
    ]
    of_orders = {"order_total": "order_total", "tax_paid": "tax_paid", "order_cost": "order_cost"}
    of_items = {"revenue": "item_revenue", "food_revenue": "item_food_revenue", "drink_revenue": "item_drink_revenue"}
    shared = [] if facts is None else [Shared(facts, of_items | of_orders, "ordered_at", {"order_id": "order_id"})]
    return MetricCatalog(models, metrics, shared)


# Metrics of the exported queries, and what each is grouped by.
SAVED_QUERIES = {
    "customer_order_metrics": (
        ["count_lifetime_orders", "lifetime_spend_pretax", "average_order_value"], [Key("customer")],
    ),
    "revenue_metrics": (["revenue", "food_revenue", "drink_revenue"], [TimeDimension("day")]),
    "order_metrics": (
        ["orders", "new_customer_orders", "order_total", "food_orders", "drink_orders"], [TimeDimension("day")],
    ),
}
