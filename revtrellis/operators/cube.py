"""Quarterly metric cube: many measures of one fact in a single pass.

Every measure is a filter on the metric fact and a way to aggregate it, split in Total /
Marketing / Partner / Sales by lead group. One row of the fact can feed several measures, so it is
expanded to (measure, region) and reduced in two steps: first per opportunity where a measure counts
them, which turns distinct counts into plain sums and spreads a hot group over its opportunities, then per group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtrellis.functions.dates import days_between
from revtrellis.functions.numbers import safe_divide
from revtrellis.params.fixed_values import REVIEW_SEGMENTS

WEEKS = 13
GLOBAL = "GLOBAL"
SPLITS = {"marketing": "Inbound", "partner": "Partner", "sales": "Outbound"}


@dataclass(frozen=True)
class Measure:
    """One block of the review. ``kind`` names the aggregation."""

    name: str
    sort_id: int
    metric_label: str
    kind: str
    datasets: tuple[str, ...]
    metrics: tuple[str, ...]
    value_types: tuple[str, ...] | None = None
    days: tuple[str, str] | None = None
    dataset_label: bool = True

    def applies(self) -> Column:
        cond = F.col("dataset").isin(*self.datasets) & F.col("metric").isin(*self.metrics)
        return cond if self.value_types is None else cond & F.col("value_type").isin(*self.value_types)


_COUNT, _PRODUCT = ("Opportunity Deal Count",), ("Product Deal Count",)
_REVENUE, _MONEY = ("Total Revenue",), ("Total Revenue", "Incremental Product Profit")
_BOTH = ("Actuals", "Targets")

# Measure labels, spelled as the review spells them.
MEASURES = [
    Measure("created_count", 1, "Created Opp Volume", "count_per_week", ("Actuals",), ("Created",), _COUNT),
    Measure("created_target", 1, "Created Opp Volume", "sum_per_week", ("Targets",), ("Created",), _PRODUCT),
    Measure("created_revenue", 1, "Created Opp Volume", "sum_per_week", _BOTH, ("Created",), _REVENUE),
    Measure("qualified_avg", 2, "Qualified Opp Total Revenue Avg ($)", "sum_per_count", _BOTH, ("Qualified SAL",), _MONEY),
    Measure("days_created_qualified", 3, "Created to Qualified (days)", "mean_days", ("Actuals",), ("Pipeline SAL",), _COUNT, ("qualified_date", "created_date"), False),
    Measure("days_qualified_won", 4, "Qualified to Win (days)", "mean_days", ("Actuals",), ("Closed Won",), _COUNT, ("close_date", "qualified_date"), False),
    Measure("days_to_win", 5, "Time to Win (days)", "mean_days", ("Actuals",), ("Closed Won",), _COUNT, ("close_date", "created_date"), False),
    Measure("win_rate", 6, "Win Rate", "won_ratio", ("Actuals",), ("Closed Won", "Closed Lost"), _COUNT, None, False),
    Measure("closed_won", 7, "Closed Won", "sum", _BOTH, ("Closed Won",), _MONEY),
    Measure("closed_won_avg", 8, "Closed Won Avg", "sum_per_count", _BOTH, ("Closed Won",), _MONEY),
    Measure("head_count", 9, "Heat Count Capacity", "capacity", ("Head Count",), ("Head Count Capacity",)),
]

# The outsourced team's blocks differ in one metric name, count profit only, and have no capacity block.
OUTSOURCED_CHANGES = {
    "days_created_qualified": {"metrics": ("Created SAL",)},
    "closed_won": {"value_types": ("Incremental Product Profit",)},
    "closed_won_avg": {"value_types": ("Incremental Product Profit",)},
    "head_count": None,
}


def outsourced_measures(measures: list[Measure] | None = None) -> list[Measure]:
    out = []
    for m in MEASURES if measures is None else measures:
        change = OUTSOURCED_CHANGES.get(m.name, {})
        if change is not None:
            out.append(Measure(**{**m.__dict__, **change}))
    return out


@dataclass(frozen=True)
class Team:
    """Rows of one side of the review, how they are labelled, and whether they also count towards GLOBAL."""

    rows: Column
    segment: Column
    measures: list[Measure]
    with_global: bool


def teams(measures: list[Measure] | None = None, outsourced: str = "%N3%", outsourced_retail: str = "%N3 Retail%", label: str = "N3 Retail") -> list[Team]:
    """In-house segments (a null team is left out, as NOT LIKE does) and the outsourced team. No row is in both."""
    measures = MEASURES if measures is None else measures
    inhouse = F.col("market_segment").isin(*REVIEW_SEGMENTS) & ~F.col("team_segment").like(outsourced)
    renamed = F.replace("market_segment", F.lit("SMB"), F.lit("Cross-Sell"))
    return [
        Team(inhouse, renamed, measures, True),
        Team(F.col("team_segment").like(outsourced_retail), F.lit(label), outsourced_measures(measures), False),
    ]


KEYS = ["measure", "segment", "label", "yr_qtr", "value_type", "sales_region"]


def _coarse_filter(measures: list[Measure]) -> Column:
    """Rows that may feed a measure, as IN lists on plain columns, which a parquet scan can use."""
    cond = F.col("dataset").isin(*sorted({d for m in measures for d in m.datasets})) & F.col("metric").isin(*sorted({x for m in measures for x in m.metrics}))
    if all(m.value_types is not None for m in measures):
        cond = cond & F.col("value_type").isin(*sorted({v for m in measures for v in m.value_types}))
    return cond


def _hits(measures: list[Measure]) -> Column:
    """Names of the measures a row feeds, looked up by the kind of row.

    A constant map keeps the generated code small; a branch per measure would make one method that the JVM
    no longer compiles.
    """
    kinds: dict[str, list[str]] = {}
    for m in measures:
        for dataset in m.datasets:
            for metric in m.metrics:
                for value_type in m.value_types or ("*",):
                    kinds.setdefault(f"{dataset}|{metric}|{value_type}", []).append(m.name)
    table = F.create_map(*[x for kind, names in kinds.items() for x in (F.lit(kind), F.array(*[F.lit(n) for n in names]))])
    of = lambda last: F.try_element_at(table, F.concat_ws("|", "dataset", "metric", last))
    return F.coalesce(of(F.col("value_type")), of(F.lit("*")))


COUNTING_KINDS = ("count_per_week", "sum_per_count", "won_ratio")
MARKS = {name: 1 << i for i, name in enumerate(["total", *SPLITS])}


def _regions(here: Column) -> Column:
    """The row's own region, and GLOBAL where the row counts towards it at this step."""
    return F.when(F.col("to_global") & here, F.array("sales_region", F.lit(GLOBAL))).otherwise(F.array("sales_region"))


def _per_opportunity(fact: DataFrame, sides: list[Team]) -> DataFrame:
    """One row per key, measure and opportunity; ``marks`` holds in which splits it was seen, and won, as bits."""
    sides = [t for t in sides if t.measures]
    hits = segment = spread = None
    for t in sides:
        entries = _hits(t.measures)
        hits = F.when(t.rows, entries) if hits is None else hits.when(t.rows, entries)
        segment = F.when(t.rows, t.segment) if segment is None else segment.when(t.rows, t.segment)
        spread = F.when(t.rows, F.lit(t.with_global)) if spread is None else spread.when(t.rows, F.lit(t.with_global))
    used = [m for t in sides for m in t.measures]
    rows = fact.filter(_coarse_filter(used)).withColumns({"segment": segment, "to_global": spread, "_hits": hits})
    rows = rows.withColumn("measure", F.explode("_hits"))
    plain_label = F.col("measure").isin(*[m.name for m in used if not m.dataset_label])
    counting = F.col("measure").isin(*[m.name for m in used if m.kind in COUNTING_KINDS])
    days = F.lit(None).cast("int")
    for m in {m.name: m for m in used if m.days}.values():
        days = F.when(F.col("measure") == m.name, days_between(*m.days)).otherwise(days)
    rows = rows.withColumn("_counting", counting).select(
        "measure",
        "segment",
        F.when(plain_label, "*").otherwise(F.col("dataset")).alias("label"),
        F.concat(F.col("year").cast("string"), F.lit("-"), F.col("quarter")).alias("yr_qtr"),
        "value_type",
        F.explode(_regions(F.col("_counting"))).alias("sales_region"),
        # Plain sums and means need no opportunity: without it they shrink to few rows before the shuffle.
        F.when(F.col("_counting"), F.col("opportunity_id")).alias("opportunity_id"),
        "lead_group",
        "value",
        days.alias("days"),
        (F.col("metric") == "Closed Won").alias("won"),
        "_counting",
        "to_global",
    )
    groups = {name: F.coalesce(F.col("lead_group") == group, F.lit(False)) for name, group in SPLITS.items()}
    seen = F.lit(MARKS["total"])
    for name, inside in groups.items():
        seen = seen + F.when(inside, MARKS[name]).otherwise(0)
    rows = rows.withColumn("_marks", seen + F.when(F.col("won"), seen * 16).otherwise(0))
    sums = [F.bit_or("_marks").alias("marks")]
    for name, inside in {"total": None, **groups}.items():
        value, days = (F.col(c) if inside is None else F.when(inside, F.col(c)) for c in ("value", "days"))
        sums += [F.sum(value).alias(f"{name}_value"), F.sum(days).alias(f"{name}_days"), F.count(days).alias(f"{name}_days_n")]
    per_opp = rows.groupBy(*KEYS, "to_global", "_counting", "opportunity_id").agg(*sums)
    # Counts were spread to GLOBAL row by row above; sums are spread here, after they shrank.
    return per_opp.withColumn("sales_region", F.explode(_regions(~F.col("_counting")))).drop("to_global", "_counting")


def _measure_value(name: str, kind_of: dict[str, list[str]]) -> Column:
    """The split's value, by the aggregation the row's measure asks for."""
    value, seen, won = F.col(f"{name}_value"), F.col(f"{name}_seen"), F.col(f"{name}_won")
    forms = {
        "count_per_week": seen / F.lit(WEEKS),
        "sum_per_week": value / F.lit(WEEKS),
        "sum": value,
        "sum_per_count": safe_divide(value, seen),
        "mean_days": safe_divide(F.col(f"{name}_days"), F.col(f"{name}_days_n")),
        "won_ratio": safe_divide(won, seen),
        "capacity": value if name == "total" else F.lit(0.0),
    }
    out = None
    for kind, names in kind_of.items():
        out = F.when(F.col("measure").isin(*names), forms[kind]) if out is None else out.when(F.col("measure").isin(*names), forms[kind])
    return out


def quarterly_cube(fact: DataFrame, sides: list[Team]) -> DataFrame:
    """Long table of all measures by segment, quarter, value type and region, from one read of the fact."""
    per_opp = _per_opportunity(fact, sides)
    measures = sides[0].measures
    counted = F.col("opportunity_id").isNotNull()
    sums = []
    for name in ["total", *SPLITS]:
        sums += [
            F.sum(f"{name}_value").alias(f"{name}_value"),
            F.count(F.when(counted & (F.col("marks").bitwiseAND(MARKS[name]) > 0), 1)).alias(f"{name}_seen"),
            F.count(F.when(counted & (F.col("marks").bitwiseAND(MARKS[name] * 16) > 0), 1)).alias(f"{name}_won"),
            F.sum(f"{name}_days").alias(f"{name}_days"),
            F.sum(f"{name}_days_n").alias(f"{name}_days_n"),
        ]
    kind_of: dict[str, list[str]] = {}
    for m in measures:
        kind_of.setdefault(m.kind, []).append(m.name)
    sort_id, label = None, None
    for m in measures:
        is_it = F.col("measure") == m.name
        sort_id = F.when(is_it, m.sort_id) if sort_id is None else sort_id.when(is_it, m.sort_id)
        label = F.when(is_it, m.metric_label) if label is None else label.when(is_it, m.metric_label)
    return per_opp.groupBy(*KEYS).agg(*sums).select(
        F.col("segment").alias("market_segment"),
        sort_id.alias("sort_id"),
        label.alias("metric"),
        "label",
        "yr_qtr",
        "value_type",
        *[_measure_value(n, kind_of).cast("double").alias(n) for n in ["total", *SPLITS]],
        "sales_region",
    )


def measure_block(fact: DataFrame, name: str) -> DataFrame:
    """One measure for the reviewed segments (regional and GLOBAL) and the outsourced team (regional)."""
    return quarterly_cube(fact, teams([m for m in MEASURES if m.name == name]))


def quarterly_review(fact: DataFrame) -> DataFrame:
    """All measures of the review."""
    return quarterly_cube(fact, teams())
