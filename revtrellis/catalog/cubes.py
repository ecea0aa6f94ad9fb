"""Quarterly metric cube."""

from __future__ import annotations

from revtrellis.catalog.registry import query
from revtrellis.operators.cube import MEASURES, measure_block, quarterly_review

_INHOUSE = "market_segment IN ('Enterprise', 'Large Accounts', 'Mid Market', 'Cross-Sell', 'SMB', 'Retail') AND team_segment NOT LIKE '%N3%'"
_OUTSOURCED = "team_segment LIKE '%N3 Retail%'"
_LABEL_INHOUSE = "replace(market_segment, 'SMB', 'Cross-Sell')"
_SPLIT = {"total": "true", "marketing": "lead_group = 'Inbound'", "partner": "lead_group = 'Partner'", "sales": "lead_group = 'Outbound'"}


def _expr(kind: str, cond: str, split: str, days: tuple[str, str] | None) -> str:
    opp = f"count(DISTINCT opportunity_id) FILTER ({cond})"
    total = f"sum(value) FILTER ({cond})"
    return {
        "count_per_week": f"{opp} / 13",
        "sum_per_week": f"{total} / 13",
        "sum": total,
        "sum_per_count": f"{total} / nullif({opp}, 0)",
        "mean_days": f"avg({days[0]} - {days[1]}) FILTER ({cond})" if days else "",
        "won_ratio": f"count(DISTINCT opportunity_id) FILTER ({cond} AND metric = 'Closed Won') / nullif({opp}, 0)",
        "capacity": total if split == "total" else "0",
    }[kind]


def _select(sort_id, label_text, kind, where, segment, label, region, days) -> str:
    """One block as plain grouped SQL: distinct counts directly on the fact."""
    cols = ", ".join(f"CAST({_expr(kind, cond, n, days)} AS DOUBLE) AS {n}" for n, cond in _SPLIT.items())
    return f"""SELECT {segment} AS market_segment, CAST({sort_id} AS INT) AS sort_id, '{label_text}' AS metric, {label} AS label,
      CAST(year AS VARCHAR) || '-' || quarter AS yr_qtr, value_type, {cols}, {region} AS sales_region FROM fact_metric WHERE {where} GROUP BY ALL"""


# name -> (kind, sort, label text, filter, filter of the outsourced block or None, label column, days)
_BLOCKS = {
    "created_count": ("count_per_week", 1, "Created Opp Volume", "dataset = 'Actuals' AND metric = 'Created' AND value_type = 'Opportunity Deal Count'", "", "dataset", None),
    "created_target": ("sum_per_week", 1, "Created Opp Volume", "dataset = 'Targets' AND metric = 'Created' AND value_type = 'Product Deal Count'", "", "dataset", None),
    "created_revenue": ("sum_per_week", 1, "Created Opp Volume", "dataset IN ('Targets', 'Actuals') AND metric = 'Created' AND value_type = 'Total Revenue'", "", "dataset", None),
    "qualified_avg": ("sum_per_count", 2, "Qualified Opp Total Revenue Avg ($)", "dataset IN ('Targets', 'Actuals') AND metric = 'Qualified SAL' AND value_type IN ('Total Revenue', 'Incremental Product Profit')", "", "dataset", None),
    "days_created_qualified": ("mean_days", 3, "Created to Qualified (days)", "dataset = 'Actuals' AND metric = 'Pipeline SAL' AND value_type = 'Opportunity Deal Count'", "dataset = 'Actuals' AND metric = 'Created SAL' AND value_type = 'Opportunity Deal Count'", "'*'", ("qualified_date", "created_date")),
    "days_qualified_won": ("mean_days", 4, "Qualified to Win (days)", "dataset = 'Actuals' AND metric = 'Closed Won' AND value_type = 'Opportunity Deal Count'", "", "'*'", ("close_date", "qualified_date")),
    "days_to_win": ("mean_days", 5, "Time to Win (days)", "dataset = 'Actuals' AND metric = 'Closed Won' AND value_type = 'Opportunity Deal Count'", "", "'*'", ("close_date", "created_date")),
    "win_rate": ("won_ratio", 6, "Win Rate", "dataset = 'Actuals' AND metric IN ('Closed Won', 'Closed Lost') AND value_type = 'Opportunity Deal Count'", "", "'*'", None),
    "closed_won": ("sum", 7, "Closed Won", "dataset IN ('Targets', 'Actuals') AND metric = 'Closed Won' AND value_type IN ('Total Revenue', 'Incremental Product Profit')", "dataset IN ('Targets', 'Actuals') AND metric = 'Closed Won' AND value_type = 'Incremental Product Profit'", "dataset", None),
    "closed_won_avg": ("sum_per_count", 8, "Closed Won Avg", "dataset IN ('Targets', 'Actuals') AND metric = 'Closed Won' AND value_type IN ('Total Revenue', 'Incremental Product Profit')", "dataset IN ('Targets', 'Actuals') AND metric = 'Closed Won' AND value_type = 'Incremental Product Profit'", "dataset", None),
    "head_count": ("capacity", 9, "Heat Count Capacity", "dataset = 'Head Count' AND metric = 'Head Count Capacity'", None, "dataset", None),
}


def block_sql(name: str) -> str:
    kind, sort_id, text, where, other, label, days = _BLOCKS[name]
    parts = [
        _select(sort_id, text, kind, f"{where} AND {_INHOUSE}", _LABEL_INHOUSE, label, "sales_region", days),
        _select(sort_id, text, kind, f"{where} AND {_INHOUSE}", _LABEL_INHOUSE, label, "'GLOBAL'", days),
    ]
    if other is not None:
        parts.append(_select(sort_id, text, kind, f"{other or where} AND {_OUTSOURCED}", "'N3 Retail'", label, "sales_region", days))
    return " UNION ALL ".join(parts)


def _register(name: str) -> None:
    query(f"qbr_{name}", block_sql(name))(lambda s: measure_block(s.table("fact_metric"), name))


for _m in MEASURES:
    _register(_m.name)


@query("pipe_qbr", " UNION ALL ".join(block_sql(m.name) for m in MEASURES))
def _(s):
    return quarterly_review(s.table("fact_metric"))
