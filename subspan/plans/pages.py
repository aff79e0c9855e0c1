"""The report pages as measure queries: (grouping columns, measures) per visual."""

from __future__ import annotations

from pyspark.sql import DataFrame

from subspan.operators.measures import Star, measure_query
from subspan.operators.semantic import SELECTABLE

PAGES: dict[str, dict[str, tuple[tuple[str, ...], tuple[str, ...]]]] = {
    "overview": {
        "headline": ((), SELECTABLE),
        "movements": (("month",), ("new_mrr", "expansion_mrr", "contraction_mrr", "churn_mrr", "reactivation_mrr")),
        "accounts": (("account_id",), ("mrr", "nrr")),
    },
    "product": {
        "headline": ((), ("mau", "average_dau", "stickiness", "activation_rate")),
        "usage": (("month",), ("mau", "average_dau")),
        "features": (("event_name",), ("feature_adoption",)),
    },
    "acquisition": {
        "funnel": (
            ("channel",),
            ("signup_accounts", "qualified_accounts", "converted_accounts", "conversion_rate", "activation_rate"),
        ),
        "activation": (("month",), ("activation_rate", "conversion_rate")),
    },
    "retention": {
        "cohorts": (("cohort_month", "month"), ("cohort_retention",)),
        "trend": (("month",), ("nrr", "grr")),
    },
    "account_detail": {
        "metrics": ((), ("mrr", "arr", "nrr", "active_users", "account_context")),
        "revenue": (("month",), ("mrr",)),
    },
    "revenue_tooltip": {"context": ((), ("revenue_context", "grr"))},
    "validation": {"bridge": (("month",), ("mrr", "arr", "nrr", "grr", "mrr_reconciliation"))},
}


def page(star: Star, name: str, visual: str, **filters) -> DataFrame:
    by, measures = PAGES[name][visual]
    return measure_query(star, measures, by, **filters)
