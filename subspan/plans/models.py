"""All models over one set of source datasets."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from subspan.operators import acquisition, bitmaps, product, revenue, staging
from subspan.session import written

# The models that readers know by name.
MARTS = (
    "dim_account",
    "dim_user",
    "dim_date",
    "fct_account_month",
    "fct_product_event",
    "fct_account_funnel",
    "fct_marketing_spend",
    "mart_revenue_monthly",
    "mart_product_monthly",
    "mart_feature_adoption",
    "mart_cohort_retention",
    "mart_acquisition",
)


@dataclass(frozen=True)
class Models:
    """Lazily composed models. ``folder`` makes the shared ones written tables.

    Without a folder every model is one logical plan from the raw frames on, which is right for
    a single query. For a full build give a folder on shared storage.
    """

    raw: Mapping[str, DataFrame]
    folder: str | None = None
    watch: Callable[[str, DataFrame], DataFrame] = lambda name, df: df  # sees a shared model before it is written

    def _shared(self, name: str, df: DataFrame, partition_by: str | None = None, placed: bool = False) -> DataFrame:
        return written(self.watch(name, df), f"{self.folder}/{name}", partition_by, placed) if self.folder else df

    @cached_property
    def stg_subscriptions(self) -> DataFrame:
        return staging.staged("subscriptions", self.raw["subscriptions"])

    @cached_property
    def stg_opportunities(self) -> DataFrame:
        return staging.staged("opportunities", self.raw["opportunities"])

    @cached_property
    def stg_marketing(self) -> DataFrame:
        return staging.staged("marketing", self.raw["marketing"])

    @cached_property
    def stg_events(self) -> DataFrame:
        return staging.stg_events(self.raw["events"])

    @cached_property
    def dim_account(self) -> DataFrame:
        return self._shared("dim_account", staging.dim_account(self.raw["accounts"]))

    @cached_property
    def dim_user(self) -> DataFrame:
        return staging.dim_user(self.raw["users"])

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._shared("dim_date", staging.dim_date(self.stg_marketing))

    @cached_property
    def int_account_month(self) -> DataFrame:
        return revenue.account_month_balances(self.dim_account, self.dim_date, self.stg_subscriptions)

    @cached_property
    def fct_account_month(self) -> DataFrame:
        return self._shared("fct_account_month", revenue.fct_account_month(self.int_account_month))

    @cached_property
    def fct_product_event(self) -> DataFrame:
        return self._shared("fct_product_event", staging.fct_product_event(self.stg_events))

    @cached_property
    def usage(self) -> DataFrame:
        # By month: a measure of one month reads one folder.
        return self._shared("usage", product.usage_base(self.fct_product_event), "month")

    @cached_property
    def usage_bits(self) -> DataFrame:
        """Needs a folder: bitmaps are built once and read by many queries."""
        if self.folder is None:
            raise ValueError("bitmaps are written tables: give the models a folder")
        return self._shared("usage_bits", bitmaps.usage_bits(self.usage, self.dim_account, self.folder), "month", placed=True)

    @cached_property
    def fct_account_funnel(self) -> DataFrame:
        funnel = acquisition.fct_account_funnel(
            self.dim_account, self.stg_opportunities, self.fct_product_event, self.dim_date
        )
        return self._shared("fct_account_funnel", funnel)

    @cached_property
    def fct_marketing_spend(self) -> DataFrame:
        return staging.fct_marketing_spend(self.stg_marketing)

    @cached_property
    def mart_revenue_monthly(self) -> DataFrame:
        return revenue.mart_revenue_monthly(self.fct_account_month)

    @cached_property
    def mart_product_monthly(self) -> DataFrame:
        return product.mart_product_monthly(self.usage, self.dim_date)

    @cached_property
    def mart_feature_adoption(self) -> DataFrame:
        return product.mart_feature_adoption(self.usage, self.mart_product_monthly)

    @cached_property
    def mart_cohort_retention(self) -> DataFrame:
        return product.mart_cohort_retention(self.dim_account, self.dim_date, self.usage)

    @cached_property
    def mart_acquisition(self) -> DataFrame:
        return acquisition.mart_acquisition(
            self.fct_account_funnel, self.dim_account, self.fct_marketing_spend
        )

    def marts(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in MARTS}
