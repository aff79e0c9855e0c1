"""A full build: every mart written, all data tests run, and only then shown to readers.

    <folder>/builds/<run>/<model>/     the run's tables
    <folder>/current/                  the log that names the run that counts
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

from pyspark.sql import DataFrame, Observation, SparkSession

from subspan.operators import checks
from subspan.plans.models import MARTS, Models
from subspan.session import observed, written
from subspan.sources import files, pointers

# The shared models after those they read, then all that only read them.
_SHARED = (("dim_account", "dim_date"), ("fct_account_month", "fct_product_event"), ("usage", "fct_account_funnel"))
WAVES = (*_SHARED, tuple(name for name in MARTS if not any(name in wave for wave in _SHARED)))


class BuildError(ValueError):
    """Data tests failed; ``failing`` has the number of failing rows by test."""

    def __init__(self, failing: dict[str, int]) -> None:
        self.failing = failing
        super().__init__("; ".join(f"{name}: {n} rows" for name, n in sorted(failing.items())))


def _tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in MARTS}


def write_marts(spark: SparkSession, raw: Mapping[str, DataFrame], place: str) -> dict[str, int]:
    """Write all marts below ``place``; the failing rows of each of the 22 data tests.

    Tests of single rows are metrics of the writes themselves. Those that compare rows read the written tables' keys once.
    """
    seen: dict[str, tuple[Observation, list[str]]] = {}

    def watch(name: str, df: DataFrame) -> DataFrame:
        metrics = checks.row_metrics(name)
        if not metrics:
            return df
        seen[name] = Observation(), df.agg(*metrics).columns
        return df.observe(seen[name][0], *metrics)

    models = Models(raw, place, watch)

    def save(name: str) -> None:
        df = getattr(models, name)
        if name in MARTS and not files.exists(spark, f"{place}/{name}"):  # shared models are written already
            written(watch(name, df), f"{place}/{name}")

    # The tables of a wave need only those of the waves before. Submitted together, small ones fill the gaps of big ones.
    for wave in WAVES:
        with ThreadPoolExecutor(len(wave)) as pool:
            list(pool.map(save, wave))
    failing = checks.key_counts(SimpleNamespace(**_tables(spark, place))).first().asDict()
    for observation, names in seen.values():
        for check in names:
            failing[check] = failing.get(check, 0) + observed(observation, check, 0)
    return failing


def build(spark: SparkSession, raw: Mapping[str, DataFrame], folder: str) -> str:
    """Write all marts below a new run, test them, then name the run. Returns it.

    A failing test or a crash leaves the earlier build as it was. The build before the current one is kept for its
    readers, older ones are removed.
    """
    run = uuid.uuid4().hex
    place = f"{folder}/builds/{run}"
    named = False
    try:
        failing = {check: n for check, n in write_marts(spark, raw, place).items() if n}
        if failing:
            raise BuildError(failing)
        pointers.point(spark, f"{folder}/current", run)
        named = True
    finally:
        if not named:
            files.remove(spark, place)
    pointers.sweep(spark, f"{folder}/builds", [e["value"] for e in pointers.entries(spark, f"{folder}/current", 2)])
    return run


def built(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The marts of the current build."""
    current = pointers.last(spark, f"{folder}/current")
    if current is None:
        raise FileNotFoundError(f"nothing was built in {folder}")
    return _tables(spark, f"{folder}/builds/{current['value']}")
