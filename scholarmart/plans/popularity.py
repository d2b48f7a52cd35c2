"""Query-popularity phase of the load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmart.contracts import WAREHOUSE_TABLES, conform
from scholarmart.operators.suggest import popularity_snapshot
from scholarmart.sources.tables import replace_day


def load_popularity(spark: SparkSession, scores: DataFrame | None, dst: str, day: dt.date, k: int = 20) -> int:
    """Replace the day's top queries; without any score the day is left as it is. Returns the rows written."""
    if scores is None or scores.isEmpty():
        return 0
    contract = WAREHOUSE_TABLES["fact_query_popularity"]
    snapshot = conform(popularity_snapshot(scores, F.lit(day), k), contract)
    replace_day(snapshot, dst, contract)
    return spark.read.schema(contract.schema).parquet(f"{dst}/{contract.name}").filter(F.col("fecha") == F.lit(day)).count()
