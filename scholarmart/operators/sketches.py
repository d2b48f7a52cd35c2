"""Distinct counts from sketches that are kept per day and merged by union."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12


def relative_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a merged HyperLogLog sketch with ``2**lg_k`` registers."""
    return 1.04 / 2 ** (lg_k / 2)


def daily_sketches(df: DataFrame, keys: Sequence[str], day: Column, value: str, lg_k: int = LG_K) -> DataFrame:
    """``fecha``, the keys and a sketch of the distinct values; made in every task before the shuffle. Nulls do not count."""
    return df.groupBy(day.alias("fecha"), *keys).agg(F.hll_sketch_agg(value, lg_k).alias("sketch"))


def merged_distinct(sketches: DataFrame, keys: Sequence[str | Column], name: str) -> DataFrame:
    """Distinct values over all sketches of a key: a value seen on several days counts once."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
