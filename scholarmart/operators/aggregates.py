"""Roll-ups and conditional aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmart.contracts import FAVOURITE, PUBLICATION, VIEW
from scholarmart.functions.scalar import month_start


def daily_counts(events: DataFrame, interaction: int, ts: str = "created_at", key: str = "id_documento") -> DataFrame:
    """Events per day and document; counted in every task before the shuffle."""
    return (
        events.groupBy(F.to_date(ts).alias("fecha"), F.col(key).alias("id_documento"))
        .agg(F.count("*").alias("cant_interacciones"))
        .select("fecha", "id_documento", F.lit(interaction).alias("id_tipo_interaccion"), "cant_interacciones")
    )


def publications(docs: DataFrame, ts: str = "created_at", key: str = "id") -> DataFrame:
    """One publication per document."""
    return docs.select(
        F.to_date(ts).alias("fecha"),
        F.col(key).alias("id_documento"),
        F.lit(PUBLICATION).alias("id_tipo_interaccion"),
        F.lit(1).cast("long").alias("cant_interacciones"),
    )


def regroup(fact: DataFrame, keys: Sequence[str], measure: str = "cant_interacciones") -> DataFrame:
    return fact.groupBy(*keys).agg(F.sum(measure).cast("long").alias(measure))


def sum_if(condition: Column, value: str = "cant_interacciones") -> Column:
    """Sum of the rows that meet a condition; 0 if none does."""
    return F.coalesce(F.sum(F.when(condition, F.col(value))), F.lit(0)).cast("long")


def views_and_favourites(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Views, favourites and their sum per key, as columns."""
    kind = F.col("id_tipo_interaccion")
    return (
        fact.filter(kind.isin(VIEW, FAVOURITE))
        .groupBy(*keys)
        .agg(
            sum_if(kind == VIEW).alias("visualizaciones"),
            sum_if(kind == FAVOURITE).alias("favoritos"),
            F.sum("cant_interacciones").cast("long").alias("total_interacciones"),
        )
    )


def pivot_sum(df: DataFrame, keys: Sequence[str], column: str, values: Sequence, measure: str) -> DataFrame:
    """One column per listed value; the list keeps Spark from scanning for it."""
    return df.groupBy(*keys).pivot(column, list(values)).agg(F.sum(measure).cast("long")).na.fill(0)


def monthly_series(fact: DataFrame, keys: Sequence[str], measure: str = "cant_interacciones") -> DataFrame:
    return fact.groupBy(*keys, month_start("fecha").alias("mes")).agg(F.sum(measure).cast("long").alias("total"))


def share_of_total(df: DataFrame, keys: Sequence[str], name: str = "porcentaje") -> DataFrame:
    """Rows per group and their part of all rows, in percent."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("cantidad"))
    total = counts.agg(F.sum("cantidad").alias("total"))
    return counts.withColumn(name, F.col("cantidad") * 100.0 / total.scalar())


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient; NULL if the denominator is 0."""
    return F.try_divide(numerator, denominator)


def flag_rate(flag: str | Column) -> Column:
    """Part of the rows where a flag holds, in percent."""
    col = F.col(flag) if isinstance(flag, str) else flag
    return F.avg(col.cast("int").cast("double")) * 100.0


def prefix_scores(prefixes: DataFrame, text: str = "query_texto", score: str = "score") -> DataFrame:
    return prefixes.groupBy(text).agg(F.sum(score).cast("long").alias(score))
