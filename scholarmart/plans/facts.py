"""Daily facts of documents and authors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmart.contracts import FAVOURITE, VIEW
from scholarmart.operators.aggregates import daily_counts, publications
from scholarmart.operators.joins import credit_authors
from scholarmart.session import tasks_for


def document_deltas(views: DataFrame, favourites: DataFrame, docs: DataFrame) -> dict[str, DataFrame]:
    """Daily counts of the rows given, by source."""
    return {
        "visualizacion": daily_counts(views, VIEW),
        "favorito": daily_counts(favourites, FAVOURITE),
        "documento": publications(docs),
    }


def union_all(frames) -> DataFrame:
    frames = list(frames)
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def document_fact(views: DataFrame, favourites: DataFrame, docs: DataFrame) -> DataFrame:
    """The whole fact in one load. Events are dealt by day and document over as many tasks as their files are worth: what one task counts does not grow."""
    return union_all(document_deltas(_dealt(views), _dealt(favourites), docs).values())


def _dealt(events: DataFrame) -> DataFrame:
    return events.select("id_documento", "created_at").repartition(tasks_for(events), F.to_date("created_at"), F.col("id_documento"))


def author_fact(document: DataFrame, bridge: DataFrame) -> DataFrame:
    return credit_authors(document, bridge).withColumn("cant_interacciones", F.col("cant_interacciones").cast("long"))
