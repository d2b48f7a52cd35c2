"""Dashboard and demo queries over the star."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scholarmart.contracts import PUBLICATION, VIEW
from scholarmart.operators.aggregates import regroup, views_and_favourites
from scholarmart.operators.joins import at_latest
from scholarmart.operators.ranking import top_k
from scholarmart.operators.selection import between_dates, last_days


def _active(docs: DataFrame) -> DataFrame:
    return docs.filter(~F.col("is_deleted"))


def publication_heatmap(docs: DataFrame, subjects: DataFrame, types: DataFrame) -> DataFrame:
    """Active documents by school, degree and type; counted per subject before the names are joined."""
    counts = _active(docs).groupBy("id_materia", "id_tipo").agg(F.count("*").alias("_n"))
    named = counts.join(subjects, "id_materia").join(types.withColumnRenamed("nombre", "tipo_documento"), "id_tipo")
    return (
        named.groupBy("nombre_escuela", "nombre_carrera", "tipo_documento")
        .agg(F.sum("_n").alias("cant_publicaciones"))
        .orderBy("nombre_escuela", "nombre_carrera", "tipo_documento")
    )


def publication_matrix(docs: DataFrame, subjects: DataFrame, types: DataFrame, type_names: Sequence[str]) -> DataFrame:
    """The heatmap with one column per document type."""
    rows = publication_heatmap(docs, subjects, types)
    return rows.groupBy("nombre_escuela", "nombre_carrera").pivot("tipo_documento", list(type_names)).agg(F.sum("cant_publicaciones")).na.fill(0)


def latest_top_queries(popularity: DataFrame, n: int = 20) -> DataFrame:
    newest = at_latest(popularity, "fecha")
    return top_k(newest.select("query_texto", "score", "ranking"), n, F.col("ranking").asc(), F.col("query_texto").asc())


def query_evolution(popularity: DataFrame, query: str | None = None) -> DataFrame:
    """Score and rank over the days with the change since the day before."""
    rows = popularity if query is None else popularity.filter(F.col("query_texto") == query)
    w = Window.partitionBy("query_texto").orderBy("fecha")
    return rows.select(
        "fecha",
        "query_texto",
        "score",
        "ranking",
        (F.col("score") - F.lag("score").over(w)).alias("cambio_score"),
        (F.col("ranking") - F.lag("ranking").over(w)).alias("cambio_ranking"),
    )


def top_authors(fact: DataFrame, users: DataFrame, n: int = 10, by_id: bool = False) -> DataFrame:
    """Authors by views. Namesakes of one degree count as one unless ``by_id``."""
    sums = regroup(fact.filter(F.col("id_tipo_interaccion") == VIEW), ["id_usuario"])
    names = ["autor", "nombre_escuela", "nombre_carrera"]
    keys = ["id_usuario", *names] if by_id else names
    people = users.select("id_usuario", F.col("nombre").alias("autor"), "nombre_escuela", "nombre_carrera")
    totals = sums.join(people, "id_usuario").groupBy(*keys).agg(F.sum("cant_interacciones").alias("visualizaciones"))
    return top_k(totals, n, F.col("visualizaciones").desc(), *[F.col(k).asc() for k in keys])


def top_documents(fact: DataFrame, docs: DataFrame, subjects: DataFrame, as_of: dt.date, days: int = 30, n: int = 10) -> DataFrame:
    """Active documents by views and favourites of the last days."""
    recent = views_and_favourites(last_days(fact, "fecha", days, as_of), ["id_documento"])
    live = _active(docs).select("id_documento", "titulo", "id_materia")
    best = top_k(recent.join(live, "id_documento"), n, F.col("total_interacciones").desc(), F.col("id_documento").asc())
    # the hierarchy is looked up for the winners only; every document has its subject
    return best.join(subjects.select("id_materia", "nombre_escuela", "nombre_carrera"), "id_materia").select(
        "id_documento", "titulo", "nombre_escuela", "nombre_carrera", "visualizaciones", "favoritos", "total_interacciones"
    )


def period_total(fact: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return between_dates(fact, "fecha", start, end).agg(F.sum("cant_interacciones").cast("long").alias("total_interacciones"))


def views_by_type_and_year(fact: DataFrame, docs: DataFrame, types: DataFrame, calendar: DataFrame) -> DataFrame:
    """Views by document type and year, deleted documents included."""
    views = fact.filter(F.col("id_tipo_interaccion") == VIEW)
    yearly = views.join(calendar.select("fecha", "anio"), "fecha").groupBy("id_documento", "anio").agg(F.sum("cant_interacciones").alias("_n"))
    typed = yearly.join(docs.select("id_documento", "id_tipo"), "id_documento").groupBy("id_tipo", "anio").agg(F.sum("_n").alias("_n"))
    named = typed.join(types.withColumnRenamed("nombre", "tipo_documento"), "id_tipo")
    return named.groupBy("tipo_documento", "anio").agg(F.sum("_n").cast("long").alias("visualizaciones")).orderBy("tipo_documento", "anio")


def publications_by_term(fact: DataFrame, docs: DataFrame, subjects: DataFrame, calendar: DataFrame, year: int) -> DataFrame:
    """Publications of active documents by school and term of one year."""
    # the year also bounds the fact, so that partitions are pruned
    events = between_dates(fact, "fecha", dt.date(year, 1, 1), dt.date(year, 12, 31)).filter(F.col("id_tipo_interaccion") == PUBLICATION)
    days = calendar.filter(F.col("anio") == year).select("fecha", "cuatrimestre")
    live = _active(docs).select("id_documento", "id_materia")
    named = events.join(days, "fecha").join(live, "id_documento").join(subjects.select("id_materia", "nombre_escuela"), "id_materia")
    return (
        named.groupBy(F.col("nombre_escuela").alias("escuela"), "cuatrimestre")
        .agg(F.sum("cant_interacciones").cast("long").alias("total_publicaciones"))
        .orderBy("escuela", "cuatrimestre")
    )


def document_activity(fact: DataFrame, docs: DataFrame, types: DataFrame, doc_id: int | None = None) -> DataFrame:
    """Interactions by type, of one document or of each."""
    if doc_id is not None:
        fact = fact.filter(F.col("id_documento") == doc_id)
    sums = regroup(fact, ["id_documento", "id_tipo_interaccion"])
    return (
        sums.join(docs.select("id_documento", "titulo"), "id_documento")
        .join(types.withColumnRenamed("nombre", "tipo_evento"), "id_tipo_interaccion")
        .select("id_documento", "titulo", "tipo_evento", F.col("cant_interacciones").alias("total_interacciones"))
    )
