"""Further reports named by the model: trends, shares, engagement, rhythm."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmart.contracts import FAVOURITE, PUBLICATION, VIEW
from scholarmart.functions.scalar import bucket, days_between, month_start, term
from scholarmart.operators.aggregates import flag_rate, ratio, regroup, share_of_total, sum_if
from scholarmart.operators.ranking import rank_groups, top_k


def activity_by_month(fact: DataFrame) -> DataFrame:
    return fact.groupBy(month_start("fecha").alias("mes")).agg(F.sum("cant_interacciones").cast("long").alias("total"))


def activity_by_term(fact: DataFrame, rule: str = "code") -> DataFrame:
    keys = [F.year("fecha").alias("anio"), term("fecha", rule).cast("int").alias("cuatrimestre")]
    return fact.groupBy(*keys).agg(F.sum("cant_interacciones").cast("long").alias("total"))


def publication_rhythm(fact: DataFrame) -> DataFrame:
    """Publications by month of the year."""
    rows = fact.filter(F.col("id_tipo_interaccion") == PUBLICATION)
    return rows.groupBy(F.month("fecha").alias("mes")).agg(F.sum("cant_interacciones").cast("long").alias("publicaciones"))


def type_shares(docs: DataFrame, types: DataFrame) -> DataFrame:
    """Documents per type in percent of all."""
    return share_of_total(docs, ["id_tipo"]).join(types, "id_tipo").select("nombre", "cantidad", "porcentaje")


def visibility_by_school(docs: DataFrame, subjects: DataFrame) -> DataFrame:
    counts = docs.groupBy("id_materia", "visibilidad").agg(F.count("*").alias("_n"))
    named = counts.join(subjects.select("id_materia", "nombre_escuela"), "id_materia")
    return named.groupBy("nombre_escuela", "visibilidad").agg(F.sum("_n").alias("documentos"))


def busiest_subjects(docs: DataFrame, subjects: DataFrame, n: int) -> DataFrame:
    counts = docs.groupBy("id_materia").agg(F.count("*").alias("documentos"))
    named = counts.join(subjects.select("id_materia", "nombre_materia"), "id_materia")
    return top_k(named, n, F.col("documentos").desc(), F.col("id_materia").asc())


def engagement(fact: DataFrame) -> DataFrame:
    """Favourites per view of every document; NULL without views."""
    kind = F.col("id_tipo_interaccion")
    sums = fact.groupBy("id_documento").agg(sum_if(kind == VIEW).alias("vistas"), sum_if(kind == FAVOURITE).alias("favoritos"))
    return sums.withColumn("ratio", ratio(F.col("favoritos"), F.col("vistas")))


def deletion_rate(docs: DataFrame, subjects: DataFrame) -> DataFrame:
    """Deleted documents per degree, in percent."""
    named = docs.select("id_materia", "is_deleted").join(subjects.select("id_materia", "nombre_carrera"), "id_materia")
    return named.groupBy("nombre_carrera").agg(F.count("*").alias("documentos"), flag_rate("is_deleted").alias("tasa_eliminacion"))


def type_diversity(docs: DataFrame, subjects: DataFrame, approximate: bool = False) -> DataFrame:
    """Different document types per degree."""
    pairs = docs.select("id_materia", "id_tipo").join(subjects.select("id_materia", "nombre_carrera"), "id_materia")
    count = F.approx_count_distinct("id_tipo") if approximate else F.countDistinct("id_tipo")
    return pairs.groupBy("nombre_carrera").agg(count.alias("tipos"))


# Fixed values of the age report.
AGE_BOUNDS = (365, 730, 1460)
AGE_LABELS = ("hasta 1 anio", "hasta 2 anios", "hasta 4 anios", "mas de 4 anios")


def age_and_views(docs: DataFrame, fact: DataFrame, as_of: dt.date) -> DataFrame:
    """Documents and mean views per age class."""
    views = regroup(fact.filter(F.col("id_tipo_interaccion") == VIEW), ["id_documento"]).withColumnRenamed("cant_interacciones", "_v")
    aged = docs.select("id_documento", days_between(F.lit(as_of), "fecha_alta").alias("_age"))
    joined = aged.join(views, "id_documento", "left").na.fill(0, ["_v"])
    return joined.groupBy(bucket("_age", AGE_BOUNDS, AGE_LABELS).alias("antiguedad")).agg(
        F.count("*").alias("documentos"), F.avg("_v").alias("vistas_promedio")
    )


def age_view_correlation(docs: DataFrame, fact: DataFrame, as_of: dt.date) -> DataFrame:
    views = regroup(fact.filter(F.col("id_tipo_interaccion") == VIEW), ["id_documento"]).withColumnRenamed("cant_interacciones", "_v")
    aged = docs.select("id_documento", days_between(F.lit(as_of), "fecha_alta").cast("double").alias("_age"))
    joined = aged.join(views, "id_documento", "left").na.fill(0, ["_v"])
    return joined.agg(F.corr("_age", F.col("_v").cast("double")).alias("correlacion"))


def school_consumption(fact: DataFrame, docs: DataFrame, subjects: DataFrame) -> DataFrame:
    """Views and favourites by school of the document, ranked."""
    used = regroup(fact.filter(F.col("id_tipo_interaccion").isin(VIEW, FAVOURITE)), ["id_documento"])
    by_subject = used.join(docs.select("id_documento", "id_materia"), "id_documento").groupBy("id_materia").agg(
        F.sum("cant_interacciones").alias("_n")
    )
    named = by_subject.join(subjects.select("id_materia", "nombre_escuela"), "id_materia")
    totals = named.groupBy("nombre_escuela").agg(F.sum("_n").cast("long").alias("consumo"))
    return rank_groups(totals, "consumo", "puesto")


def author_engagement_by_school(fact: DataFrame, users: DataFrame) -> DataFrame:
    """Authors, their interactions and the mean per author, by school of the author."""
    used = regroup(fact.filter(F.col("id_tipo_interaccion").isin(VIEW, FAVOURITE)), ["id_usuario"])
    named = used.join(users.select("id_usuario", "nombre_escuela"), "id_usuario")
    return named.groupBy("nombre_escuela").agg(
        F.count("*").alias("autores"),
        F.sum("cant_interacciones").cast("long").alias("interacciones"),
        F.avg("cant_interacciones").alias("por_autor"),
    )


def search_quality(searches: DataFrame, text: str = "query_texto") -> DataFrame:
    """Click-through and zero-result rates per search text."""
    return searches.groupBy(text).agg(
        F.count("*").alias("busquedas"),
        flag_rate("hizo_click").alias("tasa_click"),
        flag_rate(F.col("cant_resultados") == 0).alias("tasa_sin_resultados"),
    )


def favourites_counter(favourites: DataFrame) -> DataFrame:
    return favourites.groupBy("id_documento").agg(F.count("*").alias("guardado_por"))


def activity_by_hour(events: DataFrame, ts: str = "ts") -> DataFrame:
    return events.groupBy(F.hour(ts).alias("hora")).agg(F.count("*").alias("eventos"))


def browse(docs: DataFrame, subjects: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Active documents with their place in the hierarchy, to be paged."""
    live = docs.filter(~F.col("is_deleted"))
    return live.join(subjects, "id_materia").select("id_documento", "titulo", "fecha_alta", *keys)
