"""Author segmentation, document forecasts and leader boards."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmart.contracts import FAVOURITE, PUBLICATION, VIEW
from scholarmart.functions.scalar import month_index, round_half_up
from scholarmart.operators.aggregates import monthly_series, sum_if
from scholarmart.operators.ranking import ntile_by_counts, running, top_k

FIRST_DAY = dt.date(2024, 1, 1)


def author_metrics(
    fact: DataFrame, users: DataFrame, types: DataFrame, start: dt.date, end: dt.date, school: str | None = None
) -> DataFrame:
    """Publications and impact of every author with some interaction in the period.

    The fact is summed per author and type before a dimension is joined: the join by type has a handful of keys.
    """
    inside = fact.filter(F.col("fecha").between(F.lit(start), F.lit(end))).groupBy("id_usuario", "id_tipo_interaccion")
    named = inside.agg(F.sum("cant_interacciones").alias("cant_interacciones")).join(types, "id_tipo_interaccion")
    sums = named.groupBy("id_usuario").agg(
        sum_if(F.col("nombre") == "publicacion").alias("n_publicaciones"),
        sum_if(F.col("nombre").isin("visualizacion", "favorito_agregar")).alias("impacto"),
    )
    people = users if school is None else users.filter(F.col("nombre_escuela") == school)
    people = people.select("id_usuario", F.col("nombre").alias("autor"), "nombre_escuela")
    return people.join(sums, "id_usuario").select("id_usuario", "autor", "nombre_escuela", "n_publicaciones", "impacto")


def segment_authors(
    fact: DataFrame,
    users: DataFrame,
    types: DataFrame,
    start: dt.date = FIRST_DAY,
    end: dt.date | None = None,
    school: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Authors in a matrix of volume and impact, both cut at the median of the filtered authors, which counts per value give."""
    metrics = author_metrics(fact, users, types, start, end or dt.date.today(), school)
    halves = {"half_of_volume": ("n_publicaciones", 2), "half_of_impact": ("impacto", 2)}
    both = ntile_by_counts(metrics, halves, "id_usuario", slices)
    high_volume, high_impact = F.col("half_of_volume") == 2, F.col("half_of_impact") == 2
    segment = (
        F.when(high_volume & high_impact, "Referente")
        .when(high_volume, "Prolifico sin alcance")
        .when(high_impact, "Joya oculta")
        .otherwise("Periferico")
    )
    return both.select("id_usuario", "autor", "nombre_escuela", "n_publicaciones", "impacto", segment.alias("segmento"))


def by_impact(segments: DataFrame) -> DataFrame:
    return segments.orderBy(F.col("impacto").desc(), F.col("n_publicaciones").desc(), F.col("id_usuario").asc())


def segment_sizes(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segmento").agg(F.count("*").alias("autores"))


def referents(segments: DataFrame, n: int) -> DataFrame:
    """First authors of the best segment."""
    best = segments.filter(F.col("segmento") == "Referente")
    return top_k(best, n, F.col("impacto").desc(), F.col("n_publicaciones").desc(), F.col("id_usuario").asc())


def view_series(fact: DataFrame, types: DataFrame, fill_gaps: bool = False) -> DataFrame:
    """Views per document and month with the month counted from the document's first."""
    views = fact.join(types.filter(F.col("nombre") == "visualizacion"), "id_tipo_interaccion", "left_semi")
    series = monthly_series(views, ["id_documento"]).select("id_documento", month_index("mes").alias("_m"), "total")
    first = series.groupBy("id_documento").agg(F.min("_m").alias("_first"), F.max("_m").alias("_last"))
    if fill_gaps:
        months = first.select("id_documento", "_first", F.explode(F.sequence("_first", "_last")).alias("_m"))
        series = months.join(series, ["id_documento", "_m"], "left").na.fill(0, ["total"])
    else:
        series = series.join(first.drop("_last"), "id_documento")
    return series.select("id_documento", (F.col("_m") - F.col("_first")).alias("m"), "total")


def trend(fact: DataFrame, types: DataFrame, fill_gaps: bool = False) -> DataFrame:
    """Least-squares line of the monthly views of every document.

    Slope, r2 and the line itself do not depend on where months are counted from, so
    absolute month numbers serve and no window is needed.
    """
    if fill_gaps:
        series = view_series(fact, types, True)
    else:
        views = fact.join(types.filter(F.col("nombre") == "visualizacion"), "id_tipo_interaccion", "left_semi")
        # counted from 2000 to keep the numbers small
        series = monthly_series(views, ["id_documento"]).select("id_documento", (month_index("mes") - 24000).alias("m"), "total")
    return series.groupBy("id_documento").agg(
        F.count("*").alias("n"),
        F.regr_slope("total", "m").alias("slope"),
        F.regr_r2("total", "m").alias("r2"),
        F.avg("total").alias("mean"),
        F.avg("m").alias("m_mean"),
        F.max("m").alias("m_max"),
    )


def forecast(
    fact: DataFrame,
    docs: DataFrame,
    types: DataFrame,
    ids: DataFrame | Sequence[int] | None = None,
    horizon: int = 3,
    fill_gaps: bool = False,
) -> DataFrame:
    """Trend class and projected monthly views of documents, all at once.

    ``ids`` asks for certain documents; one without views still gives a row.
    """
    if ids is not None:
        if not isinstance(ids, DataFrame):
            ids = fact.sparkSession.createDataFrame([(int(i),) for i in ids], "id_documento long")
        wanted = ids.select("id_documento").distinct()
        lines = wanted.join(trend(fact.join(wanted, "id_documento", "left_semi"), types, fill_gaps), "id_documento", "left")
    else:
        lines = trend(fact, types, fill_gaps)
    slope = F.when(F.col("n") >= 2, F.col("slope"))
    projected = F.col("mean") + slope * (F.col("m_max") + horizon - F.col("m_mean"))
    kind = F.when(slope > 0.5, "creciente").when(slope < -0.5, "decreciente").otherwise("estable")
    return lines.join(docs.select("id_documento", "titulo"), "id_documento", "left").select(
        "id_documento",
        "titulo",
        F.coalesce("n", F.lit(0).cast("long")).alias("meses_con_datos"),
        round_half_up(slope, 3).alias("pendiente_mensual"),
        round_half_up(F.when(F.col("n") >= 2, F.col("r2")), 3).alias("r2"),
        round_half_up("mean", 2).alias("prom_mensual"),
        round_half_up(projected, 2).alias("proyeccion"),
        kind.alias("tendencia"),
    )


def leaders(fact: DataFrame, interactions: Sequence[int], n: int) -> DataFrame:
    """Authors with most interactions of the given types."""
    totals = (
        fact.filter(F.col("id_tipo_interaccion").isin(*interactions))
        .groupBy("id_usuario")
        .agg(F.sum("cant_interacciones").cast("long").alias("total"))
    )
    return top_k(totals, n, F.col("total").desc(), F.col("id_usuario").asc())


def productive_authors(fact: DataFrame, n: int) -> DataFrame:
    return leaders(fact, [PUBLICATION], n)


def influential_authors(fact: DataFrame, n: int) -> DataFrame:
    return leaders(fact, [VIEW, FAVOURITE], n)


def impact_per_publication(fact: DataFrame) -> DataFrame:
    kind = F.col("id_tipo_interaccion")
    sums = fact.groupBy("id_usuario").agg(
        sum_if(kind == PUBLICATION).alias("n_publicaciones"), sum_if(kind.isin(VIEW, FAVOURITE)).alias("impacto")
    )
    return sums.withColumn("impacto_por_publicacion", F.try_divide("impacto", "n_publicaciones"))


def one_hit_authors(fact: DataFrame, quantile: float = 0.5, publications: int = 1) -> DataFrame:
    """Authors with at most ``publications`` publications whose impact is at or above a quantile of all authors."""
    authors = impact_per_publication(fact)
    # exact: authors are counted by impact, and the first impact that reaches the share is the cut
    run = running(authors.groupBy("impacto").agg(F.count("*").alias("_n")), [F.col("impacto").asc()], {"n": F.col("_n")}, None)
    cut = run.filter(F.col("_run_n") >= quantile * F.col("_total_n")).agg(F.min("impacto").alias("cut"))
    few = F.col("n_publicaciones").between(1, publications)
    return authors.filter(few & (F.col("impacto") >= cut.scalar()))


def user_roles(consumption: DataFrame, production: DataFrame) -> DataFrame:
    """Users by what they do: consume, produce or both. Both frames hold ``id_usuario, n``."""
    a = consumption.groupBy("id_usuario").agg(F.sum("n").alias("consumo"))
    b = production.groupBy("id_usuario").agg(F.sum("n").alias("produccion"))
    both = a.join(b, "id_usuario", "full_outer").na.fill(0, ["consumo", "produccion"])
    kind = (
        F.when((F.col("consumo") > 0) & (F.col("produccion") > 0), "mixto")
        .when(F.col("produccion") > 0, "productor")
        .otherwise("consumidor")
    )
    return both.select("id_usuario", F.col("consumo").cast("long").alias("consumo"), F.col("produccion").cast("long").alias("produccion"), kind.alias("perfil"))


def active_consumers(events: DataFrame, n: int, user: str = "id_usuario") -> DataFrame:
    totals = events.filter(F.col(user).isNotNull()).groupBy(user).agg(F.count("*").alias("eventos"))
    return top_k(totals, n, F.col("eventos").desc(), F.col(user).asc())
