"""Ready-made queries (G)."""

from __future__ import annotations

import datetime as dt


from scholarmart.functions.scalar import round_half_up
from scholarmart.plans import dashboard, metrics
from scholarmart.suite.registry import query, rnd
from scholarmart.suite.selection import AS_OF

TYPES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")

# live documents counted by their two keys; names are looked up for the counts
HEATMAP_SQL = """SELECT nombre_escuela, nombre_carrera, tipo_documento, CAST(sum(n) AS BIGINT) AS cant_publicaciones
    FROM (SELECT id_materia, id_tipo, count(*) FILTER (NOT is_deleted) AS n FROM dim_documento GROUP BY 1, 2)
    JOIN (SELECT id_tipo, nombre AS tipo_documento FROM dim_tipo_documento) USING (id_tipo) JOIN dim_materia USING (id_materia)
    WHERE n > 0 GROUP BY 1, 2, 3"""


@query("g_1", HEATMAP_SQL)
def g_1(r):
    return dashboard.publication_heatmap(r.dim_documento, r.dim_materia, r.dim_tipo_documento)


@query(
    "g_1_pivot",
    "SELECT nombre_escuela, nombre_carrera, "
    + ", ".join(f"coalesce(sum(cant_publicaciones) FILTER (WHERE tipo_documento = '{t}'), 0)::BIGINT AS \"{t}\"" for t in TYPES)
    + f" FROM ({HEATMAP_SQL}) GROUP BY ALL",
)
def g_1_pivot(r):
    return dashboard.publication_matrix(r.dim_documento, r.dim_materia, r.dim_tipo_documento, TYPES)


@query("g_2", "SELECT query_texto, score, ranking FROM fact_query_popularity WHERE fecha = (SELECT max(fecha) FROM fact_query_popularity) ORDER BY ranking LIMIT 20")
def g_2(r):
    return dashboard.latest_top_queries(r.fact_query_popularity)


@query(
    "g_3",
    """SELECT fecha, query_texto, score, ranking, score - lag(score) OVER w AS cambio_score, ranking - lag(ranking) OVER w AS cambio_ranking
       FROM fact_query_popularity WHERE query_texto = 'tema 42' WINDOW w AS (PARTITION BY query_texto ORDER BY fecha)""",
)
def g_3(r):
    return dashboard.query_evolution(r.fact_query_popularity, "tema 42")


@query(
    "g_4",
    """WITH seen AS (SELECT id_usuario, sum(cant_interacciones) AS n FROM fact_interaccion_autor
         WHERE id_tipo_interaccion = (SELECT min(id_tipo_interaccion) FROM dim_tipo_interaccion WHERE nombre = 'visualizacion') GROUP BY 1)
       SELECT nombre AS autor, nombre_escuela, nombre_carrera, CAST(sum(n) AS BIGINT) AS visualizaciones
       FROM dim_usuario JOIN seen USING (id_usuario) GROUP BY 1, 2, 3 ORDER BY 4 DESC, 1, 2, 3 LIMIT 10""",
)
def g_4(r):
    return dashboard.top_authors(r.fact_interaccion_autor, r.dim_usuario)


@query(
    "g_4_by_id",
    """SELECT u.id_usuario, u.nombre AS autor, u.nombre_escuela, u.nombre_carrera, sum(f.cant_interacciones)::BIGINT AS visualizaciones FROM fact_interaccion_autor f
       JOIN dim_usuario u ON f.id_usuario = u.id_usuario WHERE f.id_tipo_interaccion = 2 GROUP BY ALL ORDER BY visualizaciones DESC, u.id_usuario LIMIT 10""",
)
def g_4_by_id(r):
    return dashboard.top_authors(r.fact_interaccion_autor, r.dim_usuario, by_id=True)


@query(
    "g_5",
    """WITH daily AS (SELECT id_documento, id_tipo_interaccion, sum(cant_interacciones) AS n FROM fact_interaccion_documento
         WHERE fecha >= DATE '2001-07-02' GROUP BY 1, 2),
       wide AS (SELECT id_documento, CAST(coalesce(sum(n) FILTER (nombre = 'visualizacion'), 0) AS BIGINT) AS visualizaciones,
         CAST(coalesce(sum(n) FILTER (nombre = 'favorito_agregar'), 0) AS BIGINT) AS favoritos
         FROM daily NATURAL JOIN dim_tipo_interaccion GROUP BY 1)
       SELECT id_documento, titulo, nombre_escuela, nombre_carrera, visualizaciones, favoritos, visualizaciones + favoritos AS total_interacciones
       FROM wide JOIN (SELECT id_documento, titulo, id_materia FROM dim_documento WHERE NOT is_deleted) USING (id_documento)
         JOIN dim_materia USING (id_materia)
       WHERE visualizaciones + favoritos > 0 ORDER BY total_interacciones DESC, id_documento LIMIT 10""",
)
def g_5(r):
    return dashboard.top_documents(r.fact_interaccion_documento, r.dim_documento, r.dim_materia, AS_OF)


@query("g_6", "SELECT sum(cant_interacciones)::BIGINT AS total_interacciones FROM fact_interaccion_documento WHERE fecha BETWEEN DATE '2000-03-01' AND DATE '2000-07-31'")
def g_6(r):
    return dashboard.period_total(r.fact_interaccion_documento, dt.date(2000, 3, 1), dt.date(2000, 7, 31))


@query(
    "g_7",
    """WITH views AS (SELECT id_documento, fecha, sum(cant_interacciones) AS n FROM fact_interaccion_documento
         WHERE id_tipo_interaccion IN (FROM dim_tipo_interaccion SELECT id_tipo_interaccion WHERE nombre = 'visualizacion') GROUP BY 1, 2),
       kinds AS (SELECT id_documento, (SELECT min(k.nombre) FROM dim_tipo_documento k WHERE k.id_tipo = dim_documento.id_tipo) AS tipo_documento FROM dim_documento)
       SELECT tipo_documento, anio, CAST(sum(n) AS BIGINT) AS visualizaciones FROM dim_tiempo JOIN views USING (fecha) JOIN kinds USING (id_documento) GROUP BY 1, 2""",
)
def g_7(r):
    return dashboard.views_by_type_and_year(r.fact_interaccion_documento, r.dim_documento, r.dim_tipo_documento, r.dim_tiempo)


@query(
    "g_8",
    """WITH places AS (SELECT id_documento, nombre_escuela AS escuela FROM dim_materia JOIN dim_documento USING (id_materia) WHERE NOT is_deleted),
       days AS (SELECT fecha, cuatrimestre FROM dim_tiempo WHERE anio = 1999),
       made AS (SELECT id_documento, fecha, sum(cant_interacciones) AS n FROM fact_interaccion_documento NATURAL JOIN dim_tipo_interaccion WHERE nombre = 'publicacion' GROUP BY 1, 2)
       SELECT escuela, cuatrimestre, CAST(sum(n) AS BIGINT) AS total_publicaciones FROM days JOIN made USING (fecha) JOIN places USING (id_documento) GROUP BY 1, 2""",
)
def g_8(r):
    return dashboard.publications_by_term(r.fact_interaccion_documento, r.dim_documento, r.dim_materia, r.dim_tiempo, 1999)


ACTIVITY_SQL = """WITH sums AS (SELECT id_documento, id_tipo_interaccion, CAST(sum(cant_interacciones) AS BIGINT) AS total_interacciones
      FROM fact_interaccion_documento {} GROUP BY 1, 2)
    SELECT id_documento, titulo, tipo_evento, total_interacciones FROM sums
    JOIN (SELECT id_tipo_interaccion, nombre AS tipo_evento FROM dim_tipo_interaccion) USING (id_tipo_interaccion)
    JOIN (SELECT id_documento, titulo FROM dim_documento) USING (id_documento)"""


@query("g_9", ACTIVITY_SQL.format(""))
def g_9(r):
    return dashboard.document_activity(r.fact_interaccion_documento, r.dim_documento, r.dim_tipo_interaccion)


@query("g_9_one", ACTIVITY_SQL.format("WHERE id_documento = 99"))
def g_9_one(r):
    return dashboard.document_activity(r.fact_interaccion_documento, r.dim_documento, r.dim_tipo_interaccion, 99)


@query("g_10", "SELECT CAST(date_trunc('month', fecha) AS DATE) AS mes, sum(cant_interacciones)::BIGINT AS total FROM fact_interaccion_documento GROUP BY ALL")
def g_10(r):
    return metrics.activity_by_month(r.fact_interaccion_documento)


@query(
    "g_10_term",
    """SELECT t.anio, CASE WHEN t.mes BETWEEN 3 AND 7 THEN 1 WHEN t.mes >= 8 THEN 2 ELSE 0 END AS cuatrimestre, sum(f.cant_interacciones)::BIGINT AS total
       FROM fact_interaccion_documento f JOIN dim_tiempo t ON f.fecha = t.fecha GROUP BY ALL""",
)
def g_10_term(r):
    return metrics.activity_by_term(r.fact_interaccion_documento, "academic")


@query("g_10_rhythm", "SELECT CAST(month(fecha_alta) AS INTEGER) AS mes, count(*) AS publicaciones FROM dim_documento GROUP BY ALL")
def g_10_rhythm(r):
    return metrics.publication_rhythm(r.fact_interaccion_documento)


@query(
    "g_11",
    f"""SELECT td.nombre, count(*) AS cantidad, {rnd('count(*) * 100.0::DOUBLE / (SELECT count(*) FROM dim_documento)', 6)} AS porcentaje
        FROM dim_documento d JOIN dim_tipo_documento td ON d.id_tipo = td.id_tipo GROUP BY td.nombre""",
)
def g_11(r):
    return metrics.type_shares(r.dim_documento, r.dim_tipo_documento).withColumn("porcentaje", round_half_up("porcentaje", 6))


@query("g_11_visibility", "SELECT m.nombre_escuela, d.visibilidad, count(*) AS documentos FROM dim_documento d JOIN dim_materia m ON d.id_materia = m.id_materia GROUP BY ALL")
def g_11_visibility(r):
    return metrics.visibility_by_school(r.dim_documento, r.dim_materia)


@query(
    "g_11_subjects",
    """SELECT d.id_materia, count(*) AS documentos, m.nombre_materia FROM dim_documento d JOIN dim_materia m ON d.id_materia = m.id_materia
       GROUP BY ALL ORDER BY documentos DESC, d.id_materia LIMIT 10""",
)
def g_11_subjects(r):
    return metrics.busiest_subjects(r.dim_documento, r.dim_materia, 10)


AGED_SQL = """SELECT d.id_documento, CAST(DATE '2001-08-01' - d.fecha_alta AS INTEGER) AS edad, coalesce(f.v, 0) AS v FROM dim_documento d LEFT JOIN
    (SELECT id_documento, sum(cant_interacciones)::BIGINT AS v FROM fact_interaccion_documento WHERE id_tipo_interaccion = 2 GROUP BY ALL) f ON d.id_documento = f.id_documento"""


@query(
    "g_12",
    f"""SELECT CASE WHEN edad <= 365 THEN 'hasta 1 anio' WHEN edad <= 730 THEN 'hasta 2 anios' WHEN edad <= 1460 THEN 'hasta 4 anios' ELSE 'mas de 4 anios' END AS antiguedad,
        count(*) AS documentos, {rnd('avg(v)', 6)} AS vistas_promedio FROM ({AGED_SQL}) GROUP BY ALL""",
)
def g_12(r):
    rows = metrics.age_and_views(r.dim_documento, r.fact_interaccion_documento, AS_OF)
    return rows.withColumn("vistas_promedio", round_half_up("vistas_promedio", 6))


@query("g_12_corr", f"SELECT {rnd('corr(edad, v)', 6)} AS correlacion FROM ({AGED_SQL})")
def g_12_corr(r):
    return metrics.age_view_correlation(r.dim_documento, r.fact_interaccion_documento, AS_OF).select(round_half_up("correlacion", 6).alias("correlacion"))


@query(
    "g_13",
    f"""SELECT u.nombre_escuela, count(*) AS autores, sum(f.n)::BIGINT AS interacciones, {rnd('avg(f.n)', 6)} AS por_autor FROM
        (SELECT id_usuario, sum(cant_interacciones)::BIGINT AS n FROM fact_interaccion_autor WHERE id_tipo_interaccion IN (2, 3) GROUP BY ALL) f
        JOIN dim_usuario u ON f.id_usuario = u.id_usuario GROUP BY u.nombre_escuela""",
)
def g_13(r):
    rows = metrics.author_engagement_by_school(r.fact_interaccion_autor, r.dim_usuario)
    return rows.withColumn("por_autor", round_half_up("por_autor", 6))


