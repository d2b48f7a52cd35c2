"""Mining (M), the distribution of segments (A-15) and the function surface (UDF)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from scholarmart.functions.scalar import round_half_up
from scholarmart.operators import mining
from scholarmart.suite.registry import query, rnd

START, END = dt.date(1996, 1, 1), dt.date(2000, 12, 31)


# The names of the segments, by (many publications, high impact), and of the trends.
SEGMENTS = {(True, True): "Referente", (True, False): "Prolifico sin alcance", (False, True): "Joya oculta", (False, False): "Periferico"}
TRENDS = ("creciente", "decreciente", "estable")


def segments_sql(school: str = "", start: dt.date = START, end: dt.date = END) -> str:
    """Each order is numbered; who comes after the middle of it is in its upper half."""
    names = ", ".join(f"({many}, {high}, '{name}')" for (many, high), name in SEGMENTS.items())
    place = f"WHERE nombre_escuela = '{school}'" if school else ""
    return f"""
    WITH people AS (SELECT id_usuario, nombre AS autor, nombre_escuela FROM dim_usuario {place}),
    by_kind AS (SELECT id_usuario, nombre AS kind, sum(cant_interacciones) AS n FROM fact_interaccion_autor NATURAL JOIN dim_tipo_interaccion
      WHERE fecha >= DATE '{start}' AND fecha <= DATE '{end}' GROUP BY 1, 2),
    sums AS (SELECT id_usuario, CAST(sum(if(kind = 'publicacion', n, 0)) AS BIGINT) AS n_publicaciones,
      CAST(sum(if(kind = 'publicacion', 0, n)) AS BIGINT) AS impacto FROM by_kind SEMI JOIN people USING (id_usuario) GROUP BY 1),
    placed AS (SELECT *, 2 * row_number() OVER (ORDER BY n_publicaciones, id_usuario) > 1 + count(*) OVER () AS many,
      2 * row_number() OVER (ORDER BY impacto, id_usuario) > 1 + count(*) OVER () AS high FROM sums)
    SELECT id_usuario, autor, nombre_escuela, n_publicaciones, impacto, segmento
    FROM placed JOIN (VALUES {names}) s(many, high, segmento) USING (many, high) JOIN people USING (id_usuario)"""


def segments(r, school=None):
    return mining.segment_authors(r.fact_interaccion_autor, r.dim_usuario, r.dim_tipo_interaccion, START, END, school)


@query("m_1", segments_sql())
def m_1(r):
    return segments(r)


@query("m_1_school", segments_sql("EUROPE"))
def m_1_school(r):
    return segments(r, "EUROPE")


@query("a_15", f"SELECT segmento, count(*) AS autores FROM ({segments_sql()}) GROUP BY segmento")
def a_15(r):
    return mining.segment_sizes(segments(r))


def forecast_sql(fact: str, horizon: int = 3, docs: str = "part_doc") -> str:
    """The least-squares line of each document from its sums of x, y, x², xy and y²."""
    up, down, flat = TRENDS
    return f"""
    WITH points AS (SELECT id_documento, 12 * year(fecha) + month(fecha) AS month_no, CAST(sum(cant_interacciones) AS DOUBLE) AS y
      FROM {fact} WHERE id_tipo_interaccion = 2 GROUP BY 1, 2),
    begin_ AS (SELECT id_documento, min(month_no) AS first_no FROM points GROUP BY 1),
    sums AS (SELECT id_documento, count(*) AS k, max(month_no - first_no) AS last, sum(CAST(month_no - first_no AS DOUBLE)) AS sx, sum(y) AS sy,
      sum(CAST(month_no - first_no AS DOUBLE) * (month_no - first_no)) AS sxx, sum((month_no - first_no) * y) AS sxy, sum(y * y) AS syy FROM points JOIN begin_ USING (id_documento) GROUP BY 1),
    spread AS (SELECT *, nullif(k * sxx - sx * sx, 0) AS dx, k * syy - sy * sy AS dy, k * sxy - sx * sy AS dxy FROM sums),
    line AS (SELECT id_documento, k, last, sy / k AS mean, dxy / dx AS b, (sy - dxy / dx * sx) / k AS a,
      if(dx IS NULL, NULL, if(dy = 0, 1.0::DOUBLE, dxy * dxy / (dx * dy))) AS fit FROM spread)
    SELECT id_documento, titulo, k AS meses_con_datos, {rnd('b', 3)} AS pendiente_mensual, {rnd('fit', 3)} AS r2, {rnd('mean', 2)} AS prom_mensual,
           {rnd(f'a + b * (last + {horizon})', 2)} AS proyeccion, if(b > 0.5::DOUBLE, '{up}', if(b < -0.5::DOUBLE, '{down}', '{flat}')) AS tendencia
    FROM line LEFT JOIN (SELECT id_documento, titulo FROM {docs}) USING (id_documento)"""


@query("m_2", forecast_sql("part_fact"))
def m_2(r):
    return mining.forecast(r.part_fact, r.part_doc, r.dim_tipo_interaccion)


@query("m_2_documents", forecast_sql("fact_interaccion_documento", 6, "dim_documento"))
def m_2_documents(r):
    return mining.forecast(r.fact_interaccion_documento, r.dim_documento, r.dim_tipo_interaccion, horizon=6)


@query(
    "m_3",
    f"""SELECT * FROM ({forecast_sql('part_fact')}) WHERE id_documento IN (1, 2, 3)
        UNION ALL SELECT -1, NULL, 0, NULL, NULL, NULL, NULL, 'estable'""",
)
def m_3(r):
    return mining.forecast(r.part_fact, r.part_doc, r.dim_tipo_interaccion, ids=[1, 2, 3, -1])


@query("m_4", f"SELECT * FROM ({segments_sql('ASIA')}) WHERE segmento = 'Referente' ORDER BY impacto DESC, n_publicaciones DESC, id_usuario LIMIT 5")
def m_4(r):
    return mining.referents(segments(r, "ASIA"), 5)


LEADERS = "SELECT id_usuario, sum(cant_interacciones)::BIGINT AS total FROM fact_interaccion_autor WHERE id_tipo_interaccion IN ({}) GROUP BY ALL ORDER BY total DESC, id_usuario LIMIT 10"


@query("m_5", LEADERS.format("1"))
def m_5(r):
    return mining.productive_authors(r.fact_interaccion_autor, 10)


@query("m_5_impact", LEADERS.format("2, 3"))
def m_5_impact(r):
    return mining.influential_authors(r.fact_interaccion_autor, 10)


@query(
    "m_6",
    f"""WITH a AS (SELECT id_usuario, coalesce(sum(cant_interacciones) FILTER (WHERE id_tipo_interaccion = 1), 0)::BIGINT AS n_publicaciones,
          coalesce(sum(cant_interacciones) FILTER (WHERE id_tipo_interaccion IN (2, 3)), 0)::BIGINT AS impacto FROM fact_interaccion_autor GROUP BY ALL)
        SELECT id_usuario, n_publicaciones, impacto, {rnd('impacto / CAST(n_publicaciones AS DOUBLE)', 6)} AS impacto_por_publicacion FROM a
        WHERE n_publicaciones BETWEEN 1 AND 600 AND impacto >= (SELECT quantile_disc(impacto, 0.5) FROM a)""",
)
def m_6(r):
    rows = mining.one_hit_authors(r.fact_interaccion_autor, 0.5, 600)
    return rows.withColumn("impacto_por_publicacion", round_half_up("impacto_por_publicacion", 6))


@query(
    "m_7",
    """WITH c AS (SELECT user_id AS id_usuario, count(*) AS n FROM events WHERE event_type IN ('view', 'purchase') GROUP BY ALL),
            p AS (SELECT id_usuario, count(*) AS n FROM documento_autor GROUP BY ALL)
       SELECT coalesce(c.id_usuario, p.id_usuario) AS id_usuario, coalesce(c.n, 0) AS consumo, coalesce(p.n, 0) AS produccion,
              CASE WHEN c.n > 0 AND p.n > 0 THEN 'mixto' WHEN p.n > 0 THEN 'productor' ELSE 'consumidor' END AS perfil
       FROM c FULL JOIN p ON c.id_usuario = p.id_usuario""",
)
def m_7(r):
    used = r.table("events").filter(F.col("event_type").isin("view", "purchase")).groupBy(F.col("user_id").alias("id_usuario")).agg(F.count("*").alias("n"))
    made = r.bridge.groupBy("id_usuario").agg(F.count("*").alias("n"))
    return mining.user_roles(used, made)


@query("m_8", "SELECT user_id, count(*) AS eventos FROM events WHERE event_type IN ('view', 'purchase') GROUP BY ALL ORDER BY eventos DESC, user_id LIMIT 10")
def m_8(r):
    return mining.active_consumers(r.table("events").filter(F.col("event_type").isin("view", "purchase")), 10, "user_id")


@query("udf_2", f"SELECT segmento, nombre_escuela, count(*) AS autores, sum(impacto)::BIGINT AS impacto FROM ({segments_sql()}) GROUP BY ALL")
def udf_2(r):
    segments(r).createOrReplaceTempView("segmentar_autores")
    return r.spark.sql("SELECT segmento, nombre_escuela, count(*) AS autores, sum(impacto) AS impacto FROM segmentar_autores GROUP BY segmento, nombre_escuela")


@query(
    "udf_3",
    """SELECT id_documento, visibilidad, CASE WHEN visibilidad <> v THEN 1 ELSE 0 END AS toques FROM
       (SELECT id_documento, CASE WHEN id_tipo = 3 THEN 'publico' ELSE visibilidad END AS visibilidad, visibilidad AS v FROM dim_documento)""",
)
def udf_3(r):
    from scholarmart.operators.writes import update_where

    rows = r.dim_documento.select("id_documento", "id_tipo", "visibilidad", F.lit(0).alias("toques"))
    return update_where(rows, F.col("id_tipo") == 3, {"visibilidad": F.lit("publico")}, touch=("toques", F.lit(1))).drop("id_tipo")


