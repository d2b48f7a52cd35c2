"""Joins (J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scholarmart.operators import joins
from scholarmart.operators.aggregates import regroup
from scholarmart.plans.facts import document_deltas, union_all
from scholarmart.suite.registry import query


@query("j_1", "SELECT * FROM dim_materia")
def j_1(r):
    return joins.flatten_subjects(r.materia, r.carrera, r.escuela)


@query("j_2", "SELECT * FROM dim_usuario")
def j_2(r):
    return joins.flatten_users(r.usuario, r.carrera, r.escuela)


@query("j_3", "SELECT * FROM fact_interaccion_autor WHERE id_tipo_interaccion = 2")
def j_3(r):
    views = document_deltas(r.evento_visualizacion, r.favorito, r.documento)["visualizacion"]
    return joins.credit_authors(views, r.bridge)


@query(
    "j_4",
    """SELECT m.nombre_escuela, td.nombre AS tipo_documento, ti.nombre AS tipo_evento, t.anio, CAST(sum(f.cant_interacciones) AS BIGINT) AS total
       FROM fact_interaccion_documento f JOIN dim_documento d ON f.id_documento = d.id_documento JOIN dim_materia m ON d.id_materia = m.id_materia
       JOIN dim_tipo_documento td ON d.id_tipo = td.id_tipo JOIN dim_tipo_interaccion ti ON f.id_tipo_interaccion = ti.id_tipo_interaccion
       JOIN dim_tiempo t ON f.fecha = t.fecha GROUP BY ALL""",
)
def j_4(r):
    """The fact is added up before every join that its rows are too many for: per document and year, then per subject."""
    keys = ["id_tipo_interaccion", "anio"]
    yearly = joins.star(r.fact_interaccion_documento, (r.dim_tiempo.select("fecha", "anio"), "fecha"))
    yearly = regroup(yearly, ["id_documento", *keys])
    by_subject = joins.star(yearly, (r.dim_documento.select("id_documento", "id_materia", "id_tipo"), "id_documento"))
    full = joins.star(
        regroup(by_subject, ["id_materia", "id_tipo", *keys]),
        (r.dim_materia.select("id_materia", "nombre_escuela"), "id_materia"),
        (r.dim_tipo_documento.withColumnRenamed("nombre", "tipo_documento"), "id_tipo"),
        (r.dim_tipo_interaccion.withColumnRenamed("nombre", "tipo_evento"), "id_tipo_interaccion"),
    )
    return full.groupBy("nombre_escuela", "tipo_documento", "tipo_evento", "anio").agg(F.sum("cant_interacciones").alias("total"))


@query(
    "j_5",
    """SELECT f.id_tipo_interaccion, CAST(sum(f.cant_interacciones) AS BIGINT) AS total FROM fact_interaccion_documento f
       JOIN dim_documento d ON f.id_documento = d.id_documento AND NOT d.is_deleted GROUP BY ALL""",
)
def j_5(r):
    live = r.dim_documento.filter(~F.col("is_deleted")).select("id_documento")
    per_document = regroup(r.fact_interaccion_documento, ["id_documento", "id_tipo_interaccion"])
    return joins.star(per_document, (live, "id_documento")).groupBy("id_tipo_interaccion").agg(F.sum("cant_interacciones").alias("total"))


@query(
    "j_6",
    """WITH grid AS (SELECT anio, mes, n_nationkey AS id_pais, n_name AS pais FROM (SELECT DISTINCT anio, mes FROM dim_tiempo), nation),
       made AS (SELECT c_nationkey AS id_pais, year(o_orderdate) AS anio, month(o_orderdate) AS mes, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
       SELECT grid.anio, grid.mes, grid.pais, coalesce(n, 0) AS pedidos FROM grid LEFT JOIN made USING (id_pais, anio, mes)""",
)
def j_6(r):
    """Every month of the calendar with every nation, also those without orders. Both sides are catalogues."""
    months = r.dim_tiempo.select("anio", "mes").distinct()
    nations = r.table("nation").select(F.col("n_nationkey").alias("id_pais"), F.col("n_name").alias("pais"))
    orders = r.table("orders").join(r.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    made = orders.groupBy(F.col("c_nationkey").alias("id_pais"), F.year("o_orderdate").alias("anio"), F.month("o_orderdate").alias("mes")).agg(F.count("*").alias("n"))
    grid = months.crossJoin(nations).join(made, ["id_pais", "anio", "mes"], "left")
    return grid.select("anio", "mes", "pais", F.coalesce("n", F.lit(0)).alias("pedidos"))


@query(
    "j_7",
    """SELECT p_partkey, n FROM (SELECT p_partkey, unnest(range(1, greatest(p_size - 25, 0) + 1)) AS n FROM part)""",
)
def j_7(r):
    rows = joins.repeat_rows(r.table("part"), F.greatest(F.col("p_size") - 25, F.lit(0)), "n")
    return rows.select("p_partkey", F.col("n").cast("long").alias("n"))


@query("j_8", "SELECT query_texto, score, ranking FROM fact_query_popularity WHERE fecha = (SELECT max(fecha) FROM fact_query_popularity)")
def j_8(r):
    return joins.at_latest(r.fact_query_popularity, "fecha").select("query_texto", "score", "ranking")


@query(
    "j_9",
    """SELECT f.id_documento, (SELECT titulo FROM dim_documento d WHERE d.id_documento = f.id_documento) AS titulo, f.total
       FROM (SELECT id_documento + 5000 AS id_documento, sum(cant_interacciones)::BIGINT AS total FROM fact_interaccion_documento GROUP BY ALL) f""",
)
def j_9(r):
    shifted = r.fact_interaccion_documento.groupBy((F.col("id_documento") + 5000).alias("id_documento")).agg(F.sum("cant_interacciones").alias("total"))
    return joins.lookup(shifted, r.dim_documento, "id_documento", "titulo")


@query(
    "j_10",
    """SELECT (SELECT count(*) FROM dim_materia) AS dim_materia, (SELECT count(*) FROM dim_usuario) AS dim_usuario,
       (SELECT count(*) FROM dim_documento) AS dim_documento, (SELECT count(*) FROM fact_interaccion_documento) AS fact_interaccion_documento,
       (SELECT count(*) FROM fact_interaccion_autor) AS fact_interaccion_autor""",
)
def j_10(r):
    names = ("dim_materia", "dim_usuario", "dim_documento", "fact_interaccion_documento", "fact_interaccion_autor")
    return joins.counts_row({n: getattr(r, n) for n in names})


@query("j_11", "SELECT event_id, user_id FROM events e WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 40)")
def j_11(r):
    events = r.table("events")
    listed = events.filter((F.col("event_type") == "error") & (F.col("value") > 40)).select("user_id").distinct()
    return joins.members(events, listed, ["user_id"]).select("event_id", "user_id")


@query("j_11_anti", "SELECT event_id, user_id FROM events e WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 40)")
def j_11_anti(r):
    events = r.table("events")
    listed = events.filter((F.col("event_type") == "error") & (F.col("value") > 40)).select("user_id").distinct()
    return joins.members(events, listed, ["user_id"], present=False).select("event_id", "user_id")


@query(
    "j_12",
    """SELECT d.id_documento, coalesce(f.n, 0)::BIGINT AS interacciones FROM dim_documento d
       LEFT JOIN (SELECT id_documento, sum(cant_interacciones) AS n FROM fact_interaccion_documento WHERE id_tipo_interaccion IN (2, 3) GROUP BY ALL) f
       ON d.id_documento = f.id_documento WHERE coalesce(f.n, 0) <= 1""",
)
def j_12(r):
    used = union_all(list(document_deltas(r.evento_visualizacion, r.favorito, r.documento).values())[:2])
    return joins.rarely_used(r.dim_documento.select("id_documento"), used, 1)


@query(
    "j_13",
    """SELECT s.event_id AS id_busqueda, v.event_id AS id_vista FROM events s JOIN events v ON s.user_id = v.user_id
       AND v.ts >= s.ts AND v.ts <= s.ts + INTERVAL 60 MINUTE WHERE s.event_type = 'click' AND v.event_type = 'view'""",
)
def j_13(r):
    events = r.table("events")
    searches = events.filter(F.col("event_type") == "click").select("user_id", F.col("event_id").alias("id_busqueda"), F.col("ts").alias("ts_busqueda"))
    views = events.filter(F.col("event_type") == "view").select("user_id", F.col("event_id").alias("id_vista"), F.col("ts").alias("ts_vista"))
    return joins.within_seconds(searches, views, ["user_id"], "ts_busqueda", "ts_vista", 3600).select("id_busqueda", "id_vista")


@query(
    "j_14",
    """SELECT d.id_documento, c.nombre AS carrera FROM dim_documento d JOIN carrera c ON d.id_documento % 25 + 1 = c.id""",
)
def j_14(r):
    mapped = r.dim_documento.select("id_documento", (F.col("id_documento") % 25 + 1).alias("id"))
    return mapped.join(r.carrera, "id").select("id_documento", F.col("nombre").alias("carrera"))


@query(
    "j_15",
    """SELECT t.id_documento, t.total, b.orden, b.id_usuario FROM (
         SELECT id_documento, sum(cant_interacciones)::BIGINT AS total FROM fact_interaccion_documento WHERE id_tipo_interaccion = 2
         GROUP BY ALL ORDER BY total DESC, id_documento LIMIT 10) t JOIN documento_autor b ON t.id_documento = b.id_documento""",
)
def j_15(r):
    views = document_deltas(r.evento_visualizacion, r.favorito, r.documento)["visualizacion"]
    return joins.authors_of_top(views, r.documento_autor, 10)


@query(
    "j_16",
    """SELECT c.id AS id_raiz, md5(c.texto) AS raiz, (SELECT count(*) FROM comentario x WHERE x.id_comentario_padre = c.id AND NOT x.esta_oculto) AS respuestas,
         h.id AS id_respuesta, md5(h.texto) AS respuesta
       FROM comentario c LEFT JOIN (SELECT * FROM comentario WHERE NOT esta_oculto) h ON h.id_comentario_padre = c.id
       WHERE c.id_comentario_padre IS NULL AND NOT c.esta_oculto""",
)
def j_16(r):
    rows = joins.threads(r.comentario)
    return rows.select("id_raiz", F.md5("texto_raiz").alias("raiz"), "respuestas", "id_respuesta", F.md5("texto_respuesta").alias("respuesta"))
