"""Write semantics (K)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from scholarmart.operators import writes
from scholarmart.plans.facts import document_deltas, union_all
from scholarmart.suite.registry import query

CUT = "1998-01-01 00:00:00"
DAY = dt.date(2001, 8, 1)


def people(r):
    """Suppliers as the stored table, customers as the new rows: ids overlap in part."""
    stored = r.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("nombre"), F.col("s_nationkey").alias("pais"))
    fresh = r.table("customer").select((F.col("c_custkey") + 50).alias("id"), F.col("c_name").alias("nombre"), F.col("c_nationkey").alias("pais"))
    return stored, fresh


STORED = "(SELECT s_suppkey AS id, s_name AS nombre, s_nationkey AS pais FROM supplier)"
FRESH = "(SELECT c_custkey + 50 AS id, c_name AS nombre, c_nationkey AS pais FROM customer)"


@query("k_1", f"SELECT coalesce(n.id, o.id) AS id, coalesce(n.nombre, o.nombre) AS nombre, coalesce(o.pais, n.pais) AS pais FROM {STORED} o FULL JOIN {FRESH} n ON o.id = n.id")
def k_1(r):
    stored, fresh = people(r)
    return writes.upsert(stored, fresh, ["id"], ["nombre"])  # the country is kept, as it is not on the update list


def split_events(r):
    """Interactions up to a time and those after it, as daily counts."""
    parts = []
    for test in (F.col("created_at") < F.lit(CUT).cast("timestamp"), F.col("created_at") >= F.lit(CUT).cast("timestamp")):
        deltas = document_deltas(r.evento_visualizacion.filter(test), r.favorito.filter(test), r.documento.filter(test))
        parts.append(union_all(deltas.values()))
    return parts


@query("k_2", "SELECT id_documento, id_tipo_interaccion, sum(cant_interacciones)::BIGINT AS cant_interacciones FROM fact_interaccion_documento GROUP BY ALL")
def k_2(r):
    keys = ["id_documento", "id_tipo_interaccion"]
    first, second = [p.groupBy(*keys).agg(F.sum("cant_interacciones").alias("cant_interacciones")) for p in split_events(r)]
    return writes.upsert_add(first, second, keys, ["cant_interacciones"])


@query("k_3", f"SELECT * FROM {STORED} UNION ALL SELECT * FROM {FRESH} n WHERE NOT EXISTS (SELECT 1 FROM {STORED} o WHERE o.id = n.id)")
def k_3(r):
    stored, fresh = people(r)
    return writes.insert_ignore(stored, fresh, ["id"])


@query(
    "k_4",
    """SELECT id_documento, CASE WHEN id_tipo = 4 THEN 'privado' ELSE visibilidad END AS visibilidad, is_deleted OR id_tipo = 5 AS is_deleted,
       CASE WHEN id_tipo = 5 THEN DATE '2001-08-01' ELSE deleted_at END AS deleted_at FROM dim_documento""",
)
def k_4(r):
    hidden = writes.update_where(r.dim_documento, F.col("id_tipo") == 4, {"visibilidad": F.lit("privado")})
    gone = writes.soft_delete(hidden, F.col("id_tipo") == 5, F.lit(DAY))
    return gone.select("id_documento", "visibilidad", "is_deleted", "deleted_at")


@query(
    "k_5",
    """SELECT u.id_usuario, coalesce(c.id_carrera, u.id_carrera) AS id_carrera, coalesce(c.nombre_carrera, u.nombre_carrera) AS nombre_carrera,
       coalesce(c.nombre_escuela, u.nombre_escuela) AS nombre_escuela, u.nombre FROM dim_usuario u
       LEFT JOIN (SELECT DISTINCT id_carrera * 4 AS id_usuario, id_carrera, nombre_carrera, nombre_escuela FROM dim_materia) c ON u.id_usuario = c.id_usuario""",
)
def k_5(r):
    columns = ["id_carrera", "nombre_carrera", "nombre_escuela"]
    moves = r.dim_materia.select((F.col("id_carrera") * 4).cast("long").alias("id_usuario"), *columns)
    return writes.update_from(r.dim_usuario, moves, ["id_usuario"], columns)


@query("k_6", "SELECT * FROM fact_interaccion_documento f WHERE id_documento NOT IN (SELECT id_documento FROM dim_documento WHERE is_deleted)")
def k_6(r):
    gone = r.dim_documento.filter("is_deleted").select("id_documento")
    return writes.purge(r.fact_interaccion_documento, gone, ["id_documento"]).select("fecha", "id_documento", "id_tipo_interaccion", "cant_interacciones")


@query("k_7", "SELECT id_documento, id_usuario FROM documento_autor WHERE id_documento NOT IN (SELECT id FROM documento WHERE deleted_at IS NOT NULL)")
def k_7(r):
    gone = r.documento.filter("deleted_at IS NOT NULL")
    return writes.cascade(r.bridge, gone, "id_documento", "id")


@query(
    "k_7_set_null",
    """SELECT id_documento, CASE WHEN id_usuario NOT IN (SELECT id FROM usuario WHERE rol = 'docente') THEN id_usuario END AS id_usuario, count(*) AS vistas
       FROM evento_visualizacion GROUP BY ALL""",
)
def k_7_set_null(r):
    gone = r.usuario.filter("rol = 'docente'")
    kept = writes.set_null(r.evento_visualizacion, gone, "id_usuario", "id")
    return kept.groupBy("id_documento", "id_usuario").agg(F.count("*").alias("vistas"))


@query("k_8", "SELECT c.id, count(*) AS children FROM carrera c JOIN materia m ON m.id_carrera = c.id WHERE c.id_escuela <> 2 GROUP BY c.id")
def k_8(r):
    return writes.restricted(r.carrera.filter("id_escuela <> 2"), r.materia, "id", "id_carrera")


@query(
    "k_9",
    """SELECT id_documento, visibilidad, CASE WHEN visibilidad <> v THEN DATE '2001-08-01' ELSE fecha_alta END AS updated_at FROM
       (SELECT id_documento, CASE WHEN id_tipo >= 4 THEN 'privado' ELSE visibilidad END AS visibilidad, visibilidad AS v, fecha_alta FROM dim_documento)""",
)
def k_9(r):
    before = r.dim_documento.select("id_documento", "id_tipo", "visibilidad", F.col("fecha_alta").alias("updated_at"))
    after = writes.update_where(before, F.col("id_tipo") >= 4, {"visibilidad": F.lit("privado")})
    return writes.touch_changed(before, after, ["id_documento"], F.lit(DAY)).select("id_documento", "visibilidad", "updated_at")


@query(
    "k_9_upsert",
    f"""SELECT coalesce(n.id, o.id) AS id, coalesce(n.nombre, o.nombre) AS nombre,
        CASE WHEN o.id IS NOT NULL AND n.id IS NOT NULL THEN 1 ELSE 0 END AS cambios FROM {STORED} o FULL JOIN {FRESH} n ON o.id = n.id""",
)
def k_9_upsert(r):
    stored, fresh = [df.select("id", "nombre", F.lit(0).alias("cambios")) for df in people(r)]
    return writes.upsert(stored, fresh, ["id"], ["nombre"], touch=("cambios", F.lit(1)))


@query(
    "k_10",
    """SELECT (SELECT count(*) FROM fact_interaccion_documento) AS hechos_antes,
       (SELECT count(*) FROM fact_interaccion_documento WHERE id_documento NOT IN (SELECT id_documento FROM dim_documento WHERE is_deleted)) AS hechos_despues""",
)
def k_10(r):
    gone = r.dim_documento.filter("is_deleted").select("id_documento")
    after = writes.purge(r.fact_interaccion_documento, gone, ["id_documento"])
    return writes.before_after(r.fact_interaccion_documento, after, F.count("*"), "hechos")
