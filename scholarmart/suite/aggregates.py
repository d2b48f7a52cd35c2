"""Aggregates (A), windows (W), sorting and limits (L)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from scholarmart.contracts import FAVOURITE, VIEW
from scholarmart.functions.scalar import round_half_up
from scholarmart.operators import access, aggregates, mining, ranking, sketches
from scholarmart.operators.suggest import expand_prefixes
from scholarmart.plans import dashboard, metrics
from scholarmart.session import scratch_path
from scholarmart.suite.registry import query, rnd
from scholarmart.suite.roles import prefixes_sql


@query("a_1", "SELECT * FROM fact_interaccion_documento WHERE id_tipo_interaccion IN (2, 3)")
def a_1(r):
    return aggregates.daily_counts(r.evento_visualizacion, VIEW).unionByName(aggregates.daily_counts(r.favorito, FAVOURITE))


@query("a_2", "SELECT * FROM fact_interaccion_autor")
def a_2(r):
    return r.fact_interaccion_autor


@query("a_3", "SELECT * FROM fact_interaccion_documento WHERE id_tipo_interaccion = 1")
def a_3(r):
    return aggregates.publications(r.documento)


@query(
    "a_4",
    """SELECT f.fecha, d.id_materia, f.id_tipo_interaccion, sum(f.cant_interacciones)::BIGINT AS cant_interacciones
       FROM fact_interaccion_documento f JOIN dim_documento d ON f.id_documento = d.id_documento GROUP BY ALL""",
)
def a_4(r):
    joined = r.fact_interaccion_documento.join(r.dim_documento.select("id_documento", "id_materia"), "id_documento")
    return aggregates.regroup(joined, ["fecha", "id_materia", "id_tipo_interaccion"])


@query(
    "a_5",
    """SELECT sum(cant_interacciones)::BIGINT AS total, coalesce(sum(CASE WHEN fecha > DATE '2099-01-01' THEN cant_interacciones END), 0)::BIGINT AS futuro
       FROM fact_interaccion_documento""",
)
def a_5(r):
    return r.fact_interaccion_documento.agg(
        F.sum("cant_interacciones").alias("total"), aggregates.sum_if(F.col("fecha") > F.lit(dt.date(2099, 1, 1))).alias("futuro")
    )


@query(
    "a_6",
    """SELECT id_usuario, coalesce(sum(cant_interacciones) FILTER (WHERE id_tipo_interaccion = 1), 0)::BIGINT AS publicaciones,
       coalesce(sum(cant_interacciones) FILTER (WHERE id_tipo_interaccion IN (2, 3)), 0)::BIGINT AS impacto FROM fact_interaccion_autor GROUP BY id_usuario""",
)
def a_6(r):
    kind = F.col("id_tipo_interaccion")
    return r.fact_interaccion_autor.groupBy("id_usuario").agg(
        aggregates.sum_if(kind == 1).alias("publicaciones"), aggregates.sum_if(kind.isin(2, 3)).alias("impacto")
    )


@query(
    "a_7",
    """SELECT id_documento, sum(CASE WHEN id_tipo_interaccion = 2 THEN cant_interacciones ELSE 0 END)::BIGINT AS visualizaciones,
       sum(CASE WHEN id_tipo_interaccion = 3 THEN cant_interacciones ELSE 0 END)::BIGINT AS favoritos, sum(cant_interacciones)::BIGINT AS total_interacciones
       FROM fact_interaccion_documento WHERE id_tipo_interaccion IN (2, 3) GROUP BY id_documento""",
)
def a_7(r):
    return aggregates.views_and_favourites(r.fact_interaccion_documento, ["id_documento"])


@query(
    "a_7_pivot",
    """SELECT fecha, coalesce(sum(cant_interacciones) FILTER (WHERE id_tipo_interaccion = 1), 0)::BIGINT AS "1",
       coalesce(sum(cant_interacciones) FILTER (WHERE id_tipo_interaccion = 2), 0)::BIGINT AS "2",
       coalesce(sum(cant_interacciones) FILTER (WHERE id_tipo_interaccion = 3), 0)::BIGINT AS "3" FROM fact_interaccion_documento GROUP BY fecha""",
)
def a_7_pivot(r):
    return aggregates.pivot_sum(r.fact_interaccion_documento, ["fecha"], "id_tipo_interaccion", [1, 2, 3], "cant_interacciones")


@query("a_8", "SELECT id_tipo, visibilidad, is_deleted, count(*) AS documentos FROM dim_documento GROUP BY ALL")
def a_8(r):
    return r.dim_documento.groupBy("id_tipo", "visibilidad", "is_deleted").agg(F.count("*").alias("documentos"))


@query("a_9", "SELECT id_documento, CAST(date_trunc('month', fecha) AS DATE) AS mes, sum(cant_interacciones)::BIGINT AS total FROM part_fact GROUP BY ALL")
def a_9(r):
    return aggregates.monthly_series(r.part_fact, ["id_documento"])


SERIES_SQL = """SELECT id_documento, i - min(i) OVER (PARTITION BY id_documento) AS m, total FROM (
    SELECT id_documento, CAST(year(fecha) * 12 + month(fecha) AS INTEGER) AS i, sum(cant_interacciones)::BIGINT AS total FROM part_fact GROUP BY ALL)"""


@query(
    "a_10",
    f"""SELECT id_documento, {rnd('CASE WHEN count(*) < 2 THEN NULL ELSE regr_slope(total, m) END', 5)} AS pendiente,
        {rnd('CASE WHEN count(*) < 2 THEN NULL ELSE regr_intercept(total, m) END', 5)} AS ordenada,
        {rnd('CASE WHEN count(*) < 2 THEN NULL ELSE regr_r2(total, m) END', 5)} AS r2 FROM ({SERIES_SQL}) GROUP BY id_documento""",
)
def a_10(r):
    series = mining.view_series(r.part_fact, r.dim_tipo_interaccion)
    return series.groupBy("id_documento").agg(
        round_half_up(F.regr_slope("total", "m"), 5).alias("pendiente"),
        round_half_up(F.regr_intercept("total", "m"), 5).alias("ordenada"),
        round_half_up(F.regr_r2("total", "m"), 5).alias("r2"),
    )


@query(
    "a_11",
    f"""SELECT id_documento, count(*) AS n, max(cant_interacciones) AS mayor, min(cant_interacciones) AS menor, {rnd('avg(cant_interacciones)', 6)} AS media
        FROM fact_interaccion_documento GROUP BY id_documento""",
)
def a_11(r):
    return r.fact_interaccion_documento.groupBy("id_documento").agg(
        F.count("*").alias("n"),
        F.max("cant_interacciones").alias("mayor"),
        F.min("cant_interacciones").alias("menor"),
        round_half_up(F.avg("cant_interacciones"), 6).alias("media"),
    )


@query("a_12", "SELECT DISTINCT id_carrera, nombre_carrera, nombre_escuela FROM dim_materia")
def a_12(r):
    return r.dim_materia.select("id_carrera", "nombre_carrera", "nombre_escuela").distinct()


@query("a_13", "SELECT CAST(ts AS DATE) AS fecha, user_id, event_type, count(*) AS cantidad FROM events GROUP BY ALL")
def a_13(r):
    return r.table("events").groupBy(F.to_date("ts").alias("fecha"), "user_id", "event_type").agg(F.count("*").alias("cantidad"))


@query("a_14", f"SELECT query_texto, sum(score)::BIGINT AS score FROM ({prefixes_sql('raw_queries')}) GROUP BY query_texto")
def a_14(r):
    return aggregates.prefix_scores(expand_prefixes(r.raw_queries))


@query(
    "a_16",
    f"SELECT id_tipo, count(*) AS cantidad, {rnd('count(*) * 100.0::DOUBLE / (SELECT count(*) FROM dim_documento)', 6)} AS porcentaje FROM dim_documento GROUP BY id_tipo",
)
def a_16(r):
    return aggregates.share_of_total(r.dim_documento, ["id_tipo"]).withColumn("porcentaje", round_half_up("porcentaje", 6))


@query(
    "a_17",
    f"""SELECT id_documento, vistas, favoritos, {rnd('CASE WHEN vistas = 0 THEN NULL ELSE favoritos / CAST(vistas AS DOUBLE) END', 6)} AS ratio FROM (
        SELECT id_documento, coalesce(sum(cant_interacciones) FILTER (WHERE id_tipo_interaccion = 2), 0)::BIGINT AS vistas,
               coalesce(sum(cant_interacciones) FILTER (WHERE id_tipo_interaccion = 3), 0)::BIGINT AS favoritos FROM fact_interaccion_documento GROUP BY ALL)""",
)
def a_17(r):
    return metrics.engagement(r.fact_interaccion_documento).withColumn("ratio", round_half_up("ratio", 6))


@query(
    "a_18",
    f"""SELECT m.nombre_carrera, count(*) AS documentos, {rnd('avg(CAST(d.is_deleted AS INTEGER)) * 100', 6)} AS tasa_eliminacion
        FROM dim_documento d JOIN dim_materia m ON d.id_materia = m.id_materia GROUP BY m.nombre_carrera""",
)
def a_18(r):
    return metrics.deletion_rate(r.dim_documento, r.dim_materia).withColumn("tasa_eliminacion", round_half_up("tasa_eliminacion", 6))


@query(
    "a_19",
    """SELECT m.nombre_carrera, count(DISTINCT d.id_tipo) AS tipos FROM dim_documento d JOIN dim_materia m ON d.id_materia = m.id_materia GROUP BY m.nombre_carrera""",
)
def a_19(r):
    return metrics.type_diversity(r.dim_documento, r.dim_materia)


@query(
    "a_19_approx",
    """SELECT m.nombre_carrera, count(DISTINCT d.id_tipo) AS tipos FROM dim_documento d JOIN dim_materia m ON d.id_materia = m.id_materia GROUP BY m.nombre_carrera""",
)
def a_19_approx(r):
    return metrics.type_diversity(r.dim_documento, r.dim_materia, approximate=True)


@query(
    "a_19_sketch",
    """SELECT event_type, CAST(date_trunc('month', ts) AS DATE) AS mes, count(DISTINCT CAST(ts AS DATE)) AS dias, count(DISTINCT user_id) AS usuarios, true AS dentro FROM events GROUP BY ALL""",
)
def a_19_sketch(r):
    """Users per kind and month by merging stored daily sketches, held against the exact count: within five standard errors."""
    path, events = scratch_path(r.spark, "sketches"), r.table("events")
    sketches.daily_sketches(events, ["event_type"], F.to_date("ts"), "user_id").write.parquet(path)
    daily = r.spark.read.parquet(path).withColumn("mes", F.trunc("fecha", "month"))
    days = daily.groupBy("event_type", "mes").agg(F.count("*").alias("dias"))
    found = sketches.merged_distinct(daily, ["event_type", "mes"], "estimado").join(days, ["event_type", "mes"])
    exact = events.groupBy("event_type", F.to_date(F.date_trunc("month", "ts")).alias("mes")).agg(F.countDistinct("user_id").alias("usuarios"))
    near = F.abs(F.col("estimado") - F.col("usuarios")) <= F.lit(5 * sketches.relative_error()) * F.col("usuarios")
    return exact.join(found, ["event_type", "mes"], "left").select("event_type", "mes", "dias", "usuarios", F.coalesce(near, F.lit(False)).alias("dentro"))


@query("a_20", "SELECT CAST(hour(ts) AS INTEGER) AS hora, count(*) AS eventos FROM events GROUP BY ALL")
def a_20(r):
    return metrics.activity_by_hour(r.table("events"))


@query(
    "a_21",
    f"""SELECT query_texto, count(*) AS busquedas, {rnd('avg(CAST(hizo_click AS INTEGER)) * 100', 6)} AS tasa_click,
        {rnd('avg(CAST(cant_resultados = 0 AS INTEGER)) * 100', 6)} AS tasa_sin_resultados FROM busqueda GROUP BY query_texto""",
)
def a_21(r):
    rows = metrics.search_quality(r.busqueda)
    return rows.withColumns({c: round_half_up(c, 6) for c in ("tasa_click", "tasa_sin_resultados")})


@query("a_21_favourites", "SELECT id_documento, count(*) AS guardado_por FROM favorito GROUP BY id_documento")
def a_21_favourites(r):
    return metrics.favourites_counter(r.favorito)


# --- windows ---------------------------------------------------------------------


@query(
    "w_1",
    """SELECT id_usuario, impacto, CAST(ntile(2) OVER (ORDER BY impacto, id_usuario) AS INTEGER) AS mitad, CAST(ntile(7) OVER (ORDER BY impacto, id_usuario) AS INTEGER) AS septil
       FROM (SELECT id_usuario, sum(cant_interacciones)::BIGINT AS impacto FROM fact_interaccion_autor WHERE id_tipo_interaccion IN (2, 3) GROUP BY ALL)""",
)
def w_1(r):
    rows = r.fact_interaccion_autor.filter("id_tipo_interaccion IN (2, 3)").groupBy("id_usuario").agg(F.sum("cant_interacciones").alias("impacto"))
    return ranking.ntile_by_counts(rows, {"mitad": ("impacto", 2), "septil": ("impacto", 7)}, "id_usuario")


@query(
    "w_1_ties",
    """SELECT event_id, hora, CAST(ntile(10) OVER (ORDER BY hora, event_id) AS INTEGER) AS decil, CAST(ntile(3) OVER (ORDER BY largo, event_id) AS INTEGER) AS tercio
       FROM (SELECT event_id, CAST(hour(ts) AS INTEGER) AS hora, length(event_type) AS largo FROM events)""",
)
def w_1_ties(r):
    """Few distinct values, each with many rows."""
    rows = r.table("events").select("event_id", F.hour("ts").alias("hora"), F.char_length("event_type").alias("largo"))
    return ranking.ntile_by_counts(rows, {"decil": ("hora", 10), "tercio": ("largo", 3)}, "event_id").drop("largo")


@query("w_3_hot", "SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) AS posicion FROM events")
def w_3_hot(r):
    """Places within a few large groups, each spread over many tasks."""
    rows = r.table("events").select("event_id", "event_type", "ts")
    return ranking.spread_rank(rows, ["event_type"], [F.col("ts").desc(), F.col("event_id").asc()]).drop("ts")


@query("l_4_keyset", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 25 OFFSET 50")
def l_4_keyset(r):
    """The third page, reached by the last rows of the two before it."""
    order, after = {"o_orderdate": True, "o_orderkey": False}, None
    rows = r.table("orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    for _ in range(2):
        after = ranking.last_of(ranking.page_after(rows, 25, order, after), order)
    return ranking.page_after(rows, 25, order, after)


@query("w_2", SERIES_SQL)
def w_2(r):
    return mining.view_series(r.part_fact, r.dim_tipo_interaccion)


@query(
    "w_3",
    """SELECT fecha, query_texto, score, CAST(row_number() OVER (PARTITION BY fecha ORDER BY score DESC, query_texto) AS INTEGER) AS ranking FROM
       (SELECT CAST(created_at AS DATE) AS fecha, query_texto, count(*) AS score FROM busqueda GROUP BY ALL)""",
)
def w_3(r):
    counts = r.busqueda.groupBy(F.to_date("created_at").alias("fecha"), "query_texto").agg(F.count("*").alias("score"))
    return ranking.rank_within(counts, ["fecha"], [F.col("score").desc(), F.col("query_texto").asc()], "ranking")


@query(
    "w_4",
    """SELECT query_texto, score, CAST(row_number() OVER (ORDER BY score DESC, query_texto DESC) AS INTEGER) AS ranking FROM popularidad
       ORDER BY score DESC, query_texto DESC LIMIT 20""",
)
def w_4(r):
    return ranking.numbered_top_k(r.popularidad, 20, [F.col("score").desc(), F.col("query_texto").desc()], "ranking")


@query("w_4_global", "SELECT query_texto, score, row_number() OVER (ORDER BY score DESC, query_texto DESC) AS ranking FROM popularidad")
def w_4_global(r):
    return ranking.global_row_number(r.popularidad, [F.col("score").desc(), F.col("query_texto").desc()], "ranking")


@query(
    "w_5",
    """SELECT fecha, query_texto, score, ranking, score - lag(score) OVER w AS cambio_score, ranking - lag(ranking) OVER w AS cambio_ranking
       FROM fact_query_popularity WINDOW w AS (PARTITION BY query_texto ORDER BY fecha)""",
)
def w_5(r):
    return dashboard.query_evolution(r.fact_query_popularity)


@query(
    "w_6",
    f"""SELECT id_usuario, impacto, row_number() OVER o AS posicion, {rnd('sum(impacto) OVER o / CAST(sum(impacto) OVER () AS DOUBLE)', 6)} AS share_acumulado FROM
        (SELECT id_usuario, sum(cant_interacciones)::BIGINT AS impacto FROM fact_interaccion_autor WHERE id_tipo_interaccion = 2 GROUP BY ALL)
        WINDOW o AS (ORDER BY impacto DESC, id_usuario ROWS UNBOUNDED PRECEDING)""",
)
def w_6(r):
    rows = r.fact_interaccion_autor.filter("id_tipo_interaccion = 2").groupBy("id_usuario").agg(F.sum("cant_interacciones").alias("impacto"))
    return ranking.cumulative_share(rows, "impacto", "id_usuario").withColumn("share_acumulado", round_half_up("share_acumulado", 6))


@query(
    "w_7",
    """SELECT nombre_escuela, consumo, rank() OVER (ORDER BY consumo DESC) AS puesto FROM (
         SELECT m.nombre_escuela, sum(f.cant_interacciones)::BIGINT AS consumo FROM fact_interaccion_documento f JOIN dim_documento d ON f.id_documento = d.id_documento
         JOIN dim_materia m ON d.id_materia = m.id_materia WHERE f.id_tipo_interaccion IN (2, 3) GROUP BY ALL)""",
)
def w_7(r):
    return metrics.school_consumption(r.fact_interaccion_documento, r.dim_documento, r.dim_materia)


@query(
    "w_8",
    """WITH e AS (SELECT *, ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 12 HOUR AS brk FROM events),
            s AS (SELECT *, sum(CASE WHEN brk THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM e),
            t AS (SELECT min(CASE WHEN event_type = 'click' THEN ts END) AS t0, min(CASE WHEN event_type = 'view' THEN ts END) AS t1,
                         min(CASE WHEN event_type = 'purchase' THEN ts END) AS t2 FROM s GROUP BY user_id, sid)
       SELECT count(*) AS sesiones, count(t0) AS paso_1, count(CASE WHEN t1 > t0 THEN 1 END) AS paso_2, count(CASE WHEN t1 > t0 AND t2 > t1 THEN 1 END) AS paso_3 FROM t""",
)
def w_8(r):
    return access.funnel(r.table("events"), ["click", "view", "purchase"], "12 hours")


@query(
    "w_8_steps",
    """SELECT event_type AS paso, siguiente, count(*) AS veces FROM (
         SELECT event_type, lead(event_type) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS siguiente FROM events)
       WHERE siguiente IS NOT NULL GROUP BY ALL""",
)
def w_8_steps(r):
    return access.transitions(r.table("events").withColumn("dia", F.to_date("ts")), ["user_id", "dia"])


# --- order and limits --------------------------------------------------------------


@query("l_1", "SELECT id_documento, deleted_at, fecha_alta FROM dim_documento ORDER BY deleted_at DESC NULLS FIRST, fecha_alta ASC, id_documento")
def l_1(r):
    return r.dim_documento.select("id_documento", "deleted_at", "fecha_alta").orderBy(
        F.col("deleted_at").desc_nulls_first(), F.col("fecha_alta").asc_nulls_last(), "id_documento"
    )


@query(
    "l_2",
    """SELECT id_documento, sum(cant_interacciones)::BIGINT AS total FROM fact_interaccion_documento GROUP BY id_documento ORDER BY total DESC, id_documento LIMIT 10""",
)
def l_2(r):
    totals = r.fact_interaccion_documento.groupBy("id_documento").agg(F.sum("cant_interacciones").alias("total"))
    return ranking.top_k(totals, 10, F.col("total").desc(), F.col("id_documento").asc())


@query("l_3", "SELECT query_texto, score FROM popularidad ORDER BY score DESC, query_texto DESC LIMIT 20")
def l_3(r):
    return ranking.top_k(r.popularidad, 20, F.col("score").desc(), F.col("query_texto").desc())


@query(
    "l_4",
    """SELECT id_documento, titulo, fecha_alta, CAST(row_number() OVER (ORDER BY fecha_alta DESC, id_documento) AS INTEGER) AS posicion
       FROM dim_documento WHERE NOT is_deleted ORDER BY fecha_alta DESC, id_documento LIMIT 10 OFFSET 20""",
)
def l_4(r):
    live = r.dim_documento.filter(~F.col("is_deleted")).select("id_documento", "titulo", "fecha_alta")
    return ranking.page(live, 3, 10, [F.col("fecha_alta").desc(), F.col("id_documento").asc()])


