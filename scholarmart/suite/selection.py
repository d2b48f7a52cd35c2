"""Scans and series (S), filters and projections (F)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from scholarmart.contracts import EMAIL_PATTERN, EPOCH, INT, LONG, WAREHOUSE_TABLES, Contract, struct
from scholarmart.functions.text import html_text
from scholarmart.operators.aggregates import regroup
from scholarmart.operators.joins import counts_row
from scholarmart.operators.quality import matches
from scholarmart.operators.search import scored
from scholarmart.operators.selection import active, between_dates, flag, last_days, optional_equals, search_filters, visible_to
from scholarmart.operators.suggest import popularity_snapshot
from scholarmart.plans.indexing import extract, ingest
from scholarmart.session import scratch_path
from scholarmart.sources import tables, watermarks
from scholarmart.sources.keyvalue import explode_structs, score_snapshot
from scholarmart.suite.registry import query, rnd
from scholarmart.suite.roles import TABLES

MARK, HIGH = "1998-01-01 00:00:00", "1998-06-30 00:00:00"
AS_OF = dt.date(2001, 8, 1)


def stamp(text: str):
    return F.lit(text).cast("timestamp")


@query("s_1", "SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def s_1(r):
    return r.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"))


@query("s_2", "SELECT * FROM dim_tipo_documento")
def s_2(r):
    root, contract = scratch_path(r.spark, "ensure"), WAREHOUSE_TABLES["dim_tipo_documento"]
    tables.ensure_table(r.spark, root, contract)
    tables.append(r.dim_tipo_documento, root, contract)
    return tables.ensure_table(r.spark, root, contract)  # creating it again keeps the rows


@query("s_3", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS filas FROM {n}" for n in sorted(TABLES)))
def s_3(r):
    for name in TABLES:
        r.table(name).createOrReplaceTempView(f"sm_{name}")
    listed = tables.list_tables(r.spark, pattern="sm_*").select(F.expr("substring(table_name, 4)").alias("table_name"))
    wide = counts_row({n: r.table(n) for n in TABLES})
    counts = wide.select(F.inline(F.array(*[F.struct(F.lit(n).alias("table_name"), F.col(n).alias("filas")) for n in TABLES])))
    return listed.join(counts, "table_name").orderBy("table_name")


@query(
    "s_4",
    f"""SELECT id_documento, id_usuario, CAST(created_at AS DATE) AS fecha FROM evento_visualizacion
        WHERE created_at > TIMESTAMP '{MARK}' AND created_at <= TIMESTAMP '{HIGH}'""",
)
def s_4(r):
    rows = tables.read_since(r.evento_visualizacion, "created_at", stamp(MARK), stamp(HIGH))
    return rows.select("id_documento", "id_usuario", F.to_date("created_at").alias("fecha"))


def control(r):
    """A control table as a load of views would have left it."""
    mark = r.evento_visualizacion.agg(F.max("created_at").alias("ultimo_procesado"))
    return mark.select(F.lit("visualizacion").alias("tabla_origen"), "ultimo_procesado", F.col("ultimo_procesado").alias("ultima_corrida"))


def shown(df, *cols):
    return df.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c.startswith("ultim") else F.col(c) for c in cols])


@query(
    "s_5",
    f"""SELECT 'visualizacion' AS tabla_origen, strftime(max(created_at), '%Y-%m-%d %H:%M:%S') AS ultimo_procesado FROM evento_visualizacion
        UNION ALL SELECT 'favorito', '{EPOCH}'""",
)
def s_5(r):
    both = [watermarks.get_watermark(control(r), s).withColumn("tabla_origen", F.lit(s)) for s in ("visualizacion", "favorito")]
    return shown(both[0].unionByName(both[1]), "tabla_origen", "ultimo_procesado")


@query(
    "s_6",
    f"""SELECT 'visualizacion' AS tabla_origen, strftime(max(created_at), '%Y-%m-%d %H:%M:%S') AS ultimo_procesado FROM evento_visualizacion
        UNION ALL SELECT 'vacia', '{MARK}' """,
)
def s_6(r):
    full = watermarks.high_mark(r.evento_visualizacion, "created_at", stamp(MARK)).withColumn("tabla_origen", F.lit("visualizacion"))
    none = watermarks.high_mark(r.evento_visualizacion.filter("id_documento < 0"), "created_at", stamp(MARK)).withColumn("tabla_origen", F.lit("vacia"))
    return shown(full.unionByName(none), "tabla_origen", "ultimo_procesado")


@query(
    "s_7",
    """SELECT 'visualizacion' AS tabla_origen, strftime(max(created_at), '%Y-%m-%d %H:%M:%S') AS ultimo_procesado FROM evento_visualizacion
       UNION ALL SELECT 'favorito', strftime(max(created_at), '%Y-%m-%d %H:%M:%S') FROM favorito
       UNION ALL SELECT 'documento', strftime(max(created_at), '%Y-%m-%d %H:%M:%S') FROM documento""",
)
def s_7(r):
    parts = [
        df.agg(F.max("created_at").alias("ultimo_procesado")).select(
            F.lit(n).alias("tabla_origen"), "ultimo_procesado", F.col("ultimo_procesado").alias("ultima_corrida")
        )
        for n, df in (("visualizacion", r.evento_visualizacion), ("favorito", r.favorito), ("documento", r.documento))
    ]
    marks = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return shown(watermarks.advance(control(r), marks), "tabla_origen", "ultimo_procesado")


@query(
    "s_8",
    """SELECT t.id_tipo_interaccion, t.nombre, CAST(sum(f.cant_interacciones) AS BIGINT) AS cant_interacciones
       FROM fact_interaccion_documento f JOIN dim_tipo_interaccion t ON f.id_tipo_interaccion = t.id_tipo_interaccion GROUP BY ALL""",
)
def s_8(r):
    sums = regroup(r.fact_interaccion_documento, ["id_tipo_interaccion"])
    return sums.join(r.dim_tipo_interaccion, "id_tipo_interaccion").select("id_tipo_interaccion", "nombre", "cant_interacciones")


@query(
    "s_9",
    """SELECT t.fecha, count(d.id_documento) AS documentos FROM dim_tiempo t LEFT JOIN dim_documento d ON t.fecha = d.fecha_alta GROUP BY t.fecha""",
)
def s_9(r):
    born = r.dim_documento.groupBy(F.col("fecha_alta").alias("fecha")).agg(F.count("*").alias("documentos"))
    return r.days.join(born, "fecha", "left").na.fill(0, ["documentos"])


@query(
    "s_10",
    """SELECT m.ord, m.mes, count(d.id_documento) AS documentos
       FROM (SELECT mes, row_number() OVER (ORDER BY mes) AS ord FROM (SELECT DISTINCT CAST(date_trunc('month', fecha) AS DATE) AS mes FROM dim_tiempo)) m
       LEFT JOIN dim_documento d ON CAST(date_trunc('month', d.fecha_alta) AS DATE) = m.mes GROUP BY ALL""",
)
def s_10(r):
    ends = r.days.agg(F.trunc(F.min("fecha"), "MM").alias("a"), F.trunc(F.max("fecha"), "MM").alias("b"))
    months = ends.select(F.posexplode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("pos", "mes"))
    months = months.select("mes", (F.col("pos") + 1).cast("long").alias("ord"))
    born = r.dim_documento.groupBy(F.trunc("fecha_alta", "MM").alias("mes")).agg(F.count("*").alias("documentos"))
    return months.join(born, "mes", "left").na.fill(0, ["documentos"]).select("ord", "mes", "documentos")


@query("s_11", "SELECT query_texto AS member, score FROM popularidad ORDER BY score DESC, query_texto DESC")
def s_11(r):
    return score_snapshot(r.popularidad.withColumnRenamed("query_texto", "member"))


@query("s_12", "SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS linea FROM documents")
def s_12(r):
    path = scratch_path(r.spark, "config")
    lines = F.transform(F.split("text", "\n", -1), lambda s: F.struct(s.alias("linea")))
    nested = F.to_json(F.struct("doc_id", F.struct("lang", lines.alias("lineas")).alias("doc")))
    r.table("documents").select(nested.alias("value")).write.text(path)
    schema = "doc_id long, doc struct<lang: string, lineas: array<struct<linea: string>>>"
    return explode_structs(r.spark.read.schema(schema).json(path), "doc.lineas", "doc_id", "doc.lang")


INGEST_SQL = """SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY page_id) AS id, page_id FROM pages"""


def ingested(r):
    new = r.table("pages").select("page_id", "url", F.lit(1).cast("long").alias("id_uploader"))
    return ingest(new, r.documento, [F.col("page_id").asc()])


@query("s_13", INGEST_SQL)
def s_13(r):
    return ingested(r)[0].select("id", "page_id")


@query("s_13_bridge", f"SELECT id AS id_documento, CAST(1 AS BIGINT) AS id_usuario, CAST(1 AS SMALLINT) AS orden FROM ({INGEST_SQL})")
def s_13_bridge(r):
    return ingested(r)[1]


def html_sql(html: str) -> str:
    out = html
    for pattern, flags in (("(?is)<script[^>]*>.*?</script>", "g"), ("(?is)<style[^>]*>.*?</style>", "g"), ("(?s)<!--.*?-->", "g"), ("(?s)<[^>]*>", "g")):
        out = f"regexp_replace({out}, '{pattern}', ' ', '{flags}')"
    for entity, plain in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{plain}')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


@query("s_14", f"SELECT page_id, length(t) AS n, md5(t) AS huella FROM (SELECT page_id, {html_sql('html')} AS t FROM pages)")
def s_14(r):
    text = r.table("pages").select("page_id", html_text("html").alias("t"))
    return text.select("page_id", F.length("t").cast("long").alias("n"), F.md5("t").alias("huella"))


@query("s_14_title", "SELECT page_id, trim(regexp_replace(replace(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '&amp;', '&'), '\\s+', ' ', 'g')) AS titulo FROM pages")
def s_14_title(r):
    return extract(r.table("pages")).select("page_id", "titulo")


@query("s_15", "SELECT id_tipo, count(*) AS documentos FROM (SELECT id_tipo FROM dim_documento UNION ALL SELECT id_tipo FROM dim_documento) GROUP BY id_tipo")
def s_15(r):
    root, contract = scratch_path(r.spark, "append"), Contract("docs", struct(("id_documento", LONG), ("id_tipo", INT)), ("id_documento",))
    rows = r.dim_documento.select("id_documento", "id_tipo")
    tables.append(rows, root, contract)
    tables.append(rows, root, contract)
    stored = r.spark.read.schema(rows.schema).parquet(f"{root}/docs")
    return stored.groupBy("id_tipo").agg(F.count("*").alias("documentos"))


@query("s_16", "SELECT fecha, query_texto, score, ranking FROM fact_query_popularity WHERE fecha >= DATE '2024-01-16'")
def s_16(r):
    root, name = scratch_path(r.spark, "reload"), "fact_query_popularity"
    rows = r.fact_query_popularity
    tables.reload({name: rows}, root)
    tables.reload({name: rows.filter(F.col("fecha") >= F.lit(dt.date(2024, 1, 16)))}, root)  # nothing of the first load stays
    return r.spark.read.schema(rows.schema).parquet(f"{root}/{name}").select(*rows.columns)


@query(
    "s_17",
    """SELECT fecha, query_texto, score, ranking FROM fact_query_popularity WHERE fecha <> DATE '2024-01-10'
       UNION ALL SELECT DATE '2024-01-10', query_texto, CAST(score AS INTEGER), CAST(ranking AS INTEGER) FROM
       (SELECT *, row_number() OVER (ORDER BY score DESC, query_texto DESC) AS ranking FROM popularidad) WHERE ranking <= 20""",
)
def s_17(r):
    root, contract = scratch_path(r.spark, "day"), WAREHOUSE_TABLES["fact_query_popularity"]
    rows = r.fact_query_popularity
    tables.write_table(rows, root, contract)
    day = popularity_snapshot(r.popularidad, F.lit(dt.date(2024, 1, 10))).withColumn("ranking", F.col("ranking").cast("int"))
    tables.replace_day(day, root, contract)
    return r.spark.read.schema(rows.schema).parquet(f"{root}/{contract.name}").select(*rows.columns)


@query("s_18", "SELECT nombre_escuela, count(*) AS documentos FROM dim_documento d JOIN dim_materia m ON d.id_materia = m.id_materia GROUP BY nombre_escuela")
def s_18(r):
    r.dim_documento.createOrReplaceTempView("bi_dim_documento")
    r.dim_materia.createOrReplaceTempView("bi_dim_materia")
    return r.spark.sql(
        """SELECT nombre_escuela, count(*) AS documentos
           FROM bi_dim_documento d JOIN bi_dim_materia m ON d.id_materia = m.id_materia GROUP BY nombre_escuela"""
    )


# --- filters and projections ---------------------------------------------------


@query("f_1", "SELECT id_tipo, visibilidad, count(*) AS documentos FROM dim_documento WHERE visibilidad IN ('publico', 'interno') AND id_tipo <> 3 GROUP BY ALL")
def f_1(r):
    rows = r.dim_documento.filter(F.col("visibilidad").isin("publico", "interno") & (F.col("id_tipo") != 3))
    return rows.groupBy("id_tipo", "visibilidad").agg(F.count("*").alias("documentos"))


@query("f_2", "SELECT * FROM fact_interaccion_documento WHERE fecha BETWEEN DATE '1999-03-01' AND DATE '1999-07-31'")
def f_2(r):
    return between_dates(r.fact_interaccion_documento, "fecha", dt.date(1999, 3, 1), dt.date(1999, 7, 31))


@query("f_3", "SELECT * FROM fact_interaccion_documento WHERE fecha >= DATE '2001-08-01' - INTERVAL 30 DAY")
def f_3(r):
    return last_days(r.fact_interaccion_documento, "fecha", 30, AS_OF)


@query("f_4", "SELECT id_usuario, nombre, nombre_escuela FROM dim_usuario WHERE nombre_escuela = 'ASIA'")
def f_4(r):
    rows = optional_equals(r.dim_usuario, nombre_escuela="ASIA", id_carrera=None)
    return rows.select("id_usuario", "nombre", "nombre_escuela")


@query("f_5", "SELECT id, titulo FROM documento WHERE deleted_at IS NULL")
def f_5(r):
    return active(r.documento).select("id", "titulo")


@query("f_6", "SELECT id AS id_documento, deleted_at IS NOT NULL AS is_deleted FROM documento")
def f_6(r):
    return r.documento.select(F.col("id").alias("id_documento"), *flag({"is_deleted": F.col("deleted_at").isNotNull()}))


# a query vector in a fixed rule: component i is cos(i)
QUERY_SQL = "list_transform(range(1, 65), lambda i: cos(i))"


def query_vector(dims: int = 64) -> list[float]:
    import math

    return [math.cos(i) for i in range(1, dims + 1)]


COSINE_SQL = f"list_cosine_similarity(CAST(embedding AS DOUBLE[]), {QUERY_SQL})"


@query("f_7", f"SELECT vec_id, {rnd(COSINE_SQL, 6)} AS similitud FROM embeddings WHERE {COSINE_SQL} >= 0.1")
def f_7(r):
    hits = scored(r.table("embeddings"), query_vector()).filter(F.col("similitud") >= 0.1)
    return hits.select("vec_id", (F.round(F.col("similitud").cast("decimal(28,10)"), 6).cast("double") + F.lit(0.0)).alias("similitud"))


@query("f_8", "SELECT id AS id_documento, CAST(created_at AS DATE) AS fecha, 1 AS id_tipo_interaccion, CAST(1 AS BIGINT) AS cant_interacciones FROM documento")
def f_8(r):
    return r.documento.select(
        F.col("id").alias("id_documento"), F.to_date("created_at").alias("fecha"), F.lit(1).alias("id_tipo_interaccion"), F.lit(1).cast("long").alias("cant_interacciones")
    )


@query("f_9", "SELECT id % 128 AS cubo, count(*) AS documentos FROM documento GROUP BY ALL")
def f_9(r):
    return r.documento.groupBy((F.col("id") % 128).alias("cubo")).agg(F.count("*").alias("documentos"))


@query("f_10", f"SELECT id, email, regexp_matches(email, '{EMAIL_PATTERN}', 'i') AS valido FROM usuario")
def f_10(r):
    return r.usuario.select("id", "email", matches("email", EMAIL_PATTERN).alias("valido"))


@query(
    "f_11",
    """WITH activos AS (SELECT * FROM dim_documento WHERE NOT is_deleted), por_materia AS (SELECT id_materia, count(*) AS n FROM activos GROUP BY id_materia)
       SELECT n AS documentos, count(*) AS materias FROM por_materia GROUP BY n""",
)
def f_11(r):
    live = r.dim_documento.filter(~F.col("is_deleted"))
    per_subject = live.groupBy("id_materia").agg(F.count("*").alias("documentos"))
    return per_subject.groupBy("documentos").agg(F.count("*").alias("materias"))


@query(
    "f_12",
    """SELECT d.id_documento, d.titulo FROM dim_documento d JOIN dim_materia m ON d.id_materia = m.id_materia
       WHERE m.id_escuela = 3 AND d.id_tipo = 2 AND d.fecha_alta BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""",
)
def f_12(r):
    rows = search_filters(r.dim_documento, r.dim_materia, school=3, doc_type=2, since=dt.date(1996, 1, 1), until=dt.date(2000, 12, 31))
    return rows.select("id_documento", "titulo")


@query("f_13", "SELECT id_documento, visibilidad FROM dim_documento WHERE visibilidad = 'publico'")
def f_13(r):
    return visible_to(r.dim_documento, "guest").select("id_documento", "visibilidad")


@query(
    "f_13_author",
    """SELECT id_documento, visibilidad FROM dim_documento d WHERE visibilidad IN ('publico', 'interno')
       OR EXISTS (SELECT 1 FROM documento_autor b WHERE b.id_documento = d.id_documento AND b.id_usuario = 7)""",
)
def f_13_author(r):
    return visible_to(r.dim_documento, "author", r.bridge, 7).select("id_documento", "visibilidad")
