"""Column functions (X) and set operations (U)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from scholarmart.functions import scalar, vectors
from scholarmart.functions.text import query_prefixes, search_tokens
from scholarmart.suite.registry import query, rnd
from scholarmart.suite.roles import SENTENCES_SQL, STOP_SQL, tokens_sql
from scholarmart.suite.selection import COSINE_SQL, QUERY_SQL, query_vector


@query("x_1", "SELECT id, CAST(created_at AS DATE) AS alta, CAST(deleted_at AS DATE) AS baja FROM documento")
def x_1(r):
    return r.documento.select("id", scalar.day_of("created_at").alias("alta"), scalar.day_of("deleted_at").alias("baja"))


@query(
    "x_2",
    """SELECT id, CAST(day(created_at) AS SMALLINT) AS dia, CAST(month(created_at) AS SMALLINT) AS mes,
       CAST(CASE WHEN month(created_at) <= 7 THEN 1 ELSE 2 END AS SMALLINT) AS cuatrimestre, CAST(year(created_at) AS SMALLINT) AS anio FROM documento""",
)
def x_2(r):
    return r.documento.select("id", *scalar.date_parts("created_at"))


@query(
    "x_3",
    """SELECT cuatrimestre, academico, count(*) AS dias FROM (SELECT cuatrimestre,
         CASE WHEN mes BETWEEN 3 AND 7 THEN 1 WHEN mes >= 8 THEN 2 ELSE 0 END AS academico FROM dim_tiempo) GROUP BY ALL""",
)
def x_3(r):
    terms = r.days.select(scalar.term("fecha").cast("int").alias("cuatrimestre"), scalar.term("fecha", "academic").cast("int").alias("academico"))
    return terms.groupBy("cuatrimestre", "academico").agg(F.count("*").alias("dias"))


@query("x_4", "SELECT CAST(date_trunc('month', fecha_alta) AS DATE) AS mes, count(*) AS documentos FROM dim_documento GROUP BY ALL")
def x_4(r):
    return r.dim_documento.groupBy(scalar.month_start("fecha_alta").alias("mes")).agg(F.count("*").alias("documentos"))


@query("x_5", "SELECT id_documento, CAST(year(fecha_alta) * 12 + month(fecha_alta) AS INTEGER) AS indice FROM dim_documento")
def x_5(r):
    return r.dim_documento.select("id_documento", scalar.month_index("fecha_alta").alias("indice"))


@query(
    "x_6",
    """SELECT id_documento, CAST(fecha_alta + INTERVAL 14 DAY AS DATE) AS mas_dias, CAST(fecha_alta + INTERVAL 1 MONTH AS DATE) AS mas_mes,
       CAST(fecha_alta - DATE '1995-01-01' AS INTEGER) AS dias FROM dim_documento""",
)
def x_6(r):
    return r.dim_documento.select(
        "id_documento",
        F.date_add("fecha_alta", 14).alias("mas_dias"),
        F.add_months("fecha_alta", 1).alias("mas_mes"),
        scalar.days_between("fecha_alta", F.lit(dt.date(1995, 1, 1))).alias("dias"),
    )


@query("x_7", "SELECT id_documento, CAST(DATE '2001-08-01' - fecha_alta AS INTEGER) AS edad FROM dim_documento")
def x_7(r):
    as_of = dt.date(2001, 8, 1)  # handed in, never read from the clock
    return r.dim_documento.select("id_documento", scalar.days_between(F.lit(as_of), "fecha_alta").alias("edad"))


@query("x_8", "SELECT id, coalesce(id_carrera, 0) AS id_carrera FROM usuario")
def x_8(r):
    return r.usuario.select("id", F.coalesce("id_carrera", F.lit(0)).alias("id_carrera"))


@query(
    "x_9",
    """SELECT CASE WHEN o_totalprice <= 100000 THEN 'bajo' WHEN o_totalprice <= 300000 THEN 'medio' ELSE 'alto' END AS nivel, count(*) AS documentos
       FROM orders GROUP BY ALL""",
)
def x_9(r):
    level = scalar.bucket("o_totalprice", [100000, 300000], ["bajo", "medio", "alto"])
    return r.table("orders").groupBy(level.alias("nivel")).agg(F.count("*").alias("documentos"))


@query("x_10", "SELECT l_orderkey, l_linenumber, l_suppkey, greatest(1.0::DOUBLE, l_quantity - 20) AS repeticiones FROM lineitem")
def x_10(r):
    return r.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.greatest(F.lit(1.0), F.col("l_quantity") - 20).alias("repeticiones"))


@query(
    "x_11",
    f"""SELECT p_partkey, CAST(floor(p_retailprice) AS BIGINT) AS piso, p_partkey % 30 + 1 AS resto,
        CAST(floor(p_retailprice / 7) AS INTEGER) AS entero, {rnd('power(p_size, 1.5::DOUBLE)', 6)} AS potencia FROM part""",
)
def x_11(r):
    return r.table("part").select(
        "p_partkey",
        F.floor("p_retailprice").alias("piso"),
        (F.col("p_partkey") % 30 + 1).alias("resto"),
        F.floor(F.col("p_retailprice") / 7).cast("int").alias("entero"),
        scalar.round_half_up(F.pow("p_size", F.lit(1.5)), 6).alias("potencia"),
    )


@query("x_12", f"SELECT o_orderkey, {rnd('o_totalprice / 7', 2)} AS parte FROM orders")
def x_12(r):
    return r.table("orders").select("o_orderkey", scalar.round_half_up(F.col("o_totalprice") / 7, 2).alias("parte"))


@query("x_13", "SELECT doc_id, 'Título: ' || lang || '-' || doc_id || ' | Abstract: ' || text AS plantilla FROM documents")
def x_13(r):
    title = scalar.label(F.col("lang"), "-", F.col("doc_id"))
    return r.table("documents").select("doc_id", scalar.embedding_text(title, "text").alias("plantilla"))


@query("x_14", "SELECT id_documento, list_value('uno', 'dos', 'tres', 'cuatro', 'cinco')[id_tipo] AS nombre FROM dim_documento")
def x_14(r):
    names = F.array(*[F.lit(n) for n in ("uno", "dos", "tres", "cuatro", "cinco")])
    return r.dim_documento.select("id_documento", F.element_at(names, F.col("id_tipo")).alias("nombre"))


@query("x_15", "SELECT doc_id, md5(text) AS huella FROM documents")
def x_15(r):
    return r.table("documents").select("doc_id", F.md5("text").alias("huella"))


WORDS_SQL = "string_split(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), ' ')"


@query("x_16", f"SELECT doc_id, CAST(len({WORDS_SQL}) AS INTEGER) AS palabras, md5(array_to_string({WORDS_SQL}, ' ')) AS huella FROM documents")
def x_16(r):
    w = scalar.words("text")
    return r.table("documents").select("doc_id", F.size(w).alias("palabras"), F.md5(F.array_join(w, " ")).alias("huella"))


@query("x_17", "SELECT doc_id, CAST(length(text) AS INTEGER) AS letras FROM documents")
def x_17(r):
    return r.table("documents").select("doc_id", F.char_length("text").alias("letras"))


@query("x_18", f"SELECT doc_id, CAST(len(t) AS INTEGER) AS n, md5(array_to_string(t, ' ')) AS huella FROM (SELECT doc_id, {tokens_sql('text')} AS t FROM documents)")
def x_18(r):
    rows = r.table("documents").select("doc_id", search_tokens("text").alias("t"))
    return rows.select("doc_id", F.size("t").alias("n"), F.md5(F.array_join("t", " ")).alias("huella"))


@query("x_19", f"SELECT vec_id, {rnd(COSINE_SQL, 6)} AS similitud FROM embeddings")
def x_19(r):
    sim = vectors.cosine("embedding", vectors.literal_vector(query_vector()))
    return r.table("embeddings").select("vec_id", scalar.round_half_up(sim, 6).alias("similitud"))


# DuckDB measures bytes, so every accented letter is stood in for by one capital; texts are in lower case
PLAIN_SQL = "translate(query_texto, 'áàâäãéèêëíìîïóòôöõúùûüñçß', 'ABCDEFGHIJKLMNOPQRSTUVWXY')"


@query("x_20", f"SELECT query_texto, CAST(levenshtein({PLAIN_SQL}, 'que la') AS INTEGER) AS distancia FROM popularidad WHERE levenshtein({PLAIN_SQL}, 'que la') <= 3")
def x_20(r):
    near = r.popularidad.select("query_texto", F.levenshtein("query_texto", F.lit("que la"), 3).alias("distancia"))
    return near.filter(F.col("distancia") >= 0)


@query("x_21", "SELECT page_id, string_split('https://user' || page_id || ':pw@' || url, '@')[-1] AS url_limpia FROM pages")
def x_21(r):
    full = F.concat(F.lit("https://user"), F.col("page_id").cast("string"), F.lit(":pw@"), F.col("url"))
    return r.table("pages").select("page_id", scalar.mask_credentials(full).alias("url_limpia"))


@query("x_22", "SELECT strftime(ts, '%Y%m%d%H%M') AS minuto, count(*) AS eventos FROM events GROUP BY ALL")
def x_22(r):
    return r.table("events").groupBy(scalar.minute_key("ts").alias("minuto")).agg(F.count("*").alias("eventos"))


# --- set operations --------------------------------------------------------------

# everyone who has to do with a document: its authors, its readers, those who marked it
U1_SQL = """SELECT id_documento, id_usuario FROM documento_autor UNION SELECT id_documento, id_usuario FROM evento_visualizacion
    UNION SELECT id_documento, id_usuario FROM favorito"""


@query("u_1", U1_SQL)
def u_1(r):
    pairs = [f.select("id_documento", "id_usuario") for f in (r.bridge, r.evento_visualizacion, r.favorito)]
    return pairs[0].union(pairs[1]).union(pairs[2]).distinct()


@query(
    "u_2",
    """SELECT id_documento, sum(cant_interacciones)::BIGINT AS total FROM fact_interaccion_documento WHERE id_tipo_interaccion = 2 GROUP BY ALL
       UNION ALL SELECT id_documento, sum(cant_interacciones)::BIGINT FROM part_fact GROUP BY ALL""",
)
def u_2(r):
    docs = r.fact_interaccion_documento.filter("id_tipo_interaccion = 2").groupBy("id_documento").agg(F.sum("cant_interacciones").alias("total"))
    return docs.unionByName(r.part_fact.groupBy("id_documento").agg(F.sum("cant_interacciones").alias("total")))


@query(
    "u_3",
    f"""SELECT doc_id, CAST(len(list_distinct({tokens_sql('text')})) AS INTEGER) AS distintas,
        list_filter({tokens_sql('text')}, lambda x: true)[1] AS primera FROM documents""",
)
def u_3(r):
    rows = r.table("documents").select("doc_id", F.array_distinct(search_tokens("text")).alias("t"))
    return rows.select("doc_id", F.size("t").alias("distintas"), F.get("t", F.lit(0)).alias("primera"))


@query(
    "udf_4",
    f"""SELECT text, CASE WHEN len(w) = 1 THEN text WHEN len(p) = 0 THEN text ELSE array_to_string(p, ' | ') END AS prefijos FROM (
        SELECT text, w, list_transform(list_filter(range(2, len(w) + 1), lambda i: NOT list_contains({STOP_SQL}, w[i])), lambda i: array_to_string(w[1:i], ' ')) AS p
        FROM (SELECT text, string_split(text, ' ') AS w FROM (SELECT unnest({SENTENCES_SQL}) AS text FROM conversations WHERE role = 'user')))""",
)
def udf_4(r):
    return r.raw_queries.select("text", F.array_join(query_prefixes("text"), " | ").alias("prefijos"))


@query(
    "x_19_pairs",
    f"""SELECT a.label, count(*) AS n, {rnd("avg(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), " + QUERY_SQL + "))", 6)} AS media
        FROM embeddings a GROUP BY a.label""",
)
def x_19_pairs(r):
    sim = vectors.cosine("embedding", vectors.literal_vector(query_vector()))
    return r.table("embeddings").groupBy("label").agg(F.count("*").alias("n"), scalar.round_half_up(F.avg(sim), 6).alias("media"))


