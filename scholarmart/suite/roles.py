"""The given tables in the roles of the model: as DataFrames and as SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmart.contracts import INT, LONG, TEXT, TS
from scholarmart.functions.text import STOP_WORDS, search_tokens, sentences
from scholarmart.operators.joins import flatten_subjects, flatten_users
from scholarmart.operators.ranking import rank_within, top_k_per_group
from scholarmart.operators.suggest import popularity
from scholarmart.plans.dims import calendar, document_dim, interaction_types, type_dim
from scholarmart.plans.facts import author_fact, document_fact
from scholarmart.session import tasks_for

DBL = T.DoubleType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


# Schemas of the given tables; scans never infer them.
TABLES = {
    "region": _table(r_regionkey=INT, r_name=TEXT),
    "nation": _table(n_nationkey=INT, n_name=TEXT, n_regionkey=INT),
    "customer": _table(c_custkey=LONG, c_name=TEXT, c_nationkey=INT, c_acctbal=DBL, c_mktsegment=TEXT),
    "supplier": _table(s_suppkey=LONG, s_name=TEXT, s_nationkey=INT, s_acctbal=DBL),
    "part": _table(p_partkey=LONG, p_name=TEXT, p_brand=TEXT, p_type=TEXT, p_size=INT, p_retailprice=DBL),
    "orders": _table(o_orderkey=LONG, o_custkey=LONG, o_orderstatus=TEXT, o_totalprice=DBL, o_orderdate=TS, o_orderpriority=TEXT),
    "lineitem": _table(
        l_orderkey=LONG, l_partkey=LONG, l_suppkey=LONG, l_linenumber=INT, l_quantity=DBL, l_extendedprice=DBL,
        l_discount=DBL, l_tax=DBL, l_returnflag=TEXT, l_linestatus=TEXT, l_shipdate=TS,
    ),
    "events": _table(event_id=LONG, ts=TS, user_id=LONG, event_type=TEXT, value=DBL, props=TEXT),
    "documents": _table(doc_id=LONG, text=TEXT, lang=TEXT, source=TEXT, n_chars=LONG),
    "embeddings": _table(vec_id=LONG, embedding=T.ArrayType(T.FloatType()), label=INT),
    "pages": _table(page_id=LONG, url=TEXT, html=TEXT),
    "benchmark": _table(item_id=LONG, text=TEXT),
    "labels": _table(doc_id=LONG, quality=INT, toxic=INT),
    "conversations": _table(conv_id=LONG, turn=LONG, role=TEXT, text=TEXT),
}

STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
SENTENCES_SQL = (
    "list_filter(list_transform(string_split_regex(lower(text), '[.!?\\n]+'), "
    "lambda p: trim(regexp_replace(p, '\\s+', ' ', 'g'))), lambda p: p <> '')"
)


def prefixes_sql(source: str) -> str:
    """SQL of the sub-queries of ``source(text, score)``."""
    return f"""
      SELECT unnest(CASE WHEN len(w) = 1 THEN w WHEN len(p) = 0 THEN [array_to_string(w, ' ')] ELSE p END) AS query_texto, score
      FROM (SELECT *, list_transform(list_filter(range(2, len(w) + 1), lambda i: NOT list_contains({STOP_SQL}, w[i])),
                                     lambda i: array_to_string(w[1:i], ' ')) AS p
            FROM (SELECT string_split(text, ' ') AS w, score FROM {source}))"""


def tokens_sql(text: str) -> str:
    """SQL of the normalised search tokens of a text expression."""
    return f"""list_filter(list_transform(string_split_regex(
        translate(lower(coalesce({text}, '')), 'áàâäãéèêëíìîïóòôöõúùûüñç', 'aaaaaeeeeiiiiooooouuuunc'), '[^\\p{{L}}\\p{{N}}]+'),
        lambda w: CASE WHEN length(w) > 4 THEN regexp_replace(w, '(es|s)$', '') ELSE w END),
        lambda w: w <> '' AND NOT list_contains({STOP_SQL}, w))"""


ROLE_SQL = {
    "escuela": "SELECT r_regionkey + 1 AS id, r_name AS nombre FROM region",
    "carrera": "SELECT n_nationkey + 1 AS id, n_regionkey + 1 AS id_escuela, n_name AS nombre FROM nation",
    "materia": "SELECT c_custkey AS id, c_nationkey + 1 AS id_carrera, c_name AS nombre FROM customer",
    "usuario": """SELECT s_suppkey + 1 AS id, replace(lower(s_name), '#', '.') || '@campus.edu' AS email, s_name AS nombre,
                  CASE WHEN s_acctbal >= 5000 THEN 'docente' ELSE 'estudiante' END AS rol,
                  CASE WHEN s_nationkey < 20 THEN s_nationkey + 1 END AS id_carrera FROM supplier""",
    "tipo_documento": "SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS id, o_orderpriority AS nombre FROM orders",
    "documento": """SELECT o_orderkey AS id, 'Documento ' || o_orderkey AS titulo,
                    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS id_tipo, o_custkey AS id_materia,
                    CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'publico'
                         WHEN substr(o_orderpriority, 1, 1) IN ('3', '4') THEN 'interno' ELSE 'privado' END AS visibilidad,
                    CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 30 DAY END AS deleted_at,
                    o_orderdate AS created_at FROM orders""",
    "documento_autor": """SELECT l_orderkey AS id_documento, l_suppkey + 1 AS id_usuario,
                          CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY min(l_linenumber), l_suppkey) AS INTEGER) AS orden
                          FROM lineitem GROUP BY l_orderkey, l_suppkey""",
    "evento_visualizacion": "SELECT l_orderkey AS id_documento, l_suppkey + 1 AS id_usuario, l_shipdate AS created_at FROM lineitem WHERE l_returnflag = 'N'",
    "favorito": "SELECT l_orderkey AS id_documento, l_suppkey + 1 AS id_usuario, l_shipdate AS created_at FROM lineitem WHERE l_returnflag = 'R'",
    # the hierarchy straight from the given tables: customer, nation, region
    "dim_materia": """SELECT c_custkey AS id_materia, c_name AS nombre_materia, n_nationkey + 1 AS id_carrera, n_name AS nombre_carrera,
                      n_regionkey + 1 AS id_escuela, r_name AS nombre_escuela
                      FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey""",
    # suppliers of the first 20 nations have a place there; 'Sin Carrera' and 'Sin Escuela' are fixed values
    "dim_usuario": """SELECT id_usuario, nombre, coalesce(place.id_carrera, 0) AS id_carrera, coalesce(nombre_carrera, 'Sin Carrera') AS nombre_carrera,
                      coalesce(nombre_escuela, 'Sin Escuela') AS nombre_escuela
                      FROM (SELECT s_suppkey + 1 AS id_usuario, s_name AS nombre, s_nationkey + 1 AS id_carrera FROM supplier)
                      LEFT JOIN (SELECT DISTINCT id_carrera, nombre_carrera, nombre_escuela FROM dim_materia WHERE id_carrera <= 20) place USING (id_carrera)""",
    "dim_tipo_documento": "SELECT id AS id_tipo, nombre FROM tipo_documento",
    "dim_documento": """SELECT id AS id_documento, id_tipo, id_materia, titulo, CAST(created_at AS DATE) AS fecha_alta, visibilidad,
                        deleted_at IS NOT NULL AS is_deleted, CAST(deleted_at AS DATE) AS deleted_at FROM documento""",
    "dim_tipo_interaccion": "SELECT * FROM (VALUES (1, 'publicacion'), (2, 'visualizacion'), (3, 'favorito_agregar')) t(id_tipo_interaccion, nombre)",
    "dim_tiempo": """SELECT fecha, CAST(day(fecha) AS INTEGER) AS dia, CAST(month(fecha) AS INTEGER) AS mes,
                     CASE WHEN month(fecha) <= 7 THEN 1 ELSE 2 END AS cuatrimestre, CAST(year(fecha) AS INTEGER) AS anio
                     FROM (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS fecha
                           FROM (SELECT min(l_shipdate) AS d FROM lineitem UNION ALL SELECT max(l_shipdate) FROM lineitem
                                 UNION ALL SELECT min(o_orderdate) FROM orders UNION ALL SELECT max(o_orderdate) FROM orders))""",
    "fact_interaccion_documento": """
        SELECT CAST(created_at AS DATE) AS fecha, id_documento, 2 AS id_tipo_interaccion, count(*) AS cant_interacciones
        FROM evento_visualizacion GROUP BY ALL
        UNION ALL SELECT CAST(created_at AS DATE), id_documento, 3, count(*) FROM favorito GROUP BY ALL
        UNION ALL SELECT CAST(created_at AS DATE), id, 1, 1 FROM documento""",
    "fact_interaccion_autor": """
        SELECT f.fecha, b.id_usuario, f.id_tipo_interaccion, CAST(sum(f.cant_interacciones) AS BIGINT) AS cant_interacciones
        FROM fact_interaccion_documento f JOIN documento_autor b ON f.id_documento = b.id_documento GROUP BY ALL""",
    "fact_query_popularity": """
        SELECT fecha, query_texto, CAST(score AS INTEGER) AS score, CAST(ranking AS INTEGER) AS ranking
        FROM (SELECT *, row_number() OVER (PARTITION BY fecha ORDER BY score DESC, query_texto DESC) AS ranking
              FROM (SELECT CAST(created_at AS DATE) AS fecha, query_texto, count(*) AS score FROM busqueda GROUP BY ALL))
        WHERE ranking <= 20""",
    "busqueda": """SELECT event_id AS id, user_id AS id_usuario, 'tema ' || json_extract_string(props, '$.k') AS query_texto,
                   CAST(floor(value) AS INTEGER) AS cant_resultados, event_type = 'click' AS hizo_click,
                   md5(CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d')) AS session_hash, ts AS created_at FROM events""",
    "comentario": """SELECT conv_id * 1000 + turn AS id, CASE WHEN turn > 0 THEN conv_id * 1000 END AS id_comentario_padre,
                     text AS texto, role = 'system' AS esta_oculto FROM conversations""",
    "raw_queries": f"SELECT unnest({SENTENCES_SQL}) AS text, 1 AS score FROM conversations WHERE role = 'user'",
    "popularidad": f"SELECT query_texto, CAST(sum(score) AS BIGINT) AS score FROM ({prefixes_sql('raw_queries')}) GROUP BY query_texto",
    "part_fact": """SELECT CAST(l_shipdate AS DATE) AS fecha, l_partkey AS id_documento, 2 AS id_tipo_interaccion, count(*) AS cant_interacciones
                    FROM lineitem GROUP BY ALL""",
    "part_doc": "SELECT p_partkey AS id_documento, p_name AS titulo FROM part",
    "token_docs": f"SELECT doc_id AS id, {tokens_sql('text')} AS tokens FROM documents",
}


class Roles:
    """Role frames over one folder of the given tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def escuela(self) -> DataFrame:
        return self.table("region").select((F.col("r_regionkey") + 1).alias("id"), F.col("r_name").alias("nombre"))

    @cached_property
    def carrera(self) -> DataFrame:
        return self.table("nation").select(
            (F.col("n_nationkey") + 1).alias("id"), (F.col("n_regionkey") + 1).alias("id_escuela"), F.col("n_name").alias("nombre")
        )

    @cached_property
    def materia(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("id"), (F.col("c_nationkey") + 1).alias("id_carrera"), F.col("c_name").alias("nombre")
        )

    @cached_property
    def usuario(self) -> DataFrame:
        return self.table("supplier").select(
            (F.col("s_suppkey") + 1).alias("id"),
            F.concat(F.replace(F.lower("s_name"), F.lit("#"), F.lit(".")), F.lit("@campus.edu")).alias("email"),
            F.col("s_name").alias("nombre"),
            F.when(F.col("s_acctbal") >= 5000, "docente").otherwise("estudiante").alias("rol"),
            F.when(F.col("s_nationkey") < 20, F.col("s_nationkey") + 1).alias("id_carrera"),
        )

    @cached_property
    def tipo_documento(self) -> DataFrame:
        return self.table("orders").select(
            F.substring("o_orderpriority", 1, 1).cast("int").alias("id"), F.col("o_orderpriority").alias("nombre")
        ).distinct()

    @cached_property
    def documento(self) -> DataFrame:
        kind = F.substring("o_orderpriority", 1, 1)
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"),
            F.concat(F.lit("Documento "), F.col("o_orderkey").cast("string")).alias("titulo"),
            kind.cast("int").alias("id_tipo"),
            F.col("o_custkey").alias("id_materia"),
            F.when(kind.isin("1", "2"), "publico").when(kind.isin("3", "4"), "interno").otherwise("privado").alias("visibilidad"),
            F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate") + F.expr("interval 30 days")).alias("deleted_at"),
            F.col("o_orderdate").alias("created_at"),
        )

    @cached_property
    def documento_autor(self) -> DataFrame:
        pairs = self.table("lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.min("l_linenumber").alias("_line"))
        named = pairs.select(F.col("l_orderkey").alias("id_documento"), (F.col("l_suppkey") + 1).alias("id_usuario"), "_line")
        ordered = rank_within(named, ["id_documento"], [F.col("_line").asc(), F.col("id_usuario").asc()], "orden")
        return ordered.select("id_documento", "id_usuario", "orden")

    @cached_property
    def bridge(self) -> DataFrame:
        """The author bridge where the signing order is not needed; lines hardly repeat a pair, so they are dealt by size before pairs are told apart."""
        lines = self.table("lineitem")
        pairs = lines.select(F.col("l_orderkey").alias("id_documento"), (F.col("l_suppkey") + 1).alias("id_usuario"))
        return pairs.repartition(tasks_for(lines), "id_documento", "id_usuario").distinct()

    def _interactions(self, flag: str) -> DataFrame:
        return self.table("lineitem").filter(F.col("l_returnflag") == flag).select(
            F.col("l_orderkey").alias("id_documento"), (F.col("l_suppkey") + 1).alias("id_usuario"), F.col("l_shipdate").alias("created_at")
        )

    @cached_property
    def evento_visualizacion(self) -> DataFrame:
        return self._interactions("N")

    @cached_property
    def favorito(self) -> DataFrame:
        return self._interactions("R")

    @cached_property
    def dim_materia(self) -> DataFrame:
        return flatten_subjects(self.materia, self.carrera, self.escuela)

    @cached_property
    def dim_usuario(self) -> DataFrame:
        return flatten_users(self.usuario, self.carrera, self.escuela)

    @cached_property
    def dim_tipo_documento(self) -> DataFrame:
        return type_dim(self.tipo_documento)

    @cached_property
    def dim_documento(self) -> DataFrame:
        return document_dim(self.documento)

    @cached_property
    def dim_tipo_interaccion(self) -> DataFrame:
        return interaction_types(self.spark)

    @cached_property
    def days(self) -> DataFrame:
        """Every day between the first and the last one in the data."""
        lines = self.table("lineitem").agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"))
        orders = self.table("orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
        ends = lines.unionByName(orders).agg(F.to_date(F.min("a")).alias("a"), F.to_date(F.max("b")).alias("b"))
        return ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("fecha"))

    @cached_property
    def dim_tiempo(self) -> DataFrame:
        parts = calendar(self.days)
        return parts.select("fecha", *[F.col(c).cast("int").alias(c) for c in ("dia", "mes", "cuatrimestre", "anio")])

    @cached_property
    def fact_interaccion_documento(self) -> DataFrame:
        return document_fact(self.evento_visualizacion, self.favorito, self.documento)

    @cached_property
    def fact_interaccion_autor(self) -> DataFrame:
        return author_fact(self.fact_interaccion_documento, self.bridge)

    @cached_property
    def busqueda(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("id_usuario"),
            F.concat(F.lit("tema "), F.get_json_object("props", "$.k")).alias("query_texto"),
            F.floor("value").cast("int").alias("cant_resultados"),
            (F.col("event_type") == "click").alias("hizo_click"),
            F.md5(F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd"))).alias("session_hash"),
            F.col("ts").alias("created_at"),
        )

    @cached_property
    def fact_query_popularity(self) -> DataFrame:
        counts = self.busqueda.groupBy(F.to_date("created_at").alias("fecha"), "query_texto").agg(F.count("*").cast("int").alias("score"))
        return top_k_per_group(counts, ["fecha"], 20, [F.col("score").desc(), F.col("query_texto").desc()], "ranking")

    @cached_property
    def comentario(self) -> DataFrame:
        return self.table("conversations").select(
            (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
            F.when(F.col("turn") > 0, F.col("conv_id") * 1000).alias("id_comentario_padre"),
            F.col("text").alias("texto"),
            (F.col("role") == "system").alias("esta_oculto"),
        )

    @cached_property
    def raw_queries(self) -> DataFrame:
        asked = self.table("conversations").filter(F.col("role") == "user")
        return asked.select(F.explode_outer(sentences("text")).alias("text"), F.lit(1).alias("score")).filter(F.col("text").isNotNull())

    @cached_property
    def popularidad(self) -> DataFrame:
        return popularity(self.raw_queries)

    @cached_property
    def part_fact(self) -> DataFrame:
        """Parts in the role of documents: they have long series of views."""
        daily = self.table("lineitem").groupBy(F.to_date("l_shipdate").alias("fecha"), F.col("l_partkey").alias("id_documento"))
        return daily.agg(F.count("*").alias("cant_interacciones")).withColumn("id_tipo_interaccion", F.lit(2))

    @cached_property
    def part_doc(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("id_documento"), F.col("p_name").alias("titulo"))

    @cached_property
    def token_docs(self) -> DataFrame:
        return self.table("documents").select(F.col("doc_id").alias("id"), search_tokens("text").alias("tokens"))


