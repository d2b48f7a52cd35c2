"""Data quality (Q)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scholarmart.contracts import EMAIL_PATTERN, Contract, WAREHOUSE_TABLES
from scholarmart.operators import quality
from scholarmart.suite.registry import query
from scholarmart.suite.roles import TABLES


@query(
    "q_1",
    """SELECT 'id_carrera' AS columna, count(*) - count(id_carrera) AS nulos FROM usuario UNION ALL SELECT 'nombre', count(*) - count(nombre) FROM usuario
       UNION ALL SELECT 'email', count(*) - count(email) FROM usuario""",
)
def q_1(r):
    return quality.missing(r.usuario, ["id_carrera", "nombre", "email"])


@query("q_2", "SELECT l_orderkey, l_suppkey, count(*) AS veces FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def q_2(r):
    return quality.duplicate_keys(r.table("lineitem"), ["l_orderkey", "l_suppkey"])


@query("q_2_single", "SELECT text, count(*) AS veces FROM documents GROUP BY ALL HAVING count(*) > 1")
def q_2_single(r):
    return quality.duplicate_keys(r.table("documents"), ["text"])


@query("q_3", "SELECT user_id, count(*) AS filas FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY ALL")
def q_3(r):
    return quality.orphans(r.table("events"), r.table("supplier"), "user_id", "s_suppkey")


@query(
    "q_4",
    """SELECT l_orderkey, l_suppkey, l_linenumber, l_returnflag NOT IN ('A', 'N') AS fuera_de_lista, l_linenumber < 2 AS bajo_minimo FROM lineitem""",
)
def q_4(r):
    rules = quality.row_rules(
        Contract("lineitem", TABLES["lineitem"], (), domains={"l_returnflag": ("A", "N")}, minimum={"l_linenumber": 2})
    )
    return r.table("lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", rules["l_returnflag_domain"].alias("fuera_de_lista"), rules["l_linenumber_minimum"].alias("bajo_minimo")
    )


@query("q_5", "SELECT lang, count(*) AS demasiado_largos FROM documents WHERE length(text) > 2000 GROUP BY ALL")
def q_5(r):
    rules = quality.row_rules(Contract("documents", TABLES["documents"], (), max_length={"text": 2000}))
    return r.table("documents").filter(rules["text_length"]).groupBy("lang").agg(F.count("*").alias("demasiado_largos"))


@query("q_6", f"SELECT id, email FROM usuario WHERE NOT regexp_matches(email, '{EMAIL_PATTERN}', 'i') UNION ALL SELECT id, nombre FROM usuario WHERE NOT regexp_matches(nombre, '{EMAIL_PATTERN}', 'i')")
def q_6(r):
    bad = lambda c: ~quality.matches(c, EMAIL_PATTERN)
    mails = r.usuario.filter(bad("email")).select("id", "email")
    return mails.unionByName(r.usuario.filter(bad("nombre")).select("id", F.col("nombre").alias("email")))


Q7_SQL = """SELECT id, array_to_string(list_filter([CASE WHEN id_carrera IS NULL THEN 'sin_carrera' END, CASE WHEN rol <> 'docente' THEN 'rol' END,
            CASE WHEN length(nombre) > 10 AND id % 2 = 0 THEN 'nombre' END], lambda x: x IS NOT NULL), ',') AS motivos FROM usuario"""


def q7_rules():
    return {
        "sin_carrera": F.col("id_carrera").isNull(),
        "rol": F.col("rol") != "docente",
        "nombre": (F.char_length("nombre") > 10) & (F.col("id") % 2 == 0),
    }


@query("q_7", f"SELECT id, motivos FROM ({Q7_SQL}) WHERE motivos <> ''")
def q_7(r):
    _, bad = quality.split_valid(r.usuario, q7_rules())
    return bad.select("id", F.array_join("motivos", ",").alias("motivos"))


@query("q_7_valid", f"SELECT id FROM ({Q7_SQL}) WHERE motivos = ''")
def q_7_valid(r):
    good, _ = quality.split_valid(r.usuario, q7_rules())
    return good.select("id")


@query(
    "q_7_keys",
    """SELECT 'unique:fecha,id_usuario,id_tipo_interaccion' AS regla, 0::BIGINT AS filas UNION ALL SELECT 'foreign:fecha', 0
       UNION ALL SELECT 'foreign:id_usuario', count(*) FROM fact_interaccion_autor WHERE id_usuario NOT IN (SELECT id_usuario FROM dim_usuario WHERE id_carrera > 0)
       UNION ALL SELECT 'foreign:id_tipo_interaccion', 0""",
)
def q_7_keys(r):
    frames = {
        "fact_interaccion_autor": r.fact_interaccion_autor,
        "dim_tiempo": r.dim_tiempo,
        "dim_usuario": r.dim_usuario.filter("id_carrera > 0"),
        "dim_tipo_interaccion": r.dim_tipo_interaccion,
    }
    return quality.key_violations(frames, WAREHOUSE_TABLES["fact_interaccion_autor"])


@query(
    "q_8",
    """SELECT 'dim_materia' AS tabla, count(*) AS filas, count(*) > 0 AS correcto FROM dim_materia
       UNION ALL SELECT 'dim_usuario', count(*), count(*) = 2001 FROM dim_usuario UNION ALL SELECT 'dim_documento', count(*), count(*) > 0 FROM dim_documento
       UNION ALL SELECT 'fact_interaccion_autor', count(*), count(*) > 0 FROM fact_interaccion_autor""",
)
def q_8(r):
    names = ("dim_materia", "dim_usuario", "dim_documento", "fact_interaccion_autor")
    return quality.row_counts({n: getattr(r, n) for n in names}, {"dim_usuario": 2001})


@query(
    "q_8_freshness",
    """SELECT tabla_origen, CAST(epoch(TIMESTAMP '2002-01-01 00:00:00') - epoch(m) AS BIGINT) AS segundos FROM (
         SELECT 'visualizacion' AS tabla_origen, max(created_at) AS m FROM evento_visualizacion UNION ALL SELECT 'favorito', max(created_at) FROM favorito)""",
)
def q_8_freshness(r):
    marks = [
        df.agg(F.max("created_at").alias("ultima_corrida")).select(F.lit(n).alias("tabla_origen"), F.col("ultima_corrida").alias("ultimo_procesado"), "ultima_corrida")
        for n, df in (("visualizacion", r.evento_visualizacion), ("favorito", r.favorito))
    ]
    return quality.freshness(marks[0].unionByName(marks[1]), F.lit("2002-01-01 00:00:00").cast("timestamp")).select("tabla_origen", "segundos")
