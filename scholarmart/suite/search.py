"""Search and suggestion (H), embeddings (UDF-5)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from scholarmart.contracts import WAREHOUSE_TABLES
from scholarmart.functions.scalar import round_half_up
from scholarmart.functions.stemming import by_stem, stem
from scholarmart.functions.text import search_tokens, spoken_tokens
from scholarmart.operators import neighbours, ranking, search, selection, suggest
from scholarmart.plans import completions, indexing, metrics, postings
from scholarmart.plans.popularity import load_popularity
from scholarmart.session import scratch_path
from scholarmart.sources.tables import ensure_table
from scholarmart.suite.registry import query, rnd
from scholarmart.suite.roles import prefixes_sql
from scholarmart.suite.selection import COSINE_SQL, QUERY_SQL, query_vector

TERMS = ("the", "und", "que", "tion", "elle")


def similarity(df, name="similitud"):
    return df.withColumn(name, round_half_up(name, 6))


@query("h_1", f"SELECT vec_id AS id, {rnd(COSINE_SQL, 6)} AS similitud FROM embeddings WHERE label <> 0 AND {COSINE_SQL} >= 0.1 ORDER BY {COSINE_SQL} DESC, vec_id LIMIT 10")
def h_1(r):
    live = r.table("embeddings").filter("label <> 0").withColumnRenamed("vec_id", "id")
    return similarity(search.semantic_search(live, query_vector(), 10, 0.1).select("id", "similitud"))


PAIR = "list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"


@query(
    "h_2",
    f"""SELECT query_id, id, {rnd('s', 6)} AS similitud, CAST(posicion AS INTEGER) AS posicion FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, id) AS posicion FROM (
          SELECT a.vec_id AS query_id, b.vec_id AS id, {PAIR} AS s FROM embeddings a, embeddings b)) WHERE s >= 0.3 AND posicion <= 4""",
)
def h_2(r):
    docs = r.table("embeddings").select(F.col("vec_id").alias("id"), "embedding")
    queries = docs.select(F.col("id").alias("query_id"), "embedding")
    return similarity(neighbours.nearest(queries, docs, 4, 0.3, "query_id", "id", "embedding"))


@query(
    "h_2_list",
    f"""SELECT query_id, id, {rnd('s', 6)} AS similitud, CAST(posicion AS INTEGER) AS posicion FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, id) AS posicion FROM (
          SELECT q.query_id, e.vec_id AS id, list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), q.v) AS s FROM embeddings e,
            (SELECT 'a' AS query_id, {QUERY_SQL} AS v UNION ALL SELECT 'b', list_reverse({QUERY_SQL})) q)) WHERE s >= 0.05 AND posicion <= 6""",
)
def h_2_list(r):
    docs = r.table("embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return similarity(neighbours.search_list(docs, {"a": query_vector(), "b": query_vector()[::-1]}, 6, 0.05))


@query(
    "h_3",
    f"""SELECT id, relacionado, {rnd('s', 6)} AS similitud, CAST(posicion AS INTEGER) AS posicion FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(s, 9) DESC, relacionado) AS posicion FROM (
          SELECT a.vec_id AS id, b.vec_id AS relacionado, {PAIR} AS s FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id)) WHERE s >= 0.35 AND posicion <= 5""",
)
def h_3(r):
    docs = r.table("embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return similarity(neighbours.related(docs, 5, 0.35))


def bm25_sql(source: str, terms=TERMS, k1=1.2, b=0.75) -> str:
    tf = ", ".join(f"len(list_filter(tokens, lambda w: w = '{t}')) AS tf_{i}" for i, t in enumerate(terms))
    df = ", ".join(f"sum(CASE WHEN tf_{i} > 0 THEN 1 ELSE 0 END) AS df_{i}" for i in range(len(terms)))
    score = " + ".join(
        f"ln(1 + (n - df_{i} + 0.5::DOUBLE) / (df_{i} + 0.5::DOUBLE)) * tf_{i} * {k1 + 1}::DOUBLE / (tf_{i} + {k1}::DOUBLE * ({1 - b}::DOUBLE + {b}::DOUBLE * dl / avgdl))"
        for i in range(len(terms))
    )
    any_term = " + ".join(f"tf_{i}" for i in range(len(terms)))
    return f"""WITH c AS (SELECT id, len(tokens) AS dl, {tf} FROM {source}), s AS (SELECT count(*) AS n, avg(dl) AS avgdl, {df} FROM c)
        SELECT id, {score} AS puntaje FROM c, s WHERE {any_term} > 0"""


INDEXES: dict[tuple[str, str], str] = {}


def stored_index(r) -> postings.Index:
    """The postings of a folder's documents: written when they are first asked for in a session, read by buckets from then on."""
    key = (r.spark.sparkContext.applicationId, r.dir)
    if key not in INDEXES:
        root = scratch_path(r.spark, "postings")
        postings.append(r.token_docs, root)
        INDEXES[key] = root
    return postings.Index(r.spark, INDEXES[key])


@query("h_4", f"SELECT id, {rnd('puntaje', 6)} AS puntaje FROM ({bm25_sql('token_docs')}) ORDER BY round(puntaje, 9) DESC, id LIMIT 25")
def h_4(r):
    return stored_index(r).search(TERMS, 25).withColumn("puntaje", round_half_up("puntaje", 6))


@query("h_4_scan", f"SELECT id, {rnd('puntaje', 6)} AS puntaje FROM ({bm25_sql('token_docs')}) ORDER BY round(puntaje, 9) DESC, id LIMIT 25")
def h_4_scan(r):
    """Without stored postings: the tokens of all documents are read."""
    return search.lexical_search(r.token_docs, TERMS, 25).withColumn("puntaje", round_half_up("puntaje", 6))


@query(
    "h_4_segments",
    f"""SELECT id, {rnd('puntaje', 6)} AS puntaje FROM ({bm25_sql("(SELECT t.* FROM token_docs t LEFT JOIN labels l ON l.doc_id = t.id WHERE coalesce(l.toxic, 0) = 0)")})""",
)
def h_4_segments(r):
    """Two batches of documents, by language; the toxic ones are removed after that; all scores."""
    root = scratch_path(r.spark, "segments")
    german = r.table("documents").filter("lang = 'de'").select(F.col("doc_id").alias("id"))
    postings.append(r.token_docs.join(german, "id", "left_semi"), root)
    postings.append(r.token_docs.join(german, "id", "left_anti"), root)
    postings.remove(r.table("labels").filter("toxic = 1").select(F.col("doc_id").alias("id")), root)
    return postings.Index(r.spark, root).scores(TERMS).withColumn("puntaje", round_half_up("puntaje", 6))


@query("h_5", prefixes_sql("raw_queries"))
def h_5(r):
    return suggest.expand_prefixes(r.raw_queries)


@query("h_6", "SELECT * FROM popularidad")
def h_6(r):
    return suggest.popularity(r.raw_queries)


SNAPSHOT_SQL = """SELECT DATE '2024-02-01' AS fecha, query_texto, CAST(score AS INTEGER) AS score, CAST(ranking AS SMALLINT) AS ranking FROM
    (SELECT *, row_number() OVER (ORDER BY score DESC, query_texto DESC) AS ranking FROM popularidad) WHERE ranking <= 20"""


@query("h_7", SNAPSHOT_SQL)
def h_7(r):
    root, contract = scratch_path(r.spark, "snapshot"), WAREHOUSE_TABLES["fact_query_popularity"]
    ensure_table(r.spark, root, contract)
    load_popularity(r.spark, r.popularidad, root, dt.date(2024, 2, 1))
    load_popularity(r.spark, r.popularidad, root, dt.date(2024, 2, 1))  # the day is replaced, not doubled
    return r.spark.read.schema(contract.schema).parquet(f"{root}/{contract.name}")


@query("h_8", "SELECT query_texto, score FROM popularidad WHERE starts_with(query_texto, 'que') ORDER BY score DESC, query_texto LIMIT 5")
def h_8(r):
    return suggest.suggest(r.popularidad, "que", 5)


def near_sql(text: str, typed: str) -> str:
    """DuckDB measures bytes, so every accented letter is stood in for by one capital; texts are in lower case."""
    plain = lambda e: f"translate({e}, 'áàâäãéèêëíìîïóòôöõúùûüñçß', 'ABCDEFGHIJKLMNOPQRSTUVWXY')"
    return " OR ".join(f"levenshtein({plain(f'substr({text}, 1, length({typed}) + {d})')}, {plain(typed)}) <= 1" for d in (-1, 0, 1))


@query("h_9", f"SELECT query_texto, score FROM popularidad WHERE {near_sql('query_texto', chr(39) + 'qeu' + chr(39))} ORDER BY score DESC, query_texto LIMIT 8")
def h_9(r):
    return suggest.suggest_fuzzy(r.popularidad, "qeu", 8)


@query(
    "h_9_batch",
    f"""SELECT t.prefix, p.query_texto, p.score FROM popularidad p JOIN (SELECT DISTINCT string_split(lower(text), ' ')[1] AS prefix FROM benchmark) t
        ON {near_sql('p.query_texto', 't.prefix')}""",
)
def h_9_batch(r):
    typed = r.table("benchmark").select(F.element_at(F.split(F.lower("text"), " "), 1).alias("prefix"))
    return suggest.fuzzy_matches(r.popularidad, typed)


@query("h_4_stem")
def h_4_stem(r):
    """BM25 over postings stored by Spanish stems; what is asked for is stemmed alike."""
    root = scratch_path(r.spark, "stems")
    postings.append(r.table("documents").select(F.col("doc_id").alias("id"), spoken_tokens("text").alias("tokens")), root, stems=True)
    return postings.Index(r.spark, root).search([stem(t) for t in TERMS], 20)


@query("x_18_stem")
def x_18_stem(r):
    """How many documents hold every stem, and how often."""
    docs = r.table("documents").select(F.col("doc_id").cast("long").alias("id"), spoken_tokens("text").alias("tokens"))
    return by_stem(postings.count_postings(docs)).groupBy("termino").agg(F.count("*").alias("documentos"), F.sum("tf").alias("apariciones"))


def batch_sql(typed: str, hit: str, n: int) -> str:
    """The first ``n`` hits of every prefix that was typed."""
    return f"""SELECT prefix, posicion, query_texto, score FROM (SELECT t.prefix, p.query_texto, p.score,
          CAST(row_number() OVER (PARTITION BY t.prefix ORDER BY p.score DESC, p.query_texto) AS INTEGER) AS posicion
        FROM popularidad p JOIN ({typed}) t ON {hit}) WHERE posicion <= {n}"""


def completion_table(r, n: int, longest: int):
    root = scratch_path(r.spark, "completions")
    completions.store(r.popularidad, root, n)
    return completions.stored(r.spark, root, longest=longest)


@query("h_8_batch", batch_sql("SELECT DISTINCT substr(lower(text), 1, n) AS prefix FROM benchmark, range(0, 6) s(n)", "starts_with(p.query_texto, t.prefix)", 5))
def h_8_batch(r):
    typed = r.table("benchmark").select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda n: F.substring(F.lower("text"), F.lit(1), n))).alias("prefix"))
    return completions.complete(completion_table(r, 5, 5), typed, 5)


@query("h_9_batch_n", batch_sql("SELECT DISTINCT substr(string_split(lower(text), ' ')[1], 1, n) AS prefix FROM benchmark, range(1, 5) s(n)", near_sql("p.query_texto", "t.prefix"), 4))
def h_9_batch_n(r):
    first = F.element_at(F.split(F.lower("text"), " "), 1)
    typed = r.table("benchmark").select(F.explode(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda n: F.substring(first, F.lit(1), n))).alias("prefix"))
    return completions.complete_fuzzy(completion_table(r, 4, 5), typed, 4)  # an edit away from four letters are five at most


@query("h_10", "SELECT query_texto, sum(score)::BIGINT AS score FROM (SELECT * FROM popularidad UNION ALL SELECT text, 1 FROM raw_queries) GROUP BY query_texto")
def h_10(r):
    return suggest.increment(r.popularidad, r.raw_queries.select(F.col("text").alias("query_texto")))


@query("h_11", "SELECT * FROM popularidad WHERE query_texto NOT IN (SELECT text FROM raw_queries WHERE length(text) > 60)")
def h_11(r):
    banned = r.raw_queries.filter(F.char_length("text") > 60).select(F.col("text").alias("query_texto"))
    return suggest.remove(r.popularidad, banned).select("query_texto", "score")


@query("h_11_size", "SELECT count(*) AS entradas FROM popularidad")
def h_11_size(r):
    return suggest.dictionary_size(r.popularidad)


def hybrid_sql(allowed: str) -> str:
    return f"""WITH d AS (SELECT t.id, t.tokens, e.embedding FROM token_docs t LEFT JOIN embeddings e ON t.id = e.vec_id WHERE t.id IN ({allowed})),
    sem AS (SELECT id, row_number() OVER (ORDER BY round({COSINE_SQL}, 9) DESC, id) AS p FROM d WHERE {COSINE_SQL} >= 0),
    lex AS (SELECT id, row_number() OVER (ORDER BY round(puntaje, 9) DESC, id) AS p FROM ({bm25_sql('d')}))
    SELECT id, {rnd('sum(1.0::DOUBLE / (60 + p))', 8)} AS puntaje FROM (SELECT * FROM sem UNION ALL SELECT * FROM lex)
    GROUP BY id ORDER BY round(sum(1.0::DOUBLE / (60 + p)), 12) DESC, id LIMIT 10"""


def hybrid(r, allowed):
    """Vectors and postings of the allowed documents, fused; texts are not read."""
    vectors = r.table("embeddings").select(F.col("vec_id").alias("id"), "embedding").join(allowed, "id", "left_semi")
    lists = [search.semantic_scores(vectors, query_vector(), 0.0), search.rounded(stored_index(r).scores(TERMS, allowed))]
    return search.fuse_scores(lists, 10).withColumn("puntaje", round_half_up("puntaje", 8))


@query("h_12", hybrid_sql("SELECT doc_id FROM documents WHERE lang <> 'de'"))
def h_12(r):
    return hybrid(r, r.table("documents").filter("lang <> 'de'").select(F.col("doc_id").alias("id")))


@query(
    "h_12_filters",
    hybrid_sql(
        """SELECT d.id_documento FROM dim_documento d JOIN dim_materia m ON d.id_materia = m.id_materia JOIN documents x ON x.doc_id = d.id_documento
           WHERE m.id_escuela IN (3) AND d.fecha_alta BETWEEN DATE '1993-01-01' AND DATE '2000-12-31'
             AND (visibilidad IN ('publico', 'interno') OR EXISTS (SELECT 1 FROM documento_autor b WHERE b.id_documento = d.id_documento AND b.id_usuario = 7))"""
    ),
)
def h_12_filters(r):
    """What a request asks for and what its author may see: the texts with an entry among the documents of the star."""
    wanted = selection.search_filters(r.dim_documento, r.dim_materia, school=3, since=dt.date(1993, 1, 1), until=dt.date(2000, 12, 31))
    shown = selection.visible_to(wanted, "author", r.bridge, 7).select(F.col("id_documento").cast("long").alias("id"))
    return hybrid(r, shown.join(r.table("documents").select(F.col("doc_id").alias("id")), "id", "left_semi"))


@query("h_12_scan", hybrid_sql("SELECT doc_id FROM documents WHERE lang <> 'de'"))
def h_12_scan(r):
    """Without stored postings: tokens of the texts, and their vectors where there are any."""
    vectors = r.table("embeddings").select(F.col("vec_id").alias("id"), "embedding")
    texts = r.table("documents").filter("lang <> 'de'").select(F.col("doc_id").alias("id"), search_tokens("text").alias("tokens"))
    return search.hybrid_search(texts.join(vectors, "id", "left"), query_vector(), TERMS, 10).withColumn("puntaje", round_half_up("puntaje", 8))


@query("h_13", f"SELECT vec_id AS id, {rnd(COSINE_SQL, 6)} AS similitud FROM embeddings WHERE {COSINE_SQL} >= 0.05 AND {COSINE_SQL} < 0.2 ORDER BY {COSINE_SQL} DESC, vec_id LIMIT 10")
def h_13(r):
    docs = r.table("embeddings").withColumnRenamed("vec_id", "id")
    return similarity(search.near_misses(docs, query_vector(), 10, 0.05, 0.2).select("id", "similitud"))


@query("h_13_counts", f"SELECT count(*) AS sin_filtros, count(*) FILTER (WHERE label = 3) AS con_filtros FROM embeddings WHERE {COSINE_SQL} >= 0.1")
def h_13_counts(r):
    docs = search.scored(r.table("embeddings"), query_vector())
    return search.hits_with_and_without_filters(docs, F.col("label") == 3, F.col("similitud") >= 0.1)


@query(
    "h_14",
    f"""WITH tf AS (SELECT id, termino, count(*) AS tf FROM (SELECT id, unnest(tokens) AS termino FROM token_docs) GROUP BY ALL),
          df AS (SELECT termino, count(*) AS df FROM tf GROUP BY ALL),
          w AS (SELECT id, termino, tf * ln(((SELECT count(*) FROM documents) + 1) / CAST(df + 1 AS DOUBLE)) AS peso FROM tf JOIN df USING (termino)),
          p AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(peso, 9) DESC, termino) AS posicion FROM w)
        SELECT id, termino, {rnd('peso', 6)} AS peso, CAST(posicion AS INTEGER) AS posicion FROM p WHERE posicion <= 5""",
)
def h_14(r):
    return stored_index(r).keywords(5).withColumn("peso", round_half_up("peso", 6))


def seen_vectors(r):
    """Vectors every user looked at: the number in an event stands for the vector."""
    views = r.table("events").filter("event_type = 'view'")
    return views.select(F.col("user_id").alias("id_usuario"), F.get_json_object("props", "$.k").cast("long").alias("id"))


@query(
    "h_15",
    f"""WITH seen AS (SELECT DISTINCT user_id AS u, CAST(json_extract_string(props, '$.k') AS BIGINT) AS id FROM events WHERE event_type = 'view'),
          parts AS (SELECT s.u, i, avg(CAST(e.embedding[i] AS DOUBLE)) AS v FROM seen s JOIN embeddings e ON s.id = e.vec_id, range(1, 65) t(i) GROUP BY ALL),
          prof AS (SELECT u, list(v ORDER BY i) AS embedding FROM parts GROUP BY u),
          cand AS (SELECT a.u, b.vec_id AS id, {PAIR} AS s FROM prof a, embeddings b),
          best AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY round(s, 6) DESC, id) AS posicion FROM cand c
                   WHERE s >= 0.25 AND NOT EXISTS (SELECT 1 FROM seen x WHERE x.u = c.u AND x.id = c.id))
        SELECT u AS id_usuario, id, {rnd('s', 4)} AS similitud, CAST(posicion AS INTEGER) AS posicion FROM best WHERE posicion <= 3""",
)
def h_15(r):
    seen = seen_vectors(r)
    docs = r.table("embeddings").select(F.col("vec_id").alias("id"), "embedding")
    profiles = search.profile_vectors(seen, docs, key="id")
    return neighbours.recommend(profiles, seen, docs, 3, 0.25).withColumn("similitud", round_half_up("similitud", 4))


@query(
    "h_16",
    """SELECT id_documento, titulo, nombre_escuela, nombre_carrera, fecha_alta, CAST(row_number() OVER (ORDER BY fecha_alta DESC, id_documento) AS INTEGER) AS posicion
       FROM dim_documento d JOIN dim_materia m ON d.id_materia = m.id_materia WHERE NOT d.is_deleted AND m.nombre_escuela = 'AFRICA'
       ORDER BY fecha_alta DESC, id_documento LIMIT 10 OFFSET 10""",
)
def h_16(r):
    rows = metrics.browse(r.dim_documento, r.dim_materia.filter("nombre_escuela = 'AFRICA'"), ["nombre_escuela", "nombre_carrera"])
    return ranking.page(rows, 2, 10, [F.col("fecha_alta").desc(), F.col("id_documento").asc()])


@query(
    "h_17",
    """SELECT query_texto, max(score)::BIGINT AS score FROM (SELECT query_texto, count(*) AS score FROM busqueda WHERE id_usuario = 5 GROUP BY ALL
         UNION ALL SELECT query_texto, sum(score)::BIGINT FROM fact_query_popularity GROUP BY ALL)
       WHERE starts_with(query_texto, 'tema 1') GROUP BY query_texto ORDER BY score DESC, query_texto LIMIT 5""",
)
def h_17(r):
    popular = r.fact_query_popularity.groupBy("query_texto").agg(F.sum("score").alias("score"))
    return suggest.user_suggestions(r.busqueda, popular, 5, "tema 1", 5)


@query(
    "h_17_direct",
    f"""SELECT id_documento, titulo, {rnd('14.0::DOUBLE / length(titulo)', 6)} AS fuerza FROM dim_documento
        WHERE starts_with(lower(titulo), 'documento 1499') AND 14.0::DOUBLE / length(titulo) >= 0.8""",
)
def h_17_direct(r):
    return suggest.direct_hits(r.dim_documento, "Documento 1499").withColumn("fuerza", round_half_up("fuerza", 6))


@query("h_18", "SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS p FROM conversations) WHERE p = 1")
def h_18(r):
    return ranking.latest_version(r.table("conversations"), "conv_id", "turn")


@query(
    "h_19",
    """SELECT doc_id AS id, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS resumen,
       regexp_replace(CASE WHEN instr(lower(text), 'tion') > 0 THEN substr(text, greatest(instr(lower(text), 'tion') - 40, 1), 120) ELSE '' END, '\\s+', ' ', 'g') AS fragmento
       FROM documents""",
)
def h_19(r):
    docs = r.table("documents").select(F.col("doc_id").alias("id"), F.col("text").alias("texto"))
    return search.result_rows(docs, "tion")


@query("udf_5", "SELECT page_id, 384 AS dimensiones, 1.0::DOUBLE AS norma FROM pages")
def udf_5(r):
    pages = indexing.extract(r.table("pages")).withColumnRenamed("texto_completo", "abstract")
    vectors = indexing.embed(pages)
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return vectors.select("page_id", F.size("embedding").alias("dimensiones"), round_half_up(length, 4).alias("norma"))
