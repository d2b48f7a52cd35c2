"""Joins. Sides are broadcast only where Spark's own size statistics allow it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmart.operators.ranking import top_k
from scholarmart.session import tasks_for


def flatten_subjects(subjects: DataFrame, degrees: DataFrame, schools: DataFrame) -> DataFrame:
    """School > degree > subject in one row per subject; incomplete chains are left out."""
    d = degrees.select(F.col("id").alias("id_carrera"), F.col("nombre").alias("nombre_carrera"), "id_escuela")
    s = schools.select(F.col("id").alias("id_escuela"), F.col("nombre").alias("nombre_escuela"))
    m = subjects.select(F.col("id").alias("id_materia"), F.col("nombre").alias("nombre_materia"), "id_carrera")
    return m.join(d.join(s, "id_escuela"), "id_carrera").select(
        "id_materia", "nombre_materia", "id_carrera", "nombre_carrera", "id_escuela", "nombre_escuela"
    )


def flatten_users(users: DataFrame, degrees: DataFrame, schools: DataFrame) -> DataFrame:
    """One row per user with degree and school; defaults where there is none."""
    d = degrees.select(F.col("id").alias("_degree"), F.col("nombre").alias("_degree_name"), "id_escuela")
    s = schools.select(F.col("id").alias("id_escuela"), F.col("nombre").alias("_school_name"))
    places = d.join(s, "id_escuela", "left")
    return users.join(places, users["id_carrera"] == places["_degree"], "left").select(
        F.col("id").alias("id_usuario"),
        F.coalesce("id_carrera", F.lit(0)).alias("id_carrera"),
        F.coalesce("_degree_name", F.lit("Sin Carrera")).alias("nombre_carrera"),
        F.coalesce("_school_name", F.lit("Sin Escuela")).alias("nombre_escuela"),
        "nombre",
    )


def star(fact: DataFrame, *dims: tuple[DataFrame, str]) -> DataFrame:
    """Join a fact with its dimensions; filter a dimension before passing it in."""
    for dim, key in dims:
        fact = fact.join(dim, key)
    return fact


def credit_authors(daily: DataFrame, bridge: DataFrame) -> DataFrame:
    """Spread daily document counts over the authors; each author is credited in full.

    Counts are already summed per day and document, so a hot document brings one row per day into the join.
    Hardly two credits of a task are equal, so they are not gathered before their shuffle. There are as many tasks as the input is worth: what one
    holds does not grow.
    """
    keys, n = ["fecha", "id_usuario", "id_tipo_interaccion"], tasks_for(daily, bridge)
    authors = bridge.select("id_documento", "id_usuario").repartition(n, "id_documento")
    credited = daily.repartition(n, "id_documento").join(authors, "id_documento").select(*keys, "cant_interacciones")
    return credited.repartition(n, *keys[:2]).groupBy(*keys).agg(F.sum("cant_interacciones").alias("cant_interacciones"))


def with_constants(df: DataFrame, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Every row combined with every row of a short constant table, without a join."""
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema)]) for row in rows]
    return df.select("*", F.inline(F.array(*structs)))


def repeat_rows(df: DataFrame, times: Column, name: str = "n") -> DataFrame:
    """Each row ``times`` times, numbered from one; rows with less than one time vanish."""
    numbers = F.filter(F.sequence(F.lit(1), F.greatest(times, F.lit(1))), lambda i: i <= times)
    return df.select("*", F.explode(numbers).alias(name))


def at_latest(df: DataFrame, col: str) -> DataFrame:
    """Rows of the newest value of a column, by a scalar subquery."""
    newest = df.agg(F.max(col).alias("newest"))
    return df.filter(F.col(col) == newest.scalar())


def lookup(df: DataFrame, names: DataFrame, key: str, value: str) -> DataFrame:
    """Add a looked-up value; NULL for unknown keys."""
    return df.join(names.select(key, value), key, "left")


def counts_row(frames: dict[str, DataFrame]) -> DataFrame:
    """One row with the number of rows of every frame."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("k"), "n") for name, df in frames.items()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.agg(*[F.max(F.when(F.col("k") == name, F.col("n"))).alias(name) for name in frames])


def members(df: DataFrame, listed: DataFrame, keys: Sequence[str], present: bool = True) -> DataFrame:
    """Rows whose key is (or is not) on a list."""
    return df.join(listed.select(*keys), list(keys), "left_semi" if present else "left_anti")


def rarely_used(docs: DataFrame, fact: DataFrame, at_most: int = 0) -> DataFrame:
    """Documents with no more than ``at_most`` views and favourites."""
    used = fact.groupBy("id_documento").agg(F.sum("cant_interacciones").cast("long").alias("_n"))
    joined = docs.join(used, "id_documento", "left").withColumn("interacciones", F.coalesce("_n", F.lit(0).cast("long")))
    return joined.filter(F.col("interacciones") <= at_most).drop("_n")


def within_seconds(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, seconds: int
) -> DataFrame:
    """Pairs of equal keys where ``right_ts`` lies between ``left_ts`` and ``seconds`` later.

    Time is cut into pieces of that length; a left row looks into its own piece and
    the next one. The join key holds the piece, so one busy key spreads over many tasks.
    """
    piece = lambda ts: F.floor(F.unix_timestamp(F.col(ts).cast("timestamp")) / seconds)
    seen = left.withColumn("_piece", F.explode(F.array(piece(left_ts), piece(left_ts) + 1)))
    found = right.withColumn("_piece", piece(right_ts))
    pairs = seen.join(found, [*keys, "_piece"])
    upper = F.timestamp_add("SECOND", F.lit(seconds), F.col(left_ts))
    return pairs.filter((F.col(right_ts) >= F.col(left_ts)) & (F.col(right_ts) <= upper)).drop("_piece")


def authors_of_top(fact: DataFrame, bridge: DataFrame, k: int) -> DataFrame:
    """Authors, in signing order, of the ``k`` documents with most interactions."""
    totals = fact.groupBy("id_documento").agg(F.sum("cant_interacciones").cast("long").alias("total"))
    best = top_k(totals, k, F.col("total").desc(), F.col("id_documento").asc())
    return best.join(bridge, "id_documento").select("id_documento", "total", "orden", "id_usuario")


def threads(comments: DataFrame) -> DataFrame:
    """Visible comments with their visible replies, one level deep, one row per reply.

    Replies are not gathered into a list: a thread may hold a large part of all comments.
    """
    shown = comments.filter(~F.col("esta_oculto"))
    roots = shown.filter(F.col("id_comentario_padre").isNull()).select(F.col("id").alias("id_raiz"), F.col("texto").alias("texto_raiz"))
    replies = shown.filter(F.col("id_comentario_padre").isNotNull()).select(
        F.col("id_comentario_padre").alias("id_raiz"), F.col("id").alias("id_respuesta"), F.col("texto").alias("texto_respuesta")
    )
    counts = replies.groupBy("id_raiz").agg(F.count("*").alias("_n"))
    sized = roots.join(counts, "id_raiz", "left").withColumn("respuestas", F.coalesce("_n", F.lit(0).cast("long"))).drop("_n")
    return sized.join(replies, "id_raiz", "left")
