"""Dimensions of the star."""

from __future__ import annotations

import datetime as dt
from calendar import monthrange

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmart.contracts import INTERACTION_TYPES, WAREHOUSE_TABLES, conform
from scholarmart.functions.scalar import date_parts
from scholarmart.operators.joins import flatten_subjects, flatten_users
from scholarmart.operators.writes import insert_ignore, upsert
from scholarmart.sources.tables import date_series, inline_table

CALENDAR_START = dt.date(2024, 1, 1)
# The row anonymous users stand for, as the model has them.
SENTINEL = (0, 0, "Invitado Anonimo", "Sin Escuela", "Sin Carrera")


def interaction_types(spark: SparkSession) -> DataFrame:
    return inline_table(spark, INTERACTION_TYPES, WAREHOUSE_TABLES["dim_tipo_interaccion"].schema)


def calendar(days: DataFrame, rule: str = "code") -> DataFrame:
    return days.select("fecha", *date_parts("fecha", rule))


def calendar_until(spark: SparkSession, as_of: dt.date, start: dt.date = CALENDAR_START, rule: str = "code") -> DataFrame:
    """Days from the start to one month after ``as_of``."""
    return calendar(date_series(spark, start, add_month(as_of)), rule)


def add_month(day: dt.date) -> dt.date:
    """The same day of the next month, or its last day."""
    year, month = day.year + day.month // 12, day.month % 12 + 1
    return dt.date(year, month, min(day.day, monthrange(year, month)[1]))


def document_dim(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("id").alias("id_documento"),
        "id_tipo",
        "id_materia",
        "titulo",
        F.to_date("created_at").alias("fecha_alta"),
        "visibilidad",
        F.col("deleted_at").isNotNull().alias("is_deleted"),
        F.to_date("deleted_at").alias("deleted_at"),
    )


def type_dim(types: DataFrame) -> DataFrame:
    return types.select(F.col("id").alias("id_tipo"), "nombre")


def with_sentinel(dim_users: DataFrame, sentinel: tuple = SENTINEL) -> DataFrame:
    """Add the anonymous user unless its id is taken."""
    row = inline_table(dim_users.sparkSession, [sentinel], WAREHOUSE_TABLES["dim_usuario"].schema)
    return insert_ignore(dim_users, row, ["id_usuario"])


def load_dims(
    src: dict[str, DataFrame], dwh: dict[str, DataFrame], as_of: dt.date, changed_since: dt.datetime | None = None,
    calendar_start: dt.date = CALENDAR_START,
) -> dict[str, DataFrame]:
    """New content of every dimension: full upsert of the sources over what is stored.

    ``changed_since`` restricts users and documents to rows changed after that time.
    """
    spark = dwh["dim_usuario"].sparkSession

    def recent(df: DataFrame) -> DataFrame:
        return df if changed_since is None else df.filter(F.col("updated_at") > F.lit(changed_since))

    def put(name: str, delta: DataFrame, update_cols=None) -> DataFrame:
        contract = WAREHOUSE_TABLES[name]
        return conform(upsert(dwh[name], conform(delta, contract), list(contract.keys), update_cols), contract)

    document_updates = ["id_tipo", "id_materia", "titulo", "visibilidad", "is_deleted", "deleted_at"]
    users = with_sentinel(dwh["dim_usuario"])
    users_delta = conform(flatten_users(recent(src["usuario"]), src["carrera"], src["escuela"]), WAREHOUSE_TABLES["dim_usuario"])
    return {
        "dim_tipo_interaccion": put("dim_tipo_interaccion", interaction_types(spark)),
        "dim_tiempo": insert_ignore(dwh["dim_tiempo"], calendar_until(spark, as_of, calendar_start), ["fecha"]),
        "dim_materia": put("dim_materia", flatten_subjects(src["materia"], src["carrera"], src["escuela"])),
        "dim_tipo_documento": put("dim_tipo_documento", type_dim(src["tipo_documento"])),
        "dim_usuario": conform(upsert(users, users_delta, ["id_usuario"]), WAREHOUSE_TABLES["dim_usuario"]),
        "dim_documento": put("dim_documento", document_dim(recent(src["documento"])), document_updates),
    }
