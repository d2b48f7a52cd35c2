"""Row selection: dates, optional arguments, soft deletes, search filters and visibility."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def between_dates(df: DataFrame, col: str, start: dt.date, end: dt.date) -> DataFrame:
    """Both ends are included."""
    return df.filter(F.col(col).between(F.lit(start), F.lit(end)))


def last_days(df: DataFrame, col: str, days: int, as_of: dt.date) -> DataFrame:
    return df.filter(F.col(col) >= F.lit(as_of - dt.timedelta(days=days)))


def optional_equals(df: DataFrame, **wanted) -> DataFrame:
    """Equality filters; an argument that is None asks for nothing."""
    for col, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(col) == F.lit(value))
    return df


def active(df: DataFrame, deleted_at: str = "deleted_at") -> DataFrame:
    return df.filter(F.col(deleted_at).isNull())


def search_filters(
    docs: DataFrame,
    subjects: DataFrame,
    school: int | None = None,
    degree: int | None = None,
    subject: int | None = None,
    doc_type: int | None = None,
    since: dt.date | None = None,
    until: dt.date | None = None,
) -> DataFrame:
    """Documents that meet every given filter of a search request.

    The subject hierarchy is filtered first and joined only if a level above the subject is asked for.
    """
    docs = optional_equals(docs, id_materia=subject, id_tipo=doc_type)
    if since is not None:
        docs = docs.filter(F.col("fecha_alta") >= F.lit(since))
    if until is not None:
        docs = docs.filter(F.col("fecha_alta") <= F.lit(until))
    if school is None and degree is None:
        return docs
    wanted = optional_equals(subjects, id_escuela=school, id_carrera=degree).select("id_materia")
    return docs.join(wanted, "id_materia", "left_semi").select(*docs.columns)


def visible_to(docs: DataFrame, audience: str, bridge: DataFrame | None = None, user_id: int | None = None) -> DataFrame:
    """Documents an audience may see.

    ``guest``: public ones. ``member``: public and internal ones. ``author``: these
    and the private ones the user wrote or co-wrote. Any other audience is an error.
    """
    if audience not in ("guest", "member", "author"):
        raise ValueError(f"unknown audience {audience!r}")
    allowed = ["publico"] if audience == "guest" else ["publico", "interno"]
    shown = docs.filter(F.col("visibilidad").isin(*allowed))
    if audience != "author":
        return shown
    own = bridge.filter(F.col("id_usuario") == user_id).select("id_documento")
    private = docs.filter(F.col("visibilidad") == "privado").join(own, "id_documento", "left_semi")
    return shown.unionByName(private.select(*docs.columns))


def flag(columns: Mapping[str, Column]) -> list[Column]:
    """Tests as boolean columns."""
    return [test.alias(name) for name, test in columns.items()]
