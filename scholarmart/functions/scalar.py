"""Date, number, text and key helpers over columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(col: ColumnLike) -> Column:
    return F.col(col) if isinstance(col, str) else col


def day_of(ts: ColumnLike) -> Column:
    return F.to_date(_c(ts))


def date_parts(date: ColumnLike, rule: str = "code") -> list[Column]:
    """``dia, mes, cuatrimestre, anio`` as small integers."""
    d = _c(date)
    return [
        F.day(d).cast("short").alias("dia"),
        F.month(d).cast("short").alias("mes"),
        term(d, rule).alias("cuatrimestre"),
        F.year(d).cast("short").alias("anio"),
    ]


def term(date: ColumnLike, rule: str = "code") -> Column:
    """Term of the year.

    ``code``: months up to July are 1, the rest 2. ``academic``: March to July is
    1, August to December is 2, January and February are 0 (summer).
    """
    month = F.month(_c(date))
    if rule == "code":
        value = F.when(month <= 7, 1).otherwise(2)
    elif rule == "academic":
        value = F.when(month.between(3, 7), 1).when(month >= 8, 2).otherwise(0)
    else:
        raise ValueError(f"unknown term rule {rule!r}")
    return value.cast("short")


def month_start(date: ColumnLike) -> Column:
    return F.trunc(_c(date), "MM")


def month_index(date: ColumnLike) -> Column:
    d = _c(date)
    return F.year(d) * 12 + F.month(d)


def days_between(end: ColumnLike, start: ColumnLike) -> Column:
    return F.datediff(_c(end), _c(start))


def minute_key(ts: ColumnLike) -> Column:
    return F.date_format(_c(ts), "yyyyMMddHHmm")


def round_half_up(value: ColumnLike, digits: int) -> Column:
    """Round half away from zero on the decimal value, as NUMERIC does; never ``-0.0``."""
    return F.round(_c(value).cast("decimal(28,10)"), digits).cast("double") + F.lit(0.0)


def bucket(value: ColumnLike, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first bound that ``value`` does not exceed; the last label otherwise."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("one label more than bounds is needed")
    v = _c(value)
    out = F.when(v <= bounds[0], labels[0])
    for bound, label in zip(bounds[1:], labels[1:-1]):
        out = out.when(v <= bound, label)
    return out.otherwise(labels[-1])


def mask_credentials(url: ColumnLike) -> Column:
    """What follows the last ``@``; the whole text if there is none."""
    return F.substring_index(_c(url), "@", -1)


def label(*parts: ColumnLike | int) -> Column:
    """Concatenate texts, columns and numbers into one text."""
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])


def embedding_text(title: ColumnLike, abstract: ColumnLike) -> Column:
    """The text a document is embedded from."""
    return F.concat(F.lit("Título: "), _c(title), F.lit(" | Abstract: "), _c(abstract))


def words(text: ColumnLike) -> Column:
    """Lower-case words of a text, split on blanks."""
    squeezed = F.trim(F.regexp_replace(F.lower(_c(text)), r"\s+", " "))
    return F.when(squeezed == "", F.array().cast("array<string>")).otherwise(F.split(squeezed, " "))
