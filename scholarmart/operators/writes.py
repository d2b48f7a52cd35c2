"""Upserts, updates and deletes as DataFrame to DataFrame operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _changed(pairs: Sequence[tuple[Column, Column]]) -> Column:
    out = F.lit(False)
    for old, new in pairs:
        out = out | ~old.eqNullSafe(new)
    return out


def upsert(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    touch: tuple[str, Column] | None = None,
) -> DataFrame:
    """Insert new keys and overwrite ``update_cols`` of known ones (all columns by default).

    ``touch=(column, value)`` sets a change stamp on rows whose values really differ.
    ``delta`` must hold each key once.
    """
    values = [c for c in target.columns if c not in keys]
    updated = set(values if update_cols is None else update_cols)
    old = target.select(*keys, F.struct(*values, F.lit(True).alias("_here")).alias("_old"))
    new = delta.select(*keys, F.struct(*values, F.lit(True).alias("_here")).alias("_new"))
    both = old.join(new, list(keys), "full_outer")
    is_new = F.col("_new._here").isNotNull()
    is_old = F.col("_old._here").isNotNull()
    out = {}
    for c in values:
        fresh, kept = F.col(f"_new.{c}"), F.col(f"_old.{c}")
        out[c] = F.when(is_new, fresh).otherwise(kept) if c in updated else F.when(is_old, kept).otherwise(fresh)
    if touch:
        column, stamp = touch
        differs = _changed([(F.col(f"_old.{c}"), F.col(f"_new.{c}")) for c in values if c in updated and c != column])
        out[column] = F.when(is_new & is_old & differs, stamp).when(is_old, F.col(f"_old.{column}")).otherwise(F.col(f"_new.{column}"))
    return both.select(*keys, *[out[c].alias(c) for c in values]).select(*target.columns)


def upsert_add(target: DataFrame, delta: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Insert new keys and add the measures of known ones."""
    kinds = {f.name: f.dataType for f in target.schema}
    both = target.select(*keys, *measures).unionByName(delta.select(*keys, *measures))
    sums = [F.sum(m).cast(kinds[m]).alias(m) for m in measures]
    return both.groupBy(*keys).agg(*sums).select(*[c for c in target.columns if c in {*keys, *measures}])


def insert_ignore(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert only keys the target does not hold; equal keys inside ``delta`` go in once."""
    fresh = delta.dropDuplicates(list(keys)).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column], touch: tuple[str, Column] | None = None) -> DataFrame:
    """Set columns on the rows that meet a condition."""
    hit = F.coalesce(condition, F.lit(False))
    changes = dict(values)
    if touch:
        column, stamp = touch
        changes[column] = F.when(_changed([(F.col(c), v) for c, v in values.items()]), stamp).otherwise(F.col(column))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in changes.items()})


def soft_delete(dim: DataFrame, condition: Column, as_of: Column) -> DataFrame:
    return update_where(dim, condition, {"is_deleted": F.lit(True), "deleted_at": as_of})


class DuplicateKeys(ValueError):
    """A source of an update holds a key more than once."""


def update_from(
    df: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str], check_unique: bool = True
) -> DataFrame:
    """Overwrite ``columns`` with the values of a source that is unique per key after removing equal rows."""
    distinct = source.select(*keys, *columns).distinct()
    if check_unique and distinct.groupBy(*keys).count().filter("count > 1").limit(1).count():
        raise DuplicateKeys(f"source is not unique on {list(keys)}")
    fresh = distinct.select(*keys, F.struct(*columns).alias("_src"))
    joined = df.join(fresh, list(keys), "left")
    hit = F.col("_src").isNotNull()
    return joined.withColumns({c: F.when(hit, F.col(f"_src.{c}")).otherwise(F.col(c)) for c in columns}).select(*df.columns)


def purge(df: DataFrame, removed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Physically remove the rows whose key is on the list."""
    return df.join(removed.select(*keys).distinct(), list(keys), "left_anti")


def cascade(children: DataFrame, removed: DataFrame, foreign_key: str, parent_key: str) -> DataFrame:
    """Children of removed parents go as well."""
    gone = removed.select(F.col(parent_key).alias(foreign_key)).distinct()
    return children.join(gone, foreign_key, "left_anti").select(*children.columns)


def set_null(children: DataFrame, removed: DataFrame, foreign_key: str, parent_key: str) -> DataFrame:
    """Children of removed parents stay, without their reference."""
    gone = removed.select(F.col(parent_key).alias(foreign_key)).distinct().withColumn("_gone", F.lit(True))
    joined = children.join(gone, foreign_key, "left")
    return joined.withColumn(foreign_key, F.when(F.col("_gone").isNull(), F.col(foreign_key))).select(*children.columns)


def restricted(removed: DataFrame, children: DataFrame, parent_key: str, foreign_key: str) -> DataFrame:
    """Parents that may not be removed, with the number of children that hold them."""
    held = children.filter(F.col(foreign_key).isNotNull()).groupBy(F.col(foreign_key).alias(parent_key)).agg(
        F.count("*").alias("children")
    )
    return removed.select(parent_key).distinct().join(held, parent_key)


def touch_changed(before: DataFrame, after: DataFrame, keys: Sequence[str], stamp: Column, column: str = "updated_at") -> DataFrame:
    """Set the change stamp of the rows that differ from their earlier version."""
    values = [c for c in after.columns if c not in keys and c != column]
    old = before.select(*keys, F.struct(*values).alias("_old"))
    joined = after.join(old, list(keys), "left")
    differs = F.col("_old").isNotNull() & ~F.struct(*values).eqNullSafe(F.col("_old"))
    return joined.withColumn(column, F.when(differs, stamp).otherwise(F.col(column))).select(*after.columns)


def before_after(before: DataFrame, after: DataFrame, measure: Column, name: str) -> DataFrame:
    """One row with a measure before and after a change."""
    old = before.agg(measure.alias("v")).select(F.lit("b").alias("k"), "v")
    new = after.agg(measure.alias("v")).select(F.lit("a").alias("k"), "v")
    pick = lambda k: F.max(F.when(F.col("k") == k, F.col("v")))
    return old.unionByName(new).agg(pick("b").alias(f"{name}_antes"), pick("a").alias(f"{name}_despues"))
