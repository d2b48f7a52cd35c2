"""Checks of the declared constraints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmart.contracts import Contract


def missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of NULLs in each column that may not hold any; one pass."""
    sums = [F.coalesce(F.sum(F.col(c).isNull().cast("long")), F.lit(0)).alias(c) for c in columns]
    wide = df.agg(*sums)
    pairs = F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).cast("long").alias("nulos")) for c in columns])
    return wide.select(F.inline(pairs))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; NULL keys never clash."""
    present = df
    for k in keys:
        present = present.filter(F.col(k).isNotNull())
    return present.groupBy(*keys).agg(F.count("*").alias("veces")).filter("veces > 1")


def orphans(child: DataFrame, parent: DataFrame, foreign_key: str, parent_key: str) -> DataFrame:
    """References without a parent and how often they occur.

    References are counted before the join, so a hot one is a single row.
    """
    used = child.filter(F.col(foreign_key).isNotNull()).groupBy(foreign_key).agg(F.count("*").alias("filas"))
    known = parent.select(F.col(parent_key).alias(foreign_key))
    return used.join(known, foreign_key, "left_anti")


def row_rules(contract: Contract) -> dict[str, Column]:
    """Violations a row shows by itself, by name."""
    rules = {f"{c}_null": F.col(c).isNull() for c in contract.required}
    rules |= {f"{c}_domain": F.col(c).isNotNull() & ~F.col(c).isin(*v) for c, v in contract.domains.items()}
    rules |= {f"{c}_length": F.char_length(c) > n for c, n in contract.max_length.items()}
    rules |= {f"{c}_minimum": F.col(c) < n for c, n in contract.minimum.items()}
    rules |= {f"{c}_pattern": F.col(c).isNotNull() & ~matches(c, p) for c, p in contract.pattern.items()}
    return rules


def matches(column: str, pattern: str) -> Column:
    """Case-insensitive regular expression."""
    return F.col(column).rlike(f"(?i){pattern}")


def with_reasons(df: DataFrame, rules: Mapping[str, Column], name: str = "motivos") -> DataFrame:
    """Add the list of violated rules; one pass over the rows."""
    marks = [F.when(F.coalesce(test, F.lit(False)), F.lit(rule)) for rule, test in rules.items()]
    return df.withColumn(name, F.array_compact(F.array(*marks)))


class Violations(ValueError):
    """A load that must be clean is not."""


def split_valid(df: DataFrame, rules: Mapping[str, Column], policy: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """Valid rows and quarantined rows with their reasons; ``fail`` raises instead."""
    marked = with_reasons(df, rules)
    good = marked.filter(F.size("motivos") == 0).drop("motivos")
    bad = marked.filter(F.size("motivos") > 0)
    if policy == "fail":
        first = bad.limit(1).collect()
        if first:
            raise Violations(str(first[0]["motivos"]))
    return good, bad


def key_violations(frames: Mapping[str, DataFrame], contract: Contract) -> DataFrame:
    """Violated unique and foreign keys of one table, counted: ``(regla, filas)``."""
    df = frames[contract.name]
    parts = []
    for keys in (contract.keys, *contract.unique):
        bad = duplicate_keys(df, keys)
        parts.append(bad.agg(F.coalesce(F.sum("veces"), F.lit(0)).alias("filas")).select(F.lit("unique:" + ",".join(keys)).alias("regla"), "filas"))
    for fk, (parent, key) in contract.foreign.items():
        if parent in frames:
            bad = orphans(df, frames[parent], fk, key)
            parts.append(bad.agg(F.coalesce(F.sum("filas"), F.lit(0)).alias("filas")).select(F.lit(f"foreign:{fk}").alias("regla"), "filas"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def freshness(control: DataFrame, run_ts: Column) -> DataFrame:
    """Seconds since every source was loaded last."""
    age = F.unix_timestamp(run_ts) - F.unix_timestamp("ultima_corrida")
    return control.select("tabla_origen", "ultimo_procesado", "ultima_corrida", age.alias("segundos"))


def row_counts(frames: Mapping[str, DataFrame], expected: Mapping[str, int | None]) -> DataFrame:
    """Rows per table against the expected number; None asks for at least one row."""
    parts = []
    for name, df in frames.items():
        want = expected.get(name)
        ok = F.col("filas") > 0 if want is None else F.col("filas") == want
        parts.append(df.agg(F.count("*").alias("filas")).select(F.lit(name).alias("tabla"), "filas", ok.alias("correcto")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
