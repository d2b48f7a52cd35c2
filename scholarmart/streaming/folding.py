"""A sink of counts by event day that folds itself.

Every micro-batch adds its counts as one folder for each of its days to a versioned table (``sources/versions.py``). A day that has
gathered ``most`` folders is read and written again as one, in the same commit as the batch, so a day never has more than ``most``
folders however long the stream runs, and days without new events are left alone. With ``keep_days``, days that lie further back from the latest day
than that expire: they leave the table, and later rows of them are ignored. With ``grain="month"`` the folders hold months of days, for streams that bring
years of them at once; then nothing may expire.

A batch is committed with its number: one that is run again after a failure changes nothing. Replaced files are deleted by
``versions.vacuum`` while the stream runs, once ``spare_seconds`` have passed in which readers may still use them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from scholarmart.sources import versions
from scholarmart.streaming.jobs import run_each

TABLE, PART = "counts", "_dia"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _schema(rows: DataFrame, keys: Sequence[str]) -> T.StructType:
    fields = [T.StructField(k, rows.schema[k].dataType) for k in keys]
    return T.StructType([T.StructField("dia", T.DateType()), *fields, T.StructField("n", T.LongType())])


def _write(counts: DataFrame, root: str, grain: str) -> dict[str, list[str]]:
    first = F.trunc("dia", "month") if grain == "month" else F.col("dia")
    laid = counts.withColumn(PART, first.cast("string")).hint("rebalance", PART)
    return versions.write_parts(laid, root, versions.new_folder(), PART)


def _oldest(days: Sequence[str], keep_days: int | None) -> str:
    """The first day that is kept; the latest day of the events decides, so a replay comes to the same."""
    known = [d for d in days if d != _NO_DAY]
    return str(dt.date.fromisoformat(max(known)) - dt.timedelta(days=keep_days)) if keep_days is not None and known else ""


def fold_batch(batch: DataFrame, batch_id: int, root: str, keys: Sequence[str], day: Column, most: int = 16, keep_days: int | None = None, spare_seconds: float = 86400, grain: str = "day") -> None:
    """Add the counts of one batch; days with ``most`` folders become one, expired ones go."""
    if grain not in ("day", "month") or (grain == "month" and keep_days is not None):
        raise ValueError("the grain is day or month, and only days expire")
    spark = batch.sparkSession
    base = versions.manifest(spark, root)
    if base.runs and int(base.runs[-1]) >= batch_id:
        return
    counts = batch.groupBy(day.cast("date").alias("dia"), *keys).agg(F.count("*").alias("n"))
    schema = _schema(batch, keys)
    fresh = _write(counts, root, grain)
    now = {d: [*folders] for d, folders in base.tables.get(TABLE, {}).items()}
    for d, folders in fresh.items():
        now.setdefault(d, []).extend(folders)
    oldest = _oldest(list(now), keep_days)
    now = {d: folders for d, folders in now.items() if d == _NO_DAY or d >= oldest}
    full = [d for d, folders in now.items() if len(folders) >= most]
    if full:
        whole = versions.scan(spark, root, versions.Manifest(1, {TABLE: now}), TABLE, schema, full)
        now.update(_write(whole.groupBy("dia", *keys).agg(F.sum("n").alias("n")), root, grain))
    versions.commit(spark, root, base, replaced={TABLE: now}, run=str(batch_id), forget_runs=True)
    if batch_id % most == most - 1:
        versions.vacuum(spark, root, spare_seconds)


def fold_counts(stream: DataFrame, root: str, checkpoint: str, keys: Sequence[str], day: Column, most: int = 16, keep_days: int | None = None, spare_seconds: float = 86400, grain: str = "day") -> StreamingQuery:
    """Count the rows of a stream by day and keys into a folding sink; takes what is there and stops."""
    return run_each(stream, checkpoint, lambda batch, batch_id: fold_batch(batch, batch_id, root, keys, day, most, keep_days, spare_seconds, grain))


def folded(spark: SparkSession, root: str, keys: T.StructType, since: dt.date | None = None, grain: str = "day") -> DataFrame:
    """``dia``, the keys and ``n``, summed over what is not folded yet; ``since`` reads the folders from that day on only."""
    schema = T.StructType([T.StructField("dia", T.DateType()), *keys.fields, T.StructField("n", T.LongType())])
    now = versions.manifest(spark, root)
    if since is None:
        rows = versions.scan(spark, root, now, TABLE, schema)
    else:
        first = str(since.replace(day=1) if grain == "month" else since)
        parts = [d for d in now.tables.get(TABLE, {}) if d != _NO_DAY and d >= first]
        rows = versions.scan(spark, root, now, TABLE, schema, parts).filter(F.col("dia") >= F.lit(since))
    return rows.groupBy("dia", *keys.names).agg(F.sum("n").alias("n"))
