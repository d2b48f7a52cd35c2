"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source with ``n`` rows whose target share of ``total`` rows is ``w`` has a mean of ``total * w / n`` copies a row. Each row's
count inverts the Poisson distribution at a uniform number from a hash of seed and id, so it does not depend on
partitions or retries; the row is exploded by it, and the copies are dealt out and ordered by another hash.
Large means are drawn as a sum of draws of mean ``PIECE`` at most, which keeps the inversion exact.

A null source is a source. A row without an id is drawn by its text. Rows that repeat an id get the same count.
A source without a target weight, or of weight 0, vanishes; an empty table gives an empty one. Texts do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmart.llm.common import written

PIECE, SEED = 16.0, "mix-1"


def source_key(source: Column) -> Column:
    """The source as text that tells null and '' apart."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def uniform(*parts: Column) -> Column:
    """A number from 0 to 1 of 52 bits from an md5 hash, which other engines can repeat."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def tempered(docs: DataFrame, power: float = 0.5) -> DataFrame:
    """Target weights ``(source_key, weight)`` that follow the counts of the sources to a power."""
    return docs.groupBy(source_key(F.col("source")).alias("source_key")).agg(F.pow(F.count("*").cast("double"), F.lit(power)).alias("weight"))


def rates(docs: DataFrame, weights: DataFrame, total: int | None = None) -> DataFrame:
    """One row for each source: the number of draws a row, and the distribution of a draw."""
    counts = docs.groupBy(source_key(F.col("source")).alias("source_key")).agg(F.count("*").alias("n"))
    both = counts.join(weights, "source_key")
    sums = both.agg(F.sum("n").alias("all_n"), F.sum("weight").alias("all_w"))  # one row
    wanted = F.lit(float(total)) if total is not None else F.col("all_n").cast("double")
    rate = wanted * F.col("weight") / F.col("all_w") / F.col("n")
    out = both.join(F.broadcast(sums)).where("weight > 0").select("source_key", rate.alias("rate"))
    out = out.withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / PIECE)).cast("int")).withColumn("mean", F.col("rate") / F.col("draws"))
    top = F.ceil(F.col("mean") + 12 * F.sqrt("mean") + 24).cast("int")
    steps = F.sequence(F.lit(1), top)
    weight = lambda k: F.exp(-F.col("mean")) * F.aggregate(steps, F.lit(1.0), lambda a, i: F.when(i <= k, a * F.col("mean") / i).otherwise(a))
    out = out.withColumn("p", F.transform(F.sequence(F.lit(0), top), weight))
    return out.withColumn("cdf", F.transform("p", lambda _, i: F.aggregate(F.slice("p", 1, i + 1), F.lit(0.0), lambda a, x: a + x))).select("source_key", "draws", "cdf")


def mix(docs: DataFrame, weights: DataFrame | None = None, total: int | None = None, seed: str = SEED) -> DataFrame:
    """Rows of ``docs`` in random order, each as often as drawn, with ``copy_no`` from 0; clashing columns stay as they are,
    except ``copy_no``, which is replaced."""
    plan = written(rates(docs, tempered(docs) if weights is None else weights, total), "rates")
    whole = docs.select(F.struct("*").alias("row"), source_key(F.col("source")).alias("source_key"), F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))).alias("draw_id"))
    drawn = whole.join(plan, "source_key").select(
        "row", "draw_id", F.aggregate(F.sequence(F.lit(0), F.col("draws") - 1), F.lit(0), lambda a, j: a + F.size(F.filter("cdf", lambda c: c <= uniform(F.lit(seed), F.col("draw_id"), j.cast("string"))))).alias("copies")
    )
    copies = drawn.where("copies > 0").select("row", "draw_id", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy_no"))
    place = F.xxhash64(F.lit(seed), F.lit("order"), F.col("draw_id"), F.col("copy_no"))
    dealt = copies.withColumn("place", place).repartition("place").sortWithinPartitions("place")
    return dealt.select(*(F.col("row")[c].alias(c) for c in docs.columns if c != "copy_no"), "copy_no")
