"""Near copies by MinHash with tensored banding.

Two collections of ``HALVES`` short hashes are drawn, each of ``ROWS`` minima. A table of the index is a pair of one hash
of either collection, so ``HALVES ** 2`` tables of ``2 * ROWS`` minima need ``2 * HALVES * ROWS`` minima only, about a
square root of the work of independent tables. Candidates are confirmed on their full sets.

A document's set holds the distinct shingles of ``size`` words (``[^\\x20\\x09-\\x0D]+``, A-Z in lower case); with fewer words the
whole sequence is one shingle; a null text or one without words has an empty set and is linked with nothing.
Shingles are compared by 64-bit hashes. Rows whose sets are equal form a class, and only classes are compared. Rows without
an id belong to their class, but never represent it where another has an id. Rows that repeat an id are reported
one by one and linked through it. Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmart.llm.common import WordHashes, bitmap, in_bitmap, minima, mixed, permutations, shingles, words_of, written
from scholarmart.llm.components import link

HALVES, ROWS, SEED = 12, 3, 41
SKETCH = "doc_id long, n_shingles long, c1 long, c2 long, halves array<long>"


def _sketches(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, (factors, offsets) = WordHashes(), permutations(2 * HALVES * ROWS, SEED)
        for batch in batches:
            out = []
            for text in batch["text"]:
                own = np.unique(shingles(hashes.of(words_of(text)), size))
                if not len(own):
                    out.append((0, 0, 0, None))
                    continue
                low = halves = None
                if len(own) >= 4:  # a smaller set is 0.8 like no other
                    low = minima(own, factors, offsets).reshape(2 * HALVES, ROWS)
                    halves = mixed(mixed(mixed(low[:, 0]) + low[:, 1]) + low[:, 2]).view(np.int64)
                first, second = own.sum(dtype=np.uint64), mixed(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
                out.append((len(own), first.astype(np.int64), second.astype(np.int64), halves))
            frame = pd.DataFrame(out, columns=["n_shingles", "c1", "c2", "halves"])
            frame.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield frame

    return run


def _sets(size: int, wanted):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            batch = batch[in_bitmap(wanted.value, batch["h"].to_numpy())]
            rows = [np.unique(shingles(hashes.of(words_of(text)), size)).view(np.int64) for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), "s": pd.Series(rows, dtype=object), "c1": [r.view(np.uint64).sum(dtype=np.uint64).astype(np.int64) for r in rows]})

    return run


def near_groups(docs: DataFrame, size: int = 5) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``; links need ``100 * |A ∩ B| >= 80 * |A ∪ B|``."""
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = written(slim.mapInPandas(_sketches(size), SKETCH), "sketches")
    classes = written(sketches.where("n_shingles > 0").groupBy("c1", "c2").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("halves").alias("halves")), "classes")

    single = classes.where("id is not null and halves is not null").select("id", "n", F.posexplode("halves").alias("i", "half"))
    shared = written(single.groupBy("i", "half").count().where("count > 1").select("i", "half"), "shared")
    live = single.join(shared, ["i", "half"]).groupBy("id", "n").agg(
        F.collect_list(F.when(F.col("i") < HALVES, F.struct("i", "half"))).alias("left"), F.collect_list(F.when(F.col("i") >= HALVES, F.struct("i", "half"))).alias("right")
    )
    keys = live.select("id", "n", F.explode("left").alias("l"), "right").select("id", "n", "l", F.explode("right").alias("r")).select(F.xxhash64("l.i", "l.half", "r.i", "r.half").alias("key"), "id", "n")
    keys = written(keys, "tables")
    crowded = written(keys.groupBy("key").count().where("count > 1").select("key"), "crowded")
    keys = written(keys.join(crowded, "key"), "candidates")

    wanted = keys.select("id").distinct()
    seen = spark.sparkContext.broadcast(bitmap(wanted.select(F.xxhash64("id"))))
    sets = slim.where("doc_id is not null").select("doc_id", "text", F.xxhash64("doc_id").alias("h")).mapInPandas(_sets(size, seen), "doc_id long, s array<long>, c1 long")
    owner = classes.select(F.col("id").alias("doc_id"), "c1").where("doc_id is not null")
    sets = written(sets.join(owner, ["doc_id", "c1"]).join(wanted.withColumnRenamed("id", "doc_id"), "doc_id").select(F.col("doc_id").alias("id"), "s").dropDuplicates(["id"]), "sets")

    found = link(keys, sets)
    of_class = written(classes.select("c1", "c2", "id").join(found, "id", "left").select("c1", "c2", F.coalesce("component", "id").alias("component_id")), "of_class")
    out = sketches.join(of_class, ["c1", "c2"], "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, size: int = 5) -> DataFrame:
    """The rows of ``docs`` that represent their group, with all their columns; rows that repeat an id are judged as one."""
    verdict = near_groups(docs, size).where("not kept").select(F.col("doc_id").alias("gone")).where("gone is not null").distinct()
    dropped = written(verdict, "dropped")
    whole = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("own"))
    return whole.join(dropped, F.col("own") == F.col("gone"), "left_anti").select("row.*")
