"""Document fingerprints by MinHash in numpy, and near copies by bands of them.

A text's set holds the runs of ``WIDTH`` bytes of its UTF-8 form (a shorter text is one run), each mixed to 32 bits. A fingerprint is the
smallest value under each of ``PERMUTATIONS`` universal hash permutations ``a * x + b`` modulo 2**32 with odd ``a``, written in
hexadecimal; the share of equal places of two fingerprints estimates the Jaccard similarity of the sets. A null or
empty text has an empty set: its fingerprint is all ones, alike another empty one's and nothing else's.

For near copies, bands of ``BAND`` places are join keys in Spark and candidates are confirmed on whole sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scholarmart.llm.common import bitmap, in_bitmap, written
from scholarmart.llm.components import link

WIDTH, PERMUTATIONS, BAND, SEED, BLOCK = 8, 64, 4, 7, 2048
_RNG = np.random.default_rng(SEED)
FACTORS = (_RNG.integers(0, 2**31, PERMUTATIONS, np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
OFFSETS = _RNG.integers(0, 2**32, PERMUTATIONS, np.uint32)[:, None]
_MUL = np.uint64(0x9E3779B97F4A7C15)


def runs(data: bytes) -> np.ndarray:
    """Every run of ``WIDTH`` bytes as a mixed 32-bit value, repeats included."""
    if not data:
        return np.empty(0, np.uint32)
    raw = np.frombuffer(data if len(data) >= WIDTH else data.ljust(WIDTH, b"\xff"), np.uint8)
    grams = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(raw, WIDTH)).view(np.uint64)[:, 0]
    grams = (grams ^ (grams >> np.uint64(29))) * _MUL
    return (grams >> np.uint64(32)).astype(np.uint32)


def minhash(data: bytes) -> np.ndarray:
    """Smallest values under all permutations, in blocks that stay in the cache."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint32).max, np.uint32)
    values = runs(data)
    for at in range(0, len(values), BLOCK):
        np.minimum(low, (values[None, at : at + BLOCK] * FACTORS + OFFSETS).min(axis=1), out=low)
    return low


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def _bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


SLICED = "slice long, doc_id long, text string, own boolean"
OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by slice and falling id; every own row is compared with the row behind it in its slice."""
    before = None  # the slice, id, text and fingerprint of a row that waits for its next one

    def row(waiting, text: str, low: np.ndarray) -> tuple:
        _, doc, own, own_low = waiting
        half = len(own) // 2
        edited = _bytes(own[: len(own) - half] + text[:half])
        edited_low = minhash(edited)
        return doc, len(own), hashlib.sha256(edited).hexdigest(), own_low.tobytes().hex(), edited_low.tobytes().hex(), likeness(own_low, edited_low), likeness(own_low, low)

    for batch in batches:
        out = []
        for at, doc, text, own in zip(batch["slice"], batch["doc_id"], batch["text"], batch["own"]):
            text = text or ""
            low = minhash(_bytes(text))
            if before is not None and before[0] == at:
                out.append(row(before, text, low))
            before = (at, doc, text, low) if own else None
        frame = pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        yield frame


def fingerprints(docs: DataFrame, slice_rows: int = 1000) -> DataFrame:
    """Every row of ``docs`` with its fingerprint, its edited text's, and the next row's likeness.

    The next row has the next smaller id; after the smallest (or, if there are any, rows without an id) comes the largest.
    Rows that repeat an id follow each other in the falling order of their texts. Ids are cut into slices of equal range,
    one for ``slice_rows`` rows in the mean, and a slice's first row is also sent to the end of the slice before it, so no
    order over all rows is needed; within a task rows stream, so a crowded range takes longer but no more memory.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    low, high, count = slim.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    slices = max(1, count // slice_rows)
    step = max(1, -(-(high - low + 1) // slices)) if count and low is not None else 1
    at = F.when(F.col("doc_id").isNull(), F.lit(slices)).otherwise(F.expr(f"({high or 0}L - doc_id) div {step}"))
    own = slim.select(at.cast("long").alias("slice"), "doc_id", "text", F.lit(True).alias("own"))
    # one row of three numbers for each slice that is not empty
    heads = own.groupBy("slice").agg(F.max("doc_id").alias("head"))
    behind = F.coalesce(F.lag("slice").over(Window.orderBy("slice")), F.max("slice").over(Window.partitionBy()))
    heads = written(heads.select("slice", "head", behind.alias("before")), "heads")
    first = own.join(heads, (own["slice"] == heads["slice"]) & own["doc_id"].eqNullSafe(heads["head"]))
    tails = first.select(F.col("before").alias("slice"), "doc_id", "text", F.lit(False).alias("own"))
    both = own.union(tails).repartition("slice").sortWithinPartitions("slice", F.desc("own"), F.desc_nulls_last("doc_id"), F.desc("text"))
    return both.mapInPandas(_compare, OUT)


def _band_keys(low: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of minima; two bands with one key are compared as candidates, so a clash does no harm."""
    key = np.arange(1, len(low) + 1, dtype=np.uint64) * _MUL
    for column in low.T.astype(np.uint64):
        key = (key ^ column) * _MUL
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _banded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc, text in zip(batch["doc_id"], batch["text"]):
            data = _bytes(text)
            if data:
                low = minhash(data).reshape(-1, BAND)
                rows.append((doc, len(np.unique(runs(data))), _band_keys(low)))
        yield pd.DataFrame(rows, columns=["id", "n", "bands"])


def _sets(wanted):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[in_bitmap(wanted.value, batch["h"].to_numpy())]
            yield pd.DataFrame({"id": batch["doc_id"].to_numpy(), "s": pd.Series([np.unique(runs(_bytes(t))).astype(np.int64) for t in batch["text"]], dtype=object)})

    return run


def near_copies(docs: DataFrame) -> DataFrame:
    """``doc_id, component_id`` of the texts of similarity 0.8 or more to another, by bands and exact confirmation.

    Equal texts are first one class, represented by their smallest id; rows without an id take no part, and of rows that
    repeat an id the least text counts.
    """
    slim = docs.where("doc_id is not null and text <> ''").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.col("text").cast("string")).alias("text"))
    hashed = slim.select("doc_id", "text", F.md5(F.col("text").cast("binary")).alias("m"))
    classes = written(hashed.groupBy("m").agg(F.min("doc_id").alias("id")), "equal")
    owners = written(hashed.select("doc_id", "m").join(classes, "m").select("doc_id", "id"), "owners")
    texts = slim.join(owners.where("doc_id = id").select("doc_id"), "doc_id")
    banded = written(texts.mapInPandas(_banded, "id long, n long, bands array<long>"), "bands")
    keys = banded.select("id", "n", F.explode("bands").alias("key"))
    crowded = written(keys.groupBy("key").count().where("count > 1").select("key"), "crowded")
    keys = written(keys.join(crowded, "key"), "candidates")
    seen = docs.sparkSession.sparkContext.broadcast(bitmap(keys.select(F.xxhash64("id")).distinct()))
    sets = written(texts.select("doc_id", "text", F.xxhash64("doc_id").alias("h")).mapInPandas(_sets(seen), "id long, s array<long>"), "sets")

    found = link(keys, sets)
    grouped = owners.join(found, "id", "left").select("doc_id", F.coalesce("component", "id").alias("component_id"))
    several = written(grouped.groupBy("component_id").count().where("count > 1").select("component_id"), "several")
    return grouped.join(several, "component_id").select("doc_id", "component_id")
