"""Benchmark items inside documents: size-partitioned MinHash containment search, then exact shingle containment.

Items are partitioned by the number of their shingles, in powers of two. For a partition of items of at most ``U`` shingles,
a document is seen as windows of two neighbouring blocks of ``U`` shingles, so an item lies within one window however long
the document is, and containment of 0.8 means a similarity of about 0.2 or more to that window. A window's minima under
``HASHES`` permutations are looked up among the items' minima: at that similarity, one of 32 agrees with
a probability above 0.998, and for a whole item above 0.9999. Candidates are confirmed by counting the
item's distinct shingles that the whole document contains.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` with A-Z in lower case. A shingle has ``size`` words; an item of fewer words
is one shingle of all of them, and is looked for as such. Items without words or without an id find nothing, and null or empty
texts contain nothing. Rows that repeat an id are searched one by one; the best containment is returned.

Nothing of the corpus is gathered: tasks get two bitmaps of fixed size and send on what they may hold; exact joins follow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmart.llm.common import WordHashes, bitmap, in_bitmap, mixed, permutations, shingles, written

HASHES, SEED, CHUNK = 32, 97, 8192
#: everything but 0-9, a-z and what is not ASCII separates words
SEPARATORS = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def plain_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().translate(SEPARATORS).split() if text else []


def size_class(n: int) -> int:
    """The smallest power of two that is not below ``n``."""
    return 1 << max(0, int(n) - 1).bit_length()


def _keyed(low: np.ndarray, width: int, cls: int) -> np.ndarray:
    """Join keys of minima with one row for each permutation."""
    tag = np.arange(HASHES, dtype=np.uint64) + np.uint64(width * 1_000_003 + cls * 4_099)
    return mixed(low + mixed(tag)[:, None]).view(np.int64)


def _item_rows(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, (factors, offsets) = WordHashes(), permutations(HASHES, SEED)
        for batch in batches:
            out = []
            for item, text in zip(batch["item_id"], batch["text"]):
                words = hashes.of(plain_words(text))
                if len(words):
                    own, width = np.unique(shingles(words, size)), min(size, len(words))
                    low = (own[None, :] * factors + offsets).min(axis=1)[:, None]
                    out.append((item, len(own), width, size_class(len(own)), own.view(np.int64), _keyed(low, width, size_class(len(own)))[:, 0]))
            yield pd.DataFrame(out, columns=["item_id", "n", "width", "cls", "own", "keys"])

    return run


def _window_keys(values: np.ndarray, width: int, classes: list[int], factors, offsets, known: np.ndarray) -> np.ndarray:
    found = []
    for at in range(0, len(values), CHUNK):
        part = values[at : at + CHUNK + 2 * max(classes)]
        low = part[None, :] * factors + offsets
        for cls in classes:
            blocks = np.minimum.reduceat(low, np.arange(0, part.size, cls), axis=1)
            windows = np.minimum(blocks[:, :-1], blocks[:, 1:]) if blocks.shape[1] > 1 else blocks
            keys = _keyed(windows, width, cls).reshape(-1)
            found.append(keys[in_bitmap(known, keys)])
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


def _search(size: int, classes: dict[int, list[int]], known_keys, known_shingles):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, (factors, offsets) = WordHashes(), permutations(HASHES, SEED)
        for batch in batches:
            out = []
            for uid, doc, text in zip(batch["uid"], batch["doc_id"], batch["text"]):
                words = hashes.of(plain_words(text))
                runs = {width: shingles(words, width) for width in classes if width <= len(words)}
                keys = [_window_keys(runs[width], width, classes[width], factors, offsets, known_keys.value) for width in runs]
                keys = np.concatenate(keys) if keys else np.empty(0, np.int64)
                if len(keys):
                    own = np.unique(np.concatenate(list(runs.values()))).view(np.int64)
                    out.append((uid, doc, keys, own[in_bitmap(known_shingles.value, own)]))
            yield pd.DataFrame(out, columns=["uid", "doc_id", "keys", "own"]).astype({"uid": "int64"})

    return run


def _uid():
    return F.xxhash64("doc_id", "text")


def _found(docs: DataFrame, items: DataFrame, size: int, tenths: int) -> DataFrame:
    """``uid, doc_id, item_id, n_shingles, n_found`` of confirmed items."""
    spark = docs.sparkSession
    rows = items.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = written(rows.mapInPandas(_item_rows(size), "item_id long, n long, width int, cls long, own array<long>, keys array<long>"), "items")
    classes: dict[int, list[int]] = {}
    for width, cls in sorted(map(tuple, rows.select("width", "cls").distinct().collect())):  # at most a few dozen
        classes.setdefault(width, []).append(cls)
    item_keys, item_shingles = rows.select("item_id", F.explode("keys").alias("key")), rows.select("item_id", "n", F.explode("own").alias("shingle"))
    known_keys, known_shingles = (spark.sparkContext.broadcast(bitmap(x)) for x in (item_keys.select("key"), item_shingles.select("shingle")))

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select(_uid().alias("uid"), "doc_id", "text")
    hits = written(slim.mapInPandas(_search(size, classes, known_keys, known_shingles), "uid long, doc_id long, keys array<long>, own array<long>"), "hits")
    pairs = hits.select("uid", F.explode("keys").alias("key")).join(item_keys, "key").select("uid", "item_id").distinct()
    # shared shingles are counted for these candidates only, so a phrase of many documents and items makes no rows of its own
    held = hits.select("uid", "doc_id", "own").join(pairs, "uid").select("uid", "doc_id", "item_id", F.explode("own").alias("shingle")).distinct()
    counts = held.join(item_shingles, ["item_id", "shingle"]).groupBy("uid", "doc_id", "item_id").agg(F.max("n").alias("n_shingles"), F.count("*").alias("n_found"))
    return counts.where(10 * F.col("n_found") >= tenths * F.col("n_shingles"))


def contained_items(docs: DataFrame, items: DataFrame, size: int = 5, tenths: int = 8) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_found, containment`` for every item of which a document holds ``tenths`` tenths."""
    found = _found(docs, items, size, tenths).groupBy("doc_id", "item_id").agg(F.max("n_shingles").alias("n_shingles"), F.max("n_found").alias("n_found"))
    return found.withColumn("containment", F.col("n_found") / F.col("n_shingles"))


def without_items(docs: DataFrame, items: DataFrame, size: int = 5, tenths: int = 8) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    gone = written(_found(docs, items, size, tenths).select(F.col("uid").alias("gone")).distinct(), "leaks")
    whole = docs.select(F.struct("*").alias("row"), F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("uid"))
    return whole.join(gone, F.col("uid") == F.col("gone"), "left_anti").select("row.*")
