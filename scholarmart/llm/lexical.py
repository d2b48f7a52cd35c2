"""Ranked lexical search of many items by one Aho-Corasick scan over the texts, without an index of the documents.

The terms of all items form one automaton, each guarded by a blank on either side; separators of a text become blanks, so a match is a
whole term, and neighbouring terms share a blank. A first scan counts, for every term, the documents that hold it, and
all terms of all texts; a second one counts the terms of each text again, maps them to their items, and scores all items of the
text at once in 64-bit integers. A task keeps the best ``k`` of each item and passes on no others; the lists of the tasks
are merged in groups of tasks first, then whole. Texts neither move nor are stored.

Terms are maximal runs of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]`` with A-Z in lower case. What tasks are sent is bounded: items are dealt
into blocks until the terms of each fill ``BLOCK_BYTES`` at most (an item that is larger by itself has a block of its own), and every
block is searched by itself. Rows of items that repeat an id are one item with the terms of all; items without an id or without
terms find nothing. Every row of documents ranks by itself, equal scores by rising id, rows without an id last. Null and empty texts
have no terms. Without any term in the texts there is no result. Other columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scholarmart.llm.common import written
from scholarmart.llm.decontamination import SEPARATORS

#: bytes of the terms of a block of items
BLOCK_BYTES = 4 << 20
#: groups of tasks in which lists are merged first
GROUPS = 256
#: candidates that a task gathers before it cuts them to the best of each item
PENDING = 1 << 18
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def guarded(text: str | None) -> tuple[str, int]:
    """A text with blanks for separators and at both ends, and the number of its terms."""
    data = text.encode("utf-8", "surrogatepass").lower().translate(SEPARATORS) if text else b""
    return f" {data.decode('utf-8', 'surrogatepass')} ", len(data.split())


class Block:
    """The terms of some items, and for each term the items that hold it."""

    def __init__(self, pairs: list[tuple[int, str]]):
        self.items = sorted({i for i, _ in pairs})
        self.terms = sorted({t for _, t in pairs})
        place, number = ({x: k for k, x in enumerate(xs)} for xs in (self.items, self.terms))
        owners = np.array(sorted((number[t], place[i]) for i, t in pairs), np.int64).reshape(-1, 2)
        self.owners = owners[:, 1]
        self.begins = np.searchsorted(owners[:, 0], np.arange(len(self.terms) + 1))


@lru_cache(maxsize=1)
def automaton(terms: tuple[str, ...]) -> ahocorasick.Automaton:
    made = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for number, term in enumerate(terms):
        made.add_word(f" {term} ", number)
    made.make_automaton()
    return made


def frequencies(search: ahocorasick.Automaton, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the terms in a guarded text, rising, and how often each occurs."""
    return np.unique(np.fromiter((number for _, number in search.iter(text)), np.int64), return_counts=True)


def _count(block):
    """Rows ``term, total``: documents that hold a term; under -1 documents with a term at all, under -2 terms of all texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        search = automaton(tuple(block.value.terms))
        holding, documents, length = np.zeros(len(block.value.terms), np.int64), 0, 0
        for batch in batches:
            for text in batch["text"]:
                plain, n = guarded(text)
                documents, length = documents + (n > 0), length + n
                if n:
                    holding[frequencies(search, plain)[0]] += 1
        some = np.flatnonzero(holding)
        yield pd.DataFrame({"term": np.concatenate([some, [-1, -2]]), "total": np.concatenate([holding[some], [documents, length]])})

    return run


class Best:
    """The best ``k`` documents of each item seen by a task."""

    def __init__(self, items: int, k: int):
        self.k, self.bar, self.waiting, self.rows = k, np.ones(items, np.int64), 0, []

    def add(self, scores: np.ndarray, doc: int, nameless: bool) -> None:
        hit = np.flatnonzero(scores >= self.bar)  # an equal score may still have a smaller id
        if len(hit):
            self.rows.append((hit, scores[hit], np.full(len(hit), doc, np.int64), np.full(len(hit), nameless)))
            self.waiting += len(hit)
            if self.waiting > PENDING + 2 * self.k * len(self.bar):
                self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        if not self.rows:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        item, score, doc, nameless = (np.concatenate(x) for x in zip(*self.rows))
        order = np.lexsort((doc, nameless, -score, item))
        item, score, doc, nameless = (x[order] for x in (item, score, doc, nameless))
        place = np.arange(len(item)) - np.searchsorted(item, item)
        last = place == self.k - 1
        self.bar[item[last]] = score[last]
        kept = tuple(x[place < self.k] for x in (item, score, doc, nameless))
        self.rows, self.waiting = [kept], len(kept[0])
        return kept


def _score(block, weights, documents: int, length: int, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, weight = block.value, weights.value
        search, best = automaton(tuple(own.terms)), Best(len(own.items), k)
        for batch in batches:
            for doc, nameless, text in zip(batch["doc"].to_numpy(), batch["nameless"].to_numpy(), batch["text"]):
                plain, n = guarded(text)
                terms, tf = frequencies(search, plain) if n else ((), ())
                if len(terms):
                    m = 50 + 50 * n * documents // length
                    gained = weight[terms] * (1_000_000_000 * tf // (1000 * tf + 20 * m))
                    begin, held = own.begins[terms], own.begins[terms + 1] - own.begins[terms]
                    at = np.arange(held.sum()) + np.repeat(begin - (np.cumsum(held) - held), held)
                    scores = np.zeros(len(own.items), np.int64)
                    np.add.at(scores, own.owners[at], np.repeat(gained, held))
                    best.add(scores, doc, nameless)
        item, score, doc, nameless = best.cut()
        yield pd.DataFrame({"item_id": np.asarray(own.items, np.int64)[item], "score": score, "doc": doc, "nameless": nameless})

    return run


def _blocks(items: DataFrame, most: int) -> list[Block]:
    """Items dealt by hash into as many blocks as are needed to keep the terms of each below ``most`` bytes."""
    plain = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    terms = items.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), F.explode(F.regexp_extract_all(plain, F.lit(TERM), F.lit(0))).alias("term"))
    terms = written(terms.distinct(), "item-terms")
    sizes = written(terms.groupBy("item_id").agg(F.sum(F.octet_length("term") + 16).alias("bytes")), "item-sizes")
    total, largest, n = sizes.agg(F.sum("bytes"), F.max("bytes"), F.count("*")).first()
    if not n:
        return []
    parts = -(-total // most)
    block = lambda: F.pmod(F.xxhash64("item_id"), F.lit(parts))
    while parts < 64 * n and sizes.groupBy(block().alias("b")).agg(F.sum("bytes").alias("s")).agg(F.max("s")).first()[0] > max(most, largest):
        parts *= 2
    return [Block([tuple(r) for r in terms.where(block() == b).collect()]) for b in range(parts)]


def search(docs: DataFrame, items: DataFrame, k: int = 50, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the best ``k`` rows of ``docs`` for every item, with a score above 0."""
    spark = docs.sparkSession
    slim = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc"), F.col("doc_id").isNull().alias("nameless"), F.col("text").cast("string").alias("text"))
    lists = spark.createDataFrame([], "item_id long, score long, doc long, nameless boolean")
    for block in _blocks(items, block_bytes):
        if not block.items:
            continue
        sent = spark.sparkContext.broadcast(block)
        counts = dict(slim.select("text").mapInPandas(_count(sent), "term long, total long").groupBy("term").agg(F.sum("total")).collect())
        documents, length = counts.pop(-1, 0), counts.pop(-2, 0)
        if documents:
            weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * counts.get(t, 0) + 1))) for t in range(len(block.terms))], np.int64)
            lists = lists.union(slim.mapInPandas(_score(sent, spark.sparkContext.broadcast(weights), documents, length, k), lists.schema))
    order = [F.desc("score"), "nameless", "doc"]
    lists = lists.withColumn("tasks", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    for keys in (["item_id", "tasks"], ["item_id"]):
        lists = lists.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return lists.select("item_id", "rank", F.when(~F.col("nameless"), F.col("doc")).alias("doc_id"), "score")
