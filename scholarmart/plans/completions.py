"""A stored table of completions: for every prefix of an entry the ``n`` best entries, built once and asked in batches.

An entry's place among those of a prefix never gets worse as the prefix grows, so an entry is stored as at most ``n`` runs: a place and the
lengths of its prefixes that have it. They are found over entries in order of the text, and a letter is a row only when it is read.

Runs lie in buckets by the first ``HEAD`` letters in a versioned folder (``sources/versions.py``); single prefixes read their buckets only.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmart.contracts import INT, LONG, TEXT, struct
from scholarmart.functions.text import deletion_keys
from scholarmart.operators.ranking import top_k_per_group
from scholarmart.session import scratch_path, tasks_for
from scholarmart.sources import versions
from scholarmart.sources.versions import Manifest

BUCKETS, HEAD = 64, 3
COMPLETIONS = struct(("prefijo", TEXT), ("posicion", INT), ("query_texto", TEXT), ("score", LONG))
#: prefixes of the lengths ``desde`` to ``hasta``
RUNS = struct(("query_texto", TEXT), ("score", LONG), ("posicion", INT), ("desde", INT), ("hasta", INT))


def _best_first() -> list[Column]:
    return [F.col("score").desc(), F.col("query_texto").asc()]


def _sweep(n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Runs of the entries of one task, which come in order of their texts.

    The nodes that the last entry lies below are on a stack: where entries part or end, with the ``n`` best below. Prefixes of the first and the
    last entry may go on in other tasks, so what is best here for them comes without a place.
    """
    types = {"query_texto": pa.string(), "score": pa.int64(), "posicion": pa.int32(), "desde": pa.int32(), "hasta": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, stack, last = [], [[0, True, []]], None  # a node: length, whether other tasks may share it, its best as [order, score, place, up to]

        def put(entry: list, since: int) -> None:
            if entry[2]:
                out.append((entry[0][2], entry[1], entry[2], since, entry[3]))

        def join(node: list, entries: list) -> None:
            node[2] = sorted(node[2] + entries, key=lambda e: e[0])
            for entry in node[2][n:]:
                put(entry, node[0] + 1)
            del node[2][n:]

        def close(size: int, shared: bool) -> None:
            """Take the last node off, whose prefixes have more letters than ``size`` and the node before."""
            end, border, best = stack.pop()
            border = border or shared
            if not stack or stack[-1][0] < size:
                stack.append([size, False, []])
            above = stack[-1]
            for k, entry in enumerate(best, 1):
                if border or entry[2] != k:
                    put(entry, end + 1)
                    entry[2], entry[3] = None if border else k, end
                if border:
                    out.append((entry[0][2], entry[1], None, above[0] + 1, end))
            above[1] = above[1] or border
            join(above, best)

        def taken() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types.values(), strict=True)], [*types])
            out.clear()
            return batch

        for batch in batches:
            for text, score in zip(batch["query_texto"].to_pylist(), batch["score"].to_pylist(), strict=True):
                size = 0 if last is None else len(commonprefix((last, text)))
                while stack[-1][0] > size:
                    close(size, False)
                if len(text) > size:
                    stack.append([len(text), last is None, []])
                join(stack[-1], [[(score is None, -(score or 0), text), score, None, None]])
                last = text
            if out:
                yield taken()
        while last is not None and stack[-1][0] >= 0:
            close(-1, True)
        if out:
            yield taken()

    return run


def _letters(runs: DataFrame) -> DataFrame:
    rows = runs.select("query_texto", "score", "posicion", F.explode(F.sequence("desde", "hasta")).alias("_size"))
    return rows.select(F.substring("query_texto", F.lit(1), F.col("_size")).alias("prefijo"), "posicion", "query_texto", "score")


def _runs(dictionary: DataFrame, n: int, path: str) -> DataFrame:
    """The runs of all entries; what the tasks found goes through a table at ``path``. The entries are shuffled once, by ranges of the text."""
    spark = dictionary.sparkSession
    entries = dictionary.filter("query_texto is not null").select("query_texto", F.col("score").cast("long").alias("score"))
    ordered = entries.repartitionByRange(tasks_for(dictionary), "query_texto").sortWithinPartitions("query_texto")
    ordered.mapInArrow(_sweep(n), "query_texto string, score long, posicion int, desde int, hasta int").write.parquet(path)
    swept = spark.read.schema(RUNS).parquet(path)
    borders = top_k_per_group(_letters(swept.filter("posicion is null")).drop("posicion"), ["prefijo"], n, _best_first())
    size = F.char_length("prefijo")
    return swept.filter("posicion is not null").union(borders.select("query_texto", "score", "posicion", size, size))


def completions(dictionary: DataFrame, n: int) -> DataFrame:
    """``prefijo, posicion, query_texto, score``; the empty prefix has the best of all."""
    return _letters(_runs(dictionary, n, scratch_path(dictionary.sparkSession, "completion-runs")))


def store(dictionary: DataFrame, root: str, n: int) -> Manifest:
    """Build the table and put it in place of the stored one; readers see the old one or the new one."""
    spark = dictionary.sparkSession
    base, folder = versions.manifest(spark, root), versions.new_folder()
    runs = _runs(dictionary, n, f"{root}/{folder}/swept")
    # shorter prefixes than the head are rows of their own, each in its bucket
    short = runs.filter(F.col("desde") < HEAD).withColumn("desde", F.explode(F.sequence("desde", F.least("hasta", F.lit(HEAD - 1))))).withColumn("hasta", F.col("desde"))
    long = runs.filter(F.col("hasta") >= HEAD).withColumn("desde", F.greatest("desde", F.lit(HEAD)))
    head = F.substring("query_texto", F.lit(1), F.least("desde", F.lit(HEAD)))
    laid = short.union(long).withColumn("cubeta", F.crc32(head.cast("binary")) % BUCKETS)
    laid = laid.hint("rebalance", "cubeta").sortWithinPartitions("cubeta", "query_texto", "desde")
    parts = versions.write_parts(laid, root, f"{folder}/runs", "cubeta")
    versions.drop(spark, root, f"{folder}/swept")
    return versions.commit(spark, root, base, replaced={"runs": parts, "completions": {}})


def stored(spark: SparkSession, root: str, prefixes: Sequence[str] | None = None, longest: int | None = None) -> DataFrame:
    """The stored table, the rows of some prefixes, read from their buckets alone, or those of prefixes of at most ``longest`` letters."""
    now = versions.manifest(spark, root)
    if now.tables.get("completions"):  # stored before there were runs: a row for each prefix, in buckets by the whole prefix
        parts = None if prefixes is None else {str(zlib.crc32(p.encode()) % BUCKETS) for p in prefixes}
        table = versions.scan(spark, root, now, "completions", COMPLETIONS, parts)
        table = table if longest is None else table.filter(F.char_length("prefijo") <= longest)
        return table if prefixes is None else table.filter(F.col("prefijo").isin(*prefixes))
    parts = None if prefixes is None else {str(zlib.crc32(p[:HEAD].encode()) % BUCKETS) for p in prefixes}
    runs = versions.scan(spark, root, now, "runs", RUNS, parts)
    if longest is not None:
        runs = runs.filter(F.col("desde") <= longest).withColumn("hasta", F.least("hasta", F.lit(longest)))
    if prefixes is None:
        return _letters(runs)
    begins = reduce(Column.__or__, (F.col("query_texto").startswith(p) for p in prefixes), F.lit(False))
    return _letters(runs.filter(begins)).filter(F.col("prefijo").isin(*prefixes))


def _asked(typed: DataFrame) -> DataFrame:
    return typed.filter("prefix is not null").select("prefix", F.lower("prefix").alias("_typed")).distinct()


def complete(table: DataFrame, typed: DataFrame, n: int) -> DataFrame:
    """The ``n`` best entries for every ``prefix`` typed; ``n`` may not be over that of the table."""
    hits = _asked(typed).join(table, F.col("_typed") == F.col("prefijo"))
    return hits.filter(F.col("posicion") <= n).select("prefix", "posicion", "query_texto", "score")


def complete_fuzzy(table: DataFrame, typed: DataFrame, n: int) -> DataFrame:
    """The ``n`` best entries with a prefix at most one edit away from what was typed.

    What was typed meets the prefixes of the table, not the entries, by equal words or words less one letter. One letter, or
    none, is one edit away from the beginning of every entry, so it takes the best of all; then no key is empty, and
    short prefixes do not all meet under one.
    """
    asked = _asked(typed)
    short = F.char_length("_typed") <= 1
    keyed = asked.filter(~short).select("prefix", "_typed", F.explode(deletion_keys("_typed")).alias("_key"))
    heads = table.filter("posicion = 1 and prefijo <> ''").select("prefijo", F.explode(deletion_keys("prefijo")).alias("_key"))
    near = keyed.join(heads.filter("_key <> ''"), "_key").filter(F.levenshtein("_typed", "prefijo", 1) >= 0).select("prefix", "prefijo").distinct()
    near = near.union(asked.filter(short).select("prefix", F.lit("")))
    best = near.join(table.filter(F.col("posicion") <= n), "prefijo").groupBy("prefix", "query_texto").agg(F.max("score").alias("score"))
    return top_k_per_group(best, ["prefix"], n, _best_first()).select("prefix", "posicion", "query_texto", "score")
