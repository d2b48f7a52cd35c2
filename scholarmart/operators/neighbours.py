"""Exact nearest neighbours over vectors, blocked so that no task sees a whole side."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmart.operators.ranking import top_k_per_group
from scholarmart.session import materialize

BLOCK_ROWS = 16384  # vectors of either side that meet in one task
PIVOTS = 64
CHUNK, GROUP = 128, 64  # queries and stored vectors that are compared at once


def _unit_rows(vectors: pd.Series) -> np.ndarray:
    m = np.asarray(vectors.tolist(), dtype=np.float64)
    if m.size == 0:
        return m.reshape(0, 0)
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(length == 0, np.nan, length)


def _best(sims: np.ndarray, threshold: float, k: int) -> np.ndarray:
    """Positions of the ``k`` highest values at or above the threshold; earlier ones win ties."""
    hits = np.flatnonzero(sims >= threshold)
    return hits[np.argsort(-np.round(sims[hits], 9), kind="stable")][:k]


def _angles(vectors: pd.Series, centre: np.ndarray) -> np.ndarray:
    return np.nan_to_num(np.arccos(np.clip(_unit_rows(vectors) @ centre.T, -1.0, 1.0)), nan=9.0)


def search_list(
    docs: DataFrame, queries: Mapping[str, Sequence[float]], k: int, threshold: float, key: str = "id", query_key: str = "query_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` most similar documents for each vector of a given list; exact.

    The list travels with the tasks and documents stay where they are. For a table of queries see ``nearest``.
    """
    names = list(queries)
    wanted = _unit_rows(pd.Series([list(v) for v in queries.values()], dtype=object))
    schema = T.StructType(
        [
            T.StructField(query_key, T.StringType()),
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("similitud", T.DoubleType()),
        ]
    )

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty or not names:
                continue
            pdf = pdf.sort_values(key, kind="stable")
            ids, sims = pdf[key].to_numpy(), _unit_rows(pdf[vector]) @ wanted.T
            tops = [_best(sims[:, q], threshold, k) for q in range(len(names))]
            rows = np.concatenate(tops)
            which = np.repeat(np.arange(len(names)), [len(t) for t in tops])
            yield pd.DataFrame({query_key: [names[q] for q in which], key: ids[rows], "similitud": sims[rows, which]})

    parts = docs.select(key, vector).filter(F.col(vector).isNotNull()).mapInPandas(search, schema)
    return top_k_per_group(parts, [query_key], k, [F.round("similitud", 9).desc(), F.col(key).asc()])


def _closest(queries: np.ndarray, stored: np.ndarray, limits: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of both sides and the similarity of the ``limits`` closest unit vectors at or above the threshold for each query; earlier ones win ties.

    Single precision finds who may be among them: the ``n`` highest maxima of groups of stored vectors belong to ``n`` different ones, so what lies
    below the last of these by more than the rounding is out. The rest is measured again in double precision.
    """
    found = []
    queried, kept = (np.flatnonzero(~np.isnan(m).any(axis=1)) for m in (queries, stored))  # those of length zero have no direction
    q, d = queries[queried], stored[kept]
    q32, d32, slack = q.astype(np.float32), d.astype(np.float32), 2e-7 * (d.shape[1] + 8)
    groups = -(-len(d) // GROUP)
    for a in range(0, len(q) if len(d) else 0, CHUNK):
        some = limits[queried[a : a + CHUNK]]
        sims = np.full((len(some), groups * GROUP), -2.0, np.float32)
        sims[:, : len(d)] = q32[a : a + CHUNK] @ d32.T
        sims = sims.reshape(len(some), groups, GROUP)
        highest = sims.max(axis=2)
        last = np.sort(highest, axis=1)[np.arange(len(some)), np.maximum(groups - some, 0)]
        bound = np.maximum(np.where(some > groups, -2.0, last), threshold) - slack
        row, group = np.nonzero(highest >= bound[:, None])
        pair, at = np.nonzero(sims[row, group] >= bound[row, None])
        row, at = row[pair], group[pair] * GROUP + at
        step = 1 << 16
        exact = np.concatenate([np.zeros(0), *[np.einsum("ij,ij->i", q[a + row[i : i + step]], d[at[i : i + step]]) for i in range(0, len(row), step)]])
        row, at, exact = (x[exact >= threshold] for x in (row, at, exact))
        order = np.lexsort((at, -np.round(exact, 9), row))
        row, at, exact = row[order], at[order], exact[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        first = place < some[row]
        found.append((queried[a + row[first]], kept[at[first]], exact[first]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*found))


def _lookup(numbers: Mapping[int, int], key: str) -> Column:
    return F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])[F.col(key)]


def _blocks(cells: Mapping[int, int]) -> dict[int, tuple[int, int]]:
    """The first block and the number of blocks of every cell: small cells share one, crowded ones have several."""
    blocks, at, room = {}, -1, 0
    for cell, n in sorted(cells.items()):
        if n > room:
            at, room = at + 1, BLOCK_ROWS
        more = max(0, math.ceil(n / BLOCK_ROWS) - 1)
        blocks[cell] = (at, more + 1)
        at, room = at + more, max(0, room - n)
    return blocks


def nearest(
    queries: DataFrame,
    index: DataFrame,
    k: int,
    threshold: float,
    query_key: str = "query_id",
    key: str = "id",
    vector: str = "embedding",
    pivots: int = PIVOTS,
) -> DataFrame:
    """For every query vector the ``k`` index vectors with a cosine of at least ``threshold``; exact.

    Cells: every index vector lives with its closest pivot. Angles are a metric, so a
    query can only have hits in cells whose pivot is no farther than its closest pivot
    plus twice the threshold angle, and no farther than the cell radius plus the
    threshold angle. It visits these cells only; the higher the threshold, the fewer.

    Blocks: small cells share a block, crowded ones are cut into several. A query goes once to each block with a cell it visits; the queries of a
    block are cut into pieces of ``BLOCK_ROWS``, and each pair of a block and a piece is a task of its own, which yields at most ``k`` rows per query.

    Copies: equal query vectors are searched once, and of equal index vectors only
    as many of the smallest keys as a query wants can win the tie; only these are kept.

    A query may want more than ``k`` hits by a column ``want``.
    """
    index = index.filter(F.col(vector).isNotNull()).select(key, vector)
    want = F.greatest(F.col("want"), F.lit(k)) if "want" in queries.columns else F.lit(k)
    asked = queries.filter(F.col(vector).isNotNull()).select(query_key, vector, want.cast("int").alias("_want"))
    most = asked.agg(F.max("_want")).first()[0] or k
    copies = top_k_per_group(index, [vector], most, [F.col(key).asc()], "_copy").drop("_copy")

    # a fixed number of pivots: the vectors with the smallest hash
    chosen = index.select(vector, F.xxhash64(vector).alias("_h")).distinct().orderBy("_h", vector).limit(pivots).collect()
    centre = _unit_rows(pd.Series([r[0] for r in chosen], dtype=object))
    reach, slack = math.acos(min(1.0, max(-1.0, threshold))), 1e-6

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not pdf.empty:
                angle = _angles(pdf[vector], centre)
                cell = angle.argmin(axis=1)
                yield pdf.assign(_cell=cell.astype("int32"), _angle=angle[np.arange(len(cell)), cell])

    cell_fields = [T.StructField("_cell", T.IntegerType()), T.StructField("_angle", T.DoubleType())]
    homes = materialize(copies.mapInPandas(settle, T.StructType([*copies.schema.fields, *cell_fields])))
    stats = homes.groupBy("_cell").agg(F.count("*").alias("n"), F.max("_angle").alias("radius")).collect()  # one row per pivot
    radius = np.full(max(len(chosen), 1), -9.0)
    for row in stats:
        radius[row["_cell"]] = row["radius"]

    blocks = _blocks({r["_cell"]: r["n"] for r in stats})
    holds = np.zeros((max(len(chosen), 1), sum(n for _, n in blocks.values()) + 1), bool)
    for cell, (first, n) in blocks.items():
        holds[cell, first : first + n] = True

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not pdf.empty:
                angle = _angles(pdf[vector], centre)
                near = (angle <= angle.min(axis=1, keepdims=True) + 2 * reach + slack) & (angle <= radius + reach + slack)
                yield pdf.assign(_blocks=[np.flatnonzero(holds[row].any(axis=0)).astype("int32") for row in near])

    # each vector that is asked for gets a number, which its hits carry instead of the vector
    distinct = asked.groupBy(vector).agg(F.max("_want").alias("_want")).withColumn("_probe", F.monotonically_increasing_id())
    probe_schema = T.StructType([*distinct.schema.fields, T.StructField("_blocks", T.ArrayType(T.IntegerType()))])
    hit_schema = T.StructType([T.StructField("_probe", T.LongType()), index.schema[key], T.StructField("similitud", T.DoubleType())])
    if not stats:
        empty = queries.sparkSession.createDataFrame([], T.StructType([asked.schema[vector], *hit_schema.fields[1:]]))
        return asked.drop("_want").join(empty, vector).select(query_key, key, "similitud", F.lit(1).alias("posicion"))
    probes = materialize(distinct.mapInPandas(visit, probe_schema))
    visits = probes.select("_probe", vector, "_want", F.explode("_blocks").alias("_block"))
    visited = {r["_block"]: r["n"] for r in visits.groupBy("_block").agg(F.count("*").alias("n")).collect()}  # one row per block

    parts = {b: max(1, math.ceil(visited.get(b, 0) / BLOCK_ROWS)) for first, n in blocks.values() for b in range(first, first + n)}
    left = visits.withColumn("_part", F.pmod(F.xxhash64("_probe"), _lookup(parts, "_block")).cast("int"))
    own = F.pmod(F.xxhash64(key), _lookup({c: n for c, (_, n) in blocks.items()}, "_cell")).cast("int")
    homed = homes.select(key, vector, (_lookup({c: first for c, (first, _) in blocks.items()}, "_cell") + own).alias("_block"))
    right = homed.withColumn("_part", F.explode(F.sequence(F.lit(0), _lookup(parts, "_block") - 1)))

    def compare(wanted: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        if wanted.empty or stored.empty:
            return pd.DataFrame({"_probe": [], key: [], "similitud": []})
        stored = stored.sort_values(key, kind="stable")
        which, rows, sims = _closest(_unit_rows(wanted[vector]), _unit_rows(stored[vector]), wanted["_want"].to_numpy(), threshold)
        return pd.DataFrame({"_probe": wanted["_probe"].to_numpy()[which], key: stored[key].to_numpy()[rows], "similitud": sims})

    meet = ["_block", "_part"]
    hits = left.groupBy(*meet).cogroup(right.groupBy(*meet)).applyInPandas(compare, hit_schema)
    best = top_k_per_group(hits, ["_probe"], most, [F.round("similitud", 9).desc(), F.col(key).asc()])
    named = asked.join(probes.select(vector, "_probe"), vector).select(query_key, F.col("_want"), "_probe")
    return named.join(best, "_probe").filter(F.col("posicion") <= F.col("_want")).select(query_key, key, "similitud", "posicion")


def related(docs: DataFrame, k: int, min_similarity: float, key: str = "id", vector: str = "embedding") -> DataFrame:
    """The ``k`` documents most similar to each document, itself left out; exact above ``min_similarity``."""
    found = nearest(docs.select(F.col(key).alias("_of"), vector), docs, k + 1, min_similarity, "_of", key, vector)
    others = found.filter(F.col("_of") != F.col(key)).select(F.col("_of").alias(key), F.col(key).alias("relacionado"), "similitud")
    return top_k_per_group(others, [key], k, [F.round("similitud", 9).desc(), F.col("relacionado").asc()])


def recommend(profiles: DataFrame, seen: DataFrame, docs: DataFrame, k: int, min_similarity: float, user: str = "id_usuario", key: str = "id") -> DataFrame:
    """The ``k`` documents closest to each profile vector that its user has not seen.

    A user is given as many hits more as documents were seen, so that ``k`` remain;
    a user who saw a lot makes only the own list longer.
    """
    viewed = seen.select(user, key).distinct()
    sized = profiles.join(viewed.groupBy(user).agg((F.count("*") + k).alias("want")), user, "left").na.fill(k, ["want"])
    found = nearest(sized, docs, k, min_similarity, user, key).drop("posicion")
    fresh = found.join(viewed, [user, key], "left_anti")
    return top_k_per_group(fresh, [user], k, [F.round("similitud", 9).desc(), F.col(key).asc()])
