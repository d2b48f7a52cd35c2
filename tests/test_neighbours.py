import numpy as np
import pytest
from pyspark.sql import functions as F

from scholarmart.operators import neighbours


def brute(ids, vectors, k, threshold):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    sims = unit @ unit.T
    out = {}
    for i, a in enumerate(ids):
        ranked = sorted((-round(sims[i, j], 9), b) for j, b in enumerate(ids) if a != b and sims[i, j] >= threshold)
        out[a] = [b for _, b in ranked[:k]]
    return out


def frame(spark, ids, vectors):
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "id long, embedding array<float>")


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 12))
    return (centres[rng.integers(0, 6, n)] + 0.3 * rng.normal(size=(n, 12))).astype(np.float32).astype(np.float64)


@pytest.mark.parametrize("threshold, block", [(0.9, 4096), (0.6, 4096), (0.6, 16), (-1.0, 16)])
def test_related_equals_brute_force(spark, monkeypatch, threshold, block):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)
    ids, vectors = np.arange(120), clustered(120, 3)
    got = {}
    for r in neighbours.related(frame(spark, ids, vectors), 4, threshold).orderBy("id", "posicion").collect():
        got.setdefault(r["id"], []).append(r["relacionado"])
    assert got == {a: b for a, b in brute(ids, vectors, 4, threshold).items() if b}


def test_a_third_of_equal_vectors(spark):
    vectors = clustered(90, 5)
    vectors[:30] = vectors[0]
    ids = np.arange(90)
    got = {}
    for r in neighbours.related(frame(spark, ids, vectors), 3, 0.8).orderBy("id", "posicion").collect():
        got.setdefault(r["id"], []).append(r["relacionado"])
    assert got == {a: b for a, b in brute(ids, vectors, 3, 0.8).items() if b}


def test_list_and_table_of_queries_find_the_same(spark):
    ids, vectors = np.arange(60), clustered(60, 7)
    docs = frame(spark, ids, vectors)
    queries = docs.select(F.col("id").alias("query_id"), "embedding")
    literal = {str(r["id"]): list(r["embedding"]) for r in docs.collect()}
    small = {(int(r[0]), r[1], r[2]) for r in neighbours.search_list(docs, literal, 3, 0.5).select("query_id", "id", "posicion").collect()}
    large = {tuple(r) for r in neighbours.nearest(queries, docs, 3, 0.5, "query_id", "id", "embedding").select("query_id", "id", "posicion").collect()}
    assert small == large


def test_seen_documents_do_not_use_up_the_list(spark):
    ids, vectors = np.arange(40), clustered(40, 9)
    docs = frame(spark, ids, vectors)
    seen = spark.createDataFrame([(1, i) for i in range(15)], "id_usuario int, id long")
    profile = spark.createDataFrame([(1, [float(x) for x in vectors[0]])], "id_usuario int, embedding array<float>")
    got = [r["id"] for r in neighbours.recommend(profile, seen, docs, 5, -1.0).orderBy("posicion").collect()]
    want = [b for b in brute(ids, vectors, 40, -1.0)[0] if b >= 15][:5]
    assert got == want


def test_empty_index(spark):
    docs = spark.createDataFrame([], "id long, embedding array<float>")
    assert neighbours.related(docs, 3, 0.5).count() == 0
