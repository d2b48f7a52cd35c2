"""Semantic, lexical and hybrid search as batch jobs."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmart.functions.text import snippet, truncated
from scholarmart.functions.vectors import dot, literal_vector, norm
from scholarmart.operators.ranking import top_k, top_k_per_group
from scholarmart.session import materialize


def scored(docs: DataFrame, query: Sequence[float], vector: str = "embedding") -> DataFrame:
    """Add the cosine similarity to a query; its length is taken out once, not per row.

    A query or a document of length zero has no direction, so its similarity is null.
    """
    length = math.sqrt(sum(v * v for v in query))
    if length == 0:
        return docs.withColumn("similitud", F.lit(None).cast("double"))
    unit = [v / length for v in query]
    return docs.withColumn("similitud", F.try_divide(dot(vector, literal_vector(unit)), norm(vector)))


def semantic_search(docs: DataFrame, query: Sequence[float], k: int, threshold: float, key: str = "id") -> DataFrame:
    """The ``k`` most similar documents at or above a threshold; exact.

    ``docs`` holds active documents; those without a vector have no similarity and drop out.
    """
    hits = scored(docs, query).filter(F.col("similitud") >= threshold)
    return top_k(hits, k, F.col("similitud").desc(), F.col(key).asc())


def term_counts(docs: DataFrame, terms: Sequence[str], tokens: str = "tokens", key: str = "id") -> DataFrame:
    """Length and query-term frequencies of every document; a narrow frame, no shuffle."""

    def frequency(term: str) -> Column:
        return F.size(F.filter(tokens, lambda w: w == term))

    found = [frequency(t).alias(f"tf_{i}") for i, t in enumerate(terms)]
    return docs.select(key, F.size(tokens).alias("dl"), *found)


def lexical_search(
    docs: DataFrame, terms: Sequence[str], k: int, tokens: str = "tokens", key: str = "id", k1: float = 1.2, b: float = 0.75
) -> DataFrame:
    """The ``k`` best documents by BM25."""
    return top_k(lexical_scores(docs, terms, tokens, key, k1, b), k, F.col("puntaje").desc(), F.col(key).asc())


def lexical_scores(docs: DataFrame, terms: Sequence[str], tokens: str = "tokens", key: str = "id", k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """BM25 of every document with a term. Texts are read once; the statistics come from the narrow frame."""
    counts = materialize(term_counts(docs, terms, tokens, key))
    n_terms = range(len(terms))
    stats = counts.agg(
        F.count("*").alias("n"),
        F.avg("dl").alias("avgdl"),
        *[F.sum((F.col(f"tf_{i}") > 0).cast("long")).alias(f"df_{i}") for i in n_terms],
    )
    s = stats.select(F.struct("*").alias("s")).scalar()
    matched = counts.filter(sum((F.col(f"tf_{i}") for i in n_terms), F.lit(0)) > 0).withColumn("_s", s)
    score = F.lit(0.0)
    for i in n_terms:
        df, tf = F.col(f"_s.df_{i}"), F.col(f"tf_{i}")
        idf = F.log(1 + (F.col("_s.n") - df + 0.5) / (df + 0.5))
        score = score + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("dl") / F.col("_s.avgdl")))
    return matched.select(key, score.alias("puntaje"))


def postings(docs: DataFrame, tokens: str = "tokens", key: str = "id") -> DataFrame:
    """Term frequencies per document, combined in every task before the shuffle."""
    # a plain explode would tokenise twice: once in a filter for empty arrays that is inferred from it
    words = docs.select(key, F.explode_outer(tokens).alias("termino")).filter(F.col("termino").isNotNull())
    return words.groupBy(key, "termino").agg(F.count("*").alias("tf"))


def keywords(docs: DataFrame, n: int, tokens: str = "tokens", key: str = "id") -> DataFrame:
    """The ``n`` terms of highest tf-idf of every document."""
    tf = postings(docs, tokens, key)
    # the frequency takes part in the sum, so both branches have the same shuffle and Spark runs it once
    df = tf.groupBy("termino").agg(F.sum((F.col("tf") > 0).cast("long")).alias("df"))
    total = docs.agg(F.count("*").alias("n")).scalar()
    weight = F.col("tf") * F.log((total + 1) / (F.col("df") + 1))
    weighed = tf.join(df, "termino").select(key, "termino", weight.alias("peso"))
    return top_k_per_group(weighed, [key], n, [F.round("peso", 9).desc(), F.col("termino").asc()])


def fuse(rankings: Sequence[DataFrame], k: int, key: str = "id", constant: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of ranked lists with a ``posicion`` column."""
    parts = [r.select(key, (F.lit(1.0) / (F.col("posicion") + constant)).alias("puntaje")) for r in rankings]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    fused = union.groupBy(key).agg(F.sum("puntaje").alias("puntaje"))
    return top_k(fused, k, F.round("puntaje", 12).desc(), F.col(key).asc())


def positions_of(scores: DataFrame, wanted: Sequence, key: str = "id", score: str = "puntaje") -> dict:
    """Places of a few wanted keys in a list by falling score, then key; the list itself is not sorted.

    Every row is counted between the two wanted ones that it lies between, so a task passes on one sum for each wanted key.
    """
    kind = scores.schema[key].dataType.simpleString()
    fixed = lambda values, schema: F.from_json(F.lit(json.dumps(values)), schema)  # noqa: E731 - one literal, parsed once
    marks = sorted((-r[score], r[key]) for r in scores.filter(F.array_contains(fixed(wanted, f"array<{kind}>"), F.col(key))).collect())
    if not marks:
        return {}
    place = F.struct((-F.col(score)).alias("s"), F.col(key).alias("k"))
    listed = fixed([{"s": s, "k": k} for s, k in marks], f"array<struct<s:double,k:{kind}>>")
    gap = F.size(F.filter(listed, lambda m: m < place))  # wanted rows ahead
    gaps = dict(scores.groupBy(gap.alias("gap")).count().collect())
    places, passed = {}, 0
    for at, (_, k) in enumerate(marks):  # a wanted row is the last one of its own gap
        passed += gaps.get(at, 0)
        places[k] = passed
    return places


def fuse_scores(lists: Sequence[DataFrame], k: int, key: str = "id", score: str = "puntaje", constant: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of scored lists, ranked as a whole but never sorted as a whole.

    With ``m = len(lists)``, a row behind place ``top`` of every list gets less than ``m / (constant + top)``, and each of the first ``k`` of any list
    at least ``1 / (constant + k)``. So only the first ``top = (m - 1) * constant + m * k`` of each list can be among the best ``k``; these few come to the
    driver, and their places in the other lists are counted (``positions_of``). Equal scores are ordered by key.
    """
    top = (len(lists) - 1) * constant + len(lists) * k
    lists = [materialize(scores.select(key, score)) for scores in lists]  # two narrow columns, read three times
    wanted = sorted({r[key] for scores in lists for r in top_k(scores, top, F.col(score).desc(), F.col(key).asc()).collect()})
    total: dict = {}
    for scores in lists:
        for found, place in positions_of(scores, wanted, key, score).items():
            total[found] = total.get(found, 0.0) + 1.0 / (place + constant)
    best = sorted(total.items(), key=lambda r: (-round(r[1], 12), r[0]))[:k]
    schema = T.StructType([lists[0].schema[key], T.StructField("puntaje", T.DoubleType())])
    return lists[0].sparkSession.createDataFrame(best, schema)


def hybrid_search(
    docs: DataFrame,
    query: Sequence[float],
    terms: Sequence[str],
    k: int,
    threshold: float = 0.0,
    key: str = "id",
    vector: str = "embedding",
    tokens: str = "tokens",
) -> DataFrame:
    """Semantic and lexical ranks fused; popularity and age have no say. Filter ``docs`` beforehand.

    Both lists are ranked as a whole, so a document far down in both still counts; one without a vector is ranked
    by its words alone.
    """
    return fuse_scores([semantic_scores(docs, query, threshold, key, vector), rounded(lexical_scores(docs, terms, tokens, key))], k, key)


def semantic_scores(docs: DataFrame, query: Sequence[float], threshold: float, key: str = "id", vector: str = "embedding") -> DataFrame:
    """The similarity of every document at or above a threshold, as a list to fuse."""
    near = scored(docs, query, vector).filter(F.col("similitud") >= threshold)
    return near.select(key, F.round("similitud", 9).alias("puntaje"))


def rounded(scores: DataFrame) -> DataFrame:
    return scores.withColumn("puntaje", F.round("puntaje", 9))


def near_misses(docs: DataFrame, query: Sequence[float], k: int, lower: float, threshold: float, key: str = "id") -> DataFrame:
    """Documents just below the threshold, offered as related results."""
    band = scored(docs, query).filter((F.col("similitud") >= lower) & (F.col("similitud") < threshold))
    return top_k(band, k, F.col("similitud").desc(), F.col(key).asc())


def hits_with_and_without_filters(docs: DataFrame, filtered: Column, matched: Column) -> DataFrame:
    """How many results there are with the filters and how many without; one pass."""
    return docs.filter(matched).agg(
        F.count("*").alias("sin_filtros"), F.coalesce(F.sum(filtered.cast("long")), F.lit(0)).alias("con_filtros")
    )


def profile_vectors(seen: DataFrame, vectors: DataFrame, user: str = "id_usuario", key: str = "id_documento") -> DataFrame:
    """Mean vector of the distinct documents every user looked at; partial means are merged."""
    pairs = seen.select(user, key).distinct().join(vectors.select(key, "embedding"), key)
    mean = Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>")))
    return pairs.groupBy(user).agg(mean.alias("_m")).select(user, vector_to_array("_m").cast("array<float>").alias("embedding"))


def result_rows(docs: DataFrame, term: str, text: str = "texto", key: str = "id", abstract_size: int = 200) -> DataFrame:
    """Shortened abstract and the piece of text around the match."""
    return docs.select(
        key, truncated(text, abstract_size).alias("resumen"), F.regexp_replace(snippet(text, term), r"\s+", " ").alias("fragmento")
    )

