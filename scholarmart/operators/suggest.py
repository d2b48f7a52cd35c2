"""Query popularity, prefix and fuzzy suggestions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmart.functions.text import deletion_keys, query_prefixes, within_one_edit
from scholarmart.operators.aggregates import prefix_scores
from scholarmart.operators.ranking import numbered_top_k, top_k
from scholarmart.operators.writes import purge, upsert_add


def expand_prefixes(queries: DataFrame, text: str = "text", score: str = "score") -> DataFrame:
    """One row per suggested sub-query of every query."""
    # a plain explode would evaluate the prefixes twice: once in a filter for empty arrays that is inferred from it
    rows = queries.select(F.explode_outer(query_prefixes(text)).alias("query_texto"), F.col(score).alias("score"))
    return rows.filter(F.col("query_texto").isNotNull())


def popularity(queries: DataFrame, text: str = "text", score: str = "score") -> DataFrame:
    """Score of every sub-query; equal queries are summed before they are expanded."""
    summed = queries.groupBy(text).agg(F.sum(score).alias(score))
    return prefix_scores(expand_prefixes(summed, text, score))


def popularity_snapshot(scores: DataFrame, day: Column, k: int = 20, tie: str = "reverse") -> DataFrame:
    """The ``k`` best queries with their rank for one day.

    Equal scores go in reverse order of the text, or in plain order with ``tie="text"``.
    """
    second = F.col("query_texto").desc() if tie == "reverse" else F.col("query_texto").asc()
    ranked = numbered_top_k(scores, k, [F.col("score").desc(), second], "ranking")
    return ranked.select(
        day.alias("fecha"), "query_texto", F.col("score").cast("int").alias("score"), F.col("ranking").cast("short").alias("ranking")
    )


def suggest(dictionary: DataFrame, prefix: str, n: int = 5) -> DataFrame:
    """Best entries that start with what was typed."""
    hits = dictionary.filter(F.col("query_texto").startswith(prefix.lower()))
    return top_k(hits.select("query_texto", "score"), n, F.col("score").desc(), F.col("query_texto").asc())


def suggest_fuzzy(dictionary: DataFrame, prefix: str, n: int = 5) -> DataFrame:
    """Best entries with a prefix at most one edit away from what was typed."""
    hits = dictionary.filter(within_one_edit("query_texto", prefix.lower()))
    return top_k(hits.select("query_texto", "score"), n, F.col("score").desc(), F.col("query_texto").asc())


def fuzzy_matches(dictionary: DataFrame, typed: DataFrame) -> DataFrame:
    """Pairs of typed prefixes and entries within one edit, for many prefixes at once.

    Both sides are keyed by the word and its one-letter deletions, so it is an
    equality join; the entry side is cut only at the lengths that were typed.
    ``typed`` holds ``prefix``.
    """
    asked = typed.select("prefix").distinct()
    sizes = asked.select(F.explode(F.array(*[F.char_length("prefix") + d for d in (-1, 0, 1)])).alias("size")).filter("size > 0")
    lengths = sizes.agg(F.sort_array(F.collect_set("size")).alias("sizes"))  # a set of small numbers
    sized = dictionary.select("query_texto", "score", lengths.scalar().alias("_sizes"))
    cut = F.transform("_sizes", lambda n: F.substring("query_texto", F.lit(1), n))
    heads = sized.select("query_texto", "score", F.explode(F.array_distinct(cut)).alias("_head"))
    entry_keys = heads.select("*", F.explode(deletion_keys("_head")).alias("_key"))
    typed_keys = asked.select("prefix", F.explode(deletion_keys("prefix")).alias("_key"))
    pairs = typed_keys.join(entry_keys, "_key").filter(F.levenshtein("prefix", "_head", 1) >= 0)
    return pairs.select("prefix", "query_texto", "score").distinct()


def increment(scores: DataFrame, used: DataFrame) -> DataFrame:
    """Add one per use; unknown queries start at their number of uses."""
    delta = used.groupBy("query_texto").agg(F.count("*").alias("score"))
    return upsert_add(scores, delta, ["query_texto"], ["score"])


def remove(dictionary: DataFrame, banned: DataFrame) -> DataFrame:
    return purge(dictionary, banned, ["query_texto"])


def dictionary_size(dictionary: DataFrame) -> DataFrame:
    return dictionary.agg(F.count("*").alias("entradas"))


def user_suggestions(history: DataFrame, scores: DataFrame, user_id: int, prefix: str, n: int = 5, user: str = "id_usuario") -> DataFrame:
    """The user's own queries together with the popular ones, best score of each text."""
    own = history.filter(F.col(user) == user_id).groupBy("query_texto").agg(F.count("*").alias("score"))
    merged = own.unionByName(scores.select("query_texto", F.col("score").cast("long").alias("score")))
    hits = merged.filter(F.col("query_texto").startswith(prefix))
    best = hits.groupBy("query_texto").agg(F.max("score").alias("score"))
    return top_k(best, n, F.col("score").desc(), F.col("query_texto").asc())


def direct_hits(docs: DataFrame, typed: str, strength: float = 0.8) -> DataFrame:
    """Documents whose title is what was typed, or starts with it and is hardly longer."""
    title = F.lower("titulo")
    share = F.lit(float(len(typed))) / F.char_length("titulo")
    return docs.filter(title.startswith(typed.lower()) & (share >= strength)).select("id_documento", "titulo", share.alias("fuerza"))
