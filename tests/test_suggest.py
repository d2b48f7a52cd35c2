import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from scholarmart.functions.text import deletion_keys, query_prefixes
from scholarmart.operators import suggest
from scholarmart.plans import completions

# A few searched texts with their scores.
QUERIES = [
    ("machine learning supervisado", 134), ("machine learning no supervisado", 92), ("machine learning aplicado a salud", 58),
    ("deep learning", 168), ("deep learning medicina", 89), ("deep learning vision por computadora", 64),
    ("redes neuronales", 187), ("redes neuronales convolucionales", 142), ("redes neuronales recurrentes", 96),
    ("cambio climatico modelado", 108), ("procesamiento de lenguaje natural", 156),
]


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(QUERIES, "text string, score int")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("deep learning vision por computadora", ["deep learning", "deep learning vision", "deep learning vision por computadora"]),
        ("procesamiento de imagenes", ["procesamiento de imagenes"]),
        ("redes", ["redes"]),
        ("", []),
        ("  ", []),
        ("vision de", ["vision de"]),
        ("  Redes   NEURONALES ", ["redes neuronales"]),
    ],
)
def test_prefixes(spark, text, expected):
    assert spark.createDataFrame([(text,)], "t string").select(query_prefixes("t")).first()[0] == expected


def test_popularity_and_tie_order(spark, queries):
    top = suggest.popularity_snapshot(suggest.popularity(queries), F.lit(dt.date(2026, 1, 1)), 20).orderBy("ranking").collect()
    best = [(r["query_texto"], r["score"]) for r in top]
    assert best[:3] == [("redes neuronales", 425), ("deep learning", 321), ("machine learning", 284)]
    # equal scores: reverse order of the text
    assert best[3:5] == [("procesamiento de lenguaje natural", 156), ("procesamiento de lenguaje", 156)]
    assert [r["ranking"] for r in top] == list(range(1, len(top) + 1))


def test_fuzzy_prefix(spark, queries):
    raw = queries.select(F.col("text").alias("query_texto"), "score")
    assert [r["score"] for r in suggest.suggest_fuzzy(raw, "machne", 5).collect()] == [134, 92, 58]
    assert suggest.suggest(raw, "machne", 5).collect() == []


def test_fuzzy_batch_equals_single(spark, queries):
    raw = queries.select(F.col("text").alias("query_texto"), "score")
    typed = ["machne", "dee", "redez neu", "x", "rdes"]
    pairs = suggest.fuzzy_matches(raw, spark.createDataFrame([(t,) for t in typed], "prefix string")).collect()
    for t in typed:
        want = {r["query_texto"] for r in suggest.suggest_fuzzy(raw, t, 100).collect()}
        assert {r["query_texto"] for r in pairs if r["prefix"] == t} == want


def test_deletion_keys(spark):
    keys = spark.createDataFrame([("abc",)], "t string").select(deletion_keys("t")).first()[0]
    assert set(keys) == {"abc", "bc", "ac", "ab"}


def test_increment_and_remove(spark):
    scores = spark.createDataFrame([("a", 5)], "query_texto string, score long")
    used = spark.createDataFrame([("a",), ("b",), ("a",)], "query_texto string")
    after = suggest.increment(scores, used)
    assert {tuple(r) for r in after.collect()} == {("a", 7), ("b", 1)}
    assert suggest.remove(after, spark.createDataFrame([("a",)], "query_texto string")).count() == 1


def test_completions_equal_single_look_ups(spark, queries, tmp_path):
    extra = [("rueda", 64), ("r", 1), ("", 3), (None, 9), ("ñandú", None), ("redes neuronales", 2)]
    raw = queries.union(spark.createDataFrame(extra, "text string, score int")).groupBy(F.col("text").alias("query_texto")).agg(F.sum("score").alias("score"))
    root = str(tmp_path / "table")
    completions.store(raw, root, 3)
    table, typed = completions.stored(spark, root), ["", "r", "re", "rw", "rde", "DEEP", "machne", "xyz", "ñan", "redes neuronales recurrentes", None]
    asked = spark.createDataFrame([(t,) for t in typed + typed], "prefix string")
    for many, one in ((completions.complete, suggest.suggest), (completions.complete_fuzzy, suggest.suggest_fuzzy)):
        got = many(table, asked, 2).orderBy("prefix", "posicion").collect()
        for t in typed[:-1]:
            want = [tuple(r) for r in one(raw.filter("query_texto is not null"), t, 2).collect()]
            assert [(r["query_texto"], r["score"]) for r in got if r["prefix"] == t] == want, t
        assert all(r["prefix"] is not None for r in got)
    single = completions.stored(spark, root, ["re", "deep"])
    assert {r["prefijo"] for r in single.collect()} == {"re", "deep"} and len(single.inputFiles()) <= 2
    completions.store(raw.limit(0), root, 3)
    assert completions.complete(completions.stored(spark, root), asked, 2).count() == 0


def test_short_prefixes_share_no_key(spark):
    table = completions.completions(spark.createDataFrame([(chr(97 + i) * 3, i) for i in range(26)], "query_texto string, score int"), 2)
    typed = spark.createDataFrame([(chr(97 + i),) for i in range(26)], "prefix string")
    plan = completions.complete_fuzzy(table, typed, 2)
    assert plan.count() == 52 and {r["query_texto"] for r in plan.collect()} == {"zzz", "yyy"}


def test_completions_are_stored_by_runs_not_by_letters(spark, tmp_path):
    """Every prefix has the places that all entries give it, over several tasks; what is stored grows with entries, not with their letters."""
    rng = random.Random(7)
    entries = [("".join(rng.choice("añb ") for _ in range(4)) + "x" * rng.randrange(0, 90), rng.choice([None, 1, 2, 2**60])) for _ in range(200)]
    entries += entries[:20]
    want = {}
    for text, score in entries:
        for size in range(len(text) + 1):
            want.setdefault(text[:size], []).append((score is None, -(score or 0), text, score))
    want = {(p, k, e[2], e[3]) for p, es in want.items() for k, e in enumerate(sorted(es, key=lambda e: e[:3])[:2], 1)}
    root = str(tmp_path / "table")
    completions.store(spark.createDataFrame(entries, "query_texto string, score long").repartition(4), root, 2)
    assert {tuple(r) for r in completions.stored(spark, root).collect()} == want
    assert {tuple(r) for r in completions.stored(spark, root, longest=3).collect()} == {w for w in want if len(w[0]) <= 3}
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/_data").count() < 3000 < len(want)
