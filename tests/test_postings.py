import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scholarmart.operators.ranking import top_k_per_group
from scholarmart.operators.search import fuse_scores
from scholarmart.plans import indexing, postings
from scholarmart.sources import versions

WORDS = [f"w{i}" for i in range(30)] + ["común", "日本"]


def library(seed, first, count):
    rng = random.Random(seed)
    return [(first + i, ["común"] * rng.randrange(3) + [rng.choice(WORDS) for _ in range(rng.randrange(20))]) for i in range(count)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, tokens array<string>")


def bm25(rows, terms, k1=1.2, b=0.75):
    n, average = len(rows), sum(len(t) for _, t in rows) / len(rows)
    df = Counter(x for _, t in rows for x in set(t))
    out = {}
    for i, tokens in rows:
        tf = Counter(tokens)
        parts = [math.log(1 + (n - df[x] + 0.5) / (df[x] + 0.5)) * tf[x] * (k1 + 1) / (tf[x] + k1 * (1 - b + b * len(tokens) / average)) for x in terms if tf[x]]
        if parts:
            out[i] = sum(parts)
    return out


def scores(index, terms, **more):
    return {r.id: r.puntaje for r in index.scores(terms, **more).collect()}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("postings"))
    one, two = library(1, 0, 60), library(2, 1000, 40)
    postings.append(frame(spark, one), root)
    postings.append(frame(spark, two), root)
    return root, one + two


def test_scores_over_segments(spark, stored):
    root, rows = stored
    index = postings.Index(spark, root)
    for terms in (["común"], ["w1", "日本", "unheard"], ["w1", "w1", "w2"], ["unheard"], []):
        assert scores(index, terms) == pytest.approx(bm25(rows, terms))
    best = [r.id for r in index.search(["común", "w3"], 5).collect()]
    assert best == sorted(wanted := bm25(rows, ["común", "w3"]), key=lambda i: (-round(wanted[i], 9), i))[:5]


def test_a_query_reads_the_buckets_of_its_terms(spark, stored):
    index = postings.Index(spark, stored[0])
    terms = ["w1", "común"]
    buckets = {f"cubeta={postings.bucket(t)}" for t in terms}
    files = index.postings(terms).inputFiles()
    assert files and {f.split("/")[-2] for f in files} == buckets and len(buckets) < len({f.split("/")[-2] for f in index.postings().inputFiles()})
    assert "PushedFilters: [In(termino" in index.postings(terms)._jdf.queryExecution().toString().replace("Or(", "In(")


def test_documents_allowed(spark, stored):
    root, rows = stored
    allowed = [r for r in rows if r[0] % 3 == 0]
    found = scores(postings.Index(spark, root), ["w1", "común"], allowed=frame(spark, allowed + allowed[:5]).select("id"))
    assert found == pytest.approx(bm25(allowed, ["w1", "común"]))


def test_removal_and_compaction(spark, tmp_path):
    root, rows = str(tmp_path), library(3, 0, 80)
    postings.append(frame(spark, rows), root)
    before = postings.Index(spark, root)
    postings.remove(frame(spark, rows[:30] + [(9999, [])]).select("id"), root)
    again = [(0, ["w1", "w1"]), (500, ["común"])]  # a removed id comes back
    postings.append(frame(spark, again), root)
    left = rows[30:] + again
    terms = ["w1", "común", "w7"]
    index = postings.Index(spark, root)
    assert scores(index, terms) == pytest.approx(bm25(left, terms)) and scores(before, terms) == pytest.approx(bm25(rows, terms))
    df = {r.termino: r.df for r in index.frequencies().collect()}
    now = postings.compact(spark, root)
    whole = postings.Index(spark, root)
    assert now.tables["removed"] == {} and len(now.tables["lengths"][""]) == 1
    assert scores(whole, terms) == pytest.approx(bm25(left, terms)) and {r.termino: r.df for r in whole.frequencies().collect()} == df


def test_keywords(spark, stored):
    root, rows = stored
    df, wanted = Counter(x for _, t in rows for x in set(t)), []
    for i, tokens in rows:
        weights = sorted(((-round(c * math.log((len(rows) + 1) / (df[x] + 1)), 9), x) for x, c in Counter(tokens).items()))[:3]
        wanted += [(i, x) for _, x in weights]
    assert sorted((r.id, r.termino) for r in postings.Index(spark, root).keywords(3).collect()) == sorted(wanted)


def test_postings_take_one_shuffle(spark):
    rows = [(1, ["b", "a", "b", None]), (2, []), (3, None), (4, ["b"]), (1, ["b", "c", "c", "c"]), (1, ["b"]), (None, ["a"]), (None, ["a"])]
    docs = frame(spark, rows)
    wanted = sorted([("a", 1, 1, 4), ("b", 1, 3, 4), ("c", 1, 3, 4), ("b", 1, 1, 1), ("b", 4, 1, 1), ("a", -1, 2, 1)])
    for found in (postings.count_postings(docs), postings._laid(postings._by_document(docs, "tokens", "id"))):
        assert sorted(tuple(r) for r in found.select("termino", F.coalesce("id", F.lit(-1)), "tf", "dl").collect()) == wanted
        assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_keywords_shuffle_only_what_is_left(spark, tmp_path, monkeypatch):
    rows = library(5, 0, 60) + [(0, ["w1", "w2", "w2"]), (1, ["común"]), (None, ["w1"]), (None, ["w1", "w3"])]
    monkeypatch.setattr(postings, "FREQUENT", 5)
    for name, own in (("once", library(5, 0, 60)), ("twice", rows)):
        root = str(tmp_path / name)
        postings.append(frame(spark, own), root)
        index = postings.Index(spark, root)
        found = index.keywords(3)
        slow = index.postings().join(index.frequencies(), "termino").withColumn("peso", F.col("tf") * F.log((F.lit(len(own)) + 1) / (F.col("df") + 1)))
        wanted = top_k_per_group(slow.select("id", "termino", "peso"), ["id"], 3, [F.round("peso", 9).desc(), F.col("termino").asc()])
        order = lambda df: sorted((-1 if r.id is None else r.id, r.posicion, r.termino, round(r.peso, 9)) for r in df.collect())
        assert order(found) == order(wanted)
        now = postings.compact(spark, root)
        assert len(now.tables["words"][""]) == 1 and order(postings.Index(spark, root).keywords(3)) == order(wanted)
        if name == "once":  # frequent terms are limited to 3 of a document in the scan, before the only shuffle by document
            assert "BroadcastHashJoin" in (plan := found._jdf.queryExecution().executedPlan().toString()) and plan.count("WindowGroupLimit") >= 2


def test_odd_documents(spark, tmp_path):
    root = str(tmp_path)
    rows = [(1, []), (2, None), (3, ["a"] * 500 + ["b"])]
    postings.append(frame(spark, rows), root)
    index = postings.Index(spark, root)
    assert sorted(tuple(r)[:4] for r in index.postings().collect()) == [("a", 3, 500, 501), ("b", 3, 1, 501)]
    assert sorted((r.id, r.dl) for r in index.lengths().collect()) == [(1, 0), (2, 0), (3, 501)]
    postings.append(frame(spark, []), root)
    assert set(scores(postings.Index(spark, root), ["a"])) == {3}
    empty = str(tmp_path / "empty")
    postings.append(frame(spark, []), empty)
    assert scores(postings.Index(spark, empty), ["a"]) == {} and postings.Index(spark, empty).keywords(3).count() == 0


@pytest.mark.parametrize("size", [0, 3, 400])
def test_fusion_equals_ranking_whole_lists(spark, size):
    rng = random.Random(size)
    lists = [[(i, float(rng.randrange(1 + size // 3))) for i in range(2 * size) if rng.random() < 0.6] for _ in range(2)]
    total = Counter()
    for rows in lists:
        for place, (i, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1):
            total[i] += 1 / (60 + place)
    wanted = sorted(((-round(s, 12), i) for i, s in total.items()))[:7]
    found = fuse_scores([spark.createDataFrame(rows, "id long, puntaje double") for rows in lists], 7).collect()
    assert [r.id for r in found] == [i for _, i in wanted] and [-r.puntaje for r in found] == pytest.approx([s for s, _ in wanted])


def test_ingestion_stores_and_finds(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    docs = spark.createDataFrame([(7, "La Tesis", "grafos y redes"), (8, None, "redes")], "id long, titulo string, texto string")
    bridge = spark.createDataFrame([(7, 1, 1), (8, 2, 1)], "id_documento long, id_usuario long, orden int")
    now = indexing.store(docs, bridge, root, "titulo", "texto")
    stored = versions.scan(spark, root, now, "documento", docs.withColumn("texto_busqueda", F.array(F.lit(""))).schema)
    assert sorted((r.id, r.texto_busqueda) for r in stored.collect()) == [(7, ["tesi", "grafo", "red"]), (8, ["red"])]
    assert {r.id for r in postings.Index(spark, root).scores(["red"]).collect()} == {7, 8}
    monkeypatch.setattr(versions, "commit", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        indexing.store(docs.withColumn("id", F.col("id") + 10), bridge, root, "titulo", "texto")
    assert versions.manifest(spark, root) == now and postings.Index(spark, root).lengths().count() == 2
