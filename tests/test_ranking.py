import random

import pytest
from pyspark.sql import functions as F

from scholarmart.operators import ranking


@pytest.mark.parametrize("n", [0, 1, 2, 5, 57])
@pytest.mark.parametrize("tiles", [2, 7])
def test_ntile_like_sql(spark, n, tiles):
    rng = random.Random(n)
    rows = [(i, rng.randint(0, 3)) for i in range(n)]  # few values: many ties
    df = spark.createDataFrame(rows, "id int, v int")
    got = {r["id"]: r["t"] for r in ranking.global_ntile(df, tiles, [F.col("v").asc(), F.col("id").asc()], "t", slices=4).collect()}
    df.createOrReplaceTempView("nt")
    want = {r["id"]: r["t"] for r in spark.sql(f"SELECT id, ntile({tiles}) OVER (ORDER BY v, id) AS t FROM nt").collect()}
    assert got == want


def test_row_number_of_a_hot_value(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 600, 1).otherwise(F.col("id")).alias("v"))
    out = ranking.global_row_number(df, [F.col("v").asc(), F.col("id").asc()], "n", slices=8)
    assert out.filter(F.col("n") != F.col("id") + 1).count() == 0


def test_rank_shares_ties(spark):
    df = spark.createDataFrame([("a", 5), ("b", 9), ("c", 5), ("d", 1)], "k string, v int")
    assert {r["k"]: r["p"] for r in ranking.rank_groups(df, "v", "p").collect()} == {"b": 1, "a": 2, "c": 2, "d": 4}


def test_cumulative_share(spark):
    df = spark.createDataFrame([(1, 50), (2, 30), (3, 20)], "id int, v int")
    out = ranking.cumulative_share(df, "v", "id", slices=2).orderBy("posicion").collect()
    assert [round(r["share_acumulado"], 6) for r in out] == [0.5, 0.8, 1.0]


def test_pages_do_not_overlap(spark):
    df = spark.range(25).select(F.col("id"))
    pages = [[r["id"] for r in ranking.page(df, p, 10, [F.col("id").asc()]).collect()] for p in (1, 2, 3)]
    assert [len(p) for p in pages] == [10, 10, 5] and sorted(sum(pages, [])) == list(range(25))


def test_top_k_plan(spark):
    plan = ranking.top_k(spark.range(100), 5, F.col("id").desc())._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_group_limit_runs_before_the_shuffle(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    plan = ranking.top_k_per_group(df, ["g"], 2, [F.col("id").asc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_latest_version(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, "z")], "doc int, version int, t string")
    assert {(r["doc"], r["t"]) for r in ranking.latest_version(df, "doc", "version").collect()} == {(1, "c"), (2, "z")}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 90])
@pytest.mark.parametrize("values", [(1,), (None, 5), (None, 1, 1, 1, 1, 2, 3, 40)])
def test_ntile_by_counts_like_sql(spark, n, values):
    rng = random.Random(n)
    df = spark.createDataFrame([(i, rng.choice(values), rng.random() // 0.25) for i in rng.sample(range(1000), n)], "id int, v int, w double")
    tiles = {"a": ("v", 2), "b": ("v", 7), "c": ("w", 4), "d": ("w", 1)}
    got = {tuple(r) for r in ranking.ntile_by_counts(df, tiles, "id", slices=3).collect()}
    df.createOrReplaceTempView("nt")
    over = ", ".join(f"ntile({k}) OVER (ORDER BY {m}, id) AS {name}" for name, (m, k) in tiles.items())
    assert got == {tuple(r) for r in spark.sql(f"SELECT id, v, w, {over} FROM nt").collect()} and len(got) == n


def test_ntile_by_counts_neither_sorts_nor_moves_the_rows(spark, tmp_path):
    spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("v")).write.parquet(str(tmp_path / "t"))
    out = ranking.ntile_by_counts(spark.read.parquet(str(tmp_path / "t")), {"t": ("v", 10)}, "id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("Exchange", "Sort", "Window", "Join", "ExistingRDD"))
    assert {r["count"] for r in out.groupBy("t").count().collect()} == {300}


@pytest.mark.parametrize("n", [0, 1, 400])
def test_places_within_a_hot_group(spark, n):
    rng = random.Random(n)
    # one day has nine tenths of the rows, one group is null, a key of two columns
    rows = [(i, 1 if rng.random() < 0.9 else rng.choice([None, 2, 3]), rng.choice("ab"), rng.randrange(9)) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, day int, kind string, v int").repartition(3)
    order = [F.col("v").desc(), F.col("id").asc()]
    got = ranking.spread_rank(df, ["day"], order, "p", slices=6)
    df.createOrReplaceTempView("hot")
    want = spark.sql("SELECT *, row_number() OVER (PARTITION BY day ORDER BY v DESC, id) AS p FROM hot")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    both = ranking.spread_rank(df, ["day", "kind"], order, "p", slices=5)
    want = spark.sql("SELECT *, row_number() OVER (PARTITION BY day, kind ORDER BY v DESC, id) AS p FROM hot")
    assert sorted(map(str, both.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("falling", [True, False])
def test_pages_by_keys_are_the_whole_order(spark, falling, tmp_path):
    rows = [(i, None if i % 7 == 0 else i % 4) for i in range(30)]
    spark.createDataFrame(rows, "id int, v int").coalesce(1).write.parquet(str(tmp_path / "t"))
    df, order, after, seen = spark.read.parquet(str(tmp_path / "t")), {"v": falling, "id": False}, None, []
    while True:
        page = ranking.page_after(df, 4, order, after)
        after = ranking.last_of(page, order)
        if after is None:
            break
        seen += [tuple(r) for r in page.collect()]
    assert seen == sorted(rows, key=lambda r: (r[1] is None, (-r[1] if falling else r[1]) if r[1] is not None else 0, r[0]))
    plan = ranking.page_after(df, 4, order, (2, 6))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or" in plan and "TakeOrderedAndProject" in plan
