"""What one task holds does not grow with the input."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from scholarmart.operators import neighbours
from scholarmart.operators.joins import credit_authors
from scholarmart.operators.mining import author_metrics
from scholarmart.plans.facts import document_fact
from scholarmart.streaming import state
from scholarmart.suite.roles import TABLES, Roles

DAY = dt.date(2024, 1, 1)


def test_credits_are_spread_by_the_size_of_the_input(spark, tmp_path):
    pairs = spark.range(3_500_000).select((F.col("id") % 1000).alias("id_documento"), F.xxhash64("id").alias("id_usuario"))  # 28 MB that do not compress
    pairs.write.parquet(f"{tmp_path}/pairs")
    bridge = spark.read.schema(pairs.schema).parquet(f"{tmp_path}/pairs")
    daily = spark.range(1000).select(F.date_add(F.lit(DAY), (F.col("id") % 3).cast("int")).alias("fecha"), F.col("id").alias("id_documento"), F.lit(2).alias("id_tipo_interaccion"), F.lit(1).cast("long").alias("cant_interacciones"))
    sizes = credit_authors(daily, bridge).rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert sum(sizes) == 3_500_000 and len(sizes) >= 7 and max(sizes) < 700_000  # a task for 4 MB; shuffle.partitions is 4 here


def test_authors_are_summed_before_types_are_joined(spark):
    fact = spark.createDataFrame([(DAY, 1, 1, 2), (DAY, 1, 2, 3), (DAY, 1, 2, 4), (DAY, 2, 9, 5), (DAY, 3, None, 1)], "fecha date, id_usuario long, id_tipo_interaccion int, cant_interacciones long")
    types = spark.createDataFrame([(1, "publicacion"), (2, "visualizacion"), (9, "otro")], "id_tipo_interaccion int, nombre string")
    users = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "x")], "id_usuario long, nombre string, nombre_escuela string")
    found = author_metrics(fact, users, types, DAY, DAY)
    assert sorted(tuple(r) for r in found.collect()) == [(1, "a", "x", 2, 7), (2, "b", "x", 0, 0)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    by_type = plan[plan.index("id_tipo_interaccion#") :]
    assert by_type.count("Aggregate [id_usuario") >= 1, plan  # below the join by type, which has a handful of keys


def test_a_query_goes_once_to_a_block_of_small_cells():
    blocks = neighbours._blocks({0: 10, 1: 20, 2: 2 * neighbours.BLOCK_ROWS, 3: 5, 4: 7})
    assert blocks == {0: (0, 1), 1: (0, 1), 2: (1, 2), 3: (3, 1), 4: (3, 1)}


def test_closest_of_groups_equals_brute_force():
    rng = np.random.default_rng(4)
    stored = rng.normal(size=(1000, 8))
    stored[100:160] = stored[7]  # ties: earlier ones win
    queries = np.vstack([rng.normal(size=(200, 8)), stored[7:8]])
    with np.errstate(invalid="ignore"):
        unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
        stored[5], queries[3] = 0, 0  # no direction
        q, d = unit(queries), unit(stored)
    limits = rng.integers(1, 60, len(q))
    which, rows, sims = neighbours._closest(q, d, limits, 0.1)
    for i, n in enumerate(limits):
        exact = np.nan_to_num(d @ q[i], nan=-9.0)
        best = [j for j in np.lexsort((np.arange(len(d)), -np.round(exact, 9))) if exact[j] >= 0.1][:n]
        assert rows[which == i].tolist() == best and np.allclose(sims[which == i], exact[best])


def test_a_user_is_one_call_and_one_value_however_many_windows():
    class Value:
        kept, timers = None, []

        exists = lambda self: self.kept is not None
        get = lambda self: self.kept

        def update(self, new):
            self.kept = new

        def clear(self):
            self.kept = None

    class Now:
        getCurrentWatermarkInMs = lambda self: 120_000

    value, limits = Value(), state.Limits(2, 60)
    handle = type("Handle", (), {"getValueState": lambda self, name, schema: value, "registerTimer": lambda self, at: value.timers.append(at)})
    limits.init(handle())
    rows = lambda *of: pd.DataFrame([(5, i, 60 * (t // 60), t) for i, t in of], columns=["clave", "pedido", "ventana", "momento"])
    first = pd.concat(limits.handleInputRows((5,), iter([rows((1, 70), (2, 65)), rows((3, 75), (4, 130))]), None))
    assert dict(zip(first.pedido, first.aceptado)) == {1: True, 2: True, 3: False, 4: True}
    second = pd.concat(limits.handleInputRows((5,), iter([rows((5, 140), (6, 150), (7, 30))]), None))
    assert dict(zip(second.pedido, second.aceptado)) == {5: True, 6: False, 7: True} and value.timers == [120_000, 60_000]
    assert list(limits.handleExpiredTimer((5,), Now(), None)) == [] and value.kept == ([120], [3]) and value.timers[-1] == 180_000


def test_events_and_pairs_are_dealt_by_the_size_of_the_input(spark, tmp_path):
    lines = spark.range(1_500_000).select(F.xxhash64("id").alias("l_orderkey"), F.xxhash64(F.col("id") + 1).alias("l_suppkey"))  # 24 MB that do not compress
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in TABLES["lineitem"] if f.name not in lines.columns]
    lines.select("*", *empty).write.parquet(f"{tmp_path}/lineitem.parquet")
    events = Roles(spark, str(tmp_path)).table("lineitem").select(F.col("l_orderkey").alias("id_documento"), F.timestamp_seconds(F.pmod("l_orderkey", F.lit(86400 * 90))).alias("created_at"))
    none = spark.createDataFrame([], "id long, created_at timestamp")
    for frame in (Roles(spark, str(tmp_path)).bridge, document_fact(events, events.limit(0), none)):
        sizes = [r["count"] for r in frame.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 1_500_000 and max(sizes) < 300_000  # a task for 4 MB; shuffle.partitions is 4 here
