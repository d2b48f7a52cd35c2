"""Cases that used to give wrong results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from scholarmart.functions.text import snippet
from scholarmart.operators.access import mass_revoked
from scholarmart.operators.mining import one_hit_authors
from scholarmart.operators.ranking import rank_groups
from scholarmart.operators.search import scored, semantic_search
from scholarmart.operators.selection import visible_to
from scholarmart.plans.etl import bootstrap, read_warehouse, run_phases
from scholarmart.suite.pipelines import OPTIONS, RUN_2, filled_sources
from scholarmart.suite.roles import Roles


def test_unknown_audience_is_refused(spark):
    docs = spark.createDataFrame([(1, "interno")], "id_documento long, visibilidad string")
    with pytest.raises(ValueError):
        visible_to(docs, "invitado")
    assert visible_to(docs, "guest").count() == 0 and visible_to(docs, "member").count() == 1


def test_snippet_of_a_column_and_of_any_case(spark):
    rows = spark.createDataFrame([("About Deep LEARNING today", "learning"), ("nothing here", "Deep"), ("x", "")], "t string, term string")
    found = [tuple(r) for r in rows.select(snippet("t", F.col("term"), before=5), snippet("t", "Learning", before=5)).collect()]
    assert found == [("Deep LEARNING today", "Deep LEARNING today"), ("", ""), ("", "")]


def test_zero_query_has_no_similarity(spark):
    docs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], "id long, embedding array<double>")
    assert [r.similitud for r in scored(docs, [0.0, 0.0]).collect()] == [None, None]
    assert semantic_search(docs, [0.0, 0.0], 5, -1.0).count() == 0


def test_several_marks_of_a_user_flag_a_token_once(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    tokens = spark.createDataFrame([(1, t(1), t(5)), (1, t(4), t(5)), (2, t(1), t(5))], "user_id long, iat timestamp, ts timestamp")
    marks = spark.createDataFrame([(1, t(2), t(2), t(9)), (1, t(3), t(3), t(9)), (1, t(5), t(0), t(1))], "user_id long, marca timestamp, set_at timestamp, expires_at timestamp")
    assert sorted((r.user_id, r.iat.hour, r.rechazado) for r in mass_revoked(tokens, marks).collect()) == [(1, 1, True), (1, 4, False), (2, 1, False)]


def test_groups_without_a_measure_are_ranked_last(spark):
    rows = spark.createDataFrame([("a", 5), ("b", None), ("c", 7), ("d", None)], "k string, m long")
    assert {r.k: r.r for r in rank_groups(rows, "m", "r").collect()} == {"c": 1, "a": 2, "b": 3, "d": 3}


def test_quantile_of_many_authors_is_exact(spark):
    n = 25_001
    fact = spark.range(n).select(F.col("id").alias("id_usuario"), F.explode(F.array(F.lit(1), F.lit(2))).alias("id_tipo_interaccion"), F.col("id").alias("cant_interacciones"))
    fact = fact.withColumn("cant_interacciones", F.when(F.col("id_tipo_interaccion") == 1, 1).otherwise(F.col("cant_interacciones")))
    assert one_hit_authors(fact, 0.5).agg(F.min("impacto"), F.count("*")).first()[:] == (12_500, n - 12_500)


def test_errors_of_phases_are_whole(spark):
    def fails():
        raise RuntimeError("x" * 2000)

    assert len(run_phases(spark, {"a": fails}).first().detalle) > 2000


def test_bootstrap_twice_with_one_run_time(spark, folder, tmp_path):
    r, src, dst = Roles(spark, folder), str(tmp_path / "src"), str(tmp_path / "dst")
    counts = []
    for _ in range(2):
        report = bootstrap(spark, filled_sources(r), src, dst, RUN_2, options=OPTIONS).collect()
        assert [tuple(x) for x in report] == [("etl", True, "")]
        star = read_warehouse(spark, dst)
        counts.append({n: star[n].count() for n in ("fact_interaccion_documento", "fact_interaccion_autor", "dim_documento", "dim_usuario")})
    assert counts[0] == counts[1] and all(counts[0].values())
