import datetime as dt

import pytest
from pyspark.sql import functions as F

from scholarmart.contracts import WAREHOUSE_TABLES
from scholarmart.plans import etl
from scholarmart.plans.dims import add_month, calendar_until
from scholarmart.plans.removal import remove_documents
from scholarmart.sources import tables, versions
from scholarmart.sources.tables import read_table
from tests.conftest import utc

RUN = utc(2026, 5, 5)


def sources(spark, docs=(), views=(), favourites=(), bridge=(), users=((1, "u1", 1), (2, "u2", None))):
    make = spark.createDataFrame
    return {
        "escuela": make([(1, "E")], "id int, nombre string"),
        "carrera": make([(1, 1, "C")], "id int, id_escuela int, nombre string"),
        "materia": make([(1, 1, "M")], "id int, id_carrera int, nombre string"),
        "usuario": make(list(users), "id int, nombre string, id_carrera int"),
        "tipo_documento": make([(1, "tesis")], "id int, nombre string"),
        "documento": make([(i, f"d{i}", 1, 1, "publico", None, t) for i, t in docs], "id int, titulo string, id_tipo int, id_materia int, visibilidad string, deleted_at timestamp, created_at timestamp"),
        "documento_autor": make(list(bridge), "id_documento int, id_usuario int"),
        "favorito": make(list(favourites), "id_usuario int, id_documento int, created_at timestamp"),
        "evento_visualizacion": make(list(views), "id_documento int, created_at timestamp"),
    }


def fact(spark, dst, name):
    return sorted(tuple(r) for r in read_table(spark, dst, name).collect())


DAY = dt.date(2026, 5, 4)


def at(hour):
    return utc(2026, 5, 4, hour)


def test_first_load(spark, tmp_path):
    dst = str(tmp_path)
    src = sources(spark, docs=[(1, at(1))], views=[(1, at(2))], favourites=[(1, 1, at(3))], bridge=[(1, 1), (1, 2)])
    etl.run_etl(spark, src, dst, RUN)
    assert fact(spark, dst, "fact_interaccion_documento") == [(DAY, 1, t, 1) for t in (1, 2, 3)]
    # one view of a document with two authors counts for each of them
    assert fact(spark, dst, "fact_interaccion_autor") == [(DAY, u, t, 1) for u in (1, 2) for t in (1, 2, 3)]
    users = {r["id_usuario"]: tuple(r) for r in read_table(spark, dst, "dim_usuario").collect()}
    assert users[0] == (0, 0, "Invitado Anonimo", "Sin Escuela", "Sin Carrera")
    assert users[2] == (2, 0, "Sin Carrera", "Sin Escuela", "u2")
    marks = {r["tabla_origen"]: r["ultimo_procesado"].astimezone(dt.timezone.utc) for r in read_table(spark, dst, "etl_watermark").collect()}
    assert marks == {"documento": at(1), "visualizacion": at(2), "favorito": at(3)}


def test_second_load_adds_late_rows_do_not(spark, tmp_path):
    dst = str(tmp_path)
    base = dict(docs=[(1, at(1))], bridge=[(1, 1)])
    etl.run_etl(spark, sources(spark, views=[(1, at(5))], **base), dst, RUN)
    views = [(1, at(5)), (1, at(6)), (1, at(7)), (1, at(4))]  # the last one is older than the mark
    etl.run_etl(spark, sources(spark, views=views, **base), dst, RUN + dt.timedelta(hours=1))
    assert (DAY, 1, 2, 3) in fact(spark, dst, "fact_interaccion_documento")
    again = etl.EtlOptions(mode="recompute")
    for hour in (2, 3):  # recomputing counts the late row, and twice is the same as once
        etl.run_etl(spark, sources(spark, views=views, **base), dst, RUN + dt.timedelta(hours=hour), options=again)
        assert (DAY, 1, 2, 4) in fact(spark, dst, "fact_interaccion_documento")


@pytest.mark.parametrize("policy, count", [("ignore", 1), ("add", 2)])
def test_second_publication_of_a_day(spark, tmp_path, policy, count):
    dst, options = str(tmp_path), etl.EtlOptions(publication_policy=policy)
    etl.run_etl(spark, sources(spark, docs=[(1, at(10))], bridge=[(1, 1)]), dst, RUN, options=options)
    etl.run_etl(spark, sources(spark, docs=[(1, at(10)), (2, at(15))], bridge=[(1, 1), (2, 1)]), dst, RUN + dt.timedelta(hours=1), options=options)
    assert fact(spark, dst, "fact_interaccion_documento") == [(DAY, 1, 1, 1), (DAY, 2, 1, 1)]
    assert fact(spark, dst, "fact_interaccion_autor") == [(DAY, 1, 1, count)]


def test_unknown_document_stops_or_is_set_aside(spark, tmp_path):
    src = sources(spark, docs=[(1, at(1))], views=[(1, at(2)), (99, at(2))])
    stopped = str(tmp_path / "a")
    with pytest.raises(etl.LoadRejected):
        etl.run_etl(spark, src, stopped, RUN)
    assert fact(spark, stopped, "fact_interaccion_documento") == [] and fact(spark, stopped, "etl_watermark") == []
    aside = str(tmp_path / "b")
    etl.run_etl(spark, src, aside, RUN, run_id="r", options=etl.EtlOptions(on_orphans="quarantine"))
    assert fact(spark, aside, "fact_interaccion_documento") == [(DAY, 1, 1, 1), (DAY, 1, 2, 1)]
    assert spark.read.parquet(f"{aside}/_quarantine/r/fact_interaccion_documento/id_documento").count() == 1


def test_an_interrupted_run_leaves_the_star_as_it_was(spark, tmp_path, monkeypatch):
    dst = str(tmp_path)
    first = sources(spark, docs=[(1, at(1))], views=[(1, at(2))])
    commit = versions.commit

    def crash(*args, **kwargs):
        if kwargs.get("run"):
            raise RuntimeError("driver lost")
        return commit(*args, **kwargs)

    monkeypatch.setattr(versions, "commit", crash)
    with pytest.raises(RuntimeError):
        etl.run_etl(spark, first, dst, RUN)
    monkeypatch.setattr(versions, "commit", commit)
    assert fact(spark, dst, "fact_interaccion_documento") == [] and fact(spark, dst, "dim_documento") == []
    etl.run_etl(spark, first, dst, RUN)  # the same run id again
    etl.run_etl(spark, sources(spark, docs=[(1, at(1))], views=[(1, at(2)), (1, at(3))]), dst, RUN + dt.timedelta(hours=1))
    assert (DAY, 1, 2, 2) in fact(spark, dst, "fact_interaccion_documento")


def test_a_second_load_writes_what_changes(spark, tmp_path):
    dst, april = str(tmp_path), utc(2026, 4, 4, 1)
    base = dict(docs=[(1, april)], bridge=[(1, 1)])
    etl.run_etl(spark, sources(spark, views=[(1, april)], **base), dst, RUN)
    before = versions.manifest(spark, dst)
    old = read_table(spark, dst, "fact_interaccion_documento")
    etl.run_etl(spark, sources(spark, views=[(1, april), (1, at(2))], **base), dst, RUN + dt.timedelta(hours=1))
    now = versions.manifest(spark, dst)
    assert all(now.tables[n] == before.tables[n] for n in etl.DIMS)
    for name in etl.FACTS:
        assert now.tables[name]["2026-04"] == before.tables[name]["2026-04"] and set(now.tables[name]) == {"2026-04", "2026-05"}
    assert old.count() == 2 and read_table(spark, dst, "fact_interaccion_documento").count() == 3  # an open reader keeps its version


def test_recomputing_days_empties_a_month(spark, tmp_path):
    dst = str(tmp_path)
    etl.run_etl(spark, sources(spark, docs=[(1, utc(2026, 3, 1))], favourites=[(1, 1, utc(2026, 4, 2)), (1, 1, at(1))], views=[(1, at(1))], bridge=[(1, 1)]), dst, RUN)
    options = etl.EtlOptions(mode="recompute", recompute_days=50)  # from the middle of January on
    etl.run_etl(spark, sources(spark, docs=[(1, utc(2026, 3, 1))], favourites=[(1, 1, at(1))], views=[(1, at(1))], bridge=[(1, 1)]), dst, RUN + dt.timedelta(hours=1), options=options)
    assert fact(spark, dst, "fact_interaccion_documento") == [(dt.date(2026, 3, 1), 1, 1, 1), (DAY, 1, 2, 1), (DAY, 1, 3, 1)]


def test_a_plain_star_is_taken_over(spark, tmp_path):
    dst = str(tmp_path)
    src = sources(spark, docs=[(1, at(1))], views=[(1, at(2))], bridge=[(1, 1)])
    etl.run_etl(spark, src, f"{dst}/a", RUN)
    for name, df in etl.read_warehouse(spark, f"{dst}/a").items():
        tables.write_table(df, f"{dst}/b", WAREHOUSE_TABLES[name])
    etl.run_etl(spark, sources(spark, docs=[(1, at(1))], views=[(1, at(2)), (1, at(3))], bridge=[(1, 1)]), f"{dst}/b", RUN + dt.timedelta(hours=1))
    assert (DAY, 1, 2, 2) in fact(spark, f"{dst}/b", "fact_interaccion_documento")


def test_same_run_twice_changes_nothing(spark, tmp_path):
    dst, src = str(tmp_path), sources(spark, docs=[(1, at(1))], views=[(1, at(2))])
    for _ in range(2):
        etl.run_etl(spark, src, dst, RUN, run_id="only")
    assert (DAY, 1, 2, 1) in fact(spark, dst, "fact_interaccion_documento")


def test_dimension_update_keeps_the_first_date(spark, tmp_path):
    dst = str(tmp_path)
    etl.run_etl(spark, sources(spark, docs=[(1, at(1))]), dst, RUN)
    moved = sources(spark, docs=[(1, utc(2026, 5, 1))])
    moved["documento"] = moved["documento"].withColumn("titulo", F.lit("nuevo"))
    etl.run_etl(spark, moved, dst, RUN + dt.timedelta(hours=1))
    row = read_table(spark, dst, "dim_documento").first()
    assert (row["titulo"], row["fecha_alta"]) == ("nuevo", DAY)


def test_empty_sources_leave_the_marks(spark, tmp_path):
    etl.run_etl(spark, sources(spark), str(tmp_path), RUN)
    marks = read_table(spark, str(tmp_path), "etl_watermark").select(F.year("ultimo_procesado").alias("y")).collect()
    assert [r["y"] for r in marks] == [1970] * 3


def test_removal(spark, tmp_path, monkeypatch):
    dst, april = str(tmp_path), utc(2026, 4, 4, 1)
    src = sources(
        spark, docs=[(1, at(1)), (2, at(1)), (3, april)], views=[(1, at(2)), (2, at(2)), (2, at(3)), (3, april), (1, at(4))], favourites=[(1, 2, at(3))],
        bridge=[(1, 1), (2, 1), (2, 2), (3, 1)],
    )
    etl.run_etl(spark, src, dst, RUN)
    before = versions.manifest(spark, dst)
    gone = spark.createDataFrame([(2,), (2,), (77,)], "id_documento int")
    commit = versions.commit

    def crash(*args, **kwargs):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(versions, "commit", crash)
    with pytest.raises(RuntimeError):
        remove_documents(spark, dst, src["documento_autor"], gone, DAY)
    monkeypatch.setattr(versions, "commit", commit)
    assert versions.manifest(spark, dst) == before
    now = remove_documents(spark, dst, src["documento_autor"], gone, DAY)
    assert fact(spark, dst, "fact_interaccion_documento") == [(april.date(), 3, 1, 1), (april.date(), 3, 2, 1), (DAY, 1, 1, 1), (DAY, 1, 2, 2)]
    assert fact(spark, dst, "fact_interaccion_autor") == [(april.date(), 1, 1, 1), (april.date(), 1, 2, 1), (DAY, 1, 1, 1), (DAY, 1, 2, 2)]
    for name in etl.FACTS:  # untouched months keep their files
        assert now.tables[name]["2026-04"] == before.tables[name]["2026-04"] and now.tables[name]["2026-05"] != before.tables[name]["2026-05"]
    marked = read_table(spark, dst, "dim_documento").filter("is_deleted").collect()
    assert [(r["id_documento"], r["deleted_at"]) for r in marked] == [(2, DAY)]


def test_phases_run_after_a_failure(spark):
    ran = []
    report = etl.run_phases(spark, {"a": lambda: 1 / 0, "b": lambda: ran.append(1)}).collect()
    assert [(r["fase"], r["correcta"]) for r in report] == [("a", False), ("b", True)] and ran == [1]


def test_calendar(spark):
    days = calendar_until(spark, dt.date(2024, 12, 31))
    assert days.count() == 397 and days.agg(F.max("fecha")).first()[0] == dt.date(2025, 1, 31)
    terms = {r["mes"]: r["cuatrimestre"] for r in days.collect()}
    assert [terms[m] for m in (1, 7, 8, 12)] == [1, 1, 2, 2]
    academic = {r["mes"]: r["cuatrimestre"] for r in calendar_until(spark, dt.date(2024, 12, 31), rule="academic").collect()}
    assert [academic[m] for m in (1, 7, 8, 12)] == [0, 1, 2, 2]
    assert add_month(dt.date(2024, 1, 31)) == dt.date(2024, 2, 29)
