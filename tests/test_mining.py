import datetime as dt

import pytest

from scholarmart.operators import mining
from scholarmart.plans.dims import interaction_types

FACT = "fecha date, id_documento int, id_tipo_interaccion int, cant_interacciones int"


def month(i):
    return dt.date(2024 + i // 12, i % 12 + 1, 15)


def run(spark, rows, ids, **options):
    fact = spark.createDataFrame(rows, FACT)
    docs = spark.createDataFrame([(1, "uno"), (2, "dos"), (3, "tres")], "id_documento int, titulo string")
    out = mining.forecast(fact, docs, interaction_types(spark), ids=ids, **options).collect()
    return {r["id_documento"]: r for r in out}


def figures(row):
    return (row["meses_con_datos"], row["pendiente_mensual"], row["r2"], row["prom_mensual"], row["proyeccion"], row["tendencia"])


def test_known_trends(spark):
    rows = [(month(i), d, 2, base + slope * i) for d, base, slope in ((1, 6, 1), (2, 41, -1), (3, 22, 0)) for i in range(29)]
    got = run(spark, rows, [1, 2, 3])
    assert figures(got[1]) == (29, 1.0, 1.0, 20.0, 37.0, "creciente")
    assert figures(got[2]) == (29, -1.0, 1.0, 27.0, 10.0, "decreciente")
    assert figures(got[3]) == (29, 0.0, 1.0, 22.0, 22.0, "estable")


def test_longer_series(spark):
    got = run(spark, [(month(i), 1, 2, 6 + i) for i in range(36)], [1])
    assert figures(got[1]) == (36, 1.0, 1.0, 23.5, 44.0, "creciente")


def test_one_month_and_none(spark):
    got = run(spark, [(month(0), 1, 2, 5), (month(0), 2, 3, 9)], [1, 77])
    assert figures(got[1]) == (1, None, None, 5.0, None, "estable")
    assert figures(got[77]) == (0, None, None, None, None, "estable")
    assert got[77]["titulo"] is None


def test_gap_is_kept_or_filled(spark):
    rows = [(month(0), 1, 2, 10), (month(2), 1, 2, 14)]
    assert figures(run(spark, rows, [1], horizon=1)[1]) == (2, 2.0, 1.0, 12.0, 16.0, "creciente")
    assert run(spark, rows, [1], fill_gaps=True)[1]["meses_con_datos"] == 3


AUTHORS = "fecha date, id_usuario int, id_tipo_interaccion int, cant_interacciones int"


@pytest.mark.parametrize("slices", [1, 3, 7])
def test_segments(spark, slices):
    day = dt.date(2024, 5, 1)
    rows = []
    for author, (volume, impact) in enumerate([(1, 1), (2, 9), (5, 2), (9, 9)], start=1):
        rows += [(day, author, 1, volume), (day, author, 2, impact - 1), (day, author, 3, 1)]
    users = spark.createDataFrame([(i, 1, "c", "e", f"a{i}") for i in range(1, 6)], "id_usuario int, id_carrera int, nombre_carrera string, nombre_escuela string, nombre string")
    out = mining.segment_authors(spark.createDataFrame(rows, AUTHORS), users, interaction_types(spark), end=dt.date(2024, 12, 31), slices=slices)
    assert {r["id_usuario"]: r["segmento"] for r in out.collect()} == {
        1: "Periferico", 2: "Joya oculta", 3: "Prolifico sin alcance", 4: "Referente",
    }


def test_segment_medians_are_of_the_filtered_authors(spark):
    day = dt.date(2024, 5, 1)
    users = spark.createDataFrame(
        [(i, 1, "c", "A" if i <= 2 else "B", f"a{i}") for i in range(1, 5)],
        "id_usuario int, id_carrera int, nombre_carrera string, nombre_escuela string, nombre string",
    )
    fact = spark.createDataFrame([(day, i, t, i * 10) for i in range(1, 5) for t in (1, 2)], AUTHORS)
    out = mining.segment_authors(fact, users, interaction_types(spark), end=dt.date(2024, 12, 31), school="A")
    assert {r["id_usuario"]: r["segmento"] for r in out.collect()} == {1: "Periferico", 2: "Referente"}

