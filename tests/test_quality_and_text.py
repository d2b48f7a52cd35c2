import json

import pytest
from pyspark.sql import functions as F

from scholarmart.contracts import SOURCE_TABLES, SchemaMismatch, check_schema
from scholarmart.functions import scalar, vectors
from scholarmart.functions.text import html_text, search_tokens, snippet, truncated
from scholarmart.operators import joins, quality, selection
from scholarmart.sources.keyvalue import explode_structs, load_config
from scholarmart.sources.tables import ensure_table, list_tables, month_series


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column).first()[0]


@pytest.mark.parametrize("url, masked", [("redis://u:p@h:1", "h:1"), ("redis://h:1", "redis://h:1"), ("a@b@c", "c")])
def test_mask(spark, url, masked):
    assert one(spark, scalar.mask_credentials("v"), url) == masked


@pytest.mark.parametrize("value, digits, want", [(2.5, 0, 3.0), (-2.5, 0, -3.0), (1.005, 2, 1.01), (-0.0000001, 3, 0.0)])
def test_rounding(spark, value, digits, want):
    got = one(spark, scalar.round_half_up("v", digits), value, "double")
    assert got == want and str(got) == str(want)


def test_html(spark):
    page = "<html><style>p{}</style><script>var x='<p>';</script><!-- no --><p>Uno &amp; <b>dos</b></p>\n tres</html>"
    assert one(spark, html_text("v"), page) == "Uno & dos tres"


def test_tokens(spark):
    assert one(spark, search_tokens("v"), "Las Redes NEURONALES, análisis de señales") == ["red", "neuronal", "analisi", "senal"]
    assert one(spark, search_tokens("v", stem=False), "Las redes, de ANÁLISIS") == ["redes", "analisis"]
    assert one(spark, search_tokens("v"), None) == []


def test_snippet(spark):
    assert one(spark, snippet("v", "dos", 4, 9), "uno y Dos y tres") == "o y Dos y"
    assert one(spark, snippet("v", "nada"), "uno") == ""
    assert one(spark, truncated("v", 3), "abcd") == "abc..." and one(spark, truncated("v", 4), "abcd") == "abcd"


def test_cosine_of_missing_and_zero_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0])], "id int, v array<float>")
    got = {r["id"]: r["s"] for r in df.select("id", vectors.cosine("v", vectors.literal_vector([2.0, 0.0])).alias("s")).collect()}
    assert got == {1: 1.0, 2: None, 3: None}


def test_contract_rules(spark):
    contract = SOURCE_TABLES["usuario"]
    users = spark.createDataFrame(
        [(1, "a@b.com", "Ana", "docente", None), (2, "no mail", "B", "jefe", 1), (3, None, "C", "docente", 1)],
        "id int, email string, nombre string, rol string, id_carrera int",
    ).withColumns({"created_at": F.current_timestamp(), "updated_at": F.current_timestamp()})
    good, bad = quality.split_valid(users, quality.row_rules(contract))
    assert [r["id"] for r in good.collect()] == [1]
    assert {r["id"]: set(r["motivos"]) for r in bad.collect()} == {2: {"rol_domain", "email_pattern"}, 3: {"email_null"}}
    with pytest.raises(quality.Violations):
        quality.split_valid(users, quality.row_rules(contract), "fail")


def test_schema_check(spark):
    with pytest.raises(SchemaMismatch, match="nombre"):
        check_schema(spark.createDataFrame([(1,)], "id int"), SOURCE_TABLES["tipo_documento"])
    assert check_schema(spark.createDataFrame([("x", 1)], "nombre string, id long"), SOURCE_TABLES["tipo_documento"]).columns == ["id", "nombre"]


def test_keys(spark):
    df = spark.createDataFrame([(1, 5), (1, 6), (None, 7), (None, 8)], "k int, f int")
    assert [tuple(r) for r in quality.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    parent = spark.createDataFrame([(5,), (6,)], "id int")
    assert {tuple(r) for r in quality.orphans(df, parent, "f", "id").collect()} == {(7, 1), (8, 1)}


def test_visibility(spark):
    docs = spark.createDataFrame([(1, "publico"), (2, "interno"), (3, "privado"), (4, "privado")], "id_documento int, visibilidad string")
    bridge = spark.createDataFrame([(3, 9)], "id_documento int, id_usuario int")
    ids = lambda df: {r["id_documento"] for r in df.collect()}
    assert ids(selection.visible_to(docs, "guest")) == {1}
    assert ids(selection.visible_to(docs, "member")) == {1, 2}
    assert ids(selection.visible_to(docs, "author", bridge, 9)) == {1, 2, 3}


def test_interval_join_of_a_hot_key(spark):
    searches = spark.range(200).select(F.lit(1).alias("u"), F.col("id").alias("s"), F.timestamp_seconds(F.col("id") * 10).alias("a"))
    views = spark.range(200).select(F.lit(1).alias("u"), F.col("id").alias("v"), F.timestamp_seconds(F.col("id") * 10 + 5).alias("b"))
    pairs = {(r["s"], r["v"]) for r in joins.within_seconds(searches, views, ["u"], "a", "b", 30).collect()}
    assert pairs == {(s, v) for s in range(200) for v in range(200) if 0 <= v * 10 + 5 - s * 10 <= 30}


def test_config(spark, tmp_path):
    path = tmp_path / "data.json"
    path.write_text(json.dumps({"autocomplete": {"key": "k", "queries": [{"text": "a b", "score": 3}, {"text": "c", "score": 1}]}}, indent=1))
    rows = explode_structs(load_config(spark, str(path)), "autocomplete.queries", "autocomplete.key").collect()
    assert {tuple(r) for r in rows} == {("k", "a b", 3), ("k", "c", 1)}


def test_tables(spark, tmp_path):
    contract = SOURCE_TABLES["tipo_documento"]
    for _ in range(2):
        assert ensure_table(spark, str(tmp_path), contract).count() == 0
    spark.range(1).createOrReplaceTempView("zz_b")
    spark.range(1).createOrReplaceTempView("zz_a")
    assert [r[0] for r in list_tables(spark, pattern="zz_*").collect()] == ["zz_a", "zz_b"]


def test_month_series(spark):
    import datetime as dt

    rows = month_series(spark, dt.date(2024, 1, 1), dt.date(2026, 5, 1)).collect()
    assert len(rows) == 29 and rows[-1]["ord"] == 29


def test_entities(spark):
    import html

    from scholarmart.functions.text import html_text, html_title, unescaped

    texts = ["a &amp; b", "&amp;lt;", "&eacute;&Ntilde;&szlig; &#233; &#xE9; &#x1F600; &#0; &#55296; &nope; & &; &#;", "x&nbsp;y", "", "&hellip;", "no", None, "&#9999999; &apos;"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = {r.i: r.u for r in rows.select("i", unescaped("t").alias("u")).collect()}
    kept = {2: html.unescape(texts[2].replace("&#0;", "@").replace("&#55296;", "%")).replace("@", "&#0;").replace("%", "&#55296;"), 8: "&#9999999; '"}
    assert found == {i: None if t is None else kept.get(i, html.unescape(t).replace("\u00a0", " ")) for i, t in enumerate(texts)}
    page = spark.createDataFrame([("<title>Tesis &amp; Dise&ntilde;o</title><p>M&aacute;s&nbsp; &#8364;5 &lt;b&gt;</p>",)], "h string")
    assert page.select(html_title("h"), html_text("h")).first()[:] == ("Tesis & Diseño", "Tesis & Diseño Más €5 <b>")
