from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from scholarmart.functions.stemming import by_stem, stem
from scholarmart.functions.text import STOP_WORDS, spoken_tokens
from scholarmart.plans import postings
from scholarmart.suite import QUERIES, load

# Words and stems of the published sample vocabulary.
PAIRS = """
cheque chequ, chequeo cheque, cheques chequ, chester chest, chetumaleños chetumaleñ, chi chi, chía chi, chiapaneca chiapanec, chiapas chiap,
chicas chic, chicharrones chicharron, torácica torac, toral toral, torear tor, toreándolo tor, torearlas tor, toreó tore, torero torer,
tormentas torment, tornado torn, torneos torne, tornillos tornill, torniquete torniquet, torpedearon torped, torpeza torpez, torrado torr,
torrenciales torrencial, torrente torrent, torreón torreon"""


@pytest.mark.parametrize("pair", [p.strip() for p in PAIRS.split(",")])
def test_known_pairs(pair):
    word, wanted = pair.split()
    assert stem(word) == wanted


@pytest.mark.parametrize(
    "word, wanted",
    [
        ("rápidamente", "rapid"), ("activamente", "activ"), ("biología", "biolog"), ("distribuciones", "distribu"), ("distribuyendo", "distribu"),
        ("utilidad", "util"), ("aplicaciones", "aplic"), ("siguen", "sig"), ("redes", "red"), ("", ""), ("a", "a"), ("2024", "2024"), ("дом", "дом"),
    ],
)
def test_rules(word, wanted):
    assert stem(word) == wanted


def test_forms_of_a_word_meet_in_the_postings(spark, tmp_path):
    rows = [(1, "Las aplicaciones de la red"), (2, "aplicar redes, aplicada"), (3, None), (4, ""), (5, "tormenta")]
    docs = spark.createDataFrame(rows, "id long, text string").select("id", spoken_tokens("text").alias("tokens"))
    root = str(tmp_path / "stems")
    postings.append(docs, root, stems=True)
    index = postings.Index(spark, root)
    got = {(r["termino"], r["id"], r["tf"], r["dl"]) for r in index.postings().collect()}
    assert got == {("aplic", 1, 1, 2), ("red", 1, 1, 2), ("aplic", 2, 2, 3), ("red", 2, 1, 3), ("torment", 5, 1, 1)}
    assert {r["id"] for r in index.search([stem("aplicando")], 5).collect()} == {1, 2}
    assert by_stem(index.postings().limit(0)).count() == 0


def test_stems_of_all_documents(spark, folder):
    load()
    held, times = Counter(), Counter()
    for (text,) in spark.read.parquet(f"{folder}/documents.parquet").select(F.lower("text")).collect():
        stems = Counter(stem(w) for w in regex.split(r"[^\p{L}\p{N}]+", text or "") if w and w not in STOP_WORDS)
        held.update(stems.keys())
        times.update(stems)
    got = {r["termino"]: (r["documentos"], r["apariciones"]) for r in QUERIES["x_18_stem"](spark, folder).collect()}
    assert got == {w: (held[w], times[w]) for w in held}
