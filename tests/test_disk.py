"""How often rows are shuffled, and what stays on disk."""

import os
from collections import Counter

from pyspark.sql import functions as F

from scholarmart import session
from scholarmart.functions.stemming import by_stem, stem
from scholarmart.plans import postings
from scholarmart.sources import tables
from scholarmart.suite import pipelines
from scholarmart.suite.roles import Roles

ROWS = [(1, ["redes", "red", "aplicar", None]), (2, ["aplicada", "red", "redes"]), (3, []), (4, None), (None, ["torres"]), (5, ["torre", "torres", "torres"])]


def wanted(rows):
    found = Counter()
    for i, tokens in rows:
        found.update((stem(w), -1 if i is None else i, len(tokens)) for w in tokens or [] if w is not None)
    return sorted((s, i, tf, dl) for (s, i, dl), tf in found.items())


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, tokens array<string>")


def rows_of(df):
    return sorted(tuple(r) for r in df.select("termino", F.coalesce("id", F.lit(-1)), "tf", "dl").collect())


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_stems_take_one_shuffle(spark):
    once = by_stem(postings.count_postings(frame(spark, ROWS)))
    assert exchanges(once) == 1 and rows_of(once) == wanted(ROWS)
    twice = [*ROWS, (1, ["redes", "red", "aplicar", "x"]), (2, ["redes"]), (None, ["torre"])]
    assert rows_of(by_stem(postings.count_postings(frame(spark, twice)))) == wanted(twice)


def test_postings_by_stems_are_laid_by_one_shuffle(spark, tmp_path):
    twice = [*ROWS, (1, ["redes", "red", "aplicar", "x"]), (None, ["torre"])]
    laid = postings._laid(postings._by_document(frame(spark, twice), "tokens", "id"), stems=True)
    assert exchanges(laid) == 1 and rows_of(laid) == wanted(twice)
    now = postings.append(frame(spark, twice), str(tmp_path), stems=True)
    assert rows_of(postings.Index(spark, str(tmp_path)).postings()) == wanted(twice)
    (folder,) = os.listdir(tmp_path / "_data")
    assert set(os.listdir(tmp_path / "_data" / folder)) == set(now.tables) == {"postings", "terms", "lengths"}
    lengths = sorted((-1 if r.id is None else r.id, r.dl) for r in postings.Index(spark, str(tmp_path)).lengths().collect())
    assert lengths == sorted((-1 if i is None else i, len(t or [])) for i, t in twice)


def test_a_load_and_a_removal_in_pieces_give_the_same_star(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    written, write = [], tables.write_version
    monkeypatch.setattr(tables, "write_version", lambda df, root, at, contract: written.append(contract.name) or write(df, root, at, contract))
    star = lambda: Counter(tuple(r) for r in pipelines.p_6(Roles(spark, folder)).collect())
    whole = star()
    monkeypatch.setattr(session, "tasks_for", lambda *frames, each=4 << 20, least=None: 3 if least else 4)
    written.clear()
    assert star() == whole and written.count("fact_interaccion_documento") == written.count("fact_interaccion_autor") == 6  # a load and a removal
    assert spark.conf.get(session.FREED) == "false"  # shuffles go inside a load only
