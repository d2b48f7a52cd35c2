"""Near copies, lines and their components against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scholarmart.llm.common import WordHashes, shingles, words_of
from scholarmart.llm.components import components, link
from scholarmart.llm.fingerprints import fingerprints, near_copies, runs
from scholarmart.llm.line_dedup import WIDTH, _candidates, dedup_lines, line_classes, without_repeated_lines
from scholarmart.llm.near_dedup import keep_one, near_groups


def union_find(ids, edges):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def brute(sets):
    ids = sorted(sets)
    edges = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return union_find(ids, edges)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return out


@pytest.fixture(scope="module")
def copies():
    """A crowd of copies with one to many edits, chains, exact copies and strangers."""
    rng = random.Random(3)
    base = [f"b{rng.randrange(400)}" for _ in range(120)]
    rows = [(i, " ".join(edited(rng, base, rng.choice([0, 1, 1, 2, 3, 5, 8])))) for i in range(60)]
    chain = [f"c{i}" for i in range(100)]
    for k in range(8):
        rows.append((100 + k, " ".join(chain[4 * k : 4 * k + 64])))
    rows += [(200 + i, " ".join(f"z{rng.randrange(3000)}" for _ in range(40))) for i in range(20)]
    rows += [(300 + i, rows[60 + i % 3][1]) for i in range(30)]
    return rows


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7)]
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, **{1000 + i: 1000 for i in range(50)}}


def test_link_finds_every_link_of_a_crowded_bucket(spark):
    """All ids share one key; members link only through rare common changes."""
    rng = random.Random(5)
    base, sets = list(range(100)), {}
    for i in range(80):
        own = set(base)
        for e in rng.sample(base, rng.choice([4, 12, 14])):
            own.discard(e)
            own.add(1000 + rng.randrange(60) if rng.random() < 0.7 else 10_000 + rng.randrange(10**6))
        sets[i] = own
    keys = spark.createDataFrame([(1, i, len(s)) for i, s in sets.items()], "key long, id long, n long")
    frame = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "id long, s array<long>")
    found = {i: i for i in sets} | {r.id: r.component for r in link(keys, frame).collect()}
    assert found == brute(sets)


@pytest.mark.parametrize("size, spots", [(30, 28), (90, 88)])
def test_copies_with_edits_of_their_own_make_few_pairs(spark, monkeypatch, size, spots):
    """Members differ by two lost elements and two new ones of their own; the pairs that are looked at grow with the members, not with their square."""
    sets = {i: (set(range(size)) - {i % spots, i % spots + 1}) | {1000 + 2 * i, 1001 + 2 * i} for i in range(300)}
    keys = spark.createDataFrame([(1, i, len(s)) for i, s in sets.items()], "key long, id long, n long")
    frame = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "id long, s array<long>")
    seen, confirmed = [], link.__globals__["_confirmed"]

    def counted(pairs, *rest):
        seen.append(pairs.count())
        return confirmed(pairs, *rest)

    monkeypatch.setitem(link.__globals__, "_confirmed", counted)
    found = {i: i for i in sets} | {r.id: r.component for r in link(keys, frame).collect()}
    assert found == brute(sets) and sum(seen) <= 10 * len(sets), seen


def test_near_groups_equal_brute_force(docs_of, copies):
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_groups(docs_of(copies), size=4).collect()}
    hashes = WordHashes()
    sets = {i: set(shingles(hashes.of(words_of(t)), 4).tolist()) for i, t in copies}
    roots = brute(sets)
    assert found == {i: (len(sets[i]), roots[i], roots[i] == i) for i in sets}


def test_near_groups_of_odd_rows(docs_of, odd_rows):
    rows = near_groups(docs_of(odd_rows)).collect()
    assert len(rows) == len(odd_rows)
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0 and by[1].kept and by[2].component_id == 2
    assert by[6].component_id == 5 and not by[6].kept and by[5].kept and by[4].n_shingles == 1
    null = [r for r in rows if r.doc_id is None]
    assert sorted((r.n_shingles, r.component_id or -1, r.kept) for r in null) == [(0, -1, True), (6, 5, False)]
    kept = keep_one(docs_of(odd_rows).withColumnRenamed("lang", "component_id"))
    assert "component_id" in kept.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, -1, 1, 2, 3, 4, 5, 7, 8, 9]


def test_near_groups_of_nothing(docs_of):
    assert near_groups(docs_of([])).count() == 0 and keep_one(docs_of([])).count() == 0


def line_set(line):
    data = line.strip(" ").lower().encode()
    return {data[i : i + WIDTH] for i in range(max(1, len(data) - WIDTH + 1))}


def test_lines_equal_brute_force(docs_of):
    rng = random.Random(9)
    base = [" ".join(f"w{rng.randrange(500)}" for _ in range(40)) for _ in range(6)]
    rows = []
    for i in range(25):
        lines = [" ".join(edited(rng, rng.choice(base).split(), rng.choice([0, 1, 1, 2, 6]))) for _ in range(3)] + ["", f"own line {i} {rng.random()}", "Again THE same line "]
        rows.append((i, "\n".join(lines)))
    places = {(i, p): line for i, t in rows for p, line in enumerate(t.split("\n")) if line.strip(" ")}
    order = sorted(places)
    roots = brute({k: line_set(places[p]) for k, p in enumerate(order)})
    keep = {order[k] for k, r in roots.items() if k == r}
    wanted = {i: "\n".join(line for p, line in enumerate(t.split("\n")) if not line.strip(" ") or (i, p) in keep) for i, t in rows}
    found = {r.doc_id: r.text for r in dedup_lines(docs_of(rows)).collect()}
    assert found == wanted


def test_one_edit_in_a_short_line_is_found(docs_of):
    rng = random.Random(7)
    scripts = ["abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщ", "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收"]
    lines = ["".join(rng.choice(letters) for _ in range(size)) for letters in scripts for size in (50, 60, 75, 90)]
    edits = [line[: len(line) // 2] + "7" + line[len(line) // 2 + 1 :] for line in lines]
    rows = [(1, "\n".join(lines)), (2, "\n".join([*edits, "own"])), (3, "own line at the end\n\u00a0\t" + lines[0].upper() + "\r\u3000")]
    found = {r.doc_id: (r.text, r.n_dropped) for r in dedup_lines(docs_of(rows)).collect()}
    assert found == {1: (rows[0][1], 0), 2: ("own", 12), 3: ("own line at the end", 1)}


def test_lines_of_odd_rows(docs_of, odd_rows):
    out = dedup_lines(docs_of(odd_rows).withColumnRenamed("lang", "n_lines")).collect()
    assert len(out) == len(odd_rows)
    by = {r.doc_id: r for r in out if r.doc_id is not None}
    assert by[1].text is None and by[2].text == "" and by[6].text == "" and by[6].n_dropped == 1 and by[5].n_dropped == 0 and by[3].text == "   \n \n" and by[6].n_chars == 0
    left = without_repeated_lines(docs_of(odd_rows))
    assert left.columns == docs_of(odd_rows).columns
    assert sorted(r.doc_id or -1 for r in left.collect()) == [-1, -1, 1, 2, 3, 4, 5, 7, 8, 9]
    assert dedup_lines(docs_of([])).count() == 0


def test_lines_that_share_a_band_by_chance_are_no_candidates(docs_of):
    """Lines of the same syllables, about 0.1 to 0.2 alike, share many bands; near copies among them stay candidates."""
    rng = random.Random(11)
    syllables = ["".join(rng.choice("aeioulnrst") for _ in range(rng.choice([2, 3, 4]))) for _ in range(24)]
    lines = ["".join(rng.choice(syllables) + rng.choice(["", "", " "]) for _ in range(rng.randrange(110, 130))) for _ in range(1500)]
    copies = [line[:150] + "7" + line[151:] for line in lines[:40]]
    classes = line_classes(docs_of([(1, "\n".join(lines)), (2, "\n".join(copies))]))
    by = {r.id: (r.first.doc_id, r.first.pos) for r in classes.select("id", "first").collect()}
    met = classes.select("id", F.explode("bands").alias("key")).groupBy("key").agg(F.collect_set("id").alias("ids")).where("size(ids) > 1").select(F.explode("ids")).distinct().count()
    found = {by[r.id] for r in _candidates(classes).select("id").distinct().collect()}
    assert found >= {(d, p) for d in (1, 2) for p in range(40)}
    assert met > 600 and len(found) < 200, (met, len(found))


def test_line_dedup_stage_keeps_columns_of_any_name(docs_of):
    line = "this very line stands in both of the documents"
    docs = docs_of([(1, f"{line}\nand one"), (2, f"{line}\nand two")])
    docs = docs.withColumns({"n_lines": F.lit(77), "n_dropped": F.col("doc_id") + 87, "rest": F.lit("x"), "row": F.lit("y")})
    out = without_repeated_lines(docs)
    assert out.columns == docs.columns
    found = sorted((r.doc_id, r.text, r.n_chars, r.n_lines, r.n_dropped, r.rest, r.row) for r in out.collect())
    assert found == [(1, f"{line}\nand one", len(line) + 8, 77, 88, "x", "y"), (2, "and two", 7, 77, 89, "x", "y")]


def test_fingerprints_name_the_next_document(docs_of, odd_rows):
    import hashlib

    rows = [(i * 3, " ".join(f"w{(i * j) % 37}" for j in range(5 + i % 40))) for i in range(90)]
    out = {r.doc_id: r for r in fingerprints(docs_of(rows), slice_rows=7).collect()}
    order = sorted(rows, reverse=True)
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        text = t[: len(t) - half] + after[:half]
        assert out[i].edited_sha256 == hashlib.sha256(text.encode()).hexdigest() and out[i].n_chars == len(t)
    assert len(fingerprints(docs_of(odd_rows), slice_rows=2).collect()) == len(odd_rows)
    one = fingerprints(docs_of([(4, "abcdefghijklmnop")])).first()
    assert one.near_next == 1.0 and fingerprints(docs_of([])).count() == 0


def test_fingerprints_estimate_similarity(docs_of):
    rng = random.Random(1)
    words = [f"t{rng.randrange(900)}" for _ in range(200)]
    a, b = " ".join(words), " ".join(edited(rng, words, 12))
    x, y = set(runs(a.encode()).tolist()), set(runs(b.encode()).tolist())
    out = {r.doc_id: r for r in fingerprints(docs_of([(2, a), (1, b)])).collect()}
    assert abs(out[2].near_next - len(x & y) / len(x | y)) < 0.2


def test_near_copies_equal_brute_force(docs_of, copies):
    found = {r.doc_id: r.component_id for r in near_copies(docs_of(copies)).collect()}
    roots = brute({i: set(np.unique(runs(t.encode())).tolist()) for i, t in copies})
    several = {r for r in roots.values() if sum(v == r for v in roots.values()) > 1}
    assert found == {i: r for i, r in roots.items() if r in several}
