"""Fill-in-the-middle, ranked search and byte-level BPE against brute force, on odd rows and empty tables."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from scholarmart.llm import byte_bpe, fim, lexical, queries

RANKS = (public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
ODD = ["", " ", "\n", "\n\n\n", "a", "a\n", "\na", "x\r\ny", "é😀\nß. 東京。", "no end", "<P> in it", "a<S", "… \n \t.\n"]


def key(r):
    return tuple((x is not None, x) for x in r)


# --- fill in the middle ------------------------------------------------------------

UNIT_PATTERNS = {"line": r"[^\n]*\n|[^\n]+", "sentence": r"[^\n.!?。！？]*[\n.!?。！？]|[^\n.!?。！？]+", "word": r"\S*\s|\S+", "char": r"(?s:.)"}


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 128, 1000])
def test_wavelet_matrix(size):
    symbols = np.random.default_rng(size).integers(0, 4, size).astype(np.uint8)
    matrix = fim.WaveletMatrix(symbols)
    for c in range(4):
        assert [matrix.rank(c, p) for p in range(size + 1)] == [int((symbols[:p] == c).sum()) for p in range(size + 1)]
        places = np.flatnonzero(symbols == c)
        assert [matrix.select(c, k) for k in range(len(places))] == places.tolist()


@pytest.mark.parametrize("unit", UNIT_PATTERNS)
def test_borders_equal_the_pattern(unit):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab .\n!é😀。") for _ in range(rng.randrange(300))) for _ in range(60)]
    for text in texts:
        parts = re.findall(UNIT_PATTERNS[unit], text)
        assert "".join(parts) == text
        found = fim.Borders(text, fim.UNITS[unit])
        assert found.count == len(parts)
        assert [found.place(k) for k in range(len(parts) + 1)] == [len("".join(parts[:k])) for k in range(len(parts) + 1)]


def fim_of(doc, text, unit="line"):
    text, parts = text or "", re.findall(UNIT_PATTERNS[unit], text or "")
    digest = hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(parts) + 1), h[1] % (len(parts) + 1)))
    p, m, s = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return doc, len(parts), "plain", None, None, text
    return (doc, len(parts), *(("spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 50 else ("psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")))


@pytest.mark.parametrize("unit", ["line", "sentence"])
def test_fill_in_middle(docs_of, odd_rows, unit):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(ODD)] + [(200, "<<P" + "\n>" * 50), (-5, "a\nb\n")]
    docs = docs_of(rows).withColumns({"n": F.lit(1), "form": F.lit("x"), "output": F.lit("y"), "cut": F.lit(0)})
    out = fim.restore(fim.fill_in_middle(docs, unit)).collect()
    wanted = sorted(((*fim_of(r[0], r[1], unit), r[1] or "") for r in rows), key=key)
    assert sorted(map(tuple, out), key=key) == wanted
    assert fim.fill_in_middle(docs_of([])).count() == 0


def test_shares_of_forms(docs_of):
    docs = docs_of([(i, "a\nb\nc") for i in range(300)])
    forms = Counter(r.form for r in fim.fill_in_middle(docs, fim_percent=50, spm_percent=100).collect())
    assert 100 < forms["spm"] < 200 and forms["psm"] == 0 and forms["plain"] == 300 - forms["spm"]


# --- ranked search -------------------------------------------------------------------


def terms_of(text):
    return re.findall(lexical.TERM, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, k):
    held = [(d, terms_of(t)) for d, t in docs]
    n_docs, total = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    df = Counter(x for _, t in held for x in set(t))
    wanted = {}
    for i, text in items:
        if i is not None:
            wanted.setdefault(i, set()).update(terms_of(text))
    out = []
    for i, terms in wanted.items():
        scored = []
        for d, t in held:
            tf, m = Counter(t), 50 + 50 * len(t) * n_docs // max(1, total)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * tf[x] // (1000 * tf[x] + 20 * m)) for x in terms if tf[x])
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(i, at + 1, d, -s) for at, (s, _, d) in enumerate(sorted(scored, key=lambda r: (r[0], r[1], r[2] or 0))[:k])]
    return sorted(out, key=key)


def test_search_equals_brute_force(spark, docs_of, odd_rows, monkeypatch):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["Straße", "日本", "É", "x1"]
    docs = [(rng.choice([None, *range(-50, 400)]), rng.choice([" ", "--", "\n"]).join(rng.choice(words) for _ in range(rng.randrange(1, 60)))) for _ in range(400)]
    docs += [(1000 + i, "the same W1 w2 text") for i in range(300)] + [r[:2] for r in odd_rows]  # ties beyond k
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 12)))) for i in range(30)]
    items += [(3, "w1 w1 W2!"), (None, "w1"), (90, None), (91, ""), (92, "unheard"), (93, "w1,w2"), (94, "same text w1")]
    frame = spark.createDataFrame(items, "item_id long, text string").withColumns({"doc_id": F.lit(1), "score": F.lit(1), "term": F.lit(1)})
    monkeypatch.setattr(lexical, "PENDING", 500)
    for block_bytes in (1 << 20, 400):  # one block of items, and several
        out = lexical.search(docs_of(docs).withColumn("item_id", F.lit(7)).repartition(5), frame, 50, block_bytes).collect()
        assert sorted(map(tuple, out), key=key) == ranked(docs, items, 50)
    assert len(lexical._blocks(frame, 400)) > 2


def test_search_of_empty_tables(spark, docs_of):
    items = spark.createDataFrame([(1, "a b"), (2, None)], "item_id long, text string")
    assert lexical.search(docs_of([(1, "a")]), items.limit(0)).count() == 0
    assert lexical.search(docs_of([]), items).count() == 0
    assert lexical.search(docs_of([(1, None), (2, ""), (3, " . ")]), items).count() == 0
    assert [tuple(r)[:3] for r in lexical.search(docs_of([(1, "a"), (2, "c")]), items).collect()] == [(1, 1, 1)]


# --- byte-level BPE ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def own():
    with open(RANKS[0], "rb") as file:
        return byte_bpe.Vocabulary(file.read(), RANKS[1])


def mixed_texts(seed, count, length):
    rng = random.Random(seed)
    parts = ["the ", "word", "'s", "'ll", " '", "  ", "\n", "\n\n", "\t ", "12", "é", "日本", "😀", "!?", "a" * 40, " " * 40, "\n" * 40, "-" * 40, " ", "\x85", "'re"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(length))) for _ in range(count)] + [c * length for c in " a\n-'1"]


@pytest.mark.parametrize("chunk, overlap", [(8, 8), (16, 12), (64, 32), (200, 50)])
def test_stitched_chunks_equal_the_whole(own, chunk, overlap):
    for text in mixed_texts(chunk, 150, 300):
        pieces = list(byte_bpe.pre_tokens(text, own.split, chunk, overlap))
        assert [t for piece in pieces for t in piece] == own.split(text)


def reference(own, text):
    ids = np.array(own.encoding.encode_ordinary(text or ""), "<u4").tobytes()
    return len(ids) // 4, ids


@pytest.mark.parametrize("chunk, overlap, spread", [(16, 12, 40), (64, 32, 100), (8192, 256, 32768)])
def test_encode_and_decode(spark, docs_of, odd_rows, own, chunk, overlap, spread):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(mixed_texts(chunk + 1, 40, 200) + ODD)]
    rows += [(500 + i, "Equal long texts are encoded once. " * 40) for i in range(20)]
    docs = docs_of(rows).withColumns({"ids": F.lit(1), "key": F.lit("k"), "number": F.lit(2)})
    out = byte_bpe.encode(docs.repartition(4), *RANKS, chunk, overlap, spread, decoded=spread > 40)
    if spread == 40:
        out = out.withColumn("decoded", byte_bpe.decode(spark, F.col("ids"), *RANKS))
    out = out.collect()
    wanted = sorted(((r[0], *reference(own, r[1]), (r[1] or "").encode()) for r in rows), key=key)
    assert sorted(((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in out), key=key) == wanted


def test_encode_nothing(spark, docs_of):
    assert byte_bpe.encode(docs_of([]), *RANKS).count() == 0


def test_whole_table_equals_tiktoken(spark, folder, own):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    out = {r.doc_id: r for r in queries.op13_byte_bpe(spark, folder).collect()}
    assert len(out) == len(docs)
    for doc, text in docs:
        n, ids = reference(own, text)
        assert out[doc][1:] == (n, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_vocabulary_is_tiktokens(own):
    assert isinstance(own.encoding, tiktoken.Encoding) and len(own.bytes_of) == len(own.ranks) == own.encoding.max_token_value + 1
