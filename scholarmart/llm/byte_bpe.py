"""Byte-level BPE by overlapping chunks: chunks are split into pre-tokens in parallel, stitched, and encoded piece by piece.

A text is cut into chunks of ``CHUNK`` code points, each of which reads ``OVERLAP`` more. The pattern looks ahead only, so what it
matches at a place depends on the text from there on: once two neighbouring chunks have a border of pre-tokens in common, all
later ones agree. The first common border in the overlap, with ``MARGIN`` code points left for looking ahead, is where the text
passes from one chunk to the next, and what lies between two such places is a piece. Every pre-token of a piece is then encoded by
the ranks. Neighbours that do not meet (a run of letters or blanks longer than the overlap) are split again from the end of the
last piece over ever more chunks, until their borders meet those of a chunk. Decoding concatenates the bytes of the ids.

Texts of up to ``SPREAD`` code points are stitched within their row. The chunks of longer ones are rows of their own, dealt out over all
tasks: borders in the overlaps are joined as short lists, pieces are encoded where their chunk lies, and ids come together
by document only at the end. From the first pair of chunks that does not meet, the rest of such a text is one piece.
Equal long texts are encoded once. Every row of the input gives a row, repeated ones too; a null text counts as empty and has
no ids; ids of documents may be null. Special tokens are ordinary text. Columns other than id and text do not matter.

The vocabulary is a rank file named by its path, read by Spark and sent to the tasks (below 1 MB for 50,000 ranks).
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmart.llm.common import written

CHUNK, OVERLAP, SPREAD = 8192, 256, 32768
#: code points that a pre-token's match may look at behind its end
MARGIN = 4
#: pre-tokens whose ids a task remembers before it forgets all of them
CACHE = 1 << 16
#: texts whose ids are held at a time
ROWS = 256


class Vocabulary:
    """Ranks of byte strings and the pattern of pre-tokens."""

    def __init__(self, ranks: bytes, pattern: str):
        self.pattern = regex.compile(pattern)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.known = Known(self)

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def encode(self, pre_tokens: list[str]) -> bytes:
        """Ids of pre-tokens as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.known.__getitem__, pre_tokens))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Known(dict):
    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, pre_token: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        # the merges of one pre-token; the pattern is not asked again
        ids = self[pre_token] = np.array(self.vocabulary.encoding._encode_single_piece(pre_token), "<u4").tobytes()
        return ids


@lru_cache(maxsize=2)
def _vocabulary(ranks: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(ranks, pattern)


def vocabulary(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    """The rank file at ``path`` and the pattern, as they are sent to tasks."""
    if "://" not in path:
        path = f"file://{path}"  # the driver's own; only its content travels
    content = b"\n".join(row[0].encode() for row in _lines(spark, path))
    return spark.sparkContext.broadcast((content, pattern))


def _lines(spark: SparkSession, path: str):
    if path.startswith("file://"):
        with open(path.removeprefix("file://"), encoding="ascii") as file:
            return [(line.strip(),) for line in file if line.strip()]
    return spark.read.text(path).where("value <> ''").collect()


# --- one text -----------------------------------------------------------------------


def borders(pre_tokens: list[str], start: int) -> np.ndarray:
    """Where pre-tokens begin and the last one ends, as places in the text."""
    out = np.empty(len(pre_tokens) + 1, np.int64)
    out[0] = start
    np.cumsum(np.fromiter(map(len, pre_tokens), np.int64, len(pre_tokens)), out=out[1:])
    out[1:] += start
    return out


def sure(places: np.ndarray, end: int, size: int) -> np.ndarray:
    """Borders of a chunk that ends at ``end`` which do not depend on what follows there."""
    return places if end >= size else places[places <= end - MARGIN]


def first_common(a: np.ndarray, b: np.ndarray, least: int) -> int:
    """The first border of both from ``least`` on, or -1."""
    both = np.intersect1d(a[a >= least], b, assume_unique=True)
    return int(both[0]) if len(both) else -1


def between(pre_tokens: list[str], places: np.ndarray, low: int, high: int) -> list[str]:
    a, b = np.searchsorted(places, (low, high))
    return pre_tokens[a:b]


def pre_tokens(text: str, split, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[list[str]]:
    """The pre-tokens of a text, piece by piece, each from one chunk where neighbours meet."""
    size, starts = len(text), list(range(0, len(text), chunk))

    def part(number: int):
        end = min(size, starts[number] + chunk + overlap)
        own = split(text[starts[number] : end])
        return own, borders(own, starts[number]), end

    if not size:
        return
    at = number = 0  # all before the border ``at`` is done; it is a border of chunk ``number`` too
    current = part(0)
    while True:
        own, places, end = current
        if end >= size:
            yield between(own, places, at, size)
            return
        last, reach = number + 1, 1
        current = part(last)
        meets = first_common(sure(places, end, size), current[1], starts[last])
        while meets < 0:  # split again from the last piece's end over 1, 2, 4 ... chunks more
            last = min(number + reach, len(starts) - 1)
            current = part(last)
            end = current[2]
            own = split(text[at:end])
            places = borders(own, at)
            if end >= size:
                yield own
                return
            meets = first_common(sure(places, end, size), sure(current[1], end, size), starts[last])
            reach *= 2
        yield between(own, places, at, meets)
        at, number = meets, last


def encoded(text: str, own: Vocabulary, chunk: int = CHUNK, overlap: int = OVERLAP) -> bytes:
    return b"".join(own.encode(piece) for piece in pre_tokens(text, own.split, chunk, overlap))


def _encode_texts(sent: Broadcast, chunk: int, overlap: int, decoded: bool):
    """Ids of whole texts, and if asked for the bytes they stand for, some hundred at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _vocabulary(*sent.value)
        for batch in batches:
            for part in (batch.slice(at, ROWS) for at in range(0, batch.num_rows, ROWS)):
                ids = [encoded(t.as_py(), own, chunk, overlap) for t in part.column("text")]
                columns = {"doc_id": part.column("doc_id"), "ids": pa.array(ids, pa.binary())}
                if decoded:
                    columns["decoded"] = pa.array(map(own.decode, ids), pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return run


# --- the chunks of long texts ----------------------------------------------------------


def _chunks(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``key, number, size, text`` of every chunk of every different long text."""
    cut = "transform(sequence(0, int(length(text) - 1) div {c}), k -> substring(text, k * {c} + 1, {w}))".format(c=chunk, w=chunk + overlap)
    rows = long.select("key", F.length("text").alias("size"), F.posexplode(F.expr(cut)).alias("number", "text"))
    return written(rows.dropDuplicates(["key", "number"]), "chunks")


def _edges(sent: Broadcast, chunk: int, overlap: int):
    """Borders of a chunk within the overlap with the one before it, and with the one behind it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = _vocabulary(*sent.value)
        for batch in batches:
            rows = []
            for key, number, size, text in zip(batch["key"], batch["number"], batch["size"], batch["text"]):
                start = int(number) * chunk
                places = borders(own.split(text), start)
                tail = sure(places, start + len(text), size)
                rows.append((key, number, size, places[places <= start + overlap], tail[tail >= start + chunk]))
            yield pd.DataFrame(rows, columns=["key", "number", "size", "head", "tail"])

    return run


def _pieces(chunks: DataFrame, sent: Broadcast, chunk: int, overlap: int) -> DataFrame:
    """``key, number, piece, low, high``: the piece a chunk belongs to, and where in the text it begins and ends.

    A piece bears the number of its first chunk. Only from the first pair that does not meet on has a piece several chunks.
    """
    edges = written(chunks.mapInPandas(_edges(sent, chunk, overlap), "key string, number int, size int, head array<long>, tail array<long>"), "edges")
    after = edges.select("key", (F.col("number") - 1).alias("number"), F.col("head").alias("next_head"))
    met = edges.join(after, ["key", "number"]).select("key", "number", F.array_min(F.array_intersect("tail", "next_head")).alias("meets"))
    met = written(met, "met")
    broken = met.where("meets is null").groupBy("key").agg(F.min("number").alias("broken"))
    low = met.select("key", (F.col("number") + 1).alias("number"), F.col("meets").alias("low"))
    whole = edges.select("key", "number", "size").join(met, ["key", "number"], "left").join(low, ["key", "number"], "left").join(broken, "key", "left")
    piece = F.least("number", "broken")  # least passes over null
    high = F.when(F.col("broken") <= F.col("number"), F.col("size")).otherwise(F.coalesce("meets", "size"))
    return whole.select("key", "number", piece.alias("piece"), F.coalesce("low", F.lit(0)).cast("long").alias("low"), high.cast("long").alias("high"))


def _encode_pieces(sent: Broadcast, chunk: int, overlap: int):
    """Pieces of one chunk, one a row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = _vocabulary(*sent.value)
        for batch in batches:
            rows = []
            for key, piece, low, high, text in zip(batch["key"], batch["piece"], batch["low"], batch["high"], batch["text"]):
                tokens = own.split(text[low - piece * chunk :])
                rows.append((key, piece, own.encode(between(tokens, borders(tokens, low), low, high))))
            yield pd.DataFrame(rows, columns=["key", "piece", "ids"])

    return run


def _runs(batches: Iterator[pd.DataFrame], *keys: str):
    """Rows with equal keys that follow each other, as one list at a time."""
    rows = itertools.chain.from_iterable(batch.itertuples(index=False) for batch in batches)
    return itertools.groupby(rows, lambda row: tuple(getattr(row, k) for k in keys))


def _encode_rests(sent: Broadcast, chunk: int, overlap: int):
    """Pieces of several chunks, whose rows follow each other in order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = _vocabulary(*sent.value)
        for (key, piece), rows in _runs(batches, "key", "piece"):
            rows = list(rows)
            text = "".join(row.text[:chunk] for row in rows[:-1]) + rows[-1].text
            yield pd.DataFrame({"key": [key], "piece": [piece], "ids": [encoded(text[rows[0].low - piece * chunk :], own, chunk, overlap)]})

    return run


def _concatenate(sent: Broadcast, decoded: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = _vocabulary(*sent.value)
        for (key,), rows in _runs(batches, "key"):
            ids = b"".join(row.ids for row in rows)
            yield pd.DataFrame({"key": [key], "ids": [ids]} | ({"decoded": [own.decode(ids)]} if decoded else {}))

    return run


def _encode_long(long: DataFrame, sent: Broadcast, chunk: int, overlap: int, decoded: bool) -> DataFrame:
    """``key, ids`` of every different text of ``long``, and if asked for ``decoded``."""
    chunks = _chunks(long, chunk, overlap)
    rows = chunks.join(_pieces(chunks, sent, chunk, overlap), ["key", "number"])
    several = F.col("high") - F.col("piece") * chunk > chunk + overlap
    schema = "key string, piece int, ids binary"
    pieces = rows.where(~several).mapInPandas(_encode_pieces(sent, chunk, overlap), schema)
    rests = rows.where(several).repartition("key").sortWithinPartitions("key", "piece", "number").mapInPandas(_encode_rests(sent, chunk, overlap), schema)
    return pieces.union(rests).repartition("key").sortWithinPartitions("key", "piece").mapInPandas(_concatenate(sent, decoded), "key string, ids binary" + ", decoded binary" * decoded)


# --- frames --------------------------------------------------------------------------------


def encode(
    docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP, spread: int = SPREAD, decoded: bool = False
) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row of ``docs``; ids are little-endian unsigned 32-bit integers in one binary value.

    With ``decoded``, ids are decoded where they are made, and their bytes added as a column.
    """
    sent = vocabulary(docs.sparkSession, path, pattern)
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    values = ["ids", "decoded"] if decoded else ["ids"]
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), *(T.StructField(v, T.BinaryType()) for v in values)])
    long = rows.where(F.length("text") > spread).select("doc_id", "text", F.sha2(F.col("text").cast("binary"), 256).alias("key"))
    short = rows.where(F.length("text") <= spread).mapInArrow(_encode_texts(sent, chunk, overlap, decoded), schema)
    both = short.union(long.select("doc_id", "key").join(_encode_long(long, sent, chunk, overlap, decoded), "key").select("doc_id", *values))
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), *values)


def decode(spark: SparkSession, ids: Column, path: str, pattern: str) -> Column:
    """The bytes of ids as ``encode`` gives them; an id that the vocabulary lacks is an error."""
    sent = vocabulary(spark, path, pattern)

    @F.pandas_udf("binary")
    def decode_ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = _vocabulary(*sent.value)
        for batch in batches:
            yield pd.Series([None if x is None else own.decode(x) for x in batch], dtype=object)

    return decode_ids(ids)
