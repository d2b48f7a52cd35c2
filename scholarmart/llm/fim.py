"""Fill-in-the-middle: texts cut at borders of units that a wavelet matrix over character classes counts and finds.

Every code point has one of four classes: line end, other white space, sentence mark, anything else. A unit ends behind a code point
of certain classes (``UNITS``), or with the text: with lines, a text is ``[^\\n]*\\n|[^\\n]+`` from left to right. The classes of a text form a
wavelet matrix of two bit vectors. The number of borders up to a place is the sum of the ranks of the ending classes there;
the place behind the k-th border is a select where one class ends a unit, and found by bisection on the summed ranks
where several do. So both cuts cost a few look-ups, whatever the length of the text.

The two cuts are drawn uniformly among the ``n + 1`` places from 0 to ``n`` units by a hash of the document's id, as are the share of
texts that stay plain and the order of the parts: ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm`` is ``<S>`` suffix ``<P>`` prefix ``<M>``
middle. Texts that hold a marker stay plain, so that every output can be taken apart again (``restore``). A null text
counts as empty, an empty one stays plain; a null id counts as the empty text. Rows that repeat are cut alike. Columns other than id and
text do not matter. Texts are whole; a task holds one batch of them, and one byte for each code point of the text at hand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER, BLANK, STOP, NEWLINE = range(4)
BITS = 2
SENTENCE_MARKS = ".!?。！？"
#: classes that end a unit
UNITS = {"line": (NEWLINE,), "sentence": (STOP, NEWLINE), "word": (BLANK, NEWLINE), "char": (OTHER, BLANK, STOP, NEWLINE)}
MARKERS = ("<P>", "<S>", "<M>")

CLASS_OF = np.zeros(1 << 16, np.uint8)
CLASS_OF[[c for c in range(1 << 16) if chr(c).isspace()]] = BLANK
CLASS_OF[[ord(c) for c in SENTENCE_MARKS]] = STOP
CLASS_OF[ord("\n")] = NEWLINE


def classes(text: str) -> np.ndarray:
    """The class of every code point; those beyond the basic plane are OTHER, as is its last one."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return CLASS_OF[np.minimum(points, CLASS_OF.size - 1)]


class Bits:
    """A bit vector in words of 64 with the number of ones before each word."""

    def __init__(self, ones: np.ndarray):
        packed = np.packbits(ones, bitorder="little")
        self.words = np.zeros(len(ones) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])
        self.zeros = len(ones) - int(self.before[-1])

    def rank(self, stop: int) -> int:
        """Ones before ``stop``."""
        word, rest = divmod(stop, 64)
        return int(self.before[word]) + (int(self.words[word]) & ((1 << rest) - 1)).bit_count()

    def select(self, k: int, bit: int) -> int:
        """Where the ``k``-th ``bit`` stands, from 0."""
        before = self.before if bit else 64 * np.arange(len(self.before)) - self.before
        word = int(np.searchsorted(before, k, side="right")) - 1
        held = int(self.words[word]) if bit else ~int(self.words[word]) & (2**64 - 1)
        for _ in range(k - int(before[word])):
            held &= held - 1
        return 64 * word + (held & -held).bit_length() - 1


class WaveletMatrix:
    """Rank and select over a sequence of symbols below ``2 ** bits``: one bit vector for each bit, the highest first."""

    def __init__(self, symbols: np.ndarray, bits: int = BITS):
        self.size, self.levels = len(symbols), []
        for shift in reversed(range(bits)):
            ones = (symbols >> shift & 1).astype(bool)
            self.levels.append((shift, Bits(ones)))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def _down(self, symbol: int, at: int) -> int:
        for shift, bits in self.levels:
            ones = bits.rank(at)
            at = bits.zeros + ones if symbol >> shift & 1 else at - ones
        return at

    def rank(self, symbol: int, stop: int) -> int:
        """How often ``symbol`` stands before ``stop``."""
        return self._down(symbol, stop) - self._down(symbol, 0)

    def select(self, symbol: int, k: int) -> int:
        """Where the ``k``-th ``symbol`` stands, from 0."""
        at = self._down(symbol, 0) + k
        for shift, bits in reversed(self.levels):
            one = symbol >> shift & 1
            at = bits.select(at - bits.zeros if one else at, one)
        return at


class Borders:
    """Units of a text: how many there are, and where the first ``k`` of them end."""

    def __init__(self, text: str, ends: tuple[int, ...]):
        symbols = classes(text)
        self.ends, self.matrix = ends, WaveletMatrix(symbols)
        self.closed = self.before(len(symbols))
        self.count = self.closed + int(len(symbols) > 0 and int(symbols[-1]) not in ends)

    def before(self, stop: int) -> int:
        """Units that end at ``stop`` or earlier."""
        return sum(self.matrix.rank(c, stop) for c in self.ends)

    def place(self, k: int) -> int:
        """Code points in the first ``k`` units."""
        if k == 0 or k > self.closed:
            return 0 if k == 0 else self.matrix.size
        if len(self.ends) == 1:
            return self.matrix.select(self.ends[0], k - 1) + 1
        low, high = 1, self.matrix.size
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if self.before(mid) >= k else (mid + 1, high)
        return low


def cuts(text: str, ends: tuple[int, ...], h1: int, h2: int) -> tuple[int, int, int]:
    """Units of a text and the code points before the first and the second cut."""
    borders = Borders(text, ends)
    low, high = sorted((h1 % (borders.count + 1), h2 % (borders.count + 1)))
    return borders.count, borders.place(low), borders.place(high)


def _cutter(ends: tuple[int, ...]):
    @F.pandas_udf("n long, first long, second long")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, h1, h2 in batches:
            yield pd.DataFrame([cuts(t, ends, int(a), int(b)) for t, a, b in zip(texts, h1, h2)], columns=["n", "first", "second"])

    return cut


def _draw(k: int) -> Column:
    return F.conv(F.substring("drawn", 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}")


def fill_in_middle(docs: DataFrame, unit: str = "line", seed: str = "7", fim_percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row of ``docs``.

    ``n`` counts units, lengths are code points and null if the form is plain. Only texts go to Python, which returns three numbers;
    the parts are put together by Spark's functions.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = docs.select("doc_id", text.alias("text"), drawn.alias("drawn")).select("doc_id", "text", *(_draw(k) for k in range(4)))
    rows = rows.withColumn("cut", _cutter(UNITS[unit])("text", "h1", "h2"))
    marked = F.lit(False)
    for marker in MARKERS:
        marked = marked | F.contains("text", F.lit(marker))
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= fim_percent)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    p, s, m = (F.lit(x) for x in MARKERS)
    prefix = F.expr("substring(text, 1, int(cut.first))")
    middle = F.expr("substring(text, int(cut.first) + 1, int(cut.second - cut.first))")
    suffix = F.expr("substring(text, int(cut.second) + 1)")
    output = F.when(F.col("form") == "plain", F.col("text")).when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle)).otherwise(F.concat(s, suffix, p, prefix, m, middle))
    cut = F.col("form") != "plain"
    return rows.withColumn("form", form).select(
        "doc_id", F.col("cut.n").alias("n"), "form", F.when(cut, F.col("cut.first")).alias("prefix_chars"),
        F.when(cut, F.col("cut.second") - F.col("cut.first")).alias("middle_chars"), output.alias("output"),
    )


def restore(outputs: DataFrame) -> DataFrame:
    """``outputs`` with ``restored``, the text rebuilt from ``output`` and ``form`` alone."""
    parts = F.split("output", "<[PSM]>", -1)
    psm, spm = (F.concat(*(parts[i] for i in order)) for order in ((1, 3, 2), (2, 3, 1)))
    return outputs.withColumn("restored", F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("output")))
