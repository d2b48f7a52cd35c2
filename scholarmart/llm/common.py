"""Helpers shared by the operators of this folder: written tables, hashing of words, bitmaps of bounded size."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmart.session import scratch_path, shuffles_freed

#: bits of a broadcast bitmap (2 MB); a fuller bitmap lets more rows through to the exact join behind it
BITMAP_BITS = 1 << 24
#: words whose hash a task remembers before it forgets all of them
WORD_CACHE = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: cuts lineage, survives lost executors, has a known size. Its shuffles go once it is written."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_freed(spark):
        df.write.parquet(path)
    return based(spark.read.schema(df.schema).parquet(path), path)


def based(df: DataFrame, *on: DataFrame | str) -> DataFrame:
    """The frame with a note of the written tables it reads, for ``discard``."""
    df.written_to = tuple(path for x in on for path in ((x,) if isinstance(x, str) else vars(x).get("written_to", ())))
    return df


def discard(*frames: DataFrame | None) -> None:
    """Delete the written tables below some frames, which nothing may read after that."""
    for df in frames:
        for path in () if df is None else vars(df).get("written_to", ()):
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def bitmap(hashes: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bits at ``hash mod bits`` of the only column, gathered as at most ``bits / 32768`` rows of 4 KB."""
    at = F.pmod(F.col(hashes.columns[0]), F.lit(bits)) + 1
    rows = hashes.select(F.bitmap_bucket_number(at).alias("b"), F.bitmap_bit_position(at).alias("p")).groupBy("b").agg(F.bitmap_construct_agg("p").alias("m")).collect()
    whole = np.zeros((max(1, bits // 32768), 4096), np.uint8)
    for b, m in rows:
        whole[b - 1] = np.frombuffer(m, np.uint8)
    return whole.reshape(-1)


def in_bitmap(whole: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the signed 64-bit hashes have their bit set."""
    at = np.mod(hashes.astype(np.int64), np.int64(whole.size * 8))
    return (whole[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


class WordHashes(dict):
    """64-bit hash of a word given as bytes, remembered within the task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread a combination of hashes over all 64 bits."""
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words in order, repeats included; with fewer words, of the whole sequence."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    width = min(n, size)
    out = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        out = out * _MUL + words[k : n - width + 1 + k]
    return mixed(out)


def permutations(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of universal hash permutations of the 64-bit integers, as columns."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 2**63, count, np.uint64) * np.uint64(2) + np.uint64(1)
    return factors[:, None], rng.integers(0, 2**63, count, np.uint64)[:, None]


def minima(values: np.ndarray, factors: np.ndarray, offsets: np.ndarray, block: int = 2048) -> np.ndarray:
    """The smallest value under each permutation, in blocks that stay in the cache."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), block):
        np.minimum(low, (values[None, at : at + block] * factors + offsets).min(axis=1), out=low)
    return low


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, with A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []
