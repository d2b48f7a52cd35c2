"""Stored postings: an inverted file, written when documents come in and read by the buckets of a query's terms.

Every batch of documents is a segment of a versioned folder (``sources/versions.py``): postings by bucket of the term's hash, sorted by
term, each with the length of its document, so that scoring needs no other table; frequencies of the terms by bucket;
lengths of the documents, and their counted words. A query reads the buckets of its own terms and filters them on the term, which the statistics of the files
answer too. Appending writes one more segment and commits; removal writes the ids that no longer count in older segments;
``compact`` makes one segment of all.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmart.contracts import INT, LONG, TEXT, struct
from scholarmart.functions.stemming import stem_words
from scholarmart.operators.ranking import top_k, top_k_per_group
from scholarmart.session import shuffles_freed, tasks_for
from scholarmart.sources import versions
from scholarmart.sources.versions import Manifest

BUCKETS = 64
#: terms whose frequencies are sent to every task
FREQUENT = 1 << 17
POSTINGS = struct(("termino", TEXT), ("id", LONG), ("tf", LONG), ("dl", LONG), ("segmento", INT))
TERMS = struct(("termino", TEXT), ("df", LONG), ("segmento", INT))
LENGTHS = struct(("id", LONG), ("dl", LONG), ("segmento", INT))
WORDS = struct(("id", LONG), ("dl", LONG), ("palabras", T.ArrayType(struct(("termino", TEXT), ("tf", LONG)))), ("segmento", INT))
REMOVED = struct(("id", LONG), ("segmento", INT))


def bucket(term: str) -> int:
    return zlib.crc32(term.encode()) % BUCKETS


def bucket_of(term: str = "termino") -> Column:
    return F.crc32(F.col(term).cast("binary")) % BUCKETS


def counted(tokens: Column) -> Column:
    """``[(termino, tf)]`` of one array of tokens; nulls are no terms. The array is put in order and its runs are measured."""

    def runs(w: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: (i == 0) | (F.get(w, i) != F.get(w, i - 1)))
        tf = lambda s, e: F.struct(F.get(w, s).alias("termino"), (e - s).cast("long").alias("tf"))
        return F.transform(F.array(first), lambda s: F.zip_with(s, F.concat(F.slice(s, F.lit(2), F.size(s)), F.array(F.size(w))), tf))[0]

    # bound to a variable, or it would be sorted again for every word
    ordered = F.filter(F.array(F.sort_array(F.array_compact(tokens))), lambda w: F.size(w) > 0)
    return F.get(F.transform(ordered, runs), F.lit(0))


def _by_document(docs: DataFrame, tokens: str, key: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("id"), F.size(tokens).cast("long").alias("dl"), counted(F.col(tokens)).alias("palabras"))


def _words(documents: DataFrame) -> DataFrame:
    """``termino, id, tf, dl`` of rows with counted words; rows that repeat an id are not summed yet."""
    # a plain explode would count twice: once in a filter for empty arrays that is inferred from it
    return documents.select("id", "dl", F.explode_outer("palabras").alias("w")).filter("w is not null").select("w.termino", "id", "w.tf", "dl")


def count_postings(docs: DataFrame, tokens: str = "tokens", key: str = "id") -> DataFrame:
    """``termino, id, tf, dl``; rows of one id and length are one document. Counted within the rows, so one shuffle is enough to sum them,
    and none where no id is there twice."""
    spread = _words(_by_document(docs, tokens, key))
    with shuffles_freed(docs.sparkSession):
        if docs.groupBy(key).count().filter("count > 1").isEmpty():
            return spread.select("termino", "id", "tf", "dl")
    spread = spread.repartition(tasks_for(docs), "termino", "id")
    return spread.groupBy("termino", "id", "dl").agg(F.sum("tf").alias("tf")).select("termino", "id", "tf", "dl")


def _laid(documents: DataFrame, stems: bool = False) -> DataFrame:
    """The postings with their ``cubeta``, under words or their stems, summed and laid by buckets in the same shuffle. Buckets are cut by ids into as many pieces as the files are worth."""
    tasks = tasks_for(documents)
    piece = F.pmod(F.xxhash64("id"), F.lit(-(-tasks // (BUCKETS // 2)))).cast("int")
    spread = _words(documents)
    spread = stem_words(spread).select(F.col("raiz").alias("termino"), "id", "tf", "dl") if stems else spread
    spread = spread.repartition(tasks, bucket_of(), piece).select("*", bucket_of().alias("cubeta"), piece.alias("_piece"))  # neither travels
    return spread.groupBy("cubeta", "_piece", "termino", "id", "dl").agg(F.sum("tf").alias("tf"))


def append(docs: DataFrame, root: str, tokens: str = "tokens", key: str = "id", stems: bool = False) -> Manifest:
    """Add documents as a segment, under their words or the Spanish stems of these. Ids that are stored already have to be removed before."""
    base = versions.manifest(docs.sparkSession, root)
    return versions.commit(docs.sparkSession, root, base, added=segment(docs, root, base, tokens, key, stems))


def segment(docs: DataFrame, root: str, base: Manifest, tokens: str = "tokens", key: str = "id", stems: bool = False) -> dict[str, versions.Parts]:
    """The written parts of a segment behind ``base``, to be committed, alone or with other tables."""
    spark, folder, number = docs.sparkSession, versions.new_folder(), base.version + 1
    counts = _by_document(docs, tokens, key).withColumn("segmento", F.lit(number))
    words = {"words": versions.write_parts(counts, root, f"{folder}/words", compression="zstd")}
    stored = versions.scan(spark, root, Manifest(1, words), "words", counts.schema)
    lengths = stored.select("id", F.greatest("dl", F.lit(0)).cast("long").alias("dl"))
    written = _write(spark, root, folder, number, _laid(stored, stems), lengths)
    if not stems:
        return words | written
    versions.drop(spark, root, f"{folder}/words")  # an index of stems has no words
    return written


def _rebalanced(postings: DataFrame) -> DataFrame:
    # a bucket with a frequent term is split into several files by AQE
    return postings.select("termino", "id", "tf", "dl", bucket_of().alias("cubeta")).hint("rebalance", "cubeta")


def _write(spark: SparkSession, root: str, folder: str, segment: int, laid: DataFrame, lengths: DataFrame) -> dict[str, versions.Parts]:
    number = F.lit(segment).alias("segmento")
    laid = laid.select("termino", "id", "tf", "dl", number, "cubeta")
    written = {"postings": versions.write_parts(laid.sortWithinPartitions("cubeta", "termino", "id"), root, f"{folder}/postings", "cubeta")}
    stored = versions.scan(spark, root, Manifest(1, written), "postings", POSTINGS)
    terms = stored.groupBy("termino").agg(F.count("*").alias("df")).select("termino", "df", number, bucket_of().alias("cubeta"))
    written["terms"] = versions.write_parts(terms.hint("rebalance", "cubeta").sortWithinPartitions("cubeta", "termino"), root, f"{folder}/terms", "cubeta")
    written["lengths"] = versions.write_parts(lengths.select("id", "dl", number), root, f"{folder}/lengths")
    return written


def remove(ids: DataFrame, root: str, key: str = "id") -> Manifest:
    """Let documents no longer count; their postings go with the next ``compact``."""
    spark = ids.sparkSession
    base, folder = versions.manifest(spark, root), versions.new_folder()
    gone = ids.select(F.col(key).cast("long").alias("id"), F.lit(base.version + 1).alias("segmento")).distinct()
    return versions.commit(spark, root, base, added={"removed": versions.write_parts(gone, root, f"{folder}/removed")})


def compact(spark: SparkSession, root: str) -> Manifest:
    """One segment of all that counts. Readers of earlier manifests keep their files until ``versions.vacuum``."""
    base, folder = versions.manifest(spark, root), versions.new_folder()
    index = Index(spark, root, base)
    whole = _write(spark, root, folder, base.version + 1, _rebalanced(index.postings()), index.lengths())
    whole["words"] = {}
    if index.has_words():
        words = index.words().withColumn("segmento", F.lit(base.version + 1))
        whole["words"] = versions.write_parts(words, root, f"{folder}/words")
    return versions.commit(spark, root, base, replaced={**whole, "removed": {}})


class Index:
    """The stored postings as one manifest has them."""

    def __init__(self, spark: SparkSession, root: str, now: Manifest | None = None):
        self.spark, self.root, self.now = spark, root, now or versions.manifest(spark, root)

    def _live(self, name: str, schema: T.StructType, parts: Sequence[str] | None = None) -> DataFrame:
        rows = versions.scan(self.spark, self.root, self.now, name, schema, parts)
        if not self.now.tables.get("removed"):
            return rows
        gone = versions.scan(self.spark, self.root, self.now, "removed", REMOVED).groupBy(F.col("id").alias("_id")).agg(F.max("segmento").alias("_until"))
        return rows.join(gone, (F.col("id") == F.col("_id")) & (F.col("segmento") < F.col("_until")), "left_anti")

    def postings(self, terms: Sequence[str] | None = None) -> DataFrame:
        """All postings, or those of some terms, read from their buckets alone."""
        if terms is None:
            return self._live("postings", POSTINGS)
        return self._live("postings", POSTINGS, [str(b) for b in sorted({bucket(t) for t in terms})]).filter(F.col("termino").isin(*terms))

    def lengths(self) -> DataFrame:
        return self._live("lengths", LENGTHS)

    def frequencies(self) -> DataFrame:
        """``termino, df``: added up over the segments, or counted again where documents were removed."""
        if self.now.tables.get("removed"):
            return self.postings().groupBy("termino").agg(F.count("*").alias("df"))
        return versions.scan(self.spark, self.root, self.now, "terms", TERMS).groupBy("termino").agg(F.sum("df").alias("df"))

    def scores(self, terms: Sequence[str], allowed: DataFrame | None = None, k1: float = 1.2, b: float = 0.75) -> DataFrame:
        """``id, puntaje``: BM25 of the documents with a term. ``allowed`` (``id``) restricts the documents and the statistics."""
        found, lengths = self.postings(list(dict.fromkeys(terms))), self.lengths()
        if allowed is not None:
            ids = allowed.select(F.col("id").cast("long").alias("id")).distinct()
            found, lengths = found.join(ids, "id", "left_semi"), lengths.join(ids, "id", "left_semi")
        times = F.create_map(*[F.lit(x) for t in dict.fromkeys(terms) for x in (t, list(terms).count(t))]) if terms else None
        if times is None:
            return self.spark.createDataFrame([], "id long, puntaje double")
        stats = lengths.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))
        df = found.groupBy("termino").agg(F.count("*").alias("df"))  # one row for each term of the query
        idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
        weights = df.crossJoin(stats).select("termino", (idf * F.element_at(times, F.col("termino"))).alias("_w"), "avgdl")
        part = F.col("_w") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.col("avgdl")))
        return found.join(F.broadcast(weights), "termino").groupBy("id").agg(F.sum(part).alias("puntaje"))

    def search(self, terms: Sequence[str], k: int, allowed: DataFrame | None = None) -> DataFrame:
        """The ``k`` best documents by BM25."""
        return top_k(self.scores(terms, allowed), k, F.round("puntaje", 9).desc(), F.col("id").asc())

    def has_words(self) -> bool:
        """Whether every segment has its words by document; those of stems have none."""
        segments = {name: len(self.now.tables.get(name, {}).get("", [])) for name in ("words", "lengths")}
        return segments["words"] == segments["lengths"]

    def words(self) -> DataFrame:
        return self._live("words", WORDS)

    def keywords(self, n: int) -> DataFrame:
        """The ``n`` terms of highest tf-idf of every document.

        The words of a document lie in one row, so those among the ``FREQUENT`` most frequent terms are weighed, and all but ``n`` of them dropped,
        before a term is shuffled. Only the seldom terms meet their frequencies in a shuffle, and the documents whose id is there twice, whose counts have to be
        added up first.
        """
        total = self.lengths().agg(F.count("*").alias("n")).scalar()
        df = self.frequencies()
        if self.has_words():
            frequent = F.broadcast(top_k(df, FREQUENT, F.col("df").desc(), F.col("termino").asc()))
            again = self.lengths().groupBy(F.col("id").alias("_id")).count().filter("count > 1").select("_id")
            once, same = self.words(), F.col("id").eqNullSafe(F.col("_id"))
            several = None if again.isEmpty() else self.postings().join(again, same, "left_semi").select("id", "termino", "tf")
            once = once if several is None else once.join(again, same, "left_anti")
            # whole documents are dealt over as many tasks as their files are worth, or the order within a task would grow with a split
            rows = once.select("id", "palabras").repartition(tasks_for(self.words()), "id").select("id", F.explode("palabras").alias("w")).select("id", "w.termino", "w.tf")
            seldom = rows.join(frequent, "termino", "left_anti")
            counts = rows.join(frequent, "termino").select("id", "termino", "tf", "df")
            met = (seldom if several is None else seldom.union(several.select(*seldom.columns))).join(df, "termino")
            counts = counts.union(met.select("id", "termino", "tf", "df"))
        else:
            counts = self.postings().join(df, "termino")
        weight = F.col("tf") * F.log((total + 1) / (F.col("df") + 1))
        weighed = counts.select("id", "termino", weight.alias("peso"))
        return top_k_per_group(weighed, ["id"], n, [F.round("peso", 9).desc(), F.col("termino").asc()])
