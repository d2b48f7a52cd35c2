"""Document indexing: extract text, embed it, add documents with new ids."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmart.contracts import EMBEDDING_DIMS
from scholarmart.functions.scalar import embedding_text
from scholarmart.functions.text import html_text, html_title, search_tokens
from scholarmart.operators.ranking import global_row_number
from scholarmart.plans import postings
from scholarmart.sources import versions


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Title and readable text of raw pages."""
    return pages.withColumns({"titulo": html_title(html), "texto_completo": html_text(html)})


def embed(docs: DataFrame, title: str = "titulo", abstract: str = "abstract", dims: int = EMBEDDING_DIMS) -> DataFrame:
    """Add an ``embedding`` from hashed, weighted and normalised terms; no model is needed."""
    tokens = docs.withColumn("_tokens", search_tokens(embedding_text(F.coalesce(title, F.lit("")), F.coalesce(abstract, F.lit("")))))
    stages = [
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=dims),
        IDF(inputCol="_tf", outputCol="_idf"),
        Normalizer(inputCol="_idf", outputCol="_unit"),
    ]
    out = Pipeline(stages=stages).fit(tokens).transform(tokens)
    return out.select(*docs.columns, vector_to_array("_unit", "float32").alias("embedding"))


def embed_with(load_model: Callable[[], Callable[[list[str]], np.ndarray]], title: str = "titulo", abstract: str = "abstract") -> Column:
    """Embedding column by a model of one's own; it is loaded once per task and fed in batches."""

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for texts in batches:
            yield pd.Series(list(np.asarray(model(texts.tolist()), dtype=np.float32)))

    return encode(embedding_text(title, abstract))


def ingest(new: DataFrame, existing: DataFrame, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Rows to append to the documents and to the author bridge.

    Ids continue after the largest one, in the given unique order; the uploader is first author.
    """
    last = existing.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last"))
    numbered = global_row_number(new, order, "_n")
    docs = numbered.withColumn("id", F.col("_n") + last.scalar()).drop("_n")
    bridge = docs.select(F.col("id").alias("id_documento"), F.col("id_uploader").alias("id_usuario"), F.lit(1).cast("short").alias("orden"))
    return docs, bridge


def store(docs: DataFrame, bridge: DataFrame, root: str, *texts: str) -> versions.Manifest:
    """Documents with their search tokens, author rows and postings, in one commit: a document is stored and found, or neither.

    ``docs`` gets the column ``texto_busqueda`` from the named texts; both frames are read back from their files, so ids stay as given.
    """
    spark, folder = docs.sparkSession, versions.new_folder()
    base = versions.manifest(spark, root)
    whole = docs.withColumn("texto_busqueda", search_tokens(*texts))
    added: dict[str, versions.Parts] = {"documento": versions.write_parts(whole, root, f"{folder}/documento")}
    stored = versions.scan(spark, root, versions.Manifest(1, added), "documento", whole.schema)
    own = bridge.join(stored.select(F.col("id").alias("id_documento")), "id_documento", "left_semi").select(*bridge.columns)
    added["documento_autor"] = versions.write_parts(own, root, f"{folder}/documento_autor")
    return versions.commit(spark, root, base, added={**added, **postings.segment(stored, root, base, "texto_busqueda")})
