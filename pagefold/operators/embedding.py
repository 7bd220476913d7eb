"""Vectors for chunks and questions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagefold.backends.base import Embedder
from pagefold.functions.text import is_blank, strip
from pagefold.settings import Settings


def embed_column(text: Column, embedder: Embedder, batch: int = 32) -> Column:
    """Vector per text. Blank texts reach the worker as null and come back null.

    Arrow in, Arrow out: the vectors are handed over as one flat buffer. The model sees
    ``batch`` texts at a time, however large the Arrow batch is.
    """

    @F.arrow_udf("array<float>")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        embedder.load()
        for column in columns:
            values = column.to_pylist()
            rows = [i for i, value in enumerate(values) if value is not None]
            out = np.zeros((len(values), embedder.dim), dtype=np.float32)
            for at in range(0, len(rows), batch):
                some = rows[at : at + batch]
                out[some] = embedder.encode([values[i] for i in some])
            sizes = np.zeros(len(values) + 1, dtype=np.int32)
            sizes[1:][rows] = embedder.dim
            offsets = np.cumsum(sizes, dtype=np.int32)
            vectors = pa.ListArray.from_arrays(pa.array(offsets), pa.array(out[rows].ravel()))
            mask = pa.array([value is None for value in values])
            yield pa.compute.if_else(mask, pa.scalar(None, vectors.type), vectors)

    return run(text)


def embed_chunks(
    chunks: DataFrame, embedder: Embedder, settings: Settings | None = None
) -> DataFrame:
    """Add ``embedding``; blank chunks get the zero vector without a call to the model."""
    settings = settings or Settings()
    text = F.col("text")
    zero = F.array_repeat(F.lit(0.0).cast("float"), embedder.dim)
    wanted = F.when(~is_blank(text), strip(text))
    return chunks.withColumn(
        "_vector", embed_column(wanted, embedder, settings.embed_batch)
    ).withColumn("embedding", F.coalesce("_vector", zero)).drop("_vector")


def embeddable(chunks: DataFrame) -> DataFrame:
    """Chunks of the documents that have at least one chunk with text.

    The documents without any are few and small, so they are what is looked up.
    """
    empty = (
        chunks.groupBy("source_file")
        .agg(F.count_if(~is_blank(F.col("text"))).alias("filled"))
        .where("filled = 0")
        .select("source_file")
    )
    return chunks.join(empty, "source_file", "left_anti")


def vector_table(embedded: DataFrame, embedder: Embedder) -> DataFrame:
    """What is stored beside a vector: position, size, metadata and the model, but no text."""
    metadata = F.col("metadata") if "metadata" in embedded.columns else F.lit(None)
    return embedded.select(
        "source_file",
        F.coalesce("chunk_id", F.lit(0)).alias("chunk_id"),
        F.coalesce("page_num", F.lit(1)).alias("page_num"),
        F.coalesce("char_count", F.lit(0)).alias("char_count"),
        F.col("embedding").isNotNull().alias("has_embedding"),
        "embedding",
        F.coalesce(F.size("embedding"), F.lit(0)).alias("embedding_dim"),
        F.lit(embedder.name).alias("model_name"),
        metadata.cast("map<string,string>").alias("metadata"),
    )


def embedding_summary(chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    """One row: documents with vectors, documents without, vectors."""
    every = chunks.groupBy("source_file").agg(F.count("*").alias("chunks"))
    done = vectors.groupBy("source_file").agg(F.count("*").alias("vectors"))
    return every.join(done, "source_file", "left").agg(
        F.count_if(F.col("vectors").isNotNull()).alias("succeeded"),
        F.count_if(F.col("vectors").isNull()).alias("failed"),
        F.coalesce(F.sum("vectors"), F.lit(0)).alias("vectors"),
    )
