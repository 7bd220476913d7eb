"""Chunks to vectors to the index."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pagefold.backends.base import Embedder
from pagefold.operators.embedding import embed_chunks, embeddable, embedding_summary, vector_table
from pagefold.operators.vector_index import (
    VectorIndex,
    index_entries,
    pair_vectors,
    upload_summary,
)
from pagefold.session import staged
from pagefold.settings import Settings
from pagefold.sinks.chunk_documents import write_vectors
from pagefold.sources.chunk_documents import read_vectors


def embed_documents(
    chunks: DataFrame, embedder: Embedder, output: str, settings: Settings | None = None
) -> DataFrame:
    """Write the vectors of all documents that have text; returns the summary."""
    embedded = embed_chunks(embeddable(chunks), embedder, settings)
    write_vectors(vector_table(embedded, embedder), output)
    return embedding_summary(chunks, read_vectors(chunks.sparkSession, output))


def upload_vectors(
    index: VectorIndex, chunks: DataFrame, vectors: DataFrame, reset: bool = False
) -> DataFrame:
    """Add the chunks that have vectors to the index; returns the summary."""
    if reset:
        index.reset()
    index.add(index_entries(pair_vectors(chunks, vectors)))
    return upload_summary(chunks, vectors, index.read())


def index_chunks(index: VectorIndex, chunks: DataFrame, embedder: Embedder) -> None:
    """Embed and add in one flow, without storing the vectors on their own.

    The chunks are looked at twice (which documents have text, then their vectors), so they
    are written once instead of being parsed and split twice, and deleted when they are indexed.
    """
    with staged(chunks, "chunks") as stored:
        embedded = embed_chunks(embeddable(stored), embedder, index.settings)
        index.add(index_entries(embedded))
