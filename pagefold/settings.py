"""Parameters of every stage, with the defaults the data model expects."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pagefold.functions.splitting import check_window


@dataclass(frozen=True)
class Settings:
    # Splitting.
    chunk_size: int = 500
    chunk_overlap: int = 100
    strategy: str = "semantic"
    # Image recognition.
    ocr_dpi: int = 300
    min_native_chars: int = 50
    # Optional stages.
    privacy: bool = False
    normalize: bool = False
    entity_threshold: float = 0.6
    label_threshold: float = 0.5
    keep_small_numbers: bool = False
    # Embedding and retrieval.
    embed_batch: int = 32
    simple_top_k: int = 3
    graded_top_k: int = 5
    # Cells that an approximate search looks into.
    probes: int = 32
    # Chunks that one stored record holds; a larger document is several records with one header.
    chunks_per_record: int = 1000
    # Physical bounds; they change the layout of the work, never the result. The number of
    # buckets is that of a new index; one that exists keeps its own.
    pages_per_block: int = 4096
    index_buckets: int = 64
    broadcast_bytes: int = 32 * 1024 * 1024

    def __post_init__(self) -> None:
        check_window(self.chunk_size, self.chunk_overlap)
        if self.strategy not in ("semantic", "recursive", "basic"):
            raise ValueError(f"unknown split strategy: {self.strategy}")

    def with_(self, **changes: object) -> Settings:
        return replace(self, **changes)
