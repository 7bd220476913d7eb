"""What a model has to offer to take part."""

from __future__ import annotations

from abc import ABC, abstractmethod

import numpy as np


class Backend(ABC):
    name = "backend"

    def load(self) -> None:
        """Prepare the model in the worker; called once per process."""


class Embedder(Backend):
    dim: int

    @abstractmethod
    def encode(self, texts: list[str]) -> np.ndarray:
        """One row of ``dim`` floats per text."""


class Corrector(Backend):
    @abstractmethod
    def tokens(self, text: str) -> list[str]:
        """Token texts whose concatenation is the text."""

    @abstractmethod
    def correct(self, texts: list[str]) -> list[str]:
        """Rewritten texts; mask tokens in them must be left alone."""


class SentenceSplitter(Backend):
    @abstractmethod
    def split(self, texts: list[str], languages: list[str]) -> list[list[str]]:
        """Sentences of every text, stripped and without blanks."""


class LanguageDetector(Backend):
    @abstractmethod
    def detect(self, texts: list[str]) -> list[str]:
        """Language code of every text."""


class EntityRecognizer(Backend):
    @abstractmethod
    def recognize(self, texts: list[str]) -> list[list[tuple[int, int, str, str, float]]]:
        """Per text: ``(start, end, text, label, score)`` in code points."""


class Generator(Backend):
    @abstractmethod
    def answer(self, prompts: list[str], contexts: list[str]) -> list[str]:
        """One answer per prompt."""


class PdfReader(Backend):
    @abstractmethod
    def page_texts(self, content: bytes) -> list[str]:
        """Text layer, one entry per page."""

    @abstractmethod
    def page_count(self, content: bytes) -> int:
        """Number of pages."""

    @abstractmethod
    def page_image(self, content: bytes, page: int, dpi: int) -> bytes:
        """One page rendered as an image; pages count from 1."""


class ImageReader(Backend):
    @abstractmethod
    def read(self, image: bytes) -> str:
        """Text recognised in one image."""


class DocumentParser(Backend):
    @abstractmethod
    def parse(self, content: bytes, suffix: str) -> list[str]:
        """Text per page of a scanned document; empty when it cannot be read."""
