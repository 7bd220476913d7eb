"""Model backends: small interfaces with offline stand-ins.

A backend is pickled to the Python workers and works on one Arrow batch at a time. ``load``
is called once per worker process; costly state belongs there and not in the constructor.
"""

from pagefold.backends.base import (
    Corrector,
    DocumentParser,
    Embedder,
    EntityRecognizer,
    Generator,
    ImageReader,
    LanguageDetector,
    PdfReader,
    SentenceSplitter,
)
from pagefold.backends.offline import FirstSentence, HashingEmbedder, RankedSentences, Unchanged

__all__ = [
    "Corrector",
    "DocumentParser",
    "Embedder",
    "EntityRecognizer",
    "FirstSentence",
    "Generator",
    "HashingEmbedder",
    "ImageReader",
    "LanguageDetector",
    "PdfReader",
    "RankedSentences",
    "SentenceSplitter",
    "Unchanged",
]
