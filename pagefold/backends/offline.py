"""Deterministic stand-ins that need no model, no network and no key."""

from __future__ import annotations

import hashlib
import re

import numpy as np

from pagefold.backends.base import Corrector, Embedder, Generator

_WORD = re.compile(r"[^\W_]+")
# As ``splitting.sentences``: a run of terminals may be a sentence of its own.
_SENTENCE = re.compile(r".*?(?:[.!?。！？]+(?=\s)|$)", re.S)


class HashingEmbedder(Embedder):
    """Signed feature hashing of lower-cased words, scaled to unit length.

    Two hexadecimal digits of the word's MD5 give the position, the next one the sign, so any
    engine can reproduce the vectors.
    """

    name = "hashing-words"
    _CACHE_LIMIT = 200_000

    def __init__(self, dim: int = 64) -> None:
        if not 0 < dim <= 256:
            raise ValueError("dim must be between 1 and 256")
        self.dim = dim
        self._cache: dict[str, tuple[int, int]] = {}

    def load(self) -> None:
        self._cache = {}

    def _slot(self, word: str) -> tuple[int, int]:
        slot = self._cache.get(word)
        if slot is None:
            digest = hashlib.md5(word.encode("utf-8"), usedforsecurity=False).digest()
            slot = (digest[0] % self.dim, 1 if digest[1] < 128 else -1)
            if len(self._cache) >= self._CACHE_LIMIT:
                self._cache.clear()
            self._cache[word] = slot
        return slot

    def encode(self, texts: list[str]) -> np.ndarray:
        rows, slots, signs = [], [], []
        for row, text in enumerate(texts):
            for word in _WORD.findall(text.lower()):
                slot, sign = self._slot(word)
                rows.append(row)
                slots.append(slot)
                signs.append(sign)
        flat = np.asarray(rows, dtype=np.int64) * self.dim + np.asarray(slots, dtype=np.int64)
        sums = np.bincount(flat, weights=signs, minlength=len(texts) * self.dim)
        sums = sums.astype(np.float64).reshape(len(texts), self.dim)
        norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        return np.divide(sums, norms, out=np.zeros_like(sums), where=norms > 0).astype(np.float32)


class Unchanged(Corrector):
    """Leaves every text as it is."""

    name = "unchanged"

    def tokens(self, text: str) -> list[str]:
        return re.findall(r"\s*\S+|\s+$", text)

    def correct(self, texts: list[str]) -> list[str]:
        return texts


class RankedSentences(Generator):
    """Answers with the sentences of the context that matter most to the question, in their order, and where they stand.

    A sentence matters as far as its words are the question's and as sentences like it matter: the fixed
    point of ``pull`` times the first and the rest times the second, found by power iteration. Words
    weigh by their rarity among the context's sentences. ``[2]`` behind a sentence is the second passage.
    """

    name = "ranked-sentences"
    _CUT = _SENTENCE

    def __init__(self, sentences: int = 2, pull: float = 0.7, tolerance: float = 1e-10) -> None:
        self.sentences, self.pull, self.tolerance = sentences, pull, tolerance

    def answer(self, prompts: list[str], contexts: list[str]) -> list[str]:
        return [self._one(prompt, context) for prompt, context in zip(prompts, contexts, strict=True)]

    def _one(self, prompt: str, context: str) -> str:
        # The question stands behind the last such mark; a plain question is all there is.
        question = prompt.rsplit("Question:", 1)[-1].rsplit("Answer:", 1)[0]
        found = [
            (n, m[0].strip()) for n, part in enumerate(context.split("\n\n"), 1) for m in self._CUT.finditer(part) if m[0].strip()
        ]
        if not found:
            return ""
        weights = self.importance(question, [text for _, text in found])
        best = sorted(sorted(range(len(found)), key=lambda i: (-weights[i], i))[: self.sentences])
        return " ".join(f"{found[i][1]} [{found[i][0]}]" for i in best)

    def transitions(self, question: str, sentences: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where a step from a sentence leads (rows sum to one), and where the question points."""
        held = [dict.fromkeys(_WORD.findall(s.lower())) for s in sentences]
        names = {w: i for i, w in enumerate(dict.fromkeys(w for words in held for w in words))}
        marks = np.zeros((len(sentences), len(names)))
        for i, words in enumerate(held):
            marks[i, [names[w] for w in words]] = 1.0
        marks *= np.log1p(len(sentences) / np.maximum(marks.sum(axis=0), 1))
        asked = marks[:, [names[w] for w in dict.fromkeys(_WORD.findall(question.lower())) if w in names]].sum(axis=1)
        length = np.linalg.norm(marks, axis=1, keepdims=True)
        alike = np.divide(marks, length, out=np.zeros_like(marks), where=length > 0)
        alike = alike @ alike.T
        even = np.full(len(sentences), 1 / len(sentences))
        rows = alike.sum(axis=1, keepdims=True)
        step = np.where(rows > 0, np.divide(alike, rows, out=np.zeros_like(alike), where=rows > 0), even)
        return step, asked / asked.sum() if asked.sum() else even

    def importance(self, question: str, sentences: list[str]) -> np.ndarray:
        step, start = self.transitions(question, sentences)
        now = start
        while True:
            then = self.pull * start + (1 - self.pull) * (now @ step)
            if np.abs(then - now).sum() < self.tolerance:
                return then
            now = then


class FirstSentence(Generator):
    """Answers with the first sentence of the best-ranked context."""

    name = "first-sentence"

    def answer(self, prompts: list[str], contexts: list[str]) -> list[str]:
        found = (_SENTENCE.match(context.strip()) for context in contexts)
        return [m.group(0).strip() if m else "" for m in found]
