"""Backends on top of well-known libraries, available only where those are installed."""

from __future__ import annotations

import importlib.util
import io

import numpy as np

from pagefold.backends.base import (
    Corrector,
    Embedder,
    EntityRecognizer,
    Generator,
    ImageReader,
    PdfReader,
)
from pagefold.functions.spans import DEFAULT_LABELS


def capabilities() -> dict[str, bool]:
    """Which optional libraries can be imported."""
    names = (
        "pypdf",
        "pdf2image",
        "pytesseract",
        "PIL",
        "sentence_transformers",
        "transformers",
        "gliner",
        "langchain_groq",
    )
    return {name: importlib.util.find_spec(name) is not None for name in names}


class PypdfReader(PdfReader):
    name = "pypdf"

    def page_texts(self, content: bytes) -> list[str]:
        import pypdf

        return [page.extract_text() or "" for page in pypdf.PdfReader(io.BytesIO(content)).pages]

    def page_count(self, content: bytes) -> int:
        import pypdf

        return len(pypdf.PdfReader(io.BytesIO(content)).pages)

    def page_image(self, content: bytes, page: int, dpi: int) -> bytes:
        import pdf2image

        image = pdf2image.convert_from_bytes(content, dpi=dpi, first_page=page, last_page=page)[0]
        out = io.BytesIO()
        image.save(out, "PNG")
        return out.getvalue()


class TesseractReader(ImageReader):
    """Grey scale, contrast, sharpness and a hard threshold before recognition."""

    name = "tesseract"
    # Languages, engine options and image settings.
    LANGUAGES, OPTIONS = "kor+eng", "--oem 1 --psm 6"
    CONTRAST, SHARPNESS, THRESHOLD = 2.5, 2.0, 128

    def read(self, image: bytes) -> str:
        import pytesseract
        from PIL import Image, ImageEnhance

        grey = Image.open(io.BytesIO(image)).convert("L")
        strong = ImageEnhance.Contrast(grey).enhance(self.CONTRAST)
        sharp = ImageEnhance.Sharpness(strong).enhance(self.SHARPNESS)
        table = [255 if level > self.THRESHOLD else 0 for level in range(256)]
        return pytesseract.image_to_string(
            sharp.point(table), lang=self.LANGUAGES, config=self.OPTIONS
        )


class SentenceEmbedder(Embedder):
    """A sentence-transformers model, loaded once per worker."""

    def __init__(self, name: str = "jhgan/ko-sroberta-multitask", dim: int = 768) -> None:
        self.name, self.dim = name, dim
        self._model = None

    def load(self) -> None:
        if self._model is None:
            from sentence_transformers import SentenceTransformer

            self._model = SentenceTransformer(self.name)

    def encode(self, texts: list[str]) -> np.ndarray:
        return self._model.encode(texts, batch_size=len(texts), convert_to_numpy=True)


class TokenClassifier(EntityRecognizer):
    """A transformers token-classification model; the first candidate that loads is used."""

    name = "token-classification"
    # Models tried in order.
    CANDIDATES = (
        "soddokayo/klue-roberta-large-klue-ner",
        "vitus9988/klue-roberta-large-ner-identified",
        "Leo97/KoELECTRA-small-v3-modu-ner",
    )

    def __init__(self, model: str | None = None) -> None:
        self.models = ((model,) if model else ()) + self.CANDIDATES
        self._run = None

    def load(self) -> None:
        from transformers import pipeline

        for model in self.models if self._run is None else ():
            try:
                self._run = pipeline("ner", model=model, aggregation_strategy="simple")
                return
            except Exception:
                continue

    def recognize(self, texts: list[str]) -> list[list[tuple[int, int, str, str, float]]]:
        if self._run is None:
            return [[] for _ in texts]
        return [
            [(e["start"], e["end"], e["word"], e["entity_group"], float(e["score"])) for e in found]
            for found in self._run(texts)
        ]


class LabelledRecognizer(EntityRecognizer):
    """An open-vocabulary recogniser asked for a list of labels."""

    def __init__(self, model: str = "taeminlee/gliner_ko", labels: tuple[str, ...] = DEFAULT_LABELS) -> None:
        self.name, self.labels = model, labels
        self._model = None

    def load(self) -> None:
        if self._model is None:
            from gliner import GLiNER

            self._model = GLiNER.from_pretrained(self.name)

    def recognize(self, texts: list[str]) -> list[list[tuple[int, int, str, str, float]]]:
        # Everything is reported; the threshold is applied by the span functions.
        return [
            [
                (e["start"], e["end"], e["text"], e["label"], float(e["score"]))
                for e in self._model.predict_entities(text, list(self.labels), threshold=0.0)
            ]
            for text in texts
        ]


class SpellingCorrector(Corrector):
    """A sequence-to-sequence model, decoded greedily."""

    # The model, its instruction and its generation limits.
    # What stands before every text; a model trained with another instruction takes its own.
    PROMPT = "맞춤법과 띄어쓰기를 바로잡고 <KEEP_0> 같은 표시와 숫자는 그대로 두시오: "
    LIMITS = {"max_length": 512, "num_beams": 1, "no_repeat_ngram_size": 2}

    def __init__(self, model: str = "j5ng/et5-typos-corrector", prompt: str = PROMPT) -> None:
        self.name = model
        self.prompt = prompt
        self._tokenizer = self._model = None

    def load(self) -> None:
        if self._model is None:
            from transformers import T5ForConditionalGeneration, T5TokenizerFast

            self._tokenizer = T5TokenizerFast.from_pretrained(self.name)
            self._model = T5ForConditionalGeneration.from_pretrained(self.name).eval()

    def tokens(self, text: str) -> list[str]:
        # Offsets keep the exact characters, so that the tokens join to the text.
        spans = self._tokenizer(
            text, return_offsets_mapping=True, add_special_tokens=False
        )["offset_mapping"]
        cuts = [0, *(start for start, _ in spans[1:]), len(text)]
        return [text[a:b] for a, b in zip(cuts, cuts[1:])]

    def correct(self, texts: list[str]) -> list[str]:
        inputs = self._tokenizer(
            [self.prompt + t for t in texts],
            return_tensors="pt", max_length=512, truncation=True, padding=True,
        )
        outputs = self._model.generate(**inputs, **self.LIMITS)
        return [t.strip() for t in self._tokenizer.batch_decode(outputs, skip_special_tokens=True)]


class ChatGenerator(Generator):
    """A hosted chat model; its key is read from the environment of the executors."""

    def __init__(self, model: str = "llama-3.3-70b-versatile") -> None:
        self.name = model
        self._chat = None

    def load(self) -> None:
        if self._chat is None:
            from langchain_groq import ChatGroq

            self._chat = ChatGroq(model=self.name, temperature=0)

    def answer(self, prompts: list[str], contexts: list[str]) -> list[str]:
        return [self._chat.invoke(prompt).content for prompt in prompts]
