"""PDF and image files: text layer first, recognition only where it is missing."""

from __future__ import annotations

from dataclasses import dataclass

from pagefold.backends.base import DocumentParser, ImageReader, PdfReader
from pagefold.sources.formats import Page, Unsupported


@dataclass(frozen=True)
class Recognition:
    """Backends for files without usable text; a missing one makes its step unavailable."""

    pdf: PdfReader | None = None
    image: ImageReader | None = None
    parser: DocumentParser | None = None
    dpi: int = 300
    min_native_chars: int = 50

    def load(self) -> None:
        for backend in (self.pdf, self.image, self.parser):
            if backend is not None:
                backend.load()

    def read_pdf(self, content: bytes) -> list[Page]:
        """The first page decides: with enough text each page keeps its own or is recognised
        alone; otherwise the whole file goes to the document parser, then to recognition."""
        try:
            texts = [t.strip() for t in self._pdf().page_texts(content)]
            if len(texts[0]) >= self.min_native_chars:
                return [
                    ([text], "pdf_text")
                    if len(text) >= self.min_native_chars
                    else ([self._page(content, number)], "pdf_ocr")
                    for number, text in enumerate(texts, 1)
                ]
            parsed = self.parse(content, "pdf")
            if parsed:
                return parsed
        except Unsupported:
            raise
        except Exception:
            pass  # an unreadable text layer is recognised from the images instead
        return self._all_pages(content)

    def parse(self, content: bytes, suffix: str) -> list[Page]:
        if self.parser is None:
            return []
        try:
            return [([text.strip()], "vlm_ocr") for text in self.parser.parse(content, suffix)]
        except Exception:
            return []

    def read_image(self, content: bytes) -> list[Page]:
        return [([self._image().read(content).strip()], "image_ocr")]

    def _pdf(self) -> PdfReader:
        if self.pdf is None:
            raise Unsupported("no PDF reader")
        return self.pdf

    def _image(self) -> ImageReader:
        if self.image is None:
            raise Unsupported("no image reader")
        return self.image

    def _page(self, content: bytes, number: int) -> str:
        try:
            return self._image().read(self._pdf().page_image(content, number, self.dpi)).strip()
        except Exception:
            return ""

    def _all_pages(self, content: bytes) -> list[Page]:
        reader, pages = self._image(), []
        for number in range(1, self._pdf().page_count(content) + 1):
            try:
                image = self._pdf().page_image(content, number, self.dpi)
                pages.append(([reader.read(image).strip()], "pdf_ocr"))
            except Exception:
                pages.append(([""], "ocr_failed"))
        return pages
