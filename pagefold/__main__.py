"""Command line: ``ingest``, ``embed``, ``upload`` and ``ask``."""

from __future__ import annotations

import argparse
import sys

from pagefold.backends import FirstSentence, HashingEmbedder
from pagefold.backends.optional import PypdfReader, TesseractReader, capabilities
from pagefold.operators.answering import answer_questions
from pagefold.operators.vector_index import VectorIndex
from pagefold.plans.indexing import embed_documents, upload_vectors
from pagefold.plans.ingest import ingest_folder
from pagefold.session import drop_staged, get_session
from pagefold.settings import Settings
from pagefold.sources.chunk_documents import chunk_rows, read_chunk_documents, read_vectors
from pagefold.sources.questions import DEMO_QUESTIONS, dialogue, questions_frame
from pagefold.sources.scanned import Recognition


def _recognition(settings: Settings) -> Recognition:
    have = capabilities()
    pdf = PypdfReader() if have["pypdf"] else None
    image = TesseractReader() if have["pytesseract"] and have["PIL"] else None
    return Recognition(pdf, image, dpi=settings.ocr_dpi, min_native_chars=settings.min_native_chars)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="pagefold")
    parser.add_argument("--master")
    commands = parser.add_subparsers(dest="command", required=True)
    ingest = commands.add_parser("ingest", help="files to chunk documents")
    ingest.add_argument("--raw", default="data/raw")
    ingest.add_argument("--chunks", default="data/chunks")
    ingest.add_argument("--chunk-size", type=int, default=Settings.chunk_size)
    ingest.add_argument("--chunk-overlap", type=int, default=Settings.chunk_overlap)
    ingest.add_argument("--strategy", default=Settings.strategy)
    ingest.add_argument("--privacy", action="store_true")
    ingest.add_argument("--hangul", action="store_true")
    embed = commands.add_parser("embed", help="chunk documents to vectors")
    upload = commands.add_parser("upload", help="vectors to the index")
    upload.add_argument("--reset", action="store_true")
    for command in (embed, upload):
        command.add_argument("--chunks", default="data/chunks")
        command.add_argument("--vectors", default="data/embeddings")
    ask = commands.add_parser("ask", help="answer questions from the index")
    ask.add_argument("--question", "-q")
    ask.add_argument("--interactive", "-i", action="store_true")
    ask.add_argument("--simple", action="store_true", help="no grading, fewer sources")
    for command in (upload, ask):
        command.add_argument("--index", default="data/index")
    return parser


def main(arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = get_session(master=args.master)
    embedder = HashingEmbedder()
    if args.command == "ingest":
        settings = Settings(
            chunk_size=args.chunk_size,
            chunk_overlap=args.chunk_overlap,
            strategy=args.strategy,
            privacy=args.privacy,
        )
        run = ingest_folder(
            spark, args.raw, args.chunks, settings, _recognition(settings), args.hangul
        )
        run.summary.show(truncate=False)
        drop_staged(spark)
        return
    if args.command == "ask":
        index = VectorIndex(spark, args.index)

        def answer(texts: tuple[str, ...]) -> None:
            frame = questions_frame(spark, texts)
            answers = answer_questions(index, frame, embedder, FirstSentence(), not args.simple)
            answers.show(vertical=True, truncate=500)

        if args.interactive:
            for question in dialogue(sys.stdin):
                answer((question,))
        else:
            answer((args.question,) if args.question else DEMO_QUESTIONS)
        return
    chunks = chunk_rows(read_chunk_documents(spark, args.chunks))
    if args.command == "embed":
        embed_documents(chunks, embedder, args.vectors).show()
    else:
        vectors = read_vectors(spark, args.vectors)
        upload_vectors(VectorIndex(spark, args.index), chunks, vectors, args.reset).show()


if __name__ == "__main__":
    main()
