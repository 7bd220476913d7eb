"""From retrieved entries to answers: sources, grading, context, prompt, generation."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagefold.backends.base import Embedder, Generator
from pagefold.functions.text import is_blank, preview
from pagefold.operators.embedding import embed_column
from pagefold.operators.quantised_index import QuantisedIndex
from pagefold.operators.retrieval import top_k_with_bound
from pagefold.operators.vector_index import VectorIndex, bucket_of
from pagefold.session import stage_table
from pagefold.settings import Settings

# The answer when nothing usable was found.
REFUSAL = "I don't have enough information to answer this question."
CONTEXT_SEPARATOR = "\n\n"


def embed_questions(
    questions: DataFrame, embedder: Embedder, settings: Settings | None = None
) -> DataFrame:
    """Add the vector of every question, from the model the index was built with."""
    settings = settings or Settings()
    return questions.withColumn(
        "embedding", embed_column(F.col("question"), embedder, settings.embed_batch)
    )


def retrieve(
    index: DataFrame | VectorIndex,
    questions: DataFrame,
    k: int,
    settings: Settings | None = None,
    nearest: QuantisedIndex | None = None,
) -> DataFrame:
    """Nearest entries of every question with their text and position, exact or, with ``nearest``, approximate.

    The ranking reads ids and vectors only. The texts of the few entries that remain are
    fetched by joining on the id. In a stored index the folder follows from the id and the
    index's own number of buckets, so only the folders of those entries are read.
    """
    settings = settings or Settings()
    layout = index.layout() if isinstance(index, VectorIndex) else None
    table = index.read() if isinstance(index, VectorIndex) else index
    if nearest is None:
        ranked, small = top_k_with_bound(table, questions, k, settings)
    else:
        ranked, small = stage_table(nearest.search(questions, k, settings.probes), "ranked"), False
    keys = ["id"]
    if layout is not None:
        keys.append("source_bucket")
        document = F.regexp_replace("id", "_[0-9]+$", "")
        ranked = ranked.withColumn("source_bucket", bucket_of(document, layout.buckets))
    entries = table.select(*keys, "document", "source_file", "page_num")
    found = entries.join(F.broadcast(ranked) if small else ranked, keys)
    return found.drop("source_bucket")


def source_struct() -> Column:
    return F.struct(
        "rank",
        "id",
        "source_file",
        "page_num",
        preview(F.col("document")).alias("preview"),
        "distance",
    )


def assemble(found: DataFrame, graded: bool) -> DataFrame:
    """One row per question: sources and context in rank order, and the grade.

    Grading drops blank documents and passes when any is left; when none is, the sources stay
    as they were retrieved. At most ``k`` rows meet per question.
    """
    entry = F.struct("rank", "document", source_struct().alias("source"))
    grouped = found.groupBy("question_id").agg(
        F.array_sort(F.collect_list(entry)).alias("every")
    ).withColumn("good", F.filter("every", lambda e: ~is_blank(e["document"])))
    passed = F.size("good") > 0
    chosen = F.when(passed, F.col("good")).otherwise(F.col("every")) if graded else F.col("every")
    return (
        grouped.withColumn("grade_passed", passed if graded else F.lit(True))
        .withColumn("chosen", chosen)
        .select(
            "question_id",
            "grade_passed",
            F.array_join(
                F.transform("chosen", lambda e: e["document"]), CONTEXT_SEPARATOR
            ).alias("context"),
            F.transform("chosen", lambda e: e["source"]).alias("sources"),
        )
    )


def prompt(question: Column, context: Column) -> Column:
    """Instructions to the model: stay within the context, else refuse; answer in Korean."""
    return F.concat(
        F.lit("Use only the context below to answer the question, clearly and briefly.\n"),
        F.lit(f'If the context does not hold the answer, reply "{REFUSAL}"\n'),
        F.lit("Write the answer in Korean.\n\nContext:\n"),
        context,
        F.lit("\n\nQuestion: "),
        question,
        F.lit("\n\nAnswer:"),
    )


def generate_column(question: Column, context: Column, generator: Generator) -> Column:
    """Answer and error per question; an error is reported instead of failing the task.

    A null question never reaches the model.
    """

    @F.pandas_udf("struct<answer:string,error:string>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        generator.load()
        for prompts, contexts in batches:
            answers, errors = [], []
            for p, c in zip(prompts, contexts):
                if p is None:
                    answers.append(None)
                    errors.append(None)
                    continue
                try:
                    answers.append(generator.answer([p], [c])[0])
                    errors.append(None)
                except Exception as error:
                    answers.append(f"Error: {error}")
                    errors.append(str(error))
            yield pd.DataFrame({"answer": answers, "error": errors})

    return run(prompt(question, context), context)


def answer_questions(
    index: DataFrame | VectorIndex,
    questions: DataFrame,
    embedder: Embedder,
    generator: Generator,
    graded: bool = True,
    settings: Settings | None = None,
    nearest: QuantisedIndex | None = None,
) -> DataFrame:
    """``question_id, question, context, grade_passed, answer, sources``.

    Only questions that pass the grade reach the generator; the others get the fixed refusal.
    A failed generation reports its error and no sources. Calls to a remote model are side
    effects: write the result once and read it from there.
    """
    settings = settings or Settings()
    k = settings.graded_top_k if graded else settings.simple_top_k
    asked = embed_questions(questions, embedder, settings)
    graded_rows = assemble(retrieve(index, asked, k, settings, nearest), graded)
    rows = questions.join(graded_rows, "question_id", "left").withColumn(
        "grade_passed", F.coalesce("grade_passed", F.lit(not graded))
    ).withColumn("context", F.coalesce("context", F.lit("")))
    asked_rows = rows.withColumn(
        "generated",
        generate_column(F.when(F.col("grade_passed"), F.col("question")), F.col("context"), generator),
    )
    failed = F.col("generated.error").isNotNull()
    return asked_rows.select(
        "question_id",
        "question",
        "context",
        "grade_passed",
        F.coalesce("generated.answer", F.lit(REFUSAL)).alias("answer"),
        F.when(~failed, F.col("sources")).alias("sources"),
    )
