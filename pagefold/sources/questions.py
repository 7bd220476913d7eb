"""Question input."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession

# Asked when no question is given.
DEMO_QUESTIONS = (
    "이 문서들은 무엇에 관한 것인가요?",
    "누가 언제까지 무엇을 해야 하나요?",
    "Which decisions do the documents record?",
)
# Words that end a dialogue.
STOP_WORDS = ("exit", "quit", "q")


def questions_frame(spark: SparkSession, questions: Iterable[str] = DEMO_QUESTIONS) -> DataFrame:
    rows = [(i, question) for i, question in enumerate(questions)]
    return spark.createDataFrame(rows, "question_id long, question string")


def dialogue(lines: Iterable[str]) -> Iterator[str]:
    """Questions typed so far: blanks are skipped and a stop word ends the input."""
    for line in lines:
        question = line.strip()
        if question.lower() in STOP_WORDS:
            return
        if question:
            yield question
