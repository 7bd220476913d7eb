"""Line structure: headings, table rows and list items."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagefold.functions.cleaning import stripped_lines
from pagefold.functions.text import UNICODE_SPACE, let

MAX_HEADING_CHARS = 100
_SP = f"(?U:{UNICODE_SPACE[4:]})"
_SPS = f"(?U:{UNICODE_SPACE[4:]}*)"
# Line shapes.
NUMBERED_HEADING = rf"^[\p{{Nd}}가-힣]+[.)]{_SPS}[가-힣]"
BRACKET_HEADING = r"(?s)^\[.+\]$"
LIST_ITEM = rf"^{_SPS}(?:[-*•]|\p{{Nd}}+[.)]){_SP}"
TABLE_MARKS = ("\t", "|", "│")


def is_heading(line: Column) -> Column:
    shaped = line.rlike(NUMBERED_HEADING) | line.rlike(BRACKET_HEADING)
    return (F.length(line) < MAX_HEADING_CHARS) & shaped


def is_table_row(line: Column) -> Column:
    hit = F.contains(line, F.lit(TABLE_MARKS[0]))
    for mark in TABLE_MARKS[1:]:
        hit = hit | F.contains(line, F.lit(mark))
    return hit


def is_list_item(line: Column) -> Column:
    return line.rlike(LIST_ITEM)


KINDS = {"heading": is_heading, "table": is_table_row, "list": is_list_item}


def structure_items(text: Column) -> Column:
    """``array<struct<type,line,text>>`` by line, then heading, table, list; kinds may overlap.

    ``line`` counts every line from 0, blank ones included.
    """

    def of_line(line: Column, position: Column) -> Column:
        return F.array_compact(
            F.array(
                *[
                    F.when(
                        test(line),
                        F.struct(
                            F.lit(kind).alias("type"),
                            position.alias("line"),
                            line.alias("text"),
                        ),
                    )
                    for kind, test in KINDS.items()
                ]
            )
        )

    return F.flatten(F.transform(stripped_lines(text), of_line))


def structure_types(text: Column) -> Column:
    """Kinds that occur, in alphabetical order; null when there is none."""

    def kinds(lines: Column) -> Column:
        return F.array_compact(
            F.array(*[F.when(F.exists(lines, KINDS[kind]), F.lit(kind)) for kind in sorted(KINDS)])
        )

    found = let(stripped_lines(text), kinds)
    return let(found, lambda some: F.when(F.size(some) > 0, some))
