"""Grouping of spelling variants: vocabulary acceptors composed with a one-edit transducer, part by part."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagefold.llm.acceptor import common_start, one_edit_pairs
from pagefold.llm.common import packed
from pagefold.session import spread, stage_table

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ERRORS_IN = 97
LEAST_LETTERS = 5
LEAST_TIMES = 3
RATIO = 2
# Words of a part, above which it is split by one more letter, as long as its pairs allow.
PART = 8192


def vocabulary(docs: DataFrame, errors_in: int = ERRORS_IN, letters: int = LEAST_LETTERS, times: int = LEAST_TIMES) -> DataFrame:
    """``word, n`` of all words with enough letters and occurrences, stored.

    One run in ``errors_in``, by the checksum of its row's id and itself, loses a letter first.
    """
    rows = packed(docs).select(
        F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")).alias("id"), F.col("row.text").alias("text")
    )
    runs = spread(rows).select("id", F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    mark = F.crc32(F.concat("id", F.lit(":"), F.col("run")))
    hit = runs.withColumn("mark", mark)
    place = (F.col("mark") % F.length("run")).cast("int")
    short = F.concat(F.substring(F.col("run"), F.lit(1), place), F.substring(F.col("run"), place + 2, F.length("run")))
    words = hit.select(F.when(F.col("mark") % errors_in == 0, short).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= letters).groupBy("word").agg(F.count("*").alias("n"))
    return stage_table(counted.where(F.col("n") >= times), "vocabulary")


def parts(words: DataFrame, part: int = PART) -> DataFrame:
    """``backwards, length, start, read, n``: every word in the parts that hold its pairs.

    Two words at one edit, the shorter of ``length`` letters, agree in their first or in their last
    ``half`` letters, (length - 1) / 2 rounded up. So a part is reached from the initial state by
    the first letters of words read forwards or backwards, and holds words of two lengths. It is split by
    a further letter while it holds more than ``part`` words and fewer than ``half`` letters lead to it.
    """
    size = F.length("word")
    lengths = words.select("word", "n", F.explode(F.array(size - 1, size)).alias("length"))
    least = words.select(size.alias("s")).agg(F.min("s")).first()[0] or 0
    ways = F.explode(F.array(F.struct(F.lit(False).alias("b"), F.col("word").alias("read")),
                             F.struct(F.lit(True).alias("b"), F.reverse("word").alias("read"))))
    open_ = lengths.where(F.col("length") >= least).select("length", "n", ways.alias("way"))
    open_ = open_.select(F.col("way.b").alias("backwards"), "length", "way.read", "n")
    half = F.ceil((F.col("length") - 1) / 2)
    kept, depth = [], 1
    while True:
        key = ["backwards", "length", "start"]
        cells = open_.withColumn("start", F.substring("read", 1, depth))
        full = cells.where(half > depth).groupBy(*key).agg(F.count("*").alias("held")).where(F.col("held") > part)
        full = stage_table(full.select(*key), "full")
        if full.isEmpty():
            return reduce(DataFrame.unionByName, [*kept, cells])
        kept.append(cells.join(full, key, "left_anti"))
        open_ = stage_table(cells.join(full, key, "left_semi").drop("start"), "open")
        depth += 1


def near_words(words: DataFrame, part: int = PART) -> DataFrame:
    """``word, n, n_near, best``: every word, its near words' number and ``(n, word)`` of the most frequent of them.

    A word's pairs are summed up where they are found, so at most one row per word leaves a part.
    """

    def pairs(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        backwards, length = key[0].as_py(), key[1].as_py()
        times = dict(zip(rows["read"].to_pylist(), rows["n"].to_pylist(), strict=True))
        half = length // 2  # of length - 1, rounded up
        held: dict[str, list[int | str]] = {}
        # Read backwards, a pair counts only if it does not agree in its first half too.
        least = length - half if backwards else half
        for x, y in one_edit_pairs(sorted(times), length, least):
            if backwards and common_start(x[::-1], y[::-1]) >= half:
                continue
            for word, near in ((x, y), (y, x)):
                n, shown = times[near], near[::-1] if backwards else near
                entry = held.get(word)
                if entry is None:
                    held[word] = [1, n, shown]
                else:
                    entry[0] += 1
                    if (-n, shown) < (-entry[1], entry[2]):
                        entry[1:] = [n, shown]
        found = [(w[::-1] if backwards else w, times[w], *e) for w, e in held.items()]
        columns = list(zip(*found, strict=True)) or [[]] * 5
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        names = ["word", "n", "n_near", "best_n", "best"]
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    met = parts(words, part).groupBy("backwards", "length", "start").applyInArrow(
        pairs, "word string, n long, n_near long, best_n long, best string"
    )
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"),
                        F.lit(None).cast("string").alias("best"))
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))))
    return met.unionByName(none).groupBy("word").agg(F.first("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))


def _rooted(forms: DataFrame) -> DataFrame:
    """``word, root`` of every word with a form: each round doubles how far a word has followed the forms."""
    known = stage_table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        there = known.select(F.col("word").alias("of"), F.col("root").alias("further"))
        moved = stage_table(known.join(there, F.col("root") == F.col("of"), "left").drop("of"), "roots")
        known = moved.select("word", F.coalesce("further", "root").alias("root"))
        if moved.where("further IS NOT NULL").isEmpty():
            return known


def variants(words: DataFrame, ratio: int = RATIO, part: int = PART) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a table of distinct words and their counts."""
    form = F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best"))
    near = near_words(words, part).withColumn("form", form)
    near = stage_table(near.select("word", "n", "n_near", F.col("form.word").alias("form"), (-F.col("form.less")).alias("form_n")), "near")
    roots = _rooted(near.where("form IS NOT NULL")).withColumnRenamed("word", "of")
    root: Column = F.coalesce("root", "word").alias("root")
    return near.join(roots, F.col("word") == F.col("of"), "left").select("word", "form", root, "n", "n_near", "form_n")


def variant_report(docs: DataFrame) -> DataFrame:
    """One row per word of the vocabulary: ``word, form, root, n, n_near, form_n``.

    Null and empty texts have no words; a null id stands as an empty one in a run's checksum;
    repeated rows count as often as they are there; ties of the most frequent near word go by code
    point; an empty table gives no rows. Columns other than ``doc_id`` and ``text`` are not read.
    """
    return variants(vocabulary(docs))
