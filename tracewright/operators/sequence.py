"""Ordered lines: context that is carried along, counted, folded and paired.

Lines are scanned in blocks (see ``scans``), so a long document is many tasks'.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.text import norm_ws
from tracewright.operators.scans import BLOCK, Ahead, Carry, Total, context


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, line_no from 1, line) of each document, split at line ends."""
    split = F.posexplode(F.split(F.col(text_col), r"\r?\n"))
    return docs.select(id_col, split.alias("at", "line")).select(id_col, (F.col("at") + 1).alias("line_no"), "line")


def running_count(df: DataFrame, pattern: str, out: str, start: int = 1, line: str = "line", key: str = "doc_id", order: str = "line_no", size: int = BLOCK) -> DataFrame:
    """start and the matches of a pattern up to and including the line."""
    return context(df, {out: Total(F.regexp_count(F.col(line), F.lit(pattern)).cast("long"), start)}, key, order, size)


def carry_last(df: DataFrame, value: Column, out: str, back: int | None = None, inclusive: bool = True, key: str = "doc_id", order: str = "line_no", size: int = BLOCK) -> DataFrame:
    """The last value that isn't null: of all lines so far, or of the last ``back`` lines; inclusive of the line itself or not."""
    return context(df, {out: Carry(value, back, inclusive)}, key, order, size)


def following(most: int, stop: Column, skip: Column, line: str = "line") -> Ahead:
    """What ``folded`` needs of the lines after a line."""
    return Ahead(F.struct(F.coalesce(stop, F.lit(False)).alias("stop"), F.coalesce(skip, F.lit(False)).alias("skip"), F.col(line).alias("text")), most)


def folded(after: str, end: str, line: str = "line") -> Column:
    """The line and those after it as one text.

    A line where ``stop`` holds ends the text before it; one where ``skip`` holds is left out but counts; one that matches
    ``end`` is the last. The first line is always kept, whatever it ends with.
    """
    begin = F.struct(F.array(F.col(line)).alias("texts"), F.lit(False).alias("done"))
    return F.aggregate(
        F.col(after),
        begin,
        lambda acc, p: F.when(acc["done"] | p["stop"], F.struct(acc["texts"].alias("texts"), F.lit(True).alias("done")))
        .when(p["skip"], acc)
        .otherwise(F.struct(F.array_append(acc["texts"], p["text"]).alias("texts"), p["text"].rlike(end).alias("done"))),
        lambda acc: F.array_join(acc["texts"], " "),
    )


def fold_forward(df: DataFrame, out: str, most: int, stop: Column, skip: Column, end: str, line: str = "line", key: str = "doc_id", order: str = "line_no", size: int = BLOCK) -> DataFrame:
    """The line and up to ``most`` following ones as one text, as ``folded`` says."""
    marked = context(df, {"_folded": following(most, stop, skip, line)}, key, order, size)
    return marked.withColumn(out, folded("_folded", end, line)).drop("_folded")


def section_starts(df: DataFrame, marker: Column, title: Column, category: Column, title_back: int = 90, category_back: int = 120, key: str = "doc_id", order: str = "line_no", size: int = BLOCK) -> DataFrame:
    """Rows of the marker lines with the nearest title and category before them, each within its number of lines."""
    found = context(df, {"section_title": Carry(title, title_back, False), "section_category": Carry(category, category_back, False)}, key, order, size)
    return found.filter(marker)


def first_last(df: DataFrame, keys: list[str], order: list[Column], value: str) -> DataFrame:
    """(keys, first, last) of a value by an order; ties go by the value."""
    by = F.struct(*order, F.col(value))
    return df.groupBy(*keys).agg(F.min_by(value, by).alias("first"), F.max_by(value, by).alias("last"))


def boundary_pairs(df: DataFrame, key: str, order: list[Column], value: str, pairs: DataFrame) -> DataFrame:
    """For each pair (from_key, to_key): the last value of the one and the first of the other. Groups without rows give no pair."""
    ends = first_last(df, [key], order, value)
    left = ends.select(F.col(key).alias("from_key"), F.col("last").alias("from_value"))
    right = ends.select(F.col(key).alias("to_key"), F.col("first").alias("to_value"))
    return pairs.join(left, "from_key").join(right, "to_key")


def positions(df: DataFrame, array: str, out: str = "item", at: str = "position") -> DataFrame:
    """One row an element, with its place from 0; rows without elements vanish."""
    return df.select("*", F.posexplode(array).alias(at, out)).drop(array)


def first_or(array: Column | str, default: Column) -> Column:
    return F.coalesce(F.try_element_at(array if isinstance(array, Column) else F.col(array), F.lit(1)), default)


def normalised(df: DataFrame, line: str = "line", out: str = "norm") -> DataFrame:
    return df.withColumn(out, norm_ws(line))
