"""Substring search of many queries over an index, instead of a scan a query.

The index holds, for each gram of up to three characters and each block of rows, the ids of the rows that hold it. A query's
rarest grams are looked up; in a block where one of them is missing nothing is read further, in others the lists are
intersected. What is left is verified against the texts, so the result is that of a scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.text import fold_query
from tracewright.storage import written

#: Rows of a block, about, which bounds a list; grams of a query that are looked up.
BLOCK_ROWS, RAREST = 4096, 4


@dataclass(frozen=True)
class Index:
    """texts (id, text), postings (gram, block, ids) and counts (gram, n), all written."""

    texts: DataFrame
    postings: DataFrame
    counts: DataFrame


def grams(text: Column) -> Column:
    """Distinct runs of one, two and three characters, and the empty one; a null text has none."""
    # an array of characters, since a substring by its place is looked for from the beginning
    chars = F.split(text, "")
    n = F.char_length(text)
    runs = lambda k: lambda i: F.concat(*[F.get(chars, i + j) for j in range(k)])
    each = [F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), runs(k))).otherwise(F.array()) for k in (1, 2, 3)]
    return F.when(text.isNotNull(), F.array_distinct(F.concat(F.array(F.lit("")), *each)))


def longest_grams(text: Column) -> Column:
    """Those of a query that say most: its runs of three characters, or itself if it is shorter."""
    chars, n = F.split(text, ""), F.char_length(text)
    runs = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.concat(*[F.get(chars, i + j) for j in range(3)]))
    return F.when(n >= 3, F.array_distinct(runs)).otherwise(F.array(text))


def build_index(df: DataFrame, id_col: str, cols: list[str], block_rows: int = BLOCK_ROWS) -> Index:
    """Index of the columns' text, joined by blanks and lowered, as ``questions.text_search`` reads it.

    Rows of one id may be several. Grams are made distinct within a row before they are shuffled, and a frequent gram is a list
    a block, none of which is longer than the block. Null columns are left out of the text.
    """
    texts = written(df.select(F.col(id_col).alias("id"), F.lower(F.concat_ws(" ", *cols)).alias("text")), "texts")
    blocks = max(1, -(-texts.count() // block_rows))
    rows = texts.select("id", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), F.explode(grams(F.col("text"))).alias("gram"))
    postings = written(rows.groupBy("gram", "block").agg(F.array_sort(F.collect_set("id")).alias("ids")), "postings")
    counts = written(postings.groupBy("gram").agg(F.sum(F.size("ids")).alias("n")), "counts")
    return Index(texts, postings, counts)


def search(index: Index, queries: DataFrame, query_col: str = "query", rarest: int = RAREST) -> DataFrame:
    """(query, id): the rows whose text holds a query, folded as ``questions.text_search`` folds it; a row for each row of the texts.

    Equal queries are searched once. An empty query holds everywhere; a null one nowhere.
    """
    asked = queries.select(F.col(query_col).alias("query")).filter("query IS NOT NULL").distinct().withColumn("wanted", fold_query("query"))
    each = asked.select("query", "wanted", F.explode(longest_grams(F.col("wanted"))).alias("gram")).join(index.counts, "gram", "left")
    # a list of a query's grams is as long as the query; one that no text holds ends the search for it
    chosen = each.groupBy("query", "wanted").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))), 1, rarest).alias("grams")).filter("grams[0].n > 0")
    looked = chosen.select("query", "wanted", F.size("grams").alias("all"), F.explode("grams.gram").alias("gram")).join(index.postings, "gram")
    lists = looked.groupBy("query", "wanted", "all", "block").agg(F.collect_list("ids").alias("lists")).filter(F.size("lists") == F.col("all"))
    shared = F.aggregate(F.slice("lists", 2, rarest), F.element_at("lists", 1), lambda a, b: F.array_intersect(a, b))
    found = lists.select("query", "wanted", F.explode(shared).alias("id"))
    return found.join(index.texts, "id").filter(F.contains("text", "wanted")).select("query", "id")
