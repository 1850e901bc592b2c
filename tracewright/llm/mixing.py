"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions only.

Each document draws an exponential key scaled by its quality weight; within a source the least keys come first. A source
whose target is above its size is taken whole as often as it fits (complete epochs); the rest of the target is filled in
the order of the keys, by prefix sums of sizes. Prefix sums are taken in two steps, over sums of key ranges and then inside
each range, so that a source with a third of all documents is never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.llm.common import WORD, id_key, shown_id, text_or_empty, written

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Bins of quality for each factor of e, about 60 in all: how far ranges of keys may differ in their number of documents.
QUALITY_BINS = 20
#: Documents of a source in one range of keys, about; and the number of sources up to which their table is broadcast.
RANGE_ROWS, SOURCES = 2_000, 100_000


def quality_weight(text: Column) -> Column:
    """1 for plain text, less the more of it is symbols that prose hardly has."""
    symbols = F.regexp_count(text, F.lit(r"[!#$%&*+<=>@\\^_`{|}~]"))
    return 1.0 / (1.0 + 20.0 * symbols / F.greatest(F.char_length(text), F.lit(1)))


def targets(sources: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple = WEIGHTS) -> DataFrame:
    """sources (source, source_size) with ``target``: share of all sizes by weight, at most ``most`` times a source's size, the excess shared anew.

    Sources are ranked by code point, null last, and weigh ``weights`` in turn. Filled in the order of (limit / weight), a
    level for what is left follows after each source; the highest of those levels is the common one of all that stay below
    their limits. The table has one row a source.
    """
    by_name, all_rows = Window.orderBy(F.col("source").isNull(), "source"), Window.partitionBy()
    rank = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    rows = sources.withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(most))
    filled = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    spent = F.coalesce(F.sum("limit").over(filled), F.lit(0.0))
    open_weight = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(filled), F.lit(0.0))
    level = (F.sum("source_size").over(all_rows) * share - spent) / open_weight
    rows = rows.withColumn("level", level)
    return rows.withColumn("target", F.least(F.col("limit"), F.max("level").over(all_rows) * F.col("weight"))).drop("level", "limit", "weight")


def key_range(ranges: Column) -> Column:
    """Which of ``ranges`` ranges of about as many documents a ``key`` is in, by the ``rates`` (m, rate) of its source's ``n`` documents.

    A document of quality q has a key below k with probability 1 - exp(-q * k); in a source that is the mean over its bins of like
    quality, and the ranges are equal parts of that probability. It grows with the key, so ranges are in the order of keys.
    """
    above = F.aggregate("rates", F.lit(0.0), lambda sum_, r: sum_ + r["m"] * F.exp(-F.col("key") * r["rate"])) / F.col("n")
    return F.greatest(F.lit(0), F.least(ranges - 1, F.floor(ranges * (1 - above))))


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, share: float = SHARE, most: float = MOST, whole: bool = False) -> DataFrame:
    """Per row: id, size, source_size, target (of its source) and taken: the words that the mix takes of it, epochs counted.

    The document at which a source's target is reached gives only its first words, so a source's taken words are its target
    to the word. With whole, it is taken whole or not at all, whichever comes nearer to the target; ``copies`` says how often the
    mix has a document: once an epoch, and once more if the fractional selection takes any of it. Sizes are numbers of words; a null text has none; null sources are one source, the last; a null id stays null;
    ties of keys go by id and text; repeated rows are documents of their own; reruns agree; an empty table gives none. A very long
    text is a document like others, which a source may spend its whole rest on; columns of other names than the three are ignored.
    """
    text = text_or_empty(text_col)
    rows = df.select(
        id_key(id_col).alias("dk"),
        F.col(source_col).cast("string").alias("source"),
        F.xxhash64(text, F.lit(seed)).alias("tie"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        quality_weight(text).alias("quality"),
    )
    drawn = (F.shiftrightunsigned(F.xxhash64("dk", "tie", F.lit(seed)), 11).cast("double") + 0.5) / 2.0**53
    rows = written(rows.withColumn("key", -F.log(drawn) / F.col("quality")), "sizes")
    bins = rows.groupBy("source", F.floor(-F.log("quality") * QUALITY_BINS).alias("bin")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("m"), F.avg("quality").alias("rate"))
    sources = bins.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum("m").alias("n"), F.array_sort(F.collect_list(F.struct("m", "rate"))).alias("rates"))
    sources = written(targets(sources, share, most), "sources")
    few = sources.count() <= SOURCES
    known = sources.withColumnRenamed("source", "its_source")
    rows = rows.join(F.broadcast(known) if few else known, F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")
    part = key_range(F.ceil(F.col("n") / RANGE_ROWS))
    rows = rows.withColumn("name", F.coalesce("source", F.lit(""))).withColumn("none", F.col("source").isNull()).withColumn("part", part)
    sums = rows.groupBy("none", "name", "part").agg(F.sum("size").alias("in_part"))
    before = sums.withColumn("before", F.sum("in_part").over(Window.partitionBy("none", "name").orderBy("part")) - F.col("in_part")).drop("in_part")
    inside = F.sum("size").over(Window.partitionBy("none", "name", "part").orderBy("key", "dk", "tie").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    rows = rows.withColumn("inside", inside).join(before, ["none", "name", "part"])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.round(F.col("target") - epochs * F.col("source_size")).cast("long")
    budget = rest - F.col("before") - F.col("inside")
    chosen = (budget > 0) & (budget * 2 >= F.col("size")) if whole else budget > 0
    some = F.when(chosen, F.col("size") if whole else F.least(F.col("size"), budget)).otherwise(0)
    taken = (epochs * F.col("size") + some).cast("long")
    copies = (epochs + F.when(chosen, 1).otherwise(0)).cast("int")
    return rows.select(shown_id(F.col("dk")).alias(id_col), "size", "source_size", "target", taken.alias("taken"), "tie", copies.alias("copies"))


def mixed_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix as rows of df's columns: a document once an epoch, and one more time if the fractional selection takes it.

    Documents are whole: the one at which a source's target is reached is taken or left, whichever comes nearer. Documents
    without words stand like others, repeated rows of df are documents of their own, a null text has no words and stays null,
    columns of any name pass, and an empty table gives none.
    """
    seed = options.get("seed", 17)
    names = [f"c{k}" for k in range(len(df.columns))]  # no name of df can clash with the keys
    at = names[df.columns.index(text_col)]
    same = Window.partitionBy("dk", "tie").orderBy(F.lit(0))  # rows of equal id and text are alike
    takes = mixed(df, id_col, text_col, source_col, **{**options, "whole": True})
    takes = takes.select(id_key(id_col).alias("dk"), "tie", "copies").withColumn("nth", F.row_number().over(same))
    rows = df.toDF(*names).withColumn("dk", id_key(names[df.columns.index(id_col)])).withColumn("tie", F.xxhash64(text_or_empty(at), F.lit(seed))).withColumn("nth", F.row_number().over(same))
    joined = rows.join(takes, ["dk", "tie", "nth"]).filter("copies > 0")
    return joined.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select(*names).toDF(*df.columns)
