"""Labelled rows for training: which are held out, and a bounded sample of the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text, mod ``parts``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % parts


def training_sample(labels: DataFrame, label_col: str, id_col: str, usable: Column, most: dict[int, int]) -> DataFrame:
    """(id, label) of at most most[label] rows of each label, by the least hashes of their ids.

    Only rows with an id and label for which ``usable`` holds; an id with several labels has their maximum.
    """
    rows = labels.filter(usable & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    rows = rows.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    drawn = rows.withColumn("drawn", F.xxhash64("id"))
    parts = [drawn.filter(F.col("label") == label).orderBy("drawn", "id").limit(n) for label, n in most.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("id", "label")


def sampled_texts(df: DataFrame, sample: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, label, text) of the documents in a sample; the sample is broadcast, its size is bounded by its parameters."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.join(F.broadcast(sample), "id").select("id", "label", "text")
