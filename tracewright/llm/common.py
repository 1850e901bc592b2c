"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.storage import dropped, shared_dir, written

__all__ = ["CACHES", "NO_ID", "WORD", "documents", "drop_caches", "dropped", "id_key", "shared_dir", "shown_id", "text_or_empty", "written"]

#: Stands for a null document id inside the operators, where ids are join keys; outputs show the null again.
NO_ID = -(2**63)
#: What separates words in every operator that counts or compares words: ASCII white space only.
WORD = r"[^\x20\x09-\x0D]+"


#: What a Python worker remembers between tasks; workers serve one stage after another.
CACHES: list[dict] = []


def drop_caches() -> None:
    """Frees what an earlier stage left in this worker."""
    for cache in CACHES:
        cache.clear()


def id_key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))


def shown_id(key: Column) -> Column:
    return F.when(key != F.lit(NO_ID), key)


def text_or_empty(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
