"""Deduplication on keys, merged references and duplicate reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_refs(df: DataFrame, keys: list[str], refs: str, out: str | None = None) -> DataFrame:
    """Sorted distinct union of a group's arrays. Elements are made distinct before they are gathered."""
    each = df.select(*keys, F.explode_outer(refs).alias("_ref")).distinct()
    return each.groupBy(*keys).agg(F.array_sort(F.collect_list("_ref")).alias(out or refs))


def collect_ids(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias(out))


def dedup_first(df: DataFrame, keys: list[str], order: list[Column], merge: dict[str, str] | None = None, repeats: str = "repeats") -> DataFrame:
    """The first row of each key, with sorted distinct values of other columns merged in (column -> name) and the number of rows folded.

    One aggregation: the first row by order is a state that partial states merge into, so a key with most rows is folded before
    it is shuffled. Null keys are dropped; nulls in the order come first.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    rows = df.filter(~F.exists(F.array(*[F.col(k).isNull() for k in keys]), lambda x: x))
    folded = rows.groupBy(*keys).agg(first, *[F.array_sort(F.collect_set(c)).alias(name) for c, name in (merge or {}).items()], (F.count(F.lit(1)) - 1).alias(repeats))
    return folded.select(*keys, *[F.col("_first")[c].alias(c) for c in rest], *(merge or {}).values(), repeats)


def dedup_conflicts(df: DataFrame, keys: list[str], order: list[Column], value: str) -> DataFrame:
    """Rows whose value differs from that of the row their key keeps, with the kept value.

    What a key keeps is aggregated first, a row a key, and joined back; a key with many rows meets one row there, so its rows
    can be split among tasks. Null keys are keys like others.
    """
    names = [f"_k{n}" for n in range(len(keys))]
    kept = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).agg(F.min_by(F.struct(F.col(value)), F.struct(*order)).alias("_kept"))
    same = F.lit(True)
    for k, n in zip(keys, names, strict=True):
        same = same & F.col(k).eqNullSafe(F.col(n))
    both = df.join(kept, same).withColumn("kept_value", F.col("_kept")[value])
    return both.filter(~F.col(value).eqNullSafe(F.col("kept_value"))).select(*df.columns, "kept_value")


def priority_dedup(edges: DataFrame, keys: list[str], rank: Column, order: list[Column]) -> DataFrame:
    """One row a key: of the highest rank, and of those the earliest."""
    w = Window.partitionBy(*keys).orderBy(rank.desc(), *order)
    return edges.withColumn("_place", F.row_number().over(w)).filter("_place = 1").drop("_place")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def exactly_one(child: DataFrame, fk: str, predicate: Column, value: str) -> DataFrame:
    """(fk, n, value): how many children of a parent fulfil the predicate, and the one where there is exactly one."""
    found = child.groupBy(fk).agg(F.count_if(predicate).alias("n"), F.min(F.when(predicate, F.col(value))).alias("_value"))
    return found.select(fk, "n", F.when(F.col("n") == 1, F.col("_value")).alias(value))


def unique_subkey(child: DataFrame, fk: str, key: str, must_have: str) -> DataFrame:
    """Parents whose children repeat a key or lack a required one."""
    found = child.groupBy(fk).agg((F.count(key) - F.count_distinct(key)).alias("repeated"), F.bool_or(F.col(key) == must_have).alias("has"))
    return found.filter((F.col("repeated") > 0) | ~F.coalesce(F.col("has"), F.lit(False)))


def size_histogram(df: DataFrame, key: str) -> DataFrame:
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("size").agg(F.count(F.lit(1)).alias("groups"))


def size_stats(df: DataFrame, key: str) -> DataFrame:
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("size"))
    return sizes.agg(F.min("size").alias("least"), F.max("size").alias("most"), F.avg("size").alias("mean"), F.count(F.lit(1)).alias("groups"))
