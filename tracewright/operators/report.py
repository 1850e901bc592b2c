"""Counts, coverage and reconciliation in one pass where one will do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_by(df: DataFrame, cols: list[str]) -> DataFrame:
    """(dimension, value, n): counts by each of several columns, and in total, from one aggregation."""
    sets = [[F.col(c)] for c in cols] + [[]]
    grouped = df.groupingSets(sets, *cols).agg(F.count(F.lit(1)).alias("n"), *[F.grouping(c).alias(f"_g_{c}") for c in cols])
    name, value = F.lit("total"), F.lit(None).cast("string")
    for c in cols:
        mine = F.col(f"_g_{c}") == 0
        name, value = F.when(mine, c).otherwise(name), F.when(mine, F.col(c).cast("string")).otherwise(value)
    return grouped.select(name.alias("dimension"), value.alias("value"), "n")


def scoped_counts(df: DataFrame, predicates: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(keys or [])).agg(*[F.count_if(p).alias(n) for n, p in predicates.items()])


def inventory(tables: dict[str, DataFrame], by: str | None = None) -> DataFrame:
    """(entity, scope, n): the number of rows of each table, by a column that all have, or in all."""
    parts = []
    for name, df in tables.items():
        scope = F.col(by).cast("string") if by else F.lit("all")
        parts.append(df.groupBy(scope.alias("scope")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("entity"), "scope", "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def reconcile_counts(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(dataset, metric, expected, actual) where two long tables of counts (dataset, metric, value) differ or one lacks a count."""
    e, a = (d.select("dataset", "metric", F.col("value").cast("long").alias(n)) for d, n in ((expected, "expected"), (actual, "actual")))
    return e.join(a, ["dataset", "metric"], "full").filter(~F.col("expected").eqNullSafe(F.col("actual")))


def reconcile_sum(df: DataFrame, col: str, expected) -> DataFrame:
    return df.agg(F.sum(col).alias("actual")).select(F.lit(expected).alias("expected"), "actual", F.col("actual").eqNullSafe(F.lit(expected)).alias("holds"))


def distinct_in_arrays(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: the number of distinct ids that array columns hold between them."""
    return df.select(F.explode(F.concat(*[F.coalesce(F.col(c), F.array()) for c in cols])).alias("_id")).agg(F.count_distinct("_id").alias("n"))


def facet_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def relation_report(nodes: DataFrame, edges: DataFrame, owner: DataFrame, edge_id: str, attributes: list[str], src: str = "src", dst: str = "dst") -> DataFrame:
    """(section, name, n): counts of edges by attribute, coverage of the graph, and edges by owner (node, owner), zero included."""
    from tracewright.operators import graph

    counts = count_by(edges, attributes).select(F.lit("edges").alias("section"), F.concat_ws(":", "dimension", F.coalesce("value", F.lit(""))).alias("name"), "n")
    covered = graph.graph_coverage(nodes, edges, src, dst)
    names = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("n")) for c in covered.columns])
    covered = covered.select(F.explode(names).alias("x")).select(F.lit("coverage").alias("section"), "x.name", "x.n")
    touched = graph.attach_edges(edges, edge_id, src, dst).join(owner, "node").groupBy("owner").agg(F.count_distinct("edge").alias("_n"))
    owned = owner.select("owner").distinct().join(touched, "owner", "left").select(F.lit("owner").alias("section"), F.col("owner").cast("string").alias("name"), F.coalesce("_n", F.lit(0)).alias("n"))
    return counts.union(covered).union(owned)


def canonical_order(df: DataFrame, *keys: str) -> DataFrame:
    """Rows in the order of their keys, for a sink that people read; a fingerprint needs no order."""
    return df.orderBy(*keys)


def locale_order(df: DataFrame, col: str, locale: str, *then: str) -> DataFrame:
    return df.orderBy(F.collate(F.col(col), locale), *then)


def multi_order(df: DataFrame, keys: list[tuple[str, str | None, bool]]) -> DataFrame:
    """Rows by several keys (column, collation or None, ascending)."""
    columns = [F.collate(F.col(c), collation) if collation else F.col(c) for c, collation, _ in keys]
    return df.orderBy(*[k.asc() if up else k.desc() for k, (_, _, up) in zip(columns, keys, strict=True)])


def placed(ordered: DataFrame, out: str) -> DataFrame:
    """The number, from 1, of each row of an ordered table.

    Rows are numbered inside their partitions, which the sort has put in order, and each partition starts after the counts of
    those before it (a table of a row a partition); nothing is sorted in one task.
    """
    from tracewright.storage import written

    inside = F.monotonically_increasing_id()
    rows = written(ordered.withColumn("_id", inside), "ordered")
    part = F.shiftright("_id", 33)
    counts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).select("_part", "_before")
    numbered = rows.withColumn("_part", part).join(F.broadcast(before), "_part")  # a row a partition
    return numbered.withColumn(out, F.col("_before") + F.col("_id") - F.shiftleft("_part", 33) + 1).drop("_id", "_part", "_before")
