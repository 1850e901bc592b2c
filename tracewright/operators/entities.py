"""Entity tables from records, edges between them, and the nested documents that readers want."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.text import content_id
from tracewright.operators.keys import merge_refs


def dimension(records: DataFrame, keys: list[str], prefix: str, length: int, order: list[Column], attributes: list[str] = (), refs: str | None = None) -> DataFrame:
    """One row a key: an id that is a function of the key, attributes of the key's first record, and the references of all."""
    firsts = [F.min_by(a, F.struct(*order)).alias(a) for a in attributes]
    dims = records.groupBy(*keys).agg(*firsts, F.count(F.lit(1)).alias("records")).withColumn("id", content_id(prefix, length, *keys))
    return dims.join(merge_refs(records.select(*keys, refs), keys, refs), keys) if refs else dims


def children(rows: DataFrame, facets: DataFrame, on: str, parent_id: str, prefix: str, length: int = 20) -> DataFrame:
    """A core child of each row and one for each facet that the row's ``on`` has: (parent, facet, label, id)."""
    core = rows.select(F.col(parent_id).alias("parent"), F.lit("core").alias("facet"), F.lit(None).cast("string").alias("label"))
    more = rows.join(facets, on).select(F.col(parent_id).alias("parent"), "facet", "label")
    return core.unionByName(more).withColumn("id", content_id(prefix, length, "parent", "facet"))


def choice_sets(df: DataFrame, group: str, option: str, predicate: Column | None = None) -> DataFrame:
    """(group, options, n) of the groups with two options or more."""
    rows = df if predicate is None else df.filter(predicate)
    found = rows.select(group, option).distinct().groupBy(group).agg(F.array_sort(F.collect_list(option)).alias("options"))
    return found.withColumn("n", F.size("options")).filter("n > 1")


def pathways(groups: DataFrame, group: str, foundation: str, options: str) -> DataFrame:
    """(group, steps): a foundation step only where there is a foundation, then the alternatives; orders count from 1."""
    step = lambda kind, items: F.struct(F.lit(kind).alias("kind"), items.alias("items"))
    steps = F.array_compact(F.array(F.when(F.size(foundation) > 0, step("foundation", F.col(foundation))), F.when(F.size(options) > 0, step("alternatives", F.col(options)))))
    ordered = F.transform(steps, lambda s, i: F.struct((i + 1).alias("order"), s["kind"].alias("kind"), s["items"].alias("items")))
    return groups.select(group, ordered.alias("steps"))


def label_steps(paths: DataFrame, group: str, dim: DataFrame, key: str, label: str) -> DataFrame:
    """(group, order, kind, labels): steps with the labels of their items, in the items' order."""
    items = paths.select(group, F.explode("steps").alias("s")).select(group, "s.order", "s.kind", F.posexplode_outer("s.items").alias("at", key))
    named = items.join(dim.select(key, F.col(label).alias("_label")), key, "left")
    listed = named.groupBy(group, "order", "kind").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("_label", F.col(key).cast("string")).alias("l")))).alias("x"))
    return listed.select(group, "order", "kind", F.transform("x", lambda e: e["l"]).alias("labels"))


def finalise_edges(edges: DataFrame, prefix: str, length: int, *cols: str) -> DataFrame:
    return edges.withColumn("edge_id", content_id(prefix, length, *cols))


def review_records(edges: DataFrame, scope: str, edge_id: str = "edge_id") -> DataFrame:
    """(scope, targets): the sorted distinct edges that a scope's review has to look at."""
    return edges.groupBy(scope).agg(F.array_sort(F.collect_set(edge_id)).alias("targets"))


def progressions(pairs: DataFrame, groups: DataFrame, label: str, key: str) -> DataFrame:
    """Pairs of group labels with both groups' ids; ``state`` says which label has none or several."""
    from tracewright.operators.relations import unique_label

    known = unique_label(groups, label, key)
    rows = pairs
    for side in ("from", "to"):
        rows = rows.join(known.select(F.col(label).alias(f"{side}_label"), F.col("n").alias(f"_{side}_n"), F.col(key).alias(f"{side}_key")), f"{side}_label", "left")
    bad = [F.when(F.coalesce(F.col(f"_{s}_n"), F.lit(0)) != 1, s) for s in ("from", "to")]
    return rows.withColumn("state", F.coalesce(F.concat(F.coalesce(*bad), F.lit("-unresolved")), F.lit("ok"))).drop("_from_n", "_to_n")


def alignments(edges: DataFrame, kind: str) -> DataFrame:
    """Edges as rows with arrays at both ends."""
    return edges.select(F.array("src").alias("from_ids"), F.array("dst").alias("to_ids"), F.lit(kind).alias("kind"), content_id("alignment:", 24, "src", "dst", F.lit(kind)).alias("id"))


def detail_documents(parent: DataFrame, key: str, nested: dict[str, tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """(key, detail): a JSON document of each parent with its children by name: name -> (table, foreign key, columns). Children are sorted."""
    rows = parent
    for name, (child, fk, cols) in nested.items():
        lists = child.groupBy(F.col(fk).alias(key)).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name))
        rows = rows.join(lists, key, "left").withColumn(name, F.coalesce(name, F.array().cast(lists.schema[name].dataType)))
    return rows.select(key, F.to_json(F.struct(*rows.columns)).alias("detail"))


def index_rows(parent: DataFrame, key: str, counts: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """parent with the number of its children in each table, zero included."""
    rows = parent
    for name, (child, fk) in counts.items():
        n = child.groupBy(F.col(fk).alias(key)).agg(F.count(F.lit(1)).alias(name))
        rows = rows.join(n, key, "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("long"))
    return rows


def transition_index(rows: DataFrame, dim: DataFrame, key: str, label: str) -> DataFrame:
    """Alignments (from_ids, to_ids) with the labels of the first id on each side, or the id itself."""
    for side in ("from", "to"):
        d = dim.select(F.col(key).alias(f"_{side}"), F.col(label).alias(f"_{side}_label"))
        rows = rows.withColumn(f"_{side}", F.try_element_at(f"{side}_ids", F.lit(1))).join(d, f"_{side}", "left")
        rows = rows.withColumn(f"{side}_label", F.coalesce(f"_{side}_label", F.col(f"_{side}").cast("string"))).drop(f"_{side}", f"_{side}_label")
    return rows


def source_manifest(catalog: DataFrame, receipts: DataFrame, key: str) -> DataFrame:
    """Catalogue rows with their receipts; ``received`` says whether there is one."""
    return catalog.join(receipts.withColumn("received", F.lit(True)), key, "left").withColumn("received", F.coalesce("received", F.lit(False)))


def refresh_release(release: DataFrame, counts: DataFrame) -> DataFrame:
    """release (release_id, counts MAP) with newer counts (release_id, metric, value) put in."""
    new = counts.groupBy("release_id").agg(F.map_from_entries(F.collect_list(F.struct("metric", F.col("value").cast("long")))).alias("_new"))
    rows = release.join(new, "release_id", "left")
    old_only = F.map_filter("counts", lambda k, v: ~F.coalesce(F.map_contains_key("_new", k), F.lit(False)))
    return rows.withColumn("counts", F.coalesce(F.map_concat(old_only, "_new"), "counts")).drop("_new")


def replace_rows(df: DataFrame, keep: Column, new: DataFrame) -> DataFrame:
    return df.filter(keep).unionByName(new, allowMissingColumns=True)


def rank_within(df: DataFrame, keys: list[str], order: list[Column], out: str = "place") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
