"""Lookups that must match, code pairs resolved to edges, and references checked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.operators.graph import closure


def require_match(df: DataFrame, dim: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a match, rows without)."""
    return df.join(dim, on), df.join(dim.select(on).distinct(), on, "left_anti")


def unique_label(dim: DataFrame, label: str, key: str) -> DataFrame:
    """(label, n, key): the key only where the label has exactly one."""
    found = dim.groupBy(label).agg(F.count_distinct(key).alias("n"), F.min(key).alias("_key"))
    return found.select(label, "n", F.when(F.col("n") == 1, F.col("_key")).alias(key))


def resolve_code(df: DataFrame, code: str, dim: DataFrame, dim_code: str, key: str, normalise, out: str) -> DataFrame:
    """df with the key of the one dimension row whose normalised code equals its own, and its state: ok, unknown or ambiguous."""
    known = unique_label(dim.select(normalise(F.col(dim_code)).alias("_code"), F.col(key).alias(out)), "_code", out).withColumnRenamed("n", "_n")
    rows = df.withColumn("_code", normalise(F.col(code))).join(known, "_code", "left").drop("_code")
    state = F.when(F.col("_n").isNull(), "unknown").when(F.col("_n") > 1, "ambiguous").otherwise("ok")
    return rows.withColumn(f"{out}_state", state).drop("_n")


def edges_from_specs(specs: DataFrame, dim: DataFrame, dim_code: str, key: str, normalise, src: str = "src", dst: str = "dst") -> DataFrame:
    """Specs (from_code, to_code, ...) with both ends resolved; ``state`` is ok only if both are."""
    rows = resolve_code(specs, "from_code", dim, dim_code, key, normalise, src)
    rows = resolve_code(rows, "to_code", dim, dim_code, key, normalise, dst)
    state = F.when(F.col(f"{src}_state") != "ok", F.concat(F.lit("from-"), F.col(f"{src}_state"))).when(F.col(f"{dst}_state") != "ok", F.concat(F.lit("to-"), F.col(f"{dst}_state"))).otherwise("ok")
    return rows.withColumn("state", state).drop(f"{src}_state", f"{dst}_state")


def union_edges(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def explode_join(parent: DataFrame, child: DataFrame, array: str, child_key: str) -> DataFrame:
    """Parents with the children that an array of theirs names."""
    return parent.select("*", F.explode(array).alias(child_key)).drop(array).join(child, child_key)


def fk_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str, rule: str) -> DataFrame:
    """(rule, ref, rows): references that no parent has, with how many rows hold them. Nulls aren't references."""
    refs = child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_ref")).agg(F.count(F.lit(1)).alias("rows"))
    lost = refs.join(parent.select(F.col(pk).alias("_ref")), "_ref", "left_anti")
    return lost.select(F.lit(rule).alias("rule"), F.col("_ref").cast("string").alias("ref"), "rows")


def fk_array_violations(child: DataFrame, array: str, parent: DataFrame, pk: str, rule: str) -> DataFrame:
    return fk_violations(child.select(F.explode(array).alias("_each")), "_each", parent, pk, rule)


def all_refs(df: DataFrame, key: str, suffixes: tuple[str, ...] = ("_id", "_ids", "_refs")) -> DataFrame:
    """(key, path, ref): every reference that a nested table holds, by its fields' names.

    The paths come from the schema when the plan is made: fields whose names end in one of the suffixes, in structs and in
    arrays of structs at any depth.
    """
    from pyspark.sql import types as T

    parts: list[DataFrame] = []

    def walk(rows: DataFrame, column: Column, kind: T.DataType, path: str) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(rows, column[f.name] if path else F.col(f"`{f.name}`"), f.dataType, f"{path}.{f.name}" if path else f.name)
        elif isinstance(kind, T.ArrayType):
            if isinstance(kind.elementType, (T.StructType, T.ArrayType)):
                inner = rows.select(F.col("_key"), F.explode(column).alias("_each"))
                walk(inner, F.col("_each"), kind.elementType, path)
            elif path.endswith(suffixes):
                each = rows.select(F.col("_key").alias(key), F.lit(path).alias("path"), F.explode(column).alias("ref"))
                parts.append(each.withColumn("ref", F.col("ref").cast("string")))
        elif path.endswith(suffixes) and path != key:
            parts.append(rows.select(F.col("_key").alias(key), F.lit(path).alias("path"), column.cast("string").alias("ref")).filter("ref IS NOT NULL"))

    walk(df.withColumn("_key", F.col(key)), None, df.schema, "")
    return union_edges(*parts)


def external_edges(specs: DataFrame, inventory: DataFrame, external: str, dim: DataFrame, dim_code: str, key: str, normalise) -> DataFrame:
    """Specs (external id, to_code) with the target resolved; ``state`` is unknown-source where a pinned inventory (id) lacks the external id."""
    rows = resolve_code(specs, "to_code", dim, dim_code, key, normalise, "dst")
    rows = rows.join(inventory.select(F.col("id").alias(external), F.lit(True).alias("_listed")), external, "left")
    return rows.withColumn("state", F.when(F.col("_listed").isNull(), "unknown-source").otherwise(F.col("dst_state"))).drop("_listed", "dst_state")


def coverage_both_ways(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """(side, key): keys of the left that the right lacks, and the other way round."""
    a, b = left.select(on).distinct(), right.select(on).distinct()
    return a.join(b, on, "left_anti").select(F.lit("left").alias("side"), on).union(b.join(a, on, "left_anti").select(F.lit("right").alias("side"), on))


def missing_keys(expected: DataFrame, actual: DataFrame, on: str) -> DataFrame:
    return expected.select(on).distinct().join(actual.select(on), on, "left_anti")


def restrict(child: DataFrame, fk: str, parents: DataFrame, pk: str) -> DataFrame:
    return child.join(parents.select(F.col(pk).alias(fk)), fk, "left_semi")


def enrich(df: DataFrame, dim: DataFrame, on: str, value: str, out: str) -> DataFrame:
    """df with a value looked up, or the key itself where there is none."""
    return df.join(dim.select(on, F.col(value).alias("_v")), on, "left").withColumn(out, F.coalesce("_v", F.col(on).cast("string"))).drop("_v")


def check_pins(pins: DataFrame, releases: DataFrame) -> DataFrame:
    """(profile, pinned, current) of pins (profile, release_id) that don't name the profile's release."""
    now = releases.select("profile", F.col("release_id").alias("current"))
    rows = pins.withColumnRenamed("release_id", "pinned").join(now, "profile", "left")
    return rows.filter(~F.col("pinned").eqNullSafe(F.col("current"))).select("profile", "pinned", "current")


def self_loops(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    return edges.filter(F.col(src) == F.col(dst))


def compare_rows(df: DataFrame, key: str, a, b) -> DataFrame:
    """(field, a, b): two rows side by side."""
    names = [c for c in df.columns if c != key]
    two = df.filter(F.col(key).isin(a, b)).select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in names])).alias("x"))
    return two.groupBy("x.field").agg(F.max(F.when(F.col(key) == a, F.col("x.value"))).alias("a"), F.max(F.when(F.col(key) == b, F.col("x.value"))).alias("b"))


def apply_replacements(df: DataFrame, col: str, mapping: DataFrame) -> DataFrame:
    """Ids that a mapping (old, new) replaces, replaced."""
    return df.join(mapping.select(F.col("old").alias(col), "new"), col, "left").withColumn(col, F.coalesce("new", col)).drop("new")


def replacement_ends(mapping: DataFrame) -> DataFrame:
    """(old, new) of a mapping whose replacements may be replaced themselves: each old id with those that nothing replaces. A cycle is refused."""
    led = closure(mapping, "old", "new").select(F.col("src").alias("old"), F.col("dst").alias("new"))
    return led.join(mapping.select(F.col("old").alias("new")).distinct(), "new", "left_anti").select("old", "new")


def in_force(rules: DataFrame, day: Column, start: str = "effective_from", end: str = "effective_to") -> DataFrame:
    return rules.filter((F.col(start) <= day) & (F.col(end).isNull() | (day <= F.col(end))))


def alternatives(sets: DataFrame, set_id: str, options: str, excluded) -> DataFrame:
    """(set, option): what is left in the sets that hold an excluded option."""
    return sets.filter(F.array_contains(options, excluded)).select(set_id, F.explode(options).alias("option")).filter(F.col("option") != excluded)
