"""Fingerprints, manifests, hash trees and drift of releases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def row_text(cols: list[str]) -> Column:
    """Columns as one text; a null isn't an empty text."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in cols])


def row_hash(text: Column) -> Column:
    """60 bits of MD5 as a number, which other engines can compute too."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def fingerprint(df: DataFrame, cols: list[str] | None = None, key: str | None = None) -> DataFrame:
    """One row (n, hash_xor, hash_sum, keys): the same for the same rows in any order and any partitions."""
    h = row_hash(row_text(cols or df.columns))
    rows = df.select(h.alias("h"), *([F.col(key).alias("k")] if key else []))
    keys = F.count_distinct("k") if key else F.count(F.lit(1))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("hash_xor"), F.sum(F.col("h").cast("decimal(38,0)")).cast("string").alias("hash_sum"), keys.alias("keys"))


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """(dataset, n, hash_xor, hash_sum) of each table."""
    parts = [fingerprint(df).select(F.lit(name).alias("dataset"), "n", "hash_xor", "hash_sum") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def bundle(manifests: DataFrame) -> DataFrame:
    return fingerprint(manifests, ["dataset", "n", "hash_xor", "hash_sum"])


def same_multiset(a: DataFrame, b: DataFrame) -> bool:
    return fingerprint(a, a.columns).first() == fingerprint(b, a.columns).first()


def is_deterministic(build, times: int = 2) -> bool:
    """Whether building a table again, dealt over other partitions, gives the same rows."""
    first = build()
    return all(same_multiset(first, build().repartition(3 + k)) for k in range(1, times))


def is_stale(new: DataFrame, stored: DataFrame) -> bool:
    return sorted(new.columns) != sorted(stored.columns) or not same_multiset(new, stored)


def difference(new: DataFrame, stored: DataFrame) -> DataFrame:
    """(side, ...): rows that only one of two versions has, repeats counted."""
    return new.exceptAll(stored.select(new.columns)).select(F.lit("new").alias("side"), "*").union(stored.select(new.columns).exceptAll(new).select(F.lit("stored").alias("side"), "*"))


def verify_manifest(stored: DataFrame, now: DataFrame) -> DataFrame:
    """(dataset, state): missing, unlisted, changed or same, of two manifests."""
    a, b = (d.select("dataset", F.struct("n", "hash_xor", "hash_sum").alias(n)) for d, n in ((stored, "was"), (now, "is")))
    state = F.when(F.col("is").isNull(), "missing").when(F.col("was").isNull(), "unlisted").when(F.col("is") != F.col("was"), "changed").otherwise("same")
    return a.join(b, "dataset", "full").select("dataset", state.alias("state"))


def lost_keys(before: DataFrame, now: DataFrame, key: str, predicate: Column | None = None) -> DataFrame:
    rows = before if predicate is None else before.filter(predicate)
    return rows.select(key).join(now.select(key), key, "left_anti")


def drift(before: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """(key, change): keys that were lost, added, or whose rows changed."""
    cols = [c for c in before.columns if c != key]
    a, b = (d.select(key, row_hash(row_text(cols)).alias(n)) for d, n in ((before, "was"), (now, "is")))
    change = F.when(F.col("is").isNull(), "lost").when(F.col("was").isNull(), "added").when(F.col("is") != F.col("was"), "changed")
    return a.join(b, key, "full").select(key, change.alias("change")).filter("change IS NOT NULL")


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).intersect(b.select(key))


def orphans(stored: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    return stored.join(listed.select(key), key, "left_anti")


def index_vs_detail(index: DataFrame, detail: DataFrame, key: str, count: str) -> DataFrame:
    """Keys whose count in an index isn't the number of their rows in the detail."""
    n = detail.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return index.join(n, key, "left").filter(F.col(count) != F.coalesce("_n", F.lit(0))).select(key, count, F.coalesce("_n", F.lit(0)).alias("rows"))


def stale_bridges(pins: DataFrame, manifests: DataFrame) -> DataFrame:
    """Pins (dataset, hash_xor) that no longer name what the dataset is."""
    now = manifests.select("dataset", F.col("hash_xor").alias("now"))
    return pins.join(now, "dataset", "left").filter(~F.col("hash_xor").eqNullSafe(F.col("now"))).select("dataset", "hash_xor", "now")


#: Bits of the hash of a key that name its leaf, and by which a level of the tree is wider than the one above.
LEAF_BITS, STEP_BITS = 12, 4
_HASH_BITS = 60


def leaf_of(keys: list[str], bits: int = LEAF_BITS) -> Column:
    """The range of key hashes that a row is in: a number of ``bits`` bits."""
    return F.shiftright(row_hash(row_text(keys)), _HASH_BITS - bits)


def hash_tree(df: DataFrame, keys: list[str], bits: int = LEAF_BITS, step: int = STEP_BITS) -> DataFrame:
    """(level, node, n, hash_xor, hash_sum): fingerprints of the rows in each range of key hashes, from the root (level 0) to the leaves.

    Leaves are one aggregation of the rows; every level above sums the one below, at most 2 ** bits rows. Sums and xors don't
    depend on the order of rows; repeated rows count. An empty table has no nodes.
    """
    h = row_hash(row_text(df.columns))
    rows = df.select(leaf_of(keys, bits).alias("node"), h.alias("h"))
    leaves = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("hash_xor"), F.sum(F.col("h").cast("decimal(38,0)")).alias("hash_sum"))
    depth = -(-bits // step)
    up = lambda level: max(0, bits - level * step)
    nodes = leaves.select(F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright("node", up(k)).alias("node")) for k in range(depth + 1)])).alias("at"), "n", "hash_xor", "hash_sum")
    grouped = nodes.groupBy("at.level", "at.node").agg(F.sum("n").alias("n"), F.bit_xor("hash_xor").alias("hash_xor"), F.sum("hash_sum").cast("decimal(38,0)").cast("string").alias("hash_sum"))
    return grouped


def changed_ranges(before: DataFrame, now: DataFrame, bits: int = LEAF_BITS, step: int = STEP_BITS) -> DataFrame:
    """(node, change): leaves of two hash trees that differ: lost, added or changed.

    From the root down, only the children of nodes that differ are compared, so of trees that are stored by level (as
    ``write_hashed`` does) a level is read only if the one above differs, and of it what lies below differing nodes.
    """
    found = None
    for level in range(-(-bits // step) + 1):
        a, b = (t.filter(F.col("level") == level).select("node", F.struct("n", "hash_xor", "hash_sum").alias(n)) for t, n in ((before, "was"), (now, "is")))
        if found is not None:
            up = F.shiftright("node", min(step, bits - (level - 1) * step))
            a, b = (t.withColumn("up", up).join(found.select(F.col("node").alias("up")), "up", "left_semi").drop("up") for t in (a, b))
        change = F.when(F.col("is").isNull(), "lost").when(F.col("was").isNull(), "added").when(F.col("is") != F.col("was"), "changed")
        found = a.join(b, "node", "full").select("node", change.alias("change")).filter("change IS NOT NULL")
    return found


def write_hashed(df: DataFrame, keys: list[str], path: str, bits: int = LEAF_BITS, step: int = STEP_BITS) -> None:
    """Writes df to path/rows, a folder for each leaf, and its hash tree, counted from what was written, to path/tree, a folder for each level."""
    at, spark = path.rstrip("/"), df.sparkSession
    df.withColumn("_leaf", leaf_of(keys, bits)).repartition("_leaf").write.partitionBy("_leaf").parquet(f"{at}/rows")
    stored = spark.read.schema(df.schema).parquet(f"{at}/rows").select(df.columns)
    hash_tree(stored, keys, bits, step).repartition("level").write.partitionBy("level").parquet(f"{at}/tree")


def read_hashed(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, tree) of what ``write_hashed`` wrote."""
    return spark.read.parquet(f"{path.rstrip('/')}/rows"), spark.read.parquet(f"{path.rstrip('/')}/tree")


def changed_rows(spark: SparkSession, before: str, now: str, bits: int = LEAF_BITS, step: int = STEP_BITS) -> tuple[DataFrame, int]:
    """Rows (side, ...) that only one of two stored releases has, repeats counted, and the number of files that are read for them.

    Only the folders of leaves that differ are read: at most 2 ** bits numbers reach the driver.
    """
    (a, a_tree), (b, b_tree) = read_hashed(spark, before), read_hashed(spark, now)
    leaves = [r["node"] for r in changed_ranges(a_tree, b_tree, bits, step).collect()]
    was, is_ = (t.filter(F.col("_leaf").isin(leaves)) for t in (a, b))
    files = sum(t.select("_metadata.file_path").distinct().count() for t in (was, is_))
    return difference(is_.drop("_leaf"), was.drop("_leaf")), files
