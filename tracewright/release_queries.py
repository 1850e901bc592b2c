"""Queries on files, collections and releases: what is written from the given tables is read back and compared."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.operators import entities, relations, release, report, sketches
from tracewright.registry import query, table
from tracewright.sources import files
from tracewright.storage import shared_dir


def _place(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _customer_files(spark: SparkSession, d: str) -> DataFrame:
    """Binary files of the customers' lines, a file for each thousand of keys; those of every fifth hold a header instead of names first."""
    rows = table(spark, d, "customer").select(F.floor(F.col("c_custkey") / 1000).cast("long").alias("part"), "c_custkey", F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment").alias("value"))
    path = _place(spark, "lines")
    rows.repartition("part").sortWithinPartitions("part", "c_custkey").select("part", "value").write.partitionBy("part").text(path)
    return files.binary_files(spark, path, "*.txt").select(F.concat(F.lit("part="), F.regexp_extract("path", r"/part=(\d+)/", 1)).alias("file"), "path", "content")


_FILES = """
WITH f AS (SELECT 'part=' || (c_custkey // 1000)::VARCHAR AS file, string_agg(c_custkey::VARCHAR || '|' || c_name || '|' || c_mktsegment, chr(10) ORDER BY c_custkey) || chr(10) AS x FROM customer GROUP BY 1)
"""


@query(_FILES + "SELECT file, octet_length(encode(x))::BIGINT AS bytes, sha256(x) AS sha256, starts_with(x, '1') AS one FROM f")
def file_inventory(spark: SparkSession, d: str) -> DataFrame:
    """Sizes and digests of files, and whether each begins with a given byte."""
    found = _customer_files(spark, d)
    listed = files.file_inventory(found.select(F.col("file").alias("path"), "content")).withColumnRenamed("path", "file")
    return listed.join(found.select("file", files.magic_is(b"1").alias("one")), "file")


@query(_FILES + "SELECT count(*) AS files, sum(octet_length(encode(x)))::BIGINT AS total_bytes FROM f WHERE file <> 'part=0'")
def file_totals(spark: SparkSession, d: str) -> DataFrame:
    """The text files outside an excluded folder."""
    found = files.scan_files(_customer_files(spark, d), ["txt", "md"], ["part=0"])
    return files.total_bytes(files.file_inventory(found))


@query(_FILES + "SELECT file, (substr(file, 6)::BIGINT % 7)::BIGINT AS annex, octet_length(encode(x))::BIGINT AS bytes, sha256(x) AS sha256 FROM f WHERE substr(file, 6)::BIGINT % 3 <> 1")
def file_receipts(spark: SparkSession, d: str) -> DataFrame:
    """Catalogue rows with the size and digest of their files; a catalogue needn't list all."""
    number = F.substring("file", 6, 20).cast("long")
    catalog = table(spark, d, "customer").select(F.concat(F.lit("part="), F.floor(F.col("c_custkey") / 1000).cast("long").cast("string")).alias("file")).distinct()
    catalog = catalog.filter(number % 3 != 1).withColumn("annex", number % 7)
    inventory = files.file_inventory(_customer_files(spark, d).select(F.col("file").alias("path"), "content")).withColumnRenamed("path", "file")
    return files.receipts(inventory, catalog, "file")


@query("SELECT s_suppkey, s_name, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def provenance(spark: SparkSession, d: str) -> DataFrame:
    """Rows with the source that they come from, read by name from one profile."""
    t = files.read_profile(spark, d, ["supplier", "nation", "region"])
    sources = files.with_provenance(t["nation"], t["region"].withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey").withColumnRenamed("n_nationkey", "s_nationkey")
    return files.with_provenance(t["supplier"], sources, "s_nationkey").select("s_suppkey", "s_name", "n_name", "r_name")


@query("WITH n AS (SELECT p_brand, p_partkey // 500 AS part, count(*) AS n FROM part GROUP BY 1, 2) SELECT p_brand AS profile, 'r1' AS release_id, n AS record_count, p_partkey AS id, p_name AS label FROM part JOIN n USING (p_brand) WHERE p_partkey // 500 = n.part")
def collection_records(spark: SparkSession, d: str) -> DataFrame:
    """Records of JSON envelopes, an envelope a line: parts by brand, at most 500 keys in each."""
    part = table(spark, d, "part")
    record = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("label"))
    sheets = part.groupBy(F.col("p_brand").alias("profile"), F.floor(F.col("p_partkey") / 500).alias("sheet")).agg(F.count(F.lit(1)).alias("recordCount"), F.collect_list(record).alias("records"))
    path = _place(spark, "collection")
    sheets.select("profile", F.lit("r1").alias("releaseId"), F.lit("part").alias("recordType"), "recordCount", "records").write.json(path)
    kind = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", T.StringType())])
    return files.read_collection(spark, path, kind, multi_line=False).select("profile", "release_id", "record_count", "id", "label")


_SPECS = """
WITH s AS (SELECT s_nationkey, s_suppkey, 'A' || (s_suppkey % 40) AS a, 'A' || (s_suppkey % 17) AS b, s_suppkey % 1600 AS page, s_name AS t, s_suppkey % 3 AS list, row_number() OVER (PARTITION BY s_nationkey, s_suppkey % 3 ORDER BY s_suppkey) - 1 AS place FROM supplier),
specs AS (SELECT 'nation-' || s_nationkey AS subject, 'annex-' || (s_nationkey % 5) AS annex, CASE WHEN s_nationkey % 2 = 0 THEN 'high' ELSE 'middle' END AS level,
 CASE list WHEN 0 THEN 'middleRequired' WHEN 1 THEN 'elementaryToMiddleRequired' ELSE 'highCommentaryRequired' END AS kind, place, CASE list WHEN 1 THEN 5 ELSE 4 END AS arity, a AS from_code, b AS to_code, page::INT AS page, t AS text, CASE WHEN list = 1 THEN 'd' END AS domain FROM s)
"""


def _spec_modules(spark: SparkSession, d: str) -> DataFrame:
    """Edge-spec modules written as JSON, a module a nation, and read back as rows."""
    k = F.col("s_suppkey")
    a, b, page, text = F.concat(F.lit("A"), (k % 40).cast("string")), F.concat(F.lit("A"), (k % 17).cast("string")), (k % 1600).cast("string"), F.col("s_name")
    tuples = {"middleRequired": F.array(a, b, text, page), "elementaryToMiddleRequired": F.array(a, b, F.lit("d"), page, text), "highCommentaryRequired": F.array(a, b, page, text)}
    lists = [F.transform(F.array_sort(F.collect_list(F.when(k % 3 == n, F.struct(k.alias("k"), t.alias("t"))))), lambda x: x["t"]).alias(name) for n, (name, t) in enumerate(tuples.items())]
    modules = table(spark, d, "supplier").groupBy("s_nationkey").agg(*lists)
    n = F.col("s_nationkey")
    named = modules.select(F.concat(F.lit("nation-"), n.cast("string")).alias("subject"), F.concat(F.lit("annex-"), (n % 5).cast("string")).alias("annexId"), F.when(n % 2 == 0, "high").otherwise("middle").alias("level"), *tuples)
    path = _place(spark, "specs")
    named.write.json(path)
    return files.edge_specs(spark, path, multi_line=False)


@query(_SPECS + 'SELECT * REPLACE (place::INT AS place) FROM specs')
def edge_spec_rows(spark: SparkSession, d: str) -> DataFrame:
    """The tuples of all modules' lists as one table."""
    return _spec_modules(spark, d)


@query(
    _SPECS
    + """, known AS (SELECT DISTINCT 'A' || (s_suppkey % 37) AS code, 'annex-' || (s_suppkey % 5) AS annex FROM supplier), r AS (SELECT *, subject || '/' || kind || '/' || place AS key, row_number() OVER (PARTITION BY subject, from_code, to_code ORDER BY kind, place) AS nth FROM specs)
SELECT 'spec.loop' AS rule_id, key, from_code || ' ' || to_code AS detail FROM r WHERE from_code = to_code
UNION ALL SELECT 'spec.page', key, page::VARCHAR FROM r WHERE NOT page BETWEEN 1 AND 1499
UNION ALL SELECT 'spec.text', key, text FROM r WHERE length(text) > CASE WHEN kind = 'elementaryToMiddleRequired' THEN 80 ELSE 17 END
UNION ALL SELECT 'spec.pair', key, from_code || ' ' || to_code FROM r WHERE nth > 1
UNION ALL SELECT 'spec.level', key, kind FROM r WHERE level = 'high' AND kind IN ('middleRequired', 'elementaryToMiddleRequired')
UNION ALL SELECT 'spec.code', key, c FROM (SELECT key, from_code AS c FROM r WHERE kind <> 'elementaryToMiddleRequired' UNION ALL SELECT key, to_code FROM r) WHERE c NOT IN (SELECT code FROM known)
UNION ALL SELECT 'spec.own', key, annex FROM r WHERE kind = 'highCommentaryRequired' AND NOT EXISTS (SELECT 1 FROM known WHERE known.annex = r.annex AND code IN (from_code, to_code))"""
)
def spec_module_rules(spark: SparkSession, d: str) -> DataFrame:
    """Rules of edge-spec modules: arity, codes that are known, pages, lengths, loops, repeated pairs, empty lists of high modules, an end of one's own."""
    from tracewright.plans.catalogue import module_violations

    k = F.col("s_suppkey")
    known = table(spark, d, "supplier").select(F.concat(F.lit("A"), (k % 37).cast("string")).alias("code"), F.concat(F.lit("annex-"), (k % 5).cast("string")).alias("annex")).distinct()
    return module_violations(_spec_modules(spark, d), known, longest=17).select("rule_id", "key", "detail")


@query("SELECT 'r7' AS release_id, 'customer' AS dataset, count(*) AS value FROM customer UNION ALL SELECT 'r7', 'orders', count(*) FROM orders UNION ALL SELECT 'r7', 'supplier', count(*) FROM supplier")
def release_counts(spark: SparkSession, d: str) -> DataFrame:
    """Tables written as a release, one of them by profile, and counted from what was written."""
    tables = {n: table(spark, d, n) for n in ("customer", "orders", "supplier")}
    return files.write_release(tables, "r7", _place(spark, "release"), "c_mktsegment")


def _versions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return orders, orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 1000 == 7, "X").otherwise(F.col("o_orderstatus")))


@query(
    """WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders), b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 1000 = 7 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders)
SELECT 'stale' AS name, (SELECT count(*) FROM (FROM a EXCEPT ALL FROM b)) > 0 AS holds UNION ALL SELECT 'stale-columns', true UNION ALL SELECT 'same-in-other-order', true UNION ALL SELECT 'deterministic', true UNION ALL SELECT 'no-learners', true UNION ALL SELECT 'no-orders', false"""
)
def release_checks(spark: SparkSession, d: str) -> DataFrame:
    """Whether a stored version is stale, a build repeats itself, and a data set is absent."""
    now, stored = _versions(spark, d)
    held = {
        "stale": release.is_stale(now, stored),
        "stale-columns": release.is_stale(now, now.drop("o_custkey")),
        "same-in-other-order": release.same_multiset(now, now.orderBy(F.desc("o_custkey"))),
        "deterministic": release.is_deterministic(lambda: now.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderstatus").alias("most")), 3),
        "no-learners": files.forbid_dataset(spark, f"{d}/learners.parquet"),
        "no-orders": files.forbid_dataset(spark, f"{d}/orders.parquet"),
    }
    return spark.createDataFrame(list(held.items()), "name string, holds boolean")


@query("SELECT 'customer' AS dataset, 'changed' AS state UNION ALL SELECT 'supplier', 'same' UNION ALL SELECT 'orders', 'missing' UNION ALL SELECT 'part', 'unlisted'")
def manifest_states(spark: SparkSession, d: str) -> DataFrame:
    """A stored manifest against the tables as they are now."""
    cust, supp, orders, part = (table(spark, d, n) for n in ("customer", "supplier", "orders", "part"))
    stored = release.manifest({"customer": cust, "supplier": supp, "orders": orders})
    return release.verify_manifest(stored, release.manifest({"customer": cust.filter("c_custkey > 1"), "supplier": supp.orderBy(F.desc("s_suppkey")), "part": part}))


@query("SELECT 'customer' AS dataset, true AS moved UNION ALL SELECT 'part', true")
def stale_bridges(spark: SparkSession, d: str) -> DataFrame:
    """Pins that no longer name what a dataset is: one has changed, one is gone."""
    t = {n: table(spark, d, n) for n in ("customer", "supplier", "orders", "part")}
    pins = release.manifest(t).select("dataset", "hash_xor")
    now = release.manifest({"customer": t["customer"].filter("c_custkey > 1"), "supplier": t["supplier"], "orders": t["orders"]})
    return release.stale_bridges(pins, now).select("dataset", F.lit(True).alias("moved"))


@query("SELECT l_orderkey FROM (SELECT DISTINCT l_orderkey FROM lineitem) WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')")
def orphans(spark: SparkSession, d: str) -> DataFrame:
    """What is stored and no longer listed."""
    listed = table(spark, d, "orders").filter("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return release.orphans(table(spark, d, "lineitem").select("l_orderkey").distinct(), listed, "l_orderkey")


@query(
    """WITH c AS (SELECT c_mktsegment AS release_id, count(*) AS n, count(DISTINCT c_nationkey) AS nations FROM customer GROUP BY 1)
SELECT release_id, unnest(['customers', 'kept', 'nations']) AS metric, unnest([n, 1, nations]) AS value FROM c"""
)
def refreshed_release(spark: SparkSession, d: str) -> DataFrame:
    """Releases whose counts are brought up to date; those without news stay."""
    cust = table(spark, d, "customer")
    by = cust.groupBy(F.col("c_mktsegment").alias("release_id")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("c_nationkey").alias("m"))
    old = by.select("release_id", F.map_from_arrays(F.array(F.lit("customers"), F.lit("kept")), F.array(F.lit(0), F.lit(1)).cast("array<long>")).alias("counts"))
    news = by.select("release_id", F.lit("customers").alias("metric"), F.col("n").alias("value")).union(by.select("release_id", F.lit("nations"), "m"))
    return entities.refresh_release(old, news).select("release_id", F.explode("counts").alias("metric", "value"))


@query("SELECT n_nationkey, n_name, c.k IS NOT NULL AS received, coalesce(c.n, 0)::BIGINT AS bytes FROM nation LEFT JOIN (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_nationkey % 4 <> 2 GROUP BY 1) c ON n_nationkey = c.k")
def source_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Catalogue rows with what was received of each."""
    got = table(spark, d, "customer").filter("c_nationkey % 4 <> 2").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("bytes"))
    return entities.source_manifest(table(spark, d, "nation").select("n_nationkey", "n_name"), got, "n_nationkey").select("n_nationkey", "n_name", "received", F.coalesce("bytes", F.lit(0)).alias("bytes"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT -c_custkey, 'N' FROM customer")
def replaced_rows(spark: SparkSession, d: str) -> DataFrame:
    """A part of a table replaced by new rows."""
    new = table(spark, d, "customer").select((-F.col("c_custkey")).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"))
    return entities.replace_rows(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), F.col("o_orderstatus") != "P", new)


@query("SELECT 'line-order' AS name, o.n AS expected, l.n::DECIMAL(38,0) AS actual, o.n = l.n AS holds FROM (SELECT count(*) AS n FROM lineitem) o, (SELECT sum(k) AS n FROM (SELECT count(*) AS k FROM lineitem GROUP BY l_orderkey)) l")
def reconciled_sum(spark: SparkSession, d: str) -> DataFrame:
    """A sum of parts against a total."""
    line = table(spark, d, "lineitem")
    parts = line.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    found = report.reconcile_sum(parts, "n", line.count())
    return found.select(F.lit("line-order").alias("name"), F.col("expected").cast("long").alias("expected"), F.col("actual").cast("decimal(38,0)").alias("actual"), "holds")


@query(
    """WITH r AS (SELECT p_partkey AS a, p_partkey + 1 AS b FROM part), c AS (SELECT p_partkey, f, v FROM (SELECT p_partkey, unnest(['p_brand', 'p_name', 'p_size', 'p_type']) AS f, unnest([p_brand, p_name, p_size::VARCHAR, p_type]) AS v FROM part))
SELECT f AS field, max(CASE WHEN p_partkey = (SELECT min(p_partkey) FROM part) THEN v END) AS a, max(CASE WHEN p_partkey = (SELECT max(p_partkey) FROM part) THEN v END) AS b FROM c GROUP BY f"""
)
def compared_rows(spark: SparkSession, d: str) -> DataFrame:
    """The first and the last part side by side."""
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_name", "p_size", "p_type")
    low, high = part.agg(F.min("p_partkey"), F.max("p_partkey")).first()
    return relations.compare_rows(part, "p_partkey", low, high)


_EDITED = """
WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders),
b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 997 = 3 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 1201 <> 5 UNION ALL SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 1999 = 7)
"""


def _edited_orders(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Two releases of the orders: a few rows are changed, lost and added."""
    a, key = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"), F.col("o_orderkey")
    b = a.filter(key % 1201 != 5).withColumn("o_orderstatus", F.when(key % 997 == 3, "X").otherwise(F.col("o_orderstatus")))
    return a, b.union(a.filter(key % 1999 == 7).withColumn("o_orderkey", -1 - key))


def _stored_orders(spark: SparkSession, d: str) -> list[str]:
    paths = []
    for df in _edited_orders(spark, d):
        paths.append(_place(spark, "hashed"))
        release.write_hashed(df, ["o_orderkey"], paths[-1], bits=6, step=2)
    return paths


_LEAF = "('0x' || substr(md5(o_orderkey::VARCHAR), 1, 15))::BIGINT >> 54"
_ROW = "o_orderkey::VARCHAR || '|' || o_custkey::VARCHAR || '|' || o_orderstatus || '|' || o_orderpriority"


@query(
    _EDITED
    + f""", x AS (SELECT {_LEAF} AS node, string_agg(r, chr(10) ORDER BY r) AS rows FROM (SELECT *, {_ROW} AS r FROM a) GROUP BY 1), y AS (SELECT {_LEAF} AS node, string_agg(r, chr(10) ORDER BY r) AS rows FROM (SELECT *, {_ROW} AS r FROM b) GROUP BY 1)
SELECT coalesce(x.node, y.node)::BIGINT AS node, CASE WHEN y.node IS NULL THEN 'lost' WHEN x.node IS NULL THEN 'added' ELSE 'changed' END AS change FROM x FULL JOIN y ON x.node = y.node WHERE x.rows IS DISTINCT FROM y.rows"""
)
def changed_ranges(spark: SparkSession, d: str) -> DataFrame:
    """The ranges of key hashes in which two stored releases differ, from their hash trees alone."""
    before, now = (release.read_hashed(spark, p)[1] for p in _stored_orders(spark, d))
    return release.changed_ranges(before, now, bits=6, step=2)


@query(_EDITED + "SELECT 'new' AS side, * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) UNION ALL SELECT 'stored', * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)")
def changed_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows that only one of two stored releases has; only files of ranges that differ are read."""
    return release.changed_rows(spark, *_stored_orders(spark, d), bits=6, step=2)[0]


_EITHER = "SELECT 'new' AS side, * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) UNION ALL SELECT 'stored', * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)"


@query(_EDITED + _EITHER)
def sparse_difference(spark: SparkSession, d: str) -> DataFrame:
    """Few rows differ: the table of cells shows which."""
    before, now = _edited_orders(spark, d)
    return sketches.sparse_difference(now, before)


@query(
    "WITH a AS (SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem), b AS (SELECT l_orderkey, CASE WHEN l_orderkey % 3 = 0 THEN l_partkey + 1 ELSE l_partkey END AS l_partkey, l_returnflag FROM lineitem WHERE l_linenumber < 6) " + _EITHER
)
def dense_difference(spark: SparkSession, d: str) -> DataFrame:
    """A third of the rows differs, more than so small a table of cells can show: ranges of hashes are compared."""
    rows = table(spark, d, "lineitem")
    part = F.when(F.col("l_orderkey") % 3 == 0, F.col("l_partkey") + 1).otherwise(F.col("l_partkey"))
    now = rows.filter("l_linenumber < 6").select("l_orderkey", part.alias("l_partkey"), "l_returnflag")
    return sketches.sparse_difference(now, rows.select("l_orderkey", "l_partkey", "l_returnflag"), cells=64)


@query("SELECT 'second' AS current, 'nation' AS dataset, count(*) AS n FROM nation WHERE n_nationkey <> 3 UNION ALL SELECT 'second', 'supplier', count(*) FROM supplier WHERE s_nationkey <> 3 UNION ALL SELECT 'first', 'nation', count(*) FROM nation UNION ALL SELECT 'first', 'supplier', count(*) FROM supplier")
def published_releases(spark: SparkSession, d: str) -> DataFrame:
    """A release, and a second one that becomes the current one; both stay readable."""
    root, nation, supplier = _place(spark, "published"), table(spark, d, "nation"), table(spark, d, "supplier")
    files.publish_release({"nation": nation, "supplier": supplier}, "first", root)
    files.publish_release({"nation": nation.filter("n_nationkey <> 3"), "supplier": supplier.filter("s_nationkey <> 3")}, "second", root)
    out = None
    for name in (None, "first"):
        for dataset, df in files.read_release(spark, root, ["nation", "supplier"], name).items():
            part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name or files.current_release(spark, root)).alias("current"), F.lit(dataset).alias("dataset"), "n")
            out = part if out is None else out.union(part)
    return out
