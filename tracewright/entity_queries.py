"""Queries on entities: matches that are required, edges with ids and reviews, orders and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions import text as tx
from tracewright.operators import entities, graph, relations, report, rules, sequence, triples
from tracewright.registry import query, table


@query("SELECT o_orderkey, n_name, n_name IS NOT NULL AS matched FROM orders LEFT JOIN (SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_nationkey % 6 <> 5) ON o_custkey = c_custkey")
def required_matches(spark: SparkSession, d: str) -> DataFrame:
    """Rows with a match, and those without for the diagnostics."""
    nation = table(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    dim = table(spark, d, "customer").filter("c_nationkey % 6 <> 5").join(nation, "c_nationkey").select(F.col("c_custkey").alias("o_custkey"), "n_name")
    found, lost = relations.require_match(table(spark, d, "orders").select("o_orderkey", "o_custkey"), dim, "o_custkey")
    return found.select("o_orderkey", "n_name", F.lit(True).alias("matched")).union(lost.select("o_orderkey", F.lit(None).cast("string"), F.lit(False)))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def restricted_rows(spark: SparkSession, d: str) -> DataFrame:
    """Children of the parents that stay, once each."""
    return relations.restrict(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", table(spark, d, "customer").filter("c_acctbal > 0"), "c_custkey")


@query("SELECT o_orderkey, s AS l_suppkey, s_name FROM (SELECT l_orderkey AS o_orderkey, unnest(list(DISTINCT l_suppkey)) AS s FROM lineitem GROUP BY 1) JOIN supplier ON s = s_suppkey")
def exploded_children(spark: SparkSession, d: str) -> DataFrame:
    """Parents with the children that an array names."""
    orders = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set("l_suppkey").alias("suppliers"))
    return relations.explode_join(orders, table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "suppliers", "l_suppkey")


@query(
    """SELECT o_orderkey AS id, o_custkey AS src, 'order' AS kind, NULL AS dst FROM orders UNION ALL SELECT l_orderkey, l_suppkey, 'line', l_partkey FROM lineitem"""
)
def united_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges of two kinds in one table; a column that one kind lacks is null there."""
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("src"), F.lit("order").alias("kind"))
    line = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"), F.lit("line").alias("kind"))
    return relations.union_edges(orders, line)


_PART_EDGES = "WITH e AS (SELECT 'edge:' || substr(sha256(l_partkey::VARCHAR || '|' || l_suppkey::VARCHAR), 1, 24) AS edge_id, l_partkey AS src, l_suppkey AS dst, l_returnflag AS scope, l_orderkey, l_linenumber FROM lineitem)\n"


def _part_edges(spark: SparkSession, d: str) -> DataFrame:
    line = table(spark, d, "lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"), F.col("l_returnflag").alias("scope"), "l_orderkey", "l_linenumber")
    return entities.finalise_edges(line, "edge:", 24, "src", "dst")


@query(_PART_EDGES + "SELECT edge_id, src, dst, count(*) AS n FROM e GROUP BY ALL")
def finalised_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges with ids that are a function of their ends."""
    return _part_edges(spark, d).groupBy("edge_id", "src", "dst").agg(F.count(F.lit(1)).alias("n"))


@query(_PART_EDGES + "SELECT src AS scope, md5(string_agg(DISTINCT edge_id, ',' ORDER BY edge_id)) AS targets, count(DISTINCT edge_id) AS n FROM e GROUP BY src")
def review_records(spark: SparkSession, d: str) -> DataFrame:
    """What a review of each part's edges has to look at."""
    found = entities.review_records(_part_edges(spark, d).select(F.col("src").alias("scope"), "edge_id"), "scope")
    return found.select("scope", F.md5(F.array_join("targets", ",")).alias("targets"), F.size("targets").cast("long").alias("n"))


@query(
    """WITH g AS (SELECT c_mktsegment || '-' || (c_custkey % 200) AS label, c_custkey AS k FROM customer), u AS (SELECT label, count(DISTINCT k) AS n, CASE WHEN count(DISTINCT k) = 1 THEN min(k) END AS k FROM g GROUP BY 1),
p AS (SELECT o_orderkey AS id, 'BUILDING-' || (o_orderkey % 260) AS f, 'MACHINERY-' || (o_custkey % 230) AS t FROM orders)
SELECT id, a.k AS from_key, b.k AS to_key, CASE WHEN coalesce(a.n, 0) <> 1 THEN 'from-unresolved' WHEN coalesce(b.n, 0) <> 1 THEN 'to-unresolved' ELSE 'ok' END AS state FROM p LEFT JOIN u a ON a.label = f LEFT JOIN u b ON b.label = t"""
)
def progressions(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of labels with both groups' keys, or what is wrong with a label."""
    groups = table(spark, d, "customer").select(F.concat_ws("-", "c_mktsegment", (F.col("c_custkey") % 200).cast("string")).alias("label"), F.col("c_custkey").alias("k"))
    name = lambda segment, c, n: F.concat(F.lit(f"{segment}-"), (F.col(c) % n).cast("string"))
    pairs = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), name("BUILDING", "o_orderkey", 260).alias("from_label"), name("MACHINERY", "o_custkey", 230).alias("to_label"))
    return entities.progressions(pairs, groups, "label", "k").select("id", "from_key", "to_key", "state")


@query("SELECT DISTINCT l_partkey AS from_id, l_suppkey AS to_id, 'follows' AS kind, 'alignment:' || substr(sha256(l_partkey::VARCHAR || '|' || l_suppkey::VARCHAR || '|follows'), 1, 24) AS id FROM lineitem")
def alignments(spark: SparkSession, d: str) -> DataFrame:
    """Edges as alignments with one id in the array at each end."""
    edges = table(spark, d, "lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst")).distinct()
    return entities.alignments(edges, "follows").select(F.get("from_ids", F.lit(0)).alias("from_id"), F.get("to_ids", F.lit(0)).alias("to_id"), "kind", "id")


@query(
    """WITH e AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 9 <> 0 THEN o_custkey END AS f, o_custkey + 20 AS t FROM orders)
SELECT id, coalesce(a.c_name, f::VARCHAR) AS from_label, coalesce(b.c_name, t::VARCHAR) AS to_label FROM e LEFT JOIN customer a ON a.c_custkey = f LEFT JOIN customer b ON b.c_custkey = t"""
)
def transition_index(spark: SparkSession, d: str) -> DataFrame:
    """Transitions with the labels of the first id on each side, the id itself where it has none, nothing where the side is empty."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rows = table(spark, d, "orders").select(k.alias("id"), F.when(k % 9 != 0, F.array(c, c + 1)).otherwise(F.array().cast("array<bigint>")).alias("from_ids"), F.array(c + 20).alias("to_ids"))
    return entities.transition_index(rows, table(spark, d, "customer"), "c_custkey", "c_name").select("id", "from_label", "to_label")


@query("SELECT o_orderkey, coalesce(min(l_linenumber) FILTER (l_returnflag = 'R'), -1)::BIGINT AS first FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1")
def first_or_default(spark: SparkSession, d: str) -> DataFrame:
    """The first of an array, or a default where it is empty."""
    lists = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(F.when(F.col("l_returnflag") == "R", F.col("l_linenumber").cast("long")))).alias("numbers"))
    rows = table(spark, d, "orders").select("o_orderkey").join(lists, "o_orderkey", "left")
    return rows.select("o_orderkey", sequence.first_or("numbers", F.lit(-1)).alias("first"))


@query(
    """WITH r AS (SELECT p_partkey, CASE p_type WHEN 'STANDARD' THEN 0 WHEN 'ECONOMY' THEN 1 ELSE 2 END AS rank, p_name, p_size FROM part)
SELECT p_partkey, rank, row_number() OVER (ORDER BY rank, lower(p_name), p_size DESC, p_partkey) AS place FROM r"""
)
def ranked_parts(spark: SparkSession, d: str) -> DataFrame:
    """The place of each part by several keys: a given order of types, names without regard to case, sizes downwards."""
    part = table(spark, d, "part").withColumn("rank", tx.rank_by("p_type", ["STANDARD", "ECONOMY"]))
    ordered = report.multi_order(part, [("rank", None, True), ("p_name", "UTF8_LCASE", True), ("p_size", None, False), ("p_partkey", None, True)])
    return report.placed(ordered, "place").select("p_partkey", "rank", "place")


@query("SELECT c_custkey, row_number() OVER (ORDER BY lower(c_mktsegment), c_name, c_custkey) AS place FROM customer")
def locale_places(spark: SparkSession, d: str) -> DataFrame:
    """The place of each customer by segment in a locale's order, then by name."""
    return report.placed(report.locale_order(table(spark, d, "customer"), "c_mktsegment", "en", "c_name", "c_custkey"), "place").select("c_custkey", "place")


@query("SELECT s_suppkey, row_number() OVER (ORDER BY s_nationkey, s_suppkey) AS place FROM supplier")
def canonical_places(spark: SparkSession, d: str) -> DataFrame:
    """The place of each row in a sink's order."""
    return report.placed(report.canonical_order(table(spark, d, "supplier"), "s_nationkey", "s_suppkey"), "place").select("s_suppkey", "place")


@query(
    r"""SELECT p_partkey, '10' || p_brand || '01-02' AS code, p_name AS rest, '10' || p_brand AS prefix FROM part WHERE p_size % 5 <> 0"""
)
def bracket_codes(spark: SparkSession, d: str) -> DataFrame:
    """Codes in brackets at the beginning of lines, what follows them, and what stands before their numbers."""
    line = F.concat(F.when(F.col("p_size") % 5 != 0, F.lit(" [10")).otherwise(F.lit("see [10")), F.col("p_brand"), F.lit("01-02]  "), F.col("p_name"))
    rows = table(spark, d, "part").select("p_partkey", tx.bracket_code(line).alias("r")).filter("r IS NOT NULL")
    return rows.select("p_partkey", "r.code", "r.rest", F.regexp_replace("r.code", tx.CODE_NUMBERS, "").alias("prefix"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 1 THEN p_brand ELSE p_type END AS title FROM part")
def clean_titles(spark: SparkSession, d: str) -> DataFrame:
    """Titles without bullets, brackets and kinds of choice; of a pair the one that the prefix names."""
    raw = F.concat(F.lit("- 일반 선택 과목 – "), F.col("p_brand"), F.lit(" , "), F.col("p_type"))
    return table(spark, d, "part").select("p_partkey", tx.clean_title(raw, F.concat(F.lit("12x"), F.when(F.col("p_size") % 2 == 1, "1").otherwise("2"))).alias("title"))


@query("SELECT o_orderkey, o_orderkey % 3 = 0 AS cited FROM orders")
def page_citations(spark: SparkSession, d: str) -> DataFrame:
    """Whether a reference ends with a page."""
    k = F.col("o_orderkey")
    cited = F.when(k % 3 == 0, tx.citation(F.col("o_orderpriority"), k)).otherwise(F.concat(F.col("o_orderpriority"), F.lit(" page "), k.cast("string")))
    return table(spark, d, "orders").select("o_orderkey", tx.has_page_citation(cited).alias("cited"))


@query("SELECT n, n > 20 AS decoded_other, n % 5 AS region FROM (SELECT n_nationkey AS n FROM nation JOIN (SELECT DISTINCT c_nationkey FROM customer) ON n_nationkey = c_nationkey)")
def decoded_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys by a small dictionary, with a default for those that it lacks."""
    known = {n: n % 5 for n in range(21)}
    rows = table(spark, d, "customer").select(F.col("c_nationkey").alias("n")).distinct()
    found = tx.decode("n", known, -1)
    return rows.select("n", (found == -1).alias("decoded_other"), F.when(found == -1, F.col("n") % 5).otherwise(found).cast("long").alias("region"))


@query("SELECT p_partkey, CASE WHEN p_size > 40 THEN ['legend'] WHEN p_size > 30 THEN ['ending'] ELSE [] END::VARCHAR AS hits FROM part")
def leaked_texts(spark: SparkSession, d: str) -> DataFrame:
    """Texts of a code's legend, and noun forms put on twice."""
    text = F.concat("p_name", F.when(F.col("p_size") > 40, " 두 자리 수로 제시한다").when(F.col("p_size") > 30, " 표현수행하기").otherwise(""))
    return table(spark, d, "part").select("p_partkey", F.concat(F.lit("["), F.array_join(tx.leak_hits(text), ", "), F.lit("]")).alias("hits"))


@query(r"""SELECT page_id, len(regexp_extract_all(html, '(?:href|src)="https?://'))::INT AS links, regexp_matches(html, '(?i)<(?:script|link|img)[^>]+(?:src|href)=["'']https?://|@import\s+url\([''"]?https?://') AS loads FROM pages""")
def outside_links(spark: SparkSession, d: str) -> DataFrame:
    """Addresses outside a page, and whether it loads anything from there."""
    return table(spark, d, "pages").select("page_id", tx.external_links("html").alias("links"), tx.loads_outside("html").alias("loads"))


@query("WITH RECURSIVE e AS (SELECT DISTINCT l_partkey % 50 AS src, 100 + l_suppkey % 50 AS dst FROM lineitem), c AS (SELECT DISTINCT l_suppkey % 10 AS src, l_partkey % 10 AS dst FROM lineitem) SELECT 'layers' AS name, false AS cyclic UNION ALL SELECT 'mixed', EXISTS (SELECT 1 FROM c a JOIN c b ON a.dst = b.src AND b.dst = a.src)")
def cycles(spark: SparkSession, d: str) -> DataFrame:
    """Whether edges hold a cycle: from layer to layer they can't, among the same nodes they do."""
    line = table(spark, d, "lineitem")
    layers = line.select((F.col("l_partkey") % 50).alias("src"), (100 + F.col("l_suppkey") % 50).alias("dst"))
    mixed = line.select((F.col("l_suppkey") % 10).alias("src"), (F.col("l_partkey") % 10).alias("dst"))
    return spark.createDataFrame([("layers", graph.has_cycle(layers)), ("mixed", graph.has_cycle(mixed))], "name string, cyclic boolean")


@query("SELECT 'customer:' || c_custkey AS s, 'https://example.org/ns#label' AS p, c_name AS o FROM customer UNION ALL SELECT 'customer:' || c_custkey, 'segment', c_mktsegment FROM customer UNION ALL SELECT 'customer:' || c_custkey, 'https://example.org/ns#type', 'Customer' FROM customer")
def expanded_names(spark: SparkSession, d: str) -> DataFrame:
    """Predicates with their full names, where the context has one."""
    rows = triples.to_triples(table(spark, d, "customer"), F.concat(F.lit("customer:"), F.col("c_custkey").cast("string")), "Customer", {"c_name": ("label", None), "c_mktsegment": ("segment", None)})
    context = spark.createDataFrame([(n, f"https://example.org/ns#{n}") for n in ("label", "type")], "name string, iri string")
    return triples.expand_names(rows, context).select("s", "p", "o")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 0")
def asserted_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of which each must fulfil a predicate, else the job fails."""
    return rules.assert_all(table(spark, d, "lineitem"), F.col("l_quantity") > 0, "a line without quantity").select("l_orderkey", "l_linenumber")


@query("""SELECT o_orderkey, '{"customer":{"key":' || o_custkey || ',"names":["' || o_orderpriority || '"]},"status":"' || o_orderstatus || '"}' AS json FROM orders""")
def canonical_documents(spark: SparkSession, d: str) -> DataFrame:
    """JSON with sorted keys at every depth."""
    value = F.struct(F.col("o_orderstatus").alias("status"), F.struct(F.array("o_orderpriority").alias("names"), F.col("o_custkey").alias("key")).alias("customer"))
    rows = table(spark, d, "orders").select("o_orderkey", value.alias("v"))
    return rows.select("o_orderkey", tx.canonical_json("v", rows.schema["v"].dataType).alias("json"))
