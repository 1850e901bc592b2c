"""Queries on rules: every kind of row rule, the shapes of all entity tables, and the rules across tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.operators import rules
from tracewright.plans import catalogue
from tracewright.registry import query, table

R = rules.Rule


@query(
    """WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, o_orderpriority AS p FROM orders)
SELECT 'format.iri' AS rule_id, k::VARCHAR AS key FROM o WHERE k % 17 = 0 UNION ALL SELECT 'format.uri', k::VARCHAR FROM o WHERE k % 13 = 0 UNION ALL SELECT 'format.reference', k::VARCHAR FROM o WHERE k % 13 = 0 UNION ALL SELECT 'format.date', k::VARCHAR FROM o WHERE k % 28 >= 28 OR k % 31 + 1 > 28
UNION ALL SELECT 'array.unique', k::VARCHAR FROM o WHERE c % 5 = k % 5 UNION ALL SELECT 'array.two', k::VARCHAR FROM o WHERE s = 'P' UNION ALL SELECT 'size.two', k::VARCHAR FROM o WHERE s = 'P' UNION ALL SELECT 'null-or.small', k::VARCHAR FROM o WHERE s <> 'F' AND c > 50
UNION ALL SELECT 'name.local', k::VARCHAR FROM o WHERE k % 19 = 0 UNION ALL SELECT 'header.equal', k::VARCHAR FROM o WHERE c <> k UNION ALL SELECT 'not.urgent', k::VARCHAR FROM o WHERE p = '1-URGENT'"""
)
def rule_formats(spark: SparkSession, d: str) -> DataFrame:
    """Formats, arrays, optional values, local names, equal headers and negations, all from one scan."""
    k, c, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    text = k.cast("string")
    rows = table(spark, d, "orders").select(
        k.alias("id"),
        F.concat(F.when(k % 17 == 0, "x ").otherwise("x:"), text).alias("iri"),
        F.concat(F.lit("https://x.example/"), F.when(k % 13 == 0, "a b").otherwise("ab")).alias("uri"),
        F.concat(F.lit("a"), F.when(k % 13 == 0, "<b>").otherwise("/b")).alias("reference"),
        F.concat(F.lit("2023-02-"), F.lpad((k % 31 + 1).cast("string"), 2, "0")).alias("day"),
        F.array(c % 5, k % 5).alias("pair"),
        F.when(status == "P", F.array(c)).otherwise(F.array(c, -c - 1)).alias("two"),
        F.when(status != "F", c).alias("small"),
        F.concat(F.when(k % 19 == 0, "../").otherwise(""), text).alias("file"),
        c.alias("c"),
        F.col("o_orderpriority").alias("priority"),
    )
    kinds = [
        R("format.iri", "iri", "iri"),
        R("format.uri", "uri", "uri"),
        R("format.reference", "uri_reference", "reference"),
        R("format.date", "date", "day"),
        R("array.unique", "array", "pair", (0, True)),
        R("array.two", "array", "two", (2, False)),
        R("size.two", "size", "two", 2),
        R("null-or.small", "null_or", "small", R("", "max", "small", 50)),
        R("name.local", "local_name", "file"),
        R("header.equal", "equal", "c", "id"),
        R("not.urgent", "not", "priority", R("", "const", "priority", "1-URGENT")),
    ]
    return rules.check(rows, "id", kinds, "order").select("rule_id", "key")


def _shape_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Sixteen kinds of entity tables, of the given ones' rows, each with some rows that break its shape."""
    part, cust, orders, supp, line, events = (table(spark, d, n) for n in ("part", "customer", "orders", "supplier", "lineitem", "events"))
    k = F.col("p_partkey")
    ident = lambda kind, c: F.concat(F.lit(f"{kind}:"), c.cast("string")).alias("id")
    some = lambda bad, x: F.when(~bad, x)
    refs = F.array(F.lit("s"))
    none = F.array().cast("array<string>")
    o, c, s = F.col("o_orderkey"), F.col("c_custkey"), F.col("s_suppkey")
    return {
        "release": supp.select(ident("r", s), F.concat_ws(".", (s % 3).cast("string"), F.when(s % 7 == 0, "x").otherwise("1"), F.lit("0")).alias("version"), F.when(s % 5 == 0, "hold").otherwise("cleared").alias("rights")),
        "subject_group": supp.select(ident("g", s), F.when(s % 6 == 0, " ").otherwise(F.col("s_name")).alias("label"), F.when(s % 4 == 0, "low").otherwise("high").alias("level")),
        "domain": cust.select(ident("d", c), F.col("c_name").alias("label"), some(c % 9 == 0, F.col("c_mktsegment")).alias("course_id")),
        "standard": cust.select(ident("std", c), some(c % 8 == 0, F.col("c_name")).alias("code"), F.lit("c").alias("course_id"), F.lit("d").alias("domain_id"), some(c % 11 == 0, F.struct(F.lit(1).alias("page"))).alias("locator"), (c % 10 == 0).alias("official_text"), F.lit("derived").alias("summary_kind")),
        "locator": line.select(F.concat_ws("-", F.lit("l"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"), F.lit("s").alias("source_id"), (F.col("l_linenumber") - 1).alias("page")),
        "topic": part.select(ident("t", k), F.col("p_name").alias("label"), F.lit("d").alias("domain_id"), F.when(k % 7 == 0, none).otherwise(F.array("p_name")).alias("evidence"), F.when(k % 5 == 0, none).otherwise(F.array("p_type")).alias("prompts"), F.array(F.lit(1)).alias("alignments")),
        "middle_topic": part.select(ident("m", k), F.when(F.col("p_size") > 45, "high").otherwise("middle").alias("level")),
        "cluster": part.select(ident("cl", k), F.col("p_name").alias("label"), F.lit("c").alias("course_id"), F.lit("d").alias("domain_id"), F.array(k % 3, k % 4).alias("topic_ids")),
        "transition": orders.select(ident("tr", o), F.when(o % 5 == 0, none).otherwise(refs).alias("from_topics"), refs.alias("to_topics"), F.when(o % 3 == 0, none).otherwise(refs).alias("from_courses"), refs.alias("to_courses"), F.when(o % 8 == 0, "").otherwise("why").alias("reason"), refs.alias("refs")),
        "course_relation": orders.select(ident("cr", o), (F.col("o_custkey") % 30).alias("src"), (o % 30).alias("dst"), F.when(o % 4 == 0, "official-prerequisite").otherwise("other").alias("kind"), F.when(F.col("o_orderstatus") == "F", "official-constraint").otherwise("candidate").alias("status"), refs.alias("refs")),
        "choice_set": part.select(ident("cs", k), F.when(k % 6 == 0, F.array(k)).otherwise(F.array(k, k + 1)).alias("course_ids"), F.lit(0).alias("least"), F.when(k % 2 == 0, k % 3).alias("most")),
        "credit_rule": orders.select(ident("rule", o), F.concat(F.lit("2023-02-"), F.lpad((o % 31 + 1).cast("string"), 2, "0")).alias("start"), F.lit("least").alias("kind"), F.lit("credit").alias("unit"), (F.col("o_custkey") - 3).alias("value")),
        "pathway": part.select(ident("p", k), (k % 12 != 0).alias("unofficial"), F.when(k % 10 == 0, none).otherwise(refs).alias("steps")),
        "step": part.select(ident("s", k), (k % 4).alias("order"), F.when(k % 3 == 0, none).otherwise(refs).alias("course_ids"), some(k % 5 == 0, F.col("p_type")).alias("choice_set")),
        "source": supp.select(ident("src", s), F.col("s_name").alias("name"), F.when(s % 9 == 0, F.sha1(F.col("s_name").cast("binary"))).otherwise(F.sha2("s_name", 256)).alias("sha256"), F.lit("https://x.example/a").alias("url"), F.concat(F.when(s % 13 == 0, "a/").otherwise("a-"), s.cast("string")).alias("file"), s.alias("bytes")),
        "gap": events.select(ident("gap", F.col("event_id")), F.col("props").alias("description"), F.when(F.col("event_type") == "error", "dire").otherwise("low").alias("severity"), F.lit("open").alias("status")),
    }


@query(
    """WITH v(rule_id, key) AS (
SELECT 'release.version-form', 'r:' || s_suppkey FROM supplier WHERE s_suppkey % 7 = 0 UNION ALL SELECT 'release.rights', 'r:' || s_suppkey FROM supplier WHERE s_suppkey % 5 = 0
UNION ALL SELECT 'subject_group.label', 'g:' || s_suppkey FROM supplier WHERE s_suppkey % 6 = 0 UNION ALL SELECT 'subject_group.level', 'g:' || s_suppkey FROM supplier WHERE s_suppkey % 4 = 0
UNION ALL SELECT 'domain.course_id', 'd:' || c_custkey FROM customer WHERE c_custkey % 9 = 0
UNION ALL SELECT 'standard.code', 'std:' || c_custkey FROM customer WHERE c_custkey % 8 = 0 UNION ALL SELECT 'standard.locator', 'std:' || c_custkey FROM customer WHERE c_custkey % 11 = 0 UNION ALL SELECT 'standard.official', 'std:' || c_custkey FROM customer WHERE c_custkey % 10 = 0
UNION ALL SELECT 'locator.page', 'l-' || l_orderkey || '-' || l_linenumber FROM lineitem WHERE l_linenumber < 2
UNION ALL SELECT 'topic.evidence', 't:' || p_partkey FROM part WHERE p_partkey % 7 = 0 UNION ALL SELECT 'topic.prompts', 't:' || p_partkey FROM part WHERE p_partkey % 5 = 0
UNION ALL SELECT 'middle_topic.level', 'm:' || p_partkey FROM part WHERE p_size > 45 UNION ALL SELECT 'cluster.topics', 'cl:' || p_partkey FROM part WHERE p_partkey % 3 = p_partkey % 4
UNION ALL SELECT 'transition.ends', 'tr:' || o_orderkey FROM orders WHERE o_orderkey % 15 = 0 UNION ALL SELECT 'transition.reason', 'tr:' || o_orderkey FROM orders WHERE o_orderkey % 8 = 0
UNION ALL SELECT 'course_relation.loop', 'cr:' || o_orderkey FROM orders WHERE o_custkey % 30 = o_orderkey % 30 UNION ALL SELECT 'course_relation.claim', 'cr:' || o_orderkey FROM orders WHERE o_orderkey % 4 = 0 AND o_orderstatus <> 'F'
UNION ALL SELECT 'choice_set.courses', 'cs:' || p_partkey FROM part WHERE p_partkey % 6 = 0 UNION ALL SELECT 'choice_set.most', 'cs:' || p_partkey FROM part WHERE p_partkey % 6 = 0
UNION ALL SELECT 'credit_rule.value', 'rule:' || o_orderkey FROM orders WHERE o_custkey < 3 UNION ALL SELECT 'credit_rule.start-form', 'rule:' || o_orderkey FROM orders WHERE o_orderkey % 31 + 1 > 28
UNION ALL SELECT 'pathway.boundary', 'p:' || p_partkey FROM part WHERE p_partkey % 12 = 0 UNION ALL SELECT 'pathway.steps', 'p:' || p_partkey FROM part WHERE p_partkey % 10 = 0
UNION ALL SELECT 'step.order', 's:' || p_partkey FROM part WHERE p_partkey % 4 = 0 UNION ALL SELECT 'step.choice', 's:' || p_partkey FROM part WHERE p_partkey % 15 = 0
UNION ALL SELECT 'source.hash', 'src:' || s_suppkey FROM supplier WHERE s_suppkey % 9 = 0 UNION ALL SELECT 'source.file', 'src:' || s_suppkey FROM supplier WHERE s_suppkey % 13 = 0 UNION ALL SELECT 'source.size', 'src:' || s_suppkey FROM supplier WHERE s_suppkey < 1
UNION ALL SELECT 'gap.severity', 'gap:' || event_id FROM events WHERE event_type = 'error') SELECT rule_id, key FROM v"""
)
def shapes_of_all_kinds(spark: SparkSession, d: str) -> DataFrame:
    """The shapes of sixteen kinds of tables (shape_catalogue has the other two), each checked in one scan."""
    return catalogue.check_tables(_shape_tables(spark, d)).select("rule_id", "key")


_REL = """
WITH r AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 21 = 0 THEN 'official-code-order-candidate-v1' ELSE 'read' END AS basis, CASE WHEN o_orderkey % 22 = 0 THEN 'candidate' ELSE 'internal-reviewed' END AS review,
 CASE WHEN o_orderkey % 23 = 0 THEN 'guess' WHEN o_orderkey % 29 <> 0 THEN 'official-source' END AS basis_kind, o_orderkey % 25 = 0 AS bare, CASE WHEN o_orderkey % 2 = 0 THEN 'required-prerequisite' ELSE 'recommended-before' END AS kind, CASE WHEN o_orderkey % 6 < 3 THEN 'required' ELSE 'recommended' END AS strength, o_custkey AS c, o_orderstatus AS s FROM orders)
"""


def _relations(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        k.alias("id"),
        F.when(k % 21 == 0, catalogue.BANNED_BASIS).otherwise("read").alias("basis"),
        F.when(k % 22 == 0, "candidate").otherwise("internal-reviewed").alias("review"),
        F.when(k % 23 == 0, "guess").when(k % 29 != 0, catalogue.OFFICIAL).alias("basis_kind"),
        F.when(k % 25 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("s"))).alias("refs"),
        F.when(k % 2 == 0, "required-prerequisite").otherwise("recommended-before").alias("kind"),
        F.when(k % 6 < 3, "required").otherwise("recommended").alias("strength"),
        F.when(F.col("o_orderstatus") == "P", "draft").otherwise("reviewed-recommendation").alias("status"),
        F.when(F.col("o_custkey") % 10 == 0, F.array().cast("array<bigint>")).otherwise(F.array("o_custkey")).alias("from_courses"),
        F.array(k).alias("to_courses"),
        F.when(F.col("o_custkey") % 7 == 0, F.array("o_custkey", k)).otherwise(F.array("o_custkey")).alias("from_topics"),
        F.when(F.col("o_custkey") % 9 == 0, F.array().cast("array<bigint>")).otherwise(F.array(k)).alias("to_topics"),
    )


@query(
    _REL
    + """SELECT 'learning.automatic' AS rule_id, k::VARCHAR AS key FROM r WHERE basis <> 'read' OR review = 'candidate' UNION ALL SELECT 'learning.source', k::VARCHAR FROM r WHERE basis_kind IS DISTINCT FROM 'official-source' OR bare
UNION ALL SELECT 'learning.required', k::VARCHAR FROM r WHERE kind = 'required-prerequisite' AND (basis_kind IS DISTINCT FROM 'official-source' OR strength <> 'required') UNION ALL SELECT 'learning.recommended', k::VARCHAR FROM r WHERE kind = 'recommended-before' AND strength <> 'recommended'
UNION ALL SELECT 'learning.reviewed', k::VARCHAR FROM r WHERE k NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'N')"""
)
def learning_governance(spark: SparkSession, d: str) -> DataFrame:
    """Learning relations: no banned basis, no candidates, sourced, of a fitting strength, and each named by a review."""
    rows = _relations(spark, d)
    reviews = table(spark, d, "lineitem").filter("l_returnflag = 'N'").groupBy("l_suppkey").agg(F.collect_set("l_orderkey").alias("targets"))
    return rules.violations(rules.check(rows, "id", catalogue.learning_rules(), "learning"), catalogue.without_review(rows, reviews, "learning")).select("rule_id", "key")


@query(
    _REL
    + """SELECT 'course_relation.provenance' AS rule_id, k::VARCHAR AS key FROM r WHERE s = 'P' OR review = 'candidate' OR basis_kind IS DISTINCT FROM 'official-source' OR bare
UNION ALL SELECT 'course_relation.reviewed', k::VARCHAR FROM r WHERE k NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')"""
)
def group_governance(spark: SparkSession, d: str) -> DataFrame:
    """Relations of groups: fully sourced and reviewed."""
    rows = _relations(spark, d)
    reviews = table(spark, d, "lineitem").filter("l_linestatus = 'F'").groupBy("l_suppkey").agg(F.collect_set("l_orderkey").alias("targets"))
    return rules.violations(rules.check(rows, "id", catalogue.group_rules("course_relation"), "course_relation"), catalogue.without_review(rows, reviews, "course_relation")).select("rule_id", "key")


@query(
    _REL
    + """SELECT 'transition.review' AS rule_id, k::VARCHAR AS key FROM r WHERE review = 'candidate' UNION ALL SELECT 'transition.anchors', k::VARCHAR FROM r WHERE c % 10 = 0 UNION ALL SELECT 'transition.one-from', k::VARCHAR FROM r WHERE c % 7 = 0
UNION ALL SELECT 'transition.one-to', k::VARCHAR FROM r WHERE c % 9 = 0 UNION ALL SELECT 'transition.official', k::VARCHAR FROM r WHERE basis_kind IS DISTINCT FROM 'official-source' OR bare"""
)
def transition_governance(spark: SparkSession, d: str) -> DataFrame:
    """Transitions: reviewed, anchored on both sides, one topic on each, sourced."""
    return rules.check(_relations(spark, d), "id", catalogue.transition_rules(), "transition").select("rule_id", "key")


@query(
    """SELECT 'orders' AS entity, o_orderkey::VARCHAR AS key FROM orders WHERE o_orderkey % 23 = 0 OR o_orderkey % 29 = 0 UNION ALL SELECT 'lines', l_orderkey || '-' || l_linenumber FROM lineitem WHERE l_returnflag = 'A'
UNION ALL SELECT 'parts', p_partkey::VARCHAR FROM part WHERE p_size = 1 UNION ALL SELECT 'customers', c_custkey::VARCHAR FROM customer WHERE c_acctbal < 0"""
)
def official_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges of four tables that aren't from an official source."""
    official = lambda bad: F.when(~bad, catalogue.OFFICIAL).alias("basis_kind")
    tables = {
        "orders": _relations(spark, d),
        "lines": table(spark, d, "lineitem").select(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"), official(F.col("l_returnflag") == "A")),
        "parts": table(spark, d, "part").select(F.col("p_partkey").alias("id"), official(F.col("p_size") == 1)),
        "customers": table(spark, d, "customer").select(F.col("c_custkey").alias("id"), official(F.col("c_acctbal") < 0)),
    }
    return catalogue.official_only(tables).select("entity", "key")


@query(
    """WITH t AS (SELECT p_partkey AS k, CASE p_partkey % 5 WHEN 0 THEN 'standard-core' WHEN 1 THEN 'standard-core' WHEN 2 THEN 'subject-facet' WHEN 3 THEN 'subject-facet' ELSE 'other' END AS d, CASE WHEN p_partkey % 6 <> 0 THEN CASE WHEN p_partkey % 4 = 0 THEN 'core' ELSE 'f' END END AS f, p_size > 25 AS based FROM part)
SELECT 'decomposition.kind' AS rule_id, k::VARCHAR AS key FROM t WHERE d = 'other' OR f IS NULL UNION ALL SELECT 'decomposition.core', k::VARCHAR FROM t WHERE d = 'standard-core' AND f IS DISTINCT FROM 'core' UNION ALL SELECT 'decomposition.basis', k::VARCHAR FROM t WHERE d = 'subject-facet' AND NOT based"""
)
def decomposition(spark: SparkSession, d: str) -> DataFrame:
    """Children of standards: of a known kind, cores with the core's facet, facets with their basis."""
    k = F.col("p_partkey")
    topics = table(spark, d, "part").select(
        k.alias("id"),
        F.when(k % 5 < 2, catalogue.CORE).when(k % 5 < 4, catalogue.FACET).otherwise("other").alias("decomposition"),
        F.when(k % 6 != 0, F.when(k % 4 == 0, "core").otherwise("f")).alias("facet"),
        F.when(F.col("p_size") > 25, F.array(F.lit("x"), F.lit(catalogue.FACET_BASIS))).otherwise(F.array(F.lit("x"))).alias("bases"),
    )
    return rules.check(topics, "id", catalogue.decomposition_rules(), "topic").select("rule_id", "key")


@query("SELECT p_brand || '|' || p_type || '|' || p_name AS key, count(*)::VARCHAR AS detail FROM part GROUP BY p_brand, p_type, p_name HAVING count(*) > 1")
def repeated_identities(spark: SparkSession, d: str) -> DataFrame:
    """Groups, categories and labels that several courses share."""
    courses = table(spark, d, "part").select(F.col("p_brand").alias("group_id"), F.col("p_type").alias("category"), F.col("p_name").alias("label"))
    return catalogue.repeated_identities(courses).select("key", "detail")


@query("SELECT 'few-lines' AS rule_id, l.n || '/' || o.n AS detail FROM (SELECT count(*) AS n FROM lineitem) l, (SELECT count(*) AS n FROM orders) o WHERE NOT l.n BETWEEN 2 * o.n AND 3 * o.n UNION ALL SELECT 'some-lines', l.n || '/' || o.n FROM (SELECT count(*) AS n FROM lineitem) l, (SELECT count(*) AS n FROM orders) o WHERE NOT l.n BETWEEN 2 * o.n AND 5 * o.n")
def children_per_table(spark: SparkSession, d: str) -> DataFrame:
    """Whether a table's rows are within bounds of its parents' rows."""
    orders, line = table(spark, d, "orders"), table(spark, d, "lineitem")
    return rules.violations(catalogue.children_bounds(orders, line, 2, 3, "few-lines", "line"), catalogue.children_bounds(orders, line, 2, 5, "some-lines", "line")).select("rule_id", "detail")


@query("SELECT 'source' AS entity, s_suppkey::VARCHAR AS key, CASE WHEN s_suppkey % 4 = 0 THEN 'hold' END AS detail FROM supplier WHERE s_suppkey % 4 = 0 OR s_suppkey % 5 = 0 UNION ALL SELECT 'release', c_custkey::VARCHAR, 'open' FROM customer WHERE c_acctbal < 0")
def uncleared_rights(spark: SparkSession, d: str) -> DataFrame:
    """Sources and releases whose rights aren't cleared."""
    s = F.col("s_suppkey")
    sources = table(spark, d, "supplier").select(s.alias("id"), F.when(s % 4 == 0, "hold").when(s % 5 != 0, "cleared").alias("rights"))
    releases = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") < 0, "open").otherwise("cleared").alias("rights"))
    return catalogue.uncleared(sources, releases).select("entity", "key", "detail")


@query(
    """WITH n AS (SELECT (SELECT count(*) FROM orders) AS o, (SELECT count(*) FROM lineitem) AS l, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS f)
SELECT 'statistics.stale' AS rule_id, 'high/lines' AS key, (l + 1) || '/' || l AS detail FROM n UNION ALL SELECT 'statistics.stale', 'high/closed', f || '' FROM n UNION ALL SELECT 'statistics.stale', 'high/open', (o - f - 1) || '' FROM n UNION ALL SELECT 'statistics.split', 'high/orders', (o - 1) || '/' || o FROM n"""
)
def stale_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Shown statistics against counts, and a total against its parts."""
    orders, line = table(spark, d, "orders"), table(spark, d, "lineitem")
    count = lambda df, metric, more=0, p=None: df.agg((F.count(F.lit(1)) if p is None else F.count_if(p)).alias("n")).select(F.lit("high").alias("dataset"), F.lit(metric).alias("metric"), (F.col("n") + more).alias("value"))
    closed = F.col("o_orderstatus") == "F"
    counted = count(orders, "orders").union(count(line, "lines"))
    shown = count(orders, "orders").union(count(line, "lines", 1)).union(count(orders, "closed", 0, closed)).union(count(orders, "open", -1, ~closed))
    return catalogue.stale_statistics(shown, counted, {("high", "orders"): ("closed", "open")}).select("rule_id", "key", "detail")


@query("SELECT event_type AS key, count(*)::VARCHAR AS detail FROM events WHERE event_type IN ('error', 'click') GROUP BY 1")
def unresolved_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    """Each type of diagnostics that isn't empty."""
    return catalogue.unresolved(table(spark, d, "events").filter(F.col("event_type").isin("error", "click")).select(F.col("event_type").alias("type"))).select("key", "detail")
