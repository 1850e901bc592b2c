"""Registered queries on the given tables, each with the same question in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions import text as tx
from tracewright.operators import entities, graph, keys, questions, relations, release, report, rules, scans, search, sequence, triples
from tracewright.registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]


def doc_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.normalised(sequence.lines(table(spark, sf_dir, "documents").select("doc_id", "text"))).drop("line")


# --- lines and their context -------------------------------------------------------------------------------------------

_LINES = r"""
WITH a AS (SELECT doc_id, regexp_split_to_array(text, '\r?\n') AS l FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, generate_subscripts(l, 1)::INT AS line_no, trim(regexp_replace(replace(unnest(l), chr(12), ''), '[\s\x0b\x85\p{Z}]+', ' ', 'g')) AS norm FROM a)
"""


@query(_LINES + "SELECT doc_id, line_no, norm FROM lines")
def doc_lines(spark: SparkSession, d: str) -> DataFrame:
    return doc_text_lines(spark, d)


@query(_LINES + r"SELECT doc_id, line_no, (1 + sum(CASE WHEN norm = '' OR norm LIKE '%.' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no))::BIGINT AS page FROM lines")
def line_page_counter(spark: SparkSession, d: str) -> DataFrame:
    return sequence.running_count(doc_text_lines(spark, d), r"^\z|\.\z", "page", line="norm").select("doc_id", "line_no", "page")


_SHORT = "CASE WHEN length(norm) BETWEEN 1 AND 40 THEN norm END"


@query(_LINES + f"SELECT doc_id, line_no, last_value({_SHORT} IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS heading FROM lines")
def line_heading_asof(spark: SparkSession, d: str) -> DataFrame:
    return sequence.carry_last(doc_text_lines(spark, d), F.expr(_SHORT), "heading").select("doc_id", "line_no", "heading")


@query(_LINES + f"SELECT doc_id, line_no, last_value({_SHORT} IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 80 PRECEDING AND 1 PRECEDING) AS heading FROM lines")
def line_heading_bounded(spark: SparkSession, d: str) -> DataFrame:
    return sequence.carry_last(doc_text_lines(spark, d), F.expr(_SHORT), "heading", 80, False).select("doc_id", "line_no", "heading")


@query(
    _LINES
    + r"""
, g AS (SELECT doc_id, line_no, norm, list(norm) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) AS after FROM lines),
h AS (SELECT doc_id, line_no, norm, coalesce(after, []) AS after,
  list_position(list_transform(coalesce(after, []), lambda x: x = ''), true) AS stop,
  list_position(list_transform(coalesce(after, []), lambda x: regexp_matches(x, '[.!?]$')), true) AS fin FROM g)
SELECT doc_id, line_no, array_to_string(list_concat([norm], after[1:least(CASE WHEN coalesce(stop, 0) > 0 THEN stop - 1 ELSE 99 END, CASE WHEN coalesce(fin, 0) > 0 THEN fin ELSE 99 END)]), ' ') AS statement FROM h
"""
)
def statement_fold(spark: SparkSession, d: str) -> DataFrame:
    return sequence.fold_forward(doc_text_lines(spark, d), "statement", 7, F.col("norm") == "", F.lit(False), r"[.!?]\z", line="norm").select("doc_id", "line_no", "statement")


@query(
    _LINES
    + r"""
, m AS (SELECT doc_id, line_no, norm,
  last_value(CASE WHEN length(norm) BETWEEN 1 AND 55 AND NOT regexp_matches(norm, '[.!?]$') THEN norm END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 90 PRECEDING AND 1 PRECEDING) AS section_title,
  last_value(CASE WHEN norm LIKE '%!!%' THEN 'shouted' WHEN norm LIKE '%|%' THEN 'table' WHEN length(norm) > 300 THEN 'long' END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 120 PRECEDING AND 1 PRECEDING) AS section_category
  FROM lines)
SELECT * FROM m WHERE regexp_matches(norm, '^[^ ]+\.$')
"""
)
def section_starts(spark: SparkSession, d: str) -> DataFrame:
    norm = F.col("norm")
    title = F.when(F.length(norm).between(1, 55) & ~norm.rlike(r"[.!?]\z"), norm)
    category = F.coalesce(tx.first_match("norm", [("!!", "shouted"), (r"\|", "table")]), F.when(F.length(norm) > 300, "long"))
    return sequence.section_starts(doc_text_lines(spark, d), norm.rlike(r"^[^ ]+\.\z"), title, category)


# --- text ----------------------------------------------------------------------------------------------------------------


@query("WITH a AS (SELECT page_id, regexp_extract_all(html, 'href=\"([^\"]*)\"', 1) AS l FROM pages) SELECT page_id, generate_subscripts(l, 1)::INT - 1 AS position, unnest(l) AS href FROM a")
def href_extract(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "pages").select("page_id", F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)).alias("hrefs"))
    return sequence.positions(found, "hrefs", "href")


@query(r"SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path, coalesce(try_cast(nullif(regexp_extract(url, '((?:19|20)\d{2})', 1), '') AS INT), 2022) AS year FROM pages")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "pages").select("page_id", tx.url_parts("url").alias("u"), tx.year_of("url", 2022).alias("year"))
    return rows.select("page_id", "u.host", "u.path", "year")


@query(
    r"""SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)licen[sc]e') THEN 'legal' WHEN regexp_matches(text, '[0-9]{6,}') THEN 'numeric' WHEN regexp_matches(text, ' \| ') THEN 'table'
    WHEN regexp_matches(text, '(?i) the ') THEN 'english' WHEN regexp_matches(text, '(?i) que ') THEN 'romance' ELSE 'conceptual' END AS kind FROM documents"""
)
def topic_type_classify(spark: SparkSession, d: str) -> DataFrame:
    order = [("(?i)licen[sc]e", "legal"), ("[0-9]{6,}", "numeric"), (r" \| ", "table"), ("(?i) the ", "english"), ("(?i) que ", "romance")]
    return table(spark, d, "documents").select("doc_id", tx.first_match("text", order, "conceptual").alias("kind"))


@query(
    _LINES
    + r"""
, r AS (SELECT doc_id, CASE WHEN regexp_matches(norm, 'ing\.$') THEN regexp_replace(norm, 'ing\.$', 'e') WHEN regexp_matches(norm, 'ed\.$') THEN regexp_replace(norm, 'ed\.$', '') WHEN regexp_matches(norm, '\.$') THEN regexp_replace(norm, '\.$', '') ELSE norm END AS s, line_no FROM lines)
SELECT doc_id, line_no, CASE WHEN length(s) = 0 THEN 'empty' WHEN length(s) > 60 THEN regexp_replace(substr(s, 1, 56), '\s+\S*$', '') || '…' ELSE s END AS summary FROM r
"""
)
def suffix_rewrite(spark: SparkSession, d: str) -> DataFrame:
    rewritten = tx.rewrite_first("norm", [(r"ing\.\z", "e"), (r"ed\.\z", ""), (r"\.\z", "")])
    rows = doc_text_lines(spark, d).select("doc_id", "line_no", rewritten.alias("s"))
    return rows.select("doc_id", "line_no", tx.truncate_words("s", 60, 56, "empty").alias("summary"))


@query("SELECT doc_id, 'doc:' || substr(sha256(coalesce(lang, '') || '|' || coalesce(source, '') || '|' || coalesce(text, '')), 1, 16) AS id FROM documents")
def content_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", tx.content_id("doc:", 16, "lang", "source", "text").alias("id"))


@query(r"SELECT p_partkey, p_name, p_brand, list_aggregate(list_transform(regexp_extract_all(lower(p_brand), '([0-9]+|[^0-9]+)', 1), lambda x: CASE WHEN regexp_matches(x, '^[0-9]') THEN lpad(x, 12, '0') ELSE x END), 'string_agg', '') AS brand_key FROM part")
def natural_sort_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", "p_name", "p_brand", tx.natural_key("p_brand").alias("brand_key"))


_SCAN = {"e-mail": r"[A-Za-z0-9._]+@[A-Za-z0-9.]+\.[a-z]{2,}", "phone": r"\+[0-9]{1,2} \([0-9]{3}\) [0-9]{3}-[0-9]{4}", "card": r"[^0-9][0-9]{16}[^0-9]"} | tx.SECRETS


@query(
    "WITH t AS (SELECT 'documents' AS origin, doc_id::VARCHAR AS id, text AS x FROM documents UNION ALL SELECT 'conversations', conv_id::VARCHAR || '-' || turn::VARCHAR, text FROM conversations UNION ALL SELECT 'pages', page_id::VARCHAR, html FROM pages) "
    + " UNION ALL ".join(f"SELECT origin, id, '{n}' AS hit FROM t WHERE regexp_matches(x, '{p}')" for n, p in _SCAN.items())
)
def secret_scan(spark: SparkSession, d: str) -> DataFrame:
    rows = [
        table(spark, d, "documents").select(F.lit("documents").alias("origin"), F.col("doc_id").cast("string").alias("id"), F.col("text").alias("x")),
        table(spark, d, "conversations").select(F.lit("conversations").alias("origin"), F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), F.col("text").alias("x")),
        table(spark, d, "pages").select(F.lit("pages").alias("origin"), F.col("page_id").cast("string").alias("id"), F.col("html").alias("x")),
    ]
    return entities.union_all(rows).select("origin", "id", F.explode(tx.pattern_hits("x", _SCAN)).alias("hit"))


@query("""SELECT page_id, len(regexp_extract_all(html, '(?:href|src)="https?://'))::INT AS links, regexp_matches(html, '(?i)<script[^>]+src=') AS scripts FROM pages""")
def external_links(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", tx.external_links("html").alias("links"), F.col("html").rlike("(?i)<script[^>]+src=").alias("scripts"))


@query("SELECT doc_id, line_no, coalesce(length(trim(norm)) = 0 OR length(norm) > 80 OR regexp_matches(norm, '[.!?]\\s*$'), true) AS suspicious, regexp_matches(norm, '[\"“][^\"“”]{60,}[\"”]') AS quoted FROM (" + _LINES + " SELECT * FROM lines)")
def suspicious_labels(spark: SparkSession, d: str) -> DataFrame:
    return doc_text_lines(spark, d).select("doc_id", "line_no", tx.suspicious_label("norm").alias("suspicious"), tx.long_quote("norm").alias("quoted"))


@query("SELECT p_partkey, 'https://example.org/part/' || replace(p_name, ' ', '%20') || '/' || p_partkey::VARCHAR AS iri, substr(sha256(p_name), 1, 20) AS bucket, printf('%.2f', p_retailprice) AS price FROM part")
def part_iris(spark: SparkSession, d: str) -> DataFrame:
    name = tx.iri("https://example.org/part/", "p_name")
    return table(spark, d, "part").select("p_partkey", F.concat(name, F.lit("/"), F.col("p_partkey").cast("string")).alias("iri"), tx.bucket_name("p_name").alias("bucket"), tx.fixed("p_retailprice").alias("price"))


# --- keys and duplicates -------------------------------------------------------------------------------------------------


@query(
    r"""WITH n AS (SELECT *, md5(lower(trim(regexp_replace(replace(coalesce(text, ''), chr(12), ''), '[\s\x0b\x85\p{Z}]+', ' ', 'g')))) AS h FROM documents)
SELECT h, min(doc_id) AS doc_id, min_by(lang, doc_id) AS lang, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, count(*) - 1 AS repeats FROM n GROUP BY h"""
)
def dedup_first_merge(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", F.md5(F.lower(tx.norm_ws(F.coalesce("text", F.lit(""))))).alias("h"))
    kept = keys.dedup_first(docs, ["h"], [F.col("doc_id")], {"source": "sources"})
    return kept.select("h", "doc_id", "lang", F.array_join("sources", ",").alias("sources"), "repeats")


@query(
    """WITH f AS (SELECT *, first_value(o_totalprice) OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) AS kept_value FROM orders)
SELECT o_orderkey, o_custkey, o_totalprice, kept_value FROM f WHERE o_totalprice IS DISTINCT FROM kept_value"""
)
def dedup_conflicts(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return keys.dedup_conflicts(orders, ["o_custkey", "o_orderdate"], [F.col("o_orderkey")], "o_totalprice").drop("o_orderdate")


_EDGES = """
WITH e AS (SELECT c_nationkey AS src, s_nationkey AS dst, o_orderpriority AS kind, l_orderkey * 10 + l_linenumber AS seq, l_partkey, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)
"""


def nation_edges(spark: SparkSession, d: str) -> DataFrame:
    line = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.col("o_orderpriority").alias("kind"))
    cust = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("src"))
    supp = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("dst"))
    rows = line.join(orders, "l_orderkey").join(cust, "o_custkey").join(supp, "l_suppkey")
    return rows.select("src", "dst", "kind", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), "l_partkey", "l_suppkey")


@query(
    _EDGES
    + """, r AS (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY CASE kind WHEN '1-URGENT' THEN 30 WHEN '2-HIGH' THEN 20 ELSE 10 END DESC, seq, l_partkey, l_suppkey) AS k FROM e)
SELECT src, dst, CASE kind WHEN '1-URGENT' THEN 30 WHEN '2-HIGH' THEN 20 ELSE 10 END AS rank, seq FROM r WHERE k = 1"""
)
def priority_dedup_edges(spark: SparkSession, d: str) -> DataFrame:
    rank = F.when(F.col("kind") == "1-URGENT", 30).when(F.col("kind") == "2-HIGH", 20).otherwise(10)
    kept = keys.priority_dedup(nation_edges(spark, d), ["src", "dst"], rank, [F.col("seq"), F.col("l_partkey"), F.col("l_suppkey")])
    return kept.select("src", "dst", rank.alias("rank"), "seq")


@query("SELECT 'lineitem' AS entity, l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS key, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1 UNION ALL SELECT 'documents', md5(text), count(*) FROM documents GROUP BY text HAVING count(*) > 1")
def pk_duplicates(spark: SparkSession, d: str) -> DataFrame:
    line = keys.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]).select(F.lit("lineitem").alias("entity"), F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("key"), "n")
    docs = keys.duplicate_keys(table(spark, d, "documents").select(F.md5("text").alias("key")), ["key"]).select(F.lit("documents").alias("entity"), "key", "n")
    return line.union(docs)


@query("WITH s AS (SELECT l_orderkey, count(*) AS size FROM lineitem GROUP BY 1) SELECT size, count(*) AS groups, (SELECT min(size) FROM s) AS least, (SELECT max(size) FROM s) AS most, (SELECT avg(size) FROM s) AS mean FROM s GROUP BY size")
def group_size_histogram(spark: SparkSession, d: str) -> DataFrame:
    line = table(spark, d, "lineitem").select("l_orderkey")
    stats = keys.size_stats(line, "l_orderkey").drop("groups")
    return keys.size_histogram(line, "l_orderkey").join(F.broadcast(stats))  # one row of statistics


@query("SELECT o_custkey, count(*) FILTER (o_orderstatus = 'P') AS n, CASE WHEN count(*) FILTER (o_orderstatus = 'P') = 1 THEN min(o_orderkey) FILTER (o_orderstatus = 'P') END AS o_orderkey FROM orders GROUP BY 1")
def exactly_one_open_order(spark: SparkSession, d: str) -> DataFrame:
    return keys.exactly_one(table(spark, d, "orders"), "o_custkey", F.col("o_orderstatus") == "P", "o_orderkey")


@query("SELECT l_orderkey, count(l_returnflag) - count(DISTINCT l_returnflag) AS repeated, bool_or(l_returnflag = 'N') AS has FROM lineitem GROUP BY 1 HAVING count(l_returnflag) > count(DISTINCT l_returnflag) OR NOT bool_or(l_returnflag = 'N')")
def unique_subkeys(spark: SparkSession, d: str) -> DataFrame:
    return keys.unique_subkey(table(spark, d, "lineitem"), "l_orderkey", "l_returnflag", "N")


# --- entities ------------------------------------------------------------------------------------------------------------


@query(
    """SELECT n_regionkey, c_mktsegment, 'segment:' || substr(sha256(n_regionkey::VARCHAR || '|' || c_mktsegment), 1, 16) AS id, count(*) AS records, min_by(c_name, c_custkey) AS c_name,
 string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS nations FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey, c_mktsegment"""
)
def entity_dims(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").join(table(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey").withColumn("nations", F.array("n_name"))
    dims = entities.dimension(rows, ["n_regionkey", "c_mktsegment"], "segment:", 16, [F.col("c_custkey")], ["c_name"], "nations")
    return dims.withColumn("nations", F.array_join("nations", ","))


@query(
    """WITH f(p_type, facet, label) AS (SELECT DISTINCT p_type, 'size-' || (p_size % 3)::VARCHAR, lower(p_type) || ' ' || (p_size % 3)::VARCHAR FROM part),
c AS (SELECT p_partkey::VARCHAR AS parent, 'core' AS facet, NULL AS label FROM part UNION ALL SELECT p_partkey::VARCHAR, facet, label FROM part JOIN f USING (p_type))
SELECT parent, facet, label, 'child:' || substr(sha256(parent || '|' || facet), 1, 20) AS id FROM c"""
)
def facet_explode(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").withColumn("key", F.col("p_partkey").cast("string"))
    third = (F.col("p_size") % 3).cast("string")
    facets = part.select("p_type", F.concat(F.lit("size-"), third).alias("facet"), F.concat(F.lower("p_type"), F.lit(" "), third).alias("label")).distinct()
    return entities.children(part, facets, "p_type", "key", "child:")


@query("SELECT p_brand, p_partkey // 1000 AS sheet, md5(string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey)) AS members, count(*) AS n FROM part GROUP BY 1, 2")
def cluster_collect(spark: SparkSession, d: str) -> DataFrame:
    """Members of clusters of bounded size: a brand's parts by thousands of keys."""
    part = table(spark, d, "part").withColumn("sheet", F.floor(F.col("p_partkey") / 1000).cast("long"))
    rows = keys.collect_ids(part, ["p_brand", "sheet"], "p_partkey", "ids")
    return rows.select("p_brand", "sheet", F.md5(F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")).alias("members"), F.size("ids").cast("long").alias("n"))


@query("SELECT p_brand, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS options, count(DISTINCT p_type)::INT AS n FROM part WHERE p_size > 10 GROUP BY 1 HAVING count(DISTINCT p_type) > 1")
def choice_sets(spark: SparkSession, d: str) -> DataFrame:
    return entities.choice_sets(table(spark, d, "part"), "p_brand", "p_type", F.col("p_size") > 10).withColumn("options", F.array_join("options", ","))


@query(
    """WITH g AS (SELECT p_brand, p_size, list_sort(list_distinct(list(p_partkey) FILTER (p_retailprice < 1000))) AS f, list_sort(list_distinct(list(p_partkey) FILTER (p_retailprice >= 1000))) AS o FROM part GROUP BY 1, 2),
s AS (SELECT p_brand, p_size, 1 AS ord, 'foundation' AS kind, f AS items FROM g WHERE len(f) > 0 UNION ALL SELECT p_brand, p_size, CASE WHEN len(coalesce(f, [])) > 0 THEN 2 ELSE 1 END, 'alternatives', o FROM g WHERE len(o) > 0),
x AS (SELECT p_brand || '/' || p_size::VARCHAR AS path, ord, kind, generate_subscripts(items, 1) AS pos, unnest(items) AS p_partkey FROM s)
SELECT path, ord AS "order", kind, string_agg(p_name, ',' ORDER BY pos) AS labels FROM x JOIN part USING (p_partkey) GROUP BY path, ord, kind"""
)
def pathway_steps(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").withColumn("path", F.concat(F.col("p_brand"), F.lit("/"), F.col("p_size").cast("string")))
    low = F.col("p_retailprice") < 1000
    groups = part.groupBy("path").agg(F.array_sort(F.collect_set(F.when(low, F.col("p_partkey")))).alias("f"), F.array_sort(F.collect_set(F.when(~low, F.col("p_partkey")))).alias("o"))
    steps = entities.label_steps(entities.pathways(groups, "path", "f", "o"), "path", part, "p_partkey", "p_name")
    return steps.select("path", "order", "kind", F.array_join("labels", ",").alias("labels"))


@query(
    """WITH y AS (SELECT o_custkey, year(o_orderdate) AS yr, min_by(o_orderkey, (o_orderdate, o_orderkey)) AS f, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS l FROM orders GROUP BY 1, 2)
SELECT a.o_custkey::VARCHAR || '-' || a.yr::VARCHAR AS from_key, b.o_custkey::VARCHAR || '-' || b.yr::VARCHAR AS to_key, a.l AS from_value, b.f AS to_value FROM y a JOIN y b ON a.o_custkey = b.o_custkey AND b.yr = a.yr + 1"""
)
def boundary_pairs(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", F.year("o_orderdate").alias("yr"))
    name = lambda yr: F.concat_ws("-", F.col("o_custkey").cast("string"), yr.cast("string"))
    keyed = orders.withColumn("key", name(F.col("yr")))
    pairs = orders.select(name(F.col("yr")).alias("from_key"), name(F.col("yr") + 1).alias("to_key")).distinct()
    return sequence.boundary_pairs(keyed, "key", [F.col("o_orderdate")], "o_orderkey", pairs)


@query(
    """WITH n AS (SELECT c_custkey, c_name, c_nationkey FROM customer) SELECT c_custkey, c_name, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_orders, (SELECT count(*) FROM supplier WHERE s_nationkey = c_custkey) AS n_suppliers FROM n"""
)
def index_rows(spark: SparkSession, d: str) -> DataFrame:
    cust = table(spark, d, "customer").select("c_custkey", "c_name")
    return entities.index_rows(cust, "c_custkey", {"n_orders": (table(spark, d, "orders"), "o_custkey"), "n_suppliers": (table(spark, d, "supplier"), "s_nationkey")})


@query(
    """WITH o AS (SELECT o_custkey, list_sort(list({'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus})) AS orders FROM orders GROUP BY 1)
SELECT c_custkey, to_json({'c_custkey': c_custkey, 'c_name': c_name, 'orders': coalesce(orders, [])})::VARCHAR AS detail FROM customer LEFT JOIN o ON c_custkey = o_custkey"""
)
def detail_rows(spark: SparkSession, d: str) -> DataFrame:
    cust = table(spark, d, "customer").select("c_custkey", "c_name")
    return entities.detail_documents(cust, "c_custkey", {"orders": (table(spark, d, "orders"), "o_custkey", ["o_orderkey", "o_orderstatus"])})


@query("SELECT c_custkey, n, (SELECT count(*) FROM orders o WHERE o.o_custkey = c_custkey AND o_orderstatus = 'O') AS rows FROM (SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n FROM customer) WHERE n <> (SELECT count(*) FROM orders o WHERE o.o_custkey = c_custkey AND o_orderstatus = 'O')")
def index_vs_detail(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    index = entities.index_rows(table(spark, d, "customer").select("c_custkey"), "c_custkey", {"n": (orders, "c_custkey")})
    return release.index_vs_detail(index, orders.filter("o_orderstatus = 'O'"), "c_custkey", "n")


# --- relations -----------------------------------------------------------------------------------------------------------


_SPECS = """
WITH n AS (SELECT min(n_nationkey) AS k, count(DISTINCT n_nationkey) AS c, regexp_replace(n_name, '[\\s\\[\\]]+', '', 'g') AS code FROM nation GROUP BY 3),
s AS (SELECT s_suppkey, '[ ' || n_name || ' ]' AS from_code, 'NATION_' || (s_suppkey % 30)::VARCHAR AS to_code FROM supplier JOIN nation ON s_nationkey = n_nationkey)
"""


@query(
    _SPECS
    + """SELECT s_suppkey, CASE WHEN a.c = 1 THEN a.k END AS src, CASE WHEN b.c = 1 THEN b.k END AS dst,
CASE WHEN a.k IS NULL THEN 'from-unknown' WHEN a.c > 1 THEN 'from-ambiguous' WHEN b.k IS NULL THEN 'to-unknown' WHEN b.c > 1 THEN 'to-ambiguous' ELSE 'ok' END AS state
FROM s LEFT JOIN n a ON a.code = regexp_replace(from_code, '[\\s\\[\\]]+', '', 'g') LEFT JOIN n b ON b.code = to_code"""
)
def spec_resolve(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation")
    supp = table(spark, d, "supplier").join(nation.withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey")
    specs = supp.select("s_suppkey", F.concat(F.lit("[ "), "n_name", F.lit(" ]")).alias("from_code"), F.concat(F.lit("NATION_"), (F.col("s_suppkey") % 30).cast("string")).alias("to_code"))
    return relations.edges_from_specs(specs, nation, "n_name", "n_nationkey", tx.compact).select("s_suppkey", "src", "dst", "state")


@query(
    _EDGES
    + """SELECT CASE WHEN src = dst THEN 'same-nation' WHEN a.n_regionkey = b.n_regionkey THEN 'same-region' ELSE 'cross-region' END AS scope, kind, count(*) AS n
FROM e JOIN nation a ON src = a.n_nationkey JOIN nation b ON dst = b.n_nationkey GROUP BY ALL"""
)
def edge_scope(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    rows = nation_edges(spark, d).join(n.select(F.col("n_nationkey").alias("src"), F.col("n_regionkey").alias("ra")), "src").join(n.select(F.col("n_nationkey").alias("dst"), F.col("n_regionkey").alias("rb")), "dst")
    scope = F.when(F.col("src") == F.col("dst"), "same-nation").otherwise(tx.edge_scope("ra", "rb", "same-region", "cross-region"))
    return rows.groupBy(scope.alias("scope"), "kind").agg(F.count(F.lit(1)).alias("n"))


@query(_EDGES + "SELECT n_nationkey AS node, count(DISTINCT seq) AS degree FROM nation LEFT JOIN (SELECT src AS k, seq FROM e UNION SELECT dst, seq FROM e) ON n_nationkey = k GROUP BY 1")
def endpoint_attach(spark: SparkSession, d: str) -> DataFrame:
    nodes = table(spark, d, "nation").select(F.col("n_nationkey").alias("node"))
    return graph.degree(nodes, nation_edges(spark, d), "seq")


@query(_EDGES + "SELECT src, count(*) AS loops FROM e WHERE src = dst GROUP BY 1")
def self_loops(spark: SparkSession, d: str) -> DataFrame:
    return relations.self_loops(nation_edges(spark, d)).groupBy("src").agg(F.count(F.lit(1)).alias("loops"))


@query(
    """SELECT 'order-customer' AS rule, o_custkey::VARCHAR AS ref, count(*) AS rows FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY o_custkey
UNION ALL SELECT 'line-order', l_orderkey::VARCHAR, count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_orderkey
UNION ALL SELECT 'line-part', l_partkey::VARCHAR, count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 1) GROUP BY l_partkey
UNION ALL SELECT 'line-supplier', l_suppkey::VARCHAR, count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY l_suppkey
UNION ALL SELECT 'order-suppliers', k::VARCHAR, count(*) FROM (SELECT DISTINCT l_orderkey, l_suppkey AS k FROM lineitem) WHERE k NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY k"""
)
def fk_violations(spark: SparkSession, d: str) -> DataFrame:
    line, orders, part, supp = (table(spark, d, n) for n in ("lineitem", "orders", "part", "supplier"))
    arrays = line.groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("suppliers"))
    return entities.union_all(
        [
            relations.fk_violations(orders, "o_custkey", table(spark, d, "customer"), "c_custkey", "order-customer"),
            relations.fk_violations(line, "l_orderkey", orders.filter("o_orderstatus <> 'P'"), "o_orderkey", "line-order"),
            relations.fk_violations(line, "l_partkey", part.filter("p_size > 1"), "p_partkey", "line-part"),
            relations.fk_violations(line, "l_suppkey", supp, "s_suppkey", "line-supplier"),
            relations.fk_array_violations(arrays, "suppliers", supp.filter("s_acctbal > 0"), "s_suppkey", "order-suppliers"),
        ]
    )


@query("SELECT 'left' AS side, doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'right', doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def review_coverage(spark: SparkSession, d: str) -> DataFrame:
    return relations.coverage_both_ways(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id")


@query("SELECT c_custkey, o_orderkey, o_orderkey IS NULL AS without FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P') ON c_custkey = o_custkey")
def left_optional(spark: SparkSession, d: str) -> DataFrame:
    urgent = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return table(spark, d, "customer").select("c_custkey").join(urgent, "c_custkey", "left").withColumn("without", F.col("o_orderkey").isNull())


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')")
def not_exists(spark: SparkSession, d: str) -> DataFrame:
    urgent = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return relations.missing_keys(table(spark, d, "customer").select("c_custkey"), urgent, "c_custkey").join(table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey")


@query("WITH a AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS evidence, string_split(p_brand, '#') AS prompts FROM part) SELECT p_partkey, evidence, unnest(prompts) AS prompt FROM a")
def cross_values(spark: SparkSession, d: str) -> DataFrame:
    topics = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.split("p_name", " ").alias("evidence"), F.split("p_brand", "#").alias("prompts"))
    return questions.evidence_prompts({"topic": topics}).withColumnRenamed("topic", "p_partkey")


@query("SELECT s_suppkey, s_name, CASE WHEN n_nationkey % 7 = 0 THEN s_nationkey::VARCHAR ELSE n_name END AS nation FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def enrich_fallback(spark: SparkSession, d: str) -> DataFrame:
    dim = table(spark, d, "nation").filter("n_nationkey % 7 <> 0").withColumnRenamed("n_nationkey", "s_nationkey")
    return relations.enrich(table(spark, d, "supplier"), dim, "s_nationkey", "n_name", "nation").select("s_suppkey", "s_name", "nation")


@query("SELECT s_suppkey, CASE WHEN s_nationkey < 10 THEN s_nationkey + 100 ELSE s_nationkey END AS s_nationkey FROM supplier")
def replacements(spark: SparkSession, d: str) -> DataFrame:
    mapping = table(spark, d, "nation").filter("n_nationkey < 10").select(F.col("n_nationkey").alias("old"), (F.col("n_nationkey") + 100).alias("new"))
    return relations.apply_replacements(table(spark, d, "supplier"), "s_nationkey", mapping).select("s_suppkey", "s_nationkey")


@query("WITH s AS (SELECT o_custkey, list(DISTINCT o_orderpriority) AS p FROM orders GROUP BY 1) SELECT o_custkey, o AS option FROM (SELECT o_custkey, unnest(p) AS o FROM s WHERE list_contains(p, '1-URGENT')) WHERE o <> '1-URGENT'")
def alternatives(spark: SparkSession, d: str) -> DataFrame:
    sets = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("options"))
    return relations.alternatives(sets, "o_custkey", "options", "1-URGENT")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate <= TIMESTAMP '1997-06-01' AND (o_orderstatus = 'O' OR TIMESTAMP '1997-06-01' <= o_orderdate + INTERVAL 90 DAY)")
def orders_in_force(spark: SparkSession, d: str) -> DataFrame:
    end = F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate") + F.expr("INTERVAL 90 DAYS"))
    rows = table(spark, d, "orders").withColumn("effective_from", F.col("o_orderdate")).withColumn("effective_to", end)
    return relations.in_force(rows, F.lit("1997-06-01").cast("timestamp")).select("o_orderkey", "o_custkey")


# --- graphs --------------------------------------------------------------------------------------------------------------


def _tree(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").filter("p_partkey > 0").select(F.floor(F.col("p_partkey") / 2).cast("long").alias("src"), F.col("p_partkey").alias("dst"))


@query(
    """WITH RECURSIVE e AS (SELECT p_partkey // 2 AS src, p_partkey AS dst FROM part WHERE p_partkey > 0), r AS (SELECT src AS start, dst AS node FROM e UNION SELECT r.start, e.dst FROM r JOIN e ON r.node = e.src)
SELECT (SELECT count(*) FROM r WHERE start = node) AS unpeeled, (SELECT count(*) FROM e) AS edges"""
)
def graph_peel_ok(spark: SparkSession, d: str) -> DataFrame:
    tree = _tree(spark, d)
    return graph.peel(tree).agg(F.count(F.lit(1)).alias("unpeeled")).join(F.broadcast(tree.agg(F.count(F.lit(1)).alias("edges"))))  # one row each


_DAYS = """WITH RECURSIVE t AS (SELECT user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
e AS (SELECT DISTINCT prev AS src, event_type AS dst FROM t WHERE prev IS NOT NULL AND prev < event_type UNION SELECT DISTINCT event_type, 'day-' || (user_id % 50)::VARCHAR FROM events WHERE event_type > 'p' UNION SELECT DISTINCT 'day-' || (user_id % 50)::VARCHAR, 'hour-' || hour(ts)::VARCHAR FROM events
  UNION SELECT DISTINCT 'hour-' || hour(ts)::VARCHAR, 'day-' || (user_id % 10)::VARCHAR FROM events WHERE user_id % 50 < 5),
r AS (SELECT src AS start, dst AS node FROM e UNION SELECT r.start, e.dst FROM r JOIN e ON r.node = e.src)"""


def _day_edges(spark: SparkSession, d: str) -> DataFrame:
    """Steps between kinds of events lead upwards only; days and hours point at each other."""
    from pyspark.sql import Window

    events = table(spark, d, "events")
    day, hour = (lambda n: F.concat(F.lit("day-"), (F.col("user_id") % n).cast("string"))), F.concat(F.lit("hour-"), F.hour("ts").cast("string"))
    steps = events.select(F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("src"), F.col("event_type").alias("dst")).filter("src < dst")
    parts = [steps, events.filter("event_type > 'p'").select("event_type", day(50)), events.select(day(50), hour), events.filter("user_id % 50 < 5").select(hour, day(10))]
    edges = parts[0]
    for p in parts[1:]:
        edges = edges.union(p)
    return edges.distinct()


@query(
    _DAYS
    + """, c AS (SELECT DISTINCT start FROM r WHERE start = node)
SELECT start AS node FROM c UNION SELECT r.node FROM r JOIN c ON r.start = c.start"""
)
def graph_peel_cycle(spark: SparkSession, d: str) -> DataFrame:
    """Days and hours, which point at each other, and what follows them stay."""
    return graph.peel(_day_edges(spark, d))


@query(_DAYS + " SELECT a.start AS node, min(a.node) AS component FROM r a JOIN r b ON a.start = b.node AND a.node = b.start GROUP BY 1")
def graph_components(spark: SparkSession, d: str) -> DataFrame:
    """All steps in Spark rounds: no edges are searched in one task."""
    return graph.strong_components(_day_edges(spark, d), local=0)


_HANDED = """WITH RECURSIVE e AS (SELECT DISTINCT c_nationkey * 7 + o_orderkey % 7 AS src, CASE WHEN o_orderkey % 11 = 0 THEN (c_nationkey // 3) * 7 + o_orderkey % 5 ELSE c_nationkey * 7 + o_orderkey % 7 + 1 + o_orderkey % 3 END AS dst FROM orders JOIN customer ON o_custkey = c_custkey),
r AS (SELECT src AS start, dst AS node FROM e UNION SELECT r.start, e.dst FROM r JOIN e ON r.node = e.src), c AS (SELECT a.start AS node, min(a.node) AS component FROM r a JOIN r b ON a.start = b.node AND a.node = b.start GROUP BY 1)"""


@query(_HANDED + " SELECT c.component, count(DISTINCT c.node) AS nodes, min((src, dst))[1] AS from_node, min((src, dst))[2] AS to_node FROM c JOIN e ON e.src = c.node JOIN c x ON e.dst = x.node AND x.component = c.component GROUP BY 1")
def cycle_witnesses(spark: SparkSession, d: str) -> DataFrame:
    """Steps mostly lead on by one to three numbers, a ladder; some lead back."""
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    key, nation = F.col("o_orderkey"), F.col("c_nationkey")
    dst = F.when(key % 11 == 0, F.floor(nation / 3) * 7 + key % 5).otherwise(nation * 7 + key % 7 + 1 + key % 3)
    edges = rows.select((nation * 7 + key % 7).cast("long").alias("src"), dst.cast("long").alias("dst")).distinct()
    return graph.cycle_witnesses(edges, graph.strong_components(edges))


@query(
    """WITH RECURSIVE e AS (SELECT DISTINCT 'k' || k AS sub, 'k' || k // 2 AS super FROM (SELECT n_nationkey + 1 AS k FROM nation UNION SELECT (n_nationkey + 1) // 2 FROM nation) WHERE k > 1),
r AS (SELECT sub, super FROM e UNION SELECT r.sub, e.super FROM r JOIN e ON r.super = e.sub), t AS (SELECT 'customer:' || c_custkey AS s, 'k' || (c_nationkey + 1) AS type FROM customer)
SELECT s, type FROM t UNION SELECT s, super FROM t JOIN r ON type = sub"""
)
def subclass_closure(spark: SparkSession, d: str) -> DataFrame:
    """Nations as a hierarchy of classes, five levels deep."""
    k = F.col("n_nationkey") + 1
    keys = table(spark, d, "nation").select(F.explode(F.array(k, F.floor(k / 2).cast("int"))).alias("k")).filter("k > 1").distinct()
    name = lambda c: F.concat(F.lit("k"), c.cast("string"))
    subclass = keys.select(name(F.col("k")).alias("sub"), name(F.floor(F.col("k") / 2)).alias("super"))
    types = table(spark, d, "customer").select(F.concat(F.lit("customer:"), F.col("c_custkey").cast("string")).alias("s"), name(F.col("c_nationkey") + 1).alias("type"))
    return triples.infer_subclass(types, subclass)


@query(
    """WITH RECURSIVE m AS (SELECT p_partkey AS old, p_partkey + 1 + p_size % 2 AS new FROM part WHERE p_partkey % 13 < 9),
r AS (SELECT old, new FROM m UNION SELECT r.old, m.new FROM r JOIN m ON r.new = m.old), f AS (SELECT old, new FROM r WHERE new NOT IN (SELECT old FROM m))
SELECT l_orderkey, l_linenumber, coalesce(new, l_partkey) AS l_partkey FROM lineitem LEFT JOIN f ON l_partkey = old"""
)
def replacement_chains(spark: SparkSession, d: str) -> DataFrame:
    """Parts are replaced by the next or the one after it, which may be replaced too."""
    part = table(spark, d, "part").filter("p_partkey % 13 < 9")
    mapping = relations.replacement_ends(part.select(F.col("p_partkey").alias("old"), (F.col("p_partkey") + 1 + F.col("p_size") % 2).alias("new")))
    return relations.apply_replacements(table(spark, d, "lineitem"), "l_partkey", mapping).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT o_orderkey, (10 + sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) OVER (ORDER BY o_orderkey))::BIGINT AS urgent, last_value(CASE WHEN o_totalprice > 300000 THEN o_custkey END IGNORE NULLS) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_large, last_value(CASE WHEN o_orderstatus = 'P' THEN o_custkey END IGNORE NULLS) OVER (ORDER BY o_orderkey ROWS BETWEEN 25 PRECEDING AND CURRENT ROW) AS near_open FROM orders")
def one_long_document(spark: SparkSession, d: str) -> DataFrame:
    """All orders as the lines of one document, scanned in blocks of 512."""
    rows = table(spark, d, "orders").withColumn("document", F.lit("orders"))
    pick = lambda cond: F.when(cond, F.col("o_custkey"))
    wanted = {"urgent": scans.Total((F.col("o_orderpriority") == "1-URGENT").cast("long"), 10), "last_large": scans.Carry(pick(F.col("o_totalprice") > 300000), None, False), "near_open": scans.Carry(pick(F.col("o_orderstatus") == "P"), 25)}
    return scans.context(rows, wanted, "document", "o_orderkey", 512).select("o_orderkey", *wanted)


@query(
    """WITH e AS (SELECT p_partkey // 2 AS src, p_partkey AS dst FROM part WHERE p_partkey > 0 AND p_size > 5), n AS (SELECT p_partkey AS node FROM part)
SELECT (SELECT count(*) FROM n) AS nodes, (SELECT count(*) FROM n WHERE node IN (SELECT src FROM e) OR node IN (SELECT dst FROM e)) AS participants, (SELECT count(*) FROM n WHERE node NOT IN (SELECT dst FROM e)) AS roots,
(SELECT count(*) FROM n WHERE node NOT IN (SELECT dst FROM e) AND node NOT IN (SELECT src FROM e)) AS isolated, (SELECT count(*) FROM e) AS edges"""
)
def graph_roots_coverage(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    edges = part.filter("p_partkey > 0 AND p_size > 5").select(F.floor(F.col("p_partkey") / 2).cast("long").alias("src"), F.col("p_partkey").alias("dst"))
    return graph.graph_coverage(part.select(F.col("p_partkey").alias("node")), edges)


@query(
    """WITH e AS (SELECT p_partkey // 2 AS src, p_partkey AS dst FROM part WHERE p_partkey > 0), b AS (SELECT src AS node, 'after' AS direction, dst AS other FROM e UNION ALL SELECT dst, 'before', src FROM e)
SELECT node, direction, other, CASE WHEN p_size > 10 THEN p_name ELSE other::VARCHAR END AS label FROM b JOIN part ON other = p_partkey"""
)
def graph_neighbours(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "part").filter("p_size > 10").select(F.col("p_partkey").alias("node"), F.col("p_name").alias("label"))
    return graph.neighbours(_tree(spark, d), labels)


# --- reports -------------------------------------------------------------------------------------------------------------


@query("SELECT 'l_returnflag' AS dimension, l_returnflag AS value, count(*) AS n FROM lineitem GROUP BY 2 UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY 2 UNION ALL SELECT 'l_linenumber', l_linenumber::VARCHAR, count(*) FROM lineitem GROUP BY 2 UNION ALL SELECT 'total', NULL, count(*) FROM lineitem")
def relation_stats(spark: SparkSession, d: str) -> DataFrame:
    return report.count_by(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


@query("SELECT c_mktsegment, count(*) FILTER (c_acctbal > 5000) AS rich, count(*) FILTER (c_acctbal < 0) AS owing, count(*) FILTER (c_nationkey < 5) AS near FROM customer GROUP BY 1")
def scoped_counts(spark: SparkSession, d: str) -> DataFrame:
    return report.scoped_counts(table(spark, d, "customer"), {"rich": F.col("c_acctbal") > 5000, "owing": F.col("c_acctbal") < 0, "near": F.col("c_nationkey") < 5}, ["c_mktsegment"])


@query(
    """WITH e AS (SELECT lang AS dataset, 'chars' AS metric, sum(n_chars)::BIGINT AS value FROM documents GROUP BY 1 UNION ALL SELECT 'orders', 'rows', count(*) FROM orders UNION ALL SELECT 'orders', 'lines', 4 * count(*) FROM orders),
a AS (SELECT lang AS dataset, 'chars' AS metric, sum(length(text))::BIGINT AS value FROM documents GROUP BY 1 UNION ALL SELECT 'orders', 'rows', count(DISTINCT l_orderkey) FROM lineitem UNION ALL SELECT 'lineitem', 'rows', count(*) FROM lineitem)
SELECT coalesce(e.dataset, a.dataset) AS dataset, coalesce(e.metric, a.metric) AS metric, e.value AS expected, a.value AS actual FROM e FULL JOIN a ON e.dataset = a.dataset AND e.metric = a.metric WHERE e.value IS DISTINCT FROM a.value"""
)
def count_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    docs, orders, line = (table(spark, d, n) for n in ("documents", "orders", "lineitem"))
    long = lambda df, dataset, metric, value: df.agg(value.cast("long").alias("value")).select(F.lit(dataset).alias("dataset"), F.lit(metric).alias("metric"), "value")
    by_lang = lambda value: docs.groupBy(F.col("lang").alias("dataset")).agg(value.cast("long").alias("value")).select("dataset", F.lit("chars").alias("metric"), "value")
    expected = by_lang(F.sum("n_chars")).union(long(orders, "orders", "rows", F.count(F.lit(1)))).union(long(orders, "orders", "lines", 4 * F.count(F.lit(1))))
    actual = by_lang(F.sum(F.char_length("text"))).union(long(line, "orders", "rows", F.count_distinct("l_orderkey"))).union(long(line, "lineitem", "rows", F.count(F.lit(1))))
    return report.reconcile_counts(expected, actual)


@query("SELECT 'documents' AS entity, lang AS scope, count(*) AS n FROM documents GROUP BY 2 UNION ALL SELECT 'customer', c_mktsegment, count(*) FROM customer GROUP BY 2 UNION ALL SELECT 'part', p_brand, count(*) FROM part GROUP BY 2")
def inventory_report(spark: SparkSession, d: str) -> DataFrame:
    named = {"documents": "lang", "customer": "c_mktsegment", "part": "p_brand"}
    return report.inventory({n: table(spark, d, n).withColumnRenamed(c, "scope_value") for n, c in named.items()}, "scope_value")


@query("WITH o AS (SELECT l_orderkey, list(DISTINCT l_partkey) AS a, list(DISTINCT l_suppkey) AS b FROM lineitem WHERE l_quantity > 40 GROUP BY 1) SELECT count(DISTINCT x) AS n FROM (SELECT unnest(list_concat(a, b)) AS x FROM o)")
def distinct_mapped(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").filter("l_quantity > 40").groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("a"), F.collect_set("l_suppkey").alias("b"))
    return report.distinct_in_arrays(rows, ["a", "b"])


@query("SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL")
def facet_values(spark: SparkSession, d: str) -> DataFrame:
    return report.facet_values(table(spark, d, "part"), "p_type")


# --- rules ---------------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n FROM orders WHERE (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) NOT BETWEEN 1 AND 7")
def cardinality_bounds(spark: SparkSession, d: str) -> DataFrame:
    return rules.cardinality(table(spark, d, "orders"), "o_orderkey", table(spark, d, "lineitem"), "l_orderkey", 1, 7)


@query(
    """SELECT 'doc-lang' AS rule_id, 'error' AS severity, 'documents' AS entity, doc_id::VARCHAR AS key, lang AS detail FROM documents WHERE lang NOT IN ('en', 'de', 'fr')
UNION ALL SELECT 'doc-length', 'warn', 'documents', doc_id::VARCHAR, n_chars::VARCHAR FROM documents WHERE n_chars > 10000
UNION ALL SELECT 'doc-size', 'error', 'documents', doc_id::VARCHAR, n_chars::VARCHAR FROM documents WHERE n_chars < 100
UNION ALL SELECT 'doc-source', 'error', 'documents', doc_id::VARCHAR, source FROM documents WHERE NOT regexp_matches(source, '^src[0-9]$')
UNION ALL SELECT 'doc-english', 'error', 'documents', doc_id::VARCHAR, source FROM documents WHERE lang = 'en' AND source IN ('src1', 'src2')
UNION ALL SELECT 'order-priority', 'error', 'orders', o_orderkey::VARCHAR, o_orderpriority FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'
UNION ALL SELECT 'order-number', 'error', 'orders', o_orderkey::VARCHAR, o_orderpriority FROM orders WHERE try_cast(substr(o_orderpriority, 1, 1) AS INT) > 4"""
)
def rule_check(spark: SparkSession, d: str) -> DataFrame:
    R = rules.Rule
    english = R("", "const", "lang", "en")
    docs = [
        R("doc-lang", "in", "lang", ("en", "de", "fr")),
        R("doc-length", "max", "n_chars", 10000, "warn"),
        R("doc-size", "min", "n_chars", 100),
        R("doc-source", "pattern", "source", r"^src[0-9]\z"),
        R("doc-english", "if_then", "source", (english, R("", "expression", "", ~F.col("source").isin("src1", "src2")))),
        R("doc-id", "required", "doc_id"),
        R("doc-number", "datatype", "n_chars", "bigint"),
    ]
    orders = [R("order-priority", "expression", "o_orderpriority", F.col("o_orderpriority") != "4-NOT SPECIFIED"), R("order-number", "expression", "o_orderpriority", F.substring("o_orderpriority", 1, 1).try_cast("int") <= 4), R("order-date", "required", "o_orderdate")]
    return rules.violations(rules.check(table(spark, d, "documents"), "doc_id", docs, "documents"), rules.check(table(spark, d, "orders"), "o_orderkey", orders, "orders"))


@query(
    """SELECT 'named-or-small' AS rule_id, 'error' AS severity, 'part' AS entity, p_partkey::VARCHAR AS key, p_name AS detail FROM part WHERE NOT (p_size < 40 OR p_name LIKE '%ring%')
UNION ALL SELECT 'no-self', 'error', 'part', p_partkey::VARCHAR, p_size::VARCHAR FROM part WHERE p_size = p_partkey % 50"""
)
def or_rules(spark: SparkSession, d: str) -> DataFrame:
    R = rules.Rule
    part = table(spark, d, "part").withColumn("other", (F.col("p_partkey") % 50).cast("int"))
    either = R("named-or-small", "any_of", "p_name", (R("", "expression", "", F.col("p_size") < 40), R("", "pattern", "p_name", "ring")))
    return rules.check(part, "p_partkey", [either, R("no-self", "no_self_loop", "p_size", "other")], "part")


_BAD = """
WITH r AS (SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 0 THEN 'high-course' WHEN 1 THEN 'course' WHEN 2 THEN 'relation' WHEN 3 THEN 'standard' WHEN 4 THEN 'pathway' ELSE 'release' END AS cls,
 CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS category, CASE WHEN o_orderkey % 7 = 0 THEN 1 END AS grade, CASE WHEN o_orderstatus = 'P' THEN 'candidate' ELSE 'reviewed' END AS status,
 CASE WHEN o_orderkey % 5 = 0 THEN 'official-prerequisite' ELSE 'required' END AS kind, o_custkey % 300 AS src, o_orderkey % 299 AS dst, o_orderkey % 4 = 1 AS checked, CASE WHEN o_orderkey % 9 <> 3 THEN o_orderkey END AS locator,
 o_orderkey % 8 <> 4 AS flagged, CASE WHEN o_orderkey % 101 = 0 THEN 'old' END AS replaces, o_orderkey % 13 = 5 AS released, CASE WHEN o_orderstatus = 'F' THEN 'formal-validation-passed' ELSE 'open' END AS formal FROM orders
 UNION ALL SELECT o_orderkey, 'offering', 'c', NULL, 'reviewed', 'none', 1, 2, false, 1, true, NULL, false, 'open' FROM orders WHERE o_orderkey % 17 = 0)
"""


@query(
    _BAD
    + """SELECT 'HIGH_GRADE_FORCED' AS code, id FROM r WHERE cls = 'high-course' AND grade IS NOT NULL UNION SELECT 'COURSE_CATEGORY_MISSING', id FROM r WHERE cls IN ('course', 'high-course') AND category IS NULL
UNION SELECT 'CANDIDATE_OFFICIALIZED', id FROM r WHERE kind = 'official-prerequisite' AND status = 'candidate' UNION SELECT 'LEARNING_RELATION_CYCLE', id FROM r WHERE cls = 'relation' AND src = dst
UNION SELECT 'OFFICIAL_LOCATOR_MISSING', id FROM r WHERE cls = 'standard' AND checked AND locator IS NULL UNION SELECT 'PATHWAY_BOUNDARY_MISSING', id FROM r WHERE cls = 'pathway' AND NOT coalesce(flagged, false)
UNION SELECT 'ELEMENTARY_IRI_REMINTED', id FROM r WHERE replaces IS NOT NULL UNION SELECT 'RIGHTS_HOLD_BYPASSED', id FROM r WHERE released AND formal = 'formal-validation-passed'
UNION SELECT 'COURSE_OFFERING_CONFLATION', id FROM r WHERE cls IN ('course', 'high-course') AND id IN (SELECT id FROM r WHERE cls = 'offering')
UNION SELECT 'DUPLICATE_RELATION_ASSERTION', max(id) FROM r WHERE cls = 'relation' GROUP BY src, dst, kind HAVING count(*) > 1"""
)
def adversarial_codes(spark: SparkSession, d: str) -> DataFrame:
    k, orders = F.col("o_orderkey"), table(spark, d, "orders")
    cls = F.element_at(F.array(*[F.lit(x) for x in ("high-course", "course", "relation", "standard", "pathway", "release")]), (k % 6 + 1).cast("int"))
    rows = orders.select(
        k.alias("id"),
        cls.alias("cls"),
        F.when(k % 11 != 0, F.col("o_orderpriority")).alias("category"),
        F.when(k % 7 == 0, 1).alias("grade"),
        F.when(F.col("o_orderstatus") == "P", "candidate").otherwise("reviewed").alias("status"),
        F.when(k % 5 == 0, "official-prerequisite").otherwise("required").alias("kind"),
        (F.col("o_custkey") % 300).alias("src"),
        (k % 299).alias("dst"),
        (k % 4 == 1).alias("checked"),
        F.when(k % 9 != 3, k).alias("locator"),
        (k % 8 != 4).alias("flagged"),
        F.when(k % 101 == 0, "old").alias("replaces"),
        (k % 13 == 5).alias("released"),
        F.when(F.col("o_orderstatus") == "F", "formal-validation-passed").otherwise("open").alias("formal"),
    )
    offered = orders.filter(k % 17 == 0).select(k.alias("id"), F.lit("offering").alias("cls"))
    return rules.adversarial_codes(rows.unionByName(offered, allowMissingColumns=True))


@query("SELECT 'every-positive' AS expectation, bool_and(o_totalprice > 0) AS holds FROM orders UNION ALL SELECT 'some-urgent', bool_or(o_orderpriority = '1-URGENT') FROM orders UNION ALL SELECT 'none-late', count(*) FILTER (o_orderdate > TIMESTAMP '1999-01-01') = 0 FROM orders")
def expectations(spark: SparkSession, d: str) -> DataFrame:
    late = F.col("o_orderdate") > F.lit("1999-01-01").cast("timestamp")
    return rules.expect(table(spark, d, "orders"), {"every-positive": F.col("o_totalprice") > 0}, {"some-urgent": F.col("o_orderpriority") == "1-URGENT"}, {"none-late": late})


@query("SELECT k AS field, count(*) AS rows FROM (SELECT unnest(json_keys(props)) AS k FROM events) WHERE k NOT IN ('v') GROUP BY 1")
def unexpected_json_fields(spark: SparkSession, d: str) -> DataFrame:
    return rules.unexpected_json_fields(table(spark, d, "events"), "props", ["v"])


@query("SELECT 'valid' AS part, count(*) AS n FROM events WHERE event_type IN ('click', 'view') UNION ALL SELECT 'reject', count(*) FROM events WHERE event_type NOT IN ('click', 'view', 'error')")
def split_routes(spark: SparkSession, d: str) -> DataFrame:
    ok, bad = rules.split_valid_rejects(table(spark, d, "events"), F.col("event_type").isin("click", "view"), F.col("event_type") == "error")
    return ok.agg(F.count(F.lit(1)).alias("n")).select(F.lit("valid").alias("part"), "n").union(bad.agg(F.count(F.lit(1)).alias("n")).select(F.lit("reject").alias("part"), "n"))


# --- triples and questions -----------------------------------------------------------------------------------------------


def _triples(spark: SparkSession, d: str) -> DataFrame:
    region, nation, cust = (table(spark, d, n) for n in ("region", "nation", "customer"))
    iri = lambda kind, c: F.concat(F.lit(f"{kind}:"), F.col(c).cast("string"))
    return entities.union_all(
        [
            triples.to_triples(region, iri("region", "r_regionkey"), "Region", {"r_name": ("label", None)}),
            triples.to_triples(nation, iri("nation", "n_nationkey"), "Nation", {"n_name": ("label", None)}, references={"n_regionkey": ("inRegion", "region:")}),
            triples.to_triples(cust, iri("customer", "c_custkey"), "Customer", {"c_name": ("label", None), "c_mktsegment": ("segment", "xsd:string")}, references={"c_nationkey": ("inNation", "nation:")}),
        ]
    )


_TRIPLES = """
WITH t AS (SELECT 'region:' || r_regionkey AS s, 'type' AS p, 'Region' AS o, 'iri' AS o_kind FROM region UNION ALL SELECT 'region:' || r_regionkey, 'label', r_name, 'literal' FROM region
UNION ALL SELECT 'nation:' || n_nationkey, 'type', 'Nation', 'iri' FROM nation UNION ALL SELECT 'nation:' || n_nationkey, 'label', n_name, 'literal' FROM nation UNION ALL SELECT 'nation:' || n_nationkey, 'inRegion', 'region:' || n_regionkey, 'iri' FROM nation
UNION ALL SELECT 'customer:' || c_custkey, 'type', 'Customer', 'iri' FROM customer UNION ALL SELECT 'customer:' || c_custkey, 'label', c_name, 'literal' FROM customer
UNION ALL SELECT 'customer:' || c_custkey, 'segment', c_mktsegment, 'literal' FROM customer UNION ALL SELECT 'customer:' || c_custkey, 'inNation', 'nation:' || c_nationkey, 'iri' FROM customer)
"""


@query(_TRIPLES + "SELECT s, p, o, o_kind FROM t")
def triples_unpivot(spark: SparkSession, d: str) -> DataFrame:
    return _triples(spark, d).select("s", "p", "o", "o_kind")


@query(_TRIPLES + "SELECT count(*) AS triples, count(DISTINCT s) AS nodes, count(*) FILTER (p = 'type') AS types, count(*) FILTER (o_kind = 'literal') AS literals FROM t")
def triple_counts(spark: SparkSession, d: str) -> DataFrame:
    return triples.graph_counts(_triples(spark, d))


@query("SELECT 'customer:' || c_custkey AS customer, n_name AS nation, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def triple_pattern(spark: SparkSession, d: str) -> DataFrame:
    found = triples.match(_triples(spark, d), ("?customer", "inNation", "?n"), ("?n", "label", "?nation"), ("?n", "inRegion", "?r"), ("?r", "label", "?region"))
    return found.select("customer", "nation", "region")


@query("SELECT 'customer:' || c_custkey AS customer, c_name AS name, c_mktsegment AS segment, 'nation:' || c_nationkey AS n, n_name AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey")
def star_pattern(spark: SparkSession, d: str) -> DataFrame:
    """Four patterns of a customer are one star, two of its nation another."""
    of = "?customer"
    return triples.match(_triples(spark, d), (of, "type", "Customer"), (of, "label", "?name"), (of, "segment", "?segment"), (of, "inNation", "?n"), ("?n", "type", "Nation"), ("?n", "label", "?nation"))


@query(_TRIPLES + "SELECT DISTINCT s, CASE p WHEN 'inNation' THEN 'Resident' WHEN 'inRegion' THEN 'Country' END AS type FROM t WHERE p IN ('inNation', 'inRegion') UNION SELECT s, 'Place' FROM t WHERE p = 'inRegion'")
def domain_inference(spark: SparkSession, d: str) -> DataFrame:
    domains = spark.createDataFrame([("inNation", "Resident"), ("inRegion", "Country")], "p string, domain string")
    return triples.infer_subclass(triples.infer_domain_types(_triples(spark, d), domains), spark.createDataFrame([("Country", "Place")], "sub string, super string"))


@query(_TRIPLES + """SELECT '<' || s || '> <' || p || '> ' || CASE WHEN o_kind = 'iri' THEN '<' || o || '>' ELSE '"' || o || '"' || CASE WHEN p = 'segment' THEN '^^<xsd:string>' ELSE '' END END || ' .' AS value FROM t""")
def triple_lines(spark: SparkSession, d: str) -> DataFrame:
    return triples.n_triples(_triples(spark, d))


@query(
    "WITH q AS (SELECT DISTINCT CASE WHEN p_partkey % 3 = 0 THEN upper(substr(p_name, 3, 7)) ELSE substr(p_name, 1, p_size % 5) || ' ' END AS query FROM part WHERE p_partkey % 29 = 1) "
    "SELECT query, p_partkey FROM part JOIN q ON contains(lower(concat_ws(' ', p_name, p_brand, p_type)), lower(trim(query)))"
)
def indexed_search(spark: SparkSession, d: str) -> DataFrame:
    """Pieces of some parts' names, short and empty ones too, looked up in an index of all parts."""
    part, key = table(spark, d, "part"), F.col("p_partkey")
    piece = F.when(key % 3 == 0, F.upper(F.substring("p_name", 3, 7))).otherwise(F.concat(F.substring("p_name", F.lit(1), F.col("p_size") % 5), F.lit(" ")))
    index = search.build_index(part, "p_partkey", ["p_name", "p_brand", "p_type"])
    return search.search(index, part.filter(key % 29 == 1).select(piece.alias("query"))).withColumnRenamed("id", "p_partkey")


@query("SELECT p_partkey, p_name, p_brand FROM part WHERE p_type = 'ECONOMY' AND contains(lower(concat_ws(' ', p_name, p_brand)), 'ring') ORDER BY p_name, p_partkey LIMIT 80")
def faceted_search(spark: SparkSession, d: str) -> DataFrame:
    found = questions.text_search(questions.facet_filter(table(spark, d, "part"), p_type="ECONOMY", p_brand="all"), ["p_name", "p_brand"], " RING ")
    return questions.top(found.select("p_partkey", "p_name", "p_brand"), 80, "p_name", "p_partkey")


def _status_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {
        "orders": table(spark, d, "orders").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"), F.col("o_orderstatus").alias("verification"), F.col("o_orderpriority").alias("rights")),
        "lines": table(spark, d, "lineitem").select(F.concat(F.lit("l"), F.col("l_orderkey").cast("string")).alias("id"), F.col("l_linestatus").alias("verification"), F.col("l_returnflag").alias("review")),
        "parts": table(spark, d, "part").select(F.col("p_partkey").alias("id")),
    }


@query("SELECT 'o' || o_orderkey AS id, o_orderstatus AS verification, NULL AS review, o_orderpriority AS rights FROM orders UNION ALL SELECT 'l' || l_orderkey, l_linestatus, l_returnflag, NULL FROM lineitem")
def status_union(spark: SparkSession, d: str) -> DataFrame:
    return questions.independent_status(_status_tables(spark, d))


def _chosen_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The star schema seen as the questions' tables: parts are courses, orders and lines relations, customers standards and transitions."""
    part, orders, cust, line = (table(spark, d, n) for n in ("part", "orders", "customer", "lineitem"))
    state = lambda c, value: F.when(F.col(c) == value, "candidate").otherwise("done").alias("review")
    official = F.lit("official").alias("basis")
    k = F.col("c_custkey")
    return {
        "course": part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("label"), F.col("p_brand").alias("category"), F.when(F.col("p_size") > 20, "high").otherwise("middle").alias("level"), F.when(F.col("p_partkey") % 3 == 0, F.array("p_size")).when(F.col("p_partkey") % 3 == 1, F.array().cast("array<int>")).alias("grades")),
        "relation": orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("src"), (F.col("o_orderkey") % 97).alias("dst"), F.col("o_orderpriority").alias("kind"), F.col("o_orderstatus").alias("reason"), official, state("o_orderstatus", "P")),
        "course_relation": line.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"), F.col("l_returnflag").alias("kind"), F.col("l_linestatus").alias("reason"), official, state("l_returnflag", "R")),
        "transition": cust.select(k.alias("id"), F.col("c_mktsegment").alias("kind"), F.col("c_name").alias("reason"), official, state("c_mktsegment", "BUILDING"), F.array(k, k + 1).alias("from_courses"), F.array(F.col("c_nationkey").cast("long")).alias("to_courses")),
        "offering": part.filter("p_partkey % 5 = 0").select((F.col("p_partkey") * 10).alias("id"), F.col("p_partkey").alias("course_id")),
        "standard": cust.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("source_id"), (F.col("c_custkey") % 400).alias("page"), F.col("c_nationkey").alias("domain_id"), F.lit(1).alias("course_id")),
        "source": table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")),
        "topic": orders.select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 25).cast("int").alias("domain_id"), F.array(F.struct(F.col("o_custkey").alias("standard_id"), F.col("o_orderstatus").alias("kind"), F.lit("b").alias("basis"))).alias("alignments")),
    }


@query("SELECT c_custkey AS standard, o_orderkey AS topic, 1 AS course_id, c_nationkey AS domain_id FROM customer JOIN orders ON o_custkey = c_custkey AND (o_custkey % 25)::INT = c_nationkey")
def question_standards_topics(spark: SparkSession, d: str) -> DataFrame:
    return questions.standards_topics(_chosen_tables(spark, d))


@query("SELECT o_orderkey AS topic, o_custkey AS standard_id, o_orderstatus AS kind, 'b' AS basis FROM orders")
def question_alignments(spark: SparkSession, d: str) -> DataFrame:
    return questions.standard_alignments(_chosen_tables(spark, d))


_ALL_EDGES = """
WITH e AS (SELECT o_orderkey AS id, o_orderpriority AS kind, o_orderstatus AS reason, o_orderstatus = 'P' AS open FROM orders UNION ALL SELECT l_orderkey * 10 + l_linenumber, l_returnflag, l_linestatus, l_returnflag = 'R' FROM lineitem UNION ALL SELECT c_custkey, c_mktsegment, c_name, c_mktsegment = 'BUILDING' FROM customer)
"""


@query(_ALL_EDGES + "SELECT id, CASE WHEN open THEN 'candidate' ELSE 'done' END AS review, reason, 'official' AS basis FROM e")
def question_relation_review(spark: SparkSession, d: str) -> DataFrame:
    return questions.relation_review(_chosen_tables(spark, d))


@query(_ALL_EDGES + "SELECT id, kind FROM e WHERE open")
def question_review_queue(spark: SparkSession, d: str) -> DataFrame:
    return questions.review_queue(_chosen_tables(spark, d))


@query("SELECT c_custkey AS id, unnest([c_custkey, c_custkey + 1]) AS from_course, c_nationkey::BIGINT AS to_course, c_mktsegment AS kind, c_name AS reason, 'official' AS basis FROM customer")
def question_transitions(spark: SparkSession, d: str) -> DataFrame:
    return questions.transitions(_chosen_tables(spark, d))


@query("SELECT p_partkey AS course, CASE WHEN p_partkey % 5 = 0 THEN p_partkey * 10 END AS offering FROM part")
def question_offerings(spark: SparkSession, d: str) -> DataFrame:
    return questions.course_offerings(_chosen_tables(spark, d))


@query("SELECT p_partkey AS id, p_name AS label FROM part WHERE p_size > 20 AND p_partkey % 3 <> 0")
def question_unspecified_grade(spark: SparkSession, d: str) -> DataFrame:
    return questions.unspecified_grade(_chosen_tables(spark, d))


@query("SELECT c_custkey AS standard, c_nationkey AS source_id, c_custkey % 400 AS page, n_name AS name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def question_locators(spark: SparkSession, d: str) -> DataFrame:
    return questions.source_locators(_chosen_tables(spark, d))


@query("SELECT p_partkey AS id, p_name AS label, p_brand AS category, CASE WHEN p_size > 20 THEN 'high' ELSE 'middle' END AS level FROM part")
def question_courses(spark: SparkSession, d: str) -> DataFrame:
    return questions.courses(_chosen_tables(spark, d))


@query("SELECT o_orderkey AS id, o_custkey AS src, o_orderkey % 97 AS dst, o_orderpriority AS kind FROM orders")
def question_learning_relations(spark: SparkSession, d: str) -> DataFrame:
    return questions.learning_relations(_chosen_tables(spark, d))


@query("SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS src, l_suppkey AS dst, l_returnflag AS kind FROM lineitem")
def question_course_relations(spark: SparkSession, d: str) -> DataFrame:
    return questions.course_relations(_chosen_tables(spark, d))


def _more_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    part, orders, events = (table(spark, d, n) for n in ("part", "orders", "events"))
    step = lambda order, kind, ids, chosen: F.struct(F.lit(order).alias("order"), F.lit(kind).alias("kind"), F.col("p_name").alias("reason"), chosen.alias("choice_set"), ids.alias("course_ids"))
    none = F.array().cast("array<bigint>")
    return {
        "choice_set": part.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("kind"), F.lit(0).alias("least"), F.when(F.col("p_size") > 25, F.col("p_size")).alias("most"), F.array(F.col("p_partkey"), F.col("p_partkey") + 1).alias("course_ids")),
        "credit_rule": orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("kind"), F.col("o_custkey").alias("value"), F.lit("credit").alias("unit"), F.to_date("o_orderdate").alias("start"), F.when(F.col("o_orderstatus") == "F", F.to_date("o_orderdate") + F.lit(30)).alias("end")),
        "pathway": part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("label"), F.lit(True).alias("unofficial"), F.array(step(1, "foundation", F.array(F.col("p_partkey"), F.col("p_partkey") * 2), F.lit(None).cast("string")), step(2, "alternatives", none, F.col("p_type"))).alias("steps")),
        "gap": events.filter("event_type = 'error'").select(F.col("event_id").alias("id"), F.col("props").alias("description"), F.when(F.col("value") > 50, "high").otherwise("low").alias("severity"), F.col("event_type").alias("status")),
        "transition": orders.select(F.col("o_orderkey").alias("id"), F.array(F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("https://x.example/#/topic/"), F.col("o_custkey").cast("string"))).otherwise(F.col("o_orderpriority"))).alias("from_topics"), F.array("o_custkey", "o_orderkey").alias("to_topics")),
    }


@query("SELECT p_partkey AS id, p_type AS kind, 0 AS least, CASE WHEN p_size > 25 THEN p_size END AS most, unnest([p_partkey, p_partkey + 1]) AS course FROM part")
def question_choice_sets(spark: SparkSession, d: str) -> DataFrame:
    return questions.choice_sets(_more_tables(spark, d))


@query("SELECT o_orderkey AS id, o_orderpriority AS kind, o_custkey AS value, 'credit' AS unit, o_orderdate::DATE AS start, CASE WHEN o_orderstatus = 'F' THEN o_orderdate::DATE + 30 END AS \"end\" FROM orders")
def question_credit_rules(spark: SparkSession, d: str) -> DataFrame:
    return questions.credit_rules(_more_tables(spark, d))


@query(
    """SELECT p_partkey AS id, p_brand AS label, true AS unofficial, 1 AS "order", 'foundation' AS kind, p_name AS reason, NULL AS choice_set, unnest([p_partkey, p_partkey * 2]) AS course FROM part
UNION ALL SELECT p_partkey, p_brand, true, 2, 'alternatives', p_name, p_type, NULL FROM part"""
)
def question_pathways(spark: SparkSession, d: str) -> DataFrame:
    return questions.illustrative_pathways(_more_tables(spark, d))


@query("SELECT event_id AS id, props AS description, CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS severity, event_type AS status FROM events WHERE event_type = 'error'")
def question_gaps(spark: SparkSession, d: str) -> DataFrame:
    return questions.coverage_gaps(_more_tables(spark, d))


@query("SELECT o_orderkey AS id, 'https://x.example/#/topic/' || o_custkey AS from_topic, unnest([o_custkey, o_orderkey]) AS to_topic FROM orders WHERE o_orderkey % 4 = 0")
def question_outside_bridge(spark: SparkSession, d: str) -> DataFrame:
    return questions.outside_bridge(_more_tables(spark, d))


@query("SELECT count(*) = 0 AS holds FROM conversations WHERE role NOT IN ('user', 'assistant', 'system')")
def question_no_learner_data(spark: SparkSession, d: str) -> DataFrame:
    """Whether no row is of a class that must not be there."""
    learners = table(spark, d, "conversations").filter(~F.col("role").isin("user", "assistant", "system"))
    return spark.createDataFrame([(questions.no_learner_data({"learner": learners}),)], "holds boolean")


@query(
    """WITH e AS (SELECT p_partkey // 2 AS src, p_partkey AS dst, p_partkey AS id, p_type FROM part WHERE p_partkey > 0 AND p_size > 5), n AS (SELECT p_partkey AS node, p_brand AS owner FROM part),
t AS (SELECT src AS node, id FROM e UNION SELECT dst, id FROM e)
SELECT 'edges' AS section, 'p_type:' || p_type AS name, count(*) AS n FROM e GROUP BY p_type UNION ALL SELECT 'edges', 'total:', count(*) FROM e
UNION ALL SELECT 'coverage', 'nodes', count(*) FROM n UNION ALL SELECT 'coverage', 'participants', count(*) FROM n WHERE node IN (SELECT node FROM t) UNION ALL SELECT 'coverage', 'roots', count(*) FROM n WHERE node NOT IN (SELECT dst FROM e)
UNION ALL SELECT 'coverage', 'isolated', count(*) FROM n WHERE node NOT IN (SELECT node FROM t) UNION ALL SELECT 'coverage', 'edges', count(*) FROM e
UNION ALL SELECT 'owner', owner, count(DISTINCT id) FROM n LEFT JOIN t USING (node) GROUP BY owner"""
)
def relation_report(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    edges = part.filter("p_partkey > 0 AND p_size > 5").select(F.floor(F.col("p_partkey") / 2).cast("long").alias("src"), F.col("p_partkey").alias("dst"), F.col("p_partkey").alias("id"), "p_type")
    nodes = part.select(F.col("p_partkey").alias("node"))
    return report.relation_report(nodes, edges, part.select(F.col("p_partkey").alias("node"), F.col("p_brand").alias("owner")), "id", ["p_type"])


@query(
    """SELECT o_orderkey, 'detail.customer_id' AS path, o_custkey::VARCHAR AS ref FROM orders UNION ALL SELECT o_orderkey, 'parts.part_id', (o_orderkey % 7)::VARCHAR FROM orders
UNION ALL SELECT o_orderkey, 'parts.part_id', (o_orderkey % 5)::VARCHAR FROM orders UNION ALL SELECT o_orderkey, 'source_refs', o_orderstatus FROM orders"""
)
def nested_references(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    piece = lambda n: F.struct((k % n).alias("part_id"), F.lit("x").alias("note"))
    rows = table(spark, d, "orders").select("o_orderkey", F.struct(F.col("o_custkey").alias("customer_id")).alias("detail"), F.array(piece(7), piece(5)).alias("parts"), F.array("o_orderstatus").alias("source_refs"))
    return relations.all_refs(rows, "o_orderkey")


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Order ' || o_orderkey || ' for ' || o_custkey || ' is done.' WHEN 'O' THEN 'Order ' || o_orderkey || ' waits for ' || o_custkey || '.' ELSE o_orderkey || '/' || o_custkey END AS sentence FROM orders")
def rendered_texts(spark: SparkSession, d: str) -> DataFrame:
    sentence = tx.render([("F", "Order %s for %s is done."), ("O", "Order %s waits for %s.")], "o_orderstatus", "o_orderkey", "o_custkey", default="%s/%s")
    return table(spark, d, "orders").select("o_orderkey", sentence.alias("sentence"))


@query("SELECT c_custkey, '{\"nation\":\"' || c_nationkey || '\",\"segment\":\"' || c_mktsegment || '\"}' AS json FROM customer")
def canonical_json(spark: SparkSession, d: str) -> DataFrame:
    m = F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("nation"), F.col("c_nationkey").cast("string"))
    return table(spark, d, "customer").select("c_custkey", tx.canonical_json(m).alias("json"))


@query(
    """WITH s AS (SELECT s_suppkey, 'topic-' || (s_suppkey % 40)::VARCHAR AS external, 'NATION_' || (s_suppkey % 30)::VARCHAR AS to_code FROM supplier)
SELECT s_suppkey, n_nationkey AS dst, CASE WHEN s_suppkey % 40 NOT IN (SELECT n_nationkey FROM nation) THEN 'unknown-source' WHEN n_nationkey IS NULL THEN 'unknown' ELSE 'ok' END AS state FROM s LEFT JOIN nation ON n_name = to_code"""
)
def external_edges(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation")
    specs = table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("topic-"), (F.col("s_suppkey") % 40).cast("string")).alias("external"), F.concat(F.lit("NATION_"), (F.col("s_suppkey") % 30).cast("string")).alias("to_code"))
    listed = nation.select(F.concat(F.lit("topic-"), F.col("n_nationkey").cast("string")).alias("id"))
    return relations.external_edges(specs, listed, "external", nation, "n_name", "n_nationkey", tx.compact).select("s_suppkey", "dst", "state")


@query(
    """WITH e AS (SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN 'candidate' ELSE 'done' END AS status, CASE WHEN o_orderkey % 11 = 0 THEN 'r' END AS reviewer FROM orders), r AS (SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 50 <> 7 UNION ALL SELECT -o_orderkey FROM orders WHERE o_orderkey % 500 = 1),
t AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS standard_id FROM lineitem), s AS (SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 100 <> 3)
SELECT 'review-coverage' AS rule_id, 'error' AS severity, 'edge' AS entity, id::VARCHAR AS key, 'left' AS detail FROM e WHERE id NOT IN (SELECT id FROM r) UNION ALL SELECT 'review-coverage', 'error', 'edge', id::VARCHAR, 'right' FROM r WHERE id NOT IN (SELECT id FROM e)
UNION ALL SELECT 'candidate-reviewed', 'error', 'edge', id::VARCHAR, reviewer FROM e WHERE status = 'candidate' AND reviewer IS NOT NULL
UNION ALL SELECT 'topics-per-standard', 'error', 'standard', s.id::VARCHAR, count(t.id)::VARCHAR FROM s LEFT JOIN t ON standard_id = s.id GROUP BY s.id HAVING count(t.id) NOT BETWEEN 2 AND 5
UNION ALL SELECT 'topic-standard', 'error', 'topic', standard_id::VARCHAR, count(*)::VARCHAR FROM t WHERE standard_id NOT IN (SELECT id FROM s) GROUP BY standard_id"""
)
def governance(spark: SparkSession, d: str) -> DataFrame:
    from tracewright.plans import catalogue

    k, orders = F.col("o_orderkey"), table(spark, d, "orders")
    edges = orders.select(k.alias("id"), F.when(F.col("o_orderstatus") == "P", "candidate").otherwise("done").alias("status"), F.when(k % 11 == 0, "r").alias("reviewer"))
    reviews = orders.filter(k % 50 != 7).select(k.alias("id")).union(orders.filter(k % 500 == 1).select(-k))
    topics = table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_orderkey").alias("standard_id"))
    return catalogue.governance(edges, reviews, topics, orders.filter(k % 100 != 3).select(k.alias("id")))


@query(
    """SELECT 'course.grade' AS rule_id, 'error' AS severity, 'course' AS entity, p_partkey::VARCHAR AS key, '[' || p_size || ']' AS detail FROM part WHERE p_size > 20 AND p_partkey % 3 = 0
UNION ALL SELECT 'course.id-form', 'error', 'course', p_partkey::VARCHAR, p_partkey::VARCHAR FROM part WHERE NOT regexp_matches(p_partkey::VARCHAR, '^[a-z0-9][a-z0-9._:-]*$')
UNION ALL SELECT 'course.id-length', 'error', 'course', p_partkey::VARCHAR, p_partkey::VARCHAR FROM part WHERE length(p_partkey::VARCHAR) < 3
UNION ALL SELECT 'relation.kind', 'error', 'relation', o_orderkey::VARCHAR, o_orderpriority FROM orders
UNION ALL SELECT 'relation.loop', 'error', 'relation', o_orderkey::VARCHAR, o_custkey::VARCHAR FROM orders WHERE o_custkey = o_orderkey % 97"""
)
def shape_catalogue(spark: SparkSession, d: str) -> DataFrame:
    from tracewright.plans import catalogue

    tables = _chosen_tables(spark, d)
    return catalogue.check_tables({n: tables[n] for n in ("course", "relation")})


@query("SELECT s_suppkey, '12가' || lpad((s_suppkey % 100)::VARCHAR, 2, '0') || '-01' AS code, '12가' AS prefix, 'high' AS profile, CASE WHEN s_nationkey + 5 >= 23 THEN 'vocational' ELSE 'academic' END AS scope FROM supplier")
def routed_codes(spark: SparkSession, d: str) -> DataFrame:
    from tracewright.plans.extraction import profile_of, program_scope

    annex = F.col("s_nationkey") + 5
    code = F.concat(F.lit("１２가"), F.lpad((F.col("s_suppkey") % 100).cast("string"), 2, "0"), F.lit("–01"))
    rows = table(spark, d, "supplier").select("s_suppkey", tx.norm_code(code).alias("code"), annex.alias("annex"))
    return rows.select("s_suppkey", "code", tx.code_prefix("code").alias("prefix"), profile_of(F.col("code"), F.col("annex")).alias("profile"), program_scope(F.col("annex"))[0].alias("scope"))


# --- releases ------------------------------------------------------------------------------------------------------------


def _hash(cols: str) -> str:
    text = " || '|' || ".join(f"coalesce({c}::VARCHAR, '\\N')" for c in cols.split())
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def _print_sql(name: str, cols: str) -> str:
    return f"SELECT '{name}' AS dataset, count(*) AS n, bit_xor({_hash(cols)}) AS hash_xor, sum({_hash(cols)}::HUGEINT)::VARCHAR AS hash_sum FROM {name}"


_PRINTED = {"region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey", "documents": "doc_id text lang source n_chars", "labels": "doc_id quality toxic", "benchmark": "item_id text", "conversations": "conv_id turn role text"}


@query(_print_sql("documents", _PRINTED["documents"]).replace("SELECT 'documents' AS dataset, ", "SELECT ").replace(" FROM documents", ", count(DISTINCT doc_id) AS keys FROM documents"))
def fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return release.fingerprint(table(spark, d, "documents").select(*_PRINTED["documents"].split()), key="doc_id")


@query(" UNION ALL ".join(_print_sql(n, c) for n, c in _PRINTED.items()))
def manifest(spark: SparkSession, d: str) -> DataFrame:
    return release.manifest({n: table(spark, d, n).select(*c.split()) for n, c in _PRINTED.items()})


@query("WITH m AS (" + " UNION ALL ".join(_print_sql(n, c) for n, c in _PRINTED.items()) + f") SELECT count(*) AS n, bit_xor({_hash('dataset n hash_xor hash_sum')}) AS hash_xor, sum({_hash('dataset n hash_xor hash_sum')}::HUGEINT)::VARCHAR AS hash_sum, count(*) AS keys FROM m")
def bundle(spark: SparkSession, d: str) -> DataFrame:
    return release.bundle(manifest(spark, d))


@query(
    """WITH a AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 3), b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 10 <> 4)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'lost' WHEN a.o_orderkey IS NULL THEN 'added' ELSE 'changed' END AS change FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderstatus IS DISTINCT FROM b.o_orderstatus"""
)
def version_drift(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    now = orders.filter("o_orderkey % 10 <> 4").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")))
    return release.drift(orders.filter("o_orderkey % 10 <> 3"), now, "o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 10 = 4 AND o_orderstatus = 'F'")
def lost_keys(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    return release.lost_keys(orders, orders.filter("o_orderkey % 10 <> 4"), "o_orderkey", F.col("o_orderstatus") == "F")


@query(
    """WITH a AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 4 <> 1), b AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 4 <> 2)
SELECT 'new' AS side, * FROM (FROM a EXCEPT ALL FROM b) UNION ALL SELECT 'stored', * FROM (FROM b EXCEPT ALL FROM a)"""
)
def version_difference(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderkey")
    return release.difference(orders.filter("o_orderkey % 4 <> 1").drop("o_orderkey"), orders.filter("o_orderkey % 4 <> 2").drop("o_orderkey"))


@query("SELECT doc_id FROM documents INTERSECT SELECT item_id FROM benchmark")
def class_overlap(spark: SparkSession, d: str) -> DataFrame:
    return release.overlap(table(spark, d, "documents"), table(spark, d, "benchmark").withColumnRenamed("item_id", "doc_id"), "doc_id")


@query(
    """SELECT s_suppkey::VARCHAR AS profile, 'r' || (s_nationkey + 1) AS pinned, CASE WHEN s_suppkey % 31 <> 0 THEN 'r' || s_nationkey END AS current FROM supplier WHERE s_suppkey % 9 = 2
UNION ALL SELECT s_suppkey::VARCHAR, 'r' || s_nationkey, NULL FROM supplier WHERE s_suppkey % 9 <> 2 AND s_suppkey % 31 = 0"""
)
def version_pins(spark: SparkSession, d: str) -> DataFrame:
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    name = lambda c: F.concat(F.lit("r"), c.cast("string")).alias("release_id")
    supp = table(spark, d, "supplier")
    pins = supp.select(k.cast("string").alias("profile"), name(F.when(k % 9 == 2, n + 1).otherwise(n)))
    return relations.check_pins(pins, supp.filter(k % 31 != 0).select(k.cast("string").alias("profile"), name(n)))


# --- plans ---------------------------------------------------------------------------------------------------------------


def _coded_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents seen as coded ones: each line begins with a code, of a grade that the line's length gives; some lines are headings, categories, domains or section marks."""
    lines = sequence.lines(table(spark, d, "documents").select("doc_id", "text"))
    k, n = F.length("line"), F.col("line_no")
    word = F.regexp_extract("line", r"([A-Za-z]+)", 1)
    head = F.concat(F.lit("["), F.element_at(F.array(*[F.lit(x) for x in ("9", "10", "12", "2", "7")]), (k % 5 + 1).cast("int")), F.substring(word, 1, 2), F.lpad((n % 100).cast("string"), 2, "0"), F.lit("-0"), (k % 10).cast("string"), F.lit("] "), F.col("line"))
    line = (
        F.when(k % 11 == 3, F.lit("1. 성격 및 목표"))
        .when(k % 11 == 4, F.concat(F.lit("("), (n % 9).cast("string"), F.lit(") "), F.substring("line", 1, 30)))
        .when(k % 11 == 5, F.lit("융합 선택 과목"))
        .when(k % 11 == 6, F.concat(F.lit("3. "), word))
        .when(k % 13 == 7, F.concat(head, F.lit(" 두 자리 수로 제시")))
        .when(k % 3 != 1, head)
        .otherwise(F.col("line"))
    )
    texts = lines.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("line_no", line.alias("line")))).alias("l"))
    return texts.select(F.col("doc_id").cast("string").alias("doc_id"), (F.col("doc_id") % 41).cast("int").alias("annex"), F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("text"))


_CODED = r"""
WITH s AS (SELECT doc_id, regexp_split_to_array(text, '\r?\n') AS l FROM documents WHERE text IS NOT NULL), src AS (SELECT doc_id, generate_subscripts(l, 1) AS n, unnest(l) AS x FROM s),
m AS (SELECT doc_id, n, x, length(x) AS k, regexp_extract(x, '([A-Za-z]+)', 1) AS w FROM src),
h AS (SELECT *, '[' || (['9', '10', '12', '2', '7'])[k % 5 + 1] || substr(w, 1, 2) || lpad((n % 100)::VARCHAR, 2, '0') || '-0' || (k % 10) || '] ' || x AS head FROM m),
coded AS (SELECT doc_id, (doc_id % 41)::INT AS annex, n AS line_no, CASE WHEN k % 11 = 3 THEN '1. 성격 및 목표' WHEN k % 11 = 4 THEN '(' || (n % 9) || ') ' || substr(x, 1, 30) WHEN k % 11 = 5 THEN '융합 선택 과목' WHEN k % 11 = 6 THEN '3. ' || w WHEN k % 13 = 7 THEN head || ' 두 자리 수로 제시' WHEN k % 3 <> 1 THEN head ELSE x END AS line FROM h),
a AS (SELECT *, trim(regexp_replace(replace(line, chr(12), ''), '[\s\x0b\x85\p{Z}]+', ' ', 'g')) AS norm FROM coded WHERE annex BETWEEN 5 AND 39 AND annex <> 15),
b AS (SELECT *, norm = '1. 성격 및 목표' AS mark, CASE WHEN norm LIKE '%융합 선택 과목%' THEN 'convergence-elective' END AS cat,
  CASE WHEN regexp_matches(norm, '^\([0-9]+\)\s*.+$') AND length(regexp_extract(norm, '^\([0-9]+\)\s*(.+)$', 1)) <= 80 THEN trim(regexp_extract(norm, '^\([0-9]+\)\s*(.+)$', 1)) END AS dom,
  CASE WHEN regexp_matches(norm, '^[0-9]+\.\s*(.+)$') AND NOT regexp_matches(regexp_extract(norm, '^[0-9]+\.\s*(.+)$', 1), '^(성격|목표|내용 체계|교수|평가)') THEN trim(regexp_extract(norm, '^[0-9]+\.\s*(.+)$', 1))
    WHEN length(norm) BETWEEN 1 AND 55 AND NOT regexp_matches(norm, '^[0-9]+$|교육과정|선택 중심|공통 교육|^[가-하]\.|^[0-9]+\.|^[<【•※(]|[.!?]$') THEN norm END AS title,
  CASE WHEN regexp_matches(line, '^\s*\[([^\]\n]{1,32}?(?:[0-9]{2}-[0-9]{2}))\]\s*(.*)$') THEN regexp_extract(line, '^\s*\[([^\]\n]{1,32}?(?:[0-9]{2}-[0-9]{2}))\]\s*(.*)$', 1) END AS code,
  regexp_extract(line, '^\s*\[([^\]\n]{1,32}?(?:[0-9]{2}-[0-9]{2}))\]\s*(.*)$', 2) AS rest FROM a),
c AS (SELECT *, last_value(title IGNORE NULLS) OVER w90 AS title_before, last_value(cat IGNORE NULLS) OVER w120 AS cat_before, last_value(cat IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 180 PRECEDING AND CURRENT ROW) AS cat_near,
  last_value(dom IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 80 PRECEDING AND 1 PRECEDING) AS dom_near, coalesce(list({'t': norm}) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING), []) AS after,
  sum(length(line) - length(replace(line, chr(12), ''))) OVER (PARTITION BY doc_id ORDER BY line_no) + 1 AS page
  FROM b WINDOW w90 AS (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 90 PRECEDING AND 1 PRECEDING), w120 AS (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 120 PRECEDING AND 1 PRECEDING)),
d AS (SELECT *, last_value(CASE WHEN mark THEN {'t': title_before, 'c': cat_before} END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS section,
  list_transform(after, lambda p: p.t = '' OR regexp_matches(p.t, '^\[|^•|^<성취기준|^\([가-힣0-9]+\)|^[0-9]+\)')) AS stops, list_transform(after, lambda p: regexp_matches(p.t, '^[0-9]+$|교육과정$')) AS skips, list_transform(after, lambda p: regexp_matches(p.t, '[.!?]$')) AS ends FROM c),
e AS (SELECT *, coalesce(nullif(list_position(stops, true), 0) - 1, 99) AS until, list_position(list_transform(range(1, len(after) + 1), lambda i: ends[i] AND NOT skips[i]), true) AS fin FROM d),
f AS (SELECT *, list_filter(list_transform(range(1, len(after) + 1), lambda i: CASE WHEN i <= until AND i <= coalesce(nullif(fin, 0), 99) AND NOT skips[i] THEN after[i].t END), lambda t: t IS NOT NULL) AS folded FROM e),
r AS (SELECT doc_id::VARCHAR AS doc_id, annex, line_no, page, code, substr(code, 1, length(code) - 5) AS prefix, CASE WHEN code LIKE '9%' THEN 'middle' WHEN regexp_matches(code, '^1[02]') THEN 'high' WHEN annex = 18 THEN 'middle' WHEN annex BETWEEN 19 AND 39 THEN 'high' END AS profile,
  trim(regexp_replace(replace(trim(regexp_replace(replace(rest, chr(12), ''), '[\s\x0b\x85\p{Z}]+', ' ', 'g')) || CASE WHEN len(folded) > 0 THEN ' ' || array_to_string(folded, ' ') ELSE '' END, chr(12), ''), '[\s\x0b\x85\p{Z}]+', ' ', 'g')) AS statement, dom_near, cat_near, section FROM f WHERE code IS NOT NULL AND NOT regexp_matches(code, '^[246]')),
q AS (SELECT doc_id, annex, line_no, page::BIGINT AS page, code, prefix, profile, statement, coalesce(dom_near, '영역 ' || regexp_extract(code, '([0-9]{2})-[0-9]{2}$', 1)) AS domain,
  CASE WHEN profile = 'middle' THEN CASE WHEN annex >= 16 THEN 'middle-elective' ELSE 'common' END ELSE coalesce(section.c, cat_near, CASE WHEN annex >= 23 THEN 'major-general' WHEN annex >= 19 THEN 'career-elective' ELSE 'common' END) END AS category,
  coalesce(CASE WHEN len(string_split(section.t, ',')) = 2 AND prefix LIKE '%1' THEN trim(string_split(section.t, ',')[1]) WHEN len(string_split(section.t, ',')) = 2 AND prefix LIKE '%2' THEN trim(string_split(section.t, ',')[2]) ELSE trim(regexp_replace(regexp_replace(section.t, '^[-–—]\s*', ''), '^\[|\]$', '', 'g')) END,
   nullif(regexp_replace(prefix, '^[0-9]+', ''), ''), '과목') AS title FROM r WHERE NOT regexp_matches(statement, '두 자리 수로 제시|교과목의 2개 글자를 제시'))
"""


@query(_CODED + "SELECT * FROM q")
def extracted_records(spark: SparkSession, d: str) -> DataFrame:
    """The records of documents, each with its code and context."""
    from tracewright.plans.extraction import extract_records

    return extract_records(_coded_documents(spark, d))


@query(
    _CODED
    + """SELECT 'no-standards-detected' AS type, doc_id::VARCHAR AS doc_id, NULL AS code FROM documents WHERE text IS NOT NULL AND doc_id % 41 BETWEEN 5 AND 39 AND doc_id % 41 <> 15 AND doc_id::VARCHAR NOT IN (SELECT doc_id FROM q WHERE profile IS NOT NULL)
UNION ALL SELECT 'unknown-profile', doc_id, code FROM q WHERE profile IS NULL"""
)
def extraction_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    """Documents in scope that gave no record, and record lines whose code is of no profile."""
    from tracewright.plans.extraction import empty_groups, extract_records, unknown_profiles
    from tracewright.storage import written

    docs = _coded_documents(spark, d)
    records = written(extract_records(docs), "records")
    lost = empty_groups(docs, records).select("type", "doc_id", F.lit(None).cast("string").alias("code"))
    return lost.union(unknown_profiles(records).select("type", "doc_id", "code"))


@query(
    _CODED
    + """, g AS (SELECT *, row_number() OVER (PARTITION BY profile, annex, code ORDER BY annex, line_no, doc_id) AS nth, count(*) OVER (PARTITION BY profile, annex, code) - 1 AS repeats FROM q WHERE profile IS NOT NULL),
i AS (SELECT *, 'course:' || substr(sha256(profile || '|' || category || '|' || title), 1, 16) AS course_id FROM g WHERE nth = 1)
SELECT doc_id, line_no, code, profile, repeats, course_id, 'domain:' || substr(sha256(course_id || '|' || domain), 1, 16) AS domain_id, 'standard:' || substr(sha256(profile || '|' || course_id || '|' || code), 1, 20) AS standard_id FROM i"""
)
def extracted_facts(spark: SparkSession, d: str) -> DataFrame:
    """One record a code with the ids of what it belongs to, and how many were folded into it."""
    from tracewright.plans.extraction import deduplicated, extract_records, with_ids

    records = extract_records(_coded_documents(spark, d)).filter("profile IS NOT NULL")
    return with_ids(deduplicated(records)).select("doc_id", "line_no", "code", "profile", "repeats", "course_id", "domain_id", "standard_id")


@query(None)
def extracted_summaries(spark: SparkSession, d: str) -> DataFrame:
    """Short forms of the records' statements (compatibility forms aren't SQL's; tests compare them with Python's)."""
    from tracewright.plans.extraction import extract_records, summarised

    return summarised(extract_records(_coded_documents(spark, d))).select("doc_id", "line_no", "summary")


# further questions register themselves in modules of their own
from tracewright import entity_queries, release_queries, rule_queries  # noqa: E402, F401
