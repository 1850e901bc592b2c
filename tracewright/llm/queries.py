"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tracewright.llm.common import documents


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tracewright.llm.quality import quality_scores

    return quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tracewright.llm.toxicity import toxicity_scores

    return toxicity_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tracewright.llm.mixing import mixed

    return mixed(documents(spark, sf_dir)).drop("tie", "copies")


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tracewright.llm.suffixes import without_repeated_bytes

    return without_repeated_bytes(documents(spark, sf_dir))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tracewright.llm.fingerprints import fingerprints

    return fingerprints(documents(spark, sf_dir))


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tracewright.llm.orderminhash import near_duplicates

    return near_duplicates(documents(spark, sf_dir))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tracewright.llm.packing import packed_documents

    return packed_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tracewright.llm.automata import without_repeated_spans

    return without_repeated_spans(documents(spark, sf_dir))


def op8_benchmark_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The broadcast form: all documents stream against suffix automata of the benchmark, whose words are counted first."""
    from tracewright.llm.automata import remove_reference_spans

    return remove_reference_spans(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tracewright.llm.licenses import license_scan

    return license_scan(documents(spark, sf_dir), runs=True)


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tracewright.llm.media import media_columns

    return media_columns(documents(spark, sf_dir))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tracewright.llm.centroids import clusters

    return clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tracewright.llm.languages import languages

    return languages(documents(spark, sf_dir))


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tracewright.llm.alignment import alignments

    return alignments(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_toxicity": op2_toxicity,
    "op3_mixing": op3_mixing,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_order_minhash": op6_order_minhash,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_substring_dedup": op8_substring_dedup,
    "op8_benchmark_spans": op8_benchmark_spans,
    "op9_license_scan": op9_license_scan,
    "op10_media_columns": op10_media_columns,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_language_id": op12_language_id,
    "op13_cross_tokenizer_alignment": op13_cross_tokenizer_alignment,
}



def _license_sql() -> str:
    from tracewright.llm.licenses import LEAST, TEMPLATES

    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"({k}, {quoted(name)}, {quoted(text)})" for k, (name, text) in enumerate(TEMPLATES))
    grams = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    words = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"
    return rf"""
WITH tw AS (SELECT k, name, {words.format("x")} AS w FROM (VALUES {known}) AS v(k, name, x)), t AS (SELECT k, name, {grams} AS g FROM tw),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
u AS (SELECT DISTINCT doc_id, unnest(list_concat(list_concat(string_split(text, chr(10)), regexp_split_to_array(text, '
[ 	
]*
')), [text])) AS x FROM d),
uw AS (SELECT doc_id, {words.format("x")} AS w FROM u), p AS (SELECT doc_id, {grams} AS g FROM uw WHERE len(w) > 1),
m AS (SELECT doc_id, k, name, 2.0::DOUBLE * len(list_intersect(p.g, t.g)) / (len(p.g) + len(t.g)) AS dice FROM p JOIN t ON len(p.g) BETWEEN {LEAST / (2 - LEAST) - 1e-9} * len(t.g) AND {(2 - LEAST) / LEAST + 1e-9} * len(t.g)),
units AS (SELECT * FROM m WHERE dice >= {LEAST}),
pw AS (SELECT doc_id, {words.format("text")} AS w FROM d), pg AS (SELECT doc_id, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS g FROM pw WHERE len(w) > 1),
pos AS (SELECT doc_id, unnest(g) AS x, generate_subscripts(g, 1) AS i FROM pg), tx AS (SELECT k, len(g) AS n, unnest(g) AS x FROM t),
near AS (SELECT doc_id, k, n, i, x FROM pos JOIN tx USING (x)), ok AS (SELECT doc_id, k, n FROM near GROUP BY ALL HAVING count(DISTINCT x) >= n * {LEAST / (2 - LEAST)} - 1e-9),
run AS (SELECT a.doc_id, a.k, a.n, a.i, z.i AS j FROM ok JOIN near a ON ok.doc_id = a.doc_id AND ok.k = a.k JOIN near z ON z.doc_id = a.doc_id AND z.k = a.k AND z.i >= a.i AND (z.i - a.i) * {LEAST / (2 - LEAST)} < a.n),
rd AS (SELECT run.doc_id, run.k, list_distinct(pg.g[i:j]) AS r, t.g AS tg, t.name FROM run JOIN pg ON pg.doc_id = run.doc_id JOIN t ON t.k = run.k),
best_run AS (SELECT doc_id, k, name, max(2.0::DOUBLE * len(list_intersect(r, tg)) / (len(r) + len(tg))) AS dice FROM rd GROUP BY 1, 2, 3),
every AS (SELECT doc_id, k, name, dice FROM units UNION ALL SELECT doc_id, k, name, dice FROM best_run ANTI JOIN units USING (doc_id, k) WHERE dice >= {LEAST}),
b AS (SELECT doc_id, k, name, dice, count(*) OVER (PARTITION BY doc_id) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, k) AS r FROM every)
SELECT d.doc_id, name AS license, k::INT AS template, coalesce(dice, 0.0)::DOUBLE AS dice, coalesce(n, 0)::BIGINT AS n_matches FROM d LEFT JOIN b ON d.doc_id = b.doc_id AND r = 1
"""


def _cluster_sql() -> str:
    from tracewright.llm.centroids import CLUSTERS, DIMENSIONS, ROUNDS, SCALE

    floored = lambda x, n: f"({x} - (({x} % {n}) + {n}) % {n}) // {n}"
    steps = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS})""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, q) - 1 AS j, q AS c FROM (SELECT q, sha256('3:' || coalesce(vec_id::VARCHAR, '')) AS h FROM v ORDER BY h, q LIMIT {CLUSTERS}))",
    ]
    for t in range(ROUNDS + 1):
        d = "list_sum(list_transform(list_zip(q, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
        steps.append(f"a{t} AS MATERIALIZED (SELECT r, any_value(vec_id) AS vec_id, any_value(q) AS q, arg_min(j, (d, j)) AS j, min(d) AS d FROM (SELECT r, vec_id, q, j, {d} AS d FROM v, c{t}) GROUP BY r)")
        if t < ROUNDS:
            steps.append(f"m{t} AS (SELECT j, list({floored('s', 'n')} ORDER BY i) AS c FROM (SELECT j, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT j, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM a{t}) GROUP BY j, i) GROUP BY j)")
            steps.append(f"c{t + 1} AS MATERIALIZED (SELECT j, coalesce(m{t}.c, c{t}.c) AS c FROM c{t} LEFT JOIN m{t} USING (j))")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, j::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY j))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{ROUNDS} JOIN c{ROUNDS} USING (j)
"""


ORACLES: dict[str, str] = {
    "op11_centroid_clustering": _cluster_sql(),
    "op4_suffix_array_dedup": """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT doc_id, b, unnest(range(1, octet_length(b) - 398)) AS s FROM d),
h AS (SELECT doc_id, s, md5(b[s:s + 399]) AS k FROM w),
r AS (SELECT doc_id, s FROM (SELECT *, count(*) OVER (PARTITION BY k) AS n FROM h) WHERE n > 1),
e AS (SELECT doc_id, s, max(s + 400) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM r),
n AS (SELECT doc_id, s, sum(CASE WHEN before >= s THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM e),
spans AS (SELECT doc_id, span, min(s) AS a, max(s) + 400 AS z FROM n GROUP BY 1, 2),
edges AS (SELECT doc_id, list(a ORDER BY a) AS a, list(z ORDER BY a) AS z FROM spans GROUP BY 1),
k AS (SELECT d.doc_id, octet_length(b)::BIGINT AS n_bytes, b, coalesce(a, []) AS a, coalesce(z, []) AS z FROM d LEFT JOIN edges USING (doc_id))
SELECT doc_id, n_bytes, coalesce(list_sum(z) - list_sum(a), 0)::BIGINT AS n_removed, len(a)::BIGINT AS n_spans,
  sha256(unhex(array_to_string(list_transform(range(1, len(a) + 2), lambda i: hex(b[(CASE WHEN i = 1 THEN 1 ELSE z[i - 1] END):(CASE WHEN i > len(a) THEN n_bytes ELSE a[i] - 1 END)])), ''))) AS kept_sha256 FROM k
""",
    "op8_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM d),
h AS (SELECT doc_id, s, md5(array_to_string(ws[s:s + 19], ' ')) AS k FROM w),
r AS (SELECT doc_id, s FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM h) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, s + unnest(range(0, 20)) AS p FROM r),
words AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
""",
    "op8_benchmark_spans": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents), b AS (SELECT regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM benchmark),
known AS (SELECT DISTINCT array_to_string(ws[s:s + 19], ' ') AS k FROM (SELECT ws, unnest(range(1, len(ws) - 18)) AS s FROM b)),
r AS (SELECT doc_id, s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM d) WHERE array_to_string(ws[s:s + 19], ' ') IN (SELECT k FROM known)),
gone AS (SELECT DISTINCT doc_id, s + unnest(range(0, 20)) AS p FROM r),
words AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, coalesce(t, '') AS kept FROM d LEFT JOIN kept USING (doc_id)
""",
    "op9_license_scan": _license_sql(),
}
