"""Each shape has a row that passes and one that fails; nested references; rendered texts."""

import pytest
from pyspark.sql import functions as F

from tracewright.functions import text as tx
from tracewright.operators import relations, release, report
from tracewright.operators.rules import check
from tracewright.plans import catalogue

GOOD = {
    "release": "SELECT 'r-1' AS id, '1.2.3' AS version, 'cleared' AS rights",
    "course": "SELECT 'course:1' AS id, 'Maths' AS label, 'g' AS group_id, 'common' AS category, 'high' AS level, cast(array() AS array<int>) AS grades",
    "standard": "SELECT 'std' AS id, '9' AS code, 'c' AS course_id, 'd' AS domain_id, named_struct('page', 3) AS locator, false AS official_text, 'derived' AS summary_kind",
    "locator": "SELECT 'l' AS id, 's' AS source_id, 3 AS page",
    "topic": "SELECT 'topic:1' AS id, 'T' AS label, 'd' AS domain_id, array('e') AS evidence, array('p') AS prompts, array(1) AS alignments",
    "cluster": "SELECT 'cluster:1' AS id, 'C' AS label, 'c' AS course_id, 'd' AS domain_id, array('t', 'u') AS topic_ids",
    "relation": "SELECT 'e' AS id, 'a' AS src, 'b' AS dst, 'required' AS kind, 'required' AS strength, 'why' AS reason, array('s') AS refs, 'official' AS basis",
    "transition": "SELECT 't' AS id, array('a') AS from_topics, array('b') AS to_topics, cast(array() AS array<string>) AS from_courses, array('c') AS to_courses, 'why' AS reason, array('s') AS refs",
    "course_relation": "SELECT 'cr' AS id, 'a' AS src, 'b' AS dst, 'official-prerequisite' AS kind, 'official-constraint' AS status, array('s') AS refs",
    "choice_set": "SELECT 'cs' AS id, array('a', 'b') AS course_ids, 0 AS least, cast(null AS int) AS most",
    "credit_rule": "SELECT 'cr' AS id, '2025-03-01' AS start, 'least' AS kind, 'credit' AS unit, 192 AS value",
    "pathway": "SELECT 'p' AS id, true AS unofficial, array(1) AS steps",
    "step": "SELECT 's' AS id, 1 AS order, cast(array() AS array<string>) AS course_ids, 'cs' AS choice_set",
    "source": "SELECT 's' AS id, 'n' AS name, repeat('a', 64) AS sha256, 'https://x.example/a' AS url, 'a.pdf' AS file, 5 AS bytes",
    "gap": "SELECT 'g' AS id, 'missing' AS description, 'high' AS severity, 'open' AS status",
}
BAD = {
    "release": ("rights", "'hold'"),
    "course": ("grades", "array(7)"),
    "standard": ("locator", "cast(null AS struct<page:int>)"),
    "locator": ("page", "0"),
    "topic": ("evidence", "cast(array() AS array<string>)"),
    "cluster": ("topic_ids", "array('t', 't')"),
    "relation": ("dst", "'a'"),
    "transition": ("to_topics", "cast(array() AS array<string>)"),
    "course_relation": ("status", "'candidate'"),
    "choice_set": ("course_ids", "array('a')"),
    "credit_rule": ("start", "'2025-02-30'"),
    "pathway": ("unofficial", "false"),
    "step": ("choice_set", "cast(null AS string)"),
    "source": ("file", "'../a.pdf'"),
    "gap": ("severity", "'dire'"),
}


@pytest.mark.parametrize("name", sorted(GOOD))
def test_shapes(spark, name):
    good = spark.sql(GOOD[name])
    column, value = BAD[name]
    rules = catalogue.shapes()[name]
    assert check(good, "id", rules, name).count() == 0
    assert check(good.withColumn(column, F.expr(value)), "id", rules, name).count() >= 1


def test_specs(spark):
    cols = "id int, from_code string, to_code string, label string, page int, reason string"
    rows = [(1, "a", "b", "x", 13, "r"), (2, "a", "a", "x", 13, "r"), (3, "a", "b", "x", 1500, "r"), (4, "a", "b", "x" * 41, 1, None), (5, "", "b", None, None, "q" * 81)]
    got = {(r["key"], r["rule_id"], r["severity"]) for r in check(spark.createDataFrame(rows, cols), "id", catalogue.spec_rules(), "spec").collect()}
    assert got == {("2", "spec.loop", "error"), ("3", "spec.page-high", "error"), ("4", "spec.label", "error"), ("5", "spec.from", "error"), ("5", "spec.reason", "warn")}


def test_all_refs(spark):
    df = spark.sql("SELECT 1 AS id, array('a', 'b') AS source_refs, named_struct('course_id', 'c', 'n', 1) AS one, array(named_struct('topic_ids', array('t', 'u')), named_struct('topic_ids', cast(null AS array<string>))) AS steps")
    got = sorted((r["path"], r["ref"]) for r in relations.all_refs(df, "id").collect())
    assert got == [("one.course_id", "c"), ("source_refs", "a"), ("source_refs", "b"), ("steps.topic_ids", "t"), ("steps.topic_ids", "u")]


def test_rendering_and_order(spark):
    df = spark.createDataFrame([("a", 1, None), ("z", 2, "x")], "kind string, n int, s string")
    assert [r[0] for r in df.select(tx.render([("a", "%s-%s!")], "kind", "n", "s", default="%s%s")).collect()] == ["1-!", "2x"]
    names = spark.createDataFrame([("나",), ("가",), ("다",)], "w string")
    assert [r["w"] for r in report.locale_order(names, "w", "ko").collect()] == ["가", "나", "다"]
    assert release.is_deterministic(lambda: df, 3)
    assert df.select(tx.canonical_json(F.create_map(F.lit("b"), "n", F.lit("a"), "n")).alias("j")).first()["j"] == '{"a":1,"b":1}'


def test_extraction_leaves_out_what_is_no_record(spark):
    from tracewright.plans import extraction

    line = "[9국어01-01] 글을 읽고 뜻을 이해할 수 있다."
    docs = [("a", 5, line), ("b", 15, line), ("c", 40, line), ("d", 6, "no record"), ("e", 7, "[9국어01-02] 학년을 두 자리 수로 제시한다."), ("f", 18, "[4국어01-01] 다른 학년이다."), ("g", 10, "[국어01-01] 갈래를 모른다.")]
    docs = spark.createDataFrame(docs, "doc_id string, annex int, text string")
    found = extraction.extract_records(docs)
    assert sorted((r["doc_id"], r["profile"], r["statement"]) for r in found.collect()) == [("a", "middle", "글을 읽고 뜻을 이해할 수 있다."), ("g", None, "갈래를 모른다.")]
    assert sorted(r["doc_id"] for r in extraction.empty_groups(docs, found).collect()) == ["d", "e", "f", "g"]
    assert [tuple(r) for r in extraction.unknown_profiles(found).collect()] == [("unknown-profile", "g", "국어01-01", 1)]
    assert [r["summary"] for r in extraction.summarised(found.filter("doc_id = 'a'")).collect()] == ["글을 읽고 뜻을 이해하기"]


def test_compatible_forms(spark):
    import unicodedata

    rows = ["plain", "１２가", "ﬁn", "한글", "ㅎㅏㄴ", "é", "", None]
    df = spark.createDataFrame([(x,) for x in rows], "x string")
    assert [r["y"] for r in df.select(tx.compatible("x").alias("y")).collect()] == [x and unicodedata.normalize("NFKC", x) for x in rows]


def test_canonical_json_sorts_at_every_depth(spark):
    df = spark.sql("SELECT named_struct('b', 1, 'a', named_struct('z', array(named_struct('y', 1, 'x', cast(null AS int))), 'm', map('q', 1, 'p', 2))) AS v")
    assert df.select(tx.canonical_json("v", df.schema["v"].dataType).alias("j")).first()["j"] == '{"a":{"m":{"p":2,"q":1},"z":[{"y":1}]},"b":1}'


def test_edge_spec_modules(spark, tmp_path):
    import json

    from tracewright.sources import files

    modules = {"a": {"subject": "art", "annexId": "x1", "level": "middle", "middleRequired": [["A", "B", "why", 13], ["A", "B", "again", 0], ["A"]], "elementaryToMiddleRequired": [["e1", "Z", "dom", 5, "label"]]}, "b": {"subject": "high art", "annexId": "x2", "level": "high", "highCommentaryRequired": [["H1", "H1", 1500, "t" * 90]], "middleRequired": [["A", "B", "w", 1]]}}
    for name, body in modules.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(body, indent=1))
    specs = files.edge_specs(spark, str(tmp_path))
    assert sorted((r["subject"], r["kind"], r["place"], r["arity"], r["page"]) for r in specs.collect())[0] == ("art", "elementaryToMiddleRequired", 0, 5, 5)
    known = spark.createDataFrame([("A", "x1"), ("B", "x1"), ("H1", "x9")], "code string, annex string")
    got = sorted((r["rule_id"], r["key"]) for r in catalogue.module_violations(specs, known).collect())
    high, middle = "high art/highCommentaryRequired/0", "art/middleRequired"
    assert got == sorted([("spec.arity", f"{middle}/2"), ("spec.page", f"{middle}/1"), ("spec.pair", f"{middle}/1"), ("spec.code", "art/elementaryToMiddleRequired/0"), ("spec.loop", high), ("spec.page", high), ("spec.text", high), ("spec.own", high), ("spec.level", "high art/middleRequired/0")])
