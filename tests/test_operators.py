import os

import pytest
from pyspark.sql import functions as F

from tracewright.operators import entities, graph, keys, questions, relations, release, report, rules, triples


def bag(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)


# --- keys ----------------------------------------------------------------------------------------------------------------


def test_priority_and_first(spark):
    df = spark.createDataFrame([("a", 10, 2), ("a", 30, 3), ("a", 30, 1), ("b", 10, 4), (None, 1, 5)], "k string, rank int, seq int")
    assert bag(keys.priority_dedup(df, ["k"], F.col("rank"), [F.col("seq")]), "k", "seq") == [("a", 1), ("b", 4), (None, 5)]
    first = keys.dedup_first(df.filter("k IS NOT NULL"), ["k"], [F.col("seq")], {"rank": "ranks"})
    assert bag(first, "k", "seq", "ranks", "repeats") == [("a", 1, [10, 30], 2), ("b", 4, [10], 0)]
    assert bag(keys.dedup_conflicts(df, ["k"], [F.col("seq")], "rank"), "k", "seq", "kept_value") == [("a", 2, 30)]


def test_merge_refs_keeps_groups_without_any(spark):
    df = spark.createDataFrame([("a", ["y", "x"]), ("a", ["x"]), ("b", []), ("c", None)], "k string, refs array<string>")
    assert bag(keys.merge_refs(df, ["k"], "refs")) == [("a", ["x", "y"]), ("b", []), ("c", [])]


def test_exactly_one_and_subkeys(spark):
    df = spark.createDataFrame([("a", "core", 1), ("a", "x", 2), ("b", "core", 3), ("b", "core", 4), ("c", "x", 5)], "p string, f string, id int")
    assert bag(keys.exactly_one(df, "p", F.col("f") == "core", "id")) == [("a", 1, 1), ("b", 2, None), ("c", 0, None)]
    assert bag(keys.unique_subkey(df, "p", "f", "core"), "p") == [("b",), ("c",)]
    assert bag(keys.size_histogram(df, "p")) == [(1, 1), (2, 2)]


# --- relations -----------------------------------------------------------------------------------------------------------


def test_resolution_states(spark):
    dim = spark.createDataFrame([(1, "A 1"), (2, "B"), (3, "B ")], "id int, code string")
    specs = spark.createDataFrame([("[A1]", "A 1"), ("A1", "B"), ("zz", "A1"), ("A1", "zz")], "from_code string, to_code string")
    from tracewright.functions.text import compact

    got = bag(relations.edges_from_specs(specs, dim, "code", "id", compact), "src", "dst", "state")
    assert got == sorted([(1, 1, "ok"), (1, None, "to-ambiguous"), (None, 1, "from-unknown"), (1, None, "to-unknown")], key=str)


def test_references(spark):
    child = spark.createDataFrame([(1, [1, 9]), (None, None), (7, [])], "fk int, many array<int>")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    assert bag(relations.fk_violations(child, "fk", parent, "pk", "r")) == [("r", "7", 1)]
    assert bag(relations.fk_array_violations(child, "many", parent, "pk", "r")) == [("r", "9", 1)]
    assert bag(relations.coverage_both_ways(parent.toDF("k"), spark.createDataFrame([(2,), (3,)], "k int"), "k")) == [("left", 1), ("right", 3)]


def test_pins_and_force(spark):
    releases = spark.createDataFrame([("m", "r2"), ("h", "r1")], "profile string, release_id string")
    pins = spark.createDataFrame([("m", "r1"), ("h", "r1"), ("x", "r0")], "profile string, release_id string")
    assert bag(relations.check_pins(pins, releases)) == [("m", "r1", "r2"), ("x", "r0", None)]
    dated = spark.sql("SELECT * FROM VALUES (1, DATE'2020-01-01', DATE'2020-12-31'), (2, DATE'2020-01-01', NULL), (3, DATE'2022-01-01', NULL) AS t(id, effective_from, effective_to)")
    assert bag(relations.in_force(dated, F.lit("2021-01-01").cast("date")), "id") == [(2,)]


def test_side_by_side(spark):
    df = spark.createDataFrame([(1, "x", 5), (2, "y", 5), (3, "z", 6)], "id int, a string, b int")
    assert bag(relations.compare_rows(df, "id", 1, 2)) == [("a", "x", "y"), ("b", "5", "5")]


# --- graphs --------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("edges", "left"),
    [
        ([(1, 2), (2, 3)], set()),
        ([(1, 2), (1, 3), (2, 4), (3, 4)], set()),
        ([(1, 1)], {1}),
        ([(1, 2), (2, 3), (3, 2), (3, 4)], {2, 3, 4}),
        ([(5, 6), (6, 5), (6, 7), (7, 8), (9, 5)], {5, 6, 7, 8}),
        ([], set()),
    ],
)
def test_peel(spark, edges, left):
    df = spark.createDataFrame(edges, "src int, dst int")
    for local in (0, 1000):
        assert {r["node"] for r in graph.peel(df, local=local).collect()} == left
    assert graph.has_cycle(df) == bool(left)


def test_coverage_and_degrees(spark):
    nodes = spark.createDataFrame([(k,) for k in range(1, 6)], "node int")
    edges = spark.createDataFrame([(1, 2, "a"), (2, 3, "b"), (2, 3, "b"), (4, 4, "c")], "src int, dst int, id string")
    assert graph.graph_coverage(nodes, edges).first().asDict() == {"nodes": 5, "participants": 4, "roots": 2, "isolated": 1, "edges": 4}
    assert bag(graph.degree(nodes, edges, "id")) == [(1, 1), (2, 2), (3, 1), (4, 1), (5, 0)]
    assert bag(graph.dangling(nodes.filter("node < 4"), edges)) == [(4,)]


# --- rules ---------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("rule", "good", "bad"),
    [
        (("required", "s", None), "x", None),
        (("not_blank", "s", None), "x", "  "),
        (("in", "s", ("a", "b")), "a", "c"),
        (("const", "s", "a"), "a", "b"),
        (("pattern", "s", r"^a\z"), "a", "a\n"),
        (("no_pattern", "s", "x"), "a", "ax"),
        (("datatype", "s", "int"), "12", "1x"),
        (("length", "s", (2, 3)), "ab", "a"),
        (("date", "s", None), "2020-02-29", "2021-02-29"),
        (("uri", "s", None), "http://x.example/a", "not a uri"),
        (("local_name", "s", None), "a.pdf", "../a.pdf"),
    ],
)
def test_rule_kinds(spark, rule, good, bad):
    kind, column, argument = rule
    df = spark.createDataFrame([(1, good), (2, bad)], "id int, s string")
    assert [r["key"] for r in rules.check(df, "id", [rules.Rule("r", kind, column, argument)], "t").collect()] == ["2"]


def test_numbers_arrays_and_compound_rules(spark):
    R = rules.Rule
    df = spark.createDataFrame([(1, 5, [1, 2], 5), (2, -1, [1, 1], 0), (3, None, [], None), (4, 9, None, 9)], "id int, n int, a array<int>, m int")
    each = {
        "min": R("min", "min", "n", 0),
        "max": R("max", "max", "n", 8),
        "unique": R("unique", "array", "a", (0, True)),
        "filled": R("filled", "not_empty", "a"),
        "few": R("few", "max_count", "a", 1),
        "any": R("any", "any_of", "", (R("", "required", "n"), R("", "not_empty", "a"))),
        "then": R("then", "if_then", "", (R("", "min", "n", 9), R("", "required", "a"))),
        "null": R("null", "null_or", "n", R("", "min", "n", 5)),
        "loop": R("loop", "no_self_loop", "n", "m"),
        "equal": R("equal", "equal", "n", "m"),
    }
    got = {}
    for r in rules.check(df, "id", each.values(), "t").collect():
        got.setdefault(r["rule_id"], []).append(int(r["key"]))
    want = {"min": [2], "max": [4], "unique": [2], "filled": [3, 4], "few": [1, 2], "any": [3], "then": [1, 2, 3, 4], "null": [2], "loop": [1, 4], "equal": [2]}
    want["then"] = [4]
    assert {k: sorted(v) for k, v in got.items() if k != "then"} == {k: v for k, v in want.items() if k != "then"}
    assert 4 in got["then"]


def test_checks_scan_once(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    plan = rules.check(docs, "doc_id", [rules.Rule(f"r{k}", "max", "n_chars", k) for k in range(5)], "d")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_gates(spark):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    assert rules.assert_all(df, F.col("n") > 0, "no").count() == 2
    with pytest.raises(Exception, match="too small"):
        rules.assert_all(df, F.col("n") > 1, "too small").collect()
    assert bag(rules.expect(df, {"e": F.col("n") > 0}, {"s": F.col("n") > 1}, {"z": F.col("n") > 1})) == [("e", True), ("s", True), ("z", False)]
    assert rules.unexpected_fields(df, ["m"]) == ["n"]


def test_ten_codes(spark):
    cols = "id string, cls string, category string, grade int, status string, kind string, src int, dst int, checked boolean, locator string, flagged boolean, replaces string, released boolean, formal string"
    no = (None,) * 12
    rows = [
        ("g", "high-course", "c", 1, *no[2:]),
        ("x", "course", "c", *no[1:]),
        ("x", "offering", *no),
        ("k", "course", None, *no[1:]),
        ("o", "course-relation", None, None, "candidate", "official-prerequisite", *no[4:]),
        ("l", "relation", None, None, "ok", "required", 1, 1, *no[6:]),
        ("s", "standard", *no[:6], True, None, *no[8:]),
        ("d1", "relation", None, None, "ok", "required", 1, 2, *no[6:]),
        ("d2", "relation", None, None, "ok", "required", 1, 2, *no[6:]),
        ("p", "pathway", *no),
        ("e", "topic", *no[:9], "old", *no[10:]),
        ("r", "release", *no[:10], True, "formal-validation-passed"),
        ("fine", "pathway", *no[:8], True, *no[9:]),
    ]
    got = bag(rules.adversarial_codes(spark.createDataFrame(rows, cols)))
    assert len(got) == 10 and {i for _, i in got} == {"g", "x", "k", "o", "l", "s", "d2", "p", "e", "r"}


# --- reports, releases, triples, entities ----------------------------------------------------------------------------------


def test_counts_with_nulls(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("a", 2)], "x string, y int")
    assert bag(report.count_by(df, ["x", "y"])) == sorted([("x", "a", 2), ("x", None, 1), ("y", "1", 2), ("y", "2", 1), ("total", None, 3)], key=str)
    e, a = (spark.createDataFrame(r, "dataset string, metric string, value long") for r in ([("d", "m", 1), ("d", "n", 2)], [("d", "m", 1), ("e", "n", 2)]))
    assert bag(report.reconcile_counts(e, a)) == [("d", "n", 2, None), ("e", "n", None, 2)]


def test_fingerprint_ignores_order_and_partitions(spark):
    df = spark.range(200).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL ELSE cast(id AS string) END AS s")
    prints = {release.fingerprint(d).first() for d in (df, df.repartition(7), df.orderBy(F.desc("id")))}
    assert len(prints) == 1
    assert release.fingerprint(df.union(df.limit(1))).first() not in prints
    assert not release.is_stale(df, df.repartition(3)) and release.is_stale(df, df.limit(199))


def test_manifests_and_drift(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "Y"), (4, None)], "k int, v string")
    assert bag(release.drift(a, b, "k")) == [(2, "changed"), (3, "lost"), (4, "added")]
    m, n = release.manifest({"a": a, "b": b}), release.manifest({"a": a, "b": a, "c": a})
    assert bag(release.verify_manifest(m, n)) == [("a", "same"), ("b", "changed"), ("c", "unlisted")]
    assert release.bundle(m).first() != release.bundle(n).first()
    assert bag(release.lost_keys(a, b, "k")) == [(3,)]


def test_triples(spark):
    df = spark.createDataFrame([(1, "n", ["a", "b"], 7), (2, None, [], None), (3, "q", None, 7)], "id int, name string, refs array<string>, parent int")
    t = triples.to_triples(df, F.concat(F.lit("x:"), F.col("id").cast("string")), "X", {"name": ("label", "xsd:string")}, {"refs": ("ref", "r:")}, {"parent": ("in", "p:")})
    assert bag(t, "s", "p", "o") == [("x:1", "in", "p:7"), ("x:1", "label", "n"), ("x:1", "ref", "r:a"), ("x:1", "ref", "r:b"), ("x:1", "type", "X"), ("x:2", "type", "X"), ("x:3", "in", "p:7"), ("x:3", "label", "q"), ("x:3", "type", "X")]
    assert bag(triples.match(t, ("?a", "in", "?p"), ("?b", "in", "?p")), "a", "b") == [("x:1", "x:1"), ("x:1", "x:3"), ("x:3", "x:1"), ("x:3", "x:3")]
    lines = {r["value"] for r in triples.n_triples(t).collect()}
    assert '<x:1> <label> "n"^^<xsd:string> .' in lines and "<x:1> <ref> <r:a> ." in lines
    context = spark.createDataFrame([("label", "http://l")], "name string, iri string")
    assert triples.expand_names(t, context).filter("p = 'http://l'").count() == 2


def test_reasoning_is_one_step(spark):
    t = spark.createDataFrame([("s", "inDomain", "d", "iri", None, None), ("c", "courseRelation", "e", "iri", None, None)], "s string, p string, o string, o_kind string, datatype string, lang string")
    domains = spark.createDataFrame([("inDomain", "Standard")], "p string, domain string")
    types = triples.infer_subclass(triples.infer_domain_types(t, domains), spark.createDataFrame([("Standard", "Thing")], "sub string, super string"))
    assert bag(types) == [("s", "Standard"), ("s", "Thing")]


def test_entities(spark):
    df = spark.createDataFrame([("g", "a"), ("g", "b"), ("h", "a"), ("h", "a")], "grp string, opt string")
    assert bag(entities.choice_sets(df, "grp", "opt"), "grp", "options") == [("g", ["a", "b"])]
    groups = spark.createDataFrame([("g", ["f"], ["x", "y"]), ("h", [], ["z"])], "grp string, f array<string>, o array<string>")
    labels = spark.createDataFrame([("f", "Base"), ("x", "X")], "k string, l string")
    got = bag(entities.label_steps(entities.pathways(groups, "grp", "f", "o"), "grp", labels, "k", "l"))
    assert got == [("g", 1, "foundation", ["Base"]), ("g", 2, "alternatives", ["X", "y"]), ("h", 1, "alternatives", ["z"])]
    facets = spark.createDataFrame([("t", "f1", "F one")], "kind string, facet string, label string")
    rows = spark.createDataFrame([("p1", "t"), ("p2", "u")], "id string, kind string")
    assert bag(entities.children(rows, facets, "kind", "id", "c:"), "parent", "facet") == [("p1", "core"), ("p1", "f1"), ("p2", "core")]
    release_row = spark.createDataFrame([("r", {"a": 1, "b": 2})], "release_id string, counts map<string,bigint>")
    counts = spark.createDataFrame([("r", "b", 5), ("r", "c", 6)], "release_id string, metric string, value long")
    assert entities.refresh_release(release_row, counts).first()["counts"] == {"a": 1, "b": 5, "c": 6}


def test_progressions_and_index(spark):
    groups = spark.createDataFrame([("A", 1), ("B", 2), ("B", 3)], "label string, id int")
    pairs = spark.createDataFrame([("A", "A"), ("A", "B"), ("Z", "A")], "from_label string, to_label string")
    assert bag(entities.progressions(pairs, groups, "label", "id"), "from_label", "to_label", "state") == [("A", "A", "ok"), ("A", "B", "to-unresolved"), ("Z", "A", "from-unresolved")]
    edges = spark.createDataFrame([(1, 9)], "src int, dst int")
    index = entities.transition_index(entities.alignments(edges, "bridge"), groups, "id", "label").first()
    assert (index["from_label"], index["to_label"]) == ("A", "9")


def test_questions(spark):
    tables = {
        "pathway": spark.sql("SELECT 'p' AS id, 'l' AS label, true AS unofficial, array(named_struct('order', 1, 'kind', 'f', 'reason', 'r', 'choice_set', cast(null AS string), 'course_ids', array('a', 'b')), named_struct('order', 2, 'kind', 'o', 'reason', 'r', 'choice_set', 'cs', 'course_ids', cast(array() AS array<string>))) AS steps"),
        "transition": spark.sql("SELECT 1 AS id, array('https://x/#/topic/1', 'own') AS from_topics, array('t1', 't2') AS to_topics"),
    }
    assert bag(questions.illustrative_pathways(tables), "order", "course", "choice_set") == [(1, "a", None), (1, "b", None), (2, None, "cs")]
    assert questions.outside_bridge(tables).count() == 2 and questions.no_learner_data(tables)
    assert set(questions.QUESTIONS) == {f"q{k:02d}" for k in range(1, 21)}
    df = spark.createDataFrame([("A b", "x"), ("c", "y")], "t string, f string")
    assert questions.text_search(df, ["t", "f"], " B X ").count() == 1 and questions.text_search(df, ["t"], " ").count() == 2
    assert questions.facet_filter(df, f="y", t=None).count() == 1


def plain_components(edges):
    after = {}
    for a, b in edges:
        after.setdefault(a, set()).add(b)
    reach = {}
    for start in {x for e in edges for x in e}:
        seen, going = set(), [start]
        while going:
            new = after.get(going.pop(), set()) - seen
            seen |= new
            going += new
        reach[start] = seen
    return {n: min(m for m in reach[n] if n in reach[m]) for n in reach if n in reach[n]}


@pytest.mark.parametrize(("seed", "local"), [(1, 0), (2, 0), (2, 12), (3, 10**6)])
def test_components_and_downstream_of_random_graphs(spark, seed, local):
    import random

    draw = random.Random(seed)
    edges = [(draw.randrange(40), draw.randrange(40)) for _ in range(30 + 12 * seed)]
    edges += edges[:5]
    df = spark.createDataFrame([*edges, (None, 3), (4, None)], "a long, b long")
    want = plain_components(edges)
    got = graph.strong_components(df, "a", "b", local)
    assert {r["node"]: r["component"] for r in got.collect()} == want and got.count() == len(want)
    left = set(want)
    while more := {b for a, b in edges if a in left} - left:
        left |= more
    assert {r["node"] for r in graph.peel(df, "a", "b", local).collect()} == left
    for r in graph.cycle_witnesses(df, got, "a", "b").collect():
        own = {n for n, c in want.items() if c == r["component"]}
        assert r["nodes"] == len(own) and (r["from_node"], r["to_node"]) == min(e for e in edges if own >= set(e))


def test_rounds_grow_with_the_logarithm_of_ladders(spark, monkeypatch):
    """A ladder i -> i+1, i+2, a chain, and a loop with a long tail: without a loop, then with one."""
    names, write = [], graph.written
    monkeypatch.setattr(graph, "written", lambda df, name: (names.append(name), write(df, name))[1])
    counts = []
    for n in (24, 120):
        ladder = [(k, k + j) for k in range(n) for j in (1, 2)]
        df = spark.createDataFrame(ladder, "src long, dst long")
        names.clear()
        assert graph.strong_components(df, local=0).isEmpty()
        counts.append(len(names))
    assert counts[1] < 3 * counts[0] < 400
    names.clear()
    loop = spark.createDataFrame([(1000, 1001), (1001, 1000), *[(k, k + 1) for k in range(1001, 1060)]], "src long, dst long")
    assert graph.peel(loop, local=0).count() == 61 and len(names) < 150


def test_strings_are_nodes_too(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("e", "e"), ("e", "a")], "src string, dst string")
    for local in (0, 100):
        assert bag(graph.strong_components(df, local=local), "node", "component") == [("a", "a"), ("b", "a"), ("c", "a"), ("e", "e")]


def test_closure(spark):
    chain = [(k, k + 1) for k in range(20)] + [(5, 30), (30, 31), (5, 6)]
    after = {a: {b for x, b in chain if x == a} for a, _ in chain}
    want = set()
    for a in after:
        going = [a]
        while going:
            for b in after.get(going.pop(), ()):
                if (a, b) not in want:
                    want.add((a, b))
                    going.append(b)
    df = spark.createDataFrame([*chain, (None, 1)], "src int, dst int")
    assert set(map(tuple, graph.closure(df).collect())) == want
    assert graph.closure(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="cycle"):
        graph.closure(spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "src int, dst int"))
    ends = relations.replacement_ends(spark.createDataFrame([(1, 2), (2, 3), (7, 8), (7, 1)], "old int, new int"))
    assert bag(ends, "old", "new") == [(1, 3), (2, 3), (7, 3), (7, 8)]


def plain_match(rows, patterns):
    found = [{}]
    for pattern in patterns:
        now = []
        for known in found:
            for row in rows:
                new = dict(known)
                if all(new.setdefault(x, v) == v if x.startswith("?") else x == v for x, v in zip(pattern, row, strict=True)):
                    now.append(new)
        found = now
    return sorted(tuple(sorted(f.items())) for f in found)


@pytest.mark.parametrize("most", [1, 2, 256])
def test_star_patterns_keep_bags(spark, most):
    import random

    draw = random.Random(most)
    rows = [(draw.choice("abcd"), draw.choice("pqrt"), draw.choice("abcdxy")) for _ in range(60)]
    df = spark.createDataFrame(rows, "s string, p string, o string")
    for patterns in (
        [("?s", "p", "?x"), ("?s", "q", "?y"), ("?s", "r", "x")],
        [("?s", "p", "?x"), ("?s", "p", "?y"), ("?s", "q", "?s")],
        [("?s", "p", "?x"), ("?x", "q", "?y"), ("?x", "r", "?y"), ("?y", "t", "?s")],
        [("?s", "?any", "?x"), ("?s", "t", "?x"), ("?s", "r", "?x")],
        [("a", "p", "?x"), ("?x", "q", "?y")],
        [("?x", "p", "?x")],
    ):
        got = triples.match(df, *patterns, most=most)
        assert got.columns == list(dict.fromkeys(x[1:] for t in patterns for x in t if x.startswith("?")))
        assert sorted(tuple(sorted((f"?{k}", v) for k, v in r.asDict().items())) for r in got.collect()) == plain_match(rows, patterns)
    with pytest.raises(ValueError, match="no variable"):
        triples.match(df, ("?a", "p", "?b"), ("?c", "q", "?d"))


def test_a_star_of_five_patterns_is_one_exchange(spark):
    df = spark.createDataFrame([("a", p, "1") for p in "pqrtu"], "s string, p string, o string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = triples.match(df, *[("?s", p, f"?{p}") for p in "pqrtu"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_first_rows_need_one_exchange(spark):
    df = spark.createDataFrame([(k % 3, -k, k % 5) for k in range(40)] + [(1, None, 9), (None, 1, 1)], "k int, at int, v int")
    first = keys.dedup_first(df, ["k"], [F.col("at")], {"v": "vs"})
    assert bag(first, "k", "at", "v", "vs", "repeats") == [(0, -39, 4, [0, 1, 2, 3, 4], 13), (1, None, 9, [0, 1, 2, 3, 4, 9], 13), (2, -38, 3, [0, 1, 2, 3, 4], 12)]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan
    rows, kept = [tuple(r) for r in df.collect()], {0: 4, 1: 9, 2: 3, None: 1}
    want = sorted(((*r, kept[r[0]]) for r in rows if r[2] != kept[r[0]]), key=str)
    assert bag(keys.dedup_conflicts(df, ["k"], [F.col("at")], "v")) == want


def test_hash_trees(spark, tmp_path):
    rows = [(k, f"v{k}") for k in range(3000)]
    new = [(k, "changed" if k == 77 else v) for k, v in rows if k != 1500] + [(9000, "more"), (5, "v5")]
    a, b = (spark.createDataFrame(r, "k long, v string") for r in (rows, new))
    for name, df in (("a", a), ("b", b.repartition(3))):
        release.write_hashed(df, ["k"], str(tmp_path / name), bits=7, step=3)
    stored, tree = release.read_hashed(spark, str(tmp_path / "a"))
    assert stored.count() == 3000 and tree.filter("level = 0").select("n").first()["n"] == 3000 and tree.filter("level = 3").agg({"n": "sum"}).first()[0] == 3000
    _, other = release.read_hashed(spark, str(tmp_path / "b"))
    at = {r["k"]: r["leaf"] for r in a.union(b).select("k", release.leaf_of(["k"], 7).alias("leaf")).collect()}
    got = {r["node"] for r in release.changed_ranges(tree, other, 7, 3).collect()}
    assert got == {at[k] for k in (77, 1500, 9000, 5)} and release.changed_ranges(tree, tree, 7, 3).count() == 0
    found, files_read = release.changed_rows(spark, str(tmp_path / "a"), str(tmp_path / "b"), 7, 3)
    assert bag(found, "side", "k", "v") == [("new", 5, "v5"), ("new", 77, "changed"), ("new", 9000, "more"), ("stored", 1500, "v1500"), ("stored", 77, "v77")]
    assert files_read <= 2 * len(got) < len(stored.inputFiles()) / 4
    assert release.changed_rows(spark, str(tmp_path / "a"), str(tmp_path / "a"), 7, 3)[1] == 0


def test_shared_folder(spark):
    import pytest

    from tracewright import storage

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="checkpoint"):
        storage.shared_dir(Session())
    t = storage.written(spark.range(3), "t")
    path = t.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert os.path.isdir(path)
    storage.dropped(t)
    assert not os.path.exists(path)


def test_written_tables_leave_no_shuffle_files(spark):
    """A table stands for the shuffles that made it; the session's own setting stays."""
    from tracewright import storage

    store, known = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager(), spark.conf.get(storage.CLEANUP)
    files = lambda: {x.rsplit("/", 1)[-1] for x in store.diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in x}
    before = files()
    t = storage.written(spark.range(1000).groupBy(F.col("id") % 7).count(), "t")
    assert not files() - before and t.count() == 7 and spark.conf.get(storage.CLEANUP) == known
