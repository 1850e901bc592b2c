"""Rule sets for the entity tables of a curriculum: shapes of 18 kinds of rows, and the rules across fields and tables.

Vocabularies differ between releases, so they are parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.operators.keys import duplicate_keys
from tracewright.operators.relations import coverage_both_ways, fk_violations, missing_keys
from tracewright.operators.report import reconcile_counts
from tracewright.operators.rules import Rule, as_violation, cardinality, check, violations

#: The form of an id, and the words that the tables' columns take.
ID = r"^[a-z0-9][a-z0-9._:-]*\z"
SEVERITIES, STATES = ("low", "medium", "high", "critical"), ("open", "in-progress", "closed", "accepted")


def _base(entity: str) -> list[Rule]:
    return [Rule(f"{entity}.id", "required", "id"), Rule(f"{entity}.id-form", "pattern", "id", ID), Rule(f"{entity}.id-length", "length", "id", (3, 240)), Rule(f"{entity}.label", "not_blank", "label")]


def _filled(entity: str, *columns: str) -> list[Rule]:
    return [Rule(f"{entity}.{c}", "required", c) for c in columns]


def shapes(severities: tuple = SEVERITIES, states: tuple = STATES) -> dict[str, list[Rule]]:
    """Row rules by kind of table."""
    R = Rule
    topics = (R("", "not_empty", "from_topics"), R("", "not_empty", "to_topics"))
    courses = (R("", "not_empty", "from_courses"), R("", "not_empty", "to_courses"))
    both = lambda pair: R("", "expression", "", pair[0].holds() & pair[1].holds())
    return {
        "release": [*_filled("release", "id", "version"), R("release.rights", "const", "rights", "cleared"), R("release.version-form", "pattern", "version", r"^\d+\.\d+\.\d+\z")],
        "subject_group": [*_base("subject_group"), R("subject_group.level", "in", "level", ("middle", "high"))],
        "course": [*_base("course"), *_filled("course", "group_id", "category"), R("course.level", "in", "level", ("middle", "high")), R("course.grade", "if_then", "grades", (R("", "const", "level", "high"), R("", "max_count", "grades", 0)))],
        "domain": [*_base("domain"), *_filled("domain", "course_id")],
        "standard": [*_filled("standard", "id", "code", "course_id", "domain_id", "locator"), R("standard.official", "const", "official_text", False), R("standard.kind", "const", "summary_kind", "derived")],
        "locator": [*_filled("locator", "source_id"), R("locator.page", "min", "page", 1), R("locator.page-kind", "datatype", "page", "int")],
        "topic": [*_base("topic"), *_filled("topic", "domain_id"), R("topic.evidence", "not_empty", "evidence"), R("topic.prompts", "not_empty", "prompts"), R("topic.alignments", "not_empty", "alignments")],
        "middle_topic": [R("middle_topic.level", "const", "level", "middle")],
        "cluster": [*_base("cluster"), *_filled("cluster", "course_id", "domain_id"), R("cluster.topics", "array", "topic_ids", (1, True))],
        "relation": [R("relation.loop", "no_self_loop", "src", "dst"), R("relation.kind", "in", "kind", ("required", "supporting")), R("relation.strength", "if_then", "strength", (R("", "const", "kind", "required"), R("", "const", "strength", "required"))), R("relation.reason", "not_blank", "reason"), R("relation.refs", "not_empty", "refs"), R("relation.basis", "const", "basis", "official")],
        "transition": [R("transition.ends", "any_of", "", (both(topics), both(courses))), R("transition.reason", "not_blank", "reason"), R("transition.refs", "not_empty", "refs")],
        "course_relation": [R("course_relation.loop", "no_self_loop", "src", "dst"), R("course_relation.claim", "if_then", "status", (R("", "const", "kind", "official-prerequisite"), R("", "const", "status", "official-constraint"))), R("course_relation.refs", "not_empty", "refs")],
        "choice_set": [R("choice_set.courses", "array", "course_ids", (2, True)), R("choice_set.least", "min", "least", 0), R("choice_set.most", "null_or", "most", R("", "min", "most", 1))],
        "credit_rule": [*_filled("credit_rule", "start", "kind", "unit"), R("credit_rule.value", "min", "value", 0), R("credit_rule.start-form", "date", "start")],
        "pathway": [R("pathway.boundary", "const", "unofficial", True), R("pathway.flag", "required", "unofficial"), R("pathway.steps", "not_empty", "steps")],
        "step": [R("step.order", "min", "order", 1), R("step.choice", "any_of", "", (R("", "not_empty", "course_ids"), R("", "required", "choice_set")))],
        "source": [*_filled("source", "id", "name"), R("source.hash", "pattern", "sha256", r"^[0-9a-f]{64}\z"), R("source.url", "uri", "url"), R("source.file", "local_name", "file"), R("source.size", "min", "bytes", 1)],
        "gap": [R("gap.text", "not_blank", "description"), R("gap.severity", "in", "severity", severities), R("gap.status", "in", "status", states)],
    }


def check_tables(tables: dict[str, DataFrame], rules: dict[str, list[Rule]] | None = None) -> DataFrame:
    """All row rules of the tables that are there, each table in one scan. Rules of columns that a table lacks are left out."""
    rules, parts = rules or shapes(), []
    for name, df in tables.items():
        mine = [r for r in rules.get(name, []) if not r.column or r.column in df.columns]
        if mine:
            parts.append(check(df, "id", mine, name))
    return violations(*parts)


def governance(edges: DataFrame, reviews: DataFrame, topics: DataFrame, standards: DataFrame, low: int = 2, high: int = 5) -> DataFrame:
    """Rules across tables: reviews cover all edges and nothing else; candidates have no reviewer; every standard has low..high topics; topics stand on standards.

    edges (id, status, reviewer), reviews (id), topics (id, standard_id), standards (id).
    """
    uncovered = coverage_both_ways(edges, reviews, "id")
    counts = cardinality(standards, "id", topics, "standard_id", low, high)
    return violations(
        as_violation(uncovered, "review-coverage", "edge", F.col("id"), F.col("side")),
        as_violation(edges.filter("status = 'candidate' AND reviewer IS NOT NULL"), "candidate-reviewed", "edge", F.col("id"), F.col("reviewer")),
        as_violation(counts, "topics-per-standard", "standard", F.col("id"), F.col("n")),
        as_violation(fk_violations(topics, "standard_id", standards, "id", "topic-standard"), "topic-standard", "topic", F.col("ref"), F.col("rows")),
    )


def spec_rules(most_page: int = 1499) -> list[Rule]:
    """Rows of edge specs (id, from_code, to_code, label, page, reason): codes given and different, a page, short texts."""
    R = Rule
    return [
        R("spec.from", "not_blank", "from_code"),
        R("spec.to", "not_blank", "to_code"),
        R("spec.loop", "no_self_loop", "from_code", "to_code"),
        R("spec.page-low", "min", "page", 1),
        R("spec.page-high", "max", "page", most_page),
        R("spec.label", "length", "label", (1, 40)),
        R("spec.reason", "length", "reason", (0, 80), "warn"),
        R("spec.quote", "no_pattern", "reason", '["“][^"“”]{60,}["”]', "warn"),
    ]


#: How edges and children say where they come from.
OFFICIAL, BANNED_BASIS, FACET_BASIS = "official-source", "official-code-order-candidate-v1", "middle-subject-facet-decomposition-v1"
CORE, FACET = "standard-core", "subject-facet"


def decomposition_rules() -> list[Rule]:
    """Topics (id, decomposition, facet, bases ARRAY) of standards: of a known kind, a core with the core's facet, a facet with its basis."""
    R = Rule
    of = lambda kind: R("", "const", "decomposition", kind)
    known = R("", "expression", "", F.coalesce(F.col("decomposition").isin(CORE, FACET) & F.col("facet").isNotNull(), F.lit(False)))
    return [
        R("decomposition.kind", "any_of", "decomposition", (known,)),
        R("decomposition.core", "if_then", "facet", (of(CORE), R("", "expression", "", F.coalesce(F.col("facet") == "core", F.lit(False))))),
        R("decomposition.basis", "if_then", "facet", (of(FACET), R("", "expression", "", F.coalesce(F.array_contains("bases", FACET_BASIS), F.lit(False))))),
    ]


def learning_rules() -> list[Rule]:
    """Learning relations (id, basis, review, basis_kind, refs, kind, strength): not by order of codes, reviewed, from an official source, of a strength that fits."""
    R = Rule
    official = R("", "expression", "", F.coalesce(F.col("basis_kind") == OFFICIAL, F.lit(False)))
    required = R("", "expression", "", F.coalesce((F.col("basis_kind") == OFFICIAL) & (F.col("strength") == "required"), F.lit(False)))
    return [
        R("learning.automatic", "not", "basis", R("", "any_of", "", (R("", "const", "basis", BANNED_BASIS), R("", "const", "review", "candidate")))),
        R("learning.source", "expression", "basis_kind", official.argument & F.coalesce(F.size("refs") > 0, F.lit(False))),
        R("learning.required", "if_then", "strength", (R("", "const", "kind", "required-prerequisite"), required)),
        R("learning.recommended", "if_then", "strength", (R("", "const", "kind", "recommended-before"), R("", "expression", "", F.coalesce(F.col("strength") == "recommended", F.lit(False))))),
    ]


def group_rules(entity: str) -> list[Rule]:
    """Relations of groups (id, status, review, basis_kind, basis, refs): a reviewed recommendation from an official source, with a basis."""
    all_of = [F.col("status") == "reviewed-recommendation", F.col("review") == "internal-reviewed", F.col("basis_kind") == OFFICIAL, F.length("basis") > 0, F.size("refs") > 0]
    held = F.lit(True)
    for p in all_of:
        held = held & F.coalesce(p, F.lit(False))
    return [Rule(f"{entity}.provenance", "expression", "status", held)]


def transition_rules() -> list[Rule]:
    """Transitions (id, review, from_courses, to_courses, from_topics, to_topics, basis_kind, refs): reviewed, with courses on both sides, one topic on each, and a source."""
    R = Rule
    return [
        R("transition.review", "const", "review", "internal-reviewed"),
        R("transition.anchors", "expression", "", F.coalesce((F.size("from_courses") > 0) & (F.size("to_courses") > 0), F.lit(False))),
        R("transition.one-from", "size", "from_topics", 1),
        R("transition.one-to", "size", "to_topics", 1),
        R("transition.official", "expression", "basis_kind", F.coalesce((F.col("basis_kind") == OFFICIAL) & (F.size("refs") > 0), F.lit(False))),
    ]


def without_review(edges: DataFrame, reviews: DataFrame, entity: str) -> DataFrame:
    """Edges (id) that no review (targets ARRAY) names."""
    named = reviews.select(F.explode("targets").alias("id"))
    return as_violation(missing_keys(edges, named, "id"), f"{entity}.reviewed", entity, F.col("id"), F.lit(None))


def official_only(tables: dict[str, DataFrame]) -> DataFrame:
    """Edges of any of several tables (id, basis_kind) that aren't from an official source."""
    parts = []
    for name, df in tables.items():
        rows = df.filter(~F.coalesce(F.col("basis_kind") == OFFICIAL, F.lit(False)))
        parts.append(as_violation(rows, "edge.official", name, F.col("id"), F.col("basis_kind")))
    return violations(*parts)


def repeated_identities(courses: DataFrame) -> DataFrame:
    """Courses that share group, category and label with another one: (key, detail) is the identity and how many have it."""
    again = duplicate_keys(courses, ["group_id", "category", "label"])
    return as_violation(again, "course.identity", "course", F.concat_ws("|", "group_id", "category", "label"), F.col("n"))


def children_bounds(parents: DataFrame, children: DataFrame, low: float, high: float, rule_id: str, entity: str) -> DataFrame:
    """One violation if a table has fewer than low or more than high times as many rows as its parents' table."""
    n = parents.agg(F.count(F.lit(1)).alias("p")).crossJoin(children.agg(F.count(F.lit(1)).alias("c")))  # one row each
    return as_violation(n.filter(~F.col("c").between(F.col("p") * low, F.col("p") * high)), rule_id, entity, F.lit("table"), F.concat_ws("/", "c", "p"))


def uncleared(sources: DataFrame, releases: DataFrame) -> DataFrame:
    """Sources and releases (id, rights) whose rights aren't cleared."""
    held = lambda df, entity: as_violation(df.filter(~F.col("rights").eqNullSafe(F.lit("cleared"))), f"{entity}.rights", entity, F.col("id"), F.col("rights"))
    return violations(held(sources, "source"), held(releases, "release"))


def stale_statistics(shown: DataFrame, counted: DataFrame, parts: dict[tuple[str, str], tuple[str, ...]]) -> DataFrame:
    """Statistics (dataset, metric, value) that aren't the counts, and totals (dataset, metric) that their parts, other metrics of the dataset, don't add up to."""
    stale = as_violation(reconcile_counts(shown, counted), "statistics.stale", "statistics", F.concat_ws("/", "dataset", "metric"), F.concat_ws("/", "expected", "actual"))
    sums = []
    for (dataset, metric), names in parts.items():
        mine = shown.filter(F.col("dataset") == dataset)
        both = mine.agg(F.sum(F.when(F.col("metric").isin(*names), F.col("value"))).alias("parts"), F.sum(F.when(F.col("metric") == metric, F.col("value"))).alias("total"))
        sums.append(as_violation(both.filter(~F.col("parts").eqNullSafe(F.col("total"))), "statistics.split", "statistics", F.lit(f"{dataset}/{metric}"), F.concat_ws("/", "parts", "total")))
    return violations(stale, *sums)


def unresolved(diagnostics: DataFrame) -> DataFrame:
    """A violation for each type of diagnostics that there are any of."""
    n = diagnostics.groupBy("type").agg(F.count(F.lit(1)).alias("n"))
    return as_violation(n, "diagnostics.none", "diagnostics", F.col("type"), F.col("n"))


#: Which lists of a spec module a high module keeps empty, which name a code of ours on one side only, and which need an end of the module's own annex.
MIDDLE_LISTS = ("middleRequired", "middleCommentaryRequired", "elementaryToMiddleRequired", "elementaryCommentaryRequired")
ELEMENTARY_LISTS = ("elementaryToMiddleRequired", "elementaryCommentaryRequired")
HIGH_LISTS = ("highRequired", "highCommentaryRequired")


def module_violations(specs: DataFrame, known: DataFrame, longest: int = 80, most_page: int = 1499) -> DataFrame:
    """What is wrong with the rows of edge-spec modules (see sources.files.edge_specs), against known codes (code, annex).

    Tuples have their list's length; codes are known (the first of an elementary list is not ours); pages are in range; texts
    are given and short; no loops; no pair twice in a module; high modules keep the middle lists empty; of a high edge an end
    at least belongs to the module's annex.
    """
    from tracewright.sources.files import SPEC_LISTS

    R = Rule
    kind, at = F.col("kind"), F.concat_ws("/", "subject", "kind", F.col("place").cast("string"))
    arity = F.create_map(*[x for name, columns in SPEC_LISTS.items() for x in (F.lit(name), F.lit(len(columns)))])
    rows = specs.withColumn("key", at).withColumn("pair", F.concat_ws(" ", "from_code", "to_code"))
    whole = rows.filter(F.col("arity") == arity[kind])
    row_rules = [
        R("spec.loop", "expression", "pair", F.col("from_code") != F.col("to_code")),
        R("spec.page", "expression", "page", F.coalesce(F.col("page").between(1, most_page), F.lit(False))),
        R("spec.text", "expression", "text", F.coalesce(F.length("text").between(1, F.when(kind.isin(*ELEMENTARY_LISTS), 80).otherwise(longest)), F.lit(False))),
        R("spec.domain", "expression", "domain", F.col("domain").isNull() | F.length("domain").between(1, 40)),
        R("spec.level", "expression", "kind", ~((F.col("level") == "high") & kind.isin(*MIDDLE_LISTS))),
    ]
    first = F.struct("kind", "place")
    pairs = whole.groupBy("subject", "from_code", "to_code").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("subject", "from_code", "to_code", "first")
    again = whole.join(pairs, ["subject", "from_code", "to_code"]).filter(first != F.col("first"))
    asked = F.when(kind.isin(*ELEMENTARY_LISTS), F.array("to_code")).otherwise(F.array("from_code", "to_code"))
    codes = whole.select("key", F.explode(asked).alias("code"))
    lost = codes.join(known.select("code").distinct(), "code", "left_anti")
    high = whole.filter(kind.isin(*HIGH_LISTS)).select("key", "annex", F.explode(F.array("from_code", "to_code")).alias("code"))
    own = high.select("key", "annex").distinct().join(high.join(known, ["code", "annex"]).select("key").distinct(), "key", "left_anti")
    return violations(
        as_violation(rows.filter(F.col("arity") != arity[kind]), "spec.arity", "spec", F.col("key"), F.col("arity")),
        check(whole, "key", row_rules, "spec"),
        as_violation(again, "spec.pair", "spec", F.col("key"), F.col("pair")),
        as_violation(lost, "spec.code", "spec", F.col("key"), F.col("code")),
        as_violation(own, "spec.own", "spec", F.col("key"), F.col("annex")),
    )
