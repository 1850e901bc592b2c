"""Domain questions on entity tables (a dict of DataFrames by name): bags of rows, as many as multi-valued properties make.

Tables and columns: course(id, label, category, level, grades, status, review), domain, standard(id, code, course_id,
domain_id, source_id, page), topic(id, domain_id, alignments ARRAY<STRUCT<standard_id, kind, basis>>, evidence, prompts),
relation(id, src, dst, kind, reason, basis, review), course_relation, transition(id, from_courses, to_courses, from_topics,
to_topics, kind, reason, basis, review), choice_set(id, kind, least, most, course_ids), credit_rule(id, start, end, kind,
value, unit), offering(id, course_id), pathway(id, label, unofficial, steps), gap(id, description, severity, status),
source(id, name), learner.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.operators.entities import union_all

Tables = dict[str, DataFrame]


def _edges(t: Tables) -> DataFrame:
    return union_all([t[n].select("id", "kind", "reason", "basis", "review") for n in ("relation", "course_relation", "transition")])


def courses(t: Tables) -> DataFrame:
    return t["course"].select("id", "label", "category", "level")


def standards_topics(t: Tables) -> DataFrame:
    topics = t["topic"].select(F.col("id").alias("topic"), "domain_id", F.explode("alignments").alias("a")).select("topic", "domain_id", F.col("a.standard_id").alias("standard"))
    return t["standard"].select(F.col("id").alias("standard"), "course_id", "domain_id").join(topics, ["standard", "domain_id"])


def standard_alignments(t: Tables) -> DataFrame:
    return t["topic"].select(F.col("id").alias("topic"), F.explode("alignments").alias("a")).select("topic", "a.standard_id", "a.kind", "a.basis")


def evidence_prompts(t: Tables) -> DataFrame:
    return t["topic"].select(F.col("id").alias("topic"), F.explode("evidence").alias("evidence"), "prompts").select("topic", "evidence", F.explode("prompts").alias("prompt"))


def learning_relations(t: Tables) -> DataFrame:
    return t["relation"].select("id", "src", "dst", "kind")


def relation_review(t: Tables) -> DataFrame:
    return _edges(t).select("id", "review", "reason", "basis")


def transitions(t: Tables) -> DataFrame:
    rows = t["transition"].select("id", F.explode("from_courses").alias("from_course"), "to_courses", "kind", "reason", "basis")
    return rows.withColumn("to_course", F.explode("to_courses")).drop("to_courses")


def course_relations(t: Tables) -> DataFrame:
    return t["course_relation"].select("id", "src", "dst", "kind")


def choice_sets(t: Tables) -> DataFrame:
    return t["choice_set"].select("id", "kind", "least", "most", F.explode("course_ids").alias("course"))


def credit_rules(t: Tables) -> DataFrame:
    return t["credit_rule"].select("id", "kind", "value", "unit", "start", "end")


def course_offerings(t: Tables) -> DataFrame:
    return t["course"].select(F.col("id").alias("course")).join(t["offering"].select(F.col("id").alias("offering"), F.col("course_id").alias("course")), "course", "left")


def unspecified_grade(t: Tables) -> DataFrame:
    return t["course"].filter((F.col("level") == "high") & (F.col("grades").isNull() | (F.size("grades") == 0))).select("id", "label")


def illustrative_pathways(t: Tables) -> DataFrame:
    steps = t["pathway"].select("id", "label", "unofficial", F.explode("steps").alias("s"))
    return steps.select("id", "label", "unofficial", "s.order", "s.kind", "s.reason", "s.choice_set", F.explode_outer("s.course_ids").alias("course"))


def source_locators(t: Tables) -> DataFrame:
    return t["standard"].select(F.col("id").alias("standard"), "source_id", "page").join(t["source"].select(F.col("id").alias("source_id"), "name"), "source_id")


def independent_status(t: Tables) -> DataFrame:
    """Of every table that has a verification status: its rows' three statuses, those that a table lacks as nulls."""
    parts = []
    for df in t.values():
        if "verification" in df.columns:
            parts.append(df.select("id", "verification", *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in ("review", "rights")]))
    return union_all(parts)


def coverage_gaps(t: Tables) -> DataFrame:
    return t["gap"].select("id", "description", "severity", "status")


def review_queue(t: Tables) -> DataFrame:
    return _edges(t).filter("review = 'candidate'").select("id", "kind")


def outside_bridge(t: Tables, mark: str = "/#/topic/") -> DataFrame:
    rows = t["transition"].select("id", F.explode("from_topics").alias("from_topic"), "to_topics").filter(F.col("from_topic").contains(mark))
    return rows.select("id", "from_topic", F.explode("to_topics").alias("to_topic"))


def no_learner_data(t: Tables) -> bool:
    return "learner" not in t or t["learner"].isEmpty()


QUESTIONS: dict[str, Callable] = {
    "q01": courses,
    "q02": standards_topics,
    "q03": standard_alignments,
    "q04": evidence_prompts,
    "q05": learning_relations,
    "q06": relation_review,
    "q07": transitions,
    "q08": course_relations,
    "q09": choice_sets,
    "q10": credit_rules,
    "q11": course_offerings,
    "q12": unspecified_grade,
    "q13": illustrative_pathways,
    "q14": choice_sets,
    "q15": source_locators,
    "q16": independent_status,
    "q17": coverage_gaps,
    "q18": review_queue,
    "q19": outside_bridge,
    "q20": no_learner_data,
}


def facet_filter(df: DataFrame, **facets) -> DataFrame:
    """Equality on each facet; None or 'all' means any value."""
    for col, value in facets.items():
        if value is not None and value != "all":
            df = df.filter(F.col(col) == value)
    return df


def text_search(df: DataFrame, cols: list[str], query: str) -> DataFrame:
    """Rows whose columns, joined by blanks, hold the query; case doesn't matter. An empty query finds all."""
    return df.filter(F.lower(F.concat_ws(" ", *cols)).contains(query.strip().lower())) if query.strip() else df


def top(df: DataFrame, k: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(k)
