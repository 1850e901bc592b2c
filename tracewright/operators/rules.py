"""Data-quality rules as data: one pass over a table for all its row rules, one row a violation.

A rule is (id, kind, column, argument, severity). ``check`` turns row rules into boolean columns of one projection and
explodes those that fail; set rules (keys, references, numbers of children) come from the operators for them and are united
by ``violations``.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """What must hold of each row. ``kind`` names an entry of KINDS; null values pass every kind but ``required``."""

    id: str
    kind: str
    column: str = ""
    argument: object = None
    severity: str = "error"

    def holds(self) -> Column:
        return F.coalesce(KINDS[self.kind](self), F.lit(True))


def _c(r: Rule) -> Column:
    return F.col(r.column)


def _any(r: Rule) -> Column:
    out = F.lit(False)
    for part in r.argument:
        out = out | part.holds()
    return out


KINDS = {
    "required": lambda r: _c(r).isNotNull(),
    "not_blank": lambda r: F.coalesce(F.length(F.trim(_c(r))) > 0, F.lit(False)),
    "not_empty": lambda r: F.coalesce(F.size(_c(r)) > 0, F.lit(False)),
    "max_count": lambda r: F.size(_c(r)) <= r.argument,
    "in": lambda r: _c(r).isin(*r.argument),
    "const": lambda r: _c(r) == F.lit(r.argument),
    "pattern": lambda r: _c(r).rlike(r.argument),
    "no_pattern": lambda r: ~_c(r).rlike(r.argument),
    "datatype": lambda r: _c(r).isNull() | _c(r).cast("string").try_cast(r.argument).isNotNull(),
    "min": lambda r: _c(r) >= F.lit(r.argument),
    "max": lambda r: _c(r) <= F.lit(r.argument),
    "length": lambda r: F.length(_c(r)).between(*r.argument),
    "array": lambda r: (F.size(_c(r)) >= r.argument[0]) & ((F.size(F.array_distinct(_c(r))) == F.size(_c(r))) if r.argument[1] else F.lit(True)),
    "any_of": _any,
    "if_then": lambda r: ~F.coalesce(r.argument[0].holds(), F.lit(False)) | r.argument[1].holds(),
    "null_or": lambda r: _c(r).isNull() | r.argument.holds(),
    "no_self_loop": lambda r: _c(r) != F.col(r.argument),
    "date": lambda r: _c(r).isNull() | F.try_to_timestamp(_c(r).cast("string"), F.lit(r.argument or "yyyy-MM-dd")).isNotNull(),
    "uri": lambda r: _c(r).rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:\S+\z"),
    "uri_reference": lambda r: _c(r).rlike(r"^[^\s<>\"{}|\\^`]*\z"),
    "iri": lambda r: _c(r).rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:[^\s<>\"{}|\\^`]+\z"),
    "not": lambda r: ~r.argument.holds(),
    "size": lambda r: F.coalesce(F.size(_c(r)) == r.argument, F.lit(False)),
    "local_name": lambda r: ~(_c(r).contains("/") | _c(r).contains("..")),
    "equal": lambda r: _c(r).eqNullSafe(F.col(r.argument)),
    "expression": lambda r: r.argument,
}


def check(df: DataFrame, key: str, rules: Iterable[Rule], entity: str) -> DataFrame:
    """(rule_id, severity, entity, key, detail): the rows and rules that fail, from a single scan."""
    failed = [F.when(~r.holds(), F.struct(F.lit(r.id).alias("rule_id"), F.lit(r.severity).alias("severity"), (_c(r).cast("string") if r.column else F.lit(None).cast("string")).alias("detail"))) for r in rules]
    each = df.select(F.col(key).cast("string").alias("key"), F.explode(F.array_compact(F.array(*failed))).alias("v"))
    return each.select("v.rule_id", "v.severity", F.lit(entity).alias("entity"), "key", "v.detail")


def violations(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def as_violation(df: DataFrame, rule_id: str, entity: str, key: Column, detail: Column, severity: str = "error") -> DataFrame:
    """Rows that a set rule found, in the shape of ``check``."""
    return df.select(F.lit(rule_id).alias("rule_id"), F.lit(severity).alias("severity"), F.lit(entity).alias("entity"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))


def cardinality(parent: DataFrame, pk: str, child: DataFrame, fk: str, low: int, high: int) -> DataFrame:
    """(pk, n): parents with fewer than low or more than high children, childless ones counted."""
    n = child.groupBy(F.col(fk).alias(pk)).agg(F.count(F.lit(1)).alias("_n"))
    rows = parent.select(pk).join(n, pk, "left").select(pk, F.coalesce("_n", F.lit(0)).cast("long").alias("n"))
    return rows.filter(~F.col("n").between(low, high))


def unexpected_fields(df: DataFrame, allowed: Iterable[str]) -> list[str]:
    """Columns that a closed schema doesn't have. Only names are looked at."""
    return sorted(set(df.columns) - set(allowed))


def unexpected_json_fields(df: DataFrame, json_col: str, allowed: Iterable[str]) -> DataFrame:
    """(field, rows): top-level fields of JSON texts that a closed schema doesn't have."""
    keys = F.json_object_keys(F.col(json_col))
    return df.select(F.explode(keys).alias("field")).filter(~F.col("field").isin(*allowed)).groupBy("field").agg(F.count(F.lit(1)).alias("rows"))


def assert_all(df: DataFrame, predicate: Column, message: str) -> DataFrame:
    """df, failing as it runs at the first row for which the predicate doesn't hold (a null fails too)."""
    return df.filter(F.when(F.coalesce(predicate, F.lit(False)), True).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def expect(df: DataFrame, every: dict[str, Column] | None = None, some: dict[str, Column] | None = None, none: dict[str, Column] | None = None) -> DataFrame:
    """(expectation, holds): whether predicates hold of all, of some, or of no rows."""
    checks = [F.struct(F.lit(n).alias("expectation"), F.coalesce(F.bool_and(F.coalesce(p, F.lit(False))), F.lit(True)).alias("holds")) for n, p in (every or {}).items()]
    checks += [F.struct(F.lit(n).alias("expectation"), F.coalesce(F.bool_or(F.coalesce(p, F.lit(False))), F.lit(False)).alias("holds")) for n, p in (some or {}).items()]
    checks += [F.struct(F.lit(n).alias("expectation"), (F.count_if(F.coalesce(p, F.lit(False))) == 0).alias("holds")) for n, p in (none or {}).items()]
    return df.agg(F.array(*checks).alias("c")).select(F.inline("c"))


def split_valid_rejects(df: DataFrame, known: Column, silent: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that are known, rows for the diagnostics); rows that are out of scope without notice are in neither."""
    known, silent = F.coalesce(known, F.lit(False)), F.coalesce(silent, F.lit(False))
    return df.filter(known & ~silent), df.filter(~known & ~silent)


def relation_rules(prefix: str = "relation") -> list[Rule]:
    """What holds of every qualified edge: no loop, a source, and a strength that fits its kind."""
    required = Rule(f"{prefix}-kind", "const", "kind", "required")
    return [
        Rule(f"{prefix}-loop", "no_self_loop", "src", "dst"),
        Rule(f"{prefix}-source", "not_empty", "refs"),
        Rule(f"{prefix}-strength", "if_then", "strength", (required, Rule("", "const", "strength", "required"))),
        Rule(f"{prefix}-basis", "const", "basis", "official"),
        Rule(f"{prefix}-reason", "not_blank", "reason"),
    ]


def adversarial_codes(rows: DataFrame) -> DataFrame:
    """(code, id) of rows (id, cls, category, grade, status, kind, src, dst, checked, locator, flagged, replaces, released, formal) that break one of ten rules.

    The rules: a high course has no grade; no id is both course and offering; courses have categories; candidates aren't
    official prerequisites; no relation leads to itself; checked standards have a locator; relations are asserted once;
    pathways are flagged as not official; ids of others aren't coined anew; what is on hold isn't released.
    """
    is_a = lambda *names: F.col("cls").isin(*names)
    row = {
        "HIGH_GRADE_FORCED": is_a("high-course") & F.col("grade").isNotNull(),
        "COURSE_CATEGORY_MISSING": is_a("course", "high-course") & F.col("category").isNull(),
        "CANDIDATE_OFFICIALIZED": (F.col("kind") == "official-prerequisite") & (F.col("status") == "candidate"),
        "LEARNING_RELATION_CYCLE": is_a("relation") & (F.col("src") == F.col("dst")),
        "OFFICIAL_LOCATOR_MISSING": is_a("standard") & F.col("checked") & F.col("locator").isNull(),
        "PATHWAY_BOUNDARY_MISSING": is_a("pathway") & ~F.coalesce(F.col("flagged"), F.lit(False)),
        "ELEMENTARY_IRI_REMINTED": F.col("replaces").isNotNull(),
        "RIGHTS_HOLD_BYPASSED": F.col("released") & (F.col("formal") == "formal-validation-passed"),
    }
    found = rows.select("id", F.explode(F.array_compact(F.array(*[F.when(p, F.lit(code)) for code, p in row.items()]))).alias("code")).select("code", "id")
    both = rows.filter(is_a("course", "high-course")).select("id").intersect(rows.filter(is_a("offering")).select("id")).select(F.lit("COURSE_OFFERING_CONFLATION").alias("code"), "id")
    again = rows.filter(is_a("relation")).groupBy("src", "dst", "kind").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("id")).filter("n > 1").select(F.lit("DUPLICATE_RELATION_ASSERTION").alias("code"), "id")
    return found.union(both).union(again).distinct()
