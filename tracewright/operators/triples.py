"""Entities as long (s, p, o) triples, and questions on them as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.operators.graph import closure

COLUMNS = ("s", "p", "o", "o_kind", "datatype", "lang")


def to_triples(df: DataFrame, subject: Column, cls: str, scalars: dict[str, tuple[str, str | None]], arrays: dict[str, tuple[str, str]] | None = None, references: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Triples of a table: its class, a literal for each scalar (column -> predicate, datatype), a node for each reference and array element (column -> predicate, prefix).

    A null and an empty array both give no triple. One pass: a row's triples are built as an array and exploded.
    """
    t = lambda p, o, kind, datatype=None: F.struct(F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit(kind).alias("o_kind"), F.lit(datatype).cast("string").alias("datatype"), F.lit(None).cast("string").alias("lang"))
    one = [t("type", F.lit(cls), "iri")]
    one += [F.when(F.col(c).isNotNull(), t(p, F.col(c), "literal", d)) for c, (p, d) in scalars.items()]
    one += [F.when(F.col(c).isNotNull(), t(p, F.concat(F.lit(prefix), F.col(c).cast("string")), "iri")) for c, (p, prefix) in (references or {}).items()]
    each = lambda c, p, prefix: F.transform(F.coalesce(F.col(c), F.array()), lambda x: t(p, F.concat(F.lit(prefix), x.cast("string")), "iri"))
    many = [each(c, p, prefix) for c, (p, prefix) in (arrays or {}).items()]
    return df.select(subject.alias("s"), F.explode(F.concat(F.array_compact(F.array(*one)), *many)).alias("t")).select("s", "t.*")


def expand_names(triples: DataFrame, context: DataFrame) -> DataFrame:
    """Predicates replaced by their full names from a context table (name, iri); unknown ones stay."""
    return triples.join(context.select(F.col("name").alias("p"), "iri"), "p", "left").withColumn("p", F.coalesce("iri", "p")).select(*COLUMNS)


def infer_domain_types(triples: DataFrame, domains: DataFrame) -> DataFrame:
    """Types (s, type) that follow from predicates' domains (p, domain)."""
    return triples.join(domains, "p").select("s", F.col("domain").alias("type")).distinct()


def infer_subclass(types: DataFrame, subclass: DataFrame) -> DataFrame:
    """types (s, type) with those of all classes above (sub, super), however many levels; a class above itself is refused."""
    above = closure(subclass, "sub", "super").select(F.col("src").alias("type"), F.col("dst").alias("super"))
    return types.select("s", "type").union(types.join(above, "type").select("s", F.col("super").alias("type"))).distinct()


def graph_counts(triples: DataFrame) -> DataFrame:
    return triples.agg(F.count(F.lit(1)).alias("triples"), F.count_distinct("s").alias("nodes"), F.count_if(F.col("p") == "type").alias("types"), F.count_if(F.col("o_kind") == "literal").alias("literals"))


#: Objects of one predicate that a subject may have for the predicate to be gathered in its row.
MOST_OBJECTS = 256


def match(triples: DataFrame, *patterns: tuple[str, str, str], most: int = MOST_OBJECTS) -> DataFrame:
    """Rows that fulfil all patterns (s, p, o); names with '?' are variables, others constants. Repeats stay (bag semantics).

    Patterns of one subject and given predicates are a star: one shuffle by subject gathers the objects of only those
    predicates, one list a pattern, and the lists are exploded; no join is needed. Predicates of which some subject has more
    than ``most`` objects, counted first, are joined instead, so no list is long. Stars and other patterns are then joined in
    the order of their counted rows, each with what shares a variable with it. Columns are the variables, in the order in
    which the patterns name them.
    """
    names = list(dict.fromkeys(x[1:] for t in patterns for x in t if x.startswith("?")))
    counted = triples.agg(*[F.count_if(_holds(t)).alias(str(k)) for k, t in enumerate(patterns)]).first()
    sizes = {t: counted[str(k)] for k, t in enumerate(patterns)}
    units = []
    for subject in dict.fromkeys(t[0] for t in patterns):
        own = [t for t in patterns if t[0] == subject]
        fixed = [t for t in own if subject.startswith("?") and not t[1].startswith("?")]
        heavy = _heavy(triples, {t[1] for t in fixed}, most) if len(fixed) > 1 else set()
        star = [t for t in fixed if t[1] not in heavy]
        if len(star) > 1:
            units.append((min(sizes[t] for t in star), _star(triples, star)))
            own = [t for t in own if t not in star]
        units += [(sizes[t], _single(triples, t)) for t in own]
    units.sort(key=lambda u: u[0])
    out = units.pop(0)[1]
    while units:
        at = next((k for k, (_, part) in enumerate(units) if set(part.columns) & set(out.columns)), None)
        if at is None:
            raise ValueError(f"no variable joins {units[0][1].columns} to {out.columns}")
        part = units.pop(at)[1]
        out = out.join(part, [n for n in part.columns if n in out.columns])
    return out.select(*names)


def _holds(pattern: tuple[str, str, str]) -> Column:
    """Whether a triple fits the pattern's constants, and its variables where they repeat."""
    out, seen = F.lit(True), {}
    for c, x in zip(("s", "p", "o"), pattern, strict=True):
        if not x.startswith("?"):
            out = out & (F.col(c) == x)
        elif x in seen:
            out = out & (F.col(c) == F.col(seen[x]))
        else:
            seen[x] = c
    return F.coalesce(out, F.lit(False))


def _single(triples: DataFrame, pattern: tuple[str, str, str]) -> DataFrame:
    at = {x[1:]: c for c, x in reversed(list(zip(("s", "p", "o"), pattern, strict=True))) if x.startswith("?")}
    return triples.filter(_holds(pattern)).select(*[F.col(c).alias(n) for n, c in at.items()])


def _heavy(triples: DataFrame, predicates: set[str], most: int) -> set[str]:
    """Those predicates of which some subject has more than ``most`` objects."""
    each = triples.filter(F.col("p").isin(*predicates)).groupBy("s", "p").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
    return {r["p"] for r in each.select("p").distinct().collect()}  # of the asked ones


def _star(triples: DataFrame, star: list[tuple[str, str, str]]) -> DataFrame:
    subject, lists = star[0][0][1:], [f"_o{k}" for k in range(len(star))]
    rows = triples.filter(F.col("p").isin(*{t[1] for t in star}) & F.col("s").isNotNull())
    gathered = rows.groupBy("s").agg(*[F.collect_list(F.when(_holds(t), F.col("o"))).alias(n) for t, n in zip(star, lists, strict=True)])
    for n in lists:
        gathered = gathered.filter(F.size(n) > 0)
    out, known = gathered.withColumnRenamed("s", subject), {subject}
    for (_, _, o), n in zip(star, lists, strict=True):
        out = out.withColumn(n, F.explode(n))
        if o.startswith("?"):
            out = out.filter(F.col(n) == F.col(o[1:])) if o[1:] in known else out.withColumn(o[1:], F.col(n))
            known.add(o[1:])
        out = out.drop(n)
    return out


def n_triples(df: DataFrame) -> DataFrame:
    """Lines (value) of the triples: IRIs in angle brackets, literals quoted, with their datatype or language."""
    quoted = F.concat(F.lit('"'), F.replace(F.replace(F.replace(F.col("o"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")), F.lit('"'))
    literal = F.concat(quoted, F.coalesce(F.concat(F.lit("^^<"), F.col("datatype"), F.lit(">")), F.concat(F.lit("@"), F.col("lang")), F.lit("")))
    o = F.when(F.col("o_kind") == "iri", F.concat(F.lit("<"), F.col("o"), F.lit(">"))).otherwise(literal)
    return df.select(F.concat(F.lit("<"), F.col("s"), F.lit("> <"), F.col("p"), F.lit("> "), o, F.lit(" .")).alias("value"))


def write_triples(df: DataFrame, path: str) -> None:
    n_triples(df).write.text(path)
