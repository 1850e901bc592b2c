"""From documents to coded records: one plan from lines to deduplicated rows with their context."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.text import bracket_code, clean_title, code_prefix, compact, compatible, content_id, first_match, matched, norm_code, norm_ws, rewrite_first, truncate_words
from tracewright.operators.keys import dedup_first
from tracewright.operators.scans import BLOCK, Carry, Total, context
from tracewright.operators.sequence import folded, following, lines


@dataclass(frozen=True)
class Rules:
    """Patterns of a kind of document. Fixed values; the defaults are those of Korean curriculum documents."""

    marker: str = r"^1\.\s*성격\s*(및|과)\s*목표\z"
    professional: str = r"(?:전문 공통 과목|전공 일반 과목|전공 실무 과목)\s*-\s*\d+\.\s*(.+)\z"
    numbered: str = r"^\d+\.\s*(.+)\z"
    reserved_heading: str = r"^(성격|목표|내용 체계|교수|평가)"
    reserved_phrase: str = r"교육과정|선택 중심|공통 교육|차\s*례|전문 공통 과목\z|전공 일반 과목\z|전공 실무 과목\z"
    bulleted: str = r"^[가-하]\.|^\d+\.|^[<【•※(]"
    domain: str = r"^(?:\((?:\d+)\)|(?:\d+)\))\s*(.+)\z"
    fold_stop: str = r"^\[|^•|^<성취기준|^\([가-힣0-9]+\)|^\d+\)"
    fold_skip: str = r"^\d+\z|교육과정\z"
    sentence_end: str = r"[.!?]\z"
    categories: tuple = (
        ("전문 공통 과목", "specialized-common"),
        ("전공 일반 과목", "major-general"),
        ("전공 실무 과목", "major-practical"),
        ("융합 선택 과목", "convergence-elective"),
        ("진로 선택 과목", "career-elective"),
        ("일반 선택 과목", "general-elective"),
        ("공통 과목", "common"),
    )
    endings: tuple = (
        (r"할 수 있다\z", "하기"),
        (r"할 수 있으며.*\z", "하고 설명하기"),
        (r"기른다\z", "기르기"),
        (r"갖는다\z", "갖기"),
        (r"쓴다\z", "쓰기"),
        (r"읽는다\z", "읽기"),
        (r"된다\z", "되기"),
        (r"이해한다\z", "이해하기"),
        (r"설명한다\z", "설명하기"),
        (r"분석한다\z", "분석하기"),
        (r"평가한다\z", "평가하기"),
        (r"활용한다\z", "활용하기"),
        (r"해결한다\z", "해결하기"),
        (r"표현한다\z", "표현하기"),
        (r"탐구한다\z", "탐구하기"),
        (r"한다\z", "하기"),
    )
    titles: dict = field(default_factory=dict)
    middle_titles: dict = field(default_factory=dict)
    shared_prefixes: tuple = ("성직", "인산", "디직")
    legend: str = r"두 자리 수로 제시|교과목의 2개 글자를 제시"
    first_annex: int = 5
    last_annex: int = 39
    other_annexes: tuple = (15,)


def profile_of(code: Column, annex: Column) -> Column:
    """middle or high, by the code's first digits, else by the annex; null for what is neither."""
    tight = compact(code)
    return (
        F.when(tight.startswith("9"), "middle").when(tight.rlike("^1[02]"), "high").when(annex == 18, "middle").when(annex.between(19, 39), "high")
    )


def program_scope(annex: Column, first: int = 23) -> Column:
    """The programs that a document is of: its number decides."""
    return F.when(annex >= first, F.array(F.lit("vocational"))).otherwise(F.array(F.lit("academic")))


def in_scope(annex: Column, rules: Rules | None = None) -> Column:
    """Whether a document's number is in the range of those that hold records, of which some are left out."""
    rules = rules or Rules()
    return annex.between(rules.first_annex, rules.last_annex) & ~annex.isin(*rules.other_annexes)


def empty_groups(docs: DataFrame, records: DataFrame, rules: Rules | None = None, key: str = "doc_id") -> DataFrame:
    """(type, doc_id, annex): a diagnostic for each document in scope that has given no record."""
    rows = docs.filter(in_scope(F.col("annex"), rules)).join(records.filter("profile IS NOT NULL").select(key), key, "left_anti")
    return rows.select(F.lit("no-standards-detected").alias("type"), key, "annex")


def unknown_profiles(records: DataFrame) -> DataFrame:
    """(type, doc_id, code, line_no): a diagnostic for each record line whose code is of no profile."""
    return records.filter("profile IS NULL").select(F.lit("unknown-profile").alias("type"), "doc_id", "code", "line_no")


def _section_title(norm: Column, rules: Rules) -> Column:
    """What a line before a section marker offers as its title; null if nothing."""
    tail = F.regexp_extract(norm, rules.numbered, 1)
    plain = (F.length(norm) > 0) & (F.length(norm) <= 55) & ~norm.rlike(r"^\d+\z") & ~norm.rlike(rules.reserved_phrase) & ~norm.rlike(rules.bulleted) & ~norm.rlike(rules.sentence_end)
    return F.when(norm.rlike(rules.professional), F.trim(F.regexp_extract(norm, rules.professional, 1))).when(norm.rlike(rules.numbered) & ~tail.rlike(rules.reserved_heading), F.trim(tail)).when(plain, norm)


def extract_records(docs: DataFrame, rules: Rules | None = None, compatibility: bool = True, size: int = BLOCK) -> DataFrame:
    """Records of documents (doc_id, annex, text), each with code, prefix, profile, statement, domain, page, line_no, category and title.

    Every line offers what it could be to those after it (a section, a title, a category, a domain), and scans in blocks of
    ``size`` lines carry the nearest offer to the record lines. Documents out of scope are not read; codes of the second, fourth and
    sixth grade and lines of the code's legend vanish; other codes without a profile have a null ``profile`` (for the diagnostics).
    """
    rules = rules or Rules()
    annexes = docs.filter(in_scope(F.col("annex"), rules))
    # the document's number goes with its lines, so nothing is joined back
    every = lines(annexes.select(F.struct("doc_id", "annex").alias("doc"), "text"), "doc").select("doc.doc_id", "doc.annex", "line_no", "line").withColumn("norm", norm_ws("line"))
    category = first_match("norm", rules.categories)
    offered = F.when(F.col("norm").rlike(rules.domain) & (F.length(F.regexp_extract("norm", rules.domain, 1)) <= 80), F.trim(F.regexp_extract("norm", rules.domain, 1)))
    near = {
        "title_before": Carry(_section_title(F.col("norm"), rules), 90, False),
        "category_before": Carry(category, 120, False),
        "category_near": Carry(category, 180),
        "domain_near": Carry(offered, 80, False),
        "_after": following(7, (F.col("norm") == "") | F.col("norm").rlike(rules.fold_stop), F.col("norm").rlike(rules.fold_skip), "norm"),
    }
    every = context(every, near, size=size)
    section = F.when(F.col("norm").rlike(rules.marker), F.struct("title_before", F.col("category_before").alias("category")))
    every = context(every, {"page": Total(F.regexp_count("line", F.lit("\f")).cast("long"), 1), "section": Carry(section)}, size=size)
    every = every.withColumn("record", bracket_code("line"))
    first = F.coalesce(norm_ws(F.col("record.rest")), F.col("norm"))
    rows = every.filter("record IS NOT NULL").withColumn("folded", folded("_after", rules.sentence_end, "norm"))
    # the fold starts with the whole line; the record's own text is what follows the code
    rows = rows.withColumn("statement", norm_ws(F.concat(first, F.expr("substring(folded, length(norm) + 1)"))))
    rows = rows.filter(~F.col("statement").rlike(rules.legend))
    rows = rows.withColumn("code", norm_code("record.code", compatibility)).filter(~compact("code").rlike("^[246]"))
    prefix = code_prefix("code")
    number = matched(compact("code"), r"(\d{2})-\d{2}\z")
    rows = rows.withColumn("prefix", prefix).withColumn("profile", profile_of(F.col("code"), F.col("annex")))
    high = F.coalesce("section.category", "category_near", F.when(F.col("annex") >= 23, "major-general").when(F.col("annex").between(19, 22), "career-elective").otherwise("common"))
    by_prefix, by_annex = F.lit(None).cast("string"), F.lit(None).cast("string")
    if rules.titles:
        by_prefix = F.create_map(*[F.lit(x) for pair in rules.titles.items() for x in pair])[F.col("prefix")]
    if rules.middle_titles:
        by_annex = F.when(F.col("profile") == "middle", F.create_map(*[F.lit(x) for pair in rules.middle_titles.items() for x in pair])[F.col("annex")])
    bare = F.regexp_replace("prefix", r"^\d+", "")
    return rows.select(
        "doc_id",
        "annex",
        "line_no",
        "page",
        "code",
        "prefix",
        "profile",
        "statement",
        F.coalesce("domain_near", F.concat(F.lit("영역 "), number), F.lit("통합 영역")).alias("domain"),
        F.when(F.col("profile") == "middle", F.when(F.col("annex") >= 16, "middle-elective").otherwise("common")).otherwise(high).alias("category"),
        F.coalesce(by_prefix, by_annex, clean_title(F.col("section.title_before"), F.col("prefix")), F.when(bare != "", bare), F.lit("과목")).alias("title"),
    )


def summarised(records: DataFrame, rules: Rules | None = None, compatibility: bool = True) -> DataFrame:
    """records with a short ``summary`` of each statement: in compatibility form, its ending turned into a noun form, cut at a word's end."""
    rules = rules or Rules()
    text = F.trim(F.regexp_replace(compatible("statement") if compatibility else F.col("statement"), r"[.。]\s*\z", ""))
    return records.withColumn("summary", truncate_words(rewrite_first(text, rules.endings), 180, 176, F.concat("domain", F.lit(" 영역의 핵심 이해와 수행"))))


def deduplicated(records: DataFrame, rules: Rules | None = None) -> DataFrame:
    """One record a (profile, scope, code), the first by (annex, line, document), with all its documents and the number folded.

    The scope is the annex, or one for the prefixes that several annexes share.
    """
    rules = rules or Rules()
    scope = F.when((F.col("annex") >= 23) & F.col("prefix").isin(*rules.shared_prefixes), "shared").otherwise(F.concat(F.lit("annex-"), F.col("annex").cast("string")))
    keyed = records.withColumn("scope", scope).withColumn("tight", compact("code"))
    return dedup_first(keyed, ["profile", "scope", "tight"], [F.col("annex"), F.col("line_no"), F.col("doc_id")], {"doc_id": "documents"})


def with_ids(records: DataFrame) -> DataFrame:
    """records with course, domain and standard ids, each a function of what it names: no join is needed for the foreign keys."""
    course = content_id("course:", 16, "profile", "category", "title")
    rows = records.withColumn("course_id", course).withColumn("domain_id", content_id("domain:", 16, "course_id", "domain"))
    return rows.withColumn("standard_id", content_id("standard:", 20, "profile", "course_id", "tight"))
