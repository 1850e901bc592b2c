import pytest
from pyspark.sql import functions as F

from tracewright.operators import sequence
from tracewright.plans.extraction import Rules, deduplicated, extract_records, summarised, with_ids


def texts(df, col):
    return [r[col] for r in df.orderBy("doc_id", "line_no").collect()]


@pytest.fixture
def numbered(spark):
    def make(*lines):
        return sequence.lines(spark.createDataFrame([("d", "\n".join(lines))], "doc_id string, text string"))

    return make


def test_lines(spark):
    df = sequence.lines(spark.createDataFrame([("a", "x\r\ny\n"), ("b", ""), ("c", None)], "doc_id string, text string"))
    assert [(r[0], r[1], r[2]) for r in df.orderBy("doc_id", "line_no").collect()] == [("a", 1, "x"), ("a", 2, "y"), ("a", 3, ""), ("b", 1, "")]


def test_page_counts_its_own_line(numbered):
    assert texts(sequence.running_count(numbered("a", "\fb", "c\f\f", "d"), "\f", "page"), "page") == [1, 2, 4, 4]


def test_carry_edges(numbered):
    df = numbered("H", *["x"] * 81)
    mark = F.when(F.col("line") == "H", F.lit("H"))
    assert texts(sequence.carry_last(df, mark, "v", 80, False), "v")[80:] == ["H", None]
    assert texts(sequence.carry_last(df, mark, "v", 80, True), "v")[0] == "H"
    assert texts(sequence.carry_last(df, mark, "v"), "v") == ["H"] * 82


@pytest.mark.parametrize(
    ("lines", "want"),
    [
        (["one", "two", "", "three"], "one two"),
        (["one", "[x", "two"], "one"),
        (["one", "7", "two.", "three"], "one two."),
        (["one.", "two"], "one. two"),
        (list("abcdefghi"), "a b c d e f g h"),
        (["only"], "only"),
        (["a", "1", "2", "3", "4", "5", "6", "7", "late"], "a"),
    ],
)
def test_fold(numbered, lines, want):
    df = sequence.fold_forward(numbered(*lines), "t", 7, (F.col("line") == "") | F.col("line").startswith("["), F.col("line").rlike(r"^\d+\z"), r"[.!?]\z")
    assert texts(df, "t")[0] == want


def test_boundary_pairs(spark):
    df = spark.createDataFrame([("a", 2, 10), ("a", 1, 11), ("b", 5, 12), ("b", 5, 13)], "g string, o int, v int")
    pairs = spark.createDataFrame([("a", "b"), ("b", "zz")], "from_key string, to_key string")
    assert [tuple(r) for r in sequence.boundary_pairs(df, "g", [F.col("o")], "v", pairs).collect()] == [("b", "a", 10, 12)]


def document(*lines):
    return "\n".join(lines)


def test_extraction_of_a_small_document(spark):
    high = document(
        "공통 과목",
        "1. 미적분",
        "1. 성격 및 목표",
        "(1) 수열의 극한",
        "[12미적01-01] 수열의 뜻을",
        "12",
        "이해한다.",
        "[12미적 01-02] 급수를 설명할 수 있다.",
        "(2) 미분법\f",
        "[12미적02-01] 첫 줄이다.",
        "다음 줄도 읽는다.",
        "",
        "[2국01-01] 범위 밖",
        "[기타01-01] 알 수 없다",
    )
    docs = [("h", 19, high), ("m", 8, document("[9수01-05] 수를 안다.", "• 해설")), ("n", 8, "아무것도 없다"), ("e", 16, "[기타01-01] 소속 없음")]
    rows = {(r["doc_id"], r["code"]): r for r in summarised(extract_records(spark.createDataFrame(docs, "doc_id string, annex int, text string"))).collect()}
    assert set(rows) == {("h", "12미적01-01"), ("h", "12미적 01-02"), ("h", "12미적02-01"), ("h", "기타01-01"), ("m", "9수01-05"), ("e", "기타01-01")}
    one = rows["h", "12미적01-01"]
    assert (one["statement"], one["domain"], one["title"], one["category"], one["page"], one["profile"]) == ("수열의 뜻을 이해한다.", "수열의 극한", "미적분", "common", 1, "high")
    assert one["summary"] == "수열의 뜻을 이해하기"
    assert rows["h", "12미적 01-02"]["summary"] == "급수를 설명하기"
    two = rows["h", "12미적02-01"]
    assert (two["domain"], two["page"], two["statement"]) == ("미분법", 2, "첫 줄이다. 다음 줄도 읽는다.")
    middle = rows["m", "9수01-05"]
    assert (middle["profile"], middle["category"], middle["domain"], middle["statement"]) == ("middle", "common", "영역 01", "수를 안다.")
    assert rows["e", "기타01-01"]["profile"] is None


def test_records_of_one_scope_are_folded(spark):
    docs = [("a", 24, "[성직 01-01] 하나"), ("b", 25, "[성직 01-01] 둘"), ("c", 24, "[12가01-01] 셋\n[12가01-01] 넷"), ("d", 25, "[12가01-01] 다섯")]
    found = with_ids(deduplicated(extract_records(spark.createDataFrame(docs, "doc_id string, annex int, text string")))).collect()
    got = sorted((r["scope"], r["tight"], r["statement"], tuple(r["documents"]), r["repeats"]) for r in found)
    assert got == [("annex-24", "12가01-01", "셋", ("c",), 1), ("annex-25", "12가01-01", "다섯", ("d",), 0), ("shared", "성직01-01", "하나", ("a", "b"), 1)]
    assert len({r["standard_id"] for r in found}) == 2 or len({r["standard_id"] for r in found}) == 3


def test_titles_can_be_given(spark):
    docs = spark.createDataFrame([("a", 19, "[12가01-01] 하나")], "doc_id string, annex int, text string")
    assert extract_records(docs, Rules(titles={"12가": "제목"})).first()["title"] == "제목"
