"""Segmented scans against plain loops, with blocks that are shorter and longer than documents."""

import random

import pytest
from pyspark.sql import functions as F

from tracewright.operators import scans, sequence
from tracewright.plans.extraction import extract_records
from tracewright.sources import files


@pytest.fixture(scope="module")
def rows():
    draw, out = random.Random(2), []
    for doc, n in (("a", 61), ("b", 1), ("c", 23), (None, 17), ("e", 8)):
        out += [(doc, k, draw.choice(["H1", "H2", None, "x", "x", "x"]), draw.randint(0, 3)) for k in range(1, n + 1)]
    return out


def plain(rows):
    found = {}
    for doc, k, value, n in rows:
        own = [r for r in rows if r[0] == doc]
        head = lambda r: r[2] if r[2] != "x" else None
        last = lambda lo, hi, own=own: next((head(r) for r in reversed(own) if lo <= r[1] <= hi and head(r)), None)
        found[doc, k] = (last(1, k), last(1, k - 1), last(k - 4, k), last(k - 4, k - 1), 5 + sum(r[3] or 0 for r in own if r[1] <= k), [r[2] for r in own if k < r[1] <= k + 3 and r[2]])
    return found


@pytest.mark.parametrize("size", [4, 7, 8, 100])
def test_context(spark, rows, size):
    df = spark.createDataFrame(random.Random(size).sample(rows, len(rows)), "doc string, at int, value string, n int")
    head = F.when(F.col("value") != "x", F.col("value"))
    wanted = {
        "all": scans.Carry(head),
        "all_before": scans.Carry(head, None, False),
        "near": scans.Carry(head, 4),
        "value": scans.Carry(head, 4, False),  # takes the place of a column of df
        "total": scans.Total(F.col("n"), 5),
        "next": scans.Ahead(F.col("value"), 3),
    }
    out = scans.context(df, wanted, "doc", "at", size)
    assert out.columns == ["doc", "at", "n", *wanted]
    got = {(r["doc"], r["at"]): (r["all"], r["all_before"], r["near"], r["value"], r["total"], r["next"]) for r in out.collect()}
    assert got == plain(rows) and out.count() == len(rows)


def test_bounds_and_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id string, line_no int, line string")
    assert sequence.running_count(none, "x", "n").count() == 0 and sequence.carry_last(none, F.col("line"), "v", 3).count() == 0
    with pytest.raises(ValueError, match="blocks"):
        sequence.carry_last(none, F.col("line"), "v", 11, size=10)


def test_a_long_document_is_many_tasks(spark):
    """No task sees more of one document than a block and its neighbours' nearest lines."""
    n, size = 60_000, 500
    df = spark.range(1, n + 1, 1, 8).selectExpr("'d' AS doc_id", "id AS line_no", "if(id % 7001 = 0, id, NULL) AS v")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = scans.context(df, {"last": scans.Carry(F.col("v")), "n": scans.Total(F.lit(1))}, size=size).withColumn("part", F.spark_partition_id())
        sizes = out.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.expr("n <> line_no OR last IS DISTINCT FROM nullif(line_no - line_no % 7001, 0)")).alias("wrong")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(r["n"] for r in sizes) == n and not any(r["wrong"] for r in sizes)
    assert len(sizes) >= 12 and max(r["n"] for r in sizes) < n / 4


@pytest.mark.parametrize("size", [200, 100_000])
def test_extraction_is_the_same_in_blocks(spark, size):
    draw = random.Random(7)
    kinds = ["공통 과목", "1. 성격 및 목표", "(1) 수와 연산", "[9수01-01] 수를 이해한다.", "[12영02-03] 글을 읽고", "이어지는 줄", "", "3", "2. 수학", "\f"]
    text = "\n".join(draw.choice(kinds) for _ in range(900))
    docs = spark.createDataFrame([("d1", 6, text), ("d2", 19, text[:2000]), ("d3", 4, text)], "doc_id string, annex int, text string")
    whole = {tuple(r) for r in extract_records(docs).collect()}
    assert len(whole) > 100 and {tuple(r) for r in extract_records(docs, size=size).collect()} == whole


def test_lines_of_large_files_are_numbered_across_splits(spark, tmp_path):
    lines = {"a.txt": [f"line {k} {'é' * (k % 11)}" for k in range(4000)], "b.txt": ["x"], "c.txt": []}
    for name, own in lines.items():
        (tmp_path / name).write_bytes("".join(f"{x}\r\n" if k % 3 else f"{x}\n" for k, x in enumerate(own)).encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = files.numbered_lines(spark, str(tmp_path))
        assert files.numbered_lines(spark, str(tmp_path)).select(F.spark_partition_id()).distinct().count() > 1
        got = sorted(map(tuple, df.select("doc_id", "line_no", "line").collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted((name, k + 1, x) for name, own in lines.items() for k, x in enumerate(own))
