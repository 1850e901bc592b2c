import random

import pytest
from pyspark.sql import functions as F

from tracewright.operators import questions, search


@pytest.mark.parametrize("block_rows", [3, 4096])
def test_search_equals_scans(spark, block_rows):
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcé 漢") for _ in range(draw.randint(0, 9)))
    rows = [(k, word(), word() if k % 4 else None) for k in range(80)] + [(7, "abc abc", "ABCÉ"), (7, "abc abc", "ABCÉ"), (None, "abc", ""), (90, None, None), (91, "", "")]
    df = spark.createDataFrame(rows, "id long, a string, b string")
    index = search.build_index(df.filter("id IS NOT NULL"), "id", ["a", "b"], block_rows)
    asked = ["abc", "ab", "b", "", " ", "É", "c a", "漢a", "zzz", "abcé 漢", " ABC ", "bb bb", "aaaa", "abc", *[word() for _ in range(30)]]
    got = search.search(index, spark.createDataFrame([(q,) for q in [*asked, None]], "query string"))
    found = {}
    for r in got.collect():
        found.setdefault(r["query"], []).append(r["id"])
    for q in set(asked):
        want = sorted(r["id"] for r in questions.text_search(df.filter("id IS NOT NULL"), ["a", "b"], q).collect())
        assert sorted(found.get(q, [])) == want, q
    assert None not in found


def test_lists_are_bounded_by_blocks(spark):
    df = spark.range(1000).select("id", F.lit("same text").alias("t"))
    index = search.build_index(df, "id", ["t"], 50)
    sizes = index.postings.select(F.size("ids").alias("n")).collect()
    assert max(r["n"] for r in sizes) < 100 and index.counts.filter("gram = 'ame'").first()["n"] == 1000


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id long, t string")
    index = search.build_index(none, "id", ["t"])
    assert search.search(index, spark.createDataFrame([("a",)], "query string")).count() == 0
    full = search.build_index(spark.createDataFrame([(1, "a")], "id long, t string"), "id", ["t"])
    assert search.search(full, spark.createDataFrame([], "query string")).count() == 0
