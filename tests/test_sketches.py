import random
from collections import Counter

import pytest

from tracewright.operators import sketches


def rows_of(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(6)
    rows = [(k % 900, draw.choice(["a", "b", None, "", "x|y"]), k / 7) for k in range(3000)] + [(1, "twice", 0.5)] * 5 + [(None, None, None)] * 2
    new = rows[40:] + [(1, "twice", 0.5)] * 3 + [(9999, "|", 1.0), (None, "", None)]
    new.remove((None, None, None))
    make = lambda r: spark.createDataFrame(random.Random(1).sample(r, len(r)), "k int, v string, x double").repartition(5)
    return make(rows), make(new), Counter(rows), Counter(new)


@pytest.mark.parametrize(("cells", "shown"), [(512, True), (8, False)])
def test_difference(tables, cells, shown):
    """A table of enough cells shows all that differs; one of too few stalls, and ranges are compared."""
    old, new, was, is_ = tables
    table = {(r["part"], r["cell"]): (int(r["n"]), int(r["keys"]), int(r["checks"])) for r in sketches.merged(sketches.sketch(new, cells=cells), sketches.sketch(old, sign=-1, cells=cells)).collect()}
    found = sketches.peeled(table, cells)
    assert (found is not None) == shown
    if shown:
        assert sorted(found.values()) == sorted([n for n in (is_ - was).values()] + [-n for n in (was - is_).values()])
    want = Counter({("new", *r): n for r, n in (is_ - was).items()}) + Counter({("stored", *r): n for r, n in (was - is_).items()})
    assert rows_of(sketches.sparse_difference(new, old, cells, 64)) == want


def test_sketches_of_parts_add_up(tables):
    old, _, _, _ = tables
    a, b = old.filter("k < 400"), old.filter("k >= 400 OR k IS NULL")
    assert rows_of(sketches.merged(sketches.sketch(a), sketches.sketch(b))) == rows_of(sketches.merged(sketches.sketch(old)))
    assert sketches.merged(sketches.sketch(old), sketches.sketch(old.repartition(2), sign=-1)).count() == 0


def test_equal_and_empty_tables(tables):
    old, _, was, _ = tables
    assert sketches.sparse_difference(old, old.repartition(2)).count() == 0
    none = old.limit(0)
    assert sketches.sparse_difference(none, none).count() == 0
    assert rows_of(sketches.sparse_difference(none, old, 16)) == Counter({("stored", *r): n for r, n in was.items()})


def test_places_agree_with_spark(spark):
    df = spark.createDataFrame([(7, "x")], "k int, v string")
    rows = sketches.sketch(df, cells=1000).collect()
    key = int(rows[0]["keys"])
    check, places = sketches._places(key, 1000)
    assert sorted((r["part"], r["cell"]) for r in rows) == places and all(int(r["checks"]) == check for r in rows)
