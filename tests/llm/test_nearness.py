import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tracewright.llm import orderminhash as omh
from tracewright.llm.windows import word_items


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=20), st.lists(st.integers(0, 3), max_size=20))
def test_edit_similarity(a, b):
    longest = max(len(a), len(b))
    want = 1 - edits(a, b) / longest if longest else 1.0
    got = omh.edit_similarity(np.array(a, np.uint64), np.array(b, np.uint64), 0.4)
    assert abs(got - (want if want >= 0.4 - 1e-9 else 0.0)) < 1e-9


def moved(kind, shift, n=1000):
    """A text and a near copy of it whose middle stands ``shift`` words away from its place."""
    a, new = list(range(n)), list(range(10**6, 10**6 + shift))
    copy = a[shift:] + new if kind == "cut at the start" else new + a[:-shift] if kind == "cut at the end" else a[: n // 4] + new + a[n // 4 : 3 * n // 4] + a[3 * n // 4 + shift :]
    return np.array(a, np.uint64), np.array(copy, np.uint64)


@pytest.mark.parametrize("kind", ["cut at the start", "cut at the end", "paragraphs"])
@pytest.mark.parametrize("shift", [30, 60, 99, 101, 200])
def test_shifted_copies(kind, shift):
    a, b = moved(kind, shift)
    want = 1 - edits(a.tolist(), b.tolist()) / len(a)
    for x, y in ((a, b), (b, a)):
        assert abs(omh.edit_similarity(x, y) - (want if want >= 0.8 - 1e-9 else 0.0)) < 1e-9
    assert omh.near(a, b) == (want >= 0.8 - 1e-9)
    assert shift > 60 or omh.near(a, b)


@settings(max_examples=100, deadline=None)
@given(st.randoms(use_true_random=False), st.sampled_from([0.5, 0.8, 0.9]))
def test_edited_copies(draw, least):
    a = [draw.randint(0, 30) for _ in range(draw.randint(60, 160))]
    b = list(a)
    for _ in range(draw.randint(1, 4)):
        at, size = draw.randrange(len(b) + 1), draw.randint(1, 25)
        b[at : at + draw.choice([0, size])] = [draw.randint(0, 40) for _ in range(draw.choice([0, size]))]
    longest = max(len(a), len(b))
    want = 1 - edits(a, b) / longest
    got = omh.edit_similarity(np.array(a, np.uint64), np.array(b, np.uint64), least)
    assert abs(got - (want if longest - (1 - want) * longest >= least * longest - 1e-6 else 0.0)) < 1e-9


def test_long_texts_are_aligned_like_short_ones():
    for n in (200, 20_000):
        a = np.arange(n, dtype=np.uint64)
        part = n // 20
        # sections moved from one end to the other, and a tenth of the text gone: shingles agree, the order doesn't
        turned = np.r_[a[-part * 2 :], a[part * 3 : -part * 2], a[:part]]
        for x, y in ((a, turned), (turned, a)):
            assert omh.edit_similarity(x, y) == 0.0 and not omh.near(x, y)
        # a length difference of 11 in 100 and a change at either end
        kept = np.r_[np.uint64(10**6), a[1 : n - n // 100 * 11 - 1], np.uint64(10**6 + 1)]
        for x, y in ((a, kept), (kept, a)):
            assert abs(omh.edit_similarity(x, y) - (1 - (n // 100 * 11 + 2) / n)) < 1e-9


def test_repeats_are_labelled():
    grams = np.array([5, 7, 5, 5, 7], np.uint64)
    assert len(set(omh.labelled(grams).tolist())) == 5


def test_order_counts():
    a = word_items(" ".join(f"w{k}" for k in range(200)).encode())
    assert (omh.order_sketches(a) == omh.order_sketches(a.copy())).all()
    turned = np.r_[a[100:], a[:100]]
    same = (omh.order_sketches(a) == omh.order_sketches(turned)).mean()
    assert same < 0.9 and omh.edit_similarity(a, turned) == 0.0


@pytest.fixture(scope="module")
def copies():
    draw = random.Random(11)
    rows, k = [], 0
    for group in range(14):
        words = [f"g{group}w{draw.randint(0, 400)}" for _ in range(draw.choice([6, 40, 120, 300]))]
        for _ in range(draw.choice([1, 2, 3, 25])):
            copy = list(words)
            for _ in range(draw.choice([0, 1, 2, len(words) // 60])):
                copy[draw.randrange(len(copy))] = f"e{draw.randint(0, 10**6)}"
            if draw.random() < 0.3:
                copy = copy[: len(copy) - 2]
            rows.append((k * 3 + 1, " ".join(copy)))
            k += 1
    # the same passages in another order: shingles agree, the alignment doesn't
    parts = [" ".join(f"p{k}w{n}" for n in range(50)) for k in range(4)]
    rows += [(6000, " ".join(parts)), (6001, " ".join(parts[2:] + parts[:2])), (6002, " ".join(parts) + " and one more")]
    shared = " ".join(f"boiler{n}" for n in range(60))
    rows += [(5000 + n, f"{shared} " + " ".join(f"own{n}x{m}" for m in range(60))) for n in range(40)]
    draw.shuffle(rows)
    return rows


def brute(rows, least=0.8):
    texts = {}
    for i, t in rows:
        texts.setdefault(t or "", []).append(i)
    names, parent = list(texts), list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    words = [t.split() for t in names]
    for a in range(len(names)):
        for b in range(a):
            longest, shared = max(len(words[a]), len(words[b])), (Counter(words[a]) & Counter(words[b])).total()
            if words[a] and words[b] and shared >= least * longest - 1e-9 and 1 - edits(words[a], words[b]) / longest >= least - 1e-9:
                parent[find(a)] = find(b)
    classes = {}
    for k, t in enumerate(names):
        classes.setdefault(find(k), []).extend(texts[t])
    low = lambda ids: min(ids, key=lambda i: (i is not None, i or 0))
    return sorted(((i, low(ids), len(ids)) for ids in classes.values() for i in ids), key=str)


def test_classes_against_brute_force(frame, copies, odd_rows):
    rows = copies + odd_rows
    got = omh.near_duplicates(frame(rows)).collect()
    assert sorted(((r["doc_id"], r["class_id"], r["class_size"]) for r in got), key=str) == brute(rows)
    assert sum(r["representative"] for r in got) >= len({r["class_id"] for r in got})
    by = {r["doc_id"]: r["class_id"] for r in got}
    assert by[6001] == 6001 and by[6002] == by[6000] == 6000


@pytest.mark.parametrize("block", [omh.__dict__.get("BLOCK", 0), 7])
def test_groups_that_share_boilerplate(frame, monkeypatch, block):
    monkeypatch.setattr(omh, "BLOCK", block, raising=False)
    shared = [f"boiler{n}" for n in range(80)]
    own = lambda g, c: [f"g{g}w{n}" for n in range(20)] + [f"g{g}c{c}w{n}" for n in range(10)]
    # two copies a group are near each other (0.91); texts of different groups aren't (0.73), but share most sketches
    rows = [(g * 10 + c, " ".join(shared + own(g, c))) for g in range(120) for c in range(2)]
    got = omh.near_duplicates(frame(rows)).collect()
    assert sorted(((r["doc_id"], r["class_id"], r["class_size"]) for r in got), key=str) == brute(rows)
    assert len({r["class_id"] for r in got}) == 120


def test_edited_copies_find_their_originals(frame):
    """Word edits of 2 to 6 %, which leave 0.56 to 0.9 of the shingles: edit similarity decides, not theirs."""
    draw, rows = random.Random(8), []
    for g in range(80):
        words = [f"g{g}w{draw.randint(0, 300)}" for _ in range(draw.randint(60, 400))]
        copy = [f"e{draw.randint(0, 10**6)}" if draw.random() < 0.02 + 0.04 * (g / 80) else w for w in words]
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(copy))]
    got = {r["doc_id"]: r["class_id"] for r in omh.near_duplicates(frame(rows)).collect()}
    assert all(got[i] // 2 == i // 2 for i in got) and sum(got[2 * g + 1] == 2 * g for g in range(80)) >= 78


def test_a_stranger_in_a_large_class_makes_few_rows(spark):
    """Members of the label that most have aren't dealt against each other."""
    named = spark.range(6000).selectExpr("1L AS bucket", "id AS tid", "CASE WHEN id < 5998 THEN 7L ELSE id END AS label")
    bins = np.zeros(omh.BINS, np.uint8)
    bins[:10] = 10
    words = named.select("tid").withColumn("n_words", F.lit(100).cast("long")).withColumn("bins", F.lit(bytes(bins)))
    pairs = omh._left_pairs(named, words, 0.8)
    assert pairs.count() == 2 * 5998 + 1


def test_a_pair_of_many_common_buckets_is_made_once(spark, monkeypatch):
    """All share buckets 3 and 8, even ones -2 too: each pair comes from the least that both are in."""
    texts = spark.range(60).selectExpr("id AS tid", "array(3L, 8L, CASE WHEN id % 2 = 0 THEN -2L ELSE 100 + id END) AS sketches")
    named = texts.selectExpr("explode(sketches) AS bucket", "tid", "tid AS label").filter("bucket < 100")
    bins = np.zeros(omh.BINS, np.uint8)
    bins[:10] = 10
    words = texts.withColumn("n_words", F.lit(100).cast("long")).withColumn("bins", F.lit(bytes(bins)))
    monkeypatch.setattr(type(named), "distinct", lambda df: df)
    pairs = [(r["a"], r["b"]) for r in omh._left_pairs(named, words, 0.8).collect()]
    assert sorted(pairs) == [(a, b) for a in range(60) for b in range(a)]


def test_smaller_sketches():
    import pyarrow as pa

    lists = pa.chunked_array([pa.array([[5, -7, 9]]), pa.array([[5, 8]], pa.list_(pa.int64()))])
    none = int(omh.NO_BUCKET)
    assert omh._smaller(lists, np.array([9, 5])).tolist() == [[5, -7, none], [none, none, none]]


def test_possible_pairs_miss_none():
    draw = random.Random(5)
    texts = [[draw.randint(0, 40) for _ in range(draw.randint(5, 30))] for _ in range(30)]
    texts += [t[: len(t) - draw.randint(0, 3)] for t in texts for _ in range(3)] + [[1] * 6, [2, 3], list(range(2000)), list(range(1, 2001))]
    words = [np.array(t, np.uint64) for t in texts]
    label, block, own = np.arange(len(words)) // 2, np.arange(len(words)) % 3, np.arange(len(words)) % 5 != 1
    raw = [omh._binned(w) for w in words]
    assert omh._binned(np.arange(800_000, dtype=np.uint64)).dtype == np.uint16
    for across in (False, True):
        got = {(min(i, int(j)), max(i, int(j))) for i, js in omh.possible(np.array([x.astype(np.int32) for x in raw]), label, block, across, own, 0.8) for j in js}
        want = {(i, j) for j in range(len(words)) for i in range(j) if label[i] != label[j] and (block[i] != block[j]) == across and (own[i] or own[j]) and omh.near(words[i], words[j])}
        assert want and want <= got


def test_structured_words_are_told_apart():
    from tests.llm.test_windows import thue_morse

    one = thue_morse(1024)
    a, b = (word_items(f"{x} {' '.join(f'w{k}' for k in range(9))}".encode()) for x in (one, one.translate(str.maketrans("ab", "ba"))))
    assert a[0] != b[0] and (a[1:] == b[1:]).all()


def test_long_texts_are_sketched_a_few_bands_at_a_time(monkeypatch):
    a = word_items(" ".join(f"w{k % 700}" for k in range(3000)).encode())
    whole = omh.order_sketches(a)
    monkeypatch.setattr(omh, "AT_ONCE", 5000)
    assert (omh.order_sketches(a) == whole).all()


def test_names_that_the_operator_uses_itself(frame, copies):
    df = frame(copies[:20]).withColumnsRenamed({"rank": "digest", "f": "nth__", "score": "dk__"})
    out = omh.one_of_each_class(df)
    assert out.columns == df.columns and {(r["dk"], r["digest"], r["nth__"], r["dk__"]) for r in out.collect()} == {(1, 2, "x", "y")}


def test_one_of_each_class(frame, copies, odd_rows):
    rows = copies + odd_rows
    df = frame(rows)
    out = omh.one_of_each_class(df)
    assert out.columns == df.columns
    kept = [r["doc_id"] for r in out.collect()]
    assert sorted(kept, key=str) == sorted(_firsts(rows), key=str)


def _firsts(rows):
    texts = {}
    for i, t in rows:
        texts.setdefault(t or "", []).append(i)
    by_class = {}
    for i, c, n in brute(rows):
        by_class.setdefault((c, n), []).append(i)
    # a class may share its least id with another one (ids repeat); count classes by their documents
    return [c for (c, n), ids in by_class.items() for _ in range(len(ids) // n)]


def test_empty_table(frame):
    none = frame([(1, "x")]).limit(0)
    assert omh.near_duplicates(none).count() == 0 and omh.one_of_each_class(none).count() == 0


def test_components(spark):
    pairs = [(k, k + 1) for k in range(0, 30)] + [(100, 50), (50, 101), (7, 7), (200, 201), (201, 202), (202, 200)]
    got = {r["node"]: r["label"] for r in omh.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(31), 0), 50: 50, 100: 50, 101: 50, 200: 200, 201: 200, 202: 200}
