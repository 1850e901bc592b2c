import math
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from tracewright.llm import languages as lid

EN, DE, FR = "the cat and the dog went to the house and ", "der hund und die katze gingen zu dem haus und ", "le chat et le chien sont partis vers la maison et "


def tree_of(*texts):
    codes, n = np.unique(np.concatenate([lid.grams(np.frombuffer(lid.BEFORE + t, np.uint8)) for t in texts]), return_counts=True)
    return lid.Tree(codes, n)


def plain_bits(texts, context, byte):
    """Code length by dictionaries, with escapes and exclusion."""
    after = defaultdict(Counter)
    for t in texts:
        t = lid.BEFORE + t
        for at in range(lid.ORDER, len(t)):
            for k in range(lid.ORDER + 1):
                after[t[at - k : at]][t[at]] += 1
    bits, excluded = 0.0, set()
    for k in range(lid.ORDER, -1, -1):
        here = after.get(context[len(context) - k :])
        if here is None:
            continue
        left = {b: n for b, n in here.items() if b not in excluded}
        total, kinds = sum(left.values()), len(left)
        if byte in left:
            return bits + math.log2((total + kinds) / left[byte])
        if kinds:
            bits += math.log2((total + kinds) / kinds)
        excluded |= set(here)
    return bits + math.log2(256 - len(excluded))


def test_code_lengths_are_those_of_plain_trees_and_sum_to_one():
    texts = [b"abracadabra", b"abrupt braces", "é à".encode()]
    tree = tree_of(*texts)
    for context in (b"\n\n\n\n", b"abra", b"zzbr", b"zzzz", b"\nabr"):
        codes = (int.from_bytes(context, "big") << 8) + np.arange(256)
        got = tree.lengths(codes)
        want = [plain_bits(texts, context, b) for b in range(256)]
        assert np.abs(got / lid.UNIT - want).max() < 1e-4
        assert abs((2.0 ** -(got / lid.UNIT)).sum() - 1) < 1e-3


def test_texts_are_scored_whole_in_blocks(monkeypatch):
    trees = lid.Trees(["de", "en"], *zip(*[np.unique(lid.grams(np.frombuffer(lid.BEFORE + t.encode(), np.uint8)), return_counts=True) for t in (DE * 3, EN * 3)], strict=True))
    texts = [b"", (EN * 40).encode(), b"x", (DE * 7).encode(), b"ab", (EN * 40).encode()]
    want = [trees.lengths(lid.grams(np.frombuffer(lid.BEFORE + t, np.uint8))).sum(0).tolist() for t in texts]
    for block in (16, 100, 2_000_000):
        monkeypatch.setattr(lid, "BLOCK", block)
        assert trees.code_lengths(texts).tolist() == want
    monkeypatch.setattr(lid, "KEPT", 40)  # few grams kept: others are made when they come
    few = lid.Trees(trees.names, *zip(*[np.unique(lid.grams(np.frombuffer(lid.BEFORE + t.encode(), np.uint8)), return_counts=True) for t in (DE * 3, EN * 3)], strict=True))
    assert few.code_lengths(texts).tolist() == want


def rows():
    return [(i, t * (1 + i % 5) + str(i), lang, "q", 1) for i, (t, lang) in enumerate([(EN, "en"), (DE, "de"), (FR, "fr")] * 20)]


SCHEMA = "doc_id long, text string, lang string, score string, raw int"


def test_languages_of_odd_rows(spark):
    odd = [(900, None, None), (901, "", "xx"), (902, " 12 3!", None), (None, EN, "zz"), (903, DE, None), (903, DE, None), (904, FR * 2000, None), (905, "漢字", None)]
    df = spark.createDataFrame(rows() + [(i, t, x, "q", 1) for i, t, x in odd], SCHEMA)
    got = lid.languages(df).collect()
    assert len(got) == 68 and all(0 <= r.score <= 1 for r in got)
    known = {r[0]: r[2] for r in rows()}
    assert all(r.lang_pred == known[r.doc_id] for r in got if r.doc_id in known)
    by_id = defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r)
        assert r.held_out == (r.doc_id is not None and crc32(str(r.doc_id).encode()) % 4 == 2)
    for i in (900, 901, 902):
        assert by_id[i][0].lang_pred == "und" and by_id[i][0].score == 0
    assert by_id[None][0].lang_pred == "en"  # its own label is of no null id: it teaches nothing
    assert [r.lang_pred for r in by_id[903]] == ["de", "de"] and by_id[904][0].lang_pred == "fr"
    assert by_id[905][0].lang_pred in ("en", "de", "fr")


def test_labels_of_held_out_rows_teach_nothing(spark):
    wrong = [(i, t, "xx" if crc32(str(i).encode()) % 4 == 2 else lang, s, n) for i, t, lang, s, n in rows()]
    a, b = ({(r.doc_id, r.lang_pred, r.score) for r in lid.languages(spark.createDataFrame(x, SCHEMA)).collect()} for x in (rows(), wrong))
    assert a == b


@pytest.mark.parametrize("data", [[], [(1, EN, None, "q", 1), (2, None, None, "q", 1)]])
def test_nothing_to_learn(spark, data):
    got = lid.languages(spark.createDataFrame(data, SCHEMA)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * len(data)


def test_the_sample_is_bounded_and_copies_count_once(spark, monkeypatch):
    monkeypatch.setattr(lid, "PIECES", 3)
    monkeypatch.setattr(lid, "PIECE", 64)
    many = [(i, EN * 50, "en", "q", 1) for i in range(40)] + [(100 + i, DE * 20 + str(i), "de", "q", 1) for i in range(40)]
    pieces, names = lid._pieces(spark.createDataFrame(many, SCHEMA), "doc_id", "text", "lang", 4, 2)
    got = pieces.collect()
    n = Counter(r.lang for r in got)
    assert names == ["de", "en"] and n["de"] == 3 and 1 <= n["en"] <= 3 and all(len(r.piece) <= 64 + lid.ORDER for r in got)
    assert len({(r.lang, r.piece) for r in got}) == len(got)


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = [r for r in lid.languages(df).join(df.select("doc_id", "lang"), "doc_id").collect() if r.held_out]
    assert len(got) > 200 and sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
