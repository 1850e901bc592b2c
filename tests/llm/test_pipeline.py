"""Each stage against a plain version, on the stage's own input."""

import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_nearness import brute
from tests.llm.test_windows import spared_bytes
from tracewright.llm.quality import THRESHOLD, quality_model

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_dedup", "suffix_array_dedup", "mixing", "best_fit_packing"]
    for name, (_, after) in stages.items():
        if name != "best_fit_packing":
            assert after.columns == list(corpus_pipeline.COLUMNS)


def test_quality_stage(spark, stages):
    before, after = stages["quality_classifier"]
    model = quality_model(before, spark.read.parquet(f"{SF}/labels.parquet"))
    want = sorted(r["doc_id"] for r in rows(before) if model.probability((r["text"] or "").encode()) >= THRESHOLD)
    assert sorted(r["doc_id"] for r in rows(after)) == want and 0 < len(want) < before.count()


def test_near_dedup_stage(stages):
    before, after = stages["near_dedup"]
    want = {c for _, c, _ in brute([(r["doc_id"], r["text"]) for r in rows(before)])}
    kept = rows(after)
    assert {r["doc_id"] for r in kept} == want and len(kept) == len(want)
    texts = {r["doc_id"]: r for r in rows(before)}
    assert all(texts[r["doc_id"]] == r for r in kept)


def test_suffix_array_stage(stages):
    before, after = stages["suffix_array_dedup"]
    want = spared_bytes([(r["doc_id"], r["text"]) for r in rows(before)], corpus_pipeline.PASSAGE_BYTES)
    texts = {r["doc_id"]: r["text"] or "" for r in rows(before)}
    changed = 0
    for r in rows(after):
        assert r["text"] == want[r["doc_id"], texts[r["doc_id"]]] and r["n_chars"] == len(r["text"])
        changed += r["text"] != texts[r["doc_id"]]
    assert len(rows(after)) == len(texts) and 0 < changed < len(texts)


def test_mixing_stage(spark, stages):
    from tracewright.llm.mixing import mixed

    before, after = stages["mixing"]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    total, taken, longest = Counter(), Counter(), Counter()
    texts = {}
    for r in rows(before):
        total[r["source"]] += size(r["text"])
        longest[r["source"]] = max(longest[r["source"]], size(r["text"]))
        texts[r["doc_id"]] = r
    for r in rows(after):
        taken[r["source"]] += size(r["text"])
        assert r == texts[r["doc_id"]]  # whole documents, as they were
    targets = {r["source"]: r["target"] for r in mixed(before).join(before.select("doc_id", "source"), "doc_id").collect()}
    assert all(abs(taken[s] - targets[s]) <= longest[s] / 2 + 1 and taken[s] <= 2 * total[s] for s in total)
    assert max(Counter(r["doc_id"] for r in rows(after)).values()) <= 2


def test_packing_stage(stages):
    before, after = stages["best_fit_packing"]
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = Counter()
    for r in rows(before):
        n = len(plain.encode(r["text"] or "", add_special_tokens=False).ids) + 1
        lengths.update(min(2048, n - a) for a in range(0, n, 2048))
    got = rows(after)
    assert Counter(r["length"] for r in got) == lengths
    ends = Counter()
    for r in got:
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 2048 and len(ends) <= -(-sum(lengths.elements()) // 2048) + 1
    assert np.all([r["offset"] + r["length"] <= ends[r["sequence_id"]] for r in got])


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, SF).count() == stages["best_fit_packing"][1].count()


@pytest.fixture
def odd_docs(spark, frame, odd_rows):
    """Odd rows in the columns of documents, with more columns whose names stages use themselves."""
    rows = odd_rows + [(50, "the same passage of many words, " * 20), (51, "the same passage of many words, " * 20 + "and an end"), (None, None)]
    docs = frame(rows).selectExpr("doc_id", "text", "CASE WHEN doc_id % 2 = 0 THEN 'en' END AS lang", "CASE WHEN doc_id % 3 = 0 THEN 'b' WHEN doc_id % 3 = 1 THEN 'a' END AS source", "CAST(length(text) AS bigint) AS n_chars", "dk", "1 AS quality_score", "'x' AS digest", "2 AS tie")
    return docs


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows_and_empty_tables(spark, odd_docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    got = [r.asDict() for r in stage(spark, odd_docs, SF).collect()]
    ids = Counter(r["doc_id"] for r in got)
    before = Counter(r["doc_id"] for r in odd_docs.collect())
    if name == "quality_classifier":
        assert all(n <= before[i] for i, n in ids.items())
    elif name == "near_dedup":
        assert all(n <= before[i] for i, n in ids.items()) and ids[None] >= 1 and ids[5] == 0 and ids[4] == 2 and ids[51] == 1
    elif name == "suffix_array_dedup":
        assert ids == before and all(r["text"] is not None and r["n_chars"] == len(r["text"]) for r in got)
        assert len({r["text"] for r in got if r["doc_id"] in (50, 51)}) == 2 and [r["text"] for r in got if r["doc_id"] == 51] == ["and an end"]
    elif name == "mixing":
        assert all(n <= 2 * before[i] for i, n in ids.items())
    else:
        assert set(ids) == set(before) and all(r["length"] >= 1 for r in got)
    none = stage(spark, odd_docs.limit(0), SF)
    assert none.count() == 0
    if name != "best_fit_packing":
        assert set(corpus_pipeline.COLUMNS) <= set(none.columns)
