import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewright.llm import quality, toxicity
from tracewright.llm.labels import training_sample

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def held_out_rates(found, labels, col):
    rows = found.filter("held_out").join(labels, "doc_id").groupBy(col).agg(F.avg("predicted").alias("p")).collect()
    return {r[col]: r["p"] for r in rows}


def test_quality_on_held_out_documents(tables):
    docs, labels = tables
    found = quality.quality_scores(docs, labels).cache()
    assert found.count() == docs.count() and found.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    rates = held_out_rates(found, labels, "quality")
    assert rates[1] > 0.98 and rates[0] < 0.06


def test_toxicity_on_held_out_documents(tables):
    docs, labels = tables
    found = toxicity.toxicity_scores(docs, labels).cache()
    assert found.count() == docs.count()
    rates = held_out_rates(found, labels, "toxic")
    assert rates[1] > 0.75 and rates[0] < 0.01  # some toxic labels are of texts without any typical word


def test_gradients_lower_the_loss():
    draw = np.random.default_rng(2)
    bags, labels = [], []
    for k in range(120):
        x = draw.normal(0, 1, (int(draw.integers(1, 6)), quality.FEATURES)).astype(np.float32)
        if k % 2:
            x[int(draw.integers(0, len(x))), :5] += 4  # one passage of the bag decides
        bags.append(x)
        labels.append(k % 2)
    model = quality.trained(bags, np.array(labels, float), epochs=30)
    p = np.array([model.bags(b, np.array([0]))["p"][0] for b in bags])
    assert ((p > 0.5) == np.array(labels)).mean() > 0.9


def test_scores_of_odd_rows(spark, frame, odd_rows):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 1), (None, 1, 1), (4, None, None), (4, 1, 0), (4, 0, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for found in (quality.quality_scores(frame(odd_rows), labels), toxicity.toxicity_scores(frame(odd_rows), labels)):
        rows = found.collect()
        assert sorted((r["doc_id"] for r in rows), key=str) == sorted((i for i, _ in odd_rows), key=str)
        assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in rows)
    none = frame(odd_rows).limit(0)
    assert quality.quality_scores(none, labels).count() == 0 and toxicity.toxicity_scores(none, labels.limit(0)).count() == 0


def test_sample_is_bounded(spark):
    labels = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    got = training_sample(labels, "quality", "doc_id", F.col("doc_id") % 10 != 3, {0: 30, 1: 20}).collect()
    assert sorted(r["label"] for r in got) == [0] * 30 + [1] * 20 and all(r["id"] % 10 != 3 for r in got)


@pytest.mark.parametrize("written", ["IDIOT", "1d10t", "1diot!", "іdіot", "ídïot", "ｉｄｉｏｔ", "id​iot", "!diot"])
def test_folding(written):
    assert toxicity.fold(f"you {written} there") in (" you idiot there ", " you idioti there ")
    assert toxicity.given_lexicon().measures(f"you {written} there")[0] > 0


def test_folding_leaves_numbers_and_marks():
    assert toxicity.fold("call 555-3138 now$$$ (a).") == " caii now a "


def test_exception_phrases_and_length():
    lexicon = toxicity.given_lexicon()
    assert lexicon.measures("put it in the trash can please")[0] == 0
    assert lexicon.measures("you are trash")[0] > 0
    assert lexicon.measures("idiot")[1] > lexicon.measures("idiot " + "word " * 300)[1]
    assert lexicon.measures("") == (0.0, 0.0)


def test_chosen_terms_cover_without_clean_ones():
    labels = np.array([1, 1, 1, 1, 1, 1, 0, 0, 0])
    matched = [[0], [0], [0, 2], [1, 2], [1, 2], [1, 2], [2], [2], []]
    assert sorted(toxicity._chosen(matched, labels, 3)) == [0, 1]


def naive_measures(lexicon, text):
    """Every term at every word, one by one."""
    folded = toxicity.fold(text)
    words = folded.split()
    phrases = [toxicity.fold(p).split() for p in lexicon.exceptions]
    spared = {k + j for p in phrases for k in range(len(words)) if words[k : k + len(p)] == p for j in range(len(p))}
    hits = {}
    for k, word in enumerate(words):
        found = [w for term, w in lexicon.terms.items() if (f" {word} " == term if term.endswith(" ") else f" {word}".startswith(term))]
        if found and k not in spared:
            hits[max(found), word] = True
    total = sum(w for w, _ in hits)
    return np.log1p(total), np.log1p(100 * total / (len(words) + 20))


def test_matches_against_a_naive_matcher():
    draw = np.random.default_rng(4)
    lexicon = toxicity.Lexicon({toxicity.fold(w): weight for w, weight in toxicity.GIVEN.items()} | {" stup": 1.5, " tra": 0.5, " idio": 2.0, " clow": 1.0})
    words = [*list(toxicity.GIVEN)[:12], "can", "tract", "idiotic", "$tupid", "cl0wn", "fish", "good", "day", "st", "1d10t!", "trash", "proof", "—"]
    for _ in range(300):
        text = " ".join(words[k] for k in draw.integers(0, len(words), int(draw.integers(0, 25))))
        assert np.allclose(lexicon.measures(text), naive_measures(lexicon, text)), text


def test_long_texts_of_matches_and_exceptions_take_little_time():
    import time

    lexicon = toxicity.Lexicon({" bad ": 1.0, " awf": 2.0}, ("not bad", "awful quiet night"))
    part = "not bad and awful stuff, bad things, awful quiet night. "
    want = lexicon.measures(part)
    began = time.perf_counter()
    got = lexicon.measures(part * 20_000)
    assert time.perf_counter() - began < 10 and abs(got[0] - want[0]) < 1e-9


def test_exceptions_are_learned(spark, frame):
    rows = [(k, f"{'you idiot' if k % 3 == 0 else 'the trash heap'} number {k}") for k in range(120)]
    labels = spark.createDataFrame([(k, 0, int(k % 3 == 0)) for k in range(120)], "doc_id long, quality int, toxic int")
    lexicon = toxicity.learned_lexicon(frame(rows), labels)
    assert "trash heap" in lexicon.exceptions and not any("idiot" in x for x in lexicon.exceptions if x not in toxicity.EXCEPTIONS)
    assert lexicon.measures("on the trash heap")[0] == 0 < lexicon.measures("you are trash")[0]


def test_forward_pass_against_plain_loops():
    draw = np.random.default_rng(6)
    bags = [draw.normal(0, 1, (n, quality.FEATURES)).astype(np.float32) for n in (1, 3, 7)]
    m = quality.trained(bags, np.array([0.0, 1.0, 1.0]), epochs=2)
    got = m.bags(np.concatenate(bags), np.array([0, 1, 4]))["p"]
    for bag, p in zip(bags, got, strict=True):
        hs, es = [], []
        for x in bag:
            h = [np.tanh(sum((x[i] - m.mean[i]) / m.scale[i] * m.encode[i, j] for i in range(len(x))) + m.encode_bias[j]) for j in range(m.encode.shape[1])]
            look = [np.tanh(sum(h[i] * m.look[i, j] for i in range(len(h)))) for j in range(m.look.shape[1])]
            gate = [1 / (1 + np.exp(-sum(h[i] * m.gate[i, j] for i in range(len(h))))) for j in range(m.gate.shape[1])]
            hs.append(h)
            es.append(np.exp(sum(a * b * w for a, b, w in zip(look, gate, m.weigh, strict=True))))
        z = [sum(e * h[j] for e, h in zip(es, hs, strict=True)) / sum(es) for j in range(len(hs[0]))]
        assert abs(p - 1 / (1 + np.exp(-(sum(a * b for a, b in zip(z, m.score, strict=True)) + m.bias)))) < 1e-6


def test_long_texts_are_encoded_in_parts_and_scored_whole(monkeypatch):
    draw = np.random.default_rng(8)
    raws = [draw.integers(97, 123, n, np.uint8).tobytes() for n in (0, 1, 1024, 5000, 40_000)]
    whole = [quality.passages(r) for r in raws]
    model = quality.trained(whole, np.array([0.0, 1, 0, 1, 0]), epochs=1)
    want = [float(model.bags(x, np.array([0]))["p"][0]) for x in whole]
    monkeypatch.setattr(quality, "AT_ONCE", 3)
    assert all((quality.passages(r) == x).all() for r, x in zip(raws, whole, strict=True))
    assert np.allclose(model.probabilities(raws), want)


def test_columns_of_the_score_s_name_are_replaced(spark, frame):
    df = frame([(1, "a b"), (2, None)]).withColumn("quality_score", F.lit("old")).withColumn("toxicity", F.lit("old")).withColumn("c0", F.lit(7))
    model = quality.quality_model(df, spark.createDataFrame([], "doc_id long, quality int"))
    scored = quality.with_quality(df, model)
    assert sorted(scored.columns) == sorted(df.columns) and {r["quality_score"] for r in scored.collect()} == {0.5} and {r["c0"] for r in scored.collect()} == {7}
    assert dict(toxicity.with_toxicity(df, toxicity.given_lexicon()).dtypes)["toxicity"] == "double"


def test_repeated_ids_train_once(spark, frame):
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(40)], "doc_id long, quality int, toxic int")
    rows = [(k, f"text {k} " * (k + 1)) for k in range(40)]
    one = quality.quality_model(frame(rows), labels)
    again = quality.quality_model(frame(rows + [(3, "text 3 " * 4)] * 200), labels)
    assert np.allclose(one.score, again.score)
