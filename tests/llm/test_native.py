"""Fingerprints, mixing and licence scans: the operators that are DataFrame functions only."""

import hashlib
import os
import random
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tracewright.llm import fingerprints, licenses, mixing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def native(df):
    return not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def shingles(text):
    w = WORDS.findall(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize(("per_range", "ranges"), [(250, 10_000), (3, 10_000), (2, 4)])
def test_fingerprints_against_brute_force(frame, odd_rows, per_range, ranges, monkeypatch):
    """Also where there are more ranges than the driver may know, so that they are split again."""
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", per_range)
    monkeypatch.setattr(fingerprints, "MOST_RANGES", ranges)
    rows = odd_rows + [(k, f"n{k} one two three four five six {k % 3} seven eight nine ten") for k in range(20, 45)]
    df = fingerprints.fingerprints(frame(rows), k=4096)
    assert native(df)
    got = sorted((tuple(r) for r in df.collect()), key=str)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    want = []
    for k, (i, t) in enumerate(ordered):
        t, n = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(t) // 2
        e = t[: len(t) - half] + n[:half]
        a, b = shingles(t), shingles(e)
        held = len(a & b) / len(a) if a else 1.0
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), round(alike(a, b), 9), round(alike(shingles(t), shingles(n)), 9), float(len(a)), round(held, 9)))
    assert [(g[0], g[1], g[2], round(g[5], 9), round(g[6], 9), g[7], round(g[8], 9)) for g in got] == sorted(want, key=str)
    prints = {}
    for (i, t), g in zip(sorted(rows, key=str), sorted(got, key=str), strict=True):
        prints.setdefault(g[3], set()).add(g[1])
    assert fingerprints.fingerprints(frame([(1, "x")]).limit(0)).count() == 0
    one = fingerprints.fingerprints(frame([(9, "a b c d e f")])).first()
    assert one["near_next"] == 1.0


def test_bisection_names_no_column_inside_its_lambda(spark):
    """Whatever numbers Spark gives to columns, none can be taken for a lambda variable."""
    lambdas = []
    placed = spark.range(9).select("id", fingerprints._below(F.array(F.lit(3), F.lit(5)), 2, F.col("id")).alias("at"))
    todo = [placed._jdf.queryExecution().analyzed().expressions().apply(1)]
    while todo:
        e = todo.pop()
        lambdas += [e.references().toString()] * (e.getClass().getSimpleName() == "LambdaFunction")
        todo += [e.children().apply(k) for k in range(e.children().size())]
    assert lambdas and set(lambdas) == {"{}"}
    assert [r["at"] for r in placed.orderBy("id").collect()] == [0, 0, 0, 1, 1, 2, 2, 2, 2]


def test_fingerprints_as_a_sessions_first_query_over_ranges_of_ranges(tmp_path):
    """In a process of its own: the columns' numbers begin at 0 there, as those of lambda variables do."""
    code = f"""
from pyspark.sql import SparkSession
from tracewright.llm import fingerprints
from tracewright.llm.queries import op5_document_fingerprints
spark = SparkSession.builder.master("local[2]").config(map={{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.checkpoint.dir": "file://{tmp_path}"}}).getOrCreate()
usual, fingerprints.RANGE_ROWS, fingerprints.MOST_RANGES = (fingerprints.RANGE_ROWS, fingerprints.MOST_RANGES), 5, 4
got = sorted(map(tuple, op5_document_fingerprints(spark, "/root/testdata/sf0.001").collect()))
fingerprints.RANGE_ROWS, fingerprints.MOST_RANGES = usual
assert got == sorted(map(tuple, op5_document_fingerprints(spark, "/root/testdata/sf0.001").collect())) and len(got) >= 200
"""
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ, capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0, ran.stderr[-3000:]


def test_sketches_estimate_and_merge(spark):
    text = lambda a, b: " ".join(f"w{k}" for k in range(a, b))
    df = spark.createDataFrame([("g", text(0, 3004)), ("g", text(2000, 5004)), ("h", text(0, 3004))], "part string, text string")
    sk = fingerprints.with_sketch(df, "text", "sketch", k=512)
    merged = {r["part"]: r for r in fingerprints.merged(sk, ["part"], "sketch", 512).withColumn("n", fingerprints.distinct_shingles(F.col("sketch"), 512)).collect()}
    assert abs(merged["g"]["n"] / 5000 - 1) < 0.2 and abs(merged["h"]["n"] / 3000 - 1) < 0.2
    union = fingerprints.with_sketch(spark.createDataFrame([(text(0, 5004),)], "text string"), "text", "sketch", k=512).first()["sketch"]
    assert merged["g"]["sketch"] == union
    a, b = sk.collect()[0]["sketch"], merged["g"]["sketch"]
    pair = spark.createDataFrame([(a, b)], "a array<bigint>, b array<bigint>")
    est = pair.select(fingerprints.containment("a", "b", 512).alias("c"), fingerprints.resemblance("a", "b", 512).alias("r")).first()
    assert abs(est["c"] - 1) < 0.15 and abs(est["r"] - 0.6) < 0.12


def test_mix_meets_targets(frame, odd_rows, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 5)
    rows = [(k, "word " * (k % 13), f"s{k % 7}" if k % 5 else None) for k in range(400)] + [(1000 + k, "much " * 50, "hot") for k in range(300)]
    rows += [(i, t, "odd") for i, t in odd_rows] + [(5000, "", "zero")]
    df = mixing.mixed(frame(rows))
    got = df.collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mixed(frame(rows).repartition(7)).collect()))
    size = lambda t: len(WORDS.findall(t or ""))
    total = {}
    for _, t, s in rows:
        total[s] = total.get(s, 0) + size(t)
    names = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, open_ = {}, set(names)
    while True:
        left, w = 1.5 * sum(total.values()) - sum(target.values()), sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / w > 2 * total[s]]
        if not over:
            break
        for s in over:
            target[s] = 2 * total[s]
            open_.discard(s)
    target |= {s: left * weight[s] / w for s in open_}
    taken = {}
    wanted = {}
    for i, t, s in rows:
        wanted.setdefault((i, size(t), total[s], round(target[s], 6)), []).append(s)
    for r in got:
        key = (r["doc_id"], r["size"], r["source_size"], round(r["target"], 6))
        assert key in wanted and 0 <= r["taken"] <= 2 * r["size"]
        taken[wanted[key][0]] = taken.get(wanted[key][0], 0) + r["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in names)
    assert mixing.mixed(frame([(1, "x", "s")]).limit(0)).count() == 0


def test_mixed_documents_are_rows_of_the_table(frame):
    rows = [(k, f"t{k} " * (1 + k % 9), f"s{k % 3}") for k in range(90)] + [(1, "t1 t1", "s1")] * 2
    df = frame(rows)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    words = sum(len(r["text"].split()) for r in out.collect())
    assert words == sum(r["taken"] for r in mixing.mixed(df, whole=True).collect())


@pytest.mark.parametrize("whole", [False, True])
def test_documents_that_the_mix_takes(frame, odd_rows, monkeypatch, whole):
    """A plain Efraimidis-Spirakis selection: by key within a source until the rest of the target is spent."""
    monkeypatch.setattr(mixing, "RANGE_ROWS", 7)
    rows = [(k, ("word " if k % 3 else "# $ % ") * (k % 13), f"s{k % 4}") for k in range(300)] + [(i, t, "odd") for i, t in odd_rows]
    df = frame(rows)
    got = mixing.mixed(df, whole=whole).join(df.selectExpr("doc_id", "xxhash64(coalesce(text, ''), 17) AS tie", "source", "text").distinct(), ["doc_id", "tie"]).distinct().collect()
    text = F.coalesce("text", F.lit(""))
    drawn = (F.shiftrightunsigned(F.xxhash64("doc_id", F.xxhash64(text, F.lit(17)), F.lit(17)), 11).cast("double") + 0.5) / 2.0**53
    key_of = {(r[0], r[1]): r[2] for r in df.filter("doc_id IS NOT NULL").select("doc_id", "text", (-F.log(drawn) / mixing.quality_weight(text)).alias("key")).collect()}
    for source in ("s0", "s1", "s2", "s3"):
        own = sorted((r for r in got if r["source"] == source), key=lambda r: key_of[r["doc_id"], r["text"]])
        size = sum(r["size"] for r in own)
        epochs = int(own[0]["target"] // size)
        rest = round(own[0]["target"] - epochs * size)
        for r in own:
            some = (r["size"] if 2 * rest >= r["size"] else 0) if whole and rest > 0 else max(0, min(r["size"], rest))
            assert r["taken"] == epochs * r["size"] + some
            rest -= r["size"]


def test_ranges_of_keys_are_even(spark):
    """Half prose and half texts of symbols, whose keys are ten times as far apart."""
    n, ranges = 60_000, 40
    df = spark.range(n).withColumn("quality", F.when(F.col("id") % 2 == 0, F.lit(0.95)).otherwise(F.lit(0.1))).withColumn("key", -F.log((F.xxhash64("id").bitwiseAND(F.lit(2**40 - 1)) + 0.5) / 2.0**40) / F.col("quality"))
    rates = F.array(*[F.struct(F.lit(n // 2).alias("m"), F.lit(q).alias("rate")) for q in (0.95, 0.1)])
    parts = df.withColumn("rates", rates).withColumn("n", F.lit(n)).withColumn("part", mixing.key_range(F.lit(ranges)))
    got = sorted(parts.groupBy("part").agg(F.count(F.lit(1)).alias("c"), F.min("key").alias("a"), F.max("key").alias("z")).collect())
    assert len(got) == ranges and max(r["c"] for r in got) <= 1.2 * n / ranges
    assert all(x["z"] <= y["a"] for x, y in zip(got, got[1:], strict=False))


def test_heavier_documents_come_first_more_often(spark):
    rows = [(k, ("plain words here " if k % 2 else "## $$ %% ^^ ") * 10, "a") for k in range(2000)] + [(9000 + k, "filler " * 30, "b") for k in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed(df, share=0.4).filter("doc_id < 9000").collect()
    share = lambda odd: sum(r["taken"] for r in got if r["doc_id"] % 2 == odd) / sum(r["size"] for r in got if r["doc_id"] % 2 == odd)
    assert share(1) > 1.5 * share(0)


def brute_hits(text, least=licenses.LEAST):
    grams = [licenses.bigrams(t) for _, t in licenses.TEMPLATES]
    text, hits = text or "", []
    for unit in dict.fromkeys([*text.split("\n"), *re.split(r"\n[\x20\t\r]*\n", text), text]):
        b = licenses.bigrams(unit)
        hits += [(2 * len(b & g) / (len(b) + len(g)), -k) for k, g in enumerate(grams) if b and 2 * len(b & g) / (len(b) + len(g)) >= least]
    return hits


def brute_license(text):
    hits = brute_hits(text)
    best = max(hits, default=None)
    return (licenses.TEMPLATES[-best[1]][0], best[0], len(hits)) if best else (None, 0.0, 0)


def brute_runs(text, least=licenses.LEAST):
    """Of each template that a run of the text's words reaches, the coefficient of the best run."""
    words, found = licenses.re.findall(r"[^\W_]+", text.lower()), {}
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    for k, (_, template) in enumerate(licenses.TEMPLATES):
        t = licenses.bigrams(template)
        runs = (set(pairs[i:j]) for i in range(len(pairs)) for j in range(i + 1, min(len(pairs), i + int(len(t) * (2 - least) / least)) + 1))
        dice = max((2 * len(r & t) / (len(r) + len(t)) for r in runs), default=0)
        if dice >= least:
            found[k] = dice
    return found


def test_notices_inside_other_text(frame):
    noise = lambda k, n: " ".join(f"n{k}x{i}" for i in range(n))
    wrap = lambda words, n, mark: "\n".join(mark + " ".join(words[i : i + n]) for i in range(0, len(words), n))
    texts = ["Copyright 2024 Foo Inc. All rights reserved.", f"{noise(0, 20)} Released under the MIT License. {noise(1, 30)}", "All rights are not reserved, nor is anything licensed."]
    for k, (_, t) in enumerate(licenses.TEMPLATES):
        words = t.split()
        texts.append(f"{noise(k, 40)} {t} {noise(k, 40)}")
        texts.append(wrap([*noise(k, 60).split(), *words, *noise(k, 60).split()], 9, "# "))
        changed = [*words[: len(words) // 2], *(["new"] if len(words) > 15 else []), *words[len(words) // 2 :]]
        texts.append(wrap([*noise(k, 60).split(), *changed, *noise(k, 60).split()], 7, " * "))
    # a line that matches doesn't hide a notice of another licence inside a longer one
    texts.append(f"Released under the MIT License.\n{noise(9, 20)} {licenses.TEMPLATES[0][1]} {noise(9, 20)}")
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in licenses.license_scan(frame(rows), runs=True).collect()}
    runs = 0
    for i, t in rows:
        hits = brute_hits(t)
        found = [(d, -k) for k, d in brute_runs(t).items() if -k not in {h[1] for h in hits}]
        best = max([*hits, *found], default=(0.0, None))
        want = (licenses.TEMPLATES[-best[1]][0], -best[1]) if best[1] is not None else (None, None)
        assert (got[i]["license"], got[i]["template"]) == want and abs(got[i]["dice"] - best[0]) < 1e-12 and got[i]["n_matches"] == len(hits) + len(found)
        runs += bool(found)
    assert runs >= 55 and got[0]["license"] == "proprietary" and got[1]["license"] == "MIT" and got[2]["license"] is None
    assert got[len(texts) - 1]["n_matches"] >= 2


def test_texts_without_needed_words_are_not_searched_for_runs(frame, monkeypatch):
    """Only texts with such a word are split into runs, and no run without one reaches a template."""
    needed = licenses.needed_words(licenses.TEMPLATES)
    left = [" ".join(w for w in licenses.re.findall(r"[^\W_]+", t.lower()) if w not in needed) for _, t in licenses.TEMPLATES]
    assert not any(brute_runs(t) for t in [*left, " ".join(left)])
    rows = [(1, f"some words {licenses.TEMPLATES[0][1]} more words")]
    assert licenses.license_scan(frame(rows), runs=True).first()["license"] == "Apache-2.0"
    monkeypatch.setattr(licenses, "needed_words", lambda *_: ["word that no text has"])
    assert licenses.license_scan(frame(rows), runs=True).first()["license"] is None


def test_runs_in_long_texts_are_found_in_time(frame):
    """Bigrams of templates that stand alone and a notice in the middle: a run is only tried where enough of them are near each other."""
    import time

    draw = random.Random(4)
    words = [w for _, t in licenses.TEMPLATES for w in licenses.re.findall(r"[^\W_]+", t)]
    mixed = lambda n: " ".join(f"{(k := draw.randrange(len(words) - 1)) and words[k]} {words[k + 1]} x{draw.randrange(10**6)} y{draw.randrange(10**6)} z" for _ in range(n))
    text = f"{mixed(4000)} {licenses.TEMPLATES[5][1]} {mixed(4000)}"
    began = time.perf_counter()
    got = licenses.license_scan(frame([(1, text)]), runs=True).first()
    assert got["license"] == "MIT" and got["template"] == 5 and time.perf_counter() - began < 60


def test_license_scan_against_brute_force(frame, odd_rows):
    texts = [t for _, t in licenses.TEMPLATES]
    rows = odd_rows + [(100 + k, f"Some prose.\n{t}\nMore.") for k, t in enumerate(texts)]
    rows += [(200 + k, "\n".join(t[a : a + 40] for a in range(0, len(t), 40))) for k, t in enumerate(texts)]
    rows += [(300 + k, " ".join(w for n, w in enumerate(t.split()) if n % 12 != 3)) for k, t in enumerate(texts)]
    rows += [(400, "The licence of this software is not stated."), (401, "ALL RIGHTS RESERVED"), (402, "license"), (403, "\n\nlicensed\n\nunder\n")]
    df = licenses.license_scan(frame(rows))
    assert native(df)
    got = sorted(((r["doc_id"], r["license"], r["dice"], r["n_matches"]) for r in df.collect()), key=str)
    assert got == sorted(((i, *brute_license(t)) for i, t in rows), key=str)
    assert sum(g[1] is not None for g in got) > 40
    assert licenses.license_scan(frame([(1, "x")]).limit(0)).count() == 0


def test_needed_words_suffice():
    words = set(licenses.needed_words(licenses.TEMPLATES))
    for _, t in licenses.TEMPLATES:
        grams = licenses.bigrams(t)
        free = [g for g in grams if not set(g.split()) & words]
        assert 2 * len(free) / (len(free) + len(grams)) < licenses.LEAST
