"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lowers the text, maps homoglyphs and accents to plain letters, digits and signs inside words to the letters that
they stand for, and everything else to blanks. The lexicon holds whole words and beginnings of words: a small given list,
and terms that labelled documents show to be typical, weighted by their log odds. Matches inside an exception phrase don't
count. The weights that match, against the length of the text, give the score.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.llm.common import written
from tracewright.llm.labels import remainder, sampled_texts, training_sample

#: At most so many labelled documents that are toxic, and that aren't, are learned from.
SAMPLE = {1: 4_000, 0: 8_000}
PREFIXES = (4, 5, 6, 7)
#: A term may be learned if its likelihood ratio statistic and log odds reach these; of the CANDIDATES strongest those are
#: taken in turn that add most toxic documents, each clean one counting so many times against, down to LEAST_GAIN; strictly
#: first, less so for what no strict choice covers.
LEAST_G, LEAST_ODDS, CANDIDATES, CLEAN, LEAST_GAIN = 20.0, 1.5, 3_000, (10, 2, 0.5), 3
THRESHOLD = 0.5

#: General insults of four languages by weight; learned terms are added to them.
INSULTS = {
    4.0: "idiot moron imbecile scum scumbag vermin subhuman degenerate cretin halfwit bastard dummkopf abschaum trottel vollidiot missgeburt drecksack abruti ordure raclure salaud connard estupido imbecil cretino escoria cabron malnacido",
    3.0: "stupid loser pathetic worthless disgusting brainless braindead lowlife parasite swine versager depp widerlich erbärmlich debile minable degoutant nulle inutil asqueroso patetico miserable idiota",
    2.5: "trash garbage filth clown fool coward liar jerk creep müll pfeife clown bouffon menteur lache basura payaso mentiroso cobarde",
}
GIVEN = {word: weight for weight, words in INSULTS.items() for word in words.split()}
#: Phrases in which a word of the lexicon means no harm; others are learned.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "trash collection", "garbage collection", "garbage collector", "garbage truck", "garbage can", "clown fish", "circus clown", "class clown", "sore loser rule", "idiot light", "idiot proof", "fool proof", "fool s gold", "april fool", "swine flu", "parasite host", "host parasite", "müll abfuhr", "payaso de circo")
#: A phrase of two words that holds a matched one is learned as an exception if so many clean documents of the sample have it and no toxic one; so many are kept.
LEAST_CLEAN, LEARNED = 5, 500

#: Letters of other alphabets that look like Latin ones.
LOOKALIKES = dict(zip("авекмнорстухіјѕԁԛԝһѵαβεηικνορτυχγıłøđ", "abekmhopctyxijsdqwhvabenikvoptuxyilod", strict=True))
#: Digits and signs for letters. One and l, which stand for both, fold to i.
DIGITS = {"0": "o", "1": "i", "!": "i", "|": "i", "3": "e", "4": "a", "@": "a", "5": "s", "$": "s", "7": "t", "8": "b", "9": "g"}
_INSIDE = re.compile(r"(?:(?<=[^\W\d_])|(?<![^\W_]))[0134578 9@$!|]+(?=[^\W\d_])".replace(" ", ""))
_ENDING = re.compile(r"(?<=[^\W\d_])[0134578 9@]+(?![\w@$!|])".replace(" ", ""))
_WANTED = re.compile(r"[0-9@$!|]")


class _Plain(dict):
    """What str.translate needs: letters stay, or become their plain letters; marks vanish; all else is a blank."""

    def __missing__(self, code: int) -> str | None:
        c = chr(code)
        if c in LOOKALIKES:
            out: str | None = LOOKALIKES[c]
        elif unicodedata.category(c) in ("Mn", "Cf"):
            out = None
        else:
            parts = "".join(x for x in unicodedata.normalize("NFKD", c).lower() if x.isalpha())
            out = "".join(LOOKALIKES.get(x, x) for x in parts) or " "
        out = out and out.replace("l", "i")
        self[code] = out
        return out


_plain = _Plain()


def fold(text: str) -> str:
    """Folded words, one blank between them and at both ends."""
    text = text.lower()
    if _WANTED.search(text):
        swap = lambda m: "".join(DIGITS[c] for c in m[0])
        text = _ENDING.sub(swap, _INSIDE.sub(swap, text))
    return f" {' '.join(text.translate(_plain).split())} "


@dataclass
class Lexicon:
    """terms: " word " or " beginning" in folded form, with weights. calibration: of log(1 + sum), sum for the length, and 1."""

    terms: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    calibration: tuple[float, float, float] = (1.0, 1.0, -2.0)

    def __post_init__(self) -> None:
        self._found = None

    def __getstate__(self) -> dict:
        return {"terms": self.terms, "exceptions": self.exceptions, "calibration": self.calibration, "_found": None}

    def automaton(self) -> ahocorasick.Automaton:
        if self._found is None:
            self._found = ahocorasick.Automaton()
            for term, weight in self.terms.items():
                self._found.add_word(term, (len(term), weight, term))
            for phrase in self.exceptions:
                folded = fold(phrase)
                self._found.add_word(folded, (len(folded), -1.0, folded))
            self._found.make_automaton()
        return self._found

    def measures(self, text: str) -> tuple[float, float]:
        """log(1 + sum of weights) and the same for the sum a hundred words. Of terms that begin at one word the heaviest counts; a word counts once a text."""
        folded = fold(text)
        hits: dict[int, tuple[float, str]] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight, term) in self.automaton().iter(folded):
            start = end - size + 1
            if weight < 0:
                spared.append((start, end))
            elif weight > hits.get(start, (0.0, ""))[0]:
                hits[start] = weight, folded[start : folded.index(" ", start + 1)]
        # a hit is spared if an exception phrase begins at or before it and ends after it: of those that begin so, the farthest end decides
        spared.sort()
        begins, farthest = [a for a, _ in spared], list(accumulate((b for _, b in spared), max))
        open_ = lambda s: not (k := bisect_right(begins, s)) or farthest[k - 1] <= s
        total = sum(w for w, _ in sorted({x for s, x in hits.items() if open_(s)}))
        words = folded.count(" ") - 1
        return float(np.log1p(total)), float(np.log1p(100 * total / (words + 20)))

    def phrases(self, text: str) -> set[str]:
        """The phrases of two folded words that hold a matched one, blanks around them."""
        folded, out = fold(text), set()
        for end, (size, weight, _) in self.automaton().iter(folded):
            start = end - size + 1
            if weight > 0:
                stop = folded.index(" ", start + 1)
                before, after = folded.rfind(" ", 0, start), folded.find(" ", stop + 1)
                if before >= 0:
                    out.add(folded[before : stop + 1])
                if after >= 0:
                    out.add(folded[start : after + 1])
        return out

    def score(self, text: str) -> float:
        a, b = self.measures(text)
        x, y, z = self.calibration
        return float(1 / (1 + np.exp(-(x * a + y * b + z))))


def given_lexicon() -> Lexicon:
    return Lexicon({fold(w): weight for w, weight in GIVEN.items()})


def _terms(text: str) -> set[str]:
    words = set(fold(text).split())
    return {f" {w} " for w in words if len(w) > 2} | {f" {w[:k]}" for w in words for k in PREFIXES if len(w) >= k}


def _chosen(matched: list[list[int]], labels: np.ndarray, candidates: int) -> list[int]:
    """Candidates that cover the toxic documents between them with hardly a clean one, the best first."""
    there = np.zeros((candidates, len(matched)), np.uint8)
    for doc, terms in enumerate(matched):
        there[terms, doc] = 1
    clean = there[:, labels == 0].sum(1, dtype=np.int64)
    toxic, out = there[:, labels == 1], []
    for times in CLEAN:
        while True:
            gain = toxic.sum(1, dtype=np.int64) - times * clean
            k = int(gain.argmax())
            if gain[k] < LEAST_GAIN:
                break
            out.append(k)
            toxic = toxic[:, toxic[k] == 0]
    return out


def _calibrated(measures: np.ndarray, labels: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression with a little shrinkage, by Newton steps."""
    x = np.c_[measures, np.ones(len(measures))]
    w = np.array([1.0, 1.0, -2.0])
    keep = np.diag([0.005, 0.005, 0.001]) * max(1, len(x)) ** 0.5
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + keep, x.T @ (labels - p) - keep @ w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def learned_lexicon(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", parts: int = 5, held: int = 0, sample: dict[int, int] | None = None) -> Lexicon:
    """The given list, terms learned from a bounded sample of the labelled documents whose crc32(id) mod ``parts`` isn't ``held``, and a calibration on it."""
    chosen = training_sample(labels, label_col, id_col, remainder(F.col(id_col).cast("long"), parts) != held, sample or SAMPLE)
    # a row an id: of documents with one id the first by its text counts
    texts = written(sampled_texts(df, chosen, id_col, text_col).groupBy("id", "label").agg(F.min("text").alias("text")), "sample")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                terms = sorted(_terms(text))
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([label] * len(terms), pa.int32())], ["term", "label"])

    n1, n0 = (int(x or 0) for x in texts.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first())
    lexicon = given_lexicon()
    if not n1:
        return lexicon
    counts = texts.mapInArrow(spread, "term string, label int").groupBy("term").agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("seen"))
    odds = F.log((F.col("toxic") + 0.5) / (n1 + 1)) - F.log((F.col("seen") - F.col("toxic") + 0.5) / (n0 + 1))
    share = n1 / max(1, n1 + n0)
    clean = F.col("seen") - F.col("toxic")
    g = 2 * (F.col("toxic") * F.log(F.col("toxic") / (F.col("seen") * share)) + F.when(clean > 0, clean * F.log(clean / (F.col("seen") * (1 - share + 1e-9)))).otherwise(0.0))
    best = counts.filter("toxic > 0").withColumn("odds", odds).withColumn("g", g).filter((F.col("g") >= LEAST_G) & (F.col("odds") >= LEAST_ODDS))
    # among terms of the same documents the longest comes first, and a beginning before the whole word: few innocent words share it
    rows = best.orderBy(F.desc("g"), F.desc(F.length(F.rtrim("term"))), "term").limit(CANDIDATES).collect()
    weights = {r["term"]: r["odds"] for r in rows}
    if weights:
        asked = Lexicon(weights, ())
        number = {term: k for k, term in enumerate(weights)}

        def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [sorted({number[hit[2]] for _, hit in asked.automaton().iter(fold(x))}) for x in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["id", "label", "found"])

        docs = texts.mapInArrow(matched, "id long, label int, found array<int>").collect()  # bounded by the sample
        docs = sorted(docs, key=lambda r: (r["id"], r["label"], r["found"]))
        names = list(weights)
        for k in _chosen([r["found"] for r in docs], np.array([r["label"] for r in docs]), len(names)):
            lexicon.terms[names[k]] = max(weights[names[k]], lexicon.terms.get(names[k], 0.0))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(lexicon.phrases(x)) for x in batch.column(2).to_pylist()]
            label = np.repeat(batch.column(1).to_numpy(), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays([pa.array([p for x in found for p in x], pa.string()), pa.array(label, pa.int32())], ["phrase", "label"])

    seen = texts.mapInArrow(held, "phrase string, label int").groupBy("phrase").agg(F.count_if(F.col("label") == 0).alias("clean"), F.count_if(F.col("label") == 1).alias("toxic"))
    harmless = seen.filter((F.col("toxic") == 0) & (F.col("clean") >= LEAST_CLEAN)).orderBy(F.desc("clean"), "phrase").limit(LEARNED).collect()
    lexicon = Lexicon(lexicon.terms, (*lexicon.exceptions, *[r["phrase"].strip() for r in harmless]))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [lexicon.measures(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([m[0] for m in both], pa.float64()), pa.array([m[1] for m in both], pa.float64())], ["label", "a", "b"])

    rows = texts.mapInArrow(measured, "label int, a double, b double").collect()  # bounded by the sample
    rows = sorted((r["a"], r["b"], r["label"]) for r in rows)
    lexicon.calibration = _calibrated(np.array([r[:2] for r in rows]), np.array([r[2] for r in rows], float))
    return lexicon


def with_toxicity(df: DataFrame, lexicon: Lexicon, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """df with a column of scores; one of that name is replaced. All other columns pass through, whatever their names.

    A null text scores as an empty one, repeated rows score alike, an empty table gives none, and long texts are matched whole.
    """
    at = df.columns.index(text_col)
    names = [f"c{k}" for k in range(len(df.columns))]  # no name of df can clash with the score
    fields = [T.StructField(n, f.dataType) for n, f in zip(names, df.schema.fields, strict=True)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([lexicon.score(x or "") for x in batch.column(at).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*names, "score"])

    rows = df.toDF(*names).mapInArrow(work, T.StructType([*fields, T.StructField("score", T.DoubleType())]))
    kept = [(n, c) for n, c in zip(names, df.columns, strict=True) if c != out]
    return rows.select(*[F.col(n).alias(c) for n, c in kept], F.col("score").alias(out))


def toxicity_scores(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, held_out, score (0 to 1) and predicted (1 from ``threshold`` on).

    Every text is scored whole, empty and null ones as empty; a null id is never held out and stays null; repeated rows score
    alike; null ids or labels train nothing, and without labels the given list alone decides; an empty table gives none; other
    columns are ignored.
    """
    lexicon = learned_lexicon(df, labels, id_col, text_col)
    rows = df.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    held = F.coalesce(remainder(F.col(id_col), 5) == 0, F.lit(False))
    return with_toxicity(rows, lexicon, out="score").select(id_col, held.alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"))
