"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded (byte classes, hashed byte pairs and how often it repeats itself,
through one layer), gated attention weighs the passages, and the weighted representation is scored. Labels belong to
documents only; which passages decide is learned. Training takes a bounded sample of labelled documents; scoring is per
row, over whole texts, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.llm.common import written
from tracewright.llm.labels import remainder, sampled_texts, training_sample

PASSAGE = 1024
PAIRS, GRAMS = 64, 1024
#: At most so many labelled documents of each label are trained on, whole, and of those in the order of a hash of their ids as
#: many as have so many passages in all (the first in any case).
SAMPLE, SAMPLE_PASSAGES = 3_000, 200_000
#: Passages that are encoded or scored at once, about.
AT_ONCE = 4_096
THRESHOLD = 0.7

_CLASS = np.zeros(256, np.int64)  # other
for _k, _chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", ".,;:?'\"()-", "!#$%&*+/<=>@[\\]^_`{|}~"), 1):
    _CLASS[np.frombuffer(_chars.encode(), np.uint8)] = _k
_CLASS[128:] = 8
CLASSES = 9
FEATURES = CLASSES + PAIRS + 3


def passages(raw: bytes) -> np.ndarray:
    """Features of each passage of PASSAGE bytes; an empty text is one empty passage. Long texts are encoded a part at a time."""
    step = AT_ONCE * PASSAGE
    return np.concatenate([_encoded(raw[at : at + step + 3], step) for at in range(0, max(1, len(raw)), step)])


def _encoded(raw: bytes, most: int) -> np.ndarray:
    """Features of the passages of the first ``most`` bytes; those that follow belong to pairs and grams that begin before them."""
    ahead = np.frombuffer(raw, np.uint8)
    b = ahead[:most]
    n = max(1, -(-len(b) // PASSAGE))
    out = np.zeros((n, FEATURES), np.float32)
    if not len(b):
        return out
    owner = np.arange(len(b)) // PASSAGE
    size = np.bincount(owner, minlength=n).astype(np.float32)[:, None]
    out[:, :CLASSES] = np.bincount(owner * CLASSES + _CLASS[b], minlength=n * CLASSES).reshape(n, CLASSES) / size
    wide = ahead.astype(np.uint32)
    pair = ((wide[:-1] * 251 + wide[1:]) * np.uint32(2654435761)) >> np.uint32(26)
    out[:, CLASSES : CLASSES + PAIRS] = np.bincount(owner[: len(pair)] * PAIRS + pair[: len(b)], minlength=n * PAIRS).reshape(n, PAIRS) / size
    four = wide[:-3] | wide[1:-2] << np.uint32(8) | wide[2:-1] << np.uint32(16) | wide[3:] << np.uint32(24)
    gram = ((four * np.uint32(2246822519)) >> np.uint32(22))[: len(b)]
    seen = np.bincount(owner[: len(gram)] * GRAMS + gram, minlength=n * GRAMS).reshape(n, GRAMS)
    out[:, -3] = (seen > 0).sum(1) / np.minimum(size[:, 0], GRAMS)
    out[:, -2] = seen.max(1) / size[:, 0]
    out[:, -1] = np.log1p(size[:, 0]) / 7
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    encode: np.ndarray
    encode_bias: np.ndarray
    look: np.ndarray
    gate: np.ndarray
    weigh: np.ndarray
    score: np.ndarray
    bias: float

    def bags(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """All that a forward pass yields, for bags of passages that begin at ``starts``."""
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ self.encode + self.encode_bias)
        look, gate = np.tanh(h @ self.look), 1 / (1 + np.exp(-(h @ self.gate)))
        e = (look * gate) @ self.weigh
        sizes = np.diff(np.r_[starts, len(x)])
        owner = np.repeat(np.arange(len(starts)), sizes)
        e = np.exp(e - np.maximum.reduceat(e, starts)[owner])
        a = e / np.add.reduceat(e, starts)[owner]
        z = np.add.reduceat(a[:, None] * h, starts)
        p = 1 / (1 + np.exp(-np.clip(z @ self.score + self.bias, -30, 30)))
        return {"x": x, "h": h, "look": look, "gate": gate, "a": a, "z": z, "p": p, "owner": owner}

    def probabilities(self, raws: list[bytes]) -> list[float]:
        """Scores of texts; about AT_ONCE passages, or one text, go through the model at once."""
        out, waiting, held = [], [], 0
        for raw in [*raws, None]:
            if waiting and (raw is None or held >= AT_ONCE):
                starts = np.cumsum([0, *map(len, waiting[:-1])])
                out += self.bags(np.concatenate(waiting), starts)["p"].tolist()
                waiting, held = [], 0
            if raw is not None:
                waiting.append(passages(raw))
                held += len(waiting[-1])
        return out

    def probability(self, raw: bytes) -> float:
        return self.probabilities([raw])[0]


def trained(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 24, attention: int = 12, epochs: int = 40, rate: float = 0.01, seed: int = 5) -> Model:
    """Cross-entropy by Adam on batches of bags; both labels weigh alike. Runs on the driver, on the bounded sample."""
    draw = np.random.default_rng(seed)
    every = np.concatenate(bags)
    model = Model(
        every.mean(0),
        np.maximum(every.std(0), 1e-3),
        draw.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, hidden)),
        np.zeros(hidden),
        draw.normal(0, 1 / np.sqrt(hidden), (hidden, attention)),
        draw.normal(0, 1 / np.sqrt(hidden), (hidden, attention)),
        draw.normal(0, 1 / np.sqrt(attention), attention),
        draw.normal(0, 1 / np.sqrt(hidden), hidden),
        0.0,
    )
    share = np.clip(labels.mean(), 0.02, 0.98)
    weights = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    names = ("encode", "encode_bias", "look", "gate", "weigh", "score")
    first, second, step = {n: 0.0 for n in (*names, "bias")}, {n: 0.0 for n in (*names, "bias")}, 0
    for _ in range(epochs):
        order = draw.permutation(len(bags))
        for at in range(0, len(order), 64):
            some = order[at : at + 64]
            sizes = np.array([len(bags[k]) for k in some])
            starts = np.cumsum(sizes) - sizes
            f = model.bags(np.concatenate([bags[k] for k in some]), starts)
            error = (f["p"] - labels[some]) * weights[some] / len(some)
            grads = {"score": f["z"].T @ error, "bias": error.sum()}
            dz = error[:, None] * model.score
            da = (dz[f["owner"]] * f["h"]).sum(1)
            de = f["a"] * (da - np.add.reduceat(f["a"] * da, starts)[f["owner"]])
            dh = f["a"][:, None] * dz[f["owner"]]
            grads["weigh"] = (f["look"] * f["gate"]).T @ de
            inner = de[:, None] * model.weigh
            dlook, dgate = inner * f["gate"] * (1 - f["look"] ** 2), inner * f["look"] * f["gate"] * (1 - f["gate"])
            grads["look"], grads["gate"] = f["h"].T @ dlook, f["h"].T @ dgate
            dh = (dh + dlook @ model.look.T + dgate @ model.gate.T) * (1 - f["h"] ** 2)
            grads["encode"], grads["encode_bias"] = f["x"].T @ dh, dh.sum(0)
            step += 1
            for n, g in grads.items():
                g = g + 1e-4 * getattr(model, n)
                first[n] = 0.9 * first[n] + 0.1 * g
                second[n] = 0.999 * second[n] + 0.001 * g * g
                change = rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                setattr(model, n, getattr(model, n) - change)
    return model


def quality_model(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", parts: int = 4, held: int = 2, sample: int = SAMPLE) -> Model:
    """Trained on at most ``sample`` documents of each label whose crc32(id) mod ``parts`` isn't ``held``, all passages of each. Without labelled rows the model scores 0.5 throughout.

    Of documents with one id the one of the fewest passages counts.
    """
    chosen = training_sample(labels, label_col, id_col, remainder(F.col(id_col).cast("long"), parts) != held, {0: sample, 1: sample})

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [passages(raw) for raw in batch.column(2).to_pylist()]
            arrays = [batch.column(0), batch.column(1), pa.array([len(x) for x in bags], pa.int64()), pa.array([x.tobytes() for x in bags], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "label", "size", "x"])

    texts = sampled_texts(df, chosen, id_col, text_col).withColumn("text", F.col("text").cast("binary"))
    each = texts.mapInArrow(encoded, "id long, label int, size long, x binary").groupBy("id", "label").agg(F.min(F.struct("size", "x")).alias("m"))
    bags = written(each.select("id", "label", "m.*"), "bags")  # a row an id, of at most 2 * sample ids
    before = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, -1)
    fits = bags.select("id", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before")).filter(F.col("before") < SAMPLE_PASSAGES // 2)
    rows = bags.join(F.broadcast(fits), "id").select("id", "label", "x").collect()  # bounded by both bounds of the sample
    rows = sorted(rows, key=lambda r: r["id"])
    if not rows:
        model = trained([np.zeros((1, FEATURES), np.float32)], np.array([0.5]), epochs=0)
        model.score = np.zeros_like(model.score)
        return model
    return trained([np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES) for r in rows], np.array([r["label"] for r in rows], float))


def with_quality(df: DataFrame, model: Model, text_col: str = "text", out: str = "quality_score") -> DataFrame:
    """df with a column of scores; one of that name is replaced. All other columns pass through, whatever their names.

    A null text scores as an empty one, repeated rows score alike, an empty table gives none, and a very long text is encoded a
    part at a time and scored whole.
    """
    at = df.columns.index(text_col)
    names = [f"c{k}" for k in range(len(df.columns))]  # no name of df can clash with the score
    fields = [T.StructField(n, f.dataType) for n, f in zip(names, df.schema.fields, strict=True)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.probabilities([(x or "").encode() for x in batch.column(at).to_pylist()]), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*names, "score"])

    rows = df.toDF(*names).mapInArrow(work, T.StructType([*fields, T.StructField("score", T.DoubleType())]))
    kept = [(n, c) for n, c in zip(names, df.columns, strict=True) if c != out]
    return rows.select(*[F.col(n).alias(c) for n, c in kept], F.col("score").alias(out))


def quality_scores(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, held_out, score (0 to 1) and predicted (1 from ``threshold`` on).

    Every text is scored whole, empty and null ones as empty; a null id is never held out and stays null; repeated rows score
    alike; ids or labels that are null, or labels without a document, train nothing; an empty table gives none; other columns
    are ignored.
    """
    model = quality_model(df, labels, id_col, text_col)
    rows = df.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    scored = with_quality(rows, model, out="score")
    held = F.coalesce(remainder(F.col(id_col), 4) == 2, F.lit(False))
    return scored.select(id_col, held.alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"))
