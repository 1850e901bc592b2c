"""Language identification by prediction by partial matching over bytes.

For each language a tree of contexts of up to ORDER bytes counts which byte follows. A byte's code length is taken in the
longest context that the tree has; where the byte never followed there, an escape (with the probability of the number of
different bytes that did, method C) leads to the context that is a byte shorter, in which the bytes of the longer one are
excluded, and at last to the bytes that the language never had, which are equally likely. The counts are frozen after training,
so a text's code length in a language is a sum of lengths of (context, byte) grams; it is exact in units of 1/UNIT bits. The
language of the shortest code is the prediction.

The trees are grown on a bounded sample of pieces of labelled texts. Grams are counted by Spark; the shorter contexts' counts
are sums of the longest ones'.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.llm.common import dropped, text_or_empty, written
from tracewright.llm.labels import remainder

#: Bytes of the longest context; a gram (context and byte) has one more and fits into a long.
ORDER = 4
#: What stands before a text, so that every byte has a whole context.
BEFORE = b"\n" * ORDER
#: The sample: pieces of PIECE bytes, at most PIECES of a language and ALL_PIECES of all; of the LANGUAGES with the most pieces.
PIECE, PIECES, ALL_PIECES, LANGUAGES = 4096, 256, 4096, 64
UNIT = 65_536
#: Bytes that are scored at once, and grams whose code lengths are kept (times languages).
BLOCK, KEPT = 2_000_000, 16_000_000
UNKNOWN = "und"


def grams(raw: np.ndarray) -> np.ndarray:
    """The gram that ends at each byte from the ORDER-th (from 0) on, as a number, last byte lowest."""
    out = np.zeros(max(0, len(raw) - ORDER), np.int64)
    for k in range(ORDER + 1):
        out = (out << 8) | raw[k : k + len(out)]
    return out


class Tree:
    """Frozen context tree of one language, from its grams and their counts."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.grams, self.contexts = [], []
        for k in range(ORDER + 1):  # contexts of k bytes
            known, at = np.unique(codes & (256 ** (k + 1) - 1), return_inverse=True)
            n = np.bincount(at, counts, len(known)).astype(np.int64)
            context, at = np.unique(known >> 8, return_inverse=True)
            total, kinds = np.bincount(at, n, len(context)).astype(np.int64), np.bincount(at, minlength=len(context))
            self.grams.append((known, n))
            # besides: total and kinds of the next shorter context without the bytes that followed this one
            below = (np.zeros_like(total), np.zeros_like(kinds))
            if k:
                shorter, shorter_n = self.grams[k - 1]
                seen = shorter_n[np.searchsorted(shorter, known & (256**k - 1))]
                up = np.searchsorted(self.contexts[k - 1][0], context & (256 ** (k - 1) - 1))
                below = (self.contexts[k - 1][1][up] - np.bincount(at, seen, len(context)).astype(np.int64), self.contexts[k - 1][2][up] - kinds)
            self.contexts.append((context, total, kinds, *below))

    def lengths(self, codes: np.ndarray) -> np.ndarray:
        """Code length of each gram's last byte after the others, in 1/UNIT bits."""
        n = len(codes)
        out, begun, open_ = np.zeros(n), np.zeros(n, bool), np.ones(n, bool)
        total, kinds = np.zeros(n), np.zeros(n)
        for k in range(ORDER, -1, -1):
            known, counts = self.grams[k]
            contexts, own_total, own_kinds, below_total, below_kinds = self.contexts[k]
            context = (codes >> 8) & (256**k - 1)
            at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            here = open_ & (contexts[at] == context)
            fresh = here & ~begun
            total[fresh], kinds[fresh] = own_total[at[fresh]], own_kinds[at[fresh]]
            begun |= here
            gram = codes & (256 ** (k + 1) - 1)
            g = np.minimum(np.searchsorted(known, gram), len(known) - 1)
            hit = here & (known[g] == gram)
            out[hit] += np.log2((total[hit] + kinds[hit]) / counts[g[hit]])
            open_ &= ~hit
            escape = here & ~hit & (kinds > 0)
            out[escape] += np.log2((total[escape] + kinds[escape]) / kinds[escape])
            left = here & ~hit
            total[left], kinds[left] = below_total[at[left]], below_kinds[at[left]]
        never = 256 - len(self.grams[0][0])
        out[open_] += math.log2(max(never, 1))
        return np.round(out * UNIT).astype(np.int64)


class Trees:
    """The trees of all languages, in the order of their names."""

    def __init__(self, names: list[str], codes: list[np.ndarray], counts: list[np.ndarray]) -> None:
        self.names, self.trees = names, [Tree(c, n) for c, n in zip(codes, counts, strict=True)]
        # code lengths of the most frequent grams are looked up, of others made when they come
        known, at = np.unique(np.concatenate([np.zeros(0, np.int64), *codes]), return_inverse=True)
        if len(names) and len(known) * len(names) > KEPT:
            often = np.bincount(at, np.concatenate(counts), len(known))
            known = np.sort(known[np.argsort(-often, kind="stable")[: KEPT // len(names)]])
        self.known = known
        self.kept = self._made(known)

    def _made(self, codes: np.ndarray) -> np.ndarray:
        return np.stack([t.lengths(codes) for t in self.trees], 1) if self.trees else np.zeros((len(codes), 0), np.int64)

    def lengths(self, codes: np.ndarray) -> np.ndarray:
        """(grams, languages)."""
        if not len(self.known):
            return self._made(codes)
        at = np.minimum(np.searchsorted(self.known, codes), len(self.known) - 1)
        out = self.kept[at]
        new = np.flatnonzero(self.known[at] != codes)
        if len(new):
            out[new] = self._made(codes[new])
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages) in 1/UNIT bits: exact sums, so equal texts have equal ones. Blocks of BLOCK bytes, whatever the texts' lengths."""
        out = np.zeros((len(texts), len(self.names)), np.int64)
        block, owners, held = [], [], 0

        def flush() -> None:
            nonlocal block, owners, held
            if held:
                joined = np.frombuffer(b"".join(block), np.uint8)
                sizes = np.array([len(x) - ORDER for x in block])
                inner = np.ones(len(joined) - ORDER, bool)  # grams that don't reach over two texts
                ends = np.cumsum([len(x) for x in block])[:-1]
                inner[(ends[:, None] + np.arange(-ORDER, 0)).ravel()] = False
                at, distinct = pd.factorize(grams(joined)[inner])
                each = self.lengths(distinct)
                starts = np.cumsum(sizes) - sizes
                for j in range(len(self.names)):
                    np.add.at(out[:, j], owners, np.add.reduceat(each[at, j], starts))
            block, owners, held = [], [], 0

        for k, raw in enumerate(texts):
            whole = BEFORE + raw
            for a in range(0, len(raw), BLOCK):
                part = whole[a : a + BLOCK + ORDER]
                if held + len(part) > BLOCK + ORDER:
                    flush()
                block.append(part)
                owners.append(k)
                held += len(part)
        flush()
        return out


def _pieces(df: DataFrame, id_col: str, text_col: str, lang_col: str, parts: int, held: int) -> tuple[DataFrame, list[str]]:
    """(lang, piece) of the sample and its languages. Equal pieces at one place count once, so copies don't crowd it."""
    usable = (remainder(F.col(id_col).cast("long"), parts) != held) & F.col(lang_col).isNotNull()
    rows = df.filter(usable).select(F.col(lang_col).cast("string").alias("lang"), text_or_empty(text_col).cast("binary").alias("raw"))
    rows = rows.withColumn("n", F.ceil(F.octet_length("raw") / PIECE)).filter("n > 0")
    sizes = rows.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()  # at most LANGUAGES rows
    if not sizes:
        return df.sparkSession.createDataFrame([], "lang string, piece binary"), []
    most = max(1, min(PIECES, ALL_PIECES // len(sizes)))
    # a draw is a number from 0 to 2**32 for a piece; where a language has many, only those that can be among the least are cut out
    bounds = {r["lang"]: int(min(1.0, (2 * most + 64) / r["n"]) * 2**32) for r in sizes}
    bound = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair])[F.col("lang")]
    draw = lambda k: F.xxhash64("hash", k).bitwiseAND(F.lit(2**32 - 1))
    rows = rows.withColumn("hash", F.xxhash64("raw")).withColumn("bound", bound).filter("bound IS NOT NULL")
    chosen = F.filter(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda k: draw(k) < F.col("bound"))
    # with the bytes before it, a piece's context is whole; at the beginning of a text BEFORE stands there
    start = lambda k: (k * PIECE + 1 - ORDER).cast("int")
    cut = lambda k: F.when(k == 0, F.concat(F.lit(BEFORE), F.substring("raw", F.lit(1), F.lit(PIECE)))).otherwise(F.substring("raw", start(k), F.lit(PIECE + ORDER)))
    found = rows.select("lang", F.explode(F.transform(chosen, lambda k: F.struct(draw(k).alias("draw"), cut(k).alias("piece")))).alias("p")).select("lang", "p.*").distinct()
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "piece"))).filter(F.col("rank") <= most)
    return ranked.select("lang", "piece"), sorted(bounds)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        for lang in dict.fromkeys(langs):
            each = [grams(np.frombuffer(x, np.uint8)) for x in batch.column(1).filter(pa.array(langs == lang)).to_pylist()]
            codes, n = np.unique(np.concatenate(each), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n, pa.int64())], ["lang", "gram", "n"])


def language_trees(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", parts: int = 4, held: int = 2) -> Trees:
    """Trees of the languages of rows whose crc32(id) mod ``parts`` isn't ``held``; a null id, language or text teaches nothing."""
    pieces, names = _pieces(df, id_col, text_col, lang_col, parts, held)
    counts = pieces.mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = written(counts, "grams")
    rows = counts.toArrow().to_pandas()  # at most ALL_PIECES * PIECE rows, a few bytes each
    dropped(counts)
    names = [x for x in names if x in set(rows["lang"])]
    each = [rows[rows["lang"] == x] for x in names]
    return Trees(names, [x["gram"].to_numpy() for x in each], [x["n"].to_numpy() for x in each])


def languages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", trees: Trees | None = None) -> DataFrame:
    """Per row: id, held_out, lang_pred and score, the probability of that language if all are equally likely beforehand.

    Texts are scored whole, in blocks, however long they are. ``und`` with score 0 is the prediction where a text is null or has no
    letter, and everywhere if no language is known; ties go to the first language by code point. A null id is never held out and
    stays null; repeated rows are predicted alike; an empty table gives none; other columns are ignored.
    """
    trees = trees or language_trees(df, id_col, text_col, lang_col)
    text = F.col(text_col).cast("string")
    lettered = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.when(lettered, text.cast("binary")).alias("raw"))
    sent = df.sparkSession.sparkContext.broadcast(trees)  # at most KEPT lengths and four numbers a gram and order

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        names = np.array([*known.names, UNKNOWN], object)
        for batch in batches:
            raw = batch.column(1).to_pylist()
            lengths = known.code_lengths([x or b"" for x in raw])
            best, score = np.full(len(raw), len(names) - 1), np.zeros(len(raw))
            if len(names) > 1:
                some = np.array([x is not None for x in raw], bool)
                best[some] = lengths[some].argmin(1)
                odds = np.exp2(-np.minimum((lengths - lengths.min(1, keepdims=True)) / UNIT, 1000.0))
                score[some] = (1 / odds.sum(1))[some]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names[best], pa.string()), pa.array(score, pa.float64())], ["id", "lang_pred", "score"])

    out = rows.mapInArrow(work, "id long, lang_pred string, score double")
    held = F.coalesce(remainder(F.col("id"), 4) == 2, F.lit(False))
    return out.select(F.col("id").alias(id_col), held.alias("held_out"), "lang_pred", "score")
