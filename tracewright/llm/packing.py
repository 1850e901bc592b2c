"""Best-fit packing by patterns: the histogram of piece lengths is packed, not the pieces.

Documents are cut into pieces of at most ``capacity`` tokens. Only the histogram of their lengths (at most ``capacity``
numbers, however large the corpus) comes to the driver. There, patterns of a few lengths that fill a sequence are fitted to
the histogram by non-negative least squares with an active set; repeats are rounded, what rounding leaves is fitted again, and
the rest, a small part, is packed by best fit by counts. The plan is a list of intervals of ranks within a length; each piece
finds its sequence and offset from its own rank. Ranks come from counts of (length, block) cells, so no length is gathered in
one task.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.llm.common import CACHES, written

CAPACITY = 2048
#: Words whose ids a worker remembers, and their letters; beyond either the memory is emptied, which changes no result.
MEMORY, LETTERS = 1_200_000, 32_000_000
#: Stands between words that are encoded together: a word of its own whose one id no text without it yields.
BETWEEN = "€"

#: str.split() also splits at these, the vocabulary doesn't; texts that hold any are split at ASCII white space alone.
_ODD, _PLAIN = re.compile("[\x1c-\x1f]"), re.compile(r"[^ \t\n\r\x0b\x0c]+")
#: Words of these letters and marks only have nothing to compose and one lower case each: the vocabulary's splitting pattern, a
#: fixed value, then reads as in _TOKEN.
_USUAL = re.compile(r"[\n!-~¡«»¿À-ÖØ-öø-ÿ‐-‧…]*")
_TOKEN = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
#: How the file's marks of special tokens begin; a word with it goes to the whole tokenizer.
_SPECIAL = "<|"
_words: dict[str, bytes] = {}
_tokens: dict[str, bytes] = {}
CACHES.extend((_words, _tokens))


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism here
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordIds:
    """Ids of texts, word by word. The vocabulary drops white space and never joins across it, so a text's ids are its words' ids in a row."""

    def __init__(self, path: str):
        self.path, self.tokenizer, self.letters = path, None, 0

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if self.tokenizer is None:
            self._load()
        known = _words
        if len(known) > MEMORY or self.letters > LETTERS:
            known.clear()
            _tokens.clear()
            self.letters = 0
        split = [_PLAIN.findall(x) if _ODD.search(x) else x.split() for x in texts]
        fresh = list(set().union(*split).difference(known)) if split else []
        if fresh:
            self.letters += sum(map(len, fresh))
            self._learn(fresh, known)
        return [b"".join(map(known.__getitem__, x)) for x in split]

    def _load(self) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = _tokenizer(self.path)
        (self.between,) = self.tokenizer.encode(BETWEEN, add_special_tokens=False).ids
        # for tokens that are split and lowered already: the same vocabulary, and the characters that stand for their bytes in it
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        usual = (c for c in map(chr, range(128, 0x2100)) if _USUAL.fullmatch(c))
        self.bytes = {ord(c): shown.pre_tokenize_str(c)[0][0] for c in usual}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True

    def _learn(self, fresh: list[str], known: dict[str, bytes]) -> None:
        """Adds ids of words: of usual ones by their tokens, each of which is encoded once, of others whole."""
        joined, rest = "\n".join(fresh), []
        if _SPECIAL in joined or not _USUAL.fullmatch(joined):
            usual = [w for w in fresh if _SPECIAL not in w and _USUAL.fullmatch(w)]
            rest = list(set(fresh).difference(usual))
            fresh, joined = usual, "\n".join(usual)
        if fresh:
            low = joined.lower()
            todo = list(set(_TOKEN.findall(low)).difference(_tokens))
            some = [todo[at : at + 100] for at in range(0, len(todo), 100)]
            for tokens, found in zip(some, self.bare.encode_batch_fast([" ".join(x).translate(self.bytes) for x in some], add_special_tokens=False), strict=True):
                ids = np.array(found.ids, "<u4")
                _cut(ids, tokens, np.flatnonzero(self.ends[ids]) + 1, 0, _tokens)
            whole, token, parts = _tokens.get, _tokens.__getitem__, _TOKEN.findall
            known.update((w, whole(x) or b"".join(map(token, parts(x)))) for w, x in zip(fresh, low.split("\n"), strict=True))
        for word in [w for w in rest if BETWEEN in w]:
            known[word] = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        rest = [w for w in rest if BETWEEN not in w]
        some = [rest[at : at + 100] for at in range(0, len(rest), 100)]
        for words, found in zip(some, self.tokenizer.encode_batch_fast([f" {BETWEEN} ".join([*x, ""]) for x in some], add_special_tokens=False), strict=True):
            ids = np.array(found.ids, "<u4")
            _cut(ids, words, np.flatnonzero(ids == self.between), 1, known)


def _cut(ids: np.ndarray, words: list[str], ends: np.ndarray, gap: int, into: dict[str, bytes]) -> None:
    """Puts the ids of words that were encoded together under each word; ``gap`` ids stand between two words."""
    raw, begins = ids.tobytes(), [0, *(4 * (ends[:-1] + gap)).tolist()]
    into.update(zip(words, [raw[a:b] for a, b in zip(begins, (4 * ends).tolist(), strict=True)], strict=True))


def pieces(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """(id, piece, start, length, ids_crc32): each document's ids and the end id, cut every ``capacity`` ids. A null text is empty: one piece, the end id."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, tail, step = WordIds(tokenizer_path), np.array([end], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                out = []
                for key, ids in zip(some.column(0).to_pylist(), ids_of([x or "" for x in some.column(1).to_pylist()]), strict=True):
                    ids += tail
                    for k, start in enumerate(range(0, len(ids), step)):
                        part = ids[start : start + step]
                        out.append((key, k, start // 4, len(part) // 4, zlib.crc32(part)))
                columns = list(zip(*out, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [id_col, "piece", "start", "length", "ids_crc32"])

    rows = df.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, f"`{id_col}` long, piece int, start long, length long, ids_crc32 long")


def patterns(counts: np.ndarray, capacity: int, spare: int, per_length: int = 24) -> list[tuple[int, ...]]:
    """Patterns of few lengths that occur, whose sum is ``capacity`` or at most ``spare`` less.

    For each largest length partners are spread over what room is left, and the commonest lengths are among them; one, two or
    three lengths fill the rest, or one length as often as it fits and another one.
    """
    there = np.flatnonzero(counts[: capacity + 1])
    there = there[there > 0]
    if not len(there):
        return []
    fit = np.zeros(capacity + 1, np.int64)  # the largest length that occurs and has room
    fit[there] = there
    fit = np.maximum.accumulate(fit)
    most = np.minimum(there, capacity - there)
    often = there[np.argsort(-counts[there], kind="stable")[: per_length // 2]]
    spread = fit[(most[:, None] * np.linspace(0, 1, per_length // 2 + 1)).astype(np.int64)]
    second = np.concatenate([spread, np.where(often <= most[:, None], often, 0)], axis=1)
    first = np.repeat(there, second.shape[1])
    second = second.ravel()
    left = capacity - first - second
    rows = [np.stack([first, second, 0 * first, 0 * first], 1)]
    third = fit[np.minimum(left, second)]
    rows.append(np.stack([first, second, third, 0 * first], 1))
    for part in (0.25, 0.35, 0.5):
        third = fit[np.minimum((left * part).astype(np.int64), second)]
        rows.append(np.stack([first, second, third, fit[np.minimum(left - third, second)]], 1))
    every = np.concatenate([np.stack([there, 0 * there, 0 * there, 0 * there], 1), *rows])
    every = np.unique(-np.sort(-every, axis=1), axis=0)
    sums = every.sum(1)
    found = {tuple(x for x in p if x) for p in every[(sums <= capacity) & (sums >= capacity - spare)].tolist()}
    for large in there.tolist():
        for small in {int(fit[min(large, (capacity - large) // k)]) for k in (1, 2, 3, 5, 8, 13, 21, 55)} | {large}:
            times = (capacity - large) // small if small else 0
            rest = int(fit[capacity - large - times * small])
            for p in ((large, *[small] * times, rest), (large, *[small] * max(times - 1, 0), int(fit[capacity - large - max(times - 1, 0) * small]))):
                if capacity - spare <= sum(p) <= capacity:
                    found.add(tuple(sorted((x for x in p if x), reverse=True)))
    return sorted(found, reverse=True)


def fitted(counts: np.ndarray, made: list[tuple[int, ...]], rounds: int = 80, close: float = 0.001) -> np.ndarray:
    """Non-negative repeats of the patterns whose lengths come nearest to counts, by least squares with an active set.

    Patterns that lessen the squares most join the set, the least squares over the set are found by conjugate gradients, and
    what would be negative leaves it. It ends when no pattern outside the set would lessen the rest by a share ``close``, as the
    optimality conditions have it, or when a step gains less than that. The set has no more patterns than there are lengths, so
    repeats are few and large.
    """
    owner = np.repeat(np.arange(len(made)), [len(p) for p in made])
    length = np.concatenate([np.array(p) for p in made])
    pair, times = np.unique(owner.astype(np.int64) * len(counts) + length, return_counts=True)
    owner, length, times = pair // len(counts), pair % len(counts), times.astype(float)
    norm = np.sqrt(np.bincount(owner, times**2, len(made)))
    begins = np.searchsorted(owner, np.arange(len(made) + 1))
    wanted, most = counts.astype(float), int((counts > 0).sum())
    columns, x = np.zeros(0, np.int64), np.zeros(0)

    def least(columns: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(repeats, rest) of the least squares over some patterns, from x on."""
        sizes = begins[columns + 1] - begins[columns]
        o = np.repeat(np.arange(len(columns)), sizes)
        at = np.repeat(begins[columns] - np.cumsum(sizes) + sizes, sizes) + np.arange(len(o))
        le, t = length[at], times[at]
        r = wanted - np.bincount(le, t * x[o], len(counts))
        g = np.bincount(o, t * r[le], len(columns))
        d, gg = g, float((g * g).sum())
        goal = gg * 1e-6
        for _ in range(100):
            if gg <= goal:
                break
            q = np.bincount(le, t * d[o], len(counts))
            step = gg / max(float((q * q).sum()), 1e-300)
            x, r = x + step * d, r - step * q
            g = np.bincount(o, t * r[le], len(columns))
            gg, before = float((g * g).sum()), gg
            d = g + gg / before * d
        return x, r

    rest = wanted
    for _ in range(rounds):
        error = float((rest * rest).sum())
        gain = np.bincount(owner, times * rest[length], len(made)) / norm
        gain[columns] = 0.0
        room = min(most - len(columns), max(most // 16, 1))
        joining = np.argpartition(-gain, room - 1)[:room] if 0 < room < len(gain) else np.arange(len(gain) if room > 0 else 0)
        joining = joining[gain[joining] > close * np.sqrt(error)]
        if not len(joining) or error < 1e-6:
            break
        columns, x = np.r_[columns, joining], np.r_[x, np.zeros(len(joining))]
        for _ in range(30):
            x, rest = least(columns, x)
            kept = x > 1e-6
            if kept.all():
                break
            columns, x = columns[kept], x[kept]
            if not len(columns):
                break
        rest = wanted - np.bincount(length, times * _spread(columns, np.maximum(x, 0.0), len(made))[owner], len(counts))
        if float((rest * rest).sum()) > (1 - close) * error:
            break
    return _spread(columns, np.maximum(x, 0.0), len(made))


def _spread(columns: np.ndarray, x: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size)
    out[columns] = x
    return out


#: How much patterns may leave free, in turn, as parts of the capacity: what fills a sequence to the last token comes first.
SPARES = (0, 256, 64)


def fitted_plans(counts: np.ndarray, capacity: int = CAPACITY) -> Iterator[tuple[list[tuple[tuple[int, ...], int]], np.ndarray]]:
    """((pattern, repeats) of the fits, rounded; what they leave of counts), after each fit. What rounding leaves is fitted again, as long as that takes anything."""
    left = counts.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []
    _take(left, out, (capacity,), int(left[capacity]))  # what fills a sequence alone needs no fit
    yield list(out), left.copy()
    for spare in SPARES:
        while left[1:].any():
            made = patterns(left, capacity, capacity // spare if spare else 0)
            before = left.sum()
            if made:
                repeats = fitted(left, made)
                chosen = np.flatnonzero(repeats > 0.25)
                for k in chosen[np.argsort(-repeats[chosen], kind="stable")]:
                    _take(left, out, made[k], int(repeats[k] + 0.5) or 1)
            yield list(out), left.copy()
            if before - left.sum() <= before // 50:
                break


def fitted_plan(counts: np.ndarray, capacity: int = CAPACITY) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """What all fits take, and what they leave."""
    return list(fitted_plans(counts, capacity))[-1]


def _take(left: np.ndarray, out: list, pattern: tuple[int, ...], most: int) -> None:
    """Puts a pattern into a plan, ``most`` times or as often as what is left allows."""
    used, often = np.unique(np.array(pattern), return_counts=True)
    n = int(min(most, (left[used] // often).min()))
    if n > 0:
        left[used] -= often * n
        out.append((pattern, n))


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) that together use each length exactly counts[length] times. Its size depends on the number of lengths, not of pieces.

    What the fits leave is packed by best fit. Of few pieces a late fit, or any, may take what best fit needs, so each
    number of fits is completed, and of those with the fewest sequences the one with most fits counts.
    """
    best, fewest = [], None
    for out, left in fitted_plans(counts, capacity):
        out += _best_fit(left, capacity)
        sequences = sum(n for _, n in out)
        if fewest is None or sequences <= fewest:
            best, fewest = out, sequences
    return best


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """The largest length, then again and again the largest that still fits; all such sequences at once, so each step uses a length up."""
    out: list[tuple[tuple[int, ...], int]] = []
    while (there := np.flatnonzero(left)).size and there[-1] > 0:
        pattern, spare = [int(there[-1])], left.copy()
        spare[there[-1]] -= 1
        room = capacity - pattern[0]
        while room > 0:
            options = np.flatnonzero(spare[: room + 1])
            if not options.size or options[-1] == 0:
                break
            pattern.append(int(options[-1]))
            spare[options[-1]] -= 1
            room -= pattern[-1]
        _take(left, out, tuple(pattern), int(left.max()))
    return out


def slots(packed: list[tuple[tuple[int, ...], int]], capacity: int) -> dict[str, np.ndarray]:
    """The plan as intervals of a single number line: length * 2**40 + rank. first: the interval's start, sequence: of its first rank, offset: of the piece in it."""
    used = np.zeros(capacity + 1, np.int64)
    first, sequence, offset, base = [], [], [], 0
    for pattern, n in packed:
        at = 0
        for length in pattern:
            first.append(length * 2**40 + used[length])
            sequence.append(base)
            offset.append(at)
            used[length] += n
            at += length
        base += n
    order = np.argsort(first)
    return {k: np.array(v, np.int64)[order] for k, v in (("first", first), ("sequence", sequence), ("offset", offset))}


def histogram(cut: DataFrame, capacity: int) -> np.ndarray:
    """How many pieces there are of each length: the one thing that comes to the driver, at most ``capacity`` numbers."""
    counts = np.zeros(capacity + 1, np.int64)
    for row in cut.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    return counts


def ranked(cut: DataFrame, id_col: str, counts: np.ndarray, block_rows: int = 1_000) -> DataFrame:
    """cut with ``rank``, from 0, within each length.

    A length is split by hash into as many blocks as it needs; cells (length, block) are counted, and only a cell is ever
    sorted in one task.
    """
    blocks = F.get(F.from_json(F.lit(json.dumps((-(-counts // block_rows)).tolist())), "array<bigint>"), F.col("length").cast("int"))
    cells = cut.withColumn("block", F.pmod(F.xxhash64(F.col(id_col), F.col("piece"), F.col("ids_crc32")), F.greatest(blocks, F.lit(1))))
    sizes = cells.groupBy("length", "block").agg(F.count(F.lit(1)).alias("in_cell"))
    before = sizes.select("length", "block", (F.sum("in_cell").over(Window.partitionBy("length").orderBy("block")) - F.col("in_cell")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "block").orderBy(F.col(id_col), "piece", "ids_crc32")) - 1
    return cells.withColumn("inside", inside).join(before, ["length", "block"]).withColumn("rank", F.col("before") + F.col("inside"))


def pack(cut: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """cut (id, piece, start, length, ids_crc32) with sequence_id and offset.

    Each sequence holds at most ``capacity`` ids without gaps. Ties (equal lengths, repeated rows) are dealt by rank and
    each row gets a place of its own; an empty table gives none.
    """
    counts = histogram(cut, capacity)
    table = slots(plan(counts, capacity), capacity)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("length").to_numpy() * 2**40 + batch.column("rank").to_numpy()
            k = np.searchsorted(table["first"], at, "right") - 1
            names = [id_col, "piece", "start", "length", "ids_crc32"]
            arrays = [batch.column(n) for n in names] + [pa.array(table["sequence"][k] + at - table["first"][k]), pa.array(table["offset"][k])]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "sequence_id", "offset"])

    rows = ranked(cut, id_col, counts).select(id_col, "piece", "start", "length", "ids_crc32", F.col("rank").cast("long").alias("rank"))
    return rows.mapInArrow(place, f"`{id_col}` long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def packed_documents(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their places. The pieces are written once, so that texts are tokenised once.

    Null texts are empty; null ids, ties and repeated rows are rows like any other; very long texts are cut into pieces; an empty
    table gives none; other columns are ignored.
    """
    return pack(written(pieces(df, tokenizer_path, id_col, text_col, capacity), "pieces"), id_col, capacity)
