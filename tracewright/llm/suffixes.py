"""Suffix-array deduplication of bytes.

A shard's texts are joined and their suffixes sorted by induction: suffixes are classified as smaller (S) or larger (L)
than the next; leftmost-S substrings are sorted by inducing L from S and S from L bucket by bucket, then named; where
names repeat, the reduced string of names, at most half as long, is sorted by the same function if it is short, else by
doubling: ranks of prefixes of 2, 4, 8 symbols and so on, whole arrays at a time (an induction over many names goes one position
at a time, in Python); a last induction gives the shard's array. The cost is linear in the text, but for the logarithm of the
longest repeat in the doubling. Prefixes that neighbours share are compared where the symbols before them differ; elsewhere,
in text order (permuted), each follows from the one before it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.llm.common import id_key, shown_id, text_or_empty
from tracewright.llm.windows import applied, bytes_kind, covered, intervals, keyed, repeated_windows, runs_of

LENGTH = 400


def classified(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one. text ends with its only least symbol."""
    n = len(text)
    step = np.sign(text[1:].astype(np.int64) - text[:-1].astype(np.int64))
    # within a run of equal symbols the first step after it decides
    decides = np.where(step != 0, np.arange(n - 1), n - 1)
    decides = np.minimum.accumulate(decides[::-1])[::-1]
    smaller = np.ones(n, bool)
    smaller[:-1] = np.r_[step, -1][decides] > 0
    return smaller


class _Buckets:
    def __init__(self, symbols: int):
        self.parts: list[list[np.ndarray]] = [[] for _ in range(symbols)]

    def add(self, at: np.ndarray, symbols: np.ndarray) -> None:
        """Appends positions to their symbols' buckets, in the order given."""
        if not len(at):
            return
        order = np.argsort(symbols, kind="stable")
        at, symbols = at[order], symbols[order]
        cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True):
            self.parts[symbols[a]].append(at[a:b])

    def take(self, symbol: int) -> np.ndarray:
        parts = self.parts[symbol]
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.int32)


def induced(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, symbols: int) -> np.ndarray:
    """All positions in the order that the order of the seeds (leftmost-S positions) induces."""
    start, large, small = _Buckets(symbols), _Buckets(symbols), _Buckets(symbols)
    start.add(seeds, text[seeds])
    done: list[np.ndarray] = [np.zeros(0, np.int32)] * symbols

    def push(into: _Buckets, scanned: np.ndarray, want_small: bool, symbol: int) -> np.ndarray:
        before = scanned[scanned > 0] - 1
        before = before[smaller[before] == want_small]
        at = text[before]
        same = at == symbol
        into.add(before[~same], at[~same])
        return before[same]

    for c in range(symbols):
        now, rounds = large.take(c), []
        while len(now):
            rounds.append(now)
            now = push(large, now, False, c)
        done[c] = np.concatenate(rounds) if rounds else done[c]
        push(large, start.take(c), False, c)
    out: list[np.ndarray] = []
    for c in range(symbols - 1, -1, -1):
        now, rounds = small.take(c), []
        while len(now):
            rounds.append(now)
            now = push(small, now, True, c)
        push(small, done[c][::-1], True, c)
        out += [*[r[::-1] for r in rounds], done[c]]
    # the least symbol stands only at the end and nothing induces it
    return np.concatenate([np.array([len(text) - 1], np.int32), *_upwards(out)])


def _upwards(parts: list[np.ndarray]) -> list[np.ndarray]:
    """Buckets were listed from the last to the first, the small part of each in rounds from its end, then its large part."""
    return [p for p in reversed(parts) if len(p)]


def _named(text: np.ndarray, ordered: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, int]:
    """Names by position order for leftmost-S substrings in sorted order; ends: where each one's substring ends, by position."""
    a, b = ordered[:-1], ordered[1:]
    size_a, size_b = ends[a] - a, ends[b] - b
    differ = size_a != size_b
    alive = np.flatnonzero(~differ)
    k = 0
    while len(alive):
        no = text[a[alive] + k] != text[b[alive] + k]
        differ[alive[no]] = True
        alive = alive[~no]
        k += 1
        alive = alive[size_a[alive] >= k]
    names = np.r_[0, np.cumsum(differ)]
    return names, int(names[-1]) + 1


def induced_singly(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, symbols: int) -> np.ndarray:
    """As ``induced``, one position at a time: for strings of names, which have many symbols and few places of each."""
    sizes = np.bincount(text, minlength=symbols)
    front, back = (np.cumsum(sizes) - sizes).tolist(), np.cumsum(sizes).tolist()
    at, is_small, out = text.tolist(), smaller.tolist(), [-1] * len(text)
    ends = list(back)
    for p in reversed(seeds.tolist()):
        ends[at[p]] -= 1
        out[ends[at[p]]] = p
    for k in range(len(out)):
        p = out[k] - 1
        if p >= 0 and not is_small[p]:
            out[front[at[p]]] = p
            front[at[p]] += 1
    for k in range(len(out) - 1, -1, -1):
        p = out[k] - 1
        if p >= 0 and is_small[p]:
            back[at[p]] -= 1
            out[back[at[p]]] = p
    out[0] = len(text) - 1  # the least symbol stands only at the end and nothing induces it
    return np.array(out, np.int32)


#: Names from which on a reduced string is sorted by doubling.
LONG = 1 << 12


def doubled(text: np.ndarray, symbols: int) -> np.ndarray:
    """As ``suffix_order``, by ranks of ever longer prefixes; a rank is the first place of all suffixes that share the prefix."""
    n, bits = len(text), max(1, (symbols - 1).bit_length())
    size = min(n, 62 // bits)  # symbols that one number holds
    key = np.zeros(n, np.int64)
    for k in range(size):
        key <<= bits
        key[: n - k] |= text[k:]
    order, rank, left, at = np.arange(n), np.zeros(n, np.int64), np.arange(n), np.arange(n)
    while True:
        # left: the places that are not settled, at: the suffixes there, key: what sorts them, those of a rank side by side
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[left] = at
        new = np.r_[True, key[1:] != key[:-1]]
        rank[at] = left[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        left = left[~(new & np.r_[new[1:], True])]
        if not len(left):
            return order.astype(np.int32)
        at = order[left]
        key = rank[at] << 32 | rank[at + size]  # equal prefixes don't hold the end, so there is a suffix behind them
        size *= 2


def suffix_order(text: np.ndarray, symbols: int) -> np.ndarray:
    """Start positions of text's suffixes in order. text has symbols 0..symbols - 1 and ends with its only 0."""
    place = induced if symbols * 64 < len(text) else induced_singly
    smaller = classified(text)
    leftmost = (np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1).astype(np.int32)
    if not len(leftmost):  # the end alone, or nothing but it after ever smaller symbols
        leftmost = np.array([len(text) - 1], np.int32)
    rough = place(text, smaller, leftmost, symbols)
    is_leftmost = np.zeros(len(text), bool)
    is_leftmost[leftmost] = True
    ordered = rough[is_leftmost[rough]]
    ends = np.zeros(len(text), np.int32)
    ends[leftmost] = np.r_[leftmost[1:], leftmost[-1:]]
    names, kinds = _named(text, ordered, ends)
    if kinds < len(leftmost):
        index = np.empty(len(text), np.int32)
        index[leftmost] = np.arange(len(leftmost))
        reduced = np.empty(len(leftmost), np.int32)
        reduced[index[ordered]] = names
        ordered = leftmost[(doubled if len(reduced) >= LONG else suffix_order)(reduced, kinds)]
    return place(text, smaller, ordered, symbols)


def suffix_array(raw: np.ndarray) -> np.ndarray:
    """Start positions of raw's suffixes (uint8) in order."""
    return suffix_order(np.r_[raw.astype(np.int16) + 1, np.int16(0)], 257)[1:]


def permuted_prefixes(raw: np.ndarray, order: np.ndarray, most: int, block: int = 256) -> np.ndarray:
    """For each position in text order the length, up to ``most``, of the prefix that its suffix shares with the one before it in ``order``.

    Where equal symbols stand before both suffixes, the prefix is that of the position before, less one. The others are compared,
    and one a block, so that no comparison needs more than ``most + block`` symbols.
    """
    n, far = len(raw), most + block
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.r_[raw, np.zeros(far + 16, np.uint8)]
    eight = np.ndarray((n + far + 8,), "<u8", padded.data, 0, (1,))  # the eight symbols from each place on
    compared = before <= 0
    compared[1:] |= raw[:-1] != raw[before[1:] - 1]
    compared[::block] = True
    p = np.flatnonzero(compared)
    q = before[p]
    limit = np.where(q < 0, 0, np.minimum(n - np.maximum(p, q), far))
    length = np.zeros(len(p), np.int64)
    grow = np.flatnonzero(limit)
    a, b = p[grow], q[grow]
    while len(grow):  # eight symbols at a time, then the exact number by the lowest bit that differs
        x = eight[a] ^ eight[b]
        ended = np.flatnonzero(x)
        low = x[ended] & (~x[ended] + np.uint64(1))
        length[grow[ended]] += (low.astype(np.float64).view(np.int64) >> 52) - 1023 >> 3
        alike = np.flatnonzero(x == 0)
        grow, a, b = grow[alike], a[alike] + 8, b[alike] + 8
        length[grow] += 8
        short = np.flatnonzero(length[grow] < limit[grow])
        grow, a, b = grow[short], a[short], b[short]
    length = np.minimum(length, limit)
    since = np.cumsum(compared) - 1
    return np.clip(length[since] - (np.arange(n) - p[since]), 0, most).astype(np.int32)


def repeats_in_shard(length: int, spare_first: bool = False):
    def resolve(texts: list[np.ndarray], copies: np.ndarray, groups: np.ndarray) -> list[list[int]]:
        """Runs of each text's window starts whose window is also in another text, or in another copy of this one; with spare_first, in an earlier text."""
        sizes = np.array([len(t) for t in texts])
        raw = np.concatenate(texts)
        order = suffix_array(raw)
        shared = permuted_prefixes(raw, order, length)
        first = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(texts)), sizes)
        inside = first[owner] + sizes[owner] - np.arange(len(raw)) >= length
        begins = np.flatnonzero(np.r_[True, shared[order[1:]] < length])
        repeated = np.zeros(len(raw), bool)
        if spare_first:
            earliest = np.minimum.reduceat(np.where(inside[order], order, len(raw)), begins)
            repeated[order] = np.repeat(earliest, np.diff(np.r_[begins, len(raw)])) < order
        else:
            total = np.add.reduceat(np.where(inside, copies[owner], 0)[order], begins)
            repeated[order] = np.repeat(total, np.diff(np.r_[begins, len(raw)])) > 1
        repeated &= inside
        return [runs_of(repeated[a : a + s - length + 1]) for a, s in zip(first.tolist(), sizes.tolist(), strict=True)]

    return resolve


def repeated_bytes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, spare_first: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents by key, their repeats) for strings of ``length`` bytes that start in two or more places; with spare_first, that start earlier."""
    docs = keyed(df, id_col, text_col)
    found = repeated_windows(docs, bytes_kind(length, length // 4), repeats_in_shard(length, spare_first), spare_first)
    return docs, found


def without_repeated_bytes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep_text: bool = False) -> DataFrame:
    """Removes each byte that a string of ``length`` bytes covers which also starts anywhere else in the table.

    Per row: id, n_bytes, n_removed, n_spans, kept_sha256 and, with keep_text, ``kept`` (the remaining bytes, binary). Texts
    are UTF-8 bytes, matches never cross documents, overlaps count, and all strings are judged on the input. A null text is
    empty, a null id stays null, repeated rows are documents of their own (so they remove each other), texts shorter than
    ``length`` stay whole, an empty table gives none; very long texts are searched whole, their places being one row each;
    other columns are ignored.
    """
    docs, found = repeated_bytes(df, id_col, text_col, length)

    def work(dk: int, raw: bytes, repeats: tuple | None) -> tuple:
        gone = covered(len(raw), repeats, length)
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes() if repeats else raw
        spans = int((np.diff(np.r_[0, gone.astype(np.int8)]) == 1).sum())
        row = (dk, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest())
        return (*row, kept) if keep_text else row

    schema = "dk long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text
    rows = applied(docs, found, work, schema)
    return rows.select(shown_id(F.col("dk")).alias(id_col), *[c for c in rows.columns if c != "dk"])


def texts_without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, spare_first: bool = False) -> DataFrame:
    """df with its texts freed of each byte that a string of ``length`` bytes covers which also starts anywhere else in the table; all rows and columns stay.

    With spare_first, which also starts earlier: in a document of lesser id (a null id comes first; of equal ids the texts go by
    a hash), or earlier in the same one; so one copy of each string stays, and rows of equal id and text count as one document.
    Strings are judged on the input. Bytes of a character that was cut in two are dropped, so that the text is valid UTF-8
    again. A null text becomes an empty one, repeated rows get equal texts, texts shorter than ``length`` and texts without
    repeats stay as they are, an empty table gives none, and long texts are searched a block at a time.
    """
    _, found = repeated_bytes(df, id_col, text_col, length, spare_first)
    at = df.columns.index(text_col)
    names = [f"c{k}" for k in range(len(df.columns))]  # no name of df can clash with the keys
    rows = df.toDF(*names).withColumn("dk", id_key(f"c{df.columns.index(id_col)}")).withColumn("rk", F.xxhash64(text_or_empty(f"c{at}")))
    schema = T.StructType([T.StructField(n, f.dataType if k != at else T.StringType()) for k, (n, f) in enumerate(zip(names, df.schema.fields, strict=True))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, repeats in zip(batch.column(at).to_pylist(), intervals(batch.column(len(names))), strict=True):
                raw = (text or "").encode()
                gone = covered(len(raw), repeats, length)
                texts.append(np.frombuffer(raw, np.uint8)[~gone].tobytes().decode("utf-8", "ignore") if repeats else text or "")
            columns = list(batch.columns[: len(names)])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.join(found, ["dk", "rk"], "left").select(*names, "repeats").mapInArrow(work, schema).toDF(*df.columns)
