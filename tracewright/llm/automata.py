"""Substring deduplication by words with suffix automata.

The corpus is its own reference here, so the reference can't be broadcast: it grows with the input. It is dealt out
instead. The texts that may hold a repeated window meet in shards of bounded size; in each, the texts stream in document
order against a suffix automaton of those before them, whose matching statistics say where a window has stood earlier.
``remove_reference_spans`` serves a reference table with a proven bound: its automata are built once per shard of the
reference and sent to all documents; a larger reference is refused there.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import shown_id, text_or_empty
from tracewright.llm.windows import applied, covered, keyed, repeated_windows, runs_of, word_items, word_parts, words_kind

LENGTH = 20
GRAM = 7
#: Words of one broadcast reference shard and of a whole broadcast reference; an automaton has at most two states a word.
SHARD_WORDS, REFERENCE_WORDS = 50_000, 400_000


class Automaton:
    """Suffix automaton of several sequences: accepts exactly their contiguous parts."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link: list[int] = [-1]
        self.longest: list[int] = [0]

    def _state(self, longest: int, steps: dict, link: int) -> int:
        self.next.append(steps)
        self.link.append(link)
        self.longest.append(longest)
        return len(self.next) - 1

    def _split(self, p: int, symbol: int, q: int) -> int:
        """The state of q's parts that end p's extension by symbol; a new one if q also has longer parts."""
        if self.longest[q] == self.longest[p] + 1:
            return q
        clone = self._state(self.longest[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, sequence: list) -> None:
        last = 0
        for symbol in sequence:
            q = self.next[last].get(symbol)
            if q is not None:
                last = self._split(last, symbol, q)
                continue
            p, fresh = last, self._state(self.longest[last] + 1, {}, 0)
            while p >= 0 and symbol not in self.next[p]:
                self.next[p][symbol] = fresh
                p = self.link[p]
            if p >= 0:
                self.link[fresh] = self._split(p, symbol, self.next[p][symbol])
            last = fresh

    def statistics(self, sequence: list) -> list[int]:
        """For each position the length of the longest part that ends there and that the automaton accepts."""
        state, size, out = 0, 0, []
        for symbol in sequence:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                size = self.longest[state]
            state_after = self.next[state].get(symbol)
            if state_after is None:
                size = 0
            else:
                state, size = state_after, size + 1
            out.append(size)
        return out


def earlier_in_shard(length: int):
    def resolve(texts: list[np.ndarray], copies: np.ndarray, groups: np.ndarray) -> list[list[int]]:
        """Runs of each text's window starts whose window stands in an earlier text with the same anchor."""
        out, automaton, of = [], Automaton(), None
        for text, group in zip(texts, groups.tolist(), strict=True):
            words = text.tolist()
            if group != of:
                automaton, of = Automaton(), group
                found = [0] * len(words)
            else:
                found = automaton.statistics(words)
            out.append(runs_of(np.array(found[length - 1 :]) >= length))
            automaton.add(words)
        return out

    return resolve


def kept_words(raw: bytes, gone: np.ndarray | None) -> tuple[int, bytes]:
    """(number of words, those that aren't gone, unchanged, joined by one blank)."""
    at, kept = 0, []
    for words in word_parts(raw):
        kept.append(b" ".join(words if gone is None else compress(words, ~gone[at : at + len(words)])))
        at += len(words)
    return at, b" ".join(x for x in kept if x)


def without_repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep_text: bool = False) -> DataFrame:
    """Removes each word that a window of ``length`` words covers which also starts earlier: in a smaller document id, or earlier in the same one.

    Per row: id, n_words, n_removed, kept_sha256 and, with keep_text, ``kept``. Words are runs of anything but ASCII white
    space; windows are judged on the input. A null text has no words; a null id comes before all others and stays null; rows
    with equal id and text count as one document, those with equal id and different texts are ordered by a hash of the text;
    an empty table gives none; very long texts are searched whole, their places being one row each; other columns are ignored.
    """
    docs = keyed(df, id_col, text_col)
    found = repeated_windows(docs, words_kind(length, GRAM), earlier_in_shard(length), spare_first=True)

    def work(dk: int, raw: bytes, repeats: tuple | None) -> tuple:
        n = sum(map(len, word_parts(raw))) if repeats else 0
        gone = covered(n, repeats, length) if repeats else None
        n, kept = kept_words(raw, gone)
        row = (dk, n, int(gone.sum()) if repeats else 0, hashlib.sha256(kept).hexdigest())
        return (*row, kept.decode()) if keep_text else row

    rows = applied(docs, found, work, "dk long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * keep_text)
    return rows.select(shown_id(F.col("dk")).alias(id_col), *[c for c in rows.columns if c != "dk"])


def remove_reference_spans(
    df: DataFrame, reference: DataFrame, id_col: str = "doc_id", text_col: str = "text", reference_text_col: str = "text", length: int = LENGTH
) -> DataFrame:
    """Removes maximal spans of at least ``length`` words that also stand in a text of a small reference table.

    The reference's words are counted first; more than REFERENCE_WORDS raise ValueError (deduplicate the union of both tables
    with ``without_repeated_spans`` then). Nulls, repeats and other columns: as there.
    """
    spark = df.sparkSession
    texts = reference.select(text_or_empty(reference_text_col).cast("binary").alias("raw"))
    words = texts.agg(F.sum(F.regexp_count(F.col("raw").cast("string"), F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] or 0
    if words > REFERENCE_WORDS:
        raise ValueError(f"the reference has {words} words; at most {REFERENCE_WORDS} are broadcast")
    automata, filled = [Automaton()], 0
    for row in texts.distinct().collect():  # bounded by REFERENCE_WORDS
        items = word_items(bytes(row["raw"])).tolist()
        if filled and filled + len(items) > SHARD_WORDS:
            automata.append(Automaton())
            filled = 0
        automata[-1].add(items)
        filled += len(items)
    shards = spark.sparkContext.broadcast(automata)

    def work(dk: int, raw: bytes, repeats: None) -> tuple:
        items = word_items(raw).tolist()
        gone = np.zeros(len(items), bool)
        for automaton in shards.value:
            for end, size in enumerate(automaton.statistics(items)):
                if size >= length:
                    gone[end + 1 - size : end + 1] = True
        return dk, len(items), int(gone.sum()), kept_words(raw, gone)[1].decode()

    docs = keyed(df, id_col, text_col)
    nothing = spark.createDataFrame([], "dk long, rk long, repeats array<struct<los:array<long>,width:long,runs:array<long>>>")
    rows = applied(docs, nothing, work, "dk long, n_words long, n_removed long, kept string")
    return rows.select(shown_id(F.col("dk")).alias(id_col), "n_words", "n_removed", "kept")
